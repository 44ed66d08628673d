"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the run, t from 0 to 1. Its cumulative demand for words is the integral of the schedule,
scaled to the source's target; inverting it at a document's place in the source's stream gives the document's training position.
Streams run over a source's documents in the order of a keyed digest, a second time where the target exceeds the source's size.
Copies whose middle lies before the target are taken, so whole documents are taken and a source misses its target by half a
document at most. `ranked` range-sorts the copies by position and gives each its place in the training order; the query returns the
positions and places of a document's first and last copy.

Prefix sums are taken in blocks (source, leading digits of the digest), so a hot source is dealt over many tasks.
Defined cases: a null text has size 0; a null source is a source of its own, last in the order; a null doc_id sorts as the empty
key; repeated rows are documents of their own; an empty table gives an empty mix. Extra columns are kept,
whatever their names. The table of sources, a row for each source, is the only thing the driver holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, load, materialise

WEIGHTS = (5, 2, 1)
#: Relative weight at the start and at the end of the run, by the same cycle as WEIGHTS.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
SHARE, MOST = 1.5, 2
#: A source is dealt over 16 ** DIGITS blocks; a table of at most MOST_BROADCAST sources is broadcast.
DIGITS, MOST_BROADCAST = 3, 50_000


@dataclass(frozen=True)
class Share:
    source: str | None
    size: int
    target: float
    start: float
    end: float


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, ramps=RAMPS, share: float = SHARE, most: int = MOST) -> list[Share]:
    """Targets by weight, none above `most` times its source's size; the excess goes to the others by weight until none is above."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    rows = [(most * n / weights[i % len(weights)], i, s, n, weights[i % len(weights)], ramps[i % len(ramps)]) for i, (s, n) in enumerate(ordered)]
    total, capped, left, out, level = share * sum(n for _, n in ordered), 0, sum(r[4] for r in rows), [], None
    for ratio, _, source, n, weight, (start, end) in sorted(rows, key=lambda r: r[:2]):
        now = (total - capped) / left
        if level is None and ratio > now:
            level = now
        out.append(Share(source, n, float(most * n) if level is None else level * weight, start, end))
        capped, left = capped + most * n, left - weight
    return out


def position(share: Column, start: Column, end: Column) -> Column:
    """t at which a source with a weight going linearly from start to end has met that share of its demand."""
    slope = end - start
    area = (start + end) / 2
    root = F.sqrt(F.greatest(start * start + 2 * slope * area * share, F.lit(0.0)))
    return F.when(F.abs(slope) < 1e-9, share).otherwise((root - start) / F.when(F.abs(slope) < 1e-9, 1.0).otherwise(slope))


def _key_of(source: Column) -> Column:
    """A source as a key without nulls, so that window and join are dealt alike; in the sources' order, null last."""
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ramps=RAMPS, share: float = SHARE, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """A row for each document: struct `doc` of the kept columns (all by default), size, source_size, target, taken, positions (a training position for each copy that is taken) and tie, which names the row and orders equal positions.

    Documents are dealt once, by (source, block): the window's own dealing serves the join with the blocks' offsets.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    columns = [_key_of(F.col("source").cast("string")).alias("part"), key.alias("key"), F.substring(key, 1, DIGITS).alias("block"), word_count(F.col("text").cast("string")).alias("size")]
    # sums of blocks: sources * 16 ** DIGITS rows at most, and the only other reading of the texts
    blocks = materialise(docs.select(*columns).groupBy("part", "block").agg(F.sum("size").alias("n")), "blocks", small=True)
    totals = {k: n for k, n in blocks.groupBy("part").agg(F.sum("n")).collect()}
    names = {k: k[1:] if k[0] == "1" else None for k in totals}
    keys = {s: k for k, s in names.items()}
    shares = targets([(names[k], n) for k, n in totals.items()], weights, ramps, share, most)
    table = spark.createDataFrame([(keys[x.source], x.size, x.target, x.start, x.end) for x in shares], "of_part string, source_size long, target double, start double, end double")
    table = F.broadcast(table) if len(shares) <= MOST_BROADCAST else table
    sized = docs.select(F.struct(*keep).alias("doc"), *columns)
    by_block = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("part", "block", F.coalesce(F.sum("n").over(by_block), F.lit(0)).alias("before"))
    ordered = Window.partitionBy("part", "block").orderBy("key", "size")
    within = ordered.rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).withColumn("row", F.row_number().over(ordered))
    placed = placed.join(blocks, ["part", "block"]).join(table, F.col("part") == F.col("of_part"))
    middle = F.col("before") + F.col("within") + F.col("size") / 2
    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: middle + i * F.col("source_size")), lambda m: m < F.col("target"))
    placed = placed.withColumn("copies", copies)
    places = F.transform("copies", lambda m: position(m / F.col("target"), F.col("start"), F.col("end")))
    return placed.select("doc", "size", "source_size", "target", (F.size("copies") * F.col("size")).cast("long").alias("taken"), places.alias("positions"), F.struct("part", "key", "size", "row").alias("tie"))


def _ranged(copies: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    ranged = copies.repartitionByRange(partitions, *order) if partitions else copies.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def training_order(docs: DataFrame, partitions: int | None = None, **options) -> DataFrame:
    """The mix itself: a row for each taken copy, with the documents' columns, range-sorted by training position."""
    copies = plan_mix(docs, **options).select("doc", "tie", F.posexplode("positions").alias("copy", "position"))
    return _ranged(copies, ["position", "tie", "copy"], partitions).select("doc.*")


def ranked(mix: DataFrame) -> DataFrame:
    """(tie, copy, position, place) of all copies of a mix: place counts from 0 in training order.

    The copies are range-sorted and written; the counts of the ranges, a row for each, give their offsets.
    """
    copies = mix.select("tie", F.posexplode("positions").alias("copy", "position"))
    rows = _ranged(copies, ["position", "tie", "copy"]).withColumn("at", F.monotonically_increasing_id())
    rows = materialise(rows.withColumns({"range": F.shiftright("at", 33).cast("int"), "at": F.col("at").bitwiseAND((1 << 33) - 1)}), "copies")
    counts = sorted((r[0], r[1]) for r in rows.groupBy("range").count().collect())
    starts, total = [], 0
    for k, n in counts:
        starts.append((k, total))
        total += n
    table = mix.sparkSession.createDataFrame(starts, "of_range int, start long")
    table = F.broadcast(table) if len(starts) <= MOST_BROADCAST else table
    return rows.join(table, F.col("range") == F.col("of_range")).select("tie", "copy", "position", (F.col("start") + F.col("at")).alias("place"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ["size", "source_size", "target", "taken"]
    mix = plan_mix(load(spark, sf_dir, "documents"), keep=["doc_id"]).select(F.col("doc.doc_id").alias("doc_id"), *shown, "positions", "tie")
    mix = materialise(mix, "mix", small=True)
    of = ranked(mix).groupBy(F.col("tie").alias("of_tie")).agg(*[f(c).alias(f"{name}_{c}") for c in ("position", "place") for name, f in (("first", F.min), ("last", F.max))])
    return mix.join(of, F.col("tie") == F.col("of_tie"), "left").select("doc_id", *shown, "first_position", "last_position", "first_place", "last_place")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source IS NULL, encode(source)) AS i
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
    CASE (i - 1) % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS a,
    CASE (i - 1) % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS b
  FROM totals
), levels AS (
  SELECT *, 2 * source_size / w::DOUBLE AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE)
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM weighted
  WINDOW before AS (ORDER BY 2 * source_size / w::DOUBLE, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT source, source_size, a, b, i,
    CASE WHEN ratio > cut THEN cut * w ELSE 2.0::DOUBLE * source_size END AS target
  FROM (SELECT *, coalesce((SELECT arg_min(level, (ratio, i)) FROM levels WHERE ratio > level), 1e300) AS cut FROM levels)
), placed AS (
  SELECT doc_id, size, source_size, target, a, b, i, k, row_number() OVER (PARTITION BY i ORDER BY k, size) AS n,
    size / 2.0::DOUBLE + coalesce(sum(size) OVER (PARTITION BY i ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS middle
  FROM sized s JOIN shares t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, CASE WHEN a = b THEN m / target
      ELSE (sqrt(greatest(a * a + 2 * (b - a) * ((a + b) / 2) * (m / target), 0::DOUBLE)) - a) / (b - a) END AS position
  FROM (SELECT *, 0 AS c, middle AS m FROM placed UNION ALL SELECT *, 1 AS c, middle + source_size AS m FROM placed)
  WHERE m < target
), ranked AS (
  SELECT i, n, position, row_number() OVER (ORDER BY position, i, k, size, n, c) - 1 AS place FROM copies
), found AS (
  SELECT i, n, min(position) AS first_position, max(position) AS last_position, min(place)::BIGINT AS first_place, max(place)::BIGINT AS last_place
  FROM ranked GROUP BY i, n
)
SELECT doc_id, size, source_size, target, (size * ((middle < target)::INT + (middle + source_size < target)::INT))::BIGINT AS taken,
  first_position, last_position, first_place, last_place
FROM placed p LEFT JOIN found f ON p.i = f.i AND p.n = f.n
"""
