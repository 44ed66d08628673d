"""Order MinHash fingerprints, with DataFrame and SQL functions only.

A text's k-mers are runs of five words (split at ASCII white space, A-Z lower-cased); a shorter text is one k-mer. Each k-mer is
numbered by its occurrence, and (k-mer, occurrence) is hashed. Every component has a permutation of its own: k-mers whose hash names the
component come first, by hash, then all others, by the hash mixed with the component. Of the whole text the `take` first of that order
are selected, put back into text order, and hashed together. So a component agrees only where the same k-mers were selected and stand in
the same order, which makes the share of agreeing components follow edit distance rather than the bag of k-mers alone.

A k-mer names each component equally likely and by its own hash alone, so within a component all orders are equally likely. One sort
of a text's hashes serves all components that `take` k-mers name; only the others, which short texts have, look at all k-mers again.

Likeness: agreeing components over all. Two wordless texts are alike (1), a wordless and a worded one not (0). A wordless text's
fingerprint is dashes.

Whole texts are read, every row by itself: the only things shuffled are texts (once, to meet the text before), ids and fingerprints.
Defined cases: a null text counts as empty; documents with the same id all get the next id's text, of several texts that with the
smallest; documents without id come before all others; places of k-mers beyond 2 ** 24 repeat,
which only weakens their order. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_block, id_bounds, load, materialise, shuffle_partitions

KMER, COMPONENTS, TAKE = 5, 32, 2
#: COMPONENTS is a power of two. Bits of a k-mer's place in the text, below its hash, whose top bits name a component.
_PLACE = 24
_LAST = (1 << 63) - 1
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fingerprint(df: DataFrame, text: str, name: str, kmer: int = KMER, parts: int = COMPONENTS, take: int = TAKE) -> DataFrame:
    """df with column `name`: `parts` components of eight hex digits, dashes for a wordless text.

    Steps, each a pass over the row's arrays: word hashes; k-mer hashes in text order; hashes of (k-mer, occurrence) with the place in
    the low bits, sorted, so that those that name a component stand together; the first `take` of each; for a component with fewer, the
    rest from all others; places back in order; one hash for each component. Only texts that repeat a k-mer are sorted once more, for
    the occurrence numbers. An array that a lambda looks into is named twice in its step: named once, the optimizer would write its
    expression into the lambda and compute it again for each element.
    """
    low = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    step = df.withColumn("_w", F.transform(F.filter(F.split(low, _SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)))
    step = step.withColumn("_n", F.size("_w"))
    # hashes of runs; the last ones, which are shorter, are cut off again
    runs = F.slice(F.transform("_w", lambda w, i: F.xxhash64(F.slice("_w", i + 1, kmer))), F.lit(1), F.greatest(F.col("_n") - (kmer - 1), F.lit(0)))
    step = step.withColumn("_k", F.when((F.col("_n") == 0) | (F.col("_n") >= kmer), runs).otherwise(F.array(F.xxhash64("_w")))).drop("_w")
    step = step.withColumn("_n", F.size("_k"))
    # texts with repeats: k-mers sorted by hash, places in as many low bits as the text needs; occurrences count from where a run of equal ones begins
    step = step.withColumn("_p", F.length(F.bin("_n")))
    high = lambda x: F.call_function("shiftright", x, F.col("_p"))
    packed = F.sort_array(F.transform("_k", lambda h, i: F.call_function("shiftleft", high(h), F.col("_p")).bitwiseOR(i.cast("bigint"))))
    step = step.withColumn("_s", F.when(F.size(F.array_distinct("_k")) < F.col("_n"), packed))
    starts = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: (i == 0) | (high(F.get("_s", i)) != high(F.get("_s", i - 1))))
    step = step.withColumn("_b", F.when(F.col("_s").isNotNull(), starts))
    spans = F.zip_with("_b", F.concat(F.slice("_b", 2, F.greatest(F.size("_b"), F.lit(1))), F.array("_n")), lambda a, b: F.sequence(F.lit(0), b - a - 1))
    step = step.withColumn("_o", F.when(F.col("_b").isNotNull(), F.flatten(F.filter(spans, lambda x: x.isNotNull())))).drop("_b")
    place = (1 << _PLACE) - 1
    entry = lambda h, at: h.bitwiseAND(~place).bitwiseOR(at.cast("bigint").bitwiseAND(place))
    at = lambda x: (x - F.call_function("shiftleft", high(x), F.col("_p"))).cast("int")
    again = F.transform("_s", lambda x, i: F.coalesce(entry(F.xxhash64(F.get("_k", at(x)), F.get("_o", i)), at(x)), F.lit(0)))
    once = F.transform("_k", lambda h, i: entry(F.xxhash64(h, F.lit(0)), i))
    step = step.withColumn("_h", F.sort_array(F.when(F.col("_o").isNull(), once).otherwise(again))).drop("_s", "_o", "_k", "_p")
    shift = 64 - (parts - 1).bit_length()
    part = lambda x: F.shiftright(x, shift) + (1 << (63 - shift))  # noqa: E731  from 0, in the order of signed longs
    step = step.withColumn("_c", F.filter("_h", lambda x, i: (i < take) | (part(F.get("_h", i - take)) != part(x))))

    def others(c: Column, own: Column) -> Column:
        """The k-mers that do not name the component, in the order of its own hashes, as many as it lacks."""
        mixed = F.sort_array(F.transform("_h", lambda x: F.when(part(x) == c, F.lit(_LAST)).otherwise(entry(F.xxhash64(F.shiftright(x, _PLACE), c), x.bitwiseAND(place)))))
        return F.slice(mixed, F.lit(1), F.least(F.lit(take), F.col("_n")) - F.size(own))

    numbers = F.sequence(F.lit(0), F.lit(parts - 1))
    own = F.transform(numbers, lambda c: F.filter("_c", lambda x: part(x) == c))
    filled = F.transform(own, lambda m, c: F.when(F.size(m) == take, m).otherwise(F.concat(m, others(c, m))))
    step = step.withColumn("_m", F.when(F.size("_c") == parts * take, F.transform(numbers, lambda c: F.slice("_c", c * take + 1, take))).when(F.col("_n") > 0, filled)).drop("_h", "_c", "_n")
    # the place on top, so that the members are sorted back into text order; then the place off again
    turned = lambda x: F.shiftleft(x, 64 - _PLACE).bitwiseOR(F.shiftrightunsigned(x, _PLACE)).bitwiseXOR(F.lit(-1 << 63))
    digest = lambda m: F.substring(F.lpad(F.lower(F.hex(F.xxhash64(F.transform(F.sort_array(F.transform(m, turned)), lambda x: x.bitwiseAND((1 << (64 - _PLACE)) - 1))))), 16, "0"), 9, 8)
    return step.withColumn(name, F.coalesce(F.array_join(F.transform("_m", digest), ""), F.lit("-" * (8 * parts)))).drop("_m")


def likeness(a: str, b: str, parts: int = COMPONENTS) -> Column:
    """Share of agreeing components among those filled in either: all of them, unless both texts are wordless."""
    at = F.lit([8 * i + 1 for i in range(parts)])
    cut = lambda c, i: F.substring(F.col(c), i, F.lit(8))
    filled = F.size(F.filter(at, lambda i: (cut(a, i) != "--------") | (cut(b, i) != "--------")))
    same = F.size(F.filter(at, lambda i: (cut(a, i) == cut(b, i)) & (cut(a, i) != "--------")))
    return F.when(filled == 0, 1.0).otherwise(same / filled)


def _id(docs: DataFrame) -> list[Column]:
    """The id as two columns without nulls: whether there is one, and it or 0."""
    key = F.col("doc_id").cast("long")
    return [key.isNotNull().alias("named"), F.coalesce(key, F.lit(0)).alias("id")]


def neighbours(ids: DataFrame) -> DataFrame:
    """(named, id, next_named, next_id) of distinct (named, id), ascending, those not named first; the last one's next is the first. Range blocks keep windows small; the table of blocks has a row for each of a fixed number."""
    spark = ids.sparkSession
    bounds = id_bounds(ids.where("named"), "id", max(2, min(1024, 4 * shuffle_partitions(spark))))
    blocked = ids.distinct().withColumn("block", F.when(F.col("named"), id_block(F.col("id"), bounds)).otherwise(-1))
    heads = {r[0]: r[1] for r in blocked.groupBy("block").agg(F.min("id")).collect()}
    order = sorted(heads)
    after = [(b, order[(i + 1) % len(order)] >= 0, heads[order[(i + 1) % len(order)]]) for i, b in enumerate(order)]
    table = spark.createDataFrame(after, "of_block int, head_named boolean, head long")
    inside = F.lead("id").over(Window.partitionBy("block").orderBy("id"))
    met = blocked.withColumn("inside", inside).join(F.broadcast(table), F.col("block") == F.col("of_block"))
    return met.select("named", "id", F.when(F.col("inside").isNull(), F.col("head_named")).otherwise(True).alias("next_named"), F.coalesce("inside", "head").alias("next_id"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """(named, id, next_named, next_id, text, n_chars, edited): the last quarter of a text replaced by as much of the head of the next document.

    Texts are dealt by id once; the heads come from the same exchange, which both uses read with the same columns.
    """
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(*_id(docs), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chain = neighbours(rows.select("named", "id"))
    placed = rows.repartition(parts, "named", "id").withColumn("n_chars", F.length("text").cast("long"))

    def same(named: str, of: str) -> Column:
        return (F.col("named") == F.col(named)) & (F.col("id") == F.col(of))

    # how much of a document the one before it needs: the longest of equal ids
    need = docs.select(*_id(docs), F.coalesce(F.length("text"), F.lit(0)).alias("n")).groupBy("named", "id").agg((F.max("n") / 4).cast("int").alias("need"))
    need = chain.join(need.withColumnsRenamed({"named": "before_named", "id": "before_id"}), same("before_named", "before_id"))
    need = need.select(F.col("next_named").alias("head_named"), F.col("next_id").alias("head_id"), "before_named", "before_id", "need")
    heads = placed.join(need, same("head_named", "head_id")).select("before_named", "before_id", F.expr("substring(text, 1, need)").alias("head"))
    heads = heads.groupBy("before_named", "before_id").agg(F.min("head").alias("head"))
    out = placed.join(heads, same("before_named", "before_id"))
    out = out.join(chain.withColumnsRenamed({"named": "chain_named", "id": "chain_id"}), same("chain_named", "chain_id"))
    cut = F.floor(F.col("n_chars") / 4)
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 4) as int))"), F.substring("head", F.lit(1), cut.cast("int")))
    return out.select("named", "id", "next_named", "next_id", "text", "n_chars", edited.alias("edited"))


def order_minhash(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    texts = edited_texts(docs)
    prints = fingerprint(fingerprint(texts, "text", "fingerprint").drop("text"), "edited", "edited_fingerprint")
    prints = prints.withColumn("edited_sha256", F.sha2(F.col("edited"), 256)).drop("edited")
    table = materialise(prints, "fingerprints")
    after = table.groupBy("named", "id").agg(F.min("fingerprint").alias("after")).withColumnsRenamed({"named": "after_named", "id": "after_id"})
    out = table.join(after, (F.col("next_named") == F.col("after_named")) & (F.col("next_id") == F.col("after_id")))
    return out.select(F.when(F.col("named"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "after").alias("near_next"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash(load(spark, sf_dir, "documents"))
