"""URL filter by association rules.

Given rules (host, path) decide the urls that they fit, and those verdicts are the labels to learn from. FP-growth mines combinations of
url tokens that go with a label, over all urls that have one; rules of enough support and confidence are kept, those that a shorter kept
rule already implies at no less confidence are dropped, and an inverted index from tokens to rules judges all other urls: of the rules
that fit, the surest decide.

Tokens of a url: scheme, all labels of the host from the right with their depth and their words (split at hyphens), all path parts
with their depth, the shape of every part (digits, letters, mixed), extension, all keys of the query. No url is cut. Itemsets have at
most `LONGEST` tokens, and support counts within the urls of a verdict, so that a rare verdict has rules too, and is `FEWEST` urls at least. Patterns are grown from
the end of each frequent token's prefixes, a task for a token; the driver holds frequent tokens, at most tokens of a url / support for
each verdict, and all rules that no shorter one implies.

Defined cases: a null url or one without :// has empty host and path, and the method judges its (empty) tokens, which is the default
verdict. Without any labelled url there are no mined rules and all other urls get the default. Repeated rows each get a row; a null
page_id is kept. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise

#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DEFAULT, BLOCK = "allow", 0.5
SUPPORT, FEWEST, CONFIDENCE, LONGEST = 0.005, 5, 0.6, 4
VERDICTS = ("allow", "block")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def host_words(host: Column) -> Column:
    """Words of the host's labels, which hyphens part."""
    return F.array_distinct(F.filter(F.split(host, r"[.-]"), lambda w: w != ""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url."""
    url = F.coalesce(url, F.lit(""))
    labels = F.reverse(F.split(host, r"\."))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    shape = lambda p: F.when(p.rlike("^[0-9]+$"), "digits").when(p.rlike("^[A-Za-z]+$"), "letters").otherwise("mixed")
    keys = F.transform(F.filter(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"), lambda q: q != ""), lambda q: F.concat(F.lit("q:"), F.regexp_extract(q, "^[^=]*", 0)))
    found = F.concat(
        F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)))),
        F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x)),
        F.transform(host_words(host), lambda x: F.concat(F.lit("w:"), x)),
        F.array(F.concat(F.lit("n:"), F.size(labels).cast("string"))),
        F.transform(parts, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), x)),
        F.transform(parts, lambda x, i: F.concat(F.lit("f"), i.cast("string"), F.lit(":"), shape(x))),
        F.array(F.concat(F.lit("x:"), F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))),
        keys,
    )
    return F.array_distinct(F.filter(found, lambda t: ~t.rlike("^[a-z][0-9]*:$")))


@dataclass
class Rules:
    """Mined rules as (tokens, confidence of block), and the inverted index from a rule's rarest token."""

    rules: list[tuple[frozenset[str], float]]
    index: dict[str, list[int]]

    def judge(self, tokens: list[str] | None) -> float:
        """Confidence of block by the surest of the rules that fit, their mean if several are; without any the default."""
        own = set(tokens or ())
        surest, found = 0.0, []
        for t in own:
            for r in self.index.get(t, ()):
                need, block = self.rules[r]
                if need <= own:
                    sure = abs(block - 0.5)
                    if sure > surest:
                        surest, found = sure, []
                    if sure == surest:
                        found.append(block)
        return sum(found) / len(found) if found else float(DEFAULT == "block")


def grow(base: dict[tuple[int, ...], np.ndarray], suffix: tuple[int, ...], least: np.ndarray, longest: int, out: list) -> None:
    """FP-growth over a pattern base (ascending items: counts in all and for each verdict): adds (items, counts) of all sets with the suffix, at most `longest` items, that are frequent for a verdict."""
    counts: dict[int, np.ndarray] = {}
    for items, n in base.items():
        for x in items:
            counts[x] = counts[x] + n if x in counts else n
    for x, n in counts.items():
        if (n[1:] < least).all():
            continue
        found = (x, *suffix)
        out.append((found, n))
        if len(found) < longest:
            below: dict[tuple[int, ...], np.ndarray] = {}
            for items, m in base.items():
                if x in items and (head := items[: items.index(x)]):
                    below[head] = below[head] + m if head in below else m
            grow(below, found, least, longest, out)


def itemsets(urls: DataFrame, support: float, longest: int) -> DataFrame:
    """(need, all, allow, block, allow_least, block_least): sets of at most `longest` tokens, with their counts among all urls and those of a verdict, frequent for a verdict if in `support` of its urls."""
    spark = urls.sparkSession
    schema = "need array<string>, all long, " + ", ".join(f"{v} long" for v in VERDICTS) + ", " + ", ".join(f"{v}_least long" for v in VERDICTS)
    sums = [F.sum(v).alias(v) for v in ("all", *VERDICTS)]
    ones = [F.lit(1).cast("long").alias("all"), *[F.coalesce((F.col("verdict") == v).cast("long"), F.lit(0)).alias(v) for v in VERDICTS]]
    marked = urls.select("tokens", *ones)
    total = marked.agg(*[F.sum(v).alias(v) for v in VERDICTS]).first()
    least = [max(FEWEST, math.ceil(support * (total[v] or 0))) for v in VERDICTS]
    often = marked.select(F.explode("tokens").alias("token"), "all", *VERDICTS).groupBy("token").agg(*sums)
    often = often.where(F.lit(False) if not any(total[v] for v in VERDICTS) else (F.col(VERDICTS[0]) >= least[0]) | (F.col(VERDICTS[1]) >= least[1]))
    order = [r[0] for r in often.orderBy(F.desc("all"), "token").select("token").collect()]
    shared = spark.sparkContext.broadcast({x: i for i, x in enumerate(order)})
    names = spark.sparkContext.broadcast(order)

    @F.arrow_udf("array<int>")
    def ranks(tokens: pa.Array) -> pa.Array:
        of = shared.value
        return pa.array([sorted({of[x] for x in row or () if x in of}) for row in tokens.to_pylist()], pa.list_(pa.int32()))

    rows = marked.select(ranks("tokens").alias("items"), "all", *VERDICTS).groupBy("items").agg(*sums)
    heads = rows.select(F.posexplode("items").alias("at", "item"), "items", "all", *VERDICTS)
    heads = heads.select("item", F.expr("slice(items, 1, at)").alias("head"), "all", *VERDICTS).groupBy("item", "head").agg(*sums)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        item, counts = int(pdf["item"].iloc[0]), pdf[["all", *VERDICTS]].to_numpy(np.int64)
        out = [((item,), counts.sum(0))]
        if longest > 1:
            grow({tuple(h): n for h, n in zip((x.tolist() for x in pdf["head"]), counts, strict=True) if h}, (item,), np.array(least), longest, out)
        return pd.DataFrame([[sorted(names.value[x] for x in items), *n.tolist(), *least] for items, n in out], columns=[x.split()[0] for x in schema.split(", ")])

    return heads.groupBy("item").applyInPandas(work, schema)


def mine(urls: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, longest: int = LONGEST) -> Rules:
    """Rules from columns tokens and verdict (null: no label, nothing to learn from)."""
    sets = materialise(itemsets(urls.where("verdict is not null"), support, longest), "itemsets", small=True)
    sides = F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("freq"), F.col(f"{v}_least").alias("least")) for v in VERDICTS]))
    rules = sets.select("need", "all", sides.alias("side")).select("need", "side.*", (F.col("side.freq") / F.col("all")).alias("confidence"))
    rules = rules.where((F.col("freq") >= F.col("least")) & (F.col("confidence") >= confidence)).drop("least")
    # a rule with a part that is as sure of the same verdict is implied; rows of at most 2 ** longest parts a rule
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), F.size("need")) - 2).cast("int"))
    parts = F.transform(masks, lambda m: F.filter("need", lambda t, i: F.getbit(m, i) == 1))
    rules = materialise(rules, "rules", small=True)
    shorter = rules.select(F.col("need").alias("part"), F.col("verdict").alias("of_verdict"), F.col("confidence").alias("surer"))
    split = rules.where(F.size("need") > 1).select("need", "verdict", "confidence", F.explode(parts).alias("of"))
    implied = split.join(shorter, (F.col("of") == F.col("part")) & (F.col("verdict") == F.col("of_verdict")) & (F.col("surer") >= F.col("confidence")))
    rows = rules.join(implied.select("need", "verdict").distinct(), ["need", "verdict"], "left_anti").collect()
    kept = {frozenset(r["need"]): (r["verdict"], r["confidence"]) for r in rows}
    spread: dict[str, int] = defaultdict(int)
    for need in kept:
        for t in need:
            spread[t] += 1
    out, index = [], defaultdict(list)
    for need in sorted(kept, key=sorted):
        verdict, c = kept[need]
        index[min(need, key=lambda t: (spread[t], t))].append(len(out))
        out.append((need, c if verdict == "block" else 1 - c))
    return Rules(out, dict(index))


def url_filter(pages: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, score (confidence of block)."""
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    told = parsed.withColumn("rule", rule).withColumn("given", verdict).withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path")))
    mined = mine(told.select("tokens", F.col("given").alias("verdict")), support, confidence)
    shared = pages.sparkSession.sparkContext.broadcast(mined)

    @F.arrow_udf("double")
    def judge(tokens: pa.Array) -> pa.Array:
        return pa.array([shared.value.judge(t) for t in tokens.to_pylist()], pa.float64())

    scored = told.withColumn("mined", judge("tokens"))
    score = F.when(F.col("given").isNull(), F.col("mined")).otherwise((F.col("given") == "block").cast("double"))
    return scored.withColumn("score", score).select("page_id", "host", "path", "rule", F.when(F.col("score") >= BLOCK, "block").otherwise("allow").alias("verdict"), "score")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(load(spark, sf_dir, "pages"))
