"""Language identification by partial matching (PPM) with byte context trees.

For every language a context tree of order 3 over the bytes of lower-cased UTF-8 is counted, then frozen. A byte's probability is
that of the longest context seen, with escapes (method C: q symbols seen n times in all leave q / (n + q)) to shorter contexts
down to a uniform one over all 256 bytes, and symbols of the longer context excluded in the shorter. The code length of a text is exact:
the sum of -log2 of these over all its bytes. The language with the shortest code wins.

A tree is sparse: for each order the (context, byte) pairs seen, with the bits that each costs, and the contexts seen, with the bits of
their escape. No byte and no context of the sample is left out. A byte that its context has not shown costs the escape and what the next
shorter context says. Texts are scored by their distinct windows of four bytes, each looked up once in a batch.

Training: documents are kept by a digest of id and text, `sample_rows` for each language in expectation (a bounded, documented sample);
that with the smallest digest is kept in any case, and a text that is kept counts once, however often it is repeated. Trees have a size
that follows from the sample, about 1 MB for a language. Prediction reads whole texts.

Defined cases: null, empty and letterless texts give `und` with score 0, as does a corpus without training rows. Languages that
tie go to the smaller name. Null doc_id counts as the empty text in the split. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import digest_part, load, over_arrow

ORDER = 3
SAMPLE_ROWS = 400
#: Bits of a symbol in a window's code: 0 stands before the text, a byte is its value + 1.
_SYMBOL = 9
_WINDOW = 1 << 22


@dataclass
class Tree:
    """By order: codes of (context, byte) ascending and their bits, contexts ascending and the bits of their escapes."""

    codes: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def cost(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window, given those before it."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for k in range(ORDER, -1, -1):
            code = grams[left] & ((1 << _SYMBOL * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.codes[k], code), len(self.codes[k]) - 1)
            shown = self.codes[k][at] == code
            out[left[shown]] += self.bits[k][at[shown]]
            left, code = left[~shown], code[~shown] >> _SYMBOL
            at = np.minimum(np.searchsorted(self.contexts[k], code), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == code
            out[left[known]] += self.escapes[k][at[known]]
        out[left] += 8
        return out


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]


def _grams(text: str) -> np.ndarray:
    """Codes of the four-byte windows; a byte is its value + 1, and 0 stands before the text."""
    return _codes(np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8))


def _codes(raw: np.ndarray) -> np.ndarray:
    b = np.concatenate([np.zeros(ORDER, np.int64), raw.astype(np.int64) + 1])
    out = np.zeros(len(raw), np.int64)
    for k in range(ORDER + 1):
        out = out << _SYMBOL | b[k : len(b) - ORDER + k]
    return out


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over whole texts of the rows given."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            by: dict[str, list[np.ndarray]] = defaultdict(list)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by[lang].append(_grams(text or ""))
            parts = [(lang, *np.unique(np.concatenate(g), return_counts=True)) for lang, g in by.items()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, g, _ in parts for _ in range(len(g))], pa.string()),
                    pa.array(np.concatenate([g for _, g, _ in parts])),
                    pa.array(np.concatenate([n for *_, n in parts]).astype(np.int64)),
                ],
                names=["lang", "gram", "n"],
            )

        return work

    return over_arrow(docs.select("lang", "text"), "lang string, gram long, n long", make).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(grams: list[tuple[str, int, int]]) -> Model | None:
    """Frozen trees from (lang, gram, n)."""
    if not grams:
        return None
    by: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for lang, gram, n in grams:
        by[lang].append((gram, n))
    return Model(sorted(by), [_tree(*np.array(by[lang], np.int64).T) for lang in sorted(by)])


def _tree(grams: np.ndarray, n: np.ndarray) -> Tree:
    codes, bits, contexts, escapes = [], [], [], []
    shorter: tuple[np.ndarray, np.ndarray] | None = None  # codes of the order below and their probabilities
    for k in range(ORDER + 1):
        code, inverse = np.unique(grams & ((1 << _SYMBOL * (k + 1)) - 1), return_inverse=True)
        count = np.bincount(inverse, n)
        context, of = np.unique(code >> _SYMBOL, return_inverse=True)
        shown, total = np.bincount(of), np.bincount(of, count)
        p = count / (total + shown)[of]
        # what is shown here was shown in the shorter context too; its share there is excluded
        below = np.full(len(code), 1 / 256) if shorter is None else shorter[1][np.searchsorted(shorter[0], code & ((1 << _SYMBOL * k) - 1))]
        rest = 1 - np.bincount(of, below)
        escape = shown / (total + shown) / np.maximum(rest, 1e-12)
        codes.append(code)
        bits.append(-np.log2(p))
        contexts.append(context)
        escapes.append(-np.log2(escape))
        shorter = code, p
    return Tree(codes, bits, contexts, escapes)


def code_lengths(model: Model, texts: list[str | None]) -> np.ndarray:
    """Bits of every whole text under every language; shape (texts, languages)."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    out = np.zeros((len(texts), len(model.languages)))
    held: list[np.ndarray] = []
    whose: list[int] = []

    def flush() -> None:
        if not held:
            return
        code, grams = pd.factorize(np.concatenate(held))
        starts = np.cumsum([0, *(len(h) for h in held[:-1])])
        for x, tree in enumerate(model.trees):
            np.add.at(out[:, x], whose, np.add.reduceat(tree.cost(grams)[code], starts))
        held.clear()
        whose.clear()

    size = 0
    for i, r in enumerate(raw):
        b = np.frombuffer(r, np.uint8)
        for lo in range(0, len(b), _WINDOW):  # a long text goes through in parts, each with the bytes before it
            before = min(lo, ORDER)
            held.append(_codes(b[lo - before : lo + _WINDOW])[before:])
            whose.append(i)
            size += len(held[-1])
            if size >= _WINDOW:
                flush()
                size = 0
    flush()
    return out


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The kept columns, lang_pred, score (the posterior under equal priors), bits_per_byte of the winner."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), "lang_pred string, score double, bits_per_byte double"])

    def make():
        model = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            if model is None:
                best = [("und", 0.0, None)] * len(texts)
            else:
                bits = code_lengths(model, texts)
                top = bits.argmin(1)
                low = bits[np.arange(len(texts)), top]
                score = 1 / np.exp2(-np.minimum(bits - low[:, None], 1000)).sum(1)
                best = [(model.languages[k], s, b / max(1, len(t.encode("utf-8", "replace")))) if t and any(map(str.isalpha, t)) else ("und", 0.0, None) for t, k, s, b in zip(texts, top, score.tolist(), low.tolist(), strict=True)]
            columns = [pa.array(c, t) for c, t in zip(zip(*best, strict=True), (pa.string(), pa.float64(), pa.float64()), strict=True)]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "lang_pred", "score", "bits_per_byte"])

        return work

    return over_arrow(kept, schema, make)


def remainder(doc_id: Column, by: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(by))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fits on about `sample_rows` documents of each language; all of a language with fewer."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("part", digest_part(F.col("doc_id"), F.col("text")))
    told = {r[0]: (r[1], r[2]) for r in rows.groupBy("lang").agg(F.count("*"), F.min("part")).collect()}
    if not told:
        return None
    most = F.create_map(*[F.lit(x) for lang, (n, least) in told.items() for x in (lang, max(least, sample_rows / n))])[F.col("lang")]
    # a task for the sample of each language: every task counts its own grams, so many small ones would repeat the frequent grams
    sample = rows.where(F.col("part") <= most).select("lang", "text").distinct().coalesce(len(told))
    grams = count_grams(sample)
    return fit(sorted((r[0], r[1], r[2]) for r in grams.collect()))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held))
    return identify(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"]).drop("bits_per_byte")
