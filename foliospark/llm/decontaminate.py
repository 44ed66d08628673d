"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts become words: lower-cased runs of letters and digits of any script, and single characters of scripts that are written without
spaces; all else separates. A document holds an item of n words if some stretch of it
is within k = floor(n * (1 - similarity)) word edits of the item.

1. Windows. An item within k edits shares, by the pigeonhole principle, a run of at least (n - k) / (k + 1) unchanged words with the
   stretch. So windows of the item's size are laid only where a document shares a run of min(3, that) words with some item; no
   stretch within the budget is lost by this.
2. CGK. A random walk driven by shared coins writes a window and an item as strings of three times the item's length, so that few
   edits give few differing places. Windows of one size are embedded together.
3. LSH. Several walks, each with several samples of places; a window and an item that agree on all places of a sample are
   candidates. The number of repetitions is raised until seeded trials on the items themselves, edited up to the full budget, reach
   the target recall. Where MOST_WALKS do not reach it for a size, every window laid for an item of that size is a candidate for it,
   which loses none.
4. Exact semi-global edit distance (bit-parallel) around every candidate decides.

The items are a stated query set: they go through in blocks of `block_items`, and only a block at a time is broadcast.
Defined cases: a null or wordless text or item matches nothing; repeated items and documents are each reported; an empty table
gives no rows; an item or text of any length goes through in parts of bounded memory. Extra columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, load, over_arrow

SIMILARITY, RECALL, BLOCK_ITEMS = 0.8, 0.99, 20_000
WALKS, SAMPLES, MOST_WALKS = 2, 8, 24
SEED_WORDS, STRETCH, CLASSES, SEED = 3, 3, 1024, 20_240_229
#: Words of the windows that are embedded at a time; sizes up to which coins are kept.
_EMBEDDED, _KEPT = 1 << 21, 512
_SEPARATORS = {b: " " for b in range(128) if not chr(b).isalnum()}
#: Scripts without spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
_ALONE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_APART, _WORD = re.compile(f"[{_ALONE}]"), re.compile(r"[^\W_]+")
_SCRIPTS = re.compile(f"[{_ALONE}]|[^\\W_{_ALONE}]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    low = (text or "").lower()
    if low.isascii():
        return low.translate(_SEPARATORS).split()
    return (_SCRIPTS if _APART.search(low) else _WORD).findall(low)


def budget(n: int, similarity: float = SIMILARITY) -> int:
    return int(n * (1 - similarity) + 1e-9)


def seed_words(n: int, k: int) -> int:
    return max(1, min(SEED_WORDS, (n - k) // (k + 1)))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coins(n: int, walk: int) -> np.ndarray:
    """Shared coins of a walk: whether to go on after writing a word, by step and by class of the word."""
    return _kept_coins(n, walk) if n <= _KEPT else _kept_coins.__wrapped__(n, walk)


@lru_cache(maxsize=256)
def _kept_coins(n: int, walk: int) -> np.ndarray:
    return np.random.default_rng((SEED, n, walk, 1)).integers(0, 2, (STRETCH * n, CLASSES), np.uint8)


def embed(words: np.ndarray, walk: int) -> np.ndarray:
    """CGK: (windows, n) word numbers to (STRETCH * n, windows). Past its end a window writes -1."""
    count, n = words.shape
    flat = np.concatenate([words, np.full((count, 1), -1, words.dtype)], 1).ravel()
    kind = (flat % CLASSES).astype(np.int16)
    out = np.empty((STRETCH * n, count), words.dtype)
    at = np.arange(count, dtype=np.int64) * (n + 1)
    last = at + n
    for j, coin in enumerate(coins(n, walk)):
        flat.take(at, out=out[j], mode="clip")
        at += coin.take(kind.take(at))
        np.minimum(at, last, out=at)
    return out


def sample_places(n: int, k: int, walk: int, samples: int = SAMPLES) -> np.ndarray:
    """(samples, places) random places of an embedding; fewer places where the budget is a larger part of the item."""
    places = 3 if k else 4
    return np.random.default_rng((SEED, n, walk)).integers(0, STRETCH * n, (samples, places))


def signatures(embedded: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(windows, samples) hashes of the sampled places."""
    out = np.zeros((len(places), embedded.shape[1]), np.uint64)
    for c in range(places.shape[1]):
        out = _scramble(out * _MIX + embedded[places[:, c]].astype(np.uint64) + np.uint64(c + 1))
    return out.T


def best_stretch(item: list[int], text: list[int]) -> tuple[int, int]:
    """(edits, end) of the stretch of the text nearest to the item: Myers' bit-parallel semi-global distance over words."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text, 1):
        eq = masks.get(w, 0)
        x = eq | minus
        d0 = ((((eq & plus) + plus) ^ plus) | x) & full
        hp, hn = minus | (full & ~(d0 | plus)), plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1) & full, (hn << 1) & full
        plus, minus = hn | (full & ~(d0 | hp)), hp & d0
        if score < best:
            best, end = score, j
    return best, end


@dataclass
class Index:
    """Items of one block, ready to be matched. runs: seeds of g words to (item, offset); walks: by size of an item, 0 where all windows are candidates."""

    ids: list[int]
    items: list[np.ndarray]
    vocabulary: dict[str, int]
    similarity: float
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    walks: dict[int, int]
    tables: dict[tuple[int, int], list[dict[int, list[int]]]]


def _run_keys(words: np.ndarray, g: int) -> np.ndarray:
    key = np.zeros(max(0, len(words) - g + 1), np.uint64)
    for i in range(g):
        key = key * np.uint64(0x100000001B3) + words[i : len(words) - g + 1 + i].astype(np.uint64) + np.uint64(1)
    return key


def _edited(item: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The item after k random word edits, cut or filled to its size again as a window would be."""
    out = item.tolist()
    for _ in range(k):
        kind, at = rng.integers(3), int(rng.integers(len(out)))
        if kind == 0:
            out[at] = -2 - int(rng.integers(1 << 30))
        elif kind == 1:
            out.insert(at, -2 - int(rng.integers(1 << 30)))
        elif len(out) > 1:
            del out[at]
    n = len(item)
    return np.array((out + [-2 - int(x) for x in rng.integers(1 << 30, size=n)])[:n], np.int64)


def walks_needed(items: list[np.ndarray], k: int, recall: float, trials: int = 200, most: int | None = None) -> int:
    """Walks, each with SAMPLES samples, after which that share of trial edits met its item; 0 if MOST_WALKS are too few."""
    rng = np.random.default_rng((SEED, len(items[0]), k))
    n = len(items[0])
    chosen = [items[int(i)] for i in rng.integers(len(items), size=trials)]
    left, right = np.stack(chosen), np.stack([_edited(x, k, rng) for x in chosen])
    met = np.zeros(trials, bool)
    for walk in range(MOST_WALKS if most is None else most):
        places = sample_places(n, k, walk)
        met |= (signatures(embed(left, walk), places) == signatures(embed(right, walk), places)).any(1)
        if walk + 1 >= WALKS and met.mean() >= recall:
            return walk + 1
    return 0


def build(rows: list[tuple[int, str | None]], similarity: float = SIMILARITY, recall: float = RECALL, most_walks: int = MOST_WALKS) -> Index:
    vocabulary: dict[str, int] = {}
    ids, items = [], []
    for item_id, text in rows:
        if words := words_of(text):
            ids.append(item_id)
            items.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64))
    seeds: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    by_size: dict[int, list[int]] = defaultdict(list)
    for t, item in enumerate(items):
        by_size[len(item)].append(t)
        g = seed_words(len(item), budget(len(item), similarity))
        seeds[g] += [(int(key), t, o) for o, key in enumerate(_run_keys(item, g).tolist())]
    runs = {}
    for g, found in seeds.items():
        key = np.array([f[0] for f in found], np.uint64)
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        runs[g] = (keys, np.append(first, len(found)), np.array([f[1] for f in found])[order], np.array([f[2] for f in found])[order])
    walks, tables = {}, {}
    for n, members in by_size.items():
        k = budget(n, similarity)
        walks[n] = walks_needed([items[t] for t in members], k, recall, most=most_walks)
        block = np.stack([items[t] for t in members])
        for walk in range(walks[n]):
            table: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(SAMPLES)]
            for t, row in zip(members, signatures(embed(block, walk), sample_places(n, k, walk)).tolist(), strict=True):
                for s, h in enumerate(row):
                    table[s][h].append(t)
            tables[n, walk] = [dict(d) for d in table]
    return Index(ids, items, vocabulary, similarity, runs, walks, tables)


def windows(index: Index, words: np.ndarray) -> dict[int, np.ndarray]:
    """Windows to look at, by size: those on whose diagonal the text and an item share a run, as starts, or as (start, item) where the size has no walks."""
    out: dict[int, list[np.ndarray]] = defaultdict(list)
    sizes = np.array([len(x) for x in index.items])
    for g, (keys, first, item, offset) in index.runs.items():
        known = words >= 0
        ok = known[: max(0, len(words) - g + 1)].copy()
        for i in range(1, g):
            ok &= known[i : len(words) - g + 1 + i]
        where = np.flatnonzero(ok)
        if not len(where):
            continue
        got = _run_keys(words, g)[where]
        at = np.minimum(np.searchsorted(keys, got), len(keys) - 1)
        hit = keys[at] == got
        where, at = where[hit], at[hit]
        reps = first[at + 1] - first[at]
        rows = np.repeat(first[at], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        start, size = np.repeat(where, reps) - offset[rows], sizes[item[rows]]
        for n in np.unique(size).tolist():
            own = size == n
            out[n].append(start[own] if index.walks[n] else np.unique(np.stack([start[own], item[rows[own]]], 1), axis=0))
    return {n: np.unique(np.concatenate(s), axis=0) for n, s in out.items()}


def match(index: Index, texts: list[str | None]) -> list[tuple[int, int, int, int, int, float]]:
    """(text number, item_id, end_word, n_words, edits, similarity) of every item that a text holds, at its best place."""
    known = index.vocabulary.get
    docs = [np.fromiter((known(w, -1) for w in words_of(text)), np.int64) for text in texts]
    laid: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
    for d, words in enumerate(docs):
        for n, starts in windows(index, words).items():
            laid[n].append((d, starts))
    begin = np.concatenate([[0], np.cumsum([len(w) for w in docs])])
    stream = np.concatenate([*docs, np.full(1, -1, np.int64)])
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for n, parts in sorted(laid.items()):
        k = budget(n, index.similarity)
        owner = np.concatenate([np.full(len(s), d) for d, s in parts])
        starts = np.concatenate([s if index.walks[n] else s[:, 0] for _, s in parts])
        pairs: set[tuple[int, int]] = set()
        if not index.walks[n]:
            pairs.update(enumerate(np.concatenate([s[:, 1] for _, s in parts]).tolist()))
        step = max(1, _EMBEDDED // (STRETCH * n))
        for lo in range(0, len(starts) if index.walks[n] else 0, step):
            some, whose = starts[lo : lo + step], owner[lo : lo + step]
            # places outside the text are strangers; so are unknown words, which no item holds
            at = some[:, None] + np.arange(n)[None, :]
            inside = (at >= 0) & (at < (begin[whose + 1] - begin[whose])[:, None])
            block = np.where(inside, stream[np.where(inside, at + begin[whose][:, None], len(stream) - 1)], -1)
            block = np.where(block < 0, -2 - at - len(stream), block)
            for walk in range(index.walks[n]):
                embedded = embed(block, walk)
                rows = signatures(embedded, sample_places(n, k, walk))
                for s, table in enumerate(index.tables[n, walk]):
                    column = rows[:, s]
                    for w in np.flatnonzero(np.isin(column, np.fromiter(table, np.uint64, len(table)))).tolist():
                        pairs.update((lo + w, t) for t in table[int(column[w])])
        for w, t in sorted(pairs):
            d, start = int(owner[w]), int(starts[w])
            item = index.items[t].tolist()
            lo = max(0, start - k)
            edits, end = best_stretch(item, docs[d][lo : start + n + k].tolist())
            if edits <= k and ((d, t) not in best or (edits, lo + end) < best[d, t]):
                best[d, t] = (edits, lo + end)
    return [(d, index.ids[t], end, len(index.items[t]), edits, 1 - edits / len(index.items[t])) for (d, t), (edits, end) in sorted(best.items())]


def indexes(benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block_items: int = BLOCK_ITEMS) -> Iterator:
    """Broadcast indexes of the items, a block at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-items.count() // block_items))
    for b in range(blocks):
        rows = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(build(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), similarity, recall))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """A row for each document and item that it holds: doc_id, item_id, end_word (words up to the stretch's end), n_words, edits, similarity."""
    schema = "doc_id long, item_id long, end_word long, n_words int, edits int, similarity double"
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for shared in indexes(benchmark, **options):

        def make(shared=shared):
            index = shared.value

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                ids = batch.column("doc_id").to_pylist()
                found = [(ids[d], *m) for d, *m in match(index, batch.column("text").to_pylist())]
                return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], names=[f.split()[0] for f in schema.split(", ")])

            return work

        part = over_arrow(kept, schema, make)
        out = part if out is None else out.unionByName(part)
    return out


def _clean(shared):
    """An Arrow UDF that is true for texts without any item of a broadcast index."""

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        out = np.ones(len(texts), bool)
        for lo in range(0, len(texts), 1024):
            out[[lo + m[0] for m in match(shared.value, texts.slice(lo, 1024).to_pylist())]] = False
        give_back()
        return pa.array(out)

    return clean


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no item, with all their columns. Only texts go to Python."""
    for shared in indexes(benchmark, **options):
        docs = docs.where(_clean(shared)(F.col("text").cast("string")))
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
