"""SimHash near-duplicates by self-joins of binary tries.

Fingerprints: words split at ASCII white space, A-Z lower-cased, word shingles with repeats (a shorter text is one shingle; a wordless
one has fingerprint 0). A shingle's XXH64 with seed 42 gives 64 bits, further words of a longer fingerprint are mixed from it; a bit
is 1 if it is in more than half of the hashes.

Two settings. CONTRACT: 3-word shingles, 64 bits, links at 2 or fewer differing bits. NEAR: sets of 5-word shingles (no repeats) with a
similarity (Jaccard) of 0.8 or more. Its 256 bits only propose, with a bit limit that is that of the worst pair of sets at 0.8 with
three deviations more. Each proposed group is then decided on the shingle sets themselves: a group is cut into blocks of bounded size,
pairs of blocks are tasks, and only pairs of sets that reach the similarity are linked. What a task takes is bounded; a group of m
different texts costs m / block copies of each of its sets, copies with equal sets count once.

Join: equal fingerprints count once. Several tries hold the fingerprints, each under a bit order of its own, and the nodes at one depth
of each are the tasks. CONTRACT has one trie for each of three blocks of bits and that block on top: a pair with 2 errors has a block
without any, so it meets in a node and none is lost. NEAR has random orders; the depth follows the number of fingerprints, so that a
node holds about `leaf` of them at every size, and the number of tries follows the depth, so that a pair at 0.8 meets in some node with
likelihood `recall`. A node of more than `HOT` fingerprints is cut into blocks whose pairs are the tasks, so no task grows with the
input. In a task the tries below its nodes are walked in pairs of nodes: differing bits add up, and a pair of nodes is dropped as soon
as the error budget is exceeded or all below it is linked already. A spanning forest of the links found leaves the task, so a dense
group costs one row for each member and no task goes through all pairs of a group of copies. Alternating stars join the forests.

Defined cases: null and empty texts share fingerprint 0 and are linked like any other; ties cannot occur, the smallest doc_id
names a component; documents without doc_id get the component of their group, null if no member has an id; repeated rows each get a
row. Extra columns are ignored by `near_duplicates` and kept by `drop_near_duplicates`, which leaves one row of each component: that
with the smallest doc_id (rows without one come last), then the smallest digest of its text, then of all its columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, load, materialise, over_arrow, raw_texts, sieve
from .components import components

SEED = 42
_FRONTIER, _BRUTE = 1 << 18, 64
#: Fingerprints of a node beyond which it is cut into blocks; rows that a task walks at a time.
HOT, _ROWS = 1 << 16, 1 << 17
_MIX = np.uint64(0x9E3779B97F4A7C15)


def differing_bits(share: float, bits: int) -> int:
    """Bits that differ where each does with that likelihood, with three standard deviations, so that hardly any pair at the bound is missed."""
    return math.floor(bits * share + 3 * math.sqrt(bits * share * (1 - share)))


@dataclass(frozen=True)
class Setting:
    """shingle: words; words: 64-bit words of a fingerprint; most: differing bits of a link; budget: those among the bits that a task walks; similarity: least Jaccard of shingle sets, as a fraction, that confirms a link (None: the bits decide); leaf: fingerprints of a node on average; share: a bit's likelihood to differ between sets at the similarity; recall: of pairs at it."""

    shingle: int
    words: int
    most: int
    budget: int
    similarity: tuple[int, int] | None = None
    leaf: int = 256
    share: float = 0.0
    recall: float = 1.0


CONTRACT = Setting(shingle=3, words=1, most=2, budget=2)
#: Of all sets at 0.8, four shingles against five differ in the most bits: 3 of 16 (long texts: acos(8 / 9) / pi, or 0.15).
NEAR = Setting(shingle=5, words=4, most=differing_bits(3 / 16, 256), budget=differing_bits(3 / 16, 64), similarity=(4, 5), share=math.acos(8 / 9) / math.pi, recall=0.99)
#: Sets, and shingles, of a block of a proposed group.
BLOCK_SETS, BLOCK_SHINGLES = 4096, 1 << 22
#: Behind a fingerprint that is confirmed by its set: digest and size of the set.
_DIGEST, _SIZE = 12, 4


def shingle_hashes(raw: bytes | None, k: int) -> np.ndarray:
    words = (raw or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - k + 1)


def shingle_set(raw: bytes | None, k: int) -> np.ndarray:
    """Ascending, without repeats."""
    return np.unique(shingle_hashes(raw, k))


def set_key(h: np.ndarray) -> bytes:
    """Digest and size of a set of shingles."""
    return xxhash.xxh3_128_digest(h.tobytes())[:_DIGEST] + len(h).to_bytes(_SIZE, "big")


def _widened(h: np.ndarray, words: int) -> np.ndarray:
    """(hashes, words): the hash itself, then independent mixes of it."""
    out = np.empty((len(h), words), np.uint64)
    out[:, 0] = h
    for w in range(1, words):
        x = (h + np.uint64(w)) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[:, w] = x ^ (x >> np.uint64(32))
    return out


def _majority(hashes: list[np.ndarray], words: int) -> np.ndarray:
    """(texts, words) of uint64: fingerprints of texts that all have hashes."""
    sizes = np.array([len(h) for h in hashes])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ones = np.zeros((len(hashes), 64 * words), np.int64)
    stream, most = np.concatenate(hashes), (1 << 17) // words
    for lo in range(0, len(stream), most):
        part = _widened(stream[lo : lo + most], words)
        bits = np.unpackbits(part.astype(">u8").view(np.uint8), axis=1)
        first, last = np.searchsorted(begin, lo, "right") - 1, np.searchsorted(begin, lo + len(part), "left")
        ones[first:last] += np.add.reduceat(bits, np.maximum(begin[first:last] - lo, 0), axis=0, dtype=np.int32)
    return np.packbits(2 * ones > sizes[:, None], axis=1).view(">u8").astype(np.uint64)


def prints_of(raw: list[bytes | None], s: Setting = CONTRACT) -> list[bytes]:
    """A fingerprint's bytes for each text, with the set's key behind where sets confirm."""
    out: list[bytes] = []
    held: list[np.ndarray] = []

    def flush() -> None:
        some = [h for h in held if len(h)]
        found = iter(_majority(some, s.words).astype(">u8") if some else ())
        for h in held:
            out.append((next(found).tobytes() if len(h) else bytes(8 * s.words)) + (b"" if s.similarity is None else set_key(h)))
        held.clear()

    size = 0
    for text in raw:
        h = shingle_hashes(text, s.shingle) if s.similarity is None else shingle_set(text, s.shingle)
        held.append(h)
        size += len(h)
        if size > (1 << 17) // s.words:
            flush()
            size = 0
    flush()
    return out


def fingerprint(docs: DataFrame, s: Setting = CONTRACT) -> DataFrame:
    """(doc_id, digest, fp) over whole texts. digest: of the text, null where it is."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(prints_of(raw_texts(batch.column("text")), s), pa.binary())], names=["doc_id", "digest", "fp"])

        return work

    return over_arrow(keyed(docs, "text"), "doc_id long, digest binary, fp binary", make)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("digest"), *[text.alias(m) for m in more])


class Forest:
    """Union-find over 0..n-1 on whole arrays of links."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = self.parent[i], self.parent[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up


class TrieJoin:
    """Links all positions of one task whose values differ in at most `budget` of their top `bits` and whose `distance`, a metric, is at most `most`.

    values: uint64, ascending within each task; first: where each task begins. A node is a range; the ones below it split off by
    running sums. A frontier of node pairs goes down bit by bit, those of all tasks together, and a pair is dropped if its errors
    exceed the budget or if all its members are linked to each other already.
    """

    def __init__(self, values: np.ndarray, first: np.ndarray, bits: int, budget: int, distance: Callable[[np.ndarray, np.ndarray], np.ndarray], most: int) -> None:
        self.value, self.first, self.bits, self.budget, self.distance, self.most = values, first, bits, budget, distance, most
        self.forest = Forest(len(values))
        self.fresh = False
        self.sums: dict[int, np.ndarray] = {}

    def _ones(self, depth: int) -> np.ndarray:
        if depth not in self.sums:
            self.sums[depth] = np.concatenate([np.zeros(1, np.int32), np.cumsum((self.value >> np.uint64(63 - depth) & np.uint64(1)).astype(np.int32), dtype=np.int32)])
        return self.sums[depth]

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Confirms pairs that are not linked yet."""
        apart = self.forest.parent[i] != self.forest.parent[j]
        i, j = i[apart], j[apart]
        for lo in range(0, len(i), 1 << 20):
            ok = self.distance(i[lo : lo + (1 << 20)], j[lo : lo + (1 << 20)]) <= self.most
            if ok.any():
                self.forest.add(i[lo : lo + (1 << 20)][ok], j[lo : lo + (1 << 20)][ok])
                self.fresh = False

    def _open(self, la: np.ndarray, ha: np.ndarray, lb: np.ndarray, hb: np.ndarray) -> np.ndarray:
        """Pairs of ranges that are not yet of one tree altogether."""
        if not self.fresh:
            root = self.forest.parent
            self.turns = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
            self.fresh = True
        root, turns = self.forest.parent, self.turns
        return (root[la] != root[lb]) | (turns[la] != turns[ha - 1]) | (turns[lb] != turns[hb - 1])

    def _pairs(self, la: np.ndarray, ha: np.ndarray, lb: np.ndarray, hb: np.ndarray) -> None:
        """All pairs of each pair of ranges."""
        width = hb - lb
        size = (ha - la) * width
        start = np.cumsum(size) - size
        k, w = np.arange(size.sum()) - np.repeat(start, size), np.repeat(width, size)
        i, j = np.repeat(la, size) + k // w, np.repeat(lb, size) + k % w
        ok = np.bitwise_count((self.value[i] ^ self.value[j]) >> np.uint64(64 - self.bits)) <= self.budget
        ok &= i < j
        self._link(i[ok], j[ok])

    def _leaves(self, la: int, ha: int, lb: int, hb: int) -> None:
        """Two large leaves: first their heads and neighbours, then what is still apart, tree by tree."""
        i, j = np.arange(la, ha), np.arange(lb, hb)
        self._link(i, np.full(len(i), lb))
        self._link(np.full(len(j), la), j)
        if la == lb:
            self._link(i[:-1], i[1:])
        members = i if la == lb else np.concatenate([i, j])
        root = self.forest.parent[members]
        trees, inverse, sizes = np.unique(root, return_inverse=True, return_counts=True)
        for t in np.argsort(sizes, kind="stable")[:-1]:  # all but the largest tree, against all others
            own, rest = members[inverse == t], members[inverse != t]
            # by the triangle inequality the others that are far from one member are far from all
            radius = self.distance(own, np.full(len(own), own[0])).max()
            rest = rest[self.distance(rest, np.full(len(rest), own[0])) <= self.most + radius]
            if not len(rest):
                continue
            for lo in range(0, len(own), max(1, (1 << 20) // len(rest))):
                part = own[lo : lo + max(1, (1 << 20) // len(rest))]
                self._link(np.repeat(part, len(rest)), np.tile(rest, len(part)))

    def run(self) -> Forest:
        last = np.append(self.first[1:], len(self.value))
        many = last > self.first + 1
        lo, hi = self.first[many], last[many]
        stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
        levels = min(self.budget + 1, 4)
        while stack:
            depth, la, ha, lb, hb, err = stack.pop()
            if len(la) > _FRONTIER:
                stack += [(depth, *(x[lo : lo + _FRONTIER] for x in (la, ha, lb, hb, err))) for lo in range(0, len(la), _FRONTIER)]
                continue
            left = self._open(la, ha, lb, hb)
            la, ha, lb, hb, err = (x[left] for x in (la, ha, lb, hb, err))
            small = (ha - la) * (hb - lb) <= _BRUTE
            for lo in range(0, int(small.sum()), _FRONTIER // 8):
                self._pairs(*(x[small][lo : lo + _FRONTIER // 8] for x in (la, ha, lb, hb)))
            la, ha, lb, hb, err = (x[~small] for x in (la, ha, lb, hb, err))
            if depth == self.bits:
                for pair in zip(la.tolist(), ha.tolist(), lb.tolist(), hb.tolist(), strict=True):
                    if self._open(*(np.array([x]) for x in pair))[0]:
                        self._leaves(*pair)
                continue
            if not len(la):
                continue
            ones = self._ones(depth)
            ma, mb = ha - (ones[ha] - ones[la]), hb - (ones[hb] - ones[lb])
            # of a node with itself, zeros against ones are enough
            apart = la != lb
            kids = [(la, ma, lb, mb, err), (ma, ha, mb, hb, err), (la, ma, mb, hb, err + 1), tuple(x[apart] for x in (ma, ha, lb, mb, err + 1))]
            la, ha, lb, hb, err = (np.concatenate(x) for x in zip(*kids, strict=True))
            alive = (ha > la) & (hb > lb) & (err <= self.budget)
            la, ha, lb, hb, err = (x[alive] for x in (la, ha, lb, hb, err))
            # the pairs with fewer errors last, so that they are linked first and close others
            level = err * levels // (self.budget + 1)
            for e in range(levels - 1, -1, -1):
                if (at := level == e).any():
                    stack.append((depth + 1, *(x[at] for x in (la, ha, lb, hb, err))))
        return self.forest


def tables_needed(bits: int, depth: int, share: float, recall: float) -> int:
    """Random tries after which a pair, whose bits differ with that likelihood, has met in a node with likelihood `recall`."""
    d = np.arange(bits - depth + 1)
    log_choose = np.array([math.lgamma(bits + 1) - math.lgamma(x + 1) - math.lgamma(bits - x + 1) for x in d])
    weight = np.exp(log_choose + d * math.log(share) + (bits - d) * math.log1p(-share))
    meet = np.exp(np.array([sum(math.log((bits - x - i) / (bits - i)) for i in range(depth)) for x in d]))
    n = 1
    while (weight * (1 - meet) ** n).sum() + max(0.0, 1 - weight.sum()) > 1 - recall:
        n += 1
    return n


def tries(total: int, s: Setting) -> list[tuple[np.ndarray, int]]:
    """(order of the bits, depth of the nodes) of every trie for that many fingerprints."""
    bits = 64 * s.words
    if s.similarity is None:
        blocks = np.array_split(np.arange(bits), s.most + 1)
        return [(np.concatenate([b, np.setdiff1d(np.arange(bits), b)]), len(b)) for b in blocks]
    depth = max(8, math.ceil(math.log2(max(1, total) / s.leaf)))
    return [(np.random.default_rng((SEED, t)).permutation(bits), depth) for t in range(tables_needed(bits, depth, s.share, s.recall))]


def _bits(fp: pa.Array, words: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(fp.to_pylist()), np.uint8).reshape(-1, 8 * words), axis=1)


def _word(bits: np.ndarray) -> np.ndarray:
    """Up to 64 bits as the top ones of a word."""
    packed = np.packbits(bits, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, 8 - packed.shape[1])))).view(">u8").astype(np.uint64)[:, 0]


def _nodes(bits: np.ndarray, table: int, order: np.ndarray, depth: int) -> np.ndarray:
    return (_word(bits[:, order[:depth]]) >> np.uint64(64 - depth)).astype(np.int64) | table << 48


def links(table: DataFrame, s: Setting = CONTRACT, hot: int | None = None) -> DataFrame:
    """Spanning links (u, v) of column node among distinct fingerprints (fp, node)."""
    hot = HOT if hot is None else hot
    plan = tries(table.count(), s)
    walked = min(64, min(64 * s.words - depth for _, depth in plan))

    def count():
        def work(batch: pa.RecordBatch) -> pa.Table:
            bits = _bits(batch.column("fp"), s.words)
            found = [np.unique(_nodes(bits, t, order, depth), return_counts=True) for t, (order, depth) in enumerate(plan)]
            return pa.table({"of": np.concatenate([f[0] for f in found]), "n": np.concatenate([f[1] for f in found])})

        return work

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(lo, 1 << 14)
                bits = _bits(part.column("fp"), s.words)
                for t, (order, depth) in enumerate(plan):
                    value = _word(bits[:, order[depth : depth + walked]]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(_nodes(bits, t, order, depth)), pa.array(value), part.column("fp"), part.column("node")], names=["task", "value", "fp", "node"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tasks come one behind the other; they are walked many at a time, and a batch's last task waits for the next batch."""
        held: list[pa.RecordBatch] = []

        def done(rows: pa.Table, end: int) -> Iterator[pa.RecordBatch]:
            rows = rows.slice(0, end)
            key = [rows.column(c).to_numpy() for c in ("value", "task", "i", "j")]
            value = key[0].view(np.uint64)
            order = np.lexsort((value, *key[1:]))
            turn = np.any([k[order][1:] != k[order][:-1] for k in key[1:]], axis=0)
            first = np.concatenate([[0], np.flatnonzero(turn) + 1])
            fp = np.frombuffer(b"".join(rows.column("fp").to_pylist()), ">u8").astype(np.uint64).reshape(-1, s.words)[order]
            node = rows.column("node").to_numpy()[order]
            distance = lambda x, y: np.bitwise_count(fp[x] ^ fp[y]).sum(1, dtype=np.int64)
            parent = TrieJoin(value[order], first, walked, s.budget, distance, s.most).run().parent
            child = np.flatnonzero(parent != np.arange(len(parent)))
            yield pa.RecordBatch.from_arrays([pa.array(node[child]), pa.array(node[parent[child]])], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _ROWS:
                rows = pa.Table.from_batches(held).combine_chunks()
                key = [rows.column(c).to_numpy() for c in ("task", "i", "j")]
                turns = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
                if len(turns):
                    yield from done(rows, int(turns[-1]) + 1)
                    rows = rows.slice(int(turns[-1]) + 1)
                held = rows.combine_chunks().to_batches()
        if held and (rows := pa.Table.from_batches(held)).num_rows:
            yield from done(rows.combine_chunks(), rows.num_rows)
            del rows
        held.clear()
        give_back()

    rows = table.select("fp", "node")
    dealt = rows.mapInArrow(deal, "task long, value long, fp binary, node long")
    crowded = over_arrow(rows, "of long, n long", count, rows=1 << 20).groupBy("of").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    crowded = materialise(crowded.select("of", F.ceil(F.col("n") / hot).cast("int").alias("blocks")), "crowded", small=True)
    if crowded.isEmpty():
        dealt = dealt.withColumns({"i": F.lit(0), "j": F.lit(0)})
    else:  # a block meets each other block of its node
        met = dealt.join(crowded, F.col("task") == F.col("of"), "left").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block"))))
        met = met.withColumn("block", F.coalesce("block", F.lit(0))).withColumn("other", other)
        dealt = met.select("task", "value", "fp", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    keys = ["task", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(walk, "u long, v long")


def alike(sets: list[np.ndarray], similarity: tuple[int, int]) -> list[tuple[int, int]]:
    """Spanning links of the graph of all pairs of sets (without repeats) whose Jaccard similarity is enough. Empty sets have none."""
    up, down = similarity
    size = np.array([len(x) for x in sets], np.int64)
    left = np.flatnonzero(size)
    if len(left) < 2:
        return []
    seen, ids = np.unique(np.concatenate(sets), return_inverse=True)
    of = np.split(ids, np.cumsum(size)[:-1])
    mark = np.zeros(len(seen), bool)
    found, queue, packed = [], [], None
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        i = queue.pop()
        near = left[(down * size[left] >= up * size[i]) & (down * size[i] >= up * size[left])]
        if not len(near):
            continue
        if packed is None or 2 * len(left) < len(packed[0]):
            packed = left, np.concatenate([of[x] for x in left]), np.cumsum(size[left]) - size[left]
        mark[of[i]] = True
        if 4 * len(near) < len(packed[0]):
            both = np.array([np.count_nonzero(mark[of[x]]) for x in near])
        else:
            both = np.add.reduceat(mark[packed[1]], packed[2], dtype=np.int64)[np.searchsorted(packed[0], near)]
        mark[of[i]] = False
        own = near[down * both >= up * (size[near] + size[i] - both)]
        found += [(i, int(x)) for x in own]
        queue += own.tolist()
        left = np.setdiff1d(left, own, assume_unique=True)
    return found


def confirmed(docs: DataFrame, table: DataFrame, proposed: DataFrame, s: Setting) -> DataFrame:
    """Links (u, v) of nodes of (fp, node, least) whose shingle sets are alike, among the members of each component of `proposed` (u, v).

    The sets are made again from the texts of the members alone, one for each node. Every pair of a component meets in a task.
    """
    of = proposed.select(F.col("u").alias("member"), F.col("v").alias("c")).unionByName(proposed.select(F.col("v").alias("member"), F.col("v").alias("c")).distinct())
    length = 8 * s.words + _DIGEST
    n = F.conv(F.hex(F.substring("fp", length + 1, _SIZE)), 16, 10).cast("long")
    members = materialise(table.join(of, F.col("node") == F.col("member")).select("fp", "node", "least", "c", n.alias("n")), "members", small=True)
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sized = members.groupBy("c").agg(blocks.alias("blocks")).withColumnRenamed("c", "of_c")
    placed = members.join(sized, F.col("c") == F.col("of_c")).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(raw, s.shingle) for raw in raw_texts(batch.column("text"))]
            return pa.RecordBatch.from_arrays([pa.array([set_key(h) for h in sets], pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())], names=["key", "shingles"])

        return work

    # `least` is the smallest id of a node's texts; those without any id are looked for among all texts without id
    ids = members.select(F.col("least").alias("id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("of_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(sieve(ids, "id")(F.col("of_id")))  # so few texts are shuffled where the ids are too many to broadcast
    sets = over_arrow(texts.join(ids, F.col("of_id").eqNullSafe(F.col("id")), "left_semi").select("text"), "key binary, shingles binary", make)
    sets = sets.groupBy("key").agg(F.first("shingles").alias("shingles"))
    held = placed.withColumn("of_key", F.substring("fp", 8 * s.words + 1, _DIGEST + _SIZE)).join(sets, F.col("of_key") == F.col("key"))
    # a block meets each other block of its component, or itself if it is the only one
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (F.col("blocks") == 1) | (x != F.col("block")))
    dealt = held.withColumn("other", F.explode(others)).select("c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "shingles")

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        found = np.array(alike([np.frombuffer(x, np.uint64) for x in pdf["shingles"]], s.similarity), np.int64).reshape(-1, 2)
        node = pdf["node"].to_numpy()
        if len(pdf) > 256:
            give_back()
        return pd.DataFrame({"u": node[found[:, 0]], "v": node[found[:, 1]]})

    return dealt.groupBy("c", "i", "j").applyInPandas(decide, "u long, v long")


def grouped(docs: DataFrame, s: Setting) -> tuple[DataFrame, DataFrame]:
    """((doc_id, digest, fp) of every document, (of_fp, group) of every distinct fingerprint). The number of a group is of no meaning."""
    prints = materialise(fingerprint(docs, s), "fingerprints")
    # numbered where it is written, once
    table = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).coalesce(max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))
    table = materialise(table.withColumn("node", F.monotonically_increasing_id()), "distinct")
    bits = F.substring("fp", 1, 8 * s.words)
    narrow = table.select(bits.alias("fp"), "node")
    if s.similarity is not None:  # sets that differ may share all bits
        same = materialise(narrow.groupBy("fp").agg(F.min("node").alias("head")).withColumnRenamed("fp", "of_fp"), "same", small=True)
        narrow = same.select(F.col("of_fp").alias("fp"), F.col("head").alias("node"))
        joined = table.select("node", bits.alias("fp")).join(same, F.col("fp") == F.col("of_fp")).where("node != head").select(F.col("node").alias("u"), F.col("head").alias("v"))
        stars = components(links(narrow, s).unionByName(joined))
        stars = components(confirmed(docs, table, stars, s))
    else:
        stars = components(links(narrow, s))
    return prints, table.join(stars, table.node == stars.u, "left").select(F.col("fp").alias("of_fp"), F.coalesce("v", "node").alias("group"), "least")


def near_duplicates(docs: DataFrame, s: Setting = CONTRACT) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    prints, of = grouped(docs, s)
    names = of.groupBy("group").agg(F.min("least").alias("component_id")).withColumnRenamed("group", "named")
    of = of.join(names, F.col("group") == F.col("named")).select("of_fp", "component_id")
    return prints.join(of, F.col("fp") == F.col("of_fp")).select("doc_id", F.substring("fp", 1, 8 * s.words).alias("fp"), "component_id")


def drop_near_duplicates(docs: DataFrame, s: Setting = NEAR) -> DataFrame:
    """One row of each component, with all columns."""
    prints, of = grouped(docs, s)
    texts = prints.groupBy("fp", "doc_id", "digest").agg(F.count("*").alias("rows")).join(of.drop("least"), F.col("fp") == F.col("of_fp"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    texts = materialise(texts.select("group", "doc_id", "digest", "rows", key.alias("key")), "texts", small=True)
    stays = texts.groupBy("group").agg(F.min("key").alias("first")).withColumnRenamed("group", "named")
    told = texts.join(stays, F.col("group") == F.col("named")).withColumn("stays", F.col("key") == F.col("first"))
    told = materialise(told.where("rows > 1 or not stays").select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), "stays"), "told", small=True)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(F.col("text").cast("string"))).alias("digest"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & F.col("digest").eqNullSafe(F.col("of_digest"))
    # rows that the sieve clears stay where they are; only the others are shuffled
    held = sieve(told, "of_id", "of_digest")(F.col("id"), F.col("digest"))
    own, cleared = own.where(held), own.where(~held)
    left = cleared.select("row.*").unionByName(own.join(told, same, "left_anti").select("row.*"))
    again = told.where("stays")
    if again.isEmpty():
        return left
    # only rows that repeat an id with its text meet here
    one = own.join(again, same, "left_semi").groupBy("id", "digest").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.unionByName(one.select("row.*"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(load(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
