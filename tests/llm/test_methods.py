"""The methods themselves, against brute force and round trips."""

from __future__ import annotations

import dataclasses
import itertools
import struct
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import decontaminate as D
from foliospark.llm import langid, order_minhash, quality, simhash, tokens, urls
from foliospark.llm.components import components


def test_feistel():
    for n in (1, 2, 3, 16, 17, 1000, 4097):
        f = tokens.Feistel(n, key=5)
        s = f.slot(np.arange(n))
        assert sorted(s.tolist()) == list(range(n)) and (f.number(s) == np.arange(n)).all()
    assert not np.array_equal(tokens.Feistel(1000, 1).slot(np.arange(1000)), tokens.Feistel(1000, 2).slot(np.arange(1000)))


def test_windows_keep_the_order():
    for n, windows in ((1, 64), (63, 64), (64, 64), (1000, 64), (1000, 7), (1000, 1)):
        w = tokens.Windows(n, windows, key=5)
        s = w.slot(np.arange(n))
        assert sorted(s.tolist()) == list(range(n)) and (w.number(s) == np.arange(n)).all() and np.abs(s - np.arange(n)).max() < -(-n // windows)
    assert np.array_equal(tokens.Windows(1000, 1, 5).slot(np.arange(1000)), tokens.Feistel(1000, 5).slot(np.arange(1000)))


def test_slots_follow_the_files(spark, tmp_path):
    """Files of several row groups and splits, read in any order: the sequences keep the files' order up to a window."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 40).cast("int")).alias("text"))
    docs.repartitionByRange(6, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "d"))
    conf = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = tokens.token_records(spark.read.parquet(str(tmp_path / "d")), length=16, windows=64).select("slot", "doc_id", "seq_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", conf)
    due = {(r.doc_id, r.seq_no): i for i, r in enumerate(sorted(rows, key=lambda r: (r.doc_id, r.seq_no)))}
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert max(abs(r.slot - due[r.doc_id, r.seq_no]) for r in rows) < -(-len(rows) // 64)


def test_files_of_any_name(spark, tmp_path):
    """Files that Spark did not name, and files of the same name in two folders, in one task."""
    for k, name in enumerate(("a/x.parquet", "b/x.parquet", "a/y.parquet")):
        (tmp_path / "d" / name).parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"doc_id": [10 * k + i for i in range(5)], "text": ["word"] * 5}), tmp_path / "d" / name)
    docs = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "d")).coalesce(1)
    rows = tokens.token_records(docs, length=16).collect()
    assert sorted(r.slot for r in rows) == list(range(15)) and len({r.doc_id for r in rows}) == 15


def test_shards_round_trip(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} with some\nwords é " * (i % 7)) for i in range(60)], "doc_id long, text string")
    records = tokens.token_records(docs, length=16, shard_records=25)
    tokens.write_shards(records, str(tmp_path / "shards"))
    got: dict[int, dict[int, np.ndarray]] = {}
    slots = []
    for slot, doc_id, seq, ids in tokens.read_slots(spark, str(tmp_path / "shards"), length=16, shard_records=25):
        slots.append(slot)
        got.setdefault(doc_id, {})[seq] = ids
    assert slots == list(range(records.count()))
    vocab = tokens.vocabulary()
    for r in docs.collect():
        ids = np.concatenate([got[r.doc_id][k] for k in sorted(got[r.doc_id])]).tolist()
        assert ids[-1] == vocab.end and vocab.encoding().decode(ids[:-1]) == r.text
    opened = []
    monkeypatch.setattr(tokens, "_open", lambda fs, file, at, real=tokens._open: opened.append((file.toString(), at)) or real(fs, file, at))
    read = tokens.read_slots(spark, str(tmp_path / "shards"), 30, 16, 2, 25, block=2)
    assert [s for s, *_ in itertools.islice(read, 5)] == [30, 31, 32, 33, 34] and len(opened) == 1 and "shard=1/" in opened[0][0] and opened[0][1] == 5 * 49
    assert [s for s, *_ in tokens.read_slots(spark, str(tmp_path / "shards"), len(slots), 16, 2, 25)] == []


def test_shards_in_turns(spark, tmp_path, monkeypatch):
    """A turn shuffles the sequences of its own shards alone, frees them at its end, and the last one marks success."""
    for shards in (1, 2, 3, 5, 58, 1000):
        ranges = list(tokens.turns(shards))
        assert [k for lo, hi in ranges for k in range(lo, hi)] == list(range(shards)) and len(ranges) <= tokens.TURNS
        assert all(hi - lo <= 0.6 * (shards - lo) + 1 for lo, hi in ranges[:-1]) and (shards < 50 or ranges[-1][1] - ranges[-1][0] <= 0.064 * shards + 1)
    docs = spark.createDataFrame([(i, f"text {i} with some\nwords é " * (i % 9)) for i in range(150)], "doc_id long, text string")
    local = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in local for f in Path(d).rglob("shuffle_*")}
    path, seen = tmp_path / "shards", []

    def write(records, path, real=tokens.write_shards, **kinds):
        before = files()
        real(records, path, **kinds)
        until = time.time() + 20
        while (left := files() - before) and time.time() < until:  # executors are told to, the driver does not wait
            time.sleep(0.1)
        seen.append((records.select("shard").distinct().count(), len(left), (tmp_path / "shards" / "_SUCCESS").exists()))

    monkeypatch.setattr(tokens, "write_shards", write)
    found = tokens.token_shards(docs, str(path), length=16, shard_records=25).collect()
    due = tokens.token_records(docs, length=16, shard_records=25).collect()
    shards = -(-len(due) // 25)
    assert [n for n, _, _ in seen] == [hi - lo for lo, hi in tokens.turns(shards)] and len(seen) > 2 and len(list(path.glob("shard=*/part-*"))) == shards
    assert not any(left for _, left, _ in seen) and [marked for *_, marked in seen] == [False] * (len(seen) - 1) + [True]
    # runs are numbered by the written documents' paths, which differ between calls; what the slots hold does not
    told = lambda rows: sorted((r.doc_id, r.seq_no, r.n_tokens, bytes(r.record)) for r in rows)
    assert told(found) == told(due) and sorted(r.slot for r in found) == list(range(len(due)))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def told_forest(fp: np.ndarray, near) -> np.ndarray:
    told = simhash.Forest(len(fp))
    for i in range(len(fp)):
        j = np.flatnonzero(near(fp[i], fp))
        told.add(np.full(len(j), i), j)
    return told.parent


@pytest.mark.parametrize("spread", [64, 14, 6])
def test_trie_join(spread):
    """Two tasks side by side, against all pairs of each."""
    rng = np.random.default_rng(spread)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    a = np.sort(np.concatenate([base, base, *(base ^ (np.uint64(1) << rng.integers(0, spread, 40).astype(np.uint64)) for _ in range(6)), rng.integers(0, 1 << spread if spread < 63 else 1 << 63, 500, np.uint64)]))
    b = np.sort(np.concatenate([a[::3] ^ np.uint64(1), rng.integers(0, 1 << 63, 300, np.uint64)]))
    both = np.concatenate([a, b])
    found = simhash.TrieJoin(both, np.array([0, len(a)]), 64, 2, lambda i, j: np.zeros(len(i), int), 0).run().parent
    told = simhash.Forest(len(both))
    for first, some in ((0, a), (len(a), b)):
        for i in range(len(some)):
            j = np.flatnonzero(np.bitwise_count(some[i] ^ some) <= 2) + first
            told.add(np.full(len(j), first + i), j)
    assert np.array_equal(found, told.parent)


def test_near_duplicates_shuffle_few_texts(spark, tmp_path, monkeypatch):
    """Nothing is broadcast, as with many documents: texts that are no near copies stay where they are, and the result is the same for a sieve that holds every row."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.bytes(6).hex() for _ in range(1500)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i] + " and more") for i in range(6)] + [(1, texts[1]), (None, texts[2]), (None, "alone"), (2000, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    local = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f: f.stat().st_size for d in local for f in Path(d).rglob("shuffle_*.data")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = simhash.drop_near_duplicates(docs)
        before = files()
        found = sorted(map(str, left.collect()))
        moved = sum(n for f, n in files().items() if f not in before)
        monkeypatch.setattr("foliospark.llm.common.MOST_SIEVE_BITS", 1)
        assert sorted(map(str, simhash.drop_near_duplicates(docs).collect())) == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 202 and moved < 0.25 * sum(len(t) for t in texts) / 2  # hexadecimal texts take half their length at least


def test_sieve(spark):
    from foliospark.llm.common import sieve

    rows = spark.range(20_000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("digest"))
    held = sieve(rows.where("id % 10 = 3 or id is null"), "id", "digest")(F.col("id"), F.col("digest"))
    told = rows.withColumn("held", held).groupBy(F.expr("id % 10 = 3 or id is null").alias("due"), "held").count().collect()
    n = {(r.due, r.held): r["count"] for r in told}
    assert n[True, True] == 2001 and (True, False) not in n and n[False, True] < 0.1 * n[False, False]
    assert rows.where(sieve(rows.limit(0), "id")(F.col("id"))).count() == 0


def test_query_writes_shards(spark, tmp_path, monkeypatch):
    """The query and the last stage commit shards and return what stands in them."""
    import corpus_pipeline

    docs = spark.createDataFrame([(i - 1 if i else None, f"text {i} with some\nwords é " * (300 * (i % 3))) for i in range(12)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    vocab, told = tokens.vocabulary(), {}
    for r in docs.collect():  # the rows of the query by hand
        ids = [*vocab.encoding().encode_ordinary(r.text), vocab.end]
        told |= {(r.doc_id, k): ids[lo : lo + 1024] for k, lo in enumerate(range(0, len(ids), 1024))}
    for k, call in enumerate((lambda: tokens.op1_token_shards(spark, str(tmp_path)), lambda: corpus_pipeline.token_stage(spark, docs, str(tmp_path)))):
        path = str(tmp_path / f"shards{k}")
        monkeypatch.setattr(tokens, "scratch_path", lambda spark, name, path=path, real=tokens.scratch_path: path if name == "shards" else real(spark, name))
        out = call()
        assert (tmp_path / f"shards{k}" / "_SUCCESS").exists() and len(list((tmp_path / f"shards{k}").glob("shard=*/part-*"))) == 1
        due = {(r.doc_id, r.seq_no, r.n_tokens, bytes(r.record)) for r in tokens.token_records(docs).collect()}
        assert {(r.doc_id, r.seq_no): list(np.frombuffer(bytes(r.record), "<u2", r.n_tokens, 16)) for r in out.collect()} == told
        found = out.collect()
        assert len(found) == len(due) and {(r.doc_id, r.seq_no, r.n_tokens, bytes(r.record)) for r in found} == due
        assert [r.slot for r in found] == list(range(len(found))) == [s for s, *_ in tokens.read_slots(spark, path)]
    monkeypatch.undo()
    assert tokens.token_shards(docs.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [30, 3000])
def test_trie_join_of_a_dense_group(copies):
    """Two groups whose values agree but whose fingerprints do not, and strangers; leaves with many members."""
    rng = np.random.default_rng(copies)
    group = np.repeat(np.array([0, 1, 2]), [copies, copies // 3, 40])
    value = np.sort(rng.integers(0, 4, len(group)).astype(np.uint64)) << np.uint64(32)
    rng.shuffle(group)
    group[group == 2] = np.arange(2, 2 + (group == 2).sum())
    calls = []

    def distance(i, j):
        calls.append(len(i))
        return np.where(group[i] == group[j], 0, 100)

    found = simhash.TrieJoin(value, np.zeros(1, int), 32, 3, distance, 65).run().parent
    assert np.array_equal(found, np.array([np.flatnonzero(group == g)[0] for g in group]))
    # ten pairs of leaves, forty strangers in all
    assert copies < 1000 or sum(calls) < 10 * 40 * len(group)


@pytest.mark.parametrize("hot", [simhash.HOT, 50])
def test_links_lose_none(spark, hot):
    """Pairs within 2 errors in any three blocks of bits, with and without crowded nodes."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, np.uint64)
    near = [base ^ (np.uint64(1) << np.uint64(x)) ^ (np.uint64(1) << np.uint64(y)) for x, y in rng.integers(0, 64, (4, 2))]
    fp = np.unique(np.concatenate([base, *near, np.arange(400, dtype=np.uint64), np.uint64(1 << 63) + np.arange(300, dtype=np.uint64)]))
    table = spark.createDataFrame([(bytearray(int(x).to_bytes(8, "big")), i) for i, x in enumerate(fp.tolist())], "fp binary, node long")
    forest = simhash.Forest(len(fp))
    for u, v in simhash.links(table, hot=hot).collect():
        forest.add(np.array([u]), np.array([v]))
    assert np.array_equal(forest.parent, told_forest(fp, lambda x, y: np.bitwise_count(x ^ y) <= 2))


@pytest.mark.parametrize("total", [1, 256_000, 15_000_000])
def test_tries_meet_pairs_at_the_bound(total):
    """Drawn pairs whose bits differ as those of sets at 0.8 do: the stated share has a node in common and stays within both bit limits."""
    rng = np.random.default_rng(5)
    plan = simhash.tries(total, simhash.NEAR)
    differ = rng.random((20_000, 256)) < simhash.NEAR.share
    met = np.zeros(len(differ), bool)
    for order, depth in plan:
        met |= ~differ[:, order[:depth]].any(1) & (differ[:, order[depth : depth + 64]].sum(1) <= simhash.NEAR.budget)
    assert (met & (differ.sum(1) <= simhash.NEAR.most)).mean() > 0.985 and total / 2 ** plan[0][1] <= simhash.NEAR.leaf


def test_long_fingerprints(spark):
    """Near copies at 0.8 and more are linked, half-alike and foreign texts are not; the same with few and with many nodes."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    texts, family, alike = [], [], []

    def shingles(t):
        return {tuple(t[i : i + 5]) for i in range(len(t) - 4)}

    for f in range(120):
        own = rng.choice(words, int(rng.integers(60, 400))).tolist()
        texts.append(own)
        family.append(f)
        alike.append(1.0)
        for share in (0.005, 0.02, 0.3):
            other = [w if rng.random() > share else "changed" + str(rng.integers(99)) for w in own]
            texts.append(other)
            family.append(f)
            alike.append(len(shingles(own) & shingles(other)) / len(shingles(own) | shingles(other)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for s in (simhash.NEAR, dataclasses.replace(simhash.NEAR, leaf=2)):
        found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, s).collect()}
        assert all(family[c] == family[d] for d, c in found.items())
        due = [d for d in found if alike[d] >= 0.8]
        assert np.mean([found[d] == 4 * family[d] for d in due]) > 0.95
        assert np.mean([found[d] == 4 * family[d] for d in found if alike[d] < 0.5]) < 0.05


def test_near_links_are_exact(spark, monkeypatch):
    """Pairs on both sides of 0.8, short ones, repeats, several texts of an id and groups of many blocks, against the exact similarity of all pairs."""
    rng = np.random.default_rng(21)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(60):
        own = rng.choice(words, int(rng.integers(10, 300))).tolist()
        texts.append(own)
        for goal in (0.72, 0.76, 0.79, 0.81, 0.85):
            # a run of new words at the end leaves n - k of n + k shingles
            n = len(own) - 4
            k = round(n * (1 - goal) / (1 + goal))
            texts.append(own[: len(own) - k] + rng.choice(words, k).tolist())
    texts += [["again"] * 400 + rng.choice(words, 60).tolist() for _ in range(4)]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    told = simhash.Forest(len(sets))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            told.add(np.array([i]), np.array([j]))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for sets_of_block in (simhash.BLOCK_SETS, 2):
        monkeypatch.setattr(simhash, "BLOCK_SETS", sets_of_block)
        found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, simhash.NEAR).collect()}
        assert [found[i] for i in range(len(texts))] == told.parent.tolist()
    left = simhash.drop_near_duplicates(docs.unionByName(spark.createDataFrame([(None, "no id " * 9), (None, "no id " * 9 + "x"), (0, "the same id again")], docs.schema)))
    assert left.count() == len(set(told.parent.tolist())) + 3


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300), (200, 250)]
    out = {r.u: r.v for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert out == {**dict.fromkeys(range(1, 41), 0), **dict.fromkeys(range(101, 160), 100), 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def edits(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_best_stretch():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, text = rng.integers(0, 5, rng.integers(1, 9)).tolist(), rng.integers(0, 6, rng.integers(0, 14)).tolist()
        told = min(edits(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
        assert D.best_stretch(item, text)[0] == told


def test_recall_of_edited_items():
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(3000)]
    items = [(t, " ".join(rng.choice(words, rng.integers(1, 70)))) for t in range(150)]
    index = D.build(items)
    texts, told = [], []
    for t, text in items:
        item = text.split()
        for _ in range(3):
            out = list(item)
            for _ in range(int(rng.integers(0, D.budget(len(item)) + 1))):
                kind, at = rng.integers(3), int(rng.integers(len(out)))
                out[at : at + 1] = [["zz"], [out[at], "yy"], []][kind] if len(out) > 1 else ["zz"]
            ends = rng.choice(words, 80).tolist()
            texts.append("  ".join([*ends[:40], *out, *ends[40:]]).upper())
            told.append((t, edits(item, out)))
    found = {(d, item) for d, item, *_ in D.match(index, texts)}
    due = [(d, t) for d, (t, e) in enumerate(told) if e <= D.budget(len(items[t][1].split()))]
    assert len(due) > 300 and np.mean([x in found for x in due]) >= 0.97
    assert not {(d, t) for d, t in found if len(items[t][1].split()) > 5} - {(d, t) for d, (t, _) in enumerate(told)}
    assert D.match(index, [" ".join(rng.choice([f"v{i}" for i in range(99)], 500))]) == []


def test_items_beyond_the_walks_lose_none():
    """Without enough walks all laid windows are verified: everything within the budget is found, against all stretches by brute force."""
    rng = np.random.default_rng(10)
    words = [f"w{i}" for i in range(60)]
    items = [(t, " ".join(rng.choice(words, rng.integers(1, 12)))) for t in range(40)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(20)] + [" ".join([*rng.choice(words, 9), *D.words_of(x)[1:], *rng.choice(words, 9)]) for _, x in items]
    index = D.build(items, most_walks=0)
    assert set(index.walks.values()) == {0}
    told = set()
    for d, text in enumerate(texts):
        own = text.split()
        for t, x in items:
            item = x.split()
            k = D.budget(len(item))
            if min(edits(item, own[i:j]) for i in range(len(own)) for j in range(i + 1, min(len(own), i + len(item) + k) + 1)) <= k:
                told.add((d, t))
    assert {(d, t) for d, t, *_ in D.match(index, texts)} == told
    usual = {(d, t) for d, t, *_ in D.match(D.build(items), texts)}
    assert usual <= told and len(usual) >= 0.97 * len(told)


def test_words_of_any_script():
    assert D.words_of("Don’t—stop, naïve café! 中文字 ab中c ไทย１２ x_y") == ["don", "t", "stop", "naïve", "café", "中", "文", "字", "ab", "中", "c", "ไ", "ท", "ย", "１２", "x", "y"]
    text = "前面的话" + "这是一个很长的基准测试题目请回答" + "后面的话"
    found = D.match(D.build([(1, "这是一个很长的基准测试题目请回答"), (2, "「这是一个」很长的基准测试题目请答")]), [text, "别的"])
    assert [(d, t) for d, t, *_ in found] == [(0, 1), (0, 2)]


def test_long_items():
    rng = np.random.default_rng(11)
    item = rng.choice([f"w{i}" for i in range(5000)], 10_000).tolist()
    text = rng.choice([f"v{i}" for i in range(50)], 3000).tolist() + [w if rng.random() > 0.05 else "zz" for w in item] + ["tail"] * 500
    found = D.match(D.build([(1, " ".join(item))]), [" ".join(text), " ".join(item[:6000])])
    assert [(d, t) for d, t, *_ in found] == [(0, 1)]


def test_cgk_keeps_near_words_near():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1000, (200, 40))
    b = np.stack([D._edited(x, 1, rng) for x in a])
    c = rng.integers(0, 1000, (200, 40))
    far = lambda x, y: (D.embed(x, 0) != D.embed(y, 0)).mean()
    assert far(a, a) == 0 and far(a, b) < 0.5 * far(a, c)


def told_ppm(texts: list[str], text: str) -> float:
    """Bits of a text by the definition: counts of every context, escapes by method C, exclusion down to the uniform order."""
    seen: dict[bytes | tuple, dict[int, int]] = {}
    symbols = lambda t: [0, 0, 0, *(b + 1 for b in t.lower().encode())]
    for t in texts:
        b = symbols(t)
        for i in range(3, len(b)):
            for k in range(4):
                shown = seen.setdefault(tuple(b[i - k : i]), {})
                shown[b[i]] = shown.get(b[i], 0) + 1

    def p(context: tuple, x: int) -> float:
        shown = seen.get(context)
        lower = (lambda y: p(context[1:], y)) if context else (lambda y: 1 / 256)
        if not shown:
            return lower(x)
        n, q = sum(shown.values()), len(shown)
        if x in shown:
            return shown[x] / (n + q)
        return q / (n + q) * lower(x) / (1 - sum(lower(y) for y in shown))

    b = symbols(text)
    return -sum(np.log2(p(tuple(b[i - 3 : i]), b[i])) for i in range(3, len(b)))


def ppm_model(texts: dict[str, list[str]]):
    grams: dict = {}
    for lang, some in texts.items():
        for t in some:
            for g in langid._grams(t).tolist():
                grams[lang, g] = grams.get((lang, g), 0) + 1
    return langid.fit([(lang, g, n) for (lang, g), n in grams.items()])


def test_ppm_by_definition(monkeypatch):
    texts = {"x": ["abracadabra abra", "cab", "ΑΒΓ абв 中文"], "y": ["zzzz yyyy zzyy", "".join(map(chr, range(32, 600)))]}
    model = ppm_model(texts)
    shown = ["abracadabra", "", "zzyy", "Αβ абвг 中国", "ÿþý\x00", "abra cab zz ABRA"]
    due = [[told_ppm(texts[lang], t) for lang in ("x", "y")] for t in shown]
    assert np.allclose(langid.code_lengths(model, shown), due)
    monkeypatch.setattr(langid, "_WINDOW", 5)  # parts of long texts and batches of short ones
    assert np.allclose(langid.code_lengths(model, shown), due)
    total = sum(2 ** -model.trees[0].cost(np.array([(98 << 9 | 115) << 18 | (99 << 9) | x + 1]))[0] for x in range(256))
    assert abs(total - 1) < 1e-9


def test_every_byte_tells_languages_apart(spark):
    """Two scripts, whose bytes are rare beside many Latin texts, stay apart; letters alone make a text one of a language."""
    rng = np.random.default_rng(3)
    script = lambda lo, hi: " ".join("".join(chr(int(c)) for c in rng.integers(lo, hi, 5)) for _ in range(12))
    rows = [(i, lang, t) for i in range(30) for lang, t in (("la", script(97, 123) * 20), ("ka", script(0x10D0, 0x10F0)), ("hy", script(0x561, 0x587)), ("bn", script(0x985, 0x9A8)))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(docs)
    fresh = [("ka", script(0x10D0, 0x10F0)), ("hy", script(0x561, 0x587)), ("bn", script(0x985, 0x9A8)), ("la", script(97, 123)), ("und", "½ ² 12 !"), ("und", "٣ _ ①")]
    found = langid.identify(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(fresh)], "doc_id long, text string"), model, ["doc_id"]).collect()
    assert [r.lang_pred for r in sorted(found)] == [lang for lang, _ in fresh]
    one = spark.createDataFrame([(None, "la", "the same text")] * 2000 + [(1, "b", "x"), (2, "a", "x")], docs.select("doc_id", "lang", "text").schema)
    model = langid.train(one)
    assert model.languages == ["a", "b", "la"]
    tie = langid.identify(spark.createDataFrame([(1, "x")], "doc_id long, text string"), model, ["doc_id"]).first()
    assert tie.lang_pred == "a"


def test_crf_against_all_paths():
    rng = np.random.default_rng(4)
    field = quality.Field(rng.normal(size=5), rng.normal(size=(2, 2)))
    counts = np.array([1, 4, 3])
    x = rng.normal(size=(8, 5))
    good, pairs, real = field.passes(x, counts)
    first = 0
    for d, n in enumerate(counts):
        u, total, told, moves = x[first : first + n] @ field.weights, 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(u[i] * y for i, y in enumerate(path)) + sum(field.moves[a, b] for a, b in itertools.pairwise(path)))
            total += w
            told += w * np.array(path)
            for i, (a, b) in enumerate(itertools.pairwise(path)):
                moves[i, a, b] += w
        assert np.allclose(good[:n, d], told / total)
        assert np.allclose(pairs[: n - 1, d], moves[: n - 1] / total) and real[:, d].sum() == n
        first += n


def test_long_chains_by_products(monkeypatch):
    """Prefix products give the same marginals as line by line, for texts of unequal length side by side."""
    rng = np.random.default_rng(14)
    field = quality.Field(rng.normal(size=4), rng.normal(size=(2, 2)))
    counts = np.array([1, 37, 600, 599])
    x = rng.normal(size=(counts.sum(), 4)) * 3
    seen = rng.normal(size=4)
    fast = field.passes(x, counts, seen)
    monkeypatch.setattr(quality, "_LONG", 1 << 30)
    slow = field.passes(x, counts, seen)
    real = slow[2]
    assert np.allclose(fast[0][real], slow[0][real]) and np.allclose(fast[1][real[1:]], slow[1][real[1:]])
    lines = b"a good plain line of words\n!! $$ >>\n" * 150_000
    assert 0 <= quality.Field(rng.normal(size=3 * quality.OWN - 2) / 9, rng.normal(size=(2, 2))).score(*quality.line_features([lines]))[0] <= 1


def test_line_labels_are_latent():
    """Documents of either kind hold lines of both; the chain learns the lines and how they follow each other, not one label for a whole text."""
    rng = np.random.default_rng(15)
    xs, ys, labels = [], [], []
    for d in range(300):
        label = d % 2
        y, now = [], int(rng.random() < (0.85 if label else 0.15))
        for _ in range(int(rng.integers(6, 30))):
            y.append(now)
            now = now if rng.random() < 0.7 else int(rng.random() < (0.85 if label else 0.15))
        y = np.array(y)
        xs.append(np.stack([y + rng.normal(0, 0.5, len(y)), rng.normal(size=len(y)), np.ones(len(y))], 1))
        ys.append(y)
        labels.append(label)
    import unittest.mock as mock

    with mock.patch.object(quality, "calibrated", lambda field, *a: field):
        field = quality.fit(np.concatenate(xs), np.array([len(x) for x in xs]), np.array(labels))
    good, pairs, real = field.passes(np.concatenate(xs), np.array([len(x) for x in xs]))
    told = np.concatenate(ys)
    found = good.T[real.T] >= 0.5
    mixed = np.concatenate([np.full(len(y), 0 < y.mean() < 1) for y in ys])
    assert (found == told).mean() > 0.8 and (found[mixed] == told[mixed]).mean() > 0.75
    switches = pairs[real[1:]].mean(0)
    assert switches[0, 1] > 0.02 and switches[1, 0] > 0.02


def test_url_rules(spark):
    rows = [(["a", "b"], "block")] * 8 + [(["a", "c"], "allow")] * 8 + [(["a"], None)] * 20 + [(["b", "d"], "block")] * 2
    rules = urls.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), support=0.02)
    assert rules.judge(["b"]) == 1.0 and rules.judge(["a", "c"]) == 0.0 and rules.judge(["a", "b"]) == 1.0 and rules.judge(["a"]) == 0.0 and rules.judge([]) == 0.0 and rules.judge(None) == 0.0
    assert all(not (x < y and a == b) for (x, a), (y, b) in itertools.permutations(rules.rules, 2))


def test_urls_are_not_cut(spark):
    """Signals in late parts and keys decide."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        bad = i % 2 == 0
        deep = "/de/b/c/offer" if bad else "/fr/b/c/story"
        rows.append((i, f"http://x{i}.site.com{deep}/{rng.integers(99)}?k=1&l=2&{'promo' if bad else 'm'}=3", None))
    rows += [(1000, "http://x.other.net/zz/b/c/offer/7?k=1&l=2&promo=4", "block"), (1001, "http://x.other.net/zz/b/c/story/7?k=1&l=2&m=4", "allow")]
    out = {r.page_id: r.verdict for r in urls.url_filter(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")).collect()}
    assert [out[i] for i, _, v in rows if v] == [v for *_, v in rows if v]


def test_itemsets(spark):
    """Against brute force over all sets of at most three tokens."""
    rng = np.random.default_rng(6)
    rows = [([f"t{k}" for k in range(12) if rng.random() < 0.4], [None, "allow", "block"][int(rng.integers(3))]) for _ in range(200)]
    found = {tuple(r.need): (r["all"], r.allow, r.block) for r in urls.itemsets(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.1, 3).collect()}
    least = [int(np.ceil(0.1 * sum(v == x for _, v in rows))) for x in urls.VERDICTS]
    told = {}
    for k in (1, 2, 3):
        for need in itertools.combinations(sorted(f"t{i}" for i in range(12)), k):
            has = [v for own, v in rows if set(need) <= set(own)]
            if has.count("allow") >= least[0] or has.count("block") >= least[1]:
                told[need] = len(has), has.count("allow"), has.count("block")
    assert found == told


def test_mined_rules_by_enumeration(spark):
    """Rules and judgements of the query's own mining on the small tables' urls, against all token sets counted by hand."""
    rng = np.random.default_rng(4)
    hosts, langs = ["example.org", "b.com", "c.com", "x.net"], ["de", "fr", "en", "es"]
    pages = [(i, f"http://{rng.choice(hosts)}/{rng.choice(langs)}/{rng.integers(12)}{rng.choice(['', '.html', '/?q=1'])}") for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    url = F.col("url")
    told = df.select("page_id", url, urls.host_of(url).alias("host"), urls.path_of(url).alias("path"))
    told = told.select("page_id", urls.tokens_of(url, F.col("host"), F.col("path")).alias("tokens"), urls.rule_of(F.col("host"), F.col("path"))[1].alias("given")).collect()
    labelled = [(frozenset(r.tokens), r.given) for r in told if r.given]
    counts: dict[frozenset, list[int]] = {}
    for own, given in labelled:
        for k in range(1, urls.LONGEST + 1):
            for need in itertools.combinations(sorted(own), k):
                counts.setdefault(frozenset(need), [0, 0])[given == "block"] += 1
    least = [max(urls.FEWEST, int(np.ceil(urls.SUPPORT * sum((g == "block") == side for _, g in labelled)))) for side in (False, True)]
    sure = {(need, side): n[side] / sum(n) for need, n in counts.items() for side in (0, 1) if n[side] >= least[side] and n[side] / sum(n) >= urls.CONFIDENCE}
    kept = {need: (c if side else 1 - c) for (need, side), c in sure.items() if not any(sure.get((frozenset(p), side), -1) >= c for k in range(1, len(need)) for p in itertools.combinations(need, k))}
    found = {r.page_id: r.verdict for r in urls.url_filter(df).collect()}
    for r in told:
        fits = [b for need, b in kept.items() if need <= set(r.tokens)]
        top = [b for b in fits if abs(b - 0.5) == max(abs(x - 0.5) for x in fits)]
        due = r.given or ("block" if top and sum(top) / len(top) >= 0.5 else "allow")
        assert found[r.page_id] == due
    assert len({v for i, v in found.items() if told[i].given is None}) == 2


def test_implied_rules_push_none_out(spark):
    """One pattern of 40 tokens has more sets of confidence 1 than 20,000; a rule of 0.75 stays, and only what no shorter rule implies."""
    many = [f"a{i}" for i in range(40)]
    rows = [(many, "block")] * 30 + [(["b"], "block")] * 30 + [(["b"], "allow")] * 10
    rules = urls.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"))
    assert rules.judge(["b"]) == 0.75 and sorted(map(sorted, (need for need, _ in rules.rules))) == sorted([[x] for x in [*many, "b"]])


def told_order_minhash(text: str) -> str:
    """Order MinHash by its definition: for every component all k-mers in the order of its permutation."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def chain(*values: tuple[str, int]) -> int:
        seed = 42
        for kind, v in values:
            seed = xxhash.xxh64_intdigest(struct.pack("<" + kind, v), seed)
        return signed(seed)

    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in text.lower().split()]
    runs = [words[i : i + 5] for i in range(len(words) - 4)] or ([words] if words else [])
    seen: dict[tuple, int] = {}
    entries = []
    for place, run in enumerate(runs):
        o = seen[tuple(run)] = seen.get(tuple(run), -1) + 1
        entries.append((chain(("q", chain(*(("q", w) for w in run))), ("i", o)) >> 24, place))
    out = []
    for c in range(32):
        def priority(e, c=c):
            named = (e[0] >> 35) + 16 == c
            return (not named, e[0] if named else chain(("q", e[0]), ("i", c)) >> 24)

        chosen = sorted(sorted(entries, key=priority)[:2], key=lambda e: e[1])
        member = [e[0] if (e[0] >> 35) + 16 == c else chain(("q", e[0]), ("i", c)) >> 24 for e in chosen]
        out.append(f"{chain(*(('q', m & (1 << 40) - 1) for m in member)) & 0xFFFFFFFF:08x}" if chosen else "-" * 8)
    return "".join(out)


def test_order_minhash_by_definition(spark):
    rng = np.random.default_rng(12)
    texts = ["", "one", "a b c d", "a b c d e", "a b c d e f", "x " * 40, "p q " * 300]
    texts += [" ".join(rng.choice([f"w{i}" for i in range(int(v))], int(n))) for n, v in zip(rng.integers(5, 900, 40), rng.choice([3, 50, 4000], 40), strict=True)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.f for r in order_minhash.fingerprint(docs, "text", "f").select("doc_id", "f").collect()}
    assert found == {i: told_order_minhash(t) for i, t in enumerate(texts)}


def test_order_matters_in_short_texts(spark):
    """A text against its swapped halves: as near as 32 selections from the whole texts say, whatever the length."""
    rng = np.random.default_rng(13)
    for n, due in ((20, 0.17), (68, 0.38)):
        rows = []
        for i in range(60):
            w = rng.choice([f"w{k}" for k in range(9999)], n).tolist()
            rows.append((i, " ".join(w), " ".join(w[n // 2 :] + w[: n // 2])))
        df = spark.createDataFrame(rows, "doc_id long, a string, b string")
        prints = order_minhash.fingerprint(order_minhash.fingerprint(df, "a", "x"), "b", "y")
        assert abs(prints.agg(F.avg(order_minhash.likeness("x", "y"))).first()[0] - due) < 0.05
