"""Each corpus query on the smallest tables: the contracts, against SQL or brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import queries
from foliospark.llm.urls import RULES

from ..test_queries import SF, duck, plain  # noqa: F401


@pytest.fixture(scope="module")
def docs():
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return {r[0]: r[1:] for r in rows}


def rows(spark, name: str) -> dict:
    return {r[0]: r for r in queries.QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, duck, name):  # noqa: F811
    found, told = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df()
    assert len(found) == len(told)
    assert sorted(found.columns) == sorted(told.columns)
    assert plain(found) == plain(told)


def lower(t: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_op2(spark, docs):
    found = queries.QUERIES["op2_order_minhash"](spark, SF).collect()
    assert found[0].asDict().keys() == {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"}
    ids, by = sorted(docs), {r.doc_id: r for r in found}
    assert len(found) == len(docs)
    prints: dict[str, set] = {}
    for i, d in enumerate(ids):
        text, after = docs[d][0], docs[ids[(i + 1) % len(ids)]][0]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = by[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(text, set()).add(r.fingerprint)
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
        assert (r.near_next == 1) == (r.fingerprint == by[ids[(i + 1) % len(ids)]].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert np.mean([r.near_edited for r in found]) > 0.25 > 0.02 > np.mean([r.near_next for r in found])


def test_op3(spark, docs):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    found = rows(spark, "op3_license_scan")
    assert len(found) == len(docs)
    for d, (text, *_) in docs.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        r = found[d]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        base = {label for _, label in places}
        assert r.base_labels == ",".join(sorted(base)) and base <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_op4(spark, docs):
    def fingerprint(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        if not words:
            return 0
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {d: fingerprint(t[0]) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    found = rows(spark, "op4_simhash")
    assert {d: (r.fingerprint, r.component_id) for d, r in found.items()} == {d: (f"{prints[d]:016x}", root(d)) for d in docs}


def test_op5(spark, docs):
    found = rows(spark, "op5_language_id")
    assert {d: r.held_out for d, r in found.items()} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in docs}
    held = [d for d, r in found.items() if r.held_out]
    assert np.mean([found[d].lang_pred == docs[d][1] for d in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_op6(spark):
    pages = duckdb.sql(f"SELECT page_id, url FROM '{SF}/pages.parquet'").fetchall()
    found = rows(spark, "op6_url_filter")
    for page_id, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = found[page_id]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")


def test_op7(spark, docs):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op7_decontaminate"](spark, SF).collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items if x in t[0]}
    assert exact and exact <= found
    assert len({d for d, _ in found}) < 0.2 * len(docs)


def test_op9(spark, docs):
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    found = rows(spark, "op9_quality")
    assert {d: (r.held_out, r.predicted) for d, r in found.items()} == {d: (zlib.crc32(str(d).encode()) % 5 == 0, int(found[d].score >= 0.3)) for d in docs}
    assert np.mean([found[d].predicted == q for d, q in labels if d in found]) > 0.9


def test_op10_places_follow_the_curriculum(spark, docs):
    """Places number the taken copies in order of position, and the sources' shares move along the run as their schedules say."""
    out = queries.QUERIES["op10_mix_sources"](spark, SF).collect()
    copies = [(r.first_place, r.first_position, r.doc_id, r.size) for r in out if r.taken or r.first_place is not None]
    copies += [(r.last_place, r.last_position, r.doc_id, r.size) for r in out if r.last_place not in (None, r.first_place)]
    copies.sort()
    assert [c[0] for c in copies] == list(range(len(copies))) and [c[1] for c in copies] == sorted(c[1] for c in copies)
    names = sorted({docs[c[2]][2] for c in copies}, key=lambda x: (x is None, x or ""))
    for i, name in enumerate(names):
        words = [sum(n for _, t, d, n in copies if docs[d][2] == name and lo <= t < lo + 0.5) for lo in (0.0, 0.5)]
        ramp = [(1.25, 0.75), (1.0, 1.0), (0.75, 1.25)][i % 3]
        most = max(n for _, _, d, n in copies if docs[d][2] == name)
        assert abs(words[0] * ramp[1] - words[1] * ramp[0]) <= 2 * most * max(ramp)


def test_op10_nears_targets(spark):
    out = queries.QUERIES["op10_mix_sources"](spark, SF).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"), F.max(F.expr("taken - 2 * size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= r.most and r.over <= 0 for r in out)


def test_pipeline(spark, docs):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF).select("slot", "doc_id", "record").collect()
    assert sorted(r.slot for r in out) == list(range(len(out)))
    assert len({len(r.record) for r in out}) == 1 and {r.doc_id for r in out} <= set(docs)


def test_pipeline_keeps_the_curriculum(spark):
    """Slots follow the documents' places in the mix, up to a window."""
    import corpus_pipeline as P
    from foliospark.llm.common import materialise

    mixed = materialise(P.mixing_stage(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "mixed")
    names = sorted({r[0] for r in mixed.select(F.col("_metadata.file_name")).collect()}, key=lambda n: int(n.split("-")[1]))
    due = [r.doc_id for n in names for r in mixed.where(F.col("_metadata.file_name") == n).select("doc_id", F.col("_metadata.row_index").alias("row")).orderBy("row").collect()]
    slots: dict[int, list[int]] = {}
    for r in P.token_stage(spark, mixed, SF).where("seq_no = 0").select("doc_id", "slot").orderBy("slot").collect():
        slots.setdefault(r.doc_id, []).append(r.slot)
    seen: dict[int, int] = {}
    got = []
    for d in due:
        got.append(slots[d][seen.setdefault(d, 0)])
        seen[d] += 1
    assert sum(map(len, slots.values())) == len(due)
    ranks = np.argsort(np.argsort(got))
    assert np.corrcoef(ranks, np.arange(len(due)))[0, 1] > 0.95


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Every stage takes nulls, empty texts, repeated rows, other columns and empty tables."""
    import corpus_pipeline as P

    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a fine line of words that is kept", "en", "s", 3), (3, "a fine line of words that is kept", "en", "s", 3), (None, "a text without any id at all", None, "s", 9), (4, "word", "en", None, 4)]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, None), (2, "word")], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("x") for c in ("fp", "node", "position", "slot", "file", "row", "id", "digest")}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    for some in (docs, docs.limit(0)):
        now = some
        for name, stage in P.STAGES[:-1]:
            out = P.materialise(stage(spark, now, str(tmp_path)), name)
            assert out.columns == docs.columns
            now = out
        last = P.token_stage(spark, now, str(tmp_path)).collect()
        assert sorted(r.slot for r in last) == list(range(len(last))) and (len(last) > 0) == (some is docs)


def test_stages_take_effect(spark):
    import corpus_pipeline as P

    d = spark.read.parquet(f"{SF}/documents.parquet")
    good = P.quality_stage(spark, d, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.quality: r.n for r in good.join(labels, "doc_id").groupBy("quality").agg(F.count("*").alias("n")).collect()}
    told = {r.quality: r.n for r in labels.join(d, "doc_id").groupBy("quality").agg(F.count("*").alias("n")).collect()}
    assert kept.get(0, 0) < 0.3 * told[0] and kept[1] > 0.95 * told[1] and good.columns == d.columns
    near = P.near_duplicate_stage(spark, d, SF)
    assert near.columns == d.columns and near.count() == near.select("text").distinct().count() == near.select("doc_id").distinct().count()
    clean = P.decontamination_stage(spark, d, SF)
    held = queries.QUERIES["op7_decontaminate"](spark, SF).select("doc_id").distinct()
    assert clean.count() == d.count() - held.count() and clean.columns == d.columns
    mixed = P.mixing_stage(spark, d, SF)
    taken = queries.QUERIES["op10_mix_sources"](spark, SF).where("size > 0").agg(F.sum(F.expr("taken / size"))).first()[0]
    assert mixed.columns == d.columns and mixed.where("n_chars > 0").count() == int(taken)
