"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from foliospark.llm import decontaminate, langid, licenses, mixing, order_minhash, quality, simhash, tokens, urls, warc
from foliospark.llm.common import scratch_path

LONG = " ".join(f"w{i % 977} Mit License," for i in range(20_000))
ROWS = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \n\t", "en", "s"), (4, "word", "en", "s"), (5, "word", "en", "s"), (5, "word", "en", "s"), (None, "no id here at all", None, "s"),
    (6, LONG, "en", "t"), (7, "çé ßü 中文 😀 and some more words", "fr", None), (8, "a\x00b", "fr", "t"), (9, "the quick brown fox jumps over the lazy dog " * 3, "en", "t"),
]
CLASH = ["fp", "node", "part", "slot", "shard", "id", "block", "key", "size", "doc", "position", "score", "copy_id", "quality_score", "_w", "u", "v", "label"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("x") for c in CLASH}).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_order_minhash(docs, none):
    out = order_minhash.order_minhash(docs).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(ROWS) and by[1].n_chars == 0 and by[6].n_chars == len(LONG)
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "-" * 256 and by[1].near_next == 1.0
    assert by[4].fingerprint == by[5].fingerprint and by[4].near_next == 1.0 and by[3].near_next == 0.0
    assert order_minhash.order_minhash(none).count() == 0
    assert order_minhash.order_minhash(docs.where("doc_id = 4")).first().near_next == 1.0
    ends = docs.select(F.lit(-(1 << 63)).alias("doc_id"), "text").where("text = 'word'").limit(1).unionByName(docs.where("doc_id is null or doc_id = 9").select("doc_id", "text"))
    got = {r.doc_id: r.edited_sha256 for r in order_minhash.order_minhash(ends).collect()}
    assert got[-(1 << 63)] == hashlib.sha256(b"wort").hexdigest() and got[None] == hashlib.sha256(b"no id here atword").hexdigest()


def test_order_minhash_follows_order(spark):
    words = [f"w{i}" for i in range(400)]
    swapped = words[200:] + words[:200]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(swapped)), (3, " ".join(words[:395] + ["x"] * 5))], "doc_id long, text string")
    p = order_minhash.fingerprint(df, "text", "a")
    x = p.alias("x").join(p.alias("y"), F.col("x.doc_id") < F.col("y.doc_id")).select(F.col("x.doc_id").alias("i"), F.col("y.doc_id").alias("j"), F.col("x.a").alias("a"), F.col("y.a").alias("b"))
    near = {(r.i, r.j): r.n for r in x.select("i", "j", order_minhash.likeness("a", "b").alias("n")).collect()}
    # the same k-mers but six in another order: half of the pairs change places
    assert near[1, 3] > 0.85 > 0.75 > near[1, 2] > 0.2


def test_licenses(docs, none):
    by = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert (by[1].n_words, by[1].labels, by[1].score, by[1].first_word) == (0, "", 0.0, None)
    assert (by[6].n_words, by[6].n_base, by[6].first_word, by[6].last_word) == (60_000, 20_000, 1, 59_998)
    assert by[8].n_words == 2 and licenses.license_scan(none).count() == 0


@pytest.mark.parametrize(
    ("text", "labels", "obligation"),
    [
        ("MIT", ("mit",), 0), ("(MIT OR GPL-2.0-only) AND Apache-2.0", ("apache-2.0", "gpl-2.0-only", "mit"), 0), ("MIT AND GPL-3.0", ("gpl-3.0", "mit"), 2), ("GPL-2.0 WITH Classpath-exception-2.0", ("gpl-2.0",), 1),
        ("MIT OR Apache-2.0 AND GPL-3.0", ("apache-2.0", "gpl-3.0", "mit"), 0), ("((MIT)", ("mit",), None), ("OR MIT", ("mit",), None), ("", (), None), ("Secret-1", ("secret-1",), 3), ("MIT) trailing", ("mit",), 0), ("MIT AND", ("mit",), None),
    ],
)
def test_expressions(text, labels, obligation):
    v = licenses.evaluate(text.lower())
    assert (v.labels, v.obligation) == (labels, obligation)


def test_tags(spark):
    text = "// SPDX-License-Identifier: MIT OR Apache-2.0\nReleased under the MIT License. MIT license mit license\n"
    r = licenses.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.base_labels == "mit" and set(r.labels.split(",")) == {"mit", "apache-2.0"} and r.obligation == 0 and r.expressions == ["mit or apache-2.0"] and r.n_base == 3


@pytest.mark.parametrize(
    ("text", "expressions"),
    [
        ("sublicense expression: foo\nSPDX-License-Identifier: MIT", ["mit"]), ("license\nexpression: MIT", []), ("license expression MIT and license-expression = BSD", ["mit and license-expression = bsd", "bsd"]),
        ("x SPDX License Identifier", []), ("é SPDX-License-Identifier:\tApache-2.0 OR MIT\r\nnext", ["apache-2.0 or mit"]), ("License Expression: GPL-3.0\n" * 3, ["gpl-3.0"] * 3), ("license expressions: MIT", []),
    ],
)
def test_tags_stand_on_whole_words_of_a_line(text, expressions):
    found = licenses.scan(text.encode(), licenses.automaton())
    assert found[7] == expressions and set(found[5].split(",")) - {""} == {x for e in expressions for x in licenses.evaluate(e).labels}


def test_long_expressions_stay_whole():
    due = " or ".join(f"mit-{i}" for i in range(90))
    assert licenses.scan(f"SPDX-License-Identifier: {due}\n".encode(), licenses.automaton())[7] == [due]


def test_simhash(spark, docs, none):
    out = simhash.near_duplicates(docs).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(ROWS) and by[1].fp == by[2].fp == by[3].fp == bytes(8) and by[3].component_id == 1 and by[5].component_id == 4
    assert by[None].component_id is None
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.select("doc_id").collect()) == [0, 1, 4, 6, 7, 8, 9]
    mapped = docs.withColumn("m", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("dotted.name", F.lit(1))
    assert simhash.drop_near_duplicates(mapped).columns == mapped.columns and simhash.drop_near_duplicates(mapped).count() == 7
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def test_near_duplicates_of_odd_ids(spark):
    """Ids at the ends of the range, ids that two texts share, rows without id, and repeated rows that differ in another column."""
    text = "one two three four five six seven eight"
    big = (1 << 63) - 1
    rows = [(big, text, "a"), (big - 1, text, "b"), (-(1 << 63), "quite another text with its own words here", "c"), (7, text + " nine", "d"), (7, "a second text of seven without any kin", "e"), (None, "nobody names this text of a few words", "g"), (None, "nobody names this text of a few words", "f"), (None, text, "h"), (9, "repeated row of the ninth of all texts", "y"), (9, "repeated row of the ninth of all texts", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df, simhash.NEAR).collect()}
    assert found == {(big, 7), (big - 1, 7), (None, 7), (-(1 << 63), -(1 << 63)), (7, 7), (None, None), (9, 9)}
    left = sorted((str(r.doc_id), r.source) for r in simhash.drop_near_duplicates(df).collect())
    assert left == sorted([("-9223372036854775808", "c"), ("7", "d"), ("7", "e"), ("None", "f"), ("9", "x")])


def test_language(docs, none):
    model = langid.train(docs)
    by = {r.doc_id: r for r in langid.identify(docs, model, ["doc_id"]).collect()}
    assert by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == "und" and by[9].lang_pred == "en" and by[7].lang_pred == "fr"
    assert langid.train(none) is None and {r.lang_pred for r in langid.identify(docs, None, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(none, model, ["doc_id"]).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (9, 1), (6, 0), (None, 1), (7, None), (2, 1)], "doc_id long, quality int")
    field = quality.train(docs, labels)
    kept = quality.keep_good(docs, field)
    assert kept.columns == docs.columns and kept.count() >= 1
    scores = quality.quality(docs.select("doc_id", "text"), field).collect()
    assert len(scores) == len(ROWS) and all(0 <= r.quality_score <= 1 for r in scores)
    neutral = quality.train(none, labels.limit(0))
    assert {round(r.quality_score, 6) for r in quality.quality(docs.select("text"), neutral).collect()} == {0.5}
    assert quality.keep_good(none, field).count() == 0
    again = quality.train(docs, labels.unionByName(labels).unionByName(labels.where("quality = 1")))
    assert all(0 <= r.quality_score <= 1 for r in quality.quality(docs.select("text"), again).collect())


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the quick brown fox jumps over the lazy dog"), (3, "the quick brown fox jumps over the lazy dog"), (4, "Word")], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(4, 4), (5, 4), (5, 4), (9, 3), (9, 3)]
    blocks = decontaminate.contaminated(docs, items, block_items=2).collect()
    assert sorted(found) == sorted(blocks)
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 4
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0 and decontaminate.contaminated(none, items).count() == 0


def test_mixing(docs, none):
    out = mixing.plan_mix(docs, keep=["doc_id"]).select("doc.doc_id", "size", "source_size", "target", "taken").collect()
    assert len(out) == len(ROWS) and all(r.taken <= 2 * r.size for r in out)
    assert mixing.training_order(docs).columns == docs.columns
    assert mixing.plan_mix(none).count() == 0 and mixing.training_order(none).count() == 0
    again = mixing.plan_mix(docs.repartition(3), keep=["doc_id"]).select("doc.doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_tokens(spark, docs, none):
    out = tokens.token_records(docs, length=16, shard_records=50)
    rows = out.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and {len(r.record) for r in rows} == {16 + 32}
    vocab = tokens.vocabulary()
    for r in rows:
        if r.doc_id == 1:
            assert r.n_tokens == 1 and r.record[16:] == vocab.end.to_bytes(2, "little") * 16
    assert tokens.token_records(none).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://X.ORG"), (5, "http://x.org/?q#f"), (6, "http://a.example.org/en/12"), (7, "http://notexample.org/es/"), (8, "http://casino-x.example.net/en/1"), (9, "ftp://x.com/de/1?y"), (9, "ftp://x.com/de/1?y"), (None, "a://b://c/d"), (10, "http://x.net/" + "/part-7" * 60_000 + "?" + "k=1&" * 9000)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "tokens", "score")})
    out = urls.url_filter(df).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in out}
    assert len(out) == len(rows) and got[1] == got[2] == got[3] == ("", "", None) and got[4] == ("x.org", "", None) and got[5] == ("x.org", "/", "org/")
    assert got[6][2] == "example.org/en/1" and got[7][2] == "org/" and got[9] == ("x.com", "/de/1", "com/de/") and got[None] == ("b:", "//c/d", None)
    assert got[8][2] is None and {r.verdict for r in out} <= {"allow", "block"} and len(got[10][1]) == 60_000 * 7 + 1
    assert urls.url_filter(df.limit(0)).count() == 0


def test_warc(spark):
    big, odd = "x" * 1200, "\r\n\r\nWARC/1.1\r\n" * 5000
    rows = [(1, "u", None), (2, "u", ""), (3, "u v", big), (4, None, big), (4, None, big), (5, "u", "é" * 40_000), (6, "u", odd), (7, "u", "short"), (8, "u", "short"), (None, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("z"))
    path = scratch_path(spark, "warc")
    warc.write_archives(df, path, records=3)
    out = warc.read_pages(spark, path).collect()
    assert len(out) == len(rows) and all(r.fault is None for r in out)
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in out}
    assert {(3, 1200, "revisit", 4), (4, 1200, "response", None), (None, 1200, "revisit", 4), (5, 80_000, "response", None), (7, 5, "response", None), (1, 0, "response", None), (6, len(odd), "response", None)} <= got
    empty = scratch_path(spark, "empty")
    warc.write_archives(df.limit(0), empty)
    assert warc.read_pages(spark, empty).count() == 0


def test_ids_of_the_whole_range(spark):
    big, least = "y" * 1100, -(1 << 63)
    df = spark.createDataFrame([(least, "u", big), (None, "u", big), ((1 << 63) - 1, "u", "z" * 2000), (None, "u", "q" * 3000), (None, "u", "q" * 3000)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write_archives(df, path)
    out = sorted(map(str, ((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.fault) for r in warc.read_pages(spark, path).collect())))
    assert out == sorted(map(str, [(least, 1100, "response", None, None), (None, 1100, "revisit", least, None), ((1 << 63) - 1, 2000, "response", None, None), (None, 3000, "response", None, None), (None, 3000, "response", None, None)]))


def test_broken_segments(spark):
    message = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"hello" * 10)
    half = len(message) // 2
    seg = lambda o, n, block, total=None: ("response" if n == 1 else "continuation", f"{o}:{n}", o, n, total, None, None, block, None, None, None, None)
    rows = [seg("a", 2, message[half:], len(message)), seg("a", 1, message[:half]), seg("b", 1, message[:half]), seg("b", 3, message[half:], len(message)), seg("c", 1, message[:half]), seg("c", 2, message[half:], 7), seg("d", 1, message[:half]), seg("d", 2, message[half:-9], len(message) - 9), seg("e", None, b"x")]
    out = {r.name: (r.payload, r.fault) for r in warc.reassembled(spark.createDataFrame(rows, warc._RECORD)).collect()}
    assert out["a"] == (b"hello" * 10, None)
    assert out["b"][1] == out["e"][1] == "segments are missing or repeated" and out["c"][1] == "total length differs" and out["d"][1].startswith("chunked framing")


def test_damaged_archives(spark, tmp_path):
    """Whatever is wrong with an archive gives fault rows, and the sound records around it are read."""
    good = [b"".join(warc.records_of(i, 0, "u", b"payload %d" % i, None)) + b"\r\n\r\n" for i in range(4)]
    plain = good[0] + b"rubbish in between\r\n\r\n" + good[1] + good[2].replace(b"Content-Length", b"Content-Size") + good[3]
    lacking = good[0].replace(b"WARC-Record-ID", b"WARC-Other") + good[1].replace(b"WARC-Type", b"WARC-Kind") + good[2]
    for name, content in {
        "members": b"".join(gzip.compress(g) for g in good), "plain": gzip.compress(plain), "lacking": gzip.compress(lacking), "cut": gzip.compress(b"".join(good))[:-20], "no_gzip": b"not gzip at all", "half": gzip.compress(b"".join(good)[:-30]), "empty": b"",
        "damaged": gzip.compress(good[0]) + b"\x1f\x8b\x08\x00garbage", "foreign": gzip.compress(good[0].replace(b"urn:page:0:0", b"urn:uuid:1-2-3")), "length": gzip.compress(good[0].replace(b"Content-Length: ", b"Content-Length: -") + good[1]),
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.gz").write_bytes(content)
        out = warc.read_pages(spark, str(tmp_path / name)).collect()
        told = sorted(r.page_id for r in out if r.record_type == "response" and r.page_id is not None)
        faults = sum(r.record_type == "damaged" and bool(r.fault) for r in out)
        assert (told, faults) == {
            "members": ([0, 1, 2, 3], 0), "plain": ([0, 1, 3], 2), "lacking": ([2], 2), "cut": (told, 2 if told != [0, 1, 2, 3] else 1), "no_gzip": ([], 1), "half": ([0, 1, 2], 1), "empty": ([], 0), "damaged": ([0], 1), "foreign": ([], 0), "length": ([1], 1),
        }[name], name
    assert [r.payload for r in warc.reassembled(warc.read_records(spark, str(tmp_path / "members"))).orderBy("name").collect()] == [b"payload %d" % i for i in range(4)]
