"""Column functions against plain Python."""

from __future__ import annotations

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions import text as T

ODD = ["", " ", "a", "‎a؜﻿b", "\x00", "中文", "Жж", "€", "ﬁ", "ﭐ" * 10, "ﭐ" * 11, "ا" * 20 + "ﭐ", "\x1c x\xa0　", "| a |\r\n|b|\n\n|", "|", "| x", "😀|😀", "a\x85|b|c"]
SPACES = {chr(c) for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}
BIDI = {0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2066, 0x206A), 0x61C, 0xFEFF}
RANGES = [(0, 0x24F), (0x300, 0x36F), (0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0x2000, 0x206F)]
FORMS, ARABIC = [(0xFB50, 0xFDFF), (0xFE70, 0xFEFF)], [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)]


def within(c: str, ranges) -> bool:
    return any(a <= ord(c) <= b for a, b in ranges)


def tables(t: str) -> int:
    rows = [x.strip().startswith("|") and x.strip().endswith("|") for x in t.splitlines()]
    return sum(now and not before for now, before in zip(rows, [False, *rows], strict=False))


def plain(t: str) -> tuple:
    arabic = sum(within(c, FORMS + ARABIC) for c in t)
    return (
        "".join(c for c in t if ord(c) not in BIDI),
        t.strip(),
        sum(c == "\x00" or (ord(c) > 0x206F and c not in SPACES) for c in t),
        sum(not within(c, RANGES) and c not in SPACES for c in t),
        sum(within(c, FORMS) for c in t) / arabic if arabic > 10 else 0.0,
        unicodedata.normalize("NFKC", t),
        tables(t),
    )


def check(spark, texts: list[str]) -> None:
    c = F.col("t")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", T.strip_bidi(c), T.strip(c), T.count_of(c, T.OFFICE_GARBAGE), T.count_of(c, T.PDF_GARBAGE), T.arabic_forms(c), T.nfkc(c), T.count_tables(c)).collect()
    for r in rows:
        assert tuple(r[1:]) == plain(texts[r[0]]), repr(texts[r[0]])


def test_odd_texts(spark):
    check(spark, ODD)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("|\n\r　 |ﭐا‏")), max_size=40), min_size=20, max_size=20))
def test_any_texts(spark, texts):
    check(spark, texts)


def test_names(spark):
    names = {"a.PDF": (".pdf", "a"), ".pdf": ("", ".pdf"), "a.": ("", "a."), "x.tar.gz": (".gz", "x.tar"), "none": ("", "none"), "ملف.docx": (".docx", "ملف")}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: (r[1], r[2]) for r in df.select("n", T.extension(F.col("n")), T.stem(F.col("n"))).collect()} == names


def test_nulls(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(T.strip_bidi(F.col("t")), T.nfkc(F.col("t")), T.office_garbage(F.col("t"))).first()
    assert tuple(row) == (None, None, 0.0)


def test_elapsed_and_json(spark):
    df = spark.createDataFrame([(5.25, 'x\n{"a":1}\n{bad'), (65.0, "none"), (3723.5, '{"a":1}\n  {"b":2}  ')], "s double, log string")
    rows = df.select(T.elapsed(F.col("s")), T.elapsed(F.col("s"), hours=True), T.last_json(F.col("log"))).collect()
    assert [tuple(r) for r in rows] == [("5.3s", "5.3s", '{"a":1}'), ("1m 5.0s", "1m 5.0s", None), ("62m 3.5s", "1h 2m 3.5s", '{"b":2}')]
    assert spark.range(3).select(T.backoff_seconds(F.col("id"))).collect()[2][0] == 4.0
