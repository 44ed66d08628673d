"""Arrow UDFs that work on a batch piece by piece."""

from __future__ import annotations

import tracemalloc
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.pieces import PIECE_BYTES, pieces
from foliospark.functions.render import render_grid, render_tree

TEXT = "ﬁ" * 500 + "a" * 4000


def peak(udf, batch: pa.Array) -> tuple[int, int, set]:
    """Bytes of Python objects at once, and rows and values of what comes out."""
    tracemalloc.start()
    rows, values = 0, set()
    for out in udf.func(iter([batch])):
        rows += len(out)
        values |= set(out.unique().to_pylist())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most, rows, values


def test_memory_does_not_grow_with_the_batch():
    node = {"node_type": "paragraph", "text": "x" * 50, "children": []}
    grid = {"rows": 1, "cols": 2, "cells": [{"row": 0, "col": 1, "content": "y" * 50}]}
    line = "|  | " + "y" * 50 + " |\n| --- | --- |"
    for udf, value, many, result in ((T.nfkc, TEXT, 6000, unicodedata.normalize("NFKC", TEXT)), (render_tree, [node] * 20, 6000, "\n\n".join(["x" * 50] * 20)), (render_grid, grid, 60000, line)):
        few = peak(udf, pa.array([value] * (many // 10)))
        all_ = peak(udf, pa.array([value] * many))
        assert (few[1:], all_[1:]) == ((many // 10, {result}), (many, {result}))
        assert all_[0] < 1.5 * few[0] + PIECE_BYTES, (udf.func.__name__, few[0], all_[0])


def test_pieces_keep_order_nulls_and_long_rows():
    texts = pa.array(["a", None, "b" * 3000, "", *["c" * 90] * 100, None])
    found = list(pieces(texts, 1000))
    assert [t for p in found for t in p.to_pylist()] == texts.to_pylist()
    assert all(p.nbytes <= 1000 or len(p) == 1 for p in found)
    assert len(found) < 30
    nested = pa.array([[{"t": "d" * 90}]] * 100 + [None, []])
    assert [t for p in pieces(nested, 1000) for t in p.to_pylist()] == nested.to_pylist()
    assert len(list(pieces(nested, 1000))) < 30
    assert [len(p) for p in pieces(texts.slice(0, 0))] == [0]


def test_rows_meet_their_own_result(spark):
    """Pieces of other sizes than Spark's batches, two of them in a plan, with long, empty and null rows."""
    df = spark.range(12000).repartition(2).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.repeat(F.lit("ﬁ"), (F.col("id") % 700).cast("int")), F.col("id").cast("string"))).alias("t"))
    df = df.unionByName(spark.range(12000, 12003).select("id", F.concat(F.repeat(F.lit("ﬁ"), 500_000), F.col("id").cast("string")).alias("t")))
    want = F.replace(F.col("t"), F.lit("ﬁ"), F.lit("fi"))
    got = df.select("id", want.alias("w"), T.nfkc(F.col("t")).alias("n"), T.nfkc(F.concat(F.col("t"), F.lit("ﬁ"))).alias("m"))
    wrong = ~(F.col("n").eqNullSafe(F.col("w")) & F.col("m").eqNullSafe(F.concat("w", F.lit("fi"))))
    assert got.agg(F.count("*"), F.count_if(wrong)).first() == (12003, 0)
    assert df.where("id < 0").select(T.nfkc(F.col("t"))).collect() == []
