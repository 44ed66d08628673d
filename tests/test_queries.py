"""Every query with SQL gives the same rows as its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from foliospark import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA or v is pd.NaT:
            return ""
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    columns = sorted(df.columns)
    return sorted(tuple(map(cell, row)) for row in df[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    d = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        d.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return d


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_query(spark, duck, name):
    found, told = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(told.columns)
    assert plain(found) == plain(told)
    assert len(found)


def test_pages_are_counted_from_the_text(spark, tmp_path):
    rows = [(3, "x" * 450, None), (4, "x" * 450, 7), (5, None, 900), (6, "é" * 250, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.page_count for r in queries._files(spark, str(tmp_path)).collect()}
    assert found == {3: 5, 4: 5, 5: None, 6: 3}
