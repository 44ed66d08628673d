from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from foliospark.config import PROFILES, settings
from foliospark.operators import assemble, classify, jobs

S = settings(env={})


def plain_class(ext, pages, average):
    if ext in S.office_extensions:
        return "OFFICE"
    if ext in S.image_extensions:
        return "IMAGE"
    if ext != ".pdf" or not pages:
        return "UNKNOWN"
    if average is not None and average < 50:
        return "PDF_LONG_SCAN" if pages > 20 else "PDF_SHORT_SCAN"
    return "PDF_VLM_TEXT" if pages <= 4 else "PDF_LONG_TEXT" if pages > 200 else "PDF_SHORT_TEXT"


def test_classes_at_their_bounds(spark):
    cases = [(e, p, c) for e, p, c in itertools.product([".pdf", ".csv", ".png", ".exe", ""], [None, 0, 1, 4, 5, 10, 11, 20, 21, 200, 201], [None, [0], [49], [50], [49, 50], [500]])]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "doc_id long, ext string, page_count int, chars array<int>")
    for r in classify.classify(df, S).collect():
        e, p, c = cases[r.doc_id]
        assert r.doc_class == plain_class(e, p, sum(c) / len(c) if c else None), cases[r.doc_id]


def test_sampled_pages(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 4, 5, 19, 21, 201)], "n int")
    for n, at in df.select("n", classify.sample_pages(F.col("n"), 5)).collect():
        k = min(5, n)
        assert sorted(at) == sorted({int(i * n / k) for i in range(k)}), n


def test_head_and_tail(spark):
    rows = [(d, p) for d, n in ((1, 20), (2, 21), (3, 45)) for p in range(n)]
    kept = classify.page_limits(spark.createDataFrame(rows, "doc_id int, page_no int"), S).groupBy("doc_id").agg(F.array_sort(F.collect_list("page_no"))).collect()
    assert {r[0]: r[1] for r in kept} == {1: list(range(20)), 2: [*range(10), *range(11, 21)], 3: [*range(10), *range(35, 45)]}


def test_profiles():
    assert settings("service", env={"FOLIOSPARK_VLM_TEXT_THRESHOLD": "7"}).vlm_text_threshold == 7
    assert PROFILES["orchestrator"].vlm_text_threshold == 10 and ".csv" not in PROFILES["service"].allowed_uploads
    assert S.override(vlm_model=None, long_head_pages=3).long_head_pages == 3


def test_names_by_both_rules(spark):
    names = ["a.pdf", "a.pdf", "b.pdf", "a_1.pdf", "a.pdf", "noext", "noext"]
    df = spark.createDataFrame([(i, "d", n) for i, n in enumerate(names)], "i int, folder string, name string")
    exact = {r.i: r.unique_name for r in assemble.exact_names(df, "name", "i", "folder").collect()}
    assert [exact[i] for i in range(len(names))] == assemble.free_names(names)
    simple = {r.i: r.unique_name for r in assemble.numbered_names(df, "name", "i").collect()}
    assert [simple[i] for i in (0, 1, 2, 4, 6)] == ["a.pdf", "a_1.pdf", "b.pdf", "a_2.pdf", "noext_1"]


def test_ranks_of_a_hot_key(spark):
    rows = [("hot", f"p{i:03}") for i in range(300)] + [("b", "p005"), ("b", None), (None, "x"), ("c", "p299")]
    df = spark.createDataFrame(rows[::-1], "name string, path string")
    out = assemble.rank_within(df, "name", "path", "n", blocks=16).collect()
    got = {(r.name, r.path): r.n for r in out}
    assert len(out) == len(rows) and all(got["hot", f"p{i:03}"] == i for i in range(300))
    assert (got["b", None], got["b", "p005"], got[None, "x"], got["c", "p299"]) == (0, 1, 0, 0)


def test_assembly(spark):
    pages = spark.createDataFrame([("d", 0, " \n", False), ("d", 2, "three", True), ("d", 1, "two‏", None), ("e", 0, "one", False), ("f", 0, None, False)], "doc_id string, page_no int, text string, fb boolean")
    out = {r.doc_id: r for r in assemble.assemble_pages(pages, fallback="fb").collect()}
    assert out["d"].content == "\n\n---\n*Page 2*\n\ntwo\n\n---\n*Page 3*\n\nthree" and out["d"].cpu_fallback and out["d"].pages == 3
    assert out["e"].content == "one" and out["f"].content == "" and not out["f"].cpu_fallback


def test_merge_and_status(spark):
    states = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    results = spark.createDataFrame([("a", None), ("b", "bad"), ("z", None)], "name string, error string")
    assert {r.name: r.status for r in jobs.merge_results(states, results, "name").collect()} == {"a": "ok", "b": "error", "c": "pending"}
    assert [r.name for r in jobs.missing(states, results, "name").collect()] == ["c"]
    x = spark.createDataFrame([("j", "e2"), ("j", "e1"), ("k", None), ("k", "e")], "job_id string, error string")
    assert {r.job_id: (r.status, r.error) for r in jobs.job_status(x).collect()} == {"j": ("failed", "e1; e2"), "k": ("done", None)}


def test_first_by_content(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y"), ("d", None), ("e", None)], "path string, content string")
    assert sorted(r.path for r in assemble.first_by_content(df.where("content is not null"), F.col("content"), "path").collect()) == ["a", "c"]


def test_report_text(spark):
    one = spark.createDataFrame([(3, 2, 2, 1, 1, 0, False)], "n_found long, n_unique long, n_returned long, n_ok long, n_failed long, n_missing long, complete boolean")
    text = jobs.report_text(one, 1.0, 3600.0).first()[0]
    assert "Unique files: 2" in text and "NOT all" in text and "MISSING" not in text and "Total time: 1h 0m 1.0s" in text
