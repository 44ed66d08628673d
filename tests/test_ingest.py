from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from foliospark.config import settings
from foliospark.plans import sinks
from foliospark.plans.backends import Parsed, Registry, VisionBackend
from foliospark.plans.cli import main
from foliospark.plans.ingest import run
from foliospark.sources import files as sources
from foliospark.sources import office, pdf
from foliospark.streaming import jobs as streams

from . import fixtures as fx

S = settings(env={})


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("input")
    (d / "deep").mkdir()
    long = [f"page {i} " + "x" * 80 for i in range(25)]
    for name, content in {
        "a.docx": fx.docx(), "b.xlsx": fx.xlsx(), "c.pptx": fx.pptx(), "d.odt": fx.odt(), "e.rtf": fx.RTF, "f.csv": fx.CSV, "old.doc": b"\xd0\xcf", "broken.docx": b"PK", "six.pdf": fx.pdf(long[:6]),
        "scan.pdf": fx.pdf([""] * 3), "bad.pdf": b"nothing", "locked.pdf": fx.pdf(["x"], encrypted=True), "pic.png": b"\x89PNG", "note.xyz": b"?", "_hidden.csv": fx.CSV, "deep/copy.csv": fx.CSV, "two.pdf": fx.pdf(["short " * 20, "b" * 90], flate=False),
    }.items():
        (d / name).write_bytes(content)
    return d


class Page(VisionBackend):
    """Renders nothing; answers with the page number; the PNG fails once, then is recognised."""

    def __init__(self, s):
        super().__init__(s, post=self.answer, render=lambda content, page, dpi: f"{page}".encode(), ocr=lambda image: "recognised", sleep=lambda x: None)

    def answer(self, payload):
        url = payload["messages"][1]["content"][0]["image_url"]["url"]
        if url.endswith("iVBORw==") or "iVBO" in url:
            raise ConnectionError("down")
        return "seen"


def test_readers():
    d = office.read_docx(fx.docx())
    assert [n["node_type"] for n in d.nodes] == ["heading", "paragraph", "list_item", "list_item", "list", "table"] or [n["node_type"] for n in d.nodes][-1] == "table"
    from foliospark.functions.render import document

    assert document(d.nodes, d.flat) == "# Title\n\nSome text.\n\n- one\n- two\n\n| a | b\\|c |\n| --- | --- |\n| 1 | 2 |".replace("- one\n- two", "- one\n\n- two")
    x = office.read_xlsx(fx.xlsx())
    assert x.tables == ["| head |  | 3.5 |\n| --- | --- | --- |\n|  | in |  |"] and x.pages == 1
    assert office.read_pptx(fx.pptx()).flat.splitlines() == ["First", "point", "Second", "point"]
    assert [n["text"] for n in office.read_odf(fx.odt()).nodes] == ["Head", "Body", "x", ""]
    assert office.read_rtf(fx.RTF).flat == "Hello bold\ncafé €"
    assert office.read_csv(fx.CSV).tables == ["| name | note |\n| --- | --- |\n| x | a\\|b |\n| y | two lines |"]
    with pytest.raises(ValueError):
        office.read(".doc", b"")


def test_pdf():
    content = fx.pdf(["Hello (x)".replace("(", "\\(").replace(")", "\\)"), "", "Third"])
    assert pdf.page_count(content) == 3 and pdf.page_texts(content) == ["Hello (x)", "", "Third"]
    assert pdf.sampled_chars(content, 2) == [9, 0] and pdf.page_count(b"x") == 0 and pdf.page_count(fx.pdf(["a"], encrypted=True)) == 0
    assert pdf.page_count(content[: content.index(b"trailer") // 2]) >= 1


def test_scans(spark, folder):
    assert {r.name for r in sources.scan_dir(spark, str(folder)).select("name").collect()} >= {"a.docx", "six.pdf"}
    tree = {r.name for r in sources.scan_tree(spark, str(folder)).select("name").collect()}
    assert "copy.csv" in tree and "_hidden.csv" not in tree
    assert sources.scan_file(spark, str(folder / "f.csv")).select("ext", "length").first() == (".csv", len(fx.CSV))


def test_run(spark, folder, tmp_path):
    out = run(sources.scan_tree(spark, str(folder)), S, Registry().register("vision", Page))
    sinks.write_results(out, str(tmp_path / "r"))
    rows = {r.source: r for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert len(rows) == 16
    assert {k for k, r in rows.items() if not r.ok} == {"old.doc", "broken.docx", "bad.pdf", "locked.pdf", "note.xyz"}
    assert rows["six.pdf"].doc_class == "PDF_SHORT_TEXT" and "page 5" in rows["six.pdf"].content and rows["six.pdf"].content.startswith("---\nsource: six.pdf\nparser: text_pdf\npages: 6\n---\n\n")
    assert rows["scan.pdf"].doc_class == "PDF_SHORT_SCAN" and rows["scan.pdf"].content.endswith("seen\n\n---\n*Page 2*\n\nseen\n\n---\n*Page 3*\n\nseen") and rows["scan.pdf"].pages == 3
    assert rows["pic.png"].cpu_fallback and "recognised" in rows["pic.png"].content
    assert rows["two.pdf"].doc_class == "PDF_VLM_TEXT" and rows["f.csv"].table_count == 1
    results = spark.read.parquet(str(tmp_path / "r"))
    sinks.write_documents(results, str(tmp_path / "docs"), S)
    documents = spark.read.parquet(str(tmp_path / "docs"))
    assert documents.count() == 11 and documents.where("output_name = 'six.txt'").count() == 1
    sinks.export_documents(documents, str(tmp_path / "export"))
    assert (tmp_path / "export" / "output_name=six.txt").exists()
    sinks.write_summary(results, str(tmp_path / "s"), 1.234)
    value = json.loads(spark.read.text(str(tmp_path / "s")).first()[0])
    assert value["total_elapsed_s"] == 1.23 and len(value["files"]) == 16 and "pages" in value["files"][0]


class Garbage:
    def __init__(self, s):
        pass

    def parse(self, name, ext, content, pages, force_ocr):
        return Parsed("clean ﬁne" if force_ocr else "中文" * 40, 6, 0)


def test_second_pass(spark, folder):
    out = run(sources.scan_file(spark, str(folder / "six.pdf")), S, Registry().register("text_pdf", Garbage)).first()
    assert out.content.endswith("clean fine") and out.ok


class Counted:
    """Writes down each call."""

    def __init__(self, s, folder):
        self.folder = folder

    def parse(self, name, ext, content, pages, force_ocr):
        import uuid

        (self.folder / f"{name}-{force_ocr}-{uuid.uuid4().hex}").touch()
        return Parsed("plain", 1, 0) if force_ocr or name != "f.csv" else Parsed("\x00" * 40, 1, 0)


def test_each_document_is_parsed_once(spark, folder, tmp_path):
    """And once more where its text is garbage; no content is shuffled on the way."""
    calls = tmp_path / "calls"
    calls.mkdir()
    registry = Registry().register("office", lambda s: Counted(s, calls)).register("vision", lambda s: Counted(s, calls))
    out = run(sources.scan_tree(spark, str(folder)), S, registry, scratch=str(tmp_path / "work"))
    assert out.count() == 16 and out.where("source = 'f.csv' and ok").count() == 1
    told = sorted(p.name.rsplit("-", 1)[0] for p in calls.iterdir())
    assert len(told) == len(set(told)) + told.count("copy.csv-False") - 1 and "f.csv-True" in told and sum(t.endswith("-True") for t in told) == 1
    plan = run(sources.scan_tree(spark, str(folder)), S, registry, second_pass=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_pages_side_by_side():
    """Pages of a document are asked for at the same time and put together in order."""
    import threading

    s = settings(env={}, vlm_max_workers=4)
    meet = threading.Barrier(3, timeout=10)
    v = VisionBackend(s, post=lambda p: meet.wait() or "seen", render=lambda c, page, dpi: b"x")
    v.post = lambda p: f"seen {meet.wait() >= 0}"
    got = v.parse("a.pdf", ".pdf", fx.pdf([""] * 3), None, False)
    assert got.pages == 3 and got.text == "seen True\n\n---\n*Page 2*\n\nseen True\n\n---\n*Page 3*\n\nseen True"


def test_retries():
    waits, calls = [], []

    def post(payload):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("x")
        return "ok"

    assert VisionBackend(S, post=post, sleep=waits.append).ask(b"", True) == "ok" and waits == [1.0, 2.0]
    text, used = VisionBackend(S, post=lambda p: 1 / 0, sleep=waits.append).page(b"", 1)
    assert used and text.startswith("\n\n> Page 2 could not be extracted")


def test_cli(spark, folder, tmp_path):
    assert main([str(folder / "f.csv"), str(tmp_path / "o"), "--file"]) == 0
    assert main([str(folder / "old.doc"), str(tmp_path / "p"), "--file"]) == 1
    assert main([str(folder), str(tmp_path / "m"), "--classify-only"]) == 0
    assert spark.read.parquet(str(tmp_path / "m/manifest")).where("unique_name = 'office/a.docx'").count() == 1


def at(hour: float) -> datetime.datetime:
    return datetime.datetime(2025, 1, 1) + datetime.timedelta(hours=hour)


def test_state_moves():
    s = streams.advance(None, (at(0), "processing", None, None), 86_400)
    assert s is None  # unknown jobs are not updated
    s = streams.advance(None, (at(0), "queued", "f", None), 86_400)
    s = streams.advance(s, (at(23), "processing", None, None), 86_400)
    s = streams.advance(s, (at(46), "failed", None, "e"), 86_400)
    assert s == ("f", at(0), at(46), "failed", "e")
    assert streams.advance(s, (at(47), "processing", None, None), 86_400) == s
    assert streams.advance(s, (at(70), "done", None, None), 86_400) is None
    assert streams.advance(s, (at(70), "queued", "g", None), 86_400)[0] == "g"


def test_job_stream(spark, tmp_path):
    schema = "job_id string, ts timestamp, status string, filename string, error string"
    rows = [("a", at(0), "queued", "f", None), ("a", at(1), "processing", None, None), ("a", at(2), "done", None, None), ("b", at(0), "queued", "g", None), ("c", at(0), "done", None, None)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = streams.job_states(events, 86_400).writeStream.outputMode("update").format("memory").queryName("jobs").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    found = {r.job_id: r.status for r in spark.table("jobs").collect()}
    assert found == {"a": "done", "b": "queued"}
    now = streams.current(spark.table("jobs"), at(24.5), 86_400)
    assert [r.job_id for r in now.collect()] == ["a"]


def test_uploads(spark, folder, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "x.csv").write_bytes(fx.CSV)
    (landing / "y.exe").write_bytes(b"1")
    seen = []
    up = streams.accept(sources.upload_stream(spark, str(landing)), S)
    q = streams.ingest(up, lambda df, i: seen.extend((r.name, r.http_status) for r in df.select("name", "http_status").collect()), str(tmp_path / "cp2"))
    q.awaitTermination()
    assert sorted(seen) == [("x.csv", 202), ("y.exe", 400)]
    assert sources.upload_stream(spark, str(landing)).isStreaming and streams.unique_uploads(sources.upload_stream(spark, str(landing))).isStreaming


def test_outputs_read_back(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "_summary.txt").write_text("{}")
    assert [tuple(r) for r in sources.read_outputs(spark, str(tmp_path)).collect()] == [("a.txt", "one\ntwo")]
    assert spark.range(1).select(F.lit(1)).count() == 1
