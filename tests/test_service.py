from __future__ import annotations

import io
import json
import logging
import threading

import pytest
import requests

from foliospark.config import settings
from foliospark.plans.backends import first_working
from foliospark.plans.ingest import pdf_pages
from foliospark.plans.logs import JsonLines
from foliospark.plans.service import Service, server
from foliospark.sources import files as sources
from foliospark.streaming import jobs as streams

from . import fixtures as fx

S = settings(env={}, max_upload_mb=1)


@pytest.fixture
def service(spark, tmp_path):
    waiting = []
    s = Service(spark, str(tmp_path), S, clock=lambda: s.now, start=lambda f, *a: waiting.append((f, a)))
    s.now, s.waiting = 0.0, waiting
    return s


def finish(service):
    while service.waiting:
        f, a = service.waiting.pop()
        f(*a)


def test_batch(service):
    assert service.create_batch([])[0] == 400
    code, b = service.create_batch([("../x/a.csv", fx.CSV), ("a.csv", fx.CSV), ("b.exe", b"1")])
    key = b["batch_id"]
    assert code == 202 and b["files"] == ["a.csv", "a_1.csv", "b.exe"]
    assert service.batch_result(key)[0] == 409 and service.batch("no")[0] == 404
    service.states[key]["status"] = "processing"
    assert service.delete_batch(key)[0] == 409
    finish(service)
    code, out = service.batch_result(key)
    assert out["status"] == "done" and [f["status"] for f in out["files"]] == ["ok", "ok", "error"] and "| x | a\\|b |" in out["files"][1]["markdown"]
    assert service.batch(key)[1]["files"][0]["parser"] == "office"
    assert service.delete_batch(key) == (204, None) and service.batch(key)[0] == 404 and not (service.root / key).exists()


def test_job(service):
    assert service.upload([("a.exe", b"")])[0] == 400 and service.upload([("a.csv", b"x" * (1 << 20) + b"y")])[0] == 413
    _, j = service.upload([("a.csv", fx.CSV)])
    key = j["job_id"]
    assert service.job_result(key)[0] == 409
    finish(service)
    code, out = service.job_result(key)
    assert code == 200 and out["markdown"].startswith("---\nsource: a.csv") and out["summary"]["files"][0]["ok"]
    service.now = S.job_ttl_s
    assert service.job(key)[0] == 404
    _, j = service.upload([("a.doc", b"x")])
    finish(service)
    assert service.job(j["job_id"])[1]["status"] == "failed" and service.job_result(j["job_id"])[0] == 409
    assert service.delete_job(j["job_id"])[0] == 204 and service.delete_job(j["job_id"])[0] == 404


def test_http(service):
    http = server(service, port=0)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{http.server_address[1]}"
    try:
        assert requests.get(f"{url}/health", timeout=20).json()["status"] == "ok"
        r = requests.post(f"{url}/api/v1/batches", files=[("files", ("ü.csv", fx.CSV)), ("files", ("p.pdf", fx.pdf(["x" * 90] * 5)))], timeout=20)
        assert r.status_code == 202
        finish(service)
        out = requests.get(f"{url}/api/v1/batches/{r.json()['batch_id']}/result", timeout=20).json()
        assert {f["status"] for f in out["files"]} == {"ok"}
        assert requests.delete(f"{url}/api/v1/batches/{r.json()['batch_id']}", timeout=20).status_code == 204
        assert requests.get(f"{url}/nothing", timeout=20).status_code == 404
    finally:
        http.shutdown()


def test_pdf_pages(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(fx.pdf(["one", "", "three"]))
    (tmp_path / "b.pdf").write_bytes(b"broken")
    rows = pdf_pages(sources.scan_dir(spark, str(tmp_path))).orderBy("page_no").collect()
    assert [(r.page_no, r.text) for r in rows] == [(0, "one"), (1, ""), (2, "three")]


def test_streamed_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_bytes(fx.CSV)
    (tmp_path / "in/b.exe").write_bytes(b"1")
    for attempt in range(2):  # a second stream over the same input overwrites
        up = streams.accept(sources.upload_stream(spark, str(tmp_path / "in")), S)
        streams.ingest(up, streams.run_batches(S, str(tmp_path / "out")), str(tmp_path / f"cp{attempt}")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.source, r.ok) for r in rows] == [("a.csv", True)]
    jobs = streams.new_jobs(streams.accept(sources.scan_dir(spark, str(tmp_path / "in")), S)).collect()
    assert [(j.filename, j.status) for j in jobs] == [("a.csv", "queued")] and len(jobs[0].job_id) == 36


def test_recognition_order():
    assert first_working(lambda x: 1 / 0, lambda x: "b")(b"") == "b"
    with pytest.raises(RuntimeError, match="division"):
        first_working(lambda x: 1 / 0)(b"")


def test_json_log():
    out = io.StringIO()
    handler = logging.StreamHandler(out)
    handler.setFormatter(JsonLines())
    log = logging.getLogger("foliospark.test")
    log.addHandler(handler)
    try:
        raise ValueError("bad")
    except ValueError:
        log.exception("job %s", 7)
    entry = json.loads(out.getvalue())
    assert entry["text"] == "job 7" and entry["severity"] == "error" and "ValueError: bad" in entry["error"] and entry["source"].endswith(str(entry["source"].split(":")[-1]))
