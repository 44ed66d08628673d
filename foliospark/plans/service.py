"""An HTTP service over runs: batches of files, and jobs of one file that expire. On the standard library.

    POST   /api/v1/batches               files -> 202 with the batch's id
    GET    /api/v1/batches/ID            status, files
    GET    /api/v1/batches/ID/result     texts; 409 while it is not finished
    DELETE /api/v1/batches/ID            204; 409 while it is processing
    POST   /upload                       one file -> 202; 400 for other types, 413 if it is too large
    GET    /status/ID, /result/ID        a job
    DELETE /jobs/ID
    GET    /api/v1/health, /health

The service holds states only; files are in its folder, and runs are Spark jobs that write Parquet there.
"""

from __future__ import annotations

import json
import logging
import re
import shutil
import threading
import time
import uuid
from collections.abc import Callable
from email.parser import BytesParser
from email.policy import HTTP
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

from pyspark.sql import SparkSession

from ..config import Settings
from ..operators.assemble import FILE_BREAK, free_names
from ..sources.files import scan_dir
from .backends import Registry
from .ingest import run

log = logging.getLogger(__name__)
Answer = tuple[int, dict | None]
_FILE = ("parser", "pages", "table_count", "elapsed_s", "error", "cpu_fallback")


class Service:
    """clock and start stand in for time and threads in tests."""

    def __init__(self, spark: SparkSession, root: str, s: Settings, registry: Registry | None = None, clock: Callable[[], float] = time.time, start: Callable | None = None) -> None:
        self.spark, self.root, self.s, self.registry, self.clock = spark, Path(root), s, registry, clock
        self.start = start or (lambda f, *a: threading.Thread(target=f, args=a, daemon=True).start())
        self.lock = threading.Lock()
        self.states: dict[str, dict] = {}

    # states

    def _touch(self, key: str, **values: object) -> None:
        with self.lock:
            if key in self.states:
                self.states[key] |= {**values, "updated_at": self.clock()}

    def _get(self, key: str, kind: str) -> dict | None:
        with self.lock:
            state = self.states.get(key)
            if state is None or state["kind"] != kind:
                return None
            if kind == "job" and self.clock() - state["updated_at"] >= self.s.job_ttl_s:
                del self.states[key]
                return None
            return dict(state)

    def _create(self, kind: str, files: list[tuple[str, bytes]]) -> dict:
        key, now = uuid.uuid4().hex, self.clock()
        folder = self.root / key / "input"
        folder.mkdir(parents=True)
        # path parts of client names are dropped; names that Spark's listing would hide are shown
        names = free_names(re.sub(r"^[_.]+", "", re.split(r"[/\\]", n)[-1]) or "upload" for n, _ in files)
        for name, (_, content) in zip(names, files, strict=True):
            (folder / name).write_bytes(content)
        state = {"id": key, "kind": kind, "status": "queued", "created_at": now, "updated_at": now, "error": None, "names": names, "results": {}}
        with self.lock:
            self.states[key] = state
        self.start(self._process, key)
        return state

    def _process(self, key: str) -> None:
        self._touch(key, status="processing")
        try:
            out = str(self.root / key / "results")
            run(scan_dir(self.spark, str(self.root / key / "input")), self.s, self.registry).write.mode("overwrite").parquet(out)
            results = {r.source: r.asDict() for r in self.spark.read.parquet(out).collect()}  # one upload's files
        except Exception as e:
            log.exception("%s failed", key)
            self._touch(key, status="failed", error=str(e))
            return
        failed = [r["error"] for r in results.values() if not r["ok"]]
        job = self.states.get(key, {}).get("kind") == "job"
        lost = job and results and len(failed) == len(results)
        self._touch(key, status="failed" if lost else "done", error="; ".join(sorted(failed)) if lost else None, results=results)

    # batches

    def create_batch(self, files: list[tuple[str, bytes]]) -> Answer:
        if not files:
            return 400, {"detail": "the form holds no files"}
        b = self._create("batch", files)
        return 202, {"batch_id": b["id"], "status": "queued", "files": b["names"]}

    def _files(self, state: dict, text: bool) -> list[dict]:
        out = []
        for name in state["names"]:
            r = state["results"].get(name)
            row = {"filename": name, "status": "pending" if r is None else "ok" if r["ok"] else "error", **{k: r[k] if r else None for k in _FILE}}
            row["cpu_fallback"] = bool(row["cpu_fallback"])
            if text:
                row["markdown"] = r["content"] if r and r["ok"] else None
                del row["elapsed_s"]
            out.append(row)
        return out

    def batch(self, key: str) -> Answer:
        b = self._get(key, "batch")
        if b is None:
            return 404, {"detail": "there is no such batch"}
        return 200, {"batch_id": key, **{k: b[k] for k in ("status", "created_at", "updated_at", "error")}, "files": self._files(b, False)}

    def batch_result(self, key: str) -> Answer:
        b = self._get(key, "batch")
        if b is None:
            return 404, {"detail": "there is no such batch"}
        if b["status"] in ("queued", "processing"):
            return 409, {"detail": f"the batch is {b['status']}"}
        return 200, {"batch_id": key, "status": b["status"], "files": self._files(b, True)}

    def delete_batch(self, key: str) -> Answer:
        b = self._get(key, "batch")
        if b is None:
            return 404, {"detail": "there is no such batch"}
        if b["status"] == "processing":
            return 409, {"detail": "the batch is being processed"}
        return self._delete(key)

    def _delete(self, key: str) -> Answer:
        with self.lock:
            self.states.pop(key, None)
        shutil.rmtree(self.root / key, ignore_errors=True)
        return 204, None

    # jobs

    def upload(self, files: list[tuple[str, bytes]]) -> Answer:
        name, content = files[0] if files else ("", b"")
        ext = Path(name).suffix.lower()
        if ext not in self.s.allowed_uploads:
            return 400, {"detail": f"files of type {ext!r} are not taken"}
        if len(content) > self.s.max_upload_mb * 1024 * 1024:
            return 413, {"detail": f"the file is larger than {self.s.max_upload_mb} MB"}
        return 202, {"job_id": self._create("job", [(name, content)])["id"], "filename": name}

    def job(self, key: str) -> Answer:
        j = self._get(key, "job")
        if j is None:
            return 404, {"detail": "there is no such job"}
        return 200, {"job_id": key, "filename": j["names"][0], **{k: j[k] for k in ("status", "created_at", "updated_at", "error")}}

    def job_result(self, key: str) -> Answer:
        j = self._get(key, "job")
        if j is None:
            return 404, {"detail": "there is no such job"}
        if j["status"] != "done":
            return 409, {"detail": f"the job is {j['status']}"}
        texts = FILE_BREAK.join(r["content"] for _, r in sorted(j["results"].items()) if r["ok"])
        summary = {"files": [{k: r[k] for k in ("source", *_FILE, "ok")} for _, r in sorted(j["results"].items())]}
        return 200, {"job_id": key, "status": "done", "filename": j["names"][0], "markdown": texts, "summary": summary}

    def delete_job(self, key: str) -> Answer:
        return self._delete(key) if self._get(key, "job") else (404, {"detail": "there is no such job"})

    def health(self) -> Answer:
        up = not self.spark.sparkContext._jsc.sc().isStopped()
        return 200, {"status": "ok" if up else "degraded", "spark": "ok" if up else "error"}

    def route(self, method: str, path: str, files: Callable[[], list[tuple[str, bytes]]]) -> Answer:
        routes = [
            ("POST", r"/api/v1/batches", lambda: self.create_batch(files())),
            ("GET", r"/api/v1/batches/(\w+)", self.batch),
            ("GET", r"/api/v1/batches/(\w+)/result", self.batch_result),
            ("DELETE", r"/api/v1/batches/(\w+)", self.delete_batch),
            ("POST", r"/upload", lambda: self.upload(files())),
            ("GET", r"/status/(\w+)", self.job),
            ("GET", r"/result/(\w+)", self.job_result),
            ("DELETE", r"/jobs/(\w+)", self.delete_job),
            ("GET", r"(?:/api/v1)?/health", self.health),
        ]
        for verb, pattern, call in routes:
            if verb == method and (m := re.fullmatch(pattern, path)):
                return call(*m.groups())
        return 404, {"detail": "there is no such path"}


def multipart(content_type: str, body: bytes) -> list[tuple[str, bytes]]:
    """(file name, content) of the files of a form."""
    message = BytesParser(policy=HTTP).parsebytes(b"Content-Type: " + content_type.encode() + b"\r\n\r\n" + body)
    parts = message.iter_parts() if message.is_multipart() else ()
    return [(p.get_filename(), p.get_payload(decode=True) or b"") for p in parts if p.get_filename()]


def server(service: Service, host: str = "127.0.0.1", port: int = 8080) -> ThreadingHTTPServer:
    class Handler(BaseHTTPRequestHandler):
        def _answer(self) -> None:
            length = int(self.headers.get("Content-Length") or 0)
            body = self.rfile.read(length)
            code, value = service.route(self.command, self.path.split("?")[0], lambda: multipart(self.headers.get("Content-Type", ""), body))
            data = b"" if value is None else json.dumps(value, ensure_ascii=False).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = do_DELETE = _answer

        def log_message(self, *args: object) -> None:
            log.info("%s", args)

    return ThreadingHTTPServer((host, port), Handler)
