"""Job states over streams of events: each write restarts a state's time to live, and an expired job is unknown."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import Settings
from ..operators.classify import upload_gate
from ..schemas import JOB_STATE

_STATE = "filename string, created_at timestamp, updated_at timestamp, status string, error string"
FINISHED = ("done", "failed")
#: Allowed moves of a job.
MOVES = {None: ("queued",), "queued": ("queued", "processing", "failed"), "processing": ("processing", "done", "failed"), "done": (), "failed": ()}


def advance(state: tuple | None, event: tuple, ttl_s: int) -> tuple | None:
    """The state after an event (ts, status, filename, error). Updates of unknown or expired jobs and moves that are not allowed change nothing."""
    ts, status, filename, error = event
    if state is not None and (ts - state[2]).total_seconds() >= ttl_s:
        state = None
    if status not in MOVES[None if state is None else state[3]]:
        return state
    if state is None:
        return (filename, ts, ts, status, error)
    return (state[0], state[1], ts, status, error if error is not None else state[4])


def job_states(events: DataFrame, ttl_s: int, late: str = "10 minutes") -> DataFrame:
    """Streaming states (schemas.JOB_STATE): a row whenever a batch changes a job. events: schemas.JOB_EVENT."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        state: Any = tuple(held.get) if held.exists else None
        before = state
        for e in pd.concat(list(batches)).sort_values("ts", kind="stable").itertuples():
            state = advance(state, (e.ts.to_pydatetime(), e.status, e.filename, e.error), ttl_s)
        if state is None:
            return
        held.update(state)
        held.setTimeoutTimestamp(int(state[2].timestamp() * 1000) + ttl_s * 1000)
        if state != before:
            yield pd.DataFrame([(key[0], state[3], state[0], state[1], state[2], state[4])], columns=[c.split()[0] for c in JOB_STATE.split(", ")])

    stamped = events.withWatermark("ts", late)
    return stamped.groupBy("job_id").applyInPandasWithState(step, JOB_STATE, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def current(states: DataFrame, now, ttl_s: int) -> DataFrame:
    """The latest state of each job that has not expired, from the log of states that a stream writes."""
    fields = [c for c in states.columns if c != "job_id"]
    last = states.groupBy("job_id").agg(F.max_by(F.struct(*fields), "updated_at").alias("s")).select("job_id", "s.*")
    return last.where(F.col("updated_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_s)) > F.lit(now))


def accept(uploads: DataFrame, s: Settings) -> DataFrame:
    """Uploads with the HTTP status that they get."""
    return uploads.withColumn("http_status", upload_gate(F.col("ext"), F.col("length"), s))


def unique_uploads(uploads: DataFrame, late: str = "1 hour") -> DataFrame:
    """Uploads without repeated contents within the watermark."""
    return uploads.withColumn("content_md5", F.md5("content")).withWatermark("modificationTime", late).dropDuplicatesWithinWatermark(["content_md5"])


def ingest(uploads: DataFrame, process, checkpoint: str):
    """Starts a run for each batch of accepted uploads; a batch that comes again overwrites its own output."""
    return uploads.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_jobs(uploads: DataFrame) -> DataFrame:
    """Events (schemas.JOB_EVENT) that queue accepted uploads. Ids are random: write the result before using it twice."""
    accepted = uploads.where(F.col("http_status") == 202)
    return accepted.select(F.expr("uuid()").alias("job_id"), F.current_timestamp().alias("ts"), F.lit("queued").alias("status"), F.col("name").alias("filename"), F.lit(None).cast("string").alias("error"))


def run_batches(s: Settings, path: str, registry=None):
    """A `process` for ingest(): parses the accepted files of a batch into path/batch=N, which a repetition overwrites."""
    from ..plans.ingest import run

    def process(batch: DataFrame, number: int) -> None:
        accepted = batch.where(F.col("http_status") == 202).drop("http_status")
        run(accepted.persist(), s, registry).write.mode("overwrite").parquet(f"{path}/batch={number}")
        accepted.unpersist()

    return process
