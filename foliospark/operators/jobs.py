"""Files, results, batches and jobs: merging, counting, status rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import elapsed


def merge_results(states: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Every file of a batch with its status: pending without a result, else ok or error. Results without a file are dropped."""
    shown = results.select(F.col(key).alias("_key"), *[c for c in results.columns if c != key])
    status = F.when(F.col("_key").isNull(), "pending").when(F.col("error").isNull(), "ok").otherwise("error")
    return states.join(shown, F.col(key) == F.col("_key"), "left").withColumn("status", status).drop("_key")


def missing(submitted: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Files that were submitted and never came back."""
    return submitted.join(results.select(key).distinct(), key, "left_anti")


def verdict(ok: Column, exit_code: Column, error: Column) -> tuple[Column, Column]:
    """(ok, error) of a parser process: it must say so and exit with 0; an error always has a text."""
    good = F.coalesce(ok, F.lit(False)) & (exit_code == 0)
    text = F.nullif(error, F.lit(""))
    return good, F.when(good, text).otherwise(F.coalesce(text, F.concat(F.lit("process exited "), exit_code.cast("string"))))


def counts(results: DataFrame, by: list[str]) -> DataFrame:
    return results.groupBy(*by).agg(F.count("*").alias("n_files"), F.count_if(F.col("error").isNull()).alias("n_ok"), F.count_if(F.col("error").isNotNull()).alias("n_error"), F.bool_or(F.coalesce("cpu_fallback", F.lit(False))).alias("cpu_fallback"))


def job_status(results: DataFrame, job: str = "job_id") -> DataFrame:
    """A job fails only if it has files and all of them fail; their errors are joined in order."""
    texts = F.array_join(F.array_sort(F.collect_list("error")), "; ")
    out = results.groupBy(job).agg(F.bool_and(F.col("error").isNotNull()).alias("all_failed"), texts.alias("errors"))
    return out.select(job, F.when(F.col("all_failed"), "failed").otherwise("done").alias("status"), F.when(F.col("all_failed"), F.col("errors")).alias("error"))


def latest(events: DataFrame, job: str, ts: str, status: str, tie: str) -> DataFrame:
    """The last event of every job, by partial maxima and without a window."""
    last = F.max_by(F.struct(F.col(status).alias("s"), F.col(ts).alias("t")), F.struct(F.col(ts), F.col(tie)))
    return events.groupBy(job).agg(F.min(ts).alias("created_at"), last.alias("_l"), F.count("*").alias("n_events")).select(job, "created_at", F.col("_l.t").alias("updated_at"), F.col("_l.s").alias("status"), "n_events")


def lives(events: DataFrame, job: str, ts: str, ttl_s: int) -> DataFrame:
    """The lives of a job whose state expires `ttl_s` after its last write: a later write begins a new one."""
    w = Window.partitionBy(job).orderBy(ts)
    gap = F.coalesce(F.col(ts) - F.lag(ts).over(w) >= F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_s)), F.lit(True))
    numbered = events.withColumn("_new", gap.cast("int")).withColumn("life", F.sum("_new").over(w))
    return numbered.groupBy(job, "life").agg(F.min(ts).alias("created_at"), F.max(ts).alias("updated_at"), F.count("*").alias("n_events"))


def result_gate(status: Column) -> Column:
    """HTTP status of a request for a result."""
    return F.when(status.isNull(), 404).when(status.isin("queued", "processing"), 409).otherwise(200)


def delete_gate(status: Column) -> Column:
    return F.when(status.isNull(), 404).when(status == "processing", 409).otherwise(204)


def remove_jobs(states: DataFrame, tombstones: DataFrame, job: str = "job_id") -> DataFrame:
    """States without those deleted."""
    return states.join(tombstones.select(job).distinct(), job, "left_anti")


def with_results(states: DataFrame, markdown: DataFrame, summaries: DataFrame, job: str = "job_id") -> DataFrame:
    """Finished jobs whose Markdown and summary are both there."""
    return states.where(F.col("status") == "done").join(markdown, job).join(summaries, job)


def summary_lines(results: DataFrame) -> DataFrame:
    """A JSON line for each file, nulls written out: the form for runs whose entries do not fit in one object."""
    shown = ["source", "parser", "pages", "ok", "error", "elapsed_s", "table_count", "cpu_fallback"]
    return results.select(F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("value"))


def summary(results: DataFrame, total_elapsed_s: float) -> DataFrame:
    """One row: a JSON object of the run with an entry for each file. One row holds all entries, so it is for the runs of one batch."""
    entry = F.col("value")
    return summary_lines(results).agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("_f")).select(F.format_string('{"total_elapsed_s":%s,"files":[%s]}', F.lit(str(round(total_elapsed_s, 2))), F.col("_f")).alias("value"))


def report(found: DataFrame, unique: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """One row: counts of found, unique, returned, succeeded, failed and missing files, and whether all is well."""
    a = found.agg(F.count("*").alias("n_found"))
    b = unique.agg(F.count("*").alias("n_unique"))
    c = results.agg(F.count("*").alias("n_returned"), F.count_if(F.col("error").isNull()).alias("n_ok"), F.count_if(F.col("error").isNotNull()).alias("n_failed"))
    d = missing(unique, results, key).agg(F.count("*").alias("n_missing"))
    rows = a
    for more in (b, c, d):
        rows = rows.unionByName(more, allowMissingColumns=True)
    one = rows.agg(*[F.max(n).alias(n) for n in ("n_found", "n_unique", "n_returned", "n_ok", "n_failed", "n_missing")])
    return one.withColumn("complete", (F.col("n_failed") == 0) & (F.col("n_missing") == 0))


def report_text(counted: DataFrame, hashing_s: float, processing_s: float) -> DataFrame:
    """The report as a text."""
    line = lambda label, c: F.concat(F.lit(label), F.col(c).cast("string"))
    ending = F.when(F.col("complete"), "All unique files processed successfully.").otherwise("NOT all unique files were processed successfully.")
    times = [F.concat(F.lit(f"{what} time: "), elapsed(F.lit(float(s)), hours=True)) for what, s in (("Hashing", hashing_s), ("Processing", processing_s), ("Total", hashing_s + processing_s))]
    parts = [line("Total files found: ", "n_found"), line("Unique files: ", "n_unique"), line("Results returned: ", "n_returned"), line("  Succeeded: ", "n_ok"), line("  Failed: ", "n_failed"), F.when(F.col("n_missing") > 0, line("  MISSING: ", "n_missing")), ending, *times]
    return counted.select(F.concat_ws("\n", *parts).alias("value"))
