"""Command line: python -m foliospark.plans.cli INPUT OUTPUT [options]."""

from __future__ import annotations

import argparse
import logging
import sys
import time

from ..config import PROFILES, settings
from ..operators.jobs import summary_lines
from ..sources.files import scan_file, scan_tree
from . import sinks
from .ingest import pdf_info, run


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="foliospark", description="Classify documents, parse them and write Markdown with a summary.")
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--profile", choices=sorted(PROFILES), default="engine")
    p.add_argument("--file", action="store_true", help="the input is one file")
    p.add_argument("--one-summary", action="store_true", help="write the summary as one JSON object too, which one task holds")
    p.add_argument("--classify-only", action="store_true", help="write the manifest alone")
    for name, kind in (("vlm-text-threshold", int), ("long-pdf-threshold", int), ("scanned-long-threshold", int), ("scan-char-threshold", int), ("long-head-pages", int), ("long-tail-pages", int), ("vlm-base-url", str), ("vlm-model", str), ("vlm-max-tokens", int), ("vlm-image-dpi", int), ("vlm-max-workers", int)):
        p.add_argument(f"--{name}", type=kind)
    return p.parse_args(args)


def main(args: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from ..operators.classify import classify

    a = vars(arguments(args))
    source, output, profile, single, only, one = (a.pop(k) for k in ("input", "output", "profile", "file", "classify_only", "one_summary"))
    s = settings(profile, **a)
    spark = SparkSession.builder.getOrCreate()
    log, began = logging.getLogger("foliospark"), time.time()
    files = scan_file(spark, source) if single else scan_tree(spark, source)
    if only:
        sinks.manifest(classify(pdf_info(files, s), s)).write.mode("overwrite").parquet(f"{output}/manifest")
        return 0
    sinks.write_results(run(files, s, scratch=f"{output}/_work"), f"{output}/results")
    results = spark.read.parquet(f"{output}/results")
    sinks.write_documents(results, f"{output}/documents", s)
    summary_lines(results).write.mode("overwrite").text(f"{output}/summary_lines")
    if one:
        sinks.write_summary(results, f"{output}/summary", time.time() - began)
    failed = results.where("NOT ok").count()
    log.info("%s failed, %.1f s", failed, time.time() - began)
    return int(single and failed > 0)


if __name__ == "__main__":
    sys.exit(main())
