"""Routing: extension, page count and text layer decide a document's class, parser, folder and slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLASS_FOLDERS, LONG_CLASSES, PDF_EXTENSION, UNKNOWN, UNREADABLE, Settings


def sample_pages(total: Column, sample: int) -> Column:
    """Evenly spaced page numbers from 0: floor(i * total / n) for n = min(sample, total) values of i."""
    n = F.least(F.lit(sample).cast("long"), total.cast("long"))
    spaced = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.floor(i * total.cast("long") / n).cast("long"))
    return F.when(n > 0, F.array_distinct(spaced)).otherwise(F.array().cast("array<bigint>"))


def scanned(average: Column, total: Column, threshold: int) -> Column:
    """Little text on a page: a scan. No pages: a scan too. An unknown average: not."""
    return F.when(total == 0, True).otherwise(F.coalesce(average < threshold, F.lit(False)))


def doc_class(ext: Column, pages: Column, is_scan: Column, s: Settings) -> Column:
    pages = F.coalesce(pages, F.lit(0))
    pdf = (
        F.when(pages == 0, UNKNOWN)
        .when(is_scan & (pages > s.scanned_long_threshold), "PDF_LONG_SCAN")
        .when(is_scan, "PDF_SHORT_SCAN")
        .when(pages <= s.vlm_text_threshold, "PDF_VLM_TEXT")
        .when(pages > s.long_pdf_threshold, "PDF_LONG_TEXT")
        .otherwise("PDF_SHORT_TEXT")
    )
    return F.when(ext.isin(*s.office_extensions), "OFFICE").when(ext.isin(*s.image_extensions), "IMAGE").when(ext == PDF_EXTENSION, pdf).otherwise(UNKNOWN)


def folder(cls: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in CLASS_FOLDERS.items() for x in pair])[cls]


def parser(cls: Column) -> Column:
    return F.when(cls == "OFFICE", "office").when(cls == "PDF_SHORT_TEXT", "text_pdf").when(cls == UNKNOWN, "none").otherwise("vision")


def slots(route: Column, s: Settings) -> Column:
    return F.when(route == "office", s.office_slots).when(route == "text_pdf", s.text_slots).otherwise(s.vision_slots)


def label(cls: Column) -> Column:
    return F.lower(F.replace(F.replace(cls, F.lit("PDF_"), F.lit("")), F.lit("_"), F.lit("/")))


def is_long(cls: Column) -> Column:
    return cls.isin(*LONG_CLASSES)


def page_limits(pages: DataFrame, s: Settings, doc: str = "doc_id", page: str = "page_no", head: int | None = None, tail: int | None = None) -> DataFrame:
    """The first and last pages of each document; all of a document with no more than both together. Column n_pages is the document's count."""
    head, tail = s.long_head_pages if head is None else head, s.long_tail_pages if tail is None else tail
    # a partial count and a join that may be split, not a window: a document with a large part of all pages is no task of its own
    counts = pages.groupBy(F.col(doc).alias("_of")).agg(F.count("*").alias("n_pages"))
    counted = pages.join(counts, F.col(doc).eqNullSafe(F.col("_of"))).drop("_of")
    return counted.where((F.col("n_pages") <= head + tail) | (F.col(page) < head) | (F.col(page) >= F.col("n_pages") - tail))


def upload_gate(ext: Column, length: Column, s: Settings) -> Column:
    """HTTP status of an upload: 400 for other extensions, 413 above the size limit, else 202."""
    return F.when(~ext.isin(*s.allowed_uploads), 400).when(length > s.max_upload_mb * 1024 * 1024, 413).otherwise(202)


def unreadable_rows(files: DataFrame) -> DataFrame:
    """Error rows of documents without a class."""
    return files.where(F.col("doc_class") == UNKNOWN).select(
        "doc_id", F.col("name").alias("source"), "doc_class", F.lit("none").alias("parser"), F.lit("").alias("content"), F.lit(None).cast("int").alias("pages"), F.lit(False).alias("ok"),
        F.lit(UNREADABLE).alias("error"), F.lit(0.0).alias("elapsed_s"), F.lit(None).cast("int").alias("table_count"), F.lit(False).alias("cpu_fallback"),
    )


def classify(files: DataFrame, s: Settings) -> DataFrame:
    """files (ext, page_count, chars of the sampled pages) with doc_class, parser, folder and label."""
    average = F.aggregate("chars", F.lit(0.0), lambda a, x: a + x) / F.when(F.size("chars") > 0, F.size("chars"))
    # step by step: a column that is used more than once is computed once
    out = files.withColumn("_scan", scanned(average, F.col("page_count"), s.scan_char_threshold))
    out = out.withColumn("doc_class", doc_class(F.col("ext"), F.col("page_count"), F.col("_scan"), s)).drop("_scan")
    return out.withColumns({"parser": parser(F.col("doc_class")), "folder": folder(F.col("doc_class")), "label": label(F.col("doc_class"))})
