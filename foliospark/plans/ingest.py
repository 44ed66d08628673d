"""A run: scan, classify, route, parse, check, parse again where the text is garbage, and put the results together.

Inputs are never moved and a document is known by its path, so a run can be repeated. A document's route follows from the document alone,
so one pass over the scan looks at it, routes it and parses it where its content was read: no content is shuffled or joined, and tasks
follow the input's size. The pass is written (with a scratch folder), so every document is parsed once. Only documents whose text is
garbage are read again, by a join with their paths. Parsers that wait for a server are held back by `vision_slots` in each worker.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LONG_CLASSES, PDF_EXTENSION, UNREADABLE, Settings
from ..functions.text import arabic_forms, count_tables, front_matter, nfkc, office_garbage, pdf_garbage, strip_bidi, yes_no
from ..operators.classify import classify
from ..schemas import RESULT
from ..sources import pdf
from .backends import Backend, Registry

_PARSED = "doc_id string, source string, doc_class string, parser string, ext string, text string, pages int, table_count int, cpu_fallback boolean, error string, elapsed_s double"


def pdf_info(files: DataFrame, s: Settings, content: bool = False) -> DataFrame:
    """files with page_count and chars, with their content if asked for. Only PDFs are read for that; the others never reach Python."""
    kept = [f for f in files.schema.fields if content or f.name != "content"]
    names, sample = [f.name for f in kept], s.scan_sample_pages

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[names].assign(page_count=[pdf.page_count(c) for c in b["content"]], chars=[pdf.sampled_chars(c, sample) for c in b["content"]])

    is_pdf = F.coalesce(F.col("ext") == PDF_EXTENSION, F.lit(False))
    info = "page_count int, chars array<int>"
    pdfs = files.where(is_pdf).mapInPandas(look, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), info]))
    others = files.where(~is_pdf).select(*names, F.lit(None).cast("int").alias("page_count"), F.lit(None).cast("array<int>").alias("chars"))
    return others.unionByName(pdfs)


def pdf_pages(files: DataFrame) -> DataFrame:
    """(doc_id, page_no, text) of readable PDFs, a row for each page."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, content in zip(b["doc_id"], b["content"], strict=True):
                try:
                    rows += [(doc_id, i, t) for i, t in enumerate(pdf.page_texts(content))]
                except (ValueError, TypeError, IndexError):
                    continue  # unreadable files have no pages
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "text"]).astype({"page_no": "int32"})

    return files.where(F.col("ext") == PDF_EXTENSION).select("doc_id", "content").mapInPandas(look, "doc_id string, page_no int, text string")


def parse(routed: DataFrame, s: Settings, registry: Registry, force_ocr: bool = False) -> DataFrame:
    """Results of all routes. A backend is made in a task when its first document comes; documents without a class are error rows."""
    long_pages = (s.long_head_pages, s.long_tail_pages)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backends: dict[str, Backend] = {}
        for batch in batches:
            rows = []
            for doc_id, name, cls, route, ext, total, content in batch.itertuples(index=False):
                if route == "none":
                    rows.append((doc_id, name, cls, route, ext, "", None, None, False, UNREADABLE, 0.0))
                    continue
                began = time.time()
                pages = None
                if cls in LONG_CLASSES and total > sum(long_pages):
                    pages = [*range(long_pages[0]), *range(int(total) - long_pages[1], int(total))]
                try:
                    if route not in backends:
                        backends[route] = registry.make(route, s)
                    got = backends[route].parse(name, ext, content, pages, force_ocr)
                    rows.append((doc_id, name, cls, route, ext, got.text, got.pages, got.table_count, got.cpu_fallback, None, time.time() - began))
                except Exception as e:  # a document that fails is a row, not the end of a run
                    rows.append((doc_id, name, cls, route, ext, "", None, None, False, str(e) or type(e).__name__, time.time() - began))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PARSED.split(", ")])

    return routed.select("doc_id", "name", "doc_class", "parser", "ext", F.coalesce("page_count", F.lit(0)).alias("page_count"), "content").mapInPandas(run, _PARSED)


def is_garbage(s: Settings):
    text = strip_bidi(F.col("text"))
    office = (F.col("parser") == "office") & (office_garbage(text) > s.office_garbage)
    pdfs = (F.col("parser") == "text_pdf") & ((pdf_garbage(text) > s.pdf_garbage) | (arabic_forms(text) > s.arabic_forms))
    return F.col("error").isNull() & (office | pdfs)


def finish(parsed: DataFrame, s: Settings) -> DataFrame:
    """Cleaned texts behind their front matter."""
    text = strip_bidi(F.col("text"))
    text = F.when(F.col("parser") == "text_pdf", nfkc(text)).otherwise(text)
    extra = {
        "model": F.when(F.col("parser") == "vision", F.lit(s.vlm_model)),
        "pages": F.col("pages").cast("string"),
        "cpu_fallback": F.when(F.col("parser") == "vision", yes_no(F.col("cpu_fallback"))),
    }
    content = F.when(F.col("error").isNull(), F.concat(front_matter(F.col("source"), F.col("parser"), **extra), F.col("clean"))).otherwise("")
    tables = F.coalesce("table_count", F.when(F.col("error").isNull(), count_tables(F.col("clean"))))
    done = parsed.withColumn("clean", text)
    return done.select("doc_id", "source", "doc_class", "parser", content.alias("content"), "pages", F.col("error").isNull().alias("ok"), "error", F.round("elapsed_s", 2).alias("elapsed_s"), tables.alias("table_count"), "cpu_fallback")


def run(files: DataFrame, s: Settings, registry: Registry | None = None, second_pass: bool = True, scratch: str | None = None) -> DataFrame:
    """A row (schemas.RESULT) for each file. scratch: a folder that driver and executors share, for what the passes give; without one a pass runs again for each use."""
    registry = registry or Registry()
    kept = (lambda df, name: written(df, f"{scratch}/{name}")) if scratch else (lambda df, name: df)
    parsed = kept(parse(classify(pdf_info(files, s, content=True), s), s, registry), "first")
    if second_pass:
        # recognised again only where the text layer is garbage; a failed second pass keeps the first
        bad = kept(parsed.where(is_garbage(s)).select(F.col("doc_id").alias("bad_id")), "bad")
        seen = files.join(bad, F.col("doc_id") == F.col("bad_id"), "left_semi")
        again = kept(parse(classify(pdf_info(seen, s, content=True), s), s, registry, force_ocr=True), "second").where(F.col("error").isNull())
        parsed = parsed.join(again.select(F.col("doc_id").alias("again_id")), F.col("doc_id") == F.col("again_id"), "left_anti").unionByName(again)
    out = finish(parsed, s)
    assert [c.split()[0] for c in RESULT.split(", ")] == out.columns
    return out


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
