"""Where results go. All writes go through Spark's commit protocol, so a lost executor leaves nothing half-written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import stem
from ..operators.assemble import numbered_names
from ..operators.jobs import summary


def write_results(results: DataFrame, path: str) -> None:
    """Parquet by class: the folder of a class takes the place of moving its files."""
    results.write.mode("overwrite").partitionBy("doc_class").parquet(path)


def write_documents(results: DataFrame, path: str, s: Settings) -> None:
    """(output_name, doc_id, content) of all texts in large files, dealt by size and not by document: a folder or file for each would burden the commit. `export_documents` makes files of them."""
    named = numbered_names(results.where("ok").withColumn("base", F.concat(stem(F.col("source")), F.lit(s.output_suffix))), "base", "doc_id", "output_name")
    named.select("output_name", "doc_id", "content").write.mode("overwrite").parquet(path)


def export_documents(documents: DataFrame, path: str) -> None:
    """A folder for each document that is given, with its text in it: for the documents of one batch, not for a corpus."""
    documents.select("output_name", F.col("content").alias("value")).write.mode("overwrite").option("lineSep", "\u0000").partitionBy("output_name").text(path)


def manifest(files: DataFrame) -> DataFrame:
    """(doc_id, name, doc_class, folder, unique_name): what sorting into folders would give; files without class are left out."""
    shown = files.where(F.col("folder").isNotNull())
    return numbered_names(shown.withColumn("full", F.concat("folder", F.lit("/"), "name")), "full", "doc_id").select("doc_id", "name", "doc_class", "folder", "unique_name")


def write_summary(results: DataFrame, path: str, total_elapsed_s: float) -> None:
    summary(results, total_elapsed_s).coalesce(1).write.mode("overwrite").text(path)


def write_text(one: DataFrame, path: str) -> None:
    one.coalesce(1).write.mode("overwrite").text(path)


def parser_lines(results: DataFrame) -> DataFrame:
    """The JSON line of every result, nulls written out."""
    shown = F.struct("ok", "parser", "pages", "error", "table_count", "cpu_fallback")
    return results.select("doc_id", F.to_json(shown, {"ignoreNullFields": "false"}).alias("line"))
