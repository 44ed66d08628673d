"""File scans through Spark's binaryFile source: any file system, and content is read only where a plan asks for it.

Spark's listing leaves out names that begin with an underscore or a dot, which is also what the sorted tree's scan wants.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name, extension

IGNORED = (".DS_Store",)


def _files(spark: SparkSession, paths: str | list[str], recursive: bool, pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    raw = reader.load(paths)
    name = base_name(F.col("path"))
    return raw.select(F.col("path").alias("doc_id"), "path", name.alias("name"), extension(name).alias("ext"), "length", "modificationTime", "content")


def scan_dir(spark: SparkSession, path: str) -> DataFrame:
    """Files directly in a folder."""
    return _files(spark, path, recursive=False)


def scan_tree(spark: SparkSession, path: str) -> DataFrame:
    """Files in a folder and below it."""
    return _files(spark, path, recursive=True).where(~F.col("name").isin(*IGNORED))


def scan_paths(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """The files given."""
    return _files(spark, list(paths), recursive=False)


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    return scan_paths(spark, [path])


def upload_stream(spark: SparkSession, path: str) -> DataFrame:
    """Files as they arrive in a landing folder."""
    from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

    schema = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType()), StructField("length", LongType()), StructField("content", BinaryType())])
    raw = spark.readStream.format("binaryFile").schema(schema).load(path)
    name = base_name(F.col("path"))
    return raw.select(F.col("path").alias("doc_id"), "path", name.alias("name"), extension(name).alias("ext"), "length", "modificationTime", "content")


def read_outputs(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """(name, content) of output documents; the summary, whose name begins with an underscore, is not among them."""
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=f"*{suffix}").select("value", F.col("_metadata.file_name").alias("name"))
    return texts.select("name", F.col("value").alias("content"))
