"""What the corpus operators share: scratch tables, sampling, id blocks, Arrow helpers."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words of the contracts that split on it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a sieve for each row, and in all.
SIEVE_BITS, MOST_SIEVE_BITS = 16, 1 << 27


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local one serves a local session only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="foliospark-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark reaches."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
    except Exception:  # at exit the session may be gone
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it is removed when the driver exits."""
    path = f"{shared_dir(spark)}/foliospark-{uuid.uuid4().hex}/{name}"
    atexit.register(_forget, spark, path.rsplit("/", 1)[0])
    return path


def materialise(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage, survives lost executors, computes once.

    small: rows of ids and counts behind a shuffle, far narrower than what the shuffle partitions are sized for; they go into an
    eighth as many files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if small:
        df = df.coalesce(max(1, shuffle_partitions(spark) // 8))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries within it remove their shuffle files when they end; else those stay until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sieve(table: DataFrame, *keys: str) -> Callable[..., Column]:
    """A test of key columns that is true of all keys of the table (null is a key) and false of nearly all others, so that only rows it holds need an exact join.

    A bitmap of the keys' hashes with 16 to 32 bits for each row; it is bounded, beyond that it holds more rows in vain.
    """
    spark = table.sparkSession
    bits = max(64, min(MOST_SIEVE_BITS, 1 << (SIEVE_BITS * max(1, table.count()) - 1).bit_length()))
    at = F.xxhash64(*keys).bitwiseAND(F.lit(bits - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    words = table.select(F.shiftright(at, 6).alias("word"), bit.alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def held(code: pd.Series) -> pd.Series:
        x = code.to_numpy().astype(np.int64).view(np.uint64) & np.uint64(bits - 1)
        return pd.Series((shared.value[x >> np.uint64(6)] >> (x & np.uint64(63)) & np.uint64(1)).astype(bool))

    return lambda *columns: held(F.xxhash64(*columns))


def digest_part(*keys: Column, seed: int = 7) -> Column:
    """From 0 to below 1 by the keys alone, the same on every run and at every partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), *[k.cast("string") for k in keys]), F.lit(1 << 30)).cast("double") / float(1 << 30)


def keep_fraction(key: Column, fraction: Column | float, seed: int = 7) -> Column:
    """True for about that fraction of the keys, the same ones on every run and at every partitioning."""
    return digest_part(key, seed=seed) < fraction


def give_back() -> None:
    """Returns freed memory to the system at a task's end: Python workers are kept for later stages and would hold it through them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def over_arrow(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table]], rows: int = 1024) -> DataFrame:
    """mapInArrow with a function that is made once for each task, so that models are unpacked once. It gets at most `rows` rows at a time, so that what it makes of them is not held for a whole batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                out = work(batch.slice(lo, rows))
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]
        del work
        give_back()

    return df.mapInArrow(run, schema)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def id_bounds(ids: DataFrame, name: str, blocks: int) -> list[int]:
    """At most blocks - 1 ascending values that cut an integer column into ranges of about equal row counts. The list is bounded by `blocks`."""
    if blocks < 2:
        return []
    at = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
    found = ids.agg(F.percentile_approx(name, at, 10_000)).first()[0]
    return sorted(set(found or []))


def id_block(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the key: a deterministic range block."""
    if not bounds:
        return F.lit(0)
    marks = F.lit(bounds).cast("array<bigint>")
    return F.aggregate(marks, F.lit(0), lambda n, b: n + F.when(b <= key, 1).otherwise(0)).cast("int")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
