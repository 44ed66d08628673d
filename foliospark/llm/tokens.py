"""Training-order materialisation of token ids.

Documents are tokenised whole, closed by an end-of-text id and cut into sequences of at most `length` ids. A keyed Feistel
permutation with cycle-walking gives each of the N sequences a slot of its own in 0..N-1. Slots are dealt to range partitions of
`shard_records` slots; a shard holds its records in slot order, each of the same stride, so the record of a slot is found by
arithmetic and a run resumes at any slot.

Order. With `windows` = 1 the permutation goes over all sequences. With more, the sequences keep the order of the documents by and
large: they are numbered in the order of the documents' files, the run is cut into that many windows of consecutive numbers, and the
permutation acts within each. So a curriculum that the documents were sorted by survives, up to a window.

Record: doc_id (8 bytes), sequence number (4), count of ids (4; negative where the document has no doc_id), the ids (2 or 4 bytes each by vocabulary size, the rest filled with
the end-of-text id), all little-endian. Shard files of `write_shards` add one line feed to each record. The query and the pipeline's
last stage write the shards to the shared folder and return the rows that `read_shards` finds there.

Tokenised sequences are written once to the shared folder; the table of counts by run of rows, a row for each split of a file, gives
every sequence its number. The tokenizer's ranks are a file of fixed size, read by the driver and broadcast.

Writing. Shards are written in a few turns, each of which deals the sequences of its own shards alone and frees its shuffle files at its
end. A turn takes a fixed share of the shards that are left, so disk never holds a shuffle of all sequences beside all shards: while
much is shuffled, few shards stand. The marker of success comes with the last turn.

Defined cases: a null or empty text is one sequence with the end-of-text id alone; a null doc_id is null again when
it is read; repeated rows are sequences of their own; an empty table gives no records. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freed_shuffles, load, materialise, over_arrow, scratch_path

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the byte-level vocabulary splits a text before merging (a fixed value of that vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH, SHARD_RECORDS, KEY, ROUNDS = 1024, 8192, 20_250_101, 6
#: Windows of a run that keeps the documents' order; a table of runs with at most MOST_BROADCAST rows is broadcast.
WINDOWS, MOST_BROADCAST = 64, 100_000
HEADER = 16
#: Writes of the shards; each takes that share of the shards that are left, the last all of them.
TURNS, TURN_SHARE = 4, 0.6


class Feistel:
    """A keyed permutation of 0..n-1: balanced rounds over the next power of four, walking on while outside."""

    def __init__(self, n: int, key: int | tuple[int, ...] = KEY, rounds: int = ROUNDS) -> None:
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = np.random.default_rng((*(key if isinstance(key, tuple) else (key,)), 17)).integers(0, 1 << 63, rounds, np.uint64)

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return (x ^ x >> np.uint64(32)) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._mix(right, key)
        return left << self.half | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._mix(left, key), left
        return left << self.half | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(x).astype(np.uint64))
        while (far := out >= self.n).any():
            out[far] = step(out[far])
        return out.astype(np.int64)

    def slot(self, number: np.ndarray) -> np.ndarray:
        return self._walk(number, self._once)

    def number(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


class Windows:
    """Permutations of 0..n-1 within windows of consecutive numbers, which are all of one size but the last."""

    def __init__(self, n: int, windows: int = 1, key: int = KEY) -> None:
        self.n, self.size, self.key = n, max(1, -(-n // windows)), key

    def _each(self, x: np.ndarray, to: str) -> np.ndarray:
        x = np.asarray(x).astype(np.int64)
        window = x // self.size
        out = np.empty_like(x)
        for w in np.unique(window).tolist():
            own, start = window == w, w * self.size
            feistel = Feistel(min(self.size, self.n - start), (self.key, w) if w else self.key)
            out[own] = getattr(feistel, to)(x[own] - start) + start
        return out

    def slot(self, number: np.ndarray) -> np.ndarray:
        return self._each(number, "slot")

    def number(self, slot: np.ndarray) -> np.ndarray:
        return self._each(slot, "number")


@dataclass
class Vocabulary:
    ranks: dict[bytes, int]
    pattern: str = PATTERN

    @property
    def end(self) -> int:
        """The end-of-text id: the first free one."""
        return max(self.ranks.values()) + 1

    @property
    def width(self) -> int:
        return 2 if self.end < 1 << 16 else 4

    def encoding(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})


def vocabulary(path: str = TOKENIZER) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def in_files(docs: DataFrame) -> DataFrame:
    """(file, row, doc_id, text): the path of the file that a row stands in and its place there; documents that are in no files are written first."""
    shown = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    try:
        meta = docs.metadataColumn("_metadata")
        return docs.select(meta["file_path"].alias("file"), meta["row_index"].alias("row"), *shown)
    except AnalysisException:
        return in_files(materialise(docs.select(*shown), "documents"))


def _written(path: str) -> int:
    """The number that Spark gave a file when it wrote it."""
    found = re.search(r"part-([0-9]+)[^/]*$", path)
    return int(found[1]) if found else 0


def sequences(docs: DataFrame, vocab: Vocabulary, length: int = LENGTH) -> DataFrame:
    """(part, file, row, pos, doc_id, seq_no, n_tokens, record): records without their filling. pos counts the sequences of a run, that is, of consecutive rows of a file in one task, from row `row` on."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    kind = f"<u{vocab.width}"
    types = {"part": pa.int32(), "file": pa.string(), "row": pa.int64(), "pos": pa.int64(), "doc_id": pa.int64(), "seq_no": pa.int32(), "n_tokens": pa.int32(), "record": pa.binary()}

    def make():
        encode, end = shared.value.encoding().encode_ordinary, shared.value.end
        part = TaskContext.get().partitionId()
        run, after, pos = (None, None), None, 0

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal run, after, pos
            out: list[tuple] = []
            for file, row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, row) != after:
                    run, pos = (file, row), 0
                after = file, row + 1
                tokens = np.array(encode(text or "") + [end], kind)
                for k, lo in enumerate(range(0, len(tokens), length)):
                    some = tokens[lo : lo + length]
                    out.append((part, *run, pos, doc_id, k, len(some), struct.pack("<qii", doc_id or 0, k, len(some) if doc_id is not None else -len(some)) + some.tobytes()))
                    pos += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types.values(), strict=True)], names=list(types))

        return work

    schema = "part int, file string, row long, pos long, doc_id long, seq_no int, n_tokens int, record binary"
    return over_arrow(in_files(docs), schema, make)


@dataclass
class Placed:
    """Sequences with their slot and shard, the number of shards, and what fills a record to its stride."""

    table: DataFrame
    shards: int
    stride: int
    fill: bytes

    def records(self, first: int = 0, end: int | None = None) -> DataFrame:
        """(shard, slot, doc_id, seq_no, n_tokens, record) of full stride of the shards from `first` to below `end`, a partition for each, in slot order."""
        end = self.shards if end is None else end
        some = self.table if (first, end) == (0, self.shards) else self.table.where((F.col("shard") >= first) & (F.col("shard") < end))
        ordered = some.repartitionById(end - first, F.col("shard") - first).sortWithinPartitions("shard", "slot")  # the order that a write by shard asks for, so it sorts no more
        return ordered.withColumn("record", F.rpad("record", self.stride, F.lit(self.fill)))


def placed_sequences(docs: DataFrame, path: str = TOKENIZER, length: int = LENGTH, shard_records: int = SHARD_RECORDS, key: int = KEY, windows: int = 1) -> Placed:
    spark = docs.sparkSession
    vocab = vocabulary(path)
    table = materialise(sequences(docs, vocab, length), "sequences")
    runs = sorted((tuple(r) for r in table.groupBy("file", "row", "part").count().collect()), key=lambda r: (_written(r[0]), r))
    starts, total = [], 0
    for file, row, part, n in runs:
        starts.append((file, row, part, total))
        total += n
    offsets = spark.createDataFrame(starts, "of_file string, of_row long, of_part int, start long")
    offsets = F.broadcast(offsets) if len(starts) <= MOST_BROADCAST else offsets
    shuffle = Windows(max(total, 1), windows, key)

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(shuffle.slot(number.to_numpy()))

    slot = slot.asNondeterministic()  # it is not; but so a filter by shard stays above it and it is called once, not once for the filter and again for the column
    same = (F.col("file") == F.col("of_file")) & (F.col("row") == F.col("of_row")) & (F.col("part") == F.col("of_part"))
    placed = table.join(offsets, same).withColumn("slot", slot(F.col("start") + F.col("pos")))
    dealt = placed.withColumn("shard", F.floor(F.col("slot") / shard_records).cast("int")).select("shard", "slot", "doc_id", "seq_no", "n_tokens", "record")
    return Placed(dealt, max(1, -(-total // shard_records)), HEADER + length * vocab.width, vocab.end.to_bytes(vocab.width, "little"))


def token_records(docs: DataFrame, path: str = TOKENIZER, length: int = LENGTH, shard_records: int = SHARD_RECORDS, key: int = KEY, windows: int = 1) -> DataFrame:
    """(shard, slot, doc_id, seq_no, n_tokens, record) of full stride, a partition for each shard, in slot order."""
    return placed_sequences(docs, path, length, shard_records, key, windows).records()


def write_shards(records: DataFrame, path: str, more: bool = False, last: bool = True) -> None:
    """Shard files shard=K/*.txt of fixed-stride records; any file system that Spark writes to, and Spark's commit protocol. more: adds shards to those there; last: with the marker of success."""
    writer = records.select(F.col("record").cast("string").alias("value"), "shard").write.mode("append" if more else "error")
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())
    with freed_shuffles(records.sparkSession):
        writer.option("lineSep", "\n").partitionBy("shard").text(path)


def turns(shards: int) -> Iterator[tuple[int, int]]:
    """Ranges (first, end) of the shards that are written at a time."""
    first = 0
    for k in range(TURNS):
        end = shards if k == TURNS - 1 else first + math.ceil(TURN_SHARE * (shards - first))
        if end > first:
            yield first, end
        first = end


def _shard_file(spark: SparkSession, path: str, shard: int):
    """(file system, path of its one file) of a shard, of which only the folder is listed; None behind the last."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    (found,) = (x.getPath() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-"))
    return fs, found


def _open(fs, file, at: int):
    stream = fs.open(file)
    stream.seek(at)
    return stream


def read_slots(spark: SparkSession, path: str, start: int = 0, length: int = LENGTH, width: int = 2, shard_records: int = SHARD_RECORDS, block: int = 512) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(slot, doc_id, seq_no, ids) from slot `start` on: a training run's sequential, resumable read.

    A shard's file is opened when it is reached, at the byte that the slot's number gives; `block` records are held at a time.
    """
    stride = HEADER + length * width + 1
    shard, skip = divmod(start, shard_records)
    while found := _shard_file(spark, path, shard):
        stream = _open(*found, skip * stride)
        try:
            slot = shard * shard_records + skip
            while content := bytes(stream.readNBytes(block * stride)):
                for k in range(len(content) // stride):
                    record = content[k * stride : (k + 1) * stride]
                    doc_id, seq_no, n = struct.unpack("<qii", record[:HEADER])
                    yield slot + k, None if n < 0 else doc_id, seq_no, np.frombuffer(record, f"<u{width}", abs(n), HEADER)
                slot += len(content) // stride
        finally:
            stream.close()
        shard, skip = shard + 1, 0


def _little(raw: Column, first: int, n: int) -> Column:
    """A signed little-endian integer of n bytes."""
    digits = F.hex(F.substring(raw, first, n))
    value = F.conv(F.concat(*[F.substring(digits, 2 * i - 1, 2) for i in range(n, 0, -1)]), 16, -10).cast("long")
    return value if n == 8 else F.when(value >= 1 << (8 * n - 1), value - (1 << 8 * n)).otherwise(value)


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, width: int = 2, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(shard, slot, doc_id, seq_no, n_tokens, record) of all shard files, each file's in slot order. A task holds a file at a time.

    Records are numbered by an explode and cut out behind it, all in one generated loop that loads a file's content once. A lambda over
    the content would copy all of it for each record.
    """
    body = HEADER + length * width
    stride = body + 1
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    cut = F.raise_error(F.concat(F.lit("a shard is cut, its bytes are no multiple of the stride: "), F.col("path"))).cast("long")
    slot = F.regexp_extract("path", r"/shard=([0-9]+)/", 1).cast("long") * shard_records
    start = F.when(F.col("length") % stride != 0, cut).otherwise(slot)
    found = files.where(F.col("length") > 0).select(start.alias("start"), "content", F.explode(F.sequence(F.lit(0), (F.col("length") / stride).cast("int") - 1)).alias("at"))
    found = found.select((F.col("start") + F.col("at")).alias("slot"), F.substring(F.col("content"), F.col("at") * stride + 1, F.lit(body)).alias("record"))
    told = found.withColumns({"n": _little(F.col("record"), 13, 4).cast("int"), "doc_id": _little(F.col("record"), 1, 8), "seq_no": _little(F.col("record"), 9, 4).cast("int")})
    shard = F.floor(F.col("slot") / shard_records).cast("int")
    return told.select(shard.alias("shard"), "slot", F.when(F.col("n") > 0, F.col("doc_id")).alias("doc_id"), "seq_no", F.abs("n").alias("n_tokens"), "record")


def token_shards(docs: DataFrame, path: str | None = None, length: int = LENGTH, shard_records: int = SHARD_RECORDS, windows: int = 1) -> DataFrame:
    """Writes the shards of documents, to a new folder of the shared one if no path is given, and returns the rows read back."""
    path = path or scratch_path(docs.sparkSession, "shards")
    placed = placed_sequences(docs, length=length, shard_records=shard_records, windows=windows)
    for first, end in turns(placed.shards):
        write_shards(placed.records(first, end), path, more=first > 0, last=end == placed.shards)
    return read_shards(docs.sparkSession, path, length, vocabulary().width, shard_records)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(load(spark, sf_dir, "documents"))
