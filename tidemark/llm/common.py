"""Small pieces that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.shared import shared_folder

#: The bytes that part words, as a Java regular-expression class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Hashes of words that a worker remembers.
CACHE_WORDS = 1 << 17
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 2000
#: Share of its limit that the heap of the driver's JVM may grow to before collect_garbage() does something.
HEAP_SHARE = 0.5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches have BATCH_ROWS rows where the session has Spark's default: texts of 10,000 rows are too much at a time."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))


_RECORDED: ContextVar[list[str] | None] = ContextVar("recorded", default=None)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that materialise() writes meanwhile in this thread."""
    folders: list[str] = []
    token = _RECORDED.set(folders)
    try:
        yield folders
    finally:
        _RECORDED.reset(token)


def discard(spark: SparkSession, folders: list[str], readers: DataFrame) -> list[str]:
    """Delete folders that `readers` doesn't read; returns the others."""
    files, path_of = readers.inputFiles() if folders else [], spark._jvm.org.apache.hadoop.fs.Path
    read = [f for f in folders if any(f"/{f.rsplit('/', 1)[1]}/" in x for x in files)]
    for folder in folders:
        if folder not in read:
            path = path_of(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return read


def materialise(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Later steps then start from files that survive lost executors, and two uses see the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (folders := _RECORDED.get()) is not None:
        folders.append(path)
    df.write.option("compression", codec).parquet(path)
    collect_garbage(spark)
    return spark.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Let the driver's JVM collect its garbage and give memory back if its heap has grown beyond HEAP_SHARE of its limit.

    A long row of jobs leaves plans, task results and broadcasts that nothing refers to any more. Left alone the heap grows
    to its limit over them, and the driver's Python needs memory beside it.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > HEAP_SHARE * runtime.maxMemory():
        spark._jvm.java.lang.System.gc()


def materialise_in_buckets(df: DataFrame, column: str, label: str) -> DataFrame:
    """As materialise(), as a table in buckets of `column`: groups of it are then read without a shuffle."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", f"{shared_folder(spark)}/{name}")
    writer.format("parquet").saveAsTable(name)
    return spark.table(name)


def id_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; -1 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus, F.lit(-1))


def text_bytes(batch, name: str = "text") -> list:
    """A string column of an Arrow batch as Python bytes, None for null."""
    import pyarrow as pa

    column = batch.column(name)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterator, column: int, most_bytes: int) -> Iterator:
    """The rows of Arrow batches in batches whose texts have about most_bytes; a longer text is in one of its own."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        groups = np.cumsum(sizes) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            if end > begin:
                yield batch.slice(begin, end - begin)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: idle workers share an executor's memory with those that work."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def pack(values) -> bytes:
    """An array of unsigned integers as compressed byte planes."""
    import numpy as np
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: str):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


_KEPT: dict = {}


def kept(name, make: Callable):
    """What a Python worker keeps from task to task. Workers serve all operators in turn, so they keep one thing at a time."""
    if name not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[name] = make()
    return _KEPT[name]


class WordHashes(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


def word_hashes(words: list[bytes]):
    import numpy as np

    return np.fromiter(map(kept("words", WordHashes).__getitem__, words), np.uint64, len(words))


def windows(hashes, n: int):
    """A 64-bit hash of each n neighbours."""
    import numpy as np

    mixed = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed += hashes[i : len(hashes) - n + 1 + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed
