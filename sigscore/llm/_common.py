"""Small helpers shared by the operators: columns, words, materialised intermediates."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigscore.session import scratch_path

# Words are maximal runs of anything but ASCII white space. The same bytes separate words for
# ``bytes.split()`` in Python; none of them occurs inside a multi-byte UTF-8 character.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\u000b\u000c\r"

ROWS_PER_SLICE = 256  # rows that a Python task holds unpacked at a time

_HELD: dict = {}  # of this worker process


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def without_spaces(text: Column, instead: str = "") -> Column:
    """Each white-space character replaced: plain searches, which cost less than a pattern."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(instead))
    return text


def words(text: Column) -> Column:
    """The words of a text; an empty array for null, empty or blank text."""
    spaced = without_spaces(F.coalesce(text, F.lit("")), " ")
    return F.array_remove(F.split(spaced, " "), "")


def n_words(text: Column) -> Column:
    """Number of words, as a long; 0 for null."""
    return F.size(words(text)).cast("long")


def crc_bucket(doc_id: Column, m: int) -> Column:
    """crc32 of the id's decimal text, modulo m; null ids give null."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(m))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 2_000  # at most; Spark's 10,000 whole texts a batch are held by both sides at once
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BYTES_PER_BATCH = 4_000_000  # about; rows of packed arrays reach Spark's 64 MB long before ROWS_PER_BATCH


@contextlib.contextmanager
def _settings_of_writes(spark: SparkSession):
    """Shuffle files of the writes inside go when a write is done: what was written is read from
    the shared folder from then on, so they would only fill the executors' disks. Batches that
    go to Python are of ROWS_PER_BATCH rows at most, and end when they hold BYTES_PER_BATCH."""
    before = {CLEANUP: spark.conf.get(CLEANUP, "false"), BATCH_ROWS: spark.conf.get(BATCH_ROWS, "10000"),
              BATCH_BYTES: spark.conf.get(BATCH_BYTES, "67108864b")}
    rows = int(before[BATCH_ROWS])
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(BATCH_ROWS, str(min(rows, ROWS_PER_BATCH) if rows > 0 else ROWS_PER_BATCH))
    spark.conf.set(BATCH_BYTES, str(BYTES_PER_BATCH))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: a cut of the lineage that survives lost
    executors, with a size that the planner knows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _settings_of_writes(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def text_slices(batch: pa.RecordBatch, column: str, rows: int = ROWS_PER_SLICE):
    """(first row, list of UTF-8 texts or None) for slices of a batch, so that only a slice is
    held as Python objects at a time."""
    col = batch.column(batch.schema.get_field_index(column))
    for lo in range(0, len(col), rows):
        yield lo, col.slice(lo, rows).cast(pa.binary()).to_pylist()


def held(key, make):
    """What this worker process keeps for its later tasks, made when it is not there. It keeps one thing
    at a time: workers outlive queries, and what an earlier operator kept would add up."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def tidy(work):
    """``work``, a generator over batches, that gives the memory that it has freed back to the system
    when it ends: Arrow and the C library keep it otherwise, in every worker that waits for tasks."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)
    return run


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered for words that were seen; the memory is
    emptied when it is full."""

    def __init__(self, seed: int = 0, keep: int = 200_000):
        super().__init__()
        self.seed, self.keep = seed, keep

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.keep:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (xor-shift and odd multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes; empty when there are fewer than n."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = mix64(h[: len(h) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = mix64(out + h[i: len(h) - n + 1 + i] * np.uint64(0xA24BAED4963EE407))
    return out
