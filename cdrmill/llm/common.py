"""What the operators of this subpackage share: staging, batches of texts, hashes, lookups.

Texts travel as Arrow batches. ``each_batch`` turns a function over record
batches into the shape ``mapInArrow`` wants; ``text_chunks`` cuts a batch into
pieces of bounded bytes, so that a task's memory does not follow the number of
long texts it happens to hold.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, stage

# Text of this many bytes (or one longer text) is worked on at a time. Arrays are
# some dozen times as long, and a worker keeps what it has once taken.
CHUNK_BYTES = 1 << 19

# White space that parts words: fixed values, the bytes 0x20 and 0x09-0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, for files that Spark does not write."""
    return f"{scratch_dir(spark)}/cdrmill/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    return stage(df, label)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the system, at a task's end. Workers stay for later
    tasks, and glibc keeps what arrays of up to 32 MB have left."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def each_batch(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            yield from [made] if isinstance(made, pa.RecordBatch) else made
            pa.default_memory_pool().release_unused()
        give_back()

    return run


def local_table(spark: SparkSession, columns: dict[str, pa.Array], schema: str) -> DataFrame:
    """A small table from the driver's memory. As Arrow data: made of rows, it
    would start Python workers of a second kind, which stay."""
    return spark.createDataFrame(pa.table(columns), schema)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null as empty) and its n+1 offsets."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(
    batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``size`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = texts_of(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing step, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (mod 2**64), grown on demand."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, ...]:
    """Words of many texts: 64-bit hash, start and end byte, index of the text.

    ``between`` tells for each byte whether it parts words. ASCII letters are lower-cased. The hash of a word is a polynomial over its
    bytes, read off two prefix sums and mixed; it does not depend on where the
    word stands.
    """
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, empty
    inside = ~between[data]
    first = np.zeros(n + 1, dtype=bool)  # a text starts here
    first[offsets[:-1]] = True
    edge = inside.copy()
    edge[1:] &= ~inside[:-1] | first[1:n]
    starts = np.flatnonzero(edge)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:n]
    ends = np.flatnonzero(last) + 1
    up, down = _power_tables(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODE[_LOWER[data]] * up[:n], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * down[starts])
    texts = np.searchsorted(offsets, starts, side="right") - 1
    return hashes, starts, ends, texts


def hot_bound(spark: SparkSession, rows: int) -> int:
    """From how many rows on a key counts as hot: more than an even share of a
    shuffle partition. So there are at most as many hot keys as partitions."""
    return max(2, rows // partitions(spark))


def attach(
    rows: DataFrame, info: DataFrame, key: list[str], size: str, total: int, salt: list[str]
) -> DataFrame:
    """Left join of ``rows`` with one ``info`` row per key, hot keys apart.

    ``size`` is the info column that counts a key's rows, ``total`` the number
    of rows. Hot keys (see ``hot_bound``) have at most one info row per shuffle
    partition; these are broadcast. Rows of hot keys are spread over the shuffle
    by the ``salt`` columns, where they match nothing. ``info`` is read twice:
    stage it. A key that is null in any part finds nothing.
    """
    spark = rows.sparkSession
    values = [c for c in info.columns if c not in key]
    bound = hot_bound(spark, total)
    hot = info.filter(F.col(size) > bound)
    cold = info.filter(F.col(size) <= bound)
    hot = hot.withColumnsRenamed({c: f"_hot_{c}" for c in hot.columns})
    cold = cold.withColumnsRenamed({c: f"_cold_{c}" for c in cold.columns})

    def same(prefix: str) -> Column:
        test = F.lit(True)
        for k in key:
            test = test & (F.col(k) == F.col(f"{prefix}{k}"))
        return test

    joined = rows.join(F.broadcast(hot), same("_hot_"), "left")
    is_hot = F.col(f"_hot_{size}").isNotNull()
    joined = joined.withColumn("_salt", F.when(is_hot, F.xxhash64(*salt)).otherwise(F.lit(0)))
    cold = cold.withColumn("_unsalted", F.lit(0).cast("long"))
    joined = joined.join(cold, same("_cold_") & (F.col("_salt") == F.col("_unsalted")), "left")
    picked = [
        F.when(is_hot, F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in values
    ]
    return joined.select(*rows.columns, *picked)
