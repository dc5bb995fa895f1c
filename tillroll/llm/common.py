"""Shared helpers: tables, durable intermediates, vectorised text hashing, connected components."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.session import scratch_path

#: A word is a maximal run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 18

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def configure_python(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers in bytes, not only in rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: the lineage is cut
    and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_task(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """For ``mapInArrow``: give freed memory back to the system when a task ends,
    as Python workers are kept for later tasks."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)

    return run


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns that an operator returns under these names."""
    return df.drop(*names)


def extended(df: DataFrame, added: str) -> StructType:
    """The schema of df with further fields, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])


def packed(df: DataFrame) -> DataFrame:
    """doc_id, text and, as ``_row``, all columns of df, whatever their names."""
    return df.select("doc_id", "text", F.struct("*").alias("_row"))


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def id_remainder(col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % divisor


# ---------------------------------------------------------------- hashing


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64); wraps modulo 2**64."""
    x = x + _GOLD
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and the n+1 word offsets of the rows."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside
    last[:-1] &= ~last[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
BYTE_CODE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1))
#: The same with A-Z as a-z.
BYTE_CODE_LOWER = BYTE_CODE.copy()
BYTE_CODE_LOWER[65:91] = BYTE_CODE[97:123]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """Running polynomial hash with a leading 0, for ``span_hash``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    raw = (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * _GOLD)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys, and the starts and lengths of runs of equal keys in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    return order, starts, np.diff(np.append(starts, len(keys)))


# ------------------------------------------------------ connected components


def components(edges: DataFrame, label: str = "components", rounds: int = 40) -> DataFrame:
    """Connected components of the undirected edges (a, b): rows (node, root),
    root the smallest node of the component.

    Alternating large-star and small-star steps: each is one aggregation and
    one join on a node, so no group of neighbours is gathered in a task, and the
    number of steps grows with the logarithm of the size.  Every step is written
    to the shared folder."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialize(e, label)
    sign = None
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*").where("u <> v").distinct()
        )
        e = materialize(small, label)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
