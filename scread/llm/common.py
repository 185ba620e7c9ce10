"""Helpers shared by the training-data operators: staged tables, text blocks, word hashes.

Text kernels work on Arrow string buffers as flat byte arrays, so Python never loops over words.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 500_000

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x100000001B3


def stage_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one of our own only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives executors.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = hadoop
    return out


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    df._staged.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(df._staged, True)


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        column = pa.array([squeeze.compress(t) for t in texts], pa.binary())
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", column)


def zipped(df: DataFrame) -> DataFrame:
    """``df`` with its non-null ``text`` compressed row by row, for texts that go through a shuffle; see ``unzipped``."""
    schema = df.withColumn("text", F.col("text").cast("binary")).schema
    return df.mapInArrow(_zipped, schema)


def unzipped(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor()
    return pa.array([expand.decompress(z) for z in column.to_pylist()], pa.binary())


def n_words(text) -> F.Column:
    """Number of words of a text column, long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _C2
    x ^= x >> np.uint64(27)
    x *= _C3
    x ^= x >> np.uint64(31)
    return x


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    data, offsets = string_parts(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64, at least n of them."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 1024), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first word of each document and the total) of all words of a block.

    Words are runs without the six ASCII spaces and never cross a document's end. Equal words have
    equal 64-bit hashes; ``lower`` takes A-Z as a-z.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    stops[before] = inside[before]
    ends = np.flatnonzero(stops) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = ends - starts
    total = np.cumsum(lengths)
    at = np.flatnonzero(inside)
    within = np.arange(total[-1]) - np.repeat(total - lengths, lengths)
    symbols = data[at]
    if lower:
        symbols = _LOWER[symbols]
    weighted = (symbols.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[within]
    hashes = np.add.reduceat(weighted, total - lengths)
    hashes = mix64(hashes + lengths.astype(np.uint64) * _C1)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive entries; shorter by k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ hashes[j : j + n]) * _C2 + _C1
        out ^= out >> np.uint64(29)
    return mix64(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive entries; shorter by w - 1."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])
