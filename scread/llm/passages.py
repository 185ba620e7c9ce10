"""Finding passages that occur more than once, for the substring operators.

Every window of fixed length elects one of its grams (winnowing), so equal windows meet under equal gram
hashes. Only grams that occur twice send the text of their windows through a shuffle; each operator then
decides within such a group, by its own method, which windows are repeated. Groups that very many places
share go another exact way, by hashes of whole windows with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, grams, mix64, sliding_min, stage, unzipped, words

SPANS = "did long, rk long, s int, e int"
CROWD, BROADCAST_ROWS = 20_000, 200_000


def keyed(docs: DataFrame) -> DataFrame:
    """rk, did, text: rows with equal id and text are one document, told apart by did and rk; a null id comes before all others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return d.select(
        F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("rk"),
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("did"),
        "text",
    )


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from every position (k a power of two); the last k - 1 positions hold no gram."""
    x = mix64(data.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < k:
        x[:-step] = x[:-step] * np.uint64(0x9E3779B97F4A7C15) + x[step:]
        x ^= x >> np.uint64(31)
        step *= 2
    return mix64(x)


def elected(keys: np.ndarray, bounds: np.ndarray, length: int, w: int) -> tuple[np.ndarray, ...]:
    """(document, gram position, first, last window start) of each anchor; windows never cross ``bounds``."""
    none = (np.zeros(0, np.int64),) * 4
    n = len(keys) - w + 1
    if n <= 0:
        return none
    low, step = np.uint64((1 << 24) - 1), (1 << 24) - w
    at = np.empty(n, np.int64)
    for base in range(0, n, step):
        part = keys[base : base + step + w - 1]
        m = sliding_min((part & ~low) | np.arange(len(part), dtype=np.uint64), w)
        at[base : base + len(m)] = (m & low).astype(np.int64) + base
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    at[np.arange(n) + length > bounds[doc + 1]] = -1
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, n - 1]
    good = at[first] >= 0
    first, last = first[good], last[good]
    return doc[first], at[first], first, last


def _sketch(batches: Iterator[pa.RecordBatch], unit: str, length: int, k: int) -> Iterator[pa.RecordBatch]:
    w = length - k + 1
    for batch in batches:
        for a, b, data, offsets in blocks(batch.column(2)):
            if unit == "byte":
                keys, bounds = byte_grams(data, k), offsets
            else:
                _, _, hashes, bounds = words(data, offsets)
                keys = grams(hashes, k)
                keys = np.r_[keys, np.zeros(len(hashes) - len(keys), np.uint64)]
            doc, at, first, last = elected(keys, bounds, length, w)
            n = np.bincount(doc, minlength=b - a)
            rows = np.flatnonzero(n)
            if not len(rows):
                continue
            cuts = pa.array(np.r_[0, np.cumsum(n[rows])].astype(np.int32))
            base = bounds[doc]
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (keys[at].view(np.int64), (first - base) << 24 | (last - first) << 12 | (at - first))]
            ids = [batch.column(i).take(pa.array(rows + a)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, *lists], names=["rk", "did", "h", "x"])


def _unpacked(hits: pa.StructArray) -> tuple[np.ndarray, ...]:
    h, x = (hits.field(i).to_numpy() for i in range(2))
    lo = x >> 24
    return h, lo, lo + (x >> 12 & 0xFFF), x & 0xFFF


def _contexts(batches: Iterator[pa.RecordBatch], unit: str, length: int) -> Iterator[pa.RecordBatch]:
    """The text of each hit's windows."""
    for batch in batches:
        hits = batch.column(3)
        for a, b, data, offsets in blocks(unzipped(batch.column(2))):
            part = hits.slice(a, b - a)
            n = np.diff(part.offsets.to_numpy())
            flat = part.flatten()
            h, lo, hi, off = _unpacked(flat)
            doc = np.repeat(np.arange(b - a), n)
            if unit == "byte":
                begin, end = offsets[doc] + lo, offsets[doc] + hi + length
            else:
                starts, ends, _, at = words(data, offsets)
                begin, end = starts[at[doc] + lo], ends[at[doc] + hi + length - 1]
            raw = data.tobytes()
            ctx = [raw[x:y] for x, y in zip(begin.tolist(), end.tolist())]
            row = pa.array(doc + a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), batch.column(1).take(row), batch.column(0).take(row), pa.array(lo.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(ctx, pa.binary())],
                names=["h", "did", "rk", "lo", "off", "ctx"],
            )


def _window_hashes(batches: Iterator[pa.RecordBatch], unit: str, length: int) -> Iterator[pa.RecordBatch]:
    """Hashes of each whole window of the hits."""
    for batch in batches:
        hits = batch.column(3)
        for a, b, data, offsets in blocks(unzipped(batch.column(2))):
            part = hits.slice(a, b - a)
            flat = part.flatten()
            _, lo, hi, _ = _unpacked(flat)
            doc = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            if unit == "byte":
                hashes, bounds = data.astype(np.uint64) + np.uint64(1), offsets
            else:
                _, _, hashes, bounds = words(data, offsets)
            n = hi - lo + 1
            p = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            doc = np.repeat(doc, n)
            one, two = (grams(x, length)[bounds[doc] + p].view(np.int64) for x in (mix64(hashes), mix64(hashes ^ np.uint64(0x5851F42D4C957F2D))))
            row = pa.array(doc + a)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), batch.column(1).take(row), batch.column(0).take(row), pa.array(p.astype(np.int32))], names=["w1", "w2", "did", "rk", "p"])


def repeated(docs_x: DataFrame, texts: DataFrame, unit: str, length: int, k: int, decide: Callable, decide_hot: Callable, hot_rows: int) -> DataFrame:
    """did, rk and ``spans`` (array of (s, e), inclusive window starts) of all documents with repeated windows.

    ``texts`` is ``docs_x`` with zipped texts: the same frame for every join on its keys, so that one shuffle serves all.
    ``decide`` maps the sorted contexts of anchor groups to spans in ``mapInArrow``; ``decide_hot`` maps a staged
    frame of window hashes (w1, w2, did, rk, p) to the repeated ones.
    """
    schema = "rk long, did long, h array<long>, x array<long>"
    sketch = stage(docs_x.select("rk", "did", "text").mapInArrow(partial(_sketch, unit=unit, length=length, k=k), schema), "passages-sketch")
    counts = stage(sketch.select(F.explode("h").alias("h")).groupBy("h").count().filter("count > 1"), "passages-counts")
    # first window, number of further ones and place of the gram in one number: 40, 12 and 12 bits
    each = sketch.select("did", "rk", F.explode(F.arrays_zip("h", "x")).alias("x")).select("did", "rk", "x.h", "x.x")

    def hits(which) -> DataFrame:
        found = each.join(counts.filter(which).select("h"), "h").groupBy("did", "rk").agg(F.collect_list(F.struct("h", "x")).alias("hits"))
        return texts.join(found, ["did", "rk"]).select("rk", "did", "text", "hits")

    cold = hits(F.col("count") <= hot_rows).mapInArrow(partial(_contexts, unit=unit, length=length), "h long, did long, rk long, lo int, off int, ctx binary")
    spans = decide(cold)
    if counts.filter(F.col("count") > hot_rows).limit(1).count():
        hashed = hits(F.col("count") > hot_rows).mapInArrow(partial(_window_hashes, unit=unit, length=length), "w1 long, w2 long, did long, rk long, p int")
        found = decide_hot(stage(hashed, "passages-windows")).select("did", "rk", "p")
        # neighbouring windows are one span
        run = F.col("p") - F.dense_rank().over(Window.partitionBy("did", "rk").orderBy("p"))
        runs = found.withColumn("run", run).groupBy("did", "rk", "run").agg(F.min("p").alias("s"), F.max("p").alias("e"))
        spans = spans.unionByName(runs.select("did", "rk", "s", "e"))
    return spans.groupBy("did", "rk").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def with_key(hashed: DataFrame, keys: DataFrame) -> DataFrame:
    """``hashed`` joined with ``keys`` (w1, w2, n, ...) on the window. Windows that more than ``CROWD`` rows hold are few:
    these keys are broadcast, behind a check of their number, so that no task gets all rows of one window.
    """
    on = ["w1", "w2"]
    keys = stage(keys, "passages-keys")
    crowded = keys.filter(F.col("n") > CROWD)
    if not 0 < crowded.count() <= BROADCAST_ROWS:
        return hashed.join(keys, on)
    rest = hashed.join(F.broadcast(crowded.select(*on)), on, "left_anti").join(keys.filter(F.col("n") <= CROWD), on)
    return hashed.join(F.broadcast(crowded), on).unionByName(rest)


def groups(batches: Iterator[pa.RecordBatch], least_rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups of the first column, at least ``least_rows`` each but the last; input is sorted by it."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut == 0 and held and held[-1].column(0)[len(held[-1]) - 1].as_py() != key[0]:
            cut = 0
            if rows >= least_rows:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
        elif cut and rows + cut >= least_rows:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows = [], 0
            batch = batch.slice(cut)
        held.append(batch)
        rows += len(batch)
    if held:
        yield pa.Table.from_batches(held)


def covered(spans, n: int, length: int) -> np.ndarray:
    """Which of n units the windows that start in the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["s"]] += 1
        edge[s["e"] + length] -= 1
    return np.cumsum(edge[:n]) > 0
