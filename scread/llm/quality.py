"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

Each text becomes a few statistics; random cosine features approximate a Gaussian kernel over them. The
normal equations are summed by partition and inner fold, so the out-of-fold models that calibration needs
are differences of sums. Scores follow from one small vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, grams, mix64, stage, words
from .labelled import calibrate, finish, with_label

FEATURES = 160
INNER = 4
RIDGE = 1e-3
THRESHOLD = 0.3

# byte classes: 0 other, 1 space, 2 newline, 3 symbol, 4 upper case, 5 digit, 6 full stop or comma, 7 other mark, 8 non-ASCII, 9 lower case
_CLASS = np.zeros(256, np.int64)
_CLASS[[9, 11, 12, 13, 32]] = 1
_CLASS[10] = 2
_CLASS[list(b"#*$%&|<>")] = 3
_CLASS[65:91] = 4
_CLASS[48:58] = 5
_CLASS[list(b".,")] = 6
_CLASS[list(b";:!?\"'()[]{}/\\=+_^~@`-")] = 7
_CLASS[128:] = 8
_CLASS[97:123] = 9
_N_CLASS = 10
N_STATS = 17


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys per document."""
    mixed = mix64(keys ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(mixed)
    new = np.ones(len(mixed), bool)
    new[1:] = mixed[order][1:] != mixed[order][:-1]
    return np.bincount(doc[order][new], minlength=n)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text; null and empty texts are zeros."""
    out = []
    for first, last, data, offsets in blocks(texts):
        n = last - first
        size = np.diff(offsets)
        doc_of_byte = np.repeat(np.arange(n), size)
        count = np.bincount(doc_of_byte * _N_CLASS + _CLASS[data], minlength=n * _N_CLASS).reshape(n, _N_CLASS) if len(data) else np.zeros((n, _N_CLASS))
        starts, ends, hashes, at = words(data, offsets)
        n_words = np.diff(at)
        doc = np.repeat(np.arange(n), n_words)
        length = (ends - starts).astype(float)
        w = np.maximum(n_words, 1)
        mean = np.bincount(doc, length, n) / w
        spread = np.sqrt(np.maximum(np.bincount(doc, length**2, n) / w - mean**2, 0))
        last_byte = _CLASS[data[ends - 1]] if len(ends) else np.zeros(0, np.int64)
        first_byte = _CLASS[data[starts]] if len(starts) else np.zeros(0, np.int64)
        tri = grams(hashes, 3)
        inside = doc[:-2] == doc[2:] if len(doc) > 2 else np.zeros(0, bool)
        tri, tri_doc = tri[inside], doc[: len(tri)][inside]
        n_tri = np.bincount(tri_doc, minlength=n)
        c = np.maximum(size, 1)
        stats = [
            np.log1p(n_words),
            np.minimum(mean, 40),
            np.minimum(spread, 40),
            *(count[:, k] / c for k in (2, 3, 4, 5, 6, 7, 8)),
            np.bincount(doc, last_byte == 3, n) / w,
            np.bincount(doc, (last_byte == 7) | (last_byte == 6), n) / w,
            np.bincount(doc, first_byte == 4, n) / w,
            np.bincount(doc, length <= 3, n) / w,
            _distinct(hashes, doc, n) / w,
            1 - _distinct(tri, tri_doc, n) / np.maximum(n_tri, 1) * (n_tri > 0),
            np.log1p(n_words / (count[:, 2] + 1)),
        ]
        out.append(np.where((n_words > 0)[:, None], np.stack(stats, 1), 0.0))
    return np.concatenate(out) if out else np.zeros((0, N_STATS))


def _stats_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = statistics(batch.column(1)).astype(np.float32)
        values = pa.ListArray.from_arrays(np.arange(0, s.size + 1, N_STATS, dtype=np.int32), pa.array(s.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "stats"])


class Fourier:
    """Standardised statistics to cosine features of a Gaussian kernel, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(len(mean), features)) / np.sqrt(len(mean))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.cos(x @ self.w + self.b), np.ones((len(x), 1))], 1)


def train(stats: DataFrame, labels: DataFrame, label: str, folds: int, held: int):
    """A function from statistics to scores in [0, 1], fitted on labelled rows outside the held-out fold."""
    rows = stage(with_label(stats, labels, label, folds, held), "quality-train").withColumn("inner", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(INNER)).cast("int"))
    moments = rows.agg(*[f(F.element_at("stats", i + 1)) for i in range(N_STATS) for f in (F.avg, F.stddev_pop)], F.avg("y")).first()
    if moments[-1] is None:  # no labels: every document scores one half
        return lambda stats: np.full(len(stats), 0.5)
    mean, scale = np.array(moments[:-1:2]), np.array(moments[1:-1:2])
    fourier = Fourier(mean, np.where(scale > 1e-6, scale, 1.0))
    d = FEATURES + 1
    upper = np.triu_indices(d)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = np.zeros((INNER, d, d))
        v = np.zeros((INNER, d))
        for batch in batches:
            z, y, f = fourier(np.stack(batch["stats"].to_numpy())), batch["y"].to_numpy(float), batch["inner"].to_numpy()
            for k in range(INNER):
                zk = z[f == k]
                a[k] += zk.T @ zk
                v[k] += zk.T @ y[f == k]
        for k in range(INNER):
            if a[k][-1, -1]:
                yield pd.DataFrame({"k": k, "i": upper[0], "j": upper[1], "s": a[k][upper]})
                yield pd.DataFrame({"k": k, "i": np.arange(d), "j": -1, "s": v[k]})

    a, v = np.zeros((INNER, d, d)), np.zeros((INNER, d))
    parts = rows.select("stats", "y", "inner").mapInPandas(sums, "k int, i int, j int, s double").groupBy("k", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    square, side = parts[parts["j"] >= 0], parts[parts["j"] < 0]
    a[square["k"], square["i"], square["j"]] = square["s"]
    a[square["k"], square["j"], square["i"]] = square["s"]
    v[side["k"], side["i"]] = side["s"]
    eye = np.diag(np.r_[np.ones(d - 1), 0.0])
    solve = lambda m, t: np.linalg.lstsq(m + RIDGE * max(m[-1, -1], 1) * eye, t, rcond=None)[0]
    full, left_out = solve(a.sum(0), v.sum(0)), [solve(a.sum(0) - a[k], v.sum(0) - v[k]) for k in range(INNER)]

    def out_of_fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z, f = fourier(np.stack(batch["stats"].to_numpy())), batch["inner"].to_numpy()
            s = np.einsum("ij,ij->i", z, np.stack(left_out)[f])
            yield pd.DataFrame({"s": s, "y": batch["y"]})

    knots, values = calibrate(rows.select("stats", "y", "inner").mapInPandas(out_of_fold, "s double, y int"))
    return lambda stats: np.interp(fourier(stats) @ full, knots, values)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    Only the text is an input of a score. Null and empty texts are scored as texts without words. Rows that
    repeat get equal scores; extra columns are not read; empty tables give no rows, and without labels all
    score 0.5.
    """
    stats = stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_stats_rows, "doc_id long, stats array<float>"), "quality-stats")
    model = train(stats, labels, label, folds, held)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                s = np.stack(batch["stats"].to_numpy())
                yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.clip(model(s), 0.0, 1.0)})

    return finish(stats.mapInPandas(score, "doc_id long, score double"), folds, held, threshold)


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, all columns kept; the text's own row carries its score.

    The held-out fold gives no labels here either, so its scores stay honest.
    """
    text = F.col("text").cast("string")
    stats = stage(docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(_stats_rows, "doc_id long, stats array<float>"), "quality-stats")
    model = train(stats, labels, label, folds, held)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model(statistics(batch.column("text")))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.withColumn("text", text).mapInArrow(keep, docs.withColumn("text", text).schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
