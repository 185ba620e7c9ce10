"""What both classifiers share: folds, bounded labelled samples and isotonic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN_ROWS = 40_000
BINS = 2_000


def crc(doc_id) -> Column:
    """crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def with_label(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs`` outside the held-out fold with a 0/1 label ``y`` and an inner half ``half``.

    Only ids divide the data: a row is held out if crc32 of its id modulo ``folds`` is ``held``. Labels that
    repeat are averaged and rounded; null ones are left out. Beyond ``max_rows`` labelled ids a sample by
    hash is taken. That bounds what training gathers, and what is broadcast here: an id and a label each.
    """
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(crc("doc_id") % folds != held)
    y = y.groupBy(F.col("doc_id").alias("__id")).agg(F.round(F.avg(label)).cast("int").alias("y"))
    n = y.count()
    if n > max_rows:
        y = y.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    return docs.join(F.broadcast(y), F.col("doc_id") == F.col("__id")).drop("__id").withColumn("half", (crc("doc_id") / folds).cast("long") % 2)


def isotonic(x: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the non-decreasing fit to ``good / n`` over sorted ``x`` (pool adjacent violators)."""
    pools: list[list[float]] = []
    for a, g, k in zip(x.tolist(), good.tolist(), n.tolist()):
        pools.append([g, k, a, a, a * k])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g2, k2, _, hi, s2 = pools.pop()
            pools[-1] = [pools[-1][0] + g2, pools[-1][1] + k2, pools[-1][2], hi, pools[-1][4] + s2]
    return np.array([p[4] / p[1] for p in pools]), np.array([(p[0] + 0.5 * p[0] / p[1]) / (p[1] + 0.5) for p in pools])


def calibrate(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic knots for ``scored(s, y)``; what reaches the driver is at most ``BINS`` pools of equal width."""
    low, high = scored.agg(F.min("s"), F.max("s")).first()
    if low is None:
        return np.zeros(1), np.zeros(1)
    width = (high - low) / BINS or 1.0
    bins = scored.groupBy(F.floor((F.col("s") - low) / width).alias("b")).agg(F.avg("s").alias("x"), F.sum("y").alias("g"), F.count(F.lit(1)).alias("n"))
    rows = sorted((r["x"], r["g"], r["n"]) for r in bins.collect())
    return isotonic(*(np.array(c, float) for c in zip(*rows)))


def finish(scores: DataFrame, folds: int, held: int, threshold: float) -> DataFrame:
    return scores.select("doc_id", (crc("doc_id") % folds == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
