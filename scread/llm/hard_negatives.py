"""Hard-negative mining by exact integer scores: Kronecker-packed products of blocks.

Several rows' components, biased so that none is negative, lie in separate fields of one wide integer. One
multiplication with an anchor's component then multiplies all of them, and the sum over the components holds
every row's score in its own field. The integers are as wide as their carrier is exact: 53 bits in a double
(whose products the processor's matrix routines make), 63 in a long, any number in Python's own.

Anchors go in blocks, rows in chunks; a task scores one block against one chunk, so all it holds is bounded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CHUNK_ROWS, LEAST_CHUNK, BLOCK_ANCHORS = 16_384, 64, 4_096
SCORED_AT_ONCE = 2_000_000
WIDE_FIELDS = 16


class PackedRows:
    """Integer rows packed for products with anchors whose components are at most ``most`` in size."""

    def __init__(self, rows: np.ndarray, most: int):
        self.n, d = rows.shape
        self.bias = int(np.abs(rows).max(initial=0))
        # a field holds a sum of d products of a signed component and one of 0 to 2 * bias, moved up by ``lift``
        self.lift = 2 * d * most * self.bias
        self.width = (2 * self.lift + 1).bit_length()
        self.carrier, self.fields = next(((c, b // self.width) for c, b in ((np.float64, 53), (np.int64, 63)) if b // self.width > 1), (object, WIDE_FIELDS))
        padded = np.zeros((-(-self.n // self.fields) * self.fields, d), object if self.carrier is object else np.int64)
        padded[: self.n] = rows
        padded[: self.n] += self.bias
        by_field = padded.reshape(-1, self.fields, d)
        words = by_field[:, 0, :].copy()
        for k in range(1, self.fields):
            words += by_field[:, k, :] << (k * self.width)
        self.words = words.astype(self.carrier).T
        self.lifts = sum(self.lift << (k * self.width) for k in range(self.fields))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner product of every anchor with every row, exactly."""
        sums = anchors.astype(self.carrier) @ self.words
        whole = sums if self.carrier is object else sums.astype(np.int64)
        whole = whole + self.lifts
        low = (1 << self.width) - 1
        fields = np.stack([(whole >> (k * self.width)) & low for k in range(self.fields)], axis=2)
        shift = self.lift + self.bias * anchors.astype(object if self.carrier is object else np.int64).sum(1)
        return (fields.reshape(len(anchors), -1)[:, : self.n] - shift[:, None]).astype(np.int64)


def _matrix(vectors: pd.Series, d: int) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), d), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _slices(n: int, width: int):
    step = max(1, SCORED_AT_ONCE // max(1, width))
    return ((at, min(n, at + step)) for at in range(0, n, step))


def _ordered(r: np.ndarray, c: np.ndarray, s: np.ndarray, k: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By r, then highest s, then smallest c; the first k of each r."""
    order = np.lexsort((c, -s, r))
    r, c, s = r[order], c[order], s[order]
    keep = slice(None) if k is None else np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], c[keep], s[keep]


def _positives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first ``k`` rows of this chunk that have an anchor's label and another id."""
    out = []
    d = max(anchors["vec"].map(len).max(), rows["vec"].map(len).max()) if len(anchors) and len(rows) else 0
    rows = rows.sort_values("vec_id", ignore_index=True)
    for label, mine in anchors.groupby("label"):
        near = rows[rows["label"] == label]
        if not len(near):
            continue
        asked, ids, own = _matrix(mine["vec"], d), near["vec_id"].to_numpy(), mine["anchor_id"].to_numpy()
        packed = PackedRows(_matrix(near["vec"], d), int(np.abs(asked).max(initial=0)))
        for a, b in _slices(len(asked), len(ids)):
            s = packed.scores(asked[a:b])
            other = own[a:b, None] != ids[None, :]
            kth = np.partition(np.where(other, s, np.iinfo(np.int64).min), -k, axis=1)[:, -k] if len(ids) > k else np.full(b - a, np.iinfo(np.int64).min)
            r, c = np.nonzero(other & (s >= kth[:, None]))
            r, c, s = _ordered(r, c, s[r, c], k)
            out.append(pd.DataFrame({"anchor_id": own[a + r], "positive_id": ids[c], "positive_score": s}))
    return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []}, dtype="int64")


def _bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _negatives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """The first ``k`` rows of this chunk with another label and a score between the bounds, of each anchor and positive."""
    out: list[tuple] = []
    if len(anchors) and len(rows):
        d = max(anchors["vec"].map(len).max(), rows["vec"].map(len).max())
        rows = rows.sort_values("vec_id", ignore_index=True)
        asked, ids, labels = _matrix(anchors["vec"], d), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        own, own_label = anchors["anchor_id"].to_numpy(), anchors["label"].to_numpy()
        wanted = [[(p["positive_id"], p["positive_score"], *_bounds(int(p["positive_score"]), low, high)) for p in ps] for ps in anchors["positives"]]
        least, most = (np.array([f(w[i] for w in ws) for ws in wanted], np.int64) for f, i in ((min, 2), (max, 3)))
        packed = PackedRows(_matrix(rows["vec"], d), int(np.abs(asked).max(initial=0)))
        for a, b in _slices(len(asked), len(ids)):
            s = packed.scores(asked[a:b])
            r, c = np.nonzero((s >= least[a:b, None]) & (s <= most[a:b, None]) & (labels[None, :] != own_label[a:b, None]))
            r, c, s = _ordered(r, c, s[r, c])
            ends = np.searchsorted(r, np.arange(b - a + 1))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                mine = s[ends[i] : ends[i + 1]]
                for positive, score, lowest, highest in wanted[a + i]:
                    first = int(np.searchsorted(-mine, -highest))
                    for j in range(first, min(first + k, len(mine))):
                        if mine[j] < lowest:
                            break
                        out.append((own[a + i], positive, score, ids[c[ends[i] + j]], mine[j]))
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]).astype("int64")


def integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and ``vec``, floor(scale * x) of every component: one row an id, the least by label and vector where they differ."""
    vec = F.col("embedding").cast("array<double>")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    )
    top = F.floor(F.sqrt(F.lit(2.0**63) / F.greatest(F.size("x"), F.lit(1)))) - 1  # so that no score passes a long
    whole = F.transform("x", lambda v: F.greatest(-top, F.least(top, F.floor(v * F.lit(float(scale))))))
    return usable.select("vec_id", F.struct("label", whole.alias("vec")).alias("r")).groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.vec")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, chunk_rows: int = CHUNK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives of every anchor and positive.

    ``vectors`` has vec_id, label and embedding, other columns are not read; ``is_anchor`` is a condition on
    vec_id. Scores are inner products of floor(scale * x). An anchor's positives are the first ``positives`` rows
    of its label with another id, highest score first, ties by smaller id; to each belong the first
    ``negatives`` rows of other labels with ``low`` to ``high`` per cent of its score. Nothing is skipped: every anchor meets
    every row. Rows without id, label or vector or with a null or non-finite component take no part; repeated rows
    count once, and of different rows of one id the least by label and vector. A shorter vector is one that ends in
    zeros. Components saturate where a score could pass a long. Anchors without positives, or without
    negatives in bounds, have no rows, nor has an empty table.
    """
    rows = stage(integer_rows(vectors, scale), "negatives-rows")
    asked = rows.filter(is_anchor).withColumnRenamed("vec_id", "anchor_id")
    n, n_anchors = rows.count(), asked.count()
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-n // chunk_rows), min(partitions, -(-n // LEAST_CHUNK)))
    blocks = max(1, -(-n_anchors // block_anchors))

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")).withColumn("block", each(blocks))

    def met(anchors: DataFrame):
        spread = anchors.withColumn("block", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("chunk", each(chunks))
        return spread.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk"))

    def first(anchors: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        return _positives(anchors, others, positives)

    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = met(asked).applyInPandas(first, "anchor_id long, positive_id long, positive_score long")
    near = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives)
    lists = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    known = stage(asked.join(lists, "anchor_id"), "negatives-anchors")

    def second(anchors: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        return _negatives(anchors, others, negatives, low, high)

    hard = met(known).applyInPandas(second, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
