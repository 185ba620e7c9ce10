"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first search.

The tree is fitted on a bounded sample and broadcast; its size depends on parameters alone. Every distinct
vector is put into a leaf. A query visits leaves in the order of a priority queue over the tree; how many
is calibrated: visits widen until a sample of queries, answered by brute force over all rows, reaches the
wanted recall. Neighbouring leaves form buckets, which are scanned in blocks of bounded size, so a crowded
leaf is spread over tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

FIT_ROWS, MOST_FIT_ROWS, FIT_SHARE = 20_000, 60_000, 0.05
BRANCH = 8
LEAF_ROWS = 60
BUCKET_LEAVES = 16
BLOCK_ROWS = 20_000
CALIBRATION_QUERIES = 96
RECALL = 0.98
SALTS = 32


class Tree:
    """Nodes as arrays: ``centre`` (unit vectors), ``children`` of inner nodes, ``leaf`` number or -1."""

    def __init__(self, sample: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.children: list[np.ndarray] = []
        self.leaf: list[int] = []
        centres: list[np.ndarray] = []
        self.n_leaves = 0

        def grow(x: np.ndarray, centre: np.ndarray, depth: int) -> int:
            node = len(self.leaf)
            centres.append(centre)
            self.children.append(np.zeros(0, np.int64))
            self.leaf.append(-1)
            if len(x) > leaf_rows and depth < 12:
                c = x[rng.choice(len(x), branch, replace=False)]
                for _ in range(8):
                    own = np.argmax(x @ c.T, 1)
                    sums = np.zeros_like(c)
                    np.add.at(sums, own, x)
                    norm = np.linalg.norm(sums, axis=1, keepdims=True)
                    c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
                own = np.argmax(x @ c.T, 1)
                used = np.unique(own)
                if len(used) > 1:
                    self.children[node] = np.array([grow(x[own == k], c[k], depth + 1) for k in used], np.int64)
                    return node
            self.leaf[node] = self.n_leaves
            self.n_leaves += 1
            return node

        grow(sample, np.zeros(sample.shape[1]), 0)
        self.centre = np.array(centres)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of unit vectors: the nearest child at each level."""
        out = np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            kids = self.children[node]
            if not len(kids):
                out[rows] = self.leaf[node]
                continue
            own = np.argmax(x[rows] @ self.centre[kids].T, 1)
            stack += [(int(k), rows[own == i]) for i, k in enumerate(kids) if (own == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves by best bin first: the queue holds the nodes passed by, nearest centre on top."""
        near = self.centre @ query
        queue: list[tuple[float, int]] = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while len(kids := self.children[node]):
                order = kids[np.argsort(-near[kids], kind="stable")]
                for k in order[1:].tolist():
                    heapq.heappush(queue, (-float(near[k]), k))
                node = int(order[0])
            yield self.leaf[node]


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows, double precision; a pair's value does not depend on its place."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _top(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows of each query and all that tie with the last."""
    approx = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ (rows / np.linalg.norm(rows, axis=1, keepdims=True)).T
    kth = np.partition(approx, -k, axis=1)[:, -k] if rows.shape[0] > k else np.full(len(queries), -2.0)
    q, r = np.nonzero(approx >= (kth - 1e-9)[:, None])
    return q, r, cosines(queries[q], rows[r])


def distinct_vectors(vectors: DataFrame, copies: int) -> tuple[DataFrame, DataFrame]:
    """(key, vec, ids: the ``copies`` smallest ids of each distinct usable vector) and all usable rows.

    More copies than a result holds can't be in one, so no result changes. Hot vectors are ranked by salt first.
    """
    vec = F.col("embedding").cast("array<double>")
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & ~F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("vec", lambda v: v != 0)
    )
    # zeros of either sign are one value
    good = good.withColumn("vec", F.transform("vec", lambda v: v + F.lit(0.0))).withColumn("key", F.md5(F.array_join(F.transform("vec", lambda v: v.cast("string")), ",")))
    narrow = good.withColumn("salt", F.pmod("vec_id", F.lit(SALTS)))
    first = Window.partitionBy("key", "salt").orderBy("vec_id")
    narrow = narrow.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= copies)
    second = Window.partitionBy("key").orderBy("vec_id")
    ranked = narrow.withColumn("n", F.row_number().over(second)).filter(F.col("n") <= copies)
    return ranked.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids")), good


def search(vectors: DataFrame, is_query, k: int = 5, recall: float = RECALL, fit_rows: int = FIT_ROWS, calibration: int = CALIBRATION_QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of every query among all other rows.

    ``vectors`` has vec_id and embedding (extra columns are not read); ``is_query`` is a condition on vec_id.
    Null, empty, zero and non-finite vectors take no part. Ties go to the smaller vec_id; a query excludes rows
    with its own id. Vectors of another length than the most common one are compared among themselves by the
    same means. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    uniq, good = distinct_vectors(vectors, k + 1)
    uniq = stage(uniq.withColumn("dim", F.size("vec")), "ann-vectors")
    asked = good.filter(is_query).select(F.col("vec_id").alias("query_id"), "key").distinct()
    asked = stage(asked.join(uniq.select("key", "vec", "dim"), "key"), "ann-queries")
    parts = [
        _search_dim(uniq.filter(F.col("dim") == r["dim"]), asked.filter(F.col("dim") == r["dim"]), r["count"], k, recall, fit_rows, calibration)
        for r in uniq.groupBy("dim").count().orderBy("dim").collect()
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # found: query_id, score, vec_id; the best k of few candidates per query and chunk
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_dim(uniq: DataFrame, asked: DataFrame, n: int, k: int, recall: float, fit_rows: int, calibration: int) -> DataFrame:
    fit_rows = min(max(fit_rows, int(FIT_SHARE * n)), max(fit_rows, MOST_FIT_ROWS))
    share = min(1.0, fit_rows / n)
    by_hash = lambda c, part: F.pmod(F.xxhash64(c), F.lit(1 << 30)) < max(1, int(part * (1 << 30)))
    sample = uniq.filter(by_hash("key", share)).select("key", "vec").orderBy("key").limit(2 * fit_rows).toPandas()["vec"]
    if not len(sample):
        sample = uniq.orderBy("key").limit(1).toPandas()["vec"]
    tree = Tree(_unit(sample))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.leaves(_unit(batch["vec"])))

    index = stage(uniq.select("key", "vec", "ids").mapInPandas(place, "key string, vec array<double>, ids array<long>, leaf long"), "ann-index")
    sizes = {r["leaf"]: (r["n"], r["rows"]) for r in index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("rows")).collect()}

    # calibration: true neighbours of some queries but themselves, by brute force over all rows in blocks
    probe = asked.dropDuplicates(["key"]).orderBy(F.xxhash64("key")).limit(calibration).select("key", "vec").toPandas()
    probe_keys, probe_vecs = probe["key"].tolist(), (np.stack([np.asarray(v, np.float64) for v in probe["vec"]]) if len(probe) else np.zeros((0, 1)))

    def truth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) and len(probe_vecs):
                q, r, s = _top(probe_vecs, np.stack([np.asarray(v, np.float64) for v in batch["vec"]]), k + 1)
                other = batch["key"].to_numpy()[r] != np.array(probe_keys, object)[q]
                yield pd.DataFrame({"q": q, "score": s, "leaf": batch["leaf"].to_numpy()[r]})[other]

    best = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
    true = index.mapInPandas(truth, "q long, score double, leaf long").withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).toPandas()
    needed = []
    for q in range(len(probe_keys)):
        place_of = {leaf: i for i, leaf in enumerate(tree.visits(probe_vecs[q] / np.linalg.norm(probe_vecs[q])))}
        needed += [place_of[leaf] + 1 for leaf in true.loc[true["q"] == q, "leaf"]]
    visits = 2
    while needed and np.mean(np.array(needed) <= visits) < recall and visits < tree.n_leaves:
        visits *= 2

    # a query goes once to each bucket of neighbouring leaves that it visits, with the list of these leaves
    rows_in: dict[int, int] = {}
    for leaf, (m, _) in sizes.items():
        rows_in[leaf // BUCKET_LEAVES] = rows_in.get(leaf // BUCKET_LEAVES, 0) + m
    chunks = {bucket: max(1, -(-m // BLOCK_ROWS)) for bucket, m in rows_in.items()}

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at : at + 64]
                rows = []
                for i, v in enumerate(_unit(part["vec"])):
                    seen, by_bucket = 0, {}
                    for step, leaf in enumerate(tree.visits(v)):
                        if step >= visits and seen > k:  # a query sees more rows than it returns
                            break
                        if leaf in sizes:
                            seen += sizes[leaf][1]
                            by_bucket.setdefault(leaf // BUCKET_LEAVES, []).append(leaf)
                    rows += [(i, bucket, c, leaves) for bucket, leaves in by_bucket.items() for c in range(chunks[bucket])]
                i, bucket, chunk, leaves = zip(*rows)
                i = np.array(i)
                yield pd.DataFrame({"key": part["key"].to_numpy()[i], "vec": part["vec"].to_numpy()[i], "bucket": bucket, "chunk": chunk, "leaves": leaves})

    routed = asked.select("key", "vec").dropDuplicates(["key"]).mapInPandas(route, "key string, vec array<double>, bucket long, chunk long, leaves array<long>")
    routed = stage(routed, "ann-routed")
    # the queries of a bucket meet its rows in blocks; a bucket's rows are repeated as often as its queries fill blocks
    asks = {r["bucket"]: -(-r["n"] // BLOCK_ROWS) for r in routed.filter("chunk = 0").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    dealt = pd.DataFrame({"bucket": list(asks), "chunks": [chunks[b] for b in asks], "blocks": list(asks.values())}, dtype="int64")
    spread = F.broadcast(uniq.sparkSession.createDataFrame(dealt, "bucket long, chunks long, blocks long"))  # a row per bucket, whose number parameters bound
    routed = routed.join(spread.drop("chunks"), "bucket").withColumn("block", F.pmod(F.xxhash64("key", F.lit(11)), "blocks")).drop("blocks")
    chunked = index.withColumn("bucket", F.floor(F.col("leaf") / BUCKET_LEAVES)).join(spread, "bucket")
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("key", F.lit(9)), "chunks"))
    chunked = chunked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("chunks", "blocks")

    def scan(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            leaf_of = rows["leaf"].to_numpy()
            x = np.stack(rows["vec"].to_numpy())
            qv = np.stack(queries["vec"].to_numpy())
            asks = np.repeat(np.arange(len(queries)), queries["leaves"].map(len))
            asked_leaf = np.concatenate(queries["leaves"].to_numpy())
            for leaf in np.unique(asked_leaf):
                here, mine = np.flatnonzero(leaf_of == leaf), asks[asked_leaf == leaf]
                for at in range(0, len(mine) if len(here) else 0, 256):
                    q, r, s = _top(qv[mine[at : at + 256]], x[here], k + 1)
                    out.append(pd.DataFrame({"q": mine[at + q], "score": s, "row": here[r]}))
        if not out:
            return pd.DataFrame({"key": [], "score": [], "ids": []})
        best = pd.concat(out)
        best = best[best["score"] >= best.groupby("q")["score"].transform(lambda v: v.nlargest(k + 1).iloc[-1])]
        return pd.DataFrame({"key": queries["key"].to_numpy()[best["q"]], "score": best["score"].to_numpy(), "ids": rows["ids"].to_numpy()[best["row"]]})

    on = ["bucket", "chunk", "block"]
    pairs = routed.groupBy(*on).cogroup(chunked.groupBy(*on)).applyInPandas(scan, "key string, score double, ids array<long>")
    # the best k + 1 distinct vectors of each distinct query, then their ids for each query that asked
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.element_at("ids", 1))
    few = pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    best_ids = few.groupBy("key").agg(F.collect_list(F.struct("score", "ids")).alias("near"))
    out = asked.select("query_id", "key").join(best_ids, "key").select("query_id", F.explode("near").alias("x")).select("query_id", "x.score", F.explode("x.ids").alias("vec_id"))
    return out.filter("vec_id != query_id")


def op3_ann(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
