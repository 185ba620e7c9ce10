"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target number of words. Documents are counted by exact length; a source first
takes whole passes, then a share of every length with a carried remainder, and a bounded-knapsack
dynamic programme over the documents still left spends the remaining budget. Documents of a length
are chosen by a seeded hash of their id, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stage

SALTS = 64
KNAPSACK_WORDS = 1 << 13


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """Targets of sources: ``sizes(source_key, source_size)`` gains ``target``.

    Sources in order of their key take the weights in turn. Each gets its share of ``share`` times all
    words, at most ``cap`` times its own; the excess goes to the others by weight until none is above.
    With caps sorted by cap over weight that is one prefix sum: the sources before the first that keeps
    its share are capped. One row per source is all that is ordered here.
    """
    turn = F.row_number().over(Window.orderBy("source_key")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("limit", (F.col("source_size") * cap).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("w"), "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    s = (
        s.withColumn("capped", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("budget", F.sum("source_size").over(everything).cast("double") * share)
        .withColumn("fits", (F.col("budget") - F.col("capped")) * F.col("w") <= F.col("limit") * F.col("w_left"))
        .withColumn("free", F.max("fits").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    first = F.when(F.col("fits"), F.struct(F.col("limit") / F.col("w"), "source_key", "capped", "w_left"))
    s = s.withColumn("at", F.min(first).over(everything))
    level = (F.col("budget") - F.col("at.capped")) * F.col("w") / F.col("at.w_left")
    return s.select("source_key", "source_size", F.when(F.col("free"), level).otherwise(F.col("limit")).alias("target"))


def fit(lengths: list[int], counts: list[int], target: float, capacity: int = KNAPSACK_WORDS) -> list[int]:
    """How many documents of each length to take (repeats included) so that their words come nearest ``target``.

    No document is taken more than twice, and one without words once. The list of lengths has at most
    sqrt(2 * words) entries. The nearest sum from above is what the nearest sum from below leaves of the complement.
    """
    most = [2 * c if n else 0 for n, c in zip(lengths, counts)]
    words = lambda copies: sum(n * c for n, c in zip(lengths, copies))
    total = words(most)
    goal = max(0, min(int(target + 0.5), total))
    best = _fit_below(lengths, most, goal, capacity)
    if words(best) < goal:
        above = [m - c for m, c in zip(most, _fit_below(lengths, most, total - goal, capacity))]
        if words(above) - goal < goal - words(best):
            best = above
    return [c if n else m for n, c, m in zip(lengths, best, counts)]


def _fit_below(lengths: list[int], most: list[int], goal: int, capacity: int) -> list[int]:
    """At most ``most`` documents of each length, their words near ``goal`` and not above it."""
    total = sum(n * c for n, c in zip(lengths, most))
    copies = [0] * len(lengths)
    order = sorted((i for i, n in enumerate(lengths) if n > 0), key=lambda i: -lengths[i])
    due, taken, bulk = 0.0, 0, max(0, goal - capacity)
    for i in order:  # every length its share of the bulk, the longest first, with what rounding left over
        due += lengths[i] * most[i] * (bulk / total)
        copies[i] = max(0, min(most[i], int((min(due, bulk) - taken) / lengths[i] + 0.5), (goal - taken) // lengths[i]))
        taken += copies[i] * lengths[i]
    left = goal - taken
    while left > capacity:  # give whole documents, the longest first, until the programme's table holds the rest
        i = next((i for i in order if copies[i] < most[i] and lengths[i] <= left), None)
        if i is None:
            break
        k = max(1, min(most[i] - copies[i], (left - capacity) // lengths[i]))
        copies[i] += k
        left -= k * lengths[i]
    room = min(left, capacity)
    if room > 0:
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for i in reversed(order):
            n, c = lengths[i], min(most[i] - copies[i], room // lengths[i])
            k = 1
            while c > 0 and not reach >> room & 1:
                part = min(k, c)
                steps.append((reach, i, part))
                reach |= reach << (part * n) & mask
                c, k = c - part, k * 2
        at = reach.bit_length() - 1
        for before, i, part in reversed(steps):
            if not before >> at & 1:
                copies[i] += part
                at -= part * lengths[i]
    return copies


def _fit_sources(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    return rows.assign(copies=fit(rows["size"].tolist(), rows["n"].tolist(), rows["target"].iloc[0]))[["source_key", "size", "n", "copies"]]


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: int = 2, seed: int = 17) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target`` and ``copies`` (0, 1 or 2): how often the mix takes each.

    Needs doc_id, text and source; every row counts as a document. Null and empty texts have size 0 and
    are taken once; a null source is a source of its own, after all others. Rows with equal ids and
    sizes are interchangeable. An empty table gives no rows. Columns beyond these three are not read.
    """
    key = F.when(F.col("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), F.col("source")))
    sized = stage(docs.select("doc_id", key.alias("source_key"), n_words(F.col("text")).alias("size")), "mix-sizes")
    rank = F.xxhash64(F.lit(seed), "doc_id")
    salted = sized.withColumn("rank", rank).withColumn("salt", F.pmod("rank", F.lit(SALTS)).cast("int"))
    cells = stage(salted.groupBy("source_key", "size", "salt").agg(F.count(F.lit(1)).alias("m")), "mix-cells")
    lengths = cells.groupBy("source_key", "size").agg(F.sum("m").alias("n"))
    goals = targets(cells.groupBy("source_key").agg(F.sum(F.col("size") * F.col("m")).alias("source_size")), weights, share, cap)
    goals = stage(goals, "mix-targets")
    plan = (
        lengths.join(goals.select("source_key", "target"), "source_key")
        .groupBy("source_key")
        .applyInPandas(_fit_sources, "source_key string, size long, n long, copies long")
    )
    plan = plan.select("source_key", "size", F.floor(F.col("copies") / F.greatest("n", F.lit(1))).alias("base"), "copies", "n")
    plan = plan.withColumn("more", F.col("copies") - F.col("base") * F.col("n")).drop("copies", "n")
    before = Window.partitionBy("source_key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.join(plan, ["source_key", "size"])
    cells = cells.withColumn("more", F.col("more") - F.coalesce(F.sum("m").over(before), F.lit(0)))
    order = Window.partitionBy("source_key", "size", "salt").orderBy("rank", "doc_id")
    picked = (
        salted.join(cells.drop("m"), ["source_key", "size", "salt"])
        .withColumn("nth", F.row_number().over(order))
        .withColumn("copies", F.col("base") + (F.col("nth") <= F.col("more")).cast("long"))
    )
    return picked.join(goals, "source_key").select("doc_id", "source_key", "size", "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as ``mix`` takes it, so the words are the same.

    Rows with equal id, source and size share what ``mix`` takes of them: in whole, and what is left goes to the
    first by a hash of their columns. Documents without words come once. All columns are kept.
    """
    taken = mix(docs, **options).groupBy("doc_id", "source_key", "size").agg(F.sum("copies").cast("int").alias("__all"), F.count(F.lit(1)).cast("int").alias("__rows"))
    taken = stage(taken.filter("__all > 0").toDF("__id", "__key", "__size", "__all", "__rows"), "mix-taken")
    key = F.when(F.col("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), F.col("source")))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (key == F.col("__key")) & (n_words(F.col("text")) == F.col("__size"))
    even = docs.join(taken.filter("__all % __rows = 0"), on).withColumn("__copies", (F.col("__all") / F.col("__rows")).cast("int"))
    order = Window.partitionBy("__id", "__key", "__size").orderBy(F.xxhash64(*[docs[c] for c in docs.columns]))
    nth = F.row_number().over(order)
    odd = docs.join(taken.filter("__all % __rows <> 0"), on).withColumn("__copies", (F.floor(F.col("__all") / F.col("__rows")) + (nth <= F.col("__all") % F.col("__rows")).cast("int")).cast("int"))
    mixed = even.unionByName(odd)
    return mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).select(*docs.columns)


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
