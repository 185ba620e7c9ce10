"""Count matrices in long form: summaries, filters, cell calling, saturation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cell_summary(counts: DataFrame) -> DataFrame:
    return counts.groupBy("dataset", "cell").agg(F.sum("umis").alias("umis"), F.count_if(F.col("umis") > 0).alias("genes"))


def gene_summary(counts: DataFrame) -> DataFrame:
    return counts.groupBy("dataset", "gene").agg(F.sum("umis").alias("umis"))


def filter_cells(cells: DataFrame, umi: tuple[int, int] = (10, 10_000), genes: int = 10, must_pass: bool = False) -> DataFrame:
    kept = cells.filter(F.col("umis").between(*umi) & (F.col("genes") >= genes))
    if must_pass and kept.isEmpty():
        raise ValueError("no cell passes the filter")
    return kept


def expressed(df: DataFrame, column: str = "umis") -> DataFrame:
    return df.filter(F.col(column) > 0)


def dataset_quantiles(df: DataFrame, column: str) -> DataFrame:
    """Median and the five numbers of a box plot (whiskers at the last values within 1.5 quartile ranges)."""
    q = df.groupBy("dataset").agg(F.percentile(column, [0.25, 0.5, 0.75]).alias("q"))
    q = q.select("dataset", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(2)).alias("q3"))
    inside = F.col(column).between(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    return df.join(q, "dataset").groupBy("dataset", "q1", "median", "q3").agg(F.min(F.when(inside, F.col(column))).alias("low"), F.max(F.when(inside, F.col(column))).alias("high"))


def cells_and_genes(counts: DataFrame) -> DataFrame:
    return expressed(counts).groupBy("dataset").agg(F.count_distinct("cell").alias("cells"), F.count_distinct("gene").alias("genes"))


def top_cells(cells: DataFrame, n: int = 10_000) -> DataFrame:
    w = Window.partitionBy("dataset").orderBy(F.desc("umis"), "cell")
    return cells.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def knee_cut(barcodes: DataFrame, reads: str = "reads") -> DataFrame:
    """Barcodes up to the knee, per dataset.

    Ranks and cumulative reads come from the histogram of distinct read counts, so no window spans all
    barcodes; within a count, ranks run on and cumulative reads grow evenly, and the chord's farthest point
    is at a rank that ends a count or the one before the next.
    """
    h = barcodes.groupBy("dataset", reads).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("dataset").orderBy(F.desc(reads)).rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("rank", F.sum("n").over(w)).withColumn("total", F.sum(F.col("n") * F.col(reads)).over(w))
    # the first rank of each count is a candidate too
    first = h.select("dataset", reads, (F.col("rank") - F.col("n") + 1).alias("rank"), (F.col("total") - (F.col("n") - 1) * F.col(reads)).alias("total"))
    p = h.select("dataset", reads, "rank", "total").union(first).distinct()
    p = p.withColumn("x", F.log10("rank")).withColumn("y", F.log10("total"))
    ends = p.groupBy("dataset").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min_by("y", "x").alias("y0"), F.max_by("y", "x").alias("y1"))
    far = F.abs((F.col("y1") - F.col("y0")) * F.col("x") - (F.col("x1") - F.col("x0")) * F.col("y") + F.col("x1") * F.col("y0") - F.col("y1") * F.col("x0"))
    knee = p.join(ends, "dataset").groupBy("dataset").agg(F.max_by("rank", F.struct(F.round(far, 9), -F.col("rank"))).alias("knee"))
    # whole counts above the knee's are kept; of its own count the first barcodes by name
    edge = h.join(knee, "dataset").filter(F.col("rank") >= F.col("knee")).groupBy("dataset").agg(F.max(reads).alias("edge"), F.first("knee").alias("knee"))
    above = h.join(edge, "dataset").filter(F.col(reads) > F.col("edge")).groupBy("dataset").agg(F.max("rank").alias("above"))
    edge = edge.join(above, "dataset", "left").withColumn("left", F.col("knee") - F.coalesce("above", F.lit(0)))
    b = barcodes.join(edge, "dataset").filter(F.col(reads) >= F.col("edge"))
    tie = Window.partitionBy("dataset", F.col(reads) == F.col("edge")).orderBy("barcode")
    return b.filter(F.col(reads) > F.col("edge")).select(*barcodes.columns, "knee").union(
        b.filter(F.col(reads) == F.col("edge")).withColumn("n", F.row_number().over(tie)).filter(F.col("n") <= F.col("left")).select(*barcodes.columns, "knee")
    )


def quantile_threshold(cells: DataFrame, expected: int, q: float = 0.99, ratio: int = 10) -> DataFrame:
    """Per dataset the UMI count from which barcodes are cells; ranks come from the histogram of counts."""
    h = cells.groupBy("dataset", "umis").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("dataset").orderBy(F.desc("umis")).rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("dataset")))
    at = F.least(F.col("all") - 1, F.round(F.lit(expected * (1 - q)))).cast("long")
    found = h.filter(F.col("upto") > at).groupBy("dataset").agg(F.max("umis").alias("umis"))
    return found.select("dataset", F.greatest(F.lit(1), F.round(F.col("umis") / ratio)).cast("long").alias("threshold"))


def call_cells_quantile(cells: DataFrame, expected: int, q: float = 0.99, ratio: int = 10) -> DataFrame:
    return cells.join(quantile_threshold(cells, expected, q, ratio), "dataset").filter(F.col("umis") >= F.col("threshold"))


def ranked_between(cells: DataFrame, low: int, high: int) -> DataFrame:
    """Cells of ranks ``low`` to ``high`` by UMIs, the most first, ties by name, per dataset.

    The histogram of counts has the ranks that each count takes. Counts that lie inside come whole; only the names of a count
    that a border cuts are ordered, no more of them than ``high`` a task.
    """
    h = cells.groupBy("dataset", "umis").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("dataset").orderBy(F.desc("umis")).rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("__last", F.sum("n").over(upto)).withColumn("__first", F.col("__last") - F.col("n") + 1)
    h = h.filter((F.col("__last") >= low) & (F.col("__first") <= high)).drop("n")
    inside = (F.col("__first") >= low) & (F.col("__last") <= high)
    whole = cells.join(h.filter(inside), ["dataset", "umis"], "left_semi").select(cells.columns)
    cut = cells.join(h.filter(~inside), ["dataset", "umis"])
    cut = cut.withColumn("__n", F.row_number().over(Window.partitionBy("dataset", "umis").orderBy("cell"))).filter(F.col("__n") <= high)
    return whole.unionByName(cut.filter((F.col("__n") + F.col("__first") - 1).between(low, high)).select(cells.columns))


def emptydrops_candidates(
    counts: DataFrame, expected: int, ambient: tuple[int, int] = (45_000, 90_000), least_umis: int = 500, least_share: float = 0.01, most: int | None = 20_000
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(called, profile, candidates): the quantile's cells, ``logp`` of each gene in the ambient barcodes, and the tested barcodes with ``loglik``.

    The ambient barcodes are those of the ranks ``ambient``; counts are smoothed by one over all genes. Candidates
    have at least ``least_umis`` and ``least_share`` of the called cells' median, at most ``most`` a dataset (null: all).
    """
    cells = cell_summary(counts)
    called = call_cells_quantile(cells, expected).select("dataset", "cell", "umis", "genes")
    w = Window.partitionBy("dataset").orderBy(F.desc("umis"), "cell")
    empty = ranked_between(cells, *ambient).select("dataset", "cell")
    profile = counts.join(empty, ["dataset", "cell"]).groupBy("dataset", "gene").agg(F.sum("umis").alias("a"))
    genes = counts.select("dataset", "gene").distinct().join(profile, ["dataset", "gene"], "left").fillna(0, ["a"])
    g = genes.groupBy("dataset").agg(F.count(F.lit(1)).alias("g"), F.sum("a").alias("total"))
    logp = genes.join(g, "dataset").filter("total > 0").select("dataset", "gene", F.log((F.col("a") + 1 / F.col("g")) / (F.col("total") + 1)).alias("logp"))
    floor = called.groupBy("dataset").agg(F.greatest(F.lit(float(least_umis)), F.median("umis") * least_share).alias("floor"))
    tested = cells.join(called.select("dataset", "cell"), ["dataset", "cell"], "left_anti").join(floor, "dataset").filter(F.col("umis") >= F.col("floor"))
    if most is not None:
        tested = tested.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most)
    tested = tested.select("dataset", "cell", "umis", "genes")
    joined = counts.join(tested.select("dataset", "cell"), ["dataset", "cell"]).join(logp, ["dataset", "gene"])
    observed = joined.groupBy("dataset", "cell").agg(F.sum(F.col("umis") * F.col("logp")).alias("loglik"))
    return called, logp, tested.join(observed, ["dataset", "cell"])


def call_cells_emptydrops(counts: DataFrame, expected: int, fdr: float = 0.01, simulations: int = 10_000, seed: int = 1, **options) -> DataFrame:
    """Cells by quantile and, of the rest, those unlike the ambient profile (Monte Carlo, Benjamini-Hochberg).

    A task simulates one dataset and depth. With fewer barcodes than the ambient range needs, the quantile's
    cells are returned unchanged. ``options`` are those of ``emptydrops_candidates``.
    """
    called, logp, observed = emptydrops_candidates(counts, expected, **options)

    def simulate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        low = np.zeros(len(left))
        if len(left) and len(right):
            lp = np.sort(np.asarray(right["logp"].iloc[0], float))
            p = np.exp(lp) / np.exp(lp).sum()
            depth, seen, upto = int(left["umis"].iloc[0]), left["loglik"].to_numpy(), np.cumsum(p)[:-1]
            one_by_one = depth < 4 * len(p)  # fewer draws than a multinomial's binomials
            rng, block = np.random.default_rng([seed, depth]), max(1, 1_000_000 // (depth if one_by_one else len(p)))
            for at in range(0, simulations, block):
                n = min(block, simulations - at)
                drawn = lp[np.searchsorted(upto, rng.random((n, depth)), "right")].sum(1) if one_by_one else rng.multinomial(depth, p, n) @ lp
                low += np.searchsorted(np.sort(drawn), seen + 1e-9, "right")
        return left.drop(columns="loglik").assign(p=(1 + low) / (1 + simulations))

    kinds = {f.name: f.dataType.simpleString() for f in observed.schema}
    schema = f"dataset {kinds['dataset']}, cell {kinds['cell']}, umis {kinds['umis']}, genes {kinds['genes']}, p double"
    profile = logp.groupBy("dataset").agg(F.collect_list("logp").alias("logp"))  # one number a gene
    depths = observed.select(F.col("dataset").alias("d"), F.col("umis").alias("u")).distinct().join(profile.withColumnRenamed("dataset", "d"), "d")
    tested = observed.groupBy("dataset", "umis").cogroup(depths.groupBy("d", "u")).applyInPandas(simulate, schema)
    order = Window.partitionBy("dataset").orderBy("p", "cell")
    m = tested.withColumn("i", F.row_number().over(order)).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("dataset")))
    back = Window.partitionBy("dataset").orderBy(F.desc("i"))
    passed = m.withColumn("q", F.min(F.col("p") * F.col("m") / F.col("i")).over(back)).filter(F.col("q") <= fdr)
    return called.unionByName(passed.select("dataset", "cell", "umis", "genes"))


def saturation_curve(tagged: DataFrame, fractions: Sequence[float], n_cells: int, map_rate: float = 1.0, unit: Column | None = None) -> DataFrame:
    """Saturation at sampled fractions of the reads (read_id, cb, umi, gene), in one pass.

    A read is in the sample of fraction f if its hash is below f, and so is a molecule if its smallest read is.
    ``unit`` may give another column, evenly spread over [0, 1), for the hash.
    """
    u = F.pmod(F.xxhash64("read_id"), F.lit(1 << 31)) / float(1 << 31) if unit is None else unit
    bucket = lambda x: F.aggregate(F.lit([float(f) for f in fractions]), F.lit(0), lambda s, f: s + (x >= f).cast("int"))
    reads = tagged.select(bucket(u).alias("b"), "cb", "umi", "gene").groupBy("cb", "umi", "gene", "b").agg(F.count(F.lit(1)).alias("n"))
    low = reads.groupBy("cb", "umi", "gene").agg(F.min("b").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("m"))
    r = reads.groupBy("b").agg(F.sum("n").alias("r"))
    spark = tagged.sparkSession
    f = spark.createDataFrame([(i, float(x)) for i, x in enumerate(fractions)], "i int, fraction double")
    both = r.join(low, "b", "full").select("b", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("m", F.lit(0)).alias("m"))
    out = f.join(F.broadcast(both), F.col("b") <= F.col("i"), "left").groupBy("fraction").agg(F.coalesce(F.sum("r"), F.lit(0)).alias("reads"), F.coalesce(F.sum("m"), F.lit(0)).alias("molecules"))
    return out.withColumn("saturation", 1 - F.try_divide(F.col("molecules").cast("double"), F.col("reads"))).withColumn("reads_per_cell", F.col("reads") / F.lit(float(map_rate * n_cells)))


def reads_for_saturation(curve: DataFrame, target: float = 0.7) -> DataFrame:
    """Reads per cell at which the curve 1/s = a + K/r reaches the target; null if it never does."""
    c = curve.filter("saturation > 0 and reads_per_cell > 0").select((1 / F.col("saturation")).alias("y"), (1 / F.col("reads_per_cell")).alias("x"))
    fit = c.agg(F.regr_intercept("y", "x").alias("a"), F.regr_slope("y", "x").alias("k"))
    left = F.lit(1 / target) - F.col("a")
    return fit.select(F.when(left > 0, F.col("k") / left).alias("reads_for_saturation"))


def n_cells(barcodes: DataFrame) -> DataFrame:
    return barcodes.agg(F.count(F.lit(1)).alias("n_cells"))
