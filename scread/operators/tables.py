"""Unions, orders and set operations of small relational tables and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The columns of the collated metrics, in order.
CANONICAL = [
    "Sample",
    "Software",
    "N reads/sample",
    "Q30 Bases in CB+UMI",
    "Q30 Bases in RNA read",
    "N uniquely mapped reads",
    "% uniquely mapped reads",
    "% multi-mapped reads",
    "% multi-mapped reads: too many",
    "% unmapped: too short",
    "% unmapped: other",
    "Target N cells",
    "N cells",
    "UMI cutoff used for cell calling",
    "Saturation",
    "Reads for 0.7 saturation",
    "Noise (% UMIs in non-cell barcodes)",
    "% exonic reads",
    "% Intronic reads",
    "% intergenic reads",
    "% mtDNA in Unique reads",
    "% exonicAS reads",
    "% intronicAS reads",
    "% rRNA in Unique reads",
    "Mean Reads per Cell",
    "Median UMI Counts per Cell",
    "Median Genes per Cell",
    "Total Genes Detected",
]
# The tools in the order of the report.
SOFTWARE = ["STARsolo", "ParseBio", "CellRanger", "sci-rocket", "alevin-fry"]


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stack(frames: dict[str, DataFrame], id_col: str = "dataset") -> DataFrame:
    return union_all(*[df.withColumn(id_col, F.lit(name)) for name, df in frames.items()])


def stack_ragged(frames: list[DataFrame], columns: list[str] = CANONICAL) -> DataFrame:
    """Rows of all frames with exactly these columns, as text; missing ones are null, others are left out."""
    texts = [df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c in columns]) for df in frames]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def sorted_distinct(df: DataFrame) -> DataFrame:
    return df.distinct().orderBy(*df.columns)


def missing_values(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Values of the column outside the allowed ones."""
    return df.select(column).distinct().filter(~F.col(column).isin(allowed) | F.col(column).isNull())


def absent_values(df: DataFrame, column: str, required: list) -> DataFrame:
    """Required values the column lacks."""
    want = df.sparkSession.createDataFrame([(r,) for r in required], f"{column} string")
    return want.join(df.select(F.col(column).cast("string")), column, "left_anti")


def gather(*frames: DataFrame) -> DataFrame:
    """Files of several samples as one, rows unchanged."""
    return union_all(*frames)


def members(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.intersect(keys)


def restrict_cells(stats: DataFrame, called: DataFrame, key: str = "cell") -> DataFrame:
    return stats.join(called.select(key), key, "left_semi")


def order_metrics(df: DataFrame) -> DataFrame:
    rank = F.coalesce(F.array_position(F.lit(SOFTWARE), F.col("Software")), F.lit(99))
    return df.orderBy(F.when(rank == 0, 99).otherwise(rank), "Sample")


def first_row(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order).limit(1)


def pick_first(df: DataFrame, key: str, *order) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def merge_lanes(samples: DataFrame) -> DataFrame:
    """One row per sample: first meta values, all mates' paths in lane order, without nulls."""
    order = F.col("row_no") if "row_no" in samples.columns else F.col("fastq_cdna")
    paths = [c for c in samples.columns if c.startswith("fastq_")]
    meta = [c for c in samples.columns if c not in (*paths, "sample", "row_no")]
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("p"))))), lambda x: x["p"]).alias(c) for c in paths]
    return samples.groupBy("sample").agg(*[F.min_by(c, order).alias(c) for c in meta], *lists)


def cellread_shares(stats: DataFrame, called: DataFrame) -> DataFrame:
    """Noise and region shares per sample from per-barcode read statistics and the called cells."""
    s = stats.join(called.select("sample", "cell").distinct().withColumn("called", F.lit(True)), ["sample", "cell"], "left")
    noise = F.sum(F.when(F.col("cell") == "CBnotInPasslist", F.col("cbMatch")).otherwise(0))
    part = lambda c: F.sum(F.when(F.col("called"), F.col(c)).otherwise(0))
    names = ["genomeU", "genomeM", "exonic", "intronic", "exonicAS", "intronicAS", "mito"]
    a = s.groupBy("sample").agg(noise.alias("noise"), F.sum("cbMatch").alias("all"), *[part(c).alias(c) for c in names])
    genome = F.col("genomeU") + F.col("genomeM")
    share = lambda n: F.round(F.try_divide(n.cast("double"), genome), 6)
    return a.select(
        "sample",
        F.round(F.try_divide(F.col("noise").cast("double"), F.col("all")), 6).alias("noise"),
        *[share(F.col(c)).alias(c) for c in ("exonic", "intronic", "mito", "exonicAS", "intronicAS")],
        share(genome - F.col("exonic") - F.col("intronic") - F.col("exonicAS") - F.col("intronicAS")).alias("intergenic"),
    )


def cell_meta_summary(df: DataFrame) -> DataFrame:
    """sample, n_cells, rounded mean reads and medians (half to even); absent columns give null."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("double")
    return df.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.bround(F.avg(has("reads"))).cast("long").alias("mean_reads_per_cell"),
        F.bround(F.median(has("umis"))).cast("long").alias("median_umi_per_cell"),
        F.bround(F.median(has("genes"))).cast("long").alias("median_genes_per_cell"),
    )


def region_shares(df: DataFrame) -> DataFrame:
    """Shares of the six regions of their sum, per row with a ``sample``."""
    names = ["exonic", "intronic", "intergenic", "mito", "exonicAS", "intronicAS"]
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in names), F.lit(0))
    return df.select("sample", *[F.when(total > 0, F.coalesce(F.col(c), F.lit(0)) / total).alias(c) for c in names])
