"""Filters, counters and orders of alignment lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The usual names of the mitochondrial contig.
MITO = ("chrM", "M", "MT")


def has_flags(mask: int) -> Column:
    return F.col("flag").bitwiseAND(mask) != 0


def lacks_flags(mask: int) -> Column:
    return F.col("flag").bitwiseAND(mask) == 0


def is_unique() -> Column:
    return F.col("nh") == 1


def is_multi() -> Column:
    return F.col("nh") >= 2


def is_mito(names=MITO) -> Column:
    return F.col("contig").isin(*names)


def min_score(aln: DataFrame, least: int = 30) -> DataFrame:
    return aln.filter(F.col("as_score") >= least)


def alignment_counts(aln: DataFrame) -> DataFrame:
    """Lines, not reads; the last column counts distinct mapped reads."""
    return aln.agg(
        F.count_if(lacks_flags(4)).alias("mapped"),
        F.count_if(has_flags(4)).alias("unmapped"),
        F.count_if(lacks_flags(4) & is_unique()).alias("unique_alignments"),
        F.count_distinct(F.when(lacks_flags(4), F.col("pair_id"))).alias("mapped_reads"),
    )


def mito_shares(aln: DataFrame, names=MITO) -> DataFrame:
    """Mitochondrial lines of mapped ones, of multi-mapped primary ones and of all multi-mapped ones."""
    mito, mapped, multi = is_mito(names) & lacks_flags(4), lacks_flags(4), is_multi() & lacks_flags(4)
    c = aln.agg(
        F.count_if(mapped).alias("mapped"),
        F.count_if(mito).alias("mt"),
        F.count_if(multi & lacks_flags(256)).alias("multi_primary"),
        F.count_if(multi & lacks_flags(256) & mito).alias("mt_multi_primary"),
        F.count_if(multi).alias("multi_all"),
        F.count_if(multi & mito).alias("mt_multi_all"),
    )
    share = lambda n, d: F.round(F.try_divide(F.col(n).cast("double"), F.col(d)), 4)
    return c.withColumns({"mt_share": share("mt", "mapped"), "mt_multi_primary_share": share("mt_multi_primary", "multi_primary"), "mt_multi_all_share": share("mt_multi_all", "multi_all")})


def map_rate(aln: DataFrame, n_input: int) -> DataFrame:
    """Primary mapped lines and their share of the input, cut off after four decimals."""
    return aln.agg(F.count_if(lacks_flags(260)).alias("primary_mapped")).withColumn("map_rate", F.floor(F.try_divide(F.col("primary_mapped").cast("double"), F.lit(n_input)) * 10000) / 10000)


def coord_sort(aln: DataFrame) -> DataFrame:
    return aln.repartitionByRange("contig", "pos").sortWithinPartitions("contig", "pos")


def collate(aln: DataFrame, by: str = "cb") -> DataFrame:
    """All lines of a barcode in one partition, together."""
    return aln.repartition(by).sortWithinPartitions(by)
