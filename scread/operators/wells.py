"""Demultiplexing by wells of the first barcode round: all groups in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import expand_wells
from ..functions.seq import has_n
from .match import comparable, min_hamming_map, min_hamming_rows, small


def min_len(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.filter(F.length(column) >= n)


def well_groups(groups: DataFrame, mode: str = "block") -> DataFrame:
    """(group_name, well) of groups given as well specifications."""
    return groups.select("group_name", F.explode(expand_wells("wells", mode)).alias("well")).distinct()


def assign_wells(reads: DataFrame, seq: str, whitelist: DataFrame, groups: DataFrame | None, bounds: tuple[int, int], most: int = 1) -> DataFrame:
    """Adds too_short, n_in_bc, distance, wells and ``groups`` (sorted; a tied read may be in several).

    Without groups every matched read is in the group ``all``. Short reads stay, marked, so that all can be counted.
    """
    a, b = bounds
    df = reads.withColumn("too_short", F.length(seq) < b)
    df = df.withColumn("bc", F.when(~F.col("too_short"), F.substring(seq, a + 1, b - a)))
    df = df.withColumn("n_in_bc", F.coalesce(has_n("bc"), F.lit(False)))
    near = min_hamming_map(whitelist, most)
    named = near.select("observed", "distance", "matches", F.explode("matches").alias("sequence")).join(whitelist.groupBy("sequence").agg(F.max("well").alias("well")), "sequence")
    near = named.groupBy(F.col("observed").alias("__seen")).agg(F.first("distance").alias("distance"), F.first("matches").alias("matches"), F.array_sort(F.collect_set("well")).alias("wells"))
    df = df.join(small(near, min_hamming_rows(whitelist, most)), comparable(F.col("bc")) == F.col("__seen"), "left").drop("__seen")
    if groups is None:
        return df.withColumn("groups", F.when(F.col("matches").isNotNull(), F.array(F.lit("all"))).otherwise(F.array().cast("array<string>")))
    n = groups.count()
    by_well = groups.groupBy("well").agg(F.collect_set("group_name").alias("g"))
    seen = df.select(F.explode("wells").alias("well"), "wells").distinct().join(small(by_well, n), "well")
    of = seen.groupBy("wells").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("g")))).alias("groups"))
    df = df.join(of, "wells", "left")
    return df.withColumn("groups", F.coalesce("groups", F.array().cast("array<string>")))


def well_demux_stats(assigned: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Counters of one run per group."""
    names = assigned.sparkSession.createDataFrame([("all",)], "group_name string") if groups is None else groups.select("group_name").distinct()
    hits = [F.count_if(F.col("distance") == d).alias(f"ed{d}") for d in (0, 1, 2)]
    run = assigned.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("too_short").alias("too_short"),
        F.count_if("n_in_bc").alias("n_in_bc"),
        F.count_if(~F.col("too_short") & F.col("matches").isNull()).alias("unmatched"),
        F.count_if(F.col("distance").isNotNull()).alias("hits"),
    )
    mine = assigned.select(F.explode("groups").alias("group_name"), "distance").groupBy("group_name").agg(F.count(F.lit(1)).alias("matched"), *hits)
    mine = names.join(mine, "group_name", "left").fillna(0)
    return mine.crossJoin(run).select(  # the run's counters are one row
        "group_name", "total", "too_short", "n_in_bc", "unmatched", (F.col("hits") - F.col("ed0") - F.col("ed1") - F.col("ed2")).alias("no_group_match"), "matched", "ed0", "ed1", "ed2"
    )
