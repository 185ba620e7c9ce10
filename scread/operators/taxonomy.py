"""Taxon votes of unmapped reads by k-mers, and clade sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import revcomp
from ..plans.shared import folder, written
from .kmers import kmer_hits, reference_hits
from .match import small


def ancestors(tree: DataFrame, depth: int = 64) -> DataFrame:
    """taxid, ancestor, level for every taxon and each taxon on its path to the root, itself included.

    Path doubling: each round joins paths of twice the length, so deep trees take few joins.
    """
    up = tree.select("taxid", F.when(F.col("parent") != F.col("taxid"), F.col("parent")).alias("parent"))
    known = up.select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("d"))
    jump, step = up.filter("parent is not null").select("taxid", F.col("parent").alias("to")), 1
    while step < depth:
        further = known.join(jump.withColumnRenamed("taxid", "ancestor"), "ancestor").select("taxid", F.col("to").alias("ancestor"), (F.col("d") + step).alias("d"))
        known = known.unionByName(further)
        jump = jump.join(jump.toDF("to", "to2"), "to").select("taxid", F.col("to2").alias("to"))
        step *= 2
        if jump.isEmpty():
            break
    height = known.groupBy("taxid").agg(F.max("d").alias("height"))
    return known.join(height, "taxid").select("taxid", "ancestor", (F.col("height") - F.col("d")).alias("level"))


def canonical_kmers(seqs: DataFrame, key: str, seq: str, k: int = 31) -> DataFrame:
    at = F.when(F.length(seq) >= k, F.sequence(F.lit(1), F.length(seq) - k + 1)).otherwise(F.array().cast("array<int>"))
    each = seqs.select(key, seq, F.explode(at).alias("__i")).select(key, F.substring(F.col(seq), F.col("__i"), F.lit(k)).alias("kmer")).filter(~F.col("kmer").contains("N"))
    return each.withColumn("kmer", F.least("kmer", revcomp("kmer")))


def depth_first(paths: DataFrame) -> DataFrame:
    """taxid, path (from the root to it) and place of each taxon, a taxon before all below it."""
    path = F.transform(F.array_sort(F.collect_list(F.struct("level", "ancestor"))), lambda x: x["ancestor"])
    each = paths.groupBy("taxid").agg(path.alias("path"))
    return each.withColumn("place", F.row_number().over(Window.orderBy("path")))  # a row per taxon


def kmer_taxa(references: DataFrame, paths: DataFrame, k: int = 31) -> DataFrame:
    """kmer to the lowest common ancestor of the references (taxid, sequence) that hold it.

    The ancestor of all is that of the first and the last in depth-first order, so one aggregation finds both, and only
    k-mers of several taxa meet paths. The k-mers are written once and no join has all of them on a side to broadcast.
    """
    order = depth_first(paths)
    placed = references.join(order.select("taxid", "place"), "taxid", "left").select(F.struct("taxid", "place").alias("of"), "sequence")
    own = canonical_kmers(placed, "of", "sequence", k).select("kmer", "of.taxid", "of.place")
    path = folder(references.sparkSession, "kmers")
    own.groupBy("kmer").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.min("taxid").alias("taxid"), F.bool_or(F.col("place").isNull()).alias("unknown")).write.parquet(path)
    found = references.sparkSession.read.parquet(path).filter("not unknown")  # a reference outside the tree shares no ancestor
    one, many = found.filter("first = last").select("kmer", "taxid"), found.filter("first <> last")
    ends = many.select("first", "last").distinct()
    for end in ("first", "last"):
        ends = ends.join(order.select(F.col("place").alias(end), F.col("path").alias(f"{end}_path")), end)
    common = ends.select("first", "last", F.try_element_at(F.array_intersect("first_path", "last_path"), F.lit(-1)).alias("taxid")).filter("taxid is not null")
    return one.unionByName(many.select("kmer", "first", "last").hint("merge").join(common, ["first", "last"]).select("kmer", "taxid"))


def nodes(paths: DataFrame) -> DataFrame:
    """taxid, place, last, path, known of each taxon, depth first: those below it have the places up to ``last``; path is places from the root to it.

    An ancestor without a path of its own is a root that isn't known. A row a taxon, written once, as are the paths: the plan of a
    doubling is long, and each use of it would be planned again.
    """
    paths = written(paths, "paths")
    roots = paths.select(F.col("ancestor").alias("taxid")).distinct().join(paths.select("taxid"), "taxid", "left_anti")
    every = paths.select("taxid", "ancestor", "level", F.lit(True).alias("known")).unionByName(roots.select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("level"), F.lit(False).alias("known")))
    order = written(depth_first(every).select("taxid", "place"), "places")
    above = every.join(order.toDF("ancestor", "above"), "ancestor")
    up = above.groupBy("taxid").agg(F.array_sort(F.collect_list("above")).alias("path"), F.first("known").alias("known"))
    size = every.groupBy(F.col("ancestor").alias("taxid")).agg(F.count(F.lit(1)).cast("int").alias("size"))
    each = order.join(up, "taxid").join(size, "taxid")
    return written(each.select("taxid", "place", (F.col("place") + F.col("size") - 1).alias("last"), "path", "known"), "nodes")


def _common(df: DataFrame, tree: DataFrame) -> DataFrame:
    """``df`` with the place of the lowest common ancestor of the places ``first`` and ``last``; rows without one are left out."""
    for end in ("first", "last"):
        df = df.join(tree.select(F.col("place").alias(end), F.col("path").alias(f"{end}_path")), end)
    place = F.when(F.col("first") == F.col("last"), F.col("first")).otherwise(F.try_element_at(F.array_intersect("first_path", "last_path"), F.lit(-1)))
    return df.withColumn("place", place).filter("place is not null").drop("first_path", "last_path")


def voted(hits: DataFrame, tree: DataFrame) -> DataFrame:
    """read_id and taxid of the reads of (read_id, place, hits) that have one.

    The score of a taxon is a running sum in depth-first order: hits of a taxon count from its place to the last below it.
    """
    own = hits.groupBy("read_id", "place").agg(F.sum("hits").alias("hits")).join(tree.select("place", "last", "known"), "place")
    begin = F.struct(F.col("place").alias("at"), F.col("hits").alias("change"), F.when(F.col("known"), F.col("place")).alias("of"))
    end = F.struct((F.col("last") + 1).alias("at"), (-F.col("hits")).alias("change"), F.lit(None).cast("int").alias("of"))
    read = Window.partitionBy("read_id")
    score = own.select("read_id", F.inline(F.array(begin, end))).withColumn("score", F.sum("change").over(read.orderBy("at"))).filter("of is not null")
    best = score.withColumn("top", F.max("score").over(read)).filter("score = top").groupBy("read_id").agg(F.min("of").alias("first"), F.max("of").alias("last"))
    return _common(best, tree).join(tree.select("place", "taxid"), "place").select("read_id", "taxid")


def classify_reads(reads: DataFrame, kmers: DataFrame, paths: DataFrame, k: int = 31) -> DataFrame:
    """read_id and taxid: the taxon whose path to the root has most hits, ties to the lowest common ancestor, no hit null."""
    tree = _tree(paths)
    hits = kmer_hits(reads, kmers, k).repartition("read_id").join(tree.select("taxid", "place"), "taxid")
    return reads.select("read_id").join(voted(hits, tree), "read_id", "left")


def classify_by_references(reads: DataFrame, references: DataFrame, paths: DataFrame, k: int = 31) -> DataFrame:
    """``classify_reads`` by the lowest common ancestor of the references (taxid, sequence) that hold a k-mer, without a table of k-mers."""
    tree = _tree(paths)
    placed = references.join(tree.filter("known").select("taxid", "place"), "taxid", "left").select("place", F.col("sequence").alias("seq"))
    return reads.select("read_id").join(voted(_common(reference_hits(reads, placed, k), tree), tree), "read_id", "left")


def _tree(paths: DataFrame) -> DataFrame:
    tree = nodes(paths)
    return small(tree, tree.count())


def clade_counts(taxa: DataFrame, paths: DataFrame) -> DataFrame:
    """taxid, reads (own) and clade_reads (with all below)."""
    own = taxa.filter("taxid is not null").groupBy("taxid").agg(F.count(F.lit(1)).alias("reads"))
    clade = own.join(paths, "taxid").groupBy(F.col("ancestor").alias("taxid")).agg(F.sum("reads").alias("clade_reads"))
    return clade.join(own, "taxid", "left").select("taxid", F.coalesce("reads", F.lit(0)).alias("reads"), "clade_reads")
