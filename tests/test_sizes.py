"""Queries on tables that are larger, or have larger keys, than the test data."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from scread.functions import seq
from scread.operators import intervals, taxonomy, trim, umi
from scread.queries import QUERIES
from scread.sinks import fastq as fq_out
from scread.sources import fastq, storage


@pytest.fixture(scope="module")
def high_keys(spark, sf, tmp_path_factory):
    """The smallest tables with part keys above a million."""
    path = str(tmp_path_factory.mktemp("high"))
    spark.read.parquet(f"{sf}/part.parquet").withColumn("p_partkey", F.col("p_partkey") + 1_200_000).write.parquet(f"{path}/part.parquet")
    spark.read.parquet(f"{sf}/events.parquet").write.parquet(f"{path}/events.parquet")
    return path


def test_genes_beyond_ints(spark, high_keys):
    genes = spark.read.parquet(f"{high_keys}/part.parquet").count()
    found = QUERIES["extend_genes"](spark, high_keys)
    assert found.count() == 2 * genes and found.agg(F.min("f_start")).first()[0] == 2000 * 1_200_000 + 1


def test_nearest_gene_beyond_ints(spark, high_keys):
    assert QUERIES["nearest_gene"](spark, high_keys).collect() == []  # all genes lie behind the reads


def test_coord_sort_with_few_samples(spark, sf):
    """Ranges that are cut from few sampled lines, so that no two runs of the sort need agree on them."""
    names = ("spark.sql.execution.rangeExchange.sampleSizePerPartition", "spark.sql.adaptive.coalescePartitions.enabled")
    kept = [spark.conf.get(n) for n in names]
    for n, value in zip(names, ("1", "false")):
        spark.conf.set(n, value)
    try:
        found = QUERIES["coord_sort"](spark, sf).orderBy("place").collect()
    finally:
        for n, value in zip(names, kept):
            spark.conf.set(n, value)
    assert len(found) == spark.read.parquet(f"{sf}/events.parquet").count()
    assert [r["place"] for r in found] == list(range(1, len(found) + 1))
    assert [r[1:] for r in found] == sorted(r[1:] for r in found)


def test_emptydrops_candidates_are_all_there(spark, tmp_path):
    """More barcodes in one dataset than the operator's default tests."""
    i = F.col("id")
    drops = spark.range(20_500).select(F.lit("A").alias("l_returnflag"), (i * 4 + 1).alias("l_orderkey"), i.alias("l_suppkey"), (i % 300).alias("l_partkey"), F.lit(60.0).alias("l_quantity"))
    cells = spark.range(3).select(F.lit("A").alias("l_returnflag"), (i * 4).alias("l_orderkey"), i.alias("l_suppkey"), i.alias("l_partkey"), F.lit(1000.0).alias("l_quantity"))
    drops.unionByName(cells).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert QUERIES["emptydrops_candidates"](spark, str(tmp_path)).count() == 20_500


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kmers_are_not_broadcast(spark, tmp_path):
    """The size of exploded k-mers is estimated as that of their references; they no join may have them on a side."""
    refs = spark.createDataFrame([(1, "ACGTTGCAAC" * 5), (2, "ACGTTGCAAC" * 4 + "G"), (3, "TTTTTTTTTTGGGGGGGGGGTTTTTTTTTTGGG"), (9, "TTTTTTTTTTGGGGGGGGGGTTTTTTTTTTGG")], "taxid long, sequence string")
    refs.write.parquet(f"{tmp_path}/refs")
    refs = spark.read.parquet(f"{tmp_path}/refs")
    paths = taxonomy.ancestors(spark.createDataFrame([(1, 5), (2, 5), (3, 6), (5, 7), (6, 7), (7, 7)], "taxid long, parent long"))
    known = taxonomy.kmer_taxa(refs, paths)
    assert "Join [kmer" not in _plan(known)
    kmer = lambda s: min(s, s[::-1].translate(str.maketrans("ACGT", "TGCA")))
    got = {r["kmer"]: r["taxid"] for r in known.collect()}
    assert got[kmer("ACGTTGCAAC" * 3 + "A")] == 5 and got[kmer("TTTTTTTTTTGGGGGGGGGGTTTTTTTTTTGGG"[-31:])] == 3
    assert kmer("TTTTTTTTTTGGGGGGGGGGTTTTTTTTTTG") not in got  # also of a taxon outside the tree
    assert got[kmer(("ACGTTGCAAC" * 4 + "G")[-31:])] == 2 and 7 not in got.values()


def test_molecules_are_dealt_by_their_number(spark):
    """More molecules make more tasks, not larger ones."""
    mols = spark.range(400).select((F.col("id") % 20).cast("string").alias("cell"), F.lit("g").alias("gene"), F.conv(F.col("id"), 10, 4).alias("umi"), F.lit(1).cast("long").alias("n_reads"))
    kept, umi.TASK_ROWS = getattr(umi, "TASK_ROWS", None), 10
    try:
        found = [umi.collapse_umis(mols, "1MM_CR"), umi.collapse_umis(mols, "1MM_All"), umi.filter_multigene_umis(mols)]
    finally:
        umi.TASK_ROWS = kept
    assert all("REPARTITION_BY_NUM" in _plan(df) and ", 40)" in _plan(df) for df in found)
    assert all(df.agg(F.sum("n_reads")).first()[0] == 400 for df in found)


def test_adapter_by_batches(spark):
    """The query's way of trimming against the plain expression, nulls and short reads included."""
    reads = spark.createDataFrame([("ACGTACGTTGCAGG",), ("TTTTACG",), ("TTTTAC",), ("AC",), ("",), (None,), ("GGNNACGTTGGA",)], "s string")
    both = reads.select(trim.single_cuts("ACGTTGCA", 3, 0.2)("s").alias("a"), seq.trim_adapter("s", "ACGTTGCA", 3, 0.2).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both] and both[5]["a"] is None


def test_indices_are_expanded_by_many_tasks(spark, sf):
    assert "REPARTITION_BY_NUM" in _plan(QUERIES["expand_indices"](spark, sf))


def test_a_sample_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """The ranges of one sample's pairs are tasks of their own; their parts are one file, in order and in step."""
    monkeypatch.setattr(fq_out, "TASK_PAIRS", 100, raising=False)
    text = lambda x: F.lit(x)
    df = spark.range(1000).select(
        F.col("id").alias("pair_id"), F.when(F.col("id") < 970, "a").alias("sample"), F.concat(F.lit("n"), "id").alias("name"), text("ACGT").alias("r1_seq"), text("IIII").alias("r1_qual"), text("AC").alias("r2_seq"), text("II").alias("r2_qual")
    )
    fq_out.write_fastq(df, str(tmp_path))
    for sample, want in (("a", range(970)), ("__HIVE_DEFAULT_PARTITION__", range(970, 1000))):
        for mate in ("R1", "R2"):
            (path,) = (tmp_path / f"sample={sample}" / f"mate={mate}" / "part=0").glob("*.gz")
            with storage.open_input(str(path)) as f:
                parts = [data for _, data in storage.pieces(f, storage.BLOCKS, 0)]
            assert b"".join(parts).decode() == gzip.open(path, "rt").read()
            assert b"".join(parts).decode().split("\n")[0:-1:4] == [f"@n{i}" for i in want]
            assert max(p.count(b"\n") for p in parts) < 4 * 500  # a member never holds rows of two tasks
    assert not list(tmp_path.glob("_writing*"))


def test_a_genome_is_not_broadcast(spark, monkeypatch):
    """A scan's rows are estimated by its few ranges; chunks that more ranges touch than a task takes are repeated."""
    monkeypatch.setattr(intervals, "CROWDED_BIN", 3)
    bases = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(60))
    chunks = intervals.chunk_contigs(spark.createDataFrame([("c1", bases), ("c2", bases[::-1])], "contig string, sequence string"), 10)
    at = [(f"r{i}", "c1" if i % 3 else "c2", 1 + i % 13, 9 + i % 29, "+", 1) for i in range(40)]
    got = intervals.extract_seqs(spark.createDataFrame(at, "id string, contig string, f_start int, f_end int, strand string, part int"), chunks, 10)
    assert "SortMergeJoin [contig" in _plan(got)
    want = {r[0]: (bases if r[1] == "c1" else bases[::-1])[r[2] - 1 : r[3]] for r in at}
    assert dict(map(tuple, got.collect())) == {k: v for k, v in want.items() if v}


def test_a_long_file_is_not_read_by_ever_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fastq, "MAX_SPANS", 5, raising=False)
    paths = [tmp_path / "R1", tmp_path / "R2"]
    for k, path in enumerate(paths, 1):
        path.write_text("".join(f"@r{i}\n{'ACGT' * 20 * k}\n+\n{'IIII' * 20 * k}\n" for i in range(9000)))
    pairs = fastq.read_fastq_multi(spark, [("s", "l", *paths)], ("r1", "r2"), split_bytes=65_536)
    assert pairs.rdd.getNumPartitions() == 5
    assert [(r["pair_id"], r["name"]) for r in pairs.orderBy("pair_id").collect()] == [(i, f"r{i}") for i in range(9000)]


def test_hits_are_dealt_by_reads(spark, monkeypatch):
    """More reads make more tasks, not larger ones; genes and levels are those of a plain search."""
    monkeypatch.setattr(intervals, "TASK_READS", 10, raising=False)
    rng = random.Random(4)
    exons = [(g, "c", g * 17 + 1 + k * 30, g * 17 + 1 + k * 30 + rng.randint(5, 25), rng.choice("+-")) for g in range(12) for k in range(2)]
    exons = [(g, c, a, b, exons[2 * g][4]) for g, c, a, b, _ in exons]
    reads = []
    for i in range(400):
        a = rng.randint(1, 250)
        reads.append((i, "c", rng.choice("+-"), [(a, a + 9), (a + 20, a + 20 + rng.randint(0, 12))]))
    e = spark.createDataFrame([(*x, f"t{x[0]}") for x in exons], "gene int, contig string, f_start int, f_end int, strand string, transcript string")
    r = spark.createDataFrame(reads, "read_id int, contig string, strand string, blocks array<struct<start:int,end:int>>")
    want = {}
    for i, _, strand, blocks in reads:
        bases = {p for a, b in blocks for p in range(a, b + 1)}
        inside = lambda g: {p for x in exons if x[0] == g for p in range(x[2], x[3] + 1)}
        body = lambda g: any(min(x[2] for x in exons if x[0] == g) <= b and a <= max(x[3] for x in exons if x[0] == g) for a, b in blocks)
        sense = [g for g in range(12) if exons[2 * g][4] == strand]
        one, two = [g for g in sense if 2 * len(bases & inside(g)) >= len(bases)], [g for g in sense if body(g)]
        against = any(bases <= inside(g) for g in range(12) if g not in sense)
        if one or two and not against:
            want[i] = (one, "exonic") if one else (two, "intronic")
    got = intervals.assign_genes(r, e, "GeneFull_Ex50pAS")
    assert got.rdd.getNumPartitions() >= 40 and intervals.assign_genes(r, e).rdd.getNumPartitions() >= 40
    assert {x["read_id"]: (x["genes"], x["level"]) for x in got.collect()} == want and {x[1] for x in want.values()} == {"exonic", "intronic"}
