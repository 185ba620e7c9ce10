"""Readers of per-sample result files. Each takes a glob over all samples and gives one frame.

``sample`` is taken from the path by a pattern with one group. Metrics come in long form
(sample, software, metric, num, txt); ``wide`` pivots them to the canonical columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import clean_float, clean_int, first_truthy, to_pct, unwrap_js
from ..operators.tables import CANONICAL

LONG = ["sample", "software", "metric", "num", "txt"]
# Labels of the aligner's final log, and whether the value is a number or text.
STAR_LOG = {
    "Number of input reads": ("N reads/sample", True),
    "Uniquely mapped reads number": ("N uniquely mapped reads", True),
    "Uniquely mapped reads %": ("% uniquely mapped reads", False),
    "% of reads mapped to multiple loci": ("% multi-mapped reads", False),
    "% of reads mapped to too many loci": ("% multi-mapped reads: too many", False),
    "% of reads unmapped: too short": ("% unmapped: too short", False),
    "% of reads unmapped: other": ("% unmapped: other", False),
}
# Fields of the counting summary; {mode} is the gene mode.
STAR_SUMMARY = {
    "Q30 Bases in CB+UMI": "Q30 Bases in CB+UMI",
    "Q30 Bases in RNA read": "Q30 Bases in RNA read",
    "Sequencing Saturation": "Saturation",
    "Mean Reads per Cell": "Mean Reads per Cell",
    "Median UMI per Cell": "Median UMI Counts per Cell",
    "Median {mode} per Cell": "Median Genes per Cell",
    "Total {mode} Detected": "Total Genes Detected",
}
# Positions of the vendor's metrics line.
CELLRANGER = {0: "N cells", 1: "Mean Reads per Cell", 2: "Median Genes per Cell", 3: "N reads/sample", 6: "Saturation", 8: "N R1 >Q30", 11: "% uniquely mapped reads", 18: "Total Genes Detected", 19: "Median UMI Counts per Cell"}
# Synonyms of the per-cell table's columns.
CELL_META = {
    "reads": ["n_frags", "n_fragments", "n_frag", "nCount_RNA", "n_reads", "reads"],
    "umis": ["nUMI", "n_umi", "umis", "UMI", "nCount_UMI"],
    "genes": ["nGene", "n_genes", "genes", "nGenes"],
}
# Region fields of the combinatorial run's report.
SCI_REGIONS = {
    "total_exonic_reads": "% exonic reads",
    "total_intronic_reads": "% Intronic reads",
    "total_intergenic_reads": "% intergenic reads",
    "total_mitochondrial_reads": "% mtDNA in Unique reads",
    "total_exonicAS_reads": "% exonicAS reads",
    "total_intronicAS_reads": "% intronicAS reads",
}
# Gene modes, the preferred one first.
MODES = ["GeneFull_Ex50pAS", "Gene"]


def _sample(pattern: str) -> Column:
    return F.regexp_extract(F.col("path"), pattern, 1).alias("sample")


def _lines(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob).select(F.input_file_name().alias("path"), "value")


def _whole(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), "value")


def _long(df: DataFrame, software: str) -> DataFrame:
    return df.select("sample", F.lit(software).alias("software"), "metric", F.col("num").cast("double").alias("num"), F.col("txt").cast("string").alias("txt"))


def _unpivot(df: DataFrame, software: str, columns: dict[str, Column], text: tuple[str, ...] = ()) -> DataFrame:
    """One long row per column that is not null."""
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), (F.lit(None) if k in text else v).cast("double").alias("num"), (v if k in text else v.cast("bigint")).cast("string").alias("txt")) for k, v in columns.items()])
    return _long(df.select("sample", F.inline(pairs)).filter("coalesce(txt, '') <> ''"), software)


def read_star_log_final(spark: SparkSession, glob: str, sample: str = r"/([^/]+)/[^/]*Log\.final\.out") -> DataFrame:
    """The seven labelled lines; the value is the last word."""
    labels = spark.createDataFrame([(k, m, n) for k, (m, n) in STAR_LOG.items()], "label string, metric string, is_num boolean")
    rows = _lines(spark, glob).withColumn("text", F.trim(F.substring_index("value", "|", 1))).withColumn("word", F.element_at(F.split(F.trim("value"), r"\s+"), -1))
    hit = rows.join(F.broadcast(labels), F.col("text") == F.col("label"))
    num = F.when(F.col("is_num"), clean_int("word").cast("double")).otherwise(clean_float("word"))
    return _long(hit.select(_sample(sample), "metric", num.alias("num"), F.when(F.col("is_num"), clean_int("word").cast("string")).otherwise(F.col("word")).alias("txt")), "STARsolo")


def read_star_summary(spark: SparkSession, glob: str, mode: str, sample: str = r"/([^/]+)/[^/]*Solo\.out/") -> DataFrame:
    """Fields of the counting summary for a gene mode; every value is parsed as a number, shares become percentages."""
    names = spark.createDataFrame([(k.format(mode=mode), v) for k, v in STAR_SUMMARY.items()], "label string, metric string")
    raw = _lines(spark, glob).select(_sample(sample), F.substring_index("value", ",", 1).alias("label"), F.substring_index("value", ",", -1).try_cast("double").alias("num"))
    share = F.col("metric").contains("Q30") | (F.col("metric") == "Saturation")
    return _long(raw.join(F.broadcast(names), "label").select("sample", "metric", "num", F.when(share, to_pct("num")).otherwise(F.col("num").cast("bigint").cast("string")).alias("txt")), "STARsolo")


def read_umi_cutoff(spark: SparkSession, glob: str, mode: str, sample: str = r"/([^/]+)/[^/]*Log\.out") -> DataFrame:
    """The first nUMImin of a cell-filtering line inside the block of the gene mode."""
    block = F.regexp_extract("value", rf"(?s)Starting Solo post-map for {mode}\b(.*?)(?=Starting Solo post-map for|\z)", 1)
    cut = F.regexp_extract(block, r"cellFiltering[^\n]*?nUMImin=(\d+)", 1).try_cast("bigint")
    return _unpivot(_whole(spark, glob).select(_sample(sample), cut.alias("v")), "STARsolo", {"UMI cutoff used for cell calling": F.col("v")})


def read_cell_stats(spark: SparkSession, glob: str, sample: str = r"/([^/]+)/[^/]*Solo\.out/") -> DataFrame:
    """Per-barcode read statistics: sample, cell and the numeric columns."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(glob)
    first = raw.columns[0]
    return raw.select(F.input_file_name().alias("path"), "*").select(_sample(sample), F.col(f"`{first}`").alias("cell"), *[F.col(f"`{c}`").cast("long").alias(c) for c in raw.columns[1:]])


def read_scirocket_qc(spark: SparkSession, glob: str) -> DataFrame:
    """One row per sample of ``var data = {...};`` files."""
    kinds = "total_reads double, sequencing_saturation double, estimated_cells double, mean_reads_per_cell double, perc_unique_reads_genome_unique double, " + ", ".join(f"{k} double" for k in SCI_REGIONS)
    data = _whole(spark, glob).select(F.from_json(unwrap_js("value"), f"struct<sample_succes:map<string,struct<{kinds.replace(' double', ':double')}>>>").alias("d"))
    rows = data.select(F.explode("d.sample_succes").alias("sample", "s")).select("sample", "s.*")
    total = sum((F.coalesce(F.col(k), F.lit(0.0)) for k in SCI_REGIONS), F.lit(0.0))
    shares = {m: F.when(total > 0, to_pct(F.coalesce(F.col(k), F.lit(0.0)) / total)) for k, m in SCI_REGIONS.items()}
    texts = {"Saturation": F.when(F.col("sequencing_saturation").isNotNull(), to_pct("sequencing_saturation")), "% uniquely mapped reads": F.when(F.col("perc_unique_reads_genome_unique").isNotNull(), to_pct("perc_unique_reads_genome_unique")), **shares}
    return _unpivot(rows, "sci-rocket", {"N reads/sample": F.col("total_reads"), "N cells": F.col("estimated_cells"), "Mean Reads per Cell": F.col("mean_reads_per_cell"), **texts}, tuple(texts))


# The names under which totals occur.
_SALMON = "num_processed long, num_fragments long, num_reads long, num_mapped long, num_mapped_fragments long, mapped long"


def read_salmon_meta(spark: SparkSession, glob: str, sample: str) -> DataFrame:
    """Total and mapped reads under any of their names, and their share."""
    j = _whole(spark, glob).select(_sample(sample), F.from_json("value", _SALMON).alias("j")).select("sample", "j.*")
    total, mapped = first_truthy("num_processed", "num_fragments", "num_reads"), first_truthy("num_mapped", "num_mapped_fragments", "mapped")
    share = F.when(total.isNotNull() & mapped.isNotNull(), to_pct(F.try_divide(mapped.cast("double"), total)))
    return _unpivot(j, "alevin-fry", {"N reads/sample": total, "N uniquely mapped reads": mapped, "% uniquely mapped reads": share}, ("% uniquely mapped reads",))


def read_alevin_quant(spark: SparkSession, glob: str, sample: str) -> DataFrame:
    j = _whole(spark, glob).select(_sample(sample), F.from_json("value", "num_quantified_cells long, num_genes long").alias("j"))
    return _unpivot(j, "alevin-fry", {"N cells": F.col("j.num_quantified_cells"), "Total Genes Detected": F.col("j.num_genes")})


def read_cell_meta(spark: SparkSession, glob: str, sample: str) -> DataFrame:
    """sample, reads, umis, genes per cell: of each, the first synonym that the file's own header has.

    Files are grouped by their headers, so tables of several makes can be under one glob.
    """
    lines = spark.read.text(glob).filter("value <> '' and not startswith(value, '#')").select(F.input_file_name().alias("path"), F.monotonically_increasing_id().alias("at"), "value")
    head = lines.groupBy("path").agg(F.min_by("value", "at").alias("head"), F.min("at").alias("first"))  # a row per file
    cols = F.split("value", "\t")
    body = lines.join(head, "path").filter("at <> first").withColumn("names", F.split("head", "\t"))
    places = {k: F.coalesce(*[F.nullif(F.array_position("names", n), F.lit(0)) for n in names]).cast("int") for k, names in CELL_META.items()}
    return body.select(_sample(sample), *[F.get(cols, at - 1).try_cast("double").alias(k) for k, at in places.items()])


def read_parsebio_stats(spark: SparkSession, report_glob: str, agg_glob: str, sample: str) -> DataFrame:
    """Two headerless metric,value files per sample."""

    def wide(glob: str, names: list[str]) -> DataFrame:
        kv = _lines(spark, glob).select(_sample(sample), F.substring_index("value", ",", 1).alias("k"), clean_int(F.expr("substring(value, length(substring_index(value, ',', 1)) + 2)")).alias("v"))
        return kv.groupBy("sample").pivot("k", names).agg(F.first("v"))

    a = wide(report_glob, ["reads_align_input", "reads_align_unique", "reads_align_multimap", "number_of_cells"])
    share = lambda c: F.when(F.col(c).isNotNull(), to_pct(F.try_divide(F.col(c).cast("double"), F.col("reads_align_input"))))
    texts = {"% uniquely mapped reads": share("reads_align_unique"), "% multi-mapped reads": share("reads_align_multimap")}
    one = _unpivot(a, "ParseBio", {"N reads/sample": F.col("reads_align_input"), "N cells": F.col("number_of_cells"), **texts}, tuple(texts))
    b = wide(agg_glob, ["mean_reads_per_cell", "ref-splitpipe_median_tscp_per_cell", "ref-splitpipe_median_genes_per_cell"])
    names = {"Mean Reads per Cell": "mean_reads_per_cell", "Median UMI Counts per Cell": "ref-splitpipe_median_tscp_per_cell", "Median Genes per Cell": "ref-splitpipe_median_genes_per_cell"}
    return one.unionByName(_unpivot(b, "ParseBio", {k: F.col(f"`{v}`") for k, v in names.items()}))


def read_cellranger_metrics(spark: SparkSession, glob: str, sample: str) -> DataFrame:
    """The metrics line by position; quoted thousands are parsed as numbers."""
    raw = spark.read.option("header", True).option("quote", '"').csv(glob)
    cols = [F.col(f"`{c}`") for c in raw.columns]
    decimal = (6, 8, 11)
    df = raw.select(F.input_file_name().alias("path"), *[c.alias(f"c{i}") for i, c in enumerate(cols)]).withColumn("sample", _sample(sample))
    pairs = [F.struct(F.lit(m).alias("metric"), (clean_float(f"c{i}") if i in decimal else clean_int(f"c{i}").cast("double")).alias("num"), (clean_float(f"c{i}").cast("string") if i in decimal else clean_int(f"c{i}").cast("string")).alias("txt")) for i, m in CELLRANGER.items() if i < len(cols)]
    return _long(df.select("sample", F.inline(F.array(*pairs))).filter("txt is not null"), "CellRanger")


def discover_results(spark: SparkSession, root: str, candidates: list[str], sample: str) -> DataFrame:
    """sample, path: of the ranked file-name patterns the first that exists below ``root`` for each sample.

    A missing root gives no rows. Only paths are read.
    """
    from pyspark.errors import AnalysisException

    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    except AnalysisException:
        return spark.createDataFrame([], "sample string, path string")
    rank = F.coalesce(*[F.when(F.col("path").rlike(c), i) for i, c in enumerate(candidates)])
    found = files.withColumn("rank", rank).filter("rank is not null").withColumn("sample", _sample(sample)).filter("sample <> ''")
    return found.groupBy("sample").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def choose_gene_mode(spark: SparkSession, root: str, sample: str) -> DataFrame:
    """sample, mode: the full gene mode where its folder exists, else the plain one."""
    d = discover_results(spark, root, [rf"/{m}/" for m in MODES], sample)
    return d.select("sample", F.when(F.col("path").contains(f"/{MODES[0]}/"), MODES[0]).otherwise(MODES[1]).alias("mode"))


def metrics_long(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def wide(long: DataFrame) -> DataFrame:
    """One row per sample and tool with the canonical columns as text; metrics outside them are left out."""
    names = CANONICAL[2:]
    p = long.filter(F.col("metric").isin(names)).groupBy("sample", "software").pivot("metric", names).agg(F.first("txt"))
    # a sample without any known metric keeps its row
    p = long.select("sample", "software").distinct().join(p, ["sample", "software"], "left")
    return p.select(F.col("sample").alias("Sample"), F.col("software").alias("Software"), *[F.col(f"`{c}`") for c in names])
