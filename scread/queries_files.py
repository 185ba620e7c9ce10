"""Queries of readers and writers: a derived table is written in a format, read back and compared with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import align, cells, intervals, sci, tables, umi
from .plans.shared import folder, written
from .queries import DEMUX, _CELLS, _exons, _fx, alignments, barcodes, counts, demuxed, features, query, reads, samples
from .queries_columns import _SPLICI, _genome
from .sinks import fastq as fq_out
from .sinks import tables as t_out
from .sinks.files import write_one_file
from .sources import fastq, metrics
from .sources import tables as t_in

runs = _fx("fx_runs")
IN_PATH = r"/sample=([^/]+)/"


def _per_sample(df: DataFrame, name: str, value, sample: str = "sample") -> str:
    """A text file per sample below a new folder; returns the folder."""
    path = folder(df.sparkSession, name)
    df.select(F.col(sample).cast("string").alias("sample"), value.alias("value")).repartition("sample").write.partitionBy("sample").text(path)
    return path


def _lines(*parts) -> F.Column:
    """Text lines of strings and columns; a tuple is one line."""
    col = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    return F.concat_ws("\n", *[F.concat(*map(col, p)) if isinstance(p, tuple) else col(p) for p in parts])


def _long_sql(software: str, rows: list[tuple[str, str, str]]) -> str:
    """Long metric rows of fx_runs from (metric, number, text) expressions."""
    return " UNION ALL ".join(f"SELECT sample, '{software}' AS software, '{m}' AS metric, CAST({n} AS DOUBLE) AS num, CAST({t} AS VARCHAR) AS txt FROM fx_runs" for m, n, t in rows)


def _pct(x: str) -> str:
    return f"printf('%.2f%%', ({x})*100)"


# ---- reads --------------------------------------------------------------------------------------------------

@query("fastq_round_trip", "SELECT CASE WHEN pair_id%3=0 THEN 'S_A' ELSE 'S_B' END AS sample, name, comment, r1_seq, r2_seq, repeat('I', length(r1_seq)) AS r1_qual FROM fx_reads")
def fastq_round_trip(spark, d):
    """Pairs are written as gzip FASTQ per sample in two file pairs and read back as pairs in step."""
    path = folder(spark, "fastq")
    pairs = reads(spark, d).withColumn("sample", F.when(F.col("pair_id") % 3 == 0, "S_A").otherwise("S_B"))
    pairs = pairs.withColumns({f"{m}_qual": F.repeat(F.lit("I"), F.length(f"{m}_seq")) for m in ("r1", "r2")})
    fq_out.write_fastq(pairs, path, files=2)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(path).select("path").collect()  # a line per file
    files: dict[tuple, dict[str, str]] = {}
    for r in found:
        keys = dict(x.split("=", 1) for x in r["path"].split("/") if "=" in x)
        files.setdefault((keys["sample"], keys["part"]), {})[keys["mate"]] = r["path"]
    back = fastq.read_fastq_multi(spark, [(s, p, m["R1"], m["R2"]) for (s, p), m in sorted(files.items())], ("r1", "r2"))
    return back.select("sample", "name", "comment", "r1_seq", "r2_seq", "r1_qual")


@query("fastq_split_scan", "SELECT row_number() OVER (ORDER BY pair_id)-1 AS pair_id, name, comment, r1_seq, repeat('I', length(r1_seq)) AS r1_qual, r2_seq FROM fx_reads")
def fastq_split_scan(spark, d):
    """One plain and one block-compressed file, records of different lengths, read by many tasks in step."""
    path = folder(spark, "split")
    pairs = reads(spark, d)
    files = []
    for mate, end in (("r1", ""), ("r2", ".gz")):
        line = F.concat_ws("\n", F.concat(F.lit("@"), F.concat_ws(" ", "name", "comment")), F.col(f"{mate}_seq"), F.lit("+"), F.repeat(F.lit("I"), F.length(f"{mate}_seq")))
        files.append(f"{path}/{mate}.fastq{end}")
        write_one_file(pairs.repartitionByRange("pair_id").sortWithinPartitions("pair_id").select(line.alias("value")), files[-1])
    back = fastq.read_fastq_multi(spark, [("s", "l", *files)], ("r1", "r2"), split_bytes=100_000)
    return back.select("pair_id", "name", "comment", "r1_seq", "r1_qual", "r2_seq")


@query("segment_whitelists", """SELECT CASE type WHEN 'ligation' THEN 1 WHEN 'p5' THEN 2 WHEN 'p7' THEN 3 ELSE 4 END AS segment, CASE WHEN type='ligation' AND length(sequence)=9 THEN concat(sequence,'G') ELSE sequence END AS sequence FROM fx_barcodes""")
def segment_whitelists(spark, d):
    path = folder(spark, "whitelists")
    fq_out.write_segment_whitelists(barcodes(spark, d), path)
    return t_in.read_whitelist(spark, [f"{path}/type={k}" for k in ("ligation", "p5", "p7", "rt")])


@query("barcode_sheet", "SELECT type, barcode, sequence FROM fx_barcodes")
def barcode_sheet(spark, d):
    path = folder(spark, "barcodes")
    barcodes(spark, d).write.option("sep", "\t").option("header", True).csv(path)
    return t_in.read_barcodes(spark, path).select("type", "barcode", "sequence")


@query("sample_sheet", "SELECT concat('S',cast(c_custkey AS VARCHAR)) AS sample_name, concat('r2_',cast(c_custkey AS VARCHAR)) AS fastq_cdna, concat('r1_',cast(c_custkey AS VARCHAR)) AS fastq_bc_umi, CASE WHEN c_nationkey%2=0 THEN cast(c_nationkey*100 AS VARCHAR) END AS expected_cells, CASE WHEN c_nationkey%3=0 THEN 'A01:H01' ELSE '' END AS p5, '' AS p7, '' AS rt FROM customer")
def sample_sheet(spark, d):
    path, c = folder(spark, "samples"), spark.read.parquet(f"{d}/customer.parquet")
    key, n = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    sheet = c.select(
        F.concat(F.lit("S"), key).alias("sample"), F.concat(F.lit("r2_"), key).alias("fastq_cDNA"), F.concat(F.lit("r1_"), key).alias("fastq_BC_UMI"),
        F.when(n % 2 == 0, (n * 100).cast("string")).otherwise("many").alias("expected_cells"), F.when(n % 3 == 0, "A01:H01").alias("p5"),
    )
    sheet.write.option("header", True).csv(path)
    return t_in.samples_for(t_in.read_samplesheet(spark, path))


@query("well_whitelist", "SELECT substr(translate(md5(cast(p_partkey AS VARCHAR)),'0123456789abcdef','ACGTACGTACGTACGT'),1,5) AS sequence, concat('W',cast(max(p_partkey) AS VARCHAR)) AS well FROM part WHERE p_partkey%7<>0 GROUP BY 1")
def well_whitelist(spark, d):
    """Lower-case sequences, lines without a sequence and duplicates: the last wins."""
    p = spark.read.parquet(f"{d}/part.parquet")
    tag = F.substring(F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "acgtACGTACGTACGT"), 1, 5)
    line = F.concat_ws(",", F.lit("1"), F.when(F.col("p_partkey") % 7 == 0, "").otherwise(tag), F.lit("u"), F.concat(F.lit("w"), F.col("p_partkey")), F.lit("T"))
    sheet = p.select(F.col("p_partkey").alias("k"), line.alias("value")).unionByName(p.agg(F.min("p_partkey") - 1).toDF("k").select("k", F.lit("bci,sequence,uid,well,stype").alias("value")))
    path = folder(spark, "wells")
    sheet.repartition(1).sortWithinPartitions("k").select("value").write.text(path)  # a plate's sheet is one small file
    return t_in.read_well_whitelist(spark, path)


@query("hash_sheets", "SELECT sample AS sample_name, b.barcode AS hash_name, b.sequence AS barcode FROM fx_samples, fx_barcodes b WHERE b.type=CASE sample WHEN 'S_A' THEN 'p5' ELSE 'p7' END")
def hash_sheets(spark, d):
    path, b = folder(spark, "hashes"), barcodes(spark, d)
    for name, kind in (("S_A", "p5"), ("S_B", "p7")):
        b.filter(F.col("type") == kind).select(F.col("barcode").alias("hash_name"), F.col("sequence").alias("barcode")).write.option("sep", "\t").option("header", True).csv(f"{path}/{name}")
    sheet = samples(spark, d).select(F.col("sample").alias("sample_name"), F.concat(F.lit(f"{path}/"), "sample").alias("hashing"))
    return t_in.read_hash_sheets(spark, sheet)


# ---- alignments, annotation, matrices ---------------------------------------------------------------------------

def _sam(spark, d) -> DataFrame:
    path, a = folder(spark, "sam"), alignments(spark, d)
    unmapped = ~align.lacks_flags(4)
    fields = [
        F.concat(F.lit("r"), "pair_id"), F.col("flag"), F.when(unmapped, "*").otherwise(F.col("contig")), F.when(unmapped, 0).otherwise(F.col("pos")), F.lit("255"), F.when(unmapped, "*").otherwise("40M10N41M"),
        F.lit("*"), F.lit("0"), F.lit("0"), F.repeat(F.lit("A"), (F.col("as_score") % 5 + 1).cast("int")), F.repeat(F.lit("I"), (F.col("as_score") % 5 + 1).cast("int")),
        F.concat(F.lit("NH:i:"), "nh"), F.concat(F.lit("AS:i:"), "as_score"), F.concat(F.lit("CB:Z:"), "cb"), F.lit("UB:Z:-"),
    ]
    a.select(F.concat_ws("\t", *[x.cast("string") for x in fields]).alias("value")).write.text(path)
    return t_in.read_alignments(spark, path)


@query("sam_round_trip", """SELECT concat('r',cast(pair_id AS VARCHAR)) AS read_name, flag, CASE WHEN flag&4=0 THEN contig END AS contig, nh, as_score, cb, CASE WHEN flag&4=0 THEN pos+90 END AS end_pos,
 CASE WHEN flag&4=0 THEN concat(pos,'-',pos+39,',',pos+50,'-',pos+90) END AS blocks FROM fx_alignments""")
def sam_round_trip(spark, d):
    blocks = F.array_join(F.transform("blocks", lambda b: F.concat(b["start"], F.lit("-"), b["end"])), ",")
    return _sam(spark, d).select("read_name", "flag", "contig", "nh", "as_score", "cb", "end_pos", blocks.alias("blocks"))


@query("unmapped_fasta", "SELECT concat('r',cast(pair_id AS VARCHAR)) AS contig, repeat('A',as_score%5+1) AS sequence FROM fx_alignments WHERE flag&4<>0")
def unmapped_fasta(spark, d):
    path = folder(spark, "fasta")
    fq_out.write_unmapped_fasta(_sam(spark, d), path)
    return t_in.read_fasta(spark, path)


@query("gtf_round_trip", "SELECT contig, 'x' AS source, ftype, f_start, f_end, strand, cast(gene AS VARCHAR) AS gene, CASE WHEN gene%3=0 THEN concat('t',cast(gene AS VARCHAR)) END AS transcript FROM fx_features")
def gtf_round_trip(spark, d):
    path = folder(spark, "annotation") + ".gtf"
    f = features(spark, d).withColumns({"source": F.lit("x"), "transcript": F.when(F.col("gene") % 3 == 0, F.concat(F.lit("t"), "gene"))})
    t_out.write_gtf(f, path)
    return t_in.read_annotation(spark, path).select("contig", "source", "ftype", "f_start", "f_end", "strand", "gene", "transcript")


_GFF = """SELECT 'gene' AS ftype, contig, f_start, f_end, strand, concat('g',gene) AS gene, NULL AS transcript FROM fx_features
 UNION ALL SELECT 'mRNA', contig, f_start, f_end, strand, concat('g',gene), concat('t',gene,',',k) FROM fx_features, range(2) r(k) WHERE gene%5<>0
 UNION ALL SELECT 'exon', contig, f_start, f_start+9, strand, concat('g',gene), concat('t',gene,',',k) FROM fx_features, range(2) r(k) WHERE gene%5<>0
 UNION ALL SELECT 'exon', contig, f_start, f_start+9, strand, concat('g',gene), NULL FROM fx_features WHERE gene%5=0"""


@query("gff_round_trip", _GFF)
def gff_round_trip(spark, d):
    """Genes, transcripts (with a comma in their names) and exons, some of them below the gene itself, as GFF3."""
    f = features(spark, d).withColumns({"source": F.lit("x"), "g": F.concat(F.lit("g"), "gene")})
    two = F.array(*[F.concat(F.lit("t"), "gene", F.lit(f",{k}")) for k in (0, 1)])
    under = f.filter("gene % 5 <> 0").withColumn("transcript", F.explode(two))
    bare = f.withColumn("transcript", F.lit(None).cast("string"))
    short = lambda df: df.withColumns({"ftype": F.lit("exon"), "f_end": F.col("f_start") + 9})
    every = bare.withColumn("ftype", F.lit("gene")).unionByName(under.withColumn("ftype", F.lit("mRNA"))).unionByName(short(under)).unionByName(short(bare.filter("gene % 5 = 0")))
    path = f"{folder(spark, 'gff')}/x.gff3.gz"
    t_out.write_gtf(every.withColumn("gene", F.col("g")), path)
    return t_in.read_annotation(spark, path).select("ftype", "contig", "f_start", "f_end", "strand", "gene", "transcript")


@query("gff_exon_overlap", "WITH g AS (" + _GFF + """) SELECT pair_id, gene, count(DISTINCT transcript) AS transcripts FROM fx_alignments a JOIN g ON a.contig=g.contig AND pos<=f_end AND f_start<=end_pos WHERE flag&4=0 AND ftype='exon' GROUP BY 1, 2""")
def gff_exon_overlap(spark, d):
    """Alignments by the genes of the exons of a GFF file."""
    exons = written(gff_round_trip(spark, d).filter("ftype = 'exon'").select("contig", "f_start", "f_end", "gene", "transcript"), "exons")  # counted, then joined
    mapped = alignments(spark, d).filter(align.lacks_flags(4)).select("pair_id", "contig", "pos", "end_pos")
    return intervals.overlap_join(mapped, exons).groupBy("pair_id", "gene").agg(F.count_distinct("transcript").alias("transcripts"))


@query("mtx_round_trip", "SELECT dataset, cast(cell AS VARCHAR) AS cell, cast(gene AS VARCHAR) AS gene, cast(umis AS DOUBLE) AS umis FROM fx_counts")
def mtx_round_trip(spark, d):
    path, c = folder(spark, "matrix"), counts(spark, d)
    back = []
    for name in ("A", "N", "R"):
        t_out.write_mtx(c.filter(F.col("dataset") == name), f"{path}/{name}")
        back.append(t_in.read_mtx(spark, f"{path}/{name}", name))
    return tables.gather(*back)


@query("taxonomy_report", """WITH own AS (SELECT n_regionkey, n_nationkey, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey=n_nationkey GROUP BY 1, 2), t AS (SELECT sum(n) AS t FROM own)
 SELECT 100+n_nationkey AS taxid, 10+n_regionkey AS parent, 2 AS depth, n AS clade_reads, n AS reads FROM own
 UNION ALL SELECT 10+n_regionkey, 1, 1, CAST(sum(n) AS BIGINT), 0 FROM own GROUP BY n_regionkey UNION ALL SELECT 1, NULL, 0, CAST(t AS BIGINT), 0 FROM t""")
def taxonomy_report(spark, d):
    n, c = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("nation", "customer"))
    own = n.join(c, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_regionkey", "n_nationkey").agg(F.count("c_custkey").alias("n"))
    row = lambda taxid, depth, clade, reads, order: F.struct(order.alias("o"), F.concat_ws("\t", F.lit("1.0"), clade.cast("string"), reads.cast("string"), F.lit("3"), F.lit("2"), F.lit("R"), taxid.cast("string"), F.concat(F.lit("  " * depth), F.lit("t"), taxid.cast("string"))).alias("value")).alias("r")
    r, k, zero = F.col("n_regionkey"), F.col("n_nationkey"), F.lit(0)
    rows = tables.union_all(
        own.select(row(k + 100, 2, F.col("n"), F.col("n"), r * 1000 + k + 2)),
        own.groupBy("n_regionkey").agg(F.sum("n").alias("n")).select(row(r + 10, 1, F.col("n"), zero, r * 1000 + 1)),
        own.agg(F.sum("n").alias("n")).select(row(F.lit(1), 0, F.col("n"), zero, F.lit(-1).cast("long"))),
    )
    path = folder(spark, "taxa")
    rows.repartition(1).sortWithinPartitions("r.o").select("r.value").write.text(path)  # a report is one small file
    return t_in.read_taxonomy_report(spark, path).select("taxid", "parent", "depth", "clade_reads", "reads")


# ---- metrics of other tools --------------------------------------------------------------------------------------

@query("star_log_final", _long_sql("STARsolo", [("N reads/sample", "n*1000", "n*1000"), ("% uniquely mapped reads", "n*0.5", "concat(n*0.5,'%')"), ("N uniquely mapped reads", "n*7", "n*7")]).replace("concat(n*0.5,'%')", "printf('%.1f%%', n*0.5)"))
def star_log_final(spark, d):
    n = F.col("n")
    path = _per_sample(runs(spark, d), "star-log", _lines(("   Number of input reads |\t", n * 1000), "  Unrelated |\t5", ("  Uniquely mapped reads % |\t", F.format_string("%.1f%%", n * 0.5)), (" Uniquely mapped reads number |\t", n * 7)))
    return metrics.read_star_log_final(spark, path, IN_PATH)


@query("star_summary", _long_sql("STARsolo", [("Saturation", "sat", _pct("sat")), ("Mean Reads per Cell", "n*3", "n*3"), ("Median Genes per Cell", "n+1", "n+1")]))
def star_summary(spark, d):
    n = F.col("n")
    path = _per_sample(runs(spark, d), "star-summary", _lines(("Sequencing Saturation,", F.col("sat")), "Unknown,1", ("Mean Reads per Cell,", n * 3), ("Median Gene per Cell,", n + 1)))
    return metrics.read_star_summary(spark, path, "Gene", IN_PATH)


@query("umi_cutoff", "SELECT sample, 'STARsolo' AS software, 'UMI cutoff used for cell calling' AS metric, CAST(n+2 AS DOUBLE) AS num, CAST(n+2 AS VARCHAR) AS txt FROM fx_runs")
def umi_cutoff(spark, d):
    n = F.col("n")
    path = _per_sample(runs(spark, d), "umi-cutoff", _lines("Starting Solo post-map for GeneFull_Ex50pAS", ("cellFiltering: nUMImin=", n + 9), "Starting Solo post-map for Gene", "x", (" cellFiltering: nUMImin=", n + 2)))
    return metrics.read_umi_cutoff(spark, path, "Gene", IN_PATH)


@query("cell_stats", "SELECT cast(c_nationkey AS VARCHAR) AS sample, cast(c_custkey AS VARCHAR) AS cell, c_custkey*3 AS \"cbMatch\", c_custkey%5 AS exonic FROM customer")
def cell_stats(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    path, k = folder(spark, "cell-stats"), F.col("c_custkey")
    c.select(F.col("c_nationkey").alias("sample"), k.alias("CB"), (k * 3).alias("cbMatch"), (k % 5).alias("exonic")).write.partitionBy("sample").option("sep", "\t").option("header", True).csv(path)
    return metrics.read_cell_stats(spark, f"{path}/sample=*", IN_PATH)


@query("scirocket_report", _long_sql("sci-rocket", [("N reads/sample", "n*10", "n*10"), ("Saturation", "NULL", _pct("sat")), ("% exonic reads", "NULL", _pct("n/(n+5.0)")), ("% Intronic reads", "NULL", _pct("5.0/(n+5)")), ("% intergenic reads", "NULL", "'0.00%'"), ("% mtDNA in Unique reads", "NULL", "'0.00%'"), ("% exonicAS reads", "NULL", "'0.00%'"), ("% intronicAS reads", "NULL", "'0.00%'")]))
def scirocket_report(spark, d):
    n = F.col("n")
    one = F.concat(F.lit('"'), "sample", F.lit('": {"total_reads": '), (n * 10).cast("string"), F.lit(', "sequencing_saturation": '), F.col("sat").cast("string"), F.lit(', "total_exonic_reads": '), n.cast("string"), F.lit(', "total_intronic_reads": 5}'))
    r = runs(spark, d).groupBy(F.lit("all").alias("sample")).agg(F.concat(F.lit('var data = {"sample_succes": {'), F.array_join(F.collect_list(one), ", "), F.lit("}};")).alias("v"))
    return metrics.read_scirocket_qc(spark, _per_sample(r, "sci", F.col("v")))


@query("salmon_meta", _long_sql("alevin-fry", [("N reads/sample", "n*20", "n*20"), ("N uniquely mapped reads", "n*5", "n*5"), ("% uniquely mapped reads", "NULL", "'25.00%'")]))
def salmon_meta(spark, d):
    n = F.col("n")
    v = F.concat(F.lit('{"num_processed": 0, "num_fragments": '), n * 20, F.lit(', "num_mapped": '), n * 5, F.lit("}"))
    return metrics.read_salmon_meta(spark, _per_sample(runs(spark, d), "salmon", v), IN_PATH)


@query("alevin_quant", _long_sql("alevin-fry", [("N cells", "n", "n"), ("Total Genes Detected", "n+3", "n+3")]))
def alevin_quant(spark, d):
    v = F.concat(F.lit('{"num_quantified_cells": '), F.col("n"), F.lit(', "num_genes": '), F.col("n") + 3, F.lit("}"))
    return metrics.read_alevin_quant(spark, _per_sample(runs(spark, d), "alevin", v), IN_PATH)


@query("cell_meta_tables", """WITH c AS (SELECT cast(c_nationkey AS VARCHAR) AS sample, cast(c_custkey AS DOUBLE) AS reads, cast(c_custkey%7 AS DOUBLE) AS umis, CASE WHEN c_nationkey%2=0 THEN cast(c_custkey%3 AS DOUBLE) END AS genes FROM customer)
 SELECT sample, count(*) AS n_cells, CAST(round_even(avg(reads),0) AS BIGINT) AS mean_reads_per_cell, CAST(round_even(median(umis),0) AS BIGINT) AS median_umi_per_cell, CAST(round_even(median(genes),0) AS BIGINT) AS median_genes_per_cell FROM c GROUP BY 1""")
def cell_meta_tables(spark, d):
    """Tables of two makes: each file's own header names its columns."""
    c, path = spark.read.parquet(f"{d}/customer.parquet"), folder(spark, "cell-meta")
    k = F.col("c_custkey")
    for even, names in ((True, ("n_reads", "nUMI", "nGene")), (False, ("UMI", "n_frags", None))):
        part = c.filter((F.col("c_nationkey") % 2 == 0) == even)
        cols = {"n_reads": k, "nUMI": k % 7, "nGene": k % 3, "UMI": k % 7, "n_frags": k}
        part.select(F.col("c_nationkey").alias("sample"), k.alias("bc"), *[cols[x].alias(x) for x in names if x]).write.mode("append").partitionBy("sample").option("sep", "\t").option("header", True).csv(path)
    return tables.cell_meta_summary(metrics.read_cell_meta(spark, f"{path}/sample=*", IN_PATH))


@query("parsebio_stats", _long_sql("ParseBio", [("N reads/sample", "n*1000", "n*1000"), ("% uniquely mapped reads", "NULL", "'50.00%'"), ("% multi-mapped reads", "NULL", "'10.00%'"), ("N cells", "n", "n"), ("Mean Reads per Cell", "n*2", "n*2"), ("Median UMI Counts per Cell", "n+1", "n+1")]))
def parsebio_stats(spark, d):
    n, r = F.col("n"), runs(spark, d)
    report = _per_sample(r, "parse-report", _lines(("reads_align_input,", n * 1000), ("reads_align_unique,", n * 500), ("reads_align_multimap,", n * 100), ("number_of_cells,", n)))
    agg = _per_sample(r, "parse-agg", _lines(("mean_reads_per_cell,", n * 2), ("ref-splitpipe_median_tscp_per_cell,", n + 1)))
    return metrics.read_parsebio_stats(spark, report, agg, IN_PATH)


@query("cellranger_metrics", _long_sql("CellRanger", [("N cells", "n+1000", "n+1000"), ("Mean Reads per Cell", "n", "n"), ("N reads/sample", "n*7000", "n*7000")]))
def cellranger_metrics(spark, d):
    """Counts with thousands separators inside quotes."""
    n = F.col("n")
    quoted = lambda x: F.concat(F.lit('"'), F.format_number(x, 0), F.lit('"'))
    v = _lines("cells,mean,genes,reads", F.concat_ws(",", quoted(n + 1000), n.cast("string"), F.lit("x"), quoted(n * 7000)))
    return metrics.read_cellranger_metrics(spark, f"{_per_sample(runs(spark, d), 'cellranger', v)}/sample=*", IN_PATH)


@query("results_found", "SELECT sample, CASE WHEN n%2=0 THEN 'full' ELSE 'plain' END AS kind FROM fx_runs")
def results_found(spark, d):
    """Of two ranked patterns the first that a sample has."""
    path, r = folder(spark, "results"), runs(spark, d)
    for kind, part in (("plain", r), ("full", r.filter("n % 2 = 0"))):
        part.select("sample", F.lit(kind).alias("kind"), F.lit("x").alias("value")).write.mode("append").partitionBy("sample", "kind").text(path)
    found = metrics.discover_results(spark, path, ["/kind=full/", "/kind=plain/"], IN_PATH)
    return found.select("sample", F.regexp_extract("path", "/kind=([^/]+)/", 1).alias("kind"))


@query("gene_mode", "SELECT sample, CASE WHEN n%2=0 THEN 'GeneFull_Ex50pAS' ELSE 'Gene' END AS mode FROM fx_runs")
def gene_mode(spark, d):
    path, r = folder(spark, "modes"), runs(spark, d)
    for mode, part in (("Gene", r), ("GeneFull_Ex50pAS", r.filter("n % 2 = 0"))):
        part.select("sample", F.lit("x").alias("value")).write.partitionBy("sample").text(f"{path}/{mode}")
    return metrics.choose_gene_mode(spark, path, IN_PATH)


# ---- writers ----------------------------------------------------------------------------------------------------

@query("qc_tables", DEMUX + "SELECT split_part(rtn,'-',1) AS plate, split_part(rtn,'-',2) AS well, count(*) AS pairs FROM dm WHERE sample_name IS NOT NULL GROUP BY 1, 2")
def qc_tables(spark, d):
    path = folder(spark, "qc")
    fq_out.write_qc_tables({"rt_plate_usage": sci.rt_plate_usage(demuxed(spark, d))}, path)
    return spark.read.parquet(f"{path}/rt_plate_usage")


@query("mapping_stats", """SELECT row_number() OVER (ORDER BY o, sample) AS place, sample AS "Sample", software AS "Software", cells AS "N cells", sat AS "Saturation", columns FROM (
 SELECT 0 AS o, sample, 'STARsolo' AS software, CAST(n AS VARCHAR) AS cells, NULL AS sat, 28 AS columns FROM fx_runs UNION ALL SELECT 4, sample, 'alevin-fry', NULL, '5.00%', 28 FROM fx_runs)""")
def mapping_stats(spark, d):
    """The collated table as written: canonical columns, tools in order, blanks for what a tool lacks."""
    path, r = folder(spark, "mapping"), runs(spark, d)
    one = r.select(F.col("sample").alias("Sample"), F.lit("alevin-fry").alias("Software"), F.lit("5.00%").alias("Saturation"))
    two = r.select(F.col("sample").alias("Sample"), F.lit("STARsolo").alias("Software"), F.col("n").alias("N cells"), F.lit("x").alias("other"))
    t_out.write_mapping_stats([one, two], path)
    lines = t_in.numbered_lines(spark, path).filter("line_no > 1")
    f = F.split("value", "\t", -1)
    blank = lambda i: F.nullif(F.get(f, F.lit(i)), F.lit(""))
    return lines.select((F.col("line_no") - 1).cast("long").alias("place"), blank(0).alias("Sample"), blank(1).alias("Software"), blank(12).alias("N cells"), blank(14).alias("Saturation"), F.size(f).alias("columns"))


@query("cellreads_json", "SELECT sample, " + _pct("n/(n+3.0)") + " AS pct_exonic FROM fx_runs")
def cellreads_json(spark, d):
    path = folder(spark, "cellreads")
    t_out.write_cellreads_json(runs(spark, d).select("sample", (F.col("n") / (F.col("n") + 3)).alias("exonic")), path)
    return spark.read.text(path).select(F.explode(F.from_json("value", "map<string,struct<pct_exonic:string>>")).alias("sample", "v")).select("sample", "v.pct_exonic")


@query("mt_rrna_report", """WITH a AS (SELECT count(*) FILTER (flag&4=0) AS mapped, count(*) FILTER (flag&4<>0) AS unmapped, count(*) FILTER (flag&4=0 AND nh=1) AS uniq, count(*) FILTER (flag&4=0 AND contig IN ('chrM','M','MT')) AS mt FROM fx_alignments)
 SELECT 'Total number of mapped reads' AS metric, cast(mapped AS VARCHAR) AS "count" FROM a UNION ALL SELECT 'Total number of unmapped reads', cast(unmapped AS VARCHAR) FROM a UNION ALL SELECT 'Number of uniquely mapped reads', cast(uniq AS VARCHAR) FROM a
 UNION ALL SELECT 'Number of reads mapping to mtDNA contig', cast(mt AS VARCHAR) FROM a UNION ALL SELECT 'Percentage of mtDNA reads (of mapped reads)', printf('%.4f', mt/mapped) FROM a UNION ALL SELECT 'GTF file', 'x.gtf'""")
def mt_rrna_report(spark, d):
    path, a = folder(spark, "mt-rrna"), alignments(spark, d)
    t_out.write_mt_rrna_metrics(t_out.mt_rrna_rows(align.alignment_counts(a), align.mito_shares(a), intervals.rrna_share(a, features(spark, d)), "x.gtf", "rRNA", "chrM M MT"), path)
    names = ["GTF file", "Total number of mapped reads", "Total number of unmapped reads", "Number of uniquely mapped reads", "Number of reads mapping to mtDNA contig", "Percentage of mtDNA reads (of mapped reads)"]
    return spark.read.option("header", True).csv(path).filter(F.col("Metric").isin(names)).toDF("metric", "count")


@query("called_matrix", _CELLS + """, r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY umis DESC, cell) AS n, count(*) OVER (PARTITION BY dataset) AS a FROM c),
 t AS (SELECT dataset, CAST(greatest(1,round(umis/1.02)) AS BIGINT) AS threshold FROM r WHERE n=least(a-1,cast(round(2000*0.01) as int))+1) SELECT cast(x.cell AS VARCHAR) AS cell, cast(x.gene AS VARCHAR) AS gene, cast(x.umis AS DOUBLE) AS umis FROM fx_counts x JOIN c USING (dataset, cell) JOIN t USING (dataset) WHERE x.dataset='A' AND c.umis>=threshold""")
def called_matrix(spark, d):
    """Cells called by quantile, and their counts written as a matrix and read back."""
    c = counts(spark, d)
    called = cells.call_cells_quantile(cells.cell_summary(c), 2000, ratio=1.02).filter("dataset = 'A'")
    path = folder(spark, "called")
    t_out.write_mtx(tables.restrict_cells(c.filter("dataset = 'A'"), called), path)
    return t_in.read_mtx(spark, path, "A").select("cell", "gene", "umis")


# ---- whole runs -------------------------------------------------------------------------------------------------

@query("demux_experiment", DEMUX + "SELECT s.sample, count(dm.pair_id) AS pairs, count(dm.pair_id) AS written FROM fx_samples s LEFT JOIN dm ON dm.sample_name=s.sample GROUP BY s.sample")
def demux_experiment(spark, d):
    """A run from sheets and FASTQ files to written reads and QC tables: pairs counted by the run and found in its files."""
    from .plans import runs as whole

    path, r = folder(spark, "experiment"), reads(spark, d)
    r = r.withColumns({f"{m}_qual": F.repeat(F.lit("I"), F.length(f"{m}_seq")) for m in ("r1", "r2")}).withColumn("sample", F.lit("all"))
    fq_out.write_fastq(r, f"{path}/in")
    found = sorted(x["path"] for x in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(f"{path}/in").select("path").collect())  # a line per file
    one, two = (next(x for x in found if f"mate={m}" in x) for m in ("R1", "R2"))
    s = samples(spark, d)
    # the files belong to the first sample's line; the others add their indices only
    sheet = s.select("sample", F.when(F.col("sample") == "S_A", two).alias("fastq_cDNA"), F.when(F.col("sample") == "S_A", one).alias("fastq_BC_UMI"), "p5", "p7", "rt")
    sheet.write.option("header", True).csv(f"{path}/sheet")
    barcodes(spark, d).write.option("header", True).option("sep", "\t").csv(f"{path}/barcodes")
    qc = whole.demultiplex(spark, f"{path}/sheet", f"{path}/barcodes", f"{path}/out", partitions=8)
    written = spark.read.text(f"{path}/out/fastq").filter("mate = 'R1'").groupBy("sample").agg((F.count(F.lit(1)) / 4).cast("long").alias("written"))
    return qc["samples"].join(written, "sample", "left").select("sample", "pairs", F.coalesce("written", F.lit(0)).alias("written"))


@query("count_run", """WITH n AS (SELECT a.cell, a.gene, a.umi, a.n_reads, max(struct_pack(r := b.n_reads, u := b.umi)) AS best FROM fx_molecules a LEFT JOIN fx_molecules b ON a.cell=b.cell AND a.gene=b.gene AND hamming(a.umi,b.umi)=1 GROUP BY ALL),
 t AS (SELECT cell, gene, CASE WHEN best.r IS NOT NULL AND (best.r>n_reads OR (best.r=n_reads AND best.u>umi)) THEN best.u ELSE umi END AS umi, n_reads FROM n), m AS (SELECT cell, gene, umi, sum(n_reads) AS n_reads FROM t GROUP BY 1,2,3),
 w AS (SELECT *, max(n_reads) OVER (PARTITION BY cell, umi) AS top FROM m), k AS (SELECT *, count(*) FILTER (n_reads=top) OVER (PARTITION BY cell, umi) AS ties FROM w) SELECT cell, gene, cast(count(*) AS DOUBLE) AS umis FROM k WHERE n_reads=top AND ties=1 GROUP BY 1, 2""")
def count_run(spark, d):
    """Tagged reads to a written matrix, read back."""
    from .plans import runs as whole

    m = _fx("fx_molecules")(spark, d)
    path = folder(spark, "counts")
    whole.count(m.select("cell", "gene", "umi", F.explode(F.sequence(F.lit(1), F.col("n_reads").cast("int"))).alias("read")), 20, path, "d")
    return t_in.read_mtx(spark, f"{path}/raw", "d").select("cell", "gene", "umis")


@query("collated_metrics", """SELECT sample AS "Sample", software AS "Software", reads AS "N reads/sample", cells AS "N cells" FROM (SELECT sample, 'STARsolo' AS software, cast(n*1000 AS VARCHAR) AS reads, NULL AS cells FROM fx_runs UNION ALL SELECT sample, 'alevin-fry', NULL, cast(n AS VARCHAR) FROM fx_runs)""")
def collated_metrics(spark, d):
    from .plans import runs as whole

    n, r = F.col("n"), runs(spark, d)
    star = _per_sample(r, "collate-star", _lines(("Number of input reads |\t", n * 1000)))
    alevin = _per_sample(r, "collate-alevin", F.concat(F.lit('{"num_quantified_cells": '), n, F.lit("}")))
    readers = [
        (star, lambda s, g: metrics.read_star_log_final(s, g, IN_PATH)), (alevin, lambda s, g: metrics.read_alevin_quant(s, g, IN_PATH)),
        (f"{star}-none", lambda s, g: metrics.read_salmon_meta(s, g, IN_PATH)),
    ]
    return whole.collate_metrics(spark, readers, folder(spark, "collated")).select("Sample", "Software", "N reads/sample", "N cells")


@query("splici_files", _SPLICI + """ z AS (SELECT id, CASE strand WHEN '-' THEN reverse(translate(q,'ACGT','TGCA')) ELSE q END AS sequence FROM p),
 t AS (SELECT DISTINCT cast(transcript AS VARCHAR) AS transcript_id, cast(gene AS VARCHAR) AS gene_id, 'S' AS status FROM ex UNION ALL SELECT id, cast(gene AS VARCHAR), 'U' FROM u)
 SELECT 'fasta' AS kind, id AS name, sequence AS value, NULL AS status FROM z UNION ALL SELECT 't2g_3col', transcript_id, gene_id, status FROM t UNION ALL SELECT 't2g', transcript_id, CASE status WHEN 'U' THEN concat(gene_id,'-U') ELSE gene_id END, NULL FROM t""")
def splici_files(spark, d):
    """The spliced-and-intron reference as files: FASTA and both maps."""
    path = folder(spark, "splici")
    exons = _exons(spark, d).withColumn("transcript", F.col("transcript").cast("string"))
    t_out.write_splici(*intervals.splici(exons, _genome(spark, d), 10, 5), path)
    maps = {n: spark.read.option("sep", "\t").csv(f"{path}/{n}.tsv") for n in ("t2g_3col", "t2g")}
    row = lambda df, kind, status: df.select(F.lit(kind).alias("kind"), df[df.columns[0]].alias("name"), df[df.columns[1]].alias("value"), status.alias("status"))
    none = F.lit(None).cast("string")
    return tables.union_all(row(t_in.read_fasta(spark, f"{path}/transcriptome_splici.fa"), "fasta", none), row(maps["t2g_3col"], "t2g_3col", F.col("_c2")), row(maps["t2g"], "t2g", none))


@query("demux_stream", DEMUX + "SELECT pair_id, sample_name, CASE WHEN sample_name IS NOT NULL THEN concat(p7q,p5q,ligq,CASE WHEN length(ligq)=9 THEN 'G' ELSE '' END,rtq) END AS cell FROM dm")
def demux_stream(spark, d):
    """Reads that arrive as a stream of files, all that are there."""
    from .streaming.demux import stream_demux

    path, r = folder(spark, "stream"), reads(spark, d)
    r.repartition(4).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    out = stream_demux(stream, barcodes(spark, d), samples(spark, d)).select("pair_id", "sample_name", "cell")
    out.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return spark.read.parquet(f"{path}/out")
