import gzip
import json

from conftest import rows
from pyspark.sql import functions as F

from scread.operators import align, intervals, match, tables
from scread.sinks import fastq as fq_out
from scread.sinks import tables as t_out
from scread.sources import fastq, metrics
from scread.sources import tables as t_in


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_fastq_round_trip(spark, tmp_path):
    record = lambda i, s: f"@r{i} 1:N:0:AC+GT\n{s}\n+\n{'I' * len(s)}\n"
    r1 = put(tmp_path / "x_R1.fastq.gz", "".join(record(i, "ACGT" * (1 + i % 3)) for i in range(50)))
    r2 = put(tmp_path / "x_R2.fastq.gz", "".join(record(i, "TTGA" * (1 + i % 4)) for i in range(49)))
    sheet = put(tmp_path / "s.csv", f"sample,fastq_cDNA,fastq_BC_UMI,fastq_indices,expected_cells,p5,p7,rt\ns1,{r2},{r1},,100,,,\n")
    samples = t_in.read_samplesheet(spark, sheet)
    assert samples.first()["expected_cells"] == 100 and samples.first()["p5"] == "" and samples.first()["fastq_indices"] == []
    pairs = fastq.read_fastq_pairs(spark, samples)
    assert pairs.count() == 49
    fq_out.write_fastq(pairs, str(tmp_path / "out"), files=2)
    files = []
    for part in (0, 1):
        one, two = (next((tmp_path / "out" / "sample=s1" / f"mate={m}" / f"part={part}").glob("*.gz")) for m in ("R1", "R2"))
        files.append(("s1", str(part), str(one), str(two)))
    again = fastq.read_fastq_multi(spark, files, ("r1", "r2"))
    cols = ["name", "comment", "r1_seq", "r1_qual", "r2_seq", "r2_qual"]
    assert rows(again.select(cols)) == rows(pairs.select(cols))
    four = fastq.read_fastq_multi(spark, [("s", "0", r1, r2, r1, r2)], ("r1", "r2", "i1", "i2"))
    assert "i2_qual" in four.columns and four.count() == 49


def test_sheets_and_lists(spark, tmp_path):
    wl = put(tmp_path / "wl.csv", "bci,sequence,uid,well,stype\n1,acgt,u,a1,T\n2,ACGT,u,A2,T\n3,,u,A3,T\n4,GGGG,u\n")
    assert rows(t_in.read_well_whitelist(spark, wl)) == [("ACGT", "A2")]
    a, b = put(tmp_path / "a.txt.gz", "AC\nGT\n"), put(tmp_path / "b.txt", "TT\n")
    assert rows(t_in.read_whitelist(spark, [a, b])) == [(1, "AC"), (1, "GT"), (2, "TT")]
    bc = put(tmp_path / "b.tsv", "type\tbarcode\tsequence\np5\tZ01\tACGT\np5\tA01\tACGT\n")
    assert rows(t_in.read_barcodes(spark, bc)) == [("p5", "A01", "ACGT", 3), ("p5", "Z01", "ACGT", 2)]
    assert rows(match.sheet_keys(t_in.read_barcodes(spark, bc))) == [("ACGT", "A01")]
    h = put(tmp_path / "h.tsv", "hash_name\tbarcode\nh1\tACGT\n")
    s = spark.createDataFrame([("s1", h), ("s1", "other"), ("s2", None)], "sample_name string, hashing string")
    assert rows(t_in.read_hash_sheets(spark, s)) == [("s1", "h1", "ACGT")]


def test_alignments_annotation_genome(spark, tmp_path):
    sam = put(tmp_path / "a.sam", "@HD\tVN:1\nr1\t16\tchr1\t10\t255\t5M2N5M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\tNH:i:1\tAS:i:40\tCB:Z:AC:GT\tUB:Z:-\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    a = {r["read_name"]: r for r in t_in.read_alignments(spark, sam).collect()}
    assert a["r1"]["nh"] == 1 and a["r1"]["cb"] == "AC:GT" and a["r1"]["ub"] is None and a["r1"]["end_pos"] == 21
    assert [tuple(b) for b in a["r1"]["blocks"]] == [(10, 14), (17, 21)] and a["r2"]["contig"] is None
    fq_out.write_unmapped_fasta(t_in.read_alignments(spark, sam), str(tmp_path / "un"))
    assert spark.read.text(str(tmp_path / "un")).count() == 2
    gtf = put(tmp_path / "a.gtf", '#c\nchr1\tx\texon\t1\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; note "a b";\n')
    f = t_in.read_annotation(spark, gtf)
    assert f.first()["gene"] == "g1" and f.first()["attrs"]["note"] == "a b"
    t_out.write_gtf(f, str(tmp_path / "gtf"))
    assert spark.read.text(str(tmp_path / "gtf")).first()[0] == 'chr1\tx\texon\t1\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1";'
    lines = ["gene\tID=gene:1;gene_id=G1;Note=a%3Bb+c", "mRNA\tID=t1;Parent=gene:1;transcript_id=T1", "mRNA\tID=t2;Parent=gene:1", "exon\tID=e1;Parent=t1,t2", "CDS\tParent=t2", "exon\tParent=t9", "gene\tID=g2", "exon\tID=e2;Parent=g2", "rRNA\tID=r3;Parent=g2", "region\tName=x"]
    gff = put(tmp_path / "a.gff3", "##gff-version 3\n" + "".join(f"chr1\tx\t{k}\t{i}\t9\t.\t+\t.\t{a}\n" for i, (k, a) in enumerate((x.split("\t") for x in lines), 1)))
    back = t_in.read_annotation(spark, gff)
    want = [(1, "gene", "G1", None), (2, "mRNA", "G1", "T1"), (3, "mRNA", "G1", "t2"), (4, "exon", "G1", "T1"), (4, "exon", "G1", "t2"), (5, "CDS", "G1", "t2"), (6, "exon", "t9", None), (7, "gene", "g2", None), (8, "exon", "g2", None), (9, "rRNA", "g2", "r3"), (10, "region", None, None)]
    assert rows(back.select("f_start", "ftype", "gene", "transcript")) == sorted(want, key=str)
    assert back.filter("f_start = 1").first()["attrs"]["Note"] == "a;b+c"
    again = back.filter("f_start < 6").withColumn("gene", F.when(F.col("gene") == "G1", "G;1=a").otherwise(F.col("gene")))
    t_out.write_gtf(again, str(tmp_path / "b.gff3"))
    cols = ["ftype", "f_start", "gene", "transcript"]
    assert (tmp_path / "b.gff3").read_text().startswith("##gff-version 3\nchr1\tx\tgene\t1\t9\t.\t+\t.\tID=gene:G%3B1%3Da;")
    assert rows(t_in.read_annotation(spark, str(tmp_path / "b.gff3")).select(cols)) == rows(again.select(cols))
    fa = put(tmp_path / "a.fa", ">c1 desc\nACGT\nAC\n>c2\nTT\n")
    assert rows(t_in.read_fasta(spark, fa)) == [("c1", "ACGTAC"), ("c2", "TT")]


def test_matrix_round_trip(spark, tmp_path):
    c = spark.createDataFrame([("d", "c1", "g1", 2), ("d", "c1", "g2", 1), ("d", "c2", "g1", 5)], "dataset string, cell string, gene string, umis int")
    t_out.write_mtx(c, str(tmp_path / "m"))
    t_out.write_mtx(c, str(tmp_path / "z"), compress=True)
    want = "%%MatrixMarket matrix coordinate real general\n2 2 3\n1 1 2\n2 1 1\n1 2 5\n"
    assert (tmp_path / "m" / "matrix.mtx").read_text() == want == gzip.open(tmp_path / "z" / "matrix.mtx.gz", "rt").read()
    assert (tmp_path / "m" / "features.tsv").read_text() == "g1\ng2\n" and gzip.open(tmp_path / "z" / "barcodes.tsv.gz", "rt").read() == "c1\nc2\n"
    for folder in ("m", "z"):
        assert rows(t_in.read_mtx(spark, str(tmp_path / folder), "d")) == [("d", "c1", "g1", 2.0), ("d", "c1", "g2", 1.0), ("d", "c2", "g1", 5.0)]
        assert sorted(p.name for p in (tmp_path / folder).iterdir() if not p.name.startswith(".")) == [f"{n}{'.gz' * (folder == 'z')}" for n in ("barcodes.tsv", "features.tsv", "matrix.mtx")]


def test_metrics_tree(spark, tmp_path):
    root = tmp_path / "out"
    star = root / "star"
    put(star / "s1" / "s1_Log.final.out", "  Number of input reads |\t1000\n  Uniquely mapped reads number |\t800\n  Uniquely mapped reads % |\t80.00%\n  % of reads mapped to multiple loci |\t5.00%\n")
    put(star / "s1" / "s1_Solo.out" / "GeneFull_Ex50pAS" / "Summary.csv", "Q30 Bases in CB+UMI,0.951\nSequencing Saturation,0.5\nMean Reads per Cell,12\nMedian GeneFull_Ex50pAS per Cell,7\n")
    put(star / "s1" / "s1_Solo.out" / "Gene" / "Summary.csv", "Q30 Bases in CB+UMI,0.9\n")
    put(star / "s1" / "s1_Log.out", "Starting Solo post-map for Gene\ncellFiltering nUMImin=5\nStarting Solo post-map for GeneFull_Ex50pAS\nx\n cellFiltering: nUMImin=42 \n")
    put(star / "s1" / "s1_Solo.out" / "GeneFull_Ex50pAS" / "CellReads.stats", "CB\tcbMatch\tgenomeU\tgenomeM\texonic\tintronic\texonicAS\tintronicAS\tmito\nCBnotInPasslist\t10\t0\t0\t0\t0\t0\t0\t0\nAC\t30\t15\t5\t10\t4\t1\t1\t2\n")
    g = str(star / "*" / "*Log.final.out")
    long = metrics.metrics_long(metrics.read_star_log_final(spark, g), metrics.read_star_summary(spark, str(star / "*" / "*Solo.out" / "GeneFull_Ex50pAS" / "Summary.csv"), "GeneFull_Ex50pAS"), metrics.read_umi_cutoff(spark, str(star / "*" / "*_Log.out"), "GeneFull_Ex50pAS"))
    w = metrics.wide(long).first()
    assert w["N reads/sample"] == "1000" and w["% uniquely mapped reads"] == "80.00%" and w["Q30 Bases in CB+UMI"] == "95.10%" and w["Median Genes per Cell"] == "7" and w["UMI cutoff used for cell calling"] == "42"
    assert rows(metrics.choose_gene_mode(spark, str(star), r"/star/([^/]+)/")) == [("s1", "GeneFull_Ex50pAS")]
    assert metrics.discover_results(spark, str(root / "nothing"), ["x"], "(.*)").count() == 0
    stats = metrics.read_cell_stats(spark, str(star / "*" / "*Solo.out" / "GeneFull_Ex50pAS" / "CellReads.stats"))
    sh = tables.cellread_shares(stats, spark.createDataFrame([("s1", "AC")], "sample string, cell string")).first()
    assert sh["noise"] == 0.25 and sh["exonic"] == 0.5 and sh["intergenic"] == 0.2
    t_out.write_cellreads_json(tables.cellread_shares(stats, spark.createDataFrame([("s1", "AC")], "sample string, cell string")), str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first()[0])["s1"]["pct_exonic"] == "50.00%"

    put(root / "sci" / "qc.js", 'var data = {"sample_succes": {"a": {"total_reads": 10, "sequencing_saturation": 0.25, "total_exonic_reads": 3, "total_intronic_reads": 1}}};')
    sci = metrics.wide(metrics.read_scirocket_qc(spark, str(root / "sci" / "*.js"))).first()
    assert (sci["Sample"], sci["N reads/sample"], sci["Saturation"], sci["% exonic reads"], sci["% exonicAS reads"]) == ("a", "10", "25.00%", "75.00%", "0.00%")
    put(root / "al" / "x" / "meta_info.json", '{"num_processed": 0, "num_fragments": 200, "num_mapped": 50}')
    put(root / "al" / "x" / "quant.json", '{"num_quantified_cells": 7, "num_genes": 9}')
    put(root / "al" / "x" / "cell_meta.tsv", "#c\nbc\tn_reads\tn_umi\tnGene\nA\t10\t4\t2\nB\t20\t6\t3\n")
    al = metrics.wide(metrics.metrics_long(metrics.read_salmon_meta(spark, str(root / "al" / "*" / "meta_info.json"), r"/al/([^/]+)/"), metrics.read_alevin_quant(spark, str(root / "al" / "*" / "quant.json"), r"/al/([^/]+)/"))).first()
    assert (al["N reads/sample"], al["% uniquely mapped reads"], al["N cells"], al["Total Genes Detected"]) == ("200", "25.00%", "7", "9")
    assert rows(tables.cell_meta_summary(metrics.read_cell_meta(spark, str(root / "al" / "*" / "cell_meta.tsv"), r"/al/([^/]+)/"))) == [("x", 2, 15, 5, 2)]
    put(root / "pb" / "p1" / "r.csv", 'reads_align_input,1000\nreads_align_unique,"500"\nreads_align_multimap,100\nnumber_of_cells,20\n'.replace('"', ""))
    put(root / "pb" / "p1" / "a.csv", "mean_reads_per_cell,50\nref-splitpipe_median_tscp_per_cell,30\n")
    pb = metrics.wide(metrics.read_parsebio_stats(spark, str(root / "pb" / "*" / "r.csv"), str(root / "pb" / "*" / "a.csv"), r"/pb/([^/]+)/")).first()
    assert (pb["% uniquely mapped reads"], pb["% multi-mapped reads"], pb["Median UMI Counts per Cell"]) == ("50.00%", "10.00%", "30")
    put(root / "cr" / "c1" / "m.csv", ",".join(f"h{i}" for i in range(20)) + '\n"1,234",5,6,"7,000",x,x,50.5%,x,90%,x,x,88.8%,x,x,x,x,x,x,99,11\n')
    cr = metrics.wide(metrics.read_cellranger_metrics(spark, str(root / "cr" / "*" / "m.csv"), r"/cr/([^/]+)/")).first()
    assert (cr["N cells"], cr["N reads/sample"], cr["Saturation"], cr["Total Genes Detected"], cr["Median UMI Counts per Cell"]) == ("1234", "7000", "50.5", "99", "11")
    t_out.write_mapping_stats([metrics.wide(long), metrics.wide(metrics.read_scirocket_qc(spark, str(root / "sci" / "*.js")))], str(tmp_path / "stats"))
    text = next((tmp_path / "stats").glob("part-*")).read_text().split("\n")
    assert text[0].split("\t")[:3] == ["Sample", "Software", "N reads/sample"] and len(text[1].split("\t")) == 28 and text[2].startswith("a\tsci-rocket")
    rep = put(root / "k" / "report.tsv", "10.0\t5\t5\t0\t0\tU\t0\tunclassified\n90.0\t45\t1\t3\t2\tR\t1\troot\n80.0\t40\t40\t3\t2\tD\t2\t  Bacteria\n")
    assert [(r["taxid"], r["parent"], r["reads"]) for r in t_in.read_taxonomy_report(spark, rep).orderBy("line_no").collect()] == [(0, None, 5), (1, None, 1), (2, 1, 40)]


def test_mt_rrna_report(spark, tmp_path, sf):
    from scread.plans.fixtures import fixture

    a, f = fixture(spark, sf, "fx_alignments"), fixture(spark, sf, "fx_features")
    r = t_out.mt_rrna_rows(align.alignment_counts(a), align.mito_shares(a), intervals.rrna_share(a, f), "x.gtf", "rRNA", "chrM M MT")
    t_out.write_mt_rrna_metrics(r, str(tmp_path / "m"))
    lines = next((tmp_path / "m").glob("part-*")).read_text().strip().split("\n")
    assert len(lines) == 17 and lines[0] == "Metric,Count" and lines[4].endswith(",799")


def test_streaming_demux(spark, tmp_path, sf):
    from scread.operators import sci
    from scread.plans.fixtures import fixture
    from scread.streaming.demux import stream_demux

    reads, b, s = (fixture(spark, sf, n) for n in ("fx_reads", "fx_barcodes", "fx_samples"))
    reads.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(reads.schema).parquet(str(tmp_path / "in"))
    q = stream_demux(stream, b, s).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    want = sci.sci_demux(reads, b, s)
    assert rows(out.select("pair_id", "cell")) == rows(want.select("pair_id", "cell"))
    kept, lost = sci.split_assigned(want)
    assert kept.count() + lost.count() == reads.count() == want.agg(F.count("*")).first()[0]
