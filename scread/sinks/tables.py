"""Writers of metrics tables, matrices, annotation and spliced-and-intron references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.tables import CANONICAL, order_metrics, stack_ragged
from ..plans.shared import written
from .files import write_one_file


def write_mapping_stats(rows: list[DataFrame], path: str) -> None:
    """Canonical columns, tab-separated, blanks for nulls, a header even without rows; one small file."""
    order_metrics(stack_ragged(rows, CANONICAL)).coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_cellreads_json(shares: DataFrame, path: str) -> None:
    """A JSON object per sample with its shares as percentages."""
    from ..functions.parse import to_pct

    names = [c for c in shares.columns if c != "sample"]
    shares.select(F.create_map("sample", F.struct(*[to_pct(c).alias(f"pct_{c}") for c in names])).alias("m")).select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


def mt_rrna_rows(counts: DataFrame, mito: DataFrame, rrna: DataFrame, gtf: str, ftype: str, contigs: str) -> DataFrame:
    """ord, Metric, Count: three parameters, then the metrics in their fixed order."""
    from ..functions.parse import ratio4

    c = counts.crossJoin(mito.drop("mapped")).crossJoin(rrna)  # one row each
    text = lambda n: F.col(n).cast("string")
    # The labels of the report.
    rows: list[tuple[str, Column]] = [
        ("GTF file", F.lit(gtf)),
        ("rRNA Grep command", F.lit(ftype)),
        ("MT Contig", F.lit(contigs)),
        ("Total number of mapped reads", text("mapped")),
        ("Total number of unmapped reads", text("unmapped")),
        ("Number of uniquely mapped reads", text("unique_alignments")),
        ("Number of ribosomal RNA reads in uniquely mapped reads", text("rrna")),
        ("Percentage of rRNA reads (of uniquely mapped reads)", ratio4("rrna", "unique_alignments")),
        ("Number of reads mapping to mtDNA contig", text("mt")),
        ("Percentage of mtDNA reads (of mapped reads)", ratio4("mt", "mapped")),
        ("Total multimapped reads (primary alignment)", text("multi_primary")),
        ("mtDNA counts in Multimapped reads (primary alignment)", text("mt_multi_primary")),
        ("Percentage of mtDNA in multimapped reads (primary alignment)", ratio4("mt_multi_primary", "multi_primary")),
        ("Total multimapped reads (all alignments)", text("multi_all")),
        ("mtDNA counts in Multimapped reads (all alignments)", text("mt_multi_all")),
        ("Percentage of mtDNA in multimapped reads (all alignments)", ratio4("mt_multi_all", "multi_all")),
    ]
    return c.select(F.posexplode(F.array(*[F.struct(F.lit(k).alias("Metric"), v.alias("Count")) for k, v in rows])).alias("ord", "r")).select("ord", "r.Metric", "r.Count")


def write_mt_rrna_metrics(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).sortWithinPartitions("ord").select("Metric", "Count").write.mode("overwrite").option("header", True).csv(path)


def _numbered(df: DataFrame, column: str, number: str) -> DataFrame:
    """Distinct values with their 1-based place in order, without one window over all rows.

    Values are range-partitioned; a place is the one inside a partition plus the sizes of those before it.
    """
    keys = written(df.select(column).distinct().repartitionByRange(column).withColumn("__p", F.spark_partition_id()), "keys")  # another run may cut its ranges elsewhere
    w = Window.partitionBy("__p").orderBy(column)
    keys = keys.withColumn("__i", F.row_number().over(w))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keys.groupBy("__p").agg(F.max("__i").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return written(keys.join(F.broadcast(sizes.select("__p", "__before")), "__p").select(column, (F.col("__i") + F.col("__before")).alias(number)), "numbered")


def write_mtx(counts: DataFrame, path: str, compress: bool = False) -> None:
    """matrix.mtx, features.tsv and barcodes.tsv, a file each (with .gz, block-compressed), in coordinate order by cell, then gene."""
    end, counts = ".gz" if compress else "", written(counts, "counts")
    genes, barcodes = _numbered(counts, "gene", "g"), _numbered(counts, "cell", "c")
    body = counts.join(genes, "gene").join(barcodes, "cell").select(F.col("g").cast("long").alias("g"), F.col("c").cast("long").alias("c"), "umis")
    text = lambda df, at, column: df.repartitionByRange(at).sortWithinPartitions(at).select(F.col(column).cast("string").alias("value"))
    write_one_file(text(genes, "g", "gene"), f"{path}/features.tsv{end}")
    write_one_file(text(barcodes, "c", "cell"), f"{path}/barcodes.tsv{end}")
    lines = body.repartitionByRange("c", "g").sortWithinPartitions("c", "g").select(F.concat_ws(" ", "g", "c", "umis").alias("value"))
    write_one_file(lines, f"{path}/matrix.mtx{end}", f"%%MatrixMarket matrix coordinate real general\n{genes.count()} {barcodes.count()} {{rows}}\n")


def write_splici(seqs: DataFrame, t2g: DataFrame, path: str) -> None:
    """FASTA text and the two maps: transcript to gene, and with the splicing status."""
    write_one_file(seqs.select(F.concat(F.lit(">"), "id", F.lit("\n"), "sequence").alias("value")), f"{path}/transcriptome_splici.fa")
    t2g.select("transcript_id", "gene_id", "status").write.mode("overwrite").option("sep", "\t").csv(f"{path}/t2g_3col.tsv")
    two = F.when(F.col("status") == "U", F.concat("gene_id", F.lit("-U"))).otherwise(F.col("gene_id"))
    t2g.select("transcript_id", two.alias("gene_id")).write.mode("overwrite").option("sep", "\t").csv(f"{path}/t2g.tsv")


def _escaped(text: Column) -> Column:
    """A GFF attribute value; the characters that end or part values are percent escapes."""
    for c in "%;=&,\t\n":
        text = F.replace(text, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return text


def write_gtf(features: DataFrame, path: str) -> None:
    """Features (contig, source, ftype, f_start, f_end, strand, gene, transcript) as one GTF or GFF3 file (by extension) in coordinate order.

    In a GFF3 file genes and transcripts (``gene`` features, and mRNA or transcript features) have IDs, other features have
    their transcript, else their gene, as parent.
    """
    gene, transcript = F.col("gene").cast("string"), F.col("transcript").cast("string")
    gff = any(path.removesuffix(".gz").endswith(x) for x in (".gff", ".gff3"))
    if gff:
        g, t = F.concat(F.lit("gene:"), _escaped(gene)), F.concat(F.lit("transcript:"), _escaped(transcript))
        kind = F.col("ftype")
        attrs = (
            F.when(kind == "gene", F.concat(F.lit("ID="), g, F.lit(";gene_id="), _escaped(gene)))
            .when(kind.isin("mRNA", "transcript"), F.concat(F.lit("ID="), t, F.lit(";Parent="), g, F.lit(";transcript_id="), _escaped(transcript)))
            .when(transcript.isNotNull(), F.concat(F.lit("Parent="), t))
            .otherwise(F.concat(F.lit("Parent="), g))
        )
    else:
        attrs = F.concat(F.lit('gene_id "'), gene, F.lit('";'), F.when(transcript.isNotNull(), F.concat(F.lit(' transcript_id "'), transcript, F.lit('";'))).otherwise(""))
    line = F.concat_ws("\t", "contig", F.coalesce("source", F.lit(".")), "ftype", F.col("f_start").cast("string"), F.col("f_end").cast("string"), F.lit("."), "strand", F.lit("."), attrs)
    ordered = features.repartitionByRange("contig", "f_start").sortWithinPartitions("contig", "f_start", F.desc("f_end"))
    write_one_file(ordered.select(line.alias("value")), path, "##gff-version 3\n" if gff else "")
