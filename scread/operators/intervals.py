"""Genomic intervals: overlap joins by bins, merging, introns, spliced-and-intron references, 3' extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import revcomp
from ..plans.shared import tasks
from .align import lacks_flags

BIN = 8192
CHUNK = 65_536
MAX_INDEX_ROWS = 1_000_000
CROWDED_BIN, MAX_SALTS = 250_000, 1_000
TASK_READS = 100_000


def overlap_join(reads: DataFrame, feats: DataFrame, width: int = BIN, stranded: bool = False, most: int = MAX_INDEX_ROWS) -> DataFrame:
    """Pairs with at least one common base: reads (contig, pos, end_pos), feats (contig, f_start, f_end).

    Two inequalities alone would plan as a nested loop. Both sides go into the bins they touch; a pair is
    emitted in the bin of its later start only, so nothing is deduplicated. Features that take at most ``most`` places in bins
    are an index that is broadcast: reads then stay where they are. Beyond that both sides are shuffled by bin, and bins
    with many reads are dealt out over salts, for each of which their features are repeated.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    r, f = reads.withColumn("__bin", bins("pos", "end_pos")), feats.withColumn("__bin", bins("f_start", "f_end"))
    keys = ["contig", "__bin"] + (["strand"] if stranded else [])
    if f.limit(most + 1).count() <= most:
        j = r.join(F.broadcast(f), keys)
    else:
        r, f = _dealt(r, f, ["contig", "__bin"], ["pos", "end_pos"])
        j = r.join(f, [*keys, "__salt"]).drop("__salt")
    return (
        j.filter((F.col("pos") <= F.col("f_end")) & (F.col("f_start") <= F.col("end_pos")))
        .filter(F.col("__bin") == F.floor(F.greatest("pos", "f_start") / width))
        .drop("__bin")
    )


def _dealt(many: DataFrame, few: DataFrame, keys: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with ``__salt``: rows of ``many`` whose keys are crowded are dealt out, those of ``few`` repeated for each salt.

    The number of tasks goes by rows: tasks that are put together by bytes hold millions.
    """
    crowded = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWDED_BIN)
    salts = F.broadcast(crowded.select(*keys, F.least(F.ceil(F.col("n") / CROWDED_BIN), F.lit(MAX_SALTS)).cast("int").alias("__salts")))  # at most a row per CROWDED_BIN reads
    deal = lambda df: df.join(salts, keys, "left").withColumn("__salts", F.coalesce("__salts", F.lit(1)))
    salted = deal(many).withColumn("__salt", F.pmod(F.xxhash64(*by, F.monotonically_increasing_id()), F.col("__salts")).cast("int")).drop("__salts")
    return salted.repartition(tasks(many, CROWDED_BIN), *keys, "__salt"), deal(few).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")


def assign_unambiguous(aln: DataFrame, feats: DataFrame) -> DataFrame:
    """Unique mapped lines that overlap exactly one gene of ``feats``: pair_id and gene."""
    hits = overlap_join(aln.filter(lacks_flags(4) & (F.col("nh") == 1)).select("pair_id", "contig", "pos", "end_pos"), feats)
    return hits.groupBy("pair_id").agg(F.count_distinct("gene").alias("n"), F.min("gene").alias("gene")).filter("n = 1").drop("n")


def rrna_share(aln: DataFrame, feats: DataFrame, ftype: str = "rRNA") -> DataFrame:
    assigned = assign_unambiguous(aln, features_of_type(feats, ftype)).agg(F.count(F.lit(1)).alias("rrna"))
    unique = aln.agg(F.count_if(lacks_flags(4) & (F.col("nh") == 1)).alias("unique"))
    both = assigned.crossJoin(unique)  # one row each
    return both.withColumn("rrna_share", F.round(F.try_divide(F.col("rrna").cast("double"), F.col("unique")), 4))


def features_of_type(feats: DataFrame, ftype: str) -> DataFrame:
    return feats.filter(F.col("ftype") == ftype)


def assign_genes(reads: DataFrame, exons: DataFrame, mode: str = "Gene") -> DataFrame:
    """read_id, genes (sorted array), level of the reads that some gene explains.

    ``reads``: read_id, contig, strand, blocks; ``exons``: contig, f_start, f_end, strand, gene, transcript.
    ``Gene``: all blocks inside exons of one transcript, same strand. ``GeneFull_Ex50pAS``: first at least half of
    the bases exonic, then any overlap with the gene body, sense; reads wholly exonic on the other strand are left out.
    Hits are dealt by read over as many tasks as hold about ``TASK_READS`` reads each.
    """
    n = tasks(reads, TASK_READS)
    by_read = lambda df: df.repartition(n, "read_id")
    each = reads.select("read_id", "contig", F.col("strand").alias("r_strand"), F.size("blocks").alias("n_blocks"), F.explode("blocks").alias("b"))
    each = each.select("read_id", "contig", "r_strand", "n_blocks", F.col("b.start").alias("pos"), F.col("b.end").alias("end_pos"))
    if mode == "Gene":
        hits = overlap_join(each, exons).filter((F.col("strand") == F.col("r_strand")) & (F.col("pos") >= F.col("f_start")) & (F.col("end_pos") <= F.col("f_end")))
        whole = by_read(hits.select("read_id", "n_blocks", "transcript", "gene", "pos")).groupBy("read_id", "n_blocks", "transcript", "gene").agg(F.count_distinct("pos").alias("n")).filter("n = n_blocks")
        return whole.groupBy("read_id").agg(F.array_sort(F.collect_set("gene")).alias("genes")).withColumn("level", F.lit("exonic"))
    merged = reduce_intervals(exons, ["gene", "contig", "strand"])
    common = F.least("end_pos", "f_end") - F.greatest("pos", "f_start") + 1
    bodies = exons.groupBy("gene", "contig", "strand").agg(F.min("f_start").alias("f_start"), F.max("f_end").alias("f_end"))
    same, none = F.col("strand") == F.col("r_strand"), F.lit(None)
    # what is known of a read meets in one aggregation: bases in exons by gene and strand, bodies along the strand, its own bases
    row = lambda df, gene, sense, kind, n: df.select("read_id", gene.alias("gene"), sense.cast("boolean").alias("sense"), F.lit(kind).alias("kind"), n.cast("long").alias("n"))
    facts = row(overlap_join(each, merged), F.col("gene"), same, "exon", common)
    facts = facts.unionByName(row(overlap_join(each, bodies).filter(same), F.col("gene"), same, "body", F.lit(0)))
    facts = facts.unionByName(row(each, none.cast(exons.schema["gene"].dataType), none, "read", F.col("end_pos") - F.col("pos") + 1))
    sums = by_read(facts).groupBy("read_id", "kind", "gene", "sense").agg(F.sum("n").alias("n"))
    whole = sums.groupBy("read_id").agg(F.max(F.when(F.col("kind") == "read", F.col("n"))).alias("bases"), F.collect_list(F.when(F.col("kind") != "read", F.struct("kind", "gene", "sense", "n"))).alias("all"))
    named = lambda test: F.array_sort(F.array_distinct(F.transform(F.filter("all", test), lambda x: x["gene"])))
    one = named(lambda x: (x["kind"] == "exon") & x["sense"] & (2 * x["n"] >= F.col("bases")))
    # a read wholly exonic against the strand counts only where it is exonic along it too
    anti = F.coalesce(F.exists("all", lambda x: (x["kind"] == "exon") & ~x["sense"] & (x["n"] == F.col("bases"))), F.lit(False))
    two = named(lambda x: x["kind"] == "body")
    best = whole.select("read_id", one.alias("one"), two.alias("two"), anti.alias("anti")).filter("size(one) > 0 or (size(two) > 0 and not anti)")
    exonic = F.size("one") > 0
    return best.select("read_id", F.when(exonic, F.col("one")).otherwise(F.col("two")).alias("genes"), F.when(exonic, "exonic").otherwise("intronic").alias("level"))


def cell_read_stats(reads: DataFrame, exons: DataFrame, mito: tuple[str, ...] = ("chrM", "M", "MT")) -> DataFrame:
    """Per barcode: cbMatch, genomeU, genomeM, exonic, intronic, exonicAS, intronicAS, mito.

    ``reads`` has read_id, cb (null: not in the list), contig (null: unmapped), strand, blocks, nh, primary lines only.
    """
    other = reads.withColumn("strand", F.when(F.col("strand") == "+", "-").otherwise("+"))
    mapped = reads.filter(F.col("contig").isNotNull() & ~F.col("contig").isin(*mito))
    sense = assign_genes(mapped, exons, "GeneFull_Ex50pAS").select("read_id", F.col("level").alias("sense"))
    anti = assign_genes(other.filter(F.col("contig").isNotNull() & ~F.col("contig").isin(*mito)), exons, "GeneFull_Ex50pAS").select("read_id", F.col("level").alias("anti"))
    r = reads.join(sense, "read_id", "left").join(anti, "read_id", "left").withColumn("cell", F.coalesce("cb", F.lit("CBnotInPasslist")))
    on = F.col("contig").isNotNull()
    return r.groupBy("cell").agg(
        F.count(F.lit(1)).alias("cbMatch"),
        F.count_if(on & (F.col("nh") == 1)).alias("genomeU"),
        F.count_if(on & (F.col("nh") > 1)).alias("genomeM"),
        F.count_if(F.col("sense") == "exonic").alias("exonic"),
        F.count_if(F.col("sense") == "intronic").alias("intronic"),
        F.count_if(F.col("sense").isNull() & (F.col("anti") == "exonic")).alias("exonicAS"),
        F.count_if(F.col("sense").isNull() & (F.col("anti") == "intronic")).alias("intronicAS"),
        F.count_if(F.coalesce(F.col("contig").isin(*mito), F.lit(False))).alias("mito"),
    )


def reduce_intervals(df: DataFrame, by: list[str]) -> DataFrame:
    """Overlapping or adjacent intervals (f_start, f_end) of a key merged."""
    w = Window.partitionBy(*by).orderBy("f_start", "f_end")
    reach = F.max("f_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = df.select(*by, "f_start", "f_end").withColumn("__new", (F.coalesce(F.col("f_start") > reach + 1, F.lit(True))).cast("int"))
    d = d.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*by, "__island").agg(F.min("f_start").alias("f_start"), F.max("f_end").alias("f_end")).drop("__island")


def introns(exons: DataFrame, flank: int) -> DataFrame:
    """Gaps between consecutive exons of a transcript, grown by ``flank``, merged per gene."""
    w = Window.partitionBy("transcript", "gene", "contig", "strand").orderBy("f_start", "f_end")
    gap = exons.withColumn("__next", F.lead("f_start").over(w)).filter(F.col("__next") > F.col("f_end") + 1)
    grown = gap.select("gene", "contig", "strand", (F.col("f_end") + 1 - flank).alias("f_start"), (F.col("__next") - 1 + flank).alias("f_end"))
    return reduce_intervals(grown, ["gene", "contig", "strand"])


def make_unique(df: DataFrame, key: str, order, out: str, suffix: str = "-I") -> DataFrame:
    """``key-I``, ``key-I1``, ``key-I2``, ... in order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    return df.withColumn(out, F.concat(F.col(key).cast("string"), F.lit(suffix), F.when(n > 0, n.cast("string")).otherwise("")))


def chunk_contigs(contigs: DataFrame, size: int = CHUNK) -> DataFrame:
    """contig, chunk, at (bases before), chunk_seq: sequences in pieces of fixed length, as the chunked scan gives them."""
    n = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("sequence") / size).cast("int") - 1, F.lit(0))))
    pieces = contigs.select("contig", "sequence", n.alias("chunk"))
    return pieces.select("contig", F.col("chunk").cast("long").alias("chunk"), (F.col("chunk").cast("long") * size).alias("at"), F.substring("sequence", F.col("chunk") * size + 1, F.lit(size)).alias("chunk_seq"))


def extract_seqs(ranges: DataFrame, chunks: DataFrame, size: int = CHUNK) -> DataFrame:
    """id and sequence of ranges (id, contig, f_start, f_end, strand, part): parts in order, reverse strand complemented.

    ``chunks`` has contig, chunk, at and chunk_seq; a chunk may come in several rows. They hold the genome, whatever size is
    estimated, so they are never broadcast: both sides meet by chunk, and chunks of many ranges are repeated.
    """
    each = ranges.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("f_start") - 1) / size), F.floor((F.col("f_end") - 1) / size))))
    each, chunks = _dealt(each, chunks, ["contig", "chunk"], ["id", "part"])
    j = each.join(chunks.hint("merge"), ["contig", "chunk", "__salt"])
    a = F.greatest(F.col("f_start") - F.col("at"), F.lit(1)).cast("int")
    b = F.least(F.col("f_end") - F.col("at"), F.length("chunk_seq")).cast("int")
    j = j.withColumn("piece", F.substring("chunk_seq", a, b - a + 1))
    joined = j.groupBy("id", "strand").agg(F.array_sort(F.collect_list(F.struct("part", "at", "piece"))).alias("p"))
    forward = F.array_join(F.transform("p", lambda x: x["piece"]), "")
    return joined.select("id", F.when(F.col("strand") == "-", revcomp(forward)).otherwise(forward).alias("sequence"))


def splici(exons: DataFrame, contigs: DataFrame, read_len: int, trim: int = 5) -> tuple[DataFrame, DataFrame]:
    """(sequences: id, sequence; t2g: transcript_id, gene_id, status) of spliced transcripts and introns.

    ``contigs`` has contig and sequence, or is a chunked scan of chunks of ``CHUNK`` bases.
    """
    flank = read_len - trim
    if flank < 0:
        raise ValueError("the trim is longer than the read")
    chunks = chunk_contigs(contigs) if "sequence" in contigs.columns else contigs
    length = chunks.groupBy("contig").agg(F.max(F.col("at") + F.length("chunk_seq")).cast("int").alias("__n"))
    i = introns(exons, flank).join(length, "contig")
    i = i.withColumns({"f_start": F.greatest(F.col("f_start"), F.lit(1)), "f_end": F.least(F.col("f_end"), F.col("__n"))}).drop("__n")
    i = make_unique(i, "gene", ["contig", "f_start"], "id")
    order = Window.partitionBy("transcript").orderBy("f_start")
    spliced = exons.withColumn("part", F.row_number().over(order)).select(F.col("transcript").alias("id"), "contig", "f_start", "f_end", "strand", "part")
    ranges = spliced.unionByName(i.select("id", "contig", "f_start", "f_end", "strand", F.lit(1).alias("part")))
    seqs = extract_seqs(ranges, chunks)
    t2g = exons.select(F.col("transcript").alias("transcript_id"), F.col("gene").cast("string").alias("gene_id")).distinct().unionByName(i.select(F.col("id").alias("transcript_id"), F.col("gene").cast("string").alias("gene_id")))
    return seqs, t2g.withColumn("status", F.when(F.col("transcript_id").rlike(r"-I\d*$"), "U").otherwise("S"))


def dedup_seqs(seqs: DataFrame) -> DataFrame:
    return seqs.groupBy("sequence").agg(F.min("id").alias("id")).select("id", "sequence")


def append_extra(seqs: DataFrame, t2g: DataFrame, extra: DataFrame, status: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sequences, three-column map, two-column map) with extra records (id, sequence).

    The two-column map names an unspliced extra's gene ``id-U``, the three-column map ``id`` with its status.
    """
    three = t2g.unionByName(extra.select(F.col("id").alias("transcript_id"), F.col("id").alias("gene_id"), F.lit(status).alias("status")))
    gene = F.concat("id", F.lit("-U")) if status == "U" else F.col("id")
    two = t2g.select("transcript_id", F.when(F.col("status") == "U", F.concat("gene_id", F.lit("-U"))).otherwise(F.col("gene_id")).alias("gene_id"))
    return seqs.unionByName(extra.select("id", "sequence")), three, two.unionByName(extra.select(F.col("id").alias("transcript_id"), gene.alias("gene_id")))


def join_t2g(hits: DataFrame, t2g: DataFrame, key: str = "transcript_id") -> DataFrame:
    return hits.join(t2g, key)


def coverage_peaks(aln: DataFrame, bin: int = 50, min_depth: int = 10) -> DataFrame:
    """contig, strand, f_start, f_end of runs of bins with at least ``min_depth`` reads."""
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    mapped = aln.filter(lacks_flags(4)).select("contig", strand.alias("strand"), F.explode(F.sequence(F.floor((F.col("pos") - 1) / bin), F.floor((F.col("end_pos") - 1) / bin))).alias("bin"))
    deep = mapped.groupBy("contig", "strand", "bin").agg(F.count(F.lit(1)).alias("depth")).filter(F.col("depth") >= min_depth)
    each = deep.select("contig", "strand", (F.col("bin") * bin + 1).alias("f_start"), ((F.col("bin") + 1) * bin).alias("f_end"))
    return reduce_intervals(each, ["contig", "strand"])


def nearest_gene(peaks: DataFrame, genes: DataFrame, max_gap: int = 10_000) -> DataFrame:
    """Peaks clear of genes with the nearest gene upstream on their strand: contig, strand, f_start, f_end, gene, gap.

    ``genes`` has contig, strand, f_start, f_end, gene. On the reverse strand coordinates are mirrored.
    """
    body = genes.select("contig", "strand", F.col("f_start"), F.col("f_end"), "gene")
    clear = peaks.join(
        overlap_join(peaks.withColumnsRenamed({"f_start": "pos", "f_end": "end_pos"}), body, stranded=True).select("contig", "strand", F.col("pos").alias("f_start"), F.col("end_pos").alias("f_end")),
        ["contig", "strand", "f_start", "f_end"],
        "left_anti",
    )
    sign = F.when(F.col("strand") == "-", -1).otherwise(1)
    near = lambda d: F.when(sign > 0, d["f_start"]).otherwise(-d["f_end"])
    far = lambda d: F.when(sign > 0, d["f_end"]).otherwise(-d["f_start"])
    g = body.select("contig", "strand", far(body).alias("at"), F.lit(0).alias("kind"), "gene", F.col("f_start"), F.col("f_end"))
    p = clear.select("contig", "strand", near(clear).alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(genes.schema["gene"].dataType).alias("gene"), "f_start", "f_end")
    w = Window.partitionBy("contig", "strand").orderBy("at", "kind", "f_start").rowsBetween(Window.unboundedPreceding, 0)
    u = g.unionByName(p).withColumn("near", F.last(F.when(F.col("kind") == 0, F.struct("gene", F.col("at").alias("end"))), ignorenulls=True).over(w))
    out = u.filter("kind = 1 and near is not null").withColumn("gap", F.col("at") - F.col("near.end")).filter(F.col("gap") <= max_gap)
    return out.select("contig", "strand", "f_start", "f_end", F.col("near.gene").alias("gene"), "gap")


def extend_genes(features: DataFrame, aln: DataFrame, max_gap: int = 10_000, bin: int = 50, min_depth: int = 10) -> DataFrame:
    """Features with each gene and its last exon extended to the peak next downstream.

    ``features``: contig, strand, f_start, f_end, gene, ftype (``gene`` and ``exon`` rows).
    """
    genes = features.filter("ftype = 'gene'")
    ends = nearest_gene(coverage_peaks(aln, bin, min_depth), genes, max_gap).groupBy("gene").agg(F.min("f_start").alias("__low"), F.max("f_end").alias("__high"))
    f = features.join(ends, "gene", "left")
    w = Window.partitionBy("gene", "ftype")
    last = F.when(F.col("strand") == "-", F.col("f_start") == F.min("f_start").over(w)).otherwise(F.col("f_end") == F.max("f_end").over(w))
    grows = F.col("__high").isNotNull() & F.col("ftype").isin("gene", "exon") & last
    f = f.withColumn("__grows", grows)
    start = F.when(F.col("__grows") & (F.col("strand") == "-"), F.least("f_start", "__low")).otherwise(F.col("f_start"))
    end = F.when(F.col("__grows") & (F.col("strand") == "+"), F.greatest("f_end", "__high")).otherwise(F.col("f_end"))
    return f.withColumns({"f_start": start, "f_end": end}).select(features.columns)


