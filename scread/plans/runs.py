"""Whole runs composed of the operators: an experiment's demultiplexing, its count matrix, the collated metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells, sci, umi, wells
from ..sinks import fastq as fq_out
from ..sinks import tables as t_out
from ..sources import fastq, metrics
from ..sources import tables as t_in


def demultiplex(spark: SparkSession, sheet: str, barcodes: str, out: str, hashes: str | None = None, partitions: int | None = None, files: int = 1) -> dict[str, DataFrame]:
    """One experiment from its sample sheet, FASTQ files and barcode sheet to everything below ``out``; returns the QC tables.

    ``demuxed`` is written once and read by all that follows: ``fastq`` per sample, ``discarded`` reads,
    ``whitelists`` per barcode type and ``qc`` tables. With ``hashes``, the sheet's column of hash sheets, reads of
    hashes are counted and left out of the FASTQ files. Files that can't be read from the middle are one task each: ``partitions`` deals
    their pairs out, unless as many tasks read them.
    """
    samples, keys = t_in.read_samplesheet(spark, sheet), t_in.read_barcodes(spark, barcodes)
    pairs = fastq.read_fastq_pairs(spark, samples)
    if partitions and pairs.rdd.getNumPartitions() < partitions:
        pairs = pairs.repartition(partitions)
    demuxed = sci.sci_demux(pairs, keys, samples)
    if hashes:
        demuxed = sci.match_hash(demuxed, t_in.read_hash_sheets(spark, t_in.samples_for(spark.read.option("header", True).csv(sheet)), hashes))
    demuxed.write.parquet(f"{out}/demuxed")
    demuxed = spark.read.parquet(f"{out}/demuxed")
    kept, lost = sci.split_assigned(demuxed)
    qc = {
        "totals": sci.demux_totals(demuxed),
        "samples": sci.demux_by_sample(demuxed, samples),
        "barcodes": sci.barcode_usage(demuxed, keys),
        "rt_plates": sci.rt_plate_usage(demuxed),
        "failures": sci.failure_patterns(demuxed),
        "uncorrectable": sci.top_uncorrectable(demuxed),
    }
    if hashes:
        qc |= {"hashes": sci.hash_metrics(demuxed), "hash_cells": sci.hash_cells(demuxed)}
        kept = sci.drop_hash_reads(kept)
    fq_out.write_fastq(sci.sci_rewrite(kept).drop("sample").withColumnRenamed("sample_name", "sample"), f"{out}/fastq", files=files)
    fq_out.write_discarded(lost, f"{out}/discarded")
    fq_out.write_segment_whitelists(keys, f"{out}/whitelists")
    fq_out.write_qc_tables(qc, f"{out}/qc")
    return {name: spark.read.parquet(f"{out}/qc/{name}") for name in qc}


def demultiplex_wells(reads: DataFrame, seq: str, whitelist: DataFrame, groups: DataFrame, bounds: tuple[int, int], most: int, out: str) -> DataFrame:
    """All well groups of one file in one pass: reads per group below ``out``, and the run's counters per group."""
    wells.assign_wells(reads, seq, whitelist, groups, bounds, most).write.parquet(f"{out}/assigned")
    assigned = reads.sparkSession.read.parquet(f"{out}/assigned")
    assigned.withColumn("group_name", F.explode("groups")).write.partitionBy("group_name").parquet(f"{out}/groups")
    return wells.well_demux_stats(assigned, groups)


def count(tagged: DataFrame, expected: int, out: str, dataset: str, collapse: str = "1MM_CR", multigene: str = "MultiGeneUMI_CR") -> DataFrame:
    """From tagged reads (cell, gene, umi) to a matrix of the called cells below ``out``; returns all counts."""
    counts = umi.count_matrix(umi.filter_multigene_umis(umi.collapse_umis(umi.molecules(tagged), collapse), multigene), dataset)
    counts.write.parquet(f"{out}/counts")
    counts = tagged.sparkSession.read.parquet(f"{out}/counts")
    called = cells.call_cells_quantile(cells.cell_summary(counts), expected)
    t_out.write_mtx(counts.join(called.select("dataset", "cell"), ["dataset", "cell"], "left_semi"), f"{out}/filtered")
    t_out.write_mtx(counts, f"{out}/raw")
    return counts


def exists(spark: SparkSession, glob: str) -> bool:
    """Whether any file matches the glob."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def collate_metrics(spark: SparkSession, readers: list[tuple[str, Callable[[SparkSession, str], DataFrame]]], out: str) -> DataFrame | None:
    """The collated metrics table below ``out`` from (glob, reader) pairs; a tool without files has no rows.

    A reader takes the session and the glob over all samples and gives long metrics. Returns the table, null
    without any file.
    """
    frames = [read(spark, glob) for glob, read in readers if exists(spark, glob)]
    if not frames:
        return None
    table = metrics.wide(metrics.metrics_long(*frames))
    t_out.write_mapping_stats([table], out)
    return table
