"""Read pairs out to compressed FASTQ, whitelists and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import written
from .files import FastqPairs

TASK_PAIRS = 100_000


def _record(name: Column, comment: Column, seq: str, qual: str) -> Column:
    head = F.when(F.coalesce(comment, F.lit("")) == "", name).otherwise(F.concat(name, F.lit(" "), comment))
    return F.concat(F.lit("@"), head, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def write_fastq(pairs: DataFrame, path: str, by: str = "sample", files: int = 1) -> None:
    """``path/<by>=x/mate=R1`` and ``R2`` as block-compressed gzip; mates are in step, file by file.

    The pairs are written once and cut into ranges of their order, about ``TASK_PAIRS`` each; a task writes both mates of its
    ranges, and the commit joins what tasks wrote of a file. Pairs go by lane, pair_id and name. ``files`` spreads a
    large sample over that many file pairs.
    """
    part = F.pmod(F.xxhash64("pair_id"), F.lit(files))
    order = [by, "part", *(c for c in ("lane",) if c in pairs.columns), "pair_id", "name"]
    comment = F.col("comment") if "comment" in pairs.columns else F.lit("")
    folder = F.concat(F.lit(f"{by}="), F.coalesce(F.col(by).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")), F.lit("/mate={mate}/part="), "part")
    records = [_record(F.col("name"), comment, f"{m}_seq", f"{m}_qual").alias(m) for m in ("r1", "r2")]
    df = written(pairs.withColumn("part", part).select(*order, *records), "pairs")
    df = df.repartitionByRange(max(1, -(-df.count() // TASK_PAIRS)), *order).sortWithinPartitions(*order)
    pairs.sparkSession.dataSource.register(FastqPairs)
    df.select(folder.alias("folder"), "r1", "r2").write.format("fastq_pair_files").mode("append").option("path", path).save()


def discarded_log(discarded: DataFrame) -> DataFrame:
    """read_name, the four barcodes (name, else sequence, else ?), umi and sample."""
    cell = lambda k: F.coalesce(f"{k}.name", f"{k}.seq", F.lit("?")).alias(k)
    return discarded.select(F.col("name").alias("read_name"), cell("p5"), cell("p7"), cell("ligation"), cell("rt"), F.coalesce("umi", F.lit("?")).alias("umi"), F.coalesce("sample_name", F.lit("?")).alias("sample_name"))


def write_discarded(discarded: DataFrame, path: str) -> None:
    discarded_log(discarded).write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def write_segment_whitelists(barcodes: DataFrame, path: str) -> None:
    """One text folder per barcode type; nine-letter ligation barcodes end in G."""
    seq = F.when((F.col("type") == "ligation") & (F.length("sequence") == 9), F.concat("sequence", F.lit("G"))).otherwise(F.col("sequence"))
    barcodes.select("type", seq.alias("value")).distinct().repartition("type").sortWithinPartitions("type", "value").write.partitionBy("type").text(path)


def write_qc_tables(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_unmapped_fasta(aln: DataFrame, path: str) -> None:
    aln.filter(F.col("flag").bitwiseAND(4) != 0).select(F.concat(F.lit(">"), "read_name", F.lit("\n"), "seq").alias("value")).write.text(path)
