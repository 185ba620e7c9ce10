"""Read filters and quality reports."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.seq import gc, letters, n_count, phred


def _fails(mate: str, min_len: int, min_q: int, max_bad: float, max_n: int) -> dict[str, Column]:
    seq, scores = F.col(f"{mate}_seq"), phred(f"{mate}_qual")
    bad = F.size(F.filter(scores, lambda v: v < min_q))
    return {"too short": F.length(seq) < min_len, "low quality": bad > max_bad * F.size(scores), "too many N": n_count(seq) > max_n}


def drop_reason(min_len: int = 10, min_q: int = 15, max_bad: float = 0.4, max_n: int = 5) -> Column:
    """Why a pair is dropped (either mate fails), null if it is kept."""
    r1, r2 = (_fails(m, min_len, min_q, max_bad, max_n) for m in ("r1", "r2"))
    return F.coalesce(*[F.when(r1[k] | r2[k], k) for k in ("low quality", "too many N", "too short")])


def quality_filter(pairs: DataFrame, min_len: int = 10, min_q: int = 15, max_bad: float = 0.4, max_n: int = 5) -> DataFrame:
    return pairs.filter(drop_reason(min_len, min_q, max_bad, max_n).isNull())


def trim_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """stage, reads, bases, q20, q30 and gc shares of all mates."""

    def one(df: DataFrame, stage: str) -> DataFrame:
        mates = df.select("r1_seq", "r1_qual").toDF("s", "q").unionByName(df.select("r2_seq", "r2_qual").toDF("s", "q"))
        least = lambda n: F.sum(F.size(F.filter(phred("q"), lambda v: v >= n)))
        bases = F.sum(F.length("s"))
        share = lambda n: F.round(F.try_divide(n.cast("double"), bases), 6)
        return mates.agg(F.count(F.lit(1)).alias("reads"), bases.alias("bases"), share(least(20)).alias("q20"), share(least(30)).alias("q30"), share(F.sum(F.length("s") - F.length(F.translate("s", "GC", "")))).alias("gc")).withColumn("stage", F.lit(stage))

    return one(before, "before").unionByName(one(after, "after"))


def drop_reasons(pairs: DataFrame, **limits) -> DataFrame:
    return pairs.select(drop_reason(**limits).alias("reason")).filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("pairs"))


def frequent(sequences: DataFrame, share: float) -> DataFrame:
    """sequence, reads and share of the sequences of at least ``share`` of all rows (nulls are rows, but no sequence), exactly.

    Each partition keeps a summary of 2 / ``share`` counters; their sums are too low by less than half the share,
    so the true ones are among at most 2 / ``share`` candidates, which are broadcast and counted. Reads are not shuffled.
    """
    room = ceil(2 / share)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        rows = 0
        for batch in batches:
            rows += len(batch)
            counts = batch.column(0).drop_null().value_counts()
            for text, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
                held[text] += n
            if len(held) > 4 * room:
                held = _lowered(held, room)
        held = _lowered(held, room)
        yield pa.RecordBatch.from_arrays([pa.array([None, *held], pa.string()), pa.array([rows, *held.values()], pa.int64())], names=["sequence", "n"])

    sums = sequences.mapInArrow(summary, "sequence string, n long").groupBy("sequence").agg(F.sum("n").alias("n"))
    total = sums.filter("sequence is null").select(F.col("n").alias("total"))
    candidates = sums.filter("sequence is not null").join(F.broadcast(total), F.col("n") >= F.col("total") * (share - 1 / (room + 1))).select("sequence", "total")
    counted = sequences.join(F.broadcast(candidates), "sequence").groupBy("sequence", "total").agg(F.count(F.lit(1)).alias("reads"))
    return counted.filter(F.col("reads") >= F.col("total") * share).select("sequence", "reads", (F.col("reads") / F.col("total")).alias("share"))


def _lowered(held: Counter, room: int) -> Counter:
    """At most ``room`` counters: all lose the count of the largest that is left out, which other rows than theirs outnumber ``room`` times."""
    if len(held) <= room:
        return held
    cut = sorted(held.values(), reverse=True)[room]
    return Counter({k: n - cut for k, n in held.items() if n > cut})


def read_qc(reads: DataFrame, module: str, seq: str = "seq", qual: str = "qual", adapter: str = "AGATCGGAAGAG") -> DataFrame:
    """One table of a read-quality report.

    ``base_quality`` (quantiles and mean per position), ``read_quality`` (reads per rounded-down mean),
    ``base_content`` (share of each letter per position), ``gc``, ``length``, ``duplication`` (first 50 letters),
    ``overrepresented`` (sequences of at least 0.1 % of reads), ``adapter`` (cumulative share by position).
    """
    if module == "base_quality":
        each = reads.select(F.posexplode(phred(qual)).alias("pos", "q")).groupBy("pos", "q").agg(F.count(F.lit(1)).alias("n"))
        # few distinct scores per position: quantiles weigh their counts instead of sorting all bases
        p = each.groupBy("pos").agg(F.expr("percentile(q, array(0.1, 0.25, 0.5, 0.75, 0.9), n)").alias("p"), (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean"))
        return p.select((F.col("pos") + 1).alias("position"), *[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(("p10", "p25", "p50", "p75", "p90"))], "mean")
    if module == "read_quality":
        scores = phred(qual)
        mean = F.floor(F.aggregate(scores, F.lit(0), lambda s, v: s + v) / F.size(scores))
        return reads.filter(F.length(qual) > 0).groupBy(mean.alias("quality")).agg(F.count(F.lit(1)).alias("reads"))
    if module == "base_content":
        each = reads.select(F.posexplode(letters(seq)).alias("pos", "base")).groupBy("pos").agg(*[F.count_if(F.col("base") == b).alias(b) for b in "ACGTN"], F.count(F.lit(1)).alias("bases"))
        return each.select((F.col("pos") + 1).alias("position"), *[(F.col(b) / F.col("bases")).alias(b) for b in "ACGTN"])
    if module == "gc":
        return reads.filter(F.length(seq) > 0).groupBy(F.round(gc(seq) * 100).cast("int").alias("gc_percent")).agg(F.count(F.lit(1)).alias("reads"))
    if module == "length":
        return reads.groupBy(F.length(seq).alias("length")).agg(F.count(F.lit(1)).alias("reads"))
    if module == "duplication":
        n = reads.groupBy(F.substring(seq, 1, 50).alias("s")).agg(F.count(F.lit(1)).alias("c"))
        steps = ((10_000, ">10k"), (5_000, ">5k"), (1_000, ">1k"), (500, ">500"), (100, ">100"), (50, ">50"), (10, ">10"))
        level = F.coalesce(*[F.when(F.col("c") > k, name) for k, name in steps], F.when(F.col("c") == 10, ">9").otherwise(F.col("c").cast("string")))
        return n.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("c").alias("reads"))
    if module == "overrepresented":
        return frequent(reads.select(F.col(seq).alias("sequence")), 0.001)
    if module == "adapter":
        first = F.instr(F.col(seq), adapter[:12])
        hits = reads.select(F.when(first > 0, first).alias("position"), F.length(seq).alias("len"))
        total = hits.agg(F.count(F.lit(1)).alias("total"), F.max("len").alias("longest"))
        each = hits.filter("position is not null").groupBy("position").agg(F.count(F.lit(1)).alias("n"))
        grid = total.select("total", F.explode(F.sequence(F.lit(1), F.greatest(F.col("longest"), F.lit(1)))).alias("at"))
        return grid.join(F.broadcast(each), F.col("position") <= F.col("at"), "left").groupBy("at", "total").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.col("at").alias("position"), (F.col("n") / F.col("total")).alias("share"))
    raise ValueError(f"no such module: {module}")
