"""Combinatorial (four-barcode) demultiplexing and its quality tables."""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import expand_indices
from ..functions.seq import header_indices, poly_a_start, revcomp
from .match import MAX_BROADCAST_ROWS, padded_neighbours, padded_rows, rescue_map, small

KINDS = ("p5", "p7", "ligation", "rt")
HASH_STATUS = {"n_correct": "Correct", "n_corrected": "Corrected", "n_upstream": "Corrected (Upstream)"}


def _found(name: str) -> Column:
    return F.col(f"{name}.name").isNotNull()


def sci_offsets(found: Column, length: Column) -> tuple[Column, Column]:
    """0-based starts of UMI and RT: one earlier after a matched 9-nt ligation barcode."""
    nine = found & (length == 9)
    return F.when(nine, 15).otherwise(16), F.when(nine, 23).otherwise(24)


def _tagged(df: DataFrame, seq: Column, near: DataFrame, rows: int, out: str) -> DataFrame:
    """``out``: (seq, name, status); without a hit the raw sequence, name and status null."""
    near = near.select(F.col("observed").alias("__seen"), F.col("hit").alias("__hit"))
    df = df.withColumn("__seq", seq).join(small(near, rows), F.col("__seq") == F.col("__seen"), "left")
    raw = F.struct(F.col("__seq").alias("seq"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("status"))
    return df.withColumn(out, F.coalesce("__hit", raw)).drop("__seq", "__seen", "__hit")


def sample_keys(samples: DataFrame) -> DataFrame:
    """(p5, p7, rt) barcode names to sample; ranges are expanded and multiplied, a later sheet row wins."""
    s = samples
    if "row_no" not in s.columns:  # a sheet is small; its rows are numbered in the order in which they are read
        s = s.agg(F.collect_list(F.struct("*")).alias("rows")).select(F.posexplode("rows").alias("row_no", "r")).select("row_no", "r.*")
    for kind in ("p5", "p7", "rt"):
        s = s.withColumn(f"k_{kind}", F.explode(expand_indices(kind, kind)))
    return s.groupBy("k_p5", "k_p7", "k_rt").agg(F.max_by("sample", "row_no").alias("sample_name"))


def sci_demux(reads: DataFrame, barcodes: DataFrame, samples: DataFrame) -> DataFrame:
    """p5, p7, ligation, rt as (seq, name, status), umi, sample_name, cell. Works on streams: no state is kept.

    Exact matches come first, then the only key within padded distance 1. Ligation tries ten letters exactly,
    nine exactly, then both with rescue; without a match it keeps the raw ten.
    """
    n = padded_rows(barcodes, "sequence")
    near = {k: rescue_map(barcodes.filter(F.col("type") == k)) for k in KINDS}
    p7, p5 = header_indices("comment")
    df = _tagged(reads, p7, near["p7"], n, "p7")
    df = _tagged(df, revcomp(p5), near["p5"], n, "p5")
    ten, nine = F.substring("r1_seq", 1, 10), F.substring("r1_seq", 1, 9)
    lig = near["ligation"]
    df = _tagged(_tagged(df, ten, lig, n, "lig10"), nine, lig, n, "lig9")
    order = [F.when(F.col(f"{c}.status") == status, F.col(c)) for status in ("Correct", "Corrected") for c in ("lig10", "lig9")]
    df = df.withColumn("ligation", F.coalesce(*order, F.col("lig10"))).drop("lig10", "lig9")
    umi_at, rt_at = sci_offsets(_found("ligation"), F.length("ligation.seq"))
    df = _tagged(df, F.substring("r1_seq", rt_at + 1, F.lit(10)), near["rt"], n, "rt")
    df = df.withColumn("umi", F.substring("r1_seq", umi_at + 1, F.lit(8)))
    keys = sample_keys(samples)
    df = df.join(
        small(keys, keys.count()),
        (F.col("p5.name") == F.col("k_p5")) & (F.col("p7.name") == F.col("k_p7")) & (F.col("rt.name") == F.col("k_rt")) & _found("ligation"),
        "left",
    ).drop("k_p5", "k_p7", "k_rt")
    return df.withColumn("cell", F.when(F.col("sample_name").isNotNull(), sci_cell()))


def sci_cell() -> Column:
    """p7, p5, ligation (nine letters get a G) and rt, corrected."""
    lig = F.when(F.length("ligation.seq") == 9, F.concat("ligation.seq", F.lit("G"))).otherwise(F.col("ligation.seq"))
    return F.concat("p7.seq", "p5.seq", lig, "rt.seq")


def split_assigned(demuxed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return demuxed.filter("sample_name is not null"), demuxed.filter("sample_name is null")


def sci_rewrite(kept: DataFrame) -> DataFrame:
    """R1 becomes cell and UMI with quality F; both names gain the barcodes."""
    tag = F.concat(F.lit("|P5"), "p5.name", F.lit("-P7"), "p7.name", F.lit("|"), "ligation.name", F.lit("|"), "rt.name", F.lit("_"), "umi")
    r1 = F.concat("cell", "umi")
    return kept.withColumn("name", F.concat("name", tag)).withColumn("r1_seq", r1).withColumn("r1_qual", F.repeat(F.lit("F"), F.length(r1)))


def match_hash(demuxed: DataFrame, hashes: DataFrame) -> DataFrame:
    """Adds ``hash`` (seq, name, status) for samples with a hash sheet (sample_name, hash_name, barcode).

    The candidate is the ten letters that end one letter before the first AAAA of R2: exact, then the only key
    within padded distance 1, then exactly one key anywhere before it (``Corrected (Upstream)``).
    """
    start = poly_a_start("r2_seq")
    df = demuxed.withColumn("__s", start)
    candidate = F.when(F.col("__s") > 1, F.substring("r2_seq", F.greatest(F.col("__s") - 11, F.lit(0)) + 1, F.col("__s") - 1 - F.greatest(F.col("__s") - 11, F.lit(0))))
    df = df.withColumn("__cand", candidate).withColumn("__upstream", F.when(F.col("__s") > 1, F.expr("substring(r2_seq, 1, __s)")))
    keys = hashes.select("sample_name", F.col("hash_name").alias("name"), F.col("barcode").alias("key"))
    near = keys.select("sample_name", "name", "key", F.explode(F.array_distinct(padded_neighbours(F.col("key")))).alias("__cand"))
    near = near.withColumn("exact", F.col("__cand") == F.col("key"))
    near = near.groupBy("sample_name", "__cand").agg(F.max("exact").alias("exact"), F.count(F.lit(1)).alias("n"), F.max_by(F.struct("key", "name"), F.col("exact").cast("int")).alias("k"))
    near = near.filter("exact or n = 1").select(
        "sample_name", "__cand", F.struct(F.col("k.key").alias("seq"), F.col("k.name").alias("name"), F.when(F.col("exact"), "Correct").otherwise("Corrected").alias("status")).alias("__hit")
    )
    df = df.join(small(near, padded_rows(hashes, "barcode")), ["sample_name", "__cand"], "left")
    upstream = only_key(hashes)("sample_name", F.when(F.col("__hit").isNull(), F.col("__upstream")))
    up = F.when(upstream["seq"].isNotNull(), F.struct(upstream["seq"].alias("seq"), upstream["name"].alias("name"), F.lit("Corrected (Upstream)").alias("status")))
    return df.withColumn("hash", F.coalesce("__hit", up)).drop("__s", "__cand", "__upstream", "__hit")


def only_key(hashes: DataFrame):
    """An Arrow function of a sample and a text: (seq, name) of the sample's key that alone occurs in it, and once.

    Occurrences of one key that overlap count as one, as a search that goes on behind each hit counts them; keys of different
    rows count each. All keys of a sample are searched in one pass over the text, by an automaton of them.
    """
    rows = [(r["sample_name"], r["barcode"], r["hash_name"]) for r in hashes.filter(F.length("barcode") > 0).select("sample_name", "barcode", "hash_name").limit(MAX_BROADCAST_ROWS + 1).collect()]
    if len(rows) > MAX_BROADCAST_ROWS:
        raise ValueError(f"hash sheets of more than {MAX_BROADCAST_ROWS} keys")
    made: dict[str, ahocorasick.Automaton] = {}

    def automaton(sample: str) -> ahocorasick.Automaton:
        if sample not in made:
            made[sample] = ahocorasick.Automaton()
            for owner, key, name in rows:
                if owner == sample:
                    made[sample].add_word(key, (*made[sample].get(key, ()), (key, name)))
            made[sample].make_automaton()
        return made[sample]

    def search(sample: str | None, text: str | None) -> dict | None:
        if sample is None or not text or not len(keys := automaton(sample)):
            return None
        found, until = None, -1
        for end, owners in keys.iter(text):
            key = owners[0][0]
            if len(owners) > 1 or found and found[0] != key:
                return None
            if end - len(key) >= until:  # begins behind the last hit that counted
                if found:
                    return None
                found, until = owners[0], end
        return found and {"seq": found[0], "name": found[1]}

    kind = pa.struct([("seq", pa.string()), ("name", pa.string())])

    def find(samples: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([search(s, t) for s, t in zip(samples.to_pylist(), texts.to_pylist())], kind)

    return F.arrow_udf(find, "seq string, name string")


def drop_hash_reads(demuxed: DataFrame) -> DataFrame:
    return demuxed.filter(F.col("hash.name").isNull())


def demux_totals(demuxed: DataFrame) -> DataFrame:
    """Pairs, successes, failures and corrected barcodes of a run; with ``hash`` (see ``match_hash``) also its hash reads by status."""
    ok = F.col("sample_name").isNotNull()
    corrected = [F.count_if(ok & (F.col(f"{k}.status") == "Corrected")).alias(f"corrected_{k}") for k in KINDS]
    hashed = [F.count_if(ok & (F.col("hash.status") == v)).alias(k.replace("n_", "hash_")) for k, v in HASH_STATUS.items()] if "hash" in demuxed.columns else []
    return demuxed.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failure"), *corrected, *hashed)


def demux_by_sample(demuxed: DataFrame, samples: DataFrame) -> DataFrame:
    """Pairs per sample, each counted once; samples without any are zero."""
    n = demuxed.filter("sample_name is not null").groupBy(F.col("sample_name").alias("sample")).agg(F.count(F.lit(1)).alias("pairs"))
    return samples.select("sample").distinct().join(n, "sample", "left").select("sample", F.coalesce("pairs", F.lit(0)).alias("pairs"))


def barcode_usage(demuxed: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Successful pairs per p5, p7 and ligation barcode; unused barcodes are zero."""
    used = demuxed.filter("sample_name is not null").selectExpr("stack(3, 'p5', p5.name, 'p7', p7.name, 'ligation', ligation.name) as (type, barcode)")
    n = used.groupBy("type", "barcode").agg(F.count(F.lit(1)).alias("pairs"))
    all_ = barcodes.filter("type in ('p5', 'p7', 'ligation')").select("type", "barcode").distinct()
    return all_.join(n, ["type", "barcode"], "left").select("type", "barcode", F.coalesce("pairs", F.lit(0)).alias("pairs"))


def rt_plate_usage(demuxed: DataFrame) -> DataFrame:
    ok = demuxed.filter("sample_name is not null")
    part = F.split("rt.name", "-")
    return ok.groupBy(F.get(part, F.lit(0)).alias("plate"), F.get(part, F.lit(1)).alias("well")).agg(F.count(F.lit(1)).alias("pairs"))


def failure_patterns(demuxed: DataFrame) -> DataFrame:
    """Failed pairs by which barcodes were found: all sixteen patterns."""
    names = [f"{k}_found" for k in KINDS]
    n = demuxed.filter("sample_name is null").groupBy(*[_found(k).alias(c) for k, c in zip(KINDS, names)]).agg(F.count(F.lit(1)).alias("pairs"))
    every = demuxed.sparkSession.range(16).select(*[(F.col("id").bitwiseAND(1 << i) != 0).alias(c) for i, c in enumerate(names)])
    return every.join(n, names, "left").select(*names, F.coalesce("pairs", F.lit(0)).alias("pairs"))


def uncorrectable(demuxed: DataFrame) -> DataFrame:
    """Raw sequences of failed pairs that matched no key, by type."""
    failed = demuxed.filter("sample_name is null")
    stacked = failed.selectExpr("stack(4, " + ", ".join(f"'{k}', {k}.seq, {k}.status" for k in KINDS) + ") as (type, sequence, status)")
    return stacked.filter("status is null").groupBy("type", "sequence").agg(F.count(F.lit(1)).alias("pairs"))


def top_uncorrectable(demuxed: DataFrame, n: int = 50) -> DataFrame:
    w = Window.partitionBy("type").orderBy(F.desc("pairs"), "sequence")
    return uncorrectable(demuxed).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def hash_metrics(hashed: DataFrame) -> DataFrame:
    """Per sample and hash: reads by status."""
    h = hashed.filter(F.col("hash.name").isNotNull() & F.col("sample_name").isNotNull())
    return h.groupBy("sample_name", F.col("hash.name").alias("hash_name")).agg(*[F.count_if(F.col("hash.status") == v).alias(k) for k, v in HASH_STATUS.items()])


def hash_cells(hashed: DataFrame) -> DataFrame:
    """Per sample, hash and cell: reads and distinct UMIs."""
    h = hashed.filter(F.col("hash.name").isNotNull() & F.col("sample_name").isNotNull())
    return h.groupBy("sample_name", F.col("hash.name").alias("hash_name"), "cell").agg(F.count(F.lit(1)).alias("reads"), F.count_distinct("umi").alias("umis"))
