"""Matching observed sequences to a list of known ones, as equi-joins.

A similarity join plans as a nested loop. For short lists of keys the strings within the allowed distance
are enumerated once (a neighbour map) and joined; for long lists the distinct observed strings are expanded
instead. Neighbour maps are broadcast only while their checked size stays under ``MAX_BROADCAST_ROWS``.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import hamming, letters, phred, revcomp

ALPHABET, FOREIGN = "ACGTN", "?"
MAX_BROADCAST_ROWS = 500_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a broadcast side if it has at most ``MAX_BROADCAST_ROWS`` rows; otherwise the join shuffles."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def substitutions(s: Column) -> Column:
    """All strings with exactly one letter replaced."""
    places = F.sequence(F.lit(1), F.length(s))
    one = F.transform(
        places,
        lambda i: F.transform(F.lit(list(ALPHABET)), lambda c: F.concat(F.substring(s, F.lit(1), i - 1), c, F.substring(s, i + 1, F.length(s)))),
    )
    return F.filter(F.flatten(one), lambda x: x != s)


def padded_neighbours(s: Column) -> Column:
    """All strings at padded distance 0 or 1: substitutions, one letter more or one less at the end."""
    longer = F.transform(F.lit(list(ALPHABET)), lambda c: F.concat(s, c))
    return F.concat(F.array(s), substitutions(s), longer, F.array(F.substring(s, F.lit(1), F.length(s) - 1)))


def padded_rows(sheet: DataFrame, key: str) -> int:
    """How many rows the padded neighbours of all keys have at most."""
    n, length = sheet.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length(key)), F.lit(0))).first()
    return n * (length * (len(ALPHABET) - 1) + len(ALPHABET) + 2)


def sheet_keys(sheet: DataFrame) -> DataFrame:
    """sequence, barcode: of rows with one sequence the last, by ``row_no`` as readers number it; a frame without it is taken as read."""
    last = F.max_by("barcode", "row_no") if "row_no" in sheet.columns else F.last("barcode")  # a stream's plan takes no row ids
    return sheet.groupBy("sequence").agg(last.alias("barcode"))


def match_exact(df: DataFrame, seq: str, sheet: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: (seq, name, status Correct) of the key equal to ``seq``, null without one; the last key wins."""
    keys = sheet_keys(sheet).select(F.col("sequence").alias("__key"), F.col("barcode").alias("__name"))
    hit = F.when(F.col("__name").isNotNull(), F.struct(F.col("__key").alias("seq"), F.col("__name").alias("name"), F.lit("Correct").alias("status")))
    return df.join(small(keys, sheet.count()), F.col(seq) == F.col("__key"), "left").withColumn(out, hit).drop("__key", "__name")


def rescue_map(sheet: DataFrame) -> DataFrame:
    """``observed`` to (seq, name, status): equal to a key, or within padded distance 1 of exactly one key."""
    keys = sheet_keys(sheet)
    near = keys.select("sequence", "barcode", F.explode(F.array_distinct(padded_neighbours(F.col("sequence")))).alias("observed"))
    near = near.withColumn("exact", F.col("observed") == F.col("sequence"))
    best = near.groupBy("observed").agg(
        F.max("exact").alias("exact"),
        F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct("sequence", "barcode"), F.col("exact").cast("int")).alias("key"),
    )
    kept = best.filter("exact or n = 1")
    return kept.select(
        "observed",
        F.struct(F.col("key.sequence").alias("seq"), F.col("key.barcode").alias("name"), F.when(F.col("exact"), "Correct").otherwise("Corrected").alias("status")).alias("hit"),
    )


def match_rescue(df: DataFrame, seq: str, sheet: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: the exact key, else the only key within padded distance 1 (``Corrected``), else null."""
    near = rescue_map(sheet).select(F.col("observed").alias("__seen"), F.col("hit").alias(out))
    return df.join(small(near, padded_rows(sheet, "sequence")), F.col(seq) == F.col("__seen"), "left").drop("__seen")


def comparable(s: Column) -> Column:
    """Upper case, and one sign for every letter outside the alphabet, which then equals no key's letter."""
    return F.regexp_replace(F.upper(s), f"[^{ALPHABET}]", FOREIGN)


def min_hamming_rows(whitelist: DataFrame, most: int) -> int:
    """How many rows ``min_hamming_map`` has at most."""
    n, length = whitelist.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("sequence")), F.lit(0))).first()
    return n * sum(comb(length, k) * len(ALPHABET) ** k for k in range(most + 1))


def min_hamming_map(whitelist: DataFrame, most: int) -> DataFrame:
    """``observed`` to ``distance`` and all ``matches`` at the smallest distance of at most ``most``.

    One letter of every string so far is replaced in turn, distinct strings after each turn; a letter outside
    the alphabet counts as a mismatch, see ``comparable``.
    """
    near = whitelist.select("sequence", F.col("sequence").alias("observed"), F.lit(0).alias("d")).distinct()
    letter = F.explode(F.lit([*ALPHABET, FOREIGN])).alias("c")
    for turn in range(most):
        place = near.filter(F.col("d") == turn).select("sequence", "observed", F.explode(F.sequence(F.lit(1), F.length("observed"))).alias("i")).select("*", letter)
        other = F.concat(F.expr("substring(observed, 1, i - 1)"), F.col("c"), F.expr("substring(observed, i + 1)"))
        near = near.union(place.select("sequence", other, F.lit(turn + 1))).groupBy("sequence", "observed").agg(F.min("d").alias("d"))
    least = near.groupBy("observed").agg(F.min("d").alias("distance"), F.collect_list(F.struct("d", "sequence")).alias("all"))
    ties = F.transform(F.filter("all", lambda x: x["d"] == F.col("distance")), lambda x: x["sequence"])
    return least.select("observed", "distance", F.sort_array(ties).alias("matches"))


def match_min_hamming(df: DataFrame, seq: str, whitelist: DataFrame, most: int) -> DataFrame:
    """Adds ``distance`` and ``matches`` (all keys at the smallest distance, equal length only); case does not matter."""
    near = min_hamming_map(whitelist, most).withColumnRenamed("observed", "__seen")
    return df.join(small(near, min_hamming_rows(whitelist, most)), comparable(F.col(seq)) == F.col("__seen"), "left").drop("__seen")


def correct_cb(df: DataFrame, seq: str, qual: str | None, whitelist: DataFrame, mode: str, out: str = "cb", sample: str | None = None) -> DataFrame:
    """Adds ``out``: ``seq`` corrected to the whitelist, null if rejected.

    ``Exact``: keys only. ``1MM``: else the only key at distance 1. ``1MM_multi_Nbase_pseudocounts``: else of all
    keys at distance 1 the one with at least 0.975 of the weight, (exact reads of the key + 1) times the error
    probability of the differing base. Distinct observed strings are expanded, so the whitelist may be long.
    """
    keys = whitelist.select(F.col("sequence").alias("key")).distinct()
    own = [sample] if sample else []
    seen = df.groupBy(*own, seq).agg(F.count(F.lit(1)).alias("n"))
    exact = seen.join(keys, F.col(seq) == F.col("key")).select(*own, seq, "key", "n")
    if mode == "Exact":
        found = exact.select(*own, seq, F.col("key").alias(out))
        return df.join(found, [*own, seq], "left")
    missing = seen.join(keys, F.col(seq) == F.col("key"), "left_anti")
    near = missing.select(*own, seq, F.explode(F.array_distinct(substitutions(F.col(seq)))).alias("key")).join(keys, "key")
    if mode == "1MM":
        one = near.groupBy(*own, seq).agg(F.count(F.lit(1)).alias("c"), F.min("key").alias("key")).filter("c = 1")
        found = exact.select(*own, seq, "key").unionByName(one.select(*own, seq, "key")).withColumnRenamed("key", out)
        return df.join(found, [*own, seq], "left")
    counts = exact.select(*own, F.col("key"), F.col("n").alias("exact_reads"))
    near = near.join(counts, [*own, "key"], "left").withColumn("exact_reads", F.coalesce("exact_reads", F.lit(0)))
    place = F.array_position(F.zip_with(letters(F.col(seq)), letters(F.col("key")), lambda a, b: a != b), F.lit(True)).cast("int")
    options = near.groupBy(*own, seq).agg(F.collect_list(F.struct("key", "exact_reads", place.alias("at"))).alias("options"))
    joined = df.join(options, [*own, seq], "left").join(exact.select(*own, seq, F.col("key").alias("__exact")), [*own, seq], "left")
    quality = phred(qual) if qual else None
    error = (lambda at: F.pow(F.lit(10.0), -F.element_at(quality, at) / 10)) if qual else (lambda at: F.lit(1.0))
    weights = F.transform("options", lambda o: F.struct(((o["exact_reads"] + 1) * error(o["at"])).alias("w"), o["key"].alias("key")))
    joined = joined.withColumn("__w", weights)
    total = F.aggregate("__w", F.lit(0.0), lambda s, o: s + o["w"])
    top = F.array_max("__w")
    return joined.withColumn(out, F.coalesce("__exact", F.when(top["w"] >= 0.975 * total, top["key"]))).drop("options", "__exact", "__w")


def correct_segments(df: DataFrame, segments: list[tuple[str, str | None]], whitelist: DataFrame, mode: str, out: str = "cb", sample: str | None = None, sep: str = "") -> DataFrame:
    """Adds ``out``: the corrected segments of a barcode, joined by ``sep``; null if one of them is rejected.

    ``segments`` are the columns of each segment's sequence and quality (or null), in the order of ``whitelist``'s segment
    1, 2, ...; modes as in ``correct_cb``. Each distinct (sample, segment, sequence) is corrected once, and distinct barcodes,
    not reads, are taken apart and put together again; reads meet them in one join.
    """
    own, seqs = [sample] if sample else [], [s for s, _ in segments]
    whole = df.groupBy(*own, *seqs).agg(F.count(F.lit(1)).alias("n"))
    parts = F.posexplode(F.array(*[F.col(s) for s in seqs])).alias("at", "seq")
    long = whole.select(*own, *seqs, "n", parts).withColumn("segment", F.col("at") + 1).drop("at")
    keys = whitelist.select("segment", F.col("sequence").alias("key")).distinct()
    own_segment = [*own, "segment"]
    seen = long.groupBy(*own_segment, "seq").agg(F.sum("n").alias("n"))
    exact = seen.join(keys.withColumn("seq", F.col("key")), ["segment", "seq"]).select(*own_segment, "seq", "key", "n")
    options = exact.select(*own_segment, "seq", F.array(F.struct("key", F.lit(0).cast("long").alias("exact_reads"), F.lit(0).alias("place"))).alias("options"))
    if mode != "Exact":
        missing = seen.join(exact.select(*own_segment, "seq"), [*own_segment, "seq"], "left_anti")
        near = missing.select(*own_segment, "seq", F.explode(F.array_distinct(substitutions(F.col("seq")))).alias("key")).join(keys, ["segment", "key"])
        near = near.join(exact.select(*own_segment, "key", F.col("n").alias("exact_reads")), [*own_segment, "key"], "left").withColumn("exact_reads", F.coalesce("exact_reads", F.lit(0)))
        place = F.array_position(F.zip_with(letters(F.col("seq")), letters(F.col("key")), lambda a, b: a != b), F.lit(True)).cast("int")
        near = near.groupBy(*own_segment, "seq").agg(F.collect_list(F.struct("key", "exact_reads", place.alias("place"))).alias("options"))
        options = options.unionByName(near.filter(F.size("options") == 1) if mode == "1MM" else near)
    found = long.join(options, [*own_segment, "seq"]).groupBy(*own, *seqs).agg(F.sort_array(F.collect_list(F.struct("segment", "options"))).alias("__found")).filter(F.size("__found") == len(segments))
    joined = df.join(found, [*own, *seqs], "left")

    def best(k: int, qual: str | None) -> Column:
        quality = phred(qual) if qual else None
        error = (lambda at: F.when(at == 0, 1.0).otherwise(F.pow(F.lit(10.0), -F.element_at(quality, F.greatest(at, F.lit(1))) / 10))) if qual else (lambda at: F.lit(1.0))
        weights = F.transform(F.get("__found", F.lit(k))["options"], lambda o: F.struct(((o["exact_reads"] + 1) * error(o["place"])).alias("w"), o["key"].alias("key")))
        top, total = F.array_max(weights), F.aggregate(weights, F.lit(0.0), lambda s, o: s + o["w"])
        return F.when(top["w"] >= 0.975 * total, top["key"])

    corrected = [best(k, qual).alias(f"__s{k}") for k, (_, qual) in enumerate(segments)]
    joined = joined.select("*", *corrected)
    names = [f"__s{k}" for k in range(len(segments))]
    none = F.exists(F.array(*names), lambda x: x.isNull())
    return joined.withColumn(out, F.when(F.col("__found").isNotNull() & ~none, F.concat_ws(sep, *names))).drop("__found", *names)


def demux_index(df: DataFrame, index: str, barcode: str, most: int = 1) -> DataFrame:
    """Reads whose index is within ``most`` mismatches of the barcode's reverse complement, equal length."""
    return df.filter(hamming(F.col(index), revcomp(F.lit(barcode))) <= most)


def subset_by_id(mates: DataFrame, matched: DataFrame, key: str = "read_id") -> DataFrame:
    return mates.join(matched.select(key), key, "left_semi")


def first_of(df: DataFrame, key, order) -> DataFrame:
    """The first row of each key by an explicit order."""
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*([order] if isinstance(order, str | Column) else order))
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
