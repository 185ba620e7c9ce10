"""Quality rules with cross-document line frequency, DataFrame functions only.

Lines are normalised and hashed; a line that occurs in more distinct documents of a host than the
host's limit is removed, and a document of which too little is left is rejected. The base rules look
at one document alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_words, stage

SPACES = " \t\n\x0b\x0c\r"
RUN = r"[\x20\x09-\x0D]+"
MIN_DOCS = 5
DOC_SHARE = 0.0
LEAST_LEFT = 0.75
LONG_WORDS = 1 << 16


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``ws``: words in 3-word windows found twice or more in the text.

    A window's hash and place share one long, so that one primitive sort brings equal windows together;
    the place takes as many bits as the text needs. Texts of more than ``LONG_WORDS`` words, for which too few
    bits of the hash would be left, sort whole hashes with their places instead. Arrays reach the lambdas as
    arguments, never as outer references that would be evaluated for each element.
    """
    hashed = F.transform("ws", lambda w: F.xxhash64(w))
    df = df.withColumn("hw", hashed)
    df = df.withColumn("hp", F.zip_with("hw", F.expr("slice(hw, 2, greatest(size(hw), 1))"), lambda a, b: F.xxhash64(a, b)))
    windows = F.zip_with("hp", F.expr("slice(hp, 2, greatest(size(hp), 1))"), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("bits", F.ceil(F.log2(F.col("n_words") + 1)).cast("int"))
    df = df.withColumn("tri", F.slice(windows, F.lit(1), F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))))
    packed = F.zip_with(
        "tri",
        F.when(F.col("n_words") > 2, F.sequence(F.lit(0).cast("long"), F.col("n_words") - 3)).otherwise(F.array().cast("array<bigint>")),
        lambda h, i: F.coalesce(F.call_function("shiftleft", h, F.col("bits")).bitwiseOR(i), F.lit(0).cast("long")),
    )
    long = F.col("n_words") > LONG_WORDS
    whole = F.sort_array(F.transform("tri", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("p"))))
    df = df.withColumn("sorted", F.when(~long, F.sort_array(packed))).withColumn("whole", F.when(long, whole))
    later = F.expr("slice(sorted, 2, greatest(size(sorted), 1))")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1

    def twins(keep: str) -> Column:
        same = lambda x, y: F.call_function("shiftright", x, F.col("bits")) == F.call_function("shiftright", y, F.col("bits"))
        pick = F.zip_with("sorted", later, lambda x, y: F.when(same(x, y), (x if keep == "x" else y).bitwiseAND(F.col("mask"))))
        other = F.zip_with("whole", F.expr("slice(whole, 2, greatest(size(whole), 1))"), lambda x, y: F.when(x["h"] == y["h"], (x if keep == "x" else y)["p"]))
        return F.filter(F.when(long, other).otherwise(pick), lambda v: v.isNotNull())

    df = df.withColumn("mask", mask).withColumn("firsts", twins("x"))
    places = F.when(F.size("firsts") > 0, F.sort_array(F.array_union("firsts", twins("y")))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("places", places)
    gaps = F.zip_with("places", F.expr("slice(places, 2, greatest(size(places), 1))"), lambda x, y: F.least(F.coalesce(y - x, F.lit(3).cast("long")), F.lit(3).cast("long")))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.when(F.size("places") > 0, covered).otherwise(F.lit(0).cast("long")))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, source, text and ``rk``, equal only for rows that repeat."""
    d = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    return d.withColumn("rk", F.xxhash64("doc_id", F.col("source").isNull(), "source", "text"))


def base_rules(docs: DataFrame) -> DataFrame:
    """rk, doc_id and the base columns of every row."""
    d = _keyed(docs)
    trimmed = F.btrim("text", F.lit(SPACES))
    ws = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, RUN))
    d = d.select("rk", "doc_id", "text", ws.alias("ws"))
    d = d.withColumn("n_words", F.size("ws").cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.withColumn("lines", lines)
    d = d.select(
        "rk",
        "doc_id",
        "ws",
        "n_words",
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    d = _repeated_words(d)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.select("rk", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def document_lines(docs: DataFrame) -> DataFrame:
    """host, key (hash of host and normalised line), doc_id, rk, words: one row per distinct line of a document."""
    d = _keyed(docs)
    plain = F.regexp_replace(F.lower("text"), r"[\x20\x09\x0B-\x0D]+", " ")
    lines = d.select("doc_id", "rk", F.coalesce("source", F.lit("\0")).alias("host"), F.posexplode(F.split(plain, "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(" "))).filter("line != ''")
    lines = lines.select("host", F.xxhash64("host", "line").alias("key"), "doc_id", "rk", "pos", n_words(F.col("line")).alias("words"))
    # repeated rows are one document: its lines count once each
    own = ["host", "key", "doc_id", "rk"]
    lines = lines.repartition(*own).dropDuplicates([*own, "pos"])
    return lines.groupBy(*own).agg(F.sum("words").alias("words"))


def line_rules(docs: DataFrame, min_docs: int = MIN_DOCS, doc_share: float = DOC_SHARE, least_left: float = LEAST_LEFT) -> DataFrame:
    """Base columns, ``n_removed_words`` and ``kept`` for every row of ``docs`` (doc_id, source, text).

    A host (the source; null is a host of its own) removes a line found in more than ``min_docs`` of its distinct
    documents and, if ``doc_share`` is set, in more than that share of them. A document is kept if it passes the
    base rules and more than ``least_left`` of its words are left. Null text is empty. Rows that repeat with equal
    id, source and text are one document with one verdict; rows are told apart by id and a hash of the rest. Extra
    columns are not read; an empty table gives no rows.
    """
    lines = stage(document_lines(docs), "line-rules")
    frequent = lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > min_docs)
    if doc_share:
        hosts = _keyed(docs).select(F.coalesce("source", F.lit("\0")).alias("host"), "doc_id", "rk").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
        frequent = frequent.join(hosts, "host").filter(F.col("n_docs") > doc_share * F.col("host_docs"))
    removed = lines.join(frequent.select("host", "key"), ["host", "key"]).groupBy("doc_id", "rk").agg(F.sum("words").alias("n_removed_words"))
    removed = removed.withColumnsRenamed({"doc_id": "__id", "rk": "__rk"})
    base = base_rules(docs)
    out = base.join(removed, (base["rk"] == F.col("__rk")) & base["doc_id"].eqNullSafe(F.col("__id")), "left").drop("__id", "__rk")
    out = out.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_removed_words") > least_left * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & left).drop("rk")


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    return line_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
i AS (SELECT doc_id, host, text, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM w),
t AS (SELECT doc_id, host, text, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM i),
r AS (SELECT doc_id, host, text, i, count(*) OVER (PARTITION BY doc_id, host, text, g) AS c FROM t),
p AS (SELECT doc_id, host, text, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, host, text, unnest([i, i + 1, i + 2]) AS q FROM r WHERE c >= 2) GROUP BY ALL),
l AS (SELECT doc_id, host, text, trim(x, ' ') AS line FROM (SELECT doc_id, host, text,
  unnest(string_split(regexp_replace(lower(text), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS x FROM d)),
c AS (SELECT host, line, count(DISTINCT (doc_id, text)) AS n FROM l WHERE line <> '' GROUP BY ALL),
f AS (SELECT host, line FROM c WHERE n > 5),
x AS (SELECT doc_id, host, text, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS n_removed_words
  FROM l JOIN f USING (host, line) GROUP BY ALL),
b AS (SELECT o.doc_id, len(w.ws) AS n_words, length(array_to_string(w.ws, '')) AS word_chars,
  len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS n_symbols,
  len(list_filter(string_split(w.text, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')))
    - len(list_distinct(list_filter(string_split(w.text, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
  coalesce(p.n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(x.n_removed_words, 0) AS BIGINT) AS n_removed_words
  FROM documents o JOIN w ON o.doc_id IS NOT DISTINCT FROM w.doc_id AND coalesce(o.source, chr(1)) = w.host AND coalesce(o.text, '') = w.text
  LEFT JOIN p ON w.doc_id IS NOT DISTINCT FROM p.doc_id AND w.host = p.host AND w.text = p.text
  LEFT JOIN x ON w.doc_id IS NOT DISTINCT FROM x.doc_id AND w.host = x.host AND w.text = x.text)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words > 0.75 * n_words AS kept
FROM b
"""
