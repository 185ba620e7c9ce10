"""Sanity rules of sample, barcode and hash sheets. Each returns (rule, key, detail) rows; none means it passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import expand_indices, index_problem
from ..functions.seq import is_acgt
from .tables import absent_values, union_all

# Barcode types and the columns a sample sheet needs.
TYPES = ["p5", "p7", "rt", "ligation"]
SAMPLE_COLUMNS = ["experiment_name", "p5", "p7", "rt", "sample_name", "species", "n_expected_cells"]


def _rows(df: DataFrame, rule: str, key, detail) -> DataFrame:
    col = lambda x: x if isinstance(x, Column) else F.col(x)
    return df.select(F.lit(rule).alias("rule"), col(key).cast("string").alias("key"), col(detail).cast("string").alias("detail"))


def _said(df: DataFrame, rule: str, found: list[tuple[str, str]]) -> DataFrame:
    return df.sparkSession.createDataFrame([(rule, k, d) for k, d in found], "rule string, key string, detail string")


def _empty(df: DataFrame, rule: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(rule).alias("rule"), F.lit("sheet").alias("key"), F.lit("empty").alias("detail"))


def check_barcode_sheet(b: DataFrame) -> DataFrame:
    missing = [c for c in ("type", "barcode", "sequence") if c not in b.columns]
    if missing:
        return _said(b, "barcode sheet", [(c, "missing column") for c in missing])
    return union_all(_empty(b, "barcode sheet"), _rows(absent_values(b, "type", TYPES), "barcode sheet", "type", F.lit("missing type")))


def check_dup_names(b: DataFrame) -> DataFrame:
    d = b.groupBy("type", "barcode").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _rows(d, "duplicate barcode name", F.concat_ws(":", "type", "barcode"), "n")


def check_nucleotides(b: DataFrame) -> DataFrame:
    return _rows(b.filter(~F.coalesce(is_acgt("sequence"), F.lit(False))), "only ACGT", F.concat_ws(":", "type", "barcode"), "sequence")


def check_sample_sheet(s: DataFrame) -> DataFrame:
    found = [(c, "missing column") for c in SAMPLE_COLUMNS if c not in s.columns]
    if not {"path_bcl", "path_fastq"} & set(s.columns):
        found.append(("path_bcl or path_fastq", "missing column"))
    return union_all(_said(s, "sample sheet", found), _empty(s, "sample sheet"))


def check_species(s: DataFrame, known: list[str]) -> DataFrame:
    unknown = s.select("species").distinct().filter(~F.col("species").isin(known) | F.col("species").isNull())
    many = s.groupBy("sample_name").agg(F.array_join(F.array_sort(F.collect_set("species")), ",").alias("all"), F.count_distinct("species").alias("n")).filter("n > 1")
    return union_all(_rows(unknown, "unknown species", "species", F.lit("not declared")), _rows(many, "one species per sample", "sample_name", "all"))


def check_ranges(s: DataFrame, b: DataFrame, sample: str = "sample_name") -> DataFrame:
    """Malformed parts of p5, p7 and rt, and ids the barcode sheet lacks."""
    out = []
    for kind in ("p5", "p7", "rt"):
        parts = s.select(sample, F.explode(F.split(F.regexp_replace(kind, r"\s", ""), ",")).alias("part"))
        bad = parts.withColumn("problem", index_problem(F.col("part"), kind)).filter("problem is not null")
        out.append(_rows(bad, f"{kind} range", F.concat_ws(":", sample, "part"), "problem"))
        ids = s.select(sample, F.explode(expand_indices(kind, kind)).alias("barcode"))
        unknown = ids.join(b.filter(F.col("type") == kind).select("barcode"), "barcode", "left_anti")
        out.append(_rows(unknown, f"{kind} id", sample, "barcode"))
    return union_all(*out)


def check_hash_sheets(h: DataFrame) -> DataFrame:
    missing = [c for c in ("hash_name", "barcode") if c not in h.columns]
    if missing:
        return _said(h, "hash sheet", [(c, "missing column") for c in missing])
    by = ["sample_name", "barcode"] if "sample_name" in h.columns else ["barcode"]
    return _rows(h.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "duplicate hash barcode", F.concat_ws(":", *by), "n")


def check_slice_len(whitelist: DataFrame, n: int) -> DataFrame:
    other = whitelist.groupBy(F.length("sequence").alias("len")).agg(F.count(F.lit(1)).alias("keys")).filter(F.col("len") != n)
    return _rows(other, "whitelist length", "len", "keys")


def check_endedness(s: DataFrame, mate: str = "fastq_cdna") -> DataFrame:
    kinds = s.groupBy("sample").agg(F.count_distinct(F.col(mate).isNull()).alias("n")).filter("n > 1")
    return _rows(kinds, "same endedness", "sample", F.lit("single and paired runs"))
