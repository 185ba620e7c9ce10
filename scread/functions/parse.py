"""Column functions that read numbers out of reports and write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_int(x) -> Column:
    """Integer text without thousands separators and percent signs; null if it is no integer."""
    s = F.trim(F.regexp_replace(_c(x).cast("string"), "[,%]", ""))
    return F.when(s.rlike(r"^[+-]?\d+$"), s).try_cast("bigint")


def clean_float(x) -> Column:
    return F.trim(F.regexp_replace(_c(x).cast("string"), "%", "")).try_cast("double")


def to_pct(x) -> Column:
    """A fraction as a percentage with two decimals, exact halves to even; null becomes empty text."""
    p = _c(x).cast("double") * 100
    # exact halves are odd eighths: those that the formatter would round up to an odd digit go down
    down = F.pmod(p * 8, F.lit(4.0)) == 1
    return F.when(_c(x).isNull(), "").otherwise(F.format_string("%.2f%%", p - F.when(down, 0.001).otherwise(0.0)))


def safe_fraction(n, d) -> Column:
    return F.try_divide(_c(n).cast("double"), _c(d).cast("double"))


def ratio4(n, d) -> Column:
    """A ratio as text with four decimals; null on a zero denominator."""
    return F.when(_c(d) != 0, F.format_string("%.4f", safe_fraction(n, d)))


def first_truthy(*columns) -> Column:
    """The first value that is neither null nor zero."""
    return F.coalesce(*[F.nullif(_c(c), F.lit(0)) for c in columns])


def unwrap_js(x) -> Column:
    """The JSON text of ``var data = {...};``."""
    return F.regexp_extract(_c(x), r"(?s)var\s+data\s*=\s*(\{.*\})\s*;?", 1)
