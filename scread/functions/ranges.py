"""Expansion of well and index specifications into single positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COLUMNS = 12


def _row(x: Column) -> Column:
    return F.ascii(F.substring(x, 1, 1))


def _wells(rows: Column, columns: Column) -> Column:
    return F.flatten(F.transform(rows, lambda r: F.transform(columns, lambda c: F.concat(F.char(r), c.cast("string")))))


def expand_wells(spec, mode: str = "block") -> Column:
    """Wells of ``A1-A6,B1:D3,C4``: ``,`` or ``;`` between parts, ``-`` or ``:`` inside.

    A part is the block between its corners. With ``mode='range'`` a hyphen means all wells from the first
    to the last, row by row.
    """
    spec = F.col(spec) if isinstance(spec, str) else spec
    parts = F.filter(F.split(F.replace(F.regexp_replace(F.upper(spec), r"\s", ""), F.lit(";"), F.lit(",")), ","), lambda p: p != "")

    def expand(p):
        a = F.regexp_extract(p, r"^([A-Z]\d+)", 1)
        b = F.regexp_extract(p, r"([A-Z]\d+)$", 1)
        ra, rb = _row(a), _row(b)
        ca, cb = (F.regexp_extract(x, r"(\d+)$", 1).cast("int") for x in (a, b))
        block = _wells(F.sequence(F.least(ra, rb), F.greatest(ra, rb)), F.sequence(F.least(ca, cb), F.greatest(ca, cb)))
        if mode != "range":
            return block
        at = lambda r, c: (r - 65) * _COLUMNS + c - 1
        run = F.transform(F.sequence(at(ra, ca), at(rb, cb)), lambda i: F.concat(F.char(F.floor(i / _COLUMNS).cast("int") + 65), (i % _COLUMNS + 1).cast("string")))
        return F.when(p.contains("-"), run).otherwise(block)

    return F.flatten(F.transform(parts, expand))


_ID = r"^(?:(P\d+)-)?([A-Z])(\d{2})$"


def index_parts(x: Column) -> Column:
    """plate, row and column of ``A01`` or ``P01-A01``; null if malformed."""
    return F.when(
        x.rlike(_ID),
        F.struct(F.regexp_extract(x, _ID, 1).alias("plate"), F.regexp_extract(x, _ID, 2).alias("row"), F.regexp_extract(x, _ID, 3).cast("int").alias("col")),
    )


def index_problem(part: Column, kind: str) -> Column:
    """Why one part of an index specification can't be expanded; null if it can."""
    ends = F.split(part, ":")
    a, b = index_parts(F.get(ends, F.lit(0))), index_parts(F.element_at(ends, -1))
    problem = F.when((F.size(ends) > 2) | a.isNull() | b.isNull(), "malformed").when((a["row"] > b["row"]) | (a["col"] > b["col"]), "start after end")
    if kind == "p7":
        return problem.when(a["row"] != b["row"], "not in one row")
    if kind == "p5":
        return problem.when(a["col"] != b["col"], "not in one column")
    return problem.when(a["plate"] != b["plate"], "not on one plate")


def expand_indices(spec, kind: str) -> Column:
    """Ids of ``A01:A12`` (p7: one row), ``A01:H01`` (p5: one column) or ``P01-A01:P01-H12`` (rt: a block); bad parts vanish."""
    spec = F.col(spec) if isinstance(spec, str) else spec
    parts = F.filter(F.split(F.regexp_replace(spec, r"\s", ""), ","), lambda p: p != "")

    def expand(p):
        ends = F.split(p, ":")
        a, b = index_parts(F.get(ends, F.lit(0))), index_parts(F.element_at(ends, -1))
        plate = F.when(a["plate"] != "", F.concat(a["plate"], F.lit("-"))).otherwise("")
        rows, cols = F.sequence(F.ascii(a["row"]), F.ascii(b["row"])), F.sequence(a["col"], b["col"])
        return F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: F.concat(plate, F.char(r), F.lpad(c.cast("string"), 2, "0")))))

    good = F.filter(parts, lambda p: index_problem(p, kind).isNull())
    return F.flatten(F.transform(good, expand))
