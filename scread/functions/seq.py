"""Column functions on nucleotide and quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def letters(s) -> Column:
    return F.split(_c(s), "")


COMPLEMENT = dict(zip("ACGTacgt", "TGCAtgca"))


def revcomp(s) -> Column:
    """Reverse complement; N and other letters stay."""
    return F.reverse(F.translate(_c(s), "".join(COMPLEMENT), "".join(COMPLEMENT.values())))


def hamming(a, b) -> Column:
    """Mismatches of strings of one length; null if lengths differ."""
    a, b = _c(a), _c(b)
    d = F.aggregate(F.zip_with(letters(a), letters(b), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, v: s + v)
    return F.when(F.length(a) == F.length(b), F.when(F.length(a) == 0, F.lit(0)).otherwise(d))


def hamming_padded(a, b) -> Column:
    """Mismatches plus the difference in length."""
    a, b = _c(a), _c(b)
    d = F.aggregate(F.zip_with(letters(a), letters(b), lambda x, y: (~x.eqNullSafe(y)).cast("int")), F.lit(0), lambda s, v: s + v)
    return F.when(a.isNotNull() & b.isNotNull(), F.when((F.length(a) == 0) | (F.length(b) == 0), F.greatest(F.length(a), F.length(b))).otherwise(d))


def phred(q) -> Column:
    """Quality string to an array of scores."""
    return F.when(F.length(_c(q)) == 0, F.array().cast("array<int>")).otherwise(F.transform(letters(q), lambda c: F.ascii(c) - 33))


def q_rate(q, least: int) -> Column:
    """Share of bases with at least this quality."""
    scores = phred(q)
    return F.try_divide(F.size(F.filter(scores, lambda v: v >= least)), F.size(scores))


def gc(s) -> Column:
    s = _c(s)
    return F.try_divide(F.length(s) - F.length(F.translate(s, "GCgc", "")), F.length(s))


def n_count(s) -> Column:
    return F.length(_c(s)) - F.length(F.replace(_c(s), F.lit("N"), F.lit("")))


def n_fraction(s) -> Column:
    return F.try_divide(n_count(s), F.length(_c(s)))


def has_n(s) -> Column:
    return _c(s).contains("N")


def is_acgt(s) -> Column:
    return _c(s).rlike("^[ACGT]+$")


def poly_a_start(s, run: int = 4) -> Column:
    """0-based start of the first run of ``A``; null if there is none."""
    at = F.instr(_c(s), "A" * run)
    return F.when(at > 0, at - 1)


def trim_varbases(seq, qual) -> tuple[Column, Column]:
    """Sequence and quality without one leading A, GT or TCA."""
    seq, qual = _c(seq), _c(qual)
    n = F.when(seq.startswith("A"), 1).when(seq.startswith("GT"), 2).when(seq.startswith("TCA"), 3).otherwise(0)
    rest = lambda s: F.substring(s, n + 1, F.length(s))
    return rest(seq), rest(qual)


def header_indices(comment) -> tuple[Column, Column]:
    """(p7, p5) from the last field of a header comment such as ``1:N:0:p7+p5``."""
    pair = F.split(F.element_at(F.split(_c(comment), ":"), -1), r"\+")
    return F.get(pair, F.lit(0)), F.get(pair, F.lit(1))


def read_id(name) -> Column:
    """Header line without ``@`` and all after the first space."""
    return F.regexp_extract(_c(name), r"^@?([^ ]*)", 1)


def mate_path(path) -> Column:
    """The second mate's path: the last R1 becomes R2; an error if there is none."""
    path = _c(path)
    return F.when(path.contains("R1"), F.regexp_replace(path, "^(.*)R1", "$1R2")).otherwise(F.raise_error(F.concat(F.lit("no R1 in "), path)))


def first_word(s, sep: str = " ") -> Column:
    return F.substring_index(_c(s), sep, 1)


def splice_status(target) -> Column:
    """U for intron targets, whose ids contain a hyphen, else S."""
    return F.when(_c(target).contains("-"), "U").otherwise("S")


_OPS = r"(\d+)([MIDNSHP=X])"


def cigar_ops(cigar) -> Column:
    """Array of (n, op)."""
    c = _c(cigar)
    return F.zip_with(
        F.transform(F.regexp_extract_all(c, F.lit(_OPS), F.lit(1)), lambda x: x.cast("int")),
        F.regexp_extract_all(c, F.lit(_OPS), F.lit(2)),
        lambda n, op: F.struct(n.alias("n"), op.alias("op")),
    )


def cigar_blocks(pos, cigar) -> Column:
    """Aligned reference blocks (start, end), 1-based closed; N separates blocks and D bridges them."""
    zero = F.struct(_c(pos).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("blocks"), F.lit(True).alias("new"))

    def step(acc, x):
        covers = x["op"].isin("M", "=", "X", "D")
        end = acc["at"] + x["n"] - 1
        last = F.element_at(acc["blocks"], -1)
        grown = F.concat(F.slice(acc["blocks"], 1, F.size(acc["blocks"]) - 1), F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
        opened = F.concat(acc["blocks"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"))))
        return F.struct(
            F.when(covers | (x["op"] == "N"), acc["at"] + x["n"]).otherwise(acc["at"]).alias("at"),
            F.when(covers, F.when(acc["new"], opened).otherwise(grown)).otherwise(acc["blocks"]).alias("blocks"),
            F.when(covers, F.lit(False)).when(x["op"] == "N", F.lit(True)).otherwise(acc["new"]).alias("new"),
        )

    return F.aggregate(cigar_ops(cigar), zero, step, lambda acc: acc["blocks"])


def spliced_length(cigar) -> Column:
    """Reference bases under M, = and X."""
    kept = F.filter(cigar_ops(cigar), lambda x: x["op"].isin("M", "=", "X"))
    return F.aggregate(kept, F.lit(0), lambda s, x: s + x["n"])


def trim_adapter(seq, adapter: str, least: int = 3, error: float = 0.1) -> Column:
    """Bases to keep: the read is cut where its rest first matches the adapter's start with few mismatches."""
    seq = _c(seq)
    n = F.length(seq)
    starts = F.when(n >= least, F.sequence(F.lit(1), n - least + 1)).otherwise(F.array().cast("array<int>"))

    def fits(i):
        rest = F.substring(seq, i, F.length(seq))
        m = F.least(F.length(rest), F.lit(len(adapter)))
        return hamming(F.substring(rest, F.lit(1), m), F.substring(F.lit(adapter), F.lit(1), m)) <= F.floor(m * error)

    at = F.get(F.filter(starts, fits), F.lit(0))
    return F.coalesce(at - 1, n)


def overlap_insert(r1, r2, least: int = 30, most: int = 5, share: float = 0.2) -> Column:
    """The smallest insert at which the mates run into their adapters; null if none. Both are cut to it."""
    r1, r2 = _c(r1), _c(r2)
    n = F.least(F.length(r1), F.length(r2))
    lengths = F.when(n > least, F.sequence(F.lit(least), n - 1)).otherwise(F.array().cast("array<int>"))
    ok = lambda k: (lambda d: (d <= most) & (d <= share * k))(hamming(F.substring(r1, F.lit(1), k), revcomp(F.substring(r2, F.lit(1), k))))
    return F.get(F.filter(lengths, ok), F.lit(0))
