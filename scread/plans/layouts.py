"""Read layouts: where barcodes and UMIs lie, and the modes of each protocol, as a small table."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """Segments are (0-based start, length) in the barcode read, in the order in which they form the cell barcode."""

    protocol: str
    segments: list[tuple[int, int]]
    umi: tuple[int, int]
    correction: str = "1MM_multi_Nbase_pseudocounts"
    dedup: str = "1MM_CR"
    umi_filter: str = "MultiGeneUMI_CR"
    clip: str = "CellRanger4"
    min_score: int = 30
    barcode_mate: str = "R1"
    min_quality: int | None = None
    min_length: int | None = None
    adapter: str | None = field(default=None)


def closed(*bounds: tuple[int, int]) -> list[tuple[int, int]]:
    """0-based inclusive (start, end) pairs to (start, length)."""
    return [(a, b - a + 1) for a, b in bounds]


# The layouts and modes of the supported protocols.
CATALOGUE = {
    x.protocol: x
    for x in (
        Layout("10xv1", [(0, 14)], (14, 10)),
        Layout("10xv2", [(0, 16)], (16, 10)),
        Layout("10xv3", [(0, 16)], (16, 12)),
        Layout("10xv4", [(0, 16)], (16, 12)),
        Layout("oak_seq", [(0, 16)], (16, 12), barcode_mate="R2"),
        Layout("ultima_genomics", [(0, 16)], (16, 12)),
        Layout("parse_biosciences_WT_mini", closed((50, 57), (30, 37), (10, 17)), (0, 10), "1MM", barcode_mate="R2"),
        Layout("parse_biosciences_WT", closed((50, 57), (30, 37), (10, 17)), (0, 10), "1MM", barcode_mate="R2"),
        Layout("bd_rhapsody", closed((0, 8), (13, 21), (26, 34)), (35, 8), "1MM", clip="Hamming", adapter="A" * 38),
        Layout("sciRNAseq3", closed((0, 9), (10, 19), (20, 29), (30, 39)), (40, 8), "Exact", "1MM_All", "-", "Hamming", min_quality=15, min_length=10),
        Layout("seqspec", [], (0, 0), min_quality=15, min_length=10),
    )
}


def layout(protocol: str, **overrides) -> Layout:
    """A protocol's layout; overrides that are not empty win."""
    given = {k: v for k, v in overrides.items() if v not in (None, "", [])}
    return Layout(**{**asdict(CATALOGUE[protocol]), **given})


def layouts_table(spark: SparkSession, layouts=None) -> DataFrame:
    schema = (
        "protocol string, segments array<struct<start:int,len:int>>, umi struct<start:int,len:int>, correction string, dedup string, "
        "umi_filter string, clip string, min_score int, barcode_mate string, min_quality int, min_length int, adapter string"
    )
    return spark.createDataFrame([tuple(asdict(x).values()) for x in (layouts or CATALOGUE.values())], schema)


def with_layout(reads: DataFrame, layouts: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Each read's layout by ``protocol``; non-null columns of ``overrides(sample, ...)`` win. The catalogue has a row per protocol."""
    df = reads.join(F.broadcast(layouts), "protocol", "left")
    if overrides is None:
        return df
    names = [c for c in overrides.columns if c != "sample"]
    own = overrides.select("sample", *[F.col(c).alias(f"__{c}") for c in names])
    df = df.join(own, "sample", "left")
    return df.withColumns({c: F.coalesce(f"__{c}", c) for c in names}).drop(*[f"__{c}" for c in names])


def slice_segments(seq: Column, segments: Column) -> Column:
    """The concatenated segments of a sequence, for a column of (start, len)."""
    return F.array_join(F.transform(segments, lambda s: F.substring(seq, s["start"] + 1, s["len"])), "")


def slice_simple(seq, x: Layout) -> tuple[Column, Column]:
    """(cell barcode, UMI) of a layout with one segment."""
    return slice_complex(seq, x)


def slice_complex(seq, x: Layout) -> tuple[Column, Column]:
    """(cell barcode, UMI); segments are concatenated in their order."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.concat(*[F.substring(seq, a + 1, n) for a, n in x.segments]), F.substring(seq, x.umi[0] + 1, x.umi[1])


def parse_geometry(text: str) -> tuple[int, list[tuple[int, int]]]:
    """``1[51-58,31-38]`` (read, 1-based inclusive) to the read's number and (start, length) pairs."""
    found = re.fullmatch(r"(\d)\[([\d,\- ]+)\]", text.strip())
    if not found:
        raise ValueError(f"not a read geometry: {text}")
    bounds = [tuple(map(int, part.split("-"))) for part in found[2].split(",")]
    return int(found[1]), [(a - 1, b - a + 1) for a, b in bounds]


def slice_geometry(r1, r2, text: str) -> Column:
    read, parts = parse_geometry(text)
    seq = F.col(r1 if read == 1 else r2)
    return F.concat(*[F.substring(seq, a + 1, n) for a, n in parts])


# Amplicon templates; digits mark barcode rounds, N the UMI.
AMPLICONS = {
    "v1": "NNNNNNNNNN33333333GTGGCCGATGTTTCGCATCGGCGTACGACT22222222ATCCACGTGCTTGAGACTGTGG11111111",
    "v3": "NNNNNNNNNN33333333ATGAGGGGTCAG22222222TCCAACCACCTC11111111",
}


def bc1_bounds(chemistry: str | None, default: tuple[int, int] = (50, 58)) -> tuple[int, int]:
    """(start, end) of the first-round barcode from the chemistry's template."""
    if not chemistry:
        return default
    template = AMPLICONS["v3" if chemistry.lower().strip() in ("v3", "3") else "v1"]
    return template.index("1"), template.rindex("1") + 1


def assign_roles(pairs: DataFrame, barcode_mate: str) -> DataFrame:
    """bc_seq, bc_qual, cdna_seq and cdna_qual from the mates' columns."""
    bc, cdna = ("r1", "r2") if barcode_mate == "R1" else ("r2", "r1")
    return pairs.withColumnsRenamed({f"{bc}_seq": "bc_seq", f"{bc}_qual": "bc_qual", f"{cdna}_seq": "cdna_seq", f"{cdna}_qual": "cdna_qual"})


def first_read_len(reads: DataFrame, seq: str = "r2_seq", order: str = "pair_id") -> DataFrame:
    return reads.agg(F.min_by(F.length(seq), order).alias("read_length"))
