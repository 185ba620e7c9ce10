"""Adapter and overlap trimming of read pairs by bit-parallel comparison of whole batches.

The letters of a batch are numbered, and each bit of the numbers of all letters of a read makes a bit string, a
read's planes. Two stretches of reads differ where any of their planes do, so shifting, XOR and counting
bits compares 64 positions at once, and all reads of a batch in one operation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seq import COMPLEMENT

_BLOCK = 8_192


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a row of letters each, 0 behind its end; lengths) of a string column; null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.uint8)
    inside = np.arange(out.shape[1]) < lengths[:, None]
    out[inside] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else 0
    return out, lengths


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, the first bit lowest, with an empty word behind."""
    n, width = bits.shape
    words = width // 64 + 2
    out = np.zeros((n, words * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view("<u8")


def _shifted(words: np.ndarray, s: int, width: int) -> np.ndarray:
    """The first ``width`` words of all rows moved down by ``s`` bits."""
    w, b = divmod(s, 64)
    part = words[:, w : w + width + 1]
    if part.shape[1] <= width:
        part = np.pad(part, ((0, 0), (0, width + 1 - part.shape[1])))
    return part[:, :width] if not b else (part[:, :width] >> np.uint64(b)) | (part[:, 1 : width + 1] << np.uint64(64 - b))


class Planes:
    """Bit planes of rows of letters; ``codes`` numbers the letters that occur."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
        numbered = codes[letters]
        self.planes = [_packed((numbered >> k) & 1) for k in range(max(1, int(codes.max()).bit_length()))]
        self.inside = _packed(np.arange(letters.shape[1]) < lengths[:, None])

    def differ(self, other: Planes, s: int) -> np.ndarray:
        """Mismatches of these rows from position s on with ``other`` from its begin, as far as both go."""
        width = other.inside.shape[1]
        unlike = _shifted(self.planes[0], s, width) ^ other.planes[0]
        for mine, theirs in zip(self.planes[1:], other.planes[1:]):
            unlike |= _shifted(mine, s, width) ^ theirs
        return np.bitwise_count(unlike & _shifted(self.inside, s, width) & other.inside).sum(1, dtype=np.int64)


def _codes(*letters: np.ndarray) -> np.ndarray:
    """A number from 0 for each letter that occurs."""
    seen = np.zeros(256, bool)
    for x in letters:
        seen |= np.bincount(x.ravel(), minlength=256) > 0
    return np.where(seen, np.cumsum(seen) - 1, 0).astype(np.uint8)


def adapter_cuts(letters: np.ndarray, lengths: np.ndarray, adapter: bytes, least: int, error: float) -> np.ndarray:
    """Bases to keep of each read: up to the first position whose rest, of at least ``least``, matches the adapter's begin."""
    wanted = np.frombuffer(adapter, np.uint8)[None, :]
    codes = _codes(letters, wanted)
    reads, end = Planes(letters, lengths, codes), Planes(wanted, np.array([len(adapter)]), codes)
    keep, open_ = lengths.copy(), np.ones(len(lengths), bool)
    for s in range(letters.shape[1] - least + 1):
        overlap = np.minimum(lengths - s, len(adapter))
        hit = open_ & (lengths - s >= least) & (reads.differ(end, s) <= np.floor(overlap * error))
        keep[hit] = s
        open_ &= ~hit
    return keep


def inserts(one: np.ndarray, n1: np.ndarray, two: np.ndarray, n2: np.ndarray, least: int, most: int, share: float) -> np.ndarray:
    """The smallest insert of each pair, from ``least`` to below both lengths, whose two reads agree; 0 if none does.

    The first read backwards from the insert's end is set against the complement of the second.
    """
    width = one.shape[1]
    back = one[np.arange(len(n1))[:, None], np.maximum(n1[:, None] - 1 - np.arange(width), 0)] if width else one
    complement = np.arange(256, dtype=np.uint8)
    for a, b in COMPLEMENT.items():
        complement[ord(a)] = ord(b)
    other = complement[two]
    codes = _codes(back, other)
    mine, theirs = Planes(back, n1, codes), Planes(other, n2, codes)
    found = np.zeros(len(n1), np.int64)
    for s in range(1, int(n1.max(initial=0)) - least + 1):
        length = n1 - s
        n = mine.differ(theirs, s)
        found = np.where((length >= least) & (length < n2) & (n <= most) & (n <= share * length), length, found)
    return found


def single_cuts(adapter: str, least: int, error: float):
    """An Arrow function of sequences: bases to keep of each, null of null."""

    def cuts(reads: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(reads), _BLOCK):
            block = reads.slice(at, _BLOCK)
            letters, lengths = _bytes_of(block)
            parts.append(pa.array(adapter_cuts(letters, lengths, adapter.encode(), least, error), pa.int32(), mask=block.is_null().to_numpy(zero_copy_only=False)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.int32())

    return F.arrow_udf(cuts, "int")


def pair_cuts(adapters: tuple[str | None, str | None], least: int, error: float, min_insert: int, most: int, share: float):
    """An Arrow function of both mates' sequences: insert (null: none) and bases to keep of each."""

    def cuts(r1: pa.Array, r2: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(r1), _BLOCK):
            (a, n1), (b, n2) = _bytes_of(r1.slice(at, _BLOCK)), _bytes_of(r2.slice(at, _BLOCK))
            insert = inserts(a, n1, b, n2, min_insert, most, share)
            keeps = [np.where(insert > 0, insert, adapter_cuts(x, n, adapter.encode(), least, error) if adapter else n) for x, n, adapter in ((a, n1, adapters[0]), (b, n2, adapters[1]))]
            parts.append(pa.StructArray.from_arrays([pa.array(insert, pa.int32(), mask=insert == 0), *(pa.array(k, pa.int32()) for k in keeps)], names=["insert", "keep1", "keep2"]))
        kind = pa.struct([("insert", pa.int32()), ("keep1", pa.int32()), ("keep2", pa.int32())])
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return F.arrow_udf(cuts, "insert int, keep1 int, keep2 int")


def trim_pairs(pairs: DataFrame, adapters: tuple[str | None, str | None] = (None, None), least: int = 3, error: float = 0.1, min_insert: int = 30, most: int = 5, share: float = 0.2) -> DataFrame:
    """Pairs (r1_seq, r1_qual, r2_seq, r2_qual, others as they are) with both mates and their qualities cut; adds ``insert``, ``r1_trim`` and ``r2_trim``.

    Where the mates show an insert shorter than both, both are cut to it (reason ``overlap``); else each mate at its own
    adapter, if one is given (reason ``adapter``). A mate that is not cut has no reason. Null sequences stay null.
    """
    cut = pairs.withColumn("__cut", pair_cuts(adapters, least, error, min_insert, most, share)("r1_seq", "r2_seq"))
    out = cut.withColumn("insert", F.col("__cut.insert"))
    for k in (1, 2):
        keep = F.col(f"__cut.keep{k}")
        shorter = keep < F.length(f"r{k}_seq")
        out = out.withColumn(f"r{k}_trim", F.when(shorter & F.col("__cut.insert").isNotNull(), "overlap").when(shorter, "adapter"))
    for k in (1, 2):
        out = out.withColumns({c: F.substring(c, F.lit(1), F.col(f"__cut.keep{k}")) for c in (f"r{k}_seq", f"r{k}_qual")})
    return out.drop("__cut")


def trim_counts(trimmed: DataFrame) -> DataFrame:
    """mate, reason and reads, bases left, of trimmed pairs."""
    mates = [trimmed.select(F.lit(f"r{k}").alias("mate"), F.coalesce(f"r{k}_trim", F.lit("none")).alias("reason"), F.length(f"r{k}_seq").alias("n")) for k in (1, 2)]
    return mates[0].unionByName(mates[1]).groupBy("mate", "reason").agg(F.count(F.lit(1)).alias("reads"), F.coalesce(F.sum("n"), F.lit(0)).alias("bases"))
