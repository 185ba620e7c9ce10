"""k-mer lookup by minimizers: neighbouring k-mers travel together.

The minimizer of a k-mer is the least hash of its m-mers, either strand. Consecutive k-mers of a read mostly share
it, and such a run is one super-k-mer, shuffled as one stretch of the read instead of k letters a k-mer. The
k-mer table is dealt by the same minimizers, so all exact lookups happen inside a group. References travel the same
way (`reference_hits`): their k-mers are numbers inside a group only, and no table of them is ever shuffled or written.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import folder

M = 15
GROUP_KMERS, GROUP_RUNS = 1_000_000, 500_000
#: Of references: buckets of minimizers that are counted, k-mers of reads in a group and in a partition of hits, k-mers of a stretch (a byte holds its length), letters at a time.
BUCKETS, GROUP_ASKED, TASK_ASKED, MOST, LETTERS = 1 << 16, 4_000_000, 8_000_000, 200, 1 << 20
_CODES = np.full(256, 4, np.uint8)
_CODES[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of all strings with a break behind each, their codes, where each string begins); null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(offsets)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    letters = np.zeros(begins[-1], np.uint8)
    inside = np.ones(begins[-1], bool)
    inside[begins[1:] - 1] = False
    if data is not None:
        letters[inside] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return letters, _CODES[letters], begins[:-1]


def packed(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(both strands' numbers in base 4, whether all letters are A, C, G or T) of the k letters from each place on.

    Numbers of 1, 2, 4, ... letters are made of two halves each; k is a sum of such widths.
    """
    n = max(0, len(codes) - k + 1)
    forward, back = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    one = (codes & 3).astype(np.uint64)
    other, width, done = np.uint64(3) - one, 1, 0
    while n:
        if k & width:
            forward = forward << np.uint64(2 * width) | one[done : done + n]
            back |= other[done : done + n] << np.uint64(2 * done)
            done += width
        if done == k:
            break
        one, other = one[:-width] << np.uint64(2 * width) | one[width:], other[:-width] | other[width:] << np.uint64(2 * width)
        width *= 2
    return forward, back, plain(codes, k)


def plain(codes: np.ndarray, k: int) -> np.ndarray:
    """Whether the k letters from each place on are all A, C, G or T."""
    bad = np.concatenate([[0], np.cumsum(codes > 3)])
    return bad[k:] == bad[: max(0, len(bad) - k)]


def minimizers(codes: np.ndarray, k: int, m: int) -> np.ndarray:
    """Least hash of the m-mers of the k letters from each place on."""
    one, other, good = packed(codes, m)
    h = np.minimum(one, other) * _MIX
    h ^= h >> np.uint64(29)
    h = np.where(good, h * _MIX >> np.uint64(1), np.uint64(2**63 - 1))
    width, reach = k - m + 1, 1
    while reach * 2 <= width:
        h = np.minimum(h[: len(h) - reach], h[reach:])
        reach *= 2
    left = width - reach
    return np.minimum(h[: len(h) - left], h[left:]) if left else h


class Stretches(NamedTuple):
    """Super-k-mers of a column of strings: where each begins, how many letters it has, its string and minimizer."""

    letters: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    least: np.ndarray
    place: np.ndarray  # of the start in its string


def stretches(column: pa.Array, k: int, m: int, most: int | None = None) -> Stretches:
    letters, codes, begins = _joined(column)
    if len(codes) < k:
        none = np.zeros(0, np.int64)
        return Stretches(letters, codes, none, none, none, none.astype(np.uint64), none)
    least = minimizers(codes, k, m)
    at = np.flatnonzero(plain(codes, k))
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]])
    if most:
        edges = np.flatnonzero(first)
        first |= (np.arange(len(at)) - np.repeat(edges, np.diff(np.append(edges, len(at))))) % most == 0
    starts = at[first]
    lengths = np.diff(np.append(np.flatnonzero(first), len(at))) + k - 1
    owner = np.searchsorted(begins, starts, "right") - 1
    return Stretches(letters, codes, starts, lengths, owner, least[starts], starts - begins[owner])


def _runs(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    """read, minimizer and letters of the super-k-mers of (read_id, seq)."""
    for batch in batches:
        s = stretches(batch.column(1), k, m)
        if not len(s.starts):
            continue
        ends = np.cumsum(s.lengths)
        text = s.letters[np.repeat(s.starts - ends + s.lengths, s.lengths) + np.arange(ends[-1])]
        runs = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(text)]).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(s.owner)), pa.array(s.least.astype(np.int64)), runs], names=["read_id", "minimizer", "letters"])


def _table(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    """minimizer, number and taxon of table rows (kmer, taxid); keys of another length or with other letters can't be met."""
    for batch in batches:
        _, codes, begins = _joined(batch.column(0))
        lengths = np.diff(np.append(begins, len(codes))) - 1
        rows = np.flatnonzero(lengths == k)
        if not len(rows):
            continue
        one, _, good = packed(codes, k)
        rows = rows[good[begins[rows]]]
        at = begins[rows]
        yield pa.RecordBatch.from_arrays([pa.array(minimizers(codes, k, m)[at].astype(np.int64)), pa.array(one[at].astype(np.int64)), batch.column(1).take(pa.array(rows))], names=["minimizer", "number", "taxid"])


def _lookup(k: int):
    def found(runs: pa.Table, table: pa.Table) -> pa.Table:
        if not len(runs) or not len(table):
            return runs.select(["read_id"]).slice(0, 0).append_column("taxid", table.column("taxid").slice(0, 0)).append_column("hits", pa.array([], pa.int64()))
        numbers = table.column("number").to_numpy()
        order = np.argsort(numbers, kind="stable")
        numbers = numbers[order]
        column = runs.column("letters").combine_chunks()
        _, codes, begins = _joined(column)
        one, other, good = packed(codes, k)
        mine = np.minimum(one, other).astype(np.int64)
        low, high = np.searchsorted(numbers, mine, "left"), np.searchsorted(numbers, mine, "right")
        n = np.where(good, high - low, 0)
        at = np.repeat(np.arange(len(mine)), n)
        rows = order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(at))]
        owner = np.searchsorted(begins, at, "right") - 1
        hits = pa.table({"read_id": runs.column("read_id").take(pa.array(owner)), "taxid": table.column("taxid").take(pa.array(rows))})
        return hits.group_by(["read_id", "taxid"]).aggregate([([], "count_all")]).rename_columns(["read_id", "taxid", "hits"])

    return found


def kmer_hits(reads: DataFrame, kmers: DataFrame, k: int = 31, group_kmers: int = GROUP_KMERS, group_runs: int = GROUP_RUNS) -> DataFrame:
    """read_id, taxid, hits of reads (read_id, seq) in a table (kmer: the lesser strand, taxid), k up to 31, exactly.

    k-mers with letters other than A, C, G and T are left out. Both sides are dealt by minimizer into groups of about
    ``group_kmers`` table rows; a group that more than ``group_runs`` super-k-mers meet is dealt over salts, for each of which its
    table rows are repeated.
    """
    if not 1 <= k <= 31:
        raise ValueError("k-mers of more than 31 letters don't fit in a number")
    m = min(M, max(1, k - k // 3))
    taxon = kmers.schema["taxid"].dataType.simpleString()
    kind = reads.schema["read_id"].dataType.simpleString()
    groups = max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kmers.count() // group_kmers))
    group = F.pmod("minimizer", F.lit(groups)).cast("int").alias("group")
    path = folder(reads.sparkSession, "super-kmers")
    reads.select("read_id", F.col("seq").cast("string")).mapInArrow(lambda b: _runs(b, k, m), f"read_id {kind}, minimizer long, letters string").select("read_id", "letters", group).write.parquet(path)
    runs = reads.sparkSession.read.parquet(path)
    table = kmers.select(F.col("kmer").cast("string"), "taxid").mapInArrow(lambda b: _table(b, k, m), f"minimizer long, number long, taxid {taxon}").select("number", "taxid", group)
    salts = runs.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / group_runs).cast("int").alias("salts")).filter("salts > 1")
    salted = lambda df: df.join(F.broadcast(salts), "group", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))  # noqa: E731  # at most a row per group_runs super-k-mers
    runs = salted(runs).withColumn("salt", F.pmod(F.xxhash64("letters", "read_id"), F.col("salts")).cast("int")).drop("salts")
    table = salted(table).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    met = runs.groupBy("group", "salt").cogroup(table.groupBy("group", "salt")).applyInArrow(_lookup(k), f"read_id {kind}, taxid {taxon}, hits long")
    return met.groupBy("read_id", "taxid").agg(F.sum("hits").alias("hits"))


class Deal(NamedTuple):
    """Groups of buckets; a crowded bucket has groups of its own, from ``first`` on: its k-mers in parts, for its reads each part in copies."""

    groups: int
    met: np.ndarray  # buckets that both sides have; others aren't sent
    first: np.ndarray  # -1 where a bucket shares a group
    parts: np.ndarray
    copies: np.ndarray

    @classmethod
    def of(cls, known: np.ndarray, asked: np.ndarray, least: int, group_kmers: int, group_asked: int) -> Deal:
        """By the k-mers of references and of reads in each bucket, at ``least`` so many groups."""
        groups = max(least, -(-int(known.sum()) // group_kmers), -(-int(asked.sum()) // group_asked))
        parts, copies = np.maximum(1, -(-known // group_kmers)), np.maximum(1, -(-asked // group_asked))
        met = (known > 0) & (asked > 0)
        own = parts * copies * (met & (parts * copies > 1))
        first = np.where(own > 0, groups + np.cumsum(own) - own, -1)
        return cls(groups, met, *(x.astype(np.int32) for x in (first, np.where(own > 0, parts, 1), np.where(own > 0, copies, 1))))

    @property
    def all(self) -> int:
        return self.groups + int((self.parts.astype(np.int64) * self.copies)[self.first >= 0].sum())


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows of about ``LETTERS`` letters at a time, so that long sequences make no larger arrays."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        turn = np.cumsum(lengths, dtype=np.int64) // LETTERS
        edges = [0, *(np.flatnonzero(np.diff(turn)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def _bucket_counts(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    """bucket and its k-mers, once a task."""
    n = np.zeros(BUCKETS, np.int64)
    for batch in _slices(batches, "seq"):
        s = stretches(batch.column("seq"), k, m)
        n += np.bincount(s.least.astype(np.int64) % BUCKETS, s.lengths - k + 1, BUCKETS).astype(np.int64)
    found = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(n[found])], names=["bucket", "n"])


def _cut(s: Stretches, deal: Deal, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, begin, length, bucket, first group) of what is sent: stretches, and k-mers where a bucket is in parts."""
    bucket = s.least.astype(np.int64) % BUCKETS
    n = np.where(deal.parts[bucket] > 1, s.lengths - k + 1, 1) * deal.met[bucket]
    of = np.repeat(np.arange(len(n)), n)
    starts = s.starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    bucket = bucket[of]
    parts = deal.parts[bucket]
    part = np.zeros(len(of), np.int64)
    if (cut := np.flatnonzero(parts > 1)).size:
        one, other, _ = packed(s.codes, k)
        part[cut] = (np.minimum(one, other)[starts[cut]] * _MIX >> np.uint64(33)).astype(np.int64) % parts[cut]
    group = np.where(deal.first[bucket] < 0, bucket % deal.groups, deal.first[bucket] + part * deal.copies[bucket])
    return of, starts, np.where(parts > 1, k, s.lengths[of]), bucket, group


def _fours(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters of stretches in two bits each, where each stretch begins); whole bytes a stretch, zero behind its end."""
    codes = np.append(codes & 3, np.zeros(3, np.uint8))
    four = codes[:-3] << 6 | codes[1:-2] << 4 | codes[2:-1] << 2 | codes[3:]
    n = -(-lengths // 4)
    ends = np.append(0, np.cumsum(n))
    out = four[np.repeat(starts - ends[:-1] * 4, n) + np.arange(ends[-1]) * 4]
    out[ends[1:] - 1] &= np.array([0xFF, 0xC0, 0xF0, 0xFC], np.uint8)[lengths % 4]
    return out, ends


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def _sent(codes: np.ndarray, group: np.ndarray, starts: np.ndarray, lengths: np.ndarray, more: dict[str, pa.Array]) -> pa.RecordBatch:
    """A row a group: lengths in a byte each, letters in two bits each, lists of ``more``."""
    order = np.argsort(group, kind="stable")
    group, lengths = group[order], lengths[order]
    rows = np.flatnonzero(np.diff(group, prepend=-1))
    at = np.append(rows, len(group)).astype(np.int32)
    letters, begins = _fours(codes, starts[order], lengths)
    out = {"group": pa.array(group[rows].astype(np.int32)), "sizes": _binary(lengths.astype(np.uint8), at), "letters": _binary(letters, begins[at])}
    return pa.RecordBatch.from_pydict(out | {name: pa.ListArray.from_arrays(pa.array(at), column.take(pa.array(order))) for name, column in more.items()})


def _sent_reads(batches: Iterator[pa.RecordBatch], deal: Deal, k: int, m: int) -> Iterator[pa.RecordBatch]:
    """Stretches of (read_id, seq, salt); those of a crowded bucket go to one of its copies each."""
    for batch in _slices(batches, "seq"):
        s = stretches(batch.column("seq"), k, m, MOST)
        of, starts, lengths, bucket, group = _cut(s, deal, k)
        salt = batch.column("salt").to_numpy().astype(np.uint64)[s.owner[of]] + (s.place[of] + starts - s.starts[of]).astype(np.uint64) * _MIX
        group += (salt >> np.uint64(33)).astype(np.int64) % deal.copies[bucket]
        if len(group):
            yield _sent(s.codes, group, starts, lengths, {"reads": batch.column("read_id").take(pa.array(s.owner[of]))})


def _sent_references(batches: Iterator[pa.RecordBatch], deal: Deal, k: int, m: int) -> Iterator[pa.RecordBatch]:
    """Stretches of (place, seq), equal ones of a batch once with their first and last place, in all copies of a crowded bucket."""
    for batch in _slices(batches, "seq"):
        s = stretches(batch.column("seq"), k, m, MOST)
        of, starts, lengths, bucket, group = _cut(s, deal, k)
        if not len(group):
            continue
        place = batch.column("place").fill_null(-1).take(pa.array(s.owner[of]))
        one = pa.table({"text": _binary(*_fours(s.codes, starts, lengths)), "size": lengths, "row": np.arange(len(of)), "place": place}).group_by(["text", "size"]).aggregate([("row", "min"), ("place", "min"), ("place", "max")])
        rows = one.column("row_min").to_numpy()
        n = deal.copies[bucket[rows]].astype(np.int64)
        every = np.repeat(np.arange(len(rows)), n)
        rows, copy = rows[every], np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n)
        ends = {name: one.column(f"place_{kind}").combine_chunks().take(pa.array(every)) for name, kind in (("firsts", "min"), ("lasts", "max"))}
        yield _sent(s.codes, group[rows] + copy, starts[rows], lengths[rows], ends)


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    parts = []
    for chunk in column.chunks:
        _, offsets, data = chunk.cast(pa.large_binary()).buffers()
        offsets = np.frombuffer(offsets, np.int64)
        parts.append(np.frombuffer(data, np.uint8)[offsets[chunk.offset] : offsets[chunk.offset + len(chunk)]] if data is not None else np.zeros(0, np.uint8))
    return np.concatenate([np.zeros(0, np.uint8), *parts])


def _numbers(letters: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The lesser strand's numbers of the k letters from each place on, of letters in two bits each."""
    letters = np.append(letters, np.zeros(9, np.uint8))
    byte, shift, out = at >> 2, (at & 3).astype(np.uint64) * np.uint64(2), np.uint64(64 - 2 * k)
    eight = np.ndarray(len(letters) - 8, ">u8", letters, strides=1)[byte].astype(np.uint64)
    forward = (eight << shift | letters[byte + 8].astype(np.uint64) >> np.uint64(8) - shift) >> out
    back = ~forward
    for bits, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
        back = back >> np.uint64(bits) & np.uint64(mask) | (back & np.uint64(mask)) << np.uint64(bits)
    return np.minimum(forward, back.byteswap() >> out)


def _received(rows: pa.Table, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, their stretch) of all k-mers of the rows' stretches, some stretches at a time."""
    lengths, letters = _bytes(rows.column("sizes")).astype(np.int64), _bytes(rows.column("letters"))
    ends = np.append(0, np.cumsum(-(-lengths // 4)))
    edges = [*np.searchsorted(ends, np.arange(0, ends[-1], LETTERS // 4)), len(lengths)]
    for a, b in zip(edges, edges[1:]):
        n = lengths[a:b] - k + 1
        at = np.repeat((ends[a:b] - ends[a]) * 4 - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield _numbers(letters[ends[a] : ends[b]], at, k), np.repeat(np.arange(a, b), n)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.chunked_array([chunk.flatten() for chunk in column.chunks], column.type.value_type).combine_chunks()


def _ends_met(k: int):
    def found(reads: pa.Table, references: pa.Table) -> pa.Table:
        ids, hits = _flat(reads.column("reads")), []
        if len(reads) and len(references):
            each = list(_received(references, k))
            numbers, of = (np.concatenate(x) for x in zip(*each))
            order = np.argsort(numbers, kind="stable")
            numbers, of = numbers[order], of[order]
            edges = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
            first = np.minimum.reduceat(_flat(references.column("firsts")).to_numpy()[of], edges)
            last = np.maximum.reduceat(_flat(references.column("lasts")).to_numpy()[of], edges)
            numbers, first, last = (x[first >= 0] for x in (numbers[edges], first, last))  # a reference without a place shares no ancestor
            for mine, of in _received(reads, k):
                at = np.searchsorted(numbers, mine)
                met = np.flatnonzero(numbers[np.minimum(at, len(numbers) - 1)] == mine) if len(numbers) else at[:0]
                at = at[met]
                hits.append(pa.table({"read_id": ids.take(pa.array(of[met])), "first": first[at], "last": last[at]}).group_by(["read_id", "first", "last"]).aggregate([([], "count_all")]))
        none = pa.table({"read_id": ids[:0], "first": pa.array([], pa.int32()), "last": pa.array([], pa.int32()), "hits": pa.array([], pa.int64())})
        return pa.concat_tables([none, *(x.rename_columns(none.column_names) for x in hits)])

    return found


def reference_hits(reads: DataFrame, references: DataFrame, k: int = 31, group_kmers: int = GROUP_KMERS, group_asked: int = GROUP_ASKED) -> DataFrame:
    """read_id, first, last, hits: k-mers of reads (read_id, seq) by the first and last place (int) of the references (place, seq) that hold them.

    k-mers that a reference without a place holds, and those with letters other than A, C, G and T, are left out. A read has several
    rows, all in one partition. Stretches of both sides are dealt by minimizer, a row a group and batch with two bits a letter;
    k-mers of references are sorted inside their group only, and nothing is written. For that both sides are read twice: first
    the k-mers of 65,536 buckets of minimizers are counted, and a bucket with more than a group's goes in parts, a k-mer each way.
    """
    if not 1 <= k <= 31:
        raise ValueError("k-mers of more than 31 letters don't fit in a number")
    m = min(M, max(1, k - k // 3))
    kind = reads.schema["read_id"].dataType.simpleString()
    reads = reads.select("read_id", F.col("seq").cast("string").alias("seq"))
    references = references.select(F.col("place").cast("int").alias("place"), F.col("seq").cast("string").alias("seq"))
    counted = [df.select("seq").mapInArrow(lambda b: _bucket_counts(b, k, m), "bucket int, n long").withColumn("side", F.lit(i)) for i, df in enumerate((references, reads))]
    n = np.zeros((2, BUCKETS), np.int64)
    for side, bucket, total in counted[0].unionByName(counted[1]).groupBy("side", "bucket").agg(F.sum("n")).collect():  # at most two rows a bucket
        n[side, bucket] = total
    least = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = Deal.of(*n, least, group_kmers, group_asked)
    asked = reads.withColumn("salt", F.xxhash64("read_id", "seq")).mapInArrow(lambda b: _sent_reads(b, deal, k, m), f"group int, sizes binary, letters binary, reads array<{kind}>")
    known = references.mapInArrow(lambda b: _sent_references(b, deal, k, m), "group int, sizes binary, letters binary, firsts array<int>, lasts array<int>")
    sides = [df.repartition(deal.all, "group").groupBy("group") for df in (asked, known)]
    hits = sides[0].cogroup(sides[1]).applyInArrow(_ends_met(k), f"read_id {kind}, first int, last int, hits long")
    return hits.repartition(max(least, -(-int(n[1].sum()) // TASK_ASKED)), "read_id")
