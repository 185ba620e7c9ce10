"""FASTQ readers: mates in lock-step by ordinal; files that can be read from the middle are read by many tasks.

A first pass counts the records of byte ranges, one task a range. The driver sums the counts, so each task
of the second pass knows its ordinals and, for every mate, the nearest place before them; mates meet by
ordinal without a shuffle, whatever the lengths of their records.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .storage import STREAM, cut, first_piece, kind, open_input, pieces

BATCH = 8192
SPLIT_BYTES = 64 * 2**20
MAX_SPANS = 1_000  # all spans are known to each task, so their number has a bound
MARK = 2_048
READ_AT_ONCE = 2**20


def _lines_to_header(f, how: str, place: int) -> int | None:
    """Lines between the first line break from a place and the next header; null if no record begins there.

    A header begins with @, and so may a quality line; but the second line after a quality line is a
    sequence, after a header the separator, which begins with +.
    """
    text = b""
    for _, data in pieces(f, how, place):
        text += data
        if text.count(b"\n") > 12:
            break
    lines = text.split(b"\n")[1:]
    return next((i for i in range(len(lines) - 2) if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+"), None)


def count_range(path: str, how: str, start: int, stop: int, mark: int = MARK) -> tuple[int, list[tuple[int, int, int]]]:
    """(records, marks) of a byte range; marks are (record, place of its piece, byte in it) of every ``mark``-th.

    A record is the range's whose header follows a line break in it, and the file's first record the first range's.
    """
    n, marks, last = 0, [], None
    with open_input(path) as f:
        place = first_piece(f, how, start)
        skip = 0 if start == 0 else _lines_to_header(f, how, place)
        if skip is None or place >= stop:
            return 0, []
        seen, data, ended = 0, b"", True
        for at, piece in pieces(f, how, place):
            if at >= stop:
                ended = False
                break
            begins = np.flatnonzero(np.frombuffer(piece, np.uint8) == 10) + 1
            if start == 0 and not data:
                begins = np.concatenate([[0], begins])
            own = begins[(skip - seen) % 4 :: 4] if seen >= skip else begins[skip - seen :: 4]
            seen += len(begins)
            marks += [(n + int(k), at, int(own[k])) for k in range(-n % mark, len(own), mark)]
            n += len(own)
            last = (at, int(own[-1])) if len(own) else last
            data, data_at = piece, at
        if ended and data.endswith(b"\n") and last == (data_at, len(data)):  # no line follows the last break
            n -= 1
            marks = [m for m in marks if m[0] < n]
    return n, marks


def _records(path: str, how: str, place: int, within: int) -> Iterator[tuple[list[bytes], list[bytes], list[bytes]]]:
    """(headers, sequences, qualities) in lists, from a record's first byte to the end of the file."""
    with open_input(path) as f:
        rest: list[bytes] = []
        carry, held, skip = [], 0, within
        found = pieces(f, how, place)
        while True:
            _, data = next(found, (0, None))
            if data is not None:
                carry.append(data[skip:])
                held += len(data)
                skip = 0
                if held < READ_AT_ONCE:
                    continue
            lines = b"".join(carry).split(b"\n")
            last = lines.pop()
            if data is None and last:
                lines.append(last)
            if lines and lines[0][-1:] == b"\r":
                lines = [x.removesuffix(b"\r") for x in lines]
            carry, held = [last], 0
            lines = rest + lines
            if data is None:
                lines += [b""] * (-len(lines) % 4)
            whole = len(lines) // 4 * 4
            rest = lines[whole:]
            if whole:
                yield lines[0:whole:4], lines[1:whole:4], lines[3:whole:4]
            if data is None:
                return


class _Mate:
    """Takes records of a file in order, some left out first."""

    def __init__(self, path: str, how: str, place: int, within: int, skip: int):
        self.found, self.held = _records(path, how, place, within), ([], [], [])
        self.take(skip)

    def take(self, n: int) -> tuple[list[bytes], list[bytes], list[bytes]]:
        while len(self.held[0]) < n and (more := next(self.found, None)):
            self.held = tuple(a + b for a, b in zip(self.held, more))
        out, self.held = tuple(x[:n] for x in self.held), tuple(x[n:] for x in self.held)
        return out


class _Span(InputPartition):
    def __init__(self, sample: str, lane: str, first: int, n: int | None, mates: list[tuple]):
        self.sample, self.lane, self.first, self.n, self.mates = sample, lane, first, n, mates


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.spans = [_Span(*s) for s in json.loads(options["spans"])]
        self.names = ["pair_id", "sample", "lane", "name", "comment", *(f"{m}_{x}" for m in options["mates"].split(",") for x in ("seq", "qual"))]

    def partitions(self):
        return self.spans or [_Span("", "", 0, 0, [])]

    def read(self, span: _Span):
        mates, at, left = [_Mate(*m) for m in span.mates], span.first, span.n
        while mates and left != 0:
            wanted = BATCH if left is None else min(BATCH, left)
            parts = [m.take(wanted) for m in mates]
            n = min(len(p[0]) for p in parts)
            if not n:
                return
            heads = [h[1:].partition(b" ") for h in parts[0][0][:n]]
            texts = [[h[0] for h in heads], [h[2] for h in heads], *(x[:n] for p in parts for x in p[1:])]
            fixed = [pa.array(np.arange(at, at + n)), pa.array([span.sample] * n, pa.string()), pa.array([span.lane] * n, pa.string())]
            yield pa.RecordBatch.from_arrays([*fixed, *(pa.array(t, pa.binary()).cast(pa.string()) for t in texts)], names=self.names)
            at += n
            left = None if left is None else left - n
            if n < wanted:
                return


class FastqSource(DataSource):
    """Reads the spans of sets of FASTQ files that ``read_fastq_multi`` planned."""

    @classmethod
    def name(cls) -> str:
        return "fastq_sets"

    def schema(self) -> str:
        mates = ", ".join(f"{m}_seq string, {m}_qual string" for m in self.options["mates"].split(","))
        return f"pair_id long, sample string, lane string, name string, comment string, {mates}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for r in rows.itertuples(index=False):
            n, marks = count_range(r.path, r.how, r.start, r.stop)
            yield pd.DataFrame([(r.path, r.start, n, m[0], m[1], m[2]) for m in marks] or [(r.path, r.start, 0, 0, -1, 0)], columns=["path", "start", "n", "record", "place", "within"])


def _spans(spark: SparkSession, files: list[tuple], split_bytes: int) -> list[tuple]:
    """(sample, lane, first ordinal, number, (path, kind, place, byte, records to leave out) of each mate) of each task."""
    hows = {p: kind(p) for p in dict.fromkeys(str(p) for f in files for p in f[2:])}
    ranges = {p: cut(p, hows[p], split_bytes) for p in hows}
    dealt = [f for f in files if len(f) > 2 and all(hows[str(p)] != STREAM for p in f[2:]) and any(len(ranges[str(p)]) > 1 for p in f[2:])]
    tasks = [(p, hows[p], a, b) for p in dict.fromkeys(str(p) for f in dealt for p in f[2:]) for a, b in ranges[p]]
    marks: dict[str, list[tuple]] = {}
    totals: dict[str, int] = {}
    if tasks:
        asked = spark.createDataFrame(tasks, "path string, how string, start long, stop long").repartition(min(len(tasks), MAX_SPANS), "path", "start")
        found = asked.mapInPandas(_counted, "path string, start long, n long, record long, place long, within long").collect()  # a row per 2,048 records
        base = 0
        for r in sorted(found, key=lambda r: (r["path"], r["start"], r["record"])):
            if r["record"] == 0:
                base = totals.get(r["path"], 0)
                totals[r["path"]] = base + r["n"]
            if r["place"] >= 0:
                marks.setdefault(r["path"], []).append((base + r["record"], r["place"], r["within"]))
    out, most = [], max(1, MAX_SPANS // max(1, len(dealt)))
    for sample, lane, *paths in files:
        paths = [str(p) for p in paths]
        if not all(p in totals for p in paths) or not paths:
            out.append((sample, lane, 0, None, [(p, hows[p], 0, 0, 0) for p in paths]))
            continue
        total = min(totals[p] for p in paths)
        each = max(1, -(-total // min(max(len(ranges[p]) for p in paths), most)))
        for first in range(0, total, each):
            places = []
            for p in paths:
                record, place, within = marks[p][bisect.bisect_right(marks[p], (first, float("inf"))) - 1]
                places.append((p, hows[p], place, within, first - record))
            out.append((sample, lane, first, min(each, total - first), places))
    return out


def read_fastq_multi(spark: SparkSession, files: list[tuple], mates: tuple[str, ...], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``files``: (sample, lane, path of each mate). Reading stops where the shortest mate ends.

    pair_id is a record's ordinal in its set. Plain and block-compressed files are cut into ranges of about
    ``split_bytes``, larger ones beyond ``MAX_SPANS`` tasks (which read in batches whatever their range); a set with a gzip file of another kind, which can't be read from the middle, is one partition:
    ``repartition`` then for wide work.
    """
    spark.dataSource.register(FastqSource)
    spans = _spans(spark, [(str(f[0]), str(f[1]), *f[2:]) for f in files], split_bytes)
    return spark.read.format("fastq_sets").option("spans", json.dumps(spans)).option("mates", ",".join(mates)).load()


def read_fastq_pairs(spark: SparkSession, samples: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Pairs of all samples and lanes of a sample sheet (one row per lane): R1 holds the barcode read. Lines without files give none."""
    named = samples.filter("fastq_bc_umi is not null and fastq_cdna is not null")
    rows = named.select("sample", "fastq_bc_umi", "fastq_cdna").collect()  # a line per pair of files
    return read_fastq_multi(spark, [(r["sample"], str(i), r["fastq_bc_umi"], r["fastq_cdna"]) for i, r in enumerate(rows)], ("r1", "r2"), split_bytes)
