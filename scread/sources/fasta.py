"""Chunked FASTA scan: no row holds a contig, and a long contig is read by many tasks.

A first pass sums up byte ranges: how many bases come before the first line break (of a line that an earlier
range began), which contig the range ends in and how many of its bases it holds. The sums of the ranges before
tell each range where it begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..operators.intervals import CHUNK
from .storage import STREAM, cut, first_piece, kind, open_input, pieces

SPLIT_BYTES = 64 * 2**20
_SPACE = b" \t\r\n\x0b\x0c"


def _name(header: bytes) -> str:
    words = header[1:].split()
    return words[0].decode("utf-8", "replace") if words else ""


def _parts(path: str, how: str, start: int, stop: int) -> Iterator[tuple[str, bytes]]:
    """What a byte range holds: ``before`` (up to its first line break, of a line begun earlier), then ``head`` (whole header lines) and ``bases``.

    A header that begins behind the last line break of the range is the range's and read to its end; ``inside`` says
    that it ends in a later range.
    """
    with open_input(path) as f:
        place = first_piece(f, how, start)
        before, begins, header, beyond = start > 0, start == 0, None, False  # begins: at the first byte of a line
        if place >= stop and start > 0:
            return
        for at, data in pieces(f, how, place):
            beyond = at >= stop and how != STREAM
            if beyond and header is None and not (begins and data[:1] == b">"):
                return
            pos = 0
            while pos < len(data):
                if before:
                    end = data.find(b"\n", pos) + 1
                    yield "before", data[pos : end or len(data)]
                    before, begins, pos = not end, bool(end), end or len(data)
                elif header is not None or begins and data[pos : pos + 1] == b">":
                    end = data.find(b"\n", pos) + 1
                    header = (header or b"") + data[pos : end or len(data)]
                    begins, pos = bool(end), end or len(data)
                    if end:
                        yield "head", header
                        header = None
                        if beyond:
                            yield "inside", b""
                            return
                else:
                    end = data.find(b"\n>", pos)
                    stop_at = end + 1 if end >= 0 else len(data)
                    yield "bases", data[pos:stop_at].translate(None, _SPACE)
                    begins, pos = data[stop_at - 1 : stop_at] == b"\n", stop_at
        if header is not None:
            yield "head", header
            if beyond:
                yield "inside", b""


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for r in rows.itertuples(index=False):
            before, broken, last, tail, inside = 0, r.start == 0, None, 0, False
            for what, data in _parts(r.path, r.how, r.start, r.stop):
                if what == "before":
                    before += len(data.translate(None, _SPACE))
                    broken = broken or data.endswith(b"\n")
                elif what == "head":
                    last, tail = _name(data), 0
                elif what == "bases":
                    tail += len(data)
                else:
                    inside = True
            yield pd.DataFrame([(r.path, r.start, before, broken, last, tail, inside)], columns=["path", "start", "before", "broken", "last", "tail", "inside"])


def _chunks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for r in rows.itertuples(index=False):
            contig, at = r.contig, int(r.at)
            held, out = bytearray(), []

            def flush(whole: bool) -> None:
                """Rows up to the last chunk border, or all that is held."""
                nonlocal at
                done = 0
                while done < len(held):
                    n = min(size - at % size, len(held) - done)
                    if n < size - at % size and not whole:
                        break
                    out.append((contig, at // size, at, held[done : done + n].decode("ascii", "replace")))
                    done, at = done + n, at + n
                del held[:done]

            for what, data in _parts(r.path, r.how, r.start, r.stop):
                if what == "head":
                    flush(True)
                    contig, at = _name(data), 0
                elif contig is not None and (what == "bases" or what == "before" and not r.in_header):
                    held += data.translate(None, _SPACE)
                    flush(False)
                if len(out) * size > 2**24:
                    yield pd.DataFrame(out, columns=["contig", "chunk", "at", "chunk_seq"])
                    out.clear()
            flush(True)
            if out:
                yield pd.DataFrame(out, columns=["contig", "chunk", "at", "chunk_seq"])


def begins(ranges: list[tuple], found: dict[int, dict]) -> list[tuple]:
    """Ranges with the contig that each begins in, its bases before, and whether it begins inside a header."""
    out, contig, at, in_header = [], None, 0, False
    for path, how, start, stop in ranges:
        r = found[start]
        out.append((path, how, start, stop, contig, at, in_header))
        at += 0 if in_header else r["before"]
        in_header = r["inside"] or in_header and not r["broken"]
        contig, at = (r["last"], r["tail"]) if r["last"] is not None else (contig, at + r["tail"])
    return out


def read_genome(spark: SparkSession, path: str, size: int = CHUNK, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """contig (first word of the header), chunk, at (bases of the contig before) and chunk_seq of at most ``size`` bases.

    A chunk that two byte ranges share is two rows. Contigs without bases and bases before any header give none. Plain and
    block-compressed files are read in ranges of about ``split_bytes``, other gzip files by one task.
    """
    how = kind(path)
    ranges = [(path, how, a, b) for a, b in cut(path, how, split_bytes)]
    asked = spark.createDataFrame(ranges, "path string, how string, start long, stop long").repartition(min(len(ranges), 10_000), "start")
    sums = asked.mapInPandas(_summed, "path string, start long, before long, broken boolean, last string, tail long, inside boolean")
    found = {r["start"]: r for r in sums.collect()}  # a row per range
    begun = begins(ranges, found)
    spans = spark.createDataFrame(begun, "path string, how string, start long, stop long, contig string, at long, in_header boolean").repartition(min(len(begun), 10_000), "start")
    return spans.mapInPandas(lambda b: _chunks(b, size), "contig string, chunk long, at long, chunk_seq string")
