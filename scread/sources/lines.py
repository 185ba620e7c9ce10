"""Lines of text files; a block-compressed file, which Spark's own readers leave to one task, is read by many."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .storage import BLOCKS, cut, first_piece, kind, open_input, pieces

SPLIT_BYTES = 2**20


def _lines(path: str, start: int, stop: int) -> Iterator[list[bytes]]:
    """Lists of the lines that follow a line break in a byte range, and the file's first line of the first range."""
    with open_input(path) as f:
        place = first_piece(f, BLOCKS, start)
        if place >= stop and start > 0:
            return
        rest, begun = b"", start == 0  # begun: ``rest`` begins at the first byte of a line
        for at, data in pieces(f, BLOCKS, place):
            if at >= stop:  # the last line of the range may end here
                end = data.find(b"\n")
                if not begun:
                    return
                rest += data if end < 0 else data[:end]
                if end >= 0:
                    yield [rest]
                    return
                continue
            lines = (rest + data).split(b"\n")
            rest = lines.pop()
            if lines and not begun:
                begun, lines = True, lines[1:]
            if lines:
                yield lines
            if not begun:
                rest = b""
        if begun and rest:
            yield [rest]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for r in rows.itertuples(index=False):
            for lines in _lines(r.path, r.start, r.stop):
                yield pd.DataFrame({"value": [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines]})


def read_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """value: the lines of a file, or of those of a folder or glob; block-compressed files in ranges of about ``split_bytes``."""
    if not path.endswith(".gz"):
        return spark.read.text(path)
    files = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # a row per file
    dealt = [p for p in files if kind(p) == BLOCKS]
    ranges = [(p, a, b) for p in dealt for a, b in cut(p, BLOCKS, split_bytes)]
    others = [p for p in files if p not in set(dealt)]
    out = spark.read.text(others) if others or not ranges else None
    if ranges:
        asked = spark.createDataFrame(ranges, "path string, start long, stop long").repartition(min(len(ranges), 10_000), "path", "start")
        found = asked.mapInPandas(_read, "value string")
        out = found if out is None else out.unionByName(found)
    return out
