"""Repeated byte strings by column-wise construction over many documents.

The pieces of text that share an anchor gram are aligned at it and treated as one collection. A round
inserts one symbol of every piece: the order of the pieces by their reversed prefixes (a positional
Burrows-Wheeler transform) is refined by a stable sort, and the place where each prefix starts to agree
with its neighbour's (the common prefixes) is updated from the previous round alone. After the round of a
column, neighbours that agree over the window length hold the same string. A collection is bounded by its
anchor group, so its columns stay in memory instead of external files; groups beyond a bound are decided by
hashes of whole windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import string_parts, unzipped, zipped
from .passages import SPANS, covered, groups, keyed, repeated, with_key

LENGTH = 200
GRAM = 32
HOT_ROWS = 200_000
BATCH_ROWS = 20_000


def repeated_columns(data: np.ndarray, begin: np.ndarray, size: np.ndarray, off: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For every piece and window of it, whether another piece of its group holds the same window.

    ``data[begin:begin + size]`` is a piece, ``off`` the place of its anchor in it, ``group`` non-decreasing
    numbers. Row i, column j of the result is the window that ends j columns after the first possible end.
    """
    n = len(begin)
    left, right = int(off.max()), int((size - off).max())
    result = np.zeros((n, left + right - length + 1), bool)
    order = np.arange(n)
    # where the common run of a piece and the one before it in the order starts; beyond all columns for none
    never = left + right + 1
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    agree = np.zeros(n, np.int32)
    agree[heads] = never
    lead = left - off
    for column in range(left + right):
        at = column - lead
        inside = (at >= 0) & (at < size)
        symbol = np.where(inside, data[np.minimum(begin + np.clip(at, 0, None), len(data) - 1)].astype(np.int32) + 1, 0)
        key = group[order] * 512 + symbol[order]
        if (key[1:] < key[:-1]).any():
            moved = np.argsort(key, kind="stable")
            key = key[moved]
            same = np.r_[False, key[1:] == key[:-1]]
            before = np.r_[0, moved[:-1]]
            pairs = np.stack([np.where(same, before + 1, moved), moved + 1], 1).ravel()
            worst = np.maximum.reduceat(np.r_[agree, 0], pairs)[::2]
            agree, order = np.where(same, worst, column + 1).astype(np.int32), order[moved]
        else:
            same = np.r_[False, key[1:] == key[:-1]]
            agree[~same] = column + 1
        agree[inside[order] == 0] = column + 1
        agree[heads] = never
        end = column + 1 - length
        if end >= 0:
            twin = agree <= end
            twin[:-1] |= twin[1:]
            rows = order[twin]
            result[rows[inside[rows] & (at[rows] - length + 1 >= 0)], end] = True
    return result


def _decide(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for table in groups(batches, BATCH_ROWS):
        h, did, rk, lo, off, same = (table.column(i).to_numpy() for i in (0, 1, 2, 3, 4, 6))
        data, offsets = string_parts(table.column(5))
        # identical rows are one place; equal pieces of a group go through the construction once
        ordered = np.lexsort((lo, rk, did, same, h))
        key = np.stack([h, same, did, rk, lo])[:, ordered]
        place = np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)]
        ordered, key = ordered[place], key[:, place]
        piece = np.r_[True, (key[:2, 1:] != key[:2, :-1]).any(0)]
        number = np.cumsum(piece) - 1
        copies = np.bincount(number)
        one = ordered[piece]
        group = np.cumsum(np.r_[True, h[one][1:] != h[one][:-1]]) - 1
        pieces_of = np.bincount(group)
        begin, size = offsets[one], offsets[one + 1] - offsets[one]
        spans: list[tuple[np.ndarray, ...]] = []
        whole = copies[number] > 1
        rows = ordered[whole]
        spans.append((did[rows], rk[rows], lo[rows], lo[rows] + (offsets[rows + 1] - offsets[rows]) - length))
        # only pieces that differ from the others of their group and have some are left
        todo = np.flatnonzero(pieces_of[group] > 1)
        for a, b in _cuts(group[todo]):
            part = todo[a:b]
            dense = np.cumsum(np.r_[True, group[part][1:] != group[part][:-1]]) - 1
            found = repeated_columns(data, begin[part], size[part], off[one[part]].astype(np.int64), dense, length)
            found[copies[part] > 1] = False
            edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            r, s = np.nonzero(edge == 1)
            _, e = np.nonzero(edge == -1)
            shift = off[one[part]].astype(np.int64).max() - off[one[part]].astype(np.int64)
            source = one[part][r]
            spans.append((did[source], rk[source], lo[source] + s - shift[r], lo[source] + e - 1 - shift[r]))
        out = [np.concatenate(c) for c in zip(*spans)]
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(np.int32)), pa.array(out[3].astype(np.int32))], names=["did", "rk", "s", "e"])


def _cuts(group: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of whole groups of about BATCH_ROWS."""
    edges = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
    out, a = [], 0
    while a < len(group):
        b = int(edges[np.searchsorted(edges, a + BATCH_ROWS, "left").clip(max=len(edges) - 1)])
        out.append((a, b))
        a = b
    return out


def _digest(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = string_parts(unzipped(batch.column(1)))
        rows = []
        for i, spans in enumerate(batch.column(2).to_pylist()):
            x = data[offsets[i] : offsets[i + 1]]
            if not spans:
                rows.append((len(x), 0, 0, hashlib.sha256(x).hexdigest()))
                continue
            gone = covered(spans, len(x), length)
            rows.append((len(x), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum()), hashlib.sha256(x[~gone].tobytes()).hexdigest()))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3])], names=["did", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs`` (doc_id, text).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in any document;
    strings are judged on the input. Rows that repeat with equal id and text are one document with one
    result. Null, empty and short texts lose nothing; extra columns are not read; an empty table gives no rows.
    """

    def decide(contexts: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _decide(batches, length)

        same = contexts.withColumn("same", F.xxhash64("ctx", "off"))
        return same.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPANS)

    def decide_hot(hashed: DataFrame) -> DataFrame:
        place = F.struct("did", "rk", "p")
        twice = hashed.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("a"), F.max(place).alias("b")).filter("a != b")
        return with_key(hashed, twice.select("w1", "w2", "n"))

    docs_x = keyed(docs)
    texts = zipped(docs_x)
    spans = repeated(docs_x, texts, "byte", length, gram, decide, decide_hot, hot_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digest(batches, length)

    joined = texts.join(spans, ["did", "rk"], "left").select("did", "text", "spans")
    out = joined.mapInArrow(run, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("did") != -(1 << 63), F.col("did")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, p, md5_number(substr(x, 2 * p - 1, 400)) AS k FROM (
  SELECT doc_id, x, unnest(generate_series(1, length(x) // 2 - 199)) AS p FROM d)),
r AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS b FROM w
  WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT doc_id, p, sum(CASE WHEN b IS NULL OR p > b + 200 THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY p) AS n FROM r),
s AS (SELECT doc_id, n, min(p) AS a, max(p) + 199 AS z FROM g GROUP BY doc_id, n),
c AS (SELECT doc_id, n, a, z, lag(z) OVER (PARTITION BY doc_id ORDER BY n) AS pz FROM s),
k AS (SELECT d.doc_id, sum(z - a + 1) AS n_removed, count(*) AS n_spans,
  string_agg(substr(x, 2 * coalesce(pz, 0) + 1, 2 * (a - 1 - coalesce(pz, 0))), '' ORDER BY n)
    || substr(any_value(x), 2 * max(z) + 1) AS kept
  FROM d JOIN c USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, length(d.x) // 2 AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.kept, d.x))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
