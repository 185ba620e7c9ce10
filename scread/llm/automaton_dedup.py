"""Substring dedup with suffix automata of reference shards.

The reference is all text that came earlier. Comparing every document with every shard would grow with the
square of the corpus, so a shard is an anchor group: all places that share one elected gram, in document
order. Each place is streamed through the automaton of the places before it; where the matching statistic
reaches the window length, the window began earlier. Only then does the place join the automaton.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, unzipped, words, zipped
from .passages import SPANS, covered, groups, keyed, repeated, with_key

WINDOW = 20
GRAM = 6
HOT_ROWS = 200_000
AUTOMATON_ROWS = 5_000


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of hashable symbols."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, symbols: list) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for c in symbols:
            if c in nexts[last]:
                q = nexts[last][c]
                last = q if length[q] == length[last] + 1 else self._split(last, q, c)
                continue
            cur, p = len(nexts), last
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            while p != -1 and c not in nexts[p]:
                nexts[p][c] = cur
                p = link[p]
            if p != -1:
                q = nexts[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = cur

    def _split(self, p: int, q: int, c) -> int:
        nexts, link, length = self.next, self.link, self.length
        clone = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def match(self, symbols: list) -> list[int]:
        """For each place the length of the longest suffix of what was read that occurs in the automaton."""
        nexts, link, length = self.next, self.link, self.length
        state = n = 0
        out = []
        for c in symbols:
            while state and c not in nexts[state]:
                state = link[state]
                n = length[state]
            if c in nexts[state]:
                state = nexts[state][c]
                n += 1
            else:
                n = 0
            out.append(n)
        return out


def _decide(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for table in groups(batches, 20_000):
        found = []
        hs = table.column(0).to_numpy()
        edges = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]])
        crowded = {int(hs[a]) for a, n in zip(edges, np.diff(np.r_[edges, len(hs)])) if n > AUTOMATON_ROWS}
        group, automaton, seen, pending, before, windows = None, None, {}, [], None, None
        for h, did, rk, lo, _, ctx in zip(*(c.to_pylist() for c in table.columns)):
            if h != group:
                group, automaton, seen, pending, before = h, None, {}, [], None
                windows = set() if h in crowded else None
            if (did, rk, lo) == before:  # the row repeats in the table
                continue
            before = did, rk, lo
            n = seen.get(ctx)
            if n is not None:
                found.append((did, rk, lo, lo + n - window))
                continue
            symbols = ctx.split()
            seen[ctx] = len(symbols)
            if windows is not None:  # an automaton of so many different places would not fit; whole windows do
                for i in range(len(symbols) - window + 1):
                    key = hashlib.blake2b(b" ".join(symbols[i : i + window]), digest_size=16).digest()
                    if key in windows:
                        found.append((did, rk, lo + i, lo + i))
                    windows.add(key)
                continue
            if pending:
                automaton = automaton or SuffixAutomaton()
                for p in pending:
                    automaton.add(p)
                pending = []
            if automaton is not None:
                first = None
                for i, m in enumerate(automaton.match(symbols)):
                    if m >= window:
                        first = i if first is None else first
                    elif first is not None:
                        found.append((did, rk, lo + first - window + 1, lo + i - window))
                        first = None
                if first is not None:
                    found.append((did, rk, lo + first - window + 1, lo + len(symbols) - window))
            pending.append(symbols)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["did", "rk", "s", "e"])


def _spans(docs_x: DataFrame, texts: DataFrame, window: int, gram: int, hot_rows: int) -> DataFrame:
    def decide(contexts: DataFrame) -> DataFrame:
        ordered = contexts.repartition("h").sortWithinPartitions("h", "did", "rk", "lo")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _decide(batches, window)

        return ordered.mapInArrow(run, SPANS)

    def decide_hot(hashed: DataFrame) -> DataFrame:
        place = F.struct("did", "rk", "p")
        first = hashed.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
        return with_key(hashed, first).filter(place != F.col("first"))

    return repeated(docs_x, texts, "word", window, gram, decide, decide_hot, hot_rows)


def _digest(batches: Iterator[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(2).to_pylist()
        n_words, n_removed, out = [], [], []
        for a, b, data, offsets in blocks(unzipped(batch.column(1))):
            starts, ends, _, at = words(data, offsets)
            raw = data.tobytes()
            for i in range(a, b):
                s, e = starts[at[i - a] : at[i - a + 1]], ends[at[i - a] : at[i - a + 1]]
                keep = ~covered(spans[i] or (), len(s), window)
                n_words.append(len(s))
                n_removed.append(int((~keep).sum()))
                if with_text:
                    if keep.all():
                        out.append(raw[offsets[i - a] : offsets[i - a + 1]].decode())
                        continue
                    edge = np.diff(np.r_[0, keep.astype(np.int8), 0])
                    runs = zip(s[np.flatnonzero(edge == 1)].tolist(), e[np.flatnonzero(edge == -1) - 1].tolist())
                    out.append(b" ".join([raw[x:y] for x, y in runs]).decode())
                else:
                    text = raw[offsets[i - a] : offsets[i - a + 1]]
                    kept = text.split() if keep.all() else [w for w, k in zip(text.split(), keep.tolist()) if k]
                    out.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())], names=["did", "n_words", "n_removed", "out"])


def _removed(docs: DataFrame, window: int, gram: int, hot_rows: int, with_text: bool) -> DataFrame:
    docs_x = keyed(docs)
    texts = zipped(docs_x)
    spans = _spans(docs_x, texts, window, gram, hot_rows)
    joined = texts.join(spans, ["did", "rk"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digest(batches, window, with_text)

    key = ["did", "rk"] if with_text else ["did"]
    if with_text:

        def run_keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for out in _digest(iter([batch.select(["did", "text", "spans"])]), window, True):
                    yield pa.RecordBatch.from_arrays([*out.columns, batch.column(3)], names=[*out.schema.names, "rk"])

        return joined.select("did", "text", "spans", "rk").mapInArrow(run_keyed, "did long, n_words long, n_removed long, out string, rk long").select(*key, "n_words", "n_removed", "out")
    return joined.select("did", "text", "spans").mapInArrow(run, "did long, n_words long, n_removed long, out string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words' ``kept_sha256`` for every row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document with a
    smaller id, or earlier in the same one; windows are judged on the input. A null id comes first. Rows that
    repeat with equal id and text are one document with one result. Null, empty and short texts lose nothing;
    extra columns are not read; an empty table gives no rows. Anchor groups of more than ``AUTOMATON_ROWS``
    places, whose automata would not fit a task, are decided exactly by sets of whole windows, and those of more
    than ``hot_rows`` by a distributed aggregation of window hashes.
    """
    out = _removed(docs, window, gram, hot_rows, False)
    doc_id = F.when(F.col("did") != -(1 << 63), F.col("did"))
    return out.select(doc_id.alias("doc_id"), "n_words", "n_removed", F.col("out").alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``docs`` with the words that ``remove_repeats`` takes out of ``text`` removed; all columns stay."""
    kept = _removed(docs, window, gram, hot_rows, True).filter("n_removed > 0").dropDuplicates(["did", "rk"]).select(F.col("did").alias("__did"), F.col("rk").alias("__rk"), F.col("out").alias("__out"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    same = (F.coalesce(doc_id, F.lit(-(1 << 63))) == F.col("__did")) & (F.xxhash64(doc_id.isNull(), doc_id, text) == F.col("__rk"))
    joined = docs.join(kept, same, "left")
    return joined.select(*[F.coalesce("__out", docs[c]).alias(c) if c == "text" else docs[c] for c in docs.columns])


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS p FROM d),
w AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS x FROM i),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY x ORDER BY doc_id, p) AS n FROM w),
g AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(generate_series(p, p + 19)) AS q FROM r WHERE n > 1)),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS q FROM d),
k AS (SELECT t.doc_id, count(*) FILTER (g.q IS NOT NULL) AS n_removed,
  string_agg(t.word, ' ' ORDER BY t.q) FILTER (g.q IS NULL) AS kept
  FROM t LEFT JOIN g ON t.doc_id = g.doc_id AND t.q = g.q GROUP BY t.doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
