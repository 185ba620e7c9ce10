"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on windows that toxic texts
hold much more often. A window (a word in a fixed frame of ordinary text, so that even a short one can be
compressed) is shorter under the dictionary that knows it. The differences of a text's windows are turned
into a likelihood ratio and calibrated on texts whose half of the training rows did not train the
dictionary used.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .labelled import calibrate, finish, with_label

LEVEL = 19
# bounds of what is learned from the labelled sample: dictionary sizes, the toxic texts, evidence (a part of the logarithm of
# the number of windows) and log odds from which a window is toxic, and the windows of each kind that reach the driver
ORDINARY_BYTES, TOXIC_BYTES, FRAME_BYTES = 4096, 2048, 40
LEAST_DOCS, EVIDENCE, LEAST_ODDS = 2, 0.7, 4.5
MAX_WINDOWS = 20_000
CACHED_WINDOWS = 300_000
LOW, HIGH = -2, 12
EDGES = b".,;:!?|\"'()"
THRESHOLD = 0.3


def evidence(toxic: int, ordinary: int, share: float) -> float:
    """Log likelihood by which a window that this many texts of either kind hold speaks against chance, given toxic texts' share; 0 if it is not theirs more."""
    n = toxic + ordinary
    if not n or toxic <= share * n:
        return 0.0
    return toxic * log(toxic / n / share) + (ordinary * log(ordinary / n / (1 - share)) if ordinary else 0.0)


def train_dictionaries(windows: list[tuple[str, int, int]], n_toxic: int, n_ordinary: int) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents from (window, toxic texts with it, ordinary texts with it).

    The ordinary one is chosen by zstandard's trainer, to which a window counts at most 20 times. The toxic one
    adds the windows with high odds whose evidence passes a part of the logarithm of their number, a bar that chance
    hardly passes at any size of the corpus; the strongest lie nearest the end, where they are cheapest to refer to. Both
    end in the frame of the windows, which 200 toxic and 400 ordinary windows choose.
    """
    odds = {w: log((t + 0.5) / (n_toxic + 1)) - log((o + 0.5) / (n_ordinary + 1)) for w, t, o in windows}
    ordinary = sorted((-o, w) for w, t, o in windows if odds[w] <= 1 and o)
    samples = [w.encode() for o, w in ordinary for _ in range(min(-o, 20))]
    try:
        content = zstandard.train_dictionary(ORDINARY_BYTES, [b" " + w + b" " for w in samples]).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own bytes
        content = b" ".join(dict.fromkeys(samples))[-ORDINARY_BYTES:]
    content = content.rjust(2 * FRAME_BYTES, b" ")
    share, bar = n_toxic / max(1, n_toxic + n_ordinary), EVIDENCE * log(max(2, len(windows)))
    least_odds = min(LEAST_ODDS, 0.6 * log(2 * n_ordinary + 2))  # few ordinary texts can't show high odds
    strong = [(evidence(t, o, share), w) for w, t, o in windows if t >= LEAST_DOCS and n_ordinary and odds[w] > least_odds]
    toxic = [w.encode() for e, w in sorted(strong) if e > bar]
    extra = b"".join(b" " + w + b" " for w in toxic)[-TOXIC_BYTES:]
    # of some frames from the ordinary content, the one under which the two kinds of windows differ most
    best = (-1.0, content, content)
    probes = [toxic[-200:], list(dict.fromkeys(samples))[:400]]
    for at in range(0, len(content) - FRAME_BYTES + 1, max(1, (len(content) - FRAME_BYTES) // 12)):
        frame = content[at : at + FRAME_BYTES]
        pair = content + frame, content + extra + frame
        distance = Distance(*pair)
        high, low = (np.array([distance.window(w) for w in p] or [0], float) for p in probes)
        best = max(best, ((high.mean() - low.mean()) / (0.3 + low.std()), *pair))
    return best[1:]


class Distance:
    """By how many bytes a window is shorter under the toxic dictionary, clipped and counted from ``LOW``."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        self.pair = [zstandard.ZstdCompressor(compression_params=parameters, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for d in (ordinary, toxic)]
        self.frame, self.known = ordinary[-FRAME_BYTES:] + b" ", {}

    def window(self, token: bytes) -> int:
        x = self.frame + token.strip(EDGES) + b" "
        a, b = (len(c.compress(x)) for c in self.pair)
        return min(max(a - b, LOW), HIGH) - LOW

    def counts(self, text: str) -> np.ndarray:
        """How many windows of a text have each difference; letters are lower-cased as in training."""
        tokens, known = text.lower().encode().split(), self.known
        for w in {w for w in tokens if w not in known}:
            if len(known) < CACHED_WINDOWS:
                known[w] = self.window(w)
        found = bytes([known[w] if w in known else self.window(w) for w in tokens])
        return np.bincount(np.frombuffer(found, np.uint8), minlength=HIGH - LOW + 1)


_DISTANCES: dict[tuple[bytes, bytes], Distance] = {}


def _distance(pair: tuple[bytes, bytes]) -> Distance:
    if pair not in _DISTANCES:
        if len(_DISTANCES) >= 3:
            _DISTANCES.clear()
        _DISTANCES[pair] = Distance(*pair)
    return _DISTANCES[pair]


def _windows_by_label(rows: DataFrame) -> tuple[list, list[list[int]]]:
    """Windows with the number of texts of each label and half that hold them, and the number of such texts.

    A window counts once a text for each form in which it is written there, with its outer marks. ``rows`` is the
    bounded labelled sample; of its windows the ``MAX_WINDOWS`` with the highest count of each label are returned.
    """
    kinds = [(y, h) for y in (1, 0) for h in (0, 1)]
    n = {(r["y"], r["half"]): r["count"] for r in rows.groupBy("y", "half").count().collect()}
    token = F.explode(F.array_distinct(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")))
    w = rows.select("y", "half", token.alias("w")).select("y", "half", F.btrim("w", F.lit(EDGES.decode())).alias("w")).filter("w != ''")
    c = w.groupBy("w").agg(*[F.count_if((F.col("y") == y) & (F.col("half") == h)).alias(f"c{y}{h}") for y, h in kinds])
    toxic = c.filter(F.col("c10") + F.col("c11") >= LEAST_DOCS).orderBy(F.desc(F.col("c10") + F.col("c11")), "w").limit(MAX_WINDOWS)
    ordinary = c.orderBy(F.desc(F.col("c00") + F.col("c01")), "w").limit(MAX_WINDOWS)
    return toxic.union(ordinary).distinct().orderBy("w").collect(), [[n.get((y, h), 0) for h in (0, 1)] for y in (1, 0)]


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    Only the text is an input of a score. Null and empty texts have no windows and get what calibration
    gives for none. Rows that repeat get equal scores; extra columns are not read; empty tables give no
    rows, and without toxic labels all score 0.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = stage(with_label(d, labels, label, folds, held), "toxicity-train")
    windows, (toxic, ordinary) = _windows_by_label(rows)
    # pairs[h] learns from the other half and measures half h; pairs[2] learns from all
    pairs = [train_dictionaries([(r["w"], r[f"c1{1 - h}"], r[f"c0{1 - h}"]) for r in windows], toxic[1 - h], ordinary[1 - h]) for h in (0, 1)]
    pairs.append(train_dictionaries([(r["w"], r["c10"] + r["c11"], r["c00"] + r["c01"]) for r in windows], sum(toxic), sum(ordinary)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_distance(pairs[h]).counts(t) for t, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column(1)], names=["found", "y"])

    measured = stage(rows.select("text", "y", "half").mapInArrow(measure, "found array<long>, y int"), "toxicity-halves")
    total = np.ones((2, HIGH - LOW + 1))
    for r in measured.groupBy("y").agg(*[F.sum(F.element_at("found", i + 1)).alias(f"n{i}") for i in range(HIGH - LOW + 1)]).collect():
        total[r["y"]] += r[1:]
    ratio = np.diff(np.log(total / total.sum(1, keepdims=True)), axis=0)[0] if sum(toxic) and sum(ordinary) else np.zeros(HIGH - LOW + 1)
    weighted = sum((F.element_at("found", i + 1) * F.lit(float(x)) for i, x in enumerate(ratio)), F.lit(0.0))
    knots, values = calibrate(measured.select(weighted.alias("s"), "y"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = _distance(pairs[2])
        for batch in batches:
            s = np.array([distance.counts(t) @ ratio for t in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(np.interp(s, knots, values), 0.0, 1.0))], names=["doc_id", "score"])

    return finish(d.mapInArrow(score, "doc_id long, score double"), folds, held, threshold)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
