"""Both classifiers against plain computations in one process: every window compressed, one direct ridge solve."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scread.llm import quality, toxicity
from scread.llm.labelled import BINS, isotonic


def crc(i):
    return zlib.crc32(str(i).encode())


def calibrated(s, y):
    """Isotonic knots of scores in bins of equal width."""
    low, high = s.min(), s.max()
    b = np.floor((s - low) / ((high - low) / BINS or 1.0))
    rows = sorted((s[b == k].mean(), y[b == k].sum(), (b == k).sum()) for k in np.unique(b))
    return isotonic(*(np.array(c, float) for c in zip(*rows)))


@pytest.fixture(scope="module")
def tables(spark, sf):
    big = sf.replace("0.001", "0.01")
    d, l = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in d.select("doc_id", "text").collect()}
    return d, l, texts, {r["doc_id"]: r for r in l.collect()}


def test_toxicity_compresses_every_window(tables):
    d, l, texts, labels = tables
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(d, l).collect()}
    rows = [(i, texts[i], r["toxic"]) for i, r in labels.items() if r["toxic"] is not None and i in texts and crc(i) % 4 != 2]
    half = lambda i: crc(i) // 4 % 2
    edges = toxicity.EDGES.decode()
    tokens = lambda t: t.lower().encode().split()
    forms = lambda t: [x for x in (w.decode().strip(edges) for w in set(tokens(t))) if x]  # noqa: E731  each written form counts once a text

    def dictionaries(part):
        toxic, ordinary = Counter(), Counter()
        for _, t, y in part:
            (toxic if y else ordinary).update(forms(t))
        all_t, all_o = Counter(), Counter()  # which windows are looked at depends on all training rows
        for _, t, y in rows:
            (all_t if y else all_o).update(forms(t))
        first = lambda c, least: [w for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0].encode())) if n >= least][: toxicity.MAX_WINDOWS]
        chosen = sorted({*first(all_t, toxicity.LEAST_DOCS), *first(all_o, 0)} | {w for w in first(Counter({w: all_o[w] for w in all_t} | all_o), 0)}, key=lambda w: w.encode())
        n = sum(y for _, _, y in part)
        return toxicity.Distance(*toxicity.train_dictionaries([(w, toxic[w], ordinary[w]) for w in chosen], n, len(part) - n))

    def counts(distance, text):
        found = np.zeros(toxicity.HIGH - toxicity.LOW + 1)
        for w in tokens(text):
            x = distance.frame + w.strip(toxicity.EDGES) + b" "
            a, b = (len(c.compress(x)) for c in distance.pair)
            found[min(max(a - b, toxicity.LOW), toxicity.HIGH) - toxicity.LOW] += 1
        return found

    by_half = [dictionaries([r for r in rows if half(r[0]) != h]) for h in (0, 1)]
    h = np.array([counts(by_half[half(i)], t) for i, t, _ in rows])
    y = np.array([r[2] for r in rows])
    total = 1 + np.array([h[y == k].sum(0) for k in (0, 1)])
    ratio = np.diff(np.log(total / total.sum(1, keepdims=True)), axis=0)[0]
    knots, values = calibrated(h @ ratio, y)
    full = dictionaries(rows)
    ids = list(texts)[::3]
    want = np.array([np.clip(np.interp(counts(full, texts[i]) @ ratio, knots, values), 0, 1) for i in ids])
    # sums in another order may put a training text into the next bin of the calibration, which moves its pool a little
    assert np.abs(want - np.array([got[i] for i in ids])).max() < 0.01


def test_quality_solves_one_ridge(spark, tables):
    d, l, texts, labels = tables
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(d, l).collect()}
    train = sorted(i for i, r in labels.items() if r["quality"] is not None and i in texts and crc(i) % 5 != 0)
    stats = lambda ids: quality.statistics(pa.array([texts[i] for i in ids])).astype(np.float32).astype(float)
    x, y = stats(train), np.array([labels[i]["quality"] for i in train], float)
    inner = {r["id"]: r["k"] for r in spark.createDataFrame([(i,) for i in train], "id long").select("id", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(quality.INNER)).alias("k")).collect()}
    k = np.array([inner[i] for i in train])
    scale = x.std(0)
    z_of = quality.Fourier(x.mean(0), np.where(scale > 1e-6, scale, 1.0))
    z = z_of(x)
    penalty = np.diag(np.r_[np.ones(z.shape[1] - 1), 0.0])
    solve = lambda part: np.linalg.lstsq(z[part].T @ z[part] + quality.RIDGE * part.sum() * penalty, z[part].T @ y[part], rcond=None)[0]
    left_out = np.array([solve(k != f) for f in range(quality.INNER)])
    knots, values = calibrated((z * left_out[k]).sum(1), y)
    ids = list(texts)
    want = np.clip(np.interp(z_of(stats(ids)) @ solve(np.ones(len(y), bool)), knots, values), 0, 1)
    assert np.abs(want - np.array([got[i] for i in ids])).max() < 1e-3
