"""Hard negatives against brute force, and packed products against plain ones."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scread.llm import hard_negatives as hn


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 30), st.integers(1, 20), st.sampled_from([0, 1, 5, 300, 30_000, 2**28]), st.sampled_from([0, 1, 300, 30_000, 2**28]), st.integers(0, 9))
def test_packed_products(n, d, rows_to, anchors_to, seed):
    rng = np.random.default_rng(seed)
    rows, anchors = rng.integers(-rows_to, rows_to + 1, (n, d)), rng.integers(-anchors_to, anchors_to + 1, (4, d))
    if n:
        rows[0], anchors[0] = rows_to, -anchors_to
    packed = hn.PackedRows(rows, int(np.abs(anchors).max()))
    assert packed.fields > 1 and (packed.scores(anchors) == anchors @ rows.T).all()


def test_carriers():
    assert [hn.PackedRows(np.full((3, 64), m), m).carrier for m in (100, 1_000, 2**28)] == [np.float64, np.int64, object]


def brute(rows, anchors, positives=5, negatives=3):
    """rows: (id, label, vector) with unusable ones; the definition in plain Python."""
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        new = (label, [math.floor(256 * x) for x in v])
        usable[i] = min(usable.get(i, new), new)
    out = []
    for a in filter(anchors, usable):
        label, v = usable[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in usable.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [(t, i) for t, i, m in scored if m != label and -50 * s <= -100 * t <= -95 * s][:negatives]
            out += [(a, p, k, i, -s, -t) for k, (t, i) in enumerate(hard, 1)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(700, 12)) * 0.3 + 0.25).astype(np.float32)
    x[200:430] = x[0]  # a third of all rows hold one vector, and one label
    x[500:520] *= 1000
    rows = [(i, 0 if 200 <= i < 430 else int(rng.integers(0, 4)), v.tolist()) for i, v in enumerate(x)]
    rows += [rows[0], rows[50], rows[3], (50, 3, [1.0] * 12), (None, 1, [1.0] * 12), (1000, None, [1.0] * 12), (1050, 1, None), (1100, 1, [float("nan")] * 12)]
    rows += [(1150, 1, [float("-inf")] + [1.0] * 11), (1200, 1, [None] + [1.0] * 11), (1250, 1, []), (1300, 2, [1.0, 0.5]), (-50, 2, [-1.0] * 12), (1350, 9, [0.5] * 12)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, rank string, chunk int")
    want = brute(rows, lambda i: i % 50 == 0)
    assert len(want) > 60
    for more in ({}, {"chunk_rows": 90, "block_anchors": 4}):
        assert sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 50 == 0, **more).collect()) == want
    assert hn.mine(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert hn.mine(df.filter("label = 3"), F.col("vec_id") % 50 == 0).count() == 0
    assert hn.mine(df.filter("vec_id < 9"), F.lit(False)).count() == 0


def test_components_that_pass_a_long(spark):
    rows = [(0, 1, [1e300, 1.0]), (1, 1, [1e300, -1e308]), (2, 2, [1e300, -1e308]), (3, 2, [1e12, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = hn.mine(df, F.col("vec_id") == 0).collect()
    assert all(r["positive_id"] == 1 for r in out)


@pytest.mark.parametrize("slice_size", [1, 50])
def test_slices_change_nothing(spark, monkeypatch, slice_size):
    import pandas as pd

    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"vec_id": range(40), "label": rng.integers(0, 2, 40), "vec": list(rng.integers(-9, 10, (40, 3)))})
    asked = rows.iloc[::5].rename(columns={"vec_id": "anchor_id"})
    whole = hn._positives(asked, rows, 3)
    monkeypatch.setattr(hn, "SCORED_AT_ONCE", slice_size)
    assert hn._positives(asked, rows, 3).values.tolist() == whole.values.tolist()
