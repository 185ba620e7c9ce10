"""Bit-parallel trimming against letter by letter comparison."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from scread.operators import trim

WORDS = st.text("ACGTNa", max_size=150)


def table(reads):
    n = np.array([len(r) for r in reads])
    out = np.zeros((len(reads), int(n.max(initial=0))), np.uint8)
    for i, r in enumerate(reads):
        out[i, : len(r)] = np.frombuffer(r.encode(), np.uint8)
    return out, n


def differ(a, b):
    return sum(x != y for x, y in zip(a, b))


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=5), st.text("ACGT", min_size=1, max_size=90), st.integers(1, 5), st.sampled_from([0.0, 0.1, 0.34]))
def test_adapters(reads, adapter, least, error):
    reads = reads + [reads[0] + adapter[:40], reads[0] + adapter]
    got = trim.adapter_cuts(*table(reads), adapter.encode(), least, error)
    for r, k in zip(reads, got):
        fits = (i for i in range(len(r) - least + 1) if differ(r[i:], adapter) <= math.floor(min(len(r) - i, len(adapter)) * error))
        assert k == next(fits, len(r))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS, st.text("ACGT", max_size=140), st.integers(0, 9)), min_size=1, max_size=4), st.integers(1, 40))
def test_overlaps(pairs, least):
    complement = str.maketrans("ACGTacgt", "TGCAtgca")
    mates = [(p[0], p[1]) for p in pairs] + [("".join("N" if i % 9 == p[3] else c for i, c in enumerate(p[2])) + p[0][:70], p[2][::-1].translate(complement) + p[1][:30]) for p in pairs]
    (a, n1), (b, n2) = table([m[0] for m in mates]), table([m[1] for m in mates])
    got = trim.inserts(a, n1, b, n2, least, 5, 0.2)
    for (r1, r2), k in zip(mates, got):
        ok = (n for n in range(least, min(len(r1), len(r2))) if (d := differ(r1[:n], r2[:n][::-1].translate(complement))) <= 5 and d <= 0.2 * n)
        assert k == next(ok, 0)


def test_table(spark):
    rows = [(1, "A" * 40 + "GATTACA", "I" * 47, "T" * 40 + "CC", "I" * 42), (2, None, None, "ACGT", "IIII"), (3, "ACGTACGGATT", "IIIIIIIIIII", "", ""), (4, "CCC", "III", "CCC", "III")]
    df = spark.createDataFrame(rows, "pair_id long, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    out = {r["pair_id"]: r for r in trim.trim_pairs(df, ("GATTACA", None)).collect()}
    assert out[1]["insert"] == 30 and len(out[1]["r1_seq"]) == len(out[1]["r2_qual"]) == 30 and out[1]["r1_trim"] == "overlap"
    assert (out[3]["r1_seq"], out[3]["r1_qual"], out[3]["r1_trim"], out[3]["r2_trim"]) == ("ACGTACG", "IIIIIII", "adapter", None)
    assert out[2]["r1_seq"] is None and out[2]["r2_seq"] == "ACGT" and out[4]["r1_trim"] is None
    counts = {(r["mate"], r["reason"]): r["reads"] for r in trim.trim_counts(trim.trim_pairs(df, ("GATTACA", None))).collect()}
    assert counts == {("r1", "overlap"): 1, ("r2", "overlap"): 1, ("r1", "adapter"): 1, ("r1", "none"): 2, ("r2", "none"): 3}
    assert trim.trim_pairs(df.limit(0)).count() == 0
