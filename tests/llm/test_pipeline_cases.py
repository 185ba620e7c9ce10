"""Every stage of the pipeline on nulls, empty and long texts, repeats, extra columns and no rows."""

import random

import pytest
from helpers import docs, empty, labels

import corpus_pipeline as p


@pytest.mark.parametrize("make", [docs, empty])
def test_stages_take_everything(spark, tmp_path, make):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    d = make(spark)
    for name, step in p.STAGES[:-1]:
        before = {(r["doc_id"], r["source"]) for r in d.collect()}
        d = step(spark, d, str(tmp_path))
        assert d.columns == p.COLUMNS, name
        assert {(r["doc_id"], r["source"]) for r in d.collect()} <= before
    out = p.STAGES[-1][1](spark, d, str(tmp_path))
    assert (out.count() > 0) == (d.count() > 0)


def test_near_duplicates_keep_one_of_each_group(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(70, text, "en", "s1"), (71, text, "en", "s2"), (72, text + " more", "en", "s1"), (73, "other words here", "en", "s1")]
    d = docs(spark, rows)
    kept = [r["doc_id"] for r in p.near_duplicates(spark, d, str(tmp_path)).collect()]
    assert kept.count(70) == 1 and 71 not in kept and 72 not in kept and 73 in kept
    assert kept.count(2) == 1 and kept.count(3) == 1  # wordless documents link with nothing


def test_near_duplicates_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        ws = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.randrange(3, 140))]
        for i in range(6):
            mine = list(ws)
            for _ in range(rng.randrange(4)):
                mine[rng.randrange(len(mine))] = f"n{rng.randrange(9)}"
            rows.append((100 + 10 * g + i, " ".join(mine), "en", "s1"))
    sets = {}
    for doc_id, text, *_ in rows:
        ws = text.split()
        sets[doc_id] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}
    least = {k: k for k in sets}
    near = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    for a, b in near:
        x, y = sorted((least[a], least[b]))
        least = {k: x if v == y else v for k, v in least.items()}
    d = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in p.near_duplicates(spark, d, str(tmp_path)).collect())
    assert kept == sorted(k for k, v in least.items() if k == v)


def test_near_duplicates_go_by_row(spark, tmp_path):
    t, u, v = (" ".join(f"{k}{i}" for i in range(80)) for k in "tuv")
    rows = [(1, t), (2, t), (2, u), (3, u + " plus"), (3, u + " plus"), (None, t), (None, v), (4, v), (5, ""), (5, ""), (6, None)]
    d = spark.createDataFrame([(i, x, "en", "s1", 0) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r["doc_id"], (r["text"] or "")[:2]) for r in p.near_duplicates(spark, d, str(tmp_path)).collect()), key=str)
    assert kept == sorted([(1, "t0"), (2, "u0"), (4, "v0"), (5, ""), (5, ""), (6, "")], key=str)


def test_substring_stage_keeps_other_columns(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(30))
    d = docs(spark, [(80, "a start " + passage, "en", "s1"), (81, passage + " an end", "de", None)])
    out = {r["doc_id"]: r for r in p.substring_dedup(spark, d, str(tmp_path)).collect()}
    assert out[80]["text"] == "a start " + passage and out[81]["text"] == "an end" and out[81]["lang"] == "de" and out[81]["n_chars"] == 6
    assert out[2]["text"] is None
