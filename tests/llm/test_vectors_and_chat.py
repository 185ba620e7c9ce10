import numpy as np
from pyspark.sql import functions as F

from scread.llm import ann_tree, chat
from scread.llm.components import connected


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[300:900] = x[0]  # a third of all rows hold one vector
    rows = [(i, v.tolist(), 1, "k") for i, v in enumerate(x)]
    bad = [(5000, None, 1, "k"), (5050, [0.0] * 16, 1, "k"), (5100, [float("nan")] + [1.0] * 15, 1, "k"), (5150, [None] + [1.0] * 15, 1, "k"), (5200, [], 1, "k"), (5250, [1.0, 2.0], 1, "k")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int, key string")
    out = ann_tree.search(df, F.col("vec_id") % 50 == 0, fit_rows=800).collect()
    by = {}
    for r in out:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    q = [i for i in range(1500) if i % 50 == 0]
    assert sorted(by) == q
    u = x.astype(float)
    s = (u @ u.T) / np.outer(np.linalg.norm(u, axis=1), np.linalg.norm(u, axis=1))
    hit = 0
    for i in q:
        mine = sorted(by[i])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and i not in [m[1] for m in mine]
        assert np.allclose([m[2] for m in mine], [s[i, m[1]] for m in mine], atol=1e-12)
        want = sorted((j for j in range(1500) if j != i), key=lambda j: (-round(s[i, j], 10), j))[:5]
        hit += len(set(want) & {m[1] for m in mine})
        if 300 <= i < 900:
            assert [m[1] for m in mine] == want
    assert hit >= 0.9 * 5 * len(q)
    few = ann_tree.search(df.filter("vec_id < 3"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert ann_tree.search(df.filter("vec_id < 0"), F.col("vec_id") == 0).count() == 0


def test_tree_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(900, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = ann_tree.Tree(x)
    seen = list(tree.visits(x[0]))
    assert sorted(seen) == list(range(tree.n_leaves)) and seen[0] == tree.leaves(x[:1])[0]


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "a", 1), (1, 1, "user", "b<|im_sep|>\\<\\|", 1), (1, 2, "assistant", "x\n<|im_end|>\n", 1), (1, 3, "assistant", None, 1), (2, None, None, None, 1),
        (3, 5, "assistant", "<|im_end|>\n<|im_start|>user\nhi", 1), (3, 5, "assistant", "<|im_end|>\n<|im_start|>user\nhi", 1), (None, 1, "odd\nrole<|", "\\\\", 1), (4, 0, "user", "y " * 50_000, 1),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_chat(df).select("*", chat.read_chat(F.col("formatted")).alias("t")).collect()
    back = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in out}
    for c in {r[0] for r in rows}:
        mine = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert back[c] == [m[1:] for m in mine]
    one = next(r for r in out if r["conv_id"] == 1)
    assert one["formatted"].count("<|im_start|>") == 2 and one["formatted"].count("<|im_end|>") == 2
    spans = [one["formatted"][s["start"] : s["start"] + s["length"]] for s in one["loss_spans"]]
    assert spans == ["x\n<\\|im_end|>\n", ""]
    assert chat.format_chat(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and got[200] == 150 and len(got) == 45
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
