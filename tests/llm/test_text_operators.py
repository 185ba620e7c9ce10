import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import docs, empty, labels

from scread.llm import automaton_dedup, bwt_dedup, jaccard_join, line_rules, mixing, packing, quality, toxicity
from scread.llm.common import words

SPLIT = lambda t: [w.decode() for w in (t or "").encode().split()]


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def random_docs(spark, seed=0, n=40):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)]
    passage = [rng.choice(vocab) for _ in range(45)]
    rows = []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.randrange(5, 160))]
        if i % 3 == 0:
            at = rng.randrange(len(ws))
            ws[at:at] = passage[rng.randrange(10) :]
        if i % 7 == 0:
            ws = ws * 2
        rows.append((100 + i, " ".join(ws), "en", "s1"))
    rows += [(200 + i, rows[i][1] if i % 2 else rows[i][1] + " tail", "en", "s2") for i in range(10)]
    base = next(r[1] for r in rows if len(r[1].split()) > 120).split()
    for i in range(12):
        ws = list(base)
        for _ in range(1 + i % 4):
            ws[rng.randrange(len(ws))] = f"n{i}"
        rows.append((300 + i, " ".join(ws), "en", "s1"))
    return docs(spark, rows)


def words_removed(rows, window=20):
    ordered = sorted({(r["doc_id"] if r["doc_id"] is not None else -(1 << 63), r["text"] or "") for r in rows})
    seen, out = set(), {}
    for did, text in ordered:
        ws = SPLIT(text)
        gone = set()
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p : p + window])
            if key in seen:
                gone |= set(range(p, p + window))
            seen.add(key)
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out[did, text] = (len(ws), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return sorted(((r["doc_id"], *out[r["doc_id"] if r["doc_id"] is not None else -(1 << 63), r["text"] or ""]) for r in rows), key=str)


@pytest.mark.parametrize("hot, crowd", [(200_000, 5_000), (2, 5_000), (200_000, 1)])
def test_substring_dedup(spark, hot, crowd, monkeypatch):
    monkeypatch.setattr(automaton_dedup, "AUTOMATON_ROWS", crowd)
    d = random_docs(spark)
    rows = d.collect()
    out = automaton_dedup.remove_repeats(d, hot_rows=hot)
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == words_removed(rows)
    kept = {(r["doc_id"], r["n_chars"]): r["text"] for r in automaton_dedup.without_repeats(d, hot_rows=hot).collect()}
    for doc_id, n, gone, sha in words_removed(rows):
        texts = [t for (i, _), t in kept.items() if i == doc_id]
        assert sha in {hashlib.sha256(" ".join(SPLIT(t)).encode()).hexdigest() for t in texts}


def bytes_removed(rows, length):
    distinct = sorted({(r["doc_id"] or -1, r["text"] or "") for r in rows})
    count, out = {}, {}
    for _, text in distinct:
        b = text.encode()
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] = count.get(b[p : p + length], 0) + 1
    for key in distinct:
        b = key[1].encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((r["doc_id"], *out[r["doc_id"] or -1, r["text"] or ""]) for r in rows), key=str)


@pytest.mark.parametrize("hot", [200_000, 2])
def test_suffix_dedup(spark, hot):
    d = random_docs(spark, 1).filter("doc_id is null or doc_id not in (5, 6)")
    out = bwt_dedup.remove_repeated_bytes(d, hot_rows=hot)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == bytes_removed(d.collect(), 200)


@pytest.mark.parametrize("cluster", [4_000, 2])
def test_jaccard(spark, cluster):
    d = random_docs(spark, 2)
    rows = d.collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        ws = SPLIT((r["text"] or "").translate(lower))
        sets.append({tuple(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))} if ws else set())
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                a, b = comp[i], comp[j]
                comp = [a if c == b else c for c in comp]
    least = {c: min((rows[i]["doc_id"] for i in range(len(rows)) if comp[i] == c and rows[i]["doc_id"] is not None), default=None) for c in comp}
    want = sorted(((r["doc_id"], len(s), least[c]) for r, s, c in zip(rows, sets, comp)), key=str)
    assert got(jaccard_join.link_components(d, cluster_docs=cluster), "doc_id", "n_shingles", "component_id") == want


def test_r_tree_finds_all():
    rng = np.random.default_rng(0)
    points = rng.poisson(6, (400, jaccard_join.GROUPS)).astype(np.int32)
    points[200:] = points[:200] + (rng.random((200, jaccard_join.GROUPS)) < 0.02)
    sizes = points.sum(1)
    tree = jaccard_join.RTree(points, sizes)
    for i in range(0, 400, 7):
        want = np.flatnonzero(jaccard_join.may_link(np.minimum(points, points[i]).sum(1), sizes, sizes[i]))
        assert sorted(tree.search(points[i], int(sizes[i])).tolist()) == want.tolist()


def test_packed_counts_never_understate():
    for scale in (1, 10, 1000):
        c = np.random.default_rng(1).poisson(50, jaccard_join.GROUPS) * scale
        import pyarrow as pa

        back = jaccard_join.unpacked_counts(pa.array([jaccard_join.packed_counts(c)], pa.binary()))[0]
        assert (back >= c).all() and (scale > 1 or (back == c).all())


def test_mixing(spark):
    d = random_docs(spark, 3)
    n = [len(SPLIT(r["text"])) for r in d.collect()]
    out = mixing.mix(d).collect()
    assert sorted(r["size"] for r in out) == sorted(n) and all(0 <= r["copies"] <= 2 for r in out)
    again = mixing.mix(d)
    assert got(again, "doc_id", "size", "copies") == sorted(((r["doc_id"], r["size"], r["copies"]) for r in out), key=str)
    by = {}
    for r in out:
        s = by.setdefault(r["source_key"], [r["source_size"], r["target"], 0])
        s[2] += r["size"] * r["copies"]
    # water filling, by plain iteration
    names = sorted(by)
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    budget, free, want = 1.5 * sum(n), set(names), {}
    while True:
        w = sum(weight[k] for k in free)
        share = {k: (budget - sum(want.values())) * weight[k] / w for k in free}
        over = {k for k in free if share[k] > 2 * by[k][0]}
        if not over:
            want |= share
            break
        want |= {k: 2.0 * by[k][0] for k in over}
        free -= over
        if not free:
            break
    for k in names:
        assert by[k][1] == pytest.approx(want[k])
        # one document of s2 holds 30,000 of its 31,005 words, so its nearest sum is 4 % off
        assert abs(by[k][2] - by[k][1]) <= (0.05 if k == "as2" else 0.01) * by[k][1] + 2
    mixed = mixing.mixed_documents(d)
    assert mixed.columns == d.columns
    assert sum(len(SPLIT(r["text"])) for r in mixed.collect()) == pytest.approx(sum(v[2] for v in by.values()), rel=0.05)


def test_mixed_documents_take_what_mix_takes(spark):
    rows = [(1, f"a b {i % 3}", "en", f"s{i % 3}") for i in range(30)] + [(2, "", "en", "s0"), (None, None, "en", "s1")]
    d = docs(spark, rows)
    want, got_ = {}, {}
    for r in mixing.mix(d).collect():
        k = r["doc_id"], r["source_key"], r["size"]
        want[k] = want.get(k, 0) + r["copies"]
    for r in mixing.mixed_documents(d).collect():
        k = r["doc_id"], "z" if r["source"] is None else "a" + r["source"], len(SPLIT(r["text"]))
        got_[k] = got_.get(k, 0) + 1
    assert got_ == {k: v for k, v in want.items() if v} and want[2, "as0", 0] == 1


def test_fit_goes_above_where_that_is_nearer():
    assert mixing.fit([3], [10], 50) == [17] and mixing.fit([3], [10], 49) == [16]
    rng = random.Random(9)
    for _ in range(40):
        lengths = sorted(rng.sample(range(5, 90), 4))
        counts = [rng.randrange(1, 3) for _ in lengths]
        goal = int(rng.uniform(0, 2 * sum(a * b for a, b in zip(lengths, counts))) + 0.5)
        sums = {0}
        for a, n in zip(lengths, counts):
            sums = {s + a * k for s in sums for k in range(2 * n + 1)}
        taken = sum(a * c for a, c in zip(lengths, mixing.fit(lengths, counts, goal)))
        assert abs(taken - goal) == min(abs(s - goal) for s in sums)


def test_fit_reaches_every_sum_it_can():
    rng = random.Random(4)
    for _ in range(60):
        lengths = sorted(rng.sample(range(1, 60), 6))
        counts = [rng.randrange(1, 4) for _ in lengths]
        target = rng.uniform(0, 2 * sum(a * b for a, b in zip(lengths, counts)))
        copies = mixing.fit(lengths, counts, target)
        assert all(0 <= c <= 2 * n for c, n in zip(copies, counts))
        sums = {0}
        for a, n in zip(lengths, counts):
            sums = {s + a * k for s in sums for k in range(2 * n + 1)}
        goal = int(target + 0.5)
        taken = sum(a * c for a, c in zip(lengths, copies))
        assert abs(taken - goal) <= goal - max(x for x in sums if x <= goal)


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    d = random_docs(spark, 5)
    out = packing.pack(d, path, group_pieces=40).collect()
    ids = {}
    for r in d.collect():
        ids.setdefault(r["doc_id"], []).append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    for doc_id, versions in ids.items():
        mine = [p for p in out if p["doc_id"] == doc_id]
        assert sum(p["length"] for p in mine) == sum(map(len, versions))
        if len(versions) == 1:  # the pieces tile the document
            mine.sort(key=lambda p: p["start"])
            assert [p["start"] for p in mine] == [0, *np.cumsum([p["length"] for p in mine])[:-1].tolist()]
        for p in mine:
            assert any(len(v) == p["doc_tokens"] and zlib.crc32(np.array(v[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for v in versions)
    seqs = {}
    for p in out:
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for s in seqs.values():
        s.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and s[0][0] == 0 and sum(n for _, n in s) <= 2048
    filled = sum(p["length"] for p in out)
    assert len(seqs) * 2048 - filled <= 0.05 * filled + 2048 * len({s >> 32 for s in seqs})  # little padding, a window a group aside


def test_word_tokenizer_is_exact():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, mine = Tokenizer.from_file(path), packing.WordTokenizer(path, cache_bytes=2_000)
    odd = ["don't. it's, a.b, x<|endoftext|>. <|startoftext|>", "\u0130stanbul. \u00e9. e\u0301. \u00abq\u00bb. \u00df \u0149 \u01c5. \u00aa. \u1e8b.", "5. 5., a5.! `x`. \u201cq\u201d. $$$ .,; ### a###", "\u212b. x\u200d. \u2167. \u2460. \u03a3\u0391\u03a3.", "\u4e2d\u6587. \ud55c. \u1112\u1161\u11ab", ""]
    rng = random.Random(8)
    odd += ["".join(rng.choice("abcE\u00e9\u00dc.,!#'5 <|>\n\t\u0301") for _ in range(200)) for _ in range(60)]
    for _ in range(3):  # also from the cache
        for text, ids in zip(odd, mine.encode([t.encode() for t in odd])):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_differencing_is_near_equal():
    lengths = np.random.default_rng(2).integers(1, 513, 600)
    k = packing.windows(lengths)
    sums = np.bincount(k, lengths)
    assert sums.max() <= 2048 and len(sums) <= -(-lengths.sum() // 2048) * 1.06 + 1


def test_line_rules(spark):
    boiler = "All rights are kept by the people who made this page and its many parts"
    body = lambda i: " ".join(f"d{i}w{j}" for j in range(60))
    many = [(400 + i, body(i) + "\n" + boiler, "en", "h1") for i in range(30)] + [(500 + i, (boiler + "\n") * 4 + " ".join(f"e{i}w{j}" for j in range(10)), "en", "h1") for i in range(5)]
    d = docs(spark, many)
    out = {r["doc_id"]: r for r in line_rules.line_rules(d, min_docs=20, doc_share=0.01).collect()}
    assert all(out[400 + i]["kept"] and out[400 + i]["n_removed_words"] == 15 for i in range(30))
    assert not any(out[500 + i]["kept"] for i in range(5))
    assert (out[2]["n_words"], out[2]["base_failed"], out[7]["n_symbols"]) == (0, True, 4)
    assert (out[5]["n_words"], out[5]["base_failed"]) == (30_000, False)  # the cycle is 30287 words long
    assert line_rules.line_rules(d).count() == d.count()
    again = d.unionByName(d).unionByName(d)  # repeated rows are one document, so no limit moves
    assert got(line_rules.line_rules(again, min_docs=29).distinct(), "doc_id", "n_removed_words", "kept") == got(line_rules.line_rules(d, min_docs=29).distinct(), "doc_id", "n_removed_words", "kept")


@pytest.mark.parametrize("long_words", [1 << 16, 20])
def test_repeated_words_brute_force(spark, long_words, monkeypatch):
    monkeypatch.setattr(line_rules, "LONG_WORDS", long_words)
    d = random_docs(spark, 6)
    rows = {r["doc_id"]: r["text"] or "" for r in d.collect()}
    for r in line_rules.base_rules(d).collect():
        ws = SPLIT(rows[r["doc_id"]]) if r["doc_id"] in rows else None
        tri = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
        count = {}
        for t in tri:
            count[t] = count.get(t, 0) + 1
        want = len({j for i, t in enumerate(tri) if count[t] > 1 for j in (i, i + 1, i + 2)})
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(ws), sum(map(len, ws)), want)


def test_classifiers_take_everything(spark):
    d, l = docs(spark), labels(spark)
    for scores in (quality.quality_scores(d, l), toxicity.toxicity_scores(d, l)):
        r = scores.collect()
        assert len(r) == d.count() and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in r)
    none = labels(spark, ())
    assert {x["score"] for x in quality.quality_scores(d, none).collect()} == {0.5}
    assert {x["score"] for x in toxicity.toxicity_scores(d, none).collect()} == {0.0}
    assert quality.accepted(d, l).columns == d.columns


def test_classifiers_learn(spark, sf):
    big = sf.replace("0.001", "0.01")
    d, l = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    held = quality.quality_scores(d, l).filter("held_out").join(l, "doc_id")
    right = held.filter("predicted = quality").count()
    assert right >= 0.95 * held.count()
    tox = toxicity.toxicity_scores(d, l).filter("held_out").join(l, "doc_id").select("score", "toxic").collect()
    hi, lo = [[r["score"] for r in tox if r["toxic"] == k] for k in (1, 0)]
    assert np.mean(hi) > 3 * np.mean(lo)


@pytest.mark.parametrize(
    "run",
    [
        lambda d, l: mixing.mix(d), lambda d, l: line_rules.line_rules(d), lambda d, l: quality.quality_scores(d, l), lambda d, l: toxicity.toxicity_scores(d, l), lambda d, l: bwt_dedup.remove_repeated_bytes(d),
        lambda d, l: automaton_dedup.remove_repeats(d), lambda d, l: jaccard_join.link_components(d), lambda d, l: packing.pack(d, __import__("public_tokenizers").path("word_bpe_49k.json")),
    ],
)
def test_empty_tables(spark, run):
    assert run(empty(spark), labels(spark)).count() == 0


def test_words_of_blocks():
    texts = ["ab  cd", "", "x", " \t", "y z"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    starts, ends, hashes, at = words(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "cd", "x", "y", "z"] and at.tolist() == [0, 2, 2, 3, 3, 5]
    assert len(set(hashes.tolist())) == 5
