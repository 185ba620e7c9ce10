"""Super-k-mers against plain k-mers."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from scread.operators import kmers, taxonomy

TURN = str.maketrans("ACGT", "TGCA")


def canonical(s: str, k: int) -> list[str]:
    every = (s[i : i + k] for i in range(len(s) - k + 1))
    return [min(x, x[::-1].translate(TURN)) for x in every if set(x) <= set("ACGT")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ACGTN", max_size=60)), max_size=6), st.integers(1, 31), st.integers(1, 15))
def test_runs_hold_each_kmer_once(reads, k, m):
    m = min(m, k)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(reads)), pa.int64()), pa.array(reads, pa.string())], names=["read_id", "seq"])
    got, groups = Counter(), {}
    for out in kmers._runs([batch], k, m):
        for r in out.to_pylist():
            for x in canonical(r["letters"], k):
                got[r["read_id"], x] += 1
                assert groups.setdefault(x, r["minimizer"]) == r["minimizer"]  # either strand, any place
    assert got == Counter((i, x) for i, s in enumerate(reads) for x in canonical(s or "", k))
    table = pa.RecordBatch.from_arrays([pa.array([*groups, "NN", None], pa.string()), pa.array(range(len(groups) + 2), pa.int64())], names=["kmer", "taxid"])
    rows = [r for out in kmers._table([table], k, m) for r in out.to_pylist()]
    assert [r["minimizer"] for r in rows] == list(groups.values()) and len({r["number"] for r in rows}) == len(groups)


def test_hits(spark):
    rng = random.Random(4)
    genome = "".join(rng.choice("ACGT") for _ in range(3000))
    reads = [(i, genome[p : p + 90] if i % 2 else genome[p : p + 90][::-1].translate(TURN)) for i, p in enumerate(rng.randrange(2900) for _ in range(200))]
    reads += [(500 + i, "A" * 60) for i in range(40)] + [(600, None), (601, ""), (602, genome[:40] + "N" + genome[:31]), (603, genome[:90])] * 2
    seqs = spark.createDataFrame(reads, "read_id int, seq string")
    table = [(x, n % 7) for n, x in enumerate(dict.fromkeys(canonical(genome, 31)))] + [("A" * 31, 9), ("A" * 31, 10), ("ACG", 1)]
    known = spark.createDataFrame(table, "kmer string, taxid int")
    of = {}
    for x, t in table:
        of.setdefault(x, []).append(t)
    want = Counter((i, t) for i, s in reads for x in canonical(s or "", 31) for t in of.get(x, []))
    for more in ({}, {"group_kmers": 200, "group_runs": 15}):
        assert {(r["read_id"], r["taxid"]): r["hits"] for r in kmers.kmer_hits(seqs, known, 31, **more).collect()} == want
    assert kmers.kmer_hits(seqs.limit(0), known).count() == kmers.kmer_hits(seqs, known.limit(0)).count() == 0
    plain = taxonomy.canonical_kmers(seqs, "read_id", "seq", 31).join(known, "kmer").groupBy("read_id", "taxid").count()
    assert {(r[0], r[1]): r[2] for r in plain.collect()} == want


def test_minimizers_are_few():
    codes = kmers._CODES[np.frombuffer("".join(random.Random(1).choice("ACGT") for _ in range(5000)).encode(), np.uint8)]
    least = kmers.minimizers(codes, 31, 15)
    assert len(least) == 4970 and (np.diff(least.astype(np.int64)) != 0).mean() < 0.15


def test_numbers_of_packed_letters():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(31, 70))) for _ in range(20)]
    _, codes, begins = kmers._joined(pa.array(texts))
    letters, at = kmers._fours(codes, begins, np.array([len(s) for s in texts]))
    for k in range(1, 32):
        want = [min(int(y.translate(str.maketrans("ACGT", "0123")), 4) for y in (x, x[::-1].translate(TURN))) for s in texts for x in (s[i : i + k] for i in range(len(s) - k + 1))]
        places = np.concatenate([a * 4 + np.arange(len(s) - k + 1) for s, a in zip(texts, at)])
        assert kmers._numbers(letters, places, k).tolist() == want


def test_references_are_sent_as_stretches():
    """About 10 bytes of letters a stretch and none of a bucket that only one side has; equal stretches of a batch are sent once."""
    rng = random.Random(5)
    seqs = ["".join(rng.choice("ACGT") for _ in range(64)) for _ in range(2000)]
    rows = pa.RecordBatch.from_pydict({"place": pa.array([i % 25 + 1 for i in range(6000)], pa.int32()), "seq": seqs * 3})
    n = np.zeros(kmers.BUCKETS, np.int64)
    for out in kmers._bucket_counts([rows], 31, 15):
        n[out.column("bucket").to_numpy()] = out.column("n").to_numpy()
    assert n.sum() == 6000 * 34
    deal = kmers.Deal.of(n, n, 4, 1_000_000, 1_000_000)
    sent = list(kmers._sent_references([rows], deal, 31, 15))
    assert deal.all == 4 and sum(x.nbytes for x in sent) < 6 * 2000 * 34
    found = [y for x in sent for y in kmers._received(pa.Table.from_batches([x]), 31)]
    assert sum(len(x) for x, _ in found) == 2000 * 34
    assert not list(kmers._sent_references([rows], kmers.Deal.of(n, 0 * n, 4, 1, 1), 31, 15))


def _classified(reads, refs, parent, k):
    """By the definition: read to taxon."""
    path = {t: [t] for t in parent}
    for t in parent:
        while path[t][-1] in parent and parent[path[t][-1]] != path[t][-1]:
            path[t].append(parent[path[t][-1]])
    lowest = lambda taxa: next((a for a in path[taxa[0]] if all(a in path[t] for t in taxa)), None)
    of = {}
    for t, s in refs:
        for x in canonical(s or "", k):
            of.setdefault(x, set()).add(t)
    table = {x: lowest(sorted(ts)) for x, ts in of.items() if all(t in parent for t in ts)}
    out = {}
    for i, s in reads:
        hits = Counter(t for x in canonical(s or "", k) if (t := table.get(x)) is not None)
        score = {t: sum(n for a, n in hits.items() if a in path[t]) for t in hits if t in parent}
        out[i] = lowest(sorted(t for t in score if score[t] == max(score.values()))) if score else None
    return out, table


def test_references_without_a_table(spark):
    """Hits and taxa of plain search: repeats, unknown taxa, an ancestor outside the tree, crowded buckets in parts and copies."""
    rng = random.Random(7)
    parent = {1: 1, 2: 1, 3: 2, 4: 2, 5: 1, 6: 5, 7: 90, 8: 90}
    parts = ["".join(rng.choice("ACGT") for _ in range(40)) for _ in range(12)]
    refs = [(rng.choice([3, 4, 6, 7, 8, 2, 5]), "".join(rng.sample(parts, 2))) for _ in range(14)] + [(99, parts[11]), (None, parts[10]), (3, None), (6, "A" * 300), (4, "A" * 300), (3, parts[0][:20] + "N" + parts[1])]
    reads = [(i, "".join(rng.sample(parts, 3))[rng.randrange(9) :]) for i in range(25)] + [(100 + i, "T" * 250) for i in range(12)] + [(200, None), (201, ""), (202, "ACGT"), (203, parts[2][::-1].translate(TURN) + "N" + parts[3])]
    seqs, known = spark.createDataFrame(reads, "read_id int, seq string"), spark.createDataFrame(refs, "taxid long, sequence string")
    paths = taxonomy.ancestors(spark.createDataFrame(list(parent.items()), "taxid long, parent long"))
    want, table = _classified(reads, refs, parent, 31)
    assert {2, 90} & set(want.values()) and None in want.values() and len(set(want.values())) > 4
    got = taxonomy.classify_by_references(seqs, known, paths).collect()
    assert len(got) == len(reads) and dict(map(tuple, got)) == want
    assert dict(map(tuple, taxonomy.classify_reads(seqs, taxonomy.kmer_taxa(known, paths), paths).collect())) == want
    place = {t: n for n, t in enumerate(parent, 1)}
    ends = {}
    for t, s in refs:
        for x in canonical(s or "", 31):
            ends.setdefault(x, []).append(place.get(t, -1))
    hits = Counter((i, min(ends[x]), max(ends[x])) for i, s in reads for x in canonical(s or "", 31) if x in ends and min(ends[x]) > 0)
    placed = spark.createDataFrame([(place.get(t), s) for t, s in refs], "place int, seq string")
    for more in ({}, {"group_kmers": 20, "group_asked": 150}):
        found = Counter()
        for r in kmers.reference_hits(seqs, placed, 31, **more).collect():
            found[r["read_id"], r["first"], r["last"]] += r["hits"]
        assert found == hits


def test_no_k_mers_are_written(spark, sf, monkeypatch):
    """The query neither explodes the k-mers of its references nor writes any, and shuffles no letters that aren't packed."""
    from scread.queries import QUERIES

    def folder(*_):
        raise AssertionError("k-mers are written")

    monkeypatch.setattr(kmers, "folder", folder)
    monkeypatch.setattr(taxonomy, "folder", folder)
    plan = QUERIES["classify_reads"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "sizes" in plan
    dealt = [line for line in plan.split("\n") if "REPARTITION_BY_NUM" in line]
    assert len(dealt) >= 6 and "Exchange hashpartitioning(pair_id" not in plan
