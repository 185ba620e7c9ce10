from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scread.functions import parse, ranges, seq
from scread.operators import match
from scread.plans import layouts


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return df.select(column).first()[0]


def test_wells(spark):
    w = lambda s, m="block": one(spark, ranges.expand_wells("s", m), s=s)
    assert w("A1") == ["A1"]
    assert sorted(w("A1:B2")) == ["A1", "A2", "B1", "B2"]
    assert sorted(w("a1;b2")) == ["A1", "B2"]
    assert len(w("A1-B6")) == 12
    assert len(w("A1-B6", "range")) == 18
    assert len(w("A1-A6,B1:D3,C4")) == 6 + 9 + 1


def test_indices(spark):
    x = lambda s, k: one(spark, ranges.expand_indices("s", k), s=s)
    assert x("A01:A03", "p7") == ["A01", "A02", "A03"]
    assert x("A01:C01", "p5") == ["A01", "B01", "C01"]
    assert len(x("P01-A01:P01-H12", "rt")) == 96
    assert x("A03:A01", "p7") == [] and x("A01:B02", "p7") == [] and x("P01-A01:P02-A02", "rt") == []


def test_strings(spark):
    assert one(spark, seq.revcomp("s"), s="ACGTN") == "NACGT"
    assert one(spark, seq.hamming("a", "b"), a="ACG", b="AGG") == 1
    assert one(spark, seq.hamming("a", "b"), a="ACG", b="AG") is None
    assert one(spark, seq.hamming_padded("a", "b"), a="ACG", b="AC") == 1
    assert one(spark, seq.phred("q"), q="!I") == [0, 40]
    assert one(spark, seq.mate_path("p"), p="/R1/x_R1_001.fastq.gz") == "/R1/x_R2_001.fastq.gz"
    assert one(spark, seq.read_id("s"), s="@r1 1:N:0") == "r1"
    assert [one(spark, seq.trim_varbases("s", "s")[0], s=s) for s in ("AC", "GTC", "TCAC", "GAC", "TCC", "N")] == ["C", "C", "C", "GAC", "TCC", "N"]
    assert one(spark, seq.trim_adapter("s", "AAAAAAAA"), s="CGCGCAAAA") == 5
    assert one(spark, seq.splice_status("s"), s="g-I2") == "U"


def test_cigar(spark):
    got = one(spark, seq.cigar_blocks(F.lit(10), "c"), c="2S5M3N4M1D2M1I")
    assert [tuple(b) for b in got] == [(10, 14), (18, 24)]
    assert one(spark, seq.spliced_length("c"), c="2S5M3N4M1D2M1I") == 11


def test_overlap_insert(spark):
    insert = "ACGTTGCAAGCTTAGCATCGGATCCTTAGCAAGTC"
    rc = insert[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert one(spark, seq.overlap_insert("a", "b"), a=insert + "AGATCGGA", b=rc + "AGATCGGA") == len(insert)


def test_parse(spark):
    assert one(spark, parse.clean_int("x"), x="1,234%") == 1234 and one(spark, parse.clean_int("x"), x="1.5") is None
    assert one(spark, parse.clean_float("x"), x="12.5%") == 12.5
    assert one(spark, parse.to_pct("x"), x=0.1234) == "12.34%"
    assert one(spark, parse.ratio4(F.lit(1), F.lit(3)), x=1) == "0.3333"
    assert one(spark, parse.unwrap_js("x"), x='var data = {"a": 1};\n') == '{"a": 1}'


def test_layouts():
    assert layouts.bc1_bounds("v3") == (50, 58) and layouts.bc1_bounds("v2") == (78, 86) and layouts.bc1_bounds(None) == (50, 58)
    assert layouts.parse_geometry("1[1-9,14-22]") == (1, [(0, 9), (13, 9)])
    assert layouts.layout("10xv3", dedup="", min_score=20).min_score == 20


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ACGT", min_size=5, max_size=6), min_size=1, max_size=6, unique=True), st.lists(st.text("ACGTN", min_size=4, max_size=7), min_size=1, max_size=12))
def test_neighbour_maps_equal_brute_force(spark, keys, seen):
    def padded(a, b):
        return sum(x != y for x, y in zip(a, b)) + abs(len(a) - len(b))

    sheet = spark.createDataFrame([(k, f"n{i}") for i, k in enumerate(keys)], "sequence string, barcode string")
    obs = spark.createDataFrame([(s,) for s in sorted(set(seen))], "o string")
    got = {r["o"]: r["hit"] and (r["hit"]["seq"], r["hit"]["status"]) for r in match.match_rescue(obs, "o", sheet, "hit").collect()}
    mins = {r["o"]: (r["distance"], r["matches"]) for r in match.match_min_hamming(obs, "o", sheet, 2).collect()}
    for s in set(seen):
        near = [k for k in keys if padded(s, k) <= 1]
        want = (s, "Correct") if s in keys else (near[0], "Corrected") if len(near) == 1 else None
        assert got[s] == want
        d = {k: padded(s, k) for k in keys if len(k) == len(s)}
        best = min(d.values(), default=9)
        assert mins[s] == ((best, sorted(k for k in d if d[k] == best)) if best <= 2 else (None, None))
