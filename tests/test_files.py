"""Files read from the middle and written by many tasks."""

import gzip
import random

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scread.operators import intervals
from scread.sinks import fastq as fq_out
from scread.sinks import files
from scread.sources import fasta, fastq, storage
from scread.sources import lines as lines_of
from scread.sources import tables as t_in


def blocks(data: bytes, n: int) -> bytes:
    """Block-compressed with members of n bytes."""
    return b"".join(files.member(data[i : i + n]) for i in range(0, len(data), n)) + files.LAST_MEMBER


def put(path, data: bytes):
    path.write_bytes(data)
    return str(path)


def test_members_are_gzip(tmp_path):
    noise = random.Random(1).randbytes(files.MEMBER)
    for data in (b"", b"x", b"ab" * 30_000, noise):
        assert gzip.decompress(files.member(data)) == data and storage.member_size(files.member(data)) == len(files.member(data)) <= 2**16
    assert gzip.decompress(files.LAST_MEMBER) == b"" and storage.member_size(files.LAST_MEMBER) == 28
    assert storage.member_size(gzip.compress(b"x")) is None


def record(i: int, length: int, rng) -> bytes:
    # qualities that look like headers and separators
    qual = "".join(rng.choice("@+I#") for _ in range(length))
    return f"@r{i} 1:N:0:A+C\n{'ACGT' * (length // 4)}{'N' * (length % 4)}\n+{'r%d' % i if i % 7 == 0 else ''}\n{qual}\n".encode()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 60), st.integers(1, 40), st.integers(0, 5), st.booleans(), st.booleans(), st.integers(5, 90))
def test_ranges_own_each_record_once(tmp_path_factory, n, step, seed, compressed, whole_line, member):
    rng = random.Random(seed)
    data = b"".join(record(i, rng.randint(1, 30), rng) for i in range(n))
    data = data if whole_line else data[:-1]
    path = put(tmp_path_factory.mktemp("x") / "a", blocks(data, member) if compressed else data)
    storage_piece, storage.PIECE = storage.PIECE, member
    try:
        how = storage.kind(path)
        found = [fastq.count_range(path, how, a, b, 3) for a, b in storage.cut(path, how, step * member)]
        assert sum(k for k, _ in found) == n
        base = 0
        every = [f"@r{i}".encode() for i in range(n)]
        for k, marks in found:
            assert [m[0] for m in marks] == list(range(0, k, 3))
            for m, place, within in marks:
                first = next(fastq._records(path, how, place, within))[0][0]
                assert first.split(b" ")[0] == every[base + m]
            base += k
        assert base == n
    finally:
        storage.PIECE = storage_piece


@pytest.mark.parametrize("form", ["plain", "blocks", "stream", "mixed"])
def test_one_file_by_many_tasks(spark, tmp_path, form):
    rng = random.Random(2)
    mates = [b"".join(record(i, rng.randint(5, 20) * k, rng) for i in range(6000 - k)) for k in (1, 4)]
    pack = {"plain": lambda d, k: d, "blocks": lambda d, k: blocks(d, 9_000), "stream": lambda d, k: gzip.compress(d), "mixed": lambda d, k: gzip.compress(d) if k else d}[form]
    paths = [put(tmp_path / f"R{k + 1}", pack(d, k)) for k, d in enumerate(mates)]
    pairs = fastq.read_fastq_multi(spark, [("s", "l", *paths)], ("r1", "r2"), split_bytes=65_536 if form == "plain" else 20_000)
    if form in ("plain", "blocks"):
        assert pairs.rdd.getNumPartitions() >= 8
    got = sorted(tuple(r) for r in pairs.collect())
    lines = [d.decode().split("\n") for d in mates]
    want = [(i, "s", "l", f"r{i}", "1:N:0:A+C", lines[0][4 * i + 1], lines[0][4 * i + 3], lines[1][4 * i + 1], lines[1][4 * i + 3]) for i in range(5996)]
    assert got == want


def test_awkward_files(spark, tmp_path):
    empty, crlf = put(tmp_path / "e", b""), put(tmp_path / "c", b"@a x y\r\nAC\r\n+\r\nII\r\n@b\r\nG\r\n+\r\nI")
    assert fastq.read_fastq_multi(spark, [("s", "0", empty)], ("r1",)).count() == 0
    assert rows(fastq.read_fastq_multi(spark, [("s", "0", crlf), ("s", "1", empty)], ("r1",)).select("name", "comment", "r1_seq", "r1_qual")) == [("a", "x y", "AC", "II"), ("b", "", "G", "I")]
    assert fastq.read_fastq_multi(spark, [], ("r1",)).count() == 0


def test_pairs_are_written_in_one_pass(spark, tmp_path):
    """Several lanes, whose pair_ids start anew: names are equal line by line, and the input is evaluated once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(3000).select(
        (F.col("id") % 1000).alias("pair_id"), F.concat(F.lit("l"), F.floor(F.col("id") / 1000)).alias("lane"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("sample"),
        F.concat(F.lit("n"), "id").alias("name"), F.lit("").alias("comment"), F.lit("ACGT").alias("r1_seq"), F.lit("IIII").alias("r1_qual"), F.lit("AC").alias("r2_seq"), F.lit("II").alias("r2_qual"),
    )
    fq_out.write_fastq(df.mapInPandas(count, df.schema), str(tmp_path / "out"), files=3)
    assert seen.value == 3000
    names = set()
    for sample in "ab":
        for part in range(3):
            one, two = (list((tmp_path / "out" / f"sample={sample}" / f"mate={m}" / f"part={part}").glob("*.gz")) for m in ("R1", "R2"))
            assert len(one) == len(two) == 1
            heads = [gzip.open(p, "rt").read().split("\n")[0:-1:4] for p in (one[0], two[0])]
            assert heads[0] == heads[1] and heads[0]
            names |= set(heads[0])
    assert len(names) == 3000 and not list((tmp_path / "out").glob("_writing*"))


def test_one_file_in_order(spark, tmp_path):
    lines = spark.range(5000).repartitionByRange(7, "id").sortWithinPartitions("id").select(F.col("id").cast("string").alias("value"))
    for name, read in (("x.txt", lambda p: p.read_text()), ("x.txt.gz", lambda p: gzip.open(p, "rt").read())):
        for _ in range(2):  # replaced
            files.write_one_file(lines, str(tmp_path / name), "{rows} rows\n")
        assert read(tmp_path / name) == "5000 rows\n" + "".join(f"{i}\n" for i in range(5000))
    files.write_one_file(lines.limit(0), f"file://{tmp_path}/none.gz", "{rows}\n")
    assert gzip.open(tmp_path / "none.gz", "rt").read() == "0\n"
    with pytest.raises(Exception, match="."):
        files.write_one_file(lines.select(F.raise_error(F.lit("no")).cast("string").alias("value")), str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists() and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["none.gz", "x.txt", "x.txt.gz"]


LINES = st.lists(st.sampled_from([">c1 about", ">c2", ">", ">long" + "x" * 40, "ACGT", "NN", "ACGTACGTAC" * 4, "", "A C", "GG\r"]), max_size=25)


@settings(max_examples=80, deadline=None)
@given(LINES, st.booleans(), st.booleans(), st.integers(3, 30), st.integers(1, 4), st.integers(1, 9))
def test_fasta_ranges(tmp_path_factory, lines, end, compressed, member, step, size):
    import pandas as pd

    data = ("\n".join(lines) + ("\n" if end else "")).encode()
    path = put(tmp_path_factory.mktemp("f") / "g", blocks(data, member) if compressed else data)
    want, contig = {}, None
    for n, line in enumerate(lines):
        if line.startswith(">"):
            contig = (n, (line[1:].split() or [""])[0])
        elif contig:
            want[contig] = want.get(contig, "") + "".join(line.split())
    kept, storage.PIECE = storage.PIECE, member
    try:
        how = storage.kind(path)
        ranges = [(path, how, a, b) for a, b in storage.cut(path, how, step * member)]
        frame = lambda rows, more=(): pd.DataFrame(rows, columns=["path", "how", "start", "stop", *more])
        found = {r.start: r._asdict() for f in fasta._summed([frame(ranges)]) for r in f.itertuples(index=False)}
        begun = fasta.begins(ranges, found)
        out = [tuple(r) for f in fasta._chunks([frame(begun, ["contig", "at", "in_header"])], size) for r in f.itertuples(index=False)]
    finally:
        storage.PIECE = kept
    got, now = [], None
    for name, chunk, at, seq in out:
        assert 0 < len(seq) <= size and chunk == at // size == (at + len(seq) - 1) // size
        if at == 0:
            got.append((name, seq))
        else:
            assert got[-1][0] == name and len(got[-1][1]) == at
            got[-1] = (name, got[-1][1] + seq)
    assert got == [(k[1], v) for k, v in want.items() if v]


def test_genome(spark, tmp_path):
    rng = random.Random(5)
    chrom = "".join(rng.choice("ACGT") for _ in range(400_000))
    wrapped = "\n".join(chrom[i : i + 60] for i in range(0, len(chrom), 60))
    path = put(tmp_path / "g.fa", f">one\n{chrom}\n>two x\n{wrapped}\n>three\nACGT".encode())
    chunks = fasta.read_genome(spark, path, split_bytes=65_536)
    assert chunks.agg(F.max(F.length("chunk_seq"))).first()[0] <= 65_536 and chunks.rdd.getNumPartitions() >= 8
    ranges = spark.createDataFrame([("a", "one", 65_000, 140_000, "+", 1), ("b", "two", 399_999, 400_000, "+", 1), ("b", "two", 1, 5, "+", 0), ("c", "three", 2, 9, "+", 1)], "id string, contig string, f_start int, f_end int, strand string, part int")
    got = dict(rows(intervals.extract_seqs(ranges, chunks)))
    assert got == {"a": chrom[64_999:140_000], "b": chrom[:5] + chrom[-2:], "c": "CGT"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["", "a", "bb\tc", "x" * 30, "\r"]), max_size=20), st.integers(1, 40), st.integers(30, 120), st.booleans())
def test_ranges_own_each_line_once(tmp_path_factory, texts, member, step, ended):
    data = "\n".join(texts).encode() + (b"\n" if ended and texts else b"")
    path = put(tmp_path_factory.mktemp("x") / "a.gz", blocks(data, member))
    found = [x for a, b in storage.cut(path, storage.BLOCKS, step) for part in lines_of._lines(path, a, b) for x in part]
    want = data.split(b"\n")
    assert found == (want if want[-1] else want[:-1])


def test_block_compressed_annotation_by_many_tasks(spark, tmp_path):
    """A folder with a block-compressed and a plainly compressed file; the first is read in ranges."""
    line = lambda i: f"c\tx\texon\t{i}\t{i + 9}\t.\t+\t\tgene_id \"g{i}\"; transcript_id \"t\";\n".encode()
    folder = tmp_path / "a.gtf.gz"
    folder.mkdir()
    put(folder / "one.gtf.gz", blocks(b"#head\n\n" + b"".join(map(line, range(2000))), 3_000))
    put(folder / "two.gtf.gz", gzip.compress(b"#head\n" + line(2000)))
    lines = lines_of.read_lines(spark, str(folder), 5_000)
    assert lines.rdd.getNumPartitions() > 2 and lines.count() == 2004
    got = t_in.read_annotation(spark, str(folder)).select("f_start", "frame", "gene", "transcript")
    assert rows(got) == sorted([(i, None, f"g{i}", "t") for i in range(2001)], key=str)
