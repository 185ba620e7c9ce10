"""Byte-level BPE against the library whose ranks these are, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scread.llm import byte_bpe

from helpers import docs, empty

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe.of(PATH, PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def ids(bpe, text):
    return np.frombuffer(bpe.encode(text.encode()), "<u4")


def test_byte_table_is_a_bijection():
    table = byte_bpe.byte_letters()
    assert len(set(table.values())) == 256 and table[ord("a")] == "a" and table[32] == "Ġ" and table[10] == "Ċ" and table[0xAD] == "Ń"


PARTS = [" ", " ", "　", "\x85", "\n", "\t", " ", "  ", "\x1c", "a", "é", "'s", "'t", "1", "22", ".", "!?", "word", "Wörter", "日本", "́", "😀", "-", "<|endoftext|>", "0000", "ere", "haha"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from(PARTS)).map("".join)))
def test_any_text_as_the_library(bpe, reference, text):
    got = ids(bpe, text)
    assert got.tolist() == reference.encode_ordinary(text)
    assert bpe.decode(got) == text.encode()
    assert "".join(bpe.token_texts(got)) == text


def test_tokens_that_overlap_themselves(bpe, reference):
    ranks, rng = byte_bpe.read_ranks(PATH), random.Random(1)
    tokens = [t for t in ranks if any(t[p:] == t[: len(t) - p] for p in byte_bpe.splits(t, ranks))]
    assert len(tokens) > 100
    for t in tokens:
        try:
            s = t.decode()
        except UnicodeDecodeError:
            continue
        for text in [s * 3, s * 4 + s[:1], s[1:] + s * 3, *("".join(rng.choice([s, s[:1], s[1:], s[:-1], s[-1:]]) for _ in range(rng.randint(2, 9))) for _ in range(12))]:
            assert ids(bpe, text).tolist() == reference.encode_ordinary(text)


def test_units_are_forgotten_and_found_again(bpe, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_UNITS", 3)
    for text in ["one two three four five.", "one, two;\nthree four"] * 3:
        assert ids(bpe, text).tolist() == reference.encode_ordinary(text)


def test_split_characters(bpe):
    text = "x😀日y"
    got = ids(bpe, text)
    starts, ends = bpe.characters(got, text.encode())
    assert len(got) > 4 and starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all() and (starts[1:] >= ends[:-1] - 1).all()
    assert bpe.token_texts(got[:2])[0] == "x" and "".join(bpe.token_texts(got[:2])).endswith("�")
    assert bpe.token_texts(got[:0]) == [] and bpe.decode(np.array([2**32 - 1], "<u4")) == b""


def test_table(spark, reference):
    df = docs(spark, [(11, "'s 's'S  \n\n x  y", "fr", "s3")])
    out = byte_bpe.decode(byte_bpe.encode(df, PATH, PATTERN), PATH, PATTERN).select("*", byte_bpe.unpacked("ids").alias("list"), byte_bpe.as_text(F.col("decoded")).alias("text")).collect()
    texts = [r["text"] or "" for r in df.collect()]
    assert sorted(r["text"] for r in out) == sorted(texts)
    assert all(list(r["list"]) == reference.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["list"]) and bytes(r["decoded"]) == r["text"].encode() for r in out)
    placed = byte_bpe.encode(df.filter("doc_id = 7"), PATH, PATTERN, offsets=True).select(byte_bpe.unpacked("starts").alias("s"), byte_bpe.unpacked("ends").alias("e")).first()
    seven = next(t for t in texts if t.startswith("Ä"))
    assert placed["s"][0] == 0 and placed["e"][-1] == len(seven) and all(a < b for a, b in zip(placed["s"], placed["e"]))
    assert byte_bpe.encode(empty(spark), PATH, PATTERN).count() == 0


def test_query(spark, sf, reference):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = byte_bpe.op11_byte_bpe(spark, sf).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        want = np.array(reference.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(want), hashlib.sha256(want.tobytes()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())
