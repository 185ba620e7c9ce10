"""Byte-level BPE encoding and decoding by a file of ranks, with the tokenizers library over Arrow batches.

The library's model works on characters, so every byte has one (the byte table), and a rank file has no
merges: each split of a token into two tokens is one, in the order of the token's rank. Of the splits of one
token that can overlap in a text the one that would lie further left goes first, as the lowest rank and then
the leftmost pair is what rank files mean.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from .common import blocks

KEPT_UNITS, LONGEST_KEPT = 200_000, 64
_MARKS, _LATIN_END = b".,;:!?", "\u0250"
_CUT, _SAFE_CUT = re.compile(rb"(?<=\S) "), re.compile(rb"(?<=[!-~]) ")
_LINE, _SAFE_LINE = re.compile(rb"(?<=\S)\n(?=\S)"), re.compile(rb"(?<=[!-~])\n(?=[!-~])")
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def byte_letters() -> dict[int, str]:
    """The byte table: printable Latin-1 bytes are their own character, the other 68 follow from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(spare)) for b in range(256)}


def splits(token: bytes, known) -> list[int]:
    """Places where ``token`` falls into two known tokens, in the order in which their merges are tried.

    The pair cut at p overlaps the pair cut at n - p to its right if token[p:] == token[: n - p].
    """
    n = len(token)
    out: list[int] = []
    for p in range(n // 2, 0, -1):
        right_first = token[n - p :] == token[:p]
        pair = [n - p, p] if right_first or token[p:] != token[: n - p] else [p, n - p]
        out += [q for q in dict.fromkeys(pair) if token[:q] in known and token[q:] in known]
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token and rank of every line of a rank file (base64, a space, the rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe(dict):
    """Encoder and decoder of one rank file and pattern, made once a worker process; holds the ids of units of text met lately."""

    _made: dict[tuple[str, str], ByteBpe] = {}

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores already
        ranks = read_ranks(path)
        letters = byte_letters()
        spell = lambda token: "".join(map(letters.__getitem__, token))
        by_rank = sorted(ranks, key=ranks.__getitem__)
        merges = [(spell(t[:p]), spell(t[p:])) for t in by_rank for p in splits(t, ranks)]
        vocab = {spell(t): r for t, r in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
        cut, mapped = pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([cut, mapped])
        self.merge, self.letters = self.tokenizer.model.tokenize, letters
        # decoding reverses the byte table: the bytes of all tokens in a row, and where each token's begin
        back = {letter: b for b, letter in letters.items()}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for spelled, rank in vocab.items():
            tokens[rank] = bytes(back[letter] for letter in spelled)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    @classmethod
    def of(cls, path: str, pattern: str) -> ByteBpe:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def __missing__(self, unit: bytes) -> bytes:
        """Packed ids of a text without cuts inside. Latin letters alone, with a space before or marks behind, are known to be one match each."""
        core = unit.rstrip(_MARKS)
        word = core[1:] if core[:1] == b" " else core
        latin = word.isalpha() or (text := word.decode()).isalpha() and max(text) < _LATIN_END
        if latin and len(core) < len(unit):
            ids = self[core] + self[unit[len(core) :]]
        else:
            found = [t.id for t in self.merge(core.decode("latin-1").translate(self.letters))] if latin else self._whole(unit)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(unit) <= LONGEST_KEPT:
            self[unit] = ids
        return ids

    def _whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids

    def encode(self, text: bytes) -> bytes:
        """Packed ids of a UTF-8 text.

        No match of the pattern lies across a space that follows no white space, nor across either end of a line
        break between two characters that are none; the text is cut there, and units met before are looked up.
        """
        if len(self) > KEPT_UNITS:
            self.clear()
        wide = _WIDE_SPACE.search(text) is not None
        lines = []
        for line in (_SAFE_LINE if wide else _LINE).split(text):
            first, *rest = (_SAFE_CUT if wide else _CUT).split(line)
            lines.append(self[first] + b"".join([self[b" " + unit] for unit in rest]))
        return self[b"\n"].join(lines)

    def characters(self, ids: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(first, after the last) character that each token touches; the tokens of a split character share it."""
        ends = np.cumsum(self.lengths[ids])
        leads = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        return (leads[ends - self.lengths[ids]] - 1).astype("<u4"), leads[ends - 1].astype("<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens in a row; an id that the file has not gives none."""
        ids = ids[ids < len(self.lengths)].astype(np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.begins[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at].tobytes()

    def token_texts(self, ids: np.ndarray) -> list[str]:
        """What each token adds to the text: a character split between tokens comes with the last of them, joined it is the text."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        out = [decoder.decode(self.decode(ids[i : i + 1])) for i in range(len(ids))]
        if out:
            out[-1] += decoder.decode(b"", final=True)
        return out


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str, offsets: bool) -> Iterator[pa.RecordBatch]:
    bpe = ByteBpe.of(path, pattern)
    for batch in batches:
        for first, last, _, _ in blocks(batch.column(1)):
            part = batch.slice(first, last - first)
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            ids = [bpe.encode(t) for t in texts]
            columns = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if offsets:
                places = [bpe.characters(np.frombuffer(x, "<u4"), t) for x, t in zip(ids, texts)]
                columns += [pa.array([p[k].tobytes() for p in places], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "starts", "ends"][: len(columns)])


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """doc_id, n_tokens and ``ids`` of every whole text; ``offsets`` adds ``starts`` and ``ends``.

    ``ids``, ``starts`` and ``ends`` are binary, unsigned little-endian 32-bit numbers, one a token (``unpacked``
    makes arrays of them). A token touches the characters (code points) from its start to before its end. Null and empty
    texts have no tokens; special tokens are plain text; repeated rows are encoded each; a null doc_id stays
    null; an empty table gives no rows. Only doc_id and text are read. No shuffle: a row depends on itself alone.
    A worker holds blocks of half a megabyte, or one text, and 200,000 units of at most 64 bytes.
    """
    schema = "doc_id long, n_tokens long, ids binary" + (", starts binary, ends binary" if offsets else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_encoded, path=path, pattern=pattern, offsets=offsets), schema)


def _decoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    bpe = ByteBpe.of(path, pattern)
    for batch in batches:
        for first, last, _, _ in blocks(batch.column(2)):
            part = batch.slice(first, last - first)
            found = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decoded`` (binary) beside doc_id, n_tokens and ids: the bytes of all tokens, characters split between tokens made whole.

    Bytes that are no UTF-8, as of a part of a token list, stay as they are; ``as_text`` puts U+FFFD there. Null ids decode to nothing.
    """
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(partial(_decoded, path=path, pattern=pattern), "doc_id long, n_tokens long, ids binary, decoded binary")


@F.pandas_udf(ArrayType(LongType()))
def unpacked(packed):
    """The numbers of a packed column."""
    return packed.map(lambda x: None if x is None else np.frombuffer(x, "<u4").astype(np.int64))


def as_text(decoded: Column) -> Column:
    """Decoded bytes as text, U+FFFD for what is no character."""
    return F.make_valid_utf8(decoded.cast("string"))


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents encoded by the ranks for many languages and decoded again, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    out = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, pattern), path, pattern)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
