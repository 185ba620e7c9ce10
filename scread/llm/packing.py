"""Packing token pieces into fixed windows by Karmarkar-Karp multiway differencing.

Documents are tokenized once; each is cut into full windows and small pieces of its tail. The small
pieces are dealt by hash into groups of bounded size, and each group is divided into near-equal
windows: the two partial partitions with the largest imbalance are merged with opposing order until
one is left. If a window exceeds the capacity, the group gets more windows.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, string_parts

CAPACITY = 2048
CUT = 512
GROUP_PIECES = 1500
END_ID = 1
SLICE_BYTES = 4_000_000
CACHE_BYTES, ENTRY_BYTES, MET_BITS = 24_000_000, 170, 21
MARKS = b".,;:!?#*$%&)\""
LATIN_END = "\u0130"  # before it every letter has one lower-case letter and composes with nothing
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _byte_letters() -> dict[int, int]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it prints, else one from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printing]
    return {b: 256 + i for i, b in enumerate(others)}


class WordTokenizer(dict):
    """Ids of words under a tokenizer that never joins symbols across ASCII white space, with a bounded memory.

    A slice of text looks its words up here. After the slice a new word stays if an earlier slice held it too
    and the cache's bytes are not used up; words that occur once pass by. Marks after a word's last letter or
    digit have ids of their own, so ``word`` and ``word,`` are tokenized alike. Words of Latin letters go
    straight to the vocabulary's merges, in lower case, and others through the whole tokenizer.
    """

    _made: dict = {}

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.room, self.fresh = Tokenizer.from_file(path), cache_bytes, []
        self.merges, self.written, self.met = self.tokenizer.model.tokenize, _byte_letters(), bytearray(1 << MET_BITS)

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """The tokenizer of this worker process."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __missing__(self, word: bytes) -> bytes:
        self.fresh.append(word)
        if word.isalpha():
            ids = array("I", [t.id for t in self.merges(word.lower().decode())]).tobytes()
        else:
            core = word.rstrip(MARKS)
            if core[-1:].isalnum() and len(core) < len(word):
                ids = self[core] + self[word[len(core) :]]
            else:
                text = word.decode()
                if text.isalpha() and max(text) < LATIN_END:
                    found = [t.id for t in self.merges(text.lower().encode().decode("latin-1").translate(self.written))]
                else:
                    found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
                ids = array("I", found).tobytes()
        self[word] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as unsigned 32-bit numbers in this machine's order."""
        out = [b"".join(map(self.__getitem__, t.split())) for t in texts]
        met, last = self.met, len(self.met) - 1
        for word in self.fresh:
            at = hash(word) & last
            if met[at] and self.room > 0:
                self.room -= ENTRY_BYTES + len(word) + len(self[word])
            else:
                del self[word]
            met[at] = 1
        self.fresh.clear()
        return out


def cuts(n: int, capacity: int = CAPACITY, cut: int = CUT) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then the tail in near-equal pieces of at most ``cut``."""
    full, tail = divmod(n, capacity)
    out = [(i * capacity, capacity) for i in range(full)]
    if tail:
        k = -(-tail // cut)
        at = [full * capacity + tail * i // k for i in range(k + 1)]
        out += [(a, b - a) for a, b in zip(at, at[1:])]
    return out


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, cut: int) -> Iterator[pa.RecordBatch]:
    tokenizer, end = WordTokenizer.of(path), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        _, offsets = string_parts(batch.column(1))
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
            part = batch.slice(at, upto - at)
            at = upto
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            rows: list[tuple] = []
            for i, ids in enumerate(tokenizer.encode(texts)):
                ids += end
                n = len(ids) // 4
                rows += [(i, a, k, zlib.crc32(ids[4 * a : 4 * (a + k)]), n) for a, k in cuts(n, capacity, cut)]
            cols = [np.array(c, np.int64) for c in zip(*rows)]
            ids = part.column(0).take(pa.array(cols[0]))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, cols[1:])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, cut: int = CUT) -> DataFrame:
    """Pieces of all documents; null text is empty and still has the end id."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_pieces, path=path, capacity=capacity, cut=cut), _PIECES)


def differencing(lengths: list[int], k: int) -> np.ndarray:
    """Window (0 to k - 1) of each piece, near-equal in sum, by multiway differencing.

    A partial partition keeps its filled slots in descending order; all others are empty. Merging in
    opposing order puts the largest slots of one into the emptiest of the other.
    """
    parent = list(range(len(lengths)))
    heap = [(-length, i, np.array([length]), np.array([i])) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    tick = len(heap)
    while len(heap) > 1:
        _, _, sums, slots = heapq.heappop(heap)
        _, _, more, others = heapq.heappop(heap)
        spare = k - len(sums)
        if len(more) > spare:
            first = k - len(more)
            sums[first:] += more[spare:][::-1]
            for a, b in zip(slots[first:].tolist(), others[spare:][::-1].tolist()):
                parent[b] = a
            more, others = more[:spare], others[:spare]
        sums, slots = np.concatenate([sums, more]), np.concatenate([slots, others])
        order = np.argsort(-sums, kind="stable")
        sums, slots = sums[order], slots[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, tick, sums, slots))
        tick += 1
    window = np.full(len(lengths), -1, np.int64)
    window[heap[0][3]] = np.arange(len(heap[0][3]))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    return window[[root(i) for i in range(len(lengths))]]


def windows(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each piece; no window exceeds the capacity. Pieces of a whole window keep it for themselves."""
    out = np.empty(len(lengths), np.int64)
    full = np.flatnonzero(lengths >= capacity)
    small = np.flatnonzero(lengths < capacity)
    k = 0
    if len(small):
        mine = lengths[small]
        k = max(1, -(-int(mine.sum()) // capacity))
        while True:
            found = differencing(mine.tolist(), k)
            most = int(np.bincount(found, mine).max())
            if most <= capacity:
                break
            k = max(k + 1, int(k * (1 + (most / capacity - 1) / 2)))
        out[small] = found
        k = int(found.max()) + 1
    out[full] = np.arange(k, k + len(full))
    return out


def _pack_group(rows: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "start", "length", "ids_crc32", "row"], kind="stable", ignore_index=True)
    window = windows(rows["length"].to_numpy(), capacity)
    rows["sequence_id"] = rows["group"] * (1 << 32) + window
    rows["offset"] = rows.groupby(window, sort=False)["length"].cumsum() - rows["length"]
    return rows.drop(columns=["group", "row"])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, cut: int = CUT, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece with its sequence and place there; every id of every document lies in one piece.

    Needs doc_id and text. Null and empty texts are one piece with the end id; repeated rows are packed
    as often as they occur; a null doc_id stays null. An empty table gives no rows. Extra columns are not
    read. Groups are dealt by a hash of the piece and its place in the table, about ``group_pieces`` each, at
    every size and however often rows repeat.
    """
    pieces = stage(tokenize(docs, path, capacity, cut).withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    key = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "length", "doc_tokens", "row"), F.lit(groups))

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        return _pack_group(rows, capacity)

    return pieces.withColumn("group", key).groupBy("group").applyInPandas(pack_group, _PIECES + ", sequence_id long, offset long")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
