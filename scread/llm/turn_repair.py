"""Conversation structure repair: cheapest edits that make turns alternate, by rank-convergence parallel Viterbi.

A conversation's roles must read ``(s?(ua)+)?`` by their initials. States are what has been emitted: nothing
(0), a system turn (1), a user turn (2), a whole exchange (3). Costs to go are vectors over the states, found
from the last turn back. A conversation is cut into chunks; each starts from a speculative vector, and fix-up passes
rerun a chunk from its right neighbour's vector until the two differ by a constant, from where on all
differences are the same. Pass p takes runs of 4^p chunks, so even chunks that never converge end after a
logarithm of their number. The stitched costs then drive the trace: forward, with the ASCII-least edit among
the cheapest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CHUNK_ROWS, CHUNK_BYTES = 4_096, 1_000_000
SPACES = " \t\n\x0b\x0c\r"
INITIALS = "sua"
TRUNCATED, MUST_GO, DROPPED = 4, 8, -1
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1

#: State after a turn with initial s, u, a or another; None where the grammar has no such turn.
AFTER = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: State after the only turn, user or assistant, that may be inserted or given a new role.
NEXT = (2, 2, 3, 2)
FREE = (0, 0, 0, 0)
NEVER = 1 << 30

Vector = tuple[int, int, int, int]


def _settled(base: list[int]) -> Vector:
    """Costs with inserts before what comes: two in a row lead from any state back to a whole exchange."""
    exchange, user = min(base[3], base[2] + INSERT_COST), min(base[2], base[3] + INSERT_COST)
    return min(base[0], user + INSERT_COST), min(base[1], user + INSERT_COST), user, exchange


END: Vector = _settled([0, NEVER, NEVER, 0])


@lru_cache(maxsize=None)
def step(ahead: Vector, code: int) -> tuple[Vector, int]:
    """(costs before a row, less their least; that least) from the costs after it. There are few vectors, as inserts bound their differences."""
    base = [min(cost for _, cost, _ in _moves(ahead, code, p)) for p in range(4)]
    costs = _settled(base)
    least = min(costs)
    return tuple(c - least for c in costs), least


def _moves(ahead: Vector, code: int, p: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost to go, state after) of a row from state p; code holds the initial, whether it is cut off, or that it must go."""
    yield "D", DELETE_COST + ahead[p], p
    if code != MUST_GO:
        cut, kept = TRUNCATED_COST * (code >= TRUNCATED), AFTER[p][code % TRUNCATED]
        if kept is not None:
            yield "K", KEEP_COST + cut + ahead[kept], kept
        yield "R", REROLE_COST + cut + ahead[NEXT[p]], NEXT[p]


@lru_cache(maxsize=None)
def edits(ahead: Vector, code: int, p: int) -> tuple[str, int]:
    """The least of the cheapest edits of a row from state p, inserts before it included, and the state after."""
    here, least = step(ahead, code)
    found = ""
    while True:
        moves = {edit: q for edit, cost, q in _moves(ahead, code, p) if cost == here[p] + least}
        if here[NEXT[p]] + INSERT_COST == here[p]:
            moves["I"] = None
        edit = min(moves)
        found += edit
        if edit != "I":
            return found, moves[edit]
        p = NEXT[p]


def closing(p: int) -> str:
    """Inserts after the last row."""
    return {0: "", 1: "II", 2: "I", 3: ""}[p]


def costs(codes: bytes, end: Vector) -> tuple[list[Vector], int]:
    """Costs after each row (the last is ``end``), with those before the first in front, each less its least; the sum of what was taken off."""
    out, total = [end], 0
    for code in reversed(codes):
        before, least = step(out[-1], code)
        out.append(before)
        total += least
    return out[::-1], total


def fix_up(codes: bytes, was: Vector, end: Vector, left: Vector, shift: int) -> tuple[Vector, int]:
    """``left`` and ``shift`` of a chunk whose end was ``was`` and is ``end``: rerun until both differ by a constant, that is not at all once the least is off."""
    for code in reversed(codes):
        if was == end:
            return left, shift
        (was, before), (end, now) = step(was, code), step(end, code)
        shift += now - before
    return end, shift


def trace(codes: bytes, vectors: list[Vector], p: int) -> tuple[list[str], int]:
    """Edits of each row from state p, and the state after the last."""
    out = []
    for code, ahead in zip(codes, vectors[1:]):
        found, p = edits(ahead, code, p)
        out.append(found)
    return out, p


def apply_edits(found: list[str], roles: list[str], texts: list[str], p: int, closed: str = "") -> list[dict]:
    """Repaired turns of rows from state p."""
    out = []
    for ops, role, text in zip([*found, closed], [*roles, ""], [*texts, ""]):
        for op in ops:
            if op == "K":
                p = AFTER[p][(INITIALS + "?").index(role[:1] if role[:1] and role[:1] in INITIALS else "?")]
                out.append({"role": role, "text": text})
            elif op != "D":
                p = NEXT[p]
                out.append({"role": "user" if p == 2 else "assistant", "text": "" if op == "I" else text})
    return out


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PIECE = "turns array<struct<role:string,text:string>>"
_OPEN = "place long, chunk long, turn long, role string, text string, digest string, code int"
_TYPES = {"role": pa.string(), "text": pa.string(), "digest": pa.string(), "audit": pa.string(), "code": pa.int32(), "turns": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
_NAMES = [x.split()[0] for x in f"conv_id long, {_REPORT}".split(", ")] + ["turns"] + [x.split()[0] for x in _OPEN.split(", ")]


def _whole(conv_id, rows: list[tuple]) -> dict:
    """Report and repaired turns of a conversation of one chunk; rows are (turn, role, text, digest, code)."""
    rows = [r for r in rows if r[4] != DROPPED]
    met, codes, n = set(), bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, _, digest, code in rows:
        repeated = (role, digest) in met
        met.add((role, digest))
        fault = "blank" if code == MUST_GO else "duplicate" if repeated else "truncated" if code >= TRUNCATED else None
        if fault:
            n[fault] += 1
        codes.append(MUST_GO if repeated else code)
    vectors, total = costs(bytes(codes), END)
    found, p = trace(bytes(codes), vectors, 0)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    roles = [r[1] for r in rows]
    repaired = apply_edits(found, roles, [r[2] for r in rows], 0, closing(p))
    return n | {"conv_id": conv_id, "gaps": gaps, "illegal": illegal([r[:1] for r in roles]), "cost": total + vectors[0][0], "audit": "".join(found) + closing(p), "turns": repaired}


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], _TYPES.get(c, pa.int64())) for c in _NAMES], names=_NAMES)


def _by_partition(batches: Iterator[pa.RecordBatch], chunk_rows: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Conversations that lie inside the partition and one chunk are repaired; rows of others leave as they are, numbered."""
    place = TaskContext.get().partitionId() << 40
    held: list[tuple] = []
    conv_id, size, first, chunk = None, 0, True, None  # chunk: place where the open conversation's chunk begins

    def opened() -> list[dict]:
        nonlocal place, chunk, held, size
        chunk, out = place, []
        for row in held:
            out.append({"conv_id": conv_id, "place": place, "chunk": chunk} | dict(zip(("turn", "role", "text", "digest", "code"), row)))
            place += 1
        held, size = [], 0
        return out

    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held:
                if row[0] != conv_id:
                    if first or chunk is not None:
                        out += opened()
                    else:
                        out.append(_whole(conv_id, held))
                        held = []
                    first, chunk, size = False, None, 0
                elif len(held) >= chunk_rows or size >= chunk_bytes:
                    out += opened()
            conv_id = row[0]
            held.append(row[1:])
            size += len(row[3])
        if out:
            yield _record_batch(out)
    if held:
        yield _record_batch(opened())


def _chunk_summary(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    initials = rows["initial"].tolist()
    turns = [int(t) for t in rows["turn"] if t is not None]
    counts = rows["fault"].value_counts()
    out = {k: int(counts.get(k, 0)) for k in ("blank", "duplicate", "truncated")}
    out |= {"illegal": illegal(initials), "first": initials[0], "last": initials[-1], "low": min(turns, default=None), "high": max(turns, default=None), "distinct": len(set(turns))}
    out |= {c: None if out[c] is None else str(out[c]) for c in ("low", "high")}  # a null among numbers would make them doubles
    return pd.DataFrame([{"key": rows["key"].iloc[0], "chunk": rows["chunk"].iloc[0], "codes": bytes(rows["code"].tolist())} | out])


_SUMMARY = "key string, chunk long, codes binary, blank long, duplicate long, truncated long, illegal long, first string, last string, low string, high string, distinct long"
_PASS = "key string, no long, is_last boolean, codes binary, end array<int>, left array<int>, shift long"


def _pass(rows: pd.DataFrame) -> pd.DataFrame:
    """One run of neighbouring chunks, from the right: speculative where nothing is known, else fixed up."""
    rows = rows.sort_values("no", ascending=False)
    out, known = [], None
    for r in rows.itertuples(index=False):
        was = None if r.end is None else tuple(map(int, r.end))
        end = END if r.is_last else known or (FREE if r.next_left is None else tuple(map(int, r.next_left)))
        if was is None:
            vectors, shift = costs(r.codes, end)
            left = vectors[0]
        else:
            left, shift = fix_up(r.codes, was, end, tuple(map(int, r.left)), int(r.shift))
        known = left
        out.append((r.key, r.no, r.is_last, r.codes, list(end), list(left), shift))
    return pd.DataFrame(out, columns=["key", "no", "is_last", "codes", "end", "left", "shift"])


def stitched(chunks: DataFrame) -> DataFrame:
    """key, no, is_last, codes, end, left and shift of chunks (key, no, is_last, codes), whose vectors all fit their right neighbours'."""
    unknown = F.lit(None).cast("array<int>")
    table = chunks.select("key", "no", "is_last", "codes", unknown.alias("end"), unknown.alias("left"), F.lit(None).cast("long").alias("shift"), unknown.alias("next_left"))
    p = 0
    while True:
        run = F.shiftright("no", 2 * p)
        table = stage(table.groupBy("key", run.alias("run")).applyInPandas(_pass, _PASS), "repair-pass")
        right = table.select("key", (F.col("no") - 1).alias("no"), F.col("left").alias("next_left"))
        table = table.join(right, ["key", "no"], "left")
        if not table.filter(~F.col("is_last") & (F.col("end") != F.col("next_left"))).count():
            return table.drop("next_left")
        p += 1


def _exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for codes, end in zip(rows["codes"], rows["end"]):
            vectors, _ = costs(codes, tuple(map(int, end)))
            out.append([trace(codes, vectors, p)[1] for p in range(4)])
        yield rows.drop(columns=["codes", "end"]).assign(exits=out)


def _conversation(rows: pd.DataFrame) -> pd.DataFrame:
    """The report of a conversation without its audit, and each chunk's state at its begin, from a row a chunk."""
    rows = rows.sort_values("no")
    entries, p = [], 0
    for exits in rows["exits"]:
        entries.append(p)
        p = int(exits[p])
    firsts, lasts = rows["first"].tolist(), rows["last"].tolist()
    out = rows[["key", "chunk"]].assign(entry=entries, end=rows["end"])
    out["illegal"] = int(rows["illegal"].sum()) + sum(illegal([a, b]) for a, b in zip(lasts, firsts[1:]))
    low, high = ([None if x is None else int(x) for x in rows[c]] for c in ("low", "high"))
    some = [i for i, x in enumerate(low) if x is not None]
    distinct = int(rows["distinct"].sum()) - sum(high[i] == low[j] for i, j in zip(some, some[1:]))
    out["gaps"] = high[some[-1]] - low[some[0]] + 1 - distinct if some else 0
    for c in ("blank", "duplicate", "truncated"):
        out[c] = int(rows[c].sum())
    out["cost"] = int(rows["shift"].sum()) + int(rows["left"].iloc[0][0])
    return out


_ENTRY = "key string, chunk long, entry int, end array<int>, illegal long, gaps long, blank long, duplicate long, truncated long, cost long, codes binary, is_last boolean"


def _repaired_chunk(key, known: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    if not len(known):
        return pd.DataFrame({"key": [], "chunk": [], "audit": [], "turns": []})
    rows, k = rows.sort_values("place"), known.iloc[0]
    vectors, _ = costs(k["codes"], tuple(map(int, k["end"])))
    found, p = trace(k["codes"], vectors, int(k["entry"]))
    closed = closing(p) if k["is_last"] else ""
    turns = apply_edits(found, rows["role"].tolist(), rows["text"].tolist(), int(k["entry"]), closed)
    return pd.DataFrame([{"key": k["key"], "chunk": k["chunk"], "audit": "".join(found) + closed, "turns": turns}])


def _repair_open(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, pieces) of conversations in several chunks or at a partition's edge."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    rows = rows.withColumn("key", key).drop("conv_id")
    there = rows.filter(F.col("code") != DROPPED)
    first = there.groupBy("key", "role", "digest").agg(F.min("place").alias("met"))
    flagged = there.select("key", "place", "chunk", "turn", "role", "digest", "code").join(first, ["key", "role", "digest"])
    repeated = F.col("place") > F.col("met")
    fault = F.when(F.col("code") == MUST_GO, "blank").when(repeated, "duplicate").when(F.col("code") >= TRUNCATED, "truncated")
    flagged = flagged.select("key", "place", "chunk", F.col("turn").cast("string").alias("turn"), F.substring("role", 1, 1).alias("initial"), F.when(repeated, MUST_GO).otherwise(F.col("code")).alias("code"), fault.alias("fault"))
    order = Window.partitionBy("key").orderBy("chunk")
    summary = stage(flagged.groupBy("key", "chunk").applyInPandas(_chunk_summary, _SUMMARY), "repair-chunks")
    numbered = summary.select("key", "chunk").withColumn("no", F.row_number().over(order).cast("long") - 1).withColumn("is_last", F.lead("chunk").over(order).isNull())
    chunks = summary.join(numbered, ["key", "chunk"])
    fitted = stage(stitched(chunks.select("key", "no", "is_last", "codes")), "repair-fitted")
    exits = fitted.select("key", "no", "codes", "end", F.col("end").alias("fit"), "left", "shift").mapInPandas(_exits, "key string, no long, fit array<int>, left array<int>, shift long, exits array<int>").withColumnRenamed("fit", "end")
    states = exits.join(chunks.drop("codes", "is_last"), ["key", "no"]).groupBy("key").applyInPandas(_conversation, ", ".join(_ENTRY.split(", ")[:-2]))
    states = stage(states.join(chunks.select("key", "chunk", "codes", "is_last"), ["key", "chunk"]), "repair-states")
    on = ["key", "chunk"]
    pieces = states.groupBy(*on).cogroup(there.select("key", "chunk", "place", "role", "text").groupBy(*on)).applyInPandas(_repaired_chunk, f"key string, chunk long, audit string, {_PIECE}")
    pieces = stage(pieces, "repair-pieces")
    audits = pieces.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    report = states.groupBy("key").agg(*(F.first(c).alias(c) for c in numbers)).join(audits, "key")
    # a conversation whose rows are all gone has zeros
    all_keys = rows.select("key").distinct().join(report, "key", "left").select(F.expr("try_cast(key AS bigint)").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"))
    return all_keys, pieces.select(F.expr("try_cast(key AS bigint)").alias("conv_id"), F.col("chunk").alias("place"), "turns")


def repair(rows: DataFrame, dropped: Column | None = None, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(whole, reports, pieces) of the repaired conversations of ``rows`` (conv_id, turn, role, text; extra columns are not read).

    ``whole`` has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and ``turns``, the repaired
    (role, text) in order, of conversations that fit a chunk; of all others ``reports`` has the same without turns, and
    ``pieces`` their turns by conv_id and ``place``. Rows where ``dropped`` holds are gone, though their
    conversation still has a report. Order is by turn (nulls first), then role, then text (its first 200
    characters, then its digest). Null roles and texts are one space, and a null conv_id is a conversation of
    its own. A role without a first character, or with another than s, u or a, can't be kept. Repeated rows are
    duplicates. A conversation without rows has zeros and an empty audit; an empty table gives no rows.

    Rows are dealt by ranges of their order, so a large conversation lies in many partitions; only the audit of
    one, a character an edit, must fit a row.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    gone = F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))
    said = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.when(gone, "").otherwise(text).alias("text"), gone.alias("gone"))
    bare = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    code = F.when(F.col("gone"), DROPPED).when(bare == "", MUST_GO).otherwise(
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) + F.when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    )
    said = said.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"), code.cast("int").alias("code"), F.substring("text", 1, 200).alias("head"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "head", "digest", "row"]
    sorted_rows = said.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "digest", "code")
    mapped = sorted_rows.mapInArrow(partial(_by_partition, chunk_rows=chunk_rows, chunk_bytes=chunk_bytes), f"conv_id long, {_REPORT}, {_PIECE}, {_OPEN}")
    mapped = stage(mapped, "repair-rows")
    reports, pieces = _repair_open(mapped.filter(F.col("audit").isNull()).select("conv_id", *(x.split()[0] for x in _OPEN.split(", "))))
    return mapped.filter(F.col("audit").isNotNull()).select("conv_id", *(x.split()[0] for x in _REPORT.split(", ")), "turns"), reports, pieces


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest, out = None, None, []
    for batch in batches:
        for k, line in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_pydict(dict(zip(("key", "repaired_sha256"), map(list, zip(*out)))))
            out = []
    if digest:
        out.append((key, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(("key", "repaired_sha256"), map(list, zip(*out)))))


def _line(t: Column) -> Column:
    return F.concat(t["role"], F.lit(":"), t["text"])


def repaired_digests(whole: DataFrame, reports: DataFrame, pieces: DataFrame) -> DataFrame:
    """All reports with ``repaired_sha256``, the hex digest of ``role:text`` lines joined by line breaks."""
    lines = F.array_join(F.transform("turns", _line), "\n")
    short = whole.withColumn("repaired_sha256", F.sha2(lines, 256)).drop("turns")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    each = pieces.select(key.alias("key"), "place", F.posexplode("turns").alias("n", "t")).select("key", "place", "n", _line(F.col("t")).cast("binary").alias("line"))
    hashed = each.repartition("key").sortWithinPartitions("key", "place", "n").select("key", "line").mapInArrow(_stream_digests, "key string, repaired_sha256 string")
    long = reports.withColumn("key", key).join(hashed, "key", "left").drop("key").withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    return short.unionByName(long)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with the faults that a checksum of conversation and turn deals out, and the condition of those that are gone."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    out = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    out = out.withColumn("text", text).withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))).withColumn("copy", copies)
    return out, F.col("fault") == 0


def op13_turn_repair(spark, sf_dir: str) -> DataFrame:
    rows, gone = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repaired_digests(*repair(rows, gone))
