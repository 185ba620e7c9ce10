"""Conversation repair against brute force over whole audits, with chunks down to one row."""

import hashlib
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scread.llm import turn_repair as tr

GRAMMAR = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute(rows):
    """rows: (turn, role, text) in order. The definition with audits as strings; the last emitted initial is the state."""
    met, flags, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        inside = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not inside else "duplicate" if (role, text) in met else "truncated" if inside[-1] not in ".!?" else None
        met.add((role, text))
        flags.append(fault)
        if fault:
            count[fault] += 1

    @lru_cache(None)
    def best(i, last, inserted=0):
        """(cost, audit, repaired lines) of rows from i on."""
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for x in GRAMMAR[last].replace("s", ""):
                c, a, r = best(i, x, inserted + 1)
                found.append((c + 2, "I" + a, (("user:" if x == "u" else "assistant:"), *r)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, r = best(i + 1, last)
            found.append((c + 3, "D" + a, r))
            if flags[i] not in ("blank", "duplicate"):
                cut = int(flags[i] == "truncated")
                if role[:1] and role[:1] in GRAMMAR[last]:
                    c, a, r = best(i + 1, role[:1])
                    found.append((c + cut, "K" + a, (f"{role}:{text}", *r)))
                for x in GRAMMAR[last].replace("s", ""):
                    c, a, r = best(i + 1, x)
                    found.append((c + cut + 2, "R" + a, (("user:" if x == "u" else "assistant:") + text, *r)))
        return min(found, key=lambda f: f[:2], default=(10**9, "~", ()))

    cost, audit, lines = best(0, "")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    """conv_id -> rows after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        if n:
            mine += [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:200], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

codes = st.lists(st.sampled_from(range(9)), max_size=14)


@settings(max_examples=300, deadline=None)
@given(codes)
def test_kernel(found):
    rows = [(i, ["system", "user", "assistant", "tool"][c % 4] if c < 8 else "user", "" if c == 8 else f"t{i}" + "." * (c < 4)) for i, c in enumerate(found)]
    vectors, total = tr.costs(bytes(found), tr.END)
    ops, p = tr.trace(bytes(found), vectors, 0)
    want = brute(rows)
    assert total + vectors[0][0] == want[5] and "".join(ops) + tr.closing(p) == want[6]
    turns = tr.apply_edits(ops, [r[1] for r in rows], [r[2] for r in rows], 0, tr.closing(p))
    assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest() == want[7]


@settings(max_examples=200, deadline=None)
@given(codes, codes)
def test_fix_up_equals_a_fresh_run(left, right):
    end, _ = tr.costs(bytes(right), tr.END)
    guess, shift = tr.costs(bytes(left), tr.FREE)
    fresh, total = tr.costs(bytes(left), end[0])
    assert tr.fix_up(bytes(left), tr.FREE, end[0], guess[0], shift) == (fresh[0], total)


def test_few_vectors_and_convergence():
    tr.step.cache_clear()
    seen, new = {tr.FREE, tr.END}, {tr.FREE, tr.END}
    while new:
        new = {tr.step(v, c)[0] for v in new for c in range(9)} - seen
        seen |= new
    assert len(seen) < 60
    # an alternating chunk forgets its end at once, a chunk of one role only never
    assert len({tr.costs(bytes([1, 2] * 3), v)[0][0] for v in seen}) == 1 < len({tr.costs(bytes([1] * 50), v)[0][0] for v in seen})


def conversations():
    rows = []
    say = lambda c, i: f"c{c} says {i}" + ("." if i % 5 else "")
    for c in range(60):
        rows += [(c, i, ["system", "user", "assistant", "user", "assistant", "assistant"][(i * (1 + c % 3)) % 6], say(c, i)) for i in range(c % 9)]
    rows += [(100, i, "user" if i < 90 else ["user", "assistant"][i % 2], say(100, i)) for i in range(180)]  # a large conversation, half of which never converges
    rows += [(101, i, "user", "same text.") for i in range(90)] + [(102, 7, "assistant", "same row") for _ in range(40)]
    rows += [(103, None, "user", "a."), (103, None, None, None), (103, 5, "", "x?"), (103, 9, "tool", "y\n.\n "), (103, 9, "user", "\x85"), (None, 0, "user", "null id."), (None, None, "assistant", "null id!")]
    rows += [(104, 1, "user", "long " * 60_000), (104, 2, "assistant", "long " * 60_000 + "!"), (105, -3, "user", " \t\n\x0b"), (105, 2**60, "usher", "ok. \r\n"), (103, 9, "user", "\x85")]
    return rows + [(n, 0, "user", "gone.") for n in range(1000, 3000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0][:5]


@pytest.mark.parametrize("chunk", [{}, {"chunk_rows": 1}, {"chunk_rows": 7, "chunk_bytes": 300}])
def test_table(spark, chunk):
    rows = conversations()
    df = spark.createDataFrame([(*r, 3, "k") for r in rows], "conv_id long, turn long, role string, text string, place int, audit string").repartition(3)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS[1:]) for r in tr.repaired_digests(*tr.repair(*tr.damaged(df), **chunk)).collect()}
    want = {c: brute(mine) for c, mine in damage(rows).items()}
    assert got == want
    assert len([c for c, m in damage(rows).items() if not m]) >= 5


def test_pieces_are_whole_texts(spark):
    df = spark.createDataFrame([(1, i, ["user", "assistant"][i % 2], f"t{i}.") for i in range(30)], "conv_id long, turn long, role string, text string")
    _, reports, pieces = tr.repair(df, chunk_rows=4)
    said = [(t["role"], t["text"]) for r in sorted(pieces.collect(), key=lambda r: r["place"]) for t in r["turns"]]
    assert said == [(["user", "assistant"][i % 2], f"t{i}.") for i in range(30)] and reports.first()["audit"] == "K" * 30


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert tr.repaired_digests(*tr.repair(*tr.damaged(df))).count() == 0


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS[1:]) for r in tr.op13_turn_repair(spark, sf).select(COLUMNS).collect()}
    assert got == {c: brute(mine) for c, mine in damage(rows).items()}
