"""Conversation repair against plain dynamic programming over whole lists of edits, and the search against all short lists."""

import hashlib
import itertools
import re
import zlib

import pytest

from cellweave.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, c string, m int, text_ string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain(rows):
    """(conv_id, turn, role, text) to a dict by conv_id, by relaxing (cost, audit, output) over all states row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        some = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        for _, turn, role, text in sorted(some, key=lambda r: (r[1] is not None, r[1] or 0, after(r)[0], after(r)[1])):
            role, text = (" " if role is None else role), (" " if text is None else text)
            h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if h == 0:
                continue
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            role = "user" if h == 4 else role
            kept += [(turn, role, text)] * (2 if h == 3 else 1)
        faults, seen = [], set()
        for _, role, text in kept:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        states = {"": (0, "", ())}

        def relax(into, state, label):
            if state not in into or label[:2] < into[state][:2]:
                into[state] = label

        def insert(states):
            for _ in range(6):
                for s, (cost, audit, made) in list(states.items()):
                    for c in "ua":
                        if (s, c) in NEXT:
                            relax(states, NEXT[s, c], (cost + 5, audit + "I", made + (f"{cv.ROLES[c]}:",)))

        insert(states)
        for (_, role, text), fault in zip(kept, faults, strict=True):
            new = {}
            for s, (cost, audit, made) in states.items():
                relax(new, s, (cost + 2, audit + "D", made))
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    if (s, role[:1]) in NEXT:
                        relax(new, NEXT[s, role[:1]], (cost + more, audit + "K", made + (f"{role}:{text}",)))
                    for c in "ua":
                        if (s, c) in NEXT:
                            relax(new, NEXT[s, c], (cost + more + 1, audit + "R", made + (f"{cv.ROLES[c]}:{text}",)))
            insert(new)
            states = new
        cost, audit, made = min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])
        initials = [r[:1] for _, r, _ in kept]
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(made).encode()).hexdigest(),
        }
    return out


def after(row):
    """Role and text after damage, by which rows of one turn are ordered."""
    conv, turn, role, text = row
    role, text = (" " if role is None else role), (" " if text is None else text)
    h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    return "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text


def check(spark, rows):
    got = cv.repair(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)).collect()
    want = plain(rows)
    assert len(got) == len(want)
    for r in got:
        assert {k: v for k, v in r.asDict().items() if k != "conv_id"} == want[r.conv_id], r.conv_id


def brute(rows, start, ends):
    """The least (cost, audit) over all lists of edits with at most three insertions."""
    found = []

    def go(i, q, cost, audit, inserts):
        if i == len(rows) and q in ends:
            found.append((cost, audit))
        if inserts < 3:
            for c in "ua":
                if c in cv.NEXT[q]:
                    go(i, cv.NEXT[q][c], cost + 5, audit + "I", inserts + 1)
        if i < len(rows):
            go(i + 1, q, cost + 2, audit + "D", inserts)
            initial, more = rows[i]
            if initial:
                if initial in cv.NEXT[q]:
                    go(i + 1, cv.NEXT[q][initial], cost + more, audit + "K", inserts)
                for c in "ua":
                    if c in cv.NEXT[q]:
                        go(i + 1, cv.NEXT[q][c], cost + more + 1, audit + "R", inserts)

    go(0, start, 0, "", 0)
    return min(found, default=None)


def test_search_finds_the_least_of_all_lists():
    kinds = [("s", 0), ("u", 0), ("a", 0), ("x", 0), ("u", 5), ("a", 5), ("", 0)]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            assert cv.cheapest(list(rows), 0, cv.ENDS) == brute(rows, 0, cv.ENDS), rows
    for rows in itertools.product(kinds[:4], repeat=3):
        for q, r in itertools.product(range(4), range(4)):
            assert cv.cheapest(list(rows), q, (r,)) == brute(rows, q, (r,)), (rows, q, r)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_odd_rows(spark):
    roles, texts = [None, "", "user", "assistant", "system", "tool", "u"], [None, "", " \t", "Hi.", "Hi", "a!\n", "日本。", "x" * 120_000]
    rows = [(k, t, roles[(k * 7 + t * 3) % 7], texts[(k * 5 + t * t) % 8]) for k in range(60) for t in range(k % 9)]
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (100, None, "user", "x"), (101, 5, "user", "a."), (101, 5, "user", "a."), (101, 5, "assistant", "b."), (101, 9, None, None)]
    check(spark, rows)


def test_empty_table(spark):
    assert cv.repair(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("block", [4, 256])
def test_conversation_over_several_pieces_and_tasks(spark, monkeypatch, block):
    monkeypatch.setattr(cv, "BLOCK", block)
    roles = ["user", "assistant", "assistant", "user", "system"]
    rows = [(7, t, roles[(t * t + t // 3) % 5], f"text {t % 40}" + "." * (t % 4 > 0)) for t in range(700)] + [(k, 0, "user", "a.") for k in range(6)]
    check(spark, rows)


def test_equal_rows_at_many_turns(spark):
    check(spark, [(1, t // 3, "user", "same.") for t in range(300)] + [(2, None, "user", "q.")] * 50)
