"""Repeats against a search of all pairs of positions."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cellweave.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    text = text or ""
    words, size = WORD.findall(text), len(text)
    longest = [0] * size
    for i in range(size):
        for j in range(size):
            k = 0
            while i != j and max(i, j) + k < size and text[i + k] == text[j + k]:
                k += 1
            longest[i] = max(longest[i], k if k >= least else 0)
    covered = {i + k for i in range(size) for k in range(longest[i])}
    # a repeat is maximal if neither all its places go on alike nor all come from alike
    maximal = {}
    for i in range(size):
        for k in range(least, longest[i] + 1):
            places = [m.start() for m in re.finditer(f"(?={re.escape(text[i : i + k])})", text)]
            sides = [({text[p - 1] if p else -p - 1 for p in places}, {text[p + k] if p + k < size else -p - 1 for p in places})]
            if len(places) > 1 and all(len(x) > 1 for x in sides[0]):
                maximal[places[0], k] = len(places)
    n = len(words)
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    twice = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    base = n < 10 or 100 * len(twice) > 20 * n
    part = sum(not re.match("[\\x20\\x09-\\x0D]", text[i]) for i in covered)
    kept = not base and part <= Q.MAX_COVERED * chars and max(longest, default=0) <= Q.MAX_LONGEST
    return {"n_words": n, "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(twice), "covered_chars": part, "longest_repeat": max(longest, default=0), "n_repeats": len(maximal), "base_failed": base, "kept": kept}, covered, maximal


def texts(seed):
    draw = random.Random(seed)
    out = []
    for _ in range(25):
        words = [draw.choice("a b cc d ee f gé".split()[: draw.randrange(1, 8)]) + str(draw.randrange(draw.choice([1, 4, 60]))) for _ in range(draw.randrange(70))]
        if draw.random() < 0.5:
            words += words[draw.randrange(len(words) + 1) :]
        out.append("".join(w + draw.choice(" \n\t") for w in words))
    return out


def unspaced(seed):
    """Runs without any white space, that repeat inside words, over few and over many symbols, and of one character."""
    draw = random.Random(seed)
    part = "".join(draw.choice("abc\u65e5\u672c\U0001f44d") for _ in range(30))
    return [part + "x" + part, "a" * 90, "ab" * 40 + "c", part * 3 + "yz" + part, "".join(draw.choice("ab") for _ in range(120)), "word" + part + "tail head" + part + "end"]


@pytest.mark.parametrize("seed", range(6))
def test_measures(seed, odd):
    batch = [t for t in texts(seed) + odd + unspaced(seed) if len(t or "") < 300]
    for least in (1, 5, 20):
        m = Q.measure(pa.array(batch), least)
        at, found = 0, {}
        for row, first, size, times in zip(*(x.tolist() for x in m["repeats"]), strict=True):
            found.setdefault(row, {})[first, size] = times
        for i, text in enumerate(batch):
            expected, covered, maximal = brute(text, least)
            assert {c: int(m[c][i]) for c in Q.COLUMNS} == {c: expected[c] for c in Q.COLUMNS}, (text, least)
            assert set(np.flatnonzero(m["covered"][at : at + len(text or "")]).tolist()) == covered and found.get(i, {}) == maximal
            at += len(text or "")


def test_rules(make, odd):
    batch = [t for t in texts(99) + odd + unspaced(99) if len(t or "") < 300]
    docs = make(batch)
    rows = {r.doc_id: r.asDict() for r in Q.apply_rules(docs).collect()}
    found = {i: brute(text, Q.MIN_CHARS) for i, text in enumerate(batch)}
    for i, (expected, _, _) in found.items():
        assert {c: rows[i][c] for c in expected} == expected
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in rows if rows[i]["kept"]}
    assert Q.apply_rules(make([])).count() == Q.keep_good(make([])).count() == 0
    spans = {(r.doc_id, w) for r in Q.repeated_spans(docs).collect() for w in range(r.first_char, r.first_char + r.n_chars)}
    assert spans == {(i, w) for i, (_, covered, _) in found.items() for w in covered}
    assert {(r.doc_id, r.first_char, r.n_chars, r.times) for r in Q.repeats(docs).collect()} == {(i, *k, n) for i, (_, _, maximal) in found.items() for k, n in maximal.items()}


@pytest.mark.parametrize("batch", [["a"], ["", "ab"], ["a", "b"], [None], [""], ["aa"], ["a a", "a a"]])
def test_tiny_batches(batch):
    m = Q.measure(pa.array(batch, pa.string()), 1)
    for i, text in enumerate(batch):
        assert {c: int(m[c][i]) for c in Q.COLUMNS} == {c: v for c, v in brute(text, 1)[0].items() if c in Q.COLUMNS}


def test_ids_and_columns(make):
    docs = make([None, "a b " * 9, "a b " * 9], ids=[None, 7, 7]).selectExpr("*", "1 as kept", "2 as n_words", "3 as covered")
    assert sorted((r.doc_id or 0, r.n_words) for r in Q.apply_rules(docs).collect()) == [(0, 0), (7, 18), (7, 18)]
    assert Q.keep_good(docs).columns == docs.columns


def test_long_repeats(make):
    """Of one word, and of a passage in the midst of a long text without white space."""
    draw = random.Random(8)
    passage = "".join(draw.choice("abcdefghij") for _ in range(5000))
    row = sorted(Q.apply_rules(make(["word " * 20000, passage[:2000] + "x" * 40 + passage + "y" + passage[1000:4000]])).collect())
    assert (row[0].longest_repeat, row[0].n_repeat_words, row[0].covered_chars, row[0].kept) == (99995, 20000, 80000, False)
    assert (row[1].longest_repeat, row[1].covered_chars) == (3000, 2000 + 4000 + 3000)


def test_the_repeats_decide_on_texts_that_pass_the_base_rules(make):
    fresh = lambda n, k: [f"w{k}x{i}" for i in range(n)]
    passage, long = fresh(13, 0), fresh(30, 1)
    texts = [passage + fresh(120, 2) + passage + fresh(2, 3), passage + fresh(400, 2) + passage, long + fresh(900, 2) + long, fresh(100, 2), ["x".join(passage), *fresh(40, 2), "y" + "x".join(passage)]]
    rows = sorted(Q.apply_rules(make([" ".join(t) for t in texts])).select("doc_id", "base_failed", "kept").collect())
    assert [(r.base_failed, r.kept) for r in rows] == [(False, False), (False, True), (False, False), (False, True), (False, False)]


def test_labelled_clean_texts_stay(spark):
    root = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{root}/labels.parquet").where("quality = 1").select("doc_id").distinct()
    rules = Q.apply_rules(spark.read.parquet(f"{root}/documents.parquet")).where("not base_failed").join(labels, "doc_id")
    assert rules.where("kept").count() >= 0.99 * rules.count() > 0


@pytest.mark.parametrize("text", ["a" * 150_000, "ab" * 75_000, "the same passage, over and over again. " * 4000, "".join(random.Random(3).choices("ab", k=50_000)) * 3])
def test_memory_is_in_proportion_to_the_text(text):
    tracemalloc.start()
    Q.measure(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 220 * len(text) + 10_000_000


def test_repeats_in_texts_much_longer_than_a_batch(make):
    """Shifted copies of one long passage, told by what was put together."""
    draw = random.Random(21)
    passage = "".join(draw.choices("abcdefgh", k=300_000))
    row = Q.apply_rules(make([passage + "X" + passage[1000:] + "Y" + passage[:200_000]])).first()
    assert (row.longest_repeat, row.covered_chars) == (299_000, 300_000 + 299_000 + 200_000)
