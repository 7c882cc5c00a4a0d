"""Spelling variants against plain comparison of all words, and the keys against all pairs one edit apart."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import spelling

LOWER = {a: a + 32 for a in range(65, 91)}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def plain(rows, damage=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if damage and h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda y: (-words[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def found(docs, damage=True):
    rows = spelling.variants(docs, damage).collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def edited(word, rng, letters):
    x = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    return word[:x] + rng.choice(letters) + word[x:] if kind == 0 else word[:x] + word[x + 1 :] if kind == 1 else word[:x] + rng.choice(letters) + word[x + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "éàabÿ×÷z"])
def test_all_pairs_of_edited_words(make, letters):
    rng = random.Random(letters)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 14))) for _ in range(120)]
    words += [letters[0] * k for k in range(7, 24)] + [letters[:2] * k for k in range(4, 9)]
    for _ in range(600):
        words.append(edited(rng.choice(words), rng, letters))
    texts = [" ".join([w] * rng.choice([2, 2, 3, 25, 300])) for w in words]
    docs = make(texts)
    assert found(docs, False) == plain(enumerate(texts), False)


def test_chains_of_forms(make):
    chain = ["abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    texts = [" ".join([w] * n) for w, n in zip(chain, (2, 20, 200, 2000), strict=True)]
    got = found(make(texts), False)
    assert got == plain(enumerate(texts), False)
    assert {r[1] for r in got.values()} == {"abcdefghijk"}


def test_small_table(spark, real):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == plain(zip(real.doc_id, real.text, strict=True))


def test_odd_texts(make, odd):
    long = ["ab" * 5000, "ab" * 5000 + "c", "x" * 3000, "x" * 3001, "Ünder-water naïveté NAÏVETÉ naïveté; foo1barbazqux barbazqux"]
    texts = [*odd, *odd, *long, *long, "word" * 30_000]
    ids = [*range(len(texts) - 2), None, 3]
    rows = list(zip(ids, texts, strict=True))
    assert found(make(texts, ids)) == plain(rows)


def test_no_words(make):
    assert found(make([])) == {}
    assert found(make([None, "", "short words only"])) == {}


def test_pivots_are_the_lightest_that_do_not_overlap():
    for places in itertools.combinations(range(7), 3):
        for weights in itertools.product((1, 2, 3), repeat=3):
            a, b = spelling.two_pivots(np.array([places]), np.array([weights]))
            w = dict(zip(places, weights, strict=True))
            assert b[0] - a[0] >= 2
            assert w[a[0]] + w[b[0]] == min(w[x] + w[y] for x, y in itertools.combinations(places, 2) if y - x >= 2)
