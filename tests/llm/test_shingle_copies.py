"""Groups by exact five-word-shingle similarity against a comparison of all pairs."""

import math
import random
import re

from cellweave.llm import shingle_copies as S
from test_simhash import reachable


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def alike(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def words(draw, n):
    return [draw.choice(["the", "of", "and"]) if draw.random() < 0.3 else f"{draw.choice('abcdefgh')}{draw.randrange(5000)}" for _ in range(n)]


def edited(w, kind, share, draw):
    n = max(1, int(share * len(w)))
    at = draw.randrange(len(w) - n)
    if kind == "cut":
        return w[:-n]
    if kind == "appended":
        return w + words(draw, n)
    if kind == "inserted":
        return w[:at] + words(draw, n) + w[at:]
    return [f"new{draw.randrange(10**6)}" if draw.random() < share / 5 else x for x in w]


def test_every_kind_of_edit_is_found(make):
    draw, texts, pairs = random.Random("edits"), [], dict.fromkeys(["cut", "appended", "inserted", "replaced"], 0)
    for kind in pairs:
        for share in (0.02, 0.05, 0.1, 0.15, 0.18):
            for _ in range(16):
                w = words(draw, draw.randrange(100, 600))
                texts += [" ".join(w), " ".join(edited(w, kind, share, draw))]
                pairs[kind] += alike(*map(shingles, texts[-2:]))
    group = {r.doc_id: r.component_id for r in S.groups(make(texts)).collect()}
    assert min(pairs.values()) >= 40 and all((group[i] == group[i + 1]) == alike(shingles(texts[i]), shingles(texts[i + 1])) for i in range(0, len(texts), 2))


def test_groups_against_all_pairs(make, odd, real):
    """Links are exactly the pairs at 0.8 or more, with chains, large groups and a passage that most texts hold."""
    draw, passage = random.Random(5), words(random.Random(1), 60)
    texts = odd + real.text.tolist()[:120]
    for k in range(15):
        w = words(draw, draw.randrange(5, 200))
        texts += [" ".join(edited(w, draw.choice(["cut", "appended", "inserted", "replaced"]), draw.choice([0, 0.05, 0.15, 0.2, 0.3]), draw) if len(w) > 30 else w) for _ in range(6)]
        texts.append(" ".join(passage + w[: draw.randrange(1, 30)]))
    sets = [shingles(t) for t in texts]
    label = reachable(len(texts), [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if alike(sets[a], sets[b])])
    rows = sorted(S.groups(make(texts)).collect())
    assert [(r.doc_id, r.component_id) for r in rows] == list(enumerate(label))
    kept = S.keep_one(make(texts))
    assert kept.columns == make([]).columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(label))
    assert S.groups(make([])).count() == S.keep_one(make([])).count() == 0


def test_rows_without_or_with_shared_ids_are_kept_once_a_group(make):
    """Unique texts without doc_id, and different texts under one doc_id, all stay; copies go."""
    texts = ["a b c d e f g", "h i j k l m n", "h i j k l m n", "o p q r s t u", "v w x y z 1 2"]
    kept = S.keep_one(make(texts, ids=[None, None, None, 7, 7])).collect()
    assert sorted((r.text, r.doc_id) for r in kept) == [(texts[0], None), (texts[1], None), (texts[3], 7), (texts[4], 7)]


def test_needed_is_the_quantile_of_a_binomial():
    for n in (1, 7, 64, 127, 300):
        below = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(S.needed(n)))
        assert below < S.MISS <= below + math.comb(n, S.needed(n)) * 0.8 ** S.needed(n) * 0.2 ** (n - S.needed(n))


def test_long_texts_and_borders_of_samples(make):
    """Sizes about the borders at which samples change, and very long texts, each with a copy that is just alike and one that isn't."""
    draw, texts = random.Random(9), []
    for n in (60, 66, 127, 130, 250, 262, 1030, 20000):
        w = words(draw, n)
        texts += [" ".join(w), " ".join(w[: int(0.82 * n) + 1]), " ".join(w + words(draw, int(0.2 * n))), " ".join(w[: int(0.7 * n)])]
    sets = [shingles(t) for t in texts]
    label = reachable(len(texts), [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if alike(sets[a], sets[b])])
    assert [(r.doc_id, r.component_id) for r in sorted(S.groups(make(texts)).collect())] == list(enumerate(label)) and len(set(label)) < len(texts) - 8
