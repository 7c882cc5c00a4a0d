"""Fingerprints and components against their definitions."""

import itertools
import random
import re

import xxhash

from cellweave.llm import simhash as S


def fp_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def reachable(n, edges):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


def near(prints):
    return [(a, b) for a, b in itertools.combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_are_all_within_three_bits(spark):
    draw = random.Random(3)
    prints = [0, (1 << 64) - 1, *(draw.getrandbits(64) for _ in range(40))]
    for x in list(prints):
        for flips in (1, 2, 3, 4, 5):
            for _ in range(4):
                y = x
                for b in draw.sample(range(64), flips):
                    y ^= 1 << b
                prints.append(y)
    prints = list(dict.fromkeys(prints))
    apart = spark.createDataFrame([(i, signed(x), i) for i, x in enumerate(prints)], "id long, fp long, group long")
    rows = S.links(apart).collect()
    assert sorted((r.a, r.b) for r in rows) == near(prints)
    # a star never links what isn't near, and with the links between what it leaves apart everything is reached
    stars = [(r.a, r.b) for r in S.star_links(apart).collect()]
    assert set(stars) <= set(near(prints)) and len(stars) > 20
    known = {r.fp: r.group for r in S.near_groups(apart.select("fp")).collect()}
    label = reachable(len(prints), near(prints))
    named = {}
    assert all(named.setdefault(known[signed(x)], label[i]) == label[i] for i, x in enumerate(prints)) and len(named) == len(set(label))


def test_rows_without_or_with_shared_ids(make):
    texts = ["a b c d", "a b c d", "e f g h", "i j k l", "m n o p"]
    docs = make(texts, ids=[None, None, 5, 7, 7])
    rows = [(r.doc_id, r.component_id) for r in S.groups(docs).collect()]
    assert sorted(rows, key=str) == [(5, 5), (7, 7), (7, 7), (None, None), (None, None)]
    assert sorted(r.text for r in S.keep_one(docs).collect()) == texts[1:]
    more = docs.selectExpr("*", "'g' as group", "1 as n", "2 as t", "3 as row", "4 as fp", "5 as key")
    assert S.keep_one(more).columns == more.columns and S.keep_one(more).count() == 4


def test_groups(make, odd, real):
    texts = odd + real.text.tolist() + odd
    docs = make(texts, ids=[3 * i + 1 for i in range(len(texts))])
    prints = [fp_of(t) for t in texts]
    label = reachable(len(texts), near(prints))
    rows = sorted(S.groups(docs).select("doc_id", S.hex_of("fp").alias("fp"), "component_id").collect())
    assert [(r.doc_id, r.fp, r.component_id) for r in rows] == [(3 * i + 1, f"{prints[i]:016x}", 3 * label[i] + 1) for i in range(len(texts))]
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({3 * x + 1 for x in label})
    assert S.groups(make([])).count() == S.keep_one(make([])).count() == 0
    assert S.keep_one(make(["a b c d", "a b c d"], ids=[7, 7])).count() == 1
