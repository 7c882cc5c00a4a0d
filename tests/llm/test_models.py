"""Toxicity grades and quality scores: gradients, formulas and held-out accuracy."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

from cellweave.llm import quality_fm, toxicity

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet"), spark.read.parquet(f"{ROOT}/labels.parquet")


@pytest.fixture(scope="module")
def toxic_model(tables):
    docs, labels = tables
    return toxicity.train(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 4 != 2"))


@pytest.fixture(scope="module")
def quality_model(tables):
    return quality_fm.train(*tables)


def test_cumulative_link_fit_orders_grades():
    draw = np.random.default_rng(0)
    x = draw.normal(size=600)
    grades = np.digitize(2 * x + draw.logistic(size=600) * 0.5, [-1, 0.5, 2])
    weights, thresholds = toxicity.fit(np.arange(600), np.zeros(600, dtype=np.int64), x, grades, 1, 3)
    assert weights[0] > 1 and (np.diff(thresholds) > 0).all()
    loss = lambda w, t: -np.mean(np.log(np.maximum(np.diff(np.column_stack([np.zeros(600), 1 / (1 + np.exp(-(t - w * x[:, None]))), np.ones(600)]), axis=1)[np.arange(600), grades], 1e-12)))
    best = loss(weights[0], thresholds)
    for k in range(3):
        for step in (-0.3, 0.3):
            assert loss(weights[0], thresholds + step * (np.arange(3) == k)) > best - 1e-3
    assert loss(weights[0] * 1.3, thresholds) > best - 1e-3


def test_score_by_hand(toxic_model):
    names = toxic_model.names.to_pylist()
    text = "You IDIOT, you idiot! What a moron."
    words = [w.strip(toxicity.MARKS) for w in text.lower().split()]
    counts = {}
    for w in words:
        for f in [f"w:{w}"] + [f"{n}:{w[:n]}" for n in toxicity.BEGINNINGS if len(w) >= n]:
            counts[f] = counts.get(f, 0) + 1
    x = sum(toxic_model.weights[names.index(f)] * np.log1p(n) for f, n in counts.items() if f in names)
    p, n = toxic_model.score(pa.array([text, None, ""]))
    assert np.allclose(p[0], 1 / (1 + np.exp(toxic_model.thresholds - x))) and n.tolist() == [7, 0, 0]
    assert np.allclose(p[1], p[2]) and p[1, 0] < 0.5


def test_toxic_held_out(tables, toxic_model):
    docs, labels = tables
    rows = toxicity.severity(docs, toxic_model).join(labels.withColumnRenamed("toxic", "label"), "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").collect()
    right = [r.toxic == (r.label == 1) for r in rows]
    # 38 toxic documents in four languages leave some words unseen; over the larger tables all held-out ones are found
    assert len(right) > 60 and sum(right) / len(right) > 0.93 and not any(r.toxic for r in rows if not r.label)
    assert all(r.p_1 >= r.p_2 >= r.p_3 and abs(r.expected_severity - r.p_1 - r.p_2 - r.p_3) < 1e-9 for r in rows)


def test_toxic_rows(make, odd, toxic_model, tables):
    docs = make(odd + ["you idiot moron loser scum " * 3])
    rows = sorted(toxicity.severity(docs, toxic_model).collect())
    assert [r.toxic for r in rows] == [False] * len(odd) + [True]
    kept = toxicity.keep_clean(docs, toxic_model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(len(odd)))
    assert toxicity.severity(make([]), toxic_model).count() == 0
    # nothing to learn from: no grade for anyone
    for given, labels in ((docs, tables[1].where("toxic = 0")), (make([]), tables[1]), (docs, tables[1].limit(0))):
        plain = toxicity.train(given, labels)
        assert {(r.grade, r.toxic, round(r.expected_severity, 9)) for r in toxicity.severity(docs, plain).collect()} == {(0, False, 0.0)}
        assert toxicity.severity(make([]), plain).count() == toxicity.keep_clean(make([]), plain).count() == 0


def test_toxic_ids_and_columns(make, toxic_model):
    texts = ["you idiot moron loser scum " * 3, "a fine day", "you idiot moron loser scum " * 3, None, "word " * 60000 + "you idiot moron loser scum " * 30000]
    docs = make(texts, ids=[None, 5, 5, 5, None]).selectExpr("*", "'x' as label", "1 as grade", "2 as times", "3 as features")
    assert sorted((r.doc_id or 0, r.toxic) for r in toxicity.severity(docs, toxic_model).collect()) == [(0, True), (0, True), (5, False), (5, False), (5, True)]
    kept = toxicity.keep_clean(docs, toxic_model)
    assert kept.columns == docs.columns and sorted((r.text or "") for r in kept.collect()) == ["", "a fine day"]


def test_chosen_features_against_plain_counting(spark, make):
    """Features, their likelihood ratios and the strong ones as a plain count gives them."""
    draw = np.random.default_rng(5)
    words = [f"{c}{k}word" for k in range(9) for c in "abc"]
    rows = [(i, " ".join(draw.choice(words[: 9 if i % 3 else 27], 12)) + (" Vile, vile!" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    names, strong = toxicity.select_features(sample, 50, (60, 30))
    held = {}
    for _, text, label in rows:
        bare = {w.strip(toxicity.MARKS) for w in text.lower().split()}
        for f in {f"w:{w}" for w in bare} | {f"{n}:{w[:n]}" for w in bare for n in toxicity.BEGINNINGS if len(w) >= n}:
            held.setdefault(f, [0, 0])[label] += 1

    def gain(a, b):
        p = (a + b) / 90
        term = lambda k, x, y: k * np.log(x / y) if k else 0.0
        return term(b, b / 30, p) + term(30 - b, 1 - b / 30, 1 - p) + term(a, a / 60, p) + term(60 - a, 1 - a / 60, 1 - p)

    expected = sorted(((-round(gain(*n), 9), f) for f, n in held.items() if sum(n) >= toxicity.LEAST_DOCS and gain(*n) >= toxicity.LEAST_GAIN))[:50]
    assert sorted(names.to_pylist()) == sorted(f for _, f in expected) and "w:vile" in names.to_pylist()
    odds = {f: np.log((n[1] + 0.5) / (30 - n[1] + 0.5)) - np.log((n[0] + 0.5) / (60 - n[0] + 0.5)) for f, n in held.items()}
    assert [bool(x) for x in strong] == [odds[f] > toxicity.STRONG for f in names.to_pylist()]


def test_pairwise_sum_is_the_sum_over_pairs():
    draw = np.random.default_rng(2)
    model = quality_fm.Model(0.3, draw.normal(size=50), draw.normal(size=(50, 4)))
    found, values = np.array([3, 7, 7, 20, 1, 49]), draw.normal(size=6)
    rows = np.array([0, 0, 0, 0, 1, 1])
    raw, _ = model.raw(rows, found, values, 2)
    for r in (0, 1):
        i = np.flatnonzero(rows == r)
        pairs = sum(model.factors[found[a]] @ model.factors[found[b]] * values[a] * values[b] for a in i for b in i if a < b)
        assert np.isclose(raw[r], 0.3 + model.weights[found[i]] @ values[i] + pairs)


def test_quality_held_out(tables, quality_model):
    docs, labels = tables
    rows = quality_fm.score(docs, quality_model).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert auc > 0.97 and np.mean([s >= 0.7 for s in good]) > 0.95


def test_quality_rows(make, odd, quality_model, tables):
    rows = sorted(quality_fm.score(make(odd), quality_model).collect())
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score and rows[3].score == rows[4].score
    assert quality_fm.score(make([]), quality_model).count() == 0
    one = tables[1].where("quality = 1")
    n = one.where("crc32(cast(cast(doc_id as string) as binary)) % 4 != 2").count()
    for docs, labels, share in ((make(odd), one, (n + 1) / (n + 2)), (make([]), tables[1].limit(0), 0.5)):
        plain = quality_fm.train(docs, labels)
        assert {round(r.score, 9) for r in quality_fm.score(make(odd), plain).collect()} == {round(share, 9)} and quality_fm.score(make([]), plain).count() == 0
    assert quality_fm.score(make([]), quality_fm.train(make([]), tables[1])).count() == 0
    docs = make(["a b", "a b", None, "word " * 60000], ids=[None, 7, 7, 7]).selectExpr("*", "1 as label", "2 as score", "3 as features")
    assert sorted((r.doc_id or 0, r.held_out) for r in quality_fm.score(docs, quality_model).collect()) == [(0, False)] + [(7, zlib.crc32(b"7") % 4 == 2)] * 3


def test_features_against_plain_counting(odd):
    """Hashed words with scaled logs, and the step of every statistic."""
    texts = [*odd, "One two ONE two\n#tag 12 | x\n#tag 12 | x\n", "long words " * 500]
    rows, found, values = quality_fm.features(pa.array(texts))
    for i, text in enumerate(texts):
        text = text or ""
        raw = re.findall(r"[^\x20\x09-\x0D]+", text)
        words = re.findall(r"[^\x20\x09-\x0D]+", pc.utf8_lower(pa.scalar(text)).as_py())
        counts = {}
        for w in words:
            k = xxhash.xxh64_intdigest(w.encode()) % quality_fm.BUCKETS
            counts[k] = counts.get(k, 0) + 1
        logs = {k: np.log1p(n) for k, n in counts.items()}
        size = np.sqrt(sum(x * x for x in logs.values()))
        data, lines = text.encode(), [x for x in text.split("\n") if x.strip()]
        part = lambda chars: sum(c in chars for c in data) / max(len(data), 1)
        some = max(len(words), 1)
        shares = [part(range(65, 91)), part(range(48, 58)), part(b"#*$%&|<>{}[]\\^~=_+@"), part(b".,;:!?\"'()-"), part(b"\n"), part(range(128, 256)), len(set(words)) / some, sum(a == b for a, b in zip(words, words[1:])) / some, (len(lines) - len(set(lines))) / max(len(lines), 1), sum(bool(re.search(r"[#*$%&|<>]", w)) for w in raw) / some]
        sizes = [len(words), len(text) / some, len(words) / max(len(lines), 1), len(text)]
        steps = [int(np.sqrt(x) * 31) for x in shares] + [min(int(2 * np.log2(1 + x)), 31) for x in sizes]
        expected = {k: x / size for k, x in logs.items()} | {quality_fm.BUCKETS + j * 32 + s: 1 / np.sqrt(14) for j, s in enumerate(steps)}
        mine = rows == i
        assert dict(zip(found[mine].tolist(), np.round(values[mine], 9).tolist(), strict=True)) == {k: round(float(x), 9) for k, x in expected.items()}, text[:40]
