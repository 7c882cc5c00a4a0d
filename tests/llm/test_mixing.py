import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from cellweave.llm import mixing as M


def brute(rows, rounds, share, temper=0.7):
    cells = {}
    for r in rows:
        text = r[1] or ""
        topic = "legal" if "icense" in text else "contact" if "@" in text else "tabular" if " | " in text else "prose"
        key = (r[3] or "", r[2] or "", topic)
        cells[key] = cells.get(key, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    keys = sorted(cells)
    n = np.array([cells[k] for k in keys], dtype=float)
    w = n.copy()
    for _ in range(rounds):
        for d in range(3):
            values = sorted({k[d] for k in keys})
            of = np.array([values.index(k[d]) for k in keys])
            target = np.bincount(of, n) ** temper
            target = target / target.sum()
            now = np.bincount(of, w)
            w = np.where(now[of] > 0, w * target[of] / np.where(now[of] > 0, now[of], 1), 0)
    ratio = np.where(n > 0, w / w.sum() * n.sum() / np.where(n > 0, n, 1), 0)
    low, high = 0.0, 1e9
    for _ in range(200):
        c = (low + high) / 2
        low, high = (c, high) if (n * np.minimum(1, c * ratio)).sum() < share * n.sum() else (low, c)
    return {k: (w[i] / w.sum(), min(1, high * ratio[i]) if n[i] else 1.0) for i, k in enumerate(keys)}


def test_against_brute_force(make, odd, real):
    texts = odd + real.text.tolist()
    langs, sources = ["en"] * len(odd) + real.lang.tolist(), [None] * len(odd) + real.source.tolist()
    rows = M.mix(make(texts, langs=langs, sources=sources)).collect()
    expected = brute([(i, t, langs[i], sources[i]) for i, t in enumerate(texts)], M.ROUNDS, M.SHARE)
    assert len(rows) == len(texts)
    for r in rows:
        weight, chance = expected[r.cell_source, r.cell_lang, r.cell_topic]
        u = (int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32
        assert r.cell_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))
        if r.cell_tokens:
            assert abs(r.cell_weight - weight) < 1e-9 and abs(r.cell_probability - chance) < 1e-6
        assert r.cell_kept == (u < r.cell_probability)
    total = sum(r.cell_tokens for r in rows)
    assert abs(sum(r.cell_tokens * r.cell_probability for r in rows) / total - M.SHARE) < 1e-6


def test_targets_hold(spark, make):
    texts = ["w " * (10 + i % 17) + ("| x @ license"[: i % 14]) for i in range(300)]
    docs = make(texts, langs=[("en", "de")[i % 3 == 0] for i in range(300)], sources=[("a", "b", "c")[i % 7 % 3] for i in range(300)])
    wanted = {d: spark.createDataFrame(v, "value string, weight double") for d, v in {"lang": [("en", 1.0), ("de", 1.0)], "source": [("a", 5.0), ("b", 3.0), ("c", 2.0)]}.items()}
    rows = M.mix(docs, {**wanted, "topic": 1.0}, rounds=40).select("cell_source", "cell_lang", "cell_topic", "cell_weight").distinct().collect()
    for column, shares in (("cell_lang", {"en": 0.5, "de": 0.5}), ("cell_source", {"a": 0.5, "b": 0.3, "c": 0.2})):
        for value, share in shares.items():
            assert abs(sum(r.cell_weight for r in rows if r[column] == value) - share) < 1e-6


def test_rows_keep_their_columns(make, odd):
    docs = make(odd)
    kept = M.keep_mixed(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in M.mix(docs).where("cell_kept").collect()}
    assert M.mix(make([])).count() == 0 and M.mix(make([None, ""])).where("cell_kept").count() == 2


def test_tables_without_tokens_and_targets_without_values(spark, make):
    docs = make([None, "", None])
    assert [(r.cell_weight, r.cell_probability, r.cell_kept) for r in M.mix(docs).collect()] == [(0.0, 1.0, True)] * 3
    docs = make(["a b c", "d e", None, "f " * 50, "g"], sources=["a", "a", "b", "b", None], ids=[1, 2, 3, 4, None])
    only_a = spark.createDataFrame([("a", 2.0), ("a", 1.0), ("zzz", 5.0), ("b", -1.0), (None, None)], "value string, weight double")
    rows = {r.doc_id: r for r in M.mix(docs, {**M.TEMPER, "source": only_a}).collect()}
    # b and null have no weight; what is left is less than the share, so all of it is kept
    assert {i: (r.cell_probability, r.cell_kept) for i, r in rows.items()} == {1: (1.0, True), 2: (1.0, True), 3: (0.0, False), 4: (0.0, False), None: (0.0, False)}
    nothing = only_a.where("value = 'zzz'")
    assert {r.doc_id for r in M.keep_mixed(docs, targets={**M.TEMPER, "source": nothing}).collect()} == set()
    assert M.keep_mixed(docs, targets={**M.TEMPER, "source": only_a.limit(0)}).count() == 0


def test_columns_of_the_caller_stay(make, odd):
    docs = make(odd).withColumns({"cell_source": F.lit("MINE"), "Cell_kept": F.lit(None).cast("string"), "tokens": F.lit(7), "weight": F.lit(1)})
    assert {(r.cell_source, r.Cell_kept, r.tokens, r.weight) for r in M.keep_mixed(docs).collect()} == {("MINE", None, 7, 1)}
    mixed = M.mix(docs)
    assert mixed.columns[: len(docs.columns)] == docs.columns and "cell__source" in mixed.columns
    assert {r.doc_id: r.cell__kept for r in mixed.collect()} == {r.doc_id: r.cell_kept for r in M.mix(make(odd)).collect()}


def test_repeated_rows_and_topics(make):
    texts = ["one two three", "x @ y", "z"] * 4
    rows = M.mix(make(texts, ids=[1, 2, None] * 4), topics=(("at", "@"),)).collect()
    assert len(rows) == 12 and {r.cell_topic for r in rows} == {"at", "prose"}
    for i in (1, 2, None):
        assert len({(r.cell_probability, r.cell_kept) for r in rows if r.doc_id == i}) == 1
    assert {r.cell_topic for r in M.mix(make(texts), topics=F.lit(None).cast("string")).collect()} == {""}
