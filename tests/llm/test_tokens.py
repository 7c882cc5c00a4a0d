"""Ids, counts, packing and files against the tokenizers library itself."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cellweave.llm import packing, token_counts, token_store
from cellweave.llm.tokens import ByteBpe, WordBpe

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts, end):
    return [x.ids + [end] for x in Tokenizer.from_file(WORD).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_pieces_give_the_library_s_ids(odd):
    draw, letters = random.Random(5), "ab'stle \n\t .,!<|>9½éÀ\xa0 ́日'ms"
    texts = odd + ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(1500)]
    word, byte = WordBpe(WORD), ByteBpe(BYTE)
    ids, counts = word.encode(pa.array(texts))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [x.ids for x in word.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert byte.count(pa.array(texts)).tolist() == [len(x.ids) for x in byte.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_forgetting_changes_nothing(odd, monkeypatch):
    monkeypatch.setattr("cellweave.llm.tokens.REMEMBERED", 3)
    library = ByteBpe(BYTE)
    assert library.count(pa.array(odd)).tolist() == ByteBpe(BYTE).count(pa.array(odd)).tolist()


def test_counts_and_cache(spark, make, odd, tmp_path):
    texts, cache = odd + ["x" * 2000], f"file://{tmp_path}/cache"
    docs = make(texts)
    rows = sorted(token_counts.count_tokens(docs, BYTE, cache).collect())
    expected = [len(x.ids) for x in Tokenizer.from_file(BYTE).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [r.n_tokens for r in rows] == expected and [r.over_limit for r in rows] == [n > 512 for n in expected]
    assert [r.n_bytes for r in rows] == [len((t or "").encode()) for t in texts]
    assert token_counts.encode_misses(docs, BYTE, cache).count() == 0
    stored = token_counts.read_cache(spark, cache).count()
    assert stored == len({t or "" for t in texts})
    assert token_counts.encode_misses(docs, WORD, cache).count() == stored  # another version's counts don't serve
    more = make(["something new", "a"])
    token_counts.count_tokens(more, BYTE, cache).collect()
    assert token_counts.read_cache(spark, cache).count() == stored + 1
    assert token_counts.count_tokens(make([]), BYTE, f"file://{tmp_path}/none").count() == 0


def packed(rows, texts, capacity):
    ids = ids_of(texts, 0)
    places = {}
    for r in rows:
        assert crc(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32 and r.start == r.piece * capacity
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, ids)) and len({(r.doc_id, r.piece) for r in rows}) == len(rows) == sum(math.ceil(len(x) / capacity) for x in ids)
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), math.ceil(sum(map(len, ids)) / capacity)


@pytest.mark.parametrize("capacity", [7, 2048])
def test_packing_whole_and_gapless(make, odd, capacity):
    packed(packing.pack(make(odd), WORD, capacity).collect(), odd, capacity)


def test_packing_real(spark, real):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    used, least = packed(packing.pack(docs, WORD).collect(), real.sort_values("doc_id").text.tolist(), 2048)
    assert used <= least + 2


def test_packing_empty(make):
    assert packing.pack(make([]), WORD).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_plan_uses_each_length_as_often_as_it_is_there(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.integers(1, 60))
    counts = np.concatenate([[0], draw.integers(0, 12, capacity) * draw.integers(0, 2, capacity)])
    kinds, used = packing.plan(counts, capacity), np.zeros(capacity + 1, dtype=int)
    for held, many in kinds:
        assert many > 0 and sum(a * n for a, n in held) <= capacity
        for a, n in held:
            used[a] += n * many
    assert used.tolist() == counts.tolist()


def test_complements_before_best_fit():
    # 6+4 and 7+2+1 leave nothing over; best fit alone would put 2 beside 6
    kinds = packing.plan(np.bincount([6, 4, 7, 2, 1], minlength=11), 10)
    assert sorted(sorted(a for a, n in held for _ in range(n)) for held, _ in kinds) == [[1, 2, 7], [4, 6]]
    have = np.bincount([9, 5, 3, 3], minlength=21)
    assert packing.complement(have, 9, 11, *packing.index_sums(have, 20)) == (5, 3, 3)
    assert packing.complement(have, 9, 12, *packing.index_sums(have, 20)) is None  # 3 + 9 would take the one 9 itself


def test_index_of_sums():
    draw = np.random.default_rng(3)
    for _ in range(20):
        have = draw.integers(0, 2, 31) * (np.arange(31) > 0)
        there = np.flatnonzero(have)
        two = {a + b for a in there for b in there}
        pairs, triples = packing.index_sums(have, 30)
        assert set(np.flatnonzero(pairs)) == {x for x in two if x <= 30} and set(np.flatnonzero(triples)) == {x + c for x in two for c in there if x + c <= 30}


@pytest.mark.parametrize("most", [1, 200, 70_000, 1 << 26])
def test_variable_length_round_trip(most):
    ranks = np.random.default_rng(most).integers(0, most, 1001).astype(np.uint32)
    for n in (0, 1, 4, 1001):
        doc_ids, counts, got, before = token_store.unpack_file(token_store.pack_file(np.array([5]), np.array([n]), ranks[:n], 9))
        assert got.tolist() == ranks[:n].tolist() and (doc_ids[0], counts[0], before) == (5, n, 9)


def test_files_round_trip(spark, make, odd, tmp_path):
    ids, path = list(range(len(odd)))[::-1], f"file://{tmp_path}/files"
    token_store.write_files(make(odd, ids=ids), WORD, path)
    rows, expected, start = sorted(token_store.read_files(spark, path).collect()), ids_of(odd[::-1], 1), 0
    assert len(rows) == len(odd)
    for r, e in zip(rows, expected, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(e), crc(e), np.array(e, dtype="<u4").tobytes())
        start += len(e)
    ranks = [r.n for r in spark.read.parquet(f"{path}/ranks.parquet").orderBy("rank").collect()]
    assert ranks == sorted(ranks, reverse=True) and sum(ranks) == start


def test_files_of_nothing(spark, make, tmp_path):
    token_store.write_files(make([]), WORD, f"file://{tmp_path}/files")
    assert token_store.read_files(spark, f"file://{tmp_path}/files").count() == 0


def test_shared_and_missing_ids_long_texts_and_other_columns(spark, make, tmp_path):
    """Every row counts on its own, whatever its id and however long its text."""
    texts = ["one two", "one two", "three", None, "a longer text of words " * 30000, "x" * 200000]
    ids = [7, 7, 7, None, None, 9]
    docs = make(texts, ids=ids).selectExpr("*", "1 as task", "2 as length", "3 as n", "4 as content", "5 as ids", "6 as part")
    lengths = [len(x) for x in ids_of(texts, 0)]
    rows = packing.pack(docs, WORD).collect()
    assert sorted(n for i in (7,) for n in [r.length for r in rows if r.doc_id == i]) == sorted(lengths[:3])
    assert sum(r.length for r in rows if r.doc_id is None) == lengths[3] + lengths[4] and sum(r.length for r in rows) == sum(lengths)
    path = f"file://{tmp_path}/files"
    token_store.write_files(docs, WORD, path)
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in token_store.read_files(spark, path).collect())
    assert [i for _, i, _ in found] == [None, None, 7, 7, 7, 9] and sorted(n for _, _, n in found) == sorted(lengths)
    assert [a for a, _, _ in found] == [sum(n for _, _, n in found[:k]) for k in range(len(found))]
    counted = token_counts.count_tokens(docs, BYTE, f"file://{tmp_path}/cache").collect()
    assert sorted((r.doc_id or 0, r.n_bytes) for r in counted) == sorted((i or 0, len(t or "")) for i, t in zip(ids, texts, strict=True))
