"""Quality rules with repetition measured by suffix arrays over characters.

All suffixes of many texts are sorted at once by prefix doubling (`suffix_array`): first by as many characters as fit into a 64-bit key, then by twice
as many each time; a suffix never equals one of another text, and one that is alone with its prefix is not sorted again. Neighbours in that order have
longest common prefixes; a longest-common-prefix interval is a run of suffixes that share one longer than their neighbours do. It is a maximal repeat where
the characters before its suffixes differ too (else a longer repeat has the same places). A suffix's innermost interval is the longer of the prefixes shared
with its two neighbours, so these give the union of all repeats' spans in one pass. Repeats count from `min_chars` characters on; they may
begin and end inside words and overlap themselves. Limited are the share of a text's word characters that the union covers, and the longest repeat.
Cheaper counts (words, symbols, equal lines, repeated 5-word windows) come first.

Batches of texts are worked on where they were read: nothing is shuffled, and a filter keeps whole rows in place. Texts are read whole, however long;
one text takes about 190 bytes of memory a character, whatever it repeats (10 million equal characters: 1.9 GB).

Null and empty texts have no words and fail. Equal rows get equal results, rows without doc_id and with a shared one theirs. An empty table gives an empty
result. Other columns, whatever their names, are not read, and pass through `keep_good` untouched.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import coded, id_and_text, slices, split_words, table

SYMBOLS = "#*$%&|<>"
SPACE = np.array([32, 9, 10, 11, 12, 13])
WINDOW = 5
#: A repeat counts from this many characters; more than this share of word characters in repeats, or a longer repeat, is refused. Words in repeats
#: are at most the fifth that the rule on 5-word windows lets through, so the share lies below that.
MIN_CHARS, MAX_COVERED, MAX_LONGEST = 48, 0.15, 150
#: Bytes of text that are sorted at once; symbols by which all pairs are compared together before each is on its own.
MOST, STEPS = 1 << 18, 64
#: Odd multipliers that mix a window's words into one number (any would do: what meets by chance is compared).
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xBF58476D1CE4E5B9], dtype="<u8")


class Level:
    """Ranks of suffixes by their first `size` characters: all of them, or those that share that prefix's first half (others equal none)."""

    def __init__(self, size: int, rank: np.ndarray, at: np.ndarray | None = None):
        self.size, self.rank, self.at = size, rank, at

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.at is None:
            return self.rank[a] == self.rank[b]
        if not len(self.at):
            return np.zeros(len(a), dtype=bool)
        i, j = (np.minimum(np.searchsorted(self.at, x), len(self.at) - 1) for x in (a, b))
        return (self.at[i] == a) & (self.at[j] == b) & (self.rank[i] == self.rank[j])


def suffix_array(symbols: np.ndarray, row: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, Level | None]:
    """All suffixes in order, text by text, and their ranks by the longest prefixes that are no longer than `least`, if there are such.

    symbols: all texts' symbols (from 1) one after another; row: each one's text, ascending; ends: where its text ends.
    """
    n = len(symbols)
    bits = int(symbols.max(initial=1)).bit_length()
    size = max(1, (63 - int(row[-1] if n else 0).bit_length()) // bits)
    left = ends - np.arange(n)
    key = row.astype(np.uint64)
    for k in range(size):
        next_one = np.zeros(n, dtype=np.uint64)
        next_one[: max(n - k, 0)] = np.where(left[: max(n - k, 0)] > k, symbols[k:], 0)
        key = key << np.uint64(bits) | next_one
    order = np.argsort(key)
    slots, sorted_keys = np.arange(n), key[order]
    del left, next_one, key
    rank = np.zeros(n, dtype=np.int64)
    level, first_time = None, True
    while True:
        new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])[: len(slots)]
        first = np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))
        at = order[slots]
        rank[at] = slots[first]
        del first, sorted_keys
        if size <= least:
            by = None if first_time else np.argsort(at)
            level = Level(size, rank.astype(np.int32)) if by is None else Level(size, rank[at[by]].astype(np.int32), at[by].astype(np.int32))
        first_time = False
        slots = slots[~(new & np.concatenate([new[1:], [True]])[: len(slots)])]
        if not len(slots):
            return order, level
        at = order[slots]
        after = np.where(at + size < ends[at], rank[np.minimum(at + size, n - 1)] + 1, 0)
        key = rank[at] * (n + 2) + after
        del after
        by = np.argsort(key)
        order[slots], sorted_keys = at[by], key[by]
        del key, by
        size *= 2


def lengthened(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, ends: np.ndarray, known: int) -> np.ndarray:
    """How many symbols pairs of suffixes of one text share that share `known` at least."""
    total, going = np.full(len(a), known, dtype=np.int64), np.arange(len(a))
    for _ in range(STEPS):
        later = np.maximum(a[going], b[going]) + total[going]
        going, later = going[later < ends[a[going]]], later[later < ends[a[going]]]
        going = going[symbols[later] == symbols[later - np.abs(a[going] - b[going])]]
        total[going] += 1
    for k in going.tolist():  # the few that share more are compared in slices
        i, j, end, size = int(a[k] + total[k]), int(b[k] + total[k]), int(ends[a[k]]), STEPS
        while max(i, j) < end:
            size = min(2 * size, end - max(i, j), MOST)
            differ = symbols[i : i + size] != symbols[j : j + size]
            here = int(differ.argmax())
            if differ[here]:
                i += here
                break
            i, j = i + size, j + size
        total[k] = i - a[k]
    return total


def common_prefixes(symbols: np.ndarray, order: np.ndarray, level: Level | None, begins: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """For each suffix in order the number of first symbols that it shares with the one before; 0 where that is below `least`.

    Where the symbols before both suffixes are the same, the suffixes from there are neighbours too, and share one more. So only those where they differ are compared.
    """
    n = len(order)
    pairs = np.flatnonzero(ends[order[1:]] == ends[order[:-1]]) + 1
    if level:  # leaves few pairs
        pairs = pairs[level.same(order[pairs], order[pairs - 1])]
    a, b = order[pairs], order[pairs - 1]
    follows = (a > begins[a]) & (b > begins[b]) & (symbols[a - 1] == symbols[b - 1])
    shared, head = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    lead, a = a[~follows], a[follows]
    shared[lead] = lengthened(symbols, lead, b[~follows], ends, level.size if level else 0)
    head[lead] = lead
    head = np.maximum.accumulate(head)
    shared[a] = shared[head[a]] - (a - head[a])
    shared[shared < least] = 0
    return shared[order]


def maximal_repeats(symbols: np.ndarray, order: np.ndarray, shared: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """First place in the text, length and times (3 rows) of the longest-common-prefix intervals before whose suffixes not always the same character stands."""
    before = np.where(order > begins[order], symbols[np.maximum(order - 1, 0)], -1 - order)  # none is like no other
    changes = np.cumsum(np.concatenate([[False], before[1:] != before[:-1]])[: len(order)])
    some = np.flatnonzero(shared)
    # numbers side by side: low ends, lengths and first places of open intervals; low ends, high ends, lengths and first places of closed ones
    lows, sizes, firsts, found, last = array("q"), array("q"), array("q"), array("q"), -2

    def close(high: int, length: int) -> tuple[int, int | None]:
        """Ends the intervals that share more than `length`; the low end and first place of the last one ended, if any."""
        low, least = high, None
        while sizes and sizes[-1] > length:
            low, least = lows.pop(), firsts.pop()
            found.extend((low, high, sizes.pop(), least))
            if sizes and least < firsts[-1]:
                firsts[-1] = least
        return low, least

    for part in range(0, len(some), MOST):
        ats = some[part : part + MOST]
        for at, length, here, there in zip(ats.tolist(), shared[ats].tolist(), order[ats].tolist(), order[ats - 1].tolist(), strict=True):
            if at != last + 1:  # nothing is shared in between
                close(last, 0)
            low, least = close(at - 1, length)
            if not sizes or sizes[-1] < length:
                lows.append(low)
                sizes.append(length)
                firsts.append(there if least is None else least)
            if here < firsts[-1]:
                firsts[-1] = here
            last = at
    close(last, 0)
    low, high, length, first = np.frombuffer(found, dtype=np.int64).reshape(-1, 4).T
    diverse = changes[high] > changes[low]
    return np.stack([first, length, high - low + 1])[:, diverse]


def union(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n places lies in one of the spans."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def by_row(values: np.ndarray, counts: np.ndarray, how: np.ufunc = np.add) -> np.ndarray:
    out = np.zeros(len(counts), dtype=np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = how.reduceat(values, (np.cumsum(counts) - counts)[some])
    return out


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def repeated_windows(number: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where a run of WINDOW words begins that its text has twice or more. number: each word's number among the distinct ones."""
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(number))
    at = at[at + WINDOW <= np.repeat(np.cumsum(counts), counts)]
    if not len(at):
        return at
    key = row[at].astype(np.uint64) * ODD[WINDOW]
    for k in range(WINDOW):
        key += number[at + k].astype(np.uint64) * ODD[k]
    key ^= key >> np.uint64(31)
    sorted_keys = np.sort(key)
    twice = sorted_keys[1:][sorted_keys[1:] == sorted_keys[:-1]]
    if not len(twice):
        return twice.astype(np.int64)
    at = at[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
    parts = [row[at], *[number[at + k] for k in range(WINDOW)]]  # what has an equal key is compared in full
    order = np.lexsort(parts)
    equal = np.logical_and.reduce([p[order][1:] == p[order][:-1] for p in parts])
    return np.sort(at[order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])]])


def characters(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all rows one after another, and each row's number of them."""
    counts = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(text)], pa.int32()), text), "")[0].as_py() if len(text) else ""
    return np.frombuffer(whole.encode("utf-32-le"), dtype="<u4"), counts


def measure(text: pa.Array, min_chars: int = MIN_CHARS) -> dict[str, np.ndarray]:
    """The features of a batch of texts, their maximal repeats (text, first place, length, times), and which characters lie in repeats."""
    text = pc.fill_null(text, "")
    words, n_words = split_words(text)
    points, counts = characters(text)
    n = len(points)
    is_word = ~np.isin(points, SPACE)
    held = np.zeros(int(points.max(initial=0)) + 1, dtype=bool)
    held[points] = True
    symbols = np.cumsum(held, dtype=np.int32)[points] if n else np.zeros(0, dtype=np.int32)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)  # a batch of strings has less than 2 ** 31 bytes
    ends, begins = (np.repeat(x.astype(np.int32), counts) for x in (np.cumsum(counts), np.cumsum(counts) - counts))
    order, level = suffix_array(symbols, row, ends, min_chars) if n else (np.zeros(0, dtype=np.int64), None)
    shared = common_prefixes(symbols, order, level, begins, ends, min_chars)
    length = np.zeros(n, dtype=np.int64)
    length[order] = np.maximum(shared, np.concatenate([shared[1:], [0]])[:n])
    first, size, times = maximal_repeats(symbols, order, shared, begins)
    some = np.flatnonzero(length)
    covered = union(some, length[some], n)
    windows = repeated_windows(coded(words)[0], n_words)
    return {
        "n_words": n_words,
        "word_chars": by_row(is_word.astype(np.int64), counts),
        "n_symbols": pc.count_substring_regex(text, f"[{SYMBOLS}]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in text.to_pylist()], dtype=np.int64),
        "n_repeat_words": by_row(union(windows, np.full(len(windows), WINDOW), len(words)).astype(np.int64), n_words),
        "covered_chars": by_row((covered & is_word).astype(np.int64), counts),
        "longest_repeat": by_row(length, counts, np.maximum),
        "n_repeats": np.bincount(row[first], minlength=len(counts)).astype(np.int64),
        "repeats": (row[first], first - begins[first], size, times),
        "covered": covered,
        "counts": counts,
    }


def verdict(m: dict[str, np.ndarray], max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept."""
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    return failed, ~failed & (m["covered_chars"] <= max_covered * m["word_chars"]) & (m["longest_repeat"] <= max_longest)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat", "n_repeats")


def apply_rules(docs: DataFrame, min_chars: int = MIN_CHARS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Every document's features and verdict."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", *COLUMNS)] + [("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=MOST):
            m = measure(batch.column("text"), min_chars)
            failed, kept = verdict(m, max_covered, max_longest)
            yield table(schema, doc_id=batch.column("doc_id"), base_failed=failed, kept=kept, **{c: m[c] for c in COLUMNS})

    return id_and_text(docs).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", *COLUMNS)) + ", base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, min_chars: int = MIN_CHARS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The rows that the rules keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=MOST):
            yield batch.filter(pa.array(verdict(measure(batch.column("text"), min_chars), max_covered, max_longest)[1]))

    return docs.mapInArrow(run, docs.schema)


def repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, first_char (where it first stands), n_chars and times of every maximal repeat."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "first_char", "n_chars", "times")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=MOST):
            row, first, size, times = measure(batch.column("text"), min_chars)["repeats"]
            yield table(schema, doc_id=batch.column("doc_id").take(pa.array(row)), first_char=first, n_chars=size, times=times)

    return id_and_text(docs).mapInArrow(run, "doc_id long, first_char long, n_chars long, times long")


def repeated_spans(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The union of all repeats: doc_id, first_char and n_chars of each span that isn't interrupted."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "first_char", "n_chars")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=MOST):
            m = measure(batch.column("text"), min_chars)
            counts, covered = m["counts"], m["covered"].astype(np.int64)
            row, begin = np.repeat(np.arange(len(counts)), counts), np.repeat(np.cumsum(counts) - counts, counts)
            at = np.arange(len(row))
            opens = (covered == 1) & ((at == begin) | (np.concatenate([[0], covered])[: len(row)] == 0))
            starts = np.flatnonzero(opens)
            sizes = np.bincount(np.cumsum(opens)[covered == 1] - 1, minlength=len(starts))
            yield table(schema, doc_id=batch.column("doc_id").take(pa.array(row[starts])), first_char=(at - begin)[starts], n_chars=sizes)

    return id_and_text(docs).where(F.col("text") != "").mapInArrow(run, "doc_id long, first_char long, n_chars long")
