"""Best-fit packing of token sequences by exact-complement hashing.

Only the lengths decide where a piece goes, and there are no more lengths than the capacity. So one histogram
(capacity + 1 counts) is planned on the driver, and the pieces take their places by their rank among
those of their length; neither texts nor pieces pass through the driver.

1. Each piece gets a rank among the pieces of its length that its task wrote; counts by (task, length) turn it into one
   over all tasks. No task sorts or gathers a whole length, however many pieces have it.
2. `plan` fills sequences. For each length, longest first, an index of sums of one, two and three lengths gives what
   exactly fills the gap; as many sequences as the availability counts allow take that combination at once.
   What has no exact complement goes by best fit, again many at a time.
3. Ranges of ranks carry sequence numbers and offsets; each piece finds its range by binary search.

Null texts count as empty; an empty text still has its end id, so no piece is empty. Equal rows, rows without doc_id and rows that share one are packed each on
their own. Texts are read whole, however long. Of several combinations that fill a gap the one with the longest lengths is taken; which piece of a length goes
where depends on the order of rows. An empty table gives an empty result. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import id_and_text, slices, table, written
from cellweave.llm.tokens import word_bpe

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, task_rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Ranks are below this; lengths above it in one 64-bit key.
RANKS = 1 << 44


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row for each piece: its place in its document, length, checksum and rank in its task; written, so that ranks stay."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("task_rank", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, library = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), word_bpe(tokenizer)
        for batch in slices(batches):
            ids, counts = library.encode(batch.column("text"))
            sizes = counts + 1
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            begin = (np.cumsum(counts) - counts)[row] + start
            whole, end = ids.astype("<u4"), np.array([end_id], dtype="<u4").tobytes()
            crc = [zlib.crc32(end, zlib.crc32(whole[b : b + n - 1])) if last else zlib.crc32(whole[b : b + n]) for b, n, last in zip(begin.tolist(), length.tolist(), (piece == pieces[row] - 1).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            count = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(row), dtype=np.int64)
            rank[order] = np.arange(len(row)) - (np.cumsum(count) - count)[length[order]]
            yield table(schema, doc_id=batch.column("doc_id").take(pa.array(row)), piece=piece, start=start, length=length, ids_crc32=crc, task=np.full(len(row), task), task_rank=rank + seen[length])
            seen += count

    return written(id_and_text(docs).mapInArrow(run, PIECES), "pieces")


def index_sums(have: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each sum up to the capacity is one of two lengths that are there, and of three. A sum is its own hash."""
    one = (have > 0).astype(np.float64)
    two = np.convolve(one, one)[: capacity + 1] > 0.5
    return two, np.convolve(two.astype(np.float64), one)[: capacity + 1] > 0.5


def complement(have: np.ndarray, length: int, gap: int, pairs: np.ndarray, triples: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three lengths that sum to the gap and are there beside one of `length`; the longest first. pairs, triples: index_sums of these lengths or more."""
    spare = have.copy()
    spare[length] -= 1
    if spare[gap] > 0:
        return (gap,)

    def two(total: int, spare: np.ndarray) -> tuple[int, int] | None:
        a = np.arange(total - 1, (total - 1) // 2, -1)
        fits = np.flatnonzero((spare[a] > 0) & (spare[total - a] > (a == total - a)))
        return (int(a[fits[0]]), int(total - a[fits[0]])) if len(fits) else None

    if pairs[gap] and (found := two(gap, spare)):
        return found
    if not triples[gap]:
        return None
    first = np.flatnonzero(spare[: max(gap - 1, 0)])
    for a in first[pairs[gap - first] & (first > 0)][::-1].tolist():
        spare[a] -= 1
        found = two(gap - a, spare)
        spare[a] += 1
        if found:
            return (a, *found)
    return None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """What each kind of sequence holds, as (length, times) in order, and how many sequences are of that kind."""
    have, kinds, open_kinds = counts.astype(np.int64).copy(), [], {}
    if have[capacity]:
        kinds.append(([(capacity, 1)], int(have[capacity])))
        have[capacity] = 0
    pairs = triples = None
    left = -1
    for length in range(capacity - 1, 0, -1):
        while have[length]:
            there = int((have > 0).sum())
            if pairs is None or there < left - 16:  # the index may name sums that are gone, never miss one
                (pairs, triples), left = index_sums(have, capacity), there
            found = complement(have, length, capacity - length, pairs, triples)
            if found is None:
                break
            lengths, times = np.unique([length, *found], return_counts=True)
            many = int((have[lengths] // times).min())
            have[lengths] -= many * times
            kinds.append(([(int(a), int(n)) for a, n in zip(lengths[::-1], times[::-1], strict=True)], many))
    for length in range(capacity - 1, 0, -1):
        while have[length]:
            gap = min((g for g in open_kinds if g >= length), default=None)
            if gap is None:
                gap = capacity
                open_kinds[gap] = [([], -(-int(have[length]) // (capacity // length)))]
            held, many = open_kinds[gap].pop()
            each = min(gap // length, int(have[length]))
            full = min(many, int(have[length]) // each)
            if many > full:
                open_kinds[gap].append((held, many - full))
            if not open_kinds[gap]:
                del open_kinds[gap]
            open_kinds.setdefault(gap - each * length, []).append(([*held, (length, each)], full))
            have[length] -= each * full
    return kinds + [x for group in open_kinds.values() for x in group if x[0]]


def places(kinds: list[tuple[list[tuple[int, int]], int]], capacity: int) -> dict[str, np.ndarray]:
    """For ranges of ranks of a length: the first key, the first sequence, pieces of that length in a sequence, and the first offset."""
    used, rows, sequence = np.zeros(capacity + 1, dtype=np.int64), [], 0
    for held, many in kinds:
        offset = 0
        for length, times in held:
            rows.append((length * RANKS + used[length], sequence, times, offset))
            used[length] += times * many
            offset += length * times
        sequence += many
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4).T
    return dict(zip(("key", "sequence", "times", "offset"), columns, strict=True))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """All documents' pieces with the sequence and offset that each got."""
    spark = docs.sparkSession
    pieces = cut_pieces(docs, tokenizer, capacity, end_id)
    counted = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counted = written(counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counted.groupBy("length").agg(F.sum("n")).collect():  # a row for each length
        counts[length] = n
    ranges = spark.sparkContext.broadcast(places(plan(counts, capacity), capacity))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((x, pa.int64()) for x in ("start", "length", "ids_crc32", "sequence_id", "offset"))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranges.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(r["key"], length * RANKS + rank, side="right") - 1
            nth = length * RANKS + rank - r["key"][at]
            yield table(schema, **{c: b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}, sequence_id=r["sequence"][at] + nth // r["times"][at], offset=r["offset"][at] + nth % r["times"][at] * length)

    # as many rows as tasks have lengths: more than should be broadcast where tasks are many; no task wrote more pieces of a length than it has
    ranked = pieces.join(counted.select("task", "length", "before").hint("merge"), ["task", "length"])
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("task_rank") + F.col("before")).alias("rank")).mapInArrow(place, PLACED)
