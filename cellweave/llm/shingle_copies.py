"""Near copies by SimHash and by the exact similarity of their five-word shingles: pairs at ALIKE or more, and no others, are linked.

A text is the set of its five-word shingles (A-Z lower-cased; a shorter text is one shingle), as 64-bit hashes; equal sets are one from the start.

1. Sampled sets. Of a set of 64 * 2**k shingles or more, those whose hash ends in k zero bits are its sample (64 to 128 are expected; smaller sets are whole). Sets that could
   be alike across a boundary of k also have the next sample. A sample is random, so of s sampled shingles of one set, at least needed(s) are in
   any set that is alike, but for a chance of MISS: the same order of chance as that different shingles share a hash. So a set with fewer sampled shingles that any
   other set has is alone. Of what is left the whole sets are counted in the same way. That leaves near copies, and texts that mostly are passages of
   others; common passages in other texts bring nobody together.
2. SimHash. The SimHashes of what is left are linked by pigeonring filtering (`simhash`), and these links are verified on the sets.
3. SimHashes of sets that are 0.8 alike differ in about 10 of 64 bits, so these links are not all. Samples are ordered alike everywhere, rare shingles first;
   two samples with needed(s) shingles in common share one among the first s - needed(s) + 1 of each, and meet there. What meets is compared by sizes
   and samples, and then verified on the sets.

Large groups of copies would meet in all pairs. So before step 3 each set is also compared with two of each of its buckets: the one whose shingles are the most
common (an original has few of its own), and any one. What the verified links join is one group; the sets of different groups that a bucket holds are compared
in blocks. Pairs that sizes, samples and what others have of them allow are joined to neighbourhoods, whose whole sets are compared in blocks as well; two blocks make fewer rows than
they hold texts. So texts that are nearly, but not quite, alike can be many without a row for each pair.

Sets aren't stored: they are made again from the texts for those that are compared. Null texts count as empty; all texts without words are copies
of each other. Rows without doc_id, and rows that share one, are kept once a group like all others; equal rows are copies. Texts are read whole,
however long. An empty table gives an empty result. Other columns, whatever their names, are not read by `groups`; `keep_one` returns them.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm import simhash
from cellweave.llm.common import coded, even_join, id_and_text, merging, one_of_each, slices, split_words, table, written
from cellweave.operators.graph import components

SHINGLE = 5
#: Copies are alike in ALIKE[0] / ALIKE[1] of their shingles or more; whole numbers, as a limit must not be rounded.
ALIKE = (4, 5)
#: Sampled shingles at least, where a set has as many; the chance that a sample hides a link; up to FEW ids are broadcast.
LEAST, MISS, FEW = 64, 1e-12, 1 << 18
#: Samples larger than this need no more in common than one of this size. Samples in a block of a bucket, shingles of the whole sets in a block, and shingles compared at once.
MOST, SIDE, WHOLE, COLUMNS = 511, 1000, 1 << 20, 2048
#: Fixed odd multipliers: one for each place of a shingle, then those of the mixer.
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype="<u8")


def give_back() -> None:
    """Memory that this task has freed goes back to the system, as the worker process stays for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries do so by themselves
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which memory goes back to the system: what it still holds itself at its end is free by then."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidy


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * ODD[5]
    x = (x ^ (x >> np.uint64(27))) * ODD[6]
    return x ^ (x >> np.uint64(31))


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all rows one after another, each row's ascending, and each row's number of them."""
    words, counts = split_words(pc.ascii_lower(pc.fill_null(text, "")))
    number, distinct = coded(words)
    one = np.array([xxhash.xxh64_intdigest(w) for w in distinct.cast(pa.binary()).to_pylist()], dtype="<u8")[number]
    shingles = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    row = np.repeat(np.arange(len(counts)), shingles)
    start = (np.cumsum(counts) - counts)[row] + np.arange(len(row)) - (np.cumsum(shingles) - shingles)[row]
    end, total = np.cumsum(counts)[row], np.zeros(len(row), dtype="<u8")
    for k in range(SHINGLE):
        inside = start + k < end
        total += np.where(inside, one[np.minimum(start + k, max(len(one) - 1, 0))] * ODD[k], np.uint64(0)) if len(one) else np.uint64(0)
    hashes = mixed(total)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    first = np.concatenate([[True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])])[: len(row)]
    return hashes[first], np.bincount(row[first], minlength=len(counts)).astype(np.int64)


def by_row(values: np.ndarray, counts: np.ndarray, how: np.ufunc) -> np.ndarray:
    out = np.zeros(len(counts), dtype=values.dtype)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = how.reduceat(values, (np.cumsum(counts) - counts)[some])
    return out


def needed(s: int) -> int:
    """Of s random shingles of a set at least so many are in a set that is alike, but for a chance of MISS."""
    share, chance = ALIKE[0] / ALIKE[1], 0.0
    for q in range(s + 1):
        chance += math.comb(s, q) * share**q * (1 - share) ** (s - q)
        if chance >= MISS:
            return q
    return s


def simhashes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each row's SimHash: a bit is 1 if it is set in over half of its shingles."""
    out = np.zeros(len(counts), dtype="<u8")
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(ones * 2 > counts[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def shingled(docs: DataFrame) -> DataFrame:
    """row (a key), doc_id, t (hash of the text), the set's digest d0 and d1, its SimHash fp, its size, the level of its sample, how many of it and of the next one an alike set has at least (-1: has no next), and the sample."""
    longs = ("row", "doc_id", "t", "d0", "d1", "fp", "size", "level", "q", "next_q")
    enough_of = np.array([needed(k) for k in range(MOST + 1)])
    schema = pa.schema([*((c, pa.int64()) for c in longs), ("sample", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, most=1 << 19):
            hashes, counts = shingle_sets(batch.column("text"))
            d0, d1 = by_row(hashes, counts, np.add), by_row(mixed(hashes ^ ODD[0]), counts, np.add)
            level = np.floor(np.log2(np.maximum(counts, LEAST) / LEAST)).astype(np.int64)
            of = np.repeat(np.arange(len(counts)), counts)
            taken = hashes & ((np.uint64(1) << level.astype(np.uint64)) - np.uint64(1))[of] == 0
            s = np.bincount(of[taken], minlength=len(counts))
            deeper = hashes & ((np.uint64(2) << level.astype(np.uint64)) - np.uint64(1))[of] == 0
            q = np.where(level == 0, -(-s * ALIKE[0] // ALIKE[1]), enough_of[np.minimum(s, MOST)])
            # a set that is alike may have up to ALIKE[1] / ALIKE[0] times the shingles
            border = counts * ALIKE[1] >= (LEAST * ALIKE[0]) << (level + 1)
            next_q = np.where(border, enough_of[np.minimum(np.bincount(of[deeper], minlength=len(counts)), MOST)], -1)
            cuts = np.concatenate([[0], np.cumsum(s)])
            sample = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes[taken].view(np.int64)))
            rows = np.arange(row, row + len(counts))
            row += len(counts)
            yield table(schema, row=rows, doc_id=batch.column("doc_id"), t=batch.column("t"), d0=d0.view(np.int64), d1=d1.view(np.int64), fp=simhashes(hashes, counts).view(np.int64), size=counts, level=level, q=q, next_q=next_q, sample=sample)

    return id_and_text(docs).withColumn("t", F.xxhash64("text")).mapInArrow(giving_back(run), ", ".join(f"{c} long" for c in longs) + ", sample array<long>")


def enough(common: Column, a: Column, b: Column) -> Column:
    """Whether sets of a and b shingles with so many in common are alike."""
    return common * (ALIKE[0] + ALIKE[1]) >= (a + b) * ALIKE[0]


def samples(distinct: DataFrame) -> DataFrame:
    """who (twice the id, and 1 more for the next level), level, sample and q, how many of it an alike set has at least."""
    own = distinct.select((F.col("id") * 2).alias("who"), "level", "sample", "q")
    deeper = F.filter("sample", lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(2).cast("long"), F.col("level").cast("int")) - 1) == 0)
    more = distinct.where("next_q >= 0").select(F.col("id") * 2 + 1, F.col("level") + 1, deeper, "next_q")
    return own.unionAll(more).withColumn("s", F.size("sample")).where("s > 0")


def with_holders(rows: DataFrame) -> DataFrame:
    """rows (with a key) whose key others have too, with held, how many rows have it. Counts are partial sums, and rows of hot keys stay where they are."""
    counts = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return even_join(rows, counts.withColumn("held", F.col("n")), "key", total)


def buckets(each: DataFrame) -> DataFrame:
    """who, key (a sampled shingle at a level) and score of the first shingles, rare ones first, of those samples of which others have enough."""
    key = F.explode(F.transform("sample", lambda x: x.bitwiseXOR(F.call_function("shiftleft", F.col("level"), F.lit(58))))).alias("key")
    held = written(with_holders(each.select("who", key)), "shared-shingles")
    n = held.count()
    known = merging(held.groupBy("who").agg(F.count("*").alias("m"), F.sum("held").alias("sum")), n).join(each.select("who", "s", "q"), "who")
    left = known.where(F.col("m") >= F.greatest("q", F.lit(1))).select("who", (F.col("m") - F.greatest("q", F.lit(1)) + 1).alias("first"), (F.col("sum") / F.col("s")).alias("score"))
    some = merging(held, n).join(left, "who").withColumn("nth", F.row_number().over(Window.partitionBy("who").orderBy("held", "key")))  # a sample is small
    return written(some.where("nth <= first").select("who", "key", "score"), "first-shingles")


def with_both(pairs: DataFrame, each: DataFrame, column: str) -> DataFrame:
    """pairs (a, b) with a column of each (id, column) for both: x and y."""
    total = pairs.count()
    for side, name in (("b", "y"), ("a", "x")):
        right = each.select(F.col("id").alias(side), F.col(column).alias(name)).join(merging(pairs.groupBy(side).agg(F.count("*").alias("n")), total), side)
        pairs = even_join(pairs, right, side, total)
    return pairs


def sets_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """id and set (its shingles) of the rows asked for (id, doc_id, t), made from their texts."""
    schema = pa.schema([("id", pa.int64()), ("set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            hashes, counts = shingle_sets(batch.column("text"))
            sets = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(hashes.view(np.int64)))
            yield table(schema, id=batch.column("id"), set=sets)

    few = asked.count() <= FEW  # then the texts stay where they are
    asked = asked.select("id", F.col("doc_id").alias("asked_id"), F.col("t").alias("asked_t"))
    same = F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("t") == F.col("asked_t"))
    texts = id_and_text(docs).withColumn("t", F.xxhash64("text")).join(F.broadcast(asked) if few else asked.hint("merge"), same)
    return texts.select("id", "text").mapInArrow(giving_back(run), "id long, set array<long>").dropDuplicates(["id"])


def verified(pairs: DataFrame, distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs a, b of ids whose sets are alike."""
    sized = with_both(written(pairs.distinct(), "pairs"), distinct, "size").where(enough(F.least("x", "y"), F.col("x"), F.col("y")))
    pairs = written(sized.select("a", "b"), "pairs-of-like-sizes")
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    asked = written(distinct.select("id", "doc_id", "t").join(merging(ids, pairs.count()), "id", "left_semi"), "asked")
    both = with_both(pairs, written(sets_of(docs, asked), "sets-of-pairs"), "set")
    return written(both.where(enough(F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y"))).select("a", "b"), "links")


def by_simhash(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids that SimHash links join: those with one fingerprint, and those of linked fingerprints."""
    prints = written(distinct.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")), "distinct-fingerprints")
    same = even_join(distinct.select("id", "fp"), prints, "fp", distinct.count()).where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    stars = written(simhash.star_links(prints.select(F.col("first").alias("id"), "fp")), "simhash-stars")
    label = components(stars).withColumnRenamed("component", "group")
    known = prints.select(F.col("first").alias("id"), "fp").join(label, "id", "left").select("id", "fp", F.coalesce("group", "id").alias("group"))
    return same.unionAll(stars).unionAll(simhash.links(written(known, "grouped-fingerprints")))


def by_stars(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of samples: each with two of each of its buckets."""
    first = [F.max_by("who", F.struct("score", "who")), F.min_by("who", F.xxhash64("who"))]
    middle = shared.groupBy("key").agg(F.array_distinct(F.array(*first)).alias("middle"), F.count("*").alias("n"))
    met = even_join(shared.select("key", "who"), middle, "key", shared.count()).select("who", F.explode("middle").alias("m")).where("who != m")
    return met.select(F.least("who", "m").alias("a"), F.greatest("who", "m").alias("b"))


def with_shared(some: DataFrame, docs: DataFrame) -> DataFrame:
    """some with the column common: how many of a set's shingles other sets among them have; those of which too few are left out."""
    shingles = written(sets_of(docs, some.select("id", "doc_id", "t")).select("id", F.explode("set").alias("key")), "shingles-of-sets")
    counted = with_holders(shingles).groupBy("id").agg(F.count("*").alias("common"))
    # an alike set has ALIKE[0] / ALIKE[1] of the shingles at least
    return merging(some, some.count()).join(counted, "id").where(F.col("common") * ALIKE[1] >= F.col("size") * ALIKE[0])


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values each set on the left has in common with each on the right (rows of sets): products of matrices, a slice of the values at a time."""
    values, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    column = np.cumsum(held > 1) - 1
    row, column = row[held[place] > 1], column[place[held[place] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for a in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        x, y = np.searchsorted(column, (a, a + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        has[row[x:y], column[x:y] - a] = 1
        there = np.zeros(len(sets), dtype=bool)
        there[row[x:y]] = True
        i, j = np.flatnonzero(there[left]), np.flatnonzero(there[right])
        both[np.ix_(i, j)] += has[left[i]] @ has[right[j]].T
    return both


def tree(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a square table that join all that its links join; fewer than it has rows."""
    linked = linked | linked.T
    new, a, b = np.ones(len(linked), dtype=bool), [], []
    for start in np.flatnonzero(linked.any(axis=1)).tolist():
        if not new[start]:
            continue
        new[start], ahead = False, [start]
        while ahead:
            at = ahead.pop()
            found = np.flatnonzero(linked[at] & new)
            new[found] = False
            a += [at] * len(found)
            b += found.tolist()
            ahead += found.tolist()
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def in_blocks(rows: DataFrame, key: str, columns: list[str], which: Callable[[dict[str, np.ndarray], list[np.ndarray], np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Pairs (a, b) of ids that join what `which` links among the rows of a key, in blocks: key, blocks, id, the columns, and set. Each two blocks meet once.

    which(columns, sets, left, right) gives a table of links for rows on the left and right. Each two blocks make fewer pairs than they have rows, however many are linked.
    """
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    rows = rows.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", *columns, "set")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(held: list[pa.RecordBatch]) -> np.ndarray:
        part = pa.Table.from_batches(held)
        number = {c: part.column(c).to_numpy() for c in ("i", "j", "block", "id", *columns)}
        sets = [x.values.to_numpy() for x in part.column("set")]
        left, right = np.flatnonzero(number["block"] == number["i"][0]), np.flatnonzero(number["block"] == number["j"][0])
        linked = np.zeros((len(sets), len(sets)), dtype=bool)
        if len(left) and len(right):
            linked[np.ix_(left, right)] = which(number, sets, left, right)
        a, b = tree(linked)
        a, b = number["id"][a], number["id"][b]
        return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of one key and two blocks
        found, last = np.zeros((0, 2), dtype=np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in (key, "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if last is not None and tuple(marks[a]) != last:
                    found, held = np.concatenate([found, pairs(held)]), []
                last = tuple(marks[a])
                held.append(batch.slice(a, b - a))
            if len(found) > 1 << 16:
                found = np.unique(found, axis=0)  # keys have many pairs in common
            if len(found) > 1 << 16:
                yield table(schema, a=found[:, 0], b=found[:, 1])
                found = found[:0]
        if held:
            found = np.unique(np.concatenate([found, pairs(held)]), axis=0)
        yield table(schema, a=found[:, 0], b=found[:, 1])

    return rows.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j").mapInArrow(giving_back(run), "a long, b long").distinct()


def may_be_alike(number: dict[str, np.ndarray], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which sets of different groups are alike as far as sizes, what others have of them, and samples tell."""
    x, y = np.ix_(left, right)
    size, common = number["size"], number["common"]
    inner = np.minimum(np.minimum(size[x], size[y]), np.minimum(common[x], common[y]))
    could = (number["group"][x] != number["group"][y]) & (inner * (ALIKE[0] + ALIKE[1]) >= (size[x] + size[y]) * ALIKE[0])
    return could & (common_counts(sets, left, right) >= np.maximum(number["q"][x], number["q"][y])) if could.any() else could


def are_alike(number: dict[str, np.ndarray], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which whole sets of different groups are alike."""
    x, y = np.ix_(left, right)
    both = number["size"][x] + number["size"][y]
    could = (number["group"][x] != number["group"][y]) & (np.minimum(number["size"][x], number["size"][y]) * (ALIKE[0] + ALIKE[1]) >= both * ALIKE[0])
    return could & (common_counts(sets, left, right) * (ALIKE[0] + ALIKE[1]) >= both * ALIKE[0]) if could.any() else could


def between_groups(shared: DataFrame, members: DataFrame, some: DataFrame, each: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids in different groups that are alike, so many that they join all that are.

    A bucket is cut into blocks of about SIDE samples, and each two blocks are compared where they meet. What could be alike there, by sizes and samples, is joined to neighbourhoods;
    in each of them all whole sets are compared, again in blocks. So pairs that fail on the whole sets make no rows, however many there are.
    """
    total = shared.count()
    of = merging(shared.select("key", "who", F.floor(F.col("who") / 2).alias("id")), total).join(merging(members, total).join(some.select("id", "size", "common"), "id"), "id")
    mixed_keys = of.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("n"), F.max("common").alias("most"), F.min("size").alias("least")).where("low != high")
    mixed_keys = written(mixed_keys.where(F.col("most") * ALIKE[1] >= F.col("least") * ALIKE[0]).select("key", "n", F.ceil(F.col("n") / SIDE).cast("int").alias("blocks")), "mixed-buckets")
    met = mixed_keys.agg(F.sum("n")).first()[0] or 0
    rows = even_join(of, mixed_keys, "key", met).join(merging(each.select("who", "q", F.col("sample").alias("set")), total), "who")
    near = written(in_blocks(rows, "key", ["group", "size", "common", "q"], may_be_alike), "neighbours")
    if near.isEmpty():
        return near
    label = written(components(near), "neighbourhoods")
    sized = merging(label, total).join(some.select("id", "doc_id", "t", "size"), "id").join(merging(members, total), "id")
    blocks = F.greatest(F.ceil(F.count("*") / SIDE), F.ceil(F.sum("size") / WHOLE)).cast("int")
    counts = written(merging(label, total).join(some.select("id", "size"), "id").groupBy("component").agg(F.count("*").alias("n"), blocks.alias("blocks")), "blocks-of-neighbourhoods")
    sets = written(sets_of(docs, sized.select("id", "doc_id", "t")), "sets-of-neighbours")
    rows = even_join(sized.select("id", "component", "group", "size"), counts, "component", label.count()).join(merging(sets, total), "id")
    return written(in_blocks(rows, "component", ["group", "size"], are_alike), "links-between-groups")


def by_samples(pairs: DataFrame, each: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose samples (given as pairs of who) have enough in common."""
    both = with_both(written(pairs.distinct(), "met"), each.select(F.col("who").alias("id"), F.struct("sample", "q").alias("held")), "held")
    common = F.size(F.array_intersect("x.sample", "y.sample")) >= F.greatest("x.q", "y.q")
    return both.where(common).select(F.floor(F.col("a") / 2).alias("a"), F.floor(F.col("b") / 2).alias("b")).where("a != b")


def joined(members: DataFrame, links: DataFrame) -> DataFrame:
    """members (id, group) with the groups that links (a, b) of ids join."""
    if links.isEmpty():
        return members
    n = members.count()
    of = lambda c, g: merging(members.select(F.col("id").alias(c), F.col("group").alias(g)), n)
    between = links.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    label = components(between).withColumnRenamed("id", "group")
    return written(members.join(merging(label, n), "group", "left").select("id", F.coalesce("component", "group").alias("group")), "grouped")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, t and group of every row."""
    marked = written(shingled(docs), "shingle-samples")
    whole = F.min_by(F.struct("doc_id", "t", "fp", "size", "level"), "row").alias("m")
    distinct = marked.groupBy("d0", "d1").agg(F.min("row").alias("id"), F.count("*").alias("n"), whole)
    distinct = written(distinct.select("d0", "d1", "id", "n", "m.*"), "distinct-sets")
    n = distinct.count()
    each = samples(marked.select(F.col("row").alias("id"), "level", "sample", "q", "next_q").join(merging(distinct.select("id"), n), "id", "left_semi"))
    shared = buckets(each)
    left = shared.select(F.floor(F.col("who") / 2).alias("id")).distinct()
    some = written(with_shared(written(distinct.join(merging(left, n), "id", "left_semi"), "sets-with-neighbours"), docs), "sets-of-others")
    whose = some.select((F.col("id") * 2).alias("who")).unionAll(some.select(F.col("id") * 2 + 1))
    shared = written(shared.join(merging(whose, n), "who", "left_semi"), "shared-by-these")
    each = written(each.join(merging(shared.select("who").distinct(), n), "who", "left_semi"), "samples-with-neighbours")
    members = some.select("id", F.col("id").alias("group"))
    members = joined(members, verified(by_simhash(some).unionAll(by_samples(by_stars(shared), each)), some, docs))
    members = joined(members, between_groups(shared, members, some, each, docs))
    of_set = distinct.join(merging(members, n), "id", "left").select("d0", "d1", F.coalesce("group", "id").alias("group"), "n")
    return even_join(marked.select("doc_id", "t", "d0", "d1"), of_set, ["d0", "d1"], marked.count()).select("doc_id", "t", "group")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id and component_id, the smallest doc_id of its group (null where none has one), of every row."""
    found = written(grouped(docs), "groups")
    least = found.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    return even_join(found, least, "group", found.count()).select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group with all its columns: the one with the smallest doc_id, or any where none has one; of rows that share that doc_id, one."""
    return one_of_each(docs, written(grouped(docs), "groups"))
