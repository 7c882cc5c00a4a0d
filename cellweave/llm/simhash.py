"""Near duplicates by SimHash, candidates by pigeonring filtering.

A 64-bit fingerprint is a ring of four 16-bit segments. If two differ in at most d = 3 bits, then from some segment on, chains of 1, 2, 3
and 4 consecutive segments differ in at most 1, 2, 3 and 4 quarters of d: in 0, 1, 2 and 3 bits. So fingerprints meet in an
equi-join on two consecutive segments, of which the first is equal and the second differs in one bit or none: one side states its own
two segments for each of the four starts, the other all 17 values that the chain allows. The third segment prunes what met by
chance, before the full Hamming check, which is the chain of four.

Only distinct fingerprints are joined; copies join by equality of the fingerprint, however
many there are. Large groups of near copies would meet in all pairs: so each fingerprint is first linked to one in each of its own four buckets, what that
joins is one group, and only fingerprints of different groups meet after that. Components are found by alternating large-star and
small-star rounds on the links, written out each round.

Spark sizes a table by its files, without the rows that an explode adds, so joins of rings would be broadcasts that the driver can't hold: they merge by hint, as do all
joins of tables that grow with the fingerprints.

Null texts count as empty; texts without words have fingerprint zero and are linked like any other. Texts are read whole, however long. Rows without doc_id
are linked like others, and component_id is null where no row of a component has one. Equal rows, and rows that share a doc_id, each
have a row in the result. An empty table gives an empty result. Other columns, whatever their names, are not read by `groups`; `keep_one` returns them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import even_join, id_and_text, one_of_each, slices, table, written
from cellweave.operators.graph import components

SHINGLE, SEED, DISTANCE, SEGMENTS, BITS = 3, 42, 3, 4, 16
BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(words: list[bytes]) -> int:
    """Each bit is 1 if it is set in over half of the hashes of all shingles."""
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)], dtype="<u8").view(np.uint8).reshape(-1, 8)
    if n < 64:
        ones = np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(hashes[:, k], minlength=256) @ BIT_OF_BYTE for k in range(8)])
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text) and fp, the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = pc.ascii_lower(batch.column("text")).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(WORD.findall(t)) for t in text], dtype=np.uint64)
            yield table(schema, doc_id=batch.column("doc_id"), t=batch.column("t"), fp=found.view(np.int64))

    return id_and_text(docs).withColumn("t", F.xxhash64("text")).mapInArrow(run, "doc_id long, t long, fp long")


def turned(fp: Column, by: int) -> Column:
    """The ring read from segment `by` on."""
    return fp if not by else F.shiftleft(fp, by * BITS).bitwiseOR(F.shiftrightunsigned(fp, 64 - by * BITS))


def rings_of(distinct: DataFrame) -> DataFrame:
    """id, group, and for each of the four starts k the ring from there on and its first two segments (head)."""
    starts = F.array(*[F.struct(F.lit(k).alias("k"), turned(F.col("fp"), k).alias("ring")) for k in range(SEGMENTS)])
    return distinct.select("id", "group", F.explode(starts).alias("s")).select("id", "group", "s.k", "s.ring", F.shiftrightunsigned("s.ring", BITS * SEGMENTS // 2).alias("head"))


def star_links(distinct: DataFrame) -> DataFrame:
    """Links of fingerprints (id, fp, each fp once) to one in each of their buckets: never more than four for each, however large the buckets."""
    rings = rings_of(distinct.withColumn("group", F.col("id")))
    first = rings.groupBy("k", "head").agg(F.min(F.struct("id", "ring")).alias("m"), F.count("*").alias("held")).where("held > 1")
    met = rings.join(first.hint("merge"), ["k", "head"]).where(F.col("id") > F.col("m.id"))
    return met.where(F.bit_count(F.col("ring").bitwiseXOR(F.col("m.ring"))) <= DISTANCE).select(F.col("m.id").alias("a"), F.col("id").alias("b")).distinct()


def links(distinct: DataFrame) -> DataFrame:
    """Pairs a < b of ids in different groups whose fingerprints differ in DISTANCE bits or fewer. distinct: id, fp and group, each fp once.

    A fingerprint first meets the groups that a bucket holds, then the fingerprints of the other groups; those of one group never meet.
    """
    rings = rings_of(distinct)
    flips = F.array(*[F.lit(0).cast("long"), *[F.lit(1 << j).cast("long") for j in range(BITS)]])
    asks = rings.select(F.col("id").alias("a"), F.col("group").alias("group_a"), "k", F.col("ring").alias("ring_a"), F.explode(F.transform(flips, lambda x: F.col("head").bitwiseXOR(x))).alias("head"))
    others = asks.join(rings.select("k", "head", "group").distinct().hint("merge"), ["k", "head"]).where("group_a != group")
    met = others.join(rings.select(F.col("id").alias("b"), "group", "k", F.col("ring").alias("ring_b"), "head").hint("merge"), ["k", "head", "group"]).where("a < b")
    differ = F.col("ring_a").bitwiseXOR(F.col("ring_b"))
    three = F.bit_count(F.shiftrightunsigned(differ, BITS)) * SEGMENTS <= 3 * DISTANCE
    return met.where(three).where(F.bit_count(differ) <= DISTANCE).select("a", "b").distinct()


def near_groups(distinct: DataFrame) -> DataFrame:
    """fp and group of distinct fingerprints: a group is all that links join, named by one of them."""
    first = components(star_links(distinct.select(F.col("fp").alias("id"), "fp"))).withColumnRenamed("component", "group")
    known = distinct.select("fp").join(first, F.col("fp") == F.col("id"), "left").select("fp", F.coalesce("group", "fp").alias("group"))
    known = written(known, "grouped-fingerprints")
    of = lambda c, g: known.select(F.col("fp").alias(c), F.col("group").alias(g)).hint("merge")
    between = links(known.withColumn("id", F.col("fp"))).join(of("a", "x"), "a").join(of("b", "y"), "b")
    last = components(between.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("id", "group")
    return known.join(last, "group", "left").select("fp", F.coalesce("component", "group").alias("group"))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, t, fp, group and component_id, the smallest doc_id of the group (null where none has one), of every document."""
    marked = written(fingerprints(docs), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "distinct-fingerprints")
    of_fp = written(distinct.hint("merge").join(near_groups(distinct), "fp"), "groups")
    least = of_fp.groupBy("group").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    of_fp = even_join(of_fp.withColumnRenamed("n", "rows"), least, "group", of_fp.count()).select("fp", "group", "component_id", F.col("rows").alias("n"))
    return even_join(marked, of_fp, "fp", marked.count())


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every document."""
    return grouped(docs).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns."""
    return one_of_each(docs, written(grouped(docs).select("doc_id", "t", "group"), "grouped"))


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


