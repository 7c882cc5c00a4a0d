"""Repair of conversation structure by the cheapest edits.

Rows of a conversation are taken by turn (nulls first), rows of one turn by role and then text. A row's first fault counts: blank, duplicate (role and text seen
earlier) or truncated. Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (blank and duplicate rows must go), Insert an empty user or assistant row 5; a truncated
row that stays adds 5. What is left must have role initials (s?(ua)+)?. Of the cheapest lists of edits the one whose initials come first in ASCII order is taken.

The lattice has a node for each number of rows read and each state of that pattern. Bidirectional Dijkstra searches it: a forward and a reverse heap, the nearer of
both going on, until their tops together cost more than the best crossing; so all crossings of least cost are seen, and the least audit made of a prefix
and a suffix is taken. A node's label is its least cost and, of those, least audit: audits of one node and one cost never begin with one another, so the least prefixes and
suffixes make the least whole. Keeping costs nothing, so of equal costs the forward heap takes early rows first and the reverse heap late ones.

No conversation needs to fit in a task: rows are dealt by ranges of conversation and turn, and cut into pieces of BLOCK rows; a piece is searched from each state to
each, and the pieces of a conversation are chained. Only the repaired text's digest needs all rows of a conversation in order: they stream through, sorted, and nothing but
the audit is held. Equal rows are counted before they move, and duplicates are found by partial minima.

A null counts as one space: in the checksum, as a role and as a text. A null conv_id is a conversation of its own. A role's initial is its first
character; an empty role has none, so such a row can't be kept. Conversations of which no row is left have zeros, an empty audit and the digest of the empty string. Texts are
read whole, however long; an empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import even_join, slices, table, written

SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States of (s?(ua)+)?: nothing yet, after s, after u, after a. It may end in ENDS.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
BACK = tuple([(p, c) for p, steps in enumerate(NEXT) for c, r in steps.items() if r == q] for q in range(4))
ENDS = (0, 3)
BLOCK = 256
DROP, EMPTY, STRIP, REPEAT, AS_USER, OF = 0, 1, 2, 3, 4, 20
ORDER = ("c", "has_turn", "turn0", "role", "text")
#: A row as the search sees it: the initial of its role, '' if it must be deleted, and what it costs beside the edit if it stays.
Row = tuple[str, int]
Label = tuple[int, str]


def cheapest(rows: list[Row], start: int, ends: Iterable[int]) -> Label | None:
    """Cost and audit of the cheapest edits that lead from a state to one of others; None if none do."""
    n = len(rows)
    settled: tuple[dict, dict] = ({}, {})
    seen: tuple[dict, dict] = ({(0, start): (0, "")}, {(n, q): (0, "") for q in ends})
    heaps = ([(0, 0, start)], [(0, -n, q) for q in ends])
    best: Label | None = (0, "") if n == 0 and start in ends else None

    def ahead(i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
        for c in "ua":
            if c in NEXT[q]:
                yield i, NEXT[q][c], INSERT, "I"
        if i < n:
            initial, more = rows[i]
            yield i + 1, q, DELETE, "D"
            if initial:
                if initial in NEXT[q]:
                    yield i + 1, NEXT[q][initial], more, "K"
                for c in "ua":
                    if c in NEXT[q]:
                        yield i + 1, NEXT[q][c], REROLE + more, "R"

    def behind(i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
        for p, c in BACK[q]:
            if c in ROLES:
                yield i, p, INSERT, "I"
        if i:
            initial, more = rows[i - 1]
            yield i - 1, q, DELETE, "D"
            if initial:
                for p, c in BACK[q]:
                    if c == initial:
                        yield i - 1, p, more, "K"
                    if c in ROLES:
                        yield i - 1, p, REROLE + more, "R"

    while True:
        for side in (0, 1):
            while heaps[side] and (abs(heaps[side][0][1]), heaps[side][0][2]) in settled[side]:
                heapq.heappop(heaps[side])
        if not heaps[0] or not heaps[1]:  # one side has seen all there is, and met the other wherever it could
            return best
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            return best
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, i, q = heapq.heappop(heaps[side])
        at = (abs(i), q)
        cost, audit = settled[side][at] = seen[side][at]
        for j, r, price, letter in ahead(*at) if side == 0 else behind(*at):
            to = (j, r)
            label = (cost + price, audit + letter if side == 0 else letter + audit)
            if to in settled[1 - side]:
                rest = settled[1 - side][to]
                whole = (label[0] + rest[0], label[1] + rest[1] if side == 0 else rest[1] + label[1])
                best = whole if best is None else min(best, whole)
            if to not in settled[side] and (to not in seen[side] or label < seen[side][to]):
                seen[side][to] = label
                heapq.heappush(heaps[side], (label[0], j if side == 0 else -j, r))


def damaged(conversations: DataFrame) -> DataFrame:
    """c (a key for conv_id), has_turn and turn0 (for the order), role, text and m, how many equal rows there are, after the stated damage."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(key_of(F.col("conv_id")).alias("c"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % OF).alias("h")).where(F.col("h") != DROP)
    text = F.when(F.col("h") == EMPTY, "").when(F.col("h") == STRIP, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == AS_USER, ROLES["u"]).otherwise(F.col("role"))
    rows = rows.select("c", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn0"), role.alias("role"), text.alias("text"), F.when(F.col("h") == REPEAT, 2).otherwise(1).alias("m"))
    return rows.groupBy(*ORDER).agg(F.sum("m").alias("m"))


def key_of(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def with_faults(rows: DataFrame) -> DataFrame:
    """rows with n_blank, n_duplicate and n_truncated of the m equal rows, and `kept`, whether the first of them may stay."""
    each = rows.withColumn("digest", F.sha2("text", 256))
    place = F.struct("has_turn", "turn0")
    first = each.groupBy("c", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    each = even_join(each, first, ["c", "role", "digest"], rows.count())
    tail = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    blank, own = tail == "", F.col("first") == place
    kept = ~blank & own
    count = lambda when, what: F.when(when, what).otherwise(0).cast("long")
    return each.select(*ORDER, "m", count(blank, F.col("m")).alias("n_blank"), count(~blank, F.col("m") - F.when(own, 1).otherwise(0)).alias("n_duplicate"), count(kept & ~tail.isin(".", "!", "?"), F.lit(1)).alias("n_truncated"), kept.alias("kept"))


def pieces(rows: DataFrame) -> DataFrame:
    """c, piece (ascending), illegal, first and last (initials) and moves (q, r, cost, audit): the cheapest edits from state to state, of each piece of a conversation."""
    move = pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    schema = pa.schema([("c", pa.string()), ("piece", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("moves", pa.list_(move))])

    def piece_of(c: str, number: int, run: list[tuple[str, Row]], whole: bool) -> tuple:
        initials = [x for x, _ in run]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        found = [(q, r, x) for q in ((0,) if whole else range(4)) for r in ((ENDS[-1],) if whole else range(4)) for x in [cheapest([row for _, row in run], q, ENDS if whole else (r,))] if x]
        return c, number, illegal, initials[0], initials[-1], [{"q": q, "r": r, "cost": x[0], "audit": x[1]} for q, r, x in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, c, held, outer, out = TaskContext.get().partitionId() << 32, None, [], True, []
        columns = lambda: {f.name: list(x) for f, x in zip(schema, zip(*out, strict=True), strict=True)}
        for batch in batches:
            for key, initial, m, kept, truncated in zip(*(batch.column(x).to_pylist() for x in ("c", "initial", "m", "kept", "n_truncated")), strict=True):
                if key != c:
                    if held:  # the first and the last conversation of a task may go on in others
                        out.append(piece_of(c, number, held, not outer))
                        outer, number, held = False, number + 1, []
                    elif c is not None:
                        outer = False
                    c = key
                for k in range(m):
                    held.append((initial, ((initial or " ") if kept and k == 0 else "", TRUNCATED * truncated)))
                    if len(held) == BLOCK:
                        out.append(piece_of(c, number, held, False))
                        number, held, outer = number + 1, [], True
            if len(out) >= 1000:
                yield table(schema, **columns())
                out = []
        if held:
            out.append(piece_of(c, number, held, False))
        if out:
            yield table(schema, **columns())

    some = rows.select(*ORDER, F.substring("role", 1, 1).alias("initial"), "m", "kept", "n_truncated")
    some = some.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("c", "initial", "m", "kept", "n_truncated")
    return some.mapInArrow(run, "c string, piece long, illegal long, first string, last string, moves array<struct<q:int,r:int,cost:long,audit:string>>")


def chained(parts: DataFrame) -> DataFrame:
    """c, illegal, cost and audit of whole conversations."""
    schema = pa.schema([("c", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, illegal, last, labels, out = None, 0, None, {}, []

        def end() -> None:
            if c is not None:
                out.append((c, illegal, *min(labels[q] for q in ENDS if q in labels)))

        for batch in slices(batches, "c", 1 << 14):
            for x in batch.to_pylist():
                if x["c"] != c:
                    end()
                    c, illegal, last, labels = x["c"], 0, None, {0: (0, "")}
                illegal += x["illegal"] + (last is not None and last + x["first"] not in ("su", "ua", "au"))
                last, after = x["last"], {}
                for y in x["moves"]:
                    if y["q"] in labels:
                        cost, audit = labels[y["q"]]
                        new = (cost + y["cost"], audit + y["audit"])
                        after[y["r"]] = min(after.get(y["r"], new), new)
                labels = after
            if len(out) >= 1000:
                yield table(schema, **{f.name: list(v) for f, v in zip(schema, zip(*out, strict=True), strict=True)})
                out.clear()
        end()
        if out:
            yield table(schema, **{f.name: list(v) for f, v in zip(schema, zip(*out, strict=True), strict=True)})

    return parts.repartition("c").sortWithinPartitions("c", "piece").mapInArrow(run, "c string, illegal long, cost long, audit string")


class Repaired:
    """The rows that an audit leaves of a conversation, as they come in."""

    def __init__(self, audit: str):
        self.audit, self.place, self.state, self.some, self.digest = audit, 0, 0, False, hashlib.sha256()

    def add(self, initial: str, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
        self.some, self.state = True, NEXT[self.state][initial]

    def inserted(self) -> None:
        while self.audit[self.place : self.place + 1] == "I":
            due = "a" if self.state == 2 else "u"
            self.add(due, ROLES[due], "")
            self.place += 1

    def read(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.audit[self.place]
        self.place += 1
        if letter == "K":
            self.add(role[:1], role, text)
        elif letter == "R":
            due = "a" if self.state == 2 else "u"
            self.add(due, ROLES[due], text)


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """c and repaired_sha256, the digest of the repaired rows as role:text, joined by newlines."""
    schema = pa.schema([("c", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, now, out = None, None, []

        def end() -> None:
            if now:
                now.inserted()
                out.append((c, now.digest.hexdigest()))

        for batch in slices(batches):
            for key, is_row, role, text, m in zip(*(batch.column(x).to_pylist() for x in ("c", "is_row", "role", "text", "m")), strict=True):
                if not is_row:
                    end()
                    c, now = key, Repaired(text)
                else:
                    for _ in range(m):
                        now.read(role, text)
            if len(out) >= 1000:
                yield table(schema, c=[x for x, _ in out], repaired_sha256=[x for _, x in out])
                out.clear()
        end()
        yield table(schema, c=[x for x, _ in out], repaired_sha256=[x for _, x in out])

    first = audits.select("c", F.lit(False).alias("has_turn"), F.lit(0).cast("long").alias("turn0"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("m"), F.lit(False).alias("is_row"))
    both = first.unionByName(rows.select(*ORDER, "m", F.lit(True).alias("is_row")))
    both = both.repartition("c").sortWithinPartitions("c", "is_row", *ORDER[1:])
    return both.select("c", "is_row", "role", "text", "m").mapInArrow(run, "c string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    rows = written(with_faults(written(damaged(conversations), "damaged-rows")), "rows-with-faults")
    audits = written(chained(written(pieces(rows), "conversation-pieces")), "audits")
    faults = rows.groupBy("c").agg(*[F.sum(f"n_{x}").alias(x) for x in ("blank", "duplicate", "truncated")])
    turns = rows.where("has_turn").groupBy("c", "turn0").agg(F.lit(1).alias("one")).groupBy("c").agg((F.max("turn0") - F.min("turn0") + 1 - F.count("*")).alias("gaps"))
    ids = conversations.select("conv_id", key_of(F.col("conv_id")).alias("c")).distinct()
    found = ids.join(faults, "c", "left").join(turns, "c", "left").join(audits, "c", "left").join(digests(rows, audits), "c", "left")
    zeros = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
