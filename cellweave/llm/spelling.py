"""Spelling variants: words one edit apart, found by pivotal grams, and the frequent form each one leads to.

Bigrams have one order for all words, rare ones first. A word's prefix are its first three bigrams in that order (and all others equal to the third); its
pivots are two bigrams of these that don't overlap, chosen by dynamic programming so that the fewest words have them. One edit spoils one pivot at most. Of two words one edit apart take the one
whose prefix ends first in the order: a pivot that the edit leaves alone is a bigram of the other word, and comes early enough to be in its prefix. So pivots are
joined with prefixes, and an edit's place bounds positions:

* before both pivots: the other word has both, as far from its end, and all from the first pivot on is equal;
* after both: both are as far from its start, and all up to the second pivot's end is equal;
* between them: all up to the first pivot's end and all from the second pivot on is equal;
* within a pivot: the other pivot is there, and all but the edited code point is equal.

Each case is one equi-join key of a word's pivots, its prefix and the lengths, so what meets shares nearly all of its text; what meets is verified exactly. Words with
more than TIES bigrams in the prefix ("aaaaaaaa") have every code point tried as the edited one instead, which is as exact.

Words are counted by partial sums, so a frequent word is no load; keys are 64-bit hashes that say nothing of frequency. The bigrams' counts (at most 90 * 90, as there
are so many lower-cased letters) are all that the driver gets. A null or empty text has no words; a null doc_id counts as empty text in `damaged`; equal rows and rows that
share a doc_id count like any others; a run may be as long as its text, its keys grow in proportion. An empty table gives an empty result. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import slices, table, written

LEAST_LENGTH, LEAST_COUNT, TIMES, DAMAGE = 7, 2, 10, 31
RUN = rf"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"
#: A prefix has so many bigrams, and at most TIES with those equal to the last one.
PREFIX, TIES = 3, 8
BEFORE, AFTER, BETWEEN, HOLE, WHOLE = range(1, 6)
#: Fixed odd multipliers of the hashes.
BASE, SPREAD, MIX = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9))
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def damaged(doc_id: Column, run: Column) -> Column:
    """A run, without one code point for one in DAMAGE by a checksum of doc_id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (h % F.length(run)).cast("int")
    return F.when(h % DAMAGE == 0, F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, damage: bool = True) -> DataFrame:
    """word, n of all lower-cased runs (A-Z only) of LEAST_LENGTH letters or more that occur LEAST_COUNT times or more."""
    runs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    words = runs.select((damaged(F.col("doc_id"), F.col("run")) if damage else F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def gram_ranks(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The order of all bigrams (by their two Latin-1 bytes), and how many places have each."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    weight = np.zeros(1 << 16, dtype=np.int64)
    for gram, n in grams.collect():  # bounded by the letters
        a, b = gram.encode("latin-1")
        weight[a << 8 | b] = n
    rank = np.empty(1 << 16, dtype=np.int32)
    rank[np.lexsort((np.arange(1 << 16), weight))] = np.arange(1 << 16)
    return rank, weight


def two_pivots(places: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ascending bigram places, the two that don't overlap and weigh the least in sum: best[k] is the lightest of the first k."""
    rows, k = places.shape
    best, best_at = weights[:, 0].copy(), places[:, 0].copy()
    best_of, at_of = [best.copy()], [best_at.copy()]  # after each bigram
    total, first, second = np.full(rows, np.iinfo(np.int64).max), places[:, 0].copy(), places[:, -1].copy()
    for i in range(1, k):
        for j in range(i - 1, -1, -1):  # j: the last bigram that this one may follow
            fits = (places[:, i] - places[:, j] >= 2) & ((places[:, i] - places[:, j + 1] < 2) if j + 1 < i else True)
            both = best_of[j] + weights[:, i]
            better = fits & (both < total)
            total[better], first[better], second[better] = both[better], at_of[j][better], places[better, i]
        lighter = weights[:, i] < best
        best[lighter], best_at[lighter] = weights[lighter, i], places[lighter, i]
        best_of.append(best.copy())
        at_of.append(best_at.copy())
    return first, second


def mixed(tag: int, length: np.ndarray, *parts: np.ndarray) -> np.ndarray:
    out = (length.astype(np.uint64) * np.uint64(8) + np.uint64(tag)) * MIX
    for x in parts:
        out = (out ^ (out >> np.uint64(29)) ^ x) * SPREAD
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def ranges(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0, 1, .. below each length, one after another, and whose they are."""
    whose = np.repeat(np.arange(len(lengths)), lengths)
    return np.arange(len(whose)) - np.repeat(np.cumsum(lengths) - lengths, lengths), whose


class Keys:
    """The keys of a batch of words as parts (key, word number): `index` what a word is found by, `asked` what it asks for."""

    def __init__(self, words: list[str], rank: np.ndarray, weight: np.ndarray):
        self.length = length = np.array([len(w) for w in words], dtype=np.int64)
        self.start = np.cumsum(length) - length
        self.end = self.start + length
        text = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(text), BASE)]))
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(text), INVERSE)]))
        letter = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * SPREAD
        letter = (letter ^ (letter >> np.uint64(31))) * MIX
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(letter[text] * self.power[:-1])])
        # bigrams by word, order and place
        place, whose = ranges(length - 1)
        at = self.start[whose] + place
        code = text[at].astype(np.int64) << 8 | text[at + 1]
        order = np.lexsort((place, rank[code], whose))
        own = np.cumsum(length - 1) - (length - 1)
        three = order[own[:, None] + np.arange(PREFIX)]
        self.last = rank[code[three[:, -1]]]
        early = rank[code] <= self.last[whose]
        self.wide = np.bincount(whose[early], minlength=len(words)) > TIES
        three.sort(axis=1)
        self.first, self.second = two_pivots(place[three], weight[code[three]])
        kept = early & ~self.wide[whose]
        self.place, self.whose = place[kept], whose[kept]

    def part(self, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the code points a to b of words w."""
        a, b = self.start[w] + a, self.start[w] + b
        return (self.sums[b] - self.sums[a]) * self.back[a]

    def hole(self, w: np.ndarray, x: np.ndarray, after: int, length: np.ndarray) -> np.ndarray:
        return mixed(HOLE, length, self.part(w, 0 * x, x), self.part(w, x + after, self.length[w]))

    def before(self, w: np.ndarray, i: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mixed(BEFORE, length, self.part(w, i, self.length[w]))

    def after(self, w: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mixed(AFTER, length, self.part(w, 0 * j, j + 2))

    def between(self, w: np.ndarray, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mixed(BETWEEN, length, self.part(w, 0 * i, i + 2), self.part(w, j, self.length[w]))

    def index(self) -> list[tuple[np.ndarray, np.ndarray]]:
        w, p, n = self.whose, self.place, self.length
        words = np.arange(len(n))
        low, high = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), -1)
        np.minimum.at(low, w, p)
        np.maximum.at(high, w, p)
        x, of = ranges(n)
        out = [(self.hole(of, x, 1, n[of]), of), (mixed(WHOLE, n, self.part(words, 0 * n, n)), words)]
        some = p + 2 <= high[w]
        out.append((self.before(w[some], p[some], n[w[some]]), w[some]))
        some = p >= low[w] + 2
        out.append((self.after(w[some], p[some], n[w[some]]), w[some]))
        for d in range(1, min(TIES, len(w))):
            a, b = np.arange(len(w) - d), np.arange(d, len(w))
            some = (w[a] == w[b]) & (p[b] - p[a] >= 2)
            out.append((self.between(w[a][some], p[a][some], p[b][some], n[w[a][some]]), w[a][some]))
        return out

    def asked(self) -> list[tuple[np.ndarray, np.ndarray]]:
        n, out = self.length, []
        w = np.flatnonzero(~self.wide)
        a, b = self.first[w], self.second[w]
        for more in (-1, 0, 1):
            out += [(self.before(w, a, n[w] + more), w), (self.after(w, b, n[w] + more), w), (self.between(w, a, b, n[w] + more), w)]
        all_x, all_w = ranges(np.where(self.wide, n, 0))
        x, of = np.concatenate([a, a + 1, b, b + 1, all_x]), np.concatenate([w, w, w, w, all_w])
        out.append((self.hole(of, x, 1, n[of]), of))  # replaced
        less = self.part(of, 0 * x, x) + self.power[x] * self.part(of, x + 1, n[of])
        out.append((mixed(WHOLE, n[of] - 1, less), of))  # deleted
        all_x, all_w = ranges(np.where(self.wide, n + 1, 0))
        x, of = np.concatenate([a + 1, b + 1, all_x]), np.concatenate([w, w, all_w])
        out.append((self.hole(of, x, 0, n[of] + 1), of))  # inserted
        return out


def keys(words: DataFrame, rank: np.ndarray, weight: np.ndarray, asking: bool) -> DataFrame:
    """key, id, last (where the word's prefix ends) and wide of words (id, word)."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("last", pa.int32()), ("wide", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 1 << 18):
            with np.errstate(over="ignore"):
                held = Keys(batch.column("word").to_pylist(), rank, weight)
                parts = held.asked() if asking else held.index()
            key, w = (np.concatenate(x) for x in zip(*parts, strict=True))
            ids = batch.column("id").to_numpy()
            for i in range(0, len(key), 1 << 17):
                some = w[i : i + (1 << 17)]
                yield table(schema, key=key[i : i + (1 << 17)], id=ids[some], last=held.last[some], wide=held.wide[some])

    return words.select("id", "word").mapInArrow(run, "key long, id long, last int, wide boolean")


def candidates(words: DataFrame) -> DataFrame:
    """Pairs a < b of ids that share a key."""
    rank, weight = gram_ranks(words)
    asks, held = keys(words, rank, weight, True).alias("x"), keys(words, rank, weight, False).alias("y")
    first = F.col("x.wide") | (F.struct("x.last", "x.id") < F.struct("y.last", "y.id"))
    met = asks.join(held, F.col("x.key") == F.col("y.key")).where((F.col("x.id") != F.col("y.id")) & first)
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def near_pairs(words: DataFrame) -> DataFrame:
    """a, word_a, n_a, b, word_b, n_b of all words (id, word, n) one edit apart, each pair once."""
    of = lambda s: words.select(F.col("id").alias(s), F.col("word").alias(f"word_{s}"), F.col("n").alias(f"n_{s}"))
    both = candidates(words).join(of("a"), "a").join(of("b"), "b")
    return both.where(F.levenshtein("word_a", "word_b", 1) == 1)


def roots(forms: DataFrame, most: int) -> DataFrame:
    """id, root of ids with a form (id, form_id), by doubling: each form is TIMES as frequent, so chains are short where the most frequent word occurs `most` times."""
    found = written(forms.select("id", F.col("form_id").alias("root")), "spelling-roots")
    depth = max(1, math.ceil(math.log(max(most, 1), TIMES)))
    for _ in range(math.ceil(math.log2(depth))):
        further = found.select(F.col("id").alias("root"), F.col("root").alias("next"))
        found = written(found.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return found


def variants(docs: DataFrame, damage: bool = True) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (see word_counts)."""
    words = written(word_counts(docs, damage).withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = written(near_pairs(words), "near-words")
    side = lambda x, y: pairs.select(F.col(x).alias("id"), F.col(f"n_{x}").alias("n"), F.struct((-F.col(f"n_{y}")).alias("m"), F.col(f"word_{y}").alias("form"), F.col(y).alias("form_id")).alias("other"))
    each = side("a", "b").unionAll(side("b", "a")).groupBy("id").agg(F.count("*").alias("n_near"), F.min("other").alias("best"), F.first("n").alias("own"))
    is_form = -F.col("best.m") >= TIMES * F.col("own")
    best = written(each.select("id", "n_near", *[F.when(is_form, v).alias(c) for c, v in (("form", F.col("best.form")), ("form_id", F.col("best.form_id")), ("form_n", -F.col("best.m")))]), "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    end = roots(best.where("form_id is not null"), most).join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    out = words.join(best, "id", "left").join(end, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def oracle_sql() -> str:
    """The same in DuckDB: checksums by bits, and words that share what is left without one code point. form_n is a double, as frames hold whole numbers beside nulls."""
    code = f"(SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {0xEDB88320}) ELSE c >> 1 END)))"
    return f"""WITH crc AS (SELECT {code} AS steps),
        runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
        hashed AS (SELECT run, n, xor(list_reduce([{0xFFFFFFFF}] || list_transform(range(1, octet_length(encode(d || ':' || run)) * 2, 2), lambda i: ('0x' || substr(hex(encode(d || ':' || run)), i, 2))::BIGINT), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), {0xFFFFFFFF}) AS h FROM runs, crc WHERE length(run) >= {LEAST_LENGTH}),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed) WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
        less AS (SELECT word, n, unnest(list_transform(range(0, length(word) + 1), lambda i: {{'i': i, 'v': CASE WHEN i = 0 THEN word ELSE substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) END}}), recursive := true) FROM words),
        near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.v = b.v AND a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
        best AS (SELECT word, n, count(*) AS n_near, min({{'m': -other_n, 'w': other}}) AS b FROM near GROUP BY word, n),
        forms AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= {TIMES} * words.n THEN b.w END AS form, CASE WHEN -b.m >= {TIMES} * words.n THEN (-b.m)::DOUBLE END AS form_n FROM words LEFT JOIN best ON words.word = best.word),
        {', '.join(f"r{k} AS (SELECT x.word, coalesce(y.form, x.root) AS root FROM {'(SELECT word, coalesce(form, word) AS root FROM forms)' if k == 0 else f'r{k - 1}'} x LEFT JOIN forms y ON x.root = y.word)" for k in range(12))}
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN r11 USING (word)"""
