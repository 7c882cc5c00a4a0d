"""Quality scores by a factorisation machine.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over hashed words (log counts, scaled to length 1), structure
statistics and text-length metadata (each cut into steps, one feature a step). All pairwise interactions are of rank `RANK`, and their sum is taken
in linear time by the sum-of-squares identity: half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, summed over the factors.

Training reads a bounded sample: up to `sample` labelled documents of each class, of which near copies count once, weighted back to the
classes' shares among all labels. Labels, lang, source and doc_id are never inputs. Documents whose crc32(doc_id as text) mod 4 is 2 are
held out of training. Scoring covers every word of every text, where the text was read.

Null and empty texts have a score like any other, from the steps of their statistics; texts are read whole, however long. Repeated rows get equal scores, and
rows without doc_id (not held out) or with a shared one theirs; of labels that share a doc_id one is used for each class. An empty table gives an empty
result. Where no labelled document of one of the classes is found, every text gets the share of label 1 among the labels (each class counted once
more), 0.5 without labels. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import coded, id_and_text, slices, split_words, table
from cellweave.llm.training import labelled

BUCKETS, STEPS, RANK, SAMPLE, THRESHOLD = 1 << 15, 32, 8, 3000, 0.7
#: Shares of a text, each 0 to 1, then sizes.
SHARES = ("upper", "digit", "symbol", "other_mark", "line_end", "beyond_ascii", "distinct_words", "same_word_again", "repeated_lines", "words_with_symbols")
SIZES = ("n_words", "word_length", "line_words", "n_chars")
STATISTICS = SHARES + SIZES
CLASS_OF_BYTE = np.zeros((6, 256), dtype=bool)
for i, held in enumerate((range(65, 91), range(48, 58), b"#*$%&|<>{}[]\\^~=_+@", b".,;:!?\"'()-", b"\n", range(128, 256))):
    CLASS_OF_BYTE[i, list(held)] = True


def shares_of_bytes(text: pa.Array) -> np.ndarray:
    """For each text and class of bytes the share of its bytes."""
    text = text.cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    size = np.maximum(np.diff(offsets), 1)
    found = [np.diff(np.concatenate([[0], np.cumsum(of[data])])[offsets - offsets[0]]) / size for of in CLASS_OF_BYTE]
    return np.stack(found, axis=1)


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of everything that isn't 0; rows ascending."""
    text = pc.fill_null(text, "")
    n = len(text)
    words, counts = split_words(pc.utf8_lower(text))
    number, distinct = coded(words)
    row = np.repeat(np.arange(n), counts)
    hashed = np.array([xxhash.xxh64_intdigest(w) % BUCKETS for w in distinct.cast(pa.binary()).to_pylist()], dtype=np.int64)
    keys, times = np.unique(row * BUCKETS + hashed[number], return_counts=True)
    rows, found, values = keys // BUCKETS, keys % BUCKETS, np.log1p(times)
    values = values / np.sqrt(np.maximum(np.bincount(rows, values**2, minlength=n), 1e-12))[rows]

    some = np.maximum(counts, 1)
    again = np.concatenate([[False], (number[1:] == number[:-1]) & (row[1:] == row[:-1])])[: len(row)]
    different = np.bincount(np.unique(row * (len(distinct) + 1) + number) // (len(distinct) + 1), minlength=n)
    marked = pc.match_substring_regex(distinct, r"[#*$%&|<>]").to_numpy(zero_copy_only=False)[number]
    lines = [[x for x in t.split("\n") if x.strip()] for t in text.to_pylist()]
    n_lines = np.maximum([len(x) for x in lines], 1)
    repeated = np.array([len(x) - len(set(x)) for x in lines]) / n_lines
    chars = pc.utf8_length(text).to_numpy(zero_copy_only=False)
    shares = np.column_stack([shares_of_bytes(text), different / some, np.bincount(row, again, minlength=n) / some, repeated, np.bincount(row, marked, minlength=n) / some])
    sizes = np.column_stack([counts, chars / some, counts / n_lines, chars])
    steps = np.concatenate([np.sqrt(shares) * (STEPS - 1), 2 * np.log2(1 + sizes)], axis=1).astype(np.int64).clip(0, STEPS - 1)
    wide = len(STATISTICS)
    rows = np.concatenate([rows, np.repeat(np.arange(n), wide)])
    found = np.concatenate([found, (BUCKETS + np.arange(wide) * STEPS + steps).ravel()])
    values = np.concatenate([values, np.full(n * wide, 1 / np.sqrt(wide))])
    order = np.argsort(rows, kind="stable")
    return rows[order], found[order], values[order]


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, found: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The score before the sigmoid, and each row's sum of v_i x_i. Every row has features."""
        scaled = self.factors[found] * values[:, None]
        first = np.searchsorted(rows, np.arange(n))
        sums = np.add.reduceat(scaled, first, axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), first)
        return self.bias + np.bincount(rows, self.weights[found] * values, minlength=n) + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def score(self, text: pa.Array) -> np.ndarray:
        if not len(text):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.raw(*features(text), len(text))[0], -40, 40)))


def fit(rows: np.ndarray, found: np.ndarray, values: np.ndarray, label: np.ndarray, weight: np.ndarray, epochs: int = 10, batch: int = 128, rate: float = 0.1, l2: float = 2e-4) -> Model:
    """Logistic loss by Adagrad over batches in a fixed random order."""
    draw = np.random.default_rng(0)
    size = BUCKETS + len(STATISTICS) * STEPS
    model = Model(0.0, np.zeros(size), draw.normal(0, 0.05, (size, RANK)))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    first = np.searchsorted(rows, np.arange(len(label) + 1))
    for _ in range(epochs):
        order = draw.permutation(len(label))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = first[chosen + 1] - first[chosen]
            r = np.repeat(np.arange(len(chosen)), sizes)
            take = np.repeat(first[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(r))
            f, x = found[take], values[take]
            raw, sums = model.raw(r, f, x, len(chosen))
            slope = weight[chosen] * (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - label[chosen]) / len(chosen)
            some, where = np.unique(f, return_inverse=True)
            by_w = np.bincount(where, slope[r] * x, minlength=len(some)) + l2 * model.weights[some] / len(order)
            each = slope[r, None] * x[:, None] * (sums[r] - model.factors[f] * x[:, None])
            by_v = np.stack([np.bincount(where, each[:, k], minlength=len(some)) for k in range(RANK)], axis=1) + l2 * model.factors[some] / len(order)
            seen_w[some] += by_w**2
            seen_v[some] += by_v**2
            seen_b += slope.sum() ** 2
            model.weights[some] -= rate * by_w / np.sqrt(seen_w[some])
            model.factors[some] -= rate * 0.5 * by_v / np.sqrt(seen_v[some])
            model.bias -= rate * slope.sum() / np.sqrt(seen_b)
    return model


def constant(share: float) -> Model:
    """Scores every text with the share of label 1."""
    size = BUCKETS + len(STATISTICS) * STEPS
    return Model(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, RANK)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    usable = labels.where(~held_out(F.col("doc_id"))).where("quality in (0, 1)")
    shares = {0: 0, 1: 0} | dict(usable.groupBy("quality").count().collect())
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, found, values = features(batch.column("text"))
            cuts = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield table(schema, doc_id=batch.column("doc_id"), label=batch.column("label"), features=pa.ListArray.from_arrays(cuts, pa.array(found.astype(np.int32))), x=pa.ListArray.from_arrays(cuts, pa.array(values)))

    held = labelled(docs, usable, "quality", sample).mapInArrow(run, "doc_id long, label int, features array<int>, x array<double>").toPandas().sort_values("doc_id")
    label = held.label.to_numpy().astype(float)
    if len(set(label)) < 2:
        return constant((shares[1] + 1) / (shares[0] + shares[1] + 2))
    weight = np.where(label == 1, shares[1] / max((label == 1).sum(), 1), shares[0] / max((label == 0).sum(), 1))
    rows = np.repeat(np.arange(len(held)), held.features.map(len).to_numpy())
    return fit(rows, np.concatenate([*held.features]).astype(np.int64), np.concatenate([*held.x]), label, weight / weight.mean())


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = shared.value.score(batch.column("text"))
            yield table(schema, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=found, predicted=(found >= threshold).astype(np.int32))

    each = id_and_text(docs).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    return each.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
