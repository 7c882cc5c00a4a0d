"""Toxicity grades by cumulative-link ordinal regression.

P(grade >= k) = 1 / (1 + exp(theta_k - w.x)): one weight vector w shared by all ordered thresholds theta_1 < ... < theta_K, over
sparse features of a text: its lower-cased words and their beginnings of 4, 5 and 6 characters, as log(1 + count). The expected severity is the sum of these probabilities; a document is toxic if P(grade >= 1) >= 0.5.

Labels only say toxic or not. Toxic training rows are graded 1 to K by how much evidence is in them: the number of words
that have a feature with strong log-odds for toxic, cut at its quantiles.

Training reads a bounded sample: the `sample` labelled documents of each class that come first by a hash of doc_id. Features are counted on
executors, where near copies count once (one document for each smallest hash of its 3-word shingles, under three orders); the at most `n_features` with the largest likelihood ratio, from LEAST_GAIN on, are kept, and the driver fits their weights on
at most 2 * sample sparse rows. Scoring covers every word of every text, where the text was read.

Null and empty texts score by the thresholds alone (not toxic); texts are read whole, however long. Repeated rows get equal scores, and rows without doc_id
or with a shared one theirs; of labels that share a doc_id one is used for each class. Features with equal likelihood ratios are taken in the order of
their names. An empty table gives an empty result. Where no labelled document of one of the classes is found there is nothing to learn from: every text gets
grade 0. Where too few labels make any feature certain, all rows get the training rows' mean severity. Other columns, whatever their names, pass through `keep_clean` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import coded, id_and_text, slices, split_words, table
from cellweave.llm.training import labelled

BEGINNINGS = (4, 5, 6)
MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_"
#: A feature stands in so many training documents at least, and its likelihood ratio is so high that a hundred thousand features bring about none by chance.
LEAST_DOCS, LEAST_GAIN = 4, 10.0
GRADES, SAMPLE, N_FEATURES, STRONG = 3, 4000, 4096, 3.0
#: A threshold that no text reaches.
NEVER = 60.0


def word_features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """Each row's number of words, each word's number among the distinct ones, and for these one array of features a kind (null: none)."""
    words, counts = split_words(pc.utf8_lower(pc.fill_null(text, "")))
    number, distinct = coded(words)
    bare = pc.utf8_trim(distinct, MARKS)
    size = pc.utf8_length(bare)
    kinds = [pc.if_else(pc.greater(size, 0), pc.binary_join_element_wise("w", bare, ":"), None)]
    for n in BEGINNINGS:
        kinds.append(pc.if_else(pc.greater_equal(size, n), pc.binary_join_element_wise(str(n), pc.utf8_slice_codeunits(bare, 0, n), ":"), None))
    return counts, number, kinds


def pairs(counts: np.ndarray, number: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) for features of distinct words (words x kinds, -1: none)."""
    rows, found = np.repeat(np.arange(len(counts)), counts), []
    width = int(of_word.max(initial=0)) + 1
    for kind in range(of_word.shape[1]):
        feature = of_word[:, kind][number]
        has = feature >= 0
        found.append(rows[has] * width + feature[has])
    keys, times = np.unique(np.concatenate(found), return_counts=True)
    return keys // width, keys % width, times


@dataclass
class Model:
    names: pa.Array
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= k) for each row and k, and each row's number of words."""
        counts, number, kinds = word_features(text)
        row, feature, times = pairs(counts, number, self.index(kinds))
        x = np.bincount(row, self.weights[feature] * np.log1p(times), minlength=len(counts))
        return 1 / (1 + np.exp(np.clip(self.thresholds - x[:, None], -60, 60))), counts

    def index(self, kinds: list[pa.Array]) -> np.ndarray:
        return np.stack([pc.fill_null(pc.index_in(k, self.names), -1).to_numpy(zero_copy_only=False) for k in kinds], axis=1).astype(np.int64)


def select_features(sample: DataFrame, n_features: int, sizes: tuple[int, int]) -> tuple[pa.Array, np.ndarray]:
    """The features that tell most, and which of them are strong evidence for label 1."""
    schema = pa.schema([("feature", pa.string()), ("label", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            label = batch.column("label").to_numpy(zero_copy_only=False)
            counts, number, kinds = word_features(batch.column("text"))
            for kind in kinds:
                of_word, names = coded(kind)
                of_word = np.nan_to_num(of_word, nan=-1).astype(np.int64)
                row, feature, _ = pairs(counts, number, of_word[:, None])
                key, n = np.unique(feature * 2 + label[row], return_counts=True)
                yield table(schema, feature=names.take(pa.array(key // 2)), label=(key % 2).astype(np.int32), n=n)

    count = lambda v: F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(f"n{v}")
    counted = sample.mapInArrow(run, "feature string, label int, n long").groupBy("feature").agg(count(0), count(1)).where(F.col("n0") + F.col("n1") >= LEAST_DOCS)
    # the count of documents alone, per class, gives the ratio; its largest are found without gathering the rest
    n0, n1 = sizes
    p, q, r = (F.col("n0") + F.col("n1")) / (n0 + n1), F.col("n1") / n1, F.col("n0") / n0
    term = lambda k, x, y: F.when(k > 0, k * F.log(x / y)).otherwise(0.0)
    gain = term(F.col("n1"), q, p) + term(n1 - F.col("n1"), 1 - q, 1 - p) + term(F.col("n0"), r, p) + term(n0 - F.col("n0"), 1 - r, 1 - p)
    best = counted.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "feature").limit(n_features).toPandas()
    a, b = best.n1.to_numpy(), best.n0.to_numpy()
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    return pa.array(best.feature, pa.string()), odds > STRONG


def fit(rows: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int = GRADES, l2: float = 1e-4, steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the likelihood of the grades (0..n_grades), by Adam over all rows; thresholds as a first one and positive gaps."""
    n = len(grades)
    free = np.concatenate([np.zeros(n_features), [1.0], np.zeros(n_grades - 1)])
    mean, square = np.zeros_like(free), np.zeros_like(free)

    def thresholds(f: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([[f[n_features]], np.exp(f[n_features + 1 :])]))

    for step in range(1, steps + 1):
        theta = thresholds(free)
        x = np.bincount(rows, free[features] * values, minlength=n)
        p = 1 / (1 + np.exp(np.clip(theta - x[:, None], -60, 60)))
        padded = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        chance = np.maximum(padded[at, grades] - padded[at, grades + 1], 1e-12)
        slope = padded * (1 - padded)
        upper, lower = slope[at, grades] / chance, slope[at, grades + 1] / chance
        by_x = upper - lower
        by_theta = np.zeros((n, n_grades + 2))
        by_theta[at, grades] -= upper
        by_theta[at, grades + 1] += lower
        by_theta = by_theta[:, 1:-1].sum(axis=0)
        gaps = np.cumsum(by_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(features, by_x[rows] * values, minlength=n_features) / n - l2 * free[:n_features], [gaps[0] / n], gaps[1:] * np.exp(free[n_features + 1 :]) / n])
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        free = free + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return free[:n_features], thresholds(free)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_features: int = N_FEATURES, grades: int = GRADES) -> Model:
    chosen = labelled(docs, labels, "toxic", sample).persist()
    try:
        sizes = dict(chosen.groupBy("label").count().collect())
        if set(sizes) != {0, 1}:
            return Model(pa.array([], pa.string()), np.zeros(0), np.full(grades, NEVER))
        names, strong = select_features(chosen, n_features, (sizes[0], sizes[1]))
        strong = np.append(strong, False)  # for words without a feature
        model = Model(names, np.zeros(len(names)), np.zeros(grades))
        schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("evidence", pa.int64()), ("features", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                counts, number, kinds = word_features(batch.column("text"))
                of_word = model.index(kinds)
                evident = strong[of_word].any(axis=1)[number]
                row, feature, times = pairs(counts, number, of_word)
                cuts = pa.array(np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (feature, times)]
                evidence = np.bincount(np.repeat(np.arange(len(counts)), counts), evident, minlength=len(counts)).astype(np.int64)
                yield table(schema, doc_id=batch.column("doc_id"), label=batch.column("label"), evidence=evidence, features=lists[0], times=lists[1])

        held = chosen.mapInArrow(run, "doc_id long, label int, evidence long, features array<int>, times array<int>").toPandas().sort_values("doc_id")
    finally:
        chosen.unpersist()
    evidence, toxic = held.evidence.to_numpy(), held.label.to_numpy() == 1
    cuts = np.quantile(evidence[toxic], np.arange(1, grades) / grades)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, evidence, side="right"), 0)
    rows = np.repeat(np.arange(len(held)), held.features.map(len).to_numpy())
    features, times = (np.concatenate([*column, np.zeros(0)]) for column in (held.features, held.times))
    weights, thresholds = fit(rows, features.astype(np.int64), np.log1p(times), grade, len(names), grades)
    return Model(names, weights, thresholds)


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_words, P(grade >= k) for each k, expected_severity, grade (the most probable) and toxic for every document."""
    k = len(model.thresholds)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), *((f"p_{i + 1}", pa.float64()) for i in range(k)), ("expected_severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p, counts = shared.value.score(batch.column("text"))
            each = np.concatenate([np.ones((len(p), 1)), p], axis=1) - np.concatenate([p, np.zeros((len(p), 1))], axis=1)
            yield table(schema, doc_id=batch.column("doc_id"), n_words=counts, **{f"p_{i + 1}": p[:, i] for i in range(k)}, expected_severity=p.sum(axis=1), grade=each.argmax(axis=1).astype(np.int32), toxic=p[:, 0] >= 0.5)

    return id_and_text(docs).mapInArrow(run, f"doc_id long, n_words long, {', '.join(f'p_{i + 1} double' for i in range(k))}, expected_severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that aren't toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(shared.value.score(batch.column("text"))[0][:, 0] < 0.5))

    return docs.mapInArrow(run, docs.schema)
