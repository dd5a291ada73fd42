"""Quality grades by ordinal cumulative-link regression over hashed text features.

One weight vector is shared by all grades: f = w . x, and P(grade <= k) = sigmoid(threshold_k - f)
with ordered thresholds. The features of a text are its distinct words, the shares of its word
shapes (runs of letter case, digits and symbols), and how much of it repeats; all are hashed to
2**BITS slots, so the model's size is fixed. The fit uses a bounded sample of labelled documents;
scoring covers every document.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, gram_hashes, lower_ascii, read, utf8_slices, word_hashes

BITS = 18
#: At most so many labelled documents are fitted, those of smallest hash.
MAX_LABELED = 10_000
GRADES = 3
#: A document is selected if P(grade >= SELECT_GRADE) is at least SELECT_P.
SELECT_GRADE, SELECT_P = 2, 0.5

_BYTES = np.arange(256)
_SHAPE = np.where((_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128), 97, np.where((_BYTES >= 65) & (_BYTES <= 90), 65, np.where((_BYTES >= 48) & (_BYTES <= 57), 48, _BYTES))).astype(np.uint8)
_LETTERS = np.where((_SHAPE == 97) | (_SHAPE == 65) | (_SHAPE == 48), _BYTES, 32).astype(np.uint8)


def features(data: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(slot, value) of the features of UTF-8 bytes."""
    mask = np.uint64((1 << bits) - 1)
    words = np.unique(word_hashes(lower_ascii(_LETTERS[data])))
    classes = _SHAPE[data]
    changed = np.ones(len(classes), bool)
    changed[1:] = classes[1:] != classes[:-1]
    shapes, counts = np.unique(word_hashes(classes[changed]), return_counts=True)
    tokens = word_hashes(data)
    grams = gram_hashes(tokens, 3)
    repeats = int(10 * (1 - len(np.unique(grams)) / len(grams))) if len(grams) else 0
    length = min(20, int(np.log2(len(tokens) + 1)))
    with np.errstate(over="ignore"):
        slots = np.concatenate([words & mask, (shapes * np.uint64(3) + np.uint64(1)) & mask, (np.array([repeats + 1, 100 + length], np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & mask])
    values = np.concatenate([np.ones(len(words)), 5 * counts / max(1, counts.sum()), [2, 0.5]])
    return slots.astype(np.int32), values.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """weights (2**BITS float32) and ordered thresholds (grades - 1)."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) by score and k."""
        return _sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def likelihood(params: np.ndarray, grade: np.ndarray, row: np.ndarray, slot: np.ndarray, value: np.ndarray, grades: int, decay: float) -> tuple[float, np.ndarray]:
    """Mean log-likelihood less weight decay, and its gradient. `params`: a weight for each slot, the first threshold, log gaps between thresholds."""
    used, n = len(params) - grades + 1, len(grade)
    w, gaps = params[:used], np.exp(params[used + 1 :])
    theta = params[used] + np.concatenate([[0], np.cumsum(gaps)])
    f = np.bincount(row, value * w[slot], minlength=n)
    cdf = np.column_stack([np.zeros(n), _sigmoid(theta[None, :] - f[:, None]), np.ones(n)])
    at = np.arange(n)
    p = np.maximum(cdf[at, grade + 1] - cdf[at, grade], 1e-9)
    slope = cdf * (1 - cdf)
    by_f = -(slope[at, grade + 1] - slope[at, grade]) / p / n
    by_theta = np.array([np.where(grade == k, slope[:, k + 1], 0) - np.where(grade == k + 1, slope[:, k + 1], 0) for k in range(grades - 1)]) / p / n
    by_theta = by_theta.sum(axis=1)
    shrink = decay / max(1, used) ** 0.5
    gradient = np.concatenate([np.bincount(slot, value * by_f[row], minlength=used) - shrink * w, [by_theta.sum()], gaps * by_theta[::-1].cumsum()[::-1][1:]])
    return float(np.log(p).mean() - shrink * (w * w).sum() / 2), gradient


def fit(grade: np.ndarray, row: np.ndarray, slot: np.ndarray, value: np.ndarray, grades: int = GRADES, bits: int = BITS, steps: int = 300, rate: float = 0.1, decay: float = 1e-3, rare: int = 5, least_z: float = 4.5) -> Model:
    """Maximum likelihood with weight decay by full-batch Adam. Features in fewer than `rare` rows get no weight, nor do
    those whose rows' mean grade lies within `least_z` standard errors of the general mean. Without rows, or with one grade only, all documents pass."""
    if len(np.unique(grade)) < 2:
        return Model(np.zeros(1 << bits, np.float32), np.full(grades - 1, -30.0))
    seen = np.bincount(slot, minlength=1 << bits)
    apart = np.abs(np.bincount(slot, grade[row] - grade.mean(), minlength=1 << bits)) >= least_z * grade.std() * np.sqrt(seen)
    common = (apart & (seen >= rare))[slot]
    row, value = row[common], value[common].astype(np.float64)
    used, slot = np.unique(slot[common], return_inverse=True)
    share = np.clip(np.array([(grade <= k).mean() for k in range(grades - 1)]), 1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    params = np.concatenate([np.zeros(len(used)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        gradient = likelihood(params, grade, row, slot, value, grades, decay)[1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = params[: len(used)]
    theta = params[len(used)] + np.concatenate([[0], np.cumsum(np.exp(params[len(used) + 1 :]))])
    return Model(weights, theta)


def train(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_LABELED) -> Model:
    """Fit on the documents that `grades` (`id_col`, grade int from 0) names, at most `most` ids, those of smallest hash. Null grades and ids
    are left out; an id with several grades counts with the lowest, one with several texts with the first of them."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(data) for data in utf8_slices(batch.column(1))]
            ends = pa.array(np.cumsum([0, *(len(s) for s, _ in found)]), pa.int32())
            slots, values = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, (np.int32, np.float32)[i]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(slots)), pa.ListArray.from_arrays(ends, pa.array(values))], ["grade", "slots", "values"])

    chosen = grades.select(grades[id_col].alias("_id"), grades["grade"].cast("int").alias("grade")).where("_id is not null and grade is not null").groupBy("_id").agg(F.min("grade").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("text"))
    # `most` rows of an id and a grade
    one = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "grade").agg(F.min("text").alias("text"))
    sample = one.select("grade", "text").mapInArrow(extract, "grade int, slots array<int>, values array<float>").toArrow()
    lists = sample.column("slots").combine_chunks()
    sizes = np.asarray(lists.value_lengths()) if len(lists) else np.zeros(0, int)
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.asarray(c.flatten()) for c in sample.column(name).chunks)])
    return fit(np.asarray(sample.column("grade")).astype(int), np.repeat(np.arange(len(sizes)), sizes), flat("slots", np.int32).astype(int), flat("values", np.float32))


def score(docs: DataFrame, model: Model, text_col: str = "text", select_grade: int = SELECT_GRADE, select_p: float = SELECT_P) -> DataFrame:
    """All columns of `docs` and _expected (expected grade), _tail (P(grade >= select_grade)), _selected.

    Null and empty texts are scored as texts without words. Rows stay as they are, repeated or
    not; an empty table gives an empty one. Columns of these three names are replaced.
    """
    bound_batches(docs.sparkSession)
    weights = model.weights

    @F.pandas_udf("struct<_expected: double, _tail: double>")
    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            f = np.zeros(len(part))
            for i, text in enumerate(part):
                slots, values = features(np.frombuffer((text or "").encode(), np.uint8))
                f[i] = weights[slots] @ values
            above = model.above(f)
            yield pd.DataFrame({"_expected": above.sum(axis=1), "_tail": above[:, select_grade - 1]})

    made = {"_expected", "_tail", "_selected"}
    rated = docs.select(F.struct(*(docs[c] for c in docs.columns if c not in made)).alias("row"), rate(docs[text_col]).alias("rated"))
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in made]
    return rated.select(*columns, F.col("rated._expected").alias("_expected"), F.col("rated._tail").alias("_tail"), (F.col("rated._tail") >= select_p).alias("_selected"))


def grade_column(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 of low quality, 2 good; null where neither flag decides."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)


def label_grades(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", grade_column(F.col("quality"), F.col("toxic")).alias("grade"))


def op10_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, label_grades(read(spark, sf_dir, "labels")))
    return score(docs.select("doc_id", "text"), model).select("doc_id", F.round("_expected", 6).alias("expected_grade"), F.round("_tail", 6).alias("tail_probability"), F.col("_selected").alias("kept"))
