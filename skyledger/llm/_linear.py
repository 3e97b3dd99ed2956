"""Linear classifier on distinct features: indicators scaled by class log-count ratios, hinge loss, dual coordinate
descent (the "naive Bayes support vector" method), and a logistic curve from margins to scores.

The model is fitted in one task on a bounded sample of labelled rows; it scores all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import _text as X
from skyledger.llm._spark import columns, crc_mod


@dataclass
class Model:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray  # ratio times hinge weight
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of rows whose distinct features lie at features[rows[i]:rows[i+1]]."""
        n = len(rows) - 1
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
            hit = self.keys[at] == features
            row = X.row_of(rows)[hit]
            total = np.bincount(row, self.weights[at[hit]], n)
            norm = np.bincount(row, self.ratios[at[hit]] ** 2, n)
        else:
            total = norm = np.zeros(n)
        margin = total / np.sqrt(np.maximum(norm, 1e-12)) + self.bias
        return 1 / (1 + np.exp(np.clip(-(self.slope * margin + self.offset), -40, 40)))


def hinge_dual(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, n: int, *, c: float, epochs: int, seed: int = 1) -> tuple[np.ndarray, float]:
    """min |w|^2/2 + c*sum(max(0, 1-y(wx+b))) by coordinate descent on the dual; b is the weight of a constant."""
    w, b, alpha = np.zeros(n), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1 for v in values])
    cost = c * np.where(y > 0, (y < 0).mean(), (y > 0).mean()) * 2  # both classes weigh the same
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                b += step
                alpha[i] = new
    return w, b


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps, with a little regularisation."""
    a, b = 1.0, 0.0
    x = np.column_stack((margin, np.ones(len(margin))))
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(-(a * margin + b), -40, 40)))
        g = x.T @ (p - y) + 1e-3 * np.array([a - 1, b])
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return float(max(a, 0.01)), float(b)


FOLDS = 5


def _scaled(ratio: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A row's values: the ratios of its features, of length one together."""
    return ratio[row] / np.sqrt(max(ratio[row] @ ratio[row], 1e-12))


def _weigh(rows: list[np.ndarray], y: np.ndarray, n: int, use: np.ndarray, *, smooth: float, c: float, epochs: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Log-count ratios, hinge weights and bias from the rows in use."""
    pos, neg = np.full(n, smooth), np.full(n, smooth)
    some = np.flatnonzero(use)
    for i in some:
        (pos if y[i] > 0 else neg)[rows[i]] += 1
    ratio = np.log(pos / ((y[use] > 0).sum() + 2 * smooth)) - np.log(neg / ((y[use] < 0).sum() + 2 * smooth))
    w, b = hinge_dual([rows[i] for i in some], [_scaled(ratio, rows[i]) for i in some], y[use], n, c=c, epochs=epochs)
    return ratio, w, b


def fit(samples: list[tuple[int, np.ndarray]], *, smooth: float = 1.0, least: int = 3, c: float = 1.0, epochs: int = 12) -> Model:
    """samples: label and distinct feature hashes of each row.  Features of fewer than ``least`` rows are left out."""
    none = np.zeros(0)
    if not samples:
        return Model(np.zeros(0, np.uint64), none, none, 0.0, 1.0, 0.0)
    y = np.array([1.0 if s[0] else -1.0 for s in samples])
    if abs(y.sum()) == len(y):
        return Model(np.zeros(0, np.uint64), none, none, 0.0, 1.0, 3.0 * y[0])
    keys, counts = np.unique(np.concatenate([s[1] for s in samples]), return_counts=True)
    keys = keys[counts >= least]
    if not len(keys):
        return Model(keys, none, none, 0.0, 1.0, float(np.log((y > 0).sum() / (y < 0).sum())))
    rows = []
    for _, f in samples:
        at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
        rows.append(at[keys[at] == f])
    how = dict(smooth=smooth, c=c, epochs=epochs)
    everything = np.ones(len(y), bool)
    ratio, w, b = _weigh(rows, y, len(keys), everything, **how)
    # The curve is fitted to margins that each row gets from a model without it, a fifth of the rows at a time.
    fold = np.arange(len(y)) % FOLDS
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        out = fold == k if len(y) >= 50 else everything
        r, v, d = (ratio, w, b) if len(y) < 50 else _weigh(rows, y, len(keys), ~out, **how)
        for i in np.flatnonzero(out):
            margin[i] = v[rows[i]] @ _scaled(r, rows[i]) + d
    slope, offset = _calibrate(margin, (y > 0).astype(float))
    return Model(keys, w * ratio, ratio, b, slope, offset)


Features = Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]]  # first row, features, offsets of rows


MOST_BYTES = 256 << 20  # of features that a model is fitted on


def train(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, features: Features, spark: SparkSession, *, most_rows: int, most_bytes: int = MOST_BYTES, **how
) -> Model:
    """Fits on at most ``most_rows`` labelled rows that are not held out, those of the least hash of their id, and on no
    more of them than have ``most_bytes`` of features."""
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out).select("doc_id", F.col(label).cast("int").alias("label"))
    first = [F.xxhash64(F.col("doc_id").cast("long")), "doc_id", "label"]
    chosen = chosen.orderBy(*first).limit(most_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")  # most_rows rows of three numbers

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, y, texts = columns(batch, "doc_id", "label", "text")
            found = [f[rows_[i] : rows_[i + 1]].tobytes() for _, f, rows_ in features(texts) for i in range(len(rows_) - 1)]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), y, pa.array(found, pa.binary())], ["doc_id", "label", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, size = [], 0
        for b in batches:
            for y, f in zip(*(x.to_pylist() for x in columns(b, "label", "features"))):
                if size <= most_bytes:
                    table.append((y, np.frombuffer(f, np.uint64)))
                size += len(f)
        m = fit(table, **how)
        keep = np.abs(m.ratios) > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.keys[keep].tobytes()]), pa.array([m.weights[keep].tobytes()]), pa.array([m.ratios[keep].tobytes()]), *(pa.array([x], pa.float64()) for x in (m.bias, m.slope, m.offset))],
            ["keys", "weights", "ratios", "bias", "slope", "offset"],
        )

    # Ids may repeat in the documents, so the rows are bounded again; they come sorted into one partition.
    one = rows.mapInArrow(describe, "doc_id long, label int, features binary").orderBy(*first, "features").limit(most_rows)
    got = one.mapInArrow(learn, "keys binary, weights binary, ratios binary, bias double, slope double, offset double").collect()
    if not got:
        return fit([])
    k, w, r, b, s, o = got[0]
    return Model(np.frombuffer(k, np.uint64), np.frombuffer(w), np.frombuffer(r), b, s, o)


def score(docs: DataFrame, model: Model, features: Features, spark: SparkSession) -> DataFrame:
    """(doc_id, score) of all rows of docs (doc_id, text)."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            ids, texts = columns(batch, "doc_id", "text")
            out = [m.scores(f, rows) for _, f, rows in features(texts)]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(np.concatenate([np.zeros(0), *out]))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_below(docs: DataFrame, model: Model, features: Features, spark: SparkSession, text_col: str, threshold: float) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = [m.scores(f, rows) for _, f, rows in features(columns(batch, text_col)[0].cast(pa.string()))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *out]) < threshold))

    return docs.mapInArrow(run, docs.schema)


def verdicts(scored: DataFrame, mod: int, held: int, threshold: float = 0.3) -> DataFrame:
    return scored.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), mod) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
