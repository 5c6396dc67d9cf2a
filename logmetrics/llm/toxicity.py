"""Toxicity by character n-grams scaled with naive Bayes log-count ratios.

A text's features are the distinct n-grams of its characters (A-Z as a-z), hashed
into a fixed number of buckets. On labelled rows each bucket gets its log-count
ratio: how much oftener texts of label 1 hold it than texts of label 0. The
buckets that tell the classes apart best are kept, and a logistic regression is
trained on presence times ratio. A text's score is the sum of the weights of the
kept buckets that it holds, through the logistic function.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage
from logmetrics.llm.labelled import sample
from logmetrics.llm.linear import logistic, sigmoid
from logmetrics.llm.text import LOWER, ddl, finish, map_runs, runs, verdicts

ORDERS = (4, 5, 6)
BUCKETS = 1 << 20
FEATURES = 1024
SAMPLE_ROWS = 16_000
LEAST_TEXTS = 3
SMOOTHING = 1.0
PENALTY = 2.0
SCORED_BYTES = 200_000  # of texts taken at once: several hundred bytes of arrays per byte


def _distinct(values: np.ndarray, owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, value), in order."""
    keys = np.sort(owner.astype(np.uint64) * np.uint64(buckets) + values)
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return (keys // np.uint64(buckets)).astype(np.int64), (keys % np.uint64(buckets)).astype(np.int64)


def _grams(data: np.ndarray, bounds: np.ndarray, picked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every distinct n-gram; only of ``picked`` buckets if given.

    An n-gram lies in one text. White space of any kind counts as one kind of space.
    """
    low = LOWER[data]
    low[(low >= 0x09) & (low <= 0x0D)] = 0x20
    heads = np.flatnonzero((low & 0xC0) != 0x80)  # where characters begin
    sizes = np.diff(np.append(heads, len(low)))
    code = low[heads].astype(np.uint64)
    for i in (1, 2, 3):  # the bytes of longer characters
        more = np.flatnonzero(sizes > i)
        code[more] = code[more] * np.uint64(256) + low[heads[more] + i]
    owner = np.searchsorted(bounds, heads, side="right") - 1
    texts, values = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] if len(code) >= n else h[:0]
        if n in ORDERS and len(h):
            bucket = finish(h + np.uint64(n)) % np.uint64(BUCKETS)
            keep = owner[: len(h)] == owner[n - 1 :]
            if picked is not None:
                keep &= picked[bucket]
            texts.append(owner[: len(h)][keep])
            values.append(bucket[keep])
    if not values:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _distinct(np.concatenate(values), np.concatenate(texts), BUCKETS)


@dataclass
class Model:
    """The kept buckets and their weights."""

    kept: np.ndarray
    values: np.ndarray
    bias: float

    @cached_property
    def weights(self) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[self.kept] = self.values
        return out

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        texts, buckets = _grams(data, bounds, self.weights != 0)
        sums = np.bincount(texts, weights=self.weights[buckets], minlength=len(bounds) - 1)
        return sigmoid(sums + self.bias)


def informative(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The buckets to keep, those whose presence tells the labels apart best, and their log-count ratios.

    Texts of each label that hold a bucket are counted in tasks, added up and ranked
    by Spark; the driver gets ``FEATURES`` rows.
    """

    def each(batches):
        held = np.zeros((2, BUCKETS + 1), np.int64)  # the last column counts all texts
        for batch in batches:
            for lo, hi, data, bounds in runs(batch, "text", SCORED_BYTES):
                label = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                texts, buckets = _grams(data, bounds)
                for y in (0, 1):
                    np.add.at(held[y], buckets[label[texts] == y], 1)
                    held[y, BUCKETS] += int((label == y).sum())
        used = np.flatnonzero(held.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[0, used]), pa.array(held[1, used])], ["bucket", "n0", "n1"])

    sums = labelled.mapInArrow(each, "bucket bigint, n0 bigint, n1 bigint").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = stage(sums, "toxicity-counts")
    total = counts.filter(F.col("bucket") == BUCKETS).first()
    if total is None:
        return np.zeros(0, np.int64), np.zeros(0)
    share = lambda c: (F.col(c) + SMOOTHING) / F.lit(total[c] + 2 * SMOOTHING)
    every = total.n0 + total.n1
    p = (F.col("n0") + F.col("n1")) / F.lit(every)
    best = (
        counts.filter((F.col("bucket") < BUCKETS) & (F.col("n0") + F.col("n1") >= LEAST_TEXTS))
        .select("bucket", F.log(share("n1") / share("n0")).alias("ratio"), (F.pow(share("n1") - share("n0"), F.lit(2.0)) / F.greatest(p * (1 - p), F.lit(1 / every))).alias("gain"))
        .filter("gain > 0").orderBy(F.desc("gain"), "bucket").limit(FEATURES).toPandas().sort_values("bucket")
    )
    return best.bucket.to_numpy(np.int64), best.ratio.to_numpy(float)


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, kept: np.ndarray, ratio: np.ndarray) -> Model:
    """Logistic regression on presence times ratio."""
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    column = place[np.concatenate(rows)] if rows else np.zeros(0, np.int64)
    w, b = logistic(owner, column, ratio[column], labels, len(kept), PENALTY)
    return Model(kept, w * ratio, b)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """A model from about ``rows`` labelled texts, counted by Spark.

    To the driver come the kept buckets, ``FEATURES`` at most, and which of them each
    sampled text holds. Without labelled rows, or with rows of one label only,
    the model gives every text the same score.
    """
    labelled = sample(docs, labels, key, text, label, rows)
    kept, ratio = informative(labelled)
    picked = np.zeros(BUCKETS, bool)
    picked[kept] = True

    def work(batch, data, bounds):
        texts, buckets = _grams(data, bounds, picked)
        cut = np.searchsorted(texts, np.arange(1, batch.num_rows))
        return {"label": batch.column(0), "kept": [x.astype(np.int32) for x in np.split(buckets, cut)]}

    got = map_runs(labelled, "text", ["label", "text"], "label int, kept array<int>", work, SCORED_BYTES).toPandas()
    return fit_weights([np.asarray(x, np.int64) for x in got.kept], got.label.to_numpy(), kept, ratio)


def score(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1, higher: label 1 likelier) per row.

    One row per input row; a null or empty text has the score of a text without
    n-grams, set by the bias alone. ``keep`` must not hold ``score``; other columns
    do not pass, whatever their names. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch, data, bounds):
        return {**{c: batch.column(i) for i, c in enumerate(keep)}, "score": shared.value.score(data, bounds)}

    return map_runs(docs, text, list(keep), ddl(docs, keep) + "score double", work, SCORED_BYTES)


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """``score`` as a function of a column of texts, for rows whose other columns need not go through Python."""
    shared = spark.sparkContext.broadcast(model)
    return verdicts("double", lambda data, bounds: shared.value.score(data, bounds), SCORED_BYTES)
