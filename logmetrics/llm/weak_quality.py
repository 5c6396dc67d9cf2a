"""Quality by weak labels.

Heuristic labellers vote on each document: good, bad, or nothing. They overlap and
contradict each other, and none is trusted. Over the counts of all vote patterns,
expectation-maximisation estimates how often each labeller gives each vote on good
and on bad documents, and the share of good ones; a pattern's posterior is the weak
label of its documents. A linear scorer over hashed features is then trained on the
posteriors of a sample and scores every document by what it holds, also where all
labellers are silent.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage
from logmetrics.llm.linear import logistic, sigmoid
from logmetrics.llm.quality_rules import Lines, measure
from logmetrics.llm.text import IS_WORD, LOWER, ddl, finish, map_runs

SILENT, BAD, GOOD = 0, 1, 2
BUCKETS = 1 << 16
# Printing ASCII characters that are neither letters nor digits.
IS_MARK = np.zeros(256, bool)
IS_MARK[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
SAMPLE_ROWS = 6_000
PENALTY = 0.05
ROUNDS = 200

LABELLERS = ("symbols", "letters", "lone_marks", "repetition", "doubled", "repeated_lines", "capitals", "exclamations", "stops")
PATTERNS = 3 ** len(LABELLERS)


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, SILENT))


def votes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], Lines]:
    """One row per text, one vote per labeller; and what they look at. A text without words gets no vote but for its lack of letters."""
    counts, lines = measure(data, bounds)
    n = len(bounds) - 1
    words = counts["n_words"]
    many = np.maximum(words, 1)

    def tally(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[bounds[1:]] - total[bounds[:-1]]

    upper = tally((data >= ord("A")) & (data <= ord("Z")))
    letters = np.maximum(upper + tally((data >= ord("a")) & (data <= ord("z"))), 1)
    shouts = tally(data == ord("!"))
    stops = tally((data == ord(".")) | (data == ord("?"))) + shouts
    # Words of one character that is no letter, digit or part of a longer character.
    apart, mark = ~IS_WORD[data], IS_MARK[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = apart[:-1], apart[1:]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    before[inner], after[inner - 1] = True, True
    lone = tally(mark & before & after)
    n_lines = np.maximum(np.bincount(lines.owner, minlength=n), 1)
    some = words >= 10
    values = {
        "symbols": counts["n_symbols"] / many, "repetition": counts["n_repeat_words"] / many, "repeated_lines": counts["n_dup_lines"] / n_lines,
        "letters": (letters + tally(((data >= ord("0")) & (data <= ord("9"))) | (data >= 0xC0)) * (words > 0)) / np.maximum(counts["word_chars"], 1), "lone_marks": lone / many, "doubled": counts["n_doubled"] / many, "capitals": upper / letters, "exclamations": shouts / many, "stops": many / np.maximum(stops, 1),
    }
    v = values
    cast = [
        _vote(v["symbols"] > 0.15, (words > 0) & (v["symbols"] < 0.01)),
        _vote(v["letters"] < 0.75, np.zeros(n, bool)),
        _vote(v["lone_marks"] > 0.2, np.zeros(n, bool)),
        _vote(some & (v["repetition"] > 0.2), np.zeros(n, bool)),
        _vote(some & (v["doubled"] > 0.15), np.zeros(n, bool)),
        _vote((counts["n_dup_lines"] >= 2) & (v["repeated_lines"] > 0.2), np.zeros(n, bool)),
        _vote(some & (v["capitals"] > 0.4), np.zeros(n, bool)),
        _vote(some & (v["exclamations"] > 0.3), np.zeros(n, bool)),
        _vote(some & ((v["stops"] > 120) | (v["stops"] < 1.8)), some & (v["stops"] > 4) & (v["stops"] < 60)),
    ]
    return np.stack(cast, axis=1), values, lines


def pattern_of(cast: np.ndarray) -> np.ndarray:
    return cast @ (3 ** np.arange(len(LABELLERS)))


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class Labels:
    """``rates[l, y, v]``: how often labeller l gives vote v on documents of quality y; ``good``: the share of quality 1."""

    rates: np.ndarray
    good: float

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        cast = votes_of(pattern)
        odds = np.log(self.good / (1 - self.good))
        for k in range(len(LABELLERS)):
            odds = odds + np.log(self.rates[k, 1, cast[:, k]] / self.rates[k, 0, cast[:, k]])
        return sigmoid(odds)

    def accuracies(self) -> dict[str, float]:
        """Share of a labeller's votes that are right."""
        out = {}
        for k, name in enumerate(LABELLERS):
            right = self.good * self.rates[k, 1, GOOD] + (1 - self.good) * self.rates[k, 0, BAD]
            wrong = self.good * self.rates[k, 1, BAD] + (1 - self.good) * self.rates[k, 0, GOOD]
            out[name] = float(right / max(right + wrong, 1e-12))
        return out


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Labels:
    """Expectation-maximisation, begun with documents that nobody calls bad as likely good.

    One vote of each kind is added on each side, so no rate is 0; beyond that all
    rates follow the documents.
    """
    cast, weight = votes_of(patterns), counts.astype(float)
    p = np.where((cast == BAD).any(axis=1), 0.15, 0.9)
    labels = Labels(np.full((len(LABELLERS), 2, 3), 1 / 3), 0.5)
    for _ in range(rounds):
        sides = np.stack([weight * (1 - p), weight * p])
        rates = np.stack([[np.bincount(cast[:, k], weights=side, minlength=3) + 1.0 for side in sides] for k in range(len(LABELLERS))])
        labels = Labels(rates / rates.sum(axis=2, keepdims=True), float((sides[1].sum() + 1) / (weight.sum() + 2)))
        new = labels.posterior(patterns)
        if len(p) == 0 or np.abs(new - p).max() < 1e-6:
            break
        p = new
    return labels


# Upper ends of the classes that the looked-at values fall into as features.
CLASSES = {
    "symbols": (0, 0.05, 0.15, 0.5), "repetition": (0, 0.1, 0.2, 0.5), "repeated_lines": (0, 0.1, 0.3), "letters": (0.6, 0.75, 0.85),
    "lone_marks": (0, 0.05, 0.2), "doubled": (0.02, 0.15, 0.5), "capitals": (0.05, 0.15, 0.4), "exclamations": (0, 0.1, 0.3), "stops": (1.8, 4, 15, 60, 120),
}


def features(data: np.ndarray, bounds: np.ndarray, values: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of the distinct features: runs of three bytes (A-Z as a-z, digits as 0), and value classes."""
    n = len(bounds) - 1
    low = LOWER[data]
    low[(low >= ord("0")) & (low <= ord("9"))] = ord("0")
    owner = np.repeat(np.arange(n), np.diff(bounds))
    code = low.astype(np.uint64)
    texts, buckets = [], []
    if len(code) >= 3:
        same = owner[:-2] == owner[2:]
        grams = ((code[:-2] << np.uint64(16)) | (code[1:-1] << np.uint64(8)) | code[2:])[same]
        keys = np.sort((owner[:-2][same].astype(np.uint64) << np.uint64(24)) | grams)
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
        texts.append((keys >> np.uint64(24)).astype(np.int64))
        buckets.append((finish(keys & np.uint64(0xFFFFFF)) % np.uint64(BUCKETS)).astype(np.int64))
    for j, (name, edges) in enumerate(CLASSES.items()):
        kind = np.searchsorted(np.array(edges, float), np.asarray(values[name], float), side="left")
        texts.append(np.arange(n))
        buckets.append((finish((np.uint64(1 << 40) + np.uint64(j * 16)) + kind.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64))
    texts, buckets = np.concatenate(texts), np.concatenate(buckets)
    keys = np.unique(texts * BUCKETS + buckets)
    return keys // BUCKETS, keys % BUCKETS


@dataclass
class Scorer:
    """A linear scorer over hashed features, and the labels it was trained on."""

    labels: Labels
    weights: np.ndarray
    bias: float

    @cached_property
    def posteriors(self) -> np.ndarray:
        return self.labels.posterior(np.arange(PATTERNS))

    def score(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior by votes, and score, of each text."""
        cast, values, _ = votes(data, bounds)
        texts, buckets = features(data, bounds, values)
        sums = np.bincount(texts, weights=self.weights[buckets], minlength=len(bounds) - 1)
        held = np.bincount(texts, minlength=len(bounds) - 1)
        return self.posteriors[pattern_of(cast)], sigmoid(sums / np.sqrt(np.maximum(held, 1)) + self.bias)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Scorer:
    """Labels from the votes on all documents, and a scorer trained on about ``rows`` of them, picked by a hash of the key.

    To the driver come the count of each vote pattern (19,683 at most) and the
    features of the sample. Without documents the scorer gives every text the same.
    """

    def vote(batch, data, bounds):
        return {"pattern": pattern_of(votes(data, bounds)[0])}

    tallied = map_runs(docs, text, [], "pattern int", vote).groupBy("pattern").count().toPandas()
    labels = estimate(tallied["pattern"].to_numpy(np.int64), tallied["count"].to_numpy())
    share = min(1.0, rows / max(1, int(tallied["count"].sum())))
    picked = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20)) < int(share * (1 << 20) + 0.5)

    def work(batch, data, bounds):
        cast, values, _ = votes(data, bounds)
        texts, buckets = features(data, bounds, values)
        cut = np.searchsorted(texts, np.arange(1, batch.num_rows))
        return {"pattern": pattern_of(cast), "held": [x.astype(np.int32) for x in np.split(buckets, cut)]}

    sampled = stage(docs.filter(picked).select(F.col(text).alias("text")), "quality-sample")
    got = map_runs(sampled, "text", [], "pattern int, held array<int>", work).toPandas()
    held = [np.asarray(x, np.int64) for x in got.held]
    if not held:
        return Scorer(labels, np.zeros(BUCKETS), float(np.log(labels.good / (1 - labels.good))))
    owner = np.repeat(np.arange(len(held)), [len(x) for x in held])
    value = np.repeat([1 / np.sqrt(max(1, len(x))) for x in held], [len(x) for x in held])
    w, b = logistic(owner, np.concatenate(held), value, labels.posterior(got.pattern.to_numpy(np.int64)), BUCKETS, PENALTY, steps=12)
    return Scorer(labels, w, b)


def score(docs: DataFrame, scorer: Scorer, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, ``posterior`` (good, by the votes alone) and ``score`` (0 to 1, higher: better) per row.

    One row per input row, repeated and null keys included. A null or empty text is
    voted bad for its lack of letters, and scored by its value classes alone. ``keep`` must
    not hold these names; other columns do not pass, whatever their names. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def work(batch, data, bounds):
        posterior, value = shared.value.score(data, bounds)
        return {**{c: batch.column(i) for i, c in enumerate(keep)}, "posterior": posterior, "score": value}

    return map_runs(docs, text, list(keep), ddl(docs, keep) + "posterior double, score double", work)
