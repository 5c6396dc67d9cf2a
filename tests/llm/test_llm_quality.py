"""Toxicity, quality rules, the weak-label classifier: held-out accuracy and brute force."""

import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import linear, quality_rules, text, toxicity, weak_quality
from logmetrics.llm.queries import op1_toxicity, op3_quality_classifier, op8_quality_rules

LARGER = DATA.replace("0.001", "0.1")


def run_of(*values):
    return next(text.runs(pa.RecordBatch.from_pydict({"text": pa.array(values, pa.string())}), "text"))[2:]


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[label == 1].mean() - ((label == 1).sum() - 1) / 2) / (label == 0).sum()


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    got = op1_toxicity(spark, LARGER).join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(got.score.to_numpy(), got.toxic.to_numpy()) > 0.95
    assert (got.predicted == (got.score >= 0.3)).all()
    assert got[got.toxic == 0].predicted.mean() < 0.02 and got[got.toxic == 1].predicted.mean() > 0.75


def test_toxicity_trains_on_its_own_fold_only(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    from logmetrics.llm.queries import held_out

    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x.filter(~held_out())) for x in (labels, turned))
    assert (a.kept == b.kept).all() and np.allclose(a.values, b.values)


def test_toxicity_grams_stay_in_their_text():
    data, bounds = run_of("abcd", "abcde", "", "ABCD\tabcd", "日本語x")
    owner, buckets = toxicity._grams(data, bounds)
    sizes = Counter(owner.tolist())
    assert sizes[0] == 1 and sizes[1] == 3 and sizes[2] == 0 and sizes[4] == 1
    own = {i: set(buckets[owner == i].tolist()) for i in range(5)}
    assert own[0] < own[1] and own[0] < own[3]


def test_toxicity_rows(spark, awkward, no_docs, texts):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert toxicity.score(no_docs, model).collect() == []
    assert toxicity.score(texts("a"), model).columns == ["doc_id", "score"]
    nothing = toxicity.fit(docs, labels.limit(0))
    assert len({r.score for r in toxicity.score(docs, nothing).collect()}) == 1
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 5), (3, 1), (3, 0)], "doc_id bigint, toxic int")
    toxicity.fit(docs, odd)


def test_logistic_against_plain_gradients():
    rng = np.random.RandomState(0)
    x = rng.rand(80, 5)
    y = (x @ [2, -3, 1, 0, 0] + 0.2 * rng.randn(80) > 0).astype(float)
    owner, column = np.repeat(np.arange(80), 5), np.tile(np.arange(5), 80)
    w, b = linear.logistic(owner, column, x.ravel(), y, 5, 0.5)
    p = linear.sigmoid(x @ w + b)
    assert np.abs(x.T @ (p - y) + 0.5 * w).max() < 1e-3 and abs((p - y).sum()) < 1e-3


def base(value):
    value = value or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", value)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in value.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", value)), dup, len(inside)


def test_base_counts(spark):
    rows = op8_quality_rules(spark, DATA).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        want = base(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_base_counts_of_odd_texts():
    values = ["", "  ", None, "\n\na\n\na\n", "a b c d e a b c d e", "é é é é é é é é\né", "x\x00y", "a\r\na", "x y\nx y ", "a b c d e f a b c d e"]
    counts, _ = quality_rules.measure(*run_of(*values))
    for i, v in enumerate(values):
        assert tuple(int(counts[c][i]) for c in quality_rules.COUNTS) == base(v), v


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.RandomState(3)
    owner = np.repeat([0, 2, 3], [1, 6, 9])
    lines = quality_rules.Lines(owner, rng.randint(0, quality_rules.WIDTH, (16, len(quality_rules.CLASSES))), np.ones(16))
    field = quality_rules.Field(rng.randn(quality_rules.WIDTH), rng.randn(2, 2), 0.3)
    got, gain = quality_rules.decode(field, lines), field.scores(lines)
    total, chance = 0.0, np.zeros(16)
    for text_no in np.unique(owner):
        at = np.flatnonzero(owner == text_no)
        value = lambda s: field.start * s[0] + sum(gain[i] * x for i, x in zip(at, s)) + sum(field.steps[a, b] for a, b in zip(s, s[1:]))  # noqa: B023, E731
        paths = list(product((0, 1), repeat=len(at)))
        assert tuple(got[at]) == max(paths, key=value)
        weights = np.exp([value(p) for p in paths])
        chance[at] = (np.array(paths) * weights[:, None]).sum(axis=0) / weights.sum()
    content, _ = quality_rules._expected(field, gain, quality_rules._columns(owner))
    assert np.allclose(content, chance)


def test_quality_rules_on_labels(spark):
    got = op8_quality_rules(spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").toPandas()
    good, bad = got[(got.quality == 1) & ~got.base_failed], got[got.quality == 0]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.05


def test_steps_are_learnt_and_mixed_texts_lose_their_boilerplate(spark):
    """Trained without a fold of the labels; texts of the fold are judged whole and mixed, runs of four lines by turns."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    apart = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    field = quality_rules.fit(docs, labels.filter(~apart))
    stays, leaves = np.diag(field.steps), (field.steps[0, 1], field.steps[1, 0])
    assert min(stays) > max(leaves) and len(set(np.abs(field.steps).ravel().round(3))) > 1
    held = docs.join(labels.filter(apart), "doc_id")
    judged = quality_rules.judge(held, field, keep=("doc_id", "quality", "text")).filter("not base_failed").toPandas()
    assert judged.kept[judged.quality == 1].mean() > 0.99 and judged.kept[judged.quality == 0].mean() < 0.05
    runs = {q: [r for t in judged.text[judged.quality == q] for lines in [[x for x in t.split("\n") if len(x.split()) > 7]] for r in [lines[:4]] if len(r) == 4] for q in (0, 1)}
    right = total = 0
    for bad, one, two in zip(runs[0], runs[1][::2], runs[1][1::2]):
        _, lines = quality_rules.measure(*run_of("\n".join(one + bad + two)))
        right += (quality_rules.decode(field, lines) == np.repeat([1, 0, 1], 4)).sum()
        total += 12
    assert total >= 120 and right / total > 0.95


def test_mixtures_hold_every_line_once():
    rng = np.random.RandomState(5)
    k = len(quality_rules.CLASSES)
    texts = [rng.randint(0, quality_rules.WIDTH - 3, (m, k)).astype(np.int16) for m in (1, 9, 0, 40, 3, 17, 2, 5)]
    labels = np.array([0, 0, 0, 1, 1, 1, 1, 0])
    lines, states = quality_rules.mixtures(texts, labels)
    inner = lambda rows, ys: Counter((int(y), *map(int, r[:-1])) for r, y in zip(rows, ys))
    assert inner(lines.active, states) == inner(np.concatenate(texts), np.repeat(labels, [len(t) for t in texts]))
    assert (np.diff(lines.owner) >= 0).all() and (np.bincount(lines.owner) > 0).all()
    back = quality_rules.mixtures(texts[::-1], labels[::-1])
    assert (back[0].active == lines.active).all() and (back[1] == states).all()
    changes = (np.diff(states) != 0) & (np.diff(lines.owner) == 0)
    assert changes.any()
    assert len(quality_rules.mixtures([], np.zeros(0, int))[1]) == 0


def test_a_text_of_very_many_lines_sends_a_bounded_number():
    long = np.arange(100_000)[:, None]
    got = quality_rules._spread(long)
    assert len(got) == quality_rules.RUNS * quality_rules.RUN_LINES and got[0] == 0 and got[-1] == 99_999
    assert len(quality_rules._spread(long[:256])) == 256


def test_quality_rules_rows(awkward, no_docs, texts):
    field = quality_rules.Field(np.zeros(quality_rules.WIDTH), np.zeros((2, 2)), 1.0)
    rows = quality_rules.judge(awkward, field).collect()
    assert len(rows) == awkward.count()
    assert all(r.base_failed and not r.kept and r.content_share == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert quality_rules.judge(no_docs, field).collect() == []
    assert quality_rules.judge(texts("a b"), field).columns[0] == "doc_id"


def test_a_field_without_labels_keeps(spark, texts):
    docs = texts("one two three four five six seven eight nine ten eleven")
    field = quality_rules.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert quality_rules.judge(docs, field).first().kept


def test_votes_meet_in_labels():
    """The estimate recovers who is right: two good labellers, noise elsewhere."""
    rng = np.random.RandomState(1)
    k, n = len(weak_quality.LABELLERS), 20_000
    good = rng.rand(n) < 0.85
    cast = np.zeros((n, k), int)
    for j, (seen, false) in enumerate([(0.8, 0.002), (0.7, 0.002)]):
        cast[:, j] = np.where(rng.rand(n) < np.where(good, false, seen), weak_quality.BAD, weak_quality.GOOD * (rng.rand(n) < 0.7))
    patterns, counts = np.unique(weak_quality.pattern_of(cast), return_counts=True)
    labels = weak_quality.estimate(patterns, counts)
    post = labels.posterior(weak_quality.pattern_of(cast))
    assert abs(labels.good - 0.85) < 0.03 and ((post > 0.5) == good).mean() > 0.93
    assert (weak_quality.votes_of(weak_quality.pattern_of(cast)) == cast).all()


def test_false_alarms_follow_the_data():
    """A labeller that calls a fifth of the good documents bad is told from one that does not."""
    rng = np.random.RandomState(2)
    n = 40_000
    good = rng.rand(n) < 0.8
    cast = np.zeros((n, len(weak_quality.LABELLERS)), int)
    for j, (seen, false) in enumerate([(0.8, 0.2), (0.8, 0.01), (0.7, 0.01), (0.7, 0.05)]):
        cast[:, j] = np.where(rng.rand(n) < np.where(good, false, seen), weak_quality.BAD, weak_quality.SILENT)
    patterns, counts = np.unique(weak_quality.pattern_of(cast), return_counts=True)
    labels = weak_quality.estimate(patterns, counts)
    alarms = labels.rates[:, 1, weak_quality.BAD]
    assert np.allclose(alarms[:4], [0.2, 0.01, 0.01, 0.05], atol=0.02) and abs(labels.good - 0.8) < 0.03
    assert np.allclose(labels.rates[:4, 0, weak_quality.BAD], [0.8, 0.8, 0.7, 0.7], atol=0.04)


def test_weak_labels_on_documents(spark):
    got = op3_quality_classifier(spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").toPandas()
    assert auc(got.score.to_numpy(), got.quality.to_numpy()) > 0.95
    assert got[got.quality == 1].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.4


def test_weak_label_rows(spark, awkward, no_docs, texts):
    scorer = weak_quality.fit(spark.read.parquet(f"{DATA}/documents.parquet"))
    rows = weak_quality.score(awkward, scorer).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    assert weak_quality.score(no_docs, scorer).collect() == []
    assert weak_quality.score(texts("a"), scorer).columns == ["doc_id", "posterior", "score"]
    weak_quality.score(awkward, weak_quality.fit(no_docs)).collect()
