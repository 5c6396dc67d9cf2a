"""Near-duplicates and components, against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import components, similarity


def brute(rows, k, percent):
    """Component and set size per key, from (key, text) rows with distinct keys."""
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}
    group = {key: key for key in sets}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            group[max(x, y)] = min(x, y)
    return {key: (len(s), top(key)) for key, s in sets.items()}


def result(docs, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in similarity.near_duplicates(docs, **options).collect()}


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_documents(spark, k, percent):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    assert result(docs, k=k, percent=percent) == brute([tuple(r) for r in docs.collect()], k, percent)


def test_groups_of_near_copies_in_few_words(spark):
    """Texts of few different words, whose shingles are common, in chains of edits."""
    pick = random.Random(5)
    rows, text = [], [pick.choice("abcdef") for _ in range(60)]
    for i in range(150):
        if i % 30 == 0:
            text = [pick.choice("abcdef") for _ in range(pick.choice((4, 12, 60)))]
        text = list(text)
        text[pick.randrange(len(text))] = pick.choice("abcdefg")
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k, percent in ((3, 90), (2, 70)):
        assert result(docs, k=k, percent=percent) == brute(rows, k, percent)


def test_threshold_is_met_exactly(spark):
    nine, ten = "a b c d e f g h i j k", "a b c d e f g h i j k l"  # 9 and 10 shingles of three: 90 of 100
    docs = spark.createDataFrame([(1, nine), (2, ten), (3, nine + " x y")], "doc_id bigint, text string")
    got = result(docs, k=3, percent=90)
    assert got[1] == (9, 1) and got[2] == (10, 1) and got[3] == (11, 3)


def test_short_and_empty(spark):
    rows = [(1, "One two"), (2, "one  TWO"), (3, "two one"), (4, None), (5, ""), (6, " \n"), (7, "one two three")]
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string"), k=3, percent=90)
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (1, 7)}


def test_awkward_rows(awkward, no_docs, texts):
    rows = similarity.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (6, 7)} == {(6, 6), (7, 6)}
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert similarity.near_duplicates(no_docs).collect() == []
    assert similarity.near_duplicates(texts("a b c d e f", "a b c d e f")).columns == ["doc_id", "n_shingles", "component_id"]


def test_rows_of_one_key_are_one_document(spark):
    rows = [(1, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u"), (3, "a b c d e f")]
    got = similarity.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=3, percent=90)
    assert {r.component_id for r in got.collect()} == {1}


def test_more_candidates_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BROADCAST_IDS", 0)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    assert result(docs, k=3, percent=90) == brute([tuple(r) for r in docs.collect()], 3, 90)


def test_classes_rise_with_counts():
    counts = np.array([10] * 1000 + [12, 60, 200, 10**6])
    kinds = similarity.class_of(counts, counts[:1000].mean())
    assert set(kinds[:1001]) == {0} and 0 < kinds[1001] < kinds[1002] < kinds[1003] <= 13


def test_components(spark):
    pick = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, pick.randrange(100, 130)) for _ in range(40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.v: r.c for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(1, 41)} | {b: 100 for _, b in edges[40:80] if b != 100} | {201: 200}
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_bucket_counts_beyond_what_a_task_holds(spark):
    """A bucket met oftener than 16 bits hold, in one text and over several, among rare ones."""
    many = ["same " * 150_000, "one two three four", None, "", "same " * 70_000 + "one two three four"]
    docs = spark.createDataFrame([(t,) for t in many], "text string").coalesce(1)
    found = similarity.bucket_counts(docs, "text", 3)
    held = {}
    for row in found.collect():
        counts = similarity._unpacked(row.counts)
        assert row.total == counts.sum()
        held |= {(row.block, int(i)): int(counts[i]) for i in np.flatnonzero(counts)}
    # same same same: 149,998 and 69,998; one two three, two three four: twice; two shingles across the change of words
    assert sorted(held.values()) == [1, 1, 2, 2, 219_996]
