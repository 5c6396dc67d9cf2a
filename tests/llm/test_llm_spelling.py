"""Spelling variants, against all single edits of every word."""

import random
import re
import zlib
from collections import Counter

import pytest

from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import spelling

LETTERS = [chr(x) for x in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]


def edits(word):
    out = set()
    for i in range(len(word) + 1):
        out.update(word[:i] + c + word[i:] for c in LETTERS)
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out.update(word[:i] + c + word[i + 1 :] for c in LETTERS)
    return out - {word}


def counted(rows):
    words = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def brute(words):
    near = {w: [x for x in edits(w) if x in words] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def result(docs, **options):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(docs, **options).collect()}


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute(counted([tuple(r) for r in docs.collect()]))


@pytest.mark.parametrize("block", [20, 150])
def test_words_of_few_letters_in_many_blocks(spark, monkeypatch, block):
    """Dense neighbourhoods, over blocks smaller than the words of one beginning."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", 7)
    monkeypatch.setattr(spelling, "FLUSH", 50)
    pick = random.Random(block)
    words = {"".join(pick.choice("abÿ") for _ in range(pick.randrange(5, 9))): pick.choice((3, 3, 4, 6, 7, 12, 24, 60)) for _ in range(300)}
    listed = [w for w, n in words.items() for _ in range(n)]
    pick.shuffle(listed)
    rows = [(i, " ".join(listed[i::40])) for i in range(40)]
    assert result(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(counted(rows))


def test_near_pairs_of_a_list():
    pick = random.Random(2)
    words = sorted({"".join(pick.choice("abc") for _ in range(pick.randrange(5, 8))) for _ in range(200)})
    raw = spelling.SortedList([w.encode() for w in words])
    for exact in (1, 2, 3):
        found = {(words[q], words[w]) for q, w in zip(*(x.tolist() for x in raw.near(raw, exact)))}
        assert found == {(w, x) for w in words for x in edits(w) if x in set(words) and x[:exact] == w[:exact]}
    assert [len(x) for x in spelling.SortedList([]).near(raw, 2)] == [0, 0]


def test_within_one():
    assert spelling.within_one(b"", b"abc") and spelling.within_one(b"ab", b"abc") and spelling.within_one(b"xb", b"abc") and spelling.within_one(b"bc", b"abcd")
    assert not spelling.within_one(b"xy", b"abc") and not spelling.within_one(b"cxb", b"abcd")


def test_chains_and_ties(spark):
    words = {"abcde": 40, "abcdx": 20, "abcyx": 10, "abzyx": 5, "wbzyx": 4, "klmno": 3, "klmnp": 6, "klmnq": 6, "étude": 3, "etude": 9}
    rows = [(i, " ".join(w for w, n in words.items() if n > i)) for i in range(40)]
    rows = [(key + 1000, text) for key, text in rows]
    want = brute(counted(rows))
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == want and got["abzyx"][1] == "abcde" and got["klmno"][0] == "klmnp" and got["étude"][0] == "etude"


def test_very_long_words(spark):
    long = "ab" * 2000
    rows = [(i, f"{long} {long}c {long[:-1]}") for i in range(3)]
    assert result(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute_pairs(counted(rows))


def brute_pairs(words):
    def one_edit(a, b):
        a, b = sorted((a, b), key=len)
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])

    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    assert all(not any(words[x] >= 2 * words[w] for x in found) for w, found in near.items())
    return {w: (None, w, n, len(near[w]), None) for w, n in words.items()}


def test_awkward_rows(spark, awkward, no_docs, texts):
    rows = [tuple(r) for r in awkward.collect()]
    assert result(awkward) == brute(counted(rows))
    assert result(no_docs) == {} and result(spark.createDataFrame([(1, "a an the")], "doc_id bigint, text string")) == {}
    got = spelling.group_variants(texts("words words words"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):
        spelling.group_variants(no_docs, least_length=4)
