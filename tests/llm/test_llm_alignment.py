"""Alignment of two tokenizers, against the libraries on whole texts and pairs counted one by one."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest

from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "é", "日本", " ", "\n", "  ", "<|endoftext|>", "<s>", "<0x0A>", "▁", "\x00", "\x1c", "ࠀ", "🎉🧿", "\r\n", "\t", "a", "b1", "'s", "n't", "　",
    "​", "ﬁ", "é", "ࡰ", "\x85", "don", "!!", "_", "x" * 50, "'", "1", ",", "-", ". ",
]


@pytest.fixture(scope="module")
def tools():
    return alignment.aligner_of(A, B)


def brute(tools, text):
    """Numbers, digest and linked pairs of a text, from whole encodings; None where a vocabulary does not give it back."""
    raw = (" " + text).encode()
    a, b = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
    bytes_a, bytes_b = [tools.bytes_a[i] for i in a], [tools.bytes_b[i] for i in b]
    if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
    shared = sorted(set(ends_a) & set(ends_b))
    groups = [([], []) for _ in shared]
    for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
        for i, end in zip(ids, ends):
            groups[bisect_left(shared, end)][side].append(i)
    name = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
    links = Counter(
        (i, j) for i, x, end_x in zip(a, bytes_a, ends_a) for j, y, end_y in zip(b, bytes_b, ends_b) if max(end_x - len(x), end_y - len(y)) < min(end_x, end_y)
    )
    return len(a), len(b), len(shared), hashlib.sha256(name.encode()).hexdigest(), links


def wanted(tools, rows):
    """What ``score_links`` gives for rows of (key, text)."""
    found = [(key, brute(tools, text or "")) for key, text in rows]
    counts = sum((f[4] for _, f in found if f), Counter())
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for key, f in found:
        if f is None:
            out.append((key, 0, 0, 0, 0, "", 0, 0))
        else:
            best = sum(n for (i, j), n in f[4].items() if counts[i, j] == most[j])
            out.append((key, *f[:3], sum(f[4].values()), f[3], best, sum(n * counts[p] for p, n in f[4].items())))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in alignment.score_links(docs, A, B).collect()), key=str)


def test_odd_texts(tools):
    pick = random.Random(1)
    values = ["".join(pick.choice(ODD) for _ in range(pick.randrange(1, 40))) for _ in range(1500)]
    for lo in range(0, len(values), 250):
        part = values[lo : lo + 250]
        found, want = tools.align(part), [brute(tools, t) for t in part]
        assert found["good"].tolist() == [w is not None for w in want]
        want = [w for w in want if w]
        for k, w in enumerate(want):
            links = Counter({divmod(p, len(tools.bytes_b)): n for p, n in zip(found["pairs"][k].tolist(), found["times"][k].tolist())})
            assert (found["n_a"][k], found["n_b"][k], found["n_groups"][k], found["groups_sha256"][k], links) == w


def test_characters_that_split_otherwise_make_one_unit(tools):
    text = "one two\x1cthree four"
    tools.odd.add("\x1c")
    try:
        assert tools.units(text) == [text]
        assert tools.align([text])["groups_sha256"][0] == brute(tools, text)[3]
    finally:
        tools.odd.discard("\x1c")


def test_shared_characters_are_refined(tools):
    e = tools.a.encode(" 日", add_special_tokens=False)
    assert e.offsets[0][1] == e.offsets[1][1] == 2  # the library says that both end behind the character
    assert alignment.character_ends(" 日", e.ids, e.offsets, tools.bytes_a) == [2, 3, 4]
    ids, ends, sizes = tools.encode_b([" ࠀ"])  # no piece: three bytes
    assert ends[-3:] == [2, 3, 4] and sizes == [len(ids)]


def test_documents(spark, tools):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("length(text) < 1500").select("doc_id", "text")
    assert got(docs) == wanted(tools, [tuple(r) for r in docs.collect()])


def test_rare_pairs_are_shuffled(spark, tools, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("length(text) < 800").select("doc_id", "text")
    want = wanted(tools, [tuple(r) for r in docs.collect()])
    for hot in (0, 40):
        monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
        assert got(docs) == want


def test_counts_leave_a_task_in_parts(spark, tools, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("length(text) < 500").select("doc_id", "text")
    monkeypatch.setattr(alignment, "FLUSH", 10)
    assert got(docs) == wanted(tools, [tuple(r) for r in docs.collect()])


def test_a_full_table_starts_again(tools, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    for text in ("the first text of all", "another text", "the first text of all"):
        assert tools.align([text])["groups_sha256"] == [brute(tools, text)[3]]


def test_awkward_rows(spark, tools, awkward, no_docs, texts):
    short = awkward.filter("text IS NULL OR length(text) < 1000")
    assert got(short) == wanted(tools, [tuple(r) for r in short.collect()])
    assert alignment.align(awkward, A, B).count() == awkward.count()
    assert alignment.score_links(no_docs, A, B).collect() == []
    assert alignment.score_links(texts("a b"), A, B).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
