"""Words, token counts, pieces: against the libraries and plain Python."""

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import pieces, text, tokens
from logmetrics.llm.queries import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
AWKWARD = [
    "", " ", "  a  b ", "\n", "a\n b\n\nc", "\t x", "<s>hi</s> <unk> <0x0A>", "▁x", "a▁b", "ﬁ ①  Ａ", " x", "▁▁ ▁a", "x" * 3000, "aaaaaaa",
    "\r\n a\r", "a\x00b", "日本語 テスト", "🙂🙂 a🙂", " " * 40 + "x", " " * 17, "abababab", "----====", "Internationalization don't 3.14159",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def documents(spark):
    return [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()]


def test_token_counts_are_the_librarys(library, documents):
    given_ = documents + AWKWARD
    assert tokens.counts_of(MODEL).count(given_) == [len(x) for x in library.encode(given_, num_threads=1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n▁é<>0xt日.", max_size=30), max_size=5))
def test_any_text(values):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = [library.encode(v) for v in values]
    assert tokens.counts_of(MODEL).count(values) == [len(w) for w in want]
    assert [e.tolist() for e in pieces.pieces_of(MODEL).encode(values)] == want


def test_whole_tokens_are_proved():
    counts = tokens.counts_of(MODEL)
    assert " the" in counts.whole and all(n == 1 for n in counts.merge(sorted(counts.whole)[:500]))
    with pytest.raises(ValueError):
        counts._prove(["a▁b"])


def test_token_count_rows(awkward, texts, no_docs):
    got = [tuple(r) for r in tokens.count_tokens(awkward, MODEL).collect()]
    assert len(got) == awkward.count()
    assert (1, 0, 0, False) in got and (2, 0, 0, False) in got and (None, 0, 0, False) in got
    assert next(r for r in got if r[0] == 5)[3] is True
    assert tokens.count_tokens(texts("a b"), MODEL).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert tokens.count_tokens(no_docs, MODEL).collect() == []


def test_pieces_are_the_librarys(library, documents):
    given_ = documents + AWKWARD
    got = pieces.pieces_of(MODEL).encode(given_)
    assert [g.tolist() for g in got] == library.encode(given_, num_threads=1)


def test_pieces_round_trip(awkward, no_docs):
    encoded = pieces.encode(awkward, MODEL, keep=("doc_id", "text"))
    rows = pieces.decode(encoded, MODEL, keep=("doc_id", "text"), out="again").collect()
    assert len(rows) == awkward.count() and all(r.again == (r.text or "") for r in rows)
    assert all(r.round_trip for r in pieces.encode(awkward, MODEL, verify=True).collect())
    assert pieces.decode(pieces.encode(no_docs, MODEL), MODEL).collect() == []


def test_a_small_memory_of_words_changes_nothing(monkeypatch, documents):
    whole = pieces.Pieces(MODEL).encode(documents[:20])
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    monkeypatch.setattr(pieces, "CELLS", 50)
    small = pieces.Pieces(MODEL)
    assert all((a == b).all() for a, b in zip(whole, small.encode(documents[:10]) + small.encode(documents[10:20])))


def test_runs_hold_whole_texts():
    values = ["ab c", None, "", "x" * 50, " y\nz ", "é"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(values)}).slice(0)
    seen, words = [], []
    for lo, hi, data, bounds in text.runs(batch, "text", limit=10):
        seen += range(lo, hi)
        starts, ends, owner = text.word_bounds(data, bounds)
        words += [(lo + o, data[a:b].tobytes().decode()) for a, b, o in zip(starts, ends, owner)]
    assert seen == list(range(6))
    assert words == [(i, w) for i, v in enumerate(values) for w in (v or "").split()]


def test_hashes_depend_on_content_only():
    data = np.frombuffer(b"abc abd abc ab", np.uint8)
    h = text.span_hashes(data, *text.word_bounds(data, np.array([0, len(data)]))[:2])
    assert h[0] == h[2] and len(set(h.tolist())) == 3
