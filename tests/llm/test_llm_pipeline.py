"""The pipeline: every stage judged on its own input."""

import pytest

import corpus_pipeline as pipeline
from conftest import DATA
from __spark_entry__ import queries
from logmetrics.llm import quality_rules, toxicity
from logmetrics.llm.pieces import pieces_of
from logmetrics.llm.queries import QUERIES, held_out, tokenizer_path
from logmetrics.llm.text import read
from test_llm_passages import brute as passages
from test_llm_similarity import brute as groups


@pytest.fixture(scope="module")
def documents(spark):
    return read(spark, DATA, "documents")


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_and_registration():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "quality_rules", "jaccard_join", "decontamination", "sentencepiece"]
    assert queries()["pipeline"] is pipeline.run
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_toxicity_stage(spark, documents):
    got = pipeline.drop_toxic(spark, documents, DATA)
    assert got.columns == documents.columns
    model = toxicity.fit(documents, read(spark, DATA, "labels").filter(~held_out()))
    assert ids(got) == ids(toxicity.score(documents, model).filter("score < 0.3"))


def test_quality_stage(spark, documents):
    got = pipeline.drop_poor(spark, documents, DATA)
    assert got.columns == documents.columns
    field = quality_rules.fit(documents, read(spark, DATA, "labels"))
    assert ids(got) == ids(quality_rules.judge(documents, field).filter("kept"))


def test_near_duplicate_stage(spark, documents):
    got = pipeline.drop_near_duplicates(spark, documents, DATA)
    want = groups([(r.doc_id, r.text) for r in documents.collect()], 5, 80)
    assert ids(got) == sorted(k for k, (_, top) in want.items() if k == top)
    assert got.columns == documents.columns and got.count() < documents.count()


def test_decontamination_stage(spark, documents):
    got = pipeline.drop_contaminated(spark, documents, DATA)
    items = read(spark, DATA, "benchmark").collect()
    assert ids(got) == sorted(r.doc_id for r in documents.collect() if not passages(r.text, items, 10)[1])
    assert got.columns == documents.columns and got.count() < documents.count()


def test_last_stage(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = pipeline.to_pieces(spark, documents, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows[:50]:
        assert r.ids == pieces_of(tokenizer_path("piece_bpe_32k.model")).encode([texts[r.doc_id]])[0].tolist()


def test_columns_of_any_name_pass(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven", "a", 1, True), (None, None, "b", 2, False)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, n_words int, kept boolean")
    for _, stage in pipeline.STAGES[:4]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and 1 in [r.doc_id for r in out.collect()]


def test_run(spark):
    docs = read(spark, DATA, "documents")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert ids(pipeline.run(spark, DATA)) == ids(docs)
    assert 0 < docs.count() < 200


def test_copies_with_one_id_or_none_stay_once(spark):
    one, two = ("one two three four five six seven eight nine ten", "all of it other words than those that stand above here")
    rows = [(1, one), (1, one), (2, one), (3, two), (3, one + " " + two), (None, two), (None, two + " again and more of it still"), (None, two + " again and more of it still"), (None, None), (None, None), (4, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id bigint, text string, lang string")
    got = sorted((r.doc_id or 0, r.text or "") for r in pipeline.drop_near_duplicates(spark, docs, DATA).collect())
    assert got == sorted([(0, ""), (0, ""), (0, two + " again and more of it still"), (1, one), (3, two), (3, one + " " + two), (4, ""), (5, "")])


def test_an_empty_table_goes_through_every_stage(spark, documents):
    none = documents.limit(0)
    for _, work in pipeline.STAGES:
        assert work(spark, none, DATA).collect() == []


def test_only_texts_go_through_python(spark, documents):
    """The stages that judge send one column to Python and get one back."""
    for work in (pipeline.drop_toxic, pipeline.drop_poor, pipeline.drop_contaminated):
        nodes = work(spark, documents, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" in nodes and "MapInArrow" not in nodes


def test_items_in_several_passes(spark, documents):
    items = read(spark, DATA, "benchmark")
    want = ids(pipeline.drop_contaminated(spark, documents, DATA))
    size = sum(len(r.text.encode()) for r in items.collect())
    got = pipeline.decontamination.without_hits(documents, items, block_bytes=size // 8, pass_bytes=size // 3)
    assert ids(got) == want and got.columns == documents.columns


def test_rows_without_key_are_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "doc_id bigint").select("doc_id", held_out().alias("h")).collect()
    assert all(isinstance(r.h, bool) for r in rows) and not rows[0].h
