"""Repeated lines, against a plain count."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from llm_fixtures import awkward, no_docs, texts  # noqa: F401
from logmetrics.llm import line_dedup


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, length=20, documents=3):
    """(key, lines, dropped, text) of every row."""
    held = defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n") if key is not None else ():
            held[key_of(line)].add(key)
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        gone = [key is not None and len(k) >= length and len(held[k]) >= documents and max(held[k]) != key for k in map(key_of, lines)]
        out.append((key, len(lines), sum(gone), "\n".join(line for line, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def result(docs, **options):
    return sorted((tuple(r) for r in line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, **options)).collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute([tuple(r) for r in docs.collect()])


@pytest.fixture
def hot(spark):
    """One line in every document, twice in some; others in a few."""
    pick = random.Random(3)
    rows = []
    for i in range(400):
        lines = ["the line that every document holds", *(f"a line of group number {pick.randrange(60)} only" for _ in range(pick.randrange(6))), "short"]
        lines += ["  THE line that every document holds\r"] * (i % 5 == 0) + [""] * (i % 3)
        pick.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("options", [{}, {"least_documents": 1}, {"least_documents": 5}, {"least_length": 1}])
def test_a_line_over_many_partitions(spark, hot, options):
    docs = spark.createDataFrame(hot, "doc_id bigint, text string")
    got = result(docs, **options)
    assert got == brute(hot, options.get("least_length", 20), options.get("least_documents", 3))


def test_partitions_hold_parts_of_a_hash(spark, hot):
    """The common line's rows lie in several partitions, and their sums settle it."""
    docs = spark.createDataFrame(hot, "doc_id bigint, text string")
    hashes = line_dedup.line_hashes(docs, "doc_id", "text", 20)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    parts = hashes.repartitionByRange(8, *order).withColumn("p", F.spark_partition_id())
    most = parts.groupBy("h1", "h2").agg(F.countDistinct("p").alias("p")).agg(F.max("p")).first()[0]
    assert most > 1
    assert parts.groupBy("h1", "h2", "doc").agg(F.countDistinct("p").alias("p")).filter("p > 1").isEmpty()


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_stream_by_any_batches(size):
    """However the sorted rows are cut into partitions and batches, the same lines go."""
    pick = random.Random(size)
    rows = sorted({(pick.randrange(12), 0, pick.randrange(9), 0, pick.randrange(4)) for _ in range(150)}, key=lambda r: (r[0], -r[2], r[4]))
    schema = pa.schema([(n, pa.int64()) for n in ("h1", "h2", "doc", "t")] + [("line", pa.int32()), ("state", pa.int32())])
    cuts = [0, *sorted(pick.sample(range(1, len(rows)), 5)), len(rows)]
    cuts = [c for c in cuts if c in (0, len(rows)) or rows[c][:3] != rows[c - 1][:3]]  # rows of one document and hash stay together
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        stream, own = line_dedup.Stream(3, schema), []
        for lo in range(a, b, size):
            columns = list(zip(*rows[lo : min(lo + size, b)]))
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], names=schema.names[:5])
            own += list(stream.take(batch))
        own += list(stream.close())
        found = pa.concat_tables(own).to_pylist()
        assert sum(r["state"] == line_dedup.SUM for r in found) <= 2
        out += found
    documents = defaultdict(set)
    for h, _, doc, *_ in rows:
        documents[h].add(doc)
    sums, top = defaultdict(int), {}
    for r in out:
        if r["state"] == line_dedup.SUM:
            sums[r["h1"]] += r["line"]
            top[r["h1"]] = max(r["doc"], top.get(r["h1"], r["doc"]))
    gone = {(r["h1"], r["doc"], r["line"]) for r in out if r["state"] == line_dedup.DROP}
    gone |= {(r["h1"], r["doc"], r["line"]) for r in out if r["state"] == line_dedup.OPEN and sums[r["h1"]] >= 3 and r["doc"] != top[r["h1"]]}
    assert gone == {(h, doc, line) for h, _, doc, _, line in rows if len(documents[h]) >= 3 and doc != max(documents[h])}


def test_bitmaps():
    lines = [f"line {i}" for i in range(19)]
    for dropped in ([0], [18], [0, 7, 8, 18], list(range(19))):
        n, gone, text = line_dedup.kept_lines("\n".join(lines), line_dedup.pack(np.array(dropped)))
        assert (n, gone, text) == (19, len(dropped), "\n".join(x for i, x in enumerate(lines) if i not in dropped))
    assert line_dedup.kept_lines(None, None) == (1, 0, "")
    assert len(zlib.decompress(line_dedup.pack(np.array([15])))) == 2


def test_awkward_rows(spark, awkward, no_docs, texts):
    rows = [tuple(r) for r in awkward.collect()]
    assert result(awkward) == brute(rows)
    long = "the same line, again and again\n" * 30_000
    many = [(i, long) for i in range(4)] + [(2, "the same line, again and again\nother"), (None, long)]
    assert result(spark.createDataFrame(many, "doc_id bigint, text string")) == brute(many)
    named = spark.createDataFrame([(f"d{i}", "a line that three documents hold") for i in range(3)], "doc_id string, text string")
    assert [r[2] for r in result(named)] == [1, 1, 0]
    assert result(no_docs) == []
    assert line_dedup.apply_bitmaps(texts("a"), line_dedup.keep_bitmaps(texts("a"))).columns == ["doc_id", "n_lines", "n_dropped", "kept"]
