"""Entries in buckets: work per container without shuffles; and heavy values in bounded memory."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA, nodes, plan, rows, write_tree
from logmetrics.operators import entries, events, heavy, levels, memory, tasks
from logmetrics.plans import bucketed, rendered
from logmetrics.plans.catalog import QUERIES

WORK = {
    "bucketed_task_durations": "task_durations", "bucketed_failures": "failures", "bucketed_memory_usage": "memory_usage",
}


@pytest.mark.parametrize("name", sorted(WORK))
def test_no_exchange(spark, name):
    got = QUERIES[name](spark, DATA)
    got.collect()
    names = [n.nodeName() for n in nodes(got)]
    # Rows that carry over from day to day may go to every task if they are few; nothing is dealt out by key.
    assert not any("Exchange" in n and "Broadcast" not in n for n in names) and any(n.startswith("Scan") for n in names)
    plain = QUERIES[WORK[name]](spark, DATA)
    plain.collect()
    assert any("Exchange" in n.nodeName() for n in nodes(plain))


@pytest.mark.parametrize("name", sorted(WORK))
def test_same_rows(spark, name):
    got, want = QUERIES[name](spark, DATA), QUERIES[WORK[name]](spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_tree_in_buckets(spark, tmp_path):
    files = {f"application_1_000{a}/container_1_000{a}_01_00000{c}.log": [f"17/03/29 10:00:0{c} INFO a.A: {a}{c}", "more"] for a in (1, 2) for c in (1, 2, 3)}
    root = write_tree(tmp_path / "in", files)
    stored = bucketed.bucketed_entries(spark, root, "entries_tree", f"{tmp_path}/table", buckets=4)
    assert stored.count() == 12 and stored.filter("container_id = 'container_1_0002_01_000003'").count() == 2
    assert len(list((tmp_path / "table").glob("part-*"))) <= 4
    assert rows(bucketed.spread(spark, f"{tmp_path}/table").select("raw", "container_id"), "container_id", "raw") == rows(stored.select("raw", "container_id"), "container_id", "raw")
    assert "Bucketed: true" not in plan(bucketed.spread(spark, f"{tmp_path}/table"))
    again = bucketed.bucketed_entries(spark, root, "entries_tree", f"{tmp_path}/table", buckets=4)
    assert again.count() == 12
    spark.sql("DROP TABLE entries_tree")


def test_stored_events_keep_their_columns(spark):
    parsed = entries.parse_entries(rendered.tasks(spark, DATA))
    stored = bucketed.store_in_buckets(parsed, "entries_tasks", rendered.new_path(spark, "b"), buckets=3)
    assert rows(tasks.task_events(stored), "ts", "tid", "event") == rows(tasks.task_events(parsed), "ts", "tid", "event")
    assert memory.memory_usage(events.memory_blocks(stored)).collect() == []
    spark.sql("DROP TABLE entries_tasks")


def plain(df, column, k):
    return rows(df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(k))


@pytest.mark.parametrize("buckets", [1, 7, 1000, 1 << 16])
def test_heavy_values(spark, buckets):
    df = spark.range(3_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 100 = 1 THEN NULL WHEN id % 50 < 5 THEN concat('m', id % 50) ELSE concat('x', id) END AS v")
    for k in (1, 5, 8, 50):
        assert rows(heavy.heavy_values(df, "v", k, buckets)) == plain(df, "v", k)


def test_millions_of_values(spark):
    df = spark.range(2_000_000).selectExpr("CASE WHEN id % 10 = 0 THEN concat('heavy', id % 13) ELSE concat('rare', id) END AS v")
    got = heavy.heavy_values(df, "v", 13)
    assert rows(got) == plain(df.filter("v LIKE 'heavy%'"), "v", 13)
    # What is grouped: the heavy values and the rare ones of their buckets, some hundreds of 1.8 million.
    got.collect()
    grouped = [n for n in nodes(got) if n.nodeName().startswith("HashAggregate")]
    made = [n.metrics().apply("numOutputRows").value() for n in grouped]
    assert made and max(made) < 5_000


def test_ties_fewer_values_and_no_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b",)], "v string")
    assert rows(heavy.heavy_values(df, "v", 2)) == [("a", 2), ("b", 2)]
    assert rows(heavy.heavy_values(df, "v", 9)) == [("a", 2), ("b", 2), ("c", 1)]
    assert heavy.heavy_values(df.limit(0), "v", 3).collect() == []


def test_heavy_components(spark):
    parsed = entries.valid_entries(entries.parse_entries(rendered.logs(spark, DATA)))
    assert rows(heavy.heavy_components(parsed, 4)) == rows(levels.top_components(parsed, 4))


def part_files(spark, name):
    return {f for f in spark.table(name).inputFiles() if "/part-" in f}


def test_a_large_container_is_written_in_parts(spark):
    # One container of some 25 MB packed. No task sorts it whole; before, its bucket was one task and one file.
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting, None)
    text = F.concat(F.lit("17/03/29 10:00:00 INFO a.A: "), *[F.sha2(F.concat("id", F.lit(x)), 512) for x in "ab"])
    lines = spark.range(0, 100_000, 1, 4).select(text.alias("value"), F.lit("/application_1_0001/container_1_0001_01_000002.log").alias("file_path"))
    stored = bucketed.store_in_buckets(entries.parse_entries(lines), "entries_large", rendered.new_path(spark, "b"), buckets=4)
    assert len(part_files(spark, "entries_large")) > 1
    assert stored.count() == 100_000 and stored.select("raw").distinct().count() == 100_000
    assert spark.conf.get(setting, None) == before
    spark.sql("DROP TABLE entries_large")


def test_buckets_follow_the_lines():
    assert [bucketed.buckets_for(n) for n in (0, 1, 4_000_000, 5_000_001, 10**10)] == [16, 16, 16, 21, 200]


@pytest.mark.parametrize("name, lines", [("bucketed_failures", 4_000), ("bucketed_memory_usage", 1_000), ("bucketed_task_durations", 3_000)])
def test_more_lines_more_buckets(spark, monkeypatch, name, lines):
    monkeypatch.setattr(bucketed, "BUCKET_LINES", lines // 25)
    found = plan(QUERIES[name](spark, DATA))
    assert "out of 25" in found and "out of 16" not in found


@pytest.mark.parametrize("name", sorted(WORK))
def test_large_containers_are_shuffled(spark, monkeypatch, name):
    # Of the containers, only the lines without one ('') are so many.
    monkeypatch.setattr(bucketed, "CONTAINER_LINES", 20)
    got, want = QUERIES[name](spark, DATA), QUERIES[WORK[name]](spark, DATA)
    got.collect()
    assert any("Exchange" in n.nodeName() and "Broadcast" not in n.nodeName() for n in nodes(got))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("most", [0, 1, 2, 3, 9])
def test_per_container_keeps_every_row(spark, most):
    path = lambda seq: f"/application_1_0001/container_1_0001_01_00000{seq}.log"
    files = [path(1)] * 3 + [path(2)] * 2 + [path(3)] + [None] * 4 + ["/misc/x.log"] * 2
    lines = spark.createDataFrame([(f"17/03/29 10:00:0{i % 9} INFO a.A: {i}", f) for i, f in enumerate(files)], "value string, file_path string")
    parsed, at = entries.parse_entries(lines), rendered.new_path(spark, "b")
    stored = bucketed.store_in_buckets(parsed, f"entries_most_{most}", at, buckets=3)
    got = bucketed.per_container(stored, at, lambda e: e.groupBy("container_id").agg(F.count("*").alias("n"), F.min("raw").alias("first")), most)
    assert sorted(map(str, got.collect())) == sorted(map(str, stored.groupBy("container_id").agg(F.count("*").alias("n"), F.min("raw").alias("first")).collect()))
    assert sorted(r["n"] for r in got.collect()) == [1, 2, 2, 3, 4]
    spark.sql(f"DROP TABLE entries_most_{most}")
