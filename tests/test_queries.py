import re

import pytest

import oracle
from __spark_entry__ import entry, oracle_sql
from logmetrics.plans.catalog import QUERIES
from pyspark.sql import functions as F

from conftest import DATA, nodes, plan
from logmetrics.operators import distribution, entries

@pytest.fixture(scope="module")
def duck():
    return oracle.connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    assert oracle.differences(got, duck.sql(oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry(spark).columns == ["log_level", "count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for bad in ("NestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


SCANS_ONCE = [
    "level_counts", "level_share", "report_lines", "line_totals", "app_timeline", "cluster_summary", "top_clusters",
    "app_concurrency", "out_of_order_apps", "memory_usage", "memory_headroom", "inventory_counts", "task_skew",
    "stage_bottlenecks", "container_timeline", "daily_rollup", "cluster_report", "largest_cluster_durations",
]


@pytest.mark.parametrize("name", SCANS_ONCE)
def test_scans_its_table_once(spark, name):
    """After running, for only then are repeated shuffles found and shared."""
    df = QUERIES[name](spark, DATA)
    df.collect()
    read = [n.toString() for n in nodes(df) if n.nodeName().startswith("Scan")]
    assert sum(DATA in text for text in read) <= 1


def test_scans_in_subqueries_are_counted(spark):
    data = spark.read.parquet(f"{DATA}/nation.parquet")
    df = data.filter(F.col("n_nationkey") == data.agg(F.max("n_nationkey")).scalar())
    df.collect()
    assert sum(n.nodeName().startswith("Scan") for n in nodes(df)) == 2


def test_tests_reach_a_stored_table(spark, tmp_path):
    from logmetrics.plans.rendered import logs

    entries.parse_entries(logs(spark, DATA)).write.parquet(str(tmp_path / "entries"))
    stored = spark.read.parquet(str(tmp_path / "entries"))
    for df in (entries.valid_entries(stored), entries.errors(entries.valid_entries(stored))):
        pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(df))[1]
        assert "IsNotNull(ts)" in pushed and "level" in pushed
    parsed = entries.parse_entries(logs(spark, DATA))
    assert entries.valid_entries(stored).count() == entries.valid_entries(parsed).count()


def test_densities_shuffle_no_values(spark):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = distribution.log_density(spark.read.parquet(f"{DATA}/events.parquet"), "value", by="event_type")
        df.collect()
        shuffled = [n.toString().split("\n")[0] for n in nodes(df) if n.nodeName() == "Exchange"]
        below = [n.children().apply(0).nodeName() for n in nodes(df) if n.nodeName() == "Exchange"]
        assert len(shuffled) == 1 and "WholeStageCodegen" in below[0]
        assert not any("Join" in n.nodeName() and "Broadcast" not in n.nodeName() for n in nodes(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_timeline_takes_ids_per_file(spark):
    """The path is taken apart above the first aggregation, not on every line."""
    df = QUERIES["app_timeline"](spark, DATA)
    text = plan(df)
    below = text[text.rindex("HashAggregate(keys=[file_path"):]
    assert "application_(" not in below
