from types import SimpleNamespace

import pytest

from conftest import DATA, plan, rows, ts, write_tree
from logmetrics.functions.staging import shared_dir
from logmetrics.operators import daily as D
from logmetrics.plans import jobs, rendered
from logmetrics.schemas import APP_TIMELINE, CLUSTER_SUMMARY, LEVEL_COUNTS, LOG_ENTRY
from logmetrics.sources import load_result

FILES = {
    "application_1_0001/container_1_0001_01_000001.log": [
        "17/03/29 10:00:00 INFO a.A: begin, with comma", "\tat x", "17/03/29 10:10:00 ERROR a.A: end"],
    "application_1_0002/container_1_0002_01_000001.log": ["17/03/29 10:05:00 INFO a.A: begin", "17/03/29 10:25:00 WARN a.A: end"],
    "application_2_0001/container_2_0001_01_000001.log": ["17/03/30 10:00:00 INFO a.A: only"],
}


def text(folder):
    (part,) = folder.glob("part-*")
    return part.read_text()


@pytest.mark.parametrize("sample", ["earliest", "hash"])
def test_level_distribution(spark, tmp_path, sample):
    root, out = write_tree(tmp_path / "in", FILES), tmp_path / "out"
    jobs.level_distribution(spark, root, str(out), sample=sample)
    assert text(out / "level_counts").splitlines() == ["log_level,count", "INFO,3", "ERROR,1", "WARN,1"]
    assert text(out / "level_report").splitlines()[:2] == ["Total log lines processed: 6", "Total lines with log levels: 5"]
    drawn = text(out / "level_sample").splitlines()
    assert drawn[0] == "log_entry,log_level" and len(drawn) == 6
    assert '"17/03/29 10:00:00 INFO a.A: begin, with comma",INFO' in drawn
    assert rows(load_result(spark, f"{out}/level_counts", LEVEL_COUNTS), "log_level")[0] == ("ERROR", 1)


def test_cluster_usage_and_resuming(spark, tmp_path):
    root, out = write_tree(tmp_path / "in", FILES), tmp_path / "out"
    jobs.cluster_usage(spark, root, str(out))
    assert rows(load_result(spark, f"{out}/timeline", APP_TIMELINE), "application_id")[0] == (
        "1", "application_1_0001", "0001", ts("2017-03-29 10:00:00"), ts("2017-03-29 10:10:00"))
    first = rows(load_result(spark, f"{out}/cluster_summary", CLUSTER_SUMMARY), "cluster_id")
    assert first[0] == ("1", 2, ts("2017-03-29 10:00:00"), ts("2017-03-29 10:25:00"))
    assert "  Cluster 1: 2 applications" in text(out / "cluster_report")
    assert len(text(out / "duration_density").splitlines()) == 51
    jobs.cluster_usage(spark, None, str(out), resume=True)
    assert rows(load_result(spark, f"{out}/cluster_summary", CLUSTER_SUMMARY), "cluster_id") == first


def test_entry_table(spark, tmp_path):
    root = write_tree(tmp_path / "in", {**FILES, "misc/other.log": ["17/03/29 10:00:00 INFO a.A: nobody's"]})
    table = jobs.entry_table(spark, root, str(tmp_path / "table"))
    assert table.columns == LOG_ENTRY.names and table.count() == 7
    one = table.filter("cluster_id = '2'")
    assert "PartitionFilters: [isnotnull(cluster_id" in plan(one)
    (row,) = one.collect()
    assert (row.app_number, row.ts, row.level, row.component, row.message, row.container_role) == (
        "0001", ts("2017-03-30 10:00:00"), "INFO", "a.A", "only", "AM")
    assert [r.raw for r in table.filter("cluster_id IS NULL").collect()] == ["17/03/29 10:00:00 INFO a.A: nobody's"]


def test_a_cluster_must_name_its_shared_folder():
    def session(folder, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder))

    assert shared_dir(session("hdfs://h/shared/", "spark://h:7077")) == "hdfs://h/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "spark://h:7077"))


def test_daily_report(spark, tmp_path):
    orders = D.Measures("o_orderdate", "o_totalprice", "o_totalprice", "o_totalprice", "o_totalprice", "o_custkey")
    paths = [f"{DATA}/orders.parquet", f"{DATA}/orders-2.parquet"]
    whole = jobs.daily_report(spark, paths, str(tmp_path / "a"), 1997, measures=orders).first()
    table = rendered.month_table(spark, DATA)
    half = jobs.daily_report(spark, table, str(tmp_path / "b"), 1997, months=range(1, 7), measures=orders, exact=True).first()
    assert 0 < half.total_trips < whole.total_trips
    assert str(half.first_day) == str(whole.first_day) and half.last_day.month == 6
    assert text(tmp_path / "a" / "daily_metrics").startswith("dt_year,dt_month,dt_day,num_trips,mean_o_totalprice,")


def test_staged_tables_of_a_scope_go(spark):
    from pathlib import Path

    from logmetrics.functions import staging

    with staging.scope(spark):
        path = staging.new_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert Path(path).exists()
    assert not Path(path).exists()
