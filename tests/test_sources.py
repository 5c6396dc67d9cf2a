import pytest
from pyspark.sql import functions as F

from conftest import plan, rows, write_tree
from logmetrics.schemas import APP_TIMELINE
from logmetrics.sinks import save_csv, save_report
from logmetrics.sources import (
    describe_source, existing_paths, file_inventory, inventory_summary, largest_applications, load_result,
    month_paths, read_logs, read_months, read_trips, register_views, union_all,
)
from logmetrics.plans import rendered
from conftest import DATA

A, B = "application_1_0001", "application_2_0001"
TREE = {
    f"{A}/container_1_0001_01_000001.log": ["one", "two"],
    f"{A}/container_1_0001_01_000002.log": ["three"],
    f"deep/er/{B}/container_2_0001_01_000001.log": ["four"],
    "root.log": ["five"],
    "Spark.tar.gz": ["not a log"],
}


def test_read_logs_takes_every_depth(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    got = read_logs(spark, root)
    assert sorted(r.value for r in got.collect()) == ["five", "four", "one", "three", "two"]
    assert {(r.value, r.file_path.rsplit("/", 1)[1]) for r in got.collect() if r.value == "three"} == {
        ("three", "container_1_0001_01_000002.log")}
    assert {r.block_start for r in got.collect()} == {0}


def test_read_logs_of_some_applications(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    assert {r.value for r in read_logs(spark, root, applications=[A]).collect()} == {"one", "two", "three"}
    assert read_logs(spark, root, applications=["application_1_*"]).count() == 3


def test_inventory(spark, tmp_path):
    root = write_tree(tmp_path, TREE)
    assert file_inventory(spark, root).filter("application_id = ''").count() == 1
    found = file_inventory(spark, root, keep_unmatched=False)
    assert rows(found.select("application_id", "files", "containers", "bytes"), "application_id") == [
        (A, 2, 2, 14), (B, 1, 1, 5)]
    assert [r.application_id for r in largest_applications(found, 1).collect()] == [A]
    total = inventory_summary(found).first()
    assert (total.applications, total.files, total.bytes, total.smallest_bytes, total.largest_bytes) == (2, 3, 19, 5, 14)
    assert "content" not in plan(found)


def test_a_broken_file_is_reported(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 nothing PAR1")
    got = describe_source(spark, str(tmp_path / "bad.parquet")).first()
    assert got.problem and got.column_name is None and got.problem != "PATH_NOT_FOUND"


def test_rolled_and_packed_logs_are_read(spark, tmp_path):
    write_tree(tmp_path, {"a.log": ["1"], "a.log.1": ["2"], "c/stderr": ["3"], "x.zip": ["no"], "a.log.zip": ["no"], "notes.txt": ["no"]})
    assert sorted(r.value for r in read_logs(spark, str(tmp_path)).collect()) == ["1", "2", "3"]


def test_month_paths():
    assert month_paths("s3a://b/t/", 2021, [1, 12]) == [
        "s3a://b/t/yyyy=2021/yellow_tripdata_2021-01.parquet",
        "s3a://b/t/yyyy=2021/yellow_tripdata_2021-12.parquet",
    ]


def test_existing_paths(spark, tmp_path):
    (tmp_path / "a.parquet").mkdir()
    paths = [f"{tmp_path}/a.parquet", f"{tmp_path}/b.parquet", f"{tmp_path}/a*", f"{tmp_path}/c*"]
    assert existing_paths(spark, paths) == [paths[0], paths[2]]
    with pytest.raises(FileNotFoundError):
        existing_paths(spark, paths[1:2])


def test_month_files_keep_their_partition(spark, tmp_path):
    base = str(tmp_path / "trips")
    for path in month_paths(base, 2021, [1, 3]):
        spark.range(2).write.parquet(path)
    wanted = month_paths(base, 2021)
    got = read_trips(spark, wanted, base_path=base, skip_missing=True)
    assert rows(got.groupBy("yyyy").count()) == [(2021, 4)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_trips(spark, wanted)


def test_months_prune_partitions(spark):
    got = read_months(spark, rendered.month_table(spark, DATA), 1997, [1, 2])
    text = plan(got)
    assert "PartitionFilters: [isnotnull(yyyy" in text and "mm" in text.split("PartitionFilters")[1][:120]
    assert {r.mm for r in got.select("mm").distinct().collect()} == {1, 2}


def test_results_keep_their_types(spark, tmp_path):
    df = spark.sql(
        "SELECT '0042' AS cluster_id, 'application_0042_0007' AS application_id, '0007' AS app_number,"
        " timestamp'2017-03-29 09:55:33' AS start_time, CAST(NULL AS timestamp) AS end_time"
    )
    save_csv(df, f"{tmp_path}/t", single=True)
    (part,) = (tmp_path / "t").glob("part-*.csv")
    assert part.read_text().splitlines()[1] == "0042,application_0042_0007,0007,2017-03-29T09:55:33.000Z,\"\"" or \
        part.read_text().splitlines()[1] == "0042,application_0042_0007,0007,2017-03-29T09:55:33.000Z,"
    assert load_result(spark, f"{tmp_path}/t", APP_TIMELINE).collect() == df.collect()
    save_csv(df, f"{tmp_path}/t", single=True, timestamp_format="yyyy-MM-dd HH:mm:ss")
    (part,) = (tmp_path / "t").glob("part-*.csv")
    assert "2017-03-29 09:55:33" in part.read_text()


def test_all_parts_are_read_back(spark, tmp_path):
    df = spark.range(40, numPartitions=4).select(F.col("id").cast("string").alias("cluster_id"))
    save_csv(df, f"{tmp_path}/p")
    assert len(list((tmp_path / "p").glob("part-*.csv"))) == 4
    assert load_result(spark, f"{tmp_path}/p", df.schema).count() == 40


def test_report_keeps_order(spark, tmp_path):
    df = spark.createDataFrame([(2, "c"), (0, "a"), (1, "")], "ord int, line string").repartition(3)
    save_report(df, f"{tmp_path}/r")
    (part,) = (tmp_path / "r").glob("part-*.txt")
    assert part.read_text() == "a\n\nc\n"


def test_describe_source(spark):
    got = describe_source(spark, f"{DATA}/events.parquet")
    assert ("ts", "timestamp_ntz", 1000, None) in rows(got)
    (missing,) = rows(describe_source(spark, f"{DATA}/nothing.parquet"))
    assert missing == (None, None, None, "PATH_NOT_FOUND")


def test_union_and_views(spark):
    both = union_all([spark.range(2), spark.range(3).withColumn("x", F.lit(1))])
    assert rows(both.groupBy("x").count(), "x") == [(None, 2), (1, 3)]
    register_views(numbers=spark.range(1000))
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 1000
