"""Files whose schemas differ."""

import warnings
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import nodes, plan, rows
from logmetrics.operators.daily import in_year
from logmetrics.sources import drift_report, inexact_values, read_drifting
from logmetrics.sources.drift import common_schema, common_type, schema_groups

LONG, INT, DOUBLE, TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("a, b, want", [
    (INT, LONG, LONG), (T.ByteType(), T.ShortType(), T.ShortType()), (LONG, DOUBLE, DOUBLE), (T.FloatType(), DOUBLE, DOUBLE),
    (INT, T.DecimalType(5, 2), T.DecimalType(12, 2)), (T.DecimalType(10, 4), T.DecimalType(12, 2), T.DecimalType(14, 4)),
    (LONG, T.DecimalType(38, 30), DOUBLE), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
    (T.TimestampType(), T.TimestampNTZType(), T.TimestampType()), (T.NullType(), TEXT, TEXT), (LONG, TEXT, TEXT), (T.BooleanType(), TEXT, TEXT),
    (T.BooleanType(), INT, None), (T.DateType(), INT, None), (T.ArrayType(INT), T.ArrayType(LONG), None), (T.BinaryType(), TEXT, None),
])
def test_common_type(a, b, want):
    assert common_type(a, b) == want and common_type(b, a) == want


@pytest.fixture
def months(spark, tmp_path):
    at = "timestamp'2021-0{m}-05 10:00:00' AS ts"
    shapes = {
        "1": "id * {big} AS passengers, 1.5D AS fare, {at}",
        "2": "CAST(id AS double) + 0.5 AS passengers, 2 AS fare, {at}",
        "3": "CAST(id AS int) AS Passengers, {at}, 3.5D AS fare, 'x' AS airport",
        "4": "id * {big} AS passengers, 1.5D AS fare, {at}",
    }
    for m, columns in shapes.items():
        spark.range(4).coalesce(1).selectExpr(*columns.format(at=at.format(m=m), big=2**53 // 2 + 1).split(", ")).write.parquet(f"{tmp_path}/m{m}")
    return str(tmp_path)


def read(spark, path):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return read_drifting(spark, f"{path}/m*")


def test_one_table_of_differing_months(spark, months):
    with pytest.raises(Exception):
        spark.read.parquet(f"{months}/m*").collect()  # what a plain scan makes of them
    got = read(spark, months)
    assert [(f.name, f.dataType) for f in got.schema] == [("passengers", DOUBLE), ("fare", DOUBLE), ("ts", T.TimestampType()), ("airport", TEXT)]
    per_month = got.groupBy(F.month("ts").alias("m")).agg(F.count("*"), F.sum("fare"), F.count("airport"), F.min("passengers"))
    assert rows(per_month, "m") == [(1, 4, 6.0, 0, 0.0), (2, 4, 8.0, 0, 0.5), (3, 4, 14.0, 4, 0.0), (4, 4, 6.0, 0, 0.0)]


def test_one_scan_per_schema_and_filters_pushed(spark, months):
    got = in_year(read(spark, months), "ts", 2021).select("fare")
    got.collect()
    scans = [n.toString() for n in nodes(got) if n.nodeName().startswith("Scan")]
    assert len(scans) == 3
    text = plan(got)
    assert text.count("GreaterThanOrEqual(ts") == 3 and "passengers" not in text.lower() and "airport" not in text


def test_what_a_cast_may_lose_is_told(spark, months):
    with pytest.warns(UserWarning, match="passengers: bigint of 2 files is read as double"):
        read_drifting(spark, f"{months}/m*")
    assert rows(inexact_values(spark, f"{months}/m*")) == [("passengers", 2)]  # 3 * (2^52 + 1) is odd and beyond 2^53, in two files
    report = {tuple(r) for r in drift_report(spark, f"{months}/m*").collect()}
    assert {r for r in report if r[0] in ("passengers", "airport")} == {
        ("passengers", "bigint", 2, "double", False), ("passengers", "double", 1, "double", True), ("passengers", "int", 1, "double", True),
        ("airport", None, 3, "string", True), ("airport", "string", 1, "string", True),
    }
    assert inexact_values(spark, f"{months}/m[23]").collect() == []


def test_types_with_nothing_in_common(spark, tmp_path):
    spark.range(1).selectExpr("true AS a").write.parquet(f"{tmp_path}/x")
    spark.range(1).selectExpr("1 AS a").write.parquet(f"{tmp_path}/y")
    with pytest.raises(ValueError, match="column a .*boolean, int"):
        read_drifting(spark, f"{tmp_path}/*")
    assert len(schema_groups(spark, f"{tmp_path}/*")) == 2 and common_schema(schema_groups(spark, f"{tmp_path}/x")).simpleString() == "struct<a:boolean>"


def test_partition_columns_missing_and_empty_files(spark, tmp_path):
    spark.range(2).selectExpr("id AS a").write.parquet(f"{tmp_path}/yyyy=2020")
    spark.range(2).selectExpr("id + 0.5D AS a", "now() AS `b.c`").limit(0).write.parquet(f"{tmp_path}/yyyy=2021")
    paths = [f"{tmp_path}/yyyy={y}" for y in (2020, 2021, 2022)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = read_drifting(spark, paths, base_path=str(tmp_path), skip_missing=True)
    assert [f.name for f in got.schema] == ["a", "yyyy", "b.c"]
    assert rows(got.select("a", "yyyy"), "a") == [(0.0, 2020), (1.0, 2020)]
    with pytest.raises(FileNotFoundError):
        read_drifting(spark, [f"{tmp_path}/none"], skip_missing=True)


def test_dates_become_timestamps(spark, tmp_path):
    spark.range(1).selectExpr("date'2021-03-04' AS ts").write.parquet(f"{tmp_path}/a")
    spark.range(1).selectExpr("timestamp_ntz'2021-03-04 05:06:07' AS ts").write.parquet(f"{tmp_path}/b")
    got = read_drifting(spark, f"{tmp_path}/*")
    assert rows(in_year(got, "ts", 2021), "ts") == [(datetime(2021, 3, 4),), (datetime(2021, 3, 4, 5, 6, 7),)]
