"""Sketches of days that add up."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA, nodes, rows
from logmetrics.functions.staging import stage
from logmetrics.operators import daily as D
from logmetrics.operators import sketches

ORDERS = D.Measures("o_orderdate", "o_totalprice", "o_totalprice", "o_totalprice", "o_totalprice", "o_custkey")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


@pytest.fixture(scope="module")
def stored(orders):
    return stage(sketches.daily_sketches(orders, ORDERS), "daily-sketches")


def test_days_equal_daily_metrics(orders, stored):
    """A day has fewer records than the sketch has places, so its quantile is exact."""
    got = sketches.merged_metrics(stored, *D.DAY, measures=ORDERS)
    want = D.daily_metrics(orders, ORDERS, exact=True)
    same = ["dt_year", "dt_month", "dt_day", "num_trips", "max_o_totalprice", "q95_o_totalprice", "min_o_totalprice", "mean_o_custkey"]
    assert got.columns == want.columns and rows(got.select(*same), *D.DAY) == rows(want.select(*same), *D.DAY)


@pytest.mark.parametrize("period", [("dt_year", "dt_month"), ("dt_year",), ()])
@pytest.mark.parametrize("q", [0.05, 0.5, 0.95])
def test_ranks_of_merged_days(orders, stored, period, q):
    got = sketches.merged_metrics(stored, *period, measures=ORDERS, q=q)
    name = f"q{round(q * 100)}_o_totalprice"
    values = D.with_date_parts(orders, "o_orderdate").groupBy(*period).agg(F.sort_array(F.collect_list("o_totalprice")).alias("all"), F.avg("o_totalprice").alias("mean"))
    both = got.join(values, list(period)) if period else got.crossJoin(values)
    for r in both.collect():
        n = r.num_trips
        assert n == len(r["all"]) and r.mean_o_totalprice == pytest.approx(r.mean)
        rank = sum(v <= r[name] for v in r["all"])
        assert r[name] in r["all"] and abs(rank - q * n) <= 2 * sketches.rank_error() * n + 1


def test_merging_reads_no_records(stored):
    got = sketches.merged_metrics(stored, "dt_year", measures=ORDERS)
    got.collect()
    scans = [n.toString() for n in nodes(got) if n.nodeName().startswith("Scan")]
    assert len(scans) == 1 and DATA not in scans[0]


def test_days_without_values(spark):
    df = spark.createDataFrame(
        [("2021-01-01", None), ("2021-01-02", 1.0), ("2021-01-02", 2.0), ("2021-02-01", None), (None, 5.0)], "ts string, v double"
    ).withColumn("ts", F.to_timestamp("ts"))
    m = D.Measures("ts", "v", "v", "v", "v", "v")
    daily = sketches.daily_sketches(df, m)
    assert daily.count() == 3
    got = rows(sketches.merged_metrics(daily, "dt_month", measures=m), "dt_month")
    assert got == [(1, 3, 1.5, 2.0, 2.0, 1.0, 2), (2, 1, None, None, None, None, None)]
    assert sketches.daily_sketches(df.limit(0), m).collect() == []


def test_error_shrinks_with_size():
    assert 0.005 < sketches.rank_error(800) < 0.006 and sketches.rank_error(4000) < sketches.rank_error(800) / 4
