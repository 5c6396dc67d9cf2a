import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA, plan, rows
from logmetrics.operators import daily as D
from logmetrics.schemas import DAILY_METRICS

TRIP = "tpep_pickup_datetime timestamp_ntz, trip_distance double, mta_tax double, fare_amount double, tip_amount double, passenger_count double"


def trips(spark, n=3000):
    """Half of the trips on one day, fares with ties and nulls, some of other years."""
    rnd = random.Random(1)
    data = []
    for i in range(n):
        day = datetime(2021, 3, 1) if rnd.random() < 0.5 else datetime(2020, 12, 25) + timedelta(days=rnd.randint(0, 400))
        fare = None if rnd.random() < 0.05 else rnd.choice([10.0, round(rnd.gauss(20, 30), 2)])
        data.append((day + timedelta(seconds=rnd.randint(0, 86399)), rnd.random() * 9, rnd.choice([0.5, 0.0]), fare,
                     round(rnd.random() * 5, 2), float(rnd.randint(1, 6))))
    data.append((datetime(2021, 8, 8, 1), 1.0, 0.5, None, 0.0, 1.0))
    data.append((None, 1.0, 0.5, 1.0, 0.0, 1.0))
    return data, spark.createDataFrame(data, TRIP)


def expected(data, year, q=0.95):
    days = {}
    for at, distance, tax, fare, tip, people in data:
        if at and at.year == year:
            days.setdefault((at.year, at.month, at.day), []).append((distance, tax, fare, tip, people))
    for day, records in days.items():
        distance, tax, fare, tip, people = zip(*records)
        fares = sorted(f for f in fare if f is not None)
        quantile = fares[max(math.ceil(len(fares) * q), 1) - 1] if fares else None
        yield (*day, len(records), round(sum(distance) / len(records), 9), max(tax), quantile, min(tip),
               math.ceil(sum(people) / len(people)))


def test_exact_metrics_against_brute_force(spark):
    data, df = trips(spark)
    got = D.daily_metrics(df, year=2021, exact=True)
    assert got.columns == DAILY_METRICS.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in DAILY_METRICS]
    found = rows(got.withColumn("mean_trip_distance", F.round("mean_trip_distance", 9)))
    want = [(*w[:4], pytest.approx(w[4]), *w[5:]) for w in sorted(expected(data, 2021), reverse=True)]
    assert sorted(found, reverse=True) == want


@pytest.mark.parametrize("q", [0.0, 0.5, 0.999, 1.0])
def test_exact_quantile_with_a_narrow_band(spark, q):
    """A coarse sketch leaves a real band, so all three zones hold values."""
    rnd = random.Random(2)
    values = [float(rnd.randint(0, 4000)) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    dated = df.select(F.lit(2021).alias("dt_year"), F.lit(1).alias("dt_month"), F.lit(1).alias("dt_day"), "v")
    got = D._with_exact_quantile(dated, [F.count("*").alias("n")], "v", q, "out", accuracy=100)
    assert rows(got.select("out")) == [(sorted(values)[max(math.ceil(len(values) * q), 1) - 1],)]


def test_exact_quantile_of_odd_values(spark):
    """Ties alone, infinities, decimals, and a band without width."""
    day = ("2021 AS dt_year", "CAST(id % 4 AS INT) + 1 AS dt_month", "1 AS dt_day")
    value = ("CASE id % 4 WHEN 0 THEN 7D WHEN 1 THEN if(id < 2000, double('-inf'), double('inf'))"
             " WHEN 2 THEN CAST(id AS double) ELSE NULL END AS v")
    dated = spark.range(4000).selectExpr(*day, value, "CAST(id AS decimal(12,2)) AS d")
    got = D._with_exact_quantile(dated, [F.count("*").alias("n")], "v", 0.5, "out", accuracy=100)
    assert rows(got.select("dt_month", "n", "out"), "dt_month") == [
        (1, 1000, 7.0), (2, 1000, float("-inf")), (3, 1000, 1998.0), (4, 1000, None)]
    exact = D._with_exact_quantile(dated, [F.count("*").alias("n")], "d", 0.25, "out", accuracy=50)
    assert [float(r.out) for r in exact.orderBy("dt_month").collect()] == [996.0, 997.0, 998.0, 999.0]


def test_approximate_quantile_has_bounded_rank_error(spark):
    data, df = trips(spark)
    got = {r[:3]: r[6] for r in rows(D.daily_metrics(df, year=2021))}
    assert set(got) == {w[:3] for w in expected(data, 2021)}
    fares = sorted(t[3] for t in data if t[0] and t[0].date() == datetime(2021, 3, 1).date() and t[3] is not None)
    assert abs(np.searchsorted(fares, got[2021, 3, 1]) / len(fares) - 0.95) < 0.01


def test_approximate_quantile_of_a_large_day(spark):
    n = 200_000
    df = spark.range(n).selectExpr(
        "timestamp'2021-05-05 00:00:00' + make_dt_interval(0, 0, 0, id % 86400) AS tpep_pickup_datetime",
        "1.0D AS trip_distance", "0.5D AS mta_tax", f"CAST((id * 7919) % {n} AS double) AS fare_amount",
        "0.0D AS tip_amount", "1.0D AS passenger_count")
    rough, exact = (D.daily_metrics(df, year=2021, exact=e).first().q95_fare_amount for e in (False, True))
    assert exact == 0.95 * n - 1
    assert abs(rough - exact) <= n / 10_000


def test_order_and_rollup(spark):
    data, df = trips(spark)
    daily = D.daily_metrics(df, year=2021)
    days = [r[:3] for r in rows(D.latest_first(daily))]
    assert days == sorted(days, reverse=True)
    assert [r[:3] for r in rows(D.latest_days(daily, 5))] == days[:5]
    roll = D.daily_rollup(daily).first()
    assert roll.total_trips == sum(1 for t in data if t[0] and t[0].year == 2021)
    assert (roll.days, str(roll.first_day), str(roll.last_day)) == (
        len(days), "{}-{:02d}-{:02d}".format(*days[-1]), "{}-{:02d}-{:02d}".format(*days[0]))
    assert roll.mean_daily_trips == pytest.approx(roll.total_trips / len(days))


def test_year_is_pushed_into_the_scan(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    got = D.in_year(orders, "o_orderdate", 1997)
    text = plan(got.select("o_totalprice"))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in text and "LessThan(o_orderdate,1998-01-01T00:00)" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert {r[0].year for r in got.select("o_orderdate").collect()} == {1997}


def test_year_of_zoned_times(spark):
    df = spark.sql("SELECT explode(array(timestamp'2020-12-31 23:59:59', timestamp'2021-01-01 00:00:00',"
                   " timestamp'2021-12-31 23:59:59.9', timestamp'2022-01-01 00:00:00')) AS at")
    assert D.in_year(df, "at", 2021).count() == 2


def test_a_missed_band_is_widened(spark, monkeypatch):
    """With a band that misses the rank, the days are ranked again and come out the same."""
    data = [(datetime(2021, 1, 1 + i % 3), float(i * 7919 % 1000)) for i in range(900)]
    df = spark.createDataFrame(data, "ts timestamp, v double").withColumn("w", F.lit(1))
    m = D.Measures("ts", "v", "v", "v", "v", "w")
    want = rows(D.daily_metrics(df, m, exact=True), "dt_day")
    real = D.F.percentile_approx
    monkeypatch.setattr(D.F, "percentile_approx", lambda c, q, a: D.F.transform(real(c, q, a), lambda x: x * 0 + 3.0))
    assert rows(D.daily_metrics(df, m, exact=True), "dt_day") == want
