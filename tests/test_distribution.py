import math
import random

import numpy as np
import pytest

from conftest import nodes, plan, rows
from logmetrics.operators.distribution import log_density, log_histogram, sample_size


def kde(values, points):
    x = np.log10([v for v in values if v and v > 0])
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), points)
    z = (grid[:, None] - x[None, :]) / h
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(4)
    return [("a" if rnd.random() < 0.7 else "b", float(rnd.choice([5, rnd.randint(1, 5000)]))) for _ in range(800)] + [
        ("a", 0.0), ("b", -1.0), ("b", None), ("one", 3.0), ("flat", 2.0), ("flat", 2.0)]


def test_histogram(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.bin: r for r in log_histogram(df, "v", 4).collect()}
    assert got[None].n == 2 and got[None].low is None
    positive = [v for _, v in data if v and v > 0]
    assert sum(r.n for b, r in got.items() if b is not None) == len(positive)
    for b, r in got.items():
        if b is not None:
            assert r.n == sum(math.floor(math.log10(v) * 4) == b for v in positive)
            assert (r.low, r.high) == (pytest.approx(10 ** (b / 4)), pytest.approx(10 ** ((b + 1) / 4)))
    by = log_histogram(df, "v", 4, by="k")
    assert sum(r.n for r in by.collect()) == sum(v is not None for _, v in data)


def test_density_against_numpy(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    grid, want = kde([v for _, v in data], 40)
    got = rows(log_density(df, "v", points=40), "point")
    assert [g[1] for g in got] == pytest.approx(grid.tolist())
    assert [g[2] for g in got] == pytest.approx(want.tolist())
    for key in "ab":
        grid, want = kde([v for k, v in data if k == key], 30)
        mine = rows(log_density(df, "v", points=30, by="k").filter(f"k = '{key}'"), "point")
        assert [m[3] for m in mine] == pytest.approx(want.tolist())
    without = {r.density for r in log_density(df, "v", by="k").filter("k IN ('one', 'flat')").collect()}
    assert without == {None}


def test_density_adds_up(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(10 ** rnd.gauss(0, 1),) for _ in range(2000)], "v double")
    got = rows(log_density(df, "v", points=200), "point")
    step = got[1][1] - got[0][1]
    assert sum(g[2] for g in got) * step == pytest.approx(1, abs=0.02)


def test_density_joins_no_pairs(spark, data):
    text = plan(log_density(spark.createDataFrame(data, "k string, v double"), "v", by="k"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_numbers_without_a_place_on_the_axis(spark):
    data = [(k, v) for k in ("a", None) for v in (1.0, 10.0, 100.0, 0.0, -1.0, float("nan"), float("inf"), None)]
    df = spark.createDataFrame(data, "k string, v double")
    assert sum(r.n for r in log_histogram(df, "v").filter("bin IS NULL").collect()) == 8
    assert log_histogram(df, "v").filter("bin IS NOT NULL").agg({"n": "sum"}).first()[0] == 6
    assert tuple(sample_size(df, "v").first()) == (14, 6)
    dense = log_density(df, "v", points=5, by="k").collect()
    assert len(dense) == 10 and all(0 < r.density < 1 for r in dense)
    both = [[r.density for r in dense if r.k == k] for k in ("a", None)]
    assert sorted(both[0]) == sorted(both[1])


def test_density_within_its_bound(spark):
    """Against the kernels of every value, in units of a kernel's height."""
    rnd = random.Random(3)
    values = [10 ** rnd.gauss(0, 0.7) for _ in range(3000)] + [10 ** rnd.gauss(2, 0.01) for _ in range(3000)]
    grid, want = kde(values, 50)
    got = rows(log_density(spark.createDataFrame([(v,) for v in values], "v double"), "v"), "point")
    x = np.log10(values)
    height = 1 / (x.std(ddof=1) * len(x) ** -0.2 * math.sqrt(2 * math.pi))
    assert max(abs(g[2] - w) for g, w in zip(got, want)) <= height * (2 * 256) ** -4 / 8 + 1e-13


def test_values_leave_their_task_as_cells(spark):
    df = spark.range(200_000, numPartitions=4).selectExpr("CAST(1 + id % 50000 AS double) AS v")
    got = log_density(df, "v")
    got.collect()
    made = [n.metrics().apply("shuffleRecordsWritten").value() for n in nodes(got) if n.nodeName() == "Exchange"]
    assert made and max(made) < 4 * 256 * 100
