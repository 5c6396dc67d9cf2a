"""Overlaps, sessions and coverage, against plain loops."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import nodes, rows, ts
from logmetrics.operators import entries, intervals

START = datetime(2020, 1, 1)
at = lambda s: START + timedelta(seconds=s)


@pytest.fixture
def stretches(spark):
    """Intervals of several keys: short and long, of no length, touching, without an end."""
    pick = random.Random(4)
    rows_ = []
    for i in range(300):
        s = pick.randrange(0, 400_000)
        length = pick.choice((0, 1, 60, 600, 3_600, 90_000))
        rows_.append((pick.choice("abb"), f"n{i:03}", at(s), None if i % 50 == 0 else at(s + length)))
    rows_ += [("a", "x1", at(500_000), at(500_100)), ("a", "x2", at(500_100), at(500_200)), (None, "x3", at(0), at(10)), ("c", "x4", at(5), at(6))]
    return spark.createDataFrame(rows_, "cluster_id string, application_id string, start_time timestamp, end_time timestamp"), rows_


@pytest.mark.parametrize("bin_seconds, hot", [(None, 2000), (600, 5), (10_000_000, 7), (50_000, 3)])
def test_overlaps(stretches, bin_seconds, hot):
    df, listed = stretches
    want = set()
    for k, n, s, e in listed:
        for k2, n2, s2, e2 in listed:
            if k and k == k2 and n < n2 and e and e2 and (shared := (min(e, e2) - max(s, s2)).total_seconds()) > 0:
                want.add((k, n, n2, int(shared)))
    got = rows(intervals.overlapping_apps(df, bin_seconds, hot))
    assert len(got) == len(set(got)) and set(got) == want


def test_overlaps_need_no_nested_loop(stretches):
    df = intervals.overlapping_apps(stretches[0])
    df.collect()
    names = {n.nodeName() for n in nodes(df)}
    assert not any("NestedLoop" in n or "Cartesian" in n for n in names)


def test_overlaps_of_nothing(spark):
    none = spark.createDataFrame([], "cluster_id string, application_id string, start_time timestamp, end_time timestamp")
    assert intervals.overlapping_apps(none).collect() == [] and intervals.stage_islands(none).collect() == []


def test_sessions(lines):
    values = ["17/03/29 10:00:00 INFO a.A: x", "17/03/29 10:00:00 INFO a.A: y", "17/03/29 10:30:00 INFO a.A: just in", "no time",
              "17/03/29 11:00:01 INFO a.A: out", "17/03/29 09:00:00 INFO a.A: before"]
    got = intervals.container_sessions(entries.parse_entries(lines(*values)), gap_seconds=1800)
    assert rows(got.select("started", "ended", "lines"), "started") == [
        (ts("2017-03-29 09:00:00"), ts("2017-03-29 09:00:00"), 1), (ts("2017-03-29 10:00:00"), ts("2017-03-29 10:30:00"), 3),
        (ts("2017-03-29 11:00:01"), ts("2017-03-29 11:00:01"), 1)]


def test_coverage(stretches):
    df, listed = stretches
    got = {r.cluster_id: tuple(r)[1:] for r in intervals.coverage(df, ["cluster_id"]).collect()}
    by_key = defaultdict(list)
    for k, _, s, e in listed:
        if k and e:
            by_key[k].append((s, e))
    want = {}
    for k, found in by_key.items():
        found.sort()
        islands = [list(found[0])]
        for s, e in found[1:]:
            if s > islands[-1][1]:
                islands.append([s, e])
            else:
                islands[-1][1] = max(e, islands[-1][1])
        gaps = [int((b[0] - a[1]).total_seconds()) for a, b in zip(islands, islands[1:])]
        wall = int((islands[-1][1] - islands[0][0]).total_seconds())
        want[k] = (len(islands), wall, wall - sum(gaps), sum(gaps), max(gaps, default=0))
    assert got == want


def test_coverage_carries_an_end_over_days(spark):
    """A stretch of nine days covers later ones in ranges of their own."""
    found = [("a", at(0), at(800_000)), ("a", at(86_400 * 2 + 5), at(86_400 * 2 + 9)), ("a", at(86_400 * 5), at(86_400 * 5 + 1)), ("a", at(800_010), at(800_020))]
    df = spark.createDataFrame(found, "application_id string, start_time timestamp, end_time timestamp")
    assert rows(intervals.stage_islands(df)) == [("a", 2, 800_020, 800_010, 10, 10)]
    assert intervals.stage_islands(df.withColumn("application_id", F.lit(None).cast("string"))).collect() == []
