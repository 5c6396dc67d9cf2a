import random
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import rows, ts
from logmetrics.operators import entries, report
from logmetrics.operators import timeline as T
from logmetrics.operators.running import previous_row, running_total
from logmetrics.schemas import APP_TIMELINE

# Applications of the public log collection.
KNOWN = """\
1440487435730 0039 2015-09-01 18:14:40 2015-09-01 18:19:50
1448006111297 0137 2016-04-07 10:45:21 2016-04-07 11:28:11
1448006111297 0138 2016-04-07 11:39:58 2016-04-07 12:22:08
1460011102909 0176 2016-07-26 11:54:20 2016-07-26 12:19:25
1472621869829 0081 2016-09-09 07:43:47 2016-09-09 07:44:12
1472621869829 0082 2016-09-09 07:45:49 2016-09-09 07:45:59
1472621869829 0083 2016-09-09 07:46:50 2016-09-09 07:47:09
1472621869829 0084 2016-09-09 07:48:25 2016-09-09 07:48:49
1472621869829 0085 2016-09-09 07:51:18 2016-09-09 07:51:44
1472621869829 0086 2016-09-09 07:52:43 2016-09-09 07:53:05
1472621869829 0087 2016-09-09 08:04:46 2016-09-09 08:05:19
1472621869829 0088 2016-09-09 10:06:51 2016-09-09 10:07:06
1474351042505 2578 2016-11-18 22:30:06 2016-11-19 00:59:04
1485248649253 0014 2017-03-14 21:23:57 2017-03-14 21:31:23
1485248649253 0015 2017-03-14 21:24:02 2017-03-14 21:33:36
1485248649253 0016 2017-03-14 21:26:48 2017-03-14 21:32:46
1485248649253 0017 2017-03-14 21:22:44 2017-03-14 21:38:38"""


def known(spark):
    data = []
    for line in KNOWN.splitlines():
        cluster, app, d1, t1, d2, t2 = line.split()
        data.append((cluster, f"application_{cluster}_{app}", app, ts(f"{d1} {t1}"), ts(f"{d2} {t2}")))
    return spark.createDataFrame(data, APP_TIMELINE)


def test_cluster_summary_of_known_applications(spark):
    got = T.cluster_summary(known(spark)).filter("cluster_id < '1485'")
    assert rows(got, "cluster_id") == [
        ("1440487435730", 1, ts("2015-09-01 18:14:40"), ts("2015-09-01 18:19:50")),
        ("1448006111297", 2, ts("2016-04-07 10:45:21"), ts("2016-04-07 12:22:08")),
        ("1460011102909", 1, ts("2016-07-26 11:54:20"), ts("2016-07-26 12:19:25")),
        ("1472621869829", 8, ts("2016-09-09 07:43:47"), ts("2016-09-09 10:07:06")),
        ("1474351042505", 1, ts("2016-11-18 22:30:06"), ts("2016-11-19 00:59:04")),
    ]


def test_report_of_known_totals(spark):
    # Applications per cluster of the whole collection.
    counts = [("1485248649253", 181), ("1472621869829", 8), ("1448006111297", 2), ("1440487435730", 1),
              ("1460011102909", 1), ("1474351042505", 1)]
    summary = spark.createDataFrame(counts, "cluster_id string, num_applications bigint")
    lines = [r.line for r in report.cluster_report(summary).orderBy("ord").collect()]
    assert lines == [
        "Total unique clusters: 6", "Total applications: 194", "Average applications per cluster: 32.33", "",
        "Most heavily used clusters:", "  Cluster 1485248649253: 181 applications",
        "  Cluster 1472621869829: 8 applications", "  Cluster 1448006111297: 2 applications"]
    assert rows(T.largest_cluster(summary)) == [counts[0]]
    empty = T.cluster_summary(spark.createDataFrame([], APP_TIMELINE))
    assert rows(T.cluster_stats(empty)) == [(0, 0, None)]
    assert report.cluster_report(empty).count() == 5


def test_timeline_from_lines(lines):
    path = "/l/application_7_{0}/container_7_{0}_01_{1}.log".format
    df = (
        lines("17/03/29 10:00:00 INFO a: b", "note 17/03/30 00:00:00 INFO late", "no time", path=path("0001", "000001"))
        .union(lines("17/03/29 09:59:00 INFO a: b", path=path("0001", "000002")))
        .union(lines("no time", path=path("0002", "000001")))
        .union(lines("17/03/29 10:00:00 INFO a: b", "x", path="/misc/other.log"))
    )
    loose, tight = entries.parse_entries(df, anchored=False), entries.parse_entries(df)
    want = [("7", "application_7_0001", "0001", ts("2017-03-29 09:59:00"), ts("2017-03-30 00:00:00")),
            ("7", "application_7_0002", "0002", None, None)]
    nobody = ("", "", "", ts("2017-03-29 10:00:00"), ts("2017-03-29 10:00:00"))
    assert [tuple(r) for r in T.sorted_timeline(T.app_timeline(loose)).collect()] == [nobody, *want]
    assert [tuple(r) for r in T.sorted_timeline(T.app_timeline(loose, keep_unmatched=False)).collect()] == want
    assert T.app_timeline(tight).agg(F.max("end_time")).first()[0] == ts("2017-03-29 10:00:00")
    assert rows(T.unmatched_lines(loose)) == [(2, 1)]
    assert T.app_timeline(loose, keep_unmatched=True).filter("application_id = ''").count() == 1
    per_container = rows(T.container_timeline(tight), "container_id")
    assert [(r[2], r[5]) for r in per_container] == [(None, 2), ("AM", 3), ("executor", 1), ("AM", 1)]


def test_durations_of_the_largest_cluster(spark):
    timeline = known(spark)
    got = T.with_duration(T.largest_cluster_apps(timeline, T.cluster_summary(timeline)))
    assert {r.cluster_id for r in got.collect()} == {"1472621869829"}
    assert sorted(round(r.duration_min, 2) for r in got.collect()) == [0.17, 0.25, 0.32, 0.37, 0.4, 0.42, 0.43, 0.55]


def test_order_of_applications(spark):
    got = T.out_of_order_apps(known(spark)).collect()
    assert [(r.app_number, r.previous_app) for r in got] == [("0017", "0016")]


def random_timeline(spark, n=400, hot=0.5):
    rnd = random.Random(3)
    data, used = [], set()
    for _ in range(n):
        cluster = "1" if rnd.random() < hot else str(rnd.randint(2, 5))
        number = rnd.choice([rnd.randint(0, 40_000), rnd.randint(9_990, 10_010)])
        if (cluster, number) in used:
            continue
        used.add((cluster, number))
        start = ts("2020-01-01 00:00:00") + timedelta(seconds=rnd.randint(0, 400_000))
        end = start + timedelta(seconds=rnd.choice([0, 1, 60, 3600, 200_000]))
        data.append((cluster, f"application_{cluster}_{number:04d}", f"{number:04d}", start, end))
    return data, spark.createDataFrame(data, APP_TIMELINE)


def test_concurrency_against_brute_force(spark):
    data, timeline = random_timeline(spark)
    got = T.app_concurrency(timeline)
    for cluster, at, _, running in rows(got):
        assert running == sum(c == cluster and s <= at < e for c, _, _, s, e in data)
    last = {}
    for cluster, at, _, running in rows(got, "cluster_id", "at"):
        last[cluster] = running
    assert set(last.values()) == {0}
    for cluster, peak, at in rows(T.peak_concurrency(got)):
        mine = [(a, r) for c, a, _, r in rows(got, "at") if c == cluster]
        assert (at, peak) == next(x for x in mine if x[1] == max(r for _, r in mine))


def test_out_of_order_against_brute_force(spark):
    data, timeline = random_timeline(spark)
    want = set()
    for cluster in {d[0] for d in data}:
        mine = sorted((int(d[2]), d) for d in data if d[0] == cluster)
        want |= {b[1][1] for a, b in zip(mine, mine[1:]) if b[1][3] < a[1][3]}
    got = T.out_of_order_apps(timeline).collect()
    assert {f"application_{r.cluster_id}_{r.app_number}" for r in got} == want and want


def test_running_values_against_brute_force(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("aaab"), i, rnd.randint(-5, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, i int, v bigint").repartition(8)
    span = F.floor(F.col("i") / 37)
    total = {(k, i): r for k, i, _, r in rows(running_total(df, ["k"], ["i"], span, {"v": "run"}))}
    before = {(k, i): p for k, i, _, p in rows(previous_row(df, ["k"], "i", span, ["v"], "prev"))}
    assert len(total) == len(before) == len(data)
    run, prev = {}, {}
    for k, i, v in data:
        run[k] = run.get(k, 0) + v
        assert total[k, i] == run[k]
        assert (before[k, i].v if before[k, i] else None) == prev.get(k)
        prev[k] = v
