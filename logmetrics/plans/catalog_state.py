"""Queries on files that changed, on stored states, and on stretches of time."""

import uuid

from pyspark.sql import functions as F

from ..functions.staging import new_path, stage
from ..operators import daily as D
from ..operators import entries, events, heavy, intervals, memory, sketches, tasks
from ..sources import read_drifting, union_all
from . import bucketed, incremental
from . import rendered as R
from .catalog import _ORDERS_ALL, _TASKS_SQL, _TIMELINE_SQL, LEVEL, ORACLES, ORDERS, _durations, _parsed, _parsed_sql, _table, _timeline, query


@query("drifting_months", """
SELECT CAST(month(o_orderdate) AS INT) AS mm, count(*) AS orders, CAST(sum(o_custkey) AS DOUBLE) AS customers,
  round(sum(o_totalprice), 2) AS total, count(*) FILTER (month(o_orderdate) > 8) AS priorities
FROM orders WHERE year(o_orderdate) = 1997 GROUP BY ALL""")
def _(spark, sf_dir):
    # Four months with whole customer numbers, four with floating ones, four with another spelling and a column more.
    orders, base = _table(spark, sf_dir, "orders"), new_path(spark, "drifting")
    mm, plain = F.month("o_orderdate"), ["o_orderkey", "o_orderdate"]
    shapes = [
        (1, [*plain, "o_custkey", "o_totalprice"]),
        (5, [*plain, F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice"]),
        (9, [F.col("o_custkey").cast("int").alias("O_Custkey"), *plain, "o_totalprice", "o_orderpriority"]),
    ]
    for first, columns in shapes:
        orders.filter(mm.between(first, first + 3)).select(*columns).write.parquet(f"{base}/months-{first}")
    trips = D.in_year(read_drifting(spark, [f"{base}/months-*"]), "o_orderdate", 1997)
    return trips.groupBy(F.month("o_orderdate").alias("mm")).agg(
        F.count("*").alias("orders"), F.sum("o_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count("o_orderpriority").alias("priorities"),
    )


@query("monthly_quantiles", _ORDERS_ALL + """
SELECT dt_year, dt_month, CAST(sum(num_trips) AS BIGINT) AS num_trips, max(max_o_totalprice) AS max_o_totalprice,
  min(min_o_totalprice) AS min_o_totalprice, TRUE AS within_bound FROM daily GROUP BY ALL""")
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    # Stored once; months come from the stored days.
    daily = stage(sketches.daily_sketches(orders, ORDERS), "daily-sketches")
    monthly = sketches.merged_metrics(daily, "dt_year", "dt_month", measures=ORDERS)
    value = F.col("q95_o_totalprice")
    ranks = (
        D.with_date_parts(orders, "o_orderdate").join(monthly.select("dt_year", "dt_month", "q95_o_totalprice"), ["dt_year", "dt_month"])
        .groupBy("dt_year", "dt_month")
        .agg(F.count_if(F.col("o_totalprice") < value).alias("below"), F.count_if(F.col("o_totalprice") <= value).alias("upto"))
    )
    # Twice the bound, which one month in a hundred may miss.
    wanted, slack = F.col("num_trips") * 0.95, F.col("num_trips") * (2 * sketches.rank_error()) + 1
    within = (F.col("below") - slack <= wanted) & (wanted <= F.col("upto") + slack)
    checked = monthly.join(ranks, ["dt_year", "dt_month"]).withColumn("within_bound", within)
    return checked.select("dt_year", "dt_month", "num_trips", "max_o_totalprice", "min_o_totalprice", "within_bound")


@query("incremental_timeline", _TIMELINE_SQL + " SELECT * FROM timeline")
def _(spark, sf_dir):
    lines, root, ledger = R.logs(spark, sf_dir), new_path(spark, "tree"), new_path(spark, "ledger")
    for part in (0, 1):  # the second half of the files comes later
        R.write_log_tree(lines.filter(F.pmod(F.xxhash64("file_path"), F.lit(2)) == part), f"{root}/part-{part}")
        incremental.take_new_files(spark, root, ledger, glob="*.txt")
    return incremental.timeline(spark, ledger)


@query("overlapping_apps", _TIMELINE_SQL + """,
s AS (SELECT cluster_id, application_id, CAST(epoch(start_time) AS BIGINT) AS s, CAST(epoch(end_time) AS BIGINT) AS e FROM timeline)
SELECT a.cluster_id, a.application_id AS "first", b.application_id AS "second", least(a.e, b.e) - greatest(a.s, b.s) AS shared_seconds
FROM s a JOIN s b ON a.cluster_id = b.cluster_id AND a.application_id < b.application_id AND a.s < b.e AND b.s < a.e
WHERE a.s < a.e AND b.s < b.e""")
def _(spark, sf_dir):
    timeline = stage(_timeline(spark, sf_dir), "timeline")  # several branches read it; the text is scanned once
    return intervals.overlapping_apps(timeline)


@query("container_sessions", _parsed_sql() + """,
gaps AS (SELECT application_id, container_id, ts, CASE WHEN epoch(ts) - epoch(lag(ts) OVER w) <= 86400 THEN 0 ELSE 1 END AS fresh
  FROM parsed WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY application_id, container_id ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY application_id, container_id ORDER BY ts) AS session FROM gaps)
SELECT application_id, container_id, min(ts) AS started, max(ts) AS ended, count(*) AS lines
FROM numbered GROUP BY application_id, container_id, session""")
def _(spark, sf_dir):
    return intervals.container_sessions(_parsed(spark, sf_dir), gap_seconds=86_400)


@query("stage_islands", _TASKS_SQL + """,
stretches AS (SELECT application_id, CAST(epoch(start_time) AS BIGINT) AS s, CAST(epoch(end_time) AS BIGINT) AS e FROM durations WHERE end_time >= start_time),
before AS (SELECT *, max(e) OVER (PARTITION BY application_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM stretches),
gaps AS (SELECT *, CASE WHEN s > b THEN s - b END AS gap FROM before)
SELECT application_id, count(gap) + 1 AS islands, max(e) - min(s) AS wall_seconds,
  CAST(max(e) - min(s) - coalesce(sum(gap), 0) AS BIGINT) AS busy_seconds, CAST(coalesce(sum(gap), 0) AS BIGINT) AS idle_seconds,
  coalesce(max(gap), 0) AS longest_gap FROM gaps GROUP BY application_id""")
def _(spark, sf_dir):
    return intervals.stage_islands(_durations(spark, sf_dir))


@query("heavy_components", _parsed_sql() + f"""
SELECT regexp_extract(value, '{LEVEL}\\s+([^:]+):', 2) AS component, count(*) AS entries FROM valid
GROUP BY ALL ORDER BY entries DESC, component LIMIT 20""")
def _(spark, sf_dir):
    return heavy.heavy_components(entries.valid_entries(_parsed(spark, sf_dir)))


def _in_buckets(spark, parsed, lines, work):
    """``work`` per container, on entries stored in buckets for so many lines."""
    name, path = f"entries_{uuid.uuid4().hex}", new_path(spark, "bucketed")
    stored = bucketed.store_in_buckets(parsed, name, path, buckets=bucketed.buckets_for(lines))
    return bucketed.per_container(stored, path, work)


def _task_lines(spark, sf_dir):
    """At most: a start and an end to an order."""
    return 2 * _table(spark, sf_dir, "orders").count()


def _event_lines(spark, sf_dir):
    return _table(spark, sf_dir, "events").count()


@query("bucketed_task_durations", _TASKS_SQL + " SELECT * FROM durations")
def _(spark, sf_dir):
    parsed = entries.parse_entries(R.tasks(spark, sf_dir))
    return _in_buckets(spark, parsed, _task_lines(spark, sf_dir), lambda e: tasks.task_durations(tasks.task_spans(tasks.task_events(e))))


@query("bucketed_failures", ORACLES["failures"])
def _(spark, sf_dir):
    parsed = entries.parse_entries(union_all([R.tasks(spark, sf_dir), R.logs(spark, sf_dir)]))
    lines = _task_lines(spark, sf_dir) + _event_lines(spark, sf_dir)
    return _in_buckets(spark, parsed, lines, lambda e: tasks.failures(entries.valid_entries(e)))


@query("bucketed_memory_usage", ORACLES["memory_usage"])
def _(spark, sf_dir):
    parsed = entries.parse_entries(R.messages(spark, sf_dir))
    return _in_buckets(spark, parsed, _event_lines(spark, sf_dir), lambda e: memory.memory_usage(events.memory_blocks(e)))
