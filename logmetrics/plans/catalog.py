"""Every query by name, with the SQL that must give the same rows in DuckDB.

A query takes (spark, directory of parquet tables) and returns a DataFrame. Each
runs over its whole tables. Means and densities are rounded on both sides; daily
means are nudged off exact ties first, which the two engines may round apart.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.staging import new_path, stage
from ..operators import daily as D
from ..operators import distribution, entries, events, levels, memory, multiline, report, sampling, tasks
from ..operators import timeline as T
from ..schemas import APP_TIMELINE
from ..sinks import save_csv, save_report
from ..sources import (
    describe_source, file_inventory, inventory_summary, largest_applications, load_result, read_logs, read_months, read_trips, register_views,
    source_sample, union_all, with_ids,
)
from . import jobs
from . import rendered as R

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parsed(spark, sf_dir, anchored=True, style="colon"):
    return entries.parse_entries(R.logs(spark, sf_dir), anchored=anchored, component_style=style)


def _timeline(spark, sf_dir):
    return T.app_timeline(_parsed(spark, sf_dir, anchored=False))


def _rounded(df, *columns, digits=6, nudge=0.0):
    return df.withColumns({c: F.round(F.col(c) + nudge, digits) for c in columns})


# Parsing in DuckDB, in the same steps.
STAMP = r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
LEVEL = "(INFO|WARN|ERROR|DEBUG)"


def _time_sql(pattern):
    return f"try_strptime(nullif(regexp_extract(value, '{pattern}', 1), ''), '%y/%m/%d %H:%M:%S')"


_IDS_SQL = r"""
    regexp_extract(file_path, 'application_(\d+)_(\d+)', 0) AS application_id,
    regexp_extract(file_path, 'application_(\d+)_(\d+)', 1) AS cluster_id,
    regexp_extract(file_path, 'application_(\d+)_(\d+)', 2) AS app_number,
    regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 0) AS container_id,
    regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 3) AS attempt,
    regexp_extract(file_path, 'container_(\d+)_(\d+)_(\d+)_(\d+)', 4) AS container_seq"""


def _parsed_sql(view=R.LOGS_SQL, anchored=True):
    ts = _time_sql(("^" if anchored else "") + STAMP)
    return f"""WITH {view},
parsed AS (SELECT line_no, file_path, value, {ts} AS ts, regexp_extract(value, '{LEVEL}', 1) AS level, {_IDS_SQL}
  FROM logs),
valid AS (SELECT * FROM parsed WHERE level <> '' AND ts IS NOT NULL)"""


_TIMELINE_SQL = _parsed_sql(anchored=False) + """,
timeline AS (SELECT cluster_id, application_id, app_number, min(ts) AS start_time, max(ts) AS end_time
  FROM parsed GROUP BY ALL),
summary AS (SELECT cluster_id, count(*) AS num_applications, min(start_time) AS cluster_first_app,
    max(end_time) AS cluster_last_app FROM timeline GROUP BY cluster_id)"""

# ---------------------------------------------------------------- sources, sinks


@query("log_scan", f"WITH {R.LOGS_SQL} SELECT value, count(*) AS copies FROM logs GROUP BY value")
def _(spark, sf_dir):
    lines = read_logs(spark, R.log_tree(spark, sf_dir), glob="*.txt")
    return lines.groupBy("value").agg(F.count("*").alias("copies"))


@query("log_lineage", _parsed_sql() + """
SELECT application_id, container_id, count(*) AS lines FROM parsed GROUP BY ALL""")
def _(spark, sf_dir):
    lines = read_logs(spark, R.log_tree(spark, sf_dir), glob="*.txt")
    per_file = lines.groupBy("file_path").agg(F.count("*").alias("lines"))
    return with_ids(per_file, keep_unmatched=True).groupBy("application_id", "container_id").agg(
        F.sum("lines").alias("lines")
    )


_TRIPS_SQL = """
SELECT CAST(year(o_orderdate) AS INT) AS yyyy, CAST(month(o_orderdate) AS INT) AS mm,
  count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN ({months}) GROUP BY ALL"""


def _monthly(orders):
    return orders.groupBy("yyyy", "mm").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("parquet_multi_scan", _TRIPS_SQL.format(months="1, 2, 3"))
def _(spark, sf_dir):
    base = R.month_table(spark, sf_dir)
    return _monthly(read_trips(spark, [f"{base}/yyyy=1997/mm={m}" for m in (1, 2, 3)], base_path=base))


@query("month_pruned_scan", _TRIPS_SQL.format(months="1, 2, 3, 4, 5, 6"))
def _(spark, sf_dir):
    return _monthly(read_months(spark, R.month_table(spark, sf_dir), 1997, range(1, 7)))


@query("tolerant_scan", """
SELECT CAST(year(o_orderdate) AS INT) AS yyyy, CAST(month(o_orderdate) AS INT) AS mm,
  count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE year(o_orderdate) = 2001 GROUP BY ALL""")
def _(spark, sf_dir):
    # The orders end in 2001; the months after the last one are not there.
    base = R.month_table(spark, sf_dir)
    year = [f"{base}/yyyy=2001/mm={m}" for m in range(1, 13)]
    return _monthly(read_trips(spark, year, base_path=base, skip_missing=True))


@query("parquet_glob_scan", """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""")
def _(spark, sf_dir):
    return read_trips(spark, f"{sf_dir}/orders*.parquet").groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("csv_roundtrip", _TIMELINE_SQL + " SELECT * FROM timeline")
def _(spark, sf_dir):
    path = new_path(spark, "timeline")
    save_csv(_timeline(spark, sf_dir), path)
    return load_result(spark, path, APP_TIMELINE)


@query("resume_from_timeline", _TIMELINE_SQL + " SELECT * FROM summary")
def _(spark, sf_dir):
    path = new_path(spark, "timeline")
    save_csv(_timeline(spark, sf_dir), path)
    return T.cluster_summary(load_result(spark, path, APP_TIMELINE))


@query("source_profile", """
SELECT c.column_name, c.data_type, (SELECT count(*) FROM events) AS row_count, CAST(NULL AS VARCHAR) AS problem
FROM (VALUES ('event_id', 'bigint'), ('ts', 'timestamp_ntz'), ('user_id', 'bigint'),
  ('event_type', 'string'), ('value', 'double'), ('props', 'string')) c(column_name, data_type)""")
def _(spark, sf_dir):
    return describe_source(spark, f"{sf_dir}/events.parquet")


_INVENTORY = """,
inventory AS (SELECT application_id, count(DISTINCT file_path) AS files, count(DISTINCT nullif(container_id, '')) AS containers,
    CAST(sum(length(value) + 1) AS BIGINT) AS bytes FROM parsed GROUP BY ALL)"""


def _inventory(spark, sf_dir):
    return file_inventory(spark, R.container_tree(spark, sf_dir), glob="*.txt")


@query("file_inventory", _parsed_sql() + """
{_INVENTORY} SELECT * FROM inventory""".replace("{_INVENTORY}", _INVENTORY))
def _(spark, sf_dir):
    return _inventory(spark, sf_dir)


@query("largest_applications", _parsed_sql() + _INVENTORY + " SELECT * FROM inventory ORDER BY files DESC, application_id LIMIT 5")
def _(spark, sf_dir):
    return largest_applications(_inventory(spark, sf_dir))


@query("inventory_summary", _parsed_sql() + _INVENTORY + """
SELECT count(*) AS applications, CAST(sum(files) AS BIGINT) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, min(bytes) AS smallest_bytes,
  max(bytes) AS largest_bytes, round(avg(bytes), 6) AS mean_bytes, round(avg(files), 6) AS mean_files FROM inventory""")
def _(spark, sf_dir):
    return _rounded(inventory_summary(_inventory(spark, sf_dir)), "mean_bytes", "mean_files")


@query("source_sample", "SELECT event_id, user_id, event_type, props FROM events ORDER BY event_id LIMIT 5")
def _(spark, sf_dir):
    return source_sample(_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props"), 5, ["event_id"])


@query("entry_table", _parsed_sql() + """
SELECT cluster_id, application_id, container_id, level, count(*) AS entries, count(ts) AS stamped, min(ts) AS first_ts,
  max(ts) AS last_ts FROM parsed GROUP BY ALL""")
def _(spark, sf_dir):
    table = jobs.entry_table(spark, R.log_tree(spark, sf_dir), new_path(spark, "entries"), glob="*.txt")
    # A partition column reads '' back as null.
    cluster = F.coalesce("cluster_id", F.lit("")).alias("cluster_id")
    return table.groupBy(cluster, "application_id", "container_id", "level").agg(
        F.count("*").alias("entries"), F.count("ts").alias("stamped"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query("union_scan", """
SELECT kind, count(*) AS n, count(amount) AS amounts, count(tax) AS taxes FROM (
  SELECT 'order' AS kind, o_totalprice AS amount, NULL AS tax FROM orders
  UNION ALL SELECT 'line', l_extendedprice, l_tax FROM lineitem
  UNION ALL SELECT 'event', value, NULL FROM events) GROUP BY ALL""")
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), F.col("o_totalprice").alias("amount"))
    lines = _table(spark, sf_dir, "lineitem").select(
        F.lit("line").alias("kind"), F.col("l_extendedprice").alias("amount"), F.col("l_tax").alias("tax")
    )
    happened = _table(spark, sf_dir, "events").select(F.lit("event").alias("kind"), F.col("value").alias("amount"))
    return union_all([orders, lines, happened]).groupBy("kind").agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.count("tax").alias("taxes")
    )


_LEVEL_REPORT_SQL = _parsed_sql() + """,
totals AS (SELECT count(*) AS total, count(*) FILTER (level <> '' AND ts IS NOT NULL) AS valid FROM parsed),
counts AS (SELECT level, count(*) AS n FROM valid GROUP BY level),
report AS (
  SELECT 0 AS ord, format('Total log lines processed: {:,}', total) AS line FROM totals
  UNION ALL SELECT 1, format('Total lines with log levels: {:,}', valid) FROM totals
  UNION ALL SELECT 2, 'Unique log levels found: ' || (SELECT count(*) FROM counts)
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Log level distribution:'
  UNION ALL SELECT 4 + CAST(row_number() OVER (ORDER BY n DESC, level) AS INT),
    '  ' || rpad(level, 7, ' ') || ': ' || lpad(format('{:,}', n), 10, ' ') || ' (' || format('{:5.2f}', n * 100.0 / valid) || '%)' FROM counts, totals)"""


@query("report_lines", _LEVEL_REPORT_SQL + " SELECT CAST(ord AS INT) AS ord, line FROM report")
def _(spark, sf_dir):
    return report.level_report(levels.level_tally(_parsed(spark, sf_dir)))


@query("report_roundtrip", _LEVEL_REPORT_SQL + " SELECT line FROM report")
def _(spark, sf_dir):
    path = new_path(spark, "report")
    save_report(report.level_report(levels.level_tally(_parsed(spark, sf_dir))), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("cluster_report", _TIMELINE_SQL + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY num_applications DESC, cluster_id) AS r FROM summary)
SELECT CAST(0 AS INT) AS ord, 'Total unique clusters: ' || count(*) AS line FROM summary
UNION ALL SELECT 1, 'Total applications: ' || CAST(sum(num_applications) AS BIGINT) FROM summary
UNION ALL SELECT 2, format('Average applications per cluster: {:.2f}', avg(num_applications)) FROM summary
UNION ALL SELECT 3, ''
UNION ALL SELECT 4, 'Most heavily used clusters:'
UNION ALL SELECT CAST(4 + r AS INT), '  Cluster ' || cluster_id || ': ' || num_applications || ' applications'
FROM ranked WHERE r <= 3""")
def _(spark, sf_dir):
    return report.cluster_report(T.cluster_summary(_timeline(spark, sf_dir)))


# ---------------------------------------------------------------- parsing


@query("parse_anchored", _parsed_sql() + " SELECT line_no, ts, level, value AS raw FROM parsed")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir).select("line_no", "ts", "level", "raw")


@query("parse_unanchored", _parsed_sql(anchored=False) + " SELECT line_no, ts, level, value AS raw FROM parsed")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir, anchored=False).select("line_no", "ts", "level", "raw")


@query("level_extract", f"""WITH {R.LOGS_SQL} SELECT line_no, regexp_extract(value, '{LEVEL}', 1) AS level,
  regexp_extract(value, '^{STAMP} {LEVEL}\\b', 2) AS strict_level FROM logs""")
def _(spark, sf_dir):
    line = F.col("value")
    return R.logs(spark, sf_dir).select(
        "line_no", P.log_level(line).alias("level"), P.log_level(line, strict=True).alias("strict_level")
    )


@query("component_token", f"""WITH {R.LOGS_SQL}
SELECT line_no, regexp_extract(value, '{LEVEL}\\s+([^\\s]+)', 2) AS component FROM logs""")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir, style="token").select("line_no", "component")


@query("component_colon", f"""WITH {R.LOGS_SQL}
SELECT line_no, regexp_extract(value, '{LEVEL}\\s+([^:]+):', 2) AS component,
  regexp_extract(value, '{LEVEL}\\s+[^:]+:\\s*(.*)$', 2) AS message FROM logs""")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir).select("line_no", "component", "message")


@query("project_rename", _parsed_sql() + " SELECT line_no, value AS log_entry, level AS log_level FROM valid")
def _(spark, sf_dir):
    return entries.valid_entries(_parsed(spark, sf_dir)).select(
        "line_no", F.col("raw").alias("log_entry"), F.col("level").alias("log_level")
    )


@query("path_ids", _parsed_sql() + r"""
SELECT line_no, cluster_id, application_id, app_number, container_id, attempt, container_seq,
  regexp_extract(file_path, 'container_(\d+_\d+_\d+_\d+)', 1) AS container_digits FROM parsed""")
def _(spark, sf_dir):
    return with_ids(R.logs(spark, sf_dir), keep_unmatched=True).select(
        "line_no", "cluster_id", "application_id", "app_number", "container_id", "attempt", "container_seq",
        P.container_digits(F.col("container_id")).alias("container_digits"),
    )


@query("ts_lenient", _parsed_sql() + f""" SELECT line_no, regexp_extract(value, '^{STAMP}', 1) AS stamp, ts
FROM parsed WHERE stamp <> ''""")
def _(spark, sf_dir):
    line = F.col("value")
    return (
        R.logs(spark, sf_dir)
        .select("line_no", P.stamp_text(line).alias("stamp"), P.header_time(line).alias("ts"))
        .filter("stamp <> ''")
    )


@query("ts_strict", _parsed_sql(R.MESSAGES_SQL) + " SELECT line_no, ts, level FROM parsed")
def _(spark, sf_dir):
    # Fails on an impossible date; these lines have none.
    return entries.parse_entries(R.messages(spark, sf_dir), on_bad="fail").select("line_no", "ts", "level")


@query("date_parts", """SELECT event_id, CAST(year(ts) AS INT) AS dt_year, CAST(month(ts) AS INT) AS dt_month,
  CAST(day(ts) AS INT) AS dt_day FROM events""")
def _(spark, sf_dir):
    return D.with_date_parts(_table(spark, sf_dir, "events"), "ts").select("event_id", *D.DAY)


@query("cluster_start", _TIMELINE_SQL + """
SELECT cluster_id, application_id, make_timestamp(TRY_CAST(cluster_id AS BIGINT) * 1000) AS cluster_started FROM timeline""")
def _(spark, sf_dir):
    return T.with_cluster_start(_timeline(spark, sf_dir)).select("cluster_id", "application_id", "cluster_started")


@query("container_roles", _parsed_sql() + """
SELECT container_id, attempt, CASE container_seq WHEN '' THEN NULL WHEN '000001' THEN 'AM' ELSE 'executor' END AS container_role,
  count(*) AS lines FROM parsed GROUP BY ALL""")
def _(spark, sf_dir):
    per_file = R.logs(spark, sf_dir).groupBy("file_path").agg(F.count("*").alias("lines"))
    return with_ids(per_file).groupBy("container_id", "attempt", "container_role").agg(F.sum("lines").alias("lines"))


@query("level_occurrences", f"""WITH {R.LOGS_SQL}
SELECT word AS log_level, count(*) AS occurrences
FROM (SELECT unnest(regexp_extract_all(value, '{LEVEL}', 1)) AS word FROM logs) GROUP BY word""")
def _(spark, sf_dir):
    return entries.level_occurrences(R.logs(spark, sf_dir))


# ---------------------------------------------------------------- filters


@query("valid_entries", _parsed_sql() + " SELECT line_no, ts, level FROM valid")
def _(spark, sf_dir):
    return entries.valid_entries(_parsed(spark, sf_dir)).select("line_no", "ts", "level")


@query("year_filter", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE year(o_orderdate) = 1997""")
def _(spark, sf_dir):
    return D.in_year(_table(spark, sf_dir, "orders"), "o_orderdate", 1997).select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query("even_keys_doubled", "SELECT o_orderkey * 2 AS doubled FROM orders WHERE o_orderkey % 2 = 0")
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").filter(key % 2 == 0).select((key * 2).alias("doubled"))


@query("header_lines", f"""WITH {R.LOGS_SQL}
SELECT line_no, value FROM logs WHERE regexp_matches(value, '^{STAMP}')""")
def _(spark, sf_dir):
    return entries.header_lines(R.logs(spark, sf_dir)).select("line_no", "value")


@query("error_entries", _parsed_sql() + " SELECT line_no, ts, value AS raw FROM valid WHERE level = 'ERROR'")
def _(spark, sf_dir):
    return entries.errors(entries.valid_entries(_parsed(spark, sf_dir))).select("line_no", "ts", "raw")


# ---------------------------------------------------------------- levels


@query("level_counts", _parsed_sql() + ' SELECT level AS log_level, count(*) AS "count" FROM valid GROUP BY level')
def level_counts(spark, sf_dir):
    return levels.level_counts(levels.level_tally(_parsed(spark, sf_dir)))


@query("line_totals", _parsed_sql() + """ SELECT count(*) AS total_lines,
  count(*) FILTER (level <> '' AND ts IS NOT NULL) AS valid_lines FROM parsed""")
def _(spark, sf_dir):
    return levels.line_totals(levels.level_tally(_parsed(spark, sf_dir)))


@query("level_totals", _parsed_sql() + " SELECT count(*) AS total, count(DISTINCT level) AS levels FROM valid")
def _(spark, sf_dir):
    return levels.level_totals(level_counts(spark, sf_dir))


@query("level_share", _parsed_sql() + """ SELECT level AS log_level, count(*) AS "count",
  round(count(*) * 100.0 / (SELECT count(*) FROM valid), 2) AS share_pct FROM valid GROUP BY level""")
def _(spark, sf_dir):
    return _rounded(levels.level_share(level_counts(spark, sf_dir)), "share_pct", digits=2)


@query("distinct_levels", _parsed_sql() + " SELECT DISTINCT level FROM valid")
def _(spark, sf_dir):
    return levels.distinct_levels(entries.valid_entries(_parsed(spark, sf_dir)))


@query("distinct_components", _parsed_sql() + f"""
SELECT DISTINCT regexp_extract(value, '{LEVEL}\\s+([^:]+):', 2) AS component FROM valid""")
def _(spark, sf_dir):
    return levels.distinct_components(entries.valid_entries(_parsed(spark, sf_dir)))


@query("top_components", _parsed_sql() + f"""
  SELECT regexp_extract(value, '{LEVEL}\\s+([^:]+):', 2) AS component, count(*) AS entries FROM valid GROUP BY 1
  ORDER BY entries DESC, component LIMIT 20""")
def _(spark, sf_dir):
    return levels.top_components(entries.valid_entries(_parsed(spark, sf_dir)))


@query("inventory_counts", _parsed_sql() + """
SELECT cluster_id, count(DISTINCT nullif(application_id, '')) AS applications, count(DISTINCT nullif(container_id, '')) AS containers,
  count(*) AS lines FROM parsed GROUP BY ALL""")
def _(spark, sf_dir):
    return levels.inventory_counts(R.logs(spark, sf_dir))


@query("sql_view_count", """SELECT l_returnflag, count(*) AS total FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf_dir):
    register_views(line_items=_table(spark, sf_dir, "lineitem"))
    return spark.sql("SELECT l_returnflag, COUNT(*) AS total FROM line_items GROUP BY l_returnflag")


# ---------------------------------------------------------------- timeline


@query("app_timeline", _TIMELINE_SQL + " SELECT * FROM timeline")
def _(spark, sf_dir):
    return T.sorted_timeline(_timeline(spark, sf_dir))


@query("unmatched_lines", _parsed_sql() + """
SELECT count(*) AS lines, count(DISTINCT file_path) AS files FROM parsed WHERE application_id = ''""")
def _(spark, sf_dir):
    return T.unmatched_lines(_parsed(spark, sf_dir))


@query("cluster_summary", _TIMELINE_SQL + " SELECT * FROM summary")
def _(spark, sf_dir):
    return T.cluster_summary(_timeline(spark, sf_dir))


@query("cluster_stats", _TIMELINE_SQL + """
SELECT count(*) AS clusters, CAST(sum(num_applications) AS BIGINT) AS applications,
  round(avg(num_applications), 6) AS mean_applications FROM summary""")
def _(spark, sf_dir):
    return _rounded(T.cluster_stats(T.cluster_summary(_timeline(spark, sf_dir))), "mean_applications")


@query("top_clusters", _TIMELINE_SQL + """
SELECT cluster_id, num_applications FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 3""")
def _(spark, sf_dir):
    return T.top_clusters(T.cluster_summary(_timeline(spark, sf_dir)))


@query("largest_cluster", _TIMELINE_SQL + """
SELECT cluster_id, num_applications FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 1""")
def _(spark, sf_dir):
    return T.largest_cluster(T.cluster_summary(_timeline(spark, sf_dir)))


@query("largest_cluster_durations", _TIMELINE_SQL + """
SELECT application_id, round((epoch(end_time) - epoch(start_time)) / 60, 6) AS duration_min FROM timeline
WHERE cluster_id = (SELECT cluster_id FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 1)""")
def _(spark, sf_dir):
    timeline = stage(_timeline(spark, sf_dir), "timeline")  # two branches read it; the text is scanned once
    apps = T.largest_cluster_apps(timeline, T.cluster_summary(timeline))
    return _rounded(T.with_duration(apps).select("application_id", "duration_min"), "duration_min")


@query("app_durations", _TIMELINE_SQL + """
SELECT application_id, round((epoch(end_time) - epoch(start_time)) / 60, 6) AS duration_min FROM timeline""")
def _(spark, sf_dir):
    timeline = T.with_duration(_timeline(spark, sf_dir))
    return _rounded(timeline.select("application_id", "duration_min"), "duration_min")


@query("app_concurrency", _TIMELINE_SQL + """,
changes AS (SELECT cluster_id, "at", CAST(sum(step) AS BIGINT) AS change FROM (
    SELECT cluster_id, start_time AS "at", 1 AS step FROM timeline
    UNION ALL SELECT cluster_id, end_time, -1 FROM timeline) WHERE "at" IS NOT NULL GROUP BY ALL)
SELECT cluster_id, "at", change, CAST(sum(change) OVER (PARTITION BY cluster_id ORDER BY "at") AS BIGINT) AS running
FROM changes""")
def _(spark, sf_dir):
    return T.app_concurrency(_timeline(spark, sf_dir))


@query("peak_concurrency", _TIMELINE_SQL + """,
changes AS (SELECT cluster_id, "at", sum(step) AS change FROM (
    SELECT cluster_id, start_time AS "at", 1 AS step FROM timeline
    UNION ALL SELECT cluster_id, end_time, -1 FROM timeline) WHERE "at" IS NOT NULL GROUP BY ALL),
running AS (SELECT cluster_id, "at", sum(change) OVER (PARTITION BY cluster_id ORDER BY "at") AS running FROM changes),
peaks AS (SELECT cluster_id, max(running) AS peak FROM running GROUP BY cluster_id)
SELECT p.cluster_id, CAST(p.peak AS BIGINT) AS peak, min(r."at") AS peak_at
FROM peaks p JOIN running r ON r.cluster_id = p.cluster_id AND r.running = p.peak GROUP BY ALL""")
def _(spark, sf_dir):
    return T.peak_concurrency(T.app_concurrency(_timeline(spark, sf_dir)))


@query("out_of_order_apps", _TIMELINE_SQL + """,
numbered AS (SELECT *, lag(app_number) OVER w AS previous_app, lag(start_time) OVER w AS previous_start FROM timeline
  WINDOW w AS (PARTITION BY cluster_id ORDER BY TRY_CAST(app_number AS BIGINT)))
SELECT cluster_id, app_number, start_time, previous_app, previous_start FROM numbered
WHERE start_time < previous_start""")
def _(spark, sf_dir):
    return T.out_of_order_apps(_timeline(spark, sf_dir))


@query("container_timeline", _parsed_sql() + """
SELECT application_id, container_id, CASE container_seq WHEN '' THEN NULL WHEN '000001' THEN 'AM' ELSE 'executor' END AS container_role,
  min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS lines FROM parsed GROUP BY ALL""")
def _(spark, sf_dir):
    return T.container_timeline(_parsed(spark, sf_dir))


# ---------------------------------------------------------------- daily measures

ORDERS = D.Measures("o_orderdate", "o_totalprice", "o_totalprice", "o_totalprice", "o_totalprice", "o_custkey")
EVENTS = D.Measures("ts", "value", "value", "value", "value", "user_id")


def _daily_sql(table, ts, value, up, where="TRUE"):
    return f"""WITH daily AS (
  SELECT CAST(year({ts}) AS INT) AS dt_year, CAST(month({ts}) AS INT) AS dt_month, CAST(day({ts}) AS INT) AS dt_day,
    count(*) AS num_trips, round(avg({value}) + 1e-8, 6) AS mean_{value}, max({value}) AS max_{value},
    quantile_disc({value}, 0.95) AS q95_{value}, min({value}) AS min_{value},
    CAST(ceil(avg({up})) AS BIGINT) AS mean_{up}
  FROM {table} WHERE {where} GROUP BY 1, 2, 3)"""


_ORDERS_1997 = _daily_sql("orders", "o_orderdate", "o_totalprice", "o_custkey", "year(o_orderdate) = 1997")


_ORDERS_ALL = _daily_sql("orders", "o_orderdate", "o_totalprice", "o_custkey")


@query("daily_metrics", _ORDERS_1997 + " SELECT * FROM daily")
def _(spark, sf_dir):
    daily = D.daily_metrics(_table(spark, sf_dir, "orders"), ORDERS, 1997, exact=True)
    return _rounded(D.latest_first(daily), "mean_o_totalprice", nudge=1e-8)


@query("daily_metrics_all_years", _ORDERS_ALL + " SELECT * FROM daily")
def _(spark, sf_dir):
    daily = D.daily_metrics(_table(spark, sf_dir, "orders"), ORDERS, exact=True)
    return _rounded(daily, "mean_o_totalprice", nudge=1e-8)


@query("daily_event_metrics", _daily_sql("events", "ts", "value", "user_id") + " SELECT * FROM daily")
def _(spark, sf_dir):
    return _rounded(D.daily_metrics(_table(spark, sf_dir, "events"), EVENTS, exact=True), "mean_value", nudge=1e-8)


@query("daily_metrics_approx", _ORDERS_ALL + """
SELECT dt_year, dt_month, dt_day, num_trips, mean_o_totalprice, max_o_totalprice, min_o_totalprice, mean_o_custkey, TRUE AS within_bound FROM daily""")
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    daily = D.daily_metrics(orders, ORDERS)
    # Rank of the sketch's value among the day's: it may miss the wanted one by a ten-thousandth of the day, and by rounding.
    value = F.col("q95_o_totalprice")
    ranks = (
        D.with_date_parts(orders, "o_orderdate").join(daily, list(D.DAY)).groupBy(*D.DAY)
        .agg(F.count_if(F.col("o_totalprice") < value).alias("below"), F.count_if(F.col("o_totalprice") <= value).alias("upto"))
    )
    wanted, slack = F.ceil(F.col("num_trips") * 0.95), F.col("num_trips") / 10_000 + 1
    within = (F.col("below") - slack <= wanted) & (wanted <= F.col("upto") + slack)
    checked = daily.join(ranks, list(D.DAY)).withColumn("within_bound", within).drop("q95_o_totalprice", "below", "upto")
    return _rounded(checked, "mean_o_totalprice", nudge=1e-8)


@query("daily_latest_n", _ORDERS_ALL + """
SELECT * FROM daily ORDER BY dt_year DESC, dt_month DESC, dt_day DESC LIMIT 20""")
def _(spark, sf_dir):
    daily = D.daily_metrics(_table(spark, sf_dir, "orders"), ORDERS, exact=True)
    return _rounded(D.latest_days(daily, 20), "mean_o_totalprice", nudge=1e-8)


@query("daily_rollup", _ORDERS_ALL + """
SELECT CAST(sum(num_trips) AS BIGINT) AS total_trips, round(avg(num_trips), 6) AS mean_daily_trips,
  count(*) AS days, CAST(min(make_date(dt_year, dt_month, dt_day)) AS VARCHAR) AS first_day,
  CAST(max(make_date(dt_year, dt_month, dt_day)) AS VARCHAR) AS last_day FROM daily""")
def _(spark, sf_dir):
    rollup = D.daily_rollup(D.daily_metrics(_table(spark, sf_dir, "orders"), ORDERS))
    dates = {c: F.col(c).cast("string") for c in ("first_day", "last_day")}
    return _rounded(rollup.withColumns(dates), "mean_daily_trips")


# ---------------------------------------------------------------- distributions, samples


def _histogram_sql(source, value):
    bins = f"CASE WHEN {value} > 0 AND isfinite({value}) THEN CAST(floor(log10({value}) * 5) AS BIGINT) END"
    return f"""SELECT CAST(bin AS VARCHAR) AS bin, round(pow(10.0, bin / 5.0), 6) AS low, round(pow(10.0, (bin + 1) / 5.0), 6) AS high, n
FROM (SELECT {bins} AS bin, count(*) AS n FROM {source} GROUP BY 1)"""


def _density_sql(source, value, by=None, digits=6):
    keys, using = (f"{by}, ", f"USING ({by})") if by else ("", "ON TRUE")
    group = f"GROUP BY {by}" if by else ""
    return f"""
xs AS (SELECT {keys}log10({value}) AS x FROM {source} WHERE {value} > 0 AND isfinite({value})),
shape AS (SELECT {keys}min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h FROM xs {group}),
grid AS (SELECT {keys}CAST(k AS INT) AS point, lo + (hi - lo) * (k / 49.0) AS g, n, h
  FROM shape, (SELECT unnest(range(50)) AS k)),
counted AS (SELECT {keys}x, count(*) AS c FROM xs GROUP BY ALL)
SELECT {keys}point, round(g, 6) AS log10_x,
  round(sum(c * exp(-0.5 * pow((g - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), {digits}) AS density
FROM grid JOIN counted {using} GROUP BY {keys}point, g"""


_DURATION_SQL = _TIMELINE_SQL + """,
lasted AS (SELECT cluster_id, (epoch(end_time) - epoch(start_time)) / 60 AS minutes FROM timeline)"""


def _histogram(df, column):
    # The bin as text: a null among integers means different things in pandas.
    bins = distribution.log_histogram(df, column).withColumn("bin", F.col("bin").cast("string"))
    return _rounded(bins, "low", "high")


@query("duration_histogram", _DURATION_SQL + _histogram_sql("lasted", "minutes"))
def _(spark, sf_dir):
    lasted = T.with_duration(_timeline(spark, sf_dir))
    return _histogram(lasted, "duration_min")


@query("event_histogram", _histogram_sql("events", "value"))
def _(spark, sf_dir):
    return _histogram(_table(spark, sf_dir, "events"), "value")


@query("duration_density", _DURATION_SQL + "," + _density_sql("lasted", "minutes"))
def _(spark, sf_dir):
    lasted = T.with_duration(_timeline(spark, sf_dir))
    return _rounded(distribution.log_density(lasted, "duration_min"), "log10_x", "density")


@query("density_by_cluster", _DURATION_SQL + "," + _density_sql("lasted", "minutes", "cluster_id", 4))
def _(spark, sf_dir):
    lasted = T.with_duration(_timeline(spark, sf_dir))
    dense = distribution.log_density(lasted, "duration_min", by="cluster_id")
    return _rounded(_rounded(dense, "log10_x"), "density", digits=4)


@query("sample_size", _DURATION_SQL + """
SELECT count(minutes) AS n, count(*) FILTER (minutes > 0) AS n_on_axis FROM lasted
WHERE cluster_id = (SELECT cluster_id FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 1)""")
def _(spark, sf_dir):
    timeline = stage(_timeline(spark, sf_dir), "timeline")
    lasted = T.with_duration(T.largest_cluster_apps(timeline, T.cluster_summary(timeline)))
    return distribution.sample_size(lasted, "duration_min")


@query("event_density", "WITH " + _density_sql("events", "value", "event_type"))
def _(spark, sf_dir):
    happened = _table(spark, sf_dir, "events")
    return _rounded(distribution.log_density(happened, "value", by="event_type"), "log10_x", "density")


@query("earliest_entries", _parsed_sql() + """
SELECT line_no, ts, value AS log_entry, level AS log_level FROM valid ORDER BY ts, file_path, line_no LIMIT 10""")
def _(spark, sf_dir):
    first = sampling.earliest_entries(entries.valid_entries(_parsed(spark, sf_dir)), 10, ("file_path", "line_no"))
    return first.select("line_no", "ts", F.col("raw").alias("log_entry"), F.col("level").alias("log_level"))


@query("hash_sample", _parsed_sql() + """
SELECT line_no, value AS log_entry, level AS log_level FROM valid
ORDER BY md5('0:' || CAST(line_no AS VARCHAR)), line_no LIMIT 10""")
def _(spark, sf_dir):
    drawn = sampling.hash_sample(entries.valid_entries(_parsed(spark, sf_dir)), 10, "line_no")
    return drawn.select("line_no", F.col("raw").alias("log_entry"), F.col("level").alias("log_level"))


# ---------------------------------------------------------------- messages

_MESSAGES = _parsed_sql(R.MESSAGES_SQL)


def _groups(pattern, *casts):
    """SQL select items for the groups of a pattern."""
    return ", ".join(
        f"TRY_CAST(nullif(regexp_extract(value, '{pattern}', {i}), '') AS {kind}) AS {name}"
        for i, (name, kind) in enumerate(casts, 1)
    )


def _messages(spark, sf_dir):
    return entries.parse_entries(R.messages(spark, sf_dir))


_REQUESTS_SQL = _MESSAGES + f""",
requests AS (SELECT cluster_id, application_id, container_id, ts, """ + _groups(
    r"Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory including (\d+) MB overhead",
    ("executors", "BIGINT"), ("cores", "BIGINT"), ("memory_mb", "BIGINT"), ("overhead_mb", "BIGINT"),
) + """ FROM parsed WHERE value LIKE '%Will request%'),
totals AS (SELECT cluster_id, application_id, CAST(sum(executors) AS BIGINT) AS executors,
    CAST(sum(executors * cores) AS BIGINT) AS total_cores,
    CAST(sum(executors * memory_mb) AS BIGINT) AS total_memory_mb FROM requests GROUP BY ALL)"""


@query("executor_requests", _REQUESTS_SQL + " SELECT * FROM requests")
def _(spark, sf_dir):
    return events.executor_requests(_messages(spark, sf_dir))


@query("resource_totals", _REQUESTS_SQL + " SELECT * FROM totals")
def _(spark, sf_dir):
    return events.resource_totals(events.executor_requests(_messages(spark, sf_dir)))


@query("container_requests", _MESSAGES + " SELECT cluster_id, application_id, container_id, ts, " + _groups(
    r"Container request \(host: (\w+), capability: <memory:(\d+), vCores:(\d+)>\)",
    ("host", "VARCHAR"), ("memory_mb", "BIGINT"), ("vcores", "BIGINT"),
) + " FROM parsed WHERE value LIKE '%Container request%'")
def _(spark, sf_dir):
    return events.container_requests(_messages(spark, sf_dir))


@query("python_timings", _MESSAGES + " SELECT cluster_id, application_id, container_id, ts, " + _groups(
    r"total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)",
    ("total_ms", "BIGINT"), ("boot_ms", "BIGINT"), ("init_ms", "BIGINT"), ("finish_ms", "BIGINT"),
) + " FROM parsed WHERE value LIKE '%Times: total%'")
def _(spark, sf_dir):
    return events.python_timings(_messages(spark, sf_dir))


_SPLITS_SQL = _MESSAGES + ", splits AS (SELECT cluster_id, application_id, container_id, ts, " + _groups(
    r"Input split: (.+):(\d+)\+(\d+)$", ("path", "VARCHAR"), ("\"offset\"", "BIGINT"), ("length", "BIGINT"),
) + " FROM parsed WHERE value LIKE '%Input split%')"


@query("input_splits", _SPLITS_SQL + " SELECT * FROM splits")
def _(spark, sf_dir):
    return events.input_splits(_messages(spark, sf_dir))


@query("input_splits_multiline", _SPLITS_SQL + " SELECT application_id, path, \"offset\", length, 'Input split' AS begins, 2 AS message_lines FROM splits")
def _(spark, sf_dir):
    # Entries of two lines each: the extractor reads the first, the message has both.
    lines = R.messages(spark, sf_dir).withColumn("value", F.concat("value", F.lit("\n\tat a.b.C")))
    parsed = entries.parse_entries(lines)
    splits = events.input_splits(parsed.filter(F.size(F.split("message", "\n")) == 2))
    begins = F.lit("Input split").alias("begins")
    return splits.select("application_id", "path", "offset", "length", begins, F.lit(2).alias("message_lines"))


@query("input_bytes", _SPLITS_SQL + """
SELECT cluster_id, application_id, count(*) AS splits, CAST(sum(length) AS BIGINT) AS bytes FROM splits GROUP BY ALL""")
def _(spark, sf_dir):
    return events.input_bytes(events.input_splits(_messages(spark, sf_dir)))


def _bytes_sql(number, unit):
    return f"""CAST(round({number} * CASE {unit} WHEN 'B' THEN 1 WHEN 'KB' THEN 1024 WHEN 'MB' THEN 1048576
    WHEN 'GB' THEN 1073741824 WHEN 'TB' THEN 1099511627776 END) AS BIGINT)"""


_BLOCKS_SQL = _MESSAGES + ", blocks AS (SELECT cluster_id, application_id, container_id, ts, block_id, " + f"""
    {_bytes_sql('size', 'unit')} AS size_bytes, {_bytes_sql('free', 'free_unit')} AS free_bytes
  FROM (SELECT *, """ + _groups(
    r"Block (\S+) stored as bytes in memory \(estimated size ([0-9.]+) (\w+), free ([0-9.]+) (\w+)\)",
    ("block_id", "VARCHAR"), ("size", "DOUBLE"), ("unit", "VARCHAR"), ("free", "DOUBLE"), ("free_unit", "VARCHAR"),
) + " FROM parsed WHERE value LIKE '%stored as bytes%'))"


@query("memory_blocks", _BLOCKS_SQL + " SELECT * FROM blocks")
def _(spark, sf_dir):
    return events.memory_blocks(_messages(spark, sf_dir))


@query("store_capacity", _MESSAGES + f""" SELECT cluster_id, application_id, container_id, ts,
  {_bytes_sql('size', 'unit')} AS capacity_bytes FROM (SELECT *, """ + _groups(
    r"capacity ([0-9.]+) (\w+)", ("size", "DOUBLE"), ("unit", "VARCHAR"),
) + " FROM parsed WHERE value LIKE '%MemoryStore started%')")
def _(spark, sf_dir):
    return events.store_capacity(_messages(spark, sf_dir))


@query("memory_usage", _BLOCKS_SQL + """,
seconds AS (SELECT DISTINCT application_id, container_id, ts FROM blocks WHERE ts IS NOT NULL),
-- Of each block the size it had last, for every second of its container.
held AS (SELECT s.application_id, s.container_id, s.ts, b.block_id, arg_max(b.size_bytes, (b.ts, b.size_bytes)) AS size
  FROM seconds s JOIN blocks b ON s.application_id = b.application_id AND s.container_id = b.container_id AND b.ts <= s.ts GROUP BY ALL),
used AS (SELECT application_id, container_id, ts, CAST(sum(size) AS BIGINT) AS used_bytes, count(*) AS blocks_in_use FROM held GROUP BY ALL),
wrote AS (SELECT application_id, container_id, ts, count(*) AS blocks, CAST(sum(size_bytes) AS BIGINT) AS stored_bytes FROM blocks GROUP BY ALL)
SELECT * FROM wrote JOIN used USING (application_id, container_id, ts)""")
def _(spark, sf_dir):
    return memory.memory_usage(events.memory_blocks(_messages(spark, sf_dir)))


@query("memory_headroom", _REQUESTS_SQL + _BLOCKS_SQL[len(_MESSAGES):] + """,
asked AS (SELECT application_id, cluster_id, total_memory_mb * 1048576 AS requested_bytes FROM totals),
sizes AS (SELECT application_id, cluster_id, container_id, block_id, arg_max(size_bytes, (ts, size_bytes)) AS size FROM blocks GROUP BY ALL),
peaks AS (SELECT application_id, cluster_id, CAST(sum(size) AS BIGINT) AS used_bytes FROM sizes GROUP BY ALL)
SELECT cluster_id, application_id, requested_bytes, coalesce(used_bytes, 0) AS used_bytes, CAST(0 AS BIGINT) AS untimed_stores,
  round(coalesce(used_bytes, 0) / requested_bytes, 6) AS used_share
FROM asked FULL JOIN peaks USING (cluster_id, application_id)""")
def _(spark, sf_dir):
    return _rounded(memory.memory_headroom(_messages(spark, sf_dir)), "used_share")


@query("broadcast_reads", _MESSAGES + r""" SELECT application_id, variable, count(*) AS reads,
  count(DISTINCT container_id) AS containers
FROM (SELECT *, CAST(regexp_extract(value, 'broadcast variable (\d+)$', 1) AS BIGINT) AS variable
  FROM parsed WHERE value LIKE '%broadcast variable%') GROUP BY ALL""")
def _(spark, sf_dir):
    return events.broadcast_reads(_messages(spark, sf_dir))


_HOSTS_SQL = _parsed_sql(R.HOSTS_SQL) + r""",
own AS (SELECT *, split_part(split_part(split_part(value, 'listening on addresses :[', 2), '@', 2), ':', 1) AS named FROM parsed),
hosts AS (SELECT cluster_id, container_id, coalesce(arg_max(named, (ts, named)) FILTER (named <> ''), '') AS host FROM own GROUP BY ALL)"""


@query("container_hosts", _HOSTS_SQL + " SELECT * FROM hosts")
def _(spark, sf_dir):
    return events.container_hosts(entries.parse_entries(R.hosts(spark, sf_dir)))


@query("host_distribution", _HOSTS_SQL + r"""
SELECT cluster_id, host, count(*) AS containers FROM hosts GROUP BY ALL""")
def _(spark, sf_dir):
    return events.host_distribution(events.container_hosts(entries.parse_entries(R.hosts(spark, sf_dir))))


# ---------------------------------------------------------------- tasks

_TASK = r"(Running|Finished) task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)"
_TASKS_SQL = _parsed_sql(R.TASKS_SQL) + f""",
task_events AS (SELECT cluster_id, application_id, container_id, ts,
    CASE WHEN word = 'Running' THEN 'start' ELSE 'end' END AS event, task, attempt, stage, stage_attempt, tid
  FROM (SELECT *, """.replace("*, ", "* EXCLUDE (attempt), ", 1) + _groups(
    _TASK, ("word", "VARCHAR"), ("task", "BIGINT"), ("attempt", "INT"), ("stage", "BIGINT"),
    ("stage_attempt", "INT"), ("tid", "BIGINT"),
) + """ FROM parsed)),
spans AS (SELECT application_id, container_id, tid, max(stage) AS stage, max(attempt) AS attempt,
    min(ts) FILTER (event = 'start') AS start_time, max(ts) FILTER (event = 'end') AS end_time
  FROM task_events GROUP BY ALL),
durations AS (SELECT *, CAST(epoch(end_time) - epoch(start_time) AS BIGINT) AS seconds FROM spans
  WHERE start_time IS NOT NULL AND end_time IS NOT NULL)"""


def _task_events(spark, sf_dir):
    return tasks.task_events(entries.parse_entries(R.tasks(spark, sf_dir)))


def _durations(spark, sf_dir):
    return tasks.task_durations(tasks.task_spans(_task_events(spark, sf_dir)))


@query("task_events", _TASKS_SQL + " SELECT * FROM task_events")
def _(spark, sf_dir):
    return _task_events(spark, sf_dir)


@query("task_durations", _TASKS_SQL + " SELECT * FROM durations")
def _(spark, sf_dir):
    return _durations(spark, sf_dir)


@query("app_task_stats", _TASKS_SQL + """
SELECT application_id, count(*) AS tasks, round(avg(seconds), 6) AS mean_seconds,
  quantile_cont(seconds, 0.5) AS median_seconds, max(seconds) AS max_seconds FROM durations GROUP BY ALL""")
def _(spark, sf_dir):
    return _rounded(tasks.app_task_stats(_durations(spark, sf_dir)), "mean_seconds")


@query("task_skew", _TASKS_SQL + """
SELECT application_id, stage, count(*) AS tasks, max(seconds) AS max_seconds,
  quantile_cont(seconds, 0.5) AS median_seconds, round(max(seconds) / nullif(median_seconds, 0), 6) AS skew
FROM durations GROUP BY ALL""")
def _(spark, sf_dir):
    return _rounded(tasks.task_skew(_durations(spark, sf_dir)), "skew")


_STAGES_SQL = _TASKS_SQL + """,
stages AS (SELECT application_id, stage, count(*) AS tasks,
    CAST(epoch(max(end_time)) - epoch(min(start_time)) AS BIGINT) AS wall_seconds, max(seconds) AS slowest_seconds,
    round(max(seconds) / nullif(epoch(max(end_time)) - epoch(min(start_time)), 0), 6) AS slowest_share
  FROM durations GROUP BY ALL)"""


@query("stage_bottlenecks", _STAGES_SQL + """
SELECT *, CAST(row_number() OVER (PARTITION BY application_id ORDER BY wall_seconds DESC, stage) AS INT) AS rank
FROM stages QUALIFY rank <= 3""")
def _(spark, sf_dir):
    return _rounded(tasks.stage_bottlenecks(tasks.stage_times(_durations(spark, sf_dir))), "slowest_share")


@query("task_retries", _TASKS_SQL + """
SELECT application_id, stage, count(*) AS retries, max(attempt) AS highest_attempt FROM task_events
WHERE event = 'start' AND attempt > 0 GROUP BY ALL""")
def _(spark, sf_dir):
    return tasks.task_retries(_task_events(spark, sf_dir))


@query("lost_tasks", _TASKS_SQL + " SELECT * FROM spans WHERE start_time IS NOT NULL AND end_time IS NULL")
def _(spark, sf_dir):
    return tasks.lost_tasks(tasks.task_spans(_task_events(spark, sf_dir)))


@query("failures", _TASKS_SQL + f""",
mixed AS (SELECT application_id, container_id, ts, level FROM (WITH {R.LOGS_SQL}
  SELECT {_IDS_SQL}, {_time_sql('^' + STAMP)} AS ts, regexp_extract(value, '{LEVEL}', 1) AS level FROM logs))
SELECT application_id, container_id, CAST(sum(lost) AS BIGINT) AS lost_tasks, CAST(sum(error) AS BIGINT) AS error_entries
FROM (
  SELECT application_id, container_id, 1 AS lost, 0 AS error FROM spans WHERE start_time IS NOT NULL AND end_time IS NULL
  UNION ALL
  SELECT application_id, container_id, 0, 1 FROM mixed WHERE level = 'ERROR' AND ts IS NOT NULL)
GROUP BY ALL""")
def _(spark, sf_dir):
    both = union_all([R.tasks(spark, sf_dir), R.logs(spark, sf_dir)])
    return tasks.failures(entries.valid_entries(entries.parse_entries(both)))


# ---------------------------------------------------------------- entries over lines


_NUMBERED_SQL = _parsed_sql() + f""",
numbered AS (SELECT application_id, container_id, value, ts, level, regexp_extract(value, '{LEVEL}\\s+([^:]+):', 2) AS component,
    row_number() OVER w - 1 AS line_no,
    count(*) FILTER (regexp_matches(value, '^{STAMP}')) OVER w AS entry_no
  FROM parsed WINDOW w AS (PARTITION BY application_id, container_id ORDER BY line_no)),
placed AS (SELECT *, line_no - min(line_no) OVER (PARTITION BY application_id, container_id, entry_no) AS line_in_entry
  FROM numbered)"""


@query("numbered_lines", _NUMBERED_SQL + " SELECT application_id, container_id, entry_no, line_no, line_in_entry, value FROM placed")
def _(spark, sf_dir):
    lines = with_ids(read_logs(spark, R.log_tree(spark, sf_dir), glob="*.txt"))
    numbered = multiline.number_entries(lines, ("application_id", "container_id"))
    return numbered.select("application_id", "container_id", "entry_no", "line_no", "line_in_entry", "value")


@query("multiline_entries", _NUMBERED_SQL + """,
heads AS (SELECT application_id, container_id, entry_no, ts, level, component FROM placed WHERE line_in_entry = 0 AND entry_no > 0),
texts AS (SELECT application_id, container_id, entry_no, line_in_entry // 2 AS part, min(line_no) AS first_line,
    count(*) AS lines, string_agg(value, chr(10) ORDER BY line_no) AS value FROM placed GROUP BY ALL)
SELECT texts.*, ts, level, component FROM texts LEFT JOIN heads USING (application_id, container_id, entry_no)""")
def _(spark, sf_dir):
    lines = read_logs(spark, R.log_tree(spark, sf_dir), glob="*.txt")
    placed = with_ids(lines, keep_unmatched=True)
    # Two lines to a part, so that many entries have several.
    return multiline.assemble_entries(placed, ("application_id", "container_id"), part_lines=2)


from . import catalog_state  # noqa: E402, F401  (adds its queries)
