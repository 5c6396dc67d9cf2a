"""Tables written out as log lines, for data that is not a log tree.

Each view has ``line_no, file_path, value`` like a scan of a log tree. The SQL
next to each view renders the same text in DuckDB, for checking.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.staging import new_path

FIRST_CLUSTER = 1485248649253


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _path(cluster: str, app: str, seq: str) -> str:
    """SQL for a log path, the same in Spark and DuckDB."""
    c = f"CAST({FIRST_CLUSTER} + {cluster} AS STRING)"
    a = f"lpad(CAST({app} AS STRING), 4, '0')"
    s = f"lpad(CAST({seq} AS STRING), 6, '0')"
    return f"'/application_' || {c} || '_' || {a} || '/container_' || {c} || '_' || {a} || '_01_' || {s} || '.log'"


_EVENT_PATH = _path("user_id % 6", "user_id % 40", "1 + event_id % 3")
# Some files of no application, and among them lines of every kind.
_MESSAGE_PATH = f"CASE WHEN event_id % 25 = 17 THEN '/misc/other.log' ELSE {_EVENT_PATH} END"
_TASK_PATH = f"CASE WHEN o_orderkey % 25 = 17 THEN '/misc/tasks.log' ELSE {_path('o_custkey % 6', 'o_custkey % 40', '2 + o_orderkey % 3')} END"

# --- events as a mixed log, with the irregular lines a parser must cope with ---

_LOG_LINE = """
CASE WHEN event_id % 10 = 9 THEN chr(9) || 'at a.b.C ERROR'
     WHEN event_id % 50 = 3 THEN substr(stamp, 1, 3) || '13' || substr(stamp, 6) || ' INFO app.x: bad'
     WHEN event_id % 50 = 7 THEN stamp || ' TRACE app.' || event_type || ': user=' || user_id || ' props=' || props
     WHEN event_id % 50 = 11 THEN stamp || ' WARN app.x: then ERROR'
     WHEN event_id % 50 = 13 THEN 'note ' || stamp || ' INFO app.x: inside'
     ELSE stamp || ' ' ||
          CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'DEBUG' ELSE 'INFO' END
          || ' app.' || event_type || ': user=' || user_id || ' props=' || props
END"""
_LOG_PATH = f"CASE WHEN event_id % 50 = 17 THEN '/misc/other.log' ELSE {_EVENT_PATH} END"

LOGS_SQL = f"""
stamped AS (SELECT *, strftime(ts, '%y/%m/%d %H:%M:%S') AS stamp FROM events),
logs AS (SELECT event_id AS line_no, {_LOG_PATH} AS file_path, {_LOG_LINE} AS value FROM stamped)"""


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``, one line each: headers, stack trace lines, bad dates, other levels."""
    stamped = _read(spark, sf_dir, "events").withColumn("stamp", F.date_format("ts", P.STAMP_FORMAT))
    return stamped.select(
        F.col("event_id").alias("line_no"), F.expr(_LOG_PATH).alias("file_path"), F.expr(_LOG_LINE).alias("value")
    )


# --- orders as task starts and ends ---

_TASK_TEXT = """'task ' || (o_orderkey % 50) || '.' ||
    CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END ||
    ' in stage ' || (o_orderkey % 8) || '.0 (TID ' || o_orderkey || ')'"""

TASKS_SQL = f"""
timed AS (SELECT *, o_orderdate + INTERVAL 20 YEAR + to_seconds(o_orderkey % 86400) AS started,
    o_orderdate + INTERVAL 20 YEAR + to_seconds(o_orderkey % 86400)
      + to_seconds(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS ended
  FROM orders),
logs AS (
  SELECT 2 * o_orderkey AS line_no, {_TASK_PATH} AS file_path,
    strftime(started, '%y/%m/%d %H:%M:%S') || ' INFO executor.Executor: Running ' || {_TASK_TEXT} AS value
  FROM timed
  UNION ALL
  SELECT 2 * o_orderkey + 1, {_TASK_PATH},
    strftime(ended, '%y/%m/%d %H:%M:%S') || ' INFO executor.Executor: Finished ' || {_TASK_TEXT}
  FROM timed WHERE o_orderstatus <> 'P')"""


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as tasks: a start line each, and an end line unless still pending.

    Dates move up by 20 years, for two digits of a year mean 2000 to 2099.
    """
    later = lambda ts, s: F.timestamp_add("SECOND", s, ts)
    started = later(F.expr("o_orderdate + INTERVAL '20' YEAR"), F.col("o_orderkey") % 86400)
    ended = later("started", F.floor(F.col("o_totalprice") / 1000))
    text = F.expr(_TASK_TEXT)
    line = lambda at, word: F.concat(
        F.date_format(at, P.STAMP_FORMAT), F.lit(f" INFO executor.Executor: {word} "), text
    )
    pair = F.array(
        F.struct((2 * F.col("o_orderkey")).alias("line_no"), line("started", "Running").alias("value")),
        F.struct((2 * F.col("o_orderkey") + 1).alias("line_no"), line("ended", "Finished").alias("value")),
    )
    return (
        _read(spark, sf_dir, "orders")
        .withColumn("started", started)
        .withColumn("ended", ended)
        .select(F.expr(_TASK_PATH).alias("file_path"), "o_orderstatus", F.inline(pair))
        .filter((F.col("line_no") % 2 == 0) | (F.col("o_orderstatus") != "P"))
        .select("line_no", "file_path", "value")
    )


# --- events as resource, data and memory messages ---

_MEMORY = "(1024 * (1 + user_id % 28))"
_MESSAGE = f"""
CASE event_id % 6
WHEN 0 THEN 'INFO YarnAllocator: Will request ' || (1 + user_id % 16) || ' executor containers, each with '
    || (1 + user_id % 5) || ' cores and ' || {_MEMORY} || ' MB memory including '
    || CAST(floor({_MEMORY} / 10) AS BIGINT) || ' MB overhead'
WHEN 1 THEN 'INFO YarnAllocator: Container request (host: Any, capability: <memory:' || {_MEMORY}
    || ', vCores:' || (1 + user_id % 5) || '>)'
WHEN 2 THEN 'INFO python.PythonRunner: Times: total = ' || CAST(floor(value * 10) AS BIGINT)
    || ', boot = ' || CAST(floor(value * 3) AS BIGINT) || ', init = ' || (user_id % 100) || ', finish = '
    || (CAST(floor(value * 10) AS BIGINT) - CAST(floor(value * 3) AS BIGINT) - user_id % 100)
WHEN 3 THEN 'INFO rdd.HadoopRDD: Input split: hdfs://10.0.0.1:9000/data/f' || (user_id % 10) || '.txt:'
    || (event_id * 1000) || '+' || CAST(floor(value * 1000) AS BIGINT)
WHEN 4 THEN CASE WHEN event_id % 60 = 10
    THEN 'INFO storage.MemoryStore: MemoryStore started with capacity ' || (1 + user_id % 16) || '.5 GB'
    ELSE 'INFO storage.MemoryStore: Block rdd_' || (user_id % 5) || '_' || (event_id % 7)
      || ' stored as bytes in memory (estimated size ' || CAST(floor(value * 10) AS BIGINT) || '.5 '
      || CASE WHEN event_id % 4 = 0 THEN 'KB' ELSE 'MB' END || ', free 1.2 GB)' END
ELSE 'INFO broadcast.TorrentBroadcast: Started reading broadcast variable ' || (user_id % 10)
END"""

MESSAGES_SQL = f"""
logs AS (SELECT event_id AS line_no, {_MESSAGE_PATH} AS file_path,
    strftime(ts, '%y/%m/%d %H:%M:%S') || ' ' || {_MESSAGE} AS value FROM events)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as messages on requests, worker times, splits, blocks and broadcasts."""
    line = F.concat(F.date_format("ts", P.STAMP_FORMAT), F.lit(" "), F.expr(_MESSAGE))
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("line_no"), F.expr(_MESSAGE_PATH).alias("file_path"), line.alias("value")
    )


# --- events as address announcements, and lines that name other hosts ---

_ADDRESS = """
CASE WHEN event_id % 4 = 0 AND user_id % 40 <> 7
    THEN ' INFO Remoting: Remoting started; listening on addresses :[akka.tcp://executor@worker-' || (event_id % 8) || ':' || (30000 + user_id) || ']'
    WHEN event_id % 4 = 1 THEN ' INFO executor.CoarseGrainedExecutorBackend: Connecting to driver: akka.tcp://driver@zz-driver:' || (40000 + user_id)
    ELSE ' INFO cluster.YarnClusterSchedulerBackend: Registered executor akka.tcp://executor@zz-worker-' || (user_id % 8) || ':4000' END"""

HOSTS_SQL = f"""
logs AS (SELECT event_id AS line_no, {_MESSAGE_PATH} AS file_path,
    strftime(ts, '%y/%m/%d %H:%M:%S') || {_ADDRESS} AS value FROM events)"""


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as containers announcing the address they listen on, among lines that name other hosts."""
    line = F.concat(F.date_format("ts", P.STAMP_FORMAT), F.expr(_ADDRESS))
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("line_no"), F.expr(_MESSAGE_PATH).alias("file_path"), line.alias("value")
    )


# --- trees on disk ---

_trees: dict[tuple[str, ...], str] = {}


def _once(spark: SparkSession, kind: str, sf_dir: str, write) -> str:
    """Path of a tree written at most once per application."""
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    if key not in _trees:
        path = new_path(spark, kind)
        write(path)
        _trees[key] = path
    return _trees[key]


def write_log_tree(lines: DataFrame, path: str) -> None:
    """Write lines below ``app=../container=..``, in the order of ``line_no``.

    Lines are spread by ranges of (application, container, line), so a large
    container becomes several part files, which follow each other by name.
    """
    order = ("app", "container", "line_no")
    source = F.col("file_path")
    (
        lines.select(
            F.coalesce(F.nullif(P.application_id(source), F.lit("")), F.lit("misc")).alias("app"),
            F.coalesce(F.nullif(P.container_id(source), F.lit("")), F.lit("other")).alias("container"),
            "line_no",
            "value",
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("app", "container", "value")
        .write.partitionBy("app", "container")
        .text(path)
    )


def container_tree(spark: SparkSession, sf_dir: str) -> str:
    """The mixed log with one file per container, so that the number of files is known."""

    def write(path: str) -> None:
        source = F.col("file_path")
        named = logs(spark, sf_dir).select(
            F.coalesce(F.nullif(P.application_id(source), F.lit("")), F.lit("misc")).alias("app"),
            F.coalesce(F.nullif(P.container_id(source), F.lit("")), F.lit("other")).alias("container"),
            "value",
        )
        named.repartition("app", "container").write.partitionBy("app", "container").text(path)

    return _once(spark, "containers", sf_dir, write)


def log_tree(spark: SparkSession, sf_dir: str) -> str:
    """The mixed log as a directory tree of text files."""
    return _once(spark, "logs", sf_dir, lambda path: write_log_tree(logs(spark, sf_dir), path))


def month_table(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` partitioned by ``yyyy`` and ``mm``.

    REBALANCE keeps a month together where it is small and splits it where it is
    large, so neither many small files nor one huge task results.
    """
    dated = _read(spark, sf_dir, "orders").withColumns({"yyyy": F.year("o_orderdate"), "mm": F.month("o_orderdate")})
    return _once(
        spark, "orders", sf_dir,
        lambda path: dated.hint("rebalance", "yyyy", "mm").write.partitionBy("yyyy", "mm").parquet(path),
    )
