"""Tasks: how long they took, which stages they held up, which never ended."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.settle import settle
from ..sources.logs import with_ids
from .events import WHO, captured, number, text

# Fixed message pattern of the log format.
TASK = r"(Running|Finished) task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)"

TASK_KEY = ("application_id", "container_id", "tid")


def task_events(entries: DataFrame) -> DataFrame:
    """Starts and ends of tasks, one row per line."""
    return captured(entries, "(TID ", TASK, 6).select(
        *WHO,
        F.when(text(1) == "Running", "start").otherwise("end").alias("event"),
        number(2).alias("task"),
        text(3).try_cast("int").alias("attempt"),
        number(4).alias("stage"),
        text(5).try_cast("int").alias("stage_attempt"),
        number(6).alias("tid"),
    )


def task_spans(events: DataFrame) -> DataFrame:
    """Start and end of every task; a missing one is null.

    Both come out of one aggregation, so starts and ends are never joined.
    """
    when = lambda e: F.when(F.col("event") == e, F.col("ts"))
    return events.groupBy(*TASK_KEY).agg(
        F.max("stage").alias("stage"),
        F.max("attempt").alias("attempt"),
        F.min(when("start")).alias("start_time"),
        F.max(when("end")).alias("end_time"),
    )


def task_durations(spans: DataFrame) -> DataFrame:
    """Seconds taken by every task that started and ended."""
    return spans.filter(F.col("start_time").isNotNull() & F.col("end_time").isNotNull()).withColumn(
        "seconds", F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    )


def _by_seconds(durations: DataFrame, *keys: str) -> DataFrame:
    """Tasks per key and whole second.

    A plain count that combines on the map side. The percentiles after it weigh a
    row per distinct second instead of holding every task.
    """
    return durations.groupBy(*keys, "seconds").agg(F.count("*").alias("n"))


def app_task_stats(durations: DataFrame) -> DataFrame:
    """Tasks, mean, median and longest seconds per application."""
    return _by_seconds(durations, "application_id").groupBy("application_id").agg(
        F.sum("n").alias("tasks"),
        (F.sum(F.col("seconds") * F.col("n")) / F.sum("n")).alias("mean_seconds"),
        F.percentile("seconds", F.lit(0.5), F.col("n")).alias("median_seconds"),
        F.max("seconds").alias("max_seconds"),
    )


def task_skew(durations: DataFrame) -> DataFrame:
    """Longest over median task per stage; null where the median is zero."""
    stages = _by_seconds(durations, "application_id", "stage").groupBy("application_id", "stage").agg(
        F.sum("n").alias("tasks"),
        F.max("seconds").alias("max_seconds"),
        F.percentile("seconds", F.lit(0.5), F.col("n")).alias("median_seconds"),
    )
    return stages.withColumn("skew", F.col("max_seconds") / F.nullif("median_seconds", F.lit(0.0)))


def stage_times(durations: DataFrame) -> DataFrame:
    """Wall time of each stage and the share its slowest task has in it."""
    wall = F.unix_timestamp(F.max("end_time")) - F.unix_timestamp(F.min("start_time"))
    return (
        durations.groupBy("application_id", "stage")
        .agg(F.count("*").alias("tasks"), wall.alias("wall_seconds"), F.max("seconds").alias("slowest_seconds"))
        .withColumn("slowest_share", F.col("slowest_seconds") / F.nullif("wall_seconds", F.lit(0)))
    )


def stage_bottlenecks(stages: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` slowest stages of each application.

    The limit on the rank is applied before the shuffle as well, so a task passes
    on at most ``k`` stages of an application.
    """
    slowest = Window.partitionBy("application_id").orderBy(F.desc("wall_seconds"), "stage")
    return stages.withColumn("rank", F.row_number().over(slowest)).filter(F.col("rank") <= k)


def task_retries(events: DataFrame) -> DataFrame:
    """Started attempts above the first, per stage."""
    return (
        events.filter((F.col("event") == "start") & (F.col("attempt") > 0))
        .groupBy("application_id", "stage")
        .agg(F.count("*").alias("retries"), F.max("attempt").alias("highest_attempt"))
    )


def lost_tasks(spans: DataFrame) -> DataFrame:
    """Tasks that started and never ended."""
    return spans.filter(F.col("start_time").isNotNull() & F.col("end_time").isNull())


def failures(entries: DataFrame) -> DataFrame:
    """Per container: tasks that never ended and entries of level ERROR.

    Task lines and errors are taken in one scan; errors share the null task.
    """
    is_error = F.coalesce(F.col("level") == "ERROR", F.lit(False))
    task = F.when(F.col("raw").contains("(TID "), P.captures(F.col("raw"), TASK, 6))
    found = settle(entries, {"error": is_error, "_g": task}).filter(F.col("error") | (F.size("_g") == 6))
    if "application_id" not in found.columns:
        found = with_ids(found)
    return (
        found.select("application_id", "container_id", "error", text(1).alias("event"), F.try_element_at("_g", F.lit(6)).try_cast("bigint").alias("tid"))
        .groupBy(*TASK_KEY)
        .agg(
            F.count_if(F.col("event") == "Running").alias("starts"),
            F.count_if(F.col("event") == "Finished").alias("ends"),
            F.count_if("error").alias("errors"),
        )
        .groupBy("application_id", "container_id")
        .agg(
            F.count_if(F.col("tid").isNotNull() & (F.col("starts") > 0) & (F.col("ends") == 0)).alias("lost_tasks"),
            F.sum("errors").alias("error_entries"),
        )
        .filter((F.col("lost_tasks") > 0) | (F.col("error_entries") > 0))
    )
