"""When applications ran, and what that says about clusters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..sources.logs import with_ids
from .running import previous_row, running_total


def file_spans(parsed: DataFrame) -> DataFrame:
    """First time, last time and number of lines per file.

    Everything below starts here, so that a line meets one hash aggregation and
    the ids are taken from each path once.
    """
    return parsed.groupBy("file_path").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("lines")
    )


def app_timeline(parsed: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """First and last time per application; '' holds the lines of none. Lines without a time do not matter."""
    return timeline_of_files(file_spans(parsed), keep_unmatched)


def timeline_of_files(spans: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """The timeline from the spans of files, for spans that were stored."""
    return (
        with_ids(spans, keep_unmatched)
        .groupBy("cluster_id", "application_id", "app_number")
        .agg(F.min("first_ts").alias("start_time"), F.max("last_ts").alias("end_time"))
    )


def unmatched_lines(parsed: DataFrame) -> DataFrame:
    """How many lines and files name no application in their path."""
    per_file = parsed.groupBy("file_path").agg(F.count("*").alias("lines"))
    return per_file.filter(~F.col("file_path").rlike(P.APPLICATION)).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.count("*").alias("files")
    )


def sorted_timeline(timeline: DataFrame) -> DataFrame:
    return timeline.orderBy("cluster_id", "app_number")


def container_timeline(parsed: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """First time, last time and number of lines per container; '' holds the lines of none."""
    return (
        with_ids(file_spans(parsed), keep_unmatched)
        .groupBy("application_id", "container_id", "container_role")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("lines").alias("lines"),
        )
    )


def cluster_summary(timeline: DataFrame) -> DataFrame:
    """Number of applications, first start and last end per cluster."""
    return timeline.groupBy("cluster_id").agg(
        F.count("application_id").alias("num_applications"),
        F.min("start_time").alias("cluster_first_app"),
        F.max("end_time").alias("cluster_last_app"),
    )


def cluster_stats(summary: DataFrame) -> DataFrame:
    """Clusters, applications, applications per cluster (null without clusters)."""
    return summary.agg(
        F.count("*").alias("clusters"),
        F.coalesce(F.sum("num_applications"), F.lit(0)).alias("applications"),
        F.avg("num_applications").alias("mean_applications"),
    )


def top_clusters(summary: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` busiest clusters; equal counts go by id."""
    return (
        summary.select("cluster_id", "num_applications")
        .orderBy(F.desc("num_applications"), "cluster_id")
        .limit(k)
    )


def largest_cluster(summary: DataFrame) -> DataFrame:
    """The busiest cluster: one row."""
    return top_clusters(summary, 1)


def largest_cluster_apps(timeline: DataFrame, summary: DataFrame) -> DataFrame:
    """Timeline of the busiest cluster alone.

    Its id is a scalar subquery, so the filter needs no join and no shuffle.
    """
    busiest = largest_cluster(summary).select("cluster_id").scalar()
    return timeline.filter(F.col("cluster_id") == busiest)


def with_duration(timeline: DataFrame) -> DataFrame:
    """Add ``duration_min``."""
    return timeline.withColumn("duration_min", P.minutes_between(F.col("start_time"), F.col("end_time")))


def with_cluster_start(df: DataFrame) -> DataFrame:
    """Add ``cluster_started``, read from the cluster id."""
    return df.withColumn("cluster_started", P.cluster_start(F.col("cluster_id")))


def app_concurrency(timeline: DataFrame) -> DataFrame:
    """Applications running on each cluster from each instant on.

    Intervals are half open: what starts and ends at one instant is summed first.
    That leaves at most one row per second, so a day of one cluster, the range
    the running sum works in, has at most 86,400 rows.
    """
    steps = F.array(
        F.struct(F.col("start_time").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("end_time").alias("at"), F.lit(-1).alias("step")),
    )
    changes = (
        timeline.filter(F.col("start_time").isNotNull())
        .select("cluster_id", F.inline(steps))
        .groupBy("cluster_id", "at")
        .agg(F.sum("step").alias("change"))
    )
    return running_total(changes, ["cluster_id"], ["at"], F.to_date("at"), {"change": "running"})


def peak_concurrency(concurrency: DataFrame) -> DataFrame:
    """Most applications at once per cluster, and when that was first reached."""
    return concurrency.groupBy("cluster_id").agg(
        F.max("running").alias("peak"),
        F.max_by("at", F.struct("running", -F.unix_micros("at"))).alias("peak_at"),
    )


def out_of_order_apps(timeline: DataFrame) -> DataFrame:
    """Applications that started before the one with the next lower number did.

    Numbers are unique within a cluster, so a range of 10,000 numbers has at most
    that many rows.
    Applications whose number is no bigint ('' among them) have no place in that order
    and are left out.
    """
    numbered = timeline.withColumn("_number", F.col("app_number").try_cast("bigint"))
    return (
        previous_row(
            numbered, ["cluster_id"], "_number", F.floor(F.col("_number") / 10_000),
            ["app_number", "start_time"], "previous",
        )
        .filter(F.col("start_time") < F.col("previous.start_time"))
        .select(
            "cluster_id", "app_number", "start_time",
            F.col("previous.app_number").alias("previous_app"),
            F.col("previous.start_time").alias("previous_start"),
        )
    )
