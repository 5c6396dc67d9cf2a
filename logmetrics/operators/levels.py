"""Counts by level and component."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.logs import with_ids
from .entries import is_valid


def level_tally(parsed: DataFrame) -> DataFrame:
    """Lines and valid lines by level: one scan, at most five rows.

    Totals, per-level counts, shares and the report all follow from it. Validity
    is counted rather than filtered, so no line's fields are worked out twice,
    once for a filter below the aggregation and once for the aggregation.
    """
    return parsed.groupBy("level").agg(
        F.count("*").alias("lines"), F.count_if(is_valid()).alias("valid_lines")
    )


def line_totals(tally: DataFrame) -> DataFrame:
    """All lines and valid lines."""
    return tally.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_lines"),
        F.coalesce(F.sum("valid_lines"), F.lit(0)).alias("valid_lines"),
    )


def level_counts(tally: DataFrame) -> DataFrame:
    """Valid lines per level, largest first."""
    return (
        tally.select(F.col("level").alias("log_level"), F.col("valid_lines").alias("count"))
        .filter(F.col("count") > 0)
        .orderBy(F.desc("count"), "log_level")
    )


def level_totals(counts: DataFrame) -> DataFrame:
    """Sum of the counts and number of levels."""
    return counts.agg(F.sum("count").alias("total"), F.count("*").alias("levels"))


def level_share(counts: DataFrame) -> DataFrame:
    """Counts with their share of the total in percent.

    The window spans the whole table, which has one row per level word.
    """
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select("log_level", "count", (F.col("count") * 100.0 / total).alias("share_pct"))


def distinct_levels(entries: DataFrame) -> DataFrame:
    return entries.select("level").distinct()


def distinct_components(entries: DataFrame) -> DataFrame:
    return entries.select("component").distinct()


def top_components(entries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` components with most entries; those without one count as ''."""
    return (
        entries.groupBy(F.coalesce("component", F.lit("")).alias("component"))
        .agg(F.count("*").alias("entries"))
        .orderBy(F.desc("entries"), "component")
        .limit(k)
    )


def inventory_counts(lines: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """Applications, containers and lines per cluster; '' holds the lines of none.

    Lines are counted per file, then rolled up level by level. A container
    belongs to one application and that to one cluster, so no distinct count is
    needed, and a large cluster is spread over its containers until the last step.
    """
    per_file = lines.groupBy("file_path").agg(F.count("*").alias("lines"))
    per_container = (
        with_ids(per_file, keep_unmatched)
        .groupBy("cluster_id", "application_id", "container_id")
        .agg(F.sum("lines").alias("lines"))
    )
    per_application = per_container.groupBy("cluster_id", "application_id").agg(
        F.count(F.nullif("container_id", F.lit(""))).alias("containers"),
        F.sum("lines").alias("lines"),
    )
    return per_application.groupBy("cluster_id").agg(
        F.count(F.nullif("application_id", F.lit(""))).alias("applications"),
        F.sum("containers").alias("containers"),
        F.sum("lines").alias("lines"),
    )
