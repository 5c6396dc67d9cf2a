"""Text reports as tables of numbered lines (``ord``, ``line``)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lines(df: DataFrame, head: list[Column], body: Column) -> DataFrame:
    return df.select(F.posexplode(F.concat(F.array(*head), body)).alias("ord", "line"))


def level_report(tally: DataFrame) -> DataFrame:
    """Line totals and the share of each level. A tally has at most five rows."""
    counted = F.struct((-F.col("valid_lines")).alias("minus_lines"), "level")
    one = tally.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("valid_lines"), F.lit(0)).alias("valid"),
        F.sort_array(F.collect_list(F.when(F.col("valid_lines") > 0, counted))).alias("levels"),
    )
    level = lambda r: F.format_string(
        "  %-7s: %,10d (%5.2f%%)", r["level"], -r["minus_lines"], -r["minus_lines"] * 100.0 / F.col("valid")
    )
    return _lines(
        one,
        [
            F.format_string("Total log lines processed: %,d", "total"),
            F.format_string("Total lines with log levels: %,d", "valid"),
            F.format_string("Unique log levels found: %d", F.size("levels")),
            F.lit(""),
            F.lit("Log level distribution:"),
        ],
        F.transform("levels", level),
    )


def cluster_report(summary: DataFrame, k: int = 3) -> DataFrame:
    """Cluster totals and the ``k`` busiest clusters.

    The busiest are ranked with a limit before they are gathered, so the array
    holds ``k`` rows however many clusters there are.
    """
    busiest = summary.orderBy(F.desc("num_applications"), "cluster_id").limit(k).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("num_applications")).alias("minus_apps"), "cluster_id"))).alias("top")
    )
    one = summary.agg(
        F.count("*").alias("clusters"),
        F.coalesce(F.sum("num_applications"), F.lit(0)).alias("applications"),
        F.avg("num_applications").alias("mean"),
    ).withColumn("top", busiest.scalar())
    cluster = lambda r: F.format_string("  Cluster %s: %d applications", r["cluster_id"], -r["minus_apps"])
    return _lines(
        one,
        [
            F.format_string("Total unique clusters: %d", "clusters"),
            F.format_string("Total applications: %d", "applications"),
            F.format_string("Average applications per cluster: %.2f", F.coalesce("mean", F.lit(0.0))),
            F.lit(""),
            F.lit("Most heavily used clusters:"),
        ],
        F.transform("top", cluster),
    )
