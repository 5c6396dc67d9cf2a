"""The batch jobs, from input path to written results."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import scope, stage
from ..operators import daily as D
from ..operators import distribution, entries, levels, report, sampling
from ..operators import timeline as T
from ..schemas import APP_TIMELINE, LOG_ENTRY
from ..sinks import save_csv, save_report
from ..sources import LOG_FILES, load_result, read_logs, read_months, read_trips, with_ids


def entry_table(spark: SparkSession, source: str, target: str, glob: str = LOG_FILES, anchored: bool = True) -> DataFrame:
    """Parse a log tree once into a parquet table partitioned by cluster, and return that.

    For many questions on the same logs: text is then neither read nor parsed
    again, and a query on some columns of one cluster reads just those. Tasks write
    what they scan: a log file belongs to one cluster, so a task meets few of them
    and no text is shuffled. Lines of no application are kept, with a null cluster.
    ``anchored=False`` also takes stamps inside a line, as ``cluster_usage`` does:
    choose it where a timeline is to be made from the table.
    """
    parsed = entries.parse_entries(read_logs(spark, source, glob), anchored=anchored)
    table = with_ids(parsed, keep_unmatched=True).select(*LOG_ENTRY.names)
    table.write.mode("overwrite").partitionBy("cluster_id").parquet(target)
    return spark.read.schema(LOG_ENTRY).parquet(target).select(*LOG_ENTRY.names)


def level_distribution(
    spark: SparkSession, source: str, target: str, glob: str = LOG_FILES, sample: str | None = "earliest"
) -> None:
    """Counts per level, a sample of entries and a report.

    Writes ``level_counts``, ``level_sample`` and ``level_report`` below
    ``target``. The tally is made in one scan and kept, a few rows in size;
    counts and report come from it. The sample, the ten earliest entries or ten
    at random (``"hash"``), takes the second scan; None skips it.
    """
    parsed = entries.parse_entries(read_logs(spark, source, glob))
    with scope(spark):
        tally = stage(levels.level_tally(parsed), "tally")
        save_csv(levels.level_counts(tally), f"{target}/level_counts", single=True)
        save_report(report.level_report(tally), f"{target}/level_report")
    if sample is None:
        return
    valid = entries.valid_entries(parsed)
    if sample == "earliest":
        chosen = sampling.earliest_entries(valid)
    elif sample == "hash":
        line = F.concat_ws(":", "file_path", "block_start", "raw")
        chosen = sampling.hash_sample(valid.withColumn("_key", line), 10, "_key")
    else:
        raise ValueError(f"sample must be 'earliest', 'hash' or None, not {sample!r}")
    save_csv(chosen.select(F.col("raw").alias("log_entry"), F.col("level").alias("log_level")),
             f"{target}/level_sample", single=True)


def cluster_usage(
    spark: SparkSession, source: str | None, target: str, glob: str = LOG_FILES, resume: bool = False
) -> None:
    """Timeline of applications, cluster summary, report and duration tables.

    Writes ``timeline``, ``cluster_summary``, ``cluster_report``,
    ``concurrency``, ``duration_histogram``, ``duration_density`` and
    ``duration_sample_size`` below ``target``. The text is scanned once, for the timeline; all else is made from
    the written timeline. ``resume`` takes the timeline of an earlier run.
    """
    stored = f"{target}/timeline"
    if not resume:
        # A stamp anywhere in a line counts here.
        parsed = entries.parse_entries(read_logs(spark, source, glob), anchored=False)
        save_csv(T.sorted_timeline(T.app_timeline(parsed)), stored)
    with scope(spark):
        _usage_tables(spark, load_result(spark, stored, APP_TIMELINE), target)


def _usage_tables(spark: SparkSession, timeline: DataFrame, target: str) -> None:
    summary = stage(T.cluster_summary(timeline), "summary")
    save_csv(summary.orderBy(F.desc("num_applications"), "cluster_id"), f"{target}/cluster_summary")
    save_report(report.cluster_report(summary), f"{target}/cluster_report")
    save_csv(T.app_concurrency(timeline).orderBy("cluster_id", "at"), f"{target}/concurrency")
    lasted = T.with_duration(T.largest_cluster_apps(timeline, summary))
    save_csv(distribution.log_histogram(lasted, "duration_min").orderBy("bin"), f"{target}/duration_histogram", single=True)
    save_csv(distribution.sample_size(lasted, "duration_min"), f"{target}/duration_sample_size", single=True)
    save_csv(distribution.log_density(lasted, "duration_min").orderBy("point"), f"{target}/duration_density", single=True)


def daily_report(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    year: int,
    months: Iterable[int] | None = None,
    measures: D.Measures = D.TRIPS,
    exact: bool = False,
) -> DataFrame:
    """Daily measures of one year, latest day first, saved as ``daily_metrics``.

    ``source`` is a file, a wildcard or a list of files, of which missing ones
    are skipped; with ``months`` it is a table partitioned by ``yyyy`` and ``mm``.
    Returns the roll-up of the saved table.
    """
    if months is not None:
        trips = read_months(spark, source, year, months)
    else:
        trips = read_trips(spark, source, skip_missing=True)
    with scope(spark):
        daily = D.daily_metrics(trips, measures, year, exact=exact)
        save_csv(D.latest_first(daily), f"{target}/daily_metrics", single=True)
    return D.daily_rollup(load_result(spark, f"{target}/daily_metrics", daily.schema))
