"""Stretches of time: which overlap, where they break, what they cover."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.logs import with_ids
from .running import running_max

HOT = 2_000  # intervals of one bin that one task pairs with the others


def overlaps(
    df: DataFrame, keys: Sequence[str], name: str, start: str = "start_time", end: str = "end_time", bin_seconds: int | None = None, hot: int = HOT
) -> DataFrame:
    """Pairs of intervals of one key that share time: keys, ``first``, ``second`` (by ``name``, smaller first) and ``shared_seconds``.

    Intervals are half open; those without length, start or end share nothing, and
    (keys, name) must be unique. Time is cut into bins, by default as wide as the
    mean interval (a small job), so that an interval lies in two or three. Two
    intervals meet in each common bin but make a pair only in that where the later
    one starts: every pair comes once. A bin of more than ``hot`` intervals is
    dealt over several tasks: each takes a share of them and meets all.
    """
    keys = list(keys)
    cut = df.select(*keys, F.col(name).alias("_name"), F.unix_timestamp(start).alias("_s"), F.unix_timestamp(end).alias("_e")).filter("_e > _s")
    if bin_seconds is None:
        bin_seconds = max(1, round(cut.agg(F.avg(F.col("_e") - F.col("_s"))).first()[0] or 1))
    bin_of = lambda c: F.floor(F.col(c) / F.lit(bin_seconds))
    binned = cut.withColumn("_bin", F.explode(F.sequence(bin_of("_s"), F.floor((F.col("_e") - 1) / F.lit(bin_seconds)))))
    crowded = binned.groupBy(*keys, "_bin").count().filter(F.col("count") > hot).select(*keys, "_bin", F.ceil(F.col("count") / hot).alias("_shares"))
    dealt = binned.join(crowded, [*keys, "_bin"], "left").withColumn("_shares", F.coalesce("_shares", F.lit(1)))
    left = dealt.withColumn("_share", F.pmod(F.xxhash64("_name"), "_shares"))
    right = dealt.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    right = right.select(*keys, "_bin", "_share", *[F.col(c).alias(f"{c}2") for c in ("_name", "_s", "_e")])
    met = left.join(right, [*keys, "_bin", "_share"]).filter("_name < _name2").withColumn("_later", F.greatest("_s", "_s2"))
    shared = F.least("_e", "_e2") - F.col("_later")
    return (
        met.filter((bin_of("_later") == F.col("_bin")) & (shared > 0))
        .select(*keys, F.col("_name").alias("first"), F.col("_name2").alias("second"), shared.alias("shared_seconds"))
    )


def overlapping_apps(timeline: DataFrame, bin_seconds: int | None = None, hot: int = HOT) -> DataFrame:
    """Applications of a cluster that ran at the same time, and for how long."""
    return overlaps(timeline, ["cluster_id"], "application_id", bin_seconds=bin_seconds, hot=hot)


def container_sessions(parsed: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Busy stretches of containers: lines less than or just ``gap_seconds`` apart belong together.

    ``started`` and ``ended`` are the times of the first and the last line. Lines are
    counted per file and second first, so a container sorts seconds, not lines.
    Lines without a time do not count; '' holds those of no container.
    """
    seconds = parsed.filter(F.col("ts").isNotNull()).groupBy("file_path", "ts").agg(F.count("*").alias("lines"))
    busy = with_ids(seconds).groupBy("application_id", "container_id", F.session_window("ts", f"{gap_seconds} seconds").alias("session"))
    found = busy.agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.sum("lines").alias("lines"))
    return found.drop("session")


def coverage(df: DataFrame, keys: Sequence[str], start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Per key, the union of its intervals: ``islands`` (stretches without a break), ``wall_seconds`` from first to last, ``busy_seconds``, ``idle_seconds``, ``longest_gap``.

    Intervals without a start, an end or a key do not count; touching ones make one
    island. Intervals of one start are reduced to the longest first, so that a
    key has a row per second at most, and a day of a key is the range in which the
    greatest end so far is kept; one row per day carries over.
    """
    keys = list(keys)
    cut = df.select(*keys, F.unix_timestamp(start).alias("_s"), F.unix_timestamp(end).alias("_e")).filter("_e >= _s")
    longest = cut.groupBy(*keys, "_s").agg(F.max("_e").alias("_e"))
    known = running_max(longest, keys, ["_s"], F.floor(F.col("_s") / 86_400), "_e", "_before")
    gap = F.when(F.col("_s") > F.col("_before"), F.col("_s") - F.col("_before"))
    wall, idle = F.max("_e") - F.min("_s"), F.coalesce(F.sum(gap), F.lit(0))
    return known.groupBy(*keys).agg(
        (F.count(gap) + 1).alias("islands"), wall.alias("wall_seconds"), (wall - idle).alias("busy_seconds"), idle.alias("idle_seconds"),
        F.coalesce(F.max(gap), F.lit(0)).alias("longest_gap"),
    )


def stage_islands(durations: DataFrame) -> DataFrame:
    """Per application: how long tasks ran at all, and how long none did, between its first task and its last."""
    return coverage(durations, ["application_id"])
