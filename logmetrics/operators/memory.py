"""Memory in use over time, and against what was asked for."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.settle import settle
from .events import EXECUTOR_REQUEST, STORED_BLOCK, matching
from .running import previous_row, running_total


def memory_usage(blocks: DataFrame) -> DataFrame:
    """Memory in use per container, at each second something was stored.

    A block stored again takes the place of what it was before, so it adds the
    difference only. Per second come ``blocks`` (stores), ``stored_bytes`` (written),
    and after it ``used_bytes`` and ``blocks_in_use``. Stores without a time are left
    out here and in ``memory_headroom``, which counts them.

    Stores of one second are summed first, so the range the running sum works
    in, a day of one container, has at most 86,400 rows.
    """
    who = ["application_id", "container_id"]
    stores = (
        blocks.filter(F.col("ts").isNotNull())
        .groupBy(*who, "block_id", "ts")
        .agg(F.count("*").alias("stores"), F.sum("size_bytes").alias("written"), F.max("size_bytes").alias("size"))
    )
    placed = previous_row(stores, [*who, "block_id"], "ts", F.to_date("ts"), ["size", "stores", "written"], "before")
    per_second = placed.groupBy(*who, "ts").agg(
        F.sum("stores").alias("blocks"),
        F.sum("written").alias("stored_bytes"),
        F.sum(F.col("size") - F.coalesce("before.size", F.lit(0))).alias("change"),
        F.count_if(F.col("before").isNull()).alias("new"),
    )
    running = running_total(
        per_second, who, ["ts"], F.to_date("ts"),
        {"blocks": "_stores", "stored_bytes": "_written", "change": "used_bytes", "new": "blocks_in_use"},
    )
    return running.select(*who, "ts", "blocks", "stored_bytes", "used_bytes", "blocks_in_use")


def memory_headroom(entries: DataFrame) -> DataFrame:
    """Requested against used memory per application.

    Used is the sum of the last size of every block of every container, as in
    ``memory_usage``; of several sizes in one second the largest counts.
    ``untimed_stores`` have no time and are not in it. Requests and blocks go
    through one scan and share the aggregations instead of being joined.
    """
    raw = F.col("raw")
    asked, stored = P.captures(raw, EXECUTOR_REQUEST, 4), P.captures(raw, STORED_BLOCK, 5)
    either = entries.filter(raw.contains("Will request") | raw.contains("in memory (estimated"))
    found = matching(settle(either, {"_asked": asked, "_stored": stored}), (F.size("_asked") == 4) | (F.size("_stored") == 5))
    part = lambda array, i: F.try_element_at(array, F.lit(i))
    requested = part("_asked", 1).try_cast("bigint") * part("_asked", 3).try_cast("bigint") * F.lit(1024 * 1024)
    size = P.size_in_bytes(part("_stored", 2), part("_stored", 3))
    is_block, timed = F.size("_stored") == 5, F.col("ts").isNotNull()
    return (
        found.groupBy("cluster_id", "application_id", "container_id", F.when(is_block, part("_stored", 1)).alias("block_id"))
        .agg(
            F.sum(requested).alias("requested_bytes"),
            F.max(F.when(is_block & timed, F.struct("ts", size.alias("size"))))["size"].alias("size"),
            F.count_if(is_block & ~timed).alias("untimed"),
        )
        .groupBy("cluster_id", "application_id")
        .agg(
            F.sum("requested_bytes").alias("requested_bytes"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("used_bytes"),
            F.sum("untimed").alias("untimed_stores"),
        )
        .withColumn("used_share", F.col("used_bytes") / F.nullif("requested_bytes", F.lit(0)))
    )
