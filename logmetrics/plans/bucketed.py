"""Log entries stored in buckets, for work per container without shuffles.

Pairing task starts and ends, finding failures and following memory all group by
container. Where entries are written once, dealt out by container and sorted by time, that
work runs where the rows lie. A plan without shuffles has none to share, so running
values (``memory_usage``) scan the table once per branch.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import entries
from ..schemas import LOG_ENTRY
from ..sources import LOG_FILES, read_logs, with_ids

# Joins on more columns than the buckets' are then co-located, too.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# Shuffled bytes that one task sorts when entries are dealt out. Packed text grows about tenfold in memory.
DEALT = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

# What one task may hold when it reads: lines of a bucket, of several containers, and of one container.
BUCKET_LINES = 250_000
CONTAINER_LINES = 500_000


def buckets_for(lines: int) -> int:
    """Buckets for a table of so many lines, 16 to 200.

    Up to 200 (``spark.shuffle.sort.bypassMergeThreshold``) a task writes what it
    deals out straight to files; beyond, it would hold all of it in memory first.
    """
    return min(200, max(16, -(-lines // BUCKET_LINES)))


def store_in_buckets(parsed: DataFrame, name: str, path: str, buckets: int = 200) -> DataFrame:
    """Write parsed entries as table ``name`` at ``path``, and return that.

    Text is shuffled once, here. A bucket is written, and so sorted, in as many
    parts as AQE cuts it into, but is one task when it is read: choose ``buckets``
    so that it fits (``buckets_for``). A container lies in one bucket whole, so where
    one may hold a large part of all lines, work by ``per_container``.
    """
    spark = parsed.sparkSession
    table = parsed if "application_id" in parsed.columns else with_ids(parsed)
    table = table.select(*[c for c in LOG_ENTRY.names if c in table.columns])
    dealt = table.hint("rebalance", buckets, "container_id")
    with _settings(spark, DEALT):
        dealt.write.bucketBy(buckets, "container_id").sortBy("container_id", "ts").option("path", path).mode("overwrite").saveAsTable(name)
    return bucketed(spark, name)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings hold inside and are as before at the end."""
    before = {setting: spark.conf.get(setting, None) for setting in settings}
    for setting, value in settings.items():
        spark.conf.set(setting, value)
    try:
        yield
    finally:
        for setting, value in before.items():
            spark.conf.unset(setting) if value is None else spark.conf.set(setting, value)


def bucketed_entries(spark: SparkSession, source: str, name: str, path: str, buckets: int = 200, glob: str = LOG_FILES) -> DataFrame:
    """Parse a log tree once into buckets."""
    return store_in_buckets(entries.parse_entries(read_logs(spark, source, glob)), name, path, buckets)


def bucketed(spark: SparkSession, name: str) -> DataFrame:
    """A table stored before, for work per container. Sets what lets joins stay where the rows lie."""
    for setting, value in CO_LOCATED.items():
        spark.conf.set(setting, value)
    return spark.table(name)


def spread(spark: SparkSession, path: str) -> DataFrame:
    """The same rows without buckets, in splits of any container, for work that a huge container would hold up."""
    return spark.read.schema(LOG_ENTRY).parquet(path)


def per_container(stored: DataFrame, path: str, work: Callable[[DataFrame], DataFrame], most: int | None = None) -> DataFrame:
    """``work``, which never goes beyond a container, on all entries of a stored table.

    Containers of more than ``most`` lines (``CONTAINER_LINES``) are read with
    ``spread``, so that ``work`` shuffles them by its own keys and none ends whole in
    one task; all others stay in their buckets. A job that counts lines by container
    runs here. The driver gets the ids of the large ones only.
    """
    most = CONTAINER_LINES if most is None else most
    lines = stored.groupBy("container_id").agg(F.count("*").alias("n"))
    large = [r["container_id"] for r in lines.filter(F.col("n") > most).collect()]
    if not large:
        return work(stored)
    container, named = F.col("container_id"), [c for c in large if c is not None]
    is_large = F.when(container.isNull(), F.lit(None in large)).otherwise(container.isin(named))
    return work(stored.filter(~is_large)).unionByName(work(spread(stored.sparkSession, path).filter(is_large)))
