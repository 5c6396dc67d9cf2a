"""Text scan of a log tree."""

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.settle import settle

# Names of log files: plain, rolled over, packed by a codec Spark reads; archives are not.
LOG_FILES = "{*.log,*.log.[0-9]*,*.log.gz,*.log.bz2,stderr,stdout}"


def read_logs(
    spark: SparkSession,
    root: str,
    glob: str = LOG_FILES,
    applications: Sequence[str] | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """Every line of every matching file below ``root``, at any depth.

    ``applications`` narrows the listing to those directories (``application_..``
    names, wildcards allowed: ``application_1485248649253_*`` is one cluster), so
    nothing else is listed or read. ``modified_after`` (UTC, to the second) leaves
    files that were last modified in an earlier second unopened.

    Columns: ``value``, ``file_path`` and ``block_start``, the byte at which the
    split that holds the line begins.
    """
    root = root.rstrip("/")
    paths = [root] if applications is None else [f"{root}/{a}" for a in applications]
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if modified_after is not None:
        # The reader's bound is strict.
        before = datetime.fromisoformat(modified_after) - timedelta(seconds=1)
        reader = reader.option("timeZone", "UTC").option("modifiedAfter", before.isoformat(timespec="seconds"))
    return (
        reader.text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
    )


def with_ids(df: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """Add the ids that a log file's path carries.

    Rows whose path names no application have '' in their ids; without
    ``keep_unmatched`` they go. Where lines can be reduced per file first, do
    that and call this afterwards: the path is then taken apart once per file
    instead of once per line.
    """
    path = F.col("file_path")
    ids = {"application_id": P.application_id(path), "container_id": P.container_id(path)}
    found = df.withColumns(ids) if keep_unmatched else settle(df, ids).filter("application_id <> ''")
    application, container = F.col("application_id"), F.col("container_id")
    return found.withColumns({
        "cluster_id": P.cluster_id(application),
        "app_number": P.app_number(application),
        "attempt": P.attempt(container),
        "container_seq": P.container_seq(container),
        "container_role": P.container_role(container),
    })
