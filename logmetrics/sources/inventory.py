"""What lies in a log tree, from the file listing alone."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P
from .logs import LOG_FILES


def file_inventory(spark: SparkSession, root: str, glob: str = LOG_FILES, keep_unmatched: bool = True) -> DataFrame:
    """Files, containers and bytes per application.

    Only path and length are selected, so no file is opened. Files of no
    application are counted under '' unless ``keep_unmatched`` is off.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )
    if not keep_unmatched:
        listed = listed.filter(F.col("path").rlike(P.APPLICATION))
    per_container = listed.groupBy(
        P.application_id(F.col("path")).alias("application_id"),
        P.container_id(F.col("path")).alias("container_id"),
    ).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return per_container.groupBy("application_id").agg(
        F.sum("files").alias("files"),
        F.count(F.nullif("container_id", F.lit(""))).alias("containers"),
        F.sum("bytes").alias("bytes"),
    )


def largest_applications(inventory: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` applications with most files."""
    return inventory.orderBy(F.desc("files"), "application_id").limit(k)


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """One row: applications, files, bytes, and the range of application sizes."""
    return inventory.agg(
        F.count("*").alias("applications"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.min("bytes").alias("smallest_bytes"),
        F.max("bytes").alias("largest_bytes"),
        F.avg("bytes").alias("mean_bytes"),
        F.avg("files").alias("mean_files"),
    )
