"""Timelines kept up to date as log files come in.

What a run reads is one batch: a written table of the files it took, each with path,
length, time of modification and what its lines say (first time, last time, number).
Such rows stand for their files and can be put in place of earlier ones, so the
batches together answer for all files ever read. A later run lists the tree, leaves
out what the ledger has in just that form, and scans the rest. A batch counts only
with the mark that Spark leaves when all of a write is there; what a broken run
left behind is passed over, and its files are taken again.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.staging import scope, stage
from ..operators import entries
from ..operators import timeline as T_
from ..sources import LOG_FILES, read_logs
from ..sources.tables import is_complete, list_folder

FILE_STATE = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("first_ts", T.TimestampType()),
    T.StructField("last_ts", T.TimestampType()),
    T.StructField("lines", T.LongType()),
])


def listing(spark: SparkSession, root: str, glob: str = LOG_FILES) -> DataFrame:
    """Path, length and time of modification of every log file that is not empty, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root.rstrip("/"))
    meta = lambda c: F.col(f"_metadata.{c}")
    return files.select(meta("file_path").alias("file_path"), meta("file_size").alias("length"), meta("file_modification_time").alias("modified"))


def _batches(spark: SparkSession, target: str) -> dict[int, str]:
    """Folders of batches below ``target``, whole or not, by number."""
    found = {}
    for path in list_folder(spark, target):
        if m := re.search(r"/batch-(\d+)/?$", path):
            found[int(m[1])] = path
    return found


def file_states(spark: SparkSession, target: str) -> DataFrame:
    """The latest row of every file that a whole batch has read."""
    whole = [p for p in _batches(spark, target).values() if is_complete(spark, p)]
    if not whole:
        return spark.createDataFrame([], FILE_STATE)
    rows = spark.read.schema(FILE_STATE).parquet(*whole)
    rest = [c for c in FILE_STATE.names if c != "file_path"]
    return rows.groupBy("file_path").agg(F.max_by(F.struct(*rest), "batch").alias("_latest")).select("file_path", "_latest.*").select(*FILE_STATE.names)


def take_new_files(spark: SparkSession, source: str, target: str, glob: str = LOG_FILES) -> int:
    """Scan the files below ``source`` that are new or have changed, as one batch below ``target``; how many there were.

    Only files modified since the oldest of these are opened, and lines are reduced
    per file before they meet the list, so no text is shuffled. A file that grows meanwhile is
    recorded as listed and taken again next time. Files that have gone keep their rows.
    """
    with scope(spark):
        known = file_states(spark, target).select("file_path", "length", "modified")
        new = stage(listing(spark, source, glob).join(known, ["file_path", "length", "modified"], "left_anti"), "new-files")
        files, oldest = new.agg(F.count("*"), F.date_format(F.to_utc_timestamp(F.min("modified"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")).first()
        if not files:
            return 0
        lines = read_logs(spark, source, glob, modified_after=oldest)
        spans = T_.file_spans(entries.parse_entries(lines, anchored=False))
        number = max(_batches(spark, target), default=0) + 1
        rows = new.join(spans, "file_path", "left").withColumn("batch", F.lit(number).cast("bigint"))
        rows = rows.withColumn("lines", F.coalesce("lines", F.lit(0)).cast("bigint"))
        rows.select(*FILE_STATE.names).write.parquet(f"{target.rstrip('/')}/batch-{number:06d}")
    return files


def timeline(spark: SparkSession, target: str, keep_unmatched: bool = True) -> DataFrame:
    """The application timeline of all files read so far, from the ledger alone."""
    return T_.timeline_of_files(file_states(spark, target).filter("lines > 0").select("file_path", "first_ts", "last_ts"), keep_unmatched)


def compact(spark: SparkSession, target: str) -> None:
    """Put all whole batches into one. The old ones go when the new one is whole; a run that breaks leaves them."""
    old = _batches(spark, target)
    number = max(old, default=0) + 1
    rows = file_states(spark, target).withColumn("batch", F.lit(number).cast("bigint"))
    rows.write.parquet(f"{target.rstrip('/')}/batch-{number:06d}")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in old.values():
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
