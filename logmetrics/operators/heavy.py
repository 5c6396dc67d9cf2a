"""The commonest values of a column of very many, exactly and in bounded memory.

Grouping every value keeps a row for each, most of them rare. Here values are
counted in hash buckets first. No value occurs oftener than its bucket, so a
bucket with fewer rows than the k-th commonest value holds none of the k. The
values of the fullest buckets give a lower bound of that number; then the values of
the buckets that reach it are counted, and the answer is among them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage

BUCKETS = 1 << 16


def heavy_values(df: DataFrame, column: str, k: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` commonest values of ``column`` and ``n``, their numbers; equal numbers by value. Null counts as a value.

    Exact whatever the data. Three scans, of which the second and third group only values of
    full buckets; where no bucket stands out, the third groups them all. Jobs run
    while the frame is built: ``buckets`` rows at most are written.
    """
    rows = df.select(F.col(column).alias("_value")).withColumn("_bucket", F.pmod(F.xxhash64("_value"), F.lit(buckets)))
    sizes = stage(rows.groupBy("_bucket").agg(F.count("*").alias("_n")), "heavy-buckets")

    def values_of(chosen: DataFrame) -> DataFrame:
        found = rows.join(F.broadcast(chosen.select("_bucket")), "_bucket")  # BUCKETS rows at most
        return found.groupBy("_value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("_value")).limit(k)

    fullest = sizes.orderBy(F.desc("_n"), "_bucket").limit(4 * k)
    first = stage(values_of(fullest), "heavy-values")
    known, least = first.agg(F.count("*"), F.min("n")).first()
    reach = sizes.filter(F.col("_n") >= (least if known == k else 0))
    return values_of(reach).select(F.col("_value").alias(column), "n")


def heavy_components(entries: DataFrame, k: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """``top_components`` for logs whose components are very many: same rows, grouped in bounded memory."""
    named = entries.select(F.coalesce("component", F.lit("")).alias("component"))
    return heavy_values(named, "component", k, buckets).withColumnRenamed("n", "entries")
