"""Parquet scans, results written earlier, and looking at a source."""

from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how the public monthly trip files are named.
MONTH_FILE = "yyyy={year}/yellow_tripdata_{year}-{month:02d}.parquet"

# Fixed value: what Spark puts into a folder when a write is complete.
COMMIT_MARK = "_SUCCESS"


def month_paths(
    base: str, year: int, months: Iterable[int] = range(1, 13), template: str = MONTH_FILE
) -> list[str]:
    """One path per month below ``base``."""
    return [f"{base.rstrip('/')}/{template.format(year=year, month=m)}" for m in months]


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of ``paths`` that are there; an error if none is.

    Works for any file system Spark is configured for. Wildcards are allowed.
    """
    paths = list(paths)
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    found = []
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        matches = hadoop_path.getFileSystem(conf).globStatus(hadoop_path)
        if matches is not None and len(matches) > 0:
            found.append(path)
    if not found:
        raise FileNotFoundError(f"none of these paths exists: {', '.join(paths)}")
    return found


def read_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    base_path: str | None = None,
    skip_missing: bool = False,
) -> DataFrame:
    """Parquet scan of one path, a wildcard, or a list of files.

    ``base_path`` keeps the ``key=value`` directories between it and the files as
    columns. ``skip_missing`` goes on with the paths that are there.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if skip_missing:
        paths = existing_paths(spark, paths)
        reader = reader.option("ignoreMissingFiles", True)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.parquet(*paths)


def read_months(
    spark: SparkSession,
    base: str,
    year: int,
    months: Iterable[int],
    year_column: str = "yyyy",
    month_column: str = "mm",
) -> DataFrame:
    """Months of one year from a table partitioned by year and month.

    The condition is on partition columns alone, so other months' directories
    are pruned from the scan.
    """
    return spark.read.parquet(base).filter(
        (F.col(year_column) == year) & F.col(month_column).isin(*months)
    )


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """What lies right below a folder; nothing if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [str(s.getPath().toString()) for s in system.listStatus(folder)] if system.exists(folder) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Has a written folder the mark that Spark leaves when all of it is there?"""
    return any(p.endswith(f"/{COMMIT_MARK}") for p in list_folder(spark, path))


def load_result(spark: SparkSession, path: str, schema: T.StructType, marked: bool = True) -> DataFrame:
    """Read a saved CSV result, all its part files, with given types.

    A bare empty field is null, a quoted one is ''. A folder without the mark of a
    finished write is refused, since parts may be missing; ``marked=False`` reads
    results of writers that leave none.
    """
    if marked and not is_complete(spark, path):
        raise FileNotFoundError(f"{path} is not there or not whole: it has no {COMMIT_MARK}")
    return spark.read.schema(schema).option("header", True).option("nullValue", "\\N").csv(path)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; columns a table lacks become null."""
    if not frames:
        raise ValueError("union_all needs at least one table")
    # select("*") makes plain rows of spark.range, which cannot gain columns.
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select("*") for f in frames])


def register_views(**frames: DataFrame) -> None:
    """Make tables available to ``spark.sql`` under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


_PROFILE = "column_name string, data_type string, row_count bigint, problem string"


def _problem(error: Exception) -> str:
    """Spark's condition for a failure, or ``UNEXPECTED`` with the failure's class."""
    known = error.getCondition() if isinstance(error, PySparkException) else None
    if known:
        return known
    cause = getattr(error, "java_exception", None)
    return f"UNEXPECTED: {cause.getClass().getName() if cause is not None else type(error).__name__}"


def describe_source(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columns, types and row count of a source, or why it cannot be read.

    One row per column; a source that fails gives one row with ``problem`` set to
    Spark's error condition (``PATH_NOT_FOUND`` and the like), or to ``UNEXPECTED``
    and a class. The rows are counted here, so that a file that breaks off while
    it is read is reported as well.
    """
    try:
        df = spark.read.format(fmt).load(path)
        rows = df.count()
    except (PySparkException, Py4JError) as e:
        return spark.createDataFrame([(None, None, None, _problem(e))], _PROFILE)
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), rows, None) for f in df.schema.fields], _PROFILE)


def source_sample(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """``n`` rows to look at: the first of an order, or any without one."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)
