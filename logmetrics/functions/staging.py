"""Where intermediate tables go, and how a frame is pinned to one."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_open_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, or the
    checkpoint folder set on the context.

    Only a local session may go without: it gets a fresh temporary folder. A
    cluster has no such default, since a machine's own disk is lost with it.
    """
    sc = spark.sparkContext
    path = spark.conf.get(SETTING, None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="logmetrics-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _open_scopes[-1:]:
        paths.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, so use no frame made from them afterwards."""
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes.remove(paths)
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    For a frame that several branches read and that must be the same in each of
    them (row positions of a scan), or that is far cheaper to read than to make.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
