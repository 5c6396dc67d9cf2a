import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Lines of one container, in the shape of a scan."""

    def make(*values, path="/logs/application_1485248649253_0052/container_1485248649253_0052_01_000002.log"):
        rows = [(v, path, 0) for v in values]
        return spark.createDataFrame(rows, "value string, file_path string, block_start bigint")

    return make


def ts(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df) -> list:
    """Operators of the plan that ran, subqueries included; what was reused counts where it was made."""
    found, seen = [], set()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.startswith(("ReusedExchange", "ReusedSubquery")):
            return None
        if "QueryStage" in name:
            same = df.sparkSession._jvm.System.identityHashCode(node.plan())
            if "Reused" in node.plan().nodeName() or same in seen:
                return None
            seen.add(same)
            return walk(node.plan())
        found.append(node)
        for seq in (node.children(), node.subqueries()):
            for i in range(seq.size()):
                walk(seq.apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return found


def write_tree(root: Path, files: dict[str, list[str]]) -> str:
    for name, content in files.items():
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("".join(line + "\n" for line in content))
    return str(root)
