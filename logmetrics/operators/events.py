"""What single log messages say: requests, splits, blocks, hosts, worker times.

Each extractor takes parsed entries and returns one row per matching line. A plain
word test comes before the pattern: it is cheap, runs right behind the scan, and
leaves few lines for the regexes. Ids are taken from the path of matching lines
only, unless the entries carry them already. Lines of no application or container
have '' there, as in the entry table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.settle import settle
from ..sources.logs import with_ids

# Fixed message patterns of the log format.
EXECUTOR_REQUEST = (
    r"Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory"
    r"(?: including (\d+) MB overhead)?"
)
CONTAINER_REQUEST = r"Container request \(host: ([^,]+), capability: <memory:(\d+), vCores:(\d+)>\)"
PYTHON_TIMES = r"Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)"
INPUT_SPLIT = r"(?m)Input split: (.+):(\d+)\+(\d+)$"  # on one line of an entry
STORE_CAPACITY = r"MemoryStore started with capacity ([0-9.]+) (B|KB|MB|GB|TB)"
STORED_BLOCK = (
    r"Block (\S+) stored as \w+ in memory \(estimated size ([0-9.]+) (B|KB|MB|GB|TB), "
    r"free ([0-9.]+) (B|KB|MB|GB|TB)\)"
)
BROADCAST_READ = r"Started reading broadcast variable (\d+)"
LISTENING = r"listening on addresses :\[[^\]]*@([A-Za-z0-9._-]+):\d+"

WHO = ("cluster_id", "application_id", "container_id", "ts")


def mentions(word: str, pattern: str) -> Column:
    return F.col("raw").contains(word) & F.col("raw").rlike(pattern)


def matching(entries: DataFrame, condition: Column) -> DataFrame:
    """Entries that meet the condition, with ids."""
    found = entries.filter(condition)
    return found if "application_id" in found.columns else with_ids(found)


def captured(entries: DataFrame, word: str, pattern: str, groups: int) -> DataFrame:
    """Entries that match the pattern, with its groups as ``_g`` and with ids."""
    parts = {"_g": P.captures(F.col("raw"), pattern, groups)}
    found = settle(entries.filter(F.col("raw").contains(word)), parts).filter(F.size("_g") == groups)
    return found if "application_id" in found.columns else with_ids(found)


def text(group: int) -> Column:
    """A captured group, counted from one."""
    return F.col("_g")[group - 1]


def number(group: int) -> Column:
    return text(group).try_cast("bigint")


def executor_requests(entries: DataFrame) -> DataFrame:
    return captured(entries, "Will request", EXECUTOR_REQUEST, 4).select(
        *WHO,
        number(1).alias("executors"),
        number(2).alias("cores"),
        number(3).alias("memory_mb"),
        number(4).alias("overhead_mb"),
    )


def container_requests(entries: DataFrame) -> DataFrame:
    return captured(entries, "Container request", CONTAINER_REQUEST, 3).select(
        *WHO, text(1).alias("host"), number(2).alias("memory_mb"), number(3).alias("vcores")
    )


def resource_totals(requests: DataFrame) -> DataFrame:
    """Executors, cores and memory asked for per application."""
    return requests.groupBy("cluster_id", "application_id").agg(
        F.sum("executors").alias("executors"),
        F.sum(F.col("executors") * F.col("cores")).alias("total_cores"),
        F.sum(F.col("executors") * F.col("memory_mb")).alias("total_memory_mb"),
    )


def python_timings(entries: DataFrame) -> DataFrame:
    """Python worker times in milliseconds; parts can be negative."""
    parts = ("total_ms", "boot_ms", "init_ms", "finish_ms")
    return captured(entries, "Times: total", PYTHON_TIMES, 4).select(
        *WHO, *[number(i).alias(c) for i, c in enumerate(parts, 1)]
    )


def input_splits(entries: DataFrame) -> DataFrame:
    return captured(entries, "Input split", INPUT_SPLIT, 3).select(
        *WHO, text(1).alias("path"), number(2).alias("offset"), number(3).alias("length")
    )


def input_bytes(splits: DataFrame) -> DataFrame:
    """Splits and bytes read per application."""
    return splits.groupBy("cluster_id", "application_id").agg(
        F.count("*").alias("splits"), F.sum("length").alias("bytes")
    )


def broadcast_reads(entries: DataFrame) -> DataFrame:
    """Reads per broadcast variable of an application, and by how many containers.

    Reads are summed per container first; nothing is counted distinct.
    """
    per_container = (
        matching(entries, mentions("broadcast variable", BROADCAST_READ))
        .select("application_id", "container_id", F.regexp_extract("raw", BROADCAST_READ, 1).try_cast("bigint").alias("variable"))
        .groupBy("application_id", "variable", "container_id")
        .agg(F.count("*").alias("reads"))
    )
    return per_container.groupBy("application_id", "variable").agg(
        F.sum("reads").alias("reads"), F.count("*").alias("containers")
    )


def container_hosts(entries: DataFrame) -> DataFrame:
    """The host each container runs on, '' where it does not say.

    A container's log names many hosts: the driver's, and an application master
    those of all executors. Only the container's own announcement of the addresses
    it listens on counts, the latest if there are several. Lines meet one hash
    aggregation per file before ids are taken from the path.
    """
    host = F.when(F.col("raw").contains("listening on"), F.nullif(F.regexp_extract("raw", LISTENING, 1), F.lit("")))
    said = F.when(host.isNotNull(), F.struct("ts", host.alias("host")))
    carried = "application_id" in entries.columns
    keys = ["cluster_id", "application_id", "container_id"] if carried else ["file_path"]
    per_file = entries.groupBy(*keys).agg(F.max(said).alias("said"))
    found = per_file if carried else with_ids(per_file)
    return found.groupBy("cluster_id", "container_id").agg(F.coalesce(F.max("said")["host"], F.lit("")).alias("host"))


def host_distribution(hosts: DataFrame) -> DataFrame:
    """Containers per cluster and worker host."""
    return hosts.groupBy("cluster_id", "host").agg(F.count("*").alias("containers"))


def store_capacity(entries: DataFrame) -> DataFrame:
    """Size of the memory store a container started with."""
    return captured(entries, "MemoryStore started", STORE_CAPACITY, 2).select(
        *WHO, P.size_in_bytes(text(1), text(2)).alias("capacity_bytes")
    )


def memory_blocks(entries: DataFrame) -> DataFrame:
    """Blocks put into the memory store."""
    return captured(entries, "in memory (estimated", STORED_BLOCK, 5).select(
        *WHO,
        text(1).alias("block_id"),
        P.size_in_bytes(text(2), text(3)).alias("size_bytes"),
        P.size_in_bytes(text(4), text(5)).alias("free_bytes"),
    )
