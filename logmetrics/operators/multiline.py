"""Entries that span lines: which line belongs to which header.

A file can hold a third of all lines, so no step may put a file into one task.
A scan reads a file in splits; inside a split the lines come in order. So the
windows run inside runs of 131,072 lines of a split, and one row per run carries
the counts over from the runs before it. That holds for a compressed file, too,
which is a single split however large it is.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.staging import stage

RUN = ("file_path", "block_start", "_run")


def number_entries(
    lines: DataFrame, stream: Sequence[str] = ("file_path",), run_lines: int = 131_072
) -> DataFrame:
    """Give every line its entry and its place in it: one row per line, whatever an entry's size.

    ``stream`` names the columns within which lines follow each other: the file,
    or the directory of a log that is kept in several files, which then follow
    each other by name.

    Adds ``line_no`` (from 0, in the stream), ``entry_no`` (from 1; 0 for lines
    before the first header) and ``line_in_entry`` (from 0). Every line is kept.

    Row positions mean something for one scan only, hence the written table
    between the scan and the two branches that read it: a job that runs here.
    """
    return _numbered(lines, stream, run_lines).select(*lines.columns, "line_no", "entry_no", "line_in_entry")


def _numbered(lines: DataFrame, stream: Sequence[str], run_lines: int) -> DataFrame:
    """``number_entries`` with the run of each line, the fields of its header, and whether its entry may go beyond the run."""
    keys = list(dict.fromkeys([*stream, *RUN]))
    order = [c for c in RUN if c not in stream]
    line = F.col("value")
    head = F.struct(P.header_time(line).alias("ts"), P.log_level(line).alias("level"), P.component(line).alias("component"))
    # The id counts rows in its lower 33 bits, the part of the scan in the upper.
    in_part = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    marked = stage(
        lines.withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_run", F.floor(in_part / run_lines))
        .withColumn("_header_row", F.when(P.is_header(F.col("value")), F.col("_row")))
        .withColumn("_head", F.when(F.col("_header_row").isNotNull(), head)),
        "lines",
    )
    runs = marked.groupBy(*keys).agg(
        F.min("_row").alias("_first"),
        F.count("*").alias("_lines"),
        F.count("_header_row").alias("_headers"),
        F.max("_header_row").alias("_last_header"),
        F.max_by("_head", "_header_row").alias("_last_head"),
    )
    before = Window.partitionBy(*stream).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        runs.withColumn("_lines_before", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
        .withColumn("_headers_before", F.coalesce(F.sum("_headers").over(before), F.lit(0)))
        .withColumn("_last_header_no", F.col("_lines_before") + F.col("_last_header") - F.col("_first"))
        # Lines before any header count from the start of the stream.
        .withColumn("_header_no_before", F.coalesce(F.max("_last_header_no").over(before), F.lit(0)))
        .withColumn("_head_before", F.last("_last_head", ignorenulls=True).over(before))
        .select(*keys, "_first", "_lines_before", "_headers_before", "_headers", "_header_no_before", "_head_before")
    )
    inside = Window.partitionBy(*keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    header_no = F.coalesce(
        F.col("_lines_before") + F.col("_header_seen") - F.col("_first"), F.col("_header_no_before")
    )
    return (
        marked.withColumn("_headers_seen", F.count("_header_row").over(inside))
        .withColumn("_header_seen", F.max("_header_row").over(inside))
        .withColumn("_head_seen", F.last("_head", ignorenulls=True).over(inside))
        .join(carried, keys)
        .withColumn("line_no", F.col("_lines_before") + F.col("_row") - F.col("_first"))
        .withColumn("entry_no", F.col("_headers_before") + F.col("_headers_seen"))
        .withColumn("line_in_entry", F.col("line_no") - header_no)
        .withColumn("_header", F.coalesce("_head_seen", "_head_before"))
        .withColumn("_open", (F.col("_headers_seen") == 0) | (F.col("_headers_seen") == F.col("_headers")))
    )


def assemble_entries(
    lines: DataFrame, stream: Sequence[str] = ("file_path",), part_lines: int = 1000, run_lines: int = 131_072
) -> DataFrame:
    """Whole entries: a header with the lines that continue it, as one text, and the header's ``ts, level, component``.

    An entry of more than ``part_lines`` lines comes in several rows, numbered by
    ``part``, so that no row grows without bound and no line is lost; each part has
    the header's fields. Lines before the first header form entry 0, which has none.
    Where a part's size must not matter, use ``number_entries``.

    Lines are put together inside their run first, where they already are for the
    numbering. Only what an entry leaves at a run's border is shuffled again.
    """
    stream = list(stream)
    keys = list(dict.fromkeys([*stream, *RUN]))
    text = lambda at: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(at, "value"))), lambda l: l["value"]), "\n")
    pieces = (
        _numbered(lines, stream, run_lines)
        .withColumn("part", F.floor(F.col("line_in_entry") / part_lines))
        .groupBy(*keys, "entry_no", "part")
        .agg(
            F.min("line_no").alias("first_line"), F.count("*").alias("lines"), F.first("_header").alias("_header"),
            F.first("_open").alias("_open"), text("line_in_entry").alias("value"),
        )
    )
    whole = pieces.filter(~F.col("_open")).select(*stream, "entry_no", "part", "first_line", "lines", "_header", "value")
    joined = (
        pieces.filter("_open").groupBy(*stream, "entry_no", "part")
        .agg(F.min("first_line").alias("_line"), F.sum("lines").alias("lines"), F.first("_header").alias("_header"), text("first_line").alias("value"))
        .withColumnRenamed("_line", "first_line").select(*whole.columns)
    )
    fields = [F.col("_header")[c].alias(c) for c in ("ts", "level", "component")]
    return whole.union(joined).select(*stream, "entry_no", "part", "first_line", "lines", *fields, "value")
