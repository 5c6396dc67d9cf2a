"""Lines to entries, and which entries count."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.settle import settle, worked_out


def parse_entries(
    lines: DataFrame,
    anchored: bool = True,
    strict: bool = False,
    component_style: str = "colon",
    on_bad: str = "null",
) -> DataFrame:
    """Replace ``value`` by ``ts, level, component, message, raw``.

    ``anchored`` wants the time stamp at the start of the line; otherwise one in
    the text counts too. Other columns pass through. Fields nobody selects later
    cost nothing: Catalyst drops their expressions.

    ``on_bad="fail"`` leaves out lines without a stamp and fails on an
    impossible date.

    Fields that the lines already have, as assembled entries do, are kept: every
    part of a long entry has its header's.
    """
    line = F.col("value")
    if on_bad == "fail":
        lines = lines.filter(P.stamp_text(line, anchored) != "")
    fields = {
        "ts": P.header_time(line, anchored, on_bad),
        "level": P.log_level(line, strict),
        "component": P.component(line, component_style),
        "message": P.message_text(line),
    }
    return lines.select(
        *[c for c in lines.columns if c not in ("value", *fields)],
        *[F.col(c) if c in lines.columns else field.alias(c) for c, field in fields.items()],
        line.alias("raw"),
    )


def is_valid() -> Column:
    """The condition ``valid_entries`` keeps; never null."""
    return F.coalesce(F.col("level") != "", F.lit(False)) & F.col("ts").isNotNull()


def valid_entries(parsed: DataFrame) -> DataFrame:
    """Entries with a level and a possible time stamp.

    Fields parsed from text are worked out before the test, once. Those of a stored
    table are tested as they are, so the tests reach its reader.
    """
    if not worked_out(parsed, "ts", "level"):
        return parsed.filter(F.col("ts").isNotNull() & (F.col("level") != ""))
    fields = {c: F.col(c) for c in ("ts", "level")}
    return settle(parsed, fields).filter(is_valid()).select(*parsed.columns)


def header_lines(lines: DataFrame) -> DataFrame:
    """Lines that open an entry."""
    return lines.filter(P.is_header(F.col("value")))


def errors(entries: DataFrame) -> DataFrame:
    """Entries of level ERROR. On text a plain word test spares most lines the regex."""
    if not worked_out(entries, "level"):
        return entries.filter(F.col("level") == "ERROR")
    return entries.filter(F.col("raw").contains("ERROR") & (F.col("level") == "ERROR"))


def level_occurrences(lines: DataFrame) -> DataFrame:
    """How often each level word occurs in the text, every occurrence counted."""
    words = F.regexp_extract_all("value", F.lit(P.ANY_LEVEL), F.lit(1))
    return (
        lines.select(F.explode(words).alias("log_level"))
        .groupBy("log_level")
        .agg(F.count("*").alias("occurrences"))
    )
