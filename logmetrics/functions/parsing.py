"""Reading fields out of one log line or one log path."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the log format.
STAMP = r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}"
STAMP_FORMAT = "yy/MM/dd HH:mm:ss"
MASTER_CONTAINER = "000001"

ANY_LEVEL = "(INFO|WARN|ERROR|DEBUG)"
APPLICATION = r"application_\d+_\d+"
CONTAINER = r"container_\d+_\d+_\d+_\d+"


def stamp_text(line: Column, anchored: bool = True) -> Column:
    """Time stamp as text; '' where the line has none."""
    return F.regexp_extract(line, f"{'^' if anchored else ''}({STAMP})", 1)


def header_time(line: Column, anchored: bool = True, on_bad: str = "null") -> Column:
    """Time stamp of a line.

    ``on_bad="null"`` turns an impossible date into null, ``"fail"`` lets the
    query fail on it. A line without any stamp gives null either way.
    """
    if on_bad not in ("null", "fail"):
        raise ValueError(f"on_bad must be 'null' or 'fail', not {on_bad!r}")
    text, fmt = F.nullif(stamp_text(line, anchored), F.lit("")), F.lit(STAMP_FORMAT)
    return F.try_to_timestamp(text, fmt) if on_bad == "null" else F.to_timestamp(text, STAMP_FORMAT)


def is_header(line: Column) -> Column:
    """Does the line open an entry, that is, start with a time stamp?"""
    return line.rlike(f"^{STAMP}")


def log_level(line: Column, strict: bool = False) -> Column:
    """Level word of a line, '' where there is none.

    By default the leftmost level word anywhere in the line counts, also as part
    of a longer word; ``strict`` wants it as a word right after the leading stamp.
    """
    if strict:
        return F.regexp_extract(line, rf"^{STAMP} {ANY_LEVEL}\b", 1)
    return F.regexp_extract(line, ANY_LEVEL, 1)


def component(line: Column, style: str = "colon") -> Column:
    """Component after the level: text up to the first colon, or the next token."""
    if style == "colon":
        return F.regexp_extract(line, ANY_LEVEL + r"\s+([^:]+):", 2)
    if style == "token":
        return F.regexp_extract(line, ANY_LEVEL + r"\s+([^\s]+)", 2)
    raise ValueError(f"style must be 'colon' or 'token', not {style!r}")


def message_text(line: Column) -> Column:
    """What follows ``component: ``, all lines of it."""
    return F.regexp_extract(line, "(?s)" + ANY_LEVEL + r"\s+[^:]+:\s*(.*)$", 2)


def application_id(path: Column) -> Column:
    return F.regexp_extract(path, APPLICATION, 0)


def cluster_id(application: Column) -> Column:
    """First number of an application id."""
    return F.substring_index(F.substring_index(application, "_", 2), "_", -1)


def app_number(application: Column) -> Column:
    """Last number of an application id, with its zeros."""
    return F.substring_index(application, "_", -1)


def container_id(path: Column) -> Column:
    return F.regexp_extract(path, CONTAINER, 0)


def container_digits(container: Column) -> Column:
    """Container id without its prefix: ``cluster_app_attempt_seq``."""
    return F.substring_index(container, "_", -4)


def attempt(container: Column) -> Column:
    return F.substring_index(F.substring_index(container, "_", 4), "_", -1)


def container_seq(container: Column) -> Column:
    return F.substring_index(container, "_", -1)


def container_role(container: Column) -> Column:
    """'AM' for an application's first container, 'executor' for the others."""
    seq = container_seq(container)
    return F.when(seq == MASTER_CONTAINER, "AM").when(seq != "", "executor")


def captures(text: Column, pattern: str, groups: int) -> Column:
    """The groups of a pattern's first match as an array; '' in it where there is none.

    The pattern runs over the text once, and once more over the match, however
    many groups it has. Needs two groups or more.
    """
    mark = "\u0001"
    joined = mark.join(f"${i}" for i in range(1, groups + 1))
    match = F.replace(F.regexp_extract(text, pattern, 0), F.lit(mark), F.lit("\ufffd"))
    return F.split(F.regexp_replace(match, pattern, joined), mark)


def cluster_start(cluster: Column) -> Column:
    """A cluster id is the epoch millisecond at which the cluster came up."""
    return F.timestamp_millis(cluster.try_cast("bigint"))


def size_in_bytes(number: Column, unit: Column) -> Column:
    """'1.5', 'KB' -> 1536. Units are powers of 1024."""
    factor = F.lit(None).cast("bigint")
    for power, name in enumerate(("B", "KB", "MB", "GB", "TB")):
        factor = F.when(unit == name, F.lit(1024 ** power)).otherwise(factor)
    return F.round(number.try_cast("double") * factor).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60
