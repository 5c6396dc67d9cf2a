"""A few entries to look at."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows of a total order: each task keeps ``n``, nothing is sorted."""
    return df.orderBy(*order).limit(n)


def earliest_entries(entries: DataFrame, n: int = 10, ties: Sequence[str] = ("file_path", "raw")) -> DataFrame:
    """The ``n`` earliest entries. ``ties`` settles equal times."""
    return first_rows(entries, n, "ts", *ties)


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows at random, the same ones on every run.

    ``key`` should be unique. Rows are taken in the order of a hash of seed and
    key, so any other engine that has MD5 draws the same sample.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return first_rows(df, n, draw, key)
