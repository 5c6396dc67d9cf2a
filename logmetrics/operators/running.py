"""Running values over groups of any size.

A window partitioned by a key puts the whole key into one task. Here a key is cut
into ranges of its order first: the window runs inside (key, range), and one row
per range carries over what the earlier ranges add up to.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cut(df: DataFrame, keys: list[str], order: list[str], values: list[str], span: Column) -> DataFrame:
    """The columns at work, and ``_span``. Rows without a key or place belong to no order and go.

    Two branches read this. They share one scan and shuffle only while they ask
    for the same rows and columns: so no other column passes, and the condition
    stands here, where a join would put it into one branch alone.
    """
    cut = df.select(*keys, *order, *values, span.alias("_span"))
    return cut.filter(reduce(and_, [F.col(c).isNotNull() for c in [*keys, "_span"]]))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], span: Column, values: dict[str, str]
) -> DataFrame:
    """Running sums per ``keys`` in the order of ``order``.

    ``values`` maps each column to the name of its sum. ``span`` maps ``order`` to
    a range and must rise with it; the caller picks it so that one (keys, span)
    holds few rows. (keys, order) must be unique. Rows without a key or place are
    in no order and left out. The result has keys, order, values and sums.
    """
    keys, order, names = list(keys), list(order), list(values)
    cut = _cut(df, keys, order, names, span)
    inside = Window.partitionBy(*keys, "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "_span")
        .agg(*[F.sum(v).alias(f"_sum_{v}") for v in names])
        .select(*keys, "_span", *[
            F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_carried_{v}") for v in names
        ])
    )
    return (
        cut.withColumns({f"_inside_{v}": F.sum(v).over(inside) for v in names})
        .join(carried, [*keys, "_span"])
        .select(*keys, *order, *names, *[
            (F.col(f"_inside_{v}") + F.col(f"_carried_{v}")).alias(out) for v, out in values.items()
        ])
    )


def previous_row(
    df: DataFrame, keys: Sequence[str], order: str, span: Column, columns: Sequence[str], out: str
) -> DataFrame:
    """Add struct ``out``: ``columns`` of the row before, per ``keys``; null for the first.

    ``span``, and rows without a key or place, as for ``running_total``. The result has keys, order, columns and ``out``.
    """
    keys = list(keys)
    cut = _cut(df, keys, [order], list(columns), span).withColumn("_row", F.struct(*columns))
    inside = Window.partitionBy(*keys, "_span").orderBy(order)
    earlier = Window.partitionBy(*keys).orderBy("_span")
    carried = (
        cut.groupBy(*keys, "_span")
        .agg(F.max_by("_row", order).alias("_last"))
        .select(*keys, "_span", F.lag("_last").over(earlier).alias("_carried"))
    )
    return (
        cut.withColumn("_inside", F.lag("_row").over(inside))
        .join(carried, [*keys, "_span"])
        .select(*keys, order, *columns, F.coalesce("_inside", "_carried").alias(out))
    )


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], span: Column, value: str, out: str) -> DataFrame:
    """Add ``out``: the greatest ``value`` of all rows before, per ``keys`` in the order of ``order``; null for the first.

    ``span``, (keys, order) and rows without a key or place as for ``running_total``.
    """
    keys, order = list(keys), list(order)
    cut = _cut(df, keys, order, [value], span)
    inside = Window.partitionBy(*keys, "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy(*keys, "_span").agg(F.max(value).alias("_max")).select(*keys, "_span", F.max("_max").over(earlier).alias("_carried"))
    return (
        cut.withColumn("_inside", F.max(value).over(inside))
        .join(carried, [*keys, "_span"])
        .select(*keys, *order, value, F.greatest("_inside", "_carried").alias(out))
    )
