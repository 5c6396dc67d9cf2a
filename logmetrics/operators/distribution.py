"""Histogram and density of a positive quantity on a log10 axis."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage

CELLS = 256  # per bandwidth of a density
MOST_GROUPS = 100_000  # rows of a few numbers that are sent to every task


def on_axis(value: Column) -> Column:
    """Does a number have a place on a log axis? Zero, negatives, NaN and infinity have none; never null."""
    return F.coalesce((value > 0) & (value < float("inf")), F.lit(False))


def log_histogram(df: DataFrame, column: str, bins_per_decade: int = 5, by: str | None = None) -> DataFrame:
    """Count per bin of log10(column).

    Values without a place on the axis (zero, negative, NaN, infinite) are counted
    in a row whose ``bin`` is null; nulls are not counted.
    """
    value = F.col(column).cast("double")
    keys = [by] if by else []
    edge = lambda b: F.pow(F.lit(10.0), b / bins_per_decade)
    return (
        df.filter(value.isNotNull())
        .select(*keys, F.when(on_axis(value), F.floor(F.log10(F.when(on_axis(value), value)) * bins_per_decade)).alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("n"))
        .select(*keys, "bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "n")
    )


def sample_size(df: DataFrame, column: str) -> DataFrame:
    """One row: values of a column, and those of them on the axis."""
    value = F.col(column).cast("double")
    return df.agg(F.count(value).alias("n"), F.count_if(on_axis(value)).alias("n_on_axis"))


def log_density(df: DataFrame, column: str, points: int = 50, by: str | None = None) -> DataFrame:
    """Gaussian kernel density of log10(column) on an even grid of ``points``.

    The bandwidth is Scott's: standard deviation times n^(-1/5). The grid runs
    from the smallest to the largest value. Without spread the density is null.
    With ``by``, one density per value of that column, null being one. Values
    without a place on the axis are left out; ``log_histogram`` counts them.

    Two scans. The first takes five numbers per group; they are written down, which
    is a job run here, and with few groups sent to every task. In the second a
    value is added to its cell, one of ``CELLS`` per bandwidth: number, and sums of the
    distance from the middle to the third power. The kernels are worked out per cell
    and grid point from these, by the first four terms of their series in that
    distance. What is left out is at most 1/8 (2 ``CELLS``)^-4 of a kernel's height
    per value, 2e-12. So a value costs four sums whatever the grid, and leaves its
    task in a cell's row only.
    """
    value = F.col(column).cast("double")
    keys = [by] if by else []
    x = F.col("_x")
    placed = df.filter(on_axis(value)).select(*keys, F.log10(value).alias("_x"))
    spread = F.when(F.max("_x") > F.min("_x"), F.stddev_samp("_x") * F.pow(F.count("*"), F.lit(-0.2)))
    shape = placed.groupBy(*keys).agg(
        F.min("_x").alias("_low"), F.count("*").alias("_count"), spread.alias("_h"),
        ((F.max("_x") - F.min("_x")) / max(points - 1, 1)).alias("_step"),
    ).filter("_count > 0")
    shape = stage(shape, "density")
    if by:
        side = F.broadcast(shape) if shape.count() <= MOST_GROUPS else shape
        joined = placed.join(side, placed[by].eqNullSafe(side[by])).drop(side[by])
    else:
        joined = placed.withColumn("_only", shape.select(F.struct("*").alias("_only")).scalar()).select("_x", "_only.*")
    # In bandwidths from the lowest value: the value, and the step of the grid.
    scaled = joined.select(
        *keys, "_low", "_count", "_h", "_step",
        ((x - F.col("_low")) / F.col("_h")).alias("_u"), (F.col("_step") / F.col("_h")).alias("_d"),
    )
    # In bandwidths from the lowest value, too: the middle of a value's cell, and its distance from that.
    cell = ((F.floor(F.col("_u") * CELLS) + 0.5) / CELLS).alias("_at")
    placed = scaled.select("*", cell).withColumn("_e", F.col("_u") - F.col("_at"))
    shape_columns = ["_low", "_count", "_h", "_step", "_d"]
    cells = placed.groupBy(*keys, *shape_columns, "_at").agg(
        F.count("*").alias("_m0"), F.sum("_e").alias("_m1"), F.sum(F.expr("_e * _e")).alias("_m2"), F.sum(F.expr("_e * _e * _e")).alias("_m3")
    )
    series = "exp(-0.5 * {z} * {z}) * (_m0 + {z} * _m1 + ({z} * {z} - 1) / 2 * _m2 + ({z} * {z} - 3) * {z} / 6 * _m3)"
    sums = cells.groupBy(*keys, "_low", "_count", "_h", "_step").agg(
        *[F.expr(f"sum({series.format(z=f'(_d * {k} - _at)')}) AS _k{k}") for k in range(points)]
    )
    kernels = F.array(*[f"_k{k}" for k in range(points)])
    return sums.select(
        *keys, "_low", "_step", "_count", "_h", F.posexplode(kernels).alias("point", "_kernel")
    ).select(
        *keys,
        "point",
        (F.col("_low") + F.col("_step") * F.col("point")).alias("log10_x"),
        (F.col("_kernel") / (F.col("_count") * F.col("_h") * F.sqrt(2 * F.pi()))).alias("density"),
    )
