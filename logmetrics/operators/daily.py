"""Daily measures of a table of timed records."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage
from .running import running_total

DAY = ("dt_year", "dt_month", "dt_day")


@dataclass(frozen=True)
class Measures:
    """Which column feeds which measure. The defaults are the public trip files'."""

    ts: str = "tpep_pickup_datetime"
    mean: str = "trip_distance"
    maximum: str = "mta_tax"
    quantile: str = "fare_amount"
    minimum: str = "tip_amount"
    mean_up: str = "passenger_count"


TRIPS = Measures()


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"dt_year": F.year(ts), "dt_month": F.month(ts), "dt_day": F.dayofmonth(ts)})


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Records of one year, as a range on the column itself.

    Unlike ``year(ts) = y`` the range reaches the parquet reader and skips row
    groups. The bounds take the column's own type, for a cast would undo that.
    """
    kind = df.schema[ts].dataType
    first, end = (F.lit(str(datetime(y, 1, 1))).cast(kind) for y in (year, year + 1))
    return df.filter((F.col(ts) >= first) & (F.col(ts) < end))


def daily_metrics(
    df: DataFrame,
    measures: Measures = TRIPS,
    year: int | None = None,
    q: float = 0.95,
    exact: bool = False,
) -> DataFrame:
    """Per day: records, mean, maximum, q-quantile, minimum, mean rounded up.

    Columns are named after their measure and source, ``mean_trip_distance`` and
    so on. The quantile is a value of the data: approximate by default (rank
    error 1/10,000), or ``exact`` at the price of a second scan.
    """
    df = df.filter(F.col(measures.ts).isNotNull()) if year is None else in_year(df, measures.ts, year)
    name = f"q{round(q * 100)}_{measures.quantile}"
    aggregates = [
        F.count("*").alias("num_trips"),
        F.avg(measures.mean).alias(f"mean_{measures.mean}"),
        F.max(measures.maximum).alias(f"max_{measures.maximum}"),
        F.min(measures.minimum).alias(f"min_{measures.minimum}"),
        F.ceil(F.avg(measures.mean_up)).alias(f"mean_{measures.mean_up}"),
    ]
    dated = with_date_parts(df, measures.ts)
    if exact:
        daily = _with_exact_quantile(dated, aggregates, measures.quantile, q, name)
    else:
        daily = dated.groupBy(*DAY).agg(*aggregates, F.percentile_approx(measures.quantile, q).alias(name))
    return daily.select(
        *DAY, "num_trips", f"mean_{measures.mean}", f"max_{measures.maximum}",
        name, f"min_{measures.minimum}", f"mean_{measures.mean_up}",
    )


def _with_exact_quantile(
    dated: DataFrame, aggregates: list[Column], column: str, q: float, out: str, accuracy: int = 10_000
) -> DataFrame:
    """Daily aggregates plus the exact discrete quantile.

    ``percentile`` keeps every distinct value of a group in one task's memory.
    Instead the first pass, next to the aggregates, takes approximate quantiles
    two error bounds below and above ``q``, between which the wanted value must
    lie. The second pass counts: the values below the band together, those in the
    band one by one, those above together. That combines on the map side, and
    only about 4/accuracy of a day's values are ever ranked.

    On a huge day that is still much, so the ranks come from a running count over
    a thousand slices of the band. Should a sketch miss, the counts below and above
    its band tell so; such a day is ranked again between its least and its greatest
    value, the same way.

    The first pass has one row per calendar day; it is written down, and so is the
    first ranking: jobs that run while the frame is built.
    """
    margin = 2.0 / accuracy
    ends = F.array(F.lit(max(q - margin, 0.0)), F.lit(min(q + margin, 1.0)))
    band = F.percentile_approx(column, ends, accuracy)
    days = stage(
        dated.groupBy(*DAY).agg(
            *aggregates, F.count(column).alias("_n"), band[0].alias("_low"), band[1].alias("_high"),
            F.min(column).alias("_min"), F.max(column).alias("_max"),
        ),
        "days",
    )
    ranked = stage(_ranked_in_band(dated, days, column, q), "ranked")
    missed = ranked.filter("_missed").select(*DAY)
    if missed.isEmpty():
        found = ranked
    else:
        wide = days.join(missed, list(DAY), "left_semi").withColumns({"_low": F.col("_min"), "_high": F.col("_max")})
        again = _ranked_in_band(dated.join(missed, list(DAY), "left_semi"), wide, column, q)
        found = ranked.filter("NOT _missed").unionByName(again)
    return found.withColumnRenamed("_value", out).select(*[c for c in days.columns if not c.startswith("_")], out)


def _ranked_in_band(dated: DataFrame, days: DataFrame, column: str, q: float) -> DataFrame:
    """``days`` with ``_value``, the value of the wanted rank, or ``_missed`` where that lies outside the band."""
    value, low, high = F.col(column), F.col("_low"), F.col("_high")
    # Nulls count as nothing and keep a day of nulls alone in the result.
    zone = F.when(value < low, 0).when(value > high, 2).when(value.isNull(), 0).otherwise(1)
    width = high.cast("double") - low.cast("double")
    into = value.cast("double") - low.cast("double")
    slice_ = F.when((width > 0) & (width < float("inf")), F.floor(into / width * 1000)).otherwise(0)
    counted = (
        dated.select(*DAY, column)
        .join(days.select(*DAY, "_low", "_high"), list(DAY))
        .withColumn("_zone", zone)
        .withColumn("_slice", F.when(F.col("_zone") == 0, -1).when(F.col("_zone") == 2, 1001).otherwise(slice_))
        .withColumn("_value", F.when(F.col("_zone") == 1, value))
        .groupBy(*DAY, "_slice", "_zone", "_value")
        .agg(F.count(column).alias("_times"))
    )
    ranked = running_total(counted, DAY, ["_zone", "_value"], F.col("_slice"), {"_times": "_upto"})
    n = F.col("_n")
    rank = F.greatest(F.ceil(n * F.lit(q)), F.lit(1))
    return (
        ranked.join(days, list(DAY))
        .filter(((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_times") < rank)) | (n == 0))
        .withColumn("_missed", (n > 0) & (F.col("_zone") != 1))
        .select(*days.columns, "_value", "_missed")
    )


def latest_first(daily: DataFrame) -> DataFrame:
    return daily.orderBy(*[F.desc(c) for c in DAY])


def latest_days(daily: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` days."""
    return latest_first(daily).limit(n)


def daily_rollup(daily: DataFrame) -> DataFrame:
    """Records in all, records per day, number of days, first and last day."""
    day = F.make_date(*DAY)
    return daily.agg(
        F.sum("num_trips").alias("total_trips"),
        F.avg("num_trips").alias("mean_daily_trips"),
        F.count("*").alias("days"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
