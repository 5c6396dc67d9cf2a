"""Daily measures kept in a form that adds up to months and years.

A quantile of a month does not follow from quantiles of its days, but from sketches
of them: a stored row per day holds a KLL sketch next to sums and extremes, and any
longer stretch is answered from these rows, without the records.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .daily import DAY, TRIPS, Measures, in_year, with_date_parts

SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """Share of the values by which a rank may be off, at 99 percent: the published bound of the sketch."""
    return 2.296 / size**0.9021


def daily_sketches(df: DataFrame, measures: Measures = TRIPS, year: int | None = None, size: int = SIZE) -> DataFrame:
    """Per day: records, and sums, numbers, extremes and a sketch from which ``merged_metrics`` makes measures.

    Tasks sketch what they scan; a day's sketches, some kilobytes each, are merged
    after the shuffle. Null values count in no measure, records without a time nowhere.
    """
    df = df.filter(F.col(measures.ts).isNotNull()) if year is None else in_year(df, measures.ts, year)
    return with_date_parts(df, measures.ts).groupBy(*DAY).agg(
        F.count("*").alias("num_trips"),
        F.sum(F.col(measures.mean).cast("double")).alias("mean_sum"), F.count(measures.mean).alias("mean_n"),
        F.max(measures.maximum).alias("maximum"), F.min(measures.minimum).alias("minimum"),
        F.sum(F.col(measures.mean_up).cast("double")).alias("up_sum"), F.count(measures.mean_up).alias("up_n"),
        F.count(measures.quantile).alias("quantile_n"),
        F.kll_sketch_agg_double(F.col(measures.quantile).cast("double"), F.lit(size)).alias("sketch"),
    )


def merged_metrics(daily: DataFrame, *period: str, measures: Measures = TRIPS, q: float = 0.95) -> DataFrame:
    """The measures of ``daily_metrics`` per ``period``, some of the date parts (all records for none).

    The quantile is a value of the data whose rank is off by ``rank_error`` of the
    records at most, however many days were merged; null where there are no values.
    """
    total = daily.groupBy(*period).agg(
        *[F.sum(c).alias(c) for c in ("num_trips", "mean_sum", "mean_n", "up_sum", "up_n", "quantile_n")],
        F.max("maximum").alias(f"max_{measures.maximum}"), F.min("minimum").alias(f"min_{measures.minimum}"),
        # A day without values has an empty sketch, which has no quantile but merges with others.
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    mean = lambda s, n: F.col(s) / F.nullif(F.col(n), F.lit(0))
    quantile = F.when(F.col("quantile_n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    return total.select(
        *period, "num_trips", mean("mean_sum", "mean_n").alias(f"mean_{measures.mean}"), f"max_{measures.maximum}",
        quantile.alias(f"q{round(q * 100)}_{measures.quantile}"), f"min_{measures.minimum}",
        F.ceil(mean("up_sum", "up_n")).alias(f"mean_{measures.mean_up}"),
    )
