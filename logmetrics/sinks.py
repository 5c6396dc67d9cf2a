"""Writing results."""

from pyspark.sql import DataFrame


def save_csv(
    df: DataFrame, path: str, single: bool = False, timestamp_format: str | None = None
) -> None:
    """CSV with a header line, replacing what was there.

    ``single`` puts everything into one part file and so into one task: only for
    results of report size. Timestamps print as ``2017-03-29T09:55:33.000Z``
    unless a format is given.
    """
    writer = (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True)
    if timestamp_format is not None:
        writer = writer.option("timestampFormat", timestamp_format)
    writer.csv(path)


def save_report(report: DataFrame, path: str) -> None:
    """Text file with a report's lines in order. Reports are a dozen lines."""
    report.orderBy("ord").select("line").coalesce(1).write.mode("overwrite").text(path)
