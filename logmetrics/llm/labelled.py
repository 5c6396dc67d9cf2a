"""Bounded samples of labelled texts to train on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """About ``rows`` labelled texts, picked by a hash of the key; every one where there are no more.

    Repeated labels of a key count once, the largest; labels other than 0 and 1 and null keys go.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    share = min(1.0, rows / max(1, known.count()))
    picked = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20)) < int(share * (1 << 20) + 0.5)
    one = known.filter(picked).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    texts = docs.filter(picked).select(key, F.col(text).alias("text"))
    return stage(texts.join(one, key).select("label", "text"), f"{label}-sample")
