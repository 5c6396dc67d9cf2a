"""From raw documents to token ids, in five stages.

Each stage takes all that the one before kept, as a written table, and returns the
columns of ``documents``; the last returns token ids. A stage decides by its own
operator: what toxicity, the quality rules and decontamination reject goes, and of
each group of near-duplicates (five words, similarity 0.8) the document with the
least id stays. Of rows of the same text, whatever their ids, one stays: rows with
an id before those without; of rows without id only such copies go. Rows that share
an id but not the text are different documents. Documents with a null text, or
without words, fail the quality rules.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage
from logmetrics.llm import decontamination, pieces, quality_rules, similarity, toxicity
from logmetrics.llm.queries import held_out, tokenizer_path
from logmetrics.llm.text import read

TOXIC = 0.3

# Rows and bytes that a task sends to Python at once. By default it is up to 64 MB of texts, held
# several times outside the heap of an executor that has 3,000 MB in all.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _small_batches(spark: SparkSession) -> None:
    """Sets how texts go to Python, for this session; it changes no result."""
    for setting, value in BATCHES.items():
        spark.conf.set(setting, value)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").filter(~held_out()))
    return docs.filter(toxicity.scorer(spark, model)(F.col("text")) < TOXIC)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    field = quality_rules.fit(docs, read(spark, sf_dir, "labels"))
    return docs.filter(quality_rules.keeper(spark, field)(F.col("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = similarity.near_duplicates(docs)
    surplus = stage(found.filter("doc_id != component_id").select("doc_id").distinct(), "surplus")
    return similarity.one_per_text(similarity.matching(docs, "doc_id", surplus, "left_anti").select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return decontamination.without_hits(docs, read(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    encoded = pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

# Neither a trained classifier nor merges can be written in SQL; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
