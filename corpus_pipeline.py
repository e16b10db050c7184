"""From raw documents to training batches: the stages, each written as Parquet and read again."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import jaccard, outliers, packing, quality, substrings
from starloom.session import read_table, work_folder

#: Documents with a lower score go.
LEAST_SCORE = 0.3


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores below ``LEAST_SCORE``."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality.train(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    return docs.where(quality.quality_score(F.col("text"), model) >= LEAST_SCORE)


def check_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are outliers of their language and source."""
    return outliers.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_first(docs, least=80, size=5)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated 35-word windows out of the texts; ``n_chars`` follows the text."""
    return substrings.drop_repeated(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in length buckets and token-budget batches."""
    return packing.pack(docs, packing.word_tokens(F.col("text")))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", check_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_passages),
    ("packing", pack),
]

#: The stages are learned or iterative: SQL cannot express them. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    folder = work_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
