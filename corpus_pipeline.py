"""From raw documents to clean ones with piece ids, in five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows its
predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import decontam, exact_dedup, langid, pieces, simhash
from rowtide.session import new_run_dir

# Documents whose language is less sure than this are rejected, as are letterless ones.
LEAST_SURE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is determined; null and letterless texts go."""
    found, _ = langid.identify(docs)
    sure = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), found.alias("found"))
    sure = sure.where((F.col("found.lang") != langid.UNDETERMINED) & (F.col("found.score") >= LEAST_SURE))
    return sure.select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per distinct text, the one with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of linked fingerprints."""
    return simhash.drop_near_duplicates(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no window of a benchmark item occurs."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the piece ids of the text, their number, and whether they decode to the text."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = texts.select("doc_id", pieces.encode_column(spark, F.col("text")).alias("p"))
    return coded.select("doc_id", "p.pieces", F.size("p.pieces").cast("long").alias("n_pieces"), "p.round_trip")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", clean_of_benchmark),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = new_run_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# A trained model, fingerprint chains and piece scores have no SQL form.
ORACLE_SQL = None
