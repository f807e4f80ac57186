"""A training corpus from raw documents, in five stages; every one is written as Parquet and read again."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, ngram_join, sentencepieces, toxicity
from tidemark.llm.common import read, scratch, text_or_empty
from tidemark.session import ship_package

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def like(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn toxicity from the labels of these documents, and drop those predicted toxic."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # texts may be long
    ship_package(spark)
    model = toxicity.Toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return model.score(docs).where("predicted = 0").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated runs of lines from texts; no document goes."""
    return like(docs, line_dedup.drop_repeated(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring sources to their weights; a document is there as often as the mix takes it."""
    taken = mixing.mix(docs).where("copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode texts; ``round_trip`` says whether the ids decode to the text."""
    ids = sentencepieces.encode(docs, PIECES)
    both = sentencepieces.decode(ids, PIECES)
    kept = [c for c in docs.columns if c != "text"]
    return both.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == text_or_empty("text")).alias("round_trip"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_each_group),
    ("mixing", mixed),
    ("sentencepiece", tokenized),
]

#: Trees and MinHash signatures have no SQL; tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        folder = scratch(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
