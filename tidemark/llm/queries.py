"""One query for each operator on texts and vectors, over whole given tables."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship_package

from . import chat_format, embedding_dedup, filter_audit, language_id, line_dedup, mixing, ngram_join, pii, quality_rules, sentencepieces, source_audit, token_records, toxicity
from .common import read, scratch

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # texts may be long
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op3_line_dedup(spark, sf_dir):
    return line_dedup.drop_repeated(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_source_mixing(spark, sf_dir):
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op6_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs, read(spark, sf_dir, "labels")).drop("lang")


@query
def op4_token_records(spark, sf_dir):
    folder = scratch(spark)
    index = token_records.write_records(read(spark, sf_dir, "documents"), folder, BYTE_BPE)
    back = token_records.read_records(token_records.with_start(index), folder, ("doc_id", "start"))
    return back.select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), token_records.ids_crc32().alias("ids_crc32"))


@query
def op9_sentencepiece(spark, sf_dir):
    ids = sentencepieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)
    both = sentencepieces.decode(ids.drop("text"), PIECES)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: A conversation whose texts look like the template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op8_chat_format(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(rows.dtypes)
    extra = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat_format.digest_chats(chat_format.format_chats(rows.unionByName(extra)))


@query
def op7_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.Toxicity.fit(docs, read(spark, sf_dir, "labels")).score(docs).drop("text")


@query
def op10_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.predict(docs.drop("lang"), language_id.fit(docs)).drop("text")


@query
def op2_embedding_dedup(spark, sf_dir):
    return embedding_dedup.link_vectors(read(spark, sf_dir, "embeddings"))


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.join(read(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op12_private_terms(spark, sf_dir):
    return pii.digests(pii.find(read(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op13_source_audit(spark, sf_dir):
    return source_audit.audit(read(spark, sf_dir, "documents"))
