"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rapport.llm import alignment, decontaminate, embeddings, html_text, importance, language, licenses, mixing, pieces, secrets, sharding, simhash, whitening
from rapport.llm.common import table
from rapport.llm.oracles import ORACLES  # noqa: F401


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.array_join("licenses", ", ").alias("licenses"),
        F.array_join("sentence_ids", ", ").alias("sentence_ids"),
        "n_sentences",
        F.array_join("sentences", "\n").alias("sentences"),
    )


def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return importance.resample(table(spark, sf_dir, "documents"), good, share=0.5)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def op11_alignment(spark: SparkSession, sf_dir: str, byte_model: str = BYTE_MODEL, model: str = PIECE_MODEL) -> DataFrame:
    text = alignment.byte_model_text(read_bytes(byte_model))
    return alignment.best_links(table(spark, sf_dir, "documents"), text, pieces.read_model(read_bytes(model)))


def op12_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), pieces.read_model(read_bytes(model)))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=8)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_licenses,
        op2_importance,
        op3_sharding,
        op4_main_text,
        op5_language,
        op6_secrets,
        op7_mixing,
        op8_decontamination,
        op9_embeddings,
        op10_simhash,
        op11_alignment,
        op12_sentencepiece,
        op13_whitening,
    )
}
