"""The operators' queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, langid, media, mixing, packing, passages, quality, secrets, sharding, simhash, vacode, whitening
from .common import read


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(read(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = secrets.addressed(read(spark, sf_dir, "documents"))
    return secrets.report(secrets.findings(paths.drop("text"), secrets.incremental(paths)))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(read(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored(read(spark, sf_dir, "documents"))


def op11_vacode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vacode.report(*vacode.compressed(read(spark, sf_dir, "embeddings")))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_passages, op2_packing, op3_mixing, op4_quality, op5_sharding, op6_ann, op7_secrets, op8_langid, op9_simhash, op10_media, op11_vacode, op12_bpe, op13_whitening)}
