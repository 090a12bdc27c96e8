"""The pipeline's stages. Each takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return documents' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, mixing, packing, secrets, simhash
from .common import boxed, merged, read, saved, unboxed

#: A document is rejected when its language is `und`, or less likely than this.
LEAST_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; lang becomes the predicted one. The model learns from the rows that come in.

    A null, empty or letterless text is rejected; so is every text if no row has a language to learn from. Null ids and
    repeated rows are judged by their texts like any other row.
    """
    model = langid.fit(docs)
    found = langid.labelled(docs, model)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE))
    return unboxed(kept, docs, lang=F.col("lang_pred"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of linked fingerprints: of its rows with the least id, the one with the least text digest.

    Rows get keys of their own first, so rows that share an id, or have none, are told apart by where they link. Null
    and wordless texts are one component, of which one row stays.
    """
    keyed = saved(boxed(docs).withColumn("own_key", F.monotonically_increasing_id()), "keyed")
    found = simhash.near_duplicates(keyed.select(F.col("own_key").alias("doc_id"), F.col("box_text").alias("text"))).select("doc_id", "component_id")
    # keys, ids and digests alone settle who stays; only then do texts move
    rank = F.struct(F.col("box_doc_id").isNull(), F.col("box_doc_id"), F.sha2(F.col("box_text").cast("binary"), 256), F.col("own_key"))
    ranked = keyed.select("own_key", rank.alias("rank")).join(merged(found), F.col("own_key") == F.col("doc_id"))
    keep = ranked.groupBy("component_id").agg(F.min_by("own_key", "rank").alias("keep_key")).select("keep_key")
    return unboxed(keyed.join(merged(keep), F.col("own_key") == F.col("keep_key")), docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with findings replaced by [SECRET]; scans only what the ledger lacks.

    A null text stays null, an empty one empty; null ids and repeated rows stay rows, each with its findings replaced.
    """
    ledger = secrets.incremental(secrets.addressed(docs))
    hits = secrets.findings(ledger.select("sha").distinct(), ledger)
    return secrets.redacted(docs, hits.select("sha", "found"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: one row for each pass over a document, with the words that the mix takes in that pass.

    Null and wordless texts have nothing to take and go; a null source is a source; null ids and repeated rows are
    documents of their own.
    """
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences. A null or empty text is its end token; null ids and repeated rows are packed as they come."""
    return packing.packed(docs)


STAGES = [
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("secret scans", secret_stage),
    ("mixing to target weights", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
