"""Refiled returns and shard logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbering import first_rows


def latest_refiling(rows: DataFrame, ein: str = "filer_ein", year: str = "return_year", form: str = "form_type", ts: str = "return_ts", sid: str = "submission_id", position: str = "pos", prior: DataFrame | None = None) -> DataFrame:
    """Of each form, filer and year, the filing of the latest time, then submission id, then first position. Blank filers never collapse.

    prior (ein, year): pairs that were emitted before drop out first.
    """
    if prior is not None:
        rows = rows.join(prior.select(F.col(ein).alias("_e"), F.col(year).alias("_y")).distinct(), (F.col(ein) == F.col("_e")) & (F.col(year) == F.col("_y")), "left_anti")
    own = F.when(F.coalesce(F.col(ein), F.lit("")) == "", F.concat(F.lit("#"), F.col(position).cast("string"))).otherwise(F.col(ein))
    keyed = rows.withColumn("_own", own)
    nth = F.row_number().over(Window.partitionBy(form, "_own", year).orderBy(F.desc(ts), F.desc(sid), position))
    return keyed.withColumn("_nth", nth).filter("_nth = 1").drop("_nth", "_own")


def one_row_per_filer_year(grants: DataFrame, ein: str, year: str, file: str, tie: str) -> DataFrame:
    """The published query as it is written: a single grant of each filer and year (of the last file; ties by the least `tie`)."""
    nth = F.row_number().over(Window.partitionBy(ein, year).orderBy(F.desc(file), tie))
    return grants.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def latest_filing_grants(grants: DataFrame, ein: str, year: str, file: str) -> DataFrame:
    """What that query means: all grants of each filer and year's last file. The last file is an aggregate, joined back, so no filer's grants sort in one task."""
    last = grants.groupBy(F.col(ein).alias("_e"), F.col(year).alias("_y")).agg(F.max(file).alias("_f"))
    on = F.col(ein).eqNullSafe(F.col("_e")) & F.col(year).eqNullSafe(F.col("_y")) & (F.col(file) == F.col("_f"))
    return grants.join(last, on, "left_semi")


def merge_shards(master: DataFrame, shards: list[DataFrame], key: str, position: str) -> DataFrame:
    """The master log with each shard's new rows, one a key, the first by position; keys of the master stay as they are."""
    new = shards[0]
    for s in shards[1:]:
        new = new.unionByName(s)
    new = first_rows(new.join(master.select(F.col(key).alias("_m")), F.col(key) == F.col("_m"), "left_anti"), [key], position)
    return master.unionByName(new)


def upsert(dim: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The dimension with changed rows replaced and new rows added."""
    kept = dim.join(changes.select(F.col(key).alias("_c")), F.col(key) == F.col("_c"), "left_anti")
    return kept.unionByName(changes)


def balanced_shards(weights: DataFrame, key: str, weight: str, n: int) -> DataFrame:
    """key, weight, bucket: heaviest first, each to the bucket with least so far (the first of equals).

    A fold over one array of the keys' weights: keys are few (years), and the rule is sequential.
    """
    items = weights.agg(F.sort_array(F.collect_list(F.struct((-F.col(weight)).alias("neg"), F.col(key).alias("k")))).alias("items"), F.count("*").alias("count"))
    n_buckets = F.least(F.lit(n), F.greatest(F.col("count"), F.lit(1))).cast("int")
    start = F.struct(F.transform(F.sequence(F.lit(1), n_buckets), lambda _: F.lit(0).cast("long")).alias("load"), F.array().cast(f"array<struct<k:{dict(weights.dtypes)[key]},w:bigint,bucket:int>>").alias("out"))

    def put(acc, item):
        least = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int")
        load = F.transform(acc["load"], lambda x, i: F.when(i + 1 == least, x - item["neg"].cast("long")).otherwise(x))
        return F.struct(load.alias("load"), F.concat(acc["out"], F.array(F.struct(item["k"].alias("k"), (-item["neg"]).cast("long").alias("w"), (least - 1).alias("bucket")))).alias("out"))

    return items.select(F.explode(F.aggregate("items", start, put, lambda acc: acc["out"])).alias("x")).select(F.col("x.k").alias(key), F.col("x.w").alias(weight), F.col("x.bucket").alias("bucket"))
