"""A dimension with history: intervals of validity, look-ups as of a time, and versions that are swapped in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _same(columns: Sequence[str], other: Column) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(other[c])
    return same


def changed(history: DataFrame, changes: DataFrame, keys: Sequence[str], at: str, order: str | None = None) -> DataFrame:
    """history (keys, attributes, valid_from, valid_to; the open row of a key has no valid_to) with changes applied.

    changes: keys, attributes, at (when they hold from), and order (which of a key's changes at one time is the last). A
    change closes the key's open row and opens its own; one that changes nothing is none; several of a key follow one
    another. A change before the open row's time is late and holds from that time on, as the last one given. Closed rows
    stay as they are. A key's open row and changes meet in one window; no other rows do.
    """
    keys = list(keys)
    attributes = [c for c in history.columns if c not in (*keys, "valid_from", "valid_to")]
    opened = history.filter("valid_to IS NULL").select(*keys, *attributes, F.col("valid_from").alias("_at"), F.lit(0).alias("_new"), F.lit(None).cast("decimal(38,0)").alias("_order"))
    last = F.col(order).cast("decimal(38,0)") if order else F.lit(0).cast("decimal(38,0)")
    new = changes.filter(F.col(at).isNotNull()).select(*keys, *attributes, F.col(at).cast(history.schema["valid_from"].dataType).alias("_at"), F.lit(1).alias("_new"), last.alias("_order"))
    rows = opened.unionByName(new)
    by_key = Window.partitionBy(*keys)
    begun = F.max(F.when(F.col("_new") == 0, F.col("_at"))).over(by_key)
    rows = rows.withColumn("_at", F.greatest(F.col("_at"), begun))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys, "_at").orderBy(F.desc("_new"), F.desc("_order"), *[F.desc(c) for c in attributes]))).filter("_nth = 1")
    in_time = by_key.orderBy("_at")
    rows = rows.withColumn("_before", F.lag(F.struct(*attributes)).over(in_time)).filter(F.col("_before").isNull() | ~_same(attributes, F.col("_before")))
    rows = rows.withColumn("valid_to", F.lead("_at").over(in_time))
    return history.filter("valid_to IS NOT NULL").unionByName(rows.select(*keys, *attributes, F.col("_at").alias("valid_from"), "valid_to"))


def as_of(facts: DataFrame, history: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """facts with the attributes that held for their key at that time; null where none did.

    A join on the key, which splits hot keys as any join does; the intervals of a key don't overlap, so a fact finds one.
    """
    keys = list(keys)
    attributes = [c for c in history.columns if c not in (*keys, "valid_from", "valid_to")]
    held = history.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *attributes)
    on = (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return facts.join(held, on, "left").select(*facts.columns, *attributes)


class Versions:
    """A table whose versions are swapped in one step: data goes to a folder of its own, and only then a manifest that
    names it is created under the next number. A manifest is created whole or not at all, so a failed write is never seen,
    and of two writers that start from one version the second fails."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def number(self) -> int:
        """The last version; 0 if there is none."""
        if not self.fs.exists(self.path("manifests")):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path("manifests"))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit()), default=0)

    def read(self, number: int | None = None) -> DataFrame | None:
        """A version (the last one); None if there is none."""
        number = self.number() if number is None else number
        if not number:
            return None
        text = self.spark.read.text(f"{self.folder}/manifests/{number}.json", wholetext=True).first()[0]
        return self.spark.read.parquet(f"{self.folder}/data/{json.loads(text)['data']}")

    def write(self, df: DataFrame, after: int | None = None) -> int:
        """df as the version after `after` (the last one). Raises if there is such a version already."""
        number = (self.number() if after is None else after) + 1
        name = uuid.uuid4().hex
        df.write.parquet(f"{self.folder}/data/{name}")
        draft, final = self.path(f"manifests/.{name}"), self.path(f"manifests/{number}.json")
        out = self.fs.create(draft, False)
        out.write(bytearray(json.dumps({"data": name, "after": number - 1}).encode()))
        out.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            raise FileExistsError(f"version {number} exists")
        return number
