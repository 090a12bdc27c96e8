"""python -m grantlens --steps parse,match,tag --xml DIR --dim FILE --out DIR --stamp S [--log DIR]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions import lineage
from .plans import stages
from .sources import returns, sinks, tables


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="grantlens")
    p.add_argument("--steps", default="parse,match,tag")
    p.add_argument("--xml")
    p.add_argument("--dim")
    p.add_argument("--log", help="the master log, a Parquet table of text; new returns are added")
    p.add_argument("--out", required=True)
    p.add_argument("--stamp", required=True)
    o = p.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    steps = o.steps.split(",")
    stage = lambda name: f"{o.out}/_{name}/stamp={o.stamp}"
    if "parse" in steps:
        done = None
        if o.log:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(o.log)
            if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
                done = spark.read.parquet(o.log)
        parsed = stages.parse(returns.read_returns(spark, o.xml), done)
        sinks.write_stage(parsed.grants, f"{o.out}/_parsed", o.stamp)
        sinks.write_stage(parsed.log, f"{o.out}/_log", o.stamp)
        log = spark.read.parquet(stage("log"))
        sinks.write_increment(stages.log_upload(log), tables.LOG_UPLOAD, f"{o.out}/ref_xml_processed", o.stamp)
        if o.log:
            sinks.append_log(log, tables.LOG, o.log)
    if "match" in steps:
        got = stages.match(spark.read.parquet(stage("parsed")), tables.read_text_table(spark, o.dim, tables.DIM))
        sinks.write_stage(got.grants, f"{o.out}/_matched", o.stamp)
        sinks.write_increment(got.new_institutions, tables.DIM, f"{o.out}/dim_institution", o.stamp)
        sinks.write_report(sinks.as_text(got.audit, tables.AUDIT), f"{o.out}/match_audit/stamp={o.stamp}")
    if "tag" in steps:
        out = stages.tag(spark.read.parquet(stage("matched")), stages.by_words)
        sinks.write_increment(out, tables.GRANTS, f"{o.out}/grantsdb", o.stamp)
    lineage.clear(spark)


if __name__ == "__main__":
    main()
