"""Index resolution, manifests, lists of what to leave out, uploads, heartbeats."""

import glob

import pytest
from pyspark.sql import functions as F

from grantlens.plans import stages
from grantlens.sources import index, returns, sinks, tables
from grantlens.streaming import ingest


def test_the_index_is_a_named_file_or_key_or_the_latest(spark, tmp_path):
    files = spark.createDataFrame([("index_2024-01-05.csv", 1), ("index_2025-02-01.csv", 2), ("x.txt", 9)], "key string, modified int")
    here = tmp_path / "own.csv"
    here.write_text("a\n")
    assert index.resolve(files, "/base/", index_file=str(here)) == str(here)
    assert index.resolve(files, "/base/", index_key="k.csv") == "/base/k.csv"
    assert index.resolve(files, "/base") == "/base/index_2025-02-01.csv"
    with pytest.raises(FileNotFoundError):
        index.resolve(files, "/base", index_file=str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        index.resolve(files.limit(0), "/base")


def test_a_manifest_brings_what_it_lists_and_is_still_there(spark, tmp_path):
    path = tmp_path / "manifest.csv"
    path.write_text("﻿xml_path,form_type\n/x/1.xml,990\n/x/1.xml,990\n/x/gone.xml,990PF\n,\n")
    found = spark.createDataFrame([("/x/1.xml", "<a/>"), ("/x/2.xml", "<a/>")], "path string, value string")
    manifest = tables.read_manifest(spark, str(path))
    assert manifest.count() == 2
    assert [tuple(r) for r in returns.listed(found, manifest).collect()] == [("/x/1.xml", "<a/>", "990")]


def test_pairs_and_exclusions_leave_filings_out(spark, tmp_path):
    (tmp_path / "pairs.csv").write_text("filer_ein,return_year\n001,2020\n 002 ,2021\n")
    (tmp_path / "gone.csv").write_text("Name,Filer EIN\nx,003\n")
    files = spark.createDataFrame([("001", "2020"), ("001", "2021"), ("002", "2021"), ("003", "2020"), ("004", "2020")], "filer_ein string, return_year string")
    kept = stages.wanted(files, tables.read_pairs(spark, str(tmp_path / "pairs.csv")), tables.read_exclusions(spark, str(tmp_path / "gone.csv")))
    assert sorted(map(tuple, kept.collect())) == [("001", "2021"), ("004", "2020")]
    assert stages.wanted(files).count() == 5


def test_uploads_begin_with_a_byte_order_mark_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("NA", "0012", True), (None, 'a "b", c', None)], "canonical_id string, city string, flag boolean")
    schema = tables.schema("canonical_id, city, flag, missing")
    sinks.write_increment(rows.coalesce(1), schema, str(tmp_path / "out"), "s1")
    (part,) = glob.glob(f"{tmp_path}/out/stamp=s1/part-*.csv")
    raw = open(part, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfcanonical_id,city")
    back = tables.read_text_table(spark, f"{tmp_path}/out/stamp=s1", schema)
    assert sorted(map(tuple, back.collect())) == [("", 'a "b", c', "False", ""), ("NA", "0012", "True", "")]


def test_surrogates_follow_the_first_place_in_the_grants(spark):
    names = ["Zeta Works", "Alpha Works", "Midway Works", "Zeta Works"]
    columns = {c: "" for c in tables.PARSED.names}
    grants = spark.createDataFrame([tuple((columns | {"xml_file": f"{9 - i}.xml", "grantee": n, "grant_amount": "1"})[c] for c in tables.PARSED.names) + (i,) for i, n in enumerate(names)], ", ".join(f"{c} string" for c in tables.PARSED.names) + ", pos int").coalesce(1)
    dim = spark.createDataFrame([("SG00007", "Some Other Place", "TX", "US", "non-IPEDS-US", "Austin")], tables.DIM)
    said = lambda open_names: open_names.select("qid", F.lit("us_university").alias("v_type"), F.col("name").alias("v_name"), F.lit("US").alias("v_country"))
    out = stages.match(grants, dim, answers=said)
    assert {r["grantee_normalized"]: r["canonical_id"] for r in out.new_institutions.collect()} == {"Zeta Works": "SG00008", "Alpha Works": "SG00009", "Midway Works": "SG00010"}


def test_rates(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:01", "ok"), ("2024-01-01 00:00:59", "ok"), ("2024-01-01 00:00:30", "failed"), ("2024-01-01 00:01:01", "ok")], "ts string, kind string").withColumn("ts", F.to_timestamp("ts"))
    out = ingest.rates(rows, "ts", "1 minute", "5 minutes", "kind").select(F.date_format("window.start", "mm").alias("m"), "kind", "n").collect()
    assert sorted(map(tuple, out)) == [("00", "failed", 1), ("00", "ok", 2), ("01", "ok", 1)]
