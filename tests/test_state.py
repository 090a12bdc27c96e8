"""Event-time state, history, the store of answers and the bucketed log: restarts, failures, odd input."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from grantlens.operators import history, ledger
from grantlens.sources.log import BucketedLog
from grantlens.streaming import ingest, windows

DAY = datetime(2024, 1, 1)
EVENTS = "ts timestamp, kind string, value double"


def at(hours):
    return DAY + timedelta(hours=hours)


def deliver(spark, folder, n, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/in/{n}")


def run_windows(spark, folder):
    stream = ingest.stream_files(spark, f"{folder}/in/*", EVENTS)
    windows.run(windows.windowed(stream, "ts", "1 hour", "2 hours", ["kind"], total=F.sum("value")), f"{folder}/out", f"{folder}/state")
    found = spark.read.parquet(f"{folder}/out").collect()
    return {(int((r["start"] - DAY).total_seconds() // 3600), r["kind"]): (r["n"], r["total"]) for r in found}


def test_windows_close_once_and_state_outlives_a_restart(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, 0, [(at(1.5), "a", 1.0), (at(0.2), "a", 1.0), (at(0.7), None, 5.0), (None, "a", 9.0), (at(3.1), "b", 1.0)])
    assert run_windows(spark, folder) == {(0, "a"): (1, 1.0), (0, None): (1, 5.0)}  # watermark 1.1
    # state of hour 1 was kept; a row of hour 0 comes too late, one of hour 1 does not
    deliver(spark, folder, 1, [(at(0.9), "a", 100.0), (at(1.2), "a", 10.0), (at(6.0), "b", 1.0)])
    heart = windows.Heartbeat()
    spark.streams.addListener(heart)
    try:
        found = run_windows(spark, folder)
    finally:
        spark.streams.removeListener(heart)
    assert found == {(0, "a"): (1, 1.0), (0, None): (1, 5.0), (1, "a"): (2, 11.0), (3, "b"): (1, 1.0)}
    assert run_windows(spark, folder) == found  # nothing new, nothing twice
    rates = heart.rates()
    assert (rates["rows"], rates["late"]) == (3, 1) and rates["batches"] >= 1 and rates["rows_per_second"] > 0
    assert heart.reports[-1]["watermark"].startswith("2024-01-01T04:00")


def test_sessions(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, 0, [(at(h), "a", 1.0) for h in (1.0, 0.6, 0.2, 3.0)] + [(at(0.5), "b", 2.0), (at(20), "c", 0.0)])
    stream = ingest.stream_files(spark, f"{folder}/in/*", EVENTS)
    windows.run(windows.sessions(stream, "ts", "30 minutes", "1 hour", ["kind"], total=F.sum("value")), f"{folder}/out", f"{folder}/state")
    got = {(r["kind"], r["start"], r["end"], r["n"], r["total"]) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {("a", at(0.2), at(1.5), 3, 3.0), ("a", at(3), at(3.5), 1, 1.0), ("b", at(0.5), at(1), 1, 2.0)}


HISTORY = "k int, v string, w int, valid_from timestamp, valid_to timestamp"


def rows_of(df):
    return sorted(((r["k"], r["v"], r["w"], r["valid_from"], r["valid_to"]) for r in df.collect()), key=str)


def test_changes_close_and_open_intervals(spark):
    start = spark.createDataFrame([(1, "a", None, at(0), None), (2, "x", 1, at(0), at(5)), (2, "y", 1, at(5), None)], HISTORY)
    changes = spark.createDataFrame(
        [(1, "a", None, at(3), 0), (1, "b", None, at(4), 0), (1, "c", 2, at(6), 1), (1, "d", 2, at(6), 2), (1, "d", 2, at(7), 0), (2, "late", 9, at(1), 0), (3, None, None, at(2), 0), (3, "n", None, None, 0), (1, "b", None, at(4), 0)],
        "k int, v string, w int, at timestamp, nth int",
    )
    made = history.changed(start, changes, ["k"], "at", "nth")
    assert rows_of(made) == sorted(
        [(1, "a", None, at(0), at(4)), (1, "b", None, at(4), at(6)), (1, "d", 2, at(6), None), (2, "x", 1, at(0), at(5)), (2, "late", 9, at(5), None), (3, None, None, at(2), None)], key=str
    )
    assert rows_of(history.changed(made, changes.limit(0), ["k"], "at")) == rows_of(made)
    facts = spark.createDataFrame([(1, at(3.9)), (1, at(4)), (1, at(9)), (2, at(-1)), (4, at(1)), (None, at(1)), (2, at(4.99))], "k int, t timestamp")
    got = sorted(((r["k"], r["t"], r["v"]) for r in history.as_of(facts, made, ["k"], "t").collect()), key=str)
    assert got == sorted([(1, at(3.9), "a"), (1, at(4), "b"), (1, at(9), "d"), (2, at(-1), None), (4, at(1), None), (None, at(1), None), (2, at(4.99), "x")], key=str)


def test_a_failed_write_is_never_seen(spark, tmp_path):
    table = history.Versions(spark, f"{tmp_path}/t")
    assert table.read() is None
    assert table.write(spark.range(3).toDF("n")) == 1
    fail = spark.range(5).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        table.write(fail)
    assert (table.number(), table.read().count()) == (1, 3)
    seen = table.number()  # two writers start from version 1
    assert table.write(table.read().union(spark.range(3, 5).toDF("n")), seen) == 2
    with pytest.raises(FileExistsError):
        table.write(spark.range(1).toDF("n"), seen)
    assert (table.read().count(), table.read(1).count()) == (5, 3)


def test_a_crash_between_rounds_loses_none(spark, tmp_path):
    folder = f"{tmp_path}/answers"
    names = spark.createDataFrame([(f"Name {i}",) for i in range(40)] + [("NAME  1",), (None,), ("",)], "name string")
    asked = []

    def ask(rows, fail_after=None):
        if fail_after is not None and len(asked) >= fail_after:
            raise RuntimeError("connection lost")
        asked.append(rows.count())
        return rows.filter("key <> 'NAME 3'").withColumn("verdict", F.lower("name"))

    with pytest.raises(RuntimeError):
        ledger.answered(names, "name", lambda r: ask(r, 2), "verdict string", "v1", folder, most=10)
    done = sum(asked)
    assert 0 < done < 40
    asked.clear()
    found, count = ledger.answered(names, "name", ask, "verdict string", "v1", folder, most=10)
    assert count in (40 - done, 41 - done) and sum(asked) == count  # only what was not stored
    assert {r["key"] for r in found.collect()} == {f"NAME {i}" for i in range(40)} - {"NAME 3"}
    asked.clear()
    assert ledger.answered(names, "name", ask, "verdict string", "v1", folder)[1] == 1  # what had no answer
    assert ledger.answered(names, "name", ask, "verdict string", "v2", folder)[1] == 40


def test_the_log_is_not_shuffled(spark, tmp_path):
    log = BucketedLog(spark, "log_of_a_test", f"{tmp_path}/log", "xml_file", 6)
    log.append(spark.range(0, 1000).select(F.concat(F.lit("f"), "id").alias("xml_file"), F.col("id").alias("pos")))
    new = spark.createDataFrame([(f"f{i}", i) for i in range(990, 1010)] + [(None, 1)], "xml_file string, pos long")
    found = log.unprocessed(new)
    plan = found._jdf.queryExecution().executedPlan().toString()
    log_side = plan[plan.rindex("FileScan") :]
    assert "SelectedBucketsCount: 6 out of 6" in log_side and "Exchange" not in log_side
    assert plan.count("Exchange") == 1  # the new rows'
    assert sorted(str(r["xml_file"]) for r in found.collect()) == sorted(["None", *[f"f{i}" for i in range(1000, 1010)]])
    log.merge(new.filter("xml_file IS NOT NULL"), "pos")
    assert log.read().count() == 1010
    assert log.merge(new.filter("xml_file IS NOT NULL"), "pos").count() == 0
    spark.sql("DROP TABLE log_of_a_test")
