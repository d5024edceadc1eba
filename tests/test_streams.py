"""Streams with state by key: restarts, late records, expiry."""

from datetime import datetime, timedelta

from pyspark.sql.types import StructType

from curatrix.operators.changes import ChangeTable
from curatrix.operators.state import Tables
from curatrix.streaming import keyed

SCHEMA = StructType().add("k", "string").add("at", "timestamp").add("pos", "integer").add("v", "string")
T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


def test_newest_of_each_key(spark, tmp_path):
    table = ChangeTable(Tables(spark, f"file://{tmp_path}/t"), "x", SCHEMA, "k", buckets=2)

    def run(*rows):
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = keyed.newest_changes(spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in"), "k", "at", "pos", "2 hours")
        query = keyed.fold_into(table, stream, f"file://{tmp_path}/c")
        query.awaitTermination()
        states = [s for p in query.recentProgress for s in p["stateOperators"]]
        return {r.k: r.v for r in table.read().collect()}, sum(s["numRowsDroppedByWatermark"] for s in states), states[-1]["numRowsTotal"] if states else None

    got, _, held = run(("a", at(0), 1, "a1"), ("a", at(1), 1, "a3"), ("a", at(1), 0, "a2"), ("b", at(5), 0, "b1"), (None, at(5), 0, "n"), ("c", None, 0, "n"), ("d", at(4), None, "n"))
    assert got == {"a": "a3", "b": "b1"}
    assert held == 1  # a's state expired when the watermark reached 3:00, b's is open
    # in time and newer, in time and older, equal, too late, and a key whose state has expired
    got, dropped, _ = run(("b", at(5), 1, "b2"), ("b", at(4), 9, "older"), ("e", at(4), 0, "e1"), ("a", at(2), 9, "late"), ("f", at(2.9), 0, "late"))
    assert got == {"a": "a3", "b": "b2", "e": "e1"} and dropped == 2
    got, _, _ = run(("b", at(5), 1, "same"), ("a", at(6), 0, "a4"))
    assert got == {"a": "a4", "b": "b2", "e": "e1"}
    written = table.parts()
    assert run()[0] == got and table.parts() == written  # nothing new, nothing written
    # what a batch wrote before it failed to be marked as done is written again
    table.write(spark.createDataFrame([("b", at(5), 1, "b2")], SCHEMA))
    assert run(("g", at(6), 0, "g1"))[0] == got | {"g": "g1"}


def test_sessions(spark, tmp_path):
    def run(*rows):
        spark.createDataFrame([(k, at(h), 0, "") for k, h in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = keyed.sessions(spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in"), "k", "at", "1 hour", "3 hours")
        query = keyed.append_to(f"file://{tmp_path}/out", stream, f"file://{tmp_path}/c")
        query.awaitTermination()
        dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
        out = spark.read.parquet(f"file://{tmp_path}/out").collect()
        return sorted((r.k, (r.start - T0).total_seconds() / 3600, (r.end - T0).total_seconds() / 3600, r.n) for r in out), dropped

    got, _ = run(("a", 0), ("a", 0.5), ("a", 2), ("a", 5), ("b", 5.5), (None, 0.1))
    assert got == [("a", 0, 1.5, 2)]
    got, dropped = run(("a", 6), ("a", 2.9), ("a", 1.0), ("c", 1.4), ("b", 9))  # 2.9 is in time and joins 2; what 1.0 and 1.4 began would have ended before 2.5
    assert got == [("a", 0, 1.5, 2), ("a", 2, 3.9, 2)] and dropped == 2
    assert sorted((r.k, r.n) for r in keyed.sessions(spark.createDataFrame([("a", at(0), 0, ""), ("a", at(0.5), 0, "")], SCHEMA), "k", "at", "1 hour").collect()) == [("a", 2)]
