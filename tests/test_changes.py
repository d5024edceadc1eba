"""Tables of changes, and writers that are taken over."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curatrix.operators.changes import ChangeTable
from curatrix.operators.state import Fenced, Locked, Tables

SCHEMA = StructType().add("id", "long").add("v", "string").add("_note", "string")


def rows(spark, ids, v):
    return spark.createDataFrame([(i, v, None) for i in ids], SCHEMA)


def content(table):
    found = [tuple(r) for r in table.read().select("id", "v").collect()]
    assert len(found) == len(set(found))
    return dict(found)


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))


def test_changes_are_merged(spark, tmp_path):
    table = ChangeTable(Tables(spark, f"file://{tmp_path}/t"), "x", SCHEMA, "id", buckets=8)
    assert table.read().count() == 0 and table.compact() == [] and table.write(rows(spark, [], "a")) == 0
    table.write(rows(spark, range(100), "a"))
    want = dict.fromkeys(range(100), "a")
    assert content(table) == want
    assert len(table.compact()) == 8 and content(table) == want
    before = table.read()
    table.write(rows(spark, [3, 5, 200], "b"), gone=rows(spark, [5, 7, 999], None))
    want = {k: v for k, v in want.items() if k != 7} | dict.fromkeys([3, 5, 200], "b")
    assert content(table) == want
    assert before.count() == 100  # a reader goes on with what it began with
    table.write(gone=rows(spark, [200], None))
    table.write(rows(spark, [7, 3], "c"))
    del want[200]
    want |= {7: "c", 3: "c"}
    assert content(table) == want
    # the same through another reader, after a compaction of some buckets, of all, and a vacuum
    other = ChangeTable(Tables(spark, f"file://{tmp_path}/t"), "x", SCHEMA, "id")
    assert content(other) == want
    assert sorted((r.id, r.v) for r in other.rows_of(rows(spark, [3, 4, 200, 4, None], None)).collect()) == [(3, "c"), (4, "a")]
    some = other.compact(0.15)
    assert 0 < len(some) < 8 and content(other) == want
    other.compact(0.0)
    assert other.parts()["changes"] == [] and other.vacuum() > 0 and content(other) == want
    other.write(gone=other.read())
    other.compact()
    assert other.read().count() == 0 and other.parts()["base"] == {}


def test_a_small_upsert_writes_little(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    table = ChangeTable(Tables(spark, f"file://{tmp_path}/t"), "o", orders.schema, "o_orderkey", buckets=16)
    table.write(orders)
    table.compact()
    table.vacuum()
    whole, base = size(tmp_path), {b: n for b, (n, _) in table.parts()["base"].items()}
    few = orders.where(F.col("o_orderkey") % 100 == 7)
    assert table.change(few, lambda old: old.withColumn("o_orderstatus", F.lit("Z"))) == few.count() == 150
    assert size(tmp_path) - whole < 0.05 * whole
    assert table.read().where("o_orderstatus = 'Z'").count() == 150 and table.read().count() == orders.count()
    # buckets without many changes keep their files
    table.write(orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(16)) == 3))
    assert table.compact() == [3]
    assert {b for b, (n, _) in table.parts()["base"].items() if n != base[b]} == {"3"}


def test_faulty_changes_change_nothing(spark, tmp_path):
    tables = Tables(spark, f"file://{tmp_path}/t")
    table = ChangeTable(tables, "x", SCHEMA, "id", buckets=2)
    table.write(rows(spark, [1], "a"))
    with pytest.raises(Exception, match="null key"):
        table.write(rows(spark, [None], "b"))
    with pytest.raises(ValueError, match="two rows"):
        table.write(rows(spark, [2, 2], "b"))
    with pytest.raises(Exception, match="stop"):
        table.write(rows(spark, [1], "b").withColumn("v", F.raise_error(F.lit("stop"))))
    assert content(table) == {1: "a"}
    table.write(rows(spark, [1, 2], "b"))
    table.vacuum()
    assert content(table) == {1: "b", 2: "b"}
    tables.commit("plain", rows(spark, [9], "p"))  # beside it, a table of versions
    assert tables.read("plain", SCHEMA).count() == 1 and content(table) == {1: "b", 2: "b"}


def test_a_writer_that_was_taken_over_is_refused(spark, tmp_path):
    slow, fast = (Tables(spark, f"file://{tmp_path}/t", sleep=lambda s: None) for _ in range(2))
    slow.commit("x", rows(spark, [1], "a"))
    with pytest.raises(Fenced), slow.writing():
        with fast.writing(stale=-1):
            fast.commit("x", rows(spark, [2], "fast"))
        slow.commit("x", rows(spark, [3], "slow"))
    assert [r.v for r in fast.read("x", SCHEMA).collect()] == ["fast"] and fast.state() == {"x": 2}
    # while the other still holds its lease, too, with a table of changes, whose drafts a vacuum takes away
    table = ChangeTable(slow, "y", SCHEMA, "id", buckets=2)
    with slow.writing():
        with fast.writing(stale=-1), pytest.raises(Fenced):
            table.write(rows(spark, [1], "slow"))
    assert table.read().count() == 0
    ChangeTable(fast, "y", SCHEMA, "id", buckets=2).write(rows(spark, [1], "fast"))
    assert content(table) == {1: "fast"} and table.vacuum() == 1


def test_one_waiter_takes_over(spark, tmp_path):
    first, a, b = (Tables(spark, f"file://{tmp_path}/t", sleep=lambda s: None) for _ in range(3))
    first._take(600.0)  # and is never given back
    assert not a._take(600.0)
    seen = b._leases()
    b._leases = lambda: seen  # what it saw before the other one took over
    assert a._take(-1.0) and not b._take(-1.0)
    with pytest.raises(Locked), first.writing(wait=1):
        pass


def test_a_lease_is_renewed(spark, tmp_path):
    import threading
    import time

    tables = Tables(spark, f"file://{tmp_path}/t")
    tables._take(600.0)
    lease = tmp_path / "t/_lock/00000001"
    began, done = lease.stat().st_mtime, threading.Event()
    time.sleep(1.1)
    thread = threading.Thread(target=tables._renew, args=(1, done, 0.1), daemon=True)
    thread.start()
    time.sleep(1.0)
    done.set()
    thread.join()
    assert lease.stat().st_mtime > began
