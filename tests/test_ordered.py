"""As-of join, points in ranges and frames over one order, against brute force, with frequent keys, ties, nulls and no rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curatrix.operators import ordered

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize(("most", "cut_keys"), [(10**6, 10_000), (20, 10_000), (1, 5)])
def test_as_of(spark, monkeypatch, most, cut_keys):
    monkeypatch.setattr(ordered, "CUT_KEYS", cut_keys)
    rnd = random.Random(most)
    pick = lambda i: rnd.choice(["hot", "hot", "hot", "a", "b", "c", None])
    when = lambda: rnd.choice([None, *(T0 + timedelta(hours=rnd.randrange(150)) for _ in range(9))])
    left = [(i, pick(i), when()) for i in range(400)] + [(900, "only left", T0)]
    right = [(pick(i), when(), i, None if i % 7 == 0 else f"v{i}") for i in range(150)] + [("only right", T0, 1, "x")]
    got = ordered.as_of(spark.createDataFrame(left, "id long, k string, t timestamp"), spark.createDataFrame(right, "k string, t timestamp, n long, v string"), "k", "t", most)
    assert got.columns == ["id", "k", "t", "n", "v"]

    def want(k, t):
        known = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        return max(((r[1], r[2]), r[2:]) for r in known)[1] if known else (None, None)

    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [(i, k, t, *want(k, t)) for i, k, t in left]


def test_as_of_without_rows(spark):
    left, right = spark.createDataFrame([("a", T0)], "k string, t timestamp"), spark.createDataFrame([], "k string, t timestamp, v long")
    assert [tuple(r) for r in ordered.as_of(left, right, "k", "t").collect()] == [("a", T0, None)]
    assert ordered.as_of(left.limit(0), right, "k", "t").count() == 0


@pytest.mark.parametrize("bins", [1, 2, 4, 64])
def test_in_ranges(spark, bins):
    rnd = random.Random(bins)
    points = [(i, rnd.choice([None, 5, 5, 5, *range(40)])) for i in range(300)]
    ranges = [(i, rnd.choice([None, *range(-5, 45)]), rnd.choice([None, *range(-5, 60)])) for i in range(120)] + [(500, -100, 100), (501, 5, 5), (502, 5, 6), (503, 7, 3)]
    got = ordered.in_ranges(spark.createDataFrame(points, "p long, x int"), spark.createDataFrame(ranges, "r long, lo int, hi int"), "x", "lo", "hi", bins)
    found = [(r.p, r.r) for r in got.collect()]
    want = [(p, r) for p, x in points for r, lo, hi in ranges if None not in (x, lo, hi) and lo <= x < hi]
    assert sorted(found) == sorted(want) and len(want) > 5000


def test_ranges_are_copied_a_bounded_number_of_times(spark):
    """Ranges over all bins make no more rows than the logarithm of the bins, and no plan has a cross join."""
    points = spark.range(2000).select(F.col("id").alias("p"), F.col("id").alias("x"))
    ranges = spark.range(10).select(F.col("id").alias("r"), (F.col("id") - 1).alias("lo"), F.lit(10**6).cast("long").alias("hi"))
    got = ordered.in_ranges(points, ranges, "x", "lo", "hi", 256)
    assert got.count() == sum(2000 - max(r - 1, 0) for r in range(10))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    none = points.limit(0)
    assert ordered.in_ranges(none, ranges, "x", "lo", "hi").count() == 0 and ordered.in_ranges(points, ranges.limit(0), "x", "lo", "hi").count() == 0


@pytest.mark.parametrize(("bins", "ends"), [(1, 10**6), (4, 7), (64, 10**6), (256, 3)])
def test_totals_in_ranges(spark, monkeypatch, bins, ends):
    """Against brute force, with moments that are skipped in some zones, empty ranges, nulls and many ranges that end in one bin."""
    monkeypatch.setattr(ordered, "ENDS", ends)
    rnd = random.Random(bins)
    when = lambda: T0 + timedelta(minutes=rnd.randrange(200_000), microseconds=rnd.randrange(3))
    points = [(rnd.choice([None, *(when() for _ in range(9))]), rnd.choice([None, 1, 2, 5]), rnd.choice([None, 2**60 + rnd.randrange(99), rnd.randrange(99)])) for _ in range(400)]
    ranges = [(rnd.choice([None, *(when() for _ in range(9))]), rnd.choice([None, *(when() for _ in range(9))])) for _ in range(150)]
    ranges += [(T0, T0 + timedelta(days=900)), (T0, T0 + timedelta(days=900)), (T0, T0), (points[0][0] or T0, when())]
    points, ranges = spark.createDataFrame(points, "t timestamp_ntz, n long, id long"), spark.createDataFrame(ranges, "a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [tuple(r) for r in ordered.totals_in_ranges(points, ranges, "t", "a", "b", "n", "id", bins).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    points, want = points.collect(), {}
    for a, b in ranges.collect():
        held = [p for p in points if None not in (a, b, p.t) and a <= p.t < b]
        if held:
            want[a, b] = (a, b, sum(p.n or 0 for p in held), min((p.id for p in held if p.id is not None), default=None), max(p.t for p in held))
    assert len(got) == len(want) > 30 and set(got) == set(want.values())


def test_totals_of_other_kinds_and_of_nothing(spark):
    points, ranges = spark.createDataFrame([(0.5, 1, 7), (1.5, 2, 6), (2.5, 4, 9)], "x double, n long, id long"), spark.createDataFrame([(0.0, 2.0), (1.5, 9.0), (3.0, 4.0)], "lo double, hi double")
    totals = lambda p, r: sorted(map(tuple, ordered.totals_in_ranges(p, r, "x", "lo", "hi", "n", "id").collect()))
    assert totals(points, ranges) == [(0.0, 2.0, 3, 6, 1.5), (1.5, 9.0, 6, 6, 2.5)]
    assert totals(points.limit(0), ranges) == totals(points, ranges.limit(0)) == []


def test_no_pair_of_a_point_and_a_range_is_made(spark, monkeypatch):
    """3,000 points in each of 3,000 overlapping ranges: what is paired are bins."""
    pairs = []
    monkeypatch.setattr(ordered, "in_ranges", lambda *a, f=ordered.in_ranges: pairs.append(f(*a)) or pairs[-1])
    points = spark.range(3000).select(F.col("id").alias("x"), F.lit(1).cast("long").alias("n"), "id")
    ranges = spark.range(3000).select((F.col("id") - 2999).alias("lo"), (F.col("id") + 3000).alias("hi"))
    got = {r.lo: (r.n, r.id, r.x) for r in ordered.totals_in_ranges(points, ranges, "x", "lo", "hi", "n", "id", 16).collect()}
    assert got == {i - 2999: (3000, 0, 2999) for i in range(3000)} and pairs[0].count() <= 16**3


def test_frames(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.randrange(30), rnd.choice([None, *range(9)])) for i in range(500)]
    placed = sorted(rows, key=lambda r: (r[1], r[0]))
    whole = ordered.TotalOrder(spark.createDataFrame(rows, "id long, t int, v long").repartition(5), "t", "id", block=37)
    at = {r[0]: i for i, r in enumerate(placed)}
    value = lambda i: placed[i][2] if 0 <= i < len(placed) else None
    total = lambda a, b: sum(x) if (x := [value(i) for i in range(a, b) if value(i) is not None]) else None
    for before, after in ((5, 0), (0, 3), (40, 80), (0, 0)):
        got = {r.id: r.s for r in whole.rolling(before, after, s=F.sum("v")).collect()}
        assert got == {i: total(at[i] - before, at[i] + after + 1) for i in at}
    for places in (1, 7, 50, -1, -45):
        assert {r.id: r.x for r in whole.lagged(places, x="v").collect()} == {i: value(at[i] - places) for i in at}
    assert {r.id: r.s for r in whole.running(s="v").collect()} == {i: total(0, at[i] + 1) or 0 for i in at}
    ranks = {r.id: r for r in whole.ranks("t", tiles=7).collect()}
    first = {t: min(i for i, r in enumerate(placed) if r[1] == t) for _, t, _ in rows}
    assert all((r.row_number, r.rank, r.percent_rank) == (at[i] + 1, first[r.t] + 1, first[r.t] / 499) for i, r in ranks.items())
    assert [sum(r.ntile == t for r in ranks.values()) for t in range(1, 8)] == [72, 72, 72, 71, 71, 71, 71]
    with pytest.raises(ValueError):
        whole.ranks("id")


def test_frames_without_rows(spark):
    whole = ordered.TotalOrder(spark.createDataFrame([], "id long, v long"), "id")
    assert whole.rolling(3, s=F.sum("v")).count() == whole.lagged(1, x="v").count() == whole.running(s="v").count() == whole.ranks("id").count() == 0


def test_parts_are_the_same_files(spark, tmp_path):
    from curatrix.sources import files

    folder = files.Folder(spark, f"file://{tmp_path}")
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"), F.format_string("a,\"%d\"", "id").alias("s"))
    for kind in ("parquet", "csv"):
        assert files.write_parts(rows.repartition(2), folder, "a", "k", "id", kind=kind, rows=300) == files.write_parts(rows.repartition(9), folder, "b", "k", "id", kind=kind, rows=300) == 4
        assert files.checksum(spark, f"{folder.path}/a") == files.checksum(spark, f"{folder.path}/b")
        assert folder.names("a") == [f"part-0000{i}.{kind}" for i in range(4)]
    files.join_parts(folder, "a", "all.csv", "id,k,s\n")
    got = [(int(r.id), int(r.k), r.s) for r in files.read_csv(spark, f"{folder.path}/all.csv").collect()]
    assert got == sorted(((i, i % 7, f'a,"{i}"') for i in range(1000)), key=lambda r: (r[1], r[0]))
    assert files.write_parts(rows.limit(0), folder, "none", "id") == 1 and spark.read.schema(rows.schema).parquet(f"{folder.path}/none").count() == 0
    import hashlib

    text = (tmp_path / "all.csv").read_bytes()
    assert files.checksum(spark, f"{folder.path}/all.csv") == hashlib.sha256(text).hexdigest()
    streamed = next(files._streamed(iter([__import__("pandas").DataFrame({"path": [f"file://{tmp_path}/all.csv"], "bytes": [len(text)]})])))
    assert streamed["sha256"].tolist() == [hashlib.sha256(text).hexdigest()]


def test_parts_are_the_same_bytes_whichever_jvm_wrote_them(spark, tmp_path, monkeypatch):
    """Executors list the encodings of a column in orders of their own; parts and single files have them in one, and nothing else is changed."""
    import pyarrow as pa
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    from curatrix.sources import files

    codes = {"PLAIN": 0, "PLAIN_DICTIONARY": 2, "RLE": 3, "BIT_PACKED": 4, "RLE_DICTIONARY": 8}

    def listed(path):
        m = pq.ParquetFile(path).metadata
        return [[codes[e] for e in m.row_group(g).column(i).encodings] for g in range(m.num_row_groups) for i in range(m.num_columns)]

    def as_another_jvm(path):
        """The file with each list of encodings reversed."""
        held = path.read_bytes()
        at = len(held) - 8 - int.from_bytes(held[-8:-4], "little")
        with monkeypatch.context() as m:
            m.setattr(files, "sorted", lambda x: list(x)[::-1], raising=False)
            return held[:at] + files.steady_footer(held[at:-8]) + held[-8:]

    folder = files.Folder(spark, f"file://{tmp_path}")
    # columns of many kinds, above 14 of them, so that the footer has long lists too
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.array("id", F.lit(None)).alias("a"), F.create_map(F.lit("x"), F.lit(True)).alias("m"), F.lit(1.5).alias("d"), F.current_timestamp().alias("t"), *(F.col("id").alias(f"c{i}") for i in range(12)))
    files.write_parts(rows, folder, "p", "k", "id", rows=300)
    files.write_sorted(rows, folder, "one.parquet", "k", "id")
    for path in (*sorted((tmp_path / "p").glob("*.parquet")), tmp_path / "one.parquet"):
        found, other = listed(path), as_another_jvm(path)
        assert len(found) > 18 and all(e == sorted(e) for e in found) and max(map(len, found)) > 1
        for k, move in enumerate((lambda a, b: files._move_steady(fs.LocalFileSystem(), f"{tmp_path}/{a}", f"{tmp_path}/{b}"), lambda a, b: files._rename_steady(folder, a, b))):
            (tmp_path / "turned.parquet").write_bytes(other)
            assert listed(tmp_path / "turned.parquet") != found and pa.table(pq.read_table(tmp_path / "turned.parquet")).num_rows
            move("turned.parquet", f"to{k}-{path.name}")
            assert (tmp_path / f"to{k}-{path.name}").read_bytes() == path.read_bytes() and not (tmp_path / "turned.parquet").exists()


def test_sketches_merge_to_the_whole(spark):
    from curatrix.operators import sketches

    rows = spark.range(20_000).select(F.col("id"), (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 10_000).alias("n"), F.when(F.col("id") % 10 == 0, "often").otherwise(F.concat(F.lit("v"), (F.col("id") % 500).cast("string"))).alias("v"))
    rows = rows.unionByName(rows.limit(5).select(F.lit(None).cast("long").alias("id"), "k", F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("v")))
    parts = [sketches.sketched(rows.where(F.pmod(F.coalesce("id", F.lit(0)), F.lit(4)) == p), [("k",), ()], "id", "n", "v") for p in range(4)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = {r.k: r for r in sketches.estimates(sketches.merged(stored, "k", "grouped")).collect()}
    assert set(got) == {None, 0, 1, 2} and got[None].rows == 20_005 and got[0].rows + got[1].rows + got[2].rows == 20_005
    assert abs(got[None]["distinct"] - 20_000) < 0.07 * 20_000
    assert all(abs(q - w) < 200 for q, w in zip(got[None]["quantiles"], (1000, 5000, 9000), strict=True))
    assert got[None]["top"][0]["item"] == "often" and abs(got[None]["top"][0]["count"] - 2000) <= 20_005 / (0.75 * sketches.COUNTERS)
