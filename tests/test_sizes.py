"""What small tables don't show: files that are read in several tasks, and work that must not wait for the driver."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators import similarity
from curatrix.plans import dataset
from curatrix.scratch import Scratch
from curatrix.sources import files


def _split(spark):
    """Files are read in pieces of a few kilobytes, as large ones are."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


def _whole(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_places_of_a_file_and_of_parts_that_several_tasks_read(spark):
    folder = files.Folder(spark, Scratch(spark, "places").path)
    # the later parts are the larger files, and larger files are read first
    rows = spark.range(5000).select(F.col("id").alias("k"), F.repeat(F.md5(F.col("id").cast("string")), (F.col("id") / 1000).cast("int") + 1).alias("v"))
    files.write_sorted(rows, folder, "one.parquet", "k")
    files.write_parts(rows, folder, "parts", "k", rows=1000)
    _split(spark)
    try:
        for name in ("one.parquet", "parts"):
            found = files.read_parts(spark, f"{folder.path}/{name}")
            assert found.rdd.getNumPartitions() > 1
            assert found.where("k <> place").isEmpty() and found.count() == 5000
    finally:
        _whole(spark)


def test_parts_are_moved_by_tasks(spark, monkeypatch):
    folder = files.Folder(spark, Scratch(spark, "moved").path)
    asked = []
    monkeypatch.setattr(files.Folder, "names", lambda self, name="", f=files.Folder.names: asked.append(name) or f(self, name))
    assert files.write_parts(spark.range(400), folder, "many", "id", rows=10) == 40
    assert len(asked) < 5  # not once for each part
    assert folder.names("many") == [f"part-{i:05d}.parquet" for i in range(40)]


def test_copies_are_pruned_by_tasks(spark, monkeypatch):
    published = f"{Scratch(spark, 'prune').path}/published"
    spark.range(3).select(F.col("id").cast("string").alias("photo_id")).write.parquet(f"{published}-staged/kept.parquet")
    dataset.publish(spark, f"{published}-staged", published)
    for i in range(6):
        files.store_file(f"{published}/images", f"{i}.jpg", [b"x"], check=None)
    deleted = []
    monkeypatch.setattr(files.Folder, "delete", lambda self, name="": deleted.append(name))
    found = files.images(spark, f"{published}/images")
    assert dataset.prune_images(spark, published, found) == 3 and not deleted
    assert sorted(r.photo_id for r in files.images(spark, f"{published}/images").collect()) == ["0", "1", "2"]
    assert files.delete_files(spark.createDataFrame([("9.jpg",)], "image_file string"), "image_file", f"{published}/images") == 1


def test_entities_without_semicolon(spark):
    rows = spark.createDataFrame([("a &amp{b} &amp; &copy &copy; &#39 &#39; &#x41; &nbsp",)], "t string")
    said = rows.select(T.clean_caption(F.col("t"), closed=True), T.clean_caption(F.col("t"))).first()
    assert tuple(said) == ("a &amp{b} & &copy © &#39 ' A &nbsp", "a &{b} & © © ' ' A")


def test_images_are_listed_by_a_task_and_as_they_were(spark):
    folder = f"{Scratch(spark, 'listed').path}/images"
    assert files.images(spark, folder).isEmpty()
    for i in range(60):
        files.store_file(folder, f"{i}.jpg", [b"x" * i], check=None)
    files.store_file(folder, "note.txt", [b""], check=None)
    found = files.images(spark, folder)
    assert found.rdd.getNumPartitions() <= 4  # not one for every few images
    files.store_file(folder, "later.jpg", [b"x"], check=None)
    assert sorted((r.image_file, r.photo_id, r.length) for r in found.collect()) == sorted((f"{i}.jpg", str(i), i) for i in range(60))


def test_events_of_one_moment_meet_a_span_once(spark, tmp_path, monkeypatch):
    from curatrix.operators import ordered
    from curatrix.plans import operations

    at = F.timestamp_seconds(1_700_000_000 + F.col("id") % 5 * 3600).cast("timestamp_ntz")
    rows = spark.range(500).select(F.col("id").alias("event_id"), at.alias("ts"), F.when(F.col("id") % 2 == 0, "purchase").otherwise("view").alias("event_type"))
    rows.write.parquet(f"file://{tmp_path}/events.parquet")
    met = []
    monkeypatch.setattr(ordered, "in_ranges", lambda *a, f=ordered.in_ranges: met.append(f(*a)) or met[-1])
    got = {r.span: (r.n, r.first) for r in operations.events_within(spark, f"file://{tmp_path}").collect()}
    assert met[0].count() <= 5 * 6  # moments and spans, not 500 events and 252 spans
    assert len(got) == 252 and got[0] == (200, 0) and got[8] == (200, 3) and got[14] == (100, 4) and got[-2] == (400, 0)


def test_pairs_of_near_copies_are_told_in_parts_and_their_vectors_travel_once(spark, monkeypatch):
    """As many pairs as there are in a group of near copies are never in one table, and don't each bring two vectors along."""
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(similarity, "PAIRS", 1000)
    monkeypatch.setattr(similarity, "CELLS", 5000)
    x = np.repeat(np.random.default_rng(3).normal(size=(2, 16)), 60, axis=0) + 0.01 * np.random.default_rng(4).normal(size=(120, 16))
    one = pd.DataFrame({"id": np.arange(120).astype(object), "vector": list(x)})
    sketched = next(similarity._sketched(iter([one]), np.ones((1, 16)))).assign(lo=0, hi=0, side=0)
    parts = list(similarity._open_pairs(sketched, 0.95, False))
    assert len(parts) > 3 and max(map(len, parts)) <= 2000 and sum(map(len, parts)) == 60 * 59
    assert len({int(p["part"].iloc[0]) for p in parts}) == len(parts)
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    found = {(r.a, r.b) for r in similarity.cosine_pairs(v, "id", "v", 0.95, block=50).collect()}
    assert found == {(i, j) for i in range(120) for j in range(i + 1, 120) if i // 60 == j // 60}
    held = []
    monkeypatch.setattr(similarity, "_unit", lambda vectors, dims, f=similarity._unit: held.append(len(vectors)) or f(vectors, dims))
    pairs = pd.concat(parts)
    assert len(similarity._exact(pairs, one, 0.95)) == 60 * 59 and held == [120]  # not two vectors a pair


def test_pairs_of_keys_that_come_more_than_once(spark):
    """A table with rows that come again, with the same vector and with others: the pairs of a join, as often as it has them."""
    from collections import Counter

    import numpy as np

    x = np.random.default_rng(6).normal(size=(60, 8))
    rows = [(str(i % 40), x[i].tolist()) for i in range(60)] + [(str(i), x[i].tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, v array<double>")
    cosine = lambda u, w: np.dot(u, w) / np.linalg.norm(u) / np.linalg.norm(w)
    want = Counter((a, b) for a, u in rows for b, w in rows if a < b and cosine(u, w) >= 0.5)
    got = Counter((r.a, r.b) for r in similarity.cosine_pairs(df, "id", "v", 0.5, block=20).collect())
    assert got == want and max(want.values()) > 1


def test_a_part_of_the_components_rules_most_pairs_out_and_loses_none(monkeypatch):
    """Unrelated vectors are told apart by three of eight of their components; where that leaves much, all are looked at. The open pairs are the same."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 64))
    x[300:330] = x[:30] + 0.2 * rng.normal(size=(30, 64))
    x[330:340, :24], x[330:340, 24:] = 5 * x[:10, :24], -0.1 * x[:10, 24:]  # alike in the part
    one = pd.DataFrame({"id": np.arange(600).astype(object), "vector": list(x)})
    sketched = next(similarity._sketched(iter([one]), np.ones((1, 64)))).assign(lo=0, hi=0, side=0)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    shapes = []
    monkeypatch.setattr(np, "matmul", lambda a, b, out, f=np.matmul: shapes.append(a.shape[1]) or f(a, b, out=out))
    for threshold, width in ((0.95, 25), (0.9, 25), (0.2, 64)):
        shapes.clear()
        pairs = pd.concat(similarity._open_pairs(sketched, threshold, False))
        found = set(zip(pairs["a"], pairs["b"], strict=True))
        want, near = ({(i, j) for i, j in zip(*np.nonzero(u @ u.T >= least), strict=True) if i < j} for least in (threshold, threshold - 0.06))
        assert want <= found <= near and set(shapes) == {width}


def test_a_manifest_tells_classes_without_rows_as_the_sql_does(spark, monkeypatch):
    from curatrix.plans import operations

    told = {"rows": {"kept": 3, "rejected": 0}, "photos": 4, "pending": 1, "rejected_by": {}, "labels": 3, "sha256": dict.fromkeys("abcd", "0")}
    monkeypatch.setattr(dataset, "build", lambda spark, out, *a, **k: files.write_json(files.Folder(spark, out), dataset.MANIFEST, told) or told)
    got = dict(map(tuple, operations.manifest_file(spark, "/root/testdata/sf0.001").collect()))
    assert got["rejected by model"] == 0 and got["rejected by rule"] == 0 and got["same bytes"] == 4


def test_a_build_has_the_same_bytes_whichever_jvm_wrote_them(spark):
    """The Parquet files of a build list the encodings of their columns in one order, so that the manifest's checksums are those of the rows."""
    from pathlib import Path

    from curatrix.plans import fixtures as X
    from curatrix.plans import operations

    d, out = "/root/testdata/sf0.001", f"{Scratch(spark, 'steady').path}/out"
    told = dataset.build(spark, out, X.photos(spark, d), operations._label_table(spark, d), X.embeddings(spark, d), since=X.CUTOFF)
    found = [p.read_bytes() for p in Path(out.removeprefix("file:")).glob("*.parquet/part-*.parquet")]
    assert len(found) == 2 and len(told["sha256"]) == 4
    for held in found:
        footer = held[len(held) - 8 - int.from_bytes(held[-8:-4], "little") : -8]
        assert files.steady_footer(footer) == footer


def test_small_waves_share_a_job_and_end_where_they_did(spark, monkeypatch):
    """260 calls in waves of 5, 5 and 10 at most, of which all fail from the 100th on: as many calls and records as wave by wave, in one append."""
    import pytest

    from curatrix.operators.state import Tables
    from curatrix.plans import workflows
    from curatrix.schemas import LABELS, PHOTOS
    from curatrix.sources import logs

    def labeller(prompt):
        if prompt.removeprefix("TITLE: ")[:3] >= "100":
            raise OSError("busy")
        return {"gate_category": "x"}

    made = {"photo_id": F.format_string("%03d", "id"), "title": F.format_string("%03d", "id"), "image_file": F.lit("x.jpg")}
    photos = spark.range(260).select(*(made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PHOTOS.fields))
    tables, log = Tables(spark, f"{Scratch(spark, 'waves').path}/tables"), f"{Scratch(spark, 'waves').path}/log"
    tables.commit_all({"photos": photos, "labels": spark.createDataFrame([], LABELS)})
    appended = []
    monkeypatch.setattr(logs, "append", lambda records, folder, f=logs.append: appended.append(folder) or f(records, folder))
    with pytest.raises(workflows.LabelRunError) as told:
        workflows.label(tables, log, labeller, "m", "fake", 1000, wave=10)
    assert (told.value.made, told.value.failed) == (200, 100) and len(appended) == 1
    assert sorted(r.photo_id for r in logs.read_log(spark, log).collect()) == [f"{i:03d}" for i in range(100)]


def test_tables_of_few_bytes_and_many_rows_are_not_broadcast(spark):
    """100,000 labels take a few hundred kilobytes as a file, which would be broadcast, and thirty megabytes or more in the driver."""
    from curatrix.operators import planning, quality
    from curatrix.schemas import LABELS, PHOTOS

    at = Scratch(spark, "few-bytes")
    made = {"photo_id": F.col("id").cast("string"), "gate_category": F.lit("astronomical_observation"), "image_file": F.concat(F.col("id").cast("string"), F.lit(".jpg"))}
    photos, labels = (at.keep(spark.range(100_000).select(*(made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields)), name) for name, kind in (("photos", PHOTOS), ("labels", LABELS)))
    found = [dataset.accounting(photos, labels), dataset.rejected(labels.limit(0).selectExpr("*", "cast(null as string) title", "cast(null as timestamp_ntz) date_taken", "'' page_url", "'' source_tag_label"), photos, labels)]
    found += [planning.images_to_write(photos, photos), quality.frame(quality.label_checks(), {"photos": photos, "labels": labels})]
    for df in found:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert dataset.accounting(photos, labels).first().kept == 100_000


def test_no_task_takes_a_large_file_as_one_value(spark, tmp_path, monkeypatch):
    import hashlib

    (tmp_path / "large.csv").write_bytes(b"0123456789" * 1_000_000)
    (tmp_path / "small.csv").write_bytes(b"0")
    found = {r.file: (r.bytes, r.sha256) for r in files.checksums(spark, tmp_path.as_uri()).collect()}
    assert found == {n: ((tmp_path / n).stat().st_size, hashlib.sha256((tmp_path / n).read_bytes()).hexdigest()) for n in ("large.csv", "small.csv")}

    def told(frames):
        for frame in frames:
            yield frame.assign(sha256="in blocks")

    monkeypatch.setattr(files, "_streamed", told)
    assert [r.file for r in files.checksums(spark, tmp_path.as_uri()).collect() if r.sha256 == "in blocks"] == ["large.csv"]
