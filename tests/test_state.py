import json
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curatrix.operators.graph import components
from curatrix.operators.grouping import batches, latest, stratified
from curatrix.operators import planning, quality, similarity, state
from curatrix.operators.similarity import cosine_pairs, duplicate_groups
from curatrix.operators.state import Locked, Tables, migrate
from curatrix.plans import dataset, workflows
from curatrix.schemas import EMBEDDING_ERRORS, EMBEDDINGS, LABELS, PHOTOS
from curatrix.sources import api, files, legacy, logs, npz

T0, NOW = datetime(2022, 1, 1), datetime(2026, 1, 1)


def photo(photo_id, title="T", description="d", **more):
    row = dict.fromkeys(PHOTOS.names) | {"photo_id": photo_id, "title": title, "description": description, "tags": ["a", "b"], "date_taken": datetime(2023, 1, 1), "first_seen_at": T0, "image_file": f"{photo_id}.jpg", "image_bytes": 10, "download_attempts": 1}
    return row | more


def label(photo_id, **more):
    row = dict.fromkeys(LABELS.names) | {"photo_id": photo_id, "gate_category": "astronomical_observation", "subject": "nebula", "modality": "image", "instrument": "NIRCam", "confidence": "high", "rationale": "r", "model": "m", "codebook_version": "v6", "vision": True}
    return row | more


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


def small(spark):
    photos = frame(spark, [photo("10", "Cliffs (A)", "NGC 3132 here"), photo("11", "Cliffs (B)", image_bytes=5), photo("20", "Other"), photo("30", "Lab"), photo("40", date_taken=datetime(2017, 1, 1)), photo("50")], PHOTOS)
    labels = frame(spark, [label("10", object_name="NGC 3132"), label("11"), label("20", object_name="M 51"), label("30", gate_category="hardware_engineering", subject="not_applicable", modality="not_applicable")], LABELS)
    vectors = spark.createDataFrame([("10", "m", [1.0, 0.0], T0), ("11", "m", [1.0, 0.0], T0), ("20", "m", [0.0, 1.0], T0)], EMBEDDINGS)
    return photos, labels, vectors


def test_build_audit_publish(spark, tmp_path):
    photos, labels, vectors = small(spark)
    staged, live = f"file://{tmp_path}/staged", f"file://{tmp_path}/live"
    manifest = dataset.build(spark, staged, photos, labels, vectors)
    assert manifest["rows"] == {"kept": 3, "rejected": 2} and manifest["pending"] == 1 and manifest["rejected_by"] == {"model": 1, "rule": 1}
    rows = {r.photo_id: r for r in spark.read.parquet(f"{staged}/kept.parquet").collect()}
    assert rows["10"].is_primary and not rows["11"].is_primary and rows["10"].release_group == "cliffs"
    assert rows["10"].object_name_verified and not rows["20"].object_name_verified and rows["11"].object_name_verified
    assert rows["10"].near_duplicate_group == rows["11"].near_duplicate_group == 0 and rows["20"].near_duplicate_group == 1
    assert dataset.build(spark, f"file://{tmp_path}/again", photos, labels, vectors) == manifest  # the same bytes
    dataset.audit(spark, staged, live)
    first = dataset.publish(spark, staged, live)
    assert dataset.published_folder(spark, live) == first and files.read_json(files.Folder(spark, first), "manifest.json") == manifest and not (tmp_path / "staged").exists()
    dataset.build(spark, staged, photos, labels.where("photo_id <> '20'"), vectors)
    with pytest.raises(quality.DataQualityError, match="fewer than published"):
        dataset.audit(spark, staged, live)
    dataset.audit(spark, staged, live, allow_shrink=True)
    leak = spark.read.parquet(f"{staged}/rejected.parquet").unionByName(spark.read.parquet(f"{staged}/kept.parquet").limit(1), allowMissingColumns=True).select("photo_id", "title", "rejected_as", "rejected_by", "rationale", "date_taken", "page_url", "source_tag_label").checkpoint()
    files.write_sorted(leak, files.Folder(spark, staged), "rejected.parquet", "photo_id")
    with pytest.raises(quality.DataQualityError, match="kept and rejected"):
        dataset.audit(spark, staged, live, allow_shrink=True)


def test_readers_see_one_whole_version(spark, tmp_path):
    photos, labels, vectors = small(spark)
    staged, live = f"file://{tmp_path}/staged", f"file://{tmp_path}/live"
    assert dataset.published_folder(spark, live) is None
    for n in (1, 2, 3):
        dataset.build(spark, staged, photos, labels, vectors)
        assert dataset.publish(spark, staged, live).endswith(f"/v{n:06d}")
    assert sorted(x.name for x in (tmp_path / "live").iterdir()) == ["v000002", "v000003"]
    (tmp_path / "live/v000003/_PUBLISHED").unlink()  # a publication that ended before its mark
    assert dataset.published_folder(spark, live).endswith("/v000002")
    dataset.build(spark, staged, photos, labels, vectors)
    assert dataset.publish(spark, staged, live).endswith("/v000004")
    assert sorted(x.name for x in (tmp_path / "live").iterdir()) == ["v000002", "v000004"]


def test_gallery_review_and_prune(spark, tmp_path):
    photos, labels, vectors = small(spark)
    rows = dataset.kept(dataset.labelled(spark, photos, labels, vectors))
    assert [r.photo_id for r in dataset.gallery(rows, ["20", "10"]).collect()] == ["20", "10"]
    with pytest.raises(LookupError, match="99"):
        dataset.gallery(rows, ["99"])
    assert dataset.review_rows(rows).where("html like '<tr><td>10</td>%'").count() == 1
    (tmp_path / "images").mkdir()
    for name in ("10.jpg", "77.jpg"):
        (tmp_path / "images" / name).write_bytes(b"x")
    rows.write.parquet(f"{tmp_path}/v000001/kept.parquet")
    (tmp_path / "v000001" / "_PUBLISHED").touch()
    assert dataset.prune_images(spark, f"file://{tmp_path}", files.images(spark, f"file://{tmp_path}/images")) == 1
    assert (tmp_path / "images/10.jpg").exists() and not (tmp_path / "images/77.jpg").exists()
    sheet = dataset.review_sheet(spark, f"file://{tmp_path}/v000001", 2)
    assert (tmp_path / "v000001/review.html").read_text().count("<tr>") == 2 and sheet.endswith("review.html")
    assert dataset.review_sheet(spark, f"file://{tmp_path}/v000001", 0) is None
    with pytest.raises(ValueError, match="1000"):
        dataset.review_sheet(spark, f"file://{tmp_path}/v000001", 1001)


def test_image_copies(spark, tmp_path):
    rows = spark.createDataFrame([("1", "1.jpg"), ("2", None), ("3", "3.jpg"), ("4", "4.jpg")], "photo_id string, image_file string")
    present = spark.createDataFrame([("4.jpg",), ("9.jpg",)], "image_file string")

    def copy(photo_id, image_file):
        if photo_id == "3":
            raise OSError("broken")

    states = dataset.write_images(rows, present, copy)
    assert {r.photo_id: (r.state, r.error) for r in states.collect()} == {"1": ("written", None), "2": ("failed", None), "3": ("failed", "OSError: broken"), "4": ("present", None)}
    assert tuple(dataset.image_tally(states).first()) == (1, 1, 2)


def test_verified_files(tmp_path):
    folder, whole = f"file://{tmp_path}/in", b"\xff\xd8" + b"x" * 10 + b"\xff\xd9"
    assert files.store_file(folder, "a.jpg", [whole[:5], whole[5:]], len(whole)) == len(whole) and (tmp_path / "in/a.jpg").read_bytes() == whole
    with pytest.raises(files.ImageError, match="13 of 14 bytes"):
        files.store_file(folder, "b.jpg", [whole[:-1]], len(whole))
    with pytest.raises(files.ImageError, match="not a whole JPEG"):
        files.store_file(folder, "b.jpg", [whole[:-1]])

    def cut():
        yield whole[:4]
        raise OSError("gone")

    with pytest.raises(OSError):
        files.store_file(folder, "c.jpg", cut())
    assert [x.name for x in (tmp_path / "in").iterdir()] == ["a.jpg"]


def test_npz_batches(spark, tmp_path):
    folder = f"file://{tmp_path}/staged"
    npz.save_batch(folder, "b1.npz", ["1", "2"], [[1.0, 2.0], [3.0, 4.0]], {"3": "bad"})
    npz.save_batch(folder, "b2.npz", [], [], {"4": "worse"})
    npz.save_batch(folder, "b3.npz", ["5"], [[0.5, 0.25]], {})
    got = {r.photo_id: (r.file, r.vector, r.error) for r in npz.read_batches(spark, folder).collect()}
    assert got == {"1": ("b1.npz", [1.0, 2.0], None), "2": ("b1.npz", [3.0, 4.0], None), "3": ("b1.npz", None, "bad"), "4": ("b2.npz", None, "worse"), "5": ("b3.npz", [0.5, 0.25], None)}
    tables = Tables(spark, f"file://{tmp_path}/t")
    staged = npz.read_batches(spark, folder).withColumn("pos", F.lit(0))
    assert workflows.store(tables, staged, "m", NOW) == (3, 2)
    assert workflows.store(tables, staged.unionByName(staged), "m", NOW) == (6, 4)  # rows as staged
    assert tables.read("embeddings", EMBEDDINGS).count() == 3 and tables.read("embedding_errors", EMBEDDING_ERRORS).count() == 2


def test_legacy_load(spark, tmp_path):
    rows = [("1", "a", "d", ["t"], T0, T0, "/x/1.jpg", "nebula", [1.0, 2.0]), ("2", "b", "d", ["t"], T0, T0, "/x/2.jpg", None, None), ("3", "c", "d", ["t"], T0, T0, "/x/3.jpg", None, None)]
    schema = "photo_id string, title string, description string, tags array<string>, date_taken timestamp_ntz, date_ingested timestamp_ntz, image_path string, canonical_label string, embedding array<double>"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/old/photos.parquet")
    tables, source = Tables(spark, f"file://{tmp_path}/t"), legacy.attach(spark, f"{tmp_path}/old")
    stored = spark.createDataFrame([("1.jpg", 5), ("2.jpg", 6)], "image_file string, length long")
    broken = spark.createDataFrame([("2", "cut off"), ("1", "has a vector, so it decoded")], "photo_id string, error string")
    assert legacy.load(tables, source, stored, "m", NOW, broken, dim=2) == {"photos": 3, "usable": 1, "tagged": 1, "anew": 2, "embeddings": 1}
    got = {r.photo_id: (r.image_file, r.image_bytes, r.download_attempts, r.last_download_error) for r in tables.read("photos", PHOTOS).collect()}
    assert got == {"1": ("1.jpg", 5, 1, None), "2": (None, None, 1, "file of the earlier archive is broken: cut off"), "3": (None, None, 1, "no file in the earlier archive")}
    with pytest.raises(ValueError, match="already"):
        legacy.load(tables, source, stored, "m", NOW, dim=2)


def test_log_semantics(spark, tmp_path):
    path = tmp_path / "log.jsonl"

    def write(*lines):
        path.write_text("\n".join(lines))
        return logs.read_log(spark, f"file://{path}")

    good = [json.dumps(label("1", title="t", subject=s)) for s in ("nebula", "star")]
    assert logs.project(write(*good, '{"photo_id": "2", "ga')).collect()[0].subject == "star"
    assert write(*good, "", "").count() == 2
    with pytest.raises(logs.LabelLogError, match="line 1"):
        write('{"broken', *good)
    with pytest.raises(logs.LabelLogError, match="line 2"):
        write(good[0], '{"broken', "", "")
    long = [json.dumps(label(str(i % 7), title=str(i), rationale="x" * 500)) for i in range(2000)]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")  # many blocks of one file
    try:
        last = {r.photo_id: r.title for r in latest(write(*long), "photo_id", "position").collect()}
        with pytest.raises(logs.LabelLogError, match="line 1501 "):
            write(*long[:1500], "{", *long)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert last == {str(i % 7): str(i) for i in range(2000)}
    old = json.dumps(label("1", subject="unheard of"))
    assert logs.project(write(old, good[0])).count() == 1  # only the latest record is held to the vocabulary
    with pytest.raises(logs.LabelLogError, match="subject='unheard of'"):
        logs.project(write(good[0], old))
    assert logs.read_log(spark, f"file://{tmp_path}/none").count() == 0
    kept_idle = frame(spark, [label("1", subject="not_applicable"), label("", confidence="sure")], LABELS).select(logs.problems().alias("p")).collect()
    assert [r.p for r in kept_idle] == [["kept with not_applicable"], ["confidence='sure'", "no photo_id"]]


def test_appends_are_read_in_their_order(spark, tmp_path):
    log = f"file://{tmp_path}/log"
    schema = StructType([*LABELS.fields, StructField("title", StringType())])
    for k in range(12):
        rows = [label("1", subject="star" if k % 2 else "galaxy", title=f"{k}-{j}") for j in range(3)]
        logs.append(frame(spark, rows, schema).coalesce(1), log)
    assert logs.read_log(spark, log).count() == 36
    assert latest(logs.read_log(spark, log), "photo_id", "position").first().title == "11-2"
    assert logs.project(logs.read_log(spark, log)).first().subject == "star"
    (tmp_path / "log/b00000099").mkdir()  # an append that wasn't finished
    (tmp_path / "log/b00000099/part-0.json").write_text(json.dumps(label("1", subject="nebula")))
    assert logs.read_log(spark, log).count() == 36
    logs.append(frame(spark, [label("2", title="t")], schema), log)
    assert logs.read_log(spark, log).count() == 37 and (tmp_path / "log/b00000100").exists()


def test_planning(spark):
    rows = [photo("1"), photo("2"), photo("3", date_taken=datetime(2020, 1, 1)), photo("4", image_file=None), photo("5", date_taken=datetime(2124, 1, 1)), photo("6", date_taken=None), photo("7", date_taken=datetime(2021, 12, 25)), photo("8", image_file=None, download_attempts=3)]
    photos = frame(spark, rows, PHOTOS)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "photo_id string")
    assert [r.photo_id for r in planning.label_queue(photos, ids("1"), ids("2"), 10).collect()] == ["5", "6", "7"]
    assert planning.label_queue(photos, ids(), ids(), 0).count() == 0
    assert [r.photo_id for r in planning.pending_downloads(photos).collect()] == ["4"]
    assert planning.pending_embeddings(photos, ids("1"), ids("2"), 0).count() == 4
    assert planning.pending_embeddings(photos, ids("1"), ids("2"), 1).count() == 1
    assert planning.failing(5, 3) and not planning.failing(4, 4) and not planning.failing(10, 4)
    assert planning.orphan_files(ids("1", "98", "99"), photos, ids("98")).collect()[0].photo_id == "99"


def test_state_changes(spark):
    photos = frame(spark, [photo("1", download_attempts=0, image_file=None, image_bytes=None), photo("2", image_file=None, image_bytes=None)], PHOTOS)
    new = spark.createDataFrame([("1", "a", "d", ["t"], None, 0), ("1", "b", "d", ["t"], None, 1), ("3", "c", "d", [], None, 2)], "photo_id string, title string, description string, tags array<string>, date_taken timestamp_ntz, pos int")
    up = {r.photo_id: r for r in state.upsert_photos(photos, new, NOW).collect()}
    assert up["1"].title == "b" and up["1"].first_seen_at == T0 and up["1"].last_seen_at == NOW and up["3"].first_seen_at == NOW and up["2"].last_seen_at is None
    results = spark.createDataFrame([("1", "1.jpg", 5, None, 0), ("2", None, None, "e" * 600, 0), ("2", None, None, "f" * 600, 1)], "photo_id string, image_file string, image_bytes long, error string, pos int")
    done = {r.photo_id: r for r in state.record_downloads(photos, results, NOW).collect()}
    assert (done["1"].image_file, done["1"].download_attempts, done["1"].last_download_error) == ("1.jpg", 1, None)
    assert (done["2"].image_file, done["2"].download_attempts, done["2"].last_download_error) == (None, 3, "f" * 500)
    errors = spark.createDataFrame([("1", "x", T0), ("2", "y", T0)], EMBEDDING_ERRORS)
    assert [r.photo_id for r in state.clear_errors(errors, results).collect()] == ["2"]
    seen = state.touch_seen(photos, spark.createDataFrame([("2",), ("2",)], "photo_id string"), NOW)
    assert seen.count() == 2 and seen.where("last_seen_at is not null").count() == 1


def test_tables_and_migrations(spark, tmp_path):
    tables = Tables(spark, f"file://{tmp_path}/tables")
    assert tables.read("photos", PHOTOS).count() == 0
    tables.commit("photos", frame(spark, [photo("1")], PHOTOS))
    broken = tables.read("photos", PHOTOS).withColumn("image_bytes", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        tables.commit("photos", broken)
    assert tables.read("photos", PHOTOS).count() == 1
    tables.commit("photos", tables.read("photos", PHOTOS).limit(0))
    assert tables.versions("photos")[-1] == 2 and tables.vacuum("photos", 1) == 1
    # a commit of several tables counts as one
    broken = broken.withColumn("image_bytes", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        tables.commit_all({"labels": frame(spark, [label("1")], LABELS), "photos": frame(spark, [photo("1")], PHOTOS).withColumn("image_bytes", F.raise_error(F.lit("stop")).cast("long"))})
    assert tables.read("labels", LABELS).count() == 0 and tables.state() == {"photos": 2}
    # writers take turns
    waits = []
    other = Tables(spark, tables.root, sleep=waits.append)
    with tables.writing(), pytest.raises(Locked), other.writing(wait=5):
        pass
    assert waits == [0.5, 1.0, 2.0, 4.0]
    with tables.writing():
        with other.writing(stale=-1):  # left behind by a writer that was lost
            pass
    assert other.change("photos", PHOTOS, lambda df: df.unionByName(frame(spark, [photo("9")], PHOTOS))) == 3
    assert tables.read("photos", PHOTOS).count() == 1 and tables.read("photos", PHOTOS, 2).count() == 0
    ran = []
    steps = [(1, "one", lambda t: ran.append(1)), (2, "two", lambda t: 1 / 0)]
    with pytest.raises(ZeroDivisionError):
        migrate(tables, steps, NOW)
    steps[1] = (2, "two", lambda t: ran.append(2))
    assert migrate(tables, steps, NOW) == [2] and migrate(tables, steps, NOW) == [] and ran == [1, 2]


def test_checks_find_seeded_violations(spark):
    bad = frame(spark, [photo("1", image_bytes=None), photo("2", image_file="x.jpg"), photo("3", image_file=None, download_attempts=3)], PHOTOS)
    labels = frame(spark, [label("1", gate_category="odd"), label("9", subject="not_applicable")], LABELS)
    vectors = spark.createDataFrame([("1", "m", [float("inf")], T0), ("2", "m", [0.0], T0), ("8", "m", [1.0], T0)], EMBEDDINGS)
    errors = spark.createDataFrame([("1", "x", T0)], EMBEDDING_ERRORS)
    tables = {"photos": bad, "labels": labels, "embeddings": vectors, "embedding_errors": errors, "files": spark.createDataFrame([("1.jpg",)], "image_file string")}
    checks = quality.photo_checks() + [quality.file_check()] + quality.embedding_checks() + quality.label_checks()
    assert all(r.violations == 1 for r in quality.evaluate(checks, tables))
    with pytest.raises(quality.DataQualityError, match="9 failed"):
        quality.run(checks, tables)
    kept = spark.createDataFrame([("1", "x", "image", "odd", "g", False, False, False, None), ("1", "nebula", "not_applicable", "MIRI", "g", False, True, True, "i")], "photo_id string, subject string, modality string, instrument string, release_group string, is_primary boolean, object_name_verified boolean, has_embedding boolean, image_file string")
    rejected = spark.createDataFrame([("1", "nobody")], "photo_id string, rejected_by string")
    found = {r.name: r.violations for r in quality.evaluate(quality.dataset_checks(0, 2, 5), {"kept": kept, "rejected": rejected})}
    assert found.pop("there are kept rows") == 0 and found.pop("rows are not fewer than published") == 3 and found.pop("no photo is kept and rejected") == 2
    assert all(v == 1 for v in found.values()), found


def test_grouping(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y"), ("a", 2, "w")], "k string, pos int, v string")
    assert {(r.k, r.v) for r in latest(rows, "k", "pos").collect()} == {("a", "z"), ("b", "y")}
    many = spark.range(100).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("c"))
    picked = stratified(many, "c", "id", 7).collect()
    assert len(picked) == 7 and {r.c for r in picked} == {"0", "1", "2"} and [r.id for r in picked] == [r.id for r in stratified(many, "c", "id", 7).collect()]
    at = {r.id: r.batch for r in batches(many, "id", 32).collect()}
    assert [at[i] for i in sorted(at)] == [i // 32 for i in range(100)]


def test_components_and_similarity(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components(spark, chain).collect()}
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100}
    assert components(spark, chain.limit(0)).count() == 0
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.2]), ("c", [1.0, 0.4]), ("z", [0.0, 0.0]), ("y", [0.0, 1.0])], "id string, v array<float>")
    assert {(r.a, r.b) for r in cosine_pairs(v, "id", "v", 0.97, block=2).collect()} == {("a", "b"), ("b", "c")}
    groups = {r.id: r.near_duplicate_group for r in duplicate_groups(spark, v, "id", "v", 0.97).collect()}
    assert groups == {"a": 0, "b": 0, "c": 0, "y": 1, "z": 2}  # a and c only through b; the zero vector is alone
    assert duplicate_groups(spark, v.limit(0), "id", "v").count() == 0


def brute_pairs(x, threshold):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = u @ u.T
    return {(i, j) for i, j in zip(*np.nonzero(np.triu(c >= threshold, 1)), strict=True)}


@pytest.mark.parametrize(("threshold", "pivots", "block"), [(0.4, None, 64), (0.4, 20, 16), (0.95, 20, 50), (-0.2, 3, 100), (0.999, 200, 7)])
def test_similarity_is_exact_at_any_threshold(spark, threshold, pivots, block):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([rng.normal(size=(150, 16)), np.repeat(centres, 15, axis=0) + 0.15 * rng.normal(size=(180, 16)), np.repeat(centres[:1], 60, axis=0)])
    x *= 10.0 ** rng.integers(-3, 4, len(x))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, [float("inf")] * 16), (1005, []), (None, [1.0] * 16)]
    v = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    found = [(r.a, r.b) for r in cosine_pairs(v, "id", "v", threshold, block=block, pivots=pivots).collect()]
    want = brute_pairs(x, threshold)
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 1000
    parent = list(range(len(x)))
    for i, j in sorted(want):
        while parent[i] != i:
            i = parent[i]
        while parent[j] != j:
            j = parent[j]
        parent[max(i, j)] = min(i, j)
    groups = {r.id: r.near_duplicate_group for r in duplicate_groups(spark, v.where("id is not null"), "id", "v", threshold, block=block, pivots=pivots).collect()}
    root = lambda i: i if parent[i] == i else root(parent[i])
    roots = [root(i) for i in range(len(x))]
    assert len(set(groups.values())) == len(set(roots)) + 6 and all((groups[i] == groups[0]) == (roots[i] == roots[0]) for i in range(len(x)))


def test_similarity_compares_few(spark):
    """Regions without a near one are left out before anything travels, and vectors travel for a small part of the pairs only."""
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(40, 16)), 25, axis=0) + 0.02 * rng.normal(size=(1000, 16))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    points = u[rng.choice(1000, 60, replace=False)]
    frame = pd.DataFrame({"vector": list(u)})
    told = next(similarity._intervals(iter([frame]), points))
    near = similarity.near_regions(np.stack(told["low"]), np.stack(told["high"]), 0.95)
    assert near.diagonal().all() and near.mean() < 0.25
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    for threshold, most in ((0.4, 0.0015), (0.95, 0.0)):
        assert similarity.open_pairs(spark, vectors, threshold).count() <= most * 2000 * 1999 / 2
    # of many copies only a forest is told, and none is compared
    same = spark.range(500).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("vector"))
    forest = similarity.open_pairs(spark, same, 0.95, block=100, forest=True)
    assert forest.where("sure").count() == forest.count() < 15 * 200


def test_client(caplog):
    answers, waits = [], []

    def transport(method, parameters):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    client = api.Client(transport, key="k1", sleep=waits.append)
    answers[:] = [(503, ""), (200, "<html>"), (200, '{"stat": "fail", "code": 105}'), (200, '{"stat": "ok", "x": 1}')]
    assert client.call("m")["x"] == 1 and [w for w in waits if w > 1] == [2.0, 4.0, 8.0]
    answers[:] = [(200, '{"stat": "fail", "code": 1, "message": "key k1 is bad"}')]
    with pytest.raises(api.SourceError, match=r"key \*\*\* is bad"):
        client.call("m")
    answers[:] = [OSError("k1")] * 4
    with pytest.raises(api.SourceError, match=r"\*\*\*"):
        client.call("m")
    pages = {1: {"pages": 2, "total": 3, "ids": ["a", "b"]}, 2: {"pages": 2, "total": 3, "ids": ["b", "c"]}}
    assert [i for _, i in api.listed(lambda n, size: pages[n])] == ["a", "b", "b", "c"]
    with caplog.at_level("WARNING"):
        list(api.listed(lambda n, size: pages[n] | {"total": 9}))
    assert "9 photos but lists 3" in caplog.text
    archive = api.Archive(api.Client(lambda method, p: (200, json.dumps(replies[method])), sleep=waits.append))
    replies = {
        "urls.lookupUser": {"user": {"id": "7@N"}}, "people.getPublicPhotos": {"photos": {"pages": 1, "total": "2", "photo": [{"id": "x"}, {"id": "y"}]}},
        "photos.getInfo": {"photo": {"id": "x"}}, "photos.getSizes": {"sizes": {"size": [{"label": "Thumb", "source": "t"}, {"label": "Large", "source": "l"}, {"label": "Tiny", "source": "z"}]}},
    }
    assert archive.user_id("a/b") == "7@N" and list(api.listed(archive.page("7@N"))) == [(0, "x"), (1, "y")]
    assert json.loads(archive.metadata("x")) == {"id": "x"} and archive.image_url("x") == "l" and archive.image_url("x", ("Original",)) == "z"
    replies["photos.getSizes"]["sizes"]["size"] = []
    with pytest.raises(api.SourceError, match="no sizes"):
        archive.image_url("x")


def test_flows(spark, tmp_path):
    tables = Tables(spark, f"file://{tmp_path}/t")

    def metadata(photo_id):
        if photo_id == "3":
            raise OSError("gone")
        return json.dumps({"id": photo_id, "title": {"_content": f"Title {photo_id}"}, "description": {"_content": "NGC 1"}, "dates": {"taken": "2023-01-01 00:00:00"}})

    def download(photo_id):
        if photo_id == "2":
            raise OSError("slow")
        return f"{photo_id}.jpg", 7

    ids = [(0, "1"), (1, "2"), (2, "1"), (3, "3")]
    assert workflows.ingest(tables, ids, metadata, download, NOW)
    rows = {r.photo_id: r for r in tables.read("photos", PHOTOS).collect()}
    assert set(rows) == {"1", "2"} and rows["1"].image_file == "1.jpg" and rows["2"].download_attempts == 1
    with pytest.raises(api.SourceError):
        workflows.ingest(tables, ids[:2], metadata, download, NOW + timedelta(1))  # only 2 is left, and fails
    present = lambda *names: lambda: spark.createDataFrame([(n,) for n in names], "image_file string")
    with pytest.raises(quality.DataQualityError, match="image files exist"):
        workflows.ingest(tables, [(0, "4")], metadata, lambda i: (f"{i}.jpg", 7), NOW, files=present("1.jpg"))
    ran = []
    assert not workflows.ingest(tables, [(0, "4")], metadata, download, NOW, [(1, "one", ran.append)], present("1.jpg", "2.jpg", "4.jpg")) and len(ran) == 1

    def model(part):  # fails for a batch, and for one of it
        if len(part) > 1 or "4" in part:
            raise RuntimeError(f"can't read {part}")
        return [[1.0, 2.0] for _ in part]

    assert workflows.embed(tables, model, "m", NOW) and not workflows.embed(tables, model, "m", NOW)
    assert sorted(r.photo_id for r in tables.read("embeddings", EMBEDDINGS).collect()) == ["1", "2"]
    assert [(r.photo_id, r.error) for r in tables.read("embedding_errors", EMBEDDING_ERRORS).collect()] == [("4", "can't read ['4']")]
    log = f"file://{tmp_path}/log"

    def labeller(prompt, image=None):
        if "Title 2" in prompt:
            raise OSError("busy")
        return {"gate_category": "astronomical_observation", "subject": "star", "modality": "image", "instrument": "MIRI", "confidence": "low", "seconds": 1.125, "rationale": image or prompt[:5]}

    assert workflows.label(tables, log, labeller, "m", "fake") == 2  # the failure of 2 is told, the others are kept
    assert sorted(r.photo_id for r in logs.read_log(spark, log).collect()) == ["1", "4"]
    assert workflows.label(tables, log, labeller, "m", "fake") == 0
    with pytest.raises(workflows.LabelRunError, match="1 of 1 calls failed: OSError: busy"):
        workflows.label(tables, log, labeller, "m", "fake", least=1)
    assert workflows.label(tables, log, lambda p, i: labeller("", i), "m", "fake", image=lambda i: b"pixels") == 1
    live = f"file://{tmp_path}/p"

    def copy(photo_id, image_file):
        files.store_file(f"{live}/images", f"{photo_id}.jpg", [b"x"], check=None)

    files.store_file(f"{live}/images", "77.jpg", [b"x"], check=None)
    manifest = workflows.publish_dataset(tables, f"file://{tmp_path}/s", live, log, copy=copy, review=2, run_id="manual 2026/1")
    assert {r.photo_id: (r.seconds, r.vision, r.rationale) for r in tables.read("labels", LABELS).collect()} == {"1": (1.12, False, "TITLE"), "4": (1.12, False, "TITLE"), "2": (1.12, True, "cGl4ZWxz")}
    assert manifest["rows"]["kept"] == 3 and manifest["pending"] == 0
    out = dataset.published_folder(spark, live)
    assert sorted(r.image_file for r in spark.read.parquet(f"{out}/kept.parquet").collect()) == ["images/1.jpg", "images/2.jpg", "images/4.jpg"]
    assert sorted(x.name for x in (tmp_path / "p/images").glob("*.jpg")) == ["1.jpg", "2.jpg", "4.jpg"] and (tmp_path / "p/v000001/review.html").exists()


def test_a_task_stops_calling_when_half_of_its_calls_fail(spark):
    queue = spark.createDataFrame([(str(i), "t", "d") for i in range(50)], "photo_id string, title string, description string").coalesce(1)

    def labeller(prompt):
        raise ValueError("no")

    got = [r.error for r in workflows.label_records(queue, labeller, "m", "fake").collect()]
    assert got.count("ValueError: no") == 5 and got.count("not tried") == 45


def test_a_run_stops_by_its_own_tally(spark, tmp_path):
    """However many tasks there are, a run whose calls fail makes few; one whose first calls alone fail goes on to its end."""
    blank = {f.name: F.lit(None).cast(f.dataType) for f in PHOTOS.fields}
    ids = spark.range(300).select(F.format_string("%04d", "id").alias("id"))
    blank |= {"photo_id": F.col("id"), "title": F.col("id"), "image_file": F.concat("id", F.lit(".jpg"))}
    tables = Tables(spark, f"file://{tmp_path}/t")
    tables.commit("photos", ids.select(*(c.alias(n) for n, c in blank.items())))

    def labeller(bad):
        def one(prompt):
            if bad(int(prompt.removeprefix("TITLE: ")[:4])):
                raise OSError("busy")
            return {"gate_category": "astronomical_observation", "subject": "star", "modality": "image", "instrument": "MIRI", "confidence": "low"}

        return one

    log = f"file://{tmp_path}/a"
    with pytest.raises(workflows.LabelRunError) as told:
        workflows.label(tables, log, labeller(lambda i: True), "m", "fake", 300)
    assert (told.value.made, told.value.failed) == (5, 5) and logs.read_log(spark, log).count() == 0
    with pytest.raises(workflows.LabelRunError) as told:
        workflows.label(tables, log, labeller(lambda i: i >= 70), "m", "fake", 300, wave=100)
    assert (told.value.made, told.value.failed) == (160, 90) and logs.read_log(spark, log).count() == 70
    assert workflows.label(tables, f"file://{tmp_path}/b", labeller(lambda i: i < 2), "m", "fake", 40) == 38


def test_label_stream(spark, tmp_path):
    from curatrix.streaming.label_stream import fold_log

    schema = spark.createDataFrame([], "photo_id string, subject string, pos long").schema
    tables, source = Tables(spark, f"file://{tmp_path}/t"), tmp_path / "in"
    source.mkdir()

    def run(name, *rows):
        (source / name).write_text("\n".join(json.dumps(dict(zip(schema.names, r, strict=True))) for r in rows))
        fold_log(spark, f"file://{source}", schema, tables, "labels", "photo_id", "pos", f"file://{tmp_path}/c").awaitTermination()
        return {r.photo_id: r.subject for r in tables.read("labels", schema).collect()}

    assert run("a.json", ("1", "star", 5), ("2", "nebula", 6)) == {"1": "star", "2": "nebula"}
    assert run("b.json", ("1", "galaxy", 9), ("2", "late", 1)) == {"1": "galaxy", "2": "nebula"}
