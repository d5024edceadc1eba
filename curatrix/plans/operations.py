"""Queries of the catalogue that go through files, sources, flows and single functions, with SQL that says what must come out."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.functions import values as V
from curatrix.operators import grouping, ordered, planning, quality, sketches, state
from curatrix.operators.changes import ChangeTable
from curatrix.operators.state import Tables
from curatrix.plans import dataset, workflows
from curatrix.plans import fixtures as X
from curatrix.plans.catalogue import NOW, _CUT, _RANK, _RELEASE, _UNESCAPED, _query
from curatrix.plans.fixtures import CUTOFF, table
from curatrix.schemas import EMBEDDING_ERRORS, EMBEDDINGS, ENUMS, KEEP_GATE, LABELS, LOG_RECORD, MODALITIES, PHOTOS, SUBJECTS
from curatrix.scratch import Scratch
from curatrix.sources import api, files, legacy, logs, npz
from curatrix.streaming import keyed

_NOW = f"TIMESTAMP '{NOW:%Y-%m-%d}'"


def _photo_table(spark: SparkSession, d: str) -> DataFrame:
    """The fixture's photos with all columns of the table."""
    rows = X.photos(spark, d).withColumn("first_seen_at", F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"))
    missing = [f for f in PHOTOS.fields if f.name not in rows.columns]
    return rows.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing)).select(*PHOTOS.names)


def _label_table(spark: SparkSession, d: str) -> DataFrame:
    rows = X.labels(spark, d)
    missing = [f for f in LABELS.fields if f.name not in rows.columns]
    return rows.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing)).select(*LABELS.names)


def _vector_table(spark: SparkSession, d: str) -> DataFrame:
    return X.embeddings(spark, d).select("photo_id", F.lit("m").alias("model"), "vector", F.lit(NOW).cast("timestamp_ntz").alias("created_at"))


def _tables(spark: SparkSession, **content: DataFrame) -> Tables:
    found = Tables(spark, f"{Scratch(spark, 'archive').path}/tables")
    if content:
        found.commit_all(content)
    return found


# Files.


@_query("SELECT c_mktsegment, c_custkey::VARCHAR AS c_custkey, c_name, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS place FROM customer")
def csv_in_order(spark: SparkSession, d: str) -> DataFrame:
    """One CSV file sorted by two keys; place is each row's line in it."""
    folder = files.Folder(spark, Scratch(spark, "csv").path)
    files.write_sorted(table(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_name"), folder, "customer.csv", "c_mktsegment", "c_custkey")
    return files.read_csv(spark, f"{folder.path}/customer.csv").withColumn("place", F.monotonically_increasing_id())


@_query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber = 1")
def parquet_sorted(spark: SparkSession, d: str) -> DataFrame:
    """One sorted Parquet file, and sorted ranges of the same rows, each written and read again."""
    rows = table(spark, d, "lineitem").where("l_linenumber = 1").select("l_orderkey", "l_linenumber", "l_quantity")
    folder = files.Folder(spark, Scratch(spark, "sorted").path)
    files.write_sorted(rows, folder, "lines.parquet", *rows.columns)  # all columns: rows of one key have one order in both
    files.write_ranged(rows, f"{folder.path}/ranges", "l_orderkey")
    one = files.read_parts(spark, f"{folder.path}/lines.parquet")
    # rows whose place in the file isn't that in the order would not be found again
    ranges = spark.read.parquet(f"{folder.path}/ranges").withColumn("order", F.struct(*rows.columns))
    right = grouping.numbered(ranges, "order", "place").drop("order")
    return one.join(right, ["l_orderkey", "l_linenumber", "l_quantity", "place"]).drop("place")


@_query("""+ f AS (SELECT photo_id FROM photos_f WHERE photo_id::BIGINT % 97 = 0)
SELECT photo_id || '.jpg' AS image_file, 'orphan' AS state FROM f WHERE photo_id::BIGINT % 11 = 0 UNION ALL
SELECT image_file, 'missing' FROM photos_f WHERE image_file IS NOT NULL AND photo_id::BIGINT % 13 = 0 AND photo_id::BIGINT % 97 <> 0""")
def image_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder of image files against the photos: files of photos that have none, and photos whose file isn't there."""
    photos, folder = X.photos(spark, d), f"{Scratch(spark, 'images').path}/images"
    n = F.col("photo_id").cast("long")

    def write(frames):
        for frame in frames:
            for photo_id in frame["photo_id"]:
                files.store_file(folder, f"{photo_id}.jpg", [b"\xff\xd8 \xff\xd9"])
                files.store_file(folder, f"{photo_id}.txt", [b""], check=None)
            yield frame

    photos.where(n % 97 == 0).select("photo_id").mapInPandas(write, "photo_id string").write.format("noop").mode("overwrite").save()
    found = files.images(spark, folder)
    stored = photos.where(F.col("image_file").isNotNull())
    orphans = planning.orphan_files(found, stored, spark.createDataFrame([], "photo_id string"))
    missing = planning.missing_files(stored.where(n % 13 == 0), found)
    return orphans.select("image_file", F.lit("orphan").alias("state")).unionByName(missing.select("image_file", F.lit("missing").alias("state")))


@_query("SELECT vec_id::VARCHAR AS photo_id, CASE WHEN vec_id % 10 <> 0 THEN len(embedding) ELSE -1 END AS dim, CASE WHEN vec_id % 10 <> 0 THEN embedding[1]::DOUBLE ELSE 0 END AS first, CASE WHEN vec_id % 10 = 0 THEN 'bad ' || vec_id END AS error FROM embeddings")
def npz_batches(spark: SparkSession, d: str) -> DataFrame:
    """Vectors and errors through staged NumPy archives."""
    folder = f"{Scratch(spark, 'npz').path}/staged"

    def write(frames):
        for frame in frames:
            good, ids = frame["vec_id"] % 10 != 0, frame["vec_id"].astype(str)
            npz.save_batch(folder, f"batch-{ids.iloc[0]}.npz", ids[good].tolist(), np.stack(frame["embedding"][good]) if good.any() else np.zeros((0, 0)), {i: f"bad {i}" for i in ids[~good]})
            yield frame[["vec_id"]]

    rows = table(spark, d, "embeddings").select("vec_id", "embedding").repartitionByRange(4, "vec_id")
    rows.mapInPandas(write, "vec_id long").write.format("noop").mode("overwrite").save()
    return npz.read_batches(spark, folder).select("photo_id", F.when(F.col("vector").isNotNull(), F.size("vector")).otherwise(-1).alias("dim"), F.coalesce(F.get("vector", F.lit(0)).cast("double"), F.lit(0.0)).alias("first"), "error")


@_query("""SELECT doc_id::VARCHAR AS photo_id, CASE WHEN doc_id % 4 <> 0 AND (doc_id % 9 <> 0 OR e.vec_id IS NOT NULL) THEN doc_id || '.jpg' END AS image_file,
  CASE WHEN doc_id % 4 <> 0 AND (doc_id % 9 <> 0 OR e.vec_id IS NOT NULL) THEN n_chars ELSE -1 END AS image_bytes, 1 AS download_attempts,
  CASE WHEN doc_id % 4 = 0 THEN 'no file in the earlier archive' WHEN doc_id % 9 = 0 AND e.vec_id IS NULL THEN 'file of the earlier archive is broken: cut off' END AS last_download_error,
  source AS legacy_tag_label, e.vec_id IS NOT NULL AS embedded FROM documents LEFT JOIN embeddings e ON vec_id = doc_id AND vec_id % 2 = 0""")
def legacy_load(spark: SparkSession, d: str) -> DataFrame:
    """Photos and vectors of an earlier archive, with what its files are like."""
    scratch, n = Scratch(spark, "legacy"), F.col("doc_id")
    vectors = table(spark, d, "embeddings").where("vec_id % 2 = 0").select(F.col("vec_id").alias("doc_id"), "embedding")
    old = table(spark, d, "documents").join(vectors, "doc_id", "left").select(
        n.cast("string").alias("photo_id"), F.lit("t").alias("title"), F.lit("d").alias("description"), F.array("lang").alias("tags"), F.lit(NOW).cast("timestamp_ntz").alias("date_taken"),
        F.lit(NOW).cast("timestamp_ntz").alias("date_ingested"), F.concat(F.lit("/old/"), n.cast("string"), F.lit(".jpg")).alias("image_path"), F.col("source").alias("canonical_label"), "embedding", "n_chars",
    )
    old.write.parquet(f"{scratch.path}/photos.parquet")
    i = F.col("photo_id").cast("long")
    stored = old.where(i % 4 != 0).select(T.file_name(F.col("photo_id")).alias("image_file"), F.col("n_chars").alias("length"))
    broken = old.where(i % 9 == 0).select("photo_id", F.lit("cut off").alias("error"))
    tables = Tables(spark, f"{scratch.path}/tables")
    # the loaded vectors' photos that aren't documents can't occur: vectors come from the same table
    legacy.load(tables, legacy.attach(spark, scratch.path), stored, "m", NOW, broken, dim=64)
    has = tables.read("embeddings", EMBEDDINGS).select("photo_id", F.lit(True).alias("embedded"))
    both = tables.read("photos", PHOTOS).join(has, "photo_id", "left")
    return both.select("photo_id", "image_file", F.coalesce("image_bytes", F.lit(-1)).alias("image_bytes"), "download_attempts", "last_download_error", "legacy_tag_label", F.coalesce("embedded", F.lit(False)).alias("embedded"))


# The label log.


def _log_rows(spark: SparkSession, d: str) -> DataFrame:
    return _label_table(spark, d).withColumn("title", F.lit("t")).select(*LOG_RECORD.names)


@_query("SELECT photo_id, gate_category, CASE WHEN photo_id::BIGINT % 3 = 0 THEN 'low' ELSE 'high' END AS confidence, codebook_version FROM labels_f")
def log_projection(spark: SparkSession, d: str) -> DataFrame:
    """Two appends to a log; the table is made anew from it, and a record of the later one counts."""
    tables, log, rows = _tables(spark), f"{Scratch(spark, 'log').path}/log", _log_rows(spark, d)
    logs.append(rows.withColumn("confidence", F.when(F.col("photo_id").cast("long") % 3 == 0, "medium").otherwise("high")), log)
    logs.append(rows.where(F.col("photo_id").cast("long") % 3 == 0).withColumn("confidence", F.lit("low")), log)
    workflows.load_labels(tables, logs.read_log(spark, log))
    return tables.read("labels", LABELS).select("photo_id", "gate_category", "confidence", "codebook_version")


_ENUM_SQL = {k: ", ".join(f"'{x}'" for x in v) for k, v in ENUMS.items()}


@_query(f"""+ r AS (SELECT photo_id, CASE WHEN photo_id::BIGINT % 5 = 0 THEN 'picture' ELSE gate_category END AS gate_category, CASE WHEN photo_id::BIGINT % 7 = 0 THEN 'not_applicable' ELSE subject END AS subject,
  CASE WHEN photo_id::BIGINT % 6 = 0 THEN NULL ELSE modality END AS modality, instrument, CASE WHEN photo_id::BIGINT % 8 = 0 THEN 'sure' ELSE 'high' END AS confidence FROM labels_f)
SELECT photo_id, array_to_string([x FOR x IN [CASE WHEN gate_category NOT IN ({_ENUM_SQL["gate_category"]}) THEN 'gate_category=''' || gate_category || '''' END,
  CASE WHEN modality IS NULL THEN 'modality=None' END, CASE WHEN confidence = 'sure' THEN 'confidence=''sure''' END,
  CASE WHEN gate_category = '{KEEP_GATE}' AND (subject = 'not_applicable' OR modality = 'not_applicable') THEN 'kept with not_applicable' END] IF x IS NOT NULL], '; ') AS problems FROM r""")
def log_problems(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each record of a log."""
    n = F.col("photo_id").cast("long")
    rows = _log_rows(spark, d).withColumn("gate_category", F.when(n % 5 == 0, "picture").otherwise(F.col("gate_category"))).withColumn("subject", F.when(n % 7 == 0, "not_applicable").otherwise(F.col("subject")))
    rows = rows.withColumn("modality", F.when(n % 6 != 0, F.col("modality"))).withColumn("confidence", F.when(n % 8 == 0, "sure").otherwise("high"))
    return rows.select("photo_id", F.array_join(logs.problems(), "; ").alias("problems"))


@_query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def stream_fold(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream of JSON files that is folded into a table, in two runs."""
    from curatrix.streaming.label_stream import fold_log

    scratch, tables = Scratch(spark, "stream"), _tables(spark)
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type")
    for odd in (0, 1):
        rows.where(F.col("event_id") % 2 == odd).write.mode("append").json(f"{scratch.path}/in")
        fold_log(spark, f"{scratch.path}/in", rows.schema, tables, "last", "user_id", "event_id", f"{scratch.path}/checkpoint").awaitTermination()
    return tables.read("last", rows.schema)


#: Until here the first run reads events; watermark; what comes with the second run although it is older than the watermark is refused.
_SPLIT, _LATE, _OLD = "TIMESTAMP_NTZ '2024-01-16'", "1 day", "TIMESTAMP_NTZ '2024-01-10'"


def _two_runs(spark: SparkSession, d: str, path: str) -> Iterator[DataFrame]:
    """Events as a stream of files that grows twice: what comes second holds some records that are late but in time, and others that are too late."""
    events = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    slow = F.expr(f"ts >= {_SPLIT} - INTERVAL 12 HOURS AND event_id % 3 = 0")
    events.where(F.expr(f"ts < {_SPLIT}") & ~slow).write.parquet(f"{path}/in")
    yield spark.readStream.schema(events.schema).parquet(f"{path}/in")
    old = events.where(F.expr(f"ts < {_OLD}"))
    old = old.withColumn("event_id", F.col("event_id") + 1_000_000_000).withColumn("event_type", F.lit("late"))
    old = old.unionByName(old.withColumn("user_id", F.col("user_id") + 1_000_000))
    events.where(F.expr(f"ts >= {_SPLIT}") | slow).unionByName(old).write.mode("append").parquet(f"{path}/in")
    yield spark.readStream.schema(events.schema).parquet(f"{path}/in")


@_query("SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def keyed_fold(spark: SparkSession, d: str) -> DataFrame:
    """The newest event of each user by a stream with state, in two runs, written as changes."""
    path, found = Scratch(spark, "keyed").path, None
    for stream in _two_runs(spark, d, path):
        found = found or ChangeTable(_tables(spark), "newest", stream.schema, "user_id")
        keyed.fold_into(found, keyed.newest_changes(stream, "user_id", "ts", "event_id", _LATE), f"{path}/checkpoint").awaitTermination()
    return found.read()


@_query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS begins FROM events),
  s AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 6 HOURS) AS end_us, count(*) AS n FROM s
GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users that a stream closes behind its watermark, in two runs."""
    path = Scratch(spark, "sessions").path
    for stream in _two_runs(spark, d, path):
        keyed.append_to(f"{path}/out", keyed.sessions(stream, "user_id", "ts", "6 hours", _LATE), f"{path}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


# The archive's API.


@_query("""SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN 'user of ' || c_name END AS user_id,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'original' WHEN c_custkey % 3 = 1 THEN 'medium' ELSE 'tiny' END AS url,
  CASE WHEN c_custkey % 11 = 0 THEN 'SourceError: urls.lookupUser: 1: unknown' END AS error FROM customer""")
def remote_lookups(spark: SparkSession, d: str) -> DataFrame:
    """User and image address of all customers, looked up by tasks through a transport that fails now and then, and for some always."""

    def archive(key: str) -> api.Archive:
        n, said = int(key), []

        def transport(method: str, parameters: dict) -> tuple[int, str]:
            said.append(method)
            if method == "urls.lookupUser":
                if n % 11 == 0:
                    return 200, json.dumps({"stat": "fail", "code": 1, "message": "unknown"})
                return (503, "") if n % 4 == 0 and len(said) == 1 else (200, json.dumps({"user": {"id": f"user of {parameters['url']}"}}))
            if n % 3 == 2 and said.count(method) == 1:
                return 200, json.dumps({"stat": "fail", "code": 105, "message": "try again"})
            sizes = [("Medium", "medium"), ("Original", "original"), ("Odd", "odd")] if n % 3 == 0 else [("Medium 640", "medium"), ("Odd", "odd")] if n % 3 == 1 else [("Odd", "odd"), ("Tiny", "tiny")]
            return 200, json.dumps({"sizes": {"size": [{"label": a, "source": b} for a, b in sizes]}})

        return api.Archive(api.Client(transport, sleep=lambda s: None))

    return api.lookups(table(spark, d, "customer"), archive, "c_custkey", "c_name")


def _stored_pages(spark: SparkSession, ids: DataFrame, path: str, size: int, step: int) -> None:
    """The pages of a listing as files: ids are (at, id); page p has the `size` places from (p - 1) * step on, so with a step below the size pages overlap."""
    last = F.floor(F.col("at") / step).cast("int") + 1
    of = ids.withColumn("page", F.explode(F.array(last, last - 1))).withColumn("place", F.col("at") - (F.col("page") - 1) * step).where(F.col("place").between(0, size - 1) & (F.col("page") > 0))
    body = of.groupBy("page").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"])).alias("value"))
    body.repartition("page").write.mode("overwrite").partitionBy("page").text(path)


def _page_of(path: str, total: int, step: int) -> Callable[[int, int], dict]:
    """An archive's answer for a page, from files that any task can open."""

    def page(number: int, size: int) -> dict:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        found = [f for f in store.get_file_info(fs.FileSelector(f"{root}/page={number}", allow_not_found=True)) if f.base_name.startswith("part-")]
        ids = json.loads(store.open_input_file(found[0].path).read()) if found else []
        pages = max(1, -(-total // step) if step == size else -(-(total - 1) // step))
        return {"pages": pages, "total": total, "ids": ids[: max(0, total - (number - 1) * step)]}

    return page


@_query("SELECT c_custkey::VARCHAR AS photo_id, c_custkey + greatest(c_custkey - 1, 0) // 99 AS pos FROM customer")
def listing_pages(spark: SparkSession, d: str) -> DataFrame:
    """A paged listing of all customers, read by tasks; every page repeats the last id of the one before."""
    path, ids = Scratch(spark, "pages").path, table(spark, d, "customer").select(F.col("c_custkey").alias("at"), F.col("c_custkey").cast("string").alias("id"))
    _stored_pages(spark, ids, path, 100, 99)
    return api.listing(spark, _page_of(path, ids.count(), 99), 100, 10)


@_query("SELECT c_custkey::VARCHAR AS photo_id, c_custkey AS pos, c_custkey >= (SELECT count(*) // 3 FROM customer) AS later FROM customer")
def listing_stream(spark: SparkSession, d: str) -> DataFrame:
    """A listing as a stream: the second run reads what the archive has got since."""
    scratch, ids = Scratch(spark, "pages"), table(spark, d, "customer").select(F.col("c_custkey").alias("at"), F.col("c_custkey").cast("string").alias("id"))
    _stored_pages(spark, ids, f"{scratch.path}/pages", 100, 100)
    total = ids.count()
    for upto in (total // 3, total):
        source = api.listing_source(_page_of(f"{scratch.path}/pages", upto, 100), 100, 10, "growing_listing")
        spark.dataSource.register(source)
        rows = spark.readStream.format(source.name()).load().withColumn("later", F.lit(upto == total))
        keyed.append_to(f"{scratch.path}/out", rows, f"{scratch.path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{scratch.path}/out").select("photo_id", "pos", "later")


def _payload(photo_id: str) -> str:
    n = int(photo_id)
    if n % 7 == 0:
        raise OSError(f"{photo_id} timed out")
    tags = {} if n % 5 == 0 else {"tags": {"tag": [{"_content": f"t{n % 3}"}, {"_content": "x"}]}}
    return json.dumps({"id": photo_id, "title": {"_content": f"Title {n}"}, "description": {"_content": "d" * (n % 4)}, "dates": {"taken": "" if n % 6 == 0 else "2023-05-06 07:08:09"}} | tags)


@_query("""SELECT doc_id::VARCHAR AS photo_id, 'Title ' || doc_id AS title, repeat('d', (doc_id % 4)::INT) AS description, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 't' || (doc_id % 3) || '|x' END AS tags,
  CASE WHEN doc_id % 6 <> 0 THEN TIMESTAMP '2023-05-06 07:08:09' END AS date_taken, NULL::VARCHAR AS error FROM documents WHERE doc_id % 7 <> 0
UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, NULL, NULL, 'OSError: ' || doc_id || ' timed out' FROM documents WHERE doc_id % 7 = 0""")
def metadata_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of all photos, read; one that can't be fetched is a row with an error."""
    got = Scratch(spark, "payloads").keep(api.fetch(X.photos(spark, d).select("photo_id"), _payload), "got")
    good = api.metadata(got).select("photo_id", "title", "description", F.array_join("tags", "|").alias("tags"), "date_taken", F.lit(None).cast("string").alias("error"))
    bad = got.where("error is not null").select("photo_id", *(F.lit(None).cast(f"{'timestamp_ntz' if c == 'date_taken' else 'string'}").alias(c) for c in ("title", "description", "tags", "date_taken")), "error")
    return good.unionByName(bad)


# Flows and state.


@_query(f"""SELECT c_custkey::VARCHAR AS photo_id, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 2 = 1 THEN 'Title ' || c_custkey ELSE 'old' END AS title, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey || '.jpg' END AS image_file,
  CASE WHEN c_custkey % 3 <> 0 THEN c_custkey ELSE -1 END AS image_bytes, 1 AS download_attempts, CASE WHEN c_custkey % 3 = 0 THEN 'OSError: busy' END AS last_download_error,
  CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2020-01-01' ELSE {_NOW} END AS first_seen_at, {_NOW} AS last_seen_at FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 7 <> 0""")
def ingest_flow(spark: SparkSession, d: str) -> DataFrame:
    """An ingest run over known and new photos: some payloads and some downloads fail."""
    ids = table(spark, d, "customer").select("c_custkey")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in PHOTOS.fields}
    blank |= {"photo_id": F.col("c_custkey").cast("string"), "title": F.lit("old"), "first_seen_at": F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"), "download_attempts": F.lit(0)}
    tables = _tables(spark, photos=ids.where("c_custkey % 2 = 0").select(*(c.alias(n) for n, c in blank.items())))

    def download(photo_id: str) -> tuple[str, int]:
        if int(photo_id) % 3 == 0:
            raise OSError("busy")
        return f"{photo_id}.jpg", int(photo_id)

    listed = ids.select(F.col("c_custkey").alias("pos"), F.col("c_custkey").cast("string").alias("photo_id"))
    workflows.ingest(tables, listed, _payload, download, NOW, [(1, "first", lambda t: None)])
    return tables.read("photos", PHOTOS).select("photo_id", "title", "image_file", F.coalesce("image_bytes", F.lit(-1)).alias("image_bytes"), "download_attempts", "last_download_error", "first_seen_at", "last_seen_at")


@_query("""SELECT photo_id, CASE WHEN photo_id::BIGINT % 17 <> 0 THEN photo_id::DOUBLE END AS value, CASE WHEN photo_id::BIGINT % 17 = 0 THEN 'no ' || photo_id END AS error FROM photos_f
  WHERE image_file IS NOT NULL""")
def embed_flow(spark: SparkSession, d: str) -> DataFrame:
    """Vectors for all stored images by a model that fails for a batch that holds an odd one."""
    tables = _tables(spark, photos=_photo_table(spark, d))

    def model(ids: list[str]) -> list:
        for i in ids:
            if int(i) % 17 == 0:
                raise ValueError(f"no {i}")
        return [[float(i), 1.0] for i in ids]

    workflows.embed(tables, model, "m", NOW)
    good = tables.read("embeddings", EMBEDDINGS).select("photo_id", F.get("vector", F.lit(0)).cast("double").alias("value"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(tables.read("embedding_errors", EMBEDDING_ERRORS).select("photo_id", F.lit(None).cast("double").alias("value"), "error"))


@_query("SELECT 'stored' AS what, count(*) AS n FROM embeddings WHERE vec_id % 3 <> 0 UNION ALL SELECT 'failed', count(*) FROM embeddings WHERE vec_id % 3 = 0 UNION ALL SELECT 'rows', count(*) FROM embeddings WHERE vec_id % 3 <> 0")
def store_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Staged vectors and errors in one commit: rows counted as staged, and what the table has."""
    tables = _tables(spark)
    rows = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("photo_id"), F.when(F.col("vec_id") % 3 != 0, F.col("embedding")).alias("vector"), F.when(F.col("vec_id") % 3 == 0, "bad").alias("error"), F.lit(0).alias("pos"))
    stored, failed = workflows.store(tables, rows, "m", NOW)
    return spark.createDataFrame([("stored", stored), ("failed", failed), ("rows", tables.read("embeddings", EMBEDDINGS).count())], "what string, n long")


_TITLED = "length(title) % 13 = 0"


@_query(f"""+ q AS (SELECT photo_id, title FROM photos_f WHERE image_file IS NOT NULL AND (date_taken IS NULL OR photo_id::BIGINT % 2 = 0) AND photo_id NOT IN (SELECT photo_id FROM labels_f))
SELECT photo_id, 'm' AS model, 'fake' AS backend, FALSE AS vision, 'v6' AS codebook_version, length(title)::INT AS prompt_tokens, 1.12::DOUBLE AS seconds, title FROM q WHERE NOT {_TITLED}""")
def label_flow(spark: SparkSession, d: str) -> DataFrame:
    """A labelling run over all that is waiting; calls that fail leave no record, and the others' records are stamped."""
    # every other photo has no date, and so may be labelled
    undated = F.when(F.col("photo_id").cast("long") % 2 == 1, F.col("date_taken"))
    tables, log = _tables(spark, photos=_photo_table(spark, d).withColumn("date_taken", undated), labels=_label_table(spark, d)), f"{Scratch(spark, 'log').path}/log"

    def labeller(prompt: str) -> dict:
        title = prompt.removeprefix("TITLE: ").partition("\n\nCAPTION: ")[0]
        if len(title) % 13 == 0:
            raise OSError("busy")
        return {"gate_category": KEEP_GATE, "subject": "star", "modality": "image", "instrument": "MIRI", "confidence": "low", "prompt_tokens": len(title), "seconds": 1.125}

    workflows.label(tables, log, labeller, "m", "fake", 10**6, least=10**6)
    return logs.read_log(spark, log).select("photo_id", "model", "backend", "vision", "codebook_version", "prompt_tokens", "seconds", "title")


_WAVE = 50


@_query(f"""+ q AS (SELECT photo_id, photo_id >= '15' AS bad, row_number() OVER (ORDER BY photo_id) - 1 AS place FROM photos_f WHERE image_file IS NOT NULL AND photo_id NOT IN (SELECT photo_id FROM labels_f WHERE photo_id::BIGINT % 4 = 0)),
  waves(made) AS (SELECT 5 UNION ALL SELECT made + least(made, {_WAVE}) FROM waves WHERE made < (SELECT count(*) FROM q)),
  tallies AS (SELECT made, count(*) AS n, count(*) FILTER (bad) AS bad FROM waves JOIN q ON place < made GROUP BY made),
  stop AS (SELECT coalesce(min(n) FILTER (n >= 5 AND 2 * bad >= n), max(n)) AS n FROM tallies)
SELECT photo_id, stop.n AS made, (SELECT bad FROM tallies WHERE tallies.n = stop.n LIMIT 1) AS failed FROM q, stop WHERE place < stop.n AND NOT q.bad""")
def label_waves(spark: SparkSession, d: str) -> DataFrame:
    """A labelling run whose calls all fail from some photo on: what is in the log when the run's tally ends it, and how many calls it made and lost."""
    photos = _photo_table(spark, d).withColumn("title", F.col("photo_id")).withColumn("date_taken", F.lit(None).cast("timestamp_ntz"))
    tables, log = _tables(spark, photos=photos, labels=_label_table(spark, d).where(F.col("photo_id").cast("long") % 4 == 0)), f"{Scratch(spark, 'log').path}/log"

    def labeller(prompt: str) -> dict:
        if prompt.removeprefix("TITLE: ").partition("\n")[0] >= "15":
            raise OSError("busy")
        return {"gate_category": KEEP_GATE, "subject": "star", "modality": "image", "instrument": "MIRI", "confidence": "low"}

    try:
        made, failed = workflows.label(tables, log, labeller, "m", "fake", 10**6, wave=_WAVE), 0
    except workflows.LabelRunError as e:
        made, failed = e.made, e.failed
    return logs.read_log(spark, log).select("photo_id", F.lit(made).cast("long").alias("made"), F.lit(failed).cast("long").alias("failed"))


@_query(f"""+ r AS (SELECT photo_id, CASE WHEN photo_id::BIGINT % 5 = 0 THEN 'picture' ELSE gate_category END AS gate_category FROM labels_f)
(SELECT photo_id, 'gate_category=''picture''' AS problem FROM r WHERE gate_category = 'picture' ORDER BY photo_id LIMIT 10)
UNION ALL SELECT photo_id, 'as it was' FROM labels_f WHERE photo_id::BIGINT % 5 <> 0""")
def log_refused(spark: SparkSession, d: str) -> DataFrame:
    """A log with records outside the codebook: the ten that the error tells, and the labels table, which stays as it was."""
    tables, log, rows = _tables(spark), f"{Scratch(spark, 'log').path}/log", _log_rows(spark, d)
    odd = F.col("photo_id").cast("long") % 5 == 0
    logs.append(rows.where(~odd), log)
    workflows.load_labels(tables, logs.read_log(spark, log))
    logs.append(rows.where(odd).withColumn("gate_category", F.lit("picture")), log)
    told = []
    try:
        workflows.load_labels(tables, logs.read_log(spark, log))
    except logs.LabelLogError as e:
        told = [tuple(part.split(": ", 1)) for part in str(e).split("; ")]  # ten at most
    return tables.read("labels", LABELS).select("photo_id", F.lit("as it was").alias("problem")).unionByName(spark.createDataFrame(told, "photo_id string, problem string"))


_CELL = """replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')"""
_CELLS = " || '</td><td>' || ".join(f"coalesce({_CELL.format(c)}, '')" for c in ("photo_id", "subject", "modality", "instrument", "object_name", "title", "'r'"))


@_query(f"""+ s AS (SELECT photo_id, subject, modality, instrument, object_name, title, row_number() OVER (PARTITION BY subject ORDER BY md5(photo_id || '42'), photo_id) AS turn
  FROM labels_f JOIN photos_f USING (photo_id) WHERE gate_category = '{KEEP_GATE}'), t AS (SELECT * FROM s ORDER BY turn, subject LIMIT 200)
SELECT row_number() OVER (ORDER BY photo_id) - 1 AS place, '<tr><td>' || {_CELLS} || '</td></tr>' AS html FROM t""")
def review_page(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a review sheet of 200 kept photos, read from the page that was written; place is a row's place in it."""
    out = f"{Scratch(spark, 'review').path}/out"
    keep = X.labels(spark, d).where(F.col("gate_category") == KEEP_GATE).join(X.photos(spark, d).select("photo_id", "title"), "photo_id")
    keep.write.parquet(f"{out}/kept.parquet")
    page = spark.read.text(dataset.review_sheet(spark, out, 200), wholetext=True)
    lines = page.select(F.posexplode(F.filter(F.split("value", "\n"), lambda x: x.startswith("<tr>"))).alias("place", "html"))
    return lines.select(F.col("place").cast("long").alias("place"), "html")


@_query(f"""+ k AS (SELECT photo_id FROM photos_f JOIN labels_f USING (photo_id) WHERE gate_category = '{KEEP_GATE}')
SELECT 'CSV and Parquet have the same rows' AS name, (SELECT count(*) FROM k WHERE photo_id::BIGINT % 7 = 0) + (SELECT 2 * count(*) FROM k WHERE photo_id::BIGINT % 7 = 1) AS violations""")
def csv_against_parquet(spark: SparkSession, d: str) -> DataFrame:
    """The audit of a staged dataset whose CSV lacks some rows and has others under another id: how many rows differ."""
    at, photos = f"{Scratch(spark, 'differs').path}", X.photos(spark, d)
    vectors = X.embeddings(spark, d).join(photos.select("photo_id"), "photo_id", "left_semi")
    dataset.build(spark, f"{at}/staged", photos, _label_table(spark, d), vectors, since=CUTOFF)
    n = F.col("photo_id").cast("long")
    rows = spark.read.parquet(f"{at}/staged/kept.parquet").where(n % 7 != 0).select(F.when(n % 7 == 1, F.concat("photo_id", F.lit("x"))).otherwise(F.col("photo_id")).alias("photo_id"), "subject")
    files.Folder(spark, f"{at}/staged").delete("kept.csv")
    rows.write.csv(f"{at}/staged/kept.csv", header=True)
    told = [(r.name, r.violations) for r in dataset.findings(spark, f"{at}/staged", f"{at}/published") if r.name.startswith("CSV")]
    return spark.createDataFrame(told, "name string, violations long")


@_query("""SELECT flow, run, run = 1 AND (SELECT count(*) > 0 FROM customer) AS changed FROM unnest(['ingest', 'embed']) AS f(flow), unnest([1, 2]) AS r(run)""")
def told_when_changed(spark: SparkSession, d: str) -> DataFrame:
    """What each flow says of two runs over the same archive: the second one finds nothing new, so nothing after it has to start."""
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("pos"), F.col("c_custkey").cast("string").alias("photo_id"))
    tables, out = _tables(spark), []

    def metadata(photo_id: str) -> str:
        return json.dumps({"id": photo_id, "title": {"_content": "t"}, "description": {"_content": "d"}, "dates": {"taken": ""}})

    for run in (1, 2):
        out.append(("ingest", run, workflows.ingest(tables, ids, metadata, lambda i: (f"{i}.jpg", 1), NOW)))
    for run in (1, 2):
        out.append(("embed", run, workflows.embed(tables, lambda part: [[float(i), 1.0] for i in part], "m", NOW)))
    return spark.createDataFrame(out, "flow string, run int, changed boolean")


@_query(f"""+ k AS (SELECT photo_id, title, modality, image_bytes, {_RELEASE.format('title')} AS release_group FROM photos_f JOIN labels_f USING (photo_id) WHERE gate_category = '{KEEP_GATE}')
SELECT photo_id, release_group, row_number() OVER (PARTITION BY release_group ORDER BY {_RANK}, coalesce(image_bytes, 0) DESC, photo_id) = 1 AS is_primary,
  CASE WHEN photo_id::BIGINT % 11 <> 0 THEN 'images/' || photo_id || '.jpg' END AS image_file, row_number() OVER (ORDER BY photo_id) - 1 AS place FROM k""")
def dataset_flow(spark: SparkSession, d: str) -> DataFrame:
    """The dataset flow from the log to the published table, read where it was published; place is each row's in the file."""
    tables, scratch = _tables(spark, photos=_photo_table(spark, d), embeddings=_vector_table(spark, d)), Scratch(spark, "dataset")
    logs.append(_log_rows(spark, d), f"{scratch.path}/log")
    published = f"{scratch.path}/published"

    def copy(photo_id: str, image_file: str) -> None:
        files.store_file(f"{published}/images", f"{photo_id}.jpg", [b"x"], check=None)

    # vectors of photos that the fixture lacks would fail the audit
    tables.change("embeddings", EMBEDDINGS, lambda e: e.join(grouping.by_rows(X.photos(spark, d).select("photo_id")), "photo_id", "left_semi").select(*EMBEDDINGS.names))
    workflows.publish_dataset(tables, f"{scratch.path}/staged", published, f"{scratch.path}/log", copy=copy, review=20)
    rows = files.read_parts(spark, f"{dataset.published_folder(spark, published)}/kept.parquet")
    return rows.select("photo_id", "release_group", "is_primary", "image_file", "place")


@_query(f"""+ c AS (SELECT count(*) AS photos, count(*) FILTER (gate_category = '{KEEP_GATE}') AS kept, count(*) FILTER (gate_category <> '{KEEP_GATE}') AS by_model,
  count(*) FILTER (gate_category IS NULL AND date_taken < {_CUT}) AS by_rule FROM photos_f LEFT JOIN labels_f USING (photo_id))
SELECT 'kept' AS what, kept AS n FROM c UNION ALL SELECT 'rejected', by_model + by_rule FROM c UNION ALL SELECT 'photos', photos FROM c UNION ALL SELECT 'pending', photos - kept - by_model - by_rule FROM c
UNION ALL SELECT 'rejected by model', by_model FROM c UNION ALL SELECT 'rejected by rule', by_rule FROM c UNION ALL SELECT 'labels', (SELECT count(*) FROM labels_f) UNION ALL SELECT 'same bytes', 4""")
def manifest_file(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of a build as it is read back; a second build's files have the same checksums."""
    scratch = Scratch(spark, "manifest")
    content = X.photos(spark, d), _label_table(spark, d), X.embeddings(spark, d)
    made = [dataset.build(spark, f"{scratch.path}/{k}", *content, since=CUTOFF) for k in range(2)]
    m = files.read_json(files.Folder(spark, f"{scratch.path}/0"), dataset.MANIFEST)
    same = sum(made[1]["sha256"][k] == v for k, v in m["sha256"].items())
    rows = [("kept", m["rows"]["kept"]), ("rejected", m["rows"]["rejected"]), ("photos", m["photos"]), ("pending", m["pending"])]
    rows += [(f"rejected by {k}", m["rejected_by"].get(k, 0)) for k in ("model", "rule")] + [("labels", m["labels"]), ("same bytes", same)]  # the manifest has no class without rows
    return spark.createDataFrame(rows, "what string, n long")


@_query("SELECT c_custkey, trim(c_name) || '/' || c_mktsegment AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0")
def migrations(spark: SparkSession, d: str) -> DataFrame:
    """A table after two runs of migration steps that change it; a step that was done isn't done again."""
    customers = table(spark, d, "customer")
    tables, schema = _tables(spark, customers=customers), customers.schema
    solvent = lambda t: t.change("customers", schema, lambda rows: rows.where("c_acctbal >= 0"))
    renamed = lambda t: t.change("customers", schema, lambda rows: rows.withColumn("c_name", F.concat(F.trim("c_name"), F.lit("/"), "c_mktsegment")))
    state.migrate(tables, [(2, "names", renamed), (1, "balances", solvent)], NOW)
    state.migrate(tables, [(2, "names", renamed), (1, "balances", solvent), (3, "nothing", lambda t: None)], NOW)
    return tables.read("customers", schema)


@_query("""SELECT o_orderkey, o_orderdate, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 400)::INT AS part, true AS same FROM orders""")
def parts_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Sorted parts of a table, each row with its part; the same files, by their tree of checksums, whatever the number of tasks."""
    folder, rows = files.Folder(spark, Scratch(spark, "parts").path), table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    for name, tasks in (("few", 2), ("many", 7)):
        files.write_parts(rows.repartition(tasks), folder, name, "o_orderdate", "o_orderkey", rows=400)
    same = files.checksum(spark, f"{folder.path}/few") == files.checksum(spark, f"{folder.path}/many")
    part = F.regexp_extract(F.col("_metadata.file_path"), r"/part-(\d+)\.parquet$", 1).cast("int")
    return spark.read.parquet(f"{folder.path}/many").withColumn("part", part).withColumn("same", F.lit(same))


@_query("""SELECT lang, source, grouped::BIGINT AS grouped, n, true AS distinct_right, true AS quantiles_right, true AS top_right, true AS like_whole FROM (
  SELECT lang, source, GROUPING(lang, source) AS grouped, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), ()))""")
def merged_sketches(spark: SparkSession, d: str) -> DataFrame:
    """States of four versions of the documents, merged, against exact figures: whether they are within the sketches' error, and as near as those of all rows at once."""
    docs = table(spark, d, "documents").withColumn("first", F.substring_index(F.col("text"), " ", 1))
    sets, by = [("lang", "source"), ("lang",), ()], ["lang", "source", "grouped"]
    versions = [sketches.sketched(docs.where(F.col("doc_id") % 4 == v), sets, "doc_id", "n_chars", "first").withColumn("version", F.lit(v)) for v in range(4)]
    stored = Scratch(spark, "sketches")
    for v, states in enumerate(versions):
        states.write.parquet(f"{stored.path}/states/version={v}")
    states = spark.read.parquet(f"{stored.path}/states")
    told = sketches.estimates(sketches.merged(states, *by)).alias("t")
    whole = sketches.estimates(sketches.sketched(docs, sets, "doc_id", "n_chars", "first")).alias("w")
    counts = docs.groupingSets([[F.col(c) for c in s] for s in [*sets]], "lang", "source").agg(
        F.grouping_id().alias("grouped"), F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.percentile_approx("n_chars", F.lit([0.08, 0.12, 0.48, 0.52, 0.88, 0.92]), 100_000).alias("q"), F.mode("first", True).alias("mode")
    ).alias("c")
    same = lambda a, b: (F.col(f"{a}.grouped") == F.col(f"{b}.grouped")) & F.col(f"{a}.lang").eqNullSafe(F.col(f"{b}.lang")) & F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    both = told.join(counts, same("t", "c")).join(whole, same("t", "w"))
    near = lambda a, b: F.abs(a - b) <= F.greatest(F.lit(1.0), 0.07 * F.col("c.ids"))  # noqa: E731  four standard errors
    between = [(F.col("t.quantiles")[i] >= F.col("c.q")[2 * i]) & (F.col("t.quantiles")[i] <= F.col("c.q")[2 * i + 1]) for i in range(3)]
    return both.select(
        "t.lang", "t.source", F.col("t.grouped").cast("long").alias("grouped"), F.col("t.rows").alias("n"), near(F.col("t.distinct"), F.col("c.ids")).alias("distinct_right"),
        (between[0] & between[1] & between[2]).alias("quantiles_right"), ((F.col("c.n") < 40) | F.exists("t.top", lambda x: x["item"] == F.col("c.mode"))).alias("top_right"), near(F.col("t.distinct"), F.col("w.distinct")).alias("like_whole"),
    )


@_query("SELECT photo_id FROM labels_f WHERE photo_id::BIGINT % 3 <> 0 OR photo_id::BIGINT % 4 = 0")
def errors_cleared(spark: SparkSession, d: str) -> DataFrame:
    """Embedding errors without those of photos that were downloaded anew; failed downloads clear nothing."""
    n = F.col("photo_id").cast("long")
    errors = X.labels(spark, d).select("photo_id")
    results = X.photos(spark, d).where(n % 3 == 0).select("photo_id", F.when(n % 4 == 0, "timeout").alias("error"))
    return state.clear_errors(errors, results)


@_query("""SELECT photo_id FROM photos_f WHERE photo_id IN (SELECT photo_id FROM labels_f) AND photo_id::BIGINT % 5 <> 0""")
def images_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Copies that are left when those of photos that aren't kept are deleted."""
    n, published = F.col("photo_id").cast("long"), f"{Scratch(spark, 'prune').path}/published"
    ids = X.labels(spark, d).join(X.photos(spark, d).select("photo_id"), "photo_id", "left_semi").select("photo_id")
    staged = f"{published}-staged"
    ids.where(n % 5 != 0).write.parquet(f"{staged}/kept.parquet")
    dataset.publish(spark, staged, published)

    def write(frames):
        for frame in frames:
            for photo_id in frame["photo_id"]:
                files.store_file(f"{published}/images", f"{photo_id}.jpg", [b"x"], check=None)
            yield frame

    # few bytes, but a file for each: they are dealt to all tasks
    ids.repartition(spark.sparkContext.defaultParallelism).mapInPandas(write, "photo_id string").write.format("noop").mode("overwrite").save()
    dataset.prune_images(spark, published, files.images(spark, f"{published}/images"))
    return files.images(spark, f"{published}/images").select("photo_id")


@_query(f"SELECT photo_id, row_number() OVER (ORDER BY photo_id::BIGINT DESC) AS place FROM labels_f JOIN photos_f USING (photo_id) WHERE gate_category = '{KEEP_GATE}' ORDER BY photo_id::BIGINT DESC LIMIT 7")
def gallery_order(spark: SparkSession, d: str) -> DataFrame:
    """Captions of a list of ids in the list's order; place is a row's place in the result."""
    rows = X.photos(spark, d).join(X.labels(spark, d).where(F.col("gate_category") == KEEP_GATE), "photo_id").withColumn("object_name_normalized", F.lit("n"))
    wanted = [r.photo_id for r in rows.orderBy(F.col("photo_id").cast("long").desc()).limit(7).select("photo_id").collect()]
    return dataset.gallery(rows, wanted).select("photo_id", F.col("place").cast("long").alias("place"))


@_query("SELECT photo_id FROM photos_f WHERE image_file IS NOT NULL")
def no_limit(spark: SparkSession, d: str) -> DataFrame:
    """A limit of 0 is no limit for embeddings."""
    none = spark.createDataFrame([], "photo_id string")
    return planning.pending_embeddings(X.photos(spark, d), none, none, 0)


# Single functions.


@_query(rf"""SELECT page_id, substr(html, 1, 500) AS error, replace(url, 'example', '***') AS redacted, regexp_replace(url, '[^\p{{L}}\p{{N}}_-]', '_', 'g') AS run_id,
  replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped, regexp_replace(url || '.jpg', '\.jpg$', '') AS stem, base64(encode(html)) AS b64 FROM pages""")
def text_helpers(spark: SparkSession, d: str) -> DataFrame:
    url, html = F.col("url"), F.col("html")
    return table(spark, d, "pages").select(
        "page_id", T.short_error(html).alias("error"), T.redact(url, "example").alias("redacted"), T.safe_run_id(url).alias("run_id"), T.html_escape(html).alias("escaped"),
        T.stem(F.concat(url, F.lit(".jpg"))).alias("stem"), T.base64(html).alias("b64"),
    )


_SAID = ("seen with NIRCam", "by the Near-Infrared Camera and MIRI", "a fine guidance sensor image", "mid infrared instrument, NIRSpec &amp; niriss", "nothing named")
_SAID_SQL = "[" + ", ".join(f"'{s}'" for s in _SAID) + "][doc_id % 5 + 1]"
_FOUND_SQL = "[" + ", ".join(f"'{s}'" for s in ("NIRCam", "NIRCam|MIRI", "FGS", "MIRI|NIRSpec|NIRISS", "")) + "][doc_id % 5 + 1]"


@_query(f"""SELECT doc_id, {_FOUND_SQL} AS named, CASE WHEN doc_id % 3 = 0 THEN 'NIRSpec' WHEN doc_id % 5 IN (1, 3) THEN 'multiple' WHEN doc_id % 5 = 0 THEN 'NIRCam' WHEN doc_id % 5 = 2 THEN 'FGS' ELSE 'unknown' END AS fixed FROM documents""")
def instruments_named(spark: SparkSession, d: str) -> DataFrame:
    """Instruments that title and caption name, and what `multiple` becomes."""
    i = F.col("doc_id")
    said = F.element_at(F.array(*map(F.lit, _SAID)), (i % 5 + 1).cast("int"))
    rows = table(spark, d, "documents").select(i, F.when(i % 2 == 0, said).alias("title"), F.when(i % 2 == 1, F.concat(F.lit("<b>"), said, F.lit("</b> "))).alias("description"))
    named = rows.select(i, T.named_instruments(F.col("title"), F.col("description")).alias("named"))
    return named.select(i, F.array_join("named", "|").alias("named"), T.correct_instrument(F.when(i % 3 == 0, "NIRSpec").otherwise("multiple"), F.col("named")).alias("fixed"))


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END::TIMESTAMP AS taken FROM orders")
def timestamps(spark: SparkSession, d: str) -> DataFrame:
    """Dates from text; empty text is no date."""
    text = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, d, "orders").select("o_orderkey", V.timestamp(text).alias("taken"))


@_query("SELECT vec_id, len(embedding) AS dim, list_sum(embedding::DOUBLE[]) > 0 AS positive FROM embeddings")
def fixed_vectors(spark: SparkSession, d: str) -> DataFrame:
    vector = V.as_vector(F.col("embedding"), 64)
    return table(spark, d, "embeddings").select("vec_id", F.size(vector).alias("dim"), (F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double")) > 0).alias("positive"))


_SIZES = ("Thumbnail", "Medium", "Large", "Original", "Small", "Medium 640", "Large")


@_query(f"""WITH s AS (SELECT l_orderkey, list({{'label': {list(_SIZES)}[(l_partkey % 7 + 1)::INT], 'source': l_linenumber}} ORDER BY l_linenumber) AS sizes FROM lineitem GROUP BY 1)
SELECT l_orderkey, coalesce({', '.join(f"list_filter(sizes, lambda x: x.label = '{label}')[-1].source" for label in V.SIZE_PREFERENCE)}, sizes[-1].source)::VARCHAR AS source FROM s""")
def preferred_size(spark: SparkSession, d: str) -> DataFrame:
    """The best of an array of image sizes."""
    label = F.element_at(F.array(*map(F.lit, _SIZES)), (F.col("l_partkey") % 7 + 1).cast("int"))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", label.alias("label"), F.col("l_linenumber").cast("string").alias("source")))).alias("sizes"))
    return rows.select("l_orderkey", V.pick_preferred(F.col("sizes")).alias("source"))


@_query("SELECT part, count(*) AS attempts, count(*) FILTER (bad) AS failures, count(*) >= 5 AND count(*) FILTER (bad) >= 0.5 * count(*) AS stop FROM (SELECT user_id % 50 AS part, event_type = 'click' AS bad FROM events) GROUP BY 1")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    """Attempts and failures by group, and whether such a run should stop."""
    rows = table(spark, d, "events").groupBy((F.col("user_id") % 50).alias("part")).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("event_type") == "click").alias("failures"))
    told = [(r.part, r.attempts, r.failures, planning.failing(r.attempts, r.failures)) for r in rows.collect()]  # 50 groups
    return spark.createDataFrame(told, "part long, attempts long, failures long, stop boolean")


_K = f"""k AS (SELECT p.*, l.* EXCLUDE (photo_id), CASE WHEN p.photo_id::BIGINT % 9 = 0 THEN 'comet' ELSE subject END AS said FROM photos_f p JOIN labels_f l USING (photo_id) WHERE gate_category = '{KEEP_GATE}'),
  r AS (SELECT photo_id, CASE WHEN photo_id::BIGINT % 4 = 0 THEN 'nobody' ELSE 'model' END AS rejected_by FROM photos_f JOIN labels_f USING (photo_id) WHERE gate_category <> '{KEEP_GATE}'
    UNION ALL SELECT photo_id, 'rule' FROM k WHERE photo_id::BIGINT % 10 = 0)"""


@_query(f"""+ {_K}
SELECT 'there are kept rows' AS name, 'error' AS severity, (SELECT (count(*) = 0)::BIGINT FROM k) AS violations
UNION ALL SELECT 'photo_id is unique', 'error', 0
UNION ALL SELECT 'no photo is kept and rejected', 'error', (SELECT count(*) FROM k WHERE photo_id::BIGINT % 10 = 0)
UNION ALL SELECT 'kept, rejected and pending are all photos', 'error', (SELECT abs((SELECT count(*) FROM k) + (SELECT count(*) FROM r) + 5 - (SELECT count(*) FROM photos_f)))
UNION ALL SELECT 'a rejected row says by what', 'error', (SELECT count(*) FROM r WHERE rejected_by = 'nobody')
UNION ALL SELECT 'subject is in the codebook', 'error', (SELECT count(*) FROM k WHERE said NOT IN ({', '.join(f"'{s}'" for s in SUBJECTS if s != 'not_applicable')}))
UNION ALL SELECT 'modality is in the codebook', 'error', (SELECT count(*) FROM k WHERE modality NOT IN ({', '.join(f"'{s}'" for s in MODALITIES[:2])}))
UNION ALL SELECT 'instrument is in the codebook', 'error', (SELECT count(*) FROM k WHERE instrument NOT IN ({', '.join(f"'{s}'" for s in ENUMS['instrument'])}))
UNION ALL SELECT 'a release has one primary', 'error', (SELECT count(*) FROM (SELECT photo_id::BIGINT % 20 AS g FROM k GROUP BY 1 HAVING count(*) FILTER (photo_id::BIGINT % 40 < 20) <> 1))
UNION ALL SELECT 'an object name is in its text', 'warn', (SELECT count(*) FROM k WHERE photo_id::BIGINT % 3 = 0)
UNION ALL SELECT 'a row has an embedding', 'warn', (SELECT count(*) FROM k WHERE photo_id::BIGINT % 5 = 0)
UNION ALL SELECT 'a row has a small image', 'warn', (SELECT count(*) FROM k WHERE image_file IS NULL)
UNION ALL SELECT 'rows are not fewer than published', 'warn', (SELECT greatest(1000000 - count(*), 0) FROM k)
UNION ALL SELECT 'image files exist', 'error', (SELECT count(*) FROM photos_f WHERE image_file IS NOT NULL AND photo_id::BIGINT % 6 = 0)
UNION ALL SELECT 'photos could not be embedded', 'warn', (SELECT count(*) FROM labels_f)
UNION ALL SELECT 'an embedding has a photo', 'error', (SELECT count(*) FROM embeddings_f ANTI JOIN (SELECT photo_id FROM photos_f WHERE photo_id::BIGINT % 8 <> 0) USING (photo_id))""")
def dataset_checks(spark: SparkSession, d: str) -> DataFrame:
    """The checks of a dataset, and others, over tables with seeded faults, as one plan."""
    photos, labels, n = X.photos(spark, d), X.labels(spark, d), F.col("photo_id").cast("long")
    both = photos.join(labels, "photo_id")
    kept = both.where(F.col("gate_category") == KEEP_GATE).withColumn("subject", F.when(n % 9 == 0, "comet").otherwise(F.col("subject")))
    kept = kept.withColumn("modality", F.when(F.col("modality").isin(*MODALITIES[:2]), F.col("modality")).otherwise("hologram")).withColumn("release_group", n % 20).withColumn("is_primary", n % 40 < 20)
    kept = kept.withColumn("object_name_verified", n % 3 != 0).withColumn("has_embedding", n % 5 != 0)
    no = both.where(F.col("gate_category") != KEEP_GATE).select("photo_id", F.when(n % 4 == 0, "nobody").otherwise("model").alias("rejected_by"))
    no = no.unionByName(kept.where(n % 10 == 0).select("photo_id", F.lit("rule").alias("rejected_by")))
    tables = {"kept": kept, "rejected": no, "files": photos.where(n % 6 != 0).select("image_file"), "embedding_errors": labels, "embeddings": X.embeddings(spark, d)}
    checks = [*quality.dataset_checks(5, photos.count(), 1_000_000, allow_shrink=True), quality.file_check(), *(c for c in quality.embedding_checks() if c.table == "embedding_errors")]
    rest = quality.frame([c for c in quality.embedding_checks() if c.needs], {"embeddings": tables["embeddings"], "photos": photos.where(n % 8 != 0)})
    return quality.frame(checks, tables | {"photos": photos}).unionByName(rest).drop("place")


@_query(f"""+ d AS (SELECT photo_id, title, regexp_replace({_UNESCAPED.replace('html', 'description')}, '^\\s+|\\s+$', '', 'g') AS caption FROM photos_f)
SELECT photo_id, md5('TITLE: ' || title || chr(10) || chr(10) || 'CAPTION: ' || substr(caption, 1, 100)) AS prompt FROM d""")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    """What a labeller reads of each photo."""
    return X.photos(spark, d).select("photo_id", F.md5(T.user_text(F.col("title"), F.col("description"), 100).cast("binary")).alias("prompt"))


# Tables of changes.


def _changed(spark: SparkSession, d: str) -> ChangeTable:
    """Orders after a load, two batches of upserts and one of deletions."""
    orders = table(spark, d, "orders")
    found = ChangeTable(_tables(spark), "orders", orders.schema, "o_orderkey")
    found.write(orders)
    found.compact()
    k = F.col("o_orderkey")
    found.change(orders.where(k % 100 == 1), lambda old: old.withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") + 1))
    found.write(orders.where(k % 100 == 2).withColumn("o_orderkey", k + 10_000_000).unionByName(orders.where(k % 300 == 1).withColumn("o_orderstatus", F.lit("Y"))), gone=orders.where(k % 50 == 3))
    return found


_CHANGED = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 300 = 1 THEN 'Y' WHEN o_orderkey % 100 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice + CASE WHEN o_orderkey % 100 = 1 AND o_orderkey % 300 <> 1 THEN 1 ELSE 0 END AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 50 <> 3
UNION ALL SELECT o_orderkey + 10000000, * EXCLUDE (o_orderkey) FROM orders WHERE o_orderkey % 100 = 2"""


@_query(_CHANGED)
def merged_on_read(spark: SparkSession, d: str) -> DataFrame:
    """A table with its change files merged in."""
    return _changed(spark, d).read()


@_query(f"SELECT * FROM ({_CHANGED}) WHERE o_orderkey % 7 <> 0")
def compacted(spark: SparkSession, d: str) -> DataFrame:
    """The same after further deletions, a compaction of all changed buckets and a vacuum."""
    found = _changed(spark, d)
    found.write(gone=found.read().where(F.col("o_orderkey") % 7 == 0))
    found.compact(0.0)
    found.vacuum()
    return found.read()


@_query(f"""+ seen AS (SELECT doc_id::VARCHAR AS photo_id FROM documents WHERE doc_id % 10 = 0 UNION SELECT (doc_id + 10000000)::VARCHAR FROM documents WHERE doc_id % 10 = 0)
SELECT photo_id, CASE WHEN s.photo_id IS NOT NULL THEN 'again ' || photo_id ELSE title END AS title, CASE WHEN s.photo_id IS NOT NULL THEN {_NOW} END AS last_seen_at,
  CASE WHEN p.photo_id IS NULL THEN {_NOW} ELSE TIMESTAMP '2020-01-01' END AS first_seen_at, coalesce(download_attempts, 0) AS download_attempts FROM photos_f p FULL JOIN seen s USING (photo_id)""")
def merged_photos(spark: SparkSession, d: str) -> DataFrame:
    """The photo table after an upsert of a listing that writes only the photos listed."""
    photos = _photo_table(spark, d)
    found = ChangeTable(_tables(spark), "photos", PHOTOS, "photo_id")
    found.write(photos)
    known = photos.where(F.col("photo_id").cast("long") % 10 == 0)
    listed = known.unionByName(known.withColumn("photo_id", (F.col("photo_id").cast("long") + 10_000_000).cast("string")))
    listed = listed.withColumn("title", F.concat(F.lit("again "), "photo_id")).withColumn("pos", F.lit(0))
    found.change(listed, lambda old: state.upsert_photos(old, listed, NOW))
    return found.read().select("photo_id", "title", "last_seen_at", "first_seen_at", "download_attempts")


# Joins and frames over an order.


@_query("""SELECT e.event_id, e.user_id, p.ts AS last_ts, coalesce(p.event_id, -1) AS last_id, p.value AS last_value FROM events e
  ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def last_purchase(spark: SparkSession, d: str) -> DataFrame:
    """Each event with its user's last purchase so far."""
    events = table(spark, d, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("ts").alias("last_ts"), F.col("event_id").alias("last_id"), F.col("value").alias("last_value"))
    return ordered.as_of(events.select("event_id", "user_id", "ts"), bought, "user_id", "ts").drop("ts").withColumn("last_id", F.coalesce("last_id", F.lit(-1)))


@_query("""WITH r AS (SELECT o_orderstatus, o_orderdate, max(o_orderkey) AS version FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
SELECT l.o_orderkey, l.o_orderstatus, coalesce(r.version, -1) AS version FROM orders l ASOF LEFT JOIN r ON l.o_orderstatus = r.o_orderstatus AND l.o_orderdate >= r.o_orderdate""")
def version_in_force(spark: SparkSession, d: str) -> DataFrame:
    """For each order the last urgent one of its status, of few keys with many rows each, which are cut."""
    orders = table(spark, d, "orders")
    versions = orders.where("o_orderpriority = '1-URGENT'").select("o_orderstatus", "o_orderdate", F.col("o_orderkey").alias("version"))
    return ordered.as_of(orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), versions, "o_orderstatus", "o_orderdate", most=500).select("o_orderkey", "o_orderstatus", F.coalesce("version", F.lit(-1)).alias("version"))


_SPANS = """SELECT event_id AS span, ts AS opened, ts + INTERVAL 2 HOURS AS closed FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT -1 - row_number() OVER (ORDER BY event_type), min(ts), max(ts) FROM events GROUP BY event_type"""


@_query(f"SELECT span, count(*) AS n, min(e.event_id) AS first, max(ts) AS latest FROM ({_SPANS}) s JOIN events e ON ts >= opened AND ts < closed GROUP BY span")
def events_within(spark: SparkSession, d: str) -> DataFrame:
    """Events within the two hours after each purchase, and within the long time that each type was seen, counted."""
    events, hours = table(spark, d, "events"), F.expr("INTERVAL 2 HOURS")
    short = events.where("event_type = 'purchase'").select(F.col("event_id").alias("span"), F.col("ts").alias("opened"), (F.col("ts") + hours).alias("closed"))
    types = events.groupBy("event_type").agg(F.min("ts").alias("opened"), F.max("ts").alias("closed"))
    long = types.select((-1 - F.row_number().over(Window.orderBy(F.col("event_type").asc_nulls_last()))).cast("long").alias("span"), "opened", "closed")  # a row for each type
    # events of one moment are in the same spans, and spans of the same two moments hold the same events: each is looked at once
    spans, moments = short.unionByName(long), events.groupBy("ts").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))
    totals = ordered.totals_in_ranges(moments, spans, "ts", "opened", "closed", "n", "first").withColumnRenamed("ts", "latest")
    return spans.join(totals, ["opened", "closed"]).groupBy("span").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("latest").alias("latest"))


@_query("""WITH e AS (SELECT event_id, user_id, ts, round(value * 100)::BIGINT AS cents FROM events)
SELECT event_id, coalesce(lag(cents, 3) OVER w, -1) AS before3, coalesce(lead(user_id, 2) OVER w, -1) AS after2, (sum(cents) OVER (w ROWS BETWEEN 50 PRECEDING AND 10 FOLLOWING))::BIGINT AS around,
  min(cents) OVER (w ROWS BETWEEN 50 PRECEDING AND 10 FOLLOWING) AS least, (sum(cents) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS so_far FROM e WINDOW w AS (ORDER BY ts, event_id)""")
def frames_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Frames over all events in one order, of blocks of 300."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    whole = ordered.TotalOrder(events, "ts", "event_id", block=300)
    parts = [
        whole.lagged(3, before3="cents").select("event_id", "before3"), whole.lagged(-2, after2="user_id").select("event_id", "after2"),
        whole.rolling(50, 10, around=F.sum("cents"), least=F.min("cents")).select("event_id", "around", "least"), whole.running(so_far="cents").select("event_id", "so_far"),
    ]
    return parts[0].join(parts[1], "event_id").join(parts[2], "event_id").join(parts[3], "event_id").fillna(-1)


@_query("""SELECT o_orderkey, row_number() OVER k AS row_number, ntile(7) OVER k AS ntile, rank() OVER d AS rank, percent_rank() OVER d AS percent_rank, cume_dist() OVER d AS cume_dist FROM orders
  WINDOW k AS (ORDER BY o_orderdate, o_orderkey), d AS (ORDER BY o_orderdate)""")
def ranks_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Ranks of all orders by date, in which many are equal."""
    whole = ordered.TotalOrder(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", block=1000)
    return whole.ranks("o_orderdate", tiles=7).drop("o_orderdate").withColumns({c: F.col(c).cast("long") for c in ("row_number", "ntile", "rank")})
