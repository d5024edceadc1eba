"""The four flows: ingest, embed, label and dataset. Each plans from tables, not from what an earlier step returned.

The models and the archive's transport are passed in; a flow returns whether something changed, which is what a scheduler needs to start the next.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curatrix.functions.text import safe_run_id, user_text
from curatrix.functions.values import half_even
from curatrix.operators import planning, quality, state
from curatrix.operators.grouping import by_rows, numbered
from curatrix.operators.state import Tables
from curatrix.plans import dataset
from curatrix.schemas import CODEBOOK_VERSION, EMBEDDING_ERRORS, EMBEDDINGS, LABELS, LOG_RECORD, PHOTOS
from curatrix.scratch import Scratch
from curatrix.sources import api, files, logs


def ingest(
    tables: Tables, ids: DataFrame | Iterable[tuple[int, str]], metadata: Callable[[str], str], download: Callable[[str], tuple[str, int]], now: datetime,
    migrations: list | None = None, files: Callable[[], DataFrame] | None = None,
) -> bool:
    """Migrate, list, stamp, fetch what is new, upsert, download what is missing, record, check.

    ids: (pos, photo_id) as a table, as api.listing gives it, or one by one. Other writers wait only while a table changes, not while something is fetched. files gives the stored images (image_file), to
    check that the photos' files exist."""
    spark = tables.spark
    state.migrate(tables, migrations or [], now)
    seen = api.first_places(spark, ids)
    tables.change("photos", PHOTOS, lambda photos: state.touch_seen(photos, seen, now))
    fresh = Scratch(spark, "ingest").keep(planning.new_ids(seen, tables.read("photos", PHOTOS)), "new")
    fetched = Scratch(spark, "ingest").keep(api.fetch(fresh, metadata), "payloads")
    tables.change("photos", PHOTOS, lambda photos: state.upsert_photos(photos, api.metadata(fetched).withColumn("pos", F.lit(0)), now))
    done = fetch_files(planning.pending_downloads(tables.read("photos", PHOTOS)), download).withColumn("pos", F.lit(0))
    done = Scratch(spark, "ingest").keep(done, "files")
    tally = done.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("bad")).first()
    if tally.n:
        with tables.writing():
            photos, errors = tables.read("photos", PHOTOS), tables.read("embedding_errors", EMBEDDING_ERRORS)
            tables.commit_all({"photos": state.record_downloads(photos, done, now), "embedding_errors": state.clear_errors(errors, done)})
    if tally.n and tally.n == tally.bad:
        raise api.SourceError("every download failed")
    checks, checked = quality.photo_checks(), {"photos": tables.read("photos", PHOTOS)}
    if files is not None:
        checks, checked = [*checks, quality.file_check()], checked | {"files": files()}
    quality.run(checks, checked, "photos")
    return tally.n > tally.bad or not fresh.isEmpty()


def fetch_files(ids: DataFrame, download: Callable[[str], tuple[str, int]]) -> DataFrame:
    """photo_id, image_file, image_bytes and error: a failure is a row."""

    def work(frames):
        for frame in frames:
            rows = []
            for photo_id in frame["photo_id"]:
                try:
                    rows.append((photo_id, *download(photo_id), None))
                except Exception as e:  # noqa: BLE001  told in the row
                    rows.append((photo_id, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["photo_id", "image_file", "image_bytes", "error"]).astype({"image_bytes": "Int64"})

    return ids.mapInPandas(work, "photo_id string, image_file string, image_bytes long, error string")


def vectors(ids: DataFrame, model: Callable[[list[str]], list], batch: int) -> DataFrame:
    """photo_id, vector and error, `batch` ids at a time; model returns a vector or an exception for each.

    If a whole batch fails, its ids are tried one by one, so that one of them doesn't take the others with it."""

    def tried(part: list[str]) -> list:
        try:
            return model(part)
        except Exception as e:  # noqa: BLE001  told in the row
            return [e] if len(part) == 1 else [x for one in part for x in tried([one])]

    def work(frames):
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame["photo_id"].iloc[at : at + batch].tolist()
                got = tried(part)
                yield pd.DataFrame({"photo_id": part, "vector": [None if isinstance(g, Exception) else [float(x) for x in g] for g in got], "error": [str(g) if isinstance(g, Exception) else None for g in got]})

    return ids.mapInPandas(work, "photo_id string, vector array<float>, error string")


def store(tables: Tables, staged: DataFrame, name: str, now: datetime) -> tuple[int, int]:
    """Load staged (photo_id, vector, error, pos) into embeddings and embedding_errors in one commit.

    Returns how many rows with a vector and how many with an error were staged, repeats included."""
    tally = staged.agg(F.count("vector").alias("good"), F.count_if(F.col("vector").isNull()).alias("bad")).first()
    good, bad = state.staged_vectors(staged, name, now)
    with tables.writing():
        old, errors = tables.read("embeddings", EMBEDDINGS), tables.read("embedding_errors", EMBEDDING_ERRORS)
        tables.commit_all({"embeddings": state.replace_rows(old, good), "embedding_errors": state.replace_rows(errors, bad)})
    return tally.good, tally.bad


def embed(tables: Tables, model: Callable[[list[str]], list], name: str, now: datetime, batch: int = 32) -> bool:
    """Vectors for what has none; failures are rows of embedding_errors."""
    photos = tables.read("photos", PHOTOS)
    todo = planning.pending_embeddings(photos, tables.read("embeddings", EMBEDDINGS), tables.read("embedding_errors", EMBEDDING_ERRORS))
    if todo.isEmpty():
        return False
    # written once: the model isn't asked again
    staged = Scratch(tables.spark, "embed").keep(vectors(todo, model, batch).withColumn("pos", F.lit(0)), "staged")
    store(tables, staged, name, now)
    quality.run(quality.embedding_checks(), {"photos": photos, "embeddings": tables.read("embeddings", EMBEDDINGS), "embedding_errors": tables.read("embedding_errors", EMBEDDING_ERRORS)}, "embeddings")
    return True


class LabelRunError(RuntimeError):
    """Too many calls of a run failed: how many were made, how many failed, and the first failure seen."""

    def __init__(self, made: int, failed: int, example: str | None) -> None:
        super().__init__(f"{failed} of {made} calls failed: {example}")
        self.made, self.failed = made, failed


#: Waves of so many calls at most share a job, and so many calls at most are made in such a job.
SMALL_WAVE, LANE = 1_000, 10_000


def label_records(queue: DataFrame, labeller: Callable[..., dict], model: str, backend: str, image: Callable[[str], bytes] | None = None, least: int | None = 5) -> DataFrame:
    """Log records of a queue of photos, with `error`: one photo's failure is a row, and other calls' results are kept.

    labeller reads the prompt text, and with `image` the base64 of image(photo_id), and returns the label's fields and usage. A task in
    which at least `least` calls were made and half of them failed makes no more; without `least` all are made."""

    def work(frames):
        made = bad = 0
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                if least is not None and planning.failing(made, bad, least):
                    rows.append(dict.fromkeys(LOG_RECORD.names) | {"photo_id": r.photo_id, "error": "not tried"})
                    continue
                rows.append(_called(r, labeller, model, backend, image))
                made, bad = made + 1, bad + (rows[-1]["error"] is not None)
            yield _record_frame(rows)

    return _asked(queue).mapInPandas(work, _RECORD_OR_ERROR).withColumn("seconds", half_even(F.col("seconds")))


_RECORD_OR_ERROR = StructType([*LOG_RECORD.fields, StructField("error", StringType())])


def _asked(queue: DataFrame, *more: str) -> DataFrame:
    return queue.select(*more, "photo_id", "title", user_text(F.col("title"), F.col("description")).alias("prompt"))


def _called(r, labeller: Callable[..., dict], model: str, backend: str, image: Callable[[str], bytes] | None) -> dict:
    """The record of one call; a failure is its error."""
    row = dict.fromkeys(LOG_RECORD.names) | {"photo_id": r.photo_id, "error": None}
    try:
        got = labeller(r.prompt, base64.b64encode(image(r.photo_id)).decode()) if image else labeller(r.prompt)
        return row | {f.name: got.get(f.name) for f in LOG_RECORD.fields} | {"photo_id": r.photo_id, "title": r.title, "model": model, "backend": backend, "vision": image is not None, "codebook_version": CODEBOOK_VERSION}
    except Exception as e:  # noqa: BLE001  told in the row
        return row | {"error": f"{type(e).__name__}: {e}"}


def _record_frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[*LOG_RECORD.names, "error"]).astype({c: "Int32" for c in ("prompt_tokens", "output_tokens", "cache_read_tokens")} | {"vision": "boolean"})


def _lane(part: DataFrame, sizes: list[int], made: int, bad: int, least: int, calls: int, labeller: Callable[..., dict], model: str, backend: str, image: Callable[[str], bytes] | None) -> DataFrame:
    """Records, with `error`, of waves of these sizes, one after the other in one task, `calls` calls at a time, until the run's tally says stop.

    part has the rows of all these waves; made and bad are the run's tally so far. What isn't called has no row."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, failed, left, waiting = made, bad, iter(sizes), []
        size = next(left)
        with ThreadPoolExecutor(calls) as pool:
            for frame in frames:
                waiting += frame.itertuples(index=False)
                while size and len(waiting) >= size and not planning.failing(done, failed, least):
                    rows = list(pool.map(lambda r: _called(r, labeller, model, backend, image), waiting[:size]))
                    waiting, done, failed = waiting[size:], done + size, failed + sum(r["error"] is not None for r in rows)
                    size = next(left, 0)
                    yield _record_frame(rows)
                if planning.failing(done, failed, least):
                    return

    one = part.coalesce(1).sortWithinPartitions("place")
    return _asked(one).mapInPandas(work, _RECORD_OR_ERROR).withColumn("seconds", half_even(F.col("seconds")))


def label(tables: Tables, log: str, labeller: Callable[..., dict], model: str, backend: str, limit: int = 100, image: Callable[[str], bytes] | None = None, least: int = 5, wave: int = 10_000) -> int:
    """Label what is neither labelled nor in the log, and append it to the log; returns how many records were added.

    Calls are made in waves in the order of the queue: `least`, then as many as were made before, `wave` at most. After each wave
    the tally of the whole run decides whether there is a next one. Waves of more than SMALL_WAVE calls are dealt to all tasks and are in the log before the next
    one; smaller ones follow one another in one task, that makes as many calls at a time as there are tasks (labeller and image have to bear that), and are in
    the log after LANE calls at most. So however many tasks there are, a run that fails makes at most twice
    as many calls as it takes to see that, and never more than `wave` beyond."""
    spark, scratch = tables.spark, Scratch(tables.spark, "labels")
    done = logs.read_log(spark, log).select("photo_id")
    queue = planning.label_queue(tables.read("photos", PHOTOS), tables.read("labels", LABELS), done, limit).select("photo_id", "title", "description")
    queue = scratch.keep(numbered(queue, "photo_id", "place"), "queue")
    waiting, tasks = queue.count(), spark.sparkContext.defaultParallelism
    made = bad = 0
    example = None
    while made < waiting:
        sizes, ahead = [], made
        while ahead < waiting and (size := min(max(ahead, least, 1), wave)) <= SMALL_WAVE and ahead + size - made <= LANE:
            sizes.append(min(size, waiting - ahead))
            ahead += sizes[-1]
        size = ahead - made if sizes else size
        part = queue.where((F.col("place") >= made) & (F.col("place") < made + size))
        if sizes:
            records = _lane(part, sizes, made, bad, least, tasks, labeller, model, backend, image)
        else:
            records = label_records(part.repartition(min(size, tasks), "photo_id"), labeller, model, backend, image, None)
        staged = scratch.keep(records, f"wave-{made}")
        good = staged.where("error is null").drop("error")
        tally = staged.agg(F.count(F.lit(1)).alias("made"), F.count("error").alias("bad"), F.min("error").alias("example")).first()
        if tally.made > tally.bad:
            logs.append(good, log)
        made, bad, example = made + tally.made, bad + tally.bad, example or tally.example
        if planning.failing(made, bad, least):
            raise LabelRunError(made, bad, example)
    return made - bad


def load_labels(tables: Tables, records: DataFrame) -> int:
    """The labels table anew from the log; an invalid log leaves it as it is."""
    return tables.commit("labels", logs.project(records))


def publish_dataset(
    tables: Tables, staging: str, published: str, log: str | None = None, allow_shrink: bool = False,
    copy: Callable[[str, str], None] | None = None, review: int = 0, run_id: str = "run",
) -> dict:
    """Load and check labels, build to a staging folder of this run, copy images, audit, publish, prune, write the review sheet.

    log: the label log that the labels table is made from anew. copy(photo_id, image_file) puts a small image into the
    published folder's images; copies are named by photo_id and only added, so they aren't staged."""
    spark = tables.spark
    if log is not None:
        load_labels(tables, logs.read_log(spark, log))
    photos, labels = tables.read("photos", PHOTOS), tables.read("labels", LABELS)
    quality.run(quality.label_checks(), {"photos": photos, "labels": labels}, "labels")
    safe = spark.range(1).select(safe_run_id(F.lit(run_id))).first()[0]
    staged, copies = f"{staging}/{safe}", f"{published}/images"

    def build() -> dict:
        files.Folder(spark, staged).delete()
        return dataset.build(spark, staged, photos, labels, tables.read("embeddings", EMBEDDINGS), files.images(spark, copies))

    manifest = build()
    if copy is not None:
        wanted = spark.read.parquet(f"{staged}/kept.parquet").select("photo_id").join(by_rows(photos.select("photo_id", "image_file")), "photo_id")
        states = Scratch(spark, "images").keep(dataset.write_images(wanted, files.images(spark, copies), copy), "states")
        if dataset.image_tally(states).first().written:
            manifest = build()  # with the copies that there are now
    dataset.audit(spark, staged, published, allow_shrink)
    out = dataset.publish(spark, staged, published)
    dataset.prune_images(spark, published, files.images(spark, copies))
    dataset.review_sheet(spark, out, review)
    return manifest
