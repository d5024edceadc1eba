"""Changes of state tables: each gives the next snapshot from the last one; nothing is updated in place."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curatrix.functions.text import short_error
from curatrix.operators.grouping import latest
from curatrix.schemas import MIGRATIONS


def _ntz(now: datetime):
    return F.lit(now).cast("timestamp_ntz")


def upsert_photos(photos: DataFrame, incoming: DataFrame, now: datetime, position: str = "pos") -> DataFrame:
    """New rows are added; of known ones title, description, tags, date_taken and last_seen_at change. The last row of an id wins."""
    new = latest(incoming.select("photo_id", "title", "description", "tags", "date_taken", position), "photo_id", position).drop(position)
    fresh = new.select(F.col("photo_id").alias("id"), *(F.col(c).alias(f"new_{c}") for c in ("title", "description", "tags", "date_taken")))
    both = photos.join(fresh, F.col("photo_id") == F.col("id"), "full")
    came = F.col("id").isNotNull()
    changed = {c: F.when(came, F.col(f"new_{c}")).otherwise(F.col(c)) for c in ("title", "description", "tags", "date_taken")}
    changed |= {"photo_id": F.coalesce("photo_id", "id"), "last_seen_at": F.when(came, _ntz(now)).otherwise(F.col("last_seen_at"))}
    changed |= {"first_seen_at": F.coalesce("first_seen_at", _ntz(now)), "download_attempts": F.coalesce("download_attempts", F.lit(0))}
    return both.select(*(changed.get(c, F.col(c)).alias(c) for c in photos.columns))


def replace_rows(table: DataFrame, incoming: DataFrame, key: str = "photo_id", position: str | None = None) -> DataFrame:
    """Rows of known keys are replaced whole, others added. With a position the last row of a key wins."""
    new = latest(incoming, key, position).drop(position) if position else incoming
    return table.join(new.select(key), key, "left_anti").unionByName(new.select(*table.columns))


def touch_seen(photos: DataFrame, seen: DataFrame, now: datetime) -> DataFrame:
    hit = seen.select("photo_id").distinct().withColumn("hit", F.lit(True))
    return photos.join(hit, "photo_id", "left").withColumn("last_seen_at", F.when(F.col("hit"), _ntz(now)).otherwise(F.col("last_seen_at"))).select(*photos.columns)


def record_downloads(photos: DataFrame, results: DataFrame, now: datetime, position: str = "pos") -> DataFrame:
    """Each result (photo_id, image_file, image_bytes, error) is an attempt; the last one of an id says what the row becomes.

    A success anywhere in the batch leaves its file: only the error of later failures is added."""
    ok = F.col("error").isNull()
    per = results.groupBy("photo_id").agg(
        F.count(F.lit(1)).cast("int").alias("tries"),
        F.max_by(F.when(ok, F.struct("image_file", "image_bytes")), F.when(ok, F.col(position))).alias("file"),
        F.max_by(F.struct("error"), position).alias("last"),
    )
    both = photos.join(per, "photo_id", "left")
    stored, tried = F.col("file").isNotNull(), F.col("tries").isNotNull()
    changed = {
        "image_file": F.when(stored, F.col("file.image_file")).otherwise(F.col("image_file")),
        "image_bytes": F.when(stored, F.col("file.image_bytes")).otherwise(F.col("image_bytes")),
        "downloaded_at": F.when(stored, _ntz(now)).otherwise(F.col("downloaded_at")),
        "download_attempts": F.col("download_attempts") + F.coalesce("tries", F.lit(0)),
        "last_download_error": F.when(tried, short_error(F.col("last.error"))).otherwise(F.col("last_download_error")),
    }
    return both.select(*(changed.get(c, F.col(c)).alias(c) for c in photos.columns))


def clear_errors(errors: DataFrame, results: DataFrame) -> DataFrame:
    """Without the embedding errors of photos that were downloaded anew."""
    return errors.join(results.where("error is null").select("photo_id"), "photo_id", "left_anti")


def staged_vectors(batches: DataFrame, model: str, now: datetime, position: str = "pos") -> tuple[DataFrame, DataFrame]:
    """New rows of embeddings and embedding_errors from staged (photo_id, vector, error)."""
    last = latest(batches, "photo_id", position)
    good = last.where("vector is not null").select("photo_id", F.lit(model).alias("model"), "vector", _ntz(now).alias("created_at"))
    bad = last.where("vector is null").select("photo_id", "error", _ntz(now).alias("failed_at"))
    return good, bad


class Locked(TimeoutError):
    """Another writer holds the tables."""


class Fenced(RuntimeError):
    """Another writer has taken the tables over, so what this one wanted to commit doesn't count."""


class Tables:
    """Versioned tables under one folder: a version is a folder of Parquet, and a state file says which version of each table counts.

    A commit writes the new versions first and then, by one rename, the next state file; whatever ends before that leaves all
    tables as they were. Writers take turns by numbered leases: a lease is held from reading what a change starts from to the commit, and renewed
    meanwhile. One that wasn't renewed for long was left behind; only one writer can make the next lease. A commit counts
    only while its lease is the newest, and is written to folders of its own until then, so a writer that was taken over harms nothing."""

    KEPT_STATES = 50

    def __init__(self, spark: SparkSession, root: str, sleep: Callable[[float], None] = time.sleep) -> None:
        self.spark, self.root, self._sleep, self._depth, self._lease = spark, root.rstrip("/"), sleep, 0, 0
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _names(self, *parts: str) -> list[str]:
        at = self._path(*parts)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _states(self) -> list[str]:
        return [n for n in self._names("_state") if n.endswith(".json")]

    def state(self) -> dict[str, int | dict]:
        """The version of each table that counts; for a table of changes, its parts."""
        names = self._states()
        return self._load(names[-1]) if names else {}

    def _load(self, name: str) -> dict[str, int | dict]:
        source = self._fs.open(self._path("_state", name))
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def versions(self, name: str) -> list[int]:
        """The versions of a table that are still there, the one that counts last."""
        newest = self.state().get(name, 0)
        found = [int(v[1:]) for v in self._names(name) if v.startswith("v")]
        return sorted(v for v in found if v <= newest)

    def read(self, name: str, schema: StructType, version: int | None = None) -> DataFrame:
        version = version or self.state().get(name)
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/v{version:06d}")

    def _leases(self) -> tuple[int, bool]:
        """The newest lease, and whether it was given back; 0 if there is none."""
        names = self._names("_lock")
        newest = max((int(n) for n in names if n.isdigit()), default=0)
        return newest, not newest or f"{newest:08d}.free" in names

    def _take(self, stale: float) -> bool:
        newest, free = self._leases()
        if not free:
            try:
                renewed = self._fs.getFileStatus(self._path("_lock", f"{newest:08d}")).getModificationTime() / 1000
            except Exception:  # noqa: BLE001  it was tidied away meanwhile
                return False
            free = time.time() - renewed > stale
        if not free or not self._fs.createNewFile(self._path("_lock", f"{newest + 1:08d}")):
            return False
        self._lease = newest + 1
        for name in self._names("_lock"):  # only the newest lease says anything
            if int(name.partition(".")[0]) < newest:
                self._fs.delete(self._path("_lock", name), False)
        return True

    def _renew(self, lease: int, done: threading.Event, every: float) -> None:
        while not done.wait(every):
            now = int(time.time() * 1000)
            self._fs.setTimes(self._path("_lock", f"{lease:08d}"), now, now)

    def fence(self) -> None:
        """Raise Fenced unless the lease that this writer holds is the newest."""
        if self._depth == 0 or self._leases()[0] != self._lease:
            raise Fenced(f"{self.root} was taken over by another writer")

    @contextmanager
    def writing(self, wait: float = 120.0, stale: float = 600.0) -> Iterator[None]:
        """Hold the lease. Waits in doubling steps of 0.5 to 10 seconds, `wait` at most; a lease that wasn't renewed for `stale` seconds was left behind."""
        if self._depth == 0:
            waited, step = 0.0, 0.5
            while not self._take(stale):
                if waited >= wait:
                    raise Locked(f"{self.root} is written by another")
                self._sleep(step)
                waited, step = waited + step, min(2 * step, 10.0)
            done = threading.Event()
            threading.Thread(target=self._renew, args=(self._lease, done, max(stale, 30.0) / 6), daemon=True).start()
        self._depth += 1
        try:
            yield
        finally:
            self._depth -= 1
            if self._depth == 0:
                done.set()
                if self._leases()[0] == self._lease:
                    self._fs.createNewFile(self._path("_lock", f"{self._lease:08d}.free"))

    def publish(self, state: dict[str, int | dict]) -> None:
        """Make this the state that counts, if the lease is still held."""
        names = self._states()
        number = int(names[-1].partition(".")[0]) + 1 if names else 1
        draft, final = self._path("_state", f".{number:08d}-{self._lease:08d}"), self._path("_state", f"{number:08d}.json")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        self.fence()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise OSError(f"{final} can't be written")
        for name in names[: -self.KEPT_STATES]:
            self._fs.delete(self._path("_state", name), False)

    def commit(self, name: str, df: DataFrame) -> int:
        return self.commit_all({name: df})[name]

    def commit_all(self, changes: dict[str, DataFrame]) -> dict[str, int]:
        """The next versions of several tables, which count together or not at all."""
        with self.writing():
            state = self.state()
            new = {name: state.get(name, 0) + 1 for name in changes}
            for name, df in changes.items():
                df.write.mode("overwrite").parquet(f"{self.root}/{name}/.v{new[name]:06d}-{self._lease:08d}")
            self.fence()
            for name, version in new.items():
                final = self._path(name, f"v{version:06d}")
                self._fs.delete(final, True)  # of a commit that failed after this step
                if not self._fs.rename(self._path(name, f".v{version:06d}-{self._lease:08d}"), final):
                    raise OSError(f"{final} can't be written")
            self.publish(state | new)
            return new

    def change(self, name: str, schema: StructType, f: Callable[[DataFrame], DataFrame]) -> int:
        """Commit f of the table as it is, with nobody writing in between."""
        with self.writing():
            return self.commit(name, f(self.read(name, schema)))

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Delete all but the newest versions, and drafts; returns how many versions."""
        with self.writing():
            old = self.versions(name)[:-keep]
            for v in old:
                self._fs.delete(self._path(name, f"v{v:06d}"), True)
            for draft in self._names(name):  # of writers that failed or were taken over
                if draft.startswith(".v"):
                    self._fs.delete(self._path(name, draft), True)
            return len(old)


def migrate(tables: Tables, steps: list[tuple[int, str, object]], now: datetime) -> list[int]:
    """Run the steps (version, name, function of Tables) that aren't recorded, in order; a failing one is not recorded and ends the run."""
    done = {r.version for r in tables.read("_migrations", MIGRATIONS).select("version").collect()}  # one row for each step in the code
    ran = []
    for version, name, step in sorted(steps, key=lambda s: s[0]):
        if version not in done:
            step(tables)
            row = tables.spark.createDataFrame([(version, name, now)], MIGRATIONS)
            tables.commit("_migrations", tables.read("_migrations", MIGRATIONS).unionByName(row))
            ran.append(version)
    return ran
