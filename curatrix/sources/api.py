"""A paged, rate-limited REST archive as a source. Nothing here opens a connection itself: the transport is passed in."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from curatrix.functions.values import SIZE_PREFERENCE, photo_info
from curatrix.schemas import PAGE_SIZE
from curatrix.scratch import Scratch

log = logging.getLogger(__name__)

#: (method, parameters) -> (HTTP status, body text)
Transport = Callable[[str, dict], tuple[int, str]]
TRANSIENT_CODE = 105


class SourceError(RuntimeError):
    """A call failed. transient: trying again may help."""

    def __init__(self, message: str, transient: bool = False) -> None:
        super().__init__(message)
        self.transient = transient


@dataclass
class Client:
    """Calls with pauses, retries with doubled waits, and the key kept out of messages."""

    transport: Transport
    key: str = ""
    attempts: int = 4
    wait: float = 2.0
    pause: float = 0.3
    sleep: Callable[[float], None] = field(default=time.sleep)

    def _once(self, method: str, parameters: dict) -> dict:
        self.sleep(self.pause)
        try:
            status, text = self.transport(method, parameters)
        except OSError as e:
            raise SourceError(self._safe(f"{method}: {type(e).__name__}: {e}"), True) from None
        if status == 429 or status >= 500:
            raise SourceError(f"{method}: status {status}", True)
        if status >= 400:
            raise SourceError(self._safe(f"{method}: status {status}: {text[:200]}"))
        try:
            body = json.loads(text)
        except ValueError:
            raise SourceError(f"{method}: not JSON", True) from None
        if body.get("stat", "ok") != "ok":
            raise SourceError(self._safe(f"{method}: {body.get('code')}: {body.get('message')}"), body.get("code") == TRANSIENT_CODE)
        return body

    def _safe(self, text: str) -> str:
        return text.replace(self.key, "***") if self.key else text

    def call(self, method: str, **parameters) -> dict:
        for attempt in range(self.attempts):
            try:
                return self._once(method, parameters)
            except SourceError as e:
                if not e.transient or attempt == self.attempts - 1:
                    raise
                self.sleep(self.wait * 2**attempt)
        raise SourceError(f"{method}: no attempts")


@dataclass
class Archive:
    """The archive's calls, as far as flows need them."""

    client: Client

    def user_id(self, address: str) -> str:
        """The id of the user with this address; names are not looked up, addresses are."""
        return self.client.call("urls.lookupUser", url=address)["user"]["id"]

    def page(self, user_id: str) -> Callable[[int, int], dict]:
        """For `listed`: one page of a user's public photos."""

        def one(number: int, size: int) -> dict:
            body = self.client.call("people.getPublicPhotos", user_id=user_id, per_page=size, page=number)["photos"]
            return {"pages": body["pages"], "total": body["total"], "ids": [p["id"] for p in body["photo"]]}

        return one

    def metadata(self, photo_id: str) -> str:
        """The payload that `photo_info` reads."""
        return json.dumps(self.client.call("photos.getInfo", photo_id=photo_id)["photo"])

    def image_url(self, photo_id: str, preference: tuple[str, ...] = SIZE_PREFERENCE) -> str:
        """The source of the first preferred size, or of the last one that there is."""
        sizes = self.client.call("photos.getSizes", photo_id=photo_id)["sizes"]["size"]
        if not sizes:
            raise SourceError(f"{photo_id} has no sizes")
        by = {s["label"]: s["source"] for s in sizes}
        return next((by[label] for label in preference if label in by), sizes[-1]["source"])


def listed(pages: Callable[[int, int], dict], size: int = PAGE_SIZE) -> Iterator[tuple[int, str]]:
    """(position, id) from all pages; pages(number, size) gives {"pages", "total", "ids"}. Warns if ids are missing or too many."""
    page, at, seen = 1, 0, set()
    while True:
        body = pages(page, size)
        for photo_id in body["ids"]:
            seen.add(photo_id)
            yield at, photo_id
            at += 1
        if page >= int(body["pages"]):
            break
        page += 1
    if len(seen) != int(body.get("total", len(seen))):
        log.warning("the archive says it has %s photos but lists %d; the next run will find what is missing", body["total"], len(seen))


@dataclass
class Pages(InputPartition):
    """Pages first to last of a listing, of which the entries from place `start` on and before `end` count."""

    first: int
    last: int
    start: int = 0
    end: int = 1 << 62


def listing_source(pages: Callable[[int, int], dict], size: int = PAGE_SIZE, per_task: int = 20, name: str = "archive_listing") -> type[DataSource]:
    """A data source of (pos, photo_id) that reads a listing's pages on executors, per_task pages in a task; for spark.dataSource.register.

    pages(number, size) gives {"pages", "total", "ids"}; the planner asks it for the first page only. As a stream the listing is read from the place where the last batch ended
    to what the archive says it has, so a run reads only pages that have grown; the archive has to add at the end then."""

    def entries(part: Pages) -> Iterator[tuple[int, str]]:
        for number in range(part.first, part.last + 1):
            for at, photo_id in enumerate(pages(number, size)["ids"], (number - 1) * size):
                if part.start <= at < part.end:
                    yield at, photo_id

    def ranges(first: int, last: int, start: int = 0, end: int = 1 << 62) -> list[Pages]:
        return [Pages(p, min(p + per_task - 1, last), start, end) for p in range(first, last + 1, per_task)]

    class Reader(DataSourceReader):
        def partitions(self) -> list[Pages]:
            return ranges(1, int(pages(1, size)["pages"]))

        def read(self, partition: Pages) -> Iterator[tuple[int, str]]:
            return entries(partition)

    class Stream(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"seen": 0}

        def latestOffset(self) -> dict:
            return {"seen": int(pages(1, size)["total"])}

        def partitions(self, start: dict, end: dict) -> list[Pages]:
            return ranges(start["seen"] // size + 1, -(-end["seen"] // size), start["seen"], end["seen"]) if end["seen"] > start["seen"] else []

        def read(self, partition: Pages) -> Iterator[tuple[int, str]]:
            return entries(partition)

        def commit(self, end: dict) -> None:
            pass

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "pos long, photo_id string"

        def reader(self, schema: object) -> DataSourceReader:
            return Reader()

        def streamReader(self, schema: object) -> DataSourceStreamReader:
            return Stream()

    return Listing


def listing(spark: SparkSession, pages: Callable[[int, int], dict], size: int = PAGE_SIZE, per_task: int = 20) -> DataFrame:
    """photo_id and pos of its first place; pages that shifted while they were read repeat ids. Warns if ids are missing or too many."""
    source = listing_source(pages, size, per_task)
    spark.dataSource.register(source)
    found = Scratch(spark, "listing").keep(spark.read.format(source.name()).load(), "ids")  # no page is asked for twice
    ids = found.groupBy("photo_id").agg(F.min("pos").alias("pos"))
    total, seen = int(pages(1, size).get("total", -1)), ids.count()
    if total not in (-1, seen):
        log.warning("the archive says it has %d photos but lists %d; the next run will find what is missing", total, seen)
    return ids


def first_places(spark: SparkSession, ids: DataFrame | Iterable[tuple[int, str]], step: int = 50_000) -> DataFrame:
    """photo_id and pos of its first place, from a listing, or from ids that come one by one and are written `step` at a time."""
    schema = "pos long, photo_id string"
    if not isinstance(ids, DataFrame):
        scratch, rest = Scratch(spark, "listing"), iter(ids)
        spark.createDataFrame([], schema).write.parquet(f"{scratch.path}/ids")
        while part := list(islice(rest, step)):
            spark.createDataFrame(part, schema).write.mode("append").parquet(f"{scratch.path}/ids")
        ids = spark.read.schema(schema).parquet(f"{scratch.path}/ids")
    return ids.groupBy("photo_id").agg(F.min("pos").alias("pos"))


def lookups(rows: DataFrame, archive: Callable[[str], Archive], key: str, address: str) -> DataFrame:
    """key as text, user_id, url and error for each row: whose address it is, and where its preferred image is. Calls are made where the rows are; one row's failure is told in it."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            told = []
            for photo_id, where in zip(frame["id"], frame["address"], strict=True):
                try:
                    calls = archive(photo_id)
                    told.append((photo_id, calls.user_id(where), calls.image_url(photo_id), None))
                except Exception as e:  # noqa: BLE001  whatever goes wrong is told in the row
                    told.append((photo_id, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(told, columns=["id", "user_id", "url", "error"])

    asked = rows.select(F.col(key).cast("string").alias("id"), F.col(address).alias("address"))
    return asked.mapInPandas(work, "id string, user_id string, url string, error string").withColumnRenamed("id", key)


def fetch(ids: DataFrame, one: Callable[[str], str]) -> DataFrame:
    """photo_id, payload and error for each id; one id's failure is a row, not the end of the job."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for photo_id in frame["photo_id"]:
                try:
                    rows.append((photo_id, one(photo_id), None))
                except Exception as e:  # noqa: BLE001  whatever goes wrong is told in the row
                    rows.append((photo_id, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["photo_id", "payload", "error"])

    return ids.select("photo_id").mapInPandas(work, "photo_id string, payload string, error string")


def metadata(fetched: DataFrame) -> DataFrame:
    """Rows of photos from payloads; failures are dropped, unless there is nothing else."""
    tally = fetched.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("bad")).first()
    if tally.n and tally.n == tally.bad:
        raise SourceError("every fetch failed")
    return fetched.where("error is null").select(photo_info(F.col("payload")).alias("p")).select("p.*")
