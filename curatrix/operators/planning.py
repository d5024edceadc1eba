"""What is missing: work lists from the state of the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.grouping import by_rows
from curatrix.schemas import LAUNCH_DATE, MAX_DOWNLOAD_ATTEMPTS


def new_ids(listing: DataFrame, photos: DataFrame, position: str = "pos") -> DataFrame:
    """Listed rows whose id isn't stored, in the listing's order, repeats included."""
    return listing.join(photos.select("photo_id"), "photo_id", "left_anti").orderBy(position)


def pending_downloads(photos: DataFrame, attempts: int = MAX_DOWNLOAD_ATTEMPTS) -> DataFrame:
    return photos.where(F.col("image_file").isNull() & (F.col("download_attempts") < attempts)).select("photo_id").orderBy("photo_id")


def pending_embeddings(photos: DataFrame, embeddings: DataFrame, errors: DataFrame, limit: int | None = None) -> DataFrame:
    """Downloaded, neither embedded nor failed. No limit if limit is None or 0."""
    todo = photos.where("image_file is not null").select("photo_id").join(embeddings.select("photo_id"), "photo_id", "left_anti").join(errors.select("photo_id"), "photo_id", "left_anti").orderBy("photo_id")
    return todo.limit(limit) if limit else todo


def eligible(date_taken, since: datetime = LAUNCH_DATE):
    """No date, or one that isn't before the launch, however far ahead."""
    return date_taken.isNull() | (date_taken >= F.lit(since).cast("timestamp_ntz"))


def label_queue(photos: DataFrame, labels: DataFrame, logged: DataFrame, limit: int, since: datetime = LAUNCH_DATE) -> DataFrame:
    """Downloaded, eligible, neither labelled nor in the log; the first `limit`, so 0 gives none."""
    ready = photos.where(F.col("image_file").isNotNull() & eligible(F.col("date_taken"), since))
    todo = ready.join(labels.select("photo_id"), "photo_id", "left_anti").join(logged.select("photo_id"), "photo_id", "left_anti")
    return todo.orderBy("photo_id").limit(limit)


def pending(photos: DataFrame, labels: DataFrame, since: datetime = LAUNCH_DATE) -> DataFrame:
    return photos.where(eligible(F.col("date_taken"), since)).join(labels.select("photo_id"), "photo_id", "left_anti")


def images_to_write(kept: DataFrame, present: DataFrame) -> DataFrame:
    """photo_id and state: present (there is a copy, looked at first), failed (no image) or write."""
    have = present.select(F.col("image_file").alias("copy")).distinct()
    both = kept.join(by_rows(have), F.concat("photo_id", F.lit(".jpg")) == F.col("copy"), "left")
    return both.select("photo_id", F.when(F.col("copy").isNotNull(), "present").when(F.col("image_file").isNull(), "failed").otherwise("write").alias("state"))


def orphan_files(files: DataFrame, photos: DataFrame, broken: DataFrame) -> DataFrame:
    """Files, by photo_id, that no row and no known broken image accounts for."""
    return files.join(photos.select("photo_id"), "photo_id", "left_anti").join(broken.select("photo_id"), "photo_id", "left_anti")


def missing_files(photos: DataFrame, files: DataFrame) -> DataFrame:
    """Photos whose image file isn't in the folder."""
    return photos.where("image_file is not null").join(files.select("image_file"), "image_file", "left_anti")


def failing(attempts: int, failures: int, least: int = 5, share: float = 0.5) -> bool:
    """Whether a run should stop: enough attempts, and half of them failed."""
    return attempts >= least and failures >= share * attempts
