"""The first load from an earlier archive, which is only read."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions.text import base_name, short_error
from curatrix.functions.values import as_vector
from curatrix.operators import quality
from curatrix.operators.state import Tables
from curatrix.schemas import EMBEDDING_DIM, EMBEDDINGS, PHOTOS


def attach(spark: SparkSession, source: str, **options: str) -> Callable[[str], DataFrame]:
    """A reader of the tables of a database (a JDBC address) or of a folder that holds one Parquet table for each."""
    if source.startswith("jdbc:"):
        return lambda name: spark.read.format("jdbc").options(url=source, dbtable=name, **options).load()
    return lambda name: spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")


def photo_rows(old: DataFrame) -> DataFrame:
    """Rows of photos from the earlier table: every one was downloaded once, when it was ingested."""
    when = F.col("date_ingested").cast("timestamp_ntz")
    named = {
        "tags": F.col("tags"), "first_seen_at": when, "image_file": base_name(F.col("image_path")), "downloaded_at": when, "download_attempts": F.lit(1),
        "legacy_tag_label": F.col("canonical_label"), "date_taken": F.col("date_taken").cast("timestamp_ntz"),
    } | {c: F.col(c) for c in ("photo_id", "title", "description")}
    return old.select(*(named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PHOTOS.fields))


def vector_rows(old: DataFrame, model: str, now: datetime, dim: int = EMBEDDING_DIM) -> DataFrame:
    values = as_vector(F.col("embedding"), dim)
    return old.where("embedding is not null").select("photo_id", F.lit(model).alias("model"), values.alias("vector"), F.lit(now).cast("timestamp_ntz").alias("created_at"))


def with_files(photos: DataFrame, files: DataFrame, broken: DataFrame) -> DataFrame:
    """photos with the sizes of their files (image_file, length); those without a file, or in broken (photo_id, error), are to be downloaded anew."""
    sizes = files.groupBy(F.col("image_file").alias("file")).agg(F.max("length").alias("length"))
    reasons = broken.groupBy(F.col("photo_id").alias("id")).agg(F.min("error").alias("reason"))
    both = photos.join(sizes, F.col("image_file") == F.col("file"), "left").join(reasons, F.col("photo_id") == F.col("id"), "left")
    reason = F.when(F.col("file").isNull(), "no file in the earlier archive").otherwise(F.concat(F.lit("file of the earlier archive is broken: "), F.col("reason")))
    changed = {c: F.when(reason.isNull(), F.col(c)) for c in ("image_file", "downloaded_at")}
    changed |= {"image_bytes": F.when(reason.isNull(), F.col("length")), "last_download_error": short_error(reason)}
    return both.select(*(changed.get(c, F.col(c)).alias(c) for c in photos.columns))


def load(tables: Tables, source: Callable[[str], DataFrame], files: DataFrame, model: str, now: datetime, broken: DataFrame | None = None, dim: int = EMBEDDING_DIM) -> dict[str, int]:
    """Load photos and embeddings in one commit and check them. Photos that are there already are an error.

    broken: photos (photo_id, error) whose files were found not to decode; those with a vector decoded when it was made."""
    spark = tables.spark
    with tables.writing():
        if not tables.read("photos", PHOTOS).isEmpty():
            raise ValueError(f"{tables.root} has photos already")
        old = source("photos")
        vectors = vector_rows(old, model, now, dim)
        bad = spark.createDataFrame([], "photo_id string, error string") if broken is None else broken.join(vectors.select("photo_id"), "photo_id", "left_anti")
        tables.commit_all({"photos": with_files(photo_rows(old), files, bad), "embeddings": vectors})
    photos, vectors = tables.read("photos", PHOTOS), tables.read("embeddings", EMBEDDINGS)
    tally = photos.agg(F.count(F.lit(1)).alias("photos"), F.count("image_file").alias("usable"), F.count("legacy_tag_label").alias("tagged"), F.count("last_download_error").alias("anew")).first()
    quality.run(quality.photo_checks() + quality.embedding_checks()[:3], {"photos": photos, "embeddings": vectors}, "legacy load")
    return tally.asDict() | {"embeddings": vectors.count()}
