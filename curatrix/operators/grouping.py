"""Latest record per key, first per group, samples, batches and order-preserving distinct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.text import release_key
from curatrix.functions.values import rank_of
from curatrix.schemas import MODALITY_RANK
from curatrix.scratch import Scratch


def by_rows(df: DataFrame) -> DataFrame:
    """df as a side of a join that is sorted and never broadcast. How many rows a table has, its compressed bytes don't tell: 600,000 labels take 3 MB
    as a file, so Spark would broadcast them, and 190 MB in the driver's memory."""
    return df.hint("merge")


def latest(df: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key by position; one partial aggregation, no sort."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("row")).select(key, *(F.col(f"row.{c}").alias(c) for c in rest))


def with_primary(df: DataFrame) -> DataFrame:
    """release_group and is_primary: of each release the best modality, then the largest image, then the smallest id.

    The winners come from a partial aggregation and are joined back, so no task holds a whole group."""
    order = F.struct(rank_of(F.col("modality"), MODALITY_RANK, 9), -F.coalesce("image_bytes", F.lit(0)), F.col("photo_id"))
    keyed = df.withColumn("release_group", release_key(F.col("title")))
    best = keyed.groupBy("release_group").agg(F.min_by("photo_id", order).alias("photo_id")).select("photo_id", F.lit(True).alias("first"))
    return keyed.join(by_rows(best), "photo_id", "left").withColumn("is_primary", F.coalesce("first", F.lit(False))).drop("first")


def stratified(df: DataFrame, by: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows, taken in turn from each class in class order; within a class by a hash of id and seed.

    Only the first n of a class can be taken, so a class is cut to those before anything is ordered over classes."""
    shuffled = F.md5(F.concat(F.col(key), F.lit(str(seed))).cast("binary"))
    turn = df.withColumn("turn", F.row_number().over(Window.partitionBy(by).orderBy(shuffled, key))).where(F.col("turn") <= n)
    return turn.orderBy("turn", by).limit(n)


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """name: each row's place in key order, from 0. No task sees all rows.

    Rows are sorted by range and written, since a second run of the plan might draw other ranges; then the rows of the ranges before are added."""
    scratch = Scratch(df.sparkSession, "numbered")
    ranged = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    ranged = scratch.keep(ranged, "ranged")
    ranges = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("rows"), F.min("_place").alias("_first"))
    ahead = F.coalesce(F.sum("rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    both = ranged.join(ranges.select("_part", "_first", ahead.alias("_ahead")), "_part")
    return both.withColumn(name, F.col("_ahead") + F.col("_place") - F.col("_first")).drop("_part", "_place", "_first", "_ahead")


def batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """batch: the number of each row's batch of `size` rows in key order."""
    return numbered(df, key, "_at").withColumn("batch", F.floor(F.col("_at") / size).cast("long")).drop("_at")


def distinct_in_order(df: DataFrame, value: str, position: Column | str) -> DataFrame:
    """Each value once, with the place of its first occurrence."""
    return df.groupBy(value).agg(F.min(position).alias("first_at"))


def most_common(df: DataFrame, *keys: str, first: str, n: int) -> DataFrame:
    """The n most frequent keys; ties by first occurrence."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(n)


def counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
