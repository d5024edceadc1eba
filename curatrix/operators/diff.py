"""Comparison of two label runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.grouping import most_common


def shared(old: DataFrame, new: DataFrame, field: str) -> DataFrame:
    """photo_id, before and after of the field, and whether the codebook version moved, for photos in both runs."""
    a = old.select("photo_id", F.col(field).alias("before"), F.col("codebook_version").alias("v0"))
    b = new.select("photo_id", F.col(field).alias("after"), F.col("codebook_version").alias("v1"))
    return a.join(b, "photo_id").select("photo_id", "before", "after", (~F.col("v0").eqNullSafe(F.col("v1"))).alias("moved"))


def in_scope(both: DataFrame) -> DataFrame:
    """Rows whose version moved; all rows if none did."""
    moved = both.where("moved")
    return both if moved.isEmpty() else moved


def _changed():
    return ~F.col("before").eqNullSafe(F.col("after"))


def transitions(both: DataFrame, n: int = 6) -> DataFrame:
    return most_common(both.where(_changed()), "before", "after", first="photo_id", n=n)


def change_rate(both: DataFrame) -> DataFrame:
    total, changed = F.count(F.lit(1)), F.count_if(_changed())
    return both.agg(total.alias("n"), changed.alias("changed"), (100.0 * changed / F.greatest(total, F.lit(1))).alias("percent"))


def shift(old: DataFrame, new: DataFrame, field: str) -> DataFrame:
    """Counts of each value in both runs and their difference; a value that one run lacks counts 0 there."""
    a = old.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("n_before"))
    b = new.groupBy(F.col(field).alias("v")).agg(F.count(F.lit(1)).alias("n_after"))
    both = a.join(b, F.col("value").eqNullSafe(F.col("v")), "full")
    before, after = F.coalesce("n_before", F.lit(0)), F.coalesce("n_after", F.lit(0))
    return both.select(F.coalesce("value", "v").alias("value"), before.alias("n_before"), after.alias("n_after"), (after - before).alias("delta"))


def examples(both: DataFrame, k: int) -> DataFrame:
    return both.where(_changed()).select("photo_id", "before", "after").orderBy("photo_id").limit(k)
