"""Declarative quality checks. Those of one table are evaluated together in one pass over it."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.values import largest_is_zero, not_finite
from curatrix.operators.grouping import by_rows
from curatrix.schemas import GATE_CATEGORIES, INSTRUMENTS, KEEP_GATE, MODALITIES, NOT_APPLICABLE, SUBJECTS

log = logging.getLogger(__name__)


class DataQualityError(ValueError):
    """Checks of severity `error` have violations."""


@dataclass(frozen=True)
class Check:
    """violations: an aggregate over `table`, or a function of all tables that gives one row with the column `violations`.

    needs: (other table, key): the aggregate may use in_<other>, which is true for rows whose key the other table has, else null."""

    name: str
    table: str
    violations: Column | Callable[[dict[str, DataFrame]], DataFrame]
    severity: str = "error"
    needs: tuple[str, str] | None = None


@dataclass(frozen=True)
class Result:
    name: str
    severity: str
    violations: int

    @property
    def failed(self) -> bool:
        return self.severity == "error" and self.violations > 0


def frame(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """place, name, severity and violations of each check, as a plan: one aggregation for each table, foreign keys included."""
    parts = []

    def told(place: int, check: Check, violations: Column) -> Column:
        return F.struct(F.lit(place).alias("place"), F.lit(check.name).alias("name"), F.lit(check.severity).alias("severity"), F.coalesce(violations.cast("long"), F.lit(0).cast("long")).alias("violations"))

    plain = [(i, c) for i, c in enumerate(checks) if isinstance(c.violations, Column)]
    for table in dict.fromkeys(c.table for _, c in plain):
        mine, rows = [(i, c) for i, c in plain if c.table == table], tables[table]
        for other, key in dict.fromkeys(c.needs for _, c in mine if c.needs):
            rows = rows.join(by_rows(tables[other].select(key).distinct().withColumn(f"in_{other}", F.lit(True))), key, "left")
        sums = rows.agg(*(c.violations.alias(f"v{i}") for i, c in mine))
        parts.append(sums.select(F.explode(F.array(*(told(i, c, F.col(f"v{i}")) for i, c in mine))).alias("c")).select("c.*"))
    for i, c in enumerate(checks):
        if not isinstance(c.violations, Column):
            parts.append(c.violations(tables).select(told(i, c, F.col("violations")).alias("c")).select("c.*"))
    return reduce(DataFrame.unionByName, parts)


def evaluate(checks: list[Check], tables: dict[str, DataFrame]) -> list[Result]:
    """All checks in order, in one job."""
    rows = sorted(frame(checks, tables).collect(), key=lambda r: r.place) if checks else []
    return [Result(r.name, r.severity, r.violations) for r in rows]


def run(checks: list[Check], tables: dict[str, DataFrame], context: str = "checks") -> list[Result]:
    """Evaluate all, then raise if any of severity `error` has violations; warnings are logged."""
    results = evaluate(checks, tables)
    for r in results:
        if r.violations:
            log.warning("%s: %s: %d", context, r.name, r.violations)
    failed = [r for r in results if r.failed]
    if failed:
        raise DataQualityError(f"{context}: {len(failed)} failed: " + "; ".join(f"{r.name} ({r.violations})" for r in failed))
    return results


def photo_checks() -> list[Check]:
    c = F.col
    return [
        Check("a stored image has a size", "photos", F.count_if(c("image_file").isNotNull() & c("image_bytes").isNull())),
        Check("an image file has its photo's name", "photos", F.count_if(c("image_file") != F.concat("photo_id", F.lit(".jpg")))),
        Check("three downloads or more have failed", "photos", F.count_if(c("image_file").isNull() & (c("download_attempts") >= 3)), "warn"),
    ]


def file_check() -> Check:
    return Check("image files exist", "photos", F.count_if(F.col("image_file").isNotNull() & F.col("in_files").isNull()), needs=("files", "image_file"))


def embedding_checks() -> list[Check]:
    return [
        Check("an embedding has a photo", "embeddings", F.count_if(F.col("in_photos").isNull()), needs=("photos", "photo_id")),
        Check("an embedding is finite", "embeddings", F.count_if(not_finite(F.col("vector")))),
        Check("an embedding is not zero", "embeddings", F.count_if(largest_is_zero(F.col("vector")))),
        Check("photos could not be embedded", "embedding_errors", F.count(F.lit(1)), "warn"),
    ]


def label_checks() -> list[Check]:
    c = F.col
    return [
        Check("a label has a photo", "labels", F.count_if(c("in_photos").isNull()), needs=("photos", "photo_id")),
        Check("gate_category is in the codebook", "labels", F.count_if(~c("gate_category").isin(*GATE_CATEGORIES))),
        Check("a kept label has subject and modality", "labels", F.count_if((c("gate_category") == KEEP_GATE) & ((c("subject") == NOT_APPLICABLE) | (c("modality") == NOT_APPLICABLE)))),
    ]


def dataset_checks(pending: int, photos: int, published: int | None, allow_shrink: bool = False) -> list[Check]:
    """Checks of `kept` and `rejected` as they were staged."""
    c = F.col

    def outside(column: str, values: tuple[str, ...]) -> Check:
        return Check(f"{column} is in the codebook", "kept", F.count_if(~c(column).isin(*(v for v in values if v != NOT_APPLICABLE))))

    def primaries(t: dict[str, DataFrame]) -> DataFrame:
        return t["kept"].groupBy("release_group").agg(F.count_if("is_primary").alias("n")).agg(F.count_if(c("n") != 1).alias("violations"))

    def unaccounted(t: dict[str, DataFrame]) -> DataFrame:
        rows = t["kept"].select(F.lit(1)).union(t["rejected"].select(F.lit(1)))
        return rows.agg(F.abs(F.count(F.lit(1)) + pending - photos).alias("violations"))

    checks = [
        Check("there are kept rows", "kept", (F.count(F.lit(1)) == 0).cast("int")),
        Check("photo_id is unique", "kept", F.count(F.lit(1)) - F.count_distinct("photo_id")),
        Check("no photo is kept and rejected", "kept", F.count_if("in_rejected"), needs=("rejected", "photo_id")),
        Check("kept, rejected and pending are all photos", "kept", unaccounted),
        Check("a rejected row says by what", "rejected", F.count_if(~c("rejected_by").isin("model", "rule"))),
        outside("subject", SUBJECTS),
        outside("modality", MODALITIES),
        outside("instrument", INSTRUMENTS),
        Check("a release has one primary", "kept", primaries),
        Check("an object name is in its text", "kept", F.count_if(~c("object_name_verified")), "warn"),
        Check("a row has an embedding", "kept", F.count_if(~c("has_embedding")), "warn"),
        Check("a row has a small image", "kept", F.count_if(c("image_file").isNull()), "warn"),
    ]
    if published is not None:
        checks.append(Check("rows are not fewer than published", "kept", F.greatest(F.lit(published) - F.count(F.lit(1)), F.lit(0)), "warn" if allow_shrink else "error"))
    return checks
