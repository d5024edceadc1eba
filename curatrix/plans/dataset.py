"""The dataset build: labelled rows, kept and rejected, manifest, and write-audit-publish."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators import planning, quality
from curatrix.operators.grouping import by_rows, counts, stratified, with_primary
from curatrix.operators.similarity import duplicate_groups
from curatrix.schemas import KEEP_GATE, KEPT_COLUMNS, LAUNCH_DATE, NEAR_DUPLICATE, REJECTED_COLUMNS
from curatrix.sources.files import Folder, checksum, delete_files, join_parts, read_csv, read_json, write_json, write_parts

KEPT, REJECTED, MANIFEST, PUBLISHED = "kept", "rejected", "manifest.json", "_PUBLISHED"
OUTPUTS = ("kept.parquet", "kept.csv", "rejected.parquet", "rejected.csv")
# The columns of the spreadsheets.
CSV_COLUMNS = (
    "photo_id", "subject", "modality", "object_name_normalized", "object_name", "object_name_verified", "instrument", "title", "page_url", "date_taken",
    "source_tag_label", "rationale", "confidence", "release_group", "near_duplicate_group", "is_primary", "tags", "description", "has_embedding", "model", "codebook_version",
)
REJECTED_CSV = ("photo_id", "rejected_as", "rejected_by", "title", "rationale", "page_url", "date_taken", "source_tag_label")


def labelled(spark: SparkSession, photos: DataFrame, labels: DataFrame, embeddings: DataFrame, images: DataFrame | None = None, page_base: str = "https://archive.example", threshold: float = NEAR_DUPLICATE) -> DataFrame:
    """Photos with labels, and all that is derived from both. Names and instruments are column expressions in the scan's stage;
    releases, groups and flags exist for kept rows only. `vector` is read for kept rows alone."""
    both = photos.join(by_rows(labels), "photo_id")
    keep = both.where(F.col("gate_category") == KEEP_GATE)
    groups = with_primary(keep.select("photo_id", "title", "modality", "image_bytes")).select("photo_id", "release_group", "is_primary")
    vectors = embeddings.join(by_rows(keep.select("photo_id")), "photo_id", "left_semi").select("photo_id", "vector")
    alike = duplicate_groups(spark, vectors, "photo_id", "vector", threshold)
    has = embeddings.select("photo_id", F.lit(True).alias("embedded"))
    out = both.join(by_rows(groups), "photo_id", "left").join(by_rows(alike), "photo_id", "left").join(by_rows(has), "photo_id", "left")
    if images is None:
        out = out.withColumn("copy", F.lit(None).cast("string"))
    else:
        out = out.join(by_rows(images.select(F.col("image_file").alias("copy")).distinct()), F.col("copy") == T.file_name(F.col("photo_id")), "left")
    c = F.col
    return out.select(
        "photo_id", "title", "description", "subject", "modality", "object_name",
        T.canonical_name(c("object_name")).alias("object_name_normalized"),
        F.when(c("object_name").isNull(), True).otherwise(T.name_verified(c("object_name"), c("title"), c("description"))).alias("object_name_verified"),
        T.correct_instrument(c("instrument"), T.named_instruments(c("title"), c("description"))).alias("instrument"),
        "confidence", "rationale", "gate_category", "release_group", "near_duplicate_group", "is_primary", "tags", "date_taken",
        T.page_url(page_base, c("photo_id")).alias("page_url"), c("legacy_tag_label").alias("source_tag_label"),
        F.when(c("copy").isNotNull(), F.concat(F.lit("images/"), "copy")).alias("image_file"),
        F.coalesce("embedded", F.lit(False)).alias("has_embedding"), "model", "codebook_version", c("vision").alias("labelled_with_vision"),
    )


def kept(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("gate_category") == KEEP_GATE).select(*KEPT_COLUMNS)


def rejected(rows: DataFrame, photos: DataFrame, labels: DataFrame, page_base: str = "https://archive.example", since: datetime = LAUNCH_DATE) -> DataFrame:
    """What the labels reject, and what nobody labelled as it is dated before the launch."""
    by_model = rows.where(F.col("gate_category") != KEEP_GATE).withColumn("rejected_as", F.col("gate_category")).withColumn("rejected_by", F.lit("model")).select(*REJECTED_COLUMNS)
    old = photos.join(by_rows(labels.select("photo_id")), "photo_id", "left_anti").where(F.col("date_taken") < F.lit(since).cast("timestamp_ntz"))
    by_rule = old.select(
        "photo_id", "title", F.lit("dated_before_launch").alias("rejected_as"), F.lit("rule").alias("rejected_by"), F.lit(None).cast("string").alias("rationale"),
        "date_taken", T.page_url(page_base, F.col("photo_id")).alias("page_url"), F.col("legacy_tag_label").alias("source_tag_label"),
    )
    return by_model.unionByName(by_rule)


def csv_rows(rows: DataFrame) -> DataFrame:
    """Kept rows for a spreadsheet: tags in one cell, descriptions in one line."""
    flat = rows.withColumn("tags", F.array_join("tags", "|")).withColumn("description", T.one_line(F.col("description")))
    return flat.select(*CSV_COLUMNS)


def accounting(photos: DataFrame, labels: DataFrame, since: datetime = LAUNCH_DATE) -> DataFrame:
    """photos, kept, rejected_by_model, rejected_by_rule and pending in one pass."""
    both = photos.join(by_rows(labels.select("photo_id", "gate_category")), "photo_id", "left")
    open_ = F.col("gate_category").isNull()
    recent = planning.eligible(F.col("date_taken"), since)
    return both.agg(
        F.count(F.lit(1)).alias("photos"), F.count_if(F.col("gate_category") == KEEP_GATE).alias("kept"), F.count_if(F.col("gate_category") != KEEP_GATE).alias("rejected_by_model"),
        F.count_if(open_ & ~recent).alias("rejected_by_rule"), F.count_if(open_ & recent).alias("pending"),
    )


def _by(df: DataFrame, key: str) -> dict[str, int]:
    return {str(r[key]): r.n for r in counts(df, key).orderBy(key).collect()}  # a row for each value of a closed vocabulary


def build(spark: SparkSession, out: str, photos: DataFrame, labels: DataFrame, embeddings: DataFrame, images: DataFrame | None = None, model: str = "", since: datetime = LAUNCH_DATE) -> dict:
    """Write every output to `out`; returns the manifest. It has no times, so that the same input gives the same bytes."""
    folder = Folder(spark, out)
    rows = labelled(spark, photos, labels, embeddings, images).persist()
    no = rejected(rows, photos, labels, since=since).persist()
    yes = kept(rows)
    for rows_of, of_csv, name, order in ((yes, csv_rows(yes), KEPT, "subject"), (no, no.select(*REJECTED_CSV), REJECTED, "rejected_as")):
        write_parts(rows_of, folder, f"{name}.parquet", "photo_id")
        write_parts(of_csv, folder, f"{name}.lines", order, "photo_id", kind="csv")
        join_parts(folder, f"{name}.lines", f"{name}.csv", ",".join(of_csv.columns) + "\n")
        folder.delete(f"{name}.lines")
    total = accounting(photos, labels, since).first()
    manifest = {
        "rows": {KEPT: spark.read.parquet(f"{out}/kept.parquet").count(), REJECTED: spark.read.parquet(f"{out}/rejected.parquet").count()},
        "photos": total.photos,
        "pending": total.pending,
        "rejected_by": _by(no, "rejected_by"),
        "labels": labels.count(),
        "subjects": _by(yes, "subject"),
        "codebook_versions": _by(labels, "codebook_version"),
        "embedding_model": model,
        "sha256": {name: checksum(spark, f"{out}/{name}") for name in OUTPUTS},
    }
    write_json(folder, MANIFEST, manifest)
    rows.unpersist()
    no.unpersist()
    return manifest


def published_folder(spark: SparkSession, published: str) -> str | None:
    """The folder of the newest version that was published, or None."""
    folder = Folder(spark, published)
    done = [n for n in folder.names() if n.startswith("v") and folder.exists(f"{n}/{PUBLISHED}")]
    return f"{folder.path}/{done[-1]}" if done else None


def audit(spark: SparkSession, staged: str, published: str, allow_shrink: bool = False) -> list[quality.Result]:
    """Check the staged files, read anew; raises if they mustn't be published."""
    return quality.run(*_audited(spark, staged, published, allow_shrink), "dataset")


def findings(spark: SparkSession, staged: str, published: str, allow_shrink: bool = False) -> list[quality.Result]:
    """What the checks of an audit find, whether or not that forbids to publish."""
    return quality.evaluate(*_audited(spark, staged, published, allow_shrink))


def _audited(spark: SparkSession, staged: str, published: str, allow_shrink: bool) -> tuple[list[quality.Check], dict[str, DataFrame]]:
    manifest = read_json(Folder(spark, staged), MANIFEST)
    old = published_folder(spark, published)
    before = read_json(Folder(spark, old), MANIFEST)["rows"][KEPT] if old else None
    tables = {name: spark.read.parquet(f"{staged}/{name}.parquet") for name in (KEPT, REJECTED)}
    checks = quality.dataset_checks(manifest["pending"], manifest["photos"], before, allow_shrink)

    def unlike(t: dict[str, DataFrame]) -> DataFrame:
        """Rows of a photo that one of the two files has more often than the other."""
        rows = [df.select(F.lit(name).alias("name"), "photo_id", F.lit(sign).alias("sign")) for name in (KEPT, REJECTED) for df, sign in ((t[name], 1), (read_csv(spark, f"{staged}/{name}.csv"), -1))]
        return reduce(DataFrame.union, rows).groupBy("name", "photo_id").agg(F.abs(F.sum("sign")).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))

    checks.append(quality.Check("CSV and Parquet have the same rows", KEPT, unlike))
    return checks, tables


def publish(spark: SparkSession, staged: str, published: str, keep: int = 2) -> str:
    """Move the staged folder into place by one rename, then mark it as published; returns where it is.

    Readers take the newest marked version, so at any time they see one whole version. Older versions but the last are dropped."""
    target = Folder(spark, published)
    versions = [n for n in target.names() if n.startswith("v")]
    name = f"v{int(versions[-1][1:]) + 1 if versions else 1:06d}"
    Folder(spark, staged).rename(f"{target.path}/{name}")
    target.write_text(f"{name}/{PUBLISHED}", "")
    marked = [n for n in target.names() if n.startswith("v") and target.exists(f"{n}/{PUBLISHED}")]
    for old in versions:
        if old not in marked[-keep:]:
            target.delete(old)
    return f"{target.path}/{name}"


def prune_images(spark: SparkSession, published: str, images: DataFrame) -> int:
    """Delete copies of photos that aren't kept; returns how many. Tasks delete, so that no name comes to the driver."""
    keep = spark.read.parquet(f"{published_folder(spark, published)}/kept.parquet").select("photo_id")
    gone = images.join(by_rows(keep), "photo_id", "left_anti").select("image_file")
    return delete_files(gone, "image_file", f"{published}/images")


def image_tally(states: DataFrame) -> DataFrame:
    """written, present and failed, of photo_id and state."""
    return states.agg(*(F.count_if(F.col("state") == s).alias(s) for s in ("written", "present", "failed")))


def write_images(rows: DataFrame, present: DataFrame, copy: Callable[[str, str], None]) -> DataFrame:
    """photo_id, state and error: what became of the copy of each of rows (photo_id, image_file).

    copy(photo_id, image_file) makes one; where it fails, the row says so. A photo without an image has failed."""
    states = planning.images_to_write(rows, present).join(by_rows(rows.select("photo_id", "image_file")), "photo_id")

    def work(frames):
        for frame in frames:
            told = []
            for photo_id, image_file in zip(frame["photo_id"], frame["image_file"], strict=True):
                try:
                    copy(photo_id, image_file)
                    told.append((photo_id, "written", None))
                except Exception as e:  # noqa: BLE001  told in the row
                    told.append((photo_id, "failed", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(told, columns=["photo_id", "state", "error"])

    todo = states.where("state = 'write'").select("photo_id", "image_file").repartition(rows.sparkSession.sparkContext.defaultParallelism)
    done = todo.mapInPandas(work, "photo_id string, state string, error string")
    return states.where("state <> 'write'").select("photo_id", "state", F.lit(None).cast("string").alias("error")).unionByName(done)


def review_rows(sample: DataFrame) -> DataFrame:
    """One HTML figure for each sampled row."""
    cells = [F.concat(F.lit("<td>"), F.coalesce(T.html_escape(F.col(c).cast("string")), F.lit("")), F.lit("</td>")) for c in ("photo_id", "subject", "modality", "instrument", "object_name", "title", "rationale")]
    return sample.select("photo_id", F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("html"))


def review_sheet(spark: SparkSession, out: str, n: int, name: str = "review.html") -> str | None:
    """One page with n kept rows, drawn evenly from the subjects; None if n is 0. A page that people read holds 1,000 rows at most."""
    if not 0 <= n <= 1000:
        raise ValueError("a review sheet has 0 to 1000 rows")
    if not n:
        return None
    sample = stratified(spark.read.parquet(f"{out}/kept.parquet"), "subject", "photo_id", n)
    rows = [r.html for r in review_rows(sample).orderBy("photo_id").collect()]  # n at most
    Folder(spark, out).write_text(name, "<!doctype html><meta charset='utf-8'><table>\n" + "\n".join(rows) + "\n</table>\n")
    return f"{out}/{name}"


def gallery(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """photo_id and caption of a fixed list, in its order. A missing one is an error."""
    caption = F.coalesce("object_name_normalized", T.before_bracket(F.col("title")))
    found = rows.where(F.col("photo_id").isin(*wanted)).select("photo_id", caption.alias("caption"), F.array_position(F.array(*map(F.lit, wanted)), F.col("photo_id")).alias("place"))
    missing = set(wanted) - {r.photo_id for r in found.select("photo_id").collect()}  # a fixed, short list
    if missing:
        raise LookupError(f"not in the dataset: {', '.join(sorted(missing))}")
    return found.orderBy("place")
