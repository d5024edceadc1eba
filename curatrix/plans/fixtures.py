"""The archive's tables as views of the driver's tables, in Spark and in DuckDB SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.schemas import KEEP_GATE, MODALITIES, SUBJECTS

CUTOFF = datetime(1998, 1, 1)
THRESHOLD = 0.40
#: Spellings of object names that the fixture gives documents in turn.
NAMES = ("SMACS 0723", "SMACS J0723", "Messier 51 (M51)", "WASP 96b", "ngc  3132", "Pillars of Creation.", None, "the")
TOOLS = ("NIRCam", "MIRI", "NIRSpec", "unknown")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, n):
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, o = table(spark, sf_dir, "documents"), table(spark, sf_dir, "orders")
    i = F.col("doc_id")
    stored = i % 11 != 0
    both = d.join(o.select(F.col("o_orderkey").alias("doc_id"), "o_orderdate"), "doc_id", "left")
    return both.select(
        i.cast("string").alias("photo_id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("description"), F.array("lang", "source").alias("tags"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date_taken"), F.when(stored, F.concat(i.cast("string"), F.lit(".jpg"))).alias("image_file"), F.when(stored, F.col("n_chars")).alias("image_bytes"),
        (i % 5).cast("int").alias("download_attempts"), F.when(i % 3 == 0, F.col("source")).alias("legacy_tag_label"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, keep = F.col("doc_id"), (F.col("quality") == 1) & (F.col("toxic") == 0)
    return table(spark, sf_dir, "labels").select(
        i.cast("string").alias("photo_id"),
        F.when(keep, KEEP_GATE).when(F.col("toxic") == 1, "people_event").otherwise("promotional_other").alias("gate_category"),
        F.when(keep, _pick(SUBJECTS[:13], i)).otherwise("not_applicable").alias("subject"), F.when(keep, _pick(MODALITIES[:4], i)).otherwise("not_applicable").alias("modality"),
        _pick(NAMES, i).alias("object_name"), F.when(i % 5 == 0, "multiple").otherwise(_pick(TOOLS, i)).alias("instrument"), F.lit("high").alias("confidence"), F.lit("r").alias("rationale"),
        F.lit("m").alias("model"), F.lit(True).alias("vision"), F.when(i % 2 == 0, "v2").otherwise("v6").alias("codebook_version"),
    )


def second_run(first: DataFrame) -> DataFrame:
    """The labels again, with every third subject and version changed."""
    n = F.col("photo_id").cast("long")
    turned = _pick(SUBJECTS[1:13] + SUBJECTS[:1], n)
    return first.withColumn("subject", F.when((n % 3 == 0) & (F.col("subject") != "not_applicable"), turned).otherwise(F.col("subject"))).withColumn("codebook_version", F.when(n % 3 != 1, "v7").otherwise(F.col("codebook_version")))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("photo_id"), F.col("embedding").alias("vector"))


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


#: The same views as common table expressions.
SQL = f"""photos_f AS (
  SELECT CAST(doc_id AS VARCHAR) AS photo_id, split_part(text, chr(10), 1) AS title, text AS description, [lang, source] AS tags, o_orderdate::TIMESTAMP AS date_taken,
    CASE WHEN doc_id % 11 <> 0 THEN doc_id || '.jpg' END AS image_file, CASE WHEN doc_id % 11 <> 0 THEN n_chars END AS image_bytes,
    (doc_id % 5)::INT AS download_attempts, CASE WHEN doc_id % 3 = 0 THEN source END AS legacy_tag_label
  FROM documents LEFT JOIN orders ON o_orderkey = doc_id
), labels_f AS (
  SELECT CAST(doc_id AS VARCHAR) AS photo_id,
    CASE WHEN quality = 1 AND toxic = 0 THEN '{KEEP_GATE}' WHEN toxic = 1 THEN 'people_event' ELSE 'promotional_other' END AS gate_category,
    CASE WHEN quality = 1 AND toxic = 0 THEN {_list(SUBJECTS[:13])}[doc_id % 13 + 1] ELSE 'not_applicable' END AS subject,
    CASE WHEN quality = 1 AND toxic = 0 THEN {_list(MODALITIES[:4])}[doc_id % 4 + 1] ELSE 'not_applicable' END AS modality,
    {_list(NAMES)}[doc_id % 8 + 1] AS object_name, CASE WHEN doc_id % 5 = 0 THEN 'multiple' ELSE {_list(TOOLS)}[doc_id % 4 + 1] END AS instrument,
    CASE WHEN doc_id % 2 = 0 THEN 'v2' ELSE 'v6' END AS codebook_version
  FROM labels
), run2_f AS (
  SELECT photo_id, gate_category, CASE WHEN photo_id::BIGINT % 3 = 0 AND subject <> 'not_applicable'
    THEN {_list(SUBJECTS[1:13] + SUBJECTS[:1])}[photo_id::BIGINT % 13 + 1] ELSE subject END AS subject,
    CASE WHEN photo_id::BIGINT % 3 <> 1 THEN 'v7' ELSE codebook_version END AS codebook_version
  FROM labels_f
), embeddings_f AS (
  SELECT CAST(vec_id AS VARCHAR) AS photo_id, embedding AS vector FROM embeddings
)"""
