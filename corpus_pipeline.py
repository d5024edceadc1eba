"""The corpus pipeline: stages that each write and reread the documents they keep.

All stages keep the input's columns, by exact name and place, so columns whose names clash with an operator's own do no harm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curatrix.llm import language_id
from curatrix.scratch import Scratch
from curatrix.llm.decontaminate import clean
from curatrix.llm.jaccard_join import one_of_each
from curatrix.llm.mixing import mixed
from curatrix.llm.sharding import in_shards


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those it rejects go.

    A null text and one without a letter have no language and go. If no document has both text and lang, nothing is known and all go.
    The model learns from rows whose crc32(doc_id) mod 4 isn't 2. Repeated rows stay repeated. No rows: no rows."""
    return language_id.accepted(spark, docs, language_id.fit(spark, docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id (null comes last).

    Of repeated rows one stays. Texts that are null or have no word are nobody's copies and all stay. No rows: no rows."""
    return one_of_each(spark, docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage.

    A text decides on its own, whatever other rows have its doc_id. Null and empty texts stay; an empty benchmark takes nothing away."""
    return clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken, three times at most.

    A null source is a source of its own. Rows of one doc_id are taken alike. A text without words (null, empty) counts nothing
    and is taken as often as its hash says; a source that has only such texts is left out. No rows: no rows."""
    return mixed(spark, docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their virtual slot and shard, in columns that replace any of the same name. Nulls are hashed like other values."""
    return in_shards(spark, docs)


STAGES = [
    ("language_id", known_language),
    ("near_copies", without_copies),
    ("decontamination", without_benchmark),
    ("mixing", to_weights),
    ("sharding", into_shards),
]

#: Language identification has no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage for documents; what the others keep is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
