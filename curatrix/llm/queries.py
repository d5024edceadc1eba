"""One registered query for each training-data operator, over its whole table, and the SQL that expresses it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import language_id, secrets, toxicity
from curatrix.llm.decontaminate import leaks
from curatrix.llm.embedding_dedup import near_duplicates
from curatrix.llm.jaccard_join import jaccard_classes
from curatrix.llm.line_dedup import dedup_lines
from curatrix.llm.mixing import mix
from curatrix.llm.ranked_search import ranked
from curatrix.llm.sharding import shard
from curatrix.llm.spelling import variants
from curatrix.llm.token_counts import document_tokens
from curatrix.llm.topk import top_k


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spark, _table(spark, sf_dir, "documents"), grams=True)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(spark, docs, language_id.fit(spark, docs))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark, _table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, _table(spark, sf_dir, "documents")).drop("copies")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(spark, docs, toxicity.fit(spark, docs, _table(spark, sf_dir, "labels")))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark, _table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(spark, _table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, _table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark, _table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, _table(spark, sf_dir, "documents"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, _table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op7 tells of the fixed patterns, which SQL can say as well."""
    return op7_secret_scans(spark, sf_dir).drop("spans")


def embedding_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9 over the vectors and copies of some of them (scaled, moved a little, exact), so that there are links."""
    rows, n = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id")
    kind = rows.schema["embedding"].dataType
    scaled = F.transform("embedding", lambda x: (3 * x).cast("float")).cast(kind)
    moved = F.transform("embedding", lambda x, i: (x.cast("double") + F.when((i + 1) % 8 == n % 8, 0.02).otherwise(0.0)).cast("float")).cast(kind)
    parts = [rows.where(chosen).select((n + k * 10**12).alias("vec_id"), v.alias("embedding")) for k, chosen, v in ((1, n % 3 == 0, scaled), (2, n % 2 == 0, moved), (3, n % 5 == 0, F.col("embedding")))]
    return near_duplicates(spark, reduce(DataFrame.unionByName, parts, rows))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_benchmark_decontamination": op2_benchmark_decontamination,
        "op3_language_id": op3_language_id,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_mixing": op5_mixing,
        "op6_toxicity": op6_toxicity,
        "op7_secret_scans": op7_secret_scans,
        "op8_token_counts": op8_token_counts,
        "op9_embedding_near_dedup": op9_embedding_near_dedup,
        "op10_sharding": op10_sharding,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_exact_top_k": op12_exact_top_k,
        "op13_ranked_search": op13_ranked_search,
        "secret_base_spans": secret_base_spans,
        "embedding_copies": embedding_copies,
    }


def oracle_sql() -> dict[str, str]:
    from curatrix.llm.oracles import SQL

    return dict(SQL)
