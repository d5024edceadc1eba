"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. A source whose target is q whole passes and a rest takes each document q
times, and once more those whose hash is below the source's threshold. The threshold comes from sums of words by
hash bucket: the bucket in which the running sum passes the rest is found, then only its documents are summed again by
finer buckets, and so on. Nothing is sorted but the few sums of one source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows, n_words
from curatrix.scratch import Scratch

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its size.
MOST = 3
HASH_BITS, LEVEL_BITS, LEVELS = 60, 10, 3


def hash60(doc_id) -> "F.Column":
    """The first 60 bits of the MD5 of the id as text; a null id counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size and target, by filling up: shares by weight, none above `most` times its source's size.

    One row for each source; the windows go over these sums only."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sums.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))) + 1).cast("long"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.asc_nulls_last("source"))
    whole = Window.partitionBy()
    filled = (
        weighed.withColumn("cap", most * F.col("source_size"))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("w_after", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(whole) - F.col("before")).cast("double") / F.col("w_after"))
        .withColumn("full", F.col("cap") <= F.col("w") * F.col("level"))
        .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(whole))
    )
    return filled.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("level")).alias("target"))


def _sizes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    columns = doc_rows(docs, "doc_id", "source", "text")
    return scratch.keep(columns.select("doc_id", "source", n_words(F.col("text")).alias("size"), hash60(F.col("doc_id")).alias("u")), "sizes")


def _thresholds(rows: DataFrame, scratch: Scratch, weights: tuple[int, ...], most: int) -> DataFrame:
    """s (source), source_size, target, q (passes over the whole source) and cut (hashes below it are taken once more)."""
    goals = source_targets(rows, weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    at = goals.withColumn("q", passes).withColumn("rest", F.col("target") - F.col("q") * F.col("source_size"))
    at = scratch.keep(at.withColumn("bucket", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")).withColumn("inside", F.col("source_size")), "at0")
    for level in range(1, LEVELS + 1):
        above = F.shiftright("u", HASH_BITS - LEVEL_BITS * (level - 1))
        part = F.shiftright("u", HASH_BITS - LEVEL_BITS * level)
        bounds = at.select(F.col("source").alias("s"), "bucket", "below", "rest")
        inside = rows.join(bounds, F.col("source").eqNullSafe(F.col("s")) & (above == F.col("bucket")))
        sums = inside.groupBy("source", "below", "rest", part.alias("part")).agg(F.sum("size").alias("words"))
        upto = F.col("below") + F.sum("words").over(Window.partitionBy("source").orderBy("part"))
        # the first part whose running sum passes the rest, or the last part
        edge = sums.withColumn("upto", upto).withColumn("key", F.when(F.col("upto") > F.col("rest"), F.col("part")))
        edge = edge.groupBy("source").agg(F.coalesce(F.min_by(F.struct("part", "upto", "words"), "key"), F.max_by(F.struct("part", "upto", "words"), "part")).alias("e"))
        edge = edge.select(F.col("source").alias("s"), F.col("e.part").alias("bucket"), (F.col("e.upto") - F.col("e.words")).alias("below"), F.col("e.words").alias("inside"))
        at = scratch.keep(at.drop("bucket", "below", "inside").join(edge, F.col("source").eqNullSafe(F.col("s"))).drop("s"), f"at{level}")
    nearer = (F.col("below") + F.col("inside") - F.col("rest")) < (F.col("rest") - F.col("below"))
    return at.select(F.col("source").alias("s"), "source_size", "target", "q", F.shiftleft(F.col("bucket") + nearer.cast("long"), HASH_BITS - LEVEL_BITS * LEVELS).alias("cut"))


def _copies(most: int) -> "F.Column":
    times = F.least(F.col("q") + (F.col("u") < F.col("cut")).cast("long"), F.lit(most))
    return F.when(F.col("source_size") > 0, times).otherwise(0).cast("long")


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies for every row of docs(doc_id, text, source).

    copies is how often the mix takes the row, taken = size * copies. A null text has size 0; a null source is a source of
    its own, the last. Rows with one doc_id share a hash and are taken alike, so reruns agree. A source without words has
    target 0, and its documents are left out. No rows: no rows.
    """
    scratch = Scratch(spark, "mixing")
    rows = _sizes(docs, scratch)
    cuts = _thresholds(rows, scratch, weights, most)
    taken = rows.join(cuts, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies(most))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows that the mix takes, all columns as they are, each as often as it's taken."""
    scratch = Scratch(spark, "mixing")
    cuts = scratch.keep(_thresholds(_sizes(docs, scratch), scratch, weights, most), "cuts")
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, source = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "source"))
    both = docs.toDF(*names).withColumn("u", hash60(doc_id)).join(cuts, source.eqNullSafe(F.col("s"))).withColumn("copies", _copies(most))
    return both.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*names).toDF(*docs.columns)
