"""The label log as a stream: new files are folded into the table, the newest record of an id wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from curatrix.operators.grouping import latest
from curatrix.operators.state import Tables


def fold_log(spark: SparkSession, source: str, schema: StructType, tables: Tables, name: str, key: str, position: str, checkpoint: str) -> StreamingQuery:
    """Read the JSON files that are new since the last run, and stop. A batch that is run again gives the same table.

    The table keeps each row's position, so that a late file with older records doesn't overwrite newer ones."""

    def fold(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            old = tables.read(name, schema)
            tables.commit(name, latest(old.unionByName(batch.select(*old.columns)), key, position).select(*old.columns))

    stream = spark.readStream.schema(schema).json(source)
    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by kind and time window, closed by a watermark; works on streams and on tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
