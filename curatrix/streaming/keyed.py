"""Streams with state by key: the newest record of each key, and sessions. Late records are refused, and state lasts only while it can matter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from curatrix.operators.changes import ChangeTable

Frames = Iterator[pd.DataFrame]


def _newest_of_each(key: str, position: str) -> Callable[[Frames], Frames]:
    def run(frames: Frames) -> Frames:
        for frame in frames:
            yield frame.sort_values(["_at", position], kind="stable").drop_duplicates(key, keep="last")

    return run


def newest_changes(stream: DataFrame, key: str, time: str, position: str, late: str = "1 day") -> DataFrame:
    """The records of the stream that become the newest of their key, by time and then position, with the stream's columns; for the output mode update.

    Of each key the state holds time and position of the newest record. Records older than the watermark, which is `late` behind the newest time that was seen before, are refused.
    So once the watermark passes a key's time, nothing older can come and the state expires: it is bounded by the keys of the time that the watermark leaves open.
    Each task hands on only the newest record of a key among those that it reads at once, so that a frequent key doesn't travel whole. Records with a null key, time or
    position are left out. Equal time and position: the first one that came stays."""
    names, kind = stream.columns, stream.schema
    sound = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col(position).isNotNull())
    timed = sound.withColumn("_at", F.unix_micros(F.col(time).cast("timestamp"))).withColumn("_event", F.timestamp_micros(F.col("_at")))
    few = timed.mapInPandas(_newest_of_each(key, position), timed.schema).withWatermark("_event", late)
    place = kind[position].dataType.simpleString()

    def fold(_: tuple, frames: Frames, state: GroupState) -> Frames:
        if state.hasTimedOut:
            state.remove()
            return
        newest, best = state.get if state.exists else None, None
        for frame in frames:
            row = frame.sort_values(["_at", position], kind="stable").iloc[[-1]]
            at = (int(row["_at"].iloc[0]), row[position].iloc[0])
            if newest is None or at > tuple(newest):
                newest, best = at, row
        if best is not None:
            state.update((newest[0], best[position].astype(object).iloc[0]))
            yield best[names]
        state.setTimeoutTimestamp(max(newest[0] // 1000, state.getCurrentWatermarkMs()) + 1)

    return few.groupBy(key).applyInPandasWithState(fold, kind, f"at long, place {place}", "update", GroupStateTimeout.EventTimeTimeout)


def fold_into(table: ChangeTable, changes: DataFrame, checkpoint: str) -> StreamingQuery:
    """Write what newest_changes says into the table, as far as there is input, and stop. A run begins where the last one with this checkpoint ended.

    Each batch writes only the rows that changed; one that is run again writes the same rows again, which changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        table.write(batch.select(*table.schema.names))

    return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, key: str, time: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """key, start, end, n: runs of events of a key with less than `gap` between them, `end` the last event's time plus gap; for the output mode append.

    A session comes out once the watermark, `late` behind the newest time, has passed its end; an event that would be the start of a session which has
    ended by then is refused. On a table all sessions come out."""
    timed = events.select(F.col(key), F.col(time).cast("timestamp").alias("_time")).where(F.col(key).isNotNull()).withWatermark("_time", late)
    found = timed.groupBy(F.session_window("_time", gap).alias("session"), key).agg(F.count(F.lit(1)).alias("n"))
    return found.select(key, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")


def append_to(path: str, rows: DataFrame, checkpoint: str) -> StreamingQuery:
    """Add what comes out to a folder of Parquet, each row once, as far as there is input, and stop."""
    return rows.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
