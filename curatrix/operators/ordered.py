"""Joins and frames over an order, without a task that sees all rows or all of a frequent key: as-of join, points in ranges, windows over one total order."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators.grouping import numbered
from curatrix.scratch import Scratch

#: Rows of a key that an as-of join leaves together, keys that it cuts at most, and pieces of one.
KEY_ROWS, CUT_KEYS, PIECES = 200_000, 10_000, 64


def _struct(df: DataFrame, names: list[str]) -> Column:
    return F.struct(*(F.col(n) for n in names)) if names else F.struct(F.lit(True).alias("there"))


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, most: int = KEY_ROWS) -> DataFrame:
    """left, each row with the other columns of that row of right that has its key and the last time not after its own; nulls if there is none.

    Of rows of right with one key and time the largest counts. Null keys and times match nothing. Both sides are put in the order of each key once, and the last value is
    carried along. A key with more than `most` rows is cut at quantiles of its times; what is carried into a piece is the last value of the pieces before it."""
    spark, values = left.sparkSession, [c for c in right.columns if c not in (key, time)]
    kind = right.select(_struct(right, values).alias("_value")).schema["_value"].dataType
    sound = F.col(key).isNotNull() & F.col(time).isNotNull()
    versions = right.where(sound).groupBy(key, time).agg(F.max(_struct(right, values)).alias("_value"))
    rows = left.where(sound).withColumn("_left", F.lit(True)).withColumn("_value", F.lit(None).cast(kind))
    both = Scratch(spark, "asof").keep(rows.unionByName(versions.withColumn("_left", F.lit(False)), allowMissingColumns=True), "both")

    sizes = both.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    bound = max(most, total // CUT_KEYS)
    order = Window.partitionBy(key, "_piece").orderBy(time, "_left").rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last("_value", ignorenulls=True)
    if largest <= bound:
        found = both.withColumn("_piece", F.lit(0)).withColumn("_value", carried.over(order))
    else:
        steps = [i / PIECES for i in range(1, PIECES)]
        hot = F.broadcast(sizes.where(F.col("n") > bound).select(key))  # CUT_KEYS rows at most
        cuts = both.join(hot, key).groupBy(key).agg(F.percentile_approx(F.unix_micros(F.col(time).cast("timestamp")), steps, 1000).alias("_cuts"))
        cuts = Scratch(spark, "asof").keep(cuts, "cuts")
        at = F.unix_micros(F.col(time).cast("timestamp"))
        cut = both.join(F.broadcast(cuts), key, "left").withColumn("_at", at).withColumn("_piece", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_at"))), F.lit(0))).drop("_cuts", "_at")
        ends = cut.where(~F.col("_left")).join(F.broadcast(cuts.select(key)), key, "left_semi").groupBy(key, "_piece").agg(F.max_by("_value", time).alias("_end"))
        pieces = cuts.select(key, F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("_piece")).join(ends, [key, "_piece"], "left")
        before = F.last("_end", ignorenulls=True).over(Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
        inward = pieces.select(key, "_piece", before.alias("_before"))  # PIECES rows a cut key
        found = cut.withColumn("_value", carried.over(order)).join(F.broadcast(inward), [key, "_piece"], "left").withColumn("_value", F.coalesce("_value", "_before"))
    found = found.where("_left").select(*left.columns, "_value").unionByName(left.where(~sound).withColumn("_value", F.lit(None).cast(kind)))
    return found.select(*left.columns, *(F.col("_value").getField(v).alias(v) for v in values))


#: Bins of an interval join, a power of two.
BINS = 256


def _as_number(df: DataFrame, name: str) -> str:
    """SQL of a long or double in the order of the column's values."""
    kind = df.schema[name].dataType.typeName()
    if kind == "timestamp":
        return f"unix_micros(`{name}`)"
    if kind == "timestamp_ntz":  # as it stands, since a zone's hours may be skipped or come twice
        return f"unix_date(CAST(`{name}` AS DATE)) * 86400000000L + hour(`{name}`) * 3600000000L + minute(`{name}`) * 60000000L + CAST(extract(SECOND FROM `{name}`) * 1000000 AS BIGINT)"
    if kind == "date":
        return f"CAST(unix_date(`{name}`) AS BIGINT)"
    if kind in ("float", "double"):
        return f"CAST(`{name}` AS DOUBLE)"
    if kind in ("byte", "short", "integer", "long"):
        return f"CAST(`{name}` AS BIGINT)"
    raise ValueError(f"{name}: ranges of {kind} aren't supported")


def _from_number(df: DataFrame, name: str, number: str) -> Column:
    """The value that `_as_number` made a number of."""
    kind = df.schema[name].dataType
    made = {"timestamp": f"timestamp_micros({number})", "timestamp_ntz": f"TIMESTAMP_NTZ '1970-01-01' + make_dt_interval(0, 0, 0, CAST({number} AS DECIMAL(24, 0)) / 1000000)", "date": f"date_from_unix_date(CAST({number} AS INT))"}
    return F.expr(made.get(kind.typeName(), number)).cast(kind)


def _cuts(points: DataFrame, value: str, bins: int) -> list[int | float]:
    """The sorted bounds of bins of about the same number of points; `bins` values."""
    steps = [i / bins for i in range(1, bins)]
    return sorted(set(points.agg(F.percentile_approx(F.expr(_as_number(points, value)), steps, 10_000).alias("c")).first()["c"] or []))


def _bin(value: str, cuts: list[int | float], low: int = 0) -> str:
    """SQL of how many of the sorted cuts are not above the value, by halves."""
    if not cuts:
        return str(low)
    half = len(cuts) // 2
    cut = f"{cuts[half]}L" if isinstance(cuts[half], int) else f"{cuts[half]!r}D"
    return f"CASE WHEN {value} < {cut} THEN {_bin(value, cuts[:half], low)} ELSE {_bin(value, cuts[half + 1:], low + half + 1)} END"


def in_ranges(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, bins: int = BINS) -> DataFrame:
    """Each point with each range that holds it: low <= value < high. Columns of both; null values and bounds, and empty ranges, match nothing.

    Bins are quantiles of the points, so they hold about the same number of them. A range meets the points of its first and last bin one by one. The bins between are wholly in it: they are
    taken together by halves of halves, so a range is copied 2 log2(bins) times at most however long it is, and a point once for each
    width that some range has."""
    cuts = _cuts(points, value, bins)
    levels = max(1, len(cuts).bit_length())
    # one column first, so that its value is computed once a row
    ends = ranges.where(F.col(low) < F.col(high)).withColumn("_l", F.expr(_as_number(ranges, low))).withColumn("_h", F.expr(_as_number(ranges, high)))
    ends = ends.withColumn("_a", F.expr(_bin("_l", cuts))).withColumn("_b", F.expr(_bin("_h", cuts))).drop("_l", "_h")

    def nodes(a: Column, b: Column) -> Column:
        """Whole (width, place) that bins a + 1 to b - 1 fall into: at each width the odd ones at the ends."""
        out, first, last = [], a + 1, b - 1
        for width in range(levels + 1):
            start, end = first % 2 == 1, last % 2 == 0
            out.append(F.when((first <= last) & start, F.struct(F.lit(width).alias("width"), first.alias("place"))))
            out.append(F.when((first <= last) & end & ~(start & (first == last)), F.struct(F.lit(width).alias("width"), last.alias("place"))))
            first, last = F.floor((first + 1) / 2).cast("int"), (F.floor((last - 1) / 2)).cast("int")
        return F.array_compact(F.array(*out))

    edge = F.when(F.col("_a") == F.col("_b"), F.array("_a")).otherwise(F.array("_a", "_b"))
    own = points.where(F.col(value).isNotNull()).withColumn("_v", F.expr(_as_number(points, value))).withColumn("_bin", F.expr(_bin("_v", cuts))).drop("_v")
    edges = ends.withColumn("_bin", F.explode(edge)).drop("_a", "_b")
    checked = own.join(edges, "_bin").where((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("_bin")
    whole = ends.withColumn("_node", F.explode(nodes(F.col("_a"), F.col("_b")))).withColumn("_width", F.col("_node.width")).withColumn("_place", F.col("_node.place")).drop("_a", "_b", "_node")
    whole = Scratch(points.sparkSession, "ranges").keep(whole, "whole")
    widths = sorted(r._width for r in whole.select("_width").distinct().collect())  # log2(bins) rows
    if not widths:
        return checked
    at = F.explode(F.array(*(F.struct(F.lit(w).alias("_width"), F.shiftright("_bin", w).alias("_place")) for w in widths)))
    inside = own.withColumn("_node", at).select("*", "_node._width", "_node._place").drop("_node", "_bin").join(whole, ["_width", "_place"]).drop("_width", "_place")
    return checked.unionByName(inside.select(*checked.columns))


#: Ends of ranges that a task holds of a bin, about.
ENDS = 1_000_000


def _ends_met(ends: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
    """For each range that ends in a bin, the totals of the bin's points that it holds: sums by what is summed up before both of its ends, the least by two stretches of
    a power of two that cover it, the greatest by the last point."""
    points = points.sort_values("_v", kind="stable")
    v, n = points["_v"].to_numpy(), len(points)
    first, last = np.searchsorted(v, ends["_l"].to_numpy()), np.searchsorted(v, ends["_h"].to_numpy())
    there = np.flatnonzero(last > first)
    first, last = first[there], last[there]
    ahead = np.concatenate([[0], np.cumsum(points["_total"].to_numpy())])
    width = np.frexp((last - first).astype(float))[1] - 1  # of the logarithm's whole part
    least, level = np.empty(len(there), np.int64), points["_least"].to_numpy()
    for k in range(int(width.max()) + 1 if len(there) else 0):
        if k:
            level = np.minimum(level[: n - (1 << k) + 1], level[1 << k - 1 :])
        at = np.flatnonzero(width == k)
        least[at] = np.minimum(level[first[at]], level[last[at] - (1 << k)])
    return pd.DataFrame({"_l": ends["_l"].to_numpy()[there], "_h": ends["_h"].to_numpy()[there], "_total": ahead[last] - ahead[first], "_least": least, "_greatest": v[last - 1]})


def totals_in_ranges(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, total: str, least: str, bins: int = BINS) -> DataFrame:
    """Each different range (low, high) that holds a point, low <= value < high, with the sum of `total`, the least of `least` (both whole numbers, null counts as nothing) and the greatest value of its points.

    No pair of a point and a range is made. Ranges meet the points of the bins that they end in, sorted, by bisection; the bins between are summed once for each different pair of bins.
    So it takes about the logarithm of the points for each point and range, however many points a range holds."""
    scratch, kind = Scratch(points.sparkSession, "totals"), "double" if points.schema[value].dataType.typeName() in ("float", "double") else "long"
    none = 2**63 - 1
    own = points.where(F.col(value).isNotNull()).select(F.expr(_as_number(points, value)).alias("_v"), F.coalesce(F.col(total).cast("long"), F.lit(0)).alias("_total"), F.coalesce(F.col(least).cast("long"), F.lit(none)).alias("_least"))
    own = scratch.keep(own, "points")
    cuts = _cuts(own, "_v", bins)
    own = own.withColumn("_bin", F.expr(_bin("_v", cuts)))
    met = ranges.where(F.col(low) < F.col(high)).select(F.expr(_as_number(ranges, low)).cast(kind).alias("_l"), F.expr(_as_number(ranges, high)).cast(kind).alias("_h")).distinct()
    met = scratch.keep(met.withColumn("_a", F.expr(_bin("_l", cuts))).withColumn("_b", F.expr(_bin("_h", cuts))), "ranges")

    told = [F.sum("_total").alias("_total"), F.min("_least").alias("_least"), F.max("_greatest").alias("_greatest")]
    whole = own.groupBy(F.col("_bin").alias("bin")).agg(F.sum("_total").alias("_total"), F.min("_least").alias("_least"), F.max("_v").alias("_greatest"))  # a row for each bin
    between = met.where("_b - _a > 1").select((F.col("_a") + 1).alias("from"), F.col("_b").alias("to")).distinct()  # half of the bins' square at most
    held = in_ranges(scratch.keep(whole, "whole"), scratch.keep(between, "between"), "bin", "from", "to").groupBy("from", "to").agg(*told)
    inner = met.join(held, (F.col("_a") + 1 == F.col("from")) & (F.col("_b") == F.col("to"))).select("_l", "_h", "_total", "_least", "_greatest")

    ends = met.select("_l", "_h", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_bin"))
    parts = ends.groupBy("_bin").agg(F.ceil(F.count(F.lit(1)) / ENDS).cast("int").alias("_parts"))  # a row for each bin
    parts = F.broadcast(scratch.keep(parts, "parts"))
    dealt = ends.join(parts, "_bin").withColumn("_part", F.pmod(F.xxhash64("_l", "_h"), "_parts").cast("int")).drop("_parts")
    copied = own.join(parts, "_bin").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    edges = dealt.groupBy("_bin", "_part").cogroup(copied.groupBy("_bin", "_part")).applyInPandas(_ends_met, f"_l {kind}, _h {kind}, _total long, _least long, _greatest {kind}")
    out = edges.unionByName(inner).groupBy("_l", "_h").agg(*told)
    ends_of = [_from_number(ranges, low, "_l").alias(low), _from_number(ranges, high, "_h").alias(high)]
    return out.select(*ends_of, F.col("_total").alias(total), F.nullif(F.col("_least"), F.lit(none)).alias(least), _from_number(points, value, "_greatest").alias(value))


#: Rows of a block of a total order.
BLOCK_ROWS = 1_000_000


class TotalOrder:
    """Rows in the order of some columns, numbered once; windows over all of them are then made of blocks of equal size.

    The columns have to tell rows apart; where they don't, which row comes first is open."""

    def __init__(self, df: DataFrame, *order: str, block: int = BLOCK_ROWS) -> None:
        self.columns, self.order, self.block = df.columns, list(order), block
        placed = numbered(df.withColumn("_order", F.struct(*order)), "_order", "_row").drop("_order")
        self.rows = Scratch(df.sparkSession, "order").keep(placed, "rows")
        self.n = self.rows.count()

    def rolling(self, before: int, after: int = 0, **totals: Column) -> DataFrame:
        """The rows with aggregates over the rows from `before` places before to `after` places after each.

        A block also gets the `before` rows ahead of it and the `after` rows behind it, as many as the frame needs and no more."""
        block = max(self.block, before, after)
        at, place = F.floor(F.col("_row") / block), F.col("_row") % block
        copies = F.array_compact(F.array(at, F.when(place >= block - before, at + 1) if before else F.lit(None), F.when(place < after, at - 1) if after else F.lit(None)))
        spread = self.rows.withColumn("_home", at).withColumn("_block", F.explode(copies))
        frame = Window.partitionBy("_block").orderBy("_row").rowsBetween(-before, after)
        out = spread.select("*", *(t.over(frame).alias(n) for n, t in totals.items())).where("_home = _block")
        return out.select(*self.columns, *totals)

    def lagged(self, places: int, **values: str) -> DataFrame:
        """The rows with the values that the row `places` before has, null for the first rows; negative: after."""
        back, on = max(places, 0), max(-places, 0)
        edge = (F.first if places > 0 else F.last)(F.struct("_row", *dict.fromkeys(values.values())))
        reached = F.col("_row") >= places if places > 0 else F.col("_row") < self.n + places
        out = self.rolling_with_row(back, on, _edge=edge)
        return out.select(*self.columns, *(F.when(reached, F.col("_edge").getField(v)).alias(n) for n, v in values.items()))

    def rolling_with_row(self, before: int, after: int, **totals: Column) -> DataFrame:
        columns, self.columns = self.columns, [*self.columns, "_row"]
        try:
            return self.rolling(before, after, **totals)
        finally:
            self.columns = columns

    def running(self, **sums: str) -> DataFrame:
        """The rows with the sums of columns up to and with each row: sums within blocks, and those of the blocks before, of which there is a row each."""
        placed = self.rows.withColumn("_block", F.floor(F.col("_row") / self.block))
        blocks = placed.groupBy("_block").agg(*(F.sum(c).alias(f"_of_{n}") for n, c in sums.items()))
        ahead = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.select("_block", *(F.coalesce(F.sum(f"_of_{n}").over(ahead), F.lit(0)).alias(f"_of_{n}") for n in sums))
        within = Window.partitionBy("_block").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
        out = placed.select("*", *(F.sum(c).over(within).alias(f"_in_{n}") for n, c in sums.items())).join(blocks, "_block")
        return out.select(*self.columns, *((F.coalesce(f"_in_{n}", F.lit(0)) + F.col(f"_of_{n}")).alias(n) for n in sums))

    def ranks(self, *by: str, tiles: int = 100) -> DataFrame:
        """The rows with row_number, ntile by their place, and rank, percent_rank and cume_dist by the columns `by`, which the order has to begin with.

        Ties share the place of the first of them, which a partial aggregation tells."""
        if list(by) != self.order[: len(by)]:
            raise ValueError("ranks go by the first columns of the order")
        same = self.rows.groupBy(*by).agg(F.min("_row").alias("_first"), F.max("_row").alias("_last"))
        equal = reduce(lambda a, b: a & b, (F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by))
        out = self.rows.alias("r").join(same.alias("s"), equal)
        small, large = self.n // tiles, self.n % tiles  # the first tiles have one row more
        row = F.col("_row")
        tile = F.when(row < large * (small + 1), F.floor(row / (small + 1))).otherwise(large + F.floor((row - large * (small + 1)) / max(small, 1)))
        told = {"row_number": row + 1, "ntile": tile.cast("int") + 1, "rank": F.col("_first") + 1, "percent_rank": F.col("_first") / max(self.n - 1, 1), "cume_dist": (F.col("_last") + 1) / max(self.n, 1)}
        return out.select(*(F.col(f"r.{c}").alias(c) for c in self.columns), *(c.alias(n) for n, c in told.items()))
