"""Counts, distinct values, quantiles and frequent values as states that are stored by version and merged, so that no version is read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^LG registers of a distinct count: its relative standard error is 1.04 / 2^(LG / 2), 1.6 % here. K of a quantile sketch: rank error about 1.7 / K, below 1 %.
LG, K = 12, 400
#: Counters of a frequent-values sketch. Its counts are at most rows / (0.75 * COUNTERS) off.
COUNTERS = 4096


def sketched(df: DataFrame, sets: list[tuple[str, ...]], key: str, number: str, value: str) -> DataFrame:
    """A row of states for each group of each grouping set, in one pass: rows, ids (distinct key), numbers (quantiles of whole numbers) and values (frequent ones).

    grouped says which of the columns a row's group is made of (bit i: column i of all is summed over). Nulls in key, number and value count in rows only."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    states = [
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(key), F.lit(LG)).alias("ids"), F.kll_sketch_agg_bigint(F.col(number).cast("long"), F.lit(K)).alias("numbers"),
        F.expr(f"approx_top_k_accumulate(`{value}`, {COUNTERS})").alias("values"),
    ]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.grouping_id().alias("grouped"), *states).select(*columns, "grouped", "rows", "ids", "numbers", "values")


def merged(states: DataFrame, *by: str) -> DataFrame:
    """The states of groups, added up over what they are stored by, such as versions. Equal to the states of all their rows, up to the sketches' error."""
    return states.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_bigint("numbers").alias("numbers"), F.expr(f"approx_top_k_combine(`values`, {COUNTERS})").alias("values")
    )


def estimates(states: DataFrame, quantiles: tuple[float, ...] = (0.1, 0.5, 0.9), top: int = 5) -> DataFrame:
    """What the states say: rows, distinct, quantiles as an array, and the `top` most frequent values with their counts."""
    at = F.array(*(F.kll_sketch_get_quantile_bigint("numbers", F.lit(q)) for q in quantiles))
    empty = F.kll_sketch_get_n_bigint("numbers") == 0
    rest = [c for c in states.columns if c not in ("rows", "ids", "numbers", "values")]
    return states.select(*rest, "rows", F.hll_sketch_estimate("ids").alias("distinct"), F.when(~empty, at).alias("quantiles"), F.expr(f"approx_top_k_estimate(`values`, {top})").alias("top"))
