"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks.

Unit vectors with cosine c are sqrt(2 - 2c) apart. In each of TABLES tables a vector's bucket is floor((a v + b) / width) for
PROJECTIONS Gaussian projections; vectors of one bucket are compared exactly in double precision.
Equal vectors are one class. Every class that shares a bucket belongs to a group, named after the smallest class that is in any of its
buckets; a group's vectors are brought together once and compared, and a pair counts if it shares a bucket of any table. Buckets whose
classes are in different groups are compared too; there a pair of different groups counts in the first table whose bucket it shares.
Groups and buckets are dealt out in blocks of bounded size and pairs of blocks, so that no task holds a whole one, and no task
returns pairs: only a count for each class and a spanning forest of its links. Tasks get vectors, not bucket keys, which they compute anew.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import common
from curatrix.llm.common import doc_rows, salted_join, with_totals
from curatrix.scratch import Scratch
from curatrix.operators.graph import components

THRESHOLD = 0.95
#: At cosine 0.95 one projection agrees with probability 0.873, a table with 0.087, one of the tables with 0.96; at 0.97 with 0.995.
WIDTH, PROJECTIONS, TABLES, SEED = 2.0, 18, 36, 7
#: Classes that one side of a comparison holds at most.
BLOCK = 1024


def _projections(dim: int, tables: int, each: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * each)), rng.uniform(0, width, tables * each)


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square overflows or vanishes."""
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _keys(unit: np.ndarray, tables: int, each: int, width: float, seed: int) -> np.ndarray:
    """Bucket of each vector in each table: the table's cells folded into 64 bits, the last 6 of which are the table's number."""
    dim = unit.shape[1]
    axes, shift = _projections(dim, tables, each, width, seed)
    cells = np.floor((unit @ axes + shift) / width).astype(np.int64).view(np.uint64)
    odd = np.random.default_rng([seed, 1]).integers(1, 1 << 62, each, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = (cells.reshape(len(unit), tables, each) * odd).sum(axis=2, dtype=np.uint64) + np.array(dim, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(32)
    return ((keys & ~np.uint64(63)) | np.arange(tables, dtype=np.uint64)).view(np.int64)


def _by_length(vectors: pd.Series):
    """The places of vectors of each length, and the vectors scaled to length 1."""
    sizes = vectors.map(len).to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, _unit(vectors.iloc[at])


def _buckets(frames, keyed):
    """Bucket keys of all tables for each class."""
    for whole in frames:
        for at in range(0, len(whole), BLOCK):
            frame = whole.iloc[at : at + BLOCK]
            out = [None] * len(frame)
            for rows, unit in _by_length(frame["embedding"]):
                for i, k in zip(rows, keyed(unit), strict=True):
                    out[i] = k
            yield pd.DataFrame({"cls": frame["cls"].to_numpy(), "keys": out})


#: Rows of comparisons that are smaller than this are compared together, pair by pair.
SMALL = 48


def _compare_large(frame: pd.DataFrame, unit: np.ndarray, keys: np.ndarray, threshold: float) -> pd.DataFrame:
    """Links between the two blocks of a comparison, or within one: for each class how many vectors it links with, and a root."""
    one, bucket = int(frame["lo"].iloc[0]) == int(frame["hi"].iloc[0]), bool(frame["kind"].iloc[0])
    cls, copies, group = frame["cls"].to_numpy(), frame["copies"].to_numpy(), frame["grp"].to_numpy()
    n = len(frame)
    a = n if one else int((frame["side"] == 0).sum())
    left, right = slice(0, a), slice(0, n) if one else slice(a, n)
    linked = unit[left] @ unit[right].T >= threshold
    same = lambda t: keys[left, t][:, None] == keys[right, t][None, :]
    if bucket:
        linked &= group[left][:, None] != group[right][None, :]
        for t in range(int(frame["id"].iloc[0]) & 63):
            if not linked.any():
                break
            linked &= ~same(t)
    else:
        open_ = linked.copy()
        for t in range(keys.shape[1]):
            if not open_.any():
                break
            open_ &= ~same(t)
        linked &= ~open_
    if one:
        np.fill_diagonal(linked, False)
    links = np.zeros(n, np.int64)
    links[left] += linked @ copies[right]
    if not one:
        links[right] += copies[left] @ linked
    x, y = np.nonzero(linked)
    # a forest of the links is enough for components
    roots = _roots(linked, a, n, one, x, y)
    told = (links > 0) | (roots != np.arange(n))
    return pd.DataFrame({"cls": cls[told], "links": links[told], "root": cls[roots[told]]})


def _compare_small(frame: pd.DataFrame, unit: np.ndarray, keys: np.ndarray, number: np.ndarray, threshold: float) -> pd.DataFrame:
    """The same for many small comparisons at once; number: the comparison of each row, in order."""
    one, side, bucket = (frame["lo"] == frame["hi"]).to_numpy(), frame["side"].to_numpy(), frame["kind"].to_numpy() == 1
    table, group = (frame["id"].to_numpy() & 63), frame["grp"].to_numpy()
    cls, copies = frame["cls"].to_numpy(), frame["copies"].to_numpy()
    out, links = [], np.zeros(len(frame), np.int64)
    tables = np.arange(keys.shape[1])
    for step in range(1, SMALL):
        i = np.flatnonzero(number[:-step] == number[step:]) if step < len(number) else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[one[i] | (side[i] != side[i + step])]
        i = i[~bucket[i] | (group[i] != group[i + step])]
        i = i[np.einsum("ij,ij->i", unit[i], unit[i + step]) >= threshold]
        same = keys[i] == keys[i + step]
        i = i[np.where(bucket[i], ~(same & (tables < table[i][:, None])).any(axis=1), same.any(axis=1))]
        np.add.at(links, i, copies[i + step])
        np.add.at(links, i + step, copies[i])
        out.append(pd.DataFrame({"cls": cls[i + step], "links": np.zeros(len(i), np.int64), "root": cls[i]}))
    told = links > 0
    return pd.concat([*out, pd.DataFrame({"cls": cls[told], "links": links[told], "root": cls[told]})])


def _compare(frames, threshold: float, keyed):
    """Rows come sorted by comparison. The last comparison of a batch waits for the next batch; it has two blocks at most."""
    rest, names = None, ["kind", "id", "lo", "hi"]

    def done(frame: pd.DataFrame):
        at = frame[names].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]).any(axis=1), [True]]))
        sizes = np.diff(cuts)
        number = np.repeat(np.arange(len(sizes)), sizes)
        found = list(_by_length(frame["embedding"]))
        unit = np.zeros((len(frame), max(u.shape[1] for _, u in found)))  # vectors that share a bucket are equally long
        keys = None
        for rows, u in found:
            unit[rows, : u.shape[1]] = u
            k = keyed(u)
            keys = np.zeros((len(frame), k.shape[1]), np.int64) if keys is None else keys
            keys[rows] = k
        small = np.repeat(sizes < SMALL, sizes)
        if small.any():
            yield _compare_small(frame[small], unit[small], keys[small], number[small], threshold)
        for k in np.flatnonzero(sizes >= SMALL):
            rows = slice(cuts[k], cuts[k + 1])
            yield _compare_large(frame.iloc[rows], unit[rows], keys[rows], threshold)

    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        last = (frame[names].to_numpy() != frame[names].iloc[-1].to_numpy()).any(axis=1)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            yield from done(frame.iloc[:cut].reset_index(drop=True))
        rest = frame.iloc[cut:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield from done(rest)


def _in_blocks(rows: DataFrame, kind: int) -> DataFrame:
    """Comparisons (kind, id, lo, hi) that each row of (id, size, cls, grp) takes part in, and on which side.

    What has one id is dealt into blocks of about BLOCK, and every pair of blocks is a comparison."""
    dealt = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("cls", "id"), "blocks").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("lo"), F.greatest("block", o).alias("hi"), (F.col("block") > o).cast("int").alias("side")))
    return dealt.select("cls", "grp", F.lit(kind).alias("kind"), "id", F.explode(others).alias("at")).select("cls", "grp", "kind", "id", "at.*")


def _roots(linked: np.ndarray, a: int, n: int, one: bool, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first member of each item's group under the links."""
    root = np.arange(n)
    if not len(x):
        return root
    y = y if one else y + a
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors(vec_id, embedding).

    Links are pairs found with cosine >= threshold; copies of a vector link with one another and with the same others.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing: n_links 0, a component of their own.
    Vectors of different lengths don't link. A null vec_id is never the name of a component unless it's alone. No rows: no rows.
    """
    if tables > 64:
        raise ValueError("64 tables at most")
    scratch = Scratch(spark, "vectors")
    keyed = partial(_keys, tables=tables, each=projections, width=width, seed=seed)
    rows = doc_rows(vectors, "vec_id", "embedding")
    number = vectors.schema["embedding"].dataType.elementType.simpleString()
    number = number if number in ("float", "double") else "double"
    rows = rows.withColumn("embedding", F.col("embedding").cast(f"array<{number}>"))
    sound = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0.0), F.lit(False))
    # -0.0 and 0.0 are the same component
    rows = rows.withColumn("embedding", F.when(sound, F.transform("embedding", lambda x: x + F.lit(0.0).cast(number))))
    rows = rows.withColumn("cls", F.when(sound, F.xxhash64("embedding")))
    copies = F.count(F.lit(1)).alias("copies")
    classes = scratch.keep(rows.where("cls is not null").groupBy("cls").agg(copies, F.first("embedding").alias("embedding")), "classes")
    of = scratch.keep(rows.select("vec_id", "cls"), "rows")

    # buckets of two classes at least; what travels is 16 bytes a table
    def members(some: DataFrame) -> DataFrame:
        return some.select("cls", "embedding").mapInPandas(partial(_buckets, keyed=keyed), "cls long, keys array<long>").select("cls", F.explode("keys").alias("bucket"))

    seen = members(classes.where(F.pmod(F.xxhash64("cls"), F.lit(common.GLANCE)) == 0)).groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    met = scratch.keep(with_totals(members(classes), "bucket", "cls", seen, {"size": F.count(F.lit(1)), "low": F.min("cls")}, "size > 1"), "met")
    groups = scratch.keep(met.groupBy("cls").agg(F.min("low").alias("grp")), "groups")
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    whole = salted_join(groups, sizes, ["grp"], sizes, "cls").select("cls", "grp", F.col("grp").alias("id"), "size")
    # buckets whose classes are of several groups
    both = scratch.keep(met.join(groups, "cls").select("cls", "grp", F.col("bucket").alias("id"), "size"), "both")
    mixed = both.groupBy("id", "size").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo <> hi").select("id", "size")
    mixed = salted_join(both.drop("size"), mixed, ["id"], mixed, "cls").select("cls", "grp", "id", "size")

    sides = _in_blocks(whole.where("size > 1"), 0).unionByName(_in_blocks(mixed, 1))
    comparison = ["kind", "id", "lo", "hi"]
    dealt = sides.join(classes, "cls").select(*comparison, "side", "cls", "grp", "copies", "embedding").repartition(*comparison).sortWithinPartitions(*comparison, "side", "cls")
    found = dealt.mapInPandas(partial(_compare, threshold=threshold, keyed=keyed), "cls long, links long, root long")
    found = scratch.keep(found, "found")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    labels = components(spark, found.where("cls <> root").select("cls", "root").distinct(), "cls", "root").select(F.col("node").alias("cls"), "label")
    per_class = classes.select("cls", "copies").join(counts, "cls", "left").join(labels, "cls", "left")
    per_class = scratch.keep(per_class.select("cls", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "cls").alias("label")), "per_class")
    # copies of one vector, or a group, may be a large share of all rows
    of = salted_join(of, per_class.drop("copies"), ["cls"], per_class.select("cls", F.col("copies").alias("size")), "vec_id", "left")
    least = of.where("label is not null").groupBy("label").agg(F.min("vec_id").alias("least"))
    named = salted_join(of, least, ["label"], per_class.groupBy("label").agg(F.sum("copies").alias("size")), "vec_id", "left")
    named = named.withColumn("component_id", F.coalesce("least", "vec_id"))
    return named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
