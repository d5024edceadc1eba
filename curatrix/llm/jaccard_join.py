"""N-gram Jaccard join: pivots, Voronoi regions and triangle-inequality windows, applied recursively.

The distance of two documents is 1 - J of their sets of distinct 5-word shingles (of the lower-cased words; a
shorter text is one shingle). It is a metric, so with radius r = 1 - threshold:

1. Texts with the same set form one class; a class with no partner is put aside. In hash order, two sets within r
   share at least k of their first n - ceil(t n) + k shingles, so a class that shares fewer of its own with any other
   class is alone. Only those prefixes are shuffled, never all shingles; of a shingle that a task finds in several classes, it
   sends the smallest and the largest class and has counted the others already.
2. Pivots: under several hash functions, of the classes with the same smallest shingle the one whose shingles are the
   most frequent, which is the middle of a group of edited copies. Every class
   is in the region of its nearest pivot within r (its own pivot if there is none), and linked with it. All members of a
   region are therefore in one component; pairs in it need no further look.
3. Boundary documents are replicated: y is compared with region p of another component if they share a shingle
   of their rare-first prefixes and d(y, p) <= a(p) + r, where a(p) is the region's radius.
   The document of the smaller region goes to the larger one.
4. A region of more than REGION members that boundary documents visit is joined recursively: it gets pivots of its own, by
   the next hash function, each member goes to its own pivot's region, and boundary documents to those whose windows they are in.
   Regions that LEVELS such steps leave large are dealt into blocks, which together hold every pair.
5. In the regions that remain, only those x with |d(x, p) - d(y, p)| <= r are compared with y, and of these only such as can have
   enough in common: in the pivot's set as much as the one that has less of it, outside as much as the one that has fewer shared
   shingles there. By the triangle inequality this meets every linked pair of different components.

Words, shingles and sets have hashes of 64 bits, and documents link if these say so: of n different texts, about n^2 / 2^65 pairs
get one set hash by chance (300 of 10^11 texts); other than by such chance, nothing is missed or linked wrongly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm import common
from curatrix.llm.common import HOT_KEYS, doc_rows, hash_words, lists, mix64, salted_join, shingle_sets, slices, text_buffers, with_totals
from curatrix.scratch import Scratch
from curatrix.operators.graph import components

WIDTH = 5
#: Two documents link when DEN * intersection >= NUM * union.
NUM, DEN = 75, 100
#: Share of a set by which the prefixes of step 1 are longer than one common shingle needs.
MARGIN = 10
#: Hash functions that choose pivots.
PIVOT_HASHES = 4
#: Members of a region that is joined as it is, and how often larger ones are divided by pivots of their own.
REGION, LEVELS = 1024, 3
#: Prefix shingles that a task looks at together.
CHUNK = 1 << 20
#: Row keys up to this number are broadcast (16 bytes each), more are shuffled.
BROADCAST_ROWS = 400_000


def _sets(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    flat, bounds = text_buffers(batch.column("text"))
    hashes, doc, _, _ = hash_words(flat, bounds)
    return list(shingle_sets(hashes, doc, len(batch), width))


def _class(values: np.ndarray) -> int:
    return int((mix64(values + np.uint64(1)).sum(dtype=np.uint64) ^ mix64(np.array([len(values)], np.uint64))[0]).view(np.int64))


def _classes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Class and set size of each text."""
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = _sets(batch, width)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(map(_class, sets), pa.int64()), pa.array(map(len, sets), pa.int64())], ["doc_id", "row_key", "cls", "n"])


def _decided(keys: list[int], heads: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (h, cls, shares) of some classes' prefixes, each class once.

    shares 1: a shingle h that one of these classes has. 0: the smallest and the largest of several classes that have it. Below 0: of how
    many of its shingles a class is known to share them with others of these classes; then h is a number of the class's own."""
    cls, of = np.array(keys, np.int64), np.repeat(np.arange(len(keys)), [len(x) for x in heads])
    h = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
    order = np.argsort(h, kind="stable")
    h, of = h[order].view(np.int64), of[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(h)))
    alone, many = starts[sizes == 1], starts[sizes > 1]
    shared = np.bincount(of[np.repeat(sizes > 1, sizes)], minlength=len(cls))
    told = cls[np.flatnonzero(shared)]
    of_cls = cls[of]
    low, high = (f.reduceat(of_cls, starts)[sizes > 1] if len(starts) else of_cls for f in (np.minimum, np.maximum))
    columns = [
        np.concatenate([h[alone], h[many], h[many], mix64(told.view(np.uint64)).view(np.int64)]),
        np.concatenate([of_cls[alone], low, high, told]),
        np.concatenate([np.ones(len(alone), np.int64), np.zeros(2 * len(many), np.int64), -shared[shared > 0]]).astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "cls", "shares"])


def _prefixes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Hash-order prefixes of the texts, as _decided tells them; a task looks at those of a class once."""
    told: set[int] = set()
    keys, heads, size = [], [], 0
    for whole in batches:
        for batch in slices(whole, "text"):
            for values in _sets(batch, width):
                n, key = len(values), _class(values)
                if n and key not in told:
                    told.add(key)
                    keys.append(key)
                    heads.append(values[: n - -(-NUM * n // DEN) + -(-n // MARGIN)])
                    size += len(heads[-1])
            if size >= CHUNK:
                yield _decided(keys, heads)
                keys, heads, size = [], [], 0
    yield _decided(keys, heads)


def _whole_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = [x for x in _sets(batch, width) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([_class(x) for x in sets], pa.int64()), pa.array(list(map(len, sets)), pa.int64()), lists(sets)], ["cls", "n", "items"])


def _least(n, num: int, den: int):
    """ceil(num n / den) as a column."""
    return F.floor((n * num + (den - 1)) / den).cast("long")


def _prefix_rows(sets: DataFrame, num: int, den: int) -> DataFrame:
    """A row for each shingle of the rare-first prefix that a partner of similarity num / den shares one of.

    `items` holds, rare first, the shingles of two classes at least; the n - size(items) others come before them."""
    room = F.col("n") - _least(F.col("n"), num, den) + 1 - (F.col("n") - F.size("items"))
    return sets.where(room > 0).withColumn("h", F.explode(F.slice("items", F.lit(1), room.cast("int")))).drop("items")


def _smallest(seed: int):
    """The smallest hash of `items` under the hash function of this number."""
    return F.array_min(F.transform("items", lambda h: F.xxhash64(h, F.lit(seed))))


def _may_link(n_x, n_y, m_x, m_y):
    """Whether sets of these sizes, of which m occur in other sets too, can have an intersection that is large enough."""
    return NUM * (n_x + n_y) <= (NUM + DEN) * F.least(m_x, m_y)


def _counted(pairs: DataFrame, *keys: str) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (x, y, ...) with n_x, n_y, m_x, m_y, common and union, from the sets of both. pairs is a table that was kept."""
    x = sets.select(F.col("cls").alias("x"), F.col("n").alias("n_x"), F.col("items").alias("i_x"))
    y = sets.select(F.col("cls").alias("y"), F.col("n").alias("n_y"), F.col("items").alias("i_y"))
    both = salted_join(salted_join(pairs, x, ["x"], _counted(pairs, "x"), "y"), y, ["y"], _counted(pairs, "y"), "x")
    both = both.withColumn("common", F.size(F.array_intersect("i_x", "i_y")).cast("long")).withColumn("union", F.col("n_x") + F.col("n_y") - F.col("common"))
    return both.withColumn("m_x", F.size("i_x").cast("long")).withColumn("m_y", F.size("i_y").cast("long")).drop("i_x", "i_y")


LINKED = f"{DEN} * common >= {NUM} * union"


def _labelled(spark: SparkSession, docs: DataFrame, width: int) -> DataFrame:
    """doc_id, row_key (a hash of id and text), n and label (the smallest class of its component) of each row."""
    scratch = Scratch(spark, "jaccard")
    rows = doc_rows(docs, "doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = scratch.keep(rows.mapInArrow(partial(_classes, width=width), f"doc_id {kind}, row_key long, cls long, n long"), "table")

    # Classes that share enough of their prefix with others. Texts are read again: that costs less than to store the prefixes.
    dealt = rows.select("text").mapInArrow(partial(_prefixes, width=width), "h long, cls long, shares int")
    same = Window.partitionBy("h")
    dealt = dealt.select("cls", "shares", F.min("cls").over(same).alias("lo"), F.max("cls").over(same).alias("hi"))
    shares = dealt.where("shares < 0 or (shares > 0 and lo <> hi)").groupBy("cls").agg(F.sum(F.abs("shares")).alias("shares"))
    need = F.greatest(F.lit(1), F.floor((_least(F.col("n"), NUM, DEN) + (MARGIN - 1)) / MARGIN))
    classes = table.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.min("row_key").alias("row_key"))
    paired = scratch.keep(classes.join(shares, "cls").where(F.col("shares") >= need).select("cls", "row_key"), "paired")

    # One row of each of them gives its whole set.
    del dealt, shares
    scratch.release()
    keys = paired.select("row_key")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    texts = rows.join(keys, "row_key", "left_semi").select("text")
    sets = texts.mapInArrow(partial(_whole_sets, width=width), "cls long, n long, items array<long>")
    sets = sets.join(paired, "cls", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.first("items").alias("items"))
    sets = scratch.keep(sets, "sets")

    # Their shingles that other classes have too, rare ones first. Very frequent ones are counted in parts.
    items = sets.select("cls", F.explode("items").alias("h")).where("h is not null")
    seen = items.where(F.pmod(F.xxhash64("cls"), F.lit(common.GLANCE)) == 0).groupBy("h").agg(F.count(F.lit(1)).alias("size"))
    items = with_totals(items, "h", "cls", seen, {"often": F.count(F.lit(1))}, "often > 1")
    ranked = items.groupBy("cls").agg(F.transform(F.array_sort(F.collect_list(F.struct("often", "h"))), lambda s: s["h"]).alias("items"), F.sum(F.log("often")).alias("fame"))
    sets = scratch.keep(sets.select("cls", "n").join(ranked, "cls").withColumn("fame", F.col("fame") / F.col("n")), "ranked")
    del items, ranked
    scratch.release()

    # Pivots and regions.
    firsts = sets.select("cls", "fame", *(_smallest(s).alias(f"m{s}") for s in range(PIVOT_HASHES)))
    seeded = firsts.select("cls", "fame", F.explode(F.array(*(F.struct(F.lit(s).alias("seed"), F.col(f"m{s}").alias("m")) for s in range(PIVOT_HASHES)))).alias("e")).select("cls", "fame", "e.*")
    pivots = seeded.groupBy("seed", "m").agg(F.max_by("cls", F.struct("fame", "cls")).alias("y"), F.count(F.lit(1)).alias("size")).where("size > 1")
    near = salted_join(seeded, pivots, ["seed", "m"], pivots.select("seed", "m", "size"), "cls").where("cls <> y").select(F.col("cls").alias("x"), "y").distinct()
    near = scratch.keep(near, "pivots")
    placed = scratch.keep(_links(near, sets).where(LINKED).select("x", "y", "common", "union"), "placed")
    labels = components(spark, placed, "x", "y")
    nearest = placed.groupBy("x").agg(F.max_by(F.struct("y", "common", "union"), F.struct(F.col("common") / F.col("union"), -F.col("y"))).alias("at"))
    nearest = nearest.select(F.col("x").alias("cls"), F.col("at.y").alias("p"), F.col("at.common").alias("c"), (1 - F.col("at.common") / F.col("at.union")).alias("d"))
    placed_in = sets.select("cls", F.size("items").cast("long").alias("m")).join(nearest, "cls", "left").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    regions = scratch.keep(placed_in.select("cls", F.coalesce("p", "cls").alias("p"), F.coalesce("c", "m").alias("c"), F.coalesce("d", F.lit(0.0)).alias("d"), F.coalesce("label", "cls").alias("part")), "regions")

    # Boundary documents of other components: those of the smaller region go to the larger one.
    regions = regions.join(regions.groupBy("p").agg(F.count(F.lit(1)).alias("members")), "p")
    places = regions.select("cls", "p", "part", "members")

    def prefixes(some: DataFrame) -> DataFrame:
        return _prefix_rows(some.withColumn("m", F.size("items").cast("long")), NUM, DEN).join(places, "cls")

    def holders(prefix: DataFrame) -> DataFrame:
        found = prefix.groupBy("h", "p", "part", "members").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("m").alias("top"))
        return found.select("h", *(F.col(c).alias(f"b_{c}") for c in ("p", "part", "members", "lo", "hi", "top")))

    b = lambda c: F.col(f"b_{c}")
    smaller = (F.col("members") < b("members")) | ((F.col("members") == b("members")) & (F.col("p") < b("p")))
    fits = (F.col("n") * NUM <= b("hi") * DEN) & (b("lo") * NUM <= F.col("n") * DEN) & _may_link(F.col("n"), b("lo"), F.col("m"), b("top"))
    seen = _counted(_prefix_rows(sets.where(F.pmod(F.xxhash64("cls"), F.lit(common.GLANCE)) == 0).withColumn("m", F.size("items").cast("long")), NUM, DEN), "h")
    if common.hot_keys(seen, ["h"]) is None:
        prefix = prefixes(sets).repartition("h")  # shuffled once for both sides
        met = prefix.join(holders(prefix), "h")
    else:
        prefix = scratch.keep(prefixes(sets), "prefix")
        met = salted_join(prefix, holders(prefix), ["h"], _counted(prefix, "h"), "cls")
    met = met.where((F.col("part") != b("part")) & smaller & fits)
    met = scratch.keep(met.select(F.col("cls").alias("x"), b("p").alias("y")).distinct(), "met")
    inside = regions.join(sets.select("cls", "n", F.size("items").cast("long").alias("m")), "cls").select("p", F.col("cls").alias("y"), "d", F.col("c").alias("c_in"), F.col("n").alias("n_in"), F.col("m").alias("m_in"))
    near = _near(scratch, _links(met, sets), inside, "near")
    more = _links(_tried(scratch, *_divided(scratch, near, inside, sets)), sets).where(LINKED).select("x", "y")
    parts = regions.select(F.col("cls").alias("x"), F.col("part").alias("y")).where("x <> y")
    labels = components(spark, more.unionByName(parts), "x", "y").select(F.col("node").alias("cls"), "label")

    # copies of one text, and those without words, may be a large share of all rows
    of = salted_join(table, labels, ["cls"], _counted(table, "cls"), "row_key", "left")
    return of.select("doc_id", "row_key", "n", F.coalesce("label", "cls").alias("label"))


#: Largest distance of linked sets.
REACH = 1 - NUM / DEN + 1e-9


def _near(scratch: Scratch, linked: DataFrame, inside: DataFrame, name: str) -> DataFrame:
    """The boundary documents x of each region p, kept: those within the region's radius and REACH of its pivot. linked: (x, y = p), from _links."""
    radius = inside.groupBy(F.col("p").alias("y")).agg(F.max("d").alias("a"))
    told = linked.join(radius, "y").withColumn("to_p", 1 - F.col("common") / F.col("union")).where(F.col("to_p") <= F.col("a") + REACH)
    return scratch.keep(told.select("x", F.col("y").alias("p"), "to_p", F.col("common").alias("c_x"), "n_x", "m_x"), name)


def _divided(scratch: Scratch, near: DataFrame, inside: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """near and inside with the large regions that boundary documents visit divided by pivots of their own, and those again."""
    inside = scratch.keep(inside.join(near.select("p").distinct(), "p", "left_semi"), "inside0")
    for level in range(1, LEVELS + 1):
        sizes = inside.groupBy("p").agg(F.count(F.lit(1)).alias("size"))
        total = inside.count()
        # HOT_KEYS regions at most, whose names are broadcast
        big = scratch.keep(sizes.where(F.col("size") > max(REGION, total // HOT_KEYS)).select("p"), f"big{level}")
        if big.isEmpty():
            break
        large = F.broadcast(big)
        firsts = sets.select(F.col("cls").alias("y"), _smallest(PIVOT_HASHES + level).alias("m"))
        members = scratch.keep(inside.join(large, "p", "left_semi").join(firsts, "y"), f"members{level}")
        pivots = scratch.keep(members.groupBy("p", "m").agg(F.min_by("y", F.struct("d", "y")).alias("s"), F.count(F.lit(1)).alias("size")), f"subs{level}")
        of = scratch.keep(salted_join(members, pivots.select("p", "m", "s"), ["p", "m"], pivots.select("p", "m", "size"), "y").select(F.col("y").alias("x"), F.col("s").alias("y")), f"of{level}")
        placed = _links(of, sets).select(F.col("y").alias("p"), F.col("x").alias("y"), (1 - F.col("common") / F.col("union")).alias("d"), F.col("common").alias("c_in"), F.col("n_x").alias("n_in"), F.col("m_x").alias("m_in"))
        placed = scratch.keep(placed, f"placed{level}")
        visits = near.join(large, "p", "left_semi")
        to = salted_join(visits.select("x", "p"), pivots.select("p", "s"), ["p"], _counted(visits, "p"), "x").select("x", F.col("s").alias("y")).distinct()
        visits = _near(scratch, _links(scratch.keep(to, f"to{level}"), sets), placed, f"visits{level}")
        near = scratch.keep(near.join(large, "p", "left_anti").unionByName(visits), f"near{level}")
        inside = scratch.keep(inside.join(large, "p", "left_anti").unionByName(placed), f"inside{level}")
    return near, inside


def _tried(scratch: Scratch, near: DataFrame, inside: DataFrame) -> DataFrame:
    """The pairs (x, y) of a boundary document and a member of its region that windows and common shingles allow, kept.

    Members of a region are dealt into blocks of about REGION, to each of which every boundary document goes."""
    blocks = inside.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / REGION).cast("int").alias("blocks"))
    left = near.join(blocks, "p").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = inside.join(blocks, "p").withColumn("block", F.pmod(F.xxhash64("y"), "blocks").cast("int")).drop("blocks")
    tried = salted_join(left, right, ["p", "block"], _counted(left, "p", "block"), "x").where(F.abs(F.col("d") - F.col("to_p")) <= REACH).where("x <> y")
    tried = tried.where(_may_link(F.col("n_x"), F.col("n_in"), F.col("m_x"), F.col("m_in")))
    # what both have of the pivot's set, and what both have besides it
    most = F.least("c_x", "c_in") + F.least(F.col("m_x") - F.col("c_x"), F.col("m_in") - F.col("c_in"))
    tried = tried.where(NUM * (F.col("n_x") + F.col("n_in")) <= (NUM + DEN) * most)
    return scratch.keep(tried.select("x", "y").distinct(), "tried")


def jaccard_classes(spark: SparkSession, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) for every row of docs(doc_id, text).

    Null or empty texts, and those without words, have no shingles and link with nothing: component_id = doc_id.
    Rows with the same set link; repeated rows give repeated results. A null doc_id is in the component of its
    text, which is named after its smallest doc_id that isn't null. No rows: no rows.
    """
    of = Scratch(spark, "classes").keep(_labelled(spark, docs, width), "labels")
    smallest = of.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    named = salted_join(of, smallest.select("label", "least"), ["label"], smallest.select("label", "size"), "row_key", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of docs, all columns as they are, without all but one of each component: the smallest doc_id, nulls last.

    Of repeated rows in a component one stays; texts without words all stay."""
    scratch = Scratch(spark, "near-copies")
    of = scratch.keep(_labelled(spark, docs, width).where("n > 0").select("label", "row_key", "doc_id"), "labels")
    firsts = of.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = scratch.keep(firsts.select("label", F.col("m.row_key").alias("first"), "n"), "firsts")
    many = salted_join(of, firsts.select("label", "first"), ["label"], firsts.select("label", F.col("n").alias("size")), "row_key")
    gone = scratch.keep(many.groupBy("row_key").agg(F.max(F.col("row_key") == F.col("first")).alias("stays"), F.count(F.lit(1)).alias("n")).where("not stays or n > 1"), "gone")
    names = [f"c{i}" for i in range(len(docs.columns))]
    key = F.xxhash64(*(names[docs.columns.index(c)] for c in ("doc_id", "text")))
    plain = docs.toDF(*names).withColumn("row_key", key)
    small = gone.count() <= BROADCAST_ROWS
    ids, repeated = gone.select("row_key"), gone.where("stays").select("row_key")
    kept = plain.join(F.broadcast(ids) if small else ids, "row_key", "left_anti")
    again = plain.join(F.broadcast(repeated) if small else repeated, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.unionByName(again).select(*names).toDF(*docs.columns)
