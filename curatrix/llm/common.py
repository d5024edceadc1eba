"""Shared pieces of the training-data operators: words, their hashes, and steps of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step takes at once; one longer text is a step of its own.
STEP_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15
#: Bytes of a word that are hashed 8 at a time for all words of a step at once.
LONG_WORD = 64


def doc_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that no other column of the input can clash with an operator's own.

    They are found by exact name and place: further columns that differ in case only, or repeat a name, do no harm."""
    places = [docs.columns.index(c) for c in columns]
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).select(*(F.col(f"c{i}").alias(c) for i, c in zip(places, columns, strict=True)))


def n_words(text) -> "F.Column":
    """Number of words `[^\\x20\\x09-\\x0D]+`; 0 for null.

    Runs of separators become one space, so words = separators inside the trimmed text + 1."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    body = F.trim(blank)
    return F.when(F.length(body) == 0, 0).otherwise(F.size(F.split(body, " +"))).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column, and where each begins and ends in them; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes; every text is whole in one range."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def hash_words(flat: np.ndarray, bounds: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every lower-cased word of the texts flat[bounds[i]:bounds[i + 1]], its text, start and end. blank: which bytes are part of no word.

    A word's hash takes in 8 bytes at a time and mixes after each, so it has no structure that words could share; words of
    more than LONG_WORD bytes are hashed one by one."""
    lo = int(bounds[0])
    if len(bounds) == 2 and bounds[1] - lo > 2 * STEP_BYTES:  # a long text, in pieces that end at separators
        found, at = [], lo
        while at < bounds[1]:
            cut = at + STEP_BYTES
            while cut < bounds[1] and not (gap := blank[flat[cut : min(cut + STEP_BYTES, int(bounds[1]))]]).any():
                cut += STEP_BYTES
            cut = min(cut + int(gap.argmax()), int(bounds[1])) if cut < bounds[1] else int(bounds[1])
            hashes, doc, start, end = _hash_words(flat, np.array([at, cut]), blank)
            found.append((hashes, doc, start + (at - lo), end + (at - lo)))
            at = cut
        return tuple(map(np.concatenate, zip(*found, strict=True)))
    return _hash_words(flat, bounds, blank)


def _hash_words(flat: np.ndarray, bounds: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lo = int(bounds[0])
    part = _LOWER[flat[lo : int(bounds[-1])]]
    n = len(part)
    if not n:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty
    solid = ~blank[part]
    edge = np.zeros(n + 1, bool)
    edge[np.minimum(bounds - lo, n)] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = end - start
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([part, np.zeros(8, np.uint8)]), 8)
    hashes = size.astype(np.uint64) * np.uint64(_BASE)
    at, longest = np.arange(len(size)), int(size.max(initial=0))
    for k in range(0, min(longest, LONG_WORD), 8):
        if k:
            at = at[size[at] > k]
        chunk = eights[start[at] + k].view("<u8").ravel()
        left = np.minimum(size[at] - k, 8).astype(np.uint64)
        chunk &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - left) << np.uint64(3))
        hashes[at] = mix64(hashes[at] ^ chunk)
    if longest > LONG_WORD:
        for i in np.flatnonzero(size > LONG_WORD):
            hashes[i] = xxhash.xxh64_intdigest(part[start[i] : end[i]])
    doc = np.searchsorted(bounds - lo, start, "right") - 1
    return hashes, doc, start, end


def shingle_sets(hashes: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: windows of `width` words, the whole sequence if shorter."""
    cuts = np.searchsorted(doc, np.arange(n_docs + 1))
    odd = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    m = len(hashes) - width + 1
    rolled = np.zeros(max(m, 0), np.uint64)
    for k in range(width if m > 0 else 0):
        rolled += hashes[k : k + m] * odd[k]
    rolled = mix64(rolled)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            yield mix64(np.array([(hashes[a:b] * odd[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def lists(values: list[np.ndarray]) -> pa.Array:
    """An Arrow column list<int64> of these arrays of 64-bit words."""
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def crc32_of_id(column: str = "doc_id") -> "F.Column":
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def slices(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts take about `most` bytes together."""
    _, offsets = text_buffers(batch.column(column))
    for a, b in steps(offsets, most):
        yield batch.slice(a, b - a)


def union_find(n: int, pairs: Iterable[tuple[int, int]]) -> np.ndarray:
    """The smallest member of each of n items' group."""
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return np.array([root(x) for x in range(n)], np.int64)


#: Rows of one key that a join leaves together, and keys that it splits, at most.
HOT_ROWS, HOT_KEYS = 512, 100_000


def hot_keys(sizes: DataFrame, keys: list[str]) -> DataFrame | None:
    """The keys, and into how many `salts` each is split, of the rows of sizes(keys, size) above a bound; None if no key is.

    The bound is HOT_ROWS or, if that's more, the HOT_KEYSth part of all rows; so there are HOT_KEYS such keys at most, which can
    be broadcast, and no other key has more than the bound."""
    total, most = sizes.agg(F.sum("size"), F.max("size")).first()
    bound = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= bound:
        return None
    return sizes.where(F.col("size") > bound).select(*keys, F.ceil(F.col("size") / bound).cast("int").alias("salts"))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], sizes: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """left and right joined on keys, like left.join(right, keys, how) for an inner or left join.

    sizes has the keys and `size`, how many rows of left have them. Left rows of a hot key are dealt by a hash of the column `by` into
    parts that meet copies of the key's right rows, so that no task gets all of them. Null keys match nothing."""
    hot = hot_keys(sizes, keys)
    if hot is None:
        return left.join(right, keys, how)
    hot = F.broadcast(hot)
    parts = left.join(hot, keys, "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), "salts")).cast("int")).drop("salts")
    copies = right.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return parts.join(copies, [*keys, "salt"], how).drop("salt")


#: One row in so many is looked at to tell which keys are very frequent. That decides where rows are counted, not what is counted.
GLANCE = 64


def with_totals(rows: DataFrame, key: str, by: str, seen: DataFrame, totals: dict[str, Column], where: str, again: DataFrame | None = None) -> DataFrame:
    """rows with totals over all rows of their key, as far as they pass `where`. Rows are shuffled once and never joined.

    totals: for each name an aggregate. seen: (key, size), the counts of about one row in GLANCE. The rows of keys
    that are hot there are dealt by a hash of the column `by` into parts; their totals, of HOT_KEYS keys at most, come from a
    partial aggregation over `again` (rows, or rows with repeats) and are broadcast."""
    hot = hot_keys(seen, [key])
    if hot is None:
        same = Window.partitionBy(key)
        return rows.select("*", *(total.over(same).alias(name) for name, total in totals.items())).where(where)
    hot = F.broadcast(hot.withColumn("salts", F.col("salts") * GLANCE))
    whole = (rows if again is None else again).join(hot, key, "left_semi").groupBy(key).agg(*(total.alias(f"{name}_whole") for name, total in totals.items()))
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), "salts")).cast("int")
    same = Window.partitionBy(key, "salt")
    parts = rows.join(hot, key, "left").select(*rows.columns, salt.alias("salt")).select("*", *(total.over(same).alias(name) for name, total in totals.items()))
    both = parts.join(F.broadcast(whole), key, "left")
    return both.select(*rows.columns, *(F.coalesce(f"{name}_whole", name).alias(name) for name in totals)).where(where)
