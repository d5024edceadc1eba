"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, one occurrence per group.

A line's fingerprint has 64 bits. Lines whose fingerprints differ in RADIUS bits at most agree in at least
BLOCKS - RADIUS of BLOCKS blocks, so each line goes once to every choice of so many blocks and meets only lines that agree in them. Pairs
within RADIUS are linked if the edit distance of the normalised lines is small enough.

Word fingerprints within RADIUS are far rarer than lines within the edit similarity. With `grams`, which the registered query uses, lines
meet by MinHash of their byte GRAM-grams instead: in BANDS bands of ROWS, and candidates are dropped only if sketches of SKETCH_BITS bits
a hash agree in fewer than LEAST_AGREE places.

Every line is first compared with the smallest line of its buckets, which joins nearly all of a large group at a cost in proportion
to its size. A bucket of three lines or more is open if its lines are still in different groups; only in open buckets, lines of
different groups are then compared with one another, in parts that don't grow with the bucket. That joins most of what belongs together;
in buckets that are still open, all lines of different groups whose fingerprints are near are then compared, in tiles of TILE lines, so that no partner is lost.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import common
from curatrix.llm.common import STEP_BYTES, doc_rows, hash_words, mix64, salted_join, slices, steps, with_totals
from curatrix.operators.graph import components
from curatrix.scratch import Scratch

RADIUS, BLOCKS = 3, 5
#: With grams: bytes of a gram, MinHash bands and hashes in each, and agreeing hashes (in a sketch) of lines that are compared.
GRAM, BANDS, ROWS, LEAST_AGREE = 8, 10, 3, 12
#: Bits of each hash that a sketch keeps.
SKETCH_BITS = 2
#: Least edit similarity of linked lines in percent: 100 * (1 - distance / length of the longer line), in code points.
SIMILARITY = 85
#: Rows of keys and labels that are broadcast at most (40 bytes each); more are shuffled.
BROADCAST_KEYS = 20_000
#: Bits of the filters that tell tasks which texts and lines to read.
FILTER_BITS = 1 << 26
#: An open bucket of so many lines is compared pair by pair; larger ones are divided, in so many rounds.
LEAF, ROUNDS = 8, 8
#: Lines on each side of a tile of a bucket whose lines are all compared, and pairs whose texts are compared at once.
TILE, PAIRS = 1024, 16384
#: Bytes of the first lines of pairs that are compared at once: the more pairs, the more have about the same length.
PAIR_BYTES = 1 << 22
#: Cells of a table that distances are told with at once: code points of the texts, or words of the marks of patterns.
CELLS = 1 << 21
#: Code points of the longest lines whose distance is computed in a band of the table.
LONG_LINE = 100

#: Digits count alike, ASCII punctuation and control characters (but line ends and separators of words) don't count.
_MAP = bytes(ord("0") if 0x30 <= c <= 0x39 else c for c in range(256))
_DROP = bytes(c for c in range(128) if not (chr(c).isalnum() or c == 0x20 or 0x09 <= c <= 0x0D))
#: Bits of each block.
_WIDTHS = [64 // BLOCKS + (k < 64 % BLOCKS) for k in range(BLOCKS)]


def normal_lines(text: str | None) -> list[bytes]:
    """The lines of a text (split at line feeds), normalised; a null text has none."""
    if text is None:
        return []
    return [b" ".join(line.split()) for line in text.lower().encode("utf-8", "replace").translate(_MAP, _DROP).split(b"\n")]


#: Of each byte its bits, one in each byte of a 64-bit word: sums of up to 255 such words count 8 bits at once.
_SPREAD = np.array([sum(1 << (8 * i) for i in range(8) if byte >> i & 1) for byte in range(256)], np.uint64)


def fingerprints(lines: list[bytes]) -> np.ndarray:
    """SimHash of each line: of its words' hashes, each bit that most of them have."""
    flat = np.frombuffer(b"\n".join(lines), np.uint8)
    bounds = np.cumsum([0, *(len(x) + 1 for x in lines)])
    bounds[-1] -= 1
    hashes, line, _, _ = hash_words(flat, np.minimum(bounds, len(flat)))
    out = np.zeros(len(lines), np.uint64)
    if len(hashes):
        starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        many = np.diff(np.append(starts, len(line)))
        # parts of 255 words at most, then the parts of each line
        parts = -(-many // 255)
        first = np.concatenate([[0], np.cumsum(parts)[:-1]])
        at = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
        sums = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], at, axis=0).view(np.uint8).reshape(-1, 64)
        if len(at) > len(starts):
            sums = np.add.reduceat(sums, first, axis=0, dtype=np.int32)
        out[line[starts]] = np.packbits(2 * sums.astype(np.int32) > many[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


_ODD = (mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _least(padded: list[bytes]) -> np.ndarray:
    """The smallest hash of the lines' grams under each hash function, a row for each function."""
    flat = np.frombuffer(b"".join(padded), np.uint8)
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, GRAM)).view(np.uint64).ravel()
    hashes = (mix64(windows) >> np.uint64(32)).astype(np.uint32)
    # the grams of each line, and those across its end, which don't count
    bounds = np.cumsum([0, *map(len, padded)])
    cuts = np.stack([bounds[:-1], bounds[1:] - GRAM + 1], axis=1).ravel()[:-1]
    return np.stack([np.minimum.reduceat(hashes * odd, cuts)[::2] for odd in _ODD])


def gram_marks(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sketch of each line (SKETCH_BITS bits of each MinHash) and its bands' hashes; a line shorter than a gram is one gram."""
    padded = [x.ljust(GRAM, b"\0") for x in lines]
    bounds = np.cumsum([0, *map(len, padded)])
    sketches, marks = np.zeros(len(lines), np.uint64), np.zeros((len(lines), BANDS), np.uint64)
    for a, b in steps(bounds):
        if b == a + 1:  # perhaps a very long line, whose parts share all but one place of a gram
            line = padded[a]
            least = np.minimum.reduce([_least([line[i : i + STEP_BYTES + GRAM - 1]]) for i in range(0, len(line) - GRAM + 1, STEP_BYTES)])
        else:
            least = _least(padded[a:b])
        for k in range(BANDS * ROWS):
            mixed = mix64(least[k].astype(np.uint64) + (np.uint64(k) << np.uint64(32)))
            sketches[a:b] |= (mixed & np.uint64((1 << SKETCH_BITS) - 1)) << np.uint64(SKETCH_BITS * k)
            marks[a:b, k // ROWS] = mix64(marks[a:b, k // ROWS] + mixed)
    return sketches, marks.view(np.int64)


def _key(line: bytes) -> int:
    """Hash of a normalised line; 0 for the empty one alone."""
    return (xxhash.xxh64_intdigest(line) or 1) if line else 0


def _lines(batches, grams):
    """A row for each text: its lines' keys, fingerprints, lengths and with grams the hash of each band."""
    for whole in batches:
        for batch in slices(whole, "text"):
            each = [normal_lines(t) for t in batch.column("text").to_pylist()]
            flat = [x for lines in each for x in lines]
            keys = np.fromiter(map(_key, flat), np.uint64, len(flat))
            ends = pa.array(np.cumsum([0, *map(len, each)], dtype=np.int32))
            lengths = np.fromiter((len(x) if x.isascii() else len(x.decode("utf-8", "replace")) for x in flat), np.int32, len(flat))
            sims, marks = gram_marks(flat) if grams else (fingerprints(flat), None)
            columns = [keys.view(np.int64), sims.view(np.int64), lengths, *(np.ascontiguousarray(marks[:, k]) for k in range(BANDS if grams else 0))]
            names = ["doc_id", "row_key", "keys", "sims", "lengths", *(f"m{k}" for k in range(BANDS if grams else 0))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), *(pa.ListArray.from_arrays(ends, pa.array(c)) for c in columns)], names)


def _bits(numbers: DataFrame, column: str) -> np.ndarray:
    """A bitmap of FILTER_BITS bits in which those of the numbers are set; it comes to the driver as that many bits at most."""
    place = F.pmod(column, F.lit(FILTER_BITS))
    words = numbers.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _has(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    place = numbers.view(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _held(batches, keys):
    """Row and key of the lines whose key is in the bitmap."""
    for batch in batches:
        lines = batch.column("keys")
        flat = lines.flatten().to_numpy()
        here = _has(keys.value, flat)
        rows = np.repeat(batch.column("row_key").to_numpy(), lines.value_lengths().to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(rows[here]), pa.array(flat[here])], ["row_key", "key"])


def _texts(batches, rows, keys):
    """Key and normalised line of the lines whose row and key are in the bitmaps, each once in a task."""
    rows, keys, told = rows.value, keys.value, set()
    for whole in batches:
        whole = whole.filter(pa.array(_has(rows, whole.column("row_key").to_numpy())))
        for batch in slices(whole, "text"):
            found = list({x for t in batch.column("text").to_pylist() for x in normal_lines(t) if x})
            numbers = np.fromiter(map(_key, found), np.uint64, len(found)).view(np.int64)
            here = [i for i in np.flatnonzero(_has(keys, numbers)).tolist() if numbers[i] not in told]
            told.update(numbers[here].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(numbers[here]), pa.array([found[i].decode("utf-8", "replace") for i in here], pa.string())], ["key", "line"])


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance in code points, by bit-parallel columns; if it is above `most`, any number above that."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    at: dict[str, int] = {}
    for i, c in enumerate(b):
        at[c] = at.get(c, 0) | 1 << i
    full, top, up, down, d = (1 << len(b)) - 1, 1 << (len(b) - 1), (1 << len(b)) - 1, 0, len(b)
    spare = len(a) + (len(a) if most is None else most)
    for i, c in enumerate(a):
        if d + i > spare:  # each further column takes one away at most
            return d + i - len(a)
        match = at.get(c, 0)
        zero = (((match & up) + up) ^ up) | match | down
        more, less = down | (full & ~(zero | up)), up & zero
        d += bool(more & top) - bool(less & top)
        more, less = more << 1 | 1, less << 1
        up, down = less | (full & ~(zero | more)), more & zero
        up &= full
        down &= full
    return d


def similar(a: str, b: str) -> bool:
    """Whether two normalised lines have the edit similarity. Bounds that are quick to get decide most pairs."""
    longer = max(len(a), len(b))
    most = longer * (100 - SIMILARITY) // 100
    if abs(len(a) - len(b)) > most:
        return False
    head = len(os.path.commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if max(len(a), len(b)) <= most:
        return True
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y, strict=True) if p != q) <= most:
        return True
    return edit_distance(a, b, most) <= most


def _letters(lines: list[str]) -> np.ndarray:
    """How often each line has the code points of each of 64 classes, and the pairs of code points of each of 192."""
    out = np.zeros((len(lines), 256), np.int32)
    for i, line in enumerate(lines):
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        pairs = (points[:-1] * np.uint32(31) + points[1:]) % np.uint32(192) + np.uint32(64)
        out[i] = np.bincount(np.concatenate([points & np.uint32(63), pairs]), minlength=256)
    return out


def may_be_similar(a: list[str], b: list[str]) -> np.ndarray:
    """Whether the letters of each two lines, and their pairs of letters, differ as little as those of lines within the edit distance
    must, in all pairs at once: an edit changes one letter and two pairs at most."""
    number = {x: i for i, x in enumerate(dict.fromkeys([*a, *b]))}
    counts, lengths = _letters(list(number)), np.fromiter(map(len, number), np.int64, len(number))
    x, y = np.fromiter((number[p] for p in a), np.int64, len(a)), np.fromiter((number[p] for p in b), np.int64, len(b))
    return _letters_allow(counts, lengths, x, y)


def _letters_allow(counts: np.ndarray, lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    most = np.maximum(lengths[x], lengths[y]) * (100 - SIMILARITY) // 100
    apart = counts[x] - counts[y]
    out = np.ones(len(x), bool)
    for part, times in ((apart[:, :64], 1), (apart[:, 64:], 2)):
        out &= (np.maximum(part, 0).sum(axis=1) <= times * most) & (np.maximum(-part, 0).sum(axis=1) <= times * most)
    return out


def _distances(lines: list[str], x: np.ndarray, y: np.ndarray, words: int, most: int) -> np.ndarray:
    """Levenshtein distances, in code points, of lines[x] and lines[y], all pairs at once; where one is above `most`, any number above that.

    x: longest first, none shorter than its y; the ys have more than 64 * (words - 1) code points and 64 * words at most. Columns are bit-parallel as in `edit_distance`, of words of
    64 rows, of which a column needs only those within `most` of the diagonal: what lies beyond counts as if it grew by one with each step, which is never too small."""
    (texts, row), (patterns, at) = (np.unique(side, return_inverse=True) for side in (x, y))
    longer, shorter = ([np.frombuffer(lines[i].encode("utf-32-le", "surrogatepass"), np.uint32) for i in side] for side in (texts, patterns))
    n, m = (np.fromiter(map(len, side), np.int64, len(side)) for side in (longer, shorter))
    longer, shorter = np.concatenate(longer), np.concatenate(shorter)
    there = np.zeros(max(int(longer.max()), int(shorter.max())) + 1, bool)
    there[longer] = there[shorter] = True
    number, kinds = np.cumsum(there, dtype=np.int32) - np.int32(1), int(there.sum())
    if len(patterns) * kinds * words > CELLS and len(x) > 1:  # many different code points
        half = len(x) // 2
        return np.concatenate([_distances(lines, x[:half], y[:half], words, most), _distances(lines, x[half:], y[half:], words, most)])
    columns = np.zeros((len(texts), int(n.max())), np.int32)
    columns[np.arange(columns.shape[1]) < n[:, None]] = number[longer]
    columns = np.ascontiguousarray(columns.T).take(row, axis=1)
    places = np.arange(int(m.max()))
    held = places < m[:, None]
    cells = ((places >> 6) * len(patterns) * kinds + np.arange(len(patterns))[:, None] * kinds)[held] + number[shorter]
    match = np.zeros(words * len(patterns) * kinds, np.uint64)
    np.add.at(match, cells, np.broadcast_to(np.uint64(1) << (places & 63).astype(np.uint64), held.shape)[held])
    match = match.reshape(words, -1)
    n, m, first = n[row], m[at], at * kinds
    up, down = np.full((words, len(x)), ~np.uint64(0)), np.zeros((words, len(x)), np.uint64)
    one, top = np.uint64(1), np.uint64(63)
    end = ((m - 1) & 63).astype(np.uint64)
    last = min(words - 1, most >> 6)
    d = m.copy() if last == words - 1 else np.full(len(x), 64 * (last + 1))
    for j in range(len(columns)):
        k = int(np.searchsorted(-n, -j, "left"))  # texts that have such a column
        below = min(words - 1, (j + most) >> 6)
        if below > last:
            d[:k] += 64 if below < words - 1 else m[:k] - 64 * (words - 1)
            last = below
        at, more, less = first[:k] + columns[j, :k], one, np.uint64(0)
        for w in range(max(0, (j - most) >> 6), last + 1):
            u, v, same = up[w, :k], down[w, :k], match[w].take(at)
            either = same | v
            same |= less
            zero = (((same & u) + u) ^ u) | same
            plus, minus = v | ~(zero | u), u & zero
            if w == last:
                bit = end[:k] if w == words - 1 else top
                d[:k] += ((plus >> bit) & one).astype(np.int64) - ((minus >> bit) & one).astype(np.int64)
            next_more, next_less = plus >> top, minus >> top
            plus, minus = plus << one | more, minus << one | less
            up[w, :k], down[w, :k] = minus | ~(either | plus), plus & either
            more, less = next_more, next_less
    return d


def all_similar(a: list[str], b: list[str]) -> np.ndarray:
    """`similar` of each two lines. Pairs of about the same length share their columns; few long ones are looked at one by one."""
    number = {x: i for i, x in enumerate(dict.fromkeys([*a, *b]))}
    lines, lengths = list(number), np.fromiter(map(len, number), np.int64, len(number))
    x, y = np.fromiter((number[p] for p in a), np.int64, len(a)), np.fromiter((number[q] for q in b), np.int64, len(b))
    x, y = np.where(lengths[x] < lengths[y], y, x), np.where(lengths[x] < lengths[y], x, y)
    most = lengths[x] * (100 - SIMILARITY) // 100
    out, words = x == y, (lengths[y] + 63) >> 6
    open_ = ~out & (lengths[x] - lengths[y] <= most)
    for w in np.unique(words[open_]).tolist():
        these = np.flatnonzero(open_ & (words == w))
        these = these[np.argsort(-lengths[x[these]], kind="stable")]
        step = max(1, CELLS // int(lengths[x[these[0]]]))
        for at in range(0, len(these), step):
            part = these[at : at + step]
            p, q, widest = x[part], y[part], int(most[part].max())
            if len(part) >= 16 * min(w, (2 * widest >> 6) + 2):
                out[part] = _distances(lines, p, q, w, widest) <= most[part]
            else:
                may = may_be_similar([lines[i] for i in p], [lines[i] for i in q])
                out[part] = [bool(m) and similar(lines[i], lines[j]) for m, i, j in zip(may, p, q, strict=True)]
    return out


def _similar(batches):
    for whole in batches:
        for batch in slices(whole, "a", PAIR_BYTES):
            yield batch.filter(pa.array(all_similar(batch.column("a").to_pylist(), batch.column("b").to_pylist()), pa.bool_())).select(["x", "y"])


def _bucket(sim) -> "F.Column":
    """The buckets of a fingerprint: for each choice of blocks, their bits and the choice's number."""
    shifts = [sum(_WIDTHS[:k]) for k in range(BLOCKS)]
    masks = [((1 << w) - 1) << s for w, s in zip(_WIDTHS, shifts, strict=True)]
    chosen = [sum(masks[k] for k in choice) for choice in combinations(range(BLOCKS), BLOCKS - RADIUS)]
    return F.array(*(F.xxhash64(F.lit(i), sim.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long"))) for i, m in enumerate(chosen)))


def _near(a, b, len_a, len_b, grams: bool) -> "F.Column":
    """Whether fingerprints are within the radius (with grams: sketches agree enough), and lengths within what the edit similarity allows."""
    apart = a.bitwiseXOR(b)
    if grams:
        # one bit for each place in which sketches differ
        apart = reduce(Column.bitwiseOR, (F.shiftrightunsigned(apart, k) for k in range(SKETCH_BITS))).bitwiseAND(F.lit(sum(1 << (SKETCH_BITS * k) for k in range(BANDS * ROWS))))
    return (F.bit_count(apart) <= (BANDS * ROWS - LEAST_AGREE if grams else RADIUS)) & (F.abs(len_a - len_b) * 100 <= F.greatest(len_a, len_b) * (100 - SIMILARITY))


def _texts_of(spark: SparkSession, keys: DataFrame, docs: DataFrame, rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(key, line) of the line keys. Each line is read from one text that holds it.

    Which texts and lines those are, tasks learn from two bitmaps of a fixed size; what gets through by chance is joined away."""
    asked = spark.sparkContext.broadcast(_bits(keys, "key"))
    held = rows.select("row_key", "keys").mapInArrow(partial(_held, keys=asked), "row_key long, key long").groupBy("key").agg(F.min("row_key").alias("row_key"))
    places = spark.sparkContext.broadcast(_bits(held, "row_key"))
    lines = docs.select("row_key", "text").where("text is not null").mapInArrow(partial(_texts, rows=places, keys=asked), "key long, line string")
    return scratch.keep(lines.join(_bounded(keys), "key", "left_semi").groupBy("key").agg(F.first("line").alias("line")), f"{name}-lines")


def _verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame, rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (x, y) of line keys whose lines have the edit similarity."""
    keys = scratch.keep(pairs.select(F.col("x").alias("key")).unionByName(pairs.select(F.col("y").alias("key"))).distinct(), f"{name}-keys")
    lines = _texts_of(spark, keys, docs, rows, scratch, name)
    a, b = lines.select(F.col("key").alias("x"), F.col("line").alias("a")), lines.select(F.col("key").alias("y"), F.col("line").alias("b"))
    counted = lambda c: pairs.groupBy(c).agg(F.count(F.lit(1)).alias("size"))
    both = salted_join(salted_join(pairs, a, ["x"], counted("x"), "y"), b, ["y"], counted("y"), "x")
    both = both.withColumn("longer", F.greatest(F.length("a"), F.length("b")))
    # a band of the distance table in the JVM; for longer lines quick bounds, and bits of a column at once
    short = both.where(F.col("longer") <= LONG_LINE).withColumn("d", F.expr(f"levenshtein(a, b, cast(floor(longer * {100 - SIMILARITY} / 100) as int))")).where("d >= 0")
    long = both.where(F.col("longer") > LONG_LINE).select("x", "y", "a", "b").mapInArrow(_similar, "x long, y long")
    return scratch.keep(short.select("x", "y").unionByName(long), f"{name}-edges")


def _lines_of(rows: DataFrame, *lists: str) -> DataFrame:
    """key and elements of other lists of every line that isn't empty."""
    pairs = F.arrays_zip(F.col("keys").alias("key"), *(F.col(c) for c in lists))
    return rows.select(F.explode(pairs).alias("l")).select("l.*").where("key <> 0")


def _dealt(rows: DataFrame, grams: bool, once: bool = True) -> DataFrame:
    """(key, sim, len, bucket) of every line, of each distinct one once."""
    bands = [f"m{k}" for k in range(BANDS if grams else 0)]
    lines = _lines_of(rows, "sims", "lengths", *bands)
    if once:
        lines = lines.groupBy("key").agg(*(F.first(c).alias(c) for c in ("sims", "lengths", *bands)))
    buckets = F.array(*(F.xxhash64(F.lit(k), F.col(m)) for k, m in enumerate(bands))) if grams else _bucket(F.col("sims"))
    return lines.select("key", F.col("sims").alias("sim"), F.col("lengths").alias("len"), F.explode(buckets).alias("bucket"))


def line_groups(spark: SparkSession, docs: DataFrame, scratch: Scratch, grams: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_key, keys) with the line keys of each row of docs(doc_id, row_key, text), and (key, label) of lines with near copies."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    bands = "".join(f", m{k} array<long>" for k in range(BANDS if grams else 0))
    rows = scratch.keep(docs.mapInArrow(partial(_lines, grams=grams), f"doc_id {kind}, row_key long, keys array<long>, sims array<long>, lengths array<int>{bands}"), "lines")
    # per bucket its size and smallest line; buckets of one line are done
    seen = _dealt(rows.where(F.pmod("row_key", F.lit(common.GLANCE)) == 0), grams).groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    totals = {"size": F.count(F.lit(1)), "y": F.min("key"), "sim_y": F.min_by("sim", "key"), "len_y": F.min_by("len", "key")}
    met = scratch.keep(with_totals(_dealt(rows, grams), "bucket", "key", seen, totals, "size > 1", _dealt(rows, grams, False)), "met")
    del seen
    scratch.release()
    near = _near(F.col("sim"), F.col("sim_y"), F.col("len"), F.col("len_y"), grams)
    first = scratch.keep(met.where("key <> y").where(near).select(F.col("key").alias("x"), "y").distinct(), "first")
    edges = _verified(spark, first, docs, rows, scratch, "first")
    labels = components(spark, edges, "x", "y").withColumnRenamed("node", "key")

    # buckets of two are done; those of three or more are open if their lines are in different groups
    parts = met.where("size > 2").join(_bounded(labels), "key", "left").select("bucket", "size", "key", "sim", "len", F.coalesce("label", "key").alias("part"))
    parts = scratch.keep(parts, "parts")
    ends = parts.groupBy("bucket", "size").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("bucket", "size")
    ends = scratch.keep(ends, "open")
    open_ = scratch.keep(salted_join(parts.drop("size"), ends, ["bucket"], ends, "key"), "opened")
    others = scratch.keep(_met_in_leaves(open_, scratch, grams), "others")
    if not others.isEmpty():
        labels = _relabelled(spark, labels, _verified(spark, others, docs, rows, scratch, "more"), scratch, "labels")
    rest = _met_in_tiles(spark, open_.where(F.col("size") > LEAF), labels, docs, rows, scratch, grams)
    if rest is not None:
        labels = _relabelled(spark, labels, rest, scratch, "all-labels")
    return rows.select("doc_id", "row_key", "keys"), labels


def _relabelled(spark: SparkSession, labels: DataFrame, more: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(key, label) after further links (x, y): only the groups that these join are looked at."""
    ends = labels.select(F.col("key").alias("k"), "label")
    ends = _bounded(ends)
    x = more.join(ends, F.col("x") == F.col("k"), "left").select("y", F.coalesce("label", "x").alias("p"))
    both = x.join(ends, F.col("y") == F.col("k"), "left").select("p", F.coalesce("label", "y").alias("q"))
    joined = components(spark, both, "p", "q").select("node", F.col("label").alias("to"))
    old = labels.join(_bounded(joined), F.col("label") == F.col("node"), "left").select("key", F.coalesce("to", "label").alias("label"))
    new = joined.join(labels.select("key"), F.col("node") == F.col("key"), "left_anti").select(F.col("node").alias("key"), F.col("to").alias("label"))
    return scratch.keep(old.unionByName(new), name)


def _linked(frame: pd.DataFrame, grams: bool) -> pd.DataFrame:
    """Links (x, y) between lines of different parts of some tiles: of near lines with the edit similarity, those that join what isn't joined yet.

    The letters, which each line is asked for once, rule out most pairs; what they leave of all the tiles is compared together, PAIRS at a time."""
    sims, keys, lines, side = frame["sim"].to_numpy().view(np.uint64), frame["key"].to_numpy(), frame["line"].to_numpy(object), frame["side"].to_numpy()
    part, lengths = pd.factorize(frame["part"])[0], np.fromiter(map(len, lines), np.int64, len(lines))
    parent, found, held, counts = list(range(int(part.max()) + 1)), [], [], None

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def compare() -> None:
        x, y = (np.concatenate(side) for side in zip(*held, strict=True))
        held.clear()
        for at in range(0, len(x), PAIRS):
            p, q = x[at : at + PAIRS], y[at : at + PAIRS]
            roots = np.array([root(i) for i in range(len(parent))])
            apart = roots[part[p]] != roots[part[q]]
            pairs = pd.DataFrame({"x": np.minimum(keys[p], keys[q])[apart], "y": np.maximum(keys[p], keys[q])[apart], "p": p[apart], "q": q[apart]}).drop_duplicates(["x", "y"])
            p, q = pairs["p"].to_numpy(), pairs["q"].to_numpy()
            alike = all_similar(lines[p].tolist(), lines[q].tolist())
            for m, n in zip(p[alike].tolist(), q[alike].tolist(), strict=True):
                g, h = root(part[m]), root(part[n])
                if g != h:
                    parent[max(g, h)] = min(g, h)
                    found.append((min(keys[m], keys[n]), max(keys[m], keys[n])))

    for (_, lo, hi), rows in frame.groupby(["bucket", "lo", "hi"], sort=False).indices.items():
        left, right = rows[side[rows] == 0], rows[side[rows] == 1]
        right = left if lo == hi else right
        for at in range(0, len(left), 256):
            x, y = left[at : at + 256, None], right[None, :]
            apart = sims[x] ^ sims[y]
            if grams:
                apart = reduce(np.bitwise_or, (apart >> np.uint64(k) for k in range(SKETCH_BITS))) & np.uint64(sum(1 << (SKETCH_BITS * k) for k in range(BANDS * ROWS)))
            near = (np.bitwise_count(apart) <= (BANDS * ROWS - LEAST_AGREE if grams else RADIUS)) & (part[x] != part[y])
            near &= np.abs(lengths[x] - lengths[y]) * 100 <= np.maximum(lengths[x], lengths[y]) * (100 - SIMILARITY)
            if lo == hi:
                near &= x < y
            i, j = np.nonzero(near)
            if not len(i):
                continue
            counts = _letters(lines) if counts is None else counts
            for k in range(0, len(i), 1024):
                m, n = left[at + i[k : k + 1024]], right[j[k : k + 1024]]
                may = _letters_allow(counts, lengths, m, n)
                held.append((m[may], n[may]))
            if sum(len(h[0]) for h in held) >= PAIRS:
                compare()
    if held:
        compare()
    return pd.DataFrame(found, columns=["x", "y"], dtype=np.int64)


def _met_in_tiles(spark: SparkSession, lines: DataFrame, labels: DataFrame, docs: DataFrame, rows: DataFrame, scratch: Scratch, grams: bool) -> DataFrame | None:
    """Links (x, y) that join all lines of one bucket that are near and have the edit similarity; None if all buckets are closed.

    All lines of different parts of a bucket meet, in tiles of TILE by TILE lines that any number of tasks take. This grows with the square
    of a bucket whose lines share a band without being copies of one another."""
    parts = lines.select("bucket", "key", "sim").join(_bounded(labels), "key", "left").select("bucket", "key", "sim", F.coalesce("label", "key").alias("part"))
    parts = scratch.keep(parts, "rest")
    ends = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("bucket", "size")
    ends = scratch.keep(ends, "still-open")
    if ends.isEmpty():
        return None
    still = scratch.keep(salted_join(parts, ends, ["bucket"], ends, "key"), "still-opened")
    texts = _texts_of(spark, scratch.keep(still.select("key").distinct(), "rest-keys"), docs, rows, scratch, "rest")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    dealt = still.withColumn("own", F.pmod(F.xxhash64("key"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    dealt = dealt.select("bucket", "key", "sim", "part", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    # small tiles share a group, so that their pairs are compared together; tasks are told by hand, since their time is not in proportion to their bytes
    packs = -(-dealt.count() // (2 * TILE))
    dealt = dealt.withColumn("pack", F.pmod(F.xxhash64("bucket", "lo", "hi"), F.lit(packs)))
    of = salted_join(dealt, texts, ["key"], dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "lo")
    of = of.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "pack")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield _linked(pd.concat(list(frames), ignore_index=True), grams)

    return scratch.keep(of.groupBy("pack").applyInPandas(compare, "x long, y long").distinct(), "rest-edges")


def _masks(rounds: int) -> list[list[int]]:
    """For each round, masks of 1, 2, ... places of a sketch (of SKETCH_BITS bits each), drawn at random."""
    places, out = BANDS * ROWS, []
    for k in range(rounds):
        order = np.random.default_rng([5, k]).permutation(places)
        out.append([sum(((1 << SKETCH_BITS) - 1) << (SKETCH_BITS * int(p)) for p in order[: n + 1]) for n in range(places)])
    return out


def _met_in_leaves(parts: DataFrame, scratch: Scratch, grams: bool) -> DataFrame:
    """Pairs (x, y) of lines of one bucket and different parts whose fingerprints are near.

    In buckets of LEAF lines at most, all such pairs. Larger ones are divided, in each of ROUNDS rounds, by what sketches have at some
    places, as many as leave LEAF / 2 lines together if sketches were random; lines that belong together agree there in most rounds.
    Parts of LEAF lines at most are compared pair by pair, the lines of larger ones with one of them, which is another in every
    round. So the work grows with the lines, never with the square of a bucket. What this misses `_met_in_tiles` finds."""
    masks = _masks(ROUNDS)
    depth = F.least(F.greatest(F.ceil(F.log2(F.col("size") / (LEAF / 2)) / SKETCH_BITS), F.lit(1)), F.lit(len(masks[0]))).cast("int")
    rounds = F.array(*(F.xxhash64("bucket", F.lit(k), F.col("sim").bitwiseAND(F.element_at(F.array(*map(F.lit, row)), depth))) for k, row in enumerate(masks)))
    leaf = F.when(F.col("size") <= LEAF, F.array("bucket")).otherwise(rounds)
    dealt = parts.select("key", "part", "sim", "len", F.explode(leaf).alias("leaf"))
    line = F.struct(F.xxhash64("key", "leaf").alias("turn"), "key", "part", "sim", "len")
    sizes = scratch.keep(dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"), F.min(line).alias("m")).where("size > 1"), "leaves")
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))

    def near(pairs: DataFrame) -> DataFrame:
        found = pairs.where((a("part") != b("part")) & _near(a("sim"), b("sim"), a("len"), b("len"), grams))
        return found.select(F.least("a.key", "b.key").alias("x"), F.greatest("a.key", "b.key").alias("y"))

    small = dealt.join(sizes.where(F.col("size") <= LEAF).select("leaf"), "leaf")
    pairs = near(small.alias("a").join(small.alias("b"), (a("leaf") == b("leaf")) & (a("key") < b("key"))))
    large = sizes.where(F.col("size") > LEAF)
    stars = salted_join(dealt, large.select("leaf", "m"), ["leaf"], large.select("leaf", "size"), "key")
    stars = stars.select(F.struct("key", "part", "sim", "len").alias("a"), F.col("m").alias("b"))
    return pairs.unionByName(near(stars)).distinct()


def _bounded(df: DataFrame) -> DataFrame:
    """For a join: broadcast if it has so few rows that this is safe."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def dedup_lines(spark: SparkSession, docs: DataFrame, grams: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed and removed (numbers of the lines to drop, from 0, ascending) for every row of docs(doc_id, text).

    Of each connected group of lines the first occurrence stays: that of the smallest doc_id, then the first in its text.
    Lines that are empty when normalised always stay. Null texts have no lines, an empty text has one. Rows that agree in doc_id
    and text are one document; rows of one doc_id with different texts are ordered by a hash. A null doc_id comes first.
    No rows: no rows. Texts are not shuffled as long as few lines have to be compared; beyond that, those that hold them are.
    """
    return _removals(spark, docs, grams).drop("row_key")


def _removals(spark: SparkSession, docs: DataFrame, grams: bool) -> DataFrame:
    scratch = Scratch(spark, "lines")
    rows = doc_rows(docs, "doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    keyed, labels = line_groups(spark, rows, scratch, grams)
    of = keyed.select("doc_id", "row_key", F.posexplode("keys").alias("at", "key")).where("key <> 0")
    sizes = of.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    small = labels.count() <= BROADCAST_KEYS
    both = of.join(F.broadcast(labels), "key", "left") if small else salted_join(of, labels, ["key"], sizes, "row_key", "left")
    grouped = both.select("doc_id", "row_key", "at", F.coalesce("label", "key").alias("label"))
    grouped = scratch.keep(grouped, "grouped")
    place = F.struct("doc_id", "row_key", "at")
    firsts = grouped.groupBy("label").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = scratch.keep(firsts, "firsts")
    many = grouped.join(F.broadcast(firsts.drop("n")), "label") if firsts.count() <= BROADCAST_KEYS else salted_join(grouped, firsts.drop("n"), ["label"], firsts.select("label", F.col("n").alias("size")), "row_key")
    gone = many.where(~place.eqNullSafe(F.col("first"))).groupBy("row_key").agg(F.array_sort(F.collect_set("at")).alias("removed"))
    told = keyed.select("doc_id", "row_key", F.size("keys").cast("long").alias("n_lines")).join(scratch.keep(gone, "gone"), "row_key", "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return told.select("doc_id", "row_key", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, grams: bool = False) -> DataFrame:
    """docs, all columns and rows as they are, but with the removed lines taken out of the texts."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    cuts = _removals(spark, docs, grams).where("n_removed > 0").select("row_key", "removed").dropDuplicates(["row_key"])
    both = docs.toDF(*names).withColumn("row_key", F.xxhash64(doc_id, text)).join(cuts, "row_key", "left")
    kept = F.when(F.col("removed").isNull(), F.col(text)).otherwise(kept_text(F.col(text), F.col("removed")))
    return both.withColumn(text, kept).select(*names).toDF(*docs.columns)


def kept_text(text, removed) -> "F.Column":
    """The text without the removed lines."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.array_join(F.transform(F.filter(lines, lambda s: ~F.array_contains(removed, s["i"])), lambda s: s["x"]), "\n")
