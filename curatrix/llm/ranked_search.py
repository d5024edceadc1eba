"""Ranked lexical search: MaxScore in shards of documents.

A first pass over the texts keeps, of each document, its number of terms and how often it holds the items' terms. A shard is a run of these documents of one task,
with a posting list and an upper bound for each term. For an item, lists whose bounds add up to less than the kth score are non-essential: documents that
occur in no other can't qualify. The essential lists are read a range of documents at a time; what they bring is probed in
the non-essential lists, from the largest bound to the smallest, only as long as it can still reach the kth score."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows, hash_words, lists, steps, text_buffers
from curatrix.scratch import Scratch

K = 10
#: In thousandths: how much a term's further occurrences count less, in hundredths: how much a document's length counts.
TIMES, LONG, UNIT = 1000, 75, 1_000_000_000
#: Distinct terms that items which are searched together have, on average, at most: what goes to the driver and to each task. More items are searched in turn.
TERMS = 200_000
#: Postings of a shard, and documents of a range that an item reads at once.
POSTINGS, RANGE = 2_000_000, 2_048

#: Bytes that are part of no term: ASCII but digits and letters.
GAP = np.zeros(256, bool)
GAP[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

POSTED = "doc_id long, n long, terms array<int>, times array<int>"


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For steps of texts: the first and the end, the hash of each of their terms, and the text that it is in."""
    flat, offsets = text_buffers(column)
    for a, b in steps(offsets):
        hashes, doc, _, _ = hash_words(flat, offsets[a : b + 1], GAP)
        yield a, b, hashes, doc


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, hashes, doc in _terms(batch.column("text")):
            cuts = np.searchsorted(doc, np.arange(b - a + 1))
            found = [hashes[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id")[a:b], batch.column("text")[a:b], lists(found)], ["item_id", "text", "terms"])


def _postings(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each text its number of terms, and place in `known` (sorted hashes) and occurrences of those terms that are there."""
    for batch in batches:
        for a, b, hashes, doc in _terms(batch.column("text")):
            n = np.bincount(doc, minlength=b - a)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            pair, times = np.unique(doc[hit] * len(known) + at[hit], return_counts=True)
            cuts = np.searchsorted(pair // len(known), np.arange(b - a + 1)).astype(np.int32)
            ends = pa.array(cuts, pa.int32())
            of = lambda x, ends=ends: pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], pa.array(n, pa.int64()), of(pair % len(known)), of(times)], ["doc_id", "n", "terms", "times"])


class Shard:
    """Posting lists of a run of documents in ascending place, and the upper bound of each."""

    def __init__(self, docs: np.ndarray, n: np.ndarray, owner: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray, total: int, length: int) -> None:
        self.docs, self.size = docs, len(docs)
        if LONG * int(n.max(initial=0)) * total >= 1 << 63:
            n = n.astype(object)
        m = (100 - LONG + (LONG * n * total) // length).astype(np.int64)
        times = times.astype(np.int64)
        impact = (UNIT * times) // (TIMES * times + 8 * m[owner])
        by = np.argsort(terms, kind="stable")  # documents stay in ascending place
        terms, self.owner, impact = terms[by], owner[by], impact[by]
        self.known, self.start = np.unique(terms, return_index=True)
        self.end = np.append(self.start[1:], len(terms))
        self.score = impact * weights[terms]
        self.bound = np.maximum.reduceat(self.score, self.start) if len(terms) else np.zeros(0, np.int64)

    def search(self, terms: np.ndarray, times: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the documents of score above 0 that may be among the k best, given that scores below `least` are not; and how many documents were added up."""
        at = np.searchsorted(self.known, terms)
        there = np.flatnonzero((at < len(self.known)) & (self.known[np.minimum(at, len(self.known) - 1)] == terms)) if len(self.known) else np.zeros(0, np.int64)
        at, times = at[there], times[there]
        bound = self.bound[at] * times
        order = np.argsort(bound, kind="stable")
        at, times, bound = at[order], times[order], bound[order]
        upto = np.cumsum(bound)
        rows, scores, read = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        least = max(least, 1)
        cursor = self.start[at].copy()
        total = np.zeros(RANGE, np.int64)
        for low in range(0, self.size, RANGE):
            essential = int(np.searchsorted(upto, least, "left"))  # lists before it add up to less than the kth score
            if essential == len(at):
                break
            total[:] = 0
            for j in range(essential, len(at)):
                a = cursor[j]  # essential lists have been so before, so they were read up to here
                b = a + np.searchsorted(self.owner[a : self.end[at[j]]], low + RANGE)
                total[self.owner[a:b] - low] += self.score[a:b] * times[j]
                cursor[j] = b
            seen = np.flatnonzero(total)
            read += len(seen)
            for j in range(essential - 1, -1, -1):
                seen = seen[total[seen] + upto[j] >= least]
                if not len(seen):
                    break
                owners = self.owner[self.start[at[j]] : self.end[at[j]]]
                place = np.minimum(np.searchsorted(owners, seen + low), len(owners) - 1)
                same = owners[place] == seen + low
                total[seen[same]] += self.score[self.start[at[j]] + place[same]] * times[j]
            seen = seen[total[seen] >= least]
            if len(seen):
                rows, scores = np.concatenate([rows, seen + low]), np.concatenate([scores, total[seen]])
                if len(rows) >= k:
                    least = max(least, int(np.partition(scores, len(scores) - k)[-k]))
                    keep = scores >= least  # ties stay, ids decide between them later
                    rows, scores = rows[keep], scores[keep]
        return rows, scores, read


Item = tuple[int, np.ndarray, np.ndarray]


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, total: int, length: int) -> Iterator[Shard]:
    held: list[pa.RecordBatch] = []
    count = 0

    def made() -> Shard:
        table = pa.Table.from_batches(held)
        sizes = table.column("terms").combine_chunks()
        sizes = sizes.value_lengths().to_numpy(zero_copy_only=False) if len(table) else np.zeros(0, np.int64)
        flat = lambda name: table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ids = table.column("doc_id").combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        docs = np.rec.fromarrays([~known, ids.fill_null(0).to_numpy(zero_copy_only=False)], names="none,id")
        return Shard(docs, table.column("n").to_numpy(), np.repeat(np.arange(len(table)), sizes), flat("terms"), flat("times"), weights, total, length)

    for batch in batches:
        held.append(batch)
        count += len(batch.column("terms").flatten())
        if count >= POSTINGS:
            yield made()
            held, count = [], 0
    if count:
        yield made()


def _rank(batches: Iterator[pa.RecordBatch], items: list[Item], weights: np.ndarray, total: int, length: int, k: int) -> Iterator[pa.RecordBatch]:
    """(item, doc_id, score): the k best of a task's documents for each item. The kth score goes with an item from shard to shard."""
    found = {i: (np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)) for i, _, _ in items}
    for shard in _shards(batches, weights, total, length):
        for i, terms, times in items:
            none, ids, scores = found[i]
            rows, more, _ = shard.search(terms, times, int(scores[-1]) if len(scores) == k else 1, k)
            if len(rows):
                none, ids, scores = np.concatenate([none, shard.docs.none[rows]]), np.concatenate([ids, shard.docs.id[rows]]), np.concatenate([scores, more])
                best = np.lexsort((ids, none, -scores))[:k]
                found[i] = none[best], ids[best], scores[best]
    for i, (none, ids, scores) in found.items():
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i), pa.int32()), pa.array(ids, pa.int64(), mask=none), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])


def _mapped(df: DataFrame, f: Callable, schema: str, *args: object) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return f(batches, *args)

    return df.mapInArrow(run, schema)


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K, most_terms: int = TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: for each text of items(item_id, text) the k best of docs(doc_id, text), as far as they score above 0.

    Terms are the runs of bytes that are no ASCII but digits and letters, A-Z lower-cased, told apart by hashes of 64 bits. Scores are whole numbers: of each term of the item, repeats
    included, floor(1000 ln((2 N + 2) / (2 df + 1))) times (10^9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L, all over whole texts of all documents.
    Equal scores go by ascending doc_id, null last; rows are documents of their own, whatever ids they share. Equal rows of items count once; texts that share an
    item_id are ranked each for itself. Null and empty texts have no term: they're found by nothing, find nothing and don't count in N. No document or item: no rows.
    Items are searched together as long as their terms are `most_terms` on average; more are searched in turn, each time over all documents."""
    scratch = Scratch(spark, "ranked")
    texts = doc_rows(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    asked = scratch.keep(_mapped(texts, _item_terms, "item_id long, text string, terms array<long>").where(F.size("terms") > 0), "items")
    rounds = max(1, -(-(asked.agg(F.sum(F.size(F.array_distinct("terms")))).first()[0] or 0) // most_terms))
    rows = doc_rows(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    results = None
    for turn in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == turn)
        found = part.orderBy("item_id", "text").select("item_id", "terms").collect()  # of a bounded number of terms
        of = [np.unique(np.array(r.terms, np.int64).view(np.uint64), return_counts=True) for r in found]
        known = np.unique(np.concatenate([h for h, _ in of])) if of else np.zeros(1, np.uint64)
        wanted = [(i, np.searchsorted(known, h).astype(np.int64), n) for i, (h, n) in enumerate(of)]
        posted = scratch.keep(_mapped(rows, _postings, POSTED, known).where("n > 0"), f"posted{turn}")
        total, length = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = np.zeros(len(known), np.int64)
        for r in posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():  # a row for each known term
            weights[r.term] = math.floor(1000 * math.log((2 * total + 2) / (2 * r.df + 1)))
        best = _mapped(posted, _rank, "item int, doc_id long, score long", wanted, weights, total, length or 1, k)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(found)], "item int, item_id long")
        best = best.withColumn("rank", place).where(F.col("rank") <= k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        results = best if results is None else results.unionByName(best)
    return results
