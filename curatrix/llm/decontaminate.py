"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Fixed masks choose WEIGHT of up to 8 consecutive tokens and ignore the others, so that a hash also agrees where an ignored token was
replaced. Hashes of all positions of the benchmark are joined with those of all positions of the documents. Every hit fixes
an alignment of a document with a benchmark item; the aligned tokens around it are compared, and a window of them
that agrees in most places is a leak.

The masks lose nothing: whichever 5 of 20, 4 of 16, 3 of 12 or 2 of 8 tokens are replaced, one of them still hits, so every
window of 8 to 20 tokens that agrees in 75 % is found (a test goes through all patterns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows
from curatrix.scratch import Scratch

#: 1: a token that counts, 0: one that's ignored.
MASKS = ("111011", "1001111", "1110101", "11010011", "10100111", "11011001", "101111", "11111")
#: Windows of an item that decide, in tokens (a shorter item is one window), and percent of their tokens that agree.
WINDOW, AGREE = 20, 75
#: An item of fewer tokens leaks only where all of them occur in a row; no mask is needed to find that.
SHORT = 8
#: Tokens whose seeds are made at once; a block also holds the tokens that masks reach beyond it.
BLOCK = 64
#: Tokens of the parts in which a text's hits are verified, besides their margins.
PART = 256
#: Benchmark seeds (three numbers each, some 80 bytes in memory) and text keys (two numbers) that are broadcast at most; more are
#: joined by a shuffle. Bytes of the benchmark's tokens that are broadcast at most.
BROADCAST_SEEDS, BROADCAST_KEYS, BROADCAST_BYTES = 500_000, 400_000, 32 << 20
#: Parts that the alignments of one item are dealt into where items are not broadcast.
SALTS = 16


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of any script.

    The text is first cut at separators into pieces of some 32,000 characters, so that only one piece's tokens exist at a time."""
    pieces = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?s).{0,32000}[^\p{L}\p{N}]|.+"), F.lit(0))
    return F.flatten(F.transform(pieces, lambda p: F.transform(F.filter(F.split(p, r"[^\p{L}\p{N}]+"), lambda t: t != ""), lambda t: F.xxhash64(t))))


def _masked(number: int, mask: str) -> Column:
    """Hash of the chosen ones of the tokens t0, t1, ... of a window, null if its last one isn't there; the mask's number keeps masks apart."""
    chosen = [f"t{k}" for k, bit in enumerate(mask) if bit == "1"]
    return F.when(F.col(chosen[-1]).isNotNull(), F.xxhash64(F.lit(number), *chosen))


def _seeds(rows: DataFrame, keep: list[str], masks: list[tuple[int, str]]) -> DataFrame:
    """A row for each position and mask that fits: the columns kept, `at` and `seed`. rows has h, an array of token hashes.

    Generators copy a row for each row they make; from blocks that's a few hundred bytes however long the text is."""
    reach = max(len(m) for _, m in masks)
    starts = F.when(F.size("h") > 0, F.sequence(F.lit(0), F.size("h") - 1, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    blocks = rows.select(*keep, F.explode(F.transform(starts, lambda s: F.struct(s.alias("from"), F.slice("h", s + 1, F.lit(BLOCK + reach - 1)).alias("h")))).alias("b"))
    places = F.sequence(F.lit(0), F.least(F.size("b.h"), F.lit(BLOCK)) - 1)
    placed = blocks.select(*keep, F.col("b.from").alias("from"), F.col("b.h").alias("h"), F.explode(places).alias("k"))
    # tokens as columns: the code for all masks stays small enough to be compiled
    windows = placed.select(*keep, (F.col("from") + F.col("k")).alias("at"), *(F.get("h", F.col("k") + i).alias(f"t{i}") for i in range(reach)))
    seeds = F.stack(F.lit(len(masks)), *(_masked(number, mask) for number, mask in masks))
    return windows.select(*keep, "at", seeds.alias("seed")).where("seed is not null")


def _best_window(same: Column, size: Column) -> Column:
    """The most agreeing places of any window of `size` of an array of 0 and 1."""
    # as the only element of an array, `same` is bound to a name and computed once
    most = lambda s: F.array_max(F.transform(F.sequence(F.lit(0), F.size(s) - size), lambda i: F.aggregate(F.slice(s, i + 1, size), F.lit(0), lambda a, x: a + x)))
    return F.get(F.transform(F.array(same), most), F.lit(0))


def _text_keys(text: Column) -> list[Column]:
    """Two independent hashes of a text; whether a text leaks depends on nothing else of its row."""
    return [F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("twin")]


def _few(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def _leaking_texts(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...], window: int, agree: int) -> DataFrame:
    """key, twin, item_id, doc_token, agreeing and compared of each leaking text, item and alignment."""
    scratch = Scratch(spark, "leaks")
    items = doc_rows(benchmark, "item_id", "text").distinct()
    items = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), token_hashes(F.col("text")).alias("h"))
    items = scratch.keep(items.where(F.size("h") > 0).withColumnRenamed("h", "i"), "items")
    # lengths of the short items: 7 at most
    lengths = sorted(r.n for r in items.where(F.size("i") < SHORT).select(F.size("i").alias("n")).distinct().collect())
    long, short = list(enumerate(masks)), {n: (-n, "1" * n) for n in lengths}
    plain = items.select("item", F.col("i").alias("h"))
    test = _seeds(plain.where(F.size("h") >= SHORT), ["item"], long)
    for n in lengths:
        test = test.unionByName(_seeds(plain.where(F.size("h") == n), ["item"], [short[n]]))
    test = scratch.keep(test.select("seed", "item", F.col("at").alias("at_item")), "seeds")

    rows = doc_rows(docs, "text")
    hashed = rows.select(*_text_keys(F.col("text")), token_hashes(F.col("text")).alias("h"))
    met = _seeds(hashed, ["key", "twin"], [*long, *short.values()]).join(_few(test, BROADCAST_SEEDS), "seed")
    part = F.floor(F.col("at") / PART).cast("int")
    lines = met.select("key", "twin", "item", (F.col("at") - F.col("at_item")).alias("doc_token"), part.alias("part")).distinct()
    lines = scratch.keep(lines, "lines")

    # texts that were hit, each once; they are read again, so that no seed carries tokens
    hit = scratch.keep(lines.select("key", "twin").distinct(), "hit")
    texts = rows.select(*_text_keys(F.col("text")), "text").join(_few(hit, BROADCAST_KEYS), ["key", "twin"], "left_semi")
    texts = texts.groupBy("key", "twin").agg(F.first("text").alias("text")).select("key", "twin", token_hashes(F.col("text")).alias("h"))
    # their parts; any window that holds a hit lies in the hit's part and its margins
    margin = window + max(map(len, masks))
    first = lambda p: F.greatest(p * PART - margin, F.lit(0))
    cut = lambda p: F.struct(p.alias("part"), first(p).alias("first"), F.slice("h", first(p) + 1, p * PART + PART + margin - first(p)).alias("d"))
    parts = texts.select("key", "twin", F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size("h") - 1) / PART).cast("int")), cut)).alias("p")).select("key", "twin", "p.*")
    both = lines.join(parts, ["key", "twin", "part"])
    size = items.select("item", F.size("i").alias("n"), "item_id", "i")
    bytes_of = items.agg(F.sum(F.size("i") * 8 + 40)).first()[0] or 0
    if bytes_of <= BROADCAST_BYTES:
        both = both.join(F.broadcast(size), "item")
    else:
        salted = size.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = both.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")).join(salted, ["item", "salt"]).drop("salt")
    # the item's places in the part and its margins; no token of the document is at a place before its start or after its end
    begin = F.greatest(F.col("part") * PART - margin - F.col("doc_token"), F.lit(0))
    end = F.least(F.col("n"), F.col("part") * PART + PART + margin - F.col("doc_token"))
    agrees = lambda j: F.coalesce((F.get("i", j) == F.get("d", F.col("doc_token") + j - F.col("first"))).cast("int"), F.lit(0))
    same = F.transform(F.sequence(begin, end - 1), agrees)
    compared = F.least(F.lit(window), F.col("n"))
    told = both.select("key", "twin", "item", "item_id", "doc_token", "n", _best_window(same, compared).alias("agreeing"), compared.alias("compared"))
    enough = F.col("agreeing") * 100 >= F.col("compared") * F.when(F.col("n") < SHORT, 100).otherwise(agree)
    told = told.where(enough).groupBy("key", "twin", "item", "item_id", "doc_token", "compared").agg(F.max("agreeing").alias("agreeing"))
    return scratch.keep(told.drop("item"), "told")


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW, agree: int = AGREE) -> DataFrame:
    """Leaked passages: doc_id, item_id, doc_token (where the item's first token would be in the document; may be negative),
    agreeing (places that agree in the best window) and compared (tokens in it).

    One row for each document, item and alignment in which a window of min(window, item length) tokens agrees in `agree` percent;
    all tokens of an item under SHORT tokens have to agree. Null and empty texts and items leak nothing. Every text of a
    doc_id and every text of an item_id is searched for itself, whatever their order; repeated rows, and texts that share ids,
    give one row for each (doc_id, item_id, doc_token), that with the most agreeing places. A null id is an id like any other.
    No rows in either: no rows.
    """
    told = _leaking_texts(spark, docs, benchmark, masks, window, agree)
    rows = doc_rows(docs, "doc_id", "text").select("doc_id", *_text_keys(F.col("text")))
    found = rows.join(_few(told, BROADCAST_KEYS), ["key", "twin"])
    best = found.groupBy("doc_id", "item_id", "doc_token").agg(F.max(F.struct("agreeing", "compared")).alias("best"))
    return best.select("doc_id", "item_id", "doc_token", "best.agreeing", "best.compared")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, without those whose text leaks; other texts of the same doc_id stay.

    Null and empty texts stay; without benchmark items all rows do."""
    found = _leaking_texts(spark, docs, benchmark, MASKS, WINDOW, AGREE).select("key", "twin").distinct()
    found = _few(Scratch(spark, "leaked").keep(found, "texts"), BROADCAST_KEYS)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = F.col(names[docs.columns.index("text")])
    kept = docs.toDF(*names).select(*names, *_text_keys(text)).join(found, ["key", "twin"], "left_anti")
    return kept.select(*names).toDF(*docs.columns)
