"""Spelling variants: words of a corpus that differ by one edit, each with its more frequent form and the root of its forms.

Rare-first bigram prefix filter. One edit destroys two of a word's bigrams at most, so of two near words' three rarest bigrams, in one order
for all words, at least one is in both prefixes, moved by one place at most. Only words that share such a bigram meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows, salted_join
from curatrix.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points of a word and occurrences, at least; one (document, run) in DAMAGE loses a code point.
LEAST_LENGTH, LEAST_N, DAMAGE = 5, 3, 97
#: Bigrams that one edit destroys at most, and one more.
PREFIX = 3
#: A form has so many times a word's occurrences at least. That bounds chains of forms to the logarithm of the largest count.
FORM = 2


def words(docs: DataFrame, damage: int = DAMAGE, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N) -> DataFrame:
    """word, n: the words of docs(doc_id, text) that are long and frequent enough, and their occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Where damage divides the unsigned crc32 of `<doc_id>:<run>`, the run
    loses the code point at that crc32 modulo its length; 0 damages none. Runs below the least length stay below it and aren't looked at.
    Null texts have no word, a null doc_id counts as the empty text, repeated rows count again. Occurrences are added up before they are shuffled."""
    low = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    found = F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{max(1, least_length)},}}"), F.lit(0))
    runs = doc_rows(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    word: Column = F.col("run")
    if damage:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_n)


def rare_bigrams(counted: DataFrame) -> DataFrame:
    """word, n, length, gram, pos: the PREFIX rarest bigrams of each word of counted(word, n) and their places, from 1.

    Bigrams are ordered by the number of their places in all words, then by themselves, then by place. Their counts are broadcast: the 90 letters
    that words have make 8,100 bigrams at most."""
    places = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.struct(F.col("word").substr(i, F.lit(2)).alias("gram"), i.alias("pos")))
    grams = counted.where("length(word) > 1").select("word", "n", F.length("word").alias("length"), F.explode(places).alias("at")).select("word", "n", "length", "at.*")
    often = F.broadcast(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often")))
    place = F.row_number().over(Window.partitionBy("word").orderBy("often", "gram", "pos"))
    return grams.join(often, "gram").withColumn("place", place).where(F.col("place") <= PREFIX).select("word", "n", "length", "gram", "pos")


def _thirds(word: Column, size: Column) -> Column:
    """What stays of a word, whose partner or itself has `size` code points, if the edit is in one of its thirds, for each third."""
    one, two = F.floor(size / 3).cast("int"), F.floor(2 * size / 3).cast("int")
    length = F.length(word)
    end = lambda n: F.substring(word, (length - n + 1).cast("int"), n)
    start = lambda n: F.substring(word, F.lit(1), n)
    return F.array(F.concat(F.lit("1"), end(size - one)), F.concat(F.lit("2"), start(one), F.lit(" "), end(size - two)), F.concat(F.lit("3"), start(two)))


def near_pairs(rare: DataFrame) -> DataFrame:
    """a, na, b, nb: all pairs of words of rare_bigrams() that differ by one inserted, deleted or replaced code point, each once, the shorter or else smaller one first.

    Words meet if a bigram of their prefixes agrees in place and length: a replacement moves no bigram, an insertion moves it by 0 or 1.
    A frequent bigram's bucket is divided by the two thirds of the shorter word that the edit leaves as they are, so that its work
    doesn't grow with the square of its words; every near pair shares two thirds. Then the edit distance decides."""

    def met(kind: int, size: Column, pos: Column, word: str, n: str) -> DataFrame:
        rows = rare.select(F.col("word").alias(word), F.col("n").alias(n), "gram", F.lit(kind).alias("kind"), size.alias("size"), pos.alias("pos"))
        return rows.withColumn("kept", F.explode(_thirds(F.col(word), F.col("size"))))

    size, pos = F.col("length"), F.col("pos")
    left = met(0, size, pos, "a", "na").unionByName(met(1, size, pos, "a", "na"))
    right = met(0, size, pos, "b", "nb").unionByName(met(1, size - 1, pos, "b", "nb")).unionByName(met(1, size - 1, pos - 1, "b", "nb"))
    both = left.join(right, ["gram", "kind", "size", "pos", "kept"])
    both = both.where(((F.col("kind") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return both.select("a", "na", "b", "nb").distinct()


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """word, root for all words of forms(word, form) that have a form: where the chain of forms ends.

    Pointers double their reach in each round. A form gains occurrences at each step, so there are no circles and, with n below 2^63, seven rounds at most."""
    reach = scratch.keep(forms.where("form is not null").select("word", F.col("form").alias("root")), "reach0")
    turn = 0
    while True:
        turn += 1
        step = reach.select(F.col("word").alias("root"), F.col("root").alias("far"))
        sizes = reach.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
        reach = scratch.keep(salted_join(reach, step, ["root"], sizes, "word", "left"), f"reach{turn}")
        if reach.where("far is not null").isEmpty():
            return reach.select("word", "root")
        reach = reach.select("word", F.coalesce("far", "root").alias("root"))


def variants(spark: SparkSession, docs: DataFrame, damage: int = DAMAGE, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word that words() finds in docs(doc_id, text).

    form: of the near words the one with the largest n, ties to the smallest in code-point order, if its n is FORM times the word's at least, else null; form_n its n.
    root: where the chain of forms that begins at the word ends, the word itself if it has no form. n_near: how many near words there are.
    Prefixes need words of four code points at least. No rows, or no word frequent enough: no rows. Other columns of docs don't matter."""
    if least_length <= PREFIX:
        raise ValueError(f"words need more than {PREFIX} code points")
    scratch = Scratch(spark, "spelling")
    counted = scratch.keep(words(docs, damage, least_length, least_n), "words")
    rare = scratch.keep(rare_bigrams(counted), "rare")
    pairs = scratch.keep(near_pairs(rare), "pairs")
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    frequent = -F.col("best.m") >= FORM * F.col("n")
    forms = counted.join(best, "word", "left").select(
        "word", F.when(frequent, F.col("best.other")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, -F.col("best.m")).alias("form_n")
    )
    forms = scratch.keep(forms, "forms")
    return forms.join(_roots(scratch, forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
