"""Spelling variants by permuterm rotations (operator 12).

A word is marked with a terminator and turned: the rotation that begins after the code
point at ``i`` ends with that code point, so its prefix ``w[i+1:] $ w[:i]`` stands for the
word with the edited place left out. Words that share such a prefix differ there in
exactly one replaced code point; a rotation equal to the prefix is a word without it, one
deletion away. Sorting the rotations by prefix makes each of these ranges one group, of at
most one word per letter of the alphabet and one whole rotation (91 rows, whatever the
input), which is scanned once: each member takes from it its number of neighbours and its
best one, so nothing is emitted per pair.

A deletion can be made at any of a run of equal letters; only the first counts, so every
neighbour is met in one group only.

Defined results: NULL and empty texts hold no words; a NULL doc_id counts as the empty
string in the hash; repeated rows count again; two words of equal count tie by code-point
order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm.common import cut, table

RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
TIMES = 5              # a form is so many times as frequent as its variant
EVERY = 199            # runs whose hash this divides lose a code point
END = "$"              # sorts apart from every letter


def lower_ascii(run: Column) -> Column:
    """Only A-Z lower-cased; the plain function where all code points are of one byte."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` over all documents. Runs shorter than ``min_length`` cannot give a word."""
    found = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = runs.select(F.when(h % EVERY == 0, less).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, word, n, edited, first``: for each place of a word the rotation without it
    (``edited`` is what it lacks, ``first`` whether no equal letter stands before it), and
    each whole rotation (``edited`` empty)."""
    size = F.char_length("word")

    def turn(i: Column) -> Column:
        whole = i < 0           # -1 .. -size-1: the rotation from place -i-1 on
        start = F.when(whole, -i).otherwise(i + 2)
        stop = F.when(whole, -i - 1).otherwise(i)
        edited = F.when(whole, "").otherwise(F.substring("word", i + 1, F.lit(1)))
        before = F.when(i > 0, F.substring("word", i, F.lit(1))).otherwise("")
        return F.struct(F.concat(F.substring(F.col("word"), start, size), F.lit(END), F.substring(F.col("word"), F.lit(1), stop)).alias("prefix"),
                        edited.alias("edited"), (edited != before).alias("first"))
    places = F.transform(F.sequence(-size - 1, size - 1), turn)
    return words.select("word", "n", F.explode(places).alias("r")).select("r.prefix", "word", "n", "r.edited", "r.first")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best`` (struct of -n and word) of the words with a near word."""
    groups = (rotations(words).groupBy("prefix").agg(F.collect_list(F.struct("word", "n", "edited", "first")).alias("m"))
              .filter(F.size("m") > 1))

    def near(x: Column, y: Column) -> Column:
        replaced = (x["edited"] != "") & (y["edited"] != "") & (x["edited"] != y["edited"])
        deleted = (x["edited"] != "") & x["first"] & (y["edited"] == "")
        added = (y["edited"] != "") & y["first"] & (x["edited"] == "")
        return replaced | deleted | added

    def scan(x: Column) -> Column:
        others = F.filter("m", lambda y: near(x, y))
        return F.struct(x["word"].alias("word"), F.size(others).alias("k"),
                        F.array_min(F.transform(others, lambda y: F.struct((-y["n"]).alias("n"), y["word"].alias("word")))).alias("best"))
    seen = groups.select(F.explode(F.transform("m", scan)).alias("s")).select("s.word", "s.k", "s.best").filter("k > 0")
    return seen.groupBy("word").agg(F.sum("k").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form, by pointer doubling: a form is ``TIMES`` as
    frequent, so chains are as long as the logarithm of the largest count."""
    at = cut(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = cut(at.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    words = cut(word_counts(docs, min_length, min_count), "words")
    told = words.join(neighbours(words), "word", "left")
    best_n = -F.col("best.n")
    chosen = best_n >= times * F.col("n")
    told = cut(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best.word")).alias("form"),
                           F.when(chosen, best_n).cast("long").alias("form_n")), "word-forms")
    last = roots(told.filter(F.col("form").isNotNull()))
    return told.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
