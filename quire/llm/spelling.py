r"""Spelling variants found by permuterm rotations.

A word is marked with a terminator and rotated. With the edited character rotated to the end, the
rest of the rotation is a prefix that skips it: words that differ in one replaced character share
this prefix and end differently, and a word without the character has the prefix as a whole
rotation. So each word gives one row for each of its characters (the prefix, the character out)
and one for each of its whole rotations; rows are sorted by prefix, and a scan of each group of one
prefix tells every member its number of neighbours and the best one. A group holds at most one
whole word and one word for each letter of the alphabet, so it never grows with the corpus, and no
pair is emitted. Where the edited character stands in a run of equal ones, only its first place
meets the shorter word, so that no neighbour counts twice.

Words follow their forms to the last one by pointer doubling: a form occurs at least ``RATIO``
times as often as its word, so paths are at most as long as a count has digits.

Edge cases: a null text has no words; a null id is hashed as an empty one; of repeated rows each
counts; words of equal counts are ordered by code points; a table without words has no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import discard, documents, result, written

# ---- fixed values of the contract -------------------------------------------
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run of so many loses a character.
DAMAGED = 31
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
# -----------------------------------------------------------------------------
END = "$"
#: Words of more characters are compared by digests of their rotations.
LONG = 64
#: Of the polynomial hash of long words: a prime, and a base below it.
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1234567890ABCDEF1357913


def damaged(run: Column, doc_id: Column) -> Column:
    """The run without one character if the hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.pmod(h, F.lit(DAMAGED)) == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all texts; counted in each task before words are shuffled."""
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))
    # outer: a plain explode would extract twice, once to filter
    rows = docs.select("doc_id", F.explode_outer(runs).alias("run")).filter("run is not null")
    rows = rows.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    return (rows.select(damaged(F.col("run"), F.col("doc_id")).alias("word"))
            .filter(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, role, neg, word) of words of at most ``LONG`` characters: role 0 has the whole word as
    ``prefix``, the others lack one character; role 1 where it is the first of its run of equal
    characters. ``neg`` is -n. Whole words of ``LONG`` characters only meet longer ones, elsewhere."""
    size = F.char_length("word")
    rest = lambda i: F.substring("word", i + 1, size)
    head = lambda i: F.substring("word", F.lit(1), i)
    char = lambda i: F.substring("word", i + 1, F.lit(1))
    at = lambda last: words.select("word", (-F.col("n")).alias("neg"), F.explode(F.sequence(F.lit(0), last)).alias("i"))
    i = F.col("i")
    whole = at(size).filter(size < LONG).select(F.concat(rest(i), F.lit(END), head(i)).alias("prefix"), F.lit(0).alias("role"), "neg", "word")
    first = (i == 0) | (char(i) != char(i - 1))
    edited = at(size - 1).select(F.concat(rest(i + 1), F.lit(END), head(i)).alias("prefix"),
                                 F.when(first, 1).otherwise(2).alias("role"), "neg", "word")
    return whole.unionByName(edited)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``rotations`` for long words; a prefix is a digest, a word its number."""
    for batch in batches:
        for number, neg, word in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head, tail, power = [0], [0], 1
            for c in word:
                head.append((head[-1] * _BASE + ord(c)) % _PRIME)
            for c in reversed(word):
                tail.append((tail[-1] + ord(c) * power) % _PRIME)
                power = power * _BASE % _PRIME
            n = len(word)
            places = [(i, n - i, 0) for i in range(n + 1)]
            if n > LONG:
                places += [(i, n - i - 1, 1 if i == 0 or word[i] != word[i - 1] else 2) for i in range(n)]
            for at in range(0, len(places), 4096):
                part = places[at:at + 4096]
                prefix = [hashlib.blake2b(b"%x %x %d %d" % (head[i], tail[k], i, k), digest_size=16).hexdigest() for i, k, _ in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix), pa.array([p[2] for p in part], pa.int32()), pa.array([neg] * len(part), pa.int64()),
                     pa.array([number] * len(part), pa.int64())], ["prefix", "role", "neg", "word"])


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words, and struct (neg, word) of the most frequent."""
    size = F.char_length("word")
    short = scanned(rotations(words.filter(size <= LONG)))
    # numbers in the order of the words; as whole words, those of LONG characters meet longer ones
    numbered = written(words.filter(size >= LONG).orderBy("word").withColumn("number", F.monotonically_increasing_id()), "spelling-long")
    rows = numbered.select("number", -F.col("n"), "word").mapInArrow(_digests, "prefix string, role int, neg long, word long")
    found = scanned(rows).select(F.col("word").alias("number"), "near", "best.neg", F.col("best.word").alias("other"))
    found = found.groupBy("number").agg(F.sum("near").alias("near"), F.min(F.struct("neg", "other")).alias("best"))
    names = numbered.select("number", "word")
    other = numbered.select(F.col("number").alias("_other"), F.col("word").alias("_word"))
    long = (found.join(names, "number").join(other, F.col("best.other") == F.col("_other"))
            .select("word", "near", F.struct("best.neg", F.col("_word").alias("word")).alias("best")))
    return short.unionByName(long).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def scanned(rows: DataFrame) -> DataFrame:
    """(word, near, best) of each word in each group of one prefix that has neighbours there."""
    group = Window.partitionBy("prefix")
    scan = group.orderBy("neg", "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("neg", "word")
    edited, opening, whole = F.col("role") > 0, F.col("role") == 1, F.col("role") == 0
    seen = rows.select(
        "word", "role",
        F.count(F.when(edited, 1)).over(scan).alias("n_edited"), F.count(F.when(opening, 1)).over(scan).alias("n_opening"),
        F.first(F.when(edited, me), ignorenulls=True).over(scan).alias("best1"),
        F.nth_value(F.when(edited, me), 2, ignoreNulls=True).over(scan).alias("best2"),
        F.first(F.when(opening, me), ignorenulls=True).over(scan).alias("best_opening"),
        F.first(F.when(whole, me), ignorenulls=True).over(scan).alias("shorter"))
    other = F.when(F.col("best1.word") == F.col("word"), F.col("best2")).otherwise(F.col("best1"))
    shorter = F.when(opening, F.col("shorter"))
    count = F.when(whole, F.col("n_opening")).otherwise(F.col("n_edited") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
    best = F.when(whole, F.col("best_opening")).otherwise(F.least(other, shorter))
    return seen.select("word", count.alias("near"), best.alias("best")).filter("near > 0")


def roots(links: DataFrame, steps: int) -> DataFrame:
    """(word, root) of links (word, form): each step doubles the length of the path that is behind."""
    links = links.withColumnRenamed("form", "root")
    for _ in range(steps):
        there = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(links.join(there, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        discard(links)
        links = longer
    return links


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of documents (doc_id, text); ``ratio`` is 2 at least."""
    words = written(vocabulary(docs.select("doc_id", "text"), min_length, min_count), "spelling-words")
    near = neighbours(words)
    frequent = -F.col("best.neg") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.word")).alias("form"), F.when(frequent, -F.col("best.neg")).alias("form_n"))
    formed = written(formed, "spelling-forms")
    discard(words)
    most = formed.agg(F.max("n")).first()[0] or 1
    links = written(formed.filter("form is not null").select("word", "form"), "spelling-links")
    last = roots(links, ceil(log2(max(2.0, log(max(most, ratio), ratio) + 1))))
    return formed.join(last, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(lambda: spelling_variants(documents(spark, sf_dir)), "op13")
