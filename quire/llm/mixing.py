"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same rate, its source's target over its source's words; the
whole part of the rate is copied surely, the fraction is a copy probability. Probabilities are
not drawn one by one (the words taken would scatter) but paired: of two documents one gives
words of probability mass to the other until one of the two is integral, in a random direction
that leaves each document's expectation as it was. Mass is counted in words, so a pair's
expected words stay what they are, exactly, and a source ends within one document's size of its
target (a small document's: large ones are paired first).

The pairs form a reduction tree: hashed groups of a source's documents reduce side by side to
one fractional document each, groups of these to one again, until each source has one, which is
drawn. No group holds more than about ``GROUP`` rows, whatever the size of a source; rows
without text travel.

Edge cases: a null text has size 0, as has one without words, and takes 0 words; a null source
is a source, the last one; sources of size 0 have target 0; repeated rows are documents of
their own; equal ids or texts do not matter; other columns are ignored. The draw depends on
ids, texts and ``seed`` only, not on partitions.
"""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, documents, result, text_key, written

#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix as a share of all words.
SHARE = 1.5
#: Most copies of a document (so the target of a source over its size).
MOST = 2.0
#: Documents that one task pairs at a time, about.
GROUP = 2_000
#: A document of more than this part of its group's words is paired with all the others.
LARGE = 50
SEED = 17
#: Parts into which the rows of one source are dealt for the join with its target.
SALT = 64


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, source, size)."""
    return docs.select("doc_id", text_key().alias("key"), "source",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, docs, target): one row for each source.

    Resharing what exceeds a limit by weight, again and again, ends where every source has its
    weight times one level, or its limit if that is less. With the first j sources (by limit over
    weight) at their limits, the others' level follows; the level sought is the largest of these.
    The two windows run over one row for each source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    values = F.array(*map(F.lit, weights))
    per = per.withColumn("w", F.element_at(values, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("cap", most * F.col("source_size"))
    every = Window.partitionBy(F.lit(0))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    level = ((share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return per.select("source", "source_size", "docs", F.least(F.col("w") * F.col("level"), "cap").alias("target"))


def _pair_with_all(row: dict, rest: list[dict], draw) -> None:
    """A large document against all smaller ones of its group as one counterpart, whose
    probabilities rise or fall together: one by one they would seldom move it to 0 or 1."""
    weight = sum(r["size"] for r in rest)
    if not rest or not 0.0 < row["p"] < 1.0:
        return
    up = min(row["size"] * (1.0 - row["p"]), weight * min(r["p"] for r in rest))
    down = min(row["size"] * row["p"], weight * min(1.0 - r["p"] for r in rest))
    rise = draw() * (up + down) < down
    words = up if rise else -down
    whole = row["size"] * (1.0 - row["p"]) <= up if rise else row["size"] * row["p"] <= down
    row["p"] = (1.0 if rise else 0.0) if whole else row["p"] + words / row["size"]
    for r in rest:
        r["p"] = min(max(r["p"] - words / weight, 0.0), 1.0)


def _reduce(level: int, seed: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        # large documents first: the fraction that is left in the end is then a small one's
        rows = sorted(group.to_pylist(), key=lambda r: (-r["size"], r["unit"]))
        source, part = rows[0]["source"], rows[0]["part"]
        name = f"{seed}|{level}|{part}|{source is None}|{source}".encode()
        draw = random.Random(hashlib.blake2b(name, digest_size=16).digest()).random
        words = sum(r["size"] for r in rows)
        for i, row in enumerate(rows[:-1]):
            if row["size"] * LARGE < words:
                break
            _pair_with_all(row, [r for r in rows[i + 1:] if 0.0 < r["p"] < 1.0], draw)
        held = None  # the one row whose probability is not integral yet
        for row in rows:
            if not 0.0 < row["p"] < 1.0:
                continue
            if held is None:
                held = row
                continue
            # words that can go from held to row, and back
            away = min(held["size"] * held["p"], row["size"] * (1.0 - row["p"]))
            back = min(held["size"] * (1.0 - held["p"]), row["size"] * row["p"])
            give = draw() * (away + back) < back
            words = away if give else -back
            full = held["size"] * (held["p"] if give else 1.0 - held["p"]) <= abs(words)
            held_p, row_p = held["p"] - words / held["size"], row["p"] + words / row["size"]
            if full:  # held is integral now, row may be too
                held["p"] = 0.0 if give else 1.0
                row["p"] = min(max(row_p, 0.0), 1.0)
                held = row if 0.0 < row["p"] < 1.0 else None
            else:
                row["p"] = 1.0 if give else 0.0
                held["p"] = min(max(held_p, 0.0), 1.0)
                held = held if 0.0 < held["p"] < 1.0 else None
        if last and held is not None:
            held["p"] = 1.0 if draw() < held["p"] else 0.0
        return pa.Table.from_pylist(rows, schema=group.schema)

    return run


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, key, source, size, source_size, target, copies): one row for each document;
    ``key`` is ``common.text_key`` of its text."""
    spark = docs.sparkSession
    sized = written(sizes(docs), "sizes")
    goal = written(targets(sized, weights, share, most), "targets")
    salted = goal.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    unit = F.xxhash64(F.lit(seed), "doc_id", "key")
    rows = (sized.withColumn("unit", unit).withColumn("salt", F.pmod("unit", F.lit(SALT)).cast("int")).alias("a")
            .join(salted.alias("b"), F.expr("a.salt = b.salt and a.source <=> b.source"))
            .select("a.doc_id", "a.key", "a.source", "a.size", "a.unit", "b.source_size", "b.docs", "b.target"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (rows.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("int"))
            .withColumn("p", F.col("rate") - F.col("whole")).drop("rate"))
    columns = ["doc_id", "key", "source", "size", "source_size", "target"]
    sure = rows.filter("p = 0 or size = 0").select(*columns, F.col("whole").alias("copies"))
    todo = rows.filter("p > 0 and size > 0")
    parts, level, done = F.ceil(F.col("docs") / GROUP), 0, [sure]
    most_docs = goal.agg(F.max("docs")).first()[0] or 0
    while True:
        last = most_docs <= GROUP ** (level + 1)
        dealt = F.pmod(F.xxhash64("unit", F.lit(level)), parts) if not last else F.lit(0).cast("long")
        todo = todo.withColumn("part", dealt)
        out = written(todo.groupBy("source", "part").applyInArrow(_reduce(level, seed, last), todo.schema), f"mix{level}")
        whole = out.filter("p = 0 or p = 1")
        done.append(whole.select(*columns, (F.col("whole") + F.col("p").cast("int")).alias("copies")))
        if last:
            break
        todo, level = out.filter("p > 0 and p < 1"), level + 1
        parts = F.ceil(F.col("docs") / GROUP ** (level + 1))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents, each as often as the mix takes it, with all their columns."""
    names = docs.columns
    same = Window.partitionBy("doc_id", "_key", "source").orderBy(F.lit(0))
    numbered = docs.withColumn("_key", text_key()).withColumn("_n", F.row_number().over(same))
    copies = mix(docs, **settings).withColumnRenamed("key", "_key")
    copies = copies.withColumn("_n", F.row_number().over(same)).select("doc_id", "_key", "source", "_n", "copies")
    pairs = numbered.alias("a").join(copies.alias("b"), F.expr(
        "a.doc_id <=> b.doc_id and a._key = b._key and a.source <=> b.source and a._n = b._n"))
    again = F.explode(F.array_repeat(F.lit(0), F.col("b.copies")))
    return pairs.select(*(F.col(f"a.`{c}`") for c in names), again.alias("_again")).drop("_again")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return result(lambda: mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", taken), "op8")
