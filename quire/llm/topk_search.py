"""Exact top-k search on binary codes by incremental multi-index hashing.

A vector's code has one bit for each component, its sign. Codes are cut into segments of at
most log2(number of codes) bits, and each segment indexes the distinct codes by its value. A code
within distance r of a query's differs in some segment by at most r / segments bits. So a query
probes the index with all values that differ from its own segments by 0 bits, then 1, 2, ...;
after radius s every code up to distance segments * (s + 1) - 1 is found. A query ends when it has
k verified neighbours within that distance: then no other can be among the nearest k. Until then,
codes farther than the k-th neighbour found so far are passed over.

Equal codes are one entry that keeps its k + 1 least distinct ids and how often each has the code, k
at most, so a vector that fills a third of the table is found and compared once. Rows with the
query's own id are not counted wherever it is decided what is near enough. Ties go to the smaller id. Everything is SQL functions.

Edge cases: a null vector or id, or a vector without components, is neither query nor neighbour;
a null or zero component is a 0 bit; components past the 64th are added to those 64 places
before; ids that repeat are separate neighbours; with fewer than k others all are returned; other
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import result, written
from quire.session import read_table

BITS = 64
K = 10
#: Every row whose id this divides is a query.
EVERY = 50


def code_of(vector: str = "embedding") -> Column:
    """The sign bits of a vector as a 64-bit integer."""
    part = (f"aggregate(filter(sequence(0, size({vector}) - 1), at -> at % {BITS} = place), 0D, "
            f"(total, at) -> total + coalesce(cast(element_at({vector}, at + 1) as double), 0D))")
    return F.expr(f"aggregate(sequence(0, {BITS - 1}), 0L, (bits, place) -> "
                  f"bits | if(if(size({vector}) <= {BITS}, coalesce(cast(get({vector}, place) as double), 0D), {part}) > 0, "
                  f"shiftleft(1L, place), 0L))")


def segment_bounds(n_codes: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments for so many codes."""
    count = max(1, min(BITS // 2, ceil(BITS / log2(max(4, n_codes)))))
    size = [BITS // count + (i < BITS % count) for i in range(count)]
    return [(sum(size[:i]), n) for i, n in enumerate(size)]


def _segment(code: str, first: int, bits: int) -> str:
    return f"(shiftrightunsigned({code}, {first}) & {(1 << bits) - 1}L)"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest rows of ``vectors`` to each row of
    ``queries`` (itself excepted, by its id)."""
    def coded(df: DataFrame) -> DataFrame:
        return df.filter(F.col(id_col).isNotNull() & (F.size(vector) > 0)).select(F.col(id_col).alias("id"), code_of(vector).alias("code"))

    rows = written(coded(vectors), "codes")
    asked = written(coded(queries).distinct(), "queries")
    least = Window.partitionBy("code").orderBy("id")
    counted = rows.groupBy("code", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
    # one of the k + 1 ids may be the query's own; of the others k rows are enough
    entries = (counted.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1).groupBy("code")
               .agg(F.array_sort(F.collect_list(F.struct("id", "times"))).alias("ids")))
    entries = written(entries, "entries")
    bounds = segment_bounds(entries.count())
    index = entries.select(F.explode(F.array(*(
        F.expr(f"named_struct('seg', {i}, 'value', {_segment('code', *b)})") for i, b in enumerate(bounds)))).alias("s"),
        "code", "ids").select("s.seg", "s.value", "code", "ids")
    index = written(index, "index")
    # ``most``: no neighbour of the query can be farther, given those found so far
    active = written(asked.select(F.col("code").alias("query"), F.lit(BITS).alias("most")).distinct(), "active")
    empty = "query long, code long, ids array<struct<id:long,times:int>>, distance int"
    best = vectors.sparkSession.createDataFrame([], empty)
    ended = []
    for radius in range(max(b for _, b in bounds) + 1):
        probes = None
        for i, (first, bits) in enumerate(bounds):
            masks = [sum(1 << x for x in c) for c in combinations(range(bits), radius)]
            if not masks:
                continue
            probe = active.select("query", "most", F.lit(i).alias("seg"), F.explode(F.lit(np.array(masks, dtype=np.int64))).alias("mask"))
            probe = probe.select("query", "most", "seg", F.expr(f"{_segment('query', first, bits)} ^ mask").alias("value"))
            probes = probe if probes is None else probes.unionByName(probe)
        apart = [f"bit_count({_segment('query ^ code', *b).replace('query ^ code', '(query ^ code)')})" for b in bounds]
        # a code is taken up once: where the first of its closest segments is probed
        turn = f"array_position(array({', '.join(apart)}), {radius}) = seg + 1 and array_min(array({', '.join(apart)})) = {radius}"
        found = (probes.join(index, ["seg", "value"]).filter(turn).filter("bit_count(query ^ code) <= most")
                 .select("query", "code", "ids", F.expr("cast(bit_count(query ^ code) as int)").alias("distance")))
        # k + 1 least ids that differ are enough: one of them may be the query's own, in any number of codes
        best = best.unionByName(found).withColumn("least", F.col("ids")[0]["id"])
        once = Window.partitionBy("query", "least").orderBy("distance", "code")
        w = Window.partitionBy("query").orderBy("distance", "least", "code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        best = (best.withColumn("new", (F.row_number().over(once) == 1).cast("int")).withColumn("n", F.sum("new").over(w))
                .filter(F.col("n") <= k + 1).drop("n", "new", "least"))
        best = written(best, "best")
        covered = len(bounds) * (radius + 1) - 1
        # ids within a distance: when k + 1 differ, k are not the query's own
        others = best.select("query", "distance", F.explode("ids.id").alias("id")).groupBy("query", "id").agg(F.min("distance").alias("distance"))
        sure = (others.filter(F.col("distance") <= covered).groupBy("query").agg(F.count("*").alias("have"))
                .filter(F.col("have") > k).select("query"))
        if radius < max(b for _, b in bounds):
            ended.append(written(best.join(sure, "query", "left_semi"), "ended"))
            best = written(best.join(sure, "query", "left_anti"), "open")
            rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
            most = others.withColumn("n", rank).filter(F.col("n") == k + 1).select("query", F.col("distance").alias("kth"))
            active = written(active.join(sure, "query", "left_anti").join(most, "query", "left")
                             .select("query", F.coalesce("kth", "most").alias("most")), "active")
            if active.isEmpty():
                break
    for more in ended:
        best = best.unionByName(more)
    pairs = (asked.withColumnRenamed("code", "query").join(best, "query")
             .select(F.col("id").alias("query_id"), "distance", F.explode("ids").alias("other"))
             .filter("query_id <> other.id")
             .select("query_id", "distance", F.explode(F.expr("array_repeat(other.id, other.times)")).alias("neighbour_id")))
    w = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return (pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("long"), "neighbour_id", F.col("distance").cast("long")))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return result(lambda: top_k(vectors, vectors.filter(F.col("vec_id") % EVERY == 0)), "op4")
