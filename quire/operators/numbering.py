"""Global numbering and joins on uneven keys.

``row_numbers`` numbers rows in a total order without a task that sees all of them: rows are dealt
into ranges, sorted and numbered within each range, and every range's offset is the prefix sum of the
ranges before it; the driver sees one count a range.

``heavy_light_join`` joins a table with one that has each key at most once. Keys that hold more than a
``parts``-th of all rows are measured first; there are fewer than ``parts`` of them, so the other
side's rows for them are broadcast and heavy rows stay where they are. The rest is hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import scratch_path

#: A key with more than this part of all rows is heavy.
HEAVY_PARTS = 200
#: Low bits of ``monotonically_increasing_id``: the row's place in its partition.
_PLACE_BITS = 33


def row_numbers(df: DataFrame, order: list[str | Column], out_col: str = "row_number") -> DataFrame:
    """``df`` with each row's number from 1 in the order of ``order``; rows that tie are numbered in any order.

    The sorted ranges are written once to the shared folder, so that counts and numbers are of the same
    ranges even if an executor is lost in between.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "row-numbers")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.parquet(path).withColumn("_range", F.shiftright("_id", _PLACE_BITS))
    counts = sorted((r["_range"], r["count"]) for r in kept.groupBy("_range").count().collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    table = spark.createDataFrame(offsets, "_range long, _offset long")
    place = F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)
    # one row a range
    return (kept.join(F.broadcast(table), "_range").withColumn(out_col, F.col("_offset") + place + 1)
            .select(*df.columns, out_col))


def heavy_keys(df: DataFrame, key: str, parts: int = HEAVY_PARTS) -> list:
    """The keys that hold more than a ``parts``-th of the rows: fewer than ``parts``."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).first().n
    return [r[0] for r in counts.filter((F.col("n") > total / parts) & F.col(key).isNotNull()).collect()]


def heavy_light_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", heavy: list | None = None) -> DataFrame:
    """``left`` joined (``left`` or ``inner``) with ``right``, which has each key at most once. A null key meets nothing."""
    heavy = heavy_keys(left, key) if heavy is None else heavy
    if not heavy:
        return left.join(right, key, how)
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    few = F.broadcast(right.filter(F.col(key).isin(heavy)))  # at most one row for each heavy key
    return left.filter(is_heavy).join(few, key, how).unionByName(
        left.filter(~is_heavy).join(right.filter(~is_heavy), key, how))


#: Repeated ids are broadcast up to so many.
MAX_REPEATED = 1_000_000


def split_repeated(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``df`` whose id no other row has, which can be worked on in place, and the others
    (None if there are none). Null counts as an id. Runs one job over the ids alone."""
    spark = df.sparkSession
    path = scratch_path(spark, "repeated-ids")
    ids = df.select(F.col(id_col).alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_id")
    ids.write.parquet(path)
    ids = spark.read.schema(ids.schema).parquet(path)
    n = ids.count()
    if not n:
        return df, None
    side = F.broadcast(ids) if n <= MAX_REPEATED else ids
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")
