"""Parquet table access and input parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.session import read_table

__all__ = ["read_table", "spread", "documents"]


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Make sure CPU-heavy row-local work has enough tasks.

    A large input already scans as many partitions and is returned unchanged
    (no shuffle). A coarse input (e.g. one small parquet file with a single
    row group) is hash-repartitioned on ``key`` -- deterministic on retry, and
    the resulting partitioning on the id satisfies later per-id aggregations.
    """
    spark = df.sparkSession
    # two tasks per core smooth out documents of very different lengths
    target = min_partitions or 2 * spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text", "lang", "source")
              ) -> DataFrame:
    """The corpus table, pruned to ``columns`` and spread for text work."""
    return spread(read_table(spark, sf_dir, "documents").select(*columns), "doc_id")
