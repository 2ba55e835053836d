"""What the operators of this subpackage share: tables, keys, and written intermediates."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable
from contextlib import contextmanager
from threading import get_ident

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import read_table, scratch_path

#: Words are runs of characters other than 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


#: For each thread that makes a result, the paths of the tables written on the way. A plain dict, as this
#: module travels with the functions of tasks.
_TABLES: dict[int, list[str]] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is computed once, its lineage ends there, and
    a lost executor takes nothing of it along. Its shuffle files go when it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if get_ident() in _TABLES:
        _TABLES[get_ident()].append(path)
    with settings(spark):
        df.select("*").write.parquet(path)  # a query of its own: it takes the settings when made
    return spark.read.schema(df.schema).parquet(path)


def result(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, as a written table; every table written on the way to it is removed."""
    outer, tables = _TABLES.get(get_ident()), []
    _TABLES[get_ident()] = tables
    try:
        out = written(make(), name)
    finally:
        if outer is None:
            del _TABLES[get_ident()]
        else:
            _TABLES[get_ident()] = outer
    for path in tables[:-1]:
        remove(out.sparkSession, path)
    if outer is not None:
        outer.append(tables[-1])
    return out


def remove(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame) -> None:
    """Removes the files of a ``written`` table that nothing will read again. What was made of it
    must have been written, too: a lost executor's part could not be computed anew."""
    spark = table.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        remove(spark, file)


#: For queries that write a table: their shuffle files go when they end, not when the driver next
#: happens to collect garbage; Python gets whole texts in small batches (large buffers stay with
#: the JVM's allocator, for each thread that ever had one); and nothing is broadcast but where a
#: size is proven and the code says so, so that plans are the same at every size.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: The module, known to a Python worker only, that holds what operators keep from task to task.
WORKER_MEMORY = "quire_worker_memory"


def forget() -> None:
    """Gives back what other operators have kept in this Python worker, as it has turned to new work."""
    if sys.modules.pop(WORKER_MEMORY, None) is not None:
        gc.collect()  # states of a transducer refer to each other


def slices(batches, rows: int = 256):
    """Record batches of at most so many rows."""
    for batch in batches:
        for i in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(i, rows)


def text_key(text: str | Column = "text") -> Column:
    """Tells rows of one document id with different texts apart."""
    return F.hash(F.col(text) if isinstance(text, str) else text)
