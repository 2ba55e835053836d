"""Queries on executors that cannot import this library, and what queries leave behind."""

import inspect
import os
import subprocess
import sys
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quire.llm import queries, repeats, surrogates
from quire.llm.common import result, written

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import os, sys, tempfile
os.chdir(tempfile.mkdtemp())  # workers start here
sys.path.insert(0, {root!r})
from quire.session import get_spark
spark = get_spark("local[4]", shuffle_partitions=8, extra={{"spark.checkpoint.dir": tempfile.mkdtemp()}})
def missing(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("quire") is None] * b.num_rows)], ["x"])
assert all(r.x for r in spark.range(8).mapInArrow(missing, "x boolean").collect())
import __spark_entry__ as E
for name in {names!r}:
    n = E.queries()[name](spark, {sf!r}).count()
    print(name, n)
    assert n
"""


def test_queries_run_where_workers_lack_the_library():
    names = [n for n in queries.QUERIES if n != "op7_pii_surrogates"]  # op3 and op7 have no Python code
    code = SCRIPT.format(root=ROOT, names=names, sf=SF001)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    tokenizers = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and os.path.realpath(p) != ROOT]
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900,
                         env=env | ({"PYTHONPATH": ":".join(tokenizers)} if tokenizers else {}), cwd=tempfile.gettempdir())
    assert out.returncode == 0, out.stderr[-3000:]


def test_two_names_of_a_text_are_independent(spark):
    """Hashes of 32 bits that fold as those of 64 do: texts that collide in one must differ in the other."""
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("t"))
    rows = rows.select(F.hash("t").alias("h1"), F.hash("t", F.lit(1)).alias("last"), F.hash(F.lit(1), "t").alias("first"))
    pairs = rows.groupBy("h1").agg(F.count("*").alias("n"), F.countDistinct("last").alias("last"), F.countDistinct("first").alias("first")).filter("n > 1").collect()
    assert pairs and all(r.last == 1 for r in pairs) and all(r["first"] == r.n for r in pairs)
    for module in (repeats, surrogates):  # and so the second names are made
        assert 'xxhash64("text", F.lit' not in inspect.getsource(module)


def test_result_removes_what_was_written_on_the_way(spark):
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))

    def make():
        a = written(spark.range(10), "a")
        b = result(lambda: written(a.filter("id > 3"), "b").select("id"), "c")
        return b.filter("id > 5")

    out = result(make, "d")
    left = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before
    assert [n.split("-")[0] for n in left] == ["d"] and sorted(r.id for r in out.collect()) == [6, 7, 8, 9]
    for name in ("op4_topk_search", "op10_near_dedup", "op8_mixing", "op13_spelling_variants"):
        before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
        queries.QUERIES[name](spark, SF001).count()
        left = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before
        assert len(left) == 1, left


@pytest.mark.parametrize("piece", ["a.", "4111 ", "A1B2 ", "x@a.", "Dr. ", "+1 ", "é@"])
def test_hostile_texts_do_not_end_the_job(spark, piece):
    text = piece * (1_000_000 // len(piece))
    docs = spark.createDataFrame([(1, "x@" + text), (2, text)], "doc_id long, text string")
    rows = surrogates.replaced(docs).collect()
    assert len(rows) == 2 and all(r.text is not None for r in rows)


def test_blocks_that_python_returns_are_small():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 100, 60_000, dtype=np.uint8).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([0, 0], pa.int32()), pa.array([text, text]),
                                        pa.array([[0], [0]], pa.list_(pa.int32())), pa.array([[59_951]] * 2, pa.list_(pa.int32()))], ["d", "k", "b", "at", "count"])
    sizes = [b.num_rows for b in repeats._pieces(repeats.Spec(False, 50, (40, 50)), 1)(iter([batch]))]
    assert sum(sizes) > 100_000 and max(sizes) <= repeats.OUT_ROWS


def test_workers_forget_when_they_turn_to_other_work():
    import types

    from quire.llm import bpe, common

    made = []
    for _ in range(2):
        bpe.kept_by_worker(("x",), lambda: made.append(1))
    assert made == [1] and isinstance(sys.modules[common.WORKER_MEMORY], types.ModuleType)
    list(repeats.rows_of(iter([])))
    assert common.WORKER_MEMORY not in sys.modules
