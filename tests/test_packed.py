"""Packed documents: one sparse row each, no shuffle of terms."""

from pyspark.sql import functions as F

from quire.functions.features import run_lengths, runs
from quire.operators import bayes, tfidf
from quire.plans import tfidf_nb
from quire.sources.tables import documents

from conftest import SF001


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_runs_of_sorted_arrays(spark):
    rows = [([],), ([3],), ([1, 1, 1],), ([1, 2, 2, 5, 5, 5, 9],)]
    df = spark.createDataFrame(rows, "v array<int>")
    values, starts = runs("v")
    got = [(r.v, r.d, r.n) for r in df.select("v", values.alias("d"), starts.alias("s"))
           .select("v", "d", run_lengths("s", F.size("v")).alias("n")).collect()]
    for v, d, n in got:
        assert d == sorted(set(v)) and n == [v.count(x) for x in d]


def test_packed_counts_are_the_grouped_ones(spark):
    rows = ([(0, ["a b"] * 20000 + ["c d"]), (1, []), (2, None), (3, ["x", None, "x", "", "é"])]
            + [(d, [f"t{d % 3}", "a b"]) for d in range(4, 60)])
    df = spark.createDataFrame(rows, "doc_id long, ngrams array<string>")
    want = {(r.doc_id, r.bucket): r.tf for r in tfidf.hashed_tf(df, "doc_id", num_features=97).collect()}
    packed = tfidf.packed_tf(df, "doc_id", num_features=97)
    back = tfidf.unpacked_tf(packed, "doc_id")
    got = {(r.doc_id, r.bucket): r.tf for r in back.collect()}
    assert got == want and back.count() == len(want)
    assert dict(back.dtypes) == dict(tfidf.hashed_tf(df, "doc_id").dtypes)
    by_id = {r.doc_id: r for r in packed.collect()}
    assert by_id[1].buckets == [] and by_id[2].counts == [] and sum(by_id[0].counts) == 20001
    assert tfidf.packed_tf(df.limit(0), "doc_id").count() == 0


def test_packing_needs_no_exchange(spark):
    docs = documents(spark, SF001, ("doc_id", "text"))
    packed = tfidf.packed_tf(tfidf_nb.bigram_features(docs, "doc_id", "text"), "doc_id")
    plan = executed(tfidf.unpacked_tf(packed, "doc_id"))
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM")


def test_no_term_of_a_document_is_shuffled(spark):
    docs = documents(spark, SF001, ("doc_id", "text", "lang"))
    flow = tfidf_nb.build(docs, "lang", keep=None)
    plan = executed(flow.predictions)
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert dealt and not any("doc_id" in line and "bucket" in line for line in dealt)


def test_training_texts_are_read_once(spark):
    docs = documents(spark, SF001, ("doc_id", "text", "lang"))
    flow = tfidf_nb.build(docs, "lang", keep=None)
    idf = flow.idf.select("bucket", "df")._jdf.queryExecution().optimizedPlan().toString()
    theta = flow.theta._jdf.queryExecution().optimizedPlan().toString()
    strip = lambda p: sum("sum(tf#" in line and "count(1)" in line for line in p.splitlines())
    assert strip(idf) == 1 and strip(theta) >= 1


def test_a_model_too_large_for_tasks_gives_the_same_classes(spark, monkeypatch):
    docs = documents(spark, SF001, ("doc_id", "text", "lang"))
    small = {r.doc_id: r.predicted for r in tfidf_nb.build(docs, "lang", num_features=512, keep=None).predictions.collect()}
    monkeypatch.setattr(bayes, "MAX_MODEL_BYTES", 0)
    assert not bayes.fits_tasks(2, 512)
    large = {r.doc_id: r.predicted for r in tfidf_nb.build(docs, "lang", num_features=512, keep=None).predictions.collect()}
    assert small == large and len(small) > 40
