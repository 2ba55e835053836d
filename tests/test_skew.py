"""A hot key holding a third of all rows: results stay whole and exact, and the
plans aggregate map-side before they shuffle."""

from collections import Counter

from pyspark.sql import functions as F

from quire.functions.features import stable_bucket
from quire.operators import labels, tfidf


def test_hot_document_tf_exact_and_partial(spark):
    words = [f"w{i % 50}" for i in range(3000)]
    hot = " ".join(words)                                   # one doc: 1/3 of all terms
    rows = [(0, hot)] + [(i, " ".join(words[(i * 6) % 3000:(i * 6) % 3000 + 6])) for i in range(1, 1001)]
    df = (spark.createDataFrame(rows, "doc_id long, text string")
          .select("doc_id", F.split("text", " ").alias("ngrams")))
    tf = tfidf.hashed_tf(df, "doc_id", num_features=97)
    got = {(r.doc_id, r.bucket): r.tf for r in tf.collect()}
    # brute force with the same bucket function
    bucket = {w: b for w, b in spark.createDataFrame([(w,) for w in set(words)], "t string")
              .select("t", stable_bucket("t", 97).alias("b")).collect()}
    want = Counter()
    for doc_id, text in rows:
        for w in text.split(" "):
            want[(doc_id, bucket[w])] += 1
    assert got == dict(want)
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_hot_key_last_wins_and_sets(spark):
    rows = [(1, i, f"p{i % 3}") for i in range(3000)] + [(k, 0, "q") for k in range(2, 3002)]
    df = spark.createDataFrame(rows, "k long, pos long, v string")
    last = {r.k: r.v for r in labels.last_per_key(df, "k", "pos", ["v"]).collect()}
    assert last[1] == "p2" and len(last) == 3001
    plan = labels.last_per_key(df, "k", "pos", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
