"""Forests, co-occurrence vectors, learned sentence ends, suffix rules, numbering, worker resources."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from quire.operators import cooccurrence, corpus, forest, numbering, resource, sentence_model, suffix_rules, vectors
from quire.plans import learned_queries
from test_registry import TABLES, norm_rows


@pytest.mark.parametrize("key", [k for k in learned_queries.LEARNED_QUERIES if k != "pmi_vectors"])
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in [*TABLES, "lineitem"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    df, rel = E.queries()[key](spark, SF001), con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert norm_rows(df.collect(), df.columns) == norm_rows(rel.fetchall(), rel.columns)


# ---- forest -------------------------------------------------------------------

def _blobs(spark, n=400):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        k = int(rng.integers(3))
        x = rng.normal(size=6) + 4 * np.eye(6)[k]
        rows.append((i, [float(v) for v in x], "abc"[k], 1.0))
    return spark.createDataFrame(rows, "id long, x array<double>, y string, bins double")


def test_forest_learns_and_does_not_depend_on_partitions(spark):
    df = _blobs(spark)
    train, test = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    a = forest.forest_fit(train.repartition(1), "id", "x", "y", trees=6, depth=6, bins=8)
    b = forest.forest_fit(train.repartition(7), "id", "x", "y", trees=6, depth=6, bins=8)
    assert [(t.node, t.feature, t.bin) for t in a.trees] == [(t.node, t.feature, t.bin) for t in b.trees]
    out = forest.forest_predict(test, a, "x", ["id", "y"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert np.mean([r.y == r.predicted for r in rows]) > 0.9 and all(0 < r.share <= 1 for r in rows)
    # as good as the library's own estimator on the same rows
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    vec = lambda d: d.select(array_to_vector("x").alias("features"), F.expr("instr('abc', y) - 1.0").cast("double").alias("label"))
    ml = RandomForestClassifier(numTrees=6, maxDepth=6, maxBins=8, seed=1).fit(vec(train)).transform(vec(test))
    assert np.mean([r.y == r.predicted for r in rows]) > ml.select(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0] - 0.08


def test_forest_edge_cases(spark):
    rows = [(1, [0.0, 1.0], "a"), (2, [0.0, None], None), (3, None, "b"), (4, [float("nan"), 5.0], "a"), (5, [0.0, 9.0], None)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y string")
    model = forest.forest_fit(df, "id", "x", "y", trees=4, depth=3, bins=4)
    assert set(model.labels) == {"a", ""}
    out = forest.forest_predict(df, model, "x", ["id"]).collect()
    assert len(out) == 5 and all(r.predicted in ("a", "") for r in out)
    assert forest.forest_predict(df.limit(0), model, "x", ["id"]).collect() == []
    with pytest.raises(ValueError):
        forest.forest_fit(df.limit(0), "id", "x", "y")


def test_bootstrap_counts_are_poisson(spark):
    df = spark.range(4000).select(forest.bootstrap_weights(F.col("id"), 3, 7).alias("w")).collect()
    w = np.array([r.w for r in df])
    assert abs(w.mean() - 1) < 0.05 and abs((w == 0).mean() - np.exp(-1)) < 0.02 and abs(w.var() - 1) < 0.1


# ---- word vectors -------------------------------------------------------------

def test_pmi_vectors_reproduce_the_leading_eigenvalues(spark):
    docs = corpus.tokens(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text"))
    words = vectors.vocabulary(docs.select(F.explode_outer("tokens").alias("word")).filter("word is not null"))
    counts = cooccurrence.cooccurrence(cooccurrence.known_tokens(docs, "doc_id", words), window=5).cache()
    values, vec = cooccurrence.pmi_vectors(counts, 12, iterations=20)
    rows = cooccurrence.pmi(counts).filter("pmi > 0").collect()
    names = sorted({r.word for r in rows})
    at = {w: i for i, w in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for r in rows:
        m[at[r.word], at[r.context]] = r.pmi
    assert (m == m.T).all() or np.allclose(m, m.T)
    true = np.linalg.eigvalsh(m)
    true = true[np.argsort(-np.abs(true))]
    assert np.allclose(values[:4], true[:4], rtol=1e-3) and np.allclose(np.abs(values[:8]), np.abs(true[:8]), rtol=0.05)
    got = {r.word: r.vector for r in vec.collect()}
    assert sorted(got) == names and all(len(v) == 12 for v in got.values())
    lead = np.array([got[w][0] for w in names])
    assert np.allclose(m @ lead, values[0] * lead, atol=1e-2 * np.abs(values[0] * lead).max())
    counts.unpersist()


def test_cooccurrence_by_hand(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, []), (3, ["a"])], "id long, tokens array<string>")
    got = {(r.word, r.context): r.n for r in cooccurrence.cooccurrence(df, window=2).collect()}
    assert got == {("a", "b"): 2, ("b", "a"): 2, ("a", "a"): 2, ("b", "c"): 1, ("c", "b"): 1, ("a", "c"): 1, ("c", "a"): 1}


# ---- sentences ----------------------------------------------------------------

def _letters(spark):
    """Documents in which Mr., No. 5, initials, decimals and e.g. occur often enough to be learned."""
    rows = []
    for i in range(120):
        rows.append((i, f"Yesterday Mr. Smith paid {i}.5 euro for it. The bond No. {i} was issued by J. Jones, e.g. in London. "
                        f"However Mr. Brown said no! The rest was sold by the bank of the city. Was it? The city of London has the note. The end of the note."))
    return spark.createDataFrame(rows + [(900, None), (901, ""), (902, "  \n "), (903, "Alone"), (904, "Sure. no break here. \"Quoted end.\" The next.")],
                                 "id long, text string")


def test_learned_sentence_ends(spark):
    df = _letters(spark)
    model = sentence_model.learn(df)
    assert {"mr", "e.g"} <= {r.kind for r in model.abbreviations.collect()}
    assert "the" in {r.kind for r in model.starters.collect()} and "no" in {r.kind for r in model.before_number.collect()}
    rows = sentence_model.split_sentences(df, model, "id").collect()
    assert [r.sentence for r in sorted((r for r in rows if r.id == 7), key=lambda r: r.sent_no)] == [
        "Yesterday Mr. Smith paid 7.5 euro for it.", "The bond No. 7 was issued by J. Jones, e.g. in London.", "However Mr. Brown said no!",
        "The rest was sold by the bank of the city.", "Was it?", "The city of London has the note.", "The end of the note."]
    assert [r.sentence for r in sorted((r for r in rows if r.id == 904), key=lambda r: r.sent_no)] == [
        "Sure. no break here.", '"Quoted end."', "The next."]
    assert sorted((r.id, r.sentence) for r in rows if 900 <= r.id < 904) == [(901, "."), (902, "."), (903, "Alone")]
    joined = sentence_model.split_sentences(df, model, "id", max_listed=1).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, joined))


def test_sentence_model_of_nothing(spark):
    df = _letters(spark).limit(0)
    model = sentence_model.learn(df)
    assert model.abbreviations.count() == model.starters.count() == model.before_number.count() == 0
    assert sentence_model.split_sentences(df, model, "id").collect() == []


# ---- suffix rules -------------------------------------------------------------

def test_suffix_rules_on_held_out_forms(spark):
    pairs = learned_queries._dictionary(spark, SF001).cache()
    rules = suffix_rules.induce(pairs.filter("crc32(form) % 5 > 0"))
    held = pairs.filter("crc32(form) % 5 = 0")
    made = suffix_rules.lemmas_of_forms(held.select("form"), rules).withColumnRenamed("lemma", "made")
    right = held.join(made, "form").select(F.avg((F.col("lemma") == F.col("made")).cast("int")), F.count("*")).first()
    assert right[1] > 500 and right[0] > 0.98
    pairs.unpersist()


def test_suffix_rules_by_hand(spark):
    words = ["walk", "talk", "jump", "look", "cook", "book"]
    pairs = [(w + "ing", w) for w in words] + [(w + "s", w) for w in words] + [("berries", "berry"), ("glass", "glass"), (None, "x"), ("", "y"), ("boss", "boss")]
    pairs += [(f"{w}ies", f"{w}y") for w in ("cherr", "bab", "cit", "lad", "part")]
    rules = suffix_rules.induce(spark.createDataFrame(pairs, "form string, lemma string"))
    got = suffix_rules.lemmas_of_forms(spark.createDataFrame([("hooking",), ("hooks",), ("stories",), ("xyz",), ("s",)], "form string"), rules)
    assert {r.form: r.lemma for r in got.collect()} == {"hooking": "hook", "hooks": "hook", "stories": "story", "xyz": "xyz", "s": "s"}
    docs = spark.createDataFrame([(1, "Hooking the cities, xyz cities"), (2, None), (3, "")], "id long, text string")
    out = {r.id: r.LEMMAS for r in suffix_rules.lemmatize(docs, "id", rules).collect()}
    assert out == {1: ["hook", "the", "city", "xyz", "city"], 2: [], 3: []}
    assert suffix_rules.induce(spark.createDataFrame([], "form string, lemma string")).count() == 0


# ---- numbering, heavy keys, resources -----------------------------------------

def test_row_numbers_without_a_single_partition(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("a"), F.lit(None).cast("string").alias("b"))
    out = numbering.row_numbers(df, ["a"])
    assert "SinglePartition" not in out._jdf.queryExecution().toString()
    rows = out.collect()
    assert sorted(r.row_number for r in rows) == list(range(1, 1001))
    assert [r.a for r in sorted(rows, key=lambda r: r.row_number)] == sorted(r.a for r in rows)
    assert numbering.row_numbers(df.limit(0), ["a"]).collect() == []


def test_heavy_light_join_leaves_heavy_rows_in_place(spark):
    left = spark.range(0, 9000, 1, 8).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 400)).alias("key"), "id")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3), ("zz", 4)], "key string, v int")
    assert numbering.heavy_keys(left, "key", 10) == ["hot"]
    for how in ("left", "inner"):
        a = numbering.heavy_light_join(left, right, "key", how, heavy=["hot"])
        b = left.join(right, "key", how)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    # no shuffled partition holds the hot key
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        light = left.filter("coalesce(key <> 'hot', true)").repartition(8, "key").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in light if r["count"]) <= 3000 + 3000
        plan = numbering.heavy_light_join(left, right, "key", "inner", heavy=["hot"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_resource_is_made_once_in_each_worker(spark, tmpdir_path):
    made = tmpdir_path

    def factory():
        import os
        import uuid

        open(os.path.join(made, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return {"n": 0}

    def apply(state, values):
        state["n"] += 1
        return [None if v is None else v + state["n"] * 0 for v in values]

    df = spark.range(0, 2000, 1, 16).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("a"), F.lit("x").alias("b"), F.col("id"))
    out = resource.with_resource(df, factory, apply, "a", "c", "long", batch_rows=10)
    rows = out.collect()
    assert out.columns == ["a", "b", "id", "c"] and len(rows) == 2000 and all(r.a == r.c for r in rows)
    assert [r.id for r in rows] == list(range(2000))
    out.collect()  # the workers keep it for the next job
    import os

    pids = [f.split("-")[0] for f in os.listdir(made)]
    assert len(pids) == len(set(pids)) and 0 < len(pids) <= 16
    with pytest.raises(Exception, match="values for"):
        resource.with_resource(df, dict, lambda s, v: [], "a", "c", "long").collect()

