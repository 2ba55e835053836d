import math

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quire.operators import evaluate
from quire.plans import tfidf_nb
from quire.sources.tables import read_table

from conftest import SF001

V = 64


def test_relational_nb_matches_mllib(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text", "lang")
    flow = tfidf_nb.build(docs, "lang", num_features=V)
    # the same TF rows as dense vectors for MLlib
    index = flow.index.select("label", F.col("idx").alias("label_idx"))
    tf_train = flow.tf.filter("is_train").join(index, "label")
    dense = (tf_train.groupBy("doc_id", "label_idx")
             .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "tf"))).alias("m"))
             .select("doc_id", F.col("label_idx").alias("label"),
                     array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(V - 1)),
                                                 lambda i: F.coalesce(F.col("m")[i], F.lit(0)).cast("double"))
                                     ).alias("tf")))
    # training docs without any bigram still count as documents
    empty = (flow.docs.filter("is_train").join(index, "label").join(tf_train.select("doc_id").distinct(), "doc_id", "left_anti")
             .select("doc_id", F.col("label_idx").alias("label"),
                     array_to_vector(F.array_repeat(F.lit(0.0), V)).alias("tf")))
    train = dense.unionByName(empty)
    idf = IDF(inputCol="tf", outputCol="features").fit(train)
    nb = NaiveBayes(labelCol="label", featuresCol="features").fit(idf.transform(train))

    pri = {r.label_idx: r.pi for r in flow.priors.collect()}
    labels = sorted(pri)
    for i, lab in enumerate(labels):
        assert math.isclose(pri[lab], nb.pi[i], rel_tol=1e-9, abs_tol=1e-12)
    theta0 = {r.label_idx: r.theta0 for r in flow.priors.collect()}
    seen = {(r.label_idx, r.bucket): r.theta for r in flow.theta.collect()}
    theta = nb.theta.toArray()
    for i, lab in enumerate(labels):
        for b in range(V):
            ours = seen.get((lab, b), theta0[lab])
            assert math.isclose(ours, theta[i][b], rel_tol=1e-9, abs_tol=1e-12)

    # predictions on the held-out docs agree with MLlib's model
    ours = {r.doc_id: r.prediction for r in flow.predictions.collect()}
    tf_test = flow.tf.filter("not is_train")
    dense_t = (tf_test.groupBy("doc_id")
               .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "tf"))).alias("m"))
               .select("doc_id", array_to_vector(F.transform(
                   F.sequence(F.lit(0), F.lit(V - 1)),
                   lambda i: F.coalesce(F.col("m")[i], F.lit(0)).cast("double"))).alias("tf")))
    theirs = {r.doc_id: labels[int(r.prediction)]
              for r in nb.transform(idf.transform(dense_t)).collect()}
    assert theirs
    for d, p in theirs.items():
        assert ours[d] == p
    assert len(flow.kept) == 3
    flow.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_f1_fixture(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    m = evaluate.summary_metrics(evaluate.confusion_matrix(pred)).first()
    assert math.isclose(m.weighted_f1, 0.52)
    assert math.isclose(m.accuracy, 0.6)
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert math.isclose(ev.evaluate(pred), m.weighted_f1)


def test_flow_invariants(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text", "lang")
    flow = tfidf_nb.build(docs, "lang")
    pred = flow.predictions
    n_test = flow.docs.filter("not is_train").count()
    assert pred.count() == n_test
    labels = {r.label for r in flow.index.collect()}
    assert {r.predicted for r in pred.collect()} <= labels
    assert math.isclose(sum(math.exp(r.pi) for r in flow.priors.collect()), 1.0)


def jobs_run(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_building_the_flow_runs_no_job(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text", "lang")
    spark.sparkContext.setJobGroup("build", "")
    flow = tfidf_nb.build(docs, "lang")
    try:
        assert jobs_run(spark, "build") == 0
        assert flow.predictions.count() and jobs_run(spark, "build") > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        flow.release()


def test_no_shuffle_carries_text(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text", "lang")
    pred = tfidf_nb.build(docs, "lang", keep=None).predictions
    pred.collect()
    plan = pred._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "text" not in line
    # what is above an exchange never reads text from below it
    logical = pred._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in logical


def test_scores_of_many_classes_make_no_row_per_class(spark):
    rows = [(d, f"bond issuer{d % 1000} note{d % 7}x coupon", f"class{d % 1000}") for d in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    flow = tfidf_nb.build(docs, "lang", num_features=256, evaluate_split=False, keep=None)
    n_classes = flow.priors.count()
    assert n_classes == 1000
    assert flow.predictions.count() == 3000
    from quire.operators import bayes
    model = bayes.nb_model(flow.theta.withColumnRenamed("label_idx", "c"), flow.priors.withColumnRenamed("label_idx", "c"), "c")
    assert model.count() <= 256 and model.select(F.max(F.size("gain"))).first()[0] == 1000
    plan = flow.predictions._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == plan.count("explode(ngrams") or "explode(sequence" not in plan


def test_missing_labels_are_a_class_of_their_own(spark):
    rows = [(d, "bond coupon note issuer", None if d % 3 else "a") for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    flow = tfidf_nb.build(docs, "lang", num_features=64, evaluate_split=False, keep=None)
    assert {r.label for r in flow.index.collect()} == {"", "a"}
    assert {r.predicted for r in flow.predictions.collect()} == {""}
    from quire.operators import labels
    assert labels.drop_empty_label(docs, "lang").count() == 10


def test_split_is_the_same_for_any_partitions(spark):
    from quire.plans import ml
    docs = read_table(spark, SF001, "documents").select("doc_id")
    got = [{r.doc_id for r in ml.split(docs.repartition(n), "doc_id")[1].collect()} for n in (8, 16)]
    assert got[0] == got[1] and 40 < len(got[0]) < 80
    train, test = ml.split(docs, "doc_id", evaluate=False)
    assert train.count() == 200 and test.count() == 0
