"""Plan shape: column pruning and filter pushdown reach the parquet scans;
no nested-loop or cartesian joins."""

import __spark_entry__ as E
from conftest import SF001


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = plan_of(E.queries()["tokens"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_merge_starts_from_the_entities_with_text(spark):
    p = plan_of(E.queries()["merge_labels"](spark, SF001))
    assert "FullOuter" not in p and "RightOuter" not in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in p


def test_dictionary_lemmatizer_is_row_local(spark):
    df = E.queries()["lemmatize_dict"](spark, SF001)
    p = plan_of(df)
    assert p.count("Exchange") == p.count("REPARTITION_BY_NUM")


def test_mean_vector_tokenizes_once(spark):
    from quire.operators import corpus, vectors
    from quire.sources.tables import documents
    counts = vectors.word_counts(corpus.tokens(documents(spark, SF001, ("doc_id", "text"))), "doc_id")
    assert plan_of(counts).count("regexp_replace") == 1


def test_no_cross_joins(spark):
    for key in ("nb_predict", "merge_labels", "mean_vector", "tfidf", "lemmatize_dict"):
        df = E.queries()[key](spark, SF001)
        df.collect()
        p = plan_of(df)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, key


def test_naive_bayes_counts_buckets_once(spark, monkeypatch):
    from quire.plans import ml, ml_queries

    seen = []

    class Watched(ml.Pipeline):
        def fit(self, dataset, params=None):
            seen.append((dataset.columns, dataset.storageLevel.useDisk))
            return super().fit(dataset, params)

    train, _ = ml.split(ml_queries._lemma_docs(spark, SF001), "doc_id")
    indexer = ml.fit_label_indexer(ml_queries._lemma_docs(spark, SF001), "lang")
    plain = ml.nb_pipeline(indexer, hashing="md5").fit(train)
    monkeypatch.setattr(ml, "Pipeline", Watched)
    model = ml.fit_nb(train.select("LEMMAS", "lang"), indexer, hashing="md5")
    assert seen == [(["label", "tf"], True)]
    assert [type(s) for s in model.stages] == [type(s) for s in plain.stages]
    rows = [m.transform(train).select("doc_id", "predictedCategory").collect() for m in (model, plain)]
    assert sorted(rows[0]) == sorted(rows[1])
