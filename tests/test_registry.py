"""Registered queries against their DuckDB twins on sf0.001, plus ML invariants."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = "customer supplier orders documents embeddings labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


def norm_rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_is_registered_with_a_twin_or_is_ml():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    ml_only = {k for k in set(qs) - set(sql) if not k.startswith("op") and k != "pipeline"}
    assert ml_only == {"pipeline_params", "w2v_vectors", "w2v_doc_vectors", "w2v_rf_predict", "pmi_vectors"}


@pytest.mark.parametrize("key", [
    "clean_text", "ascii_text", "ocr_quality", "sentences", "distinct_sentences", "tokens",
    "lemma_tokens", "lemmatize_dict", "stopwords_removed", "bigrams", "hashed_tf", "idf",
    "tfidf", "label_index", "nb_priors", "nb_theta", "nb_predict", "weighted_f1",
    "merge_labels", "entities_with_text", "last_per_key", "submission", "w2v_vocab",
    "mean_vector", "corpus_stats", "preview_top5", "src_csv_corpus", "sink_parquet",
    "sink_sentences", "sink_predictions", "all_text_sentences", "bad_ocr", "lemmatize_join",
    "sink_labeled_csv", "sink_submission", "src_labeled_corpus", "src_unlabeled_corpus", "src_label_csv",
    "src_text_lines", "src_whole_text", "malformed_rows", "ml_nb_predict", "ml_hashed_tf", "ml_random_split",
    "score_saved_pipeline",
])
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert norm_rows(df.collect(), df.columns) == norm_rows(rel.fetchall(), rel.columns)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["doc_id", "label", "predicted"]
    assert len(rows) > 0


def test_pipeline_params_are_whole(spark):
    rows = E.queries()["pipeline_params"](spark, SF001).collect()
    assert max(len(r.value) for r in rows if r.param == "stopWords") > 5000
    assert {"de", "en", "es", "fr"} <= set(next(r.value for r in rows if r.stage_class == "IndexToString" and r.param == "labels").strip("[]").replace("'", "").split(", "))


def test_w2v_rf(spark):
    v = E.queries()["w2v_vectors"](spark, SF001).collect()
    assert v and all(len(r.vector) == 300 for r in v)
    out = E.queries()["w2v_rf_check"](spark, SF001).collect()
    assert out and all(r.known_class and r.sums_to_one for r in out)
    dv = E.queries()["w2v_doc_vectors"](spark, SF001).collect()
    assert len(dv) == 200 and all(math.isfinite(x) for x in dv[0].vector)
