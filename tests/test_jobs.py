"""The command-line flows end to end on small files made from the sf0.001 tables."""

import os

import pytest

from pyspark.sql import functions as F

from quire.plans import jobs
from quire.sources.tables import read_table

from conftest import SF001


def _write_csv(df, path):
    df.coalesce(1).write.option("header", True).option("escape", '"').csv(path)


def test_flows_end_to_end(spark, tmpdir_path):
    d = tmpdir_path
    docs = read_table(spark, SF001, "documents").limit(60)
    txt = os.path.join(d, "txt")
    os.makedirs(txt)
    for r in docs.select("doc_id", "text").collect():
        with open(os.path.join(txt, f"doc{r.doc_id}.txt"), "w", encoding="utf-8") as f:
            f.write(r.text)
    ids = docs.select(F.concat(F.lit("XS"), F.col("doc_id").cast("string")).alias("ISIN"),
                      "doc_id", "lang")
    _write_csv(ids.select("ISIN", F.col("lang").alias("ISSUER.NAME"), F.lit("N").alias("ZCP.FL"),
                          F.lit(1.0).alias("MIN.TRAD.AMT"), F.lit(2.0).alias("MLT.TRAD.AMT"),
                          F.lit("EUR").alias("OPS.CURR")), os.path.join(d, "isin"))
    _write_csv(ids.select("ISIN", F.lit("G").alias("GA.NAME")), os.path.join(d, "ga"))
    _write_csv(ids.select("ISIN", F.lit("R1").alias("ROC")), os.path.join(d, "roc"))
    _write_csv(ids.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("docid"), "ISIN"),
               os.path.join(d, "docid"))

    merged = jobs.flatten_input_job(spark, os.path.join(d, "isin"), os.path.join(d, "ga"),
                                    os.path.join(d, "roc"), os.path.join(d, "docid"), [txt],
                                    os.path.join(d, "labels_text"))
    assert merged.count() == 60
    sents = jobs.flatten_all_text_job(spark, [txt], os.path.join(d, "all_text"))
    assert sents.count() > 60
    assert jobs.bad_ocr_job(spark, [txt]).count() == 0

    lem = jobs.lemmatize_job(spark, os.path.join(d, "labels_text"), os.path.join(d, "lemmas"))
    assert "LEMMAS" in lem.columns and lem.count() == 60
    metrics = jobs.tfidf_nb_job(spark, "ISSUER_NAME", os.path.join(d, "lemmas"))
    assert 0.0 <= metrics["f1"] <= 1.0
    jobs.tfidf_nb_job(spark, "ISSUER_NAME", os.path.join(d, "lemmas"), evaluate=False,
                      save_as=os.path.join(d, "model"))
    head = jobs.pipeline_classifier_job(spark, os.path.join(d, "model"), os.path.join(d, "lemmas"),
                                        os.path.join(d, "run"))
    assert len(head) == 5
    sub = jobs.combine_results_job(spark, os.path.join(d, "run"), os.path.join(d, "submission"))
    rows = sub.collect()
    assert len(rows) == 60 and [r.ISIN for r in rows] == sorted(r.ISIN for r in rows)
    (file,) = [f for f in os.listdir(os.path.join(d, "submission")) if f.endswith(".csv")]
    assert len(open(os.path.join(d, "submission", file)).readlines()) == 61

    # word vectors, and a forest on them: train and evaluate, train and save
    jobs.word2vec_job(spark, os.path.join(d, "all_text"), os.path.join(d, "w2v"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        jobs.word2vec_job(spark, os.path.join(d, "all_text"), os.path.join(d, "w2v"))
    metrics = jobs.w2v_rf_job(spark, "ISSUER_NAME", os.path.join(d, "labels_text"), os.path.join(d, "w2v"))
    assert 0.0 <= metrics["accuracy"] <= 1.0
    jobs.w2v_rf_job(spark, "ISSUER_NAME", os.path.join(d, "labels_text"), os.path.join(d, "w2v"), evaluate=False,
                    save_as=os.path.join(d, "forest"))
    assert os.path.isdir(os.path.join(d, "forest"))


def test_stop_word_file(spark, tmpdir_path):
    from quire.functions.stopwords import load_stop_words
    path = os.path.join(tmpdir_path, "stop.txt")
    open(path, "w").write("The\n\n of \nthe\n")
    assert load_stop_words(spark, path) == ("of", "the")


class _Cluster:
    """What ``checkpoint_dir`` asks of a session, with a cluster's master."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_needs_a_shared_folder():
    from quire.session import checkpoint_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Cluster())
