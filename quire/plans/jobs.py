"""The original command-line jobs as functions over paths.

Each job is a short composition of the library's sources, operators, MLlib
pipelines and sinks; all data work stays in Spark. Paths may be on any file
system Spark can read; intermediate models go where the caller says.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import corpus, labels
from quire.plans import ml
from quire.sinks import files as sinks
from quire.sources import files as sources

ISSUER_SCHEMA = ("ISIN string, `ISSUER.NAME` string, `ZCP.FL` string, `MIN.TRAD.AMT` double, "
                 "`MLT.TRAD.AMT` double, `OPS.CURR` string")
GUARANTOR_SCHEMA = "ISIN string, `GA.NAME` string"
ROC_SCHEMA = "ISIN string, ROC string"
DOCID_SCHEMA = "docid string, ISIN string"


def flatten_input_job(spark: SparkSession, issuers_csv, guarantors_csv, roc_csv, docid_csv,
                      txt_dirs, out_csv: str) -> DataFrame:
    """Label files + text files -> one labelled corpus CSV."""
    iss = sources.read_label_file(spark, issuers_csv, ISSUER_SCHEMA)
    issuers = iss.select(F.col("ISIN").alias("isin"), F.col("`ISSUER.NAME`").alias("issuer_name"),
                         F.col("`ZCP.FL`").alias("zcp_fl"), F.col("`MIN.TRAD.AMT`").alias("min_trad_amt"),
                         F.col("`MLT.TRAD.AMT`").alias("mlt_trad_amt"), F.col("`OPS.CURR`").alias("ops_curr"),
                         "position")
    ga = sources.read_label_file(spark, guarantors_csv, GUARANTOR_SCHEMA).select(
        F.col("ISIN").alias("isin"), F.col("`GA.NAME`").alias("ga_name"), "position")
    roc = sources.read_label_file(spark, roc_csv, ROC_SCHEMA).select(
        F.col("ISIN").alias("isin"), F.col("ROC").alias("roc"))
    dm = sources.read_label_file(spark, docid_csv, DOCID_SCHEMA).select(
        "docid", F.col("ISIN").alias("isin"))
    texts = sources.read_whole_texts(spark, txt_dirs)
    merged = labels.merge_labels(issuers, ga, roc, dm, texts)
    sinks.write_labeled_csv(merged, out_csv)
    return merged


def flatten_all_text_job(spark: SparkSession, txt_dirs, out_path: str,
                         distinct: bool = True) -> DataFrame:
    """All text files -> one sentence per line (optionally de-duplicated)."""
    texts = sources.read_whole_texts(spark, txt_dirs)
    sents = corpus.sentences(texts, "docid")
    out = corpus.distinct_sentences(sents) if distinct else sents
    sinks.write_sentences(out, out_path)
    return out


def bad_ocr_job(spark: SparkSession, txt_dirs) -> DataFrame:
    """Names of text files whose non-word share is above the threshold."""
    return corpus.bad_ocr(sources.read_whole_texts(spark, txt_dirs), "docid")


def lemmatize_job(spark: SparkSession, input_csv, save_as: str, text_col: str = "TEXT",
                  schema=None) -> DataFrame:
    """Corpus CSV -> corpus + LEMMAS column -> parquet."""
    lem = corpus.lemma_corpus(sources.read_csv_corpus(spark, input_csv, schema), text_col, "LEMMAS")
    sinks.write_parquet(lem, save_as)
    return spark.read.parquet(save_as)


def word2vec_job(spark: SparkSession, input_txt, save_as: str) -> Word2VecModel:
    """Sentence lines -> Word2Vec model, saved (fails if the path exists)."""
    lines = sources.read_text_lines(spark, input_txt).withColumnRenamed("value", "text")
    model = ml.fit_word2vec(lines)
    model.save(save_as)
    return model


def tfidf_nb_job(spark: SparkSession, label_col: str, lemmas_path: str, evaluate: bool = True,
                 save_as: str | None = None, id_col: str = "ISIN"):
    """Train TF-IDF + NB; evaluate on a 30% split or train on all and save."""
    lem = spark.read.parquet(lemmas_path)
    train, test = ml.split(lem, id_col, evaluate)
    train = train.persist()
    indexer = ml.fit_label_indexer(lem, label_col)
    model = ml.nb_pipeline(indexer).fit(train)
    train.unpersist()
    if evaluate:
        return ml.evaluate_predictions(model.transform(test))
    model.write().overwrite().save(save_as)
    return model


def w2v_rf_job(spark: SparkSession, label_col: str, labeled_csv, w2v_path: str,
               evaluate: bool = True, save_as: str | None = None, schema=None):
    """Train a random forest on word vectors of a labelled corpus CSV; evaluate on a 30% split
    (by a hash of the text) or train on all and save."""
    lab = sources.read_labeled_corpus(spark, label_col, labeled_csv, schema=schema)
    train, test = ml.split(lab, "text", evaluate)
    train = train.persist()
    indexer = ml.fit_label_indexer(lab, "category")
    model = ml.rf_pipeline(indexer, Word2VecModel.load(w2v_path)).fit(train)
    train.unpersist()
    if evaluate:
        return ml.evaluate_predictions(model.transform(test))
    model.write().overwrite().save(save_as)
    return model


def pipeline_classifier_job(spark: SparkSession, pipeline_path: str, unlabeled_path: str,
                            save_as: str, id_col: str = "ISIN") -> list:
    """Score an unlabelled parquet corpus with a saved pipeline; write the
    predictions CSV and return a 5-row preview (scores computed once)."""
    scored = ml.score(PipelineModel.load(pipeline_path), spark.read.parquet(unlabeled_path),
                      id_col).persist()
    head = sinks.preview(scored).collect()
    sinks.write_predictions(scored, save_as, id_col)
    scored.unpersist()
    return head


def combine_results_job(spark: SparkSession, results_dir: str, out_dir: str) -> DataFrame:
    """Prediction part files -> last prediction per id -> one submission CSV in ``out_dir``, named
    after the results folder."""
    back = sources.read_predictions(spark, results_dir)
    sub = labels.submission(back, "isin", "label", order_col="position")
    sinks.write_submission(sub, f"{out_dir.rstrip('/')}/{sinks.submission_name(results_dir)}")
    return sub
