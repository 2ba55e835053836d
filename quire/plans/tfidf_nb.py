"""Flow A as one relational plan: lemmas -> stop words -> bigrams -> hashed TF
-> IDF -> Naive Bayes -> predictions -> evaluation.

Documents become packed sparse rows, one each: training reads them into one
aggregate by class and bucket, scoring meets the model where the row is, so neither
texts nor terms are shuffled.

Nothing runs until a result is asked for; the DataFrames of an ``NBFlow`` share
the same upstream plan. Callers (queries, bench, tests) pick what they need and
call ``release`` when done.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.features import NUM_FEATURES, bigrams, train_flag
from quire.functions.lemma import lemmas
from quire.functions.stopwords import remove_stop_words
from quire.functions.text import ascii_text
from quire.operators import bayes, evaluate, labels, tfidf


def materialize(df: DataFrame, how: str | None = "persist") -> DataFrame:
    """Keep a re-used intermediate: ``persist`` (recomputed from lineage if an
    executor is lost), ``checkpoint`` (written to the shared checkpoint folder,
    cuts the lineage) or ``None``."""
    if how == "persist":
        return df.persist()
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    return df


def bigram_features(docs: DataFrame, id_col: str, text_col: str, keys: tuple[str, ...] = (),
                    stop_words=None) -> DataFrame:
    """(id, *keys, ngrams): row-local text -> lemmas -> filtered words -> bigrams."""
    words = remove_stop_words(lemmas(ascii_text(text_col)), stop_words)
    # two projections: the optimizer keeps an expensive column that is read
    # several times (the bigram expression reads ``words`` thrice) in its own
    # projection instead of inlining it
    return (docs.select(id_col, *keys, words.alias("words"))
                .select(id_col, *keys, bigrams("words").alias("ngrams")))


@dataclass
class NBFlow:
    docs: DataFrame        # (id, label, is_train)
    packed: DataFrame      # (id, label, is_train, buckets, counts)
    tf: DataFrame          # (id, label, is_train, bucket, tf)
    index: DataFrame       # (label, n, idx)
    idf: DataFrame         # (bucket, df, idf)         fitted on training docs
    weights: DataFrame     # (id, label, is_train, bucket, tf, w)
    priors: DataFrame      # (label_idx, n_docs, pi, theta0)
    theta: DataFrame       # (label_idx, bucket, s_cb, theta)
    kept: list[DataFrame]  # what ``release`` frees
    predict: Callable[[], DataFrame]

    @cached_property
    def predictions(self) -> DataFrame:
        """(id, label, prediction, predicted) on test docs. The classes are counted first (labels
        alone are read): their number says whether the model fits every task."""
        return self.predict()

    def confusion(self) -> DataFrame:
        return evaluate.confusion_matrix(self.predictions, "label", "predicted")

    def metrics(self) -> DataFrame:
        return evaluate.summary_metrics(self.confusion())

    def release(self) -> None:
        """Frees the tables that the flow keeps, after its results are computed."""
        for df in self.kept:
            df.unpersist()


def build(documents: DataFrame, label_col: str, id_col: str = "doc_id",
          text_col: str = "text", num_features: int = NUM_FEATURES,
          smoothing: float = 1.0, stop_words=None, evaluate_split: bool = True,
          keep: str | None = "persist") -> NBFlow:
    """Wire the whole flow over a document table. No job runs here (but for
    ``keep="checkpoint"``, which writes).

    ``evaluate_split=True``: train on the md5 70% split, predict the other 30%.
    ``False``: train on all documents and predict all of them. Ids are taken to be unique.

    The label goes along with its document's terms, as a string: neither the text nor the
    documents are ever shuffled on the label, only sums by class and bucket are.
    """
    is_train = train_flag(id_col) if evaluate_split else F.lit(True)
    docs = documents.select(id_col, labels.label_text(label_col).alias("label"), text_col,
                            is_train.alias("is_train"))
    index = labels.label_index(documents, label_col)
    feats = bigram_features(docs, id_col, text_col, ("label", "is_train"), stop_words)
    # the one expensive step: a sparse row for each document, made within the row
    keys = ("label", "is_train")
    packed = materialize(tfidf.packed_tf(feats, id_col, "ngrams", keys, num_features), keep)
    docs = docs.drop(text_col)

    train_docs = docs.filter("is_train")
    m = tfidf.n_docs(train_docs)
    sums = bayes.class_sums(tfidf.unpacked_tf(packed.filter("is_train"), id_col, keys), "label")
    idf = tfidf.idf_of_sums(sums, m)
    tf = tfidf.unpacked_tf(packed, id_col, keys)
    weights = tfidf.tfidf(tf, idf, m, "bucket", rows=num_features).withColumnRenamed("tfidf", "w")

    train_w = tfidf.tfidf(sums, idf, m, "bucket", rows=num_features).withColumnRenamed("tfidf", "w")
    by_class = index.select("label", F.col("idx").alias("label_idx"))
    # the fitted model: a row of priors for each class and at most classes x num_features rows of theta
    priors = materialize(bayes.nb_priors(train_docs, "label", train_w, smoothing, num_features)
                         .join(by_class, "label").select("label_idx", "n_docs", "pi", "theta0"), keep)
    theta = materialize(bayes.nb_theta(train_w, "label", smoothing, num_features)
                        .join(by_class, "label").select("label_idx", "bucket", "s_cb", "theta"), keep)

    def predict() -> DataFrame:
        # classes that no training document has are no classes of the model
        seen = train_docs.select("label").distinct()
        k = seen.count()
        classes = seen.join(by_class, "label").select(F.array_sort(F.collect_list("label_idx"))).scalar()
        place = lambda c: (F.array_position(classes, F.col(c)) - 1).cast("double")
        model_priors = priors.withColumn("cls", place("label_idx"))
        model = bayes.nb_model(theta.withColumn("cls", place("label_idx")), model_priors, "cls", k)
        test_docs = docs.filter(~F.col("is_train")) if evaluate_split else docs
        test_w = weights.filter(~F.col("is_train")) if evaluate_split else weights
        pred = bayes.nb_predict(test_docs.select(id_col, "label"), id_col, test_w, model, model_priors, "cls",
                                small=bayes.fits_tasks(k, num_features), classes=k)
        pred = pred.withColumn("prediction", F.element_at(classes, (F.col("prediction") + 1).cast("int")))
        return labels.index_to_label(pred, index, "prediction", "predicted")

    kept = [packed, priors, theta] if keep == "persist" else []
    return NBFlow(docs, packed, tf, index, idf, weights, priors, theta, kept, predict)
