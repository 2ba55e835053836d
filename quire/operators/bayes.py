"""Multinomial Naive Bayes as DataFrame aggregations (smoothing lambda).

  pi_c     = ln(n_c + l) - ln(N + K l)
  theta_cb = ln(s_cb + l) - ln(s_c + V l)        s_cb = sum of weights of b in c
  score_c  = pi_c + sum_b x_b theta_cb           prediction = argmax, ties -> lowest index

``V`` is the feature-space size (``num_features``), not the number of seen
features, and ``K`` the number of classes present in the training rows, as in
Spark ML's NaiveBayes. The model tables are bounded by classes x num_features.

Scale: training is two partial aggregations (per class, per class x bucket),
whose shuffles carry at most partitions x classes x num_features rows whatever
the corpus size. Scoring keeps the model sparse: with theta0_c for buckets that
class c never saw, a score is pi_c + theta0_c * sum(w) + the sum over seen
buckets of w * (theta_cb - theta0_c). One model row per bucket holds the last
differences of all classes; each joined row carries an array with a place for each class. A model of
at most ``MAX_MODEL_BYTES`` goes to every task (``small``): terms then stay where their document is, and
one row a document is shuffled at most. A larger one is joined by bucket.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.features import NUM_FEATURES


#: A model (``num_features`` x (classes + 4) words of 8 bytes, at most) of at most so many bytes goes to every task.
MAX_MODEL_BYTES = 64 << 20


def class_sums(tf: DataFrame, label_col: str) -> DataFrame:
    """(label, bucket, tf, n): term counts and documents by class and bucket, in one aggregate.

    ``tf`` has a row for each bucket of a document. The weight of a bucket is its count times a factor
    that all documents share, so the class sums of the weights are these sums times that factor.

    Both sums are positive; the filter has every reader of the table ask for both, so that readers of one
    of them share the other's exchange instead of computing the texts again.
    """
    sums = tf.groupBy(label_col, "bucket").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("n"))
    return sums.filter((F.col("tf") > 0) & (F.col("n") > 0))


def nb_priors(docs: DataFrame, label_col: str, weights: DataFrame,
              smoothing: float = 1.0, num_features: int = NUM_FEATURES) -> DataFrame:
    """(label, n_docs, pi, theta0) per class of the training documents.

    ``docs``: one row per training document with ``label_col``;
    ``weights``: (…, label_col, bucket, w) feature weights of those documents.
    ``theta0`` is theta for a bucket the class never saw.
    """
    lam = float(smoothing)
    counts = docs.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_docs"))
    mass = weights.groupBy(label_col).agg(F.sum("w").alias("s_c"))
    n_total = counts.select(F.sum("n_docs")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return (counts.join(mass, label_col, "left")
                  .select(label_col, "n_docs",
                          (F.log(F.col("n_docs") + lam) - F.log(n_total + k * lam)).alias("pi"),
                          (F.log(F.lit(lam)) - F.log(F.coalesce("s_c", F.lit(0.0))
                                                     + num_features * lam)).alias("theta0")))


def nb_theta(weights: DataFrame, label_col: str, smoothing: float = 1.0,
             num_features: int = NUM_FEATURES) -> DataFrame:
    """(label, bucket, s_cb, theta) for every (class, bucket) seen in training."""
    lam = float(smoothing)
    s_cb = weights.groupBy(label_col, "bucket").agg(F.sum("w").alias("s_cb"))
    s_c = s_cb.groupBy(label_col).agg(F.sum("s_cb").alias("s_c"))
    return (s_cb.join(s_c, label_col)
                .select(label_col, "bucket", "s_cb",
                        (F.log(F.col("s_cb") + lam) - F.log(F.col("s_c") + num_features * lam))
                        .alias("theta")))


def _n_classes(priors: DataFrame, classes: int | None) -> Column:
    return priors.select(F.count(F.lit(1))).scalar() if classes is None else F.lit(classes)


def nb_model(theta: DataFrame, priors: DataFrame, label_col: str, classes: int | None = None) -> DataFrame:
    """(bucket, gain): one row per bucket that training saw.

    ``gain`` has a place for each class, in index order: theta - theta0 where the class saw the
    bucket, 0 elsewhere. ``label_col`` holds class indices 0..K-1 as doubles. ``classes`` is their
    number, where the caller has counted them.
    """
    k = _n_classes(priors, classes)
    gains = (theta.join(priors.select(label_col, "theta0"), label_col)
                  .groupBy("bucket")
                  .agg(F.map_from_entries(F.collect_list(F.struct(
                      F.col(label_col).cast("int"), F.col("theta") - F.col("theta0")))).alias("_g")))
    gains = gains.withColumn("_c", F.sequence(F.lit(0), (k - 1).cast("int")))
    places = F.transform("_c", lambda c: F.coalesce(F.element_at("_g", c), F.lit(0.0)))
    return gains.select("bucket", places.alias("gain"))


def nb_scores(weights: DataFrame, id_col: str, model: DataFrame, priors: DataFrame,
              label_col: str, small: bool = False, classes: int | None = None) -> DataFrame:
    """(id, scores): for documents with at least one feature of positive weight, an array with the score of
    each class:

      pi_c + theta0_c * sum(w) + sum over seen buckets of w * gain_c

    One row per (document, bucket) meets one row per bucket, whatever the number of classes; the
    gains are summed as a vector, with a partial aggregate in each task. ``small``: the caller has
    checked that the model ``fits_tasks``; it is broadcast, and no row of a bucket is shuffled.
    """
    model = F.broadcast(model) if small else model
    k = _n_classes(priors, classes)
    # a weight of 0 (a term that all training documents have) adds nothing to any score
    joined = weights.filter("w > 0").select(id_col, "bucket", "w").join(model, "bucket", "left")
    gain = array_to_vector(F.coalesce("gain", F.array_repeat(F.lit(0.0), k.cast("int"))))
    sums = (joined.select(id_col, "w", gain.alias("gain")).groupBy(id_col)
                  .agg(Summarizer.sum(F.col("gain"), F.col("w")).alias("gain"), F.sum("w").alias("mass"))
                  .withColumn("_c", _classes(priors, label_col)))
    return sums.select(id_col, F.zip_with(vector_to_array("gain"), "_c",
                                          lambda g, c: c["pi"] + c["theta0"] * F.col("mass") + g).alias("scores"))


def _classes(priors: DataFrame, label_col: str) -> Column:
    """(label_col, pi, theta0) of the classes in index order, as a scalar subquery: the classes of a
    fitted model are few enough for every task."""
    return priors.select(F.array_sort(F.collect_list(F.struct(
        F.col(label_col).alias("idx"), "pi", "theta0")))).scalar()


def nb_predict(docs: DataFrame, id_col: str, weights: DataFrame, model: DataFrame,
               priors: DataFrame, label_col: str, small: bool = False, classes: int | None = None) -> DataFrame:
    """(id, *other docs columns, prediction): the best class per document.

    ``label_col`` holds class indices (doubles); equal scores go to the lowest index. A document
    without features gets the class of the largest prior.
    """
    scores = nb_scores(weights, id_col, model, priors, label_col, small, classes)
    best = scores.select(id_col, (F.array_position("scores", F.array_max("scores")) - 1).cast("double")
                         .alias("prediction"))
    default = (priors.select(F.max_by(label_col, F.struct(F.col("pi"), -F.col(label_col))))
                     .scalar())
    return (docs.join(best, id_col, "left")
                .withColumn("prediction", F.coalesce("prediction", default)))


def fits_tasks(classes: int, num_features: int = NUM_FEATURES) -> bool:
    """Whether a model of so many classes is small enough to go to every task."""
    return 8 * num_features * (classes + 4) <= MAX_MODEL_BYTES
