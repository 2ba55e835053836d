"""Term frequencies, document frequencies and TF-IDF as aggregations.

Shapes (long format, one row per non-zero entry):
  tf     (id, *keys, term|bucket, tf)
  idf    (term|bucket, df, idf)          idf = ln((m + 1) / (df + 1))
  tfidf  (id, *keys, term|bucket, tf, tfidf)
  packed (id, *keys, buckets, counts)     one row per document, buckets sorted

Scale notes: the per-document explode is row-local (``explode_outer`` plus a
null filter: a plain ``explode`` makes the optimizer infer a ``size(x) > 0``
filter that it pushes below the projection, evaluating the whole text
pipeline twice); ``groupBy(id, bucket)``
aggregates map-side before its shuffle, so a document that holds a large share
of all tokens contributes at most ``num_features`` rows per partition. The
document frequency table of hashed features has at most ``num_features`` rows,
which is the proven bound that makes its broadcast safe. ``packed_tf`` counts within the row, so
terms are never shuffled; what reads it unpacks it in the task and aggregates map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.features import NUM_FEATURES, run_lengths, runs, stable_bucket
from quire.operators.numbering import split_repeated


def hashed_tf(df: DataFrame, id_col: str, terms_col: str = "ngrams",
              keys: tuple[str, ...] = (), num_features: int = NUM_FEATURES) -> DataFrame:
    """(id, *keys, bucket, tf): counts of hashed terms per document."""
    return (df.select(id_col, *keys, F.explode_outer(terms_col).alias("term"))
              .filter(F.col("term").isNotNull())
              .select(id_col, *keys, stable_bucket("term", num_features).alias("bucket"))
              .groupBy(id_col, *keys, "bucket")
              .agg(F.count(F.lit(1)).alias("tf")))


def packed_tf(df: DataFrame, id_col: str, terms_col: str = "ngrams", keys: tuple[str, ...] = (),
              num_features: int = NUM_FEATURES) -> DataFrame:
    """(id, *keys, buckets, counts): the sparse row of each document, without a shuffle.

    Rows are not merged: the ids of ``df`` are taken to be unique. A null or empty term array gives empty arrays.
    """
    terms = F.array_compact(F.coalesce(F.col(terms_col), F.array().cast("array<string>")))
    hashed = df.select(id_col, *keys, F.sort_array(F.transform(terms, lambda t: stable_bucket(t, num_features))).alias("_b"))
    buckets, starts = runs("_b")
    return (hashed.select(id_col, *keys, buckets.alias("buckets"), starts.alias("_s"), F.size("_b").alias("_n"))
                  .select(id_col, *keys, "buckets", run_lengths("_s", F.col("_n")).alias("counts")))


def unpacked_tf(packed: DataFrame, id_col: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keys, bucket, tf) of packed rows; a document without terms has no row."""
    pairs = packed.select(id_col, *keys, F.explode_outer(F.arrays_zip("buckets", "counts")).alias("_t"))
    return (pairs.select(id_col, *keys, F.col("_t.buckets").alias("bucket"), F.col("_t.counts").cast("long").alias("tf"))
                 .filter(F.col("bucket").isNotNull()))


def term_tf(df: DataFrame, id_col: str, terms_col: str = "ngrams",
            keys: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keys, term, tf): counts of plain terms per document.

    Terms are counted within the row; only rows whose id another row has, too, are merged by a shuffle.
    """
    here, repeated = split_repeated(df, id_col)
    terms = F.sort_array(F.array_compact(F.coalesce(F.col(terms_col), F.array().cast("array<string>"))))
    distinct, starts = runs("_w")
    packed = (here.select(id_col, *keys, terms.alias("_w")).select(id_col, *keys, distinct.alias("term"), starts.alias("_s"), F.size("_w").alias("_n"))
              .select(id_col, *keys, "term", run_lengths("_s", F.col("_n")).alias("tf")))
    out = (packed.select(id_col, *keys, F.explode_outer(F.arrays_zip("term", "tf")).alias("_t"))
           .select(id_col, *keys, F.col("_t.term").alias("term"), F.col("_t.tf").cast("long").alias("tf")).filter("term is not null"))
    if repeated is None:
        return out
    return out.unionByName(repeated.select(id_col, *keys, F.explode_outer(terms_col).alias("term"))
                           .filter(F.col("term").isNotNull())
                           .groupBy(id_col, *keys, "term")
                           .agg(F.count(F.lit(1)).alias("tf")))


def n_docs(docs: DataFrame) -> Column:
    """Number of documents as a scalar-subquery column (runs once)."""
    return docs.select(F.count(F.lit(1))).scalar()


def idf(tf: DataFrame, m: Column, key: str = "bucket") -> DataFrame:
    """(key, df, idf) over the documents that produced ``tf``."""
    return (tf.groupBy(key).agg(F.count(F.lit(1)).alias("df"))
              .withColumn("idf", F.log((m + 1.0) / (F.col("df") + 1.0))))


def idf_of_sums(sums: DataFrame, m: Column) -> DataFrame:
    """(bucket, df, idf) from sums by class and bucket, where ``n`` counts the documents."""
    return (sums.groupBy("bucket").agg(F.sum("n").alias("df"))
                .withColumn("idf", F.log((m + 1.0) / (F.col("df") + 1.0))))


#: An idf table of at most so many rows (about 32 bytes each) is broadcast.
MAX_BROADCAST_ROWS = 1_000_000


def tfidf(tf: DataFrame, idf_df: DataFrame, m: Column, key: str = "bucket",
          rows: int | None = None) -> DataFrame:
    """Weights tf * idf; a feature unseen when fitting gets ln(m + 1).

    ``rows`` is a proven bound on the idf table's rows (the feature space of hashed terms); it is
    broadcast if that is small. A plain-term vocabulary grows with the data and is left to the
    planner (AQE broadcasts it only if it turns out small, and splits hot terms otherwise).
    """
    side = idf_df.select(key, "idf")
    if rows is not None and rows <= MAX_BROADCAST_ROWS:
        side = F.broadcast(side)
    unseen = F.log(m + 1.0)
    return (tf.join(side, key, "left")
              .withColumn("tfidf", F.col("tf") * F.coalesce(F.col("idf"), unseen))
              .drop("idf"))
