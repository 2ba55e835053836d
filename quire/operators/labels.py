"""Label tables: index <-> string, label merge by entity key, submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import ROC_SEPARATOR, ascii_text, strip_label_quotes

# ---- fixed values: submission layout ---------------------------------------
SUBMISSION_COLUMNS = ["ISIN", "ISSUER.NAME", "GA.NAME", "OPS.CURR", "ZCP.FL", "ROC",
                      "MIN.TRAD.AMT", "MLT.TRAD.AMT"]
SUBMISSION_TARGET = "ISSUER.NAME"
# ---------------------------------------------------------------------------


#: Parts into which the documents of one label are dealt for the join with the label's row.
LABEL_PARTS = 32


def label_text(label_col: str) -> Column:
    """A label as a string; a missing one is the empty string, a class of its own."""
    return F.coalesce(F.col(label_col).cast("string"), F.lit(""))


def drop_empty_label(df: DataFrame, label_col: str) -> DataFrame:
    """Only the rows that have a label."""
    return df.filter(label_text(label_col) != "")


def label_index(df: DataFrame, label_col: str) -> DataFrame:
    """(label, n, idx): most frequent label gets 0, ties in label order.

    A missing label is ``""``. The aggregate has one row per distinct label, and the global
    ordering window runs over that table only: a class list is a model's output size, which the
    driver holds in the estimator form, too.
    """
    counts = df.groupBy(label_text(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc("label"))
    return counts.withColumn("idx", (F.row_number().over(w) - 1).cast("double"))


def _by_label(df: DataFrame, value: Column, table: DataFrame, key: str) -> DataFrame:
    """Left join with one row per label; a label that most rows have is dealt to
    ``LABEL_PARTS`` parts."""
    part = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(LABEL_PARTS)).cast("int")
    dealt = table.withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(LABEL_PARTS - 1))))
    rows = df.withColumn("_k", value).withColumn("_q", part)
    return rows.join(dealt, (F.col("_k") == F.col(key)) & (F.col("_q") == F.col("_p")), "left").drop(
        "_k", "_q", "_p", key)


def index_labels(df: DataFrame, index: DataFrame, label_col: str,
                 out_col: str = "label_idx") -> DataFrame:
    """Attach the label's index (string -> index). Leave the text out of ``df``: the join
    may shuffle it."""
    return _by_label(df, label_text(label_col),
                     index.select(F.col("label").alias("_l"), F.col("idx").alias(out_col)), "_l")


def index_to_label(df: DataFrame, index: DataFrame, idx_col: str = "prediction",
                   out_col: str = "predictedCategory") -> DataFrame:
    """Attach the label string of an index (index -> string)."""
    return _by_label(df, F.col(idx_col),
                     index.select(F.col("idx").alias("_i"), F.col("label").alias(out_col)), "_i")


def last_per_key(df: DataFrame, key: str, order_col: str, value_cols: list[str]) -> DataFrame:
    """Later rows overwrite earlier ones: the row with the largest order value.

    ``max_by`` is a partial aggregate, so a hot key is reduced map-side
    instead of being collected into one task.
    """
    return df.groupBy(key).agg(*[
        F.max_by(F.col(c), F.col(order_col)).alias(c) for c in value_cols])


def merge_labels(issuers: DataFrame, guarantors: DataFrame, rocs: DataFrame,
                 docmap: DataFrame, texts: DataFrame, flatten: bool = True,
                 order_col: str = "position") -> DataFrame:
    """One labelled row per entity that has a text.

    issuers    (isin, issuer_name, zcp_fl, min_trad_amt, mlt_trad_amt, ops_curr, position)
    guarantors (isin, ga_name, position)
    rocs       (isin, roc)        0..n rows per entity
    docmap     (docid, isin)      n:m
    texts      (docid, text)

    ``position`` orders the rows of a source; of several rows of one entity the last one counts.
    A missing label becomes ``""``; ROC values are de-duplicated, sorted and joined with ``|``; the
    first (smallest) document id that has a text is used. An entity without a text has no row,
    so the entities with a text are the left side of every join, and the text, the only wide
    column, is joined last.
    """
    def isin(df: DataFrame) -> DataFrame:
        return df.withColumn("isin", strip_label_quotes(F.col("isin").cast("string")))

    values = ["issuer_name", "zcp_fl", "min_trad_amt", "mlt_trad_amt", "ops_curr"]
    iss = last_per_key(isin(issuers), "isin", order_col, values)
    ga = last_per_key(isin(guarantors), "isin", order_col, ["ga_name"])
    roc = (isin(rocs).select("isin", strip_label_quotes("roc").alias("roc")).groupBy("isin")
           .agg(F.concat_ws(ROC_SEPARATOR, F.array_sort(F.collect_set("roc"))).alias("roc")))
    dm = isin(docmap).select(strip_label_quotes(F.col("docid").cast("string")).alias("docid"), "isin")
    tx = texts.select(F.col("docid").cast("string").alias("docid"), "text")
    # documents that exist -> first existing document per entity
    first_doc = (dm.join(tx.select("docid"), "docid", "left_semi")
                   .groupBy("isin").agg(F.min("docid").alias("docid")))
    keyed = first_doc.join(iss, "isin", "left").join(ga, "isin", "left").join(roc, "isin", "left")
    body = ascii_text("text") if flatten else F.col("text")
    return (keyed.join(tx, "docid", "inner")
                 .select(F.col("isin").alias("ISIN"),
                         F.coalesce(strip_label_quotes("issuer_name"), F.lit("")).alias("ISSUER_NAME"),
                         F.coalesce("zcp_fl", F.lit("")).alias("ZCP_FL"),
                         F.col("min_trad_amt").alias("MIN_TRAD_AMT"),
                         F.col("mlt_trad_amt").alias("MLT_TRAD_AMT"),
                         F.coalesce("ops_curr", F.lit("")).alias("OPS_CURR"),
                         F.coalesce(strip_label_quotes("ga_name"), F.lit("")).alias("GA_NAME"),
                         F.coalesce("roc", F.lit("")).alias("ROC"),
                         body.alias("TEXT")))


def entities_with_text(docmap: DataFrame, texts: DataFrame) -> DataFrame:
    """Entities for which at least one mapped document has a text."""
    return (docmap.select(F.col("docid").cast("string").alias("docid"), "isin")
                  .join(texts.select(F.col("docid").cast("string").alias("docid")), "docid", "left_semi")
                  .select("isin").distinct())


def submission(predictions: DataFrame, id_col: str = "isin", label_col: str = "label",
               order_col: str | None = None, target: str = SUBMISSION_TARGET) -> DataFrame:
    """The fixed 8-column submission table, one row per id, sorted by id.

    With ``order_col`` the last prediction per id wins; without it each id is
    expected once (a duplicate keeps the largest label, deterministic).
    """
    if order_col:
        one = last_per_key(predictions, id_col, order_col, [label_col])
    else:
        one = predictions.groupBy(id_col).agg(F.max(label_col).alias(label_col))
    cols = []
    for name in SUBMISSION_COLUMNS:
        if name == "ISIN":
            cols.append(F.col(id_col).cast("string").alias(name))
        elif name == target:
            cols.append(F.col(label_col).cast("string").alias(name))
        elif name in ("MIN.TRAD.AMT", "MLT.TRAD.AMT"):
            cols.append(F.lit(0).alias(name))
        else:
            cols.append(F.lit("").alias(name))
    return one.select(*cols).orderBy("ISIN")
