"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the library's operators over the driver's tables. Array results are
rendered as joined strings and doubles rounded to 6 places so that the DuckDB
twins in ``quire.oracle_queries`` can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.features import train_flag
from quire.operators import corpus, labels, numbering, tfidf, vectors
from quire.plans import jobs, tfidf_nb
from quire.session import scratch_path
from quire.sinks import files as sinks
from quire.sources import files as sources
from quire.sources.tables import documents, read_table, spread

R = 6  # decimals kept in compared doubles


def _docs(spark, sf, cols=("doc_id", "text")) -> DataFrame:
    return documents(spark, sf, cols)


def _joined(c, sep=" "):
    return F.concat_ws(sep, c)


# ---- 2.3 projections / scalar text functions --------------------------------

def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", T.clean_text("text").alias("text"))


def ascii_text(spark, sf):
    return _docs(spark, sf).select("doc_id", T.ascii_text("text").alias("text"))


def labeled_corpus(spark, sf):
    return corpus.labeled_corpus(_docs(spark, sf, ("doc_id", "text", "lang")), "lang")


def unlabeled_corpus(spark, sf):
    return corpus.unlabeled_corpus(_docs(spark, sf), "doc_id")


def ocr_quality(spark, sf):
    return (corpus.ocr_quality(_docs(spark, sf), "doc_id")
                  .withColumn("ratio", F.round("ratio", R)))


#: A share of non-word characters that some documents of the test corpus exceed.
OCR_QUERY_RATIO = 0.25


def bad_ocr(spark, sf):
    return corpus.bad_ocr(_docs(spark, sf), "doc_id", threshold=OCR_QUERY_RATIO)


def sentences(spark, sf):
    return corpus.sentences(_docs(spark, sf), "doc_id")


def distinct_sentences(spark, sf):
    return corpus.distinct_sentences(corpus.sentences(_docs(spark, sf), "doc_id"))


def all_text_sentences(spark, sf):
    """Distinct sentences over several text collections (documents and
    conversation turns), as for the word-vector training text."""
    docs = read_table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    conv = read_table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(":"),
                 F.col("turn").cast("string")).alias("id"), "text")
    both = spread(docs.unionByName(conv), "id")
    return corpus.distinct_sentences(corpus.sentences(both, "id"))


def tokens(spark, sf):
    t = corpus.tokens(_docs(spark, sf))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"),
                    _joined("tokens").alias("tokens"))


def lemma_tokens(spark, sf):
    t = corpus.lemma_corpus(_docs(spark, sf), out_col="lemmas")
    return t.select("doc_id", F.size("lemmas").alias("n_lemmas"),
                    _joined("lemmas").alias("lemmas"))


#: A dictionary of its own; a form listed twice has its first lemma in alphabetical order.
DICTIONARY = [("and", "also"), ("der", "derr"), ("les", "leurs"), ("que", "quel"), ("that", "thatt"),
              ("the", "thez"), ("The", "thee"), ("und", "undd")]


def _lemma_rows(t: DataFrame) -> DataFrame:
    return t.select("doc_id", F.size("lemmas").alias("n_lemmas"), _joined("lemmas").alias("lemmas"))


def lemmatize_dict(spark, sf):
    return _lemma_rows(corpus.lemmatize_with_dictionary(_docs(spark, sf), DICTIONARY, out_col="lemmas"))


def lemmatize_join(spark, sf):
    """The same by a join with the dictionary as a table."""
    table = spark.createDataFrame(DICTIONARY, "form string, lemma string")
    return _lemma_rows(corpus.lemmatize_by_join(_docs(spark, sf), "doc_id", table, out_col="lemmas"))


def lemma_corpus(spark, sf):
    t = corpus.lemma_corpus(_docs(spark, sf, ("doc_id", "text", "lang", "source", "n_chars")))
    return t.withColumn("LEMMAS", _joined("LEMMAS"))


def stopwords_removed(spark, sf):
    t = corpus.filtered_words(corpus.lemma_corpus(_docs(spark, sf)))
    return t.select("doc_id", F.size("words").alias("n_words"), _joined("words").alias("words"))


def bigrams(spark, sf):
    t = corpus.with_bigrams(corpus.filtered_words(corpus.lemma_corpus(_docs(spark, sf))))
    return t.select("doc_id", F.size("ngrams").alias("n_bigrams"),
                    _joined("ngrams", "|").alias("bigrams"))


def corpus_stats(spark, sf):
    return corpus.corpus_stats(read_table(spark, sf, "documents"))


# ---- features ---------------------------------------------------------------

def _bigram_docs(spark, sf):
    return tfidf_nb.bigram_features(_docs(spark, sf), "doc_id", "text")


def hashed_tf(spark, sf):
    return tfidf.unpacked_tf(tfidf.packed_tf(_bigram_docs(spark, sf), "doc_id"), "doc_id")


def idf(spark, sf):
    docs = read_table(spark, sf, "documents")
    tf = tfidf.term_tf(_bigram_docs(spark, sf), "doc_id")
    return (tfidf.idf(tf, tfidf.n_docs(docs), "term")
                 .withColumn("idf", F.round("idf", R)))


def tfidf_query(spark, sf):
    docs = read_table(spark, sf, "documents")
    m = tfidf.n_docs(docs)
    tf = tfidf.term_tf(_bigram_docs(spark, sf), "doc_id")  # one exchange, read twice
    w = tfidf.tfidf(tf, tfidf.idf(tf, m, "term"), m, "term")
    return w.withColumn("tfidf", F.round("tfidf", R))


def hash_split(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", train_flag("doc_id").alias("is_train"))


# ---- labels -----------------------------------------------------------------

def label_index(spark, sf):
    return labels.label_index(read_table(spark, sf, "documents"), "lang")


def index_to_label(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "source")
    idx = labels.label_index(docs, "source")
    with_idx = labels.index_labels(docs, idx, "source", "source_idx")
    return (labels.index_to_label(with_idx, idx, "source_idx", "source_back")
                  .select("doc_id", "source_idx", "source_back"))


# ---- Naive Bayes (relational) -------------------------------------------------

def _flow(spark, sf) -> tfidf_nb.NBFlow:
    # nothing is kept in memory, as nobody would free it: within one query the sums by class
    # and bucket are one exchange that all steps of the fit read
    return tfidf_nb.build(_docs(spark, sf, ("doc_id", "text", "lang")), "lang", keep=None)


def nb_priors(spark, sf):
    p = _flow(spark, sf).priors
    return p.select("label_idx", "n_docs", F.round("pi", R).alias("pi"),
                    F.round("theta0", R).alias("theta0"))


def nb_theta(spark, sf):
    t = _flow(spark, sf).theta
    return t.select("label_idx", "bucket", F.round("s_cb", R).alias("s_cb"),
                    F.round("theta", R).alias("theta"))


def nb_predict(spark, sf):
    return _flow(spark, sf).predictions.select("doc_id", "label", "predicted")


def confusion_matrix(spark, sf):
    return _flow(spark, sf).confusion()


def weighted_f1(spark, sf):
    m = _flow(spark, sf).metrics()
    return m.select(*[F.round(c, R).alias(c) for c in
                      ("weighted_f1", "accuracy", "weighted_precision", "weighted_recall")], "n")


def preview_top5(spark, sf):
    return nb_predict(spark, sf).orderBy("doc_id").limit(5)


# ---- label merge and submission --------------------------------------------------

def _label_sources(spark, sf):
    """Customers, and after them suppliers with the same keys, as issuers; two labels of each
    document, one after the other, as guarantors; all orders as multi-valued labels."""
    cust, sup = read_table(spark, sf, "customer"), read_table(spark, sf, "supplier")

    def issuer(df, p, segment, rank):
        return df.select(F.col(f"{p}_{'custkey' if p == 'c' else 'suppkey'}").alias("isin"), F.col(f"{p}_name").alias("issuer_name"),
                         F.lit("N").alias("zcp_fl"), F.col(f"{p}_acctbal").cast("double").alias("min_trad_amt"),
                         F.col(f"{p}_nationkey").cast("double").alias("mlt_trad_amt"), segment.alias("ops_curr"),
                         F.lit(rank).alias("position"))

    issuers = issuer(cust, "c", F.col("c_mktsegment"), 0).unionByName(issuer(sup, "s", F.lit("SUPPLIER"), 1))
    lab = read_table(spark, sf, "labels")
    guarantors = lab.select(F.col("doc_id").alias("isin"), F.concat(F.lit("Q"), F.col("quality").cast("string")).alias("ga_name"),
                            F.lit(0).alias("position"))
    guarantors = guarantors.unionByName(lab.filter("toxic = 1").select(
        F.col("doc_id").alias("isin"), F.lit("TOXIC").alias("ga_name"), F.lit(1).alias("position")))
    rocs = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("isin"), F.col("o_orderpriority").alias("roc"))
    # every entity names one document file; only some of those files exist
    docmap = cust.select(F.col("c_custkey").alias("docid"), F.col("c_custkey").alias("isin"))
    texts = read_table(spark, sf, "documents").select(F.col("doc_id").alias("docid"), "text")
    return issuers, guarantors, rocs, docmap, texts


def merge_labels(spark, sf):
    return labels.merge_labels(*_label_sources(spark, sf))


def entities_with_text(spark, sf):
    _, _, _, docmap, texts = _label_sources(spark, sf)
    return labels.entities_with_text(docmap, texts)


def last_per_key(spark, sf):
    o = read_table(spark, sf, "orders")
    return labels.last_per_key(o, "o_custkey", "o_orderkey", ["o_orderpriority", "o_orderstatus"])


def submission(spark, sf):
    conv = read_table(spark, sf, "conversations")
    preds = conv.select(F.col("conv_id").alias("isin"), F.col("role").alias("label"), "turn")
    return labels.submission(preds, "isin", "label", order_col="turn")


# ---- vectors -----------------------------------------------------------------------

def _words(t: DataFrame) -> DataFrame:
    return t.select(F.explode_outer("tokens").alias("word")).filter(F.col("word").isNotNull())


def w2v_vocab(spark, sf):
    t = corpus.tokens(_docs(spark, sf))
    return vectors.vocabulary(_words(t))


def mean_vector(spark, sf):
    # the counts are a table: the vocabulary, its size and the sums all read them
    path = scratch_path(spark, "counts")
    vectors.word_counts(corpus.tokens(_docs(spark, sf)), "doc_id").write.parquet(path)
    counts = spark.read.parquet(path)
    emb = read_table(spark, sf, "embeddings")
    rows, size = emb.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    vocab = vectors.vocabulary_from_counts(counts)
    # a row a word: each broadcast reads its part
    words = scratch_path(spark, "word-vectors")
    vectors.hashed_word_vectors(vocab, emb, F.lit(rows)).write.parquet(words)
    wv = spark.read.parquet(words)
    mv = vectors.mean_vectors(counts, "doc_id", wv, wv.count(), size)
    return mv.withColumn("value", F.round("value", R))


# ---- file round trips: write with a sink, read back with a source ------------------

MERGED_SCHEMA = ("ISIN string, ISSUER_NAME string, ZCP_FL string, MIN_TRAD_AMT double, "
                 "MLT_TRAD_AMT double, OPS_CURR string, GA_NAME string, ROC string, TEXT string")


def src_csv_corpus(spark, sf):
    """Labelled corpus -> CSV (quoted, doubled quotes) -> CSV corpus reader."""
    path = scratch_path(spark, "roundtrip/labeled_csv")
    sinks.write_labeled_csv(merge_labels(spark, sf), path)
    return sources.read_csv_corpus(spark, path, MERGED_SCHEMA)


def sink_labeled_csv(spark, sf):
    """The lines of the labelled corpus CSV, as written."""
    path = scratch_path(spark, "roundtrip/labeled_lines")
    merged = merge_labels(spark, sf)
    sinks.write_labeled_csv(merged, path)
    return sources.read_text_lines(spark, path).filter(F.col("value") != sinks.csv_header(merged))


def src_labeled_corpus(spark, sf):
    """Labelled corpus CSV -> (category, text) of one label column."""
    path = scratch_path(spark, "roundtrip/labeled_read")
    sinks.write_labeled_csv(merge_labels(spark, sf), path)
    return sources.read_labeled_corpus(spark, "OPS_CURR", path, schema=MERGED_SCHEMA)


def src_unlabeled_corpus(spark, sf):
    """Unlabelled corpus CSV -> (isin, text)."""
    path = scratch_path(spark, "roundtrip/unlabeled_read")
    sinks.write_labeled_csv(_docs(spark, sf).select(F.col("doc_id").cast("string").alias("ISIN"), T.ascii_text("text").alias("TEXT")), path)
    return sources.read_unlabeled_corpus(spark, path, schema="ISIN string, TEXT string")


def src_label_csv(spark, sf):
    """The four label files as CSV -> readers with positions -> merge."""
    base = scratch_path(spark, "roundtrip/labels")
    issuers, guarantors, rocs, docmap, texts = _label_sources(spark, sf)

    def through(df, name, schema):
        # part files stand in the order of the rows
        (df.orderBy("position").drop("position") if "position" in df.columns else df).write.option("header", True).option("escape", '"').csv(f"{base}/{name}")
        return sources.read_label_file(spark, f"{base}/{name}", schema)

    return labels.merge_labels(
        through(issuers, "issuers", "isin string, issuer_name string, zcp_fl string, min_trad_amt double, mlt_trad_amt double, ops_curr string"),
        through(guarantors, "guarantors", "isin string, ga_name string"), through(rocs, "rocs", "isin string, roc string"),
        through(docmap, "docids", "docid string, isin string"), texts)


def _flat(spark, sf):
    return _docs(spark, sf).select("doc_id", T.ascii_text("text").alias("value"))


def src_text_lines(spark, sf):
    """Flattened documents -> text files, a document a line -> line reader."""
    path = scratch_path(spark, "roundtrip/lines")
    _flat(spark, sf).select("value").write.text(path)
    return sources.read_text_lines(spark, path)


def src_whole_text(spark, sf):
    """Flattened documents -> text files in two folders -> whole-file reader over both -> lines."""
    path = scratch_path(spark, "roundtrip/whole")
    for i in (0, 1):
        (_flat(spark, sf).filter(F.col("doc_id") % 2 == i).select("value")
         .write.option("maxRecordsPerFile", 500).text(f"{path}/{i}"))
    files = sources.read_whole_texts(spark, [f"{path}/0", f"{path}/1"], "part-*")
    return files.select(F.explode(F.split(F.regexp_replace("text", "\n$", ""), "\n")).alias("value"))


def malformed_rows(spark, sf):
    """Orders as CSV lines, some too short, some too long, some of a wrong type -> the lines that do
    not parse."""
    path = scratch_path(spark, "roundtrip/malformed")
    key = F.col("o_orderkey")
    line = (F.when(key % 7 == 0, key.cast("string")).when(key % 11 == 0, F.concat_ws(",", key, "o_orderstatus", F.lit("more")))
            .when(key % 13 == 0, F.concat_ws(",", F.concat(F.lit("x"), key.cast("string")), "o_orderstatus"))
            .otherwise(F.concat_ws(",", key, "o_orderstatus")))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    (read_table(spark, sf, "orders").select(line.alias("value"))
     .select(F.when(first, F.concat(F.lit("key,status\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(path))
    return sources.malformed_rows(spark, path, "key long, status string")


def sink_parquet(spark, sf):
    """Lemma corpus -> parquet (overwrite) -> parquet reader."""
    path = scratch_path(spark, "roundtrip/lemma_parquet")
    sinks.write_parquet(lemma_corpus(spark, sf), path)
    return spark.read.parquet(path)


def sink_sentences(spark, sf):
    """Sentences -> text file -> line reader."""
    path = scratch_path(spark, "roundtrip/sentences")
    sinks.write_sentences(corpus.sentences(_docs(spark, sf), "doc_id"), path)
    return sources.read_text_lines(spark, path).withColumnRenamed("value", "sentence")


def _prediction_parts(spark, sf) -> str:
    """Two prediction part files of very different sizes with the same ids: the first has every
    turn's role, the second, read later, corrects some conversations."""
    path = scratch_path(spark, "roundtrip/predictions")
    conv = read_table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("ISIN"), "role", "turn")
    last = labels.last_per_key(conv, "ISIN", "turn", ["role"])
    large = conv.select("ISIN", F.concat("role", F.lit("?")).alias("predictedCategory"), F.lit(0).alias("part"))
    middle = last.select("ISIN", F.col("role").alias("predictedCategory"), F.lit(1).alias("part"))
    small = last.filter(F.col("ISIN").cast("long") % 10 == 0).select("ISIN", F.lit("corrected").alias("predictedCategory"), F.lit(2).alias("part"))
    parts = large.unionByName(middle).unionByName(small).repartitionByRange(3, "part")
    sinks.write_predictions(parts, path)
    return path


def sink_predictions(spark, sf):
    """Predictions -> quoted headerless CSV parts -> part reader -> last wins ->
    sorted 8-column submission."""
    back = sources.read_predictions(spark, _prediction_parts(spark, sf))
    return labels.submission(back, "isin", "label", order_col="position")


def sink_submission(spark, sf):
    """Prediction parts -> the submission file, by its lines."""
    out = scratch_path(spark, "roundtrip/submission")
    jobs.combine_results_job(spark, _prediction_parts(spark, sf), out)
    return sources.read_text_lines(spark, out)


def submission_parts(spark, sf):
    """Prediction parts -> ordered submission part files, by their lines; ``place`` is a line's place in the
    order of the files."""
    out = scratch_path(spark, "roundtrip/submission_parts")
    back = sources.read_predictions(spark, _prediction_parts(spark, sf))
    sinks.write_submission_parts(labels.submission(back, "isin", "label", order_col="position"), out)
    lines = sources.with_position(sources.read_text_lines(spark, out), "value")
    return numbering.row_numbers(lines, ["position"], "place").select("place", "value")


QUERIES = {
    "clean_text": clean_text,
    "ascii_text": ascii_text,
    "labeled_corpus": labeled_corpus,
    "unlabeled_corpus": unlabeled_corpus,
    "ocr_quality": ocr_quality,
    "bad_ocr": bad_ocr,
    "sentences": sentences,
    "distinct_sentences": distinct_sentences,
    "all_text_sentences": all_text_sentences,
    "tokens": tokens,
    "lemma_tokens": lemma_tokens,
    "lemmatize_dict": lemmatize_dict,
    "lemmatize_join": lemmatize_join,
    "lemma_corpus": lemma_corpus,
    "stopwords_removed": stopwords_removed,
    "bigrams": bigrams,
    "corpus_stats": corpus_stats,
    "hashed_tf": hashed_tf,
    "idf": idf,
    "tfidf": tfidf_query,
    "hash_split": hash_split,
    "label_index": label_index,
    "index_to_label": index_to_label,
    "nb_priors": nb_priors,
    "nb_theta": nb_theta,
    "nb_predict": nb_predict,
    "confusion_matrix": confusion_matrix,
    "weighted_f1": weighted_f1,
    "preview_top5": preview_top5,
    "merge_labels": merge_labels,
    "entities_with_text": entities_with_text,
    "last_per_key": last_per_key,
    "submission": submission,
    "w2v_vocab": w2v_vocab,
    "mean_vector": mean_vector,
    "src_csv_corpus": src_csv_corpus,
    "sink_parquet": sink_parquet,
    "sink_sentences": sink_sentences,
    "sink_predictions": sink_predictions,
    "sink_labeled_csv": sink_labeled_csv,
    "sink_submission": sink_submission,
    "submission_parts": submission_parts,
    "src_labeled_corpus": src_labeled_corpus,
    "src_unlabeled_corpus": src_unlabeled_corpus,
    "src_label_csv": src_label_csv,
    "src_text_lines": src_text_lines,
    "src_whole_text": src_whole_text,
    "malformed_rows": malformed_rows,
}
