"""Corpus-level operators: cleaning, OCR check, sentences, tokens, lemmas.

Every operator here is row-local (a projection or a generator): no shuffle
except ``distinct_sentences``, whose dedup aggregates map-side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import lemma as L
from quire.functions import text as T
from quire.functions.features import bigrams as bigram_expr
from quire.functions.stopwords import remove_stop_words

def _empty():
    return F.array().cast("array<string>")


def labeled_corpus(df: DataFrame, label_col: str, text_col: str = "text") -> DataFrame:
    """(category, text): the label column as a string, text cleaned of ``\\W+``."""
    return df.select(F.col(label_col).cast("string").alias("category"),
                     T.clean_text(text_col).alias("text"))


def unlabeled_corpus(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(isin, text): the id as a string, text cleaned of ``\\W+``."""
    return df.select(F.col(id_col).cast("string").alias("isin"),
                     T.clean_text(text_col).alias("text"))


def ocr_quality(df: DataFrame, id_col: str, text_col: str = "text",
                threshold: float = T.OCR_BAD_RATIO) -> DataFrame:
    """(id, ratio, is_bad) per document."""
    return df.select(F.col(id_col), T.ocr_ratio(text_col).alias("ratio"),
                     T.is_bad_ocr(text_col, threshold).alias("is_bad"))


def bad_ocr(df: DataFrame, id_col: str, text_col: str = "text",
            threshold: float = T.OCR_BAD_RATIO) -> DataFrame:
    """Ids of documents that need a new OCR pass."""
    return ocr_quality(df, id_col, text_col, threshold).filter("is_bad").select(id_col)


def sentences(df: DataFrame, id_col: str, text_col: str = "text",
              flatten: bool = True) -> DataFrame:
    """(id, sent_no, sentence): one row per sentence, numbered from 0."""
    src = T.ascii_text(text_col, strip_quotes=False) if flatten else F.col(text_col)
    return (df.select(F.col(id_col),
                      F.posexplode(T.sentence_array(src)).alias("sent_no", "sentence"))
              .withColumn("sentence", F.trim("sentence"))
              .filter(F.length("sentence") > 0))


def distinct_sentences(sents: DataFrame) -> DataFrame:
    """Unique sentence strings (``sort -u``)."""
    return sents.select("sentence").distinct()


def tokens(df: DataFrame, text_col: str = "text", out_col: str = "tokens",
           clean: bool = True) -> DataFrame:
    """Whitespace tokens of the (cleaned) text, case kept; null text -> []."""
    toks = T.word_tokens(text_col) if clean else T.whitespace_tokens(text_col)
    return df.withColumn(out_col, F.coalesce(toks, _empty()))


def lemma_corpus(df: DataFrame, text_col: str = "text", out_col: str = "LEMMAS",
                 flatten: bool = True) -> DataFrame:
    """All input columns plus the lemma array.

    ``flatten`` first applies the one-line ASCII cleanup that the corpus CSV
    had received before lemmatization.
    """
    src = T.ascii_text(text_col) if flatten else F.col(text_col)
    return df.withColumn(out_col, L.lemmas(src))


def lemmatize_with_dictionary(df: DataFrame, dictionary, text_col: str = "text",
                              out_col: str = "LEMMAS", flatten: bool = True) -> DataFrame:
    """Lemmas by a dictionary of (form, lemma) pairs; forms it lacks fall back to the suffix rules.

    The pairs are a part of the expression: every task probes them row by row, without a
    shuffle. A form listed more than once has its first lemma in alphabetical order.
    """
    src = T.ascii_text(text_col) if flatten else F.col(text_col)
    return df.withColumn(out_col, L.lemmas(src, L.one_lemma_per_form(dictionary)))


def lemmatize_by_join(df: DataFrame, id_col: str, dictionary: DataFrame, text_col: str = "text",
                      out_col: str = "LEMMAS", flatten: bool = True) -> DataFrame:
    """The same with a dictionary table too large for an expression.

    The distinct forms of the corpus, not its tokens, meet the dictionary; each document gets
    the map of its own forms, and its tokens are looked up in place, in their order.
    """
    src = T.ascii_text(text_col) if flatten else F.col(text_col)
    d = (dictionary.select(F.lower("form").alias("form"), F.lower("lemma").alias("lemma"))
                   .groupBy("form").agg(F.min("lemma").alias("lemma")))
    toks = df.withColumn("_toks", F.transform(F.coalesce(L.lemma_tokens_of(src), _empty()), F.lower))
    forms = toks.select(id_col, F.explode(F.array_distinct("_toks")).alias("form"))
    maps = (forms.join(d, "form").groupBy(id_col)
                 .agg(F.map_from_entries(F.collect_list(F.struct("form", "lemma"))).alias("_map")))
    found = toks.join(maps, id_col, "left")
    lemma = F.transform("_toks", lambda t: F.coalesce(F.element_at("_map", t), L.suffix_rule(t)))
    return found.withColumn(out_col, F.filter(lemma, L.keep_lemma)).drop("_toks", "_map")


def filtered_words(df: DataFrame, in_col: str = "LEMMAS", out_col: str = "words",
                   stop_words=None) -> DataFrame:
    """Stop words removed (case-insensitive), order kept."""
    return df.withColumn(out_col, remove_stop_words(F.coalesce(F.col(in_col), _empty()), stop_words))


def with_bigrams(df: DataFrame, in_col: str = "words", out_col: str = "ngrams") -> DataFrame:
    """Bigrams of the filtered words (pairs bridge removed words)."""
    return df.withColumn(out_col, bigram_expr(in_col))


def corpus_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Number of documents, of texts present and total characters."""
    return df.agg(F.count(F.lit(1)).alias("n_docs"),
                  F.count(text_col).alias("n_texts"),
                  F.sum(F.length(text_col)).alias("n_chars"))
