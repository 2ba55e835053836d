"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the
shared folder and read again as the next one's ``docs``. All but the last return the columns of
``documents``, ``n_chars`` for the text as it then is.

Edge cases are those of the operators: the first stage drops documents without letters, null
texts included; line dedup drops documents all of whose lines stand earlier; of documents with one
id one stays in near-dedup; the mix repeats documents; an empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import bpe, language_id, line_dedup, mixing, near_dedup
from quire.llm.common import documents, result, text_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The stages have no SQL twin: language ID and mixing are learned and drawn.
ORACLE_SQL = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a model of their own labels can tell."""
    model = language_id.fit(docs, language_id.learn_from())
    return language_id.predict(docs, model, COLUMNS).filter("not reject").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of runs that stand earlier; what has no other line goes."""
    def kept() -> DataFrame:
        rows = line_dedup.line_dedup(docs, columns=("doc_id", "lang", "source")).filter("n_lines = 0 or n_removed < n_lines")
        return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)

    return result(kept, "lines")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    kept = result(lambda: near_dedup.near_dedup(docs).filter("kept").select("doc_id").distinct(), "near")
    one = Window.partitionBy("doc_id").orderBy("_key", "source", "lang")
    rows = docs.select(*COLUMNS, text_key().alias("_key"))
    known = (rows.join(kept, "doc_id", "left_semi").withColumn("_n", F.row_number().over(one))
             .filter("_n = 1").select(*COLUMNS))
    return known.unionByName(rows.filter("doc_id is null").select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document of the mix, by encoding and decoding it."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", languages), ("line_dedup", lines), ("near_dedup", near), ("mixing", mix), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = result(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
