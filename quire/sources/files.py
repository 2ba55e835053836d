"""File sources: CSV corpora, label files, raw text files, prediction parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.operators.corpus import labeled_corpus, unlabeled_corpus

CORRUPT = "_corrupt_record"
NO_NULL_MARKER = "\u0000"


def read_csv_corpus(spark: SparkSession, path, schema: StructType | str | None = None,
                    multi_line: bool = False) -> DataFrame:
    """Header CSV; doubled quotes inside quoted fields are undone (``escape='"'``).

    Give a ``schema`` in production: inference costs an extra pass over the data. Flattened
    texts have no line breaks, so files are split among tasks; ``multi_line`` reads quoted
    line breaks, with one task per file.
    """
    # the writer puts null as an unquoted empty field and "" as a quoted one;
    # with no null marker text of its own the reader keeps that distinction
    r = (spark.read.option("header", True).option("escape", '"')
         .option("nullValue", NO_NULL_MARKER).option("multiLine", multi_line))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_labeled_corpus(spark: SparkSession, label_col: str, path, text_col: str = "TEXT",
                        schema: StructType | str | None = None) -> DataFrame:
    """(category, text) from a labelled corpus CSV."""
    return labeled_corpus(read_csv_corpus(spark, path, schema), label_col, text_col)


def read_unlabeled_corpus(spark: SparkSession, path, id_col: str = "ISIN", text_col: str = "TEXT",
                          schema: StructType | str | None = None) -> DataFrame:
    """(isin, text) from an unlabelled corpus CSV."""
    return unlabeled_corpus(read_csv_corpus(spark, path, schema), id_col, text_col)


def read_text_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line (``value``)."""
    return spark.read.text(path)


def read_whole_texts(spark: SparkSession, dirs, pattern: str = "*.txt") -> DataFrame:
    """(docid, text): one row per file of the given directories, the file stem as id."""
    paths = [dirs] if isinstance(dirs, str) else list(dirs)
    df = (spark.read.option("pathGlobFilter", pattern)
          .text(paths, wholetext=True).select("value", "_metadata.file_name"))
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    return df.select(stem.alias("docid"), F.col("value").alias("text"))


def with_position(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``position``, which orders the rows of a file source as they stand: by file
    name (files of one name in several folders by path), then place in the file. Rows of a block are read in order by one task, so their
    increasing ids compare; ids of different blocks or files do not."""
    place = F.struct(F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.select(*(columns or ["*"]), place.alias("position"))


def read_label_file(spark: SparkSession, path, schema: StructType | str) -> DataFrame:
    """A label CSV with header and an explicit schema, and each row's ``position``."""
    return with_position(spark.read.option("header", True).option("escape", '"').schema(schema).csv(path))


def read_predictions(spark: SparkSession, path, id_col: str = "isin",
                     label_col: str = "label") -> DataFrame:
    """(isin, label, position) from headerless ``part*`` files.

    With ``position`` "the last line of the last file wins" is ``last_per_key``.
    """
    df = (spark.read.schema(f"{id_col} string, {label_col} string")
          .option("pathGlobFilter", "part*").csv(path))
    return with_position(df, id_col, label_col)


def malformed_rows(spark: SparkSession, path, schema: StructType | str) -> DataFrame:
    """(line): the lines of a CSV, its header excepted, that do not parse into ``schema``: too few
    or too many fields, or a value of another type."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*fields.fields, StructField(CORRUPT, StringType())])
    lines = with_position(spark.read.text(path), "value")
    first = lines.groupBy("position.file_path").agg(F.min("position").alias("first"))
    parsed = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields),
                        {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.withColumn("row", parsed)
    header = lines.join(first, F.col("position") == F.col("first"), "left_semi").select("position")
    return (rows.filter(F.col(f"row.{CORRUPT}").isNotNull()).join(header, "position", "left_anti")
                .select(F.col("value").alias("line")))
