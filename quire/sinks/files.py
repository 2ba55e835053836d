"""File sinks: parquet, prediction CSV, labelled CSV, sentence text, submission."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from quire.session import scratch_path

# Spark's CSV writer trims values by default; texts keep their spaces
KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite a parquet data set."""
    df.write.mode("overwrite").parquet(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "ISIN",
                      label_col: str = "predictedCategory") -> None:
    """Headerless ``"id","label"`` lines, every field quoted, overwrite."""
    (df.select(F.col(id_col).cast("string"), F.col(label_col).cast("string"))
       .write.mode("overwrite").option("header", False).option("quoteAll", True)
       .options(**KEEP_SPACES).csv(path))


def _quoted(c) -> Column:
    """A CSV field in quotes, inner quotes doubled; null is an empty field."""
    return F.coalesce(F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


def csv_lines(df: DataFrame) -> Column:
    """The rows as CSV lines: strings in quotes, numbers bare."""
    fields = [F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")) if isinstance(f.dataType, NumericType)
              else _quoted(F.col(f"`{f.name}`")) for f in df.schema.fields]
    return F.concat_ws(",", *fields)


def csv_header(df: DataFrame) -> str:
    return ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)


def write_labeled_csv(df: DataFrame, path: str) -> None:
    """Labelled corpus as CSV part files, each with a header: names and strings in quotes (inner
    quotes doubled, so readers with escape='"' undo them), numbers bare. A partition is one file
    whatever ``spark.sql.files.maxRecordsPerFile`` says, so that no file is without a header."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its partition, so of its file
    lines = df.select(csv_lines(df).alias("value"))
    header = F.lit(csv_header(df) + "\n")
    (lines.select(F.when(first, F.concat(header, "value")).otherwise(F.col("value")).alias("value"))
          .write.mode("overwrite").option("maxRecordsPerFile", 0).text(path))


def write_sentences(sents: DataFrame, path: str, col: str = "sentence") -> None:
    """One sentence per line."""
    sents.select(col).write.mode("overwrite").text(path)


def submission_name(results_dir: str) -> str:
    """File name for the submission of a results folder: its path, ``/`` as ``_``. The root of an
    absolute path is left out: readers skip files whose names begin with ``_``."""
    return re.sub(r"^(\w+:)?/*|/*$", "", results_dir).replace("/", "_") + ".csv"


def submission_lines(sub: DataFrame) -> Column:
    """The rows as CSV lines: id and label in quotes, empty fields bare."""
    return F.concat_ws(",", *(
        F.when(F.col(f"`{f.name}`") == "", "").otherwise(_quoted(F.col(f"`{f.name}`"))) if not isinstance(f.dataType, NumericType)
        else F.col(f"`{f.name}`").cast("string") for f in sub.schema.fields))


def write_submission_parts(sub: DataFrame, path: str) -> None:
    """The submission table as part files whose names are in the order of the ids; the first one begins
    with the header. Rows are dealt by ranges of ids and written where they are sorted; Spark's commit
    makes the files visible when all tasks have ended, so a failed task leaves none of its rows.
    """
    header = sub.sparkSession.range(1).select(F.lit(0).alias("_place"), F.lit("").alias("ISIN"), F.lit(csv_header(sub)).alias("value"))
    rows = sub.select(F.lit(1).alias("_place"), "ISIN", submission_lines(sub).alias("value"))
    (header.unionByName(rows).repartitionByRange("_place", "ISIN").sortWithinPartitions("_place", "ISIN")
           .select("value").write.mode("overwrite").option("maxRecordsPerFile", 0).text(path))


def write_submission(sub: DataFrame, file: str) -> None:
    """The submission table as one CSV file: quoted header, id and label in quotes, empty fields
    bare, sorted by id.

    The rows are sorted and written by many tasks, in parts in the order of the ids; the parts are
    then copied into the one file that the format demands, as streams, by this process:
    ``write_submission_parts`` is the form for large tables.
    """
    spark = sub.sparkSession
    lines = sub.orderBy("ISIN").select(submission_lines(sub).alias("value"))
    parts = scratch_path(spark, "submission")
    lines.write.text(parts)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, target = hadoop.fs.Path(parts), hadoop.fs.Path(file)
    files = source.getFileSystem(conf)
    out = target.getFileSystem(conf).create(target, True)
    try:
        out.write(bytearray((csv_header(sub) + "\n").encode()))
        for name in sorted(f.getPath().getName() for f in files.listStatus(source)):
            if name.startswith("part"):
                part = files.open(hadoop.fs.Path(source, name))
                try:
                    hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
    finally:
        out.close()


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, for printing."""
    return df.limit(n)
