"""Incremental batch scoring with Structured Streaming.

The batch scoring job (load a fitted pipeline, transform a corpus, keep
``(id, predictedCategory)``) applied to documents as they land in a folder.
There is no state: each micro-batch is an ordinary row-local transform, and the
checkpoint in the shared folder makes the file sink exactly-once across
restarts and lost executors.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quire.operators.corpus import lemma_corpus
from quire.session import checkpoint_dir


def scoring_stream(spark: SparkSession, source_dir: str, schema: StructType | str,
                   model: PipelineModel, id_col: str = "doc_id", text_col: str = "text",
                   max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming DataFrame of (id, predictedCategory) for parquet files in ``source_dir``."""
    docs = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(source_dir))
    return model.transform(lemma_corpus(docs, text_col)).select(id_col, "predictedCategory")


def start_scoring(stream: DataFrame, out_dir: str, name: str = "scoring",
                  available_now: bool = False) -> StreamingQuery:
    """Write the scores as parquet; checkpoint kept under the shared folder."""
    spark = stream.sparkSession
    w = (stream.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", f"{checkpoint_dir(spark)}/streams/{name}")
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
