"""quire: a Spark-native engine for classifying large document corpora.

Every operator is a function DataFrame -> DataFrame (or a Column expression),
so Catalyst sees one plan from the parquet scan to the last aggregate.
"""

import sys

from pyspark import cloudpickle

from quire.session import checkpoint_dir, get_spark, read_table

__all__ = ["checkpoint_dir", "get_spark", "read_table"]

# Functions that run in tasks travel with the job, by value: executors need numpy and pyarrow, but not this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
