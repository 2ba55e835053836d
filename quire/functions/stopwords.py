"""Stop-word lists and the row-local stop-word filter.

The default list is built from a rule, not typed in: the union of the stop-word
lists that Spark ML ships for the six languages of the corpus. A user who has
their own list (one word per line) passes it with ``load_stop_words``.
"""

from __future__ import annotations

import functools
import zipfile
from pathlib import Path

import pyspark
from pyspark import SparkContext
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DEFAULT_LANGUAGES = ("english", "dutch", "german", "french", "spanish", "italian")


def _bundled(lang: str) -> list[str]:
    """Spark's own list. Without a session (SQL twins are made without one) it is read from the
    jar that it is bundled in."""
    if SparkContext._active_spark_context is not None:
        return StopWordsRemover.loadDefaultStopWords(lang)
    jar = next((Path(pyspark.__file__).parent / "jars").glob("spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as z:
        return z.read(f"org/apache/spark/ml/feature/stopwords/{lang}.txt").decode().splitlines()


@functools.lru_cache(maxsize=None)
def default_stop_words(languages: tuple[str, ...] = DEFAULT_LANGUAGES) -> tuple[str, ...]:
    """Sorted, lower-case union of Spark's bundled lists for ``languages``."""
    words = {w.strip().lower() for lang in languages for w in _bundled(lang)}
    return tuple(sorted(words - {""}))


def load_stop_words(spark: SparkSession, path: str) -> tuple[str, ...]:
    """A stop list file anywhere Spark reads, one word per line; blank lines ignored. A list is a
    part of the expressions it filters, so the driver holds it."""
    words = spark.read.text(path).select(F.lower(F.trim("value")).alias("w")).filter("w <> ''").distinct()
    return tuple(sorted(r.w for r in words.collect()))


def remove_stop_words(tokens, stop_words=None) -> Column:
    """Drop tokens whose lower-case form is a stop word (case-insensitive).

    ``lower(t) IN (...)`` is rewritten by the optimizer into a hash-set
    lookup, so the cost per token does not grow with the list.
    """
    words = list(stop_words if stop_words is not None else default_stop_words())
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    if not words:
        return col
    return F.filter(col, lambda t: ~F.lower(t).isin(words))
