"""Substring dedup on words over a De Bruijn graph of word k-mers.

Each window of ``k`` consecutive words is an edge between its first and its last k - 1
words. The graph of a corpus is mostly paths that one document alone walks; what several
documents walk are long paths without a branch, for each copied passage one. So

* edges are gathered into path pieces (neighbouring edges with one minimizer), pieces whose
  minimizer only one document has drop out, and a repeated piece without another piece at
  the same minimizer is a nonbranching path: it is judged as one row, by a join on its
  identifier;
* where pieces branch (same minimizer, different words around it) they are taken apart into
  their single edges, which are judged one by one;
* neighbouring pieces of one document with the same source path compact into long spans, and
  each span is verified at its source coordinates: both places are read and the words
  compared by a digest of their bytes.

Edge cases: a null text or id has no words removed and is no source; a text of fewer than
``k`` words has no edge; rows of one id never take words from each other; repeated rows are
judged alike and each is returned; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import repeats
from quire.llm.common import documents, result, slices, text_key, written

#: Words of a window.
K = 13
#: Words of a minimizer; it only decides how edges are gathered.
Q = 7


def repeated_spans(docs: DataFrame, k: int = K, q: int = Q) -> DataFrame:
    """(doc_id, key, at, count, source_id, source_key, source_at): spans of ``count`` windows
    from word ``at`` on that an earlier document has from word ``source_at`` on."""
    pieces = repeats.repeated_pieces(docs, repeats.Spec(True, k, (min(q, k), k) if q < k else (k,)))
    # pieces of one document that continue each other at the source compact into one span
    path = ["doc_id", "key", "source_id", "source_key", (F.col("source_at") - F.col("at")).alias("lag")]
    runs = pieces.distinct().select(*path, "at", "count")
    w = Window.partitionBy("doc_id", "key", "source_id", "source_key", "lag").orderBy("at")
    ends = F.max(F.col("at") + F.col("count")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(F.col("at") <= ends, 0).otherwise(1)
    spans = (runs.withColumn("_run", opened).withColumn("_run", F.sum("_run").over(w))
             .groupBy("doc_id", "key", "source_id", "source_key", "lag", "_run")
             .agg(F.min("at").alias("at"), F.max(F.col("at") + F.col("count")).alias("end")))
    return written(spans.select("doc_id", "key", "at", (F.col("end") - F.col("at")).alias("count"), "source_id",
                                "source_key", (F.col("at") + F.col("lag")).alias("source_at")), "spans")


_PLACE = ["doc_id", "key", "at", "count"]


def _digests(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, key, body, at, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = body.split()
                for a, n in zip(at, count, strict=True):
                    text = b" ".join(words[a:a + n + k - 1])
                    rows.append((doc_id, key, a, n, hashlib.blake2b(text, digest_size=16).digest()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                list(zip(*rows, strict=True)) or [[]] * 5, kinds, strict=True)], [*_PLACE, "digest"])

    return run


def verified(docs: DataFrame, spans: DataFrame, k: int = K) -> DataFrame:
    """The spans whose words at the source coordinates are the same. A place that many spans
    have as their source is read once."""
    there = spans.select(F.col("source_id").alias("doc_id"), F.col("source_key").alias("key"),
                         F.col("source_at").alias("at"), "count")
    places = repeats.lists(spans.select(_PLACE).union(there).distinct(), "at", "count")
    read = (repeats.at_key(repeats.keyed(docs), places).select("doc_id", "key", "body", "at", "count")
            .mapInArrow(_digests(k), "doc_id long, key int, at int, count int, digest binary")
            .groupBy(_PLACE).agg(F.min("digest").alias("digest")))  # equal rows have equal places
    read = written(read, "digests")
    source = read.select(*(F.col(c).alias(f"source_{c.removeprefix('doc_')}") for c in _PLACE[:3]), "count",
                         F.col("digest").alias("source_digest"))
    return (spans.join(repeats.unique(read), _PLACE)
            .join(repeats.unique(source), ["source_id", "source_key", "source_at", "count"])
            .filter("digest = source_digest").select(spans.columns))


def _cut(k: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, body, at, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (body or b"").split()
                removed = repeats.covered(at or [], count or [], k, len(words))
                kept, last = [], 0
                for begin, end in removed:
                    kept += words[last:begin]
                    last = end
                kept += words[last:]
                text = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), len(removed),
                             text.decode() if body is not None and with_text else None, hashlib.sha256(text).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["doc_id", "n_words", "n_removed", "n_spans", "text", "kept_sha256"])

    return run


def substring_dedup(docs: DataFrame, k: int = K, q: int = Q, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, text, kept_sha256): ``text`` is the kept words
    joined by one space (null where it is not asked for)."""
    spans = verified(docs, repeated_spans(docs, k, q), k)
    places = repeats.lists(spans, "at", "count")
    body = docs.select("doc_id", text_key().alias("text_key"), F.col("text").cast("binary").alias("body"))
    return (repeats.at_key(body, places, "left").select("doc_id", "body", "at", "count")
            .mapInArrow(_cut(k, with_text), "doc_id long, n_words long, n_removed long, n_spans long, text string, "
                                 "kept_sha256 string"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(lambda: substring_dedup(documents(spark, sf_dir), with_text=False).drop("text", "n_spans"), "op1")
