"""Spans of documents that an earlier document has too: the steps that substring dedup on
words and on bytes share.

The windows of k tokens of all documents are far too many to shuffle, so they are judged in
pieces (``grams.Windows``): neighbouring windows with one anchor, the least identifier of
their q-grams. Equal windows have equal anchors, so

1. anchors seen in one document only drop out (one narrow row for each piece);
2. of the other anchors, a piece whose whole sequence an earlier document has is repeated
   as one (by two 64-bit names: its anchor's and its own);
3. a piece first seen here, whose anchor has other pieces too, may share single windows with
   them: it goes to the next, larger q. At q = k a piece is one window, and nothing is left.

Documents whose whole text an earlier one has are set aside at first: a hash of each text finds
them, and their spans are one row each. ``key`` tells rows of one id apart; it is 0 where an id
has one text only, which is the rule.

Anchors and pieces are aggregated within blocks of documents before they are shuffled, so a
passage that a third of all documents share costs a row for each block; joins on anchors, which
many different pieces may share, can be split. Text moves only to meet the ranges of its own
document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import grams
from quire.llm.common import discard, forget, slices, text_key, written

#: Bytes of text that are turned into arrays at once (a longer document alone).
BLOCK_BYTES = 1 << 18
#: Rows of a batch that goes back to the JVM, which holds it outside of its heap.
OUT_ROWS = 1 << 13


@dataclass(frozen=True)
class Spec:
    """``k`` tokens a window; ``sizes``: the ascending q of the levels, the last one k."""

    words: bool
    k: int
    sizes: tuple[int, ...]

    def tokens(self, texts: list[bytes], lanes: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Token identifiers, by lane, of texts one after the other, and where each begins."""
        if not self.words:
            starts = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
            buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
            return [grams.BYTE_VALUE[i][buffer] for i in range(lanes)], starts
        starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])]).astype(np.int64)
        buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        first, last = grams.word_bounds(buffer)
        return ([grams.word_ids(buffer, first, last, i) for i in range(lanes)],
                np.searchsorted(first, starts))


#: More windows than any text has: a span to the end of the text.
WHOLE = 1 << 30


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, body): body is the text as bytes; rows without an id or text have no
    part in matches."""
    return (docs.select("doc_id", text_key().alias("text_key"), F.col("text").cast("binary").alias("body"))
            .filter("doc_id is not null and body is not null"))


def unique(rows: DataFrame) -> DataFrame:
    """Rows with one row for each join key: their hash partitions are even, whatever the other
    side's keys are, so they are built into hash tables and the other side needs no sort."""
    return rows.hint("shuffle_hash")


def at_key(body: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """``body`` joined with rows, one for each document, on (doc_id, key); texts are not sorted."""
    rows = rows.withColumnRenamed("doc_id", "_id")
    same = (F.col("doc_id") == F.col("_id")) & ((F.col("key") == 0) | (F.col("key") == F.col("text_key")))
    return body.join(unique(rows), same, how).drop("_id")


def texts_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, many) of the documents that no earlier one equals, and whole spans of the
    others; ``many`` says that their id has several texts. Equal texts are told by two hashes; the
    second begins with a literal, as one that ends with it would be a function of the first."""
    rows = docs.filter("doc_id is not null and text is not null").select(
        "doc_id", text_key().alias("key"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    rows = written(rows, "texts")
    many = rows.groupBy("doc_id").agg((F.min("h1") < F.max("h1")).alias("many"))
    first = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    rows = (rows.distinct().join(first, ["h1", "h2"]).join(many, "doc_id")
            .withColumn("key", F.when(F.col("many"), F.col("key")).otherwise(0)))
    rows = written(rows.select("doc_id", "key", "many", "first"), "firsts")
    copies = rows.filter("doc_id > first").select(
        "doc_id", "key", F.lit(0).alias("at"), F.lit(WHOLE).alias("count"), F.col("first").alias("source_id"),
        F.col("key").alias("source_key"), F.lit(0).alias("source_at"))
    return rows.filter("doc_id = first").select("doc_id", "many").distinct(), copies


def _values(column: pa.Array) -> list:
    """Python values; lists of numbers as arrays."""
    if not len(column) or not pa.types.is_list(column.type) or column.null_count or column.flatten().null_count:
        return column.to_pylist()
    return np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as Python values, a few hundred of a batch at a time."""
    forget()
    for batch in slices(batches):
        yield from zip(*(_values(c) for c in batch.columns), strict=True)


def batch_of(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names.split())


def _anchors(spec: Spec) -> Callable:
    """From (doc_id, body), for each document the anchors that it shares with another one of its
    block, and those to be looked for elsewhere: all others, and of the shared ones one mention
    for the whole block. So a passage that a third of all documents have is shuffled once for
    each block, not for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grams.blocks(rows_of(batches), lambda r: len(r[1]), BLOCK_BYTES):
            (tokens,), starts = spec.tokens([r[1] for r in part], 1)
            w = grams.Windows(tokens, starts, spec.k, spec.sizes[0], named=False)
            ids, number = np.unique(np.array([r[0] for r in part], dtype=np.int64), return_inverse=True)
            doc = number[w.documents(w.at)]
            order = np.lexsort((doc, w.anchor))
            anchor, doc = w.anchor[order], doc[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            anchor, doc = anchor[new].view(np.int64), doc[new]
            head = np.ones(len(doc), dtype=bool)
            head[1:] = anchor[1:] != anchor[:-1]
            alone = head & np.append(head[1:], True)
            rows = {}
            for name, mask in (("sought", head), ("shared", ~alone)):
                order = np.argsort(doc[mask], kind="stable")
                cuts = np.searchsorted(doc[mask][order], np.arange(len(ids) + 1))
                rows[name] = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(anchor[mask][order]))
            yield batch_of("doc_id sought shared", ids, rows["sought"], rows["shared"])

    return run


def _pieces(spec: Spec, level: int) -> Callable:
    """From (doc_id, key, body, known): on the first level the pieces with an anchor in
    ``known``, on the others all pieces of the ranges in ``at`` and ``count``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grams.blocks(rows_of(batches), lambda r: len(r[2]), BLOCK_BYTES):
            # where a piece is one window, its name is of another lane than its anchor
            single = spec.sizes[level] == spec.k
            lanes, starts = spec.tokens([r[2] for r in part], 1 + single)
            doc = np.arange(len(part))
            shift = np.zeros(len(part), dtype=np.int64) - starts[:-1]
            if level:
                at = np.concatenate([np.array(r[3], dtype=np.int64) + starts[i] for i, r in enumerate(part)])
                size = np.concatenate([np.array(r[4], dtype=np.int64) for r in part]) + spec.k - 1
                doc = np.repeat(doc, [len(r[3]) for r in part])
                low = np.concatenate([[0], np.cumsum(size)])
                take = np.arange(int(low[-1])) + np.repeat(at - low[:-1], size)
                lanes = [x[take] for x in lanes]
                shift = at - low[:-1] - starts[doc]
                starts = low
            w = grams.Windows(lanes[0], starts, spec.k, spec.sizes[level])
            if level:
                which = np.arange(len(w.at))
            else:
                known = np.unique(np.concatenate([np.array(r[3], dtype=np.int64) for r in part]))
                which = np.flatnonzero(np.isin(w.anchor.view(np.int64), known))
            if not len(which):
                continue
            second = grams.window_ids(lanes[1], spec.k, lane=1) if single else w.window
            unit = w.documents(w.at[which])
            own = doc[unit]
            ids = np.array([r[0] for r in part], dtype=np.int64)[own]
            keys = np.array([r[1] for r in part], dtype=np.int32)[own]
            at = (w.at[which] + shift[unit]).astype(np.int32)
            anchor, piece = w.anchor[which].view(np.int64), w.piece_ids(which, second, 1).view(np.int64)
            # of equal pieces in the block, all but those of the least id are repeats already
            order = np.lexsort((at, keys, ids, piece, anchor))
            head = np.ones(len(order), dtype=bool)
            head[1:] = (anchor[order][1:] != anchor[order][:-1]) | (piece[order][1:] != piece[order][:-1])
            first = order[np.flatnonzero(head)[np.cumsum(head) - 1]]  # of each row in order
            open_ = ids[order] == ids[first]
            columns = [x[order] for x in (anchor, piece, ids, keys, at, w.count[which].astype(np.int32))]
            source = [pa.array(x[first], mask=open_) for x in (ids, keys, at)]
            whole = batch_of("anchor piece doc_id key at count source_id source_key source_at", *columns, *source)
            yield from slices([whole], OUT_ROWS)

    return run


def lists(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows of a document as arrays; a document bounds their length."""
    keys = [c for c in ("doc_id", "key") if c in rows.columns]
    if len(columns) == 1:
        return rows.groupBy(*keys).agg(F.collect_list(columns[0]).alias(columns[0]))
    grouped = rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("_all"))
    return grouped.select(*keys, *(F.col(f"_all.{c}").alias(c) for c in columns))


def repeated_pieces(docs: DataFrame, spec: Spec) -> DataFrame:
    """(doc_id, key, at, count, source_id, source_key, source_at): runs of ``count`` windows from
    token ``at`` on that a document with a smaller id has too, and one place there; together they
    are all such windows."""
    body = keyed(docs)
    firsts, copies = texts_of(docs)
    anchors = written(body.select("doc_id", "body").mapInArrow(
        _anchors(spec), "doc_id long, sought array<long>, shared array<long>"), "anchors")
    # the joins ask for both columns: with the filter here, the count and the join read one exchange
    sought = (anchors.select("doc_id", F.explode("sought").alias("anchor"))
              .filter("doc_id is not null and anchor is not null").repartition("anchor"))
    twice = (sought.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
             .filter("lo < hi").select("anchor"))
    found = sought.join(unique(twice), "anchor").select("doc_id", "anchor")
    found = found.union(anchors.select("doc_id", F.explode("shared")))
    known = written(lists(found, "anchor").join(firsts, "doc_id"), "known")
    discard(anchors)
    schema = ("anchor long, piece long, doc_id long, key int, at int, count int, source_id long, source_key int, "
              "source_at int")
    columns = ["doc_id", "key", "at", "count", "source_id", "source_key", "source_at"]
    todo = body.join(unique(known), "doc_id").select("doc_id", F.expr("if(many, text_key, 0)").alias("key"), "body", "anchor")
    spans = [copies]
    for level in range(len(spec.sizes)):
        pieces = written(todo.mapInArrow(_pieces(spec, level), schema), f"pieces{level}")
        if not level:
            discard(known)
        # one exchange for the least place of each piece and for its occurrences: all reads of it
        # need the same rows and columns
        dealt = (pieces.filter("source_id is null and anchor is not null and piece is not null and doc_id is not null")
                 .selectExpr("anchor", "piece", "doc_id", "shiftleft(cast(key as long), 32) | at as place", "count")
                 .repartition("anchor", "piece"))
        first = dealt.groupBy("anchor", "piece").agg(
            F.min("doc_id").alias("first_id"), F.min_by(F.expr("place + 0 * count"), "doc_id").alias("first_place"))
        judged = dealt.join(unique(first), ["anchor", "piece"])
        repeated = F.col("first_id") < F.col("doc_id")
        at = lambda c: F.expr(f"cast({c} & 4294967295 as int)")
        key = lambda c: F.expr(f"cast(shiftright({c}, 32) as int)")
        if spec.sizes[level] == spec.k:
            judged = judged.filter(repeated)
        else:
            # pieces first seen here that differ from another document's with the same anchor
            spread = (first.groupBy("anchor").agg(((F.min("first_id") < F.max("first_id"))
                                                   & F.min("first_place").isNotNull()).alias("open"))
                      .filter("open").select("anchor"))
            opened = first.join(unique(spread), "anchor").select(
                "anchor", "piece", F.expr("first_id is not null and first_place is not null").alias("open"))
            judged = judged.join(unique(opened), ["anchor", "piece"], "left").filter(repeated | F.col("open"))
        out = judged.select("doc_id", key("place").alias("key"), at("place").alias("at"), "count",
                            *(F.when(repeated, c).alias(f"source_{n}") for c, n in (
                                (F.col("first_id"), "id"), (key("first_place"), "key"), (at("first_place"), "at"))))
        out = out.unionByName(pieces.filter("source_id is not null").select(columns))
        out = written(out, f"judged{level}")
        discard(pieces)
        spans.append(out.filter("source_id is not null"))
        if spec.sizes[level] != spec.k:
            ranges = lists(out.filter("source_id is null"), "at", "count")
            todo = at_key(body, ranges).select("doc_id", "key", "body", "at", "count")
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def covered(at: list[int], count: list[int], k: int, n_tokens: int) -> list[tuple[int, int]]:
    """Maximal [begin, end) of tokens under runs of windows, ascending."""
    if not at or n_tokens < k:
        return []
    low = np.array(at, dtype=np.int64)
    high = low + np.array(count, dtype=np.int64) + (k - 1)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.minimum(np.maximum.accumulate(high[order]), n_tokens)
    new = np.ones(len(low), dtype=bool)
    new[1:] = low[1:] > high[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(low)) - 1
    return list(zip(low[begin].tolist(), high[end].tolist(), strict=True))
