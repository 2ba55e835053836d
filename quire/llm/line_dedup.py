"""Line dedup by winnowing over line hashes.

Of each window of ``WINDOW`` consecutive lines (blank ones do not count) the least line hash is
the window's fingerprint, the rightmost one of equals. Every run of at least ``WINDOW`` equal lines
therefore shares a fingerprint wherever it stands, and neighbouring windows mostly share theirs.

Fingerprints that occur once drop out. Every window whose fingerprint is a common one carries a
digest of its lines, and windows are grouped by digest; this takes the place of joining the
positions of fingerprints and extending matches from them, which would pair the copies of a passage
that many documents share. A window that stands earlier, too (in a smaller id, or before in the same document), is a
repeat; overlapping repeats make runs, and the lines of the runs are deleted. A hash that a third
of all lines have costs one row for each task before the shuffle, and windows are grouped by what
they hold, never paired.

Two shorter runs count as well, each its own fingerprint: a line of at least ``LONG`` words, as a
line may be a whole paragraph; and all lines of a text that has fewer than a window, where an
earlier text consists of the same ones.

Edge cases: a null text or id keeps its lines and is nobody's earlier copy; blank lines stay; equal rows of one id are one document; other
columns are passed on where asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import repeats
from quire.llm.common import documents, result, slices, text_key, written

#: Consecutive lines of a window, and so the shortest run of short lines that is deleted.
WINDOW = 3
#: Words of a line that is a run by itself.
LONG = 50


def split_lines(body: bytes) -> tuple[list[bytes], list[int]]:
    """All lines, and the numbers of those that are not blank."""
    lines = body.split(b"\n")
    return lines, [i for i, x in enumerate(lines) if x.strip(b" \t\n\r\x0b\x0c")]


def fingerprints(digests: list[bytes], window: int) -> list[int]:
    """For each window of digests the number of its least one, the rightmost of equals."""
    out, at = [], -1
    for start in range(len(digests) - window + 1):
        end = start + window
        if at < start:  # the last choice has left the window
            at = min(range(start, end), key=lambda i: (digests[i], -i))
        elif digests[end - 1] <= digests[at]:
            at = end - 1
        out.append(at)
    return out


def _digest(lines: list[bytes], kind: bytes) -> bytes:
    return hashlib.blake2b(b"".join(lines), digest_size=16, person=kind).digest()


def runs(lines: list[bytes], window: int, long: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(first line, lines, mark, digest) of all runs of the lines, none of them blank, that are
    deleted where they stand earlier: marked windows, long lines, and a short text as a whole."""
    digests = [_digest([x], b"line") for x in lines]
    for start, at in enumerate(fingerprints(digests, window)):
        yield start, window, digests[at], _digest(digests[start:start + window], b"window")
    for start, line in enumerate(lines):
        if len(line.split()) >= long:
            yield start, 1, digests[start], digests[start]
    if 0 < len(lines) < window:
        whole = _digest(digests, b"text")
        yield 0, len(lines), whole, whole


def _windows(window: int, long: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, key, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines, full = split_lines(body)
                for start, count, mark, whole in runs([lines[i] for i in full], window, long):
                    rows.append((int.from_bytes(mark[:8], "little", signed=True), whole, doc_id, key, start, count))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                list(zip(*rows, strict=True)) or [[]] * 6, kinds, strict=True)], ["mark", "whole", "doc_id", "key", "at", "count"])

    return run


def repeated_runs(docs: DataFrame, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """(doc_id, key, at, count): runs of ``count`` lines, by the number of their first line that is
    not blank, that stand earlier, too."""
    body = repeats.keyed(docs).select("doc_id", F.col("text_key").alias("key"), "body")
    rows = written(body.mapInArrow(_windows(window, long), "mark long, whole binary, doc_id long, key int, at int, count int"), "windows")
    common = rows.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    rows = rows.join(repeats.unique(common), "mark").drop("mark")
    first = rows.groupBy("whole").agg(F.min(F.struct("doc_id", "key", "at")).alias("first"), F.count("*").alias("n"))
    later = rows.join(repeats.unique(first.filter("n > 1")), "whole").filter(F.struct("doc_id", "key", "at") > F.col("first"))
    return written(later.select("doc_id", "key", "at", "count"), "later")


def _cut(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for body, at, count in zip(*(c.to_pylist() for c in batch.columns[-3:]), strict=True):
                lines, full = split_lines(body or b"")
                cut = repeats.covered(at or [], count or [], 1, len(full))
                gone = {full[i] for begin, end in cut for i in range(begin, end)}
                text = b"\n".join(x for i, x in enumerate(lines) if i not in gone)
                rows.append((None if body is None else text.decode(), len(full), len(gone), len(cut),
                             hashlib.sha256(text).hexdigest()))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            made = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *made],
                                             [*names, "text", "n_lines", "n_removed", "n_runs", "kept_sha256"])

    return run


def line_dedup(docs: DataFrame, window: int = WINDOW, columns: tuple[str, ...] = ("doc_id",), long: int = LONG) -> DataFrame:
    """``columns``, and (text, n_lines, n_removed, n_runs, kept_sha256): the text without the lines
    of later repeated runs, how many lines that are not blank it had and lost, and in how many runs."""
    places = repeats.lists(repeated_runs(docs, window, long), "at", "count")
    kept = [F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]
    body = docs.select(*kept, "doc_id", text_key().alias("text_key"), F.col("text").cast("binary").alias("body"))
    joined = repeats.at_key(body, places, "left").select(*(f"_{i}" for i in range(len(columns))), "body", "at", "count")
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    return joined.mapInArrow(_cut(list(columns)), ", ".join(
        [*fields, "text string, n_lines long, n_removed long, n_runs long, kept_sha256 string"]))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(lambda: line_dedup(documents(spark, sf_dir)).drop("text"), "op2")
