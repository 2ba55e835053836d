"""Word vectors from co-occurrence counts: windowed pairs, pointwise mutual information, and the
leading eigenvectors of that matrix by block power iteration.

Every step is an aggregate or a join: pairs are counted in each task before they are shuffled, the
matrix is a table of its positive entries, and a step of the iteration joins it with the current
vectors and adds up by word. The driver holds ``size`` by ``size`` matrices, and tables of words up to
``MAX_BROADCAST_BYTES``.

Where the vocabulary is that small, words are numbered and pairs are numbers, of which a row holds many (``PairSums``):
tasks sort and add them up as arrays, and Spark deals them out by the part of the numbers that a row is of.

Edge cases: documents without known words, and vocabularies without pairs, have no rows; a word next to
itself counts in both directions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.numbering import row_numbers, split_repeated
from quire.operators.vectors import WINDOW_SIZE
from quire.session import scratch_path


#: Tables of words, and vectors by word, are sent to every task up to so many bytes.
MAX_BROADCAST_BYTES = 64 << 20
#: Pairs that a task counts at once, and documents whose tokens it turns into numbers at once.
PAIRS_AT_ONCE = 1 << 24
DOCS_AT_ONCE = 1000
#: Pairs of the text that are summed in one task at most, on average, and fewest that are worth one.
PAIRS_A_PART = 1 << 24
FEWEST_A_PART = 1 << 18
#: Pairs in a written row, about.
PAIRS_A_ROW = 1 << 16
#: Sorted numbers of one part: their low bits and counts as arrays of the narrowest unsigned type.
PACKED = "part int, size int, key binary, n binary"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _listed(vocab: DataFrame) -> tuple[list[str], int | None] | None:
    """The distinct words of the vocabulary, if they are few enough to be sent, and the number of tokens that they are.
    Frequent words come first where the vocabulary counts them: what is looked up most lies together."""
    counted = "n" in vocab.columns
    words = vocab.filter("word is not null").groupBy("word").agg((F.sum("n") if counted else F.lit(None)).cast("long").alias("n"))
    words = _kept(words, "words")
    size = words.agg(F.coalesce(F.sum(F.octet_length("word") + 16), F.lit(0))).first()[0]
    if size > MAX_BROADCAST_BYTES:
        return None
    rows = words.collect()
    return sorted((r.word for r in rows), key={r.word: (-(r.n or 0), r.word) for r in rows}.get), sum(r.n or 0 for r in rows) if counted else None


def _numbers(tokens: pa.Array, words: pa.Array) -> np.ndarray:
    """The place of each token among the words, -1 if it has none."""
    coded = tokens.dictionary_encode()
    of = np.append(pc.index_in(coded.dictionary, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False), -1).astype(np.int64)
    return of[coded.indices.fill_null(len(of) - 1).to_numpy(zero_copy_only=False)]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            yield batch.slice(at, DOCS_AT_ONCE)


def _only(sent):
    """Rows (id, tokens) with the tokens that are listed, without rows that have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(sent.value, pa.string())
        for batch in _parts(batches):
            ids, lists = batch.columns
            flat = lists.flatten()
            known = _numbers(flat, words) >= 0
            count = np.bincount(pc.list_parent_indices(lists).to_numpy()[known], minlength=len(lists))
            some = pa.array(count > 0)
            offsets = np.concatenate([[0], np.cumsum(count[count > 0])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(known)))
            yield pa.RecordBatch.from_arrays([ids.filter(some), tokens], batch.schema.names)
    return run


def known_tokens(doc_tokens: DataFrame, id_col: str, vocab: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(id, tokens): the tokens that the vocabulary (word, ..) has, in their order. A vocabulary of
    bounded size is sent to the tasks, which filter their documents in place. Of a larger one, and for ids that
    several rows have, tokens meet the vocabulary word by word."""
    listed = _listed(vocab)
    here, joined = (doc_tokens.filter("false"), doc_tokens) if listed is None else split_repeated(doc_tokens, id_col)
    rows = here.select(id_col, F.col(tokens_col).alias(tokens_col))
    out = None
    if listed is not None:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        out = rows.mapInArrow(_only(rows.sparkSession.sparkContext.broadcast(listed[0])), fields)
    if joined is not None:
        rows = joined.select(id_col, F.posexplode_outer(tokens_col).alias("pos", "word")).filter("word is not null")
        kept = rows.join(vocab.select("word"), "word").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_t"))
        kept = kept.select(id_col, F.col("_t.word").alias(tokens_col))
        out = kept if out is None else out.unionByName(kept)
    return out


# ---- many numbers in a row ------------------------------------------------------

def _odd(bits: int) -> int:
    return int((1 << bits) * 0.6180339887498949) | 1


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of so many bits in another order, in which leading bits deal them evenly: times an odd number."""
    return x * np.uint64(_odd(bits)) & np.uint64((1 << bits) - 1)


def _unmixed(x: np.ndarray, bits: int) -> np.ndarray:
    return x * np.uint64(pow(_odd(bits), -1, 1 << bits)) & np.uint64((1 << bits) - 1)


def _width(n_words: int) -> int:
    """Bits of a word's number."""
    return max(n_words - 1, 1).bit_length()


def _starts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, dtype=np.int64)


def _narrow(x: np.ndarray) -> bytes:
    return x.astype(np.min_scalar_type(int(x.max()))).tobytes()


def _packed(keys: np.ndarray, n: np.ndarray, low: int) -> pa.RecordBatch:
    """Sorted keys and their counts, a row for each part: the bits above the ``low`` ones."""
    first, last = (int(k) >> low for k in (keys[0], keys[-1]))
    at = np.searchsorted(keys, np.arange(first, last + 2, dtype=np.uint64) << np.uint64(low))
    parts = [(part, i, j) for part, i, j in zip(range(first, last + 1), at, at[1:]) if j > i]
    keys = keys & np.uint64((1 << low) - 1)
    columns = ([x[0] for x in parts], [int(j - i) for _, i, j in parts], [_narrow(keys[i:j]) for _, i, j in parts], [_narrow(n[i:j]) for _, i, j in parts])
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "size", "key", "n"])


def _unpacked(batch: pa.RecordBatch, low: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of each row."""
    for part, size, *cells in zip(*batch.columns):
        key, n = (np.frombuffer(c.as_buffer(), f"u{c.as_buffer().size // size.as_py()}") for c in cells)
        yield key.astype(np.uint64) | np.uint64(part.as_py() << low), n.astype(np.int64)


def _merged(low: int, whole: int = 0):
    """A partition's keys in order, counts of equal ones added up, in rows of about ``PAIRS_A_ROW``; keys that are equal
    but for the ``whole`` lowest bits come in one row."""
    most = PAIRS_A_ROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for batch in batches for x in _unpacked(batch, low)]
        if held:
            keys, n = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(keys, kind="stable")  # sorted runs are merged
            keys, n = keys[order], n[order]
            starts = _starts(keys)
            keys, n = keys[starts], np.add.reduceat(n, starts)
            starts = _starts(keys >> np.uint64(whole))
            ends = starts[np.minimum(np.searchsorted(starts, np.arange(most, len(keys), most)), len(starts) - 1)]
            cuts = np.unique(np.concatenate([[0], ends, [len(keys)]]))
            for i, j in zip(cuts, cuts[1:]):
                yield _packed(keys[i:j], n[i:j], low)
    return run


def _parts_for(spark: SparkSession, n: int, bits: int) -> int:
    """The base-2 logarithm of the number of parts for ``n`` pairs."""
    few = min(2 * spark.sparkContext.defaultParallelism, -(-n // FEWEST_A_PART))
    return min(bits, (max(few, -(-n // PAIRS_A_PART), 1) - 1).bit_length())


def _dealt(packed: DataFrame, parts: int, low: int, whole: int = 0) -> DataFrame:
    return packed.repartitionById(1 << parts, F.col("part")).mapInArrow(_merged(low, whole), PACKED)


# ---- pairs ------------------------------------------------------------------------

def _pair_counts(sent, window: int, low: int):
    """Counts of the unordered pairs in the rows' token lists, made in blocks and packed: the key of the
    words numbered a <= b has a's bits before b's, and is mixed."""
    def counted(keys: np.ndarray) -> pa.RecordBatch:
        keys.sort()
        starts = _starts(keys)
        return _packed(keys[starts], np.diff(starts, append=len(keys)), low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(sent.value, pa.string())
        width = _width(len(words))
        held, size = np.empty(PAIRS_AT_ONCE, dtype=np.uint64), 0
        for batch in _parts(batches):
            lists = batch.column(0)
            ids, doc = _numbers(lists.flatten(), words), pc.list_parent_indices(lists).to_numpy()
            for d in range(1, window + 1):
                a, b = ids[:-d], ids[d:]
                both = (doc[:-d] == doc[d:]) & (a >= 0) & (b >= 0)  # an unlisted token keeps its place
                a, b = a[both], b[both]
                keys = _mixed((np.minimum(a, b) << width | np.maximum(a, b)).astype(np.uint64), 2 * width)
                while len(keys):
                    some = keys[:len(held) - size]
                    held[size:size + len(some)] = some
                    size, keys = size + len(some), keys[len(some):]
                    if size == len(held):
                        yield counted(held)
                        size = 0
        if size:
            yield counted(held[:size])
    return run


def _both_ways(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, n) of unordered pairs, in both directions."""
    other = a != b
    return np.concatenate([a, b[other]]), np.concatenate([b, a[other]]), np.concatenate([np.where(other, n, 2 * n), n[other]])


class PairSums(NamedTuple):
    """Counts of unordered pairs of numbered words: rows of ``PACKED``, the words by number, and the base-2 logarithm of
    the number of parts."""
    sums: DataFrame
    words: Broadcast
    parts: int

    @property
    def width(self) -> int:
        return _width(len(self.words.value))

    def mapped(self, make: Callable, schema: str) -> DataFrame:
        """A batch for each row, by a function of its arrays a, b and n, which ``make()`` makes once in a task."""
        pairs = self.reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of = make()
            for a, b, n in pairs(batches):
                yield of(a, b, n)
        return self.sums.mapInArrow(run, schema)

    def reader(self) -> Callable:
        """For tasks: the arrays a, b and n of each row of batches of ``sums``."""
        width, low = self.width, 2 * self.width - self.parts

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for batch in batches:
                for keys, n in _unpacked(batch, low):
                    keys = _unmixed(keys, 2 * width).astype(np.int64)
                    yield keys >> width, keys & (1 << width) - 1, n
        return pairs

    def rows(self) -> DataFrame:
        """(word, context, n)."""
        sent = self.words

        def make() -> Callable:
            words = pa.array(sent.value, pa.string())

            def of(a, b, n):
                x, y, m = _both_ways(a, b, n)
                return pa.RecordBatch.from_arrays([words.take(pa.array(x)), words.take(pa.array(y)), pa.array(m)], ["word", "context", "n"])
            return of
        return self.mapped(make, "word string, context string, n long")

    def margins(self) -> np.ndarray:
        """Each word's pairs, in both directions."""
        n_words, pairs = len(self.words.value), self.reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n_words)  # whole numbers, exact up to 2 ** 53
            for a, b, n in pairs(batches):
                total += np.bincount(a, n, n_words)
                total += np.bincount(b, n, n_words)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].astype(np.int64))], ["i", "m"])
        found = self.sums.mapInArrow(run, "i long, m long").groupBy("i").agg(F.sum("m").alias("m")).toArrow()
        out = np.zeros(n_words, dtype=np.int64)
        out[found["i"].to_numpy()] = found["m"].to_numpy()
        return out


def pair_sums(doc_tokens: DataFrame, window: int = WINDOW_SIZE, tokens_col: str = "tokens", vocab: DataFrame | None = None,
              keep: bool = True) -> PairSums | DataFrame:
    """The counts of ``cooccurrence``, numbered; (word, context, n) if the vocabulary (word, ..) is too large to be sent.
    ``vocab`` has all words of the tokens; its counts ``n``, if it has them, tell how many parts to make. ``keep`` writes
    the sums once, for several reads."""
    spark = doc_tokens.sparkSession
    if vocab is None:
        vocab = doc_tokens.select(F.explode_outer(tokens_col).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    listed = _listed(vocab)
    if listed is not None:
        words, n_tokens = listed
        if n_tokens is None:
            n_tokens = doc_tokens.agg(F.coalesce(F.sum(F.greatest(F.size(tokens_col), F.lit(0))), F.lit(0))).first()[0]
        sent, bits = spark.sparkContext.broadcast(words), 2 * _width(len(words))
        parts = _parts_for(spark, n_tokens * window, bits)
        counts = doc_tokens.select(tokens_col).mapInArrow(_pair_counts(sent, window, bits - parts), PACKED)
        sums = _dealt(counts, parts, bits - parts)
        return PairSums(_kept(sums, "pairs") if keep else sums, sent, parts)
    t, n = F.col(tokens_col), F.size(tokens_col)
    def at(d):
        rest = F.greatest(n - d, F.lit(0))
        return F.zip_with(F.slice(t, F.lit(1), rest), F.slice(t, d + 1, rest),
                          lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))
    pairs = doc_tokens.select(F.explode_outer(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(window)), at))).alias("p"))
    counts = pairs.filter("p is not null").groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))
    if keep:
        counts = _kept(counts, "pairs")
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("context")), F.struct(F.col("b").alias("word"), F.col("a").alias("context")))
    other = counts.filter("a <> b").select(F.explode(sides).alias("s"), "n").select("s.word", "s.context", "n")
    return other.unionByName(counts.filter("a = b").select(F.col("a").alias("word"), F.col("b").alias("context"), (2 * F.col("n")).alias("n")))


def cooccurrence(doc_tokens: DataFrame, window: int = WINDOW_SIZE, tokens_col: str = "tokens", vocab: DataFrame | None = None,
                 keep: bool = False) -> DataFrame:
    """(word, context, n): how often ``context`` is at most ``window`` tokens before or after ``word``.

    Unordered pairs are counted, half of the rows; both directions are made of their sums. ``vocab``
    (word, ..) has all words of the tokens; without it they are found by one more pass. Words of bounded
    size are numbered, and tasks count pairs of numbers before they are shuffled. ``keep`` writes the sums
    once, for several reads.
    """
    sums = pair_sums(doc_tokens, window, tokens_col, vocab, keep)
    return sums.rows() if isinstance(sums, PairSums) else sums


def _sendable(table: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(table) if n_bytes <= MAX_BROADCAST_BYTES else table


def _pmi_of(counts: PairSums, shift: float) -> Callable:
    """A function of words, contexts and counts, all by number: their mutual information."""
    margins = counts.margins()
    total = np.log(float(max(margins.sum(), 1)))
    logs = counts.sums.sparkSession.sparkContext.broadcast(np.log(np.maximum(margins, 1).astype(float)))
    return lambda x, y, n: np.log(n.astype(float)) - logs.value[x] - logs.value[y] + total - shift


def pmi(counts: DataFrame | PairSums, shift: float = 0.0) -> DataFrame:
    """(word, context, n, pmi): ln(n * total / (n_word * n_context)) - ``shift``. The words' sums are
    written once; where they are of bounded size, pairs meet them in place."""
    if isinstance(counts, PairSums):
        value_of, sent = _pmi_of(counts, shift), counts.words

        def make() -> Callable:
            words = pa.array(sent.value, pa.string())

            def of(a, b, n):
                x, y, m = _both_ways(a, b, n)
                columns = [words.take(pa.array(x)), words.take(pa.array(y)), pa.array(m), pa.array(value_of(x, y, m))]
                return pa.RecordBatch.from_arrays(columns, ["word", "context", "n", "pmi"])
            return of
        return counts.mapped(make, "word string, context string, n long, pmi double")
    margin = _kept(counts.groupBy("word").agg(F.sum("n").alias("m")), "margins")
    size = margin.agg(F.coalesce(F.sum(F.octet_length("word") + 24), F.lit(0))).first()[0]
    total = margin.agg(F.sum("m").alias("total")).scalar()
    ln = lambda c: F.log(F.col(c).cast("double"))
    joined = counts.join(_sendable(margin.withColumnRenamed("m", "mw"), size), "word").join(
        _sendable(margin.select(F.col("word").alias("context"), F.col("m").alias("mc")), size), "context")
    value = ln("n") - ln("mw") - ln("mc") + F.log(total.cast("double")) - F.lit(shift)
    return joined.select("word", "context", "n", value.alias("pmi"))


def _grams(size: int):
    """Sums of products of two vector columns over a task's rows: (i, row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            a, b = (c.flatten().to_numpy(zero_copy_only=False).reshape(-1, size) for c in batch.columns)
            total += a.T @ b
        i, j = np.indices((size, size)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "x"])
    return run


def _gram(df: DataFrame, a: str, b: str, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for r in df.select(a, F.col(b).alias("_b")).mapInArrow(_grams(size), "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        out[r.i, r.j] = r.x
    return out


def _turned(df: DataFrame, matrix: np.ndarray, col: str) -> DataFrame:
    """(i, v): ``col`` times a matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(matrix)) @ matrix
            offsets = pa.array(np.arange(len(v) + 1, dtype=np.int32) * matrix.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(v.ravel()))], ["i", "v"])
    return df.select("i", col).mapInArrow(run, "i long, v array<double>")


def _iterated(words: DataFrame, n: int, size: int, iterations: int, seed: int,
              times: Callable[[DataFrame], DataFrame]) -> tuple[np.ndarray, DataFrame]:
    """Leading eigenvalues and (word, vector) of a symmetric matrix with a row for each of the ``n`` words (word, i);
    ``times`` writes the matrix times a table (i, v) and returns it."""
    size = min(size, n)
    if not size:
        return np.zeros(0), words.select("word", F.array().cast("array<double>").alias("vector"))
    start = [F.xxhash64(F.lit(seed + k), "word") / F.lit(float(1 << 63)) for k in range(size)]
    v = _kept(words.select("i", F.array(*start).alias("v")), "pmi-start")
    for step in range(iterations + 1):
        r = np.linalg.qr(np.linalg.cholesky(_gram(v, "v", "v", size) + 1e-12 * np.eye(size)).T)[1]
        u = _turned(v, np.linalg.inv(r), "v")
        y = times(u)
        if step < iterations:
            v = y
    both = _kept(u.join(y.withColumnRenamed("v", "y"), "i"), "pmi-last")
    projected = _gram(both, "v", "y", size)
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    order = np.argsort(-np.abs(values))
    values, turn = values[order], turn[:, order]
    out = _turned(both, turn * np.sqrt(np.abs(values)), "v").join(words, "i")
    return values, out.select("word", F.col("v").alias("vector"))


def leading_vectors(matrix: DataFrame, size: int, iterations: int = 12, seed: int = 1234) -> tuple[np.ndarray, DataFrame]:
    """The ``size`` leading eigenvalues, by size, of a symmetric matrix (word, context, value > 0), and
    (word, vector): eigenvectors times the root of their eigenvalue's size.

    Words are numbered and the entries are dealt by row once, so that a step's sums need no shuffle of
    entries; vectors of bounded size are broadcast. Each step writes its vectors to the shared folder: the
    lineage stays short, and lost executors cost a part of one step.
    """
    matrix = _kept(matrix.select("word", "context", "value"), "pmi-matrix")
    # a symmetric matrix has each word as a row
    words = _kept(row_numbers(matrix.select("word").distinct(), ["word"], "i"), "pmi-words")
    n, n_bytes = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word") + 24), F.lit(0))).first()
    named = _sendable(words, n_bytes)
    entries = (matrix.join(named, "word").select("i", "context", "value")
               .join(_sendable(words.select(F.col("word").alias("context"), F.col("i").alias("j")), n_bytes), "context"))
    entries = _kept(entries.select("i", "j", "value").repartition("i").sortWithinPartitions("i"), "pmi-entries")
    size = min(size, n)

    def times(u: DataFrame) -> DataFrame:
        there = _sendable(u.select(F.col("i").alias("j"), F.col("v").alias("vec")), n * (size + 4) * 8)
        parts = [F.sum(F.col("value") * F.get("vec", F.lit(k))).alias(f"s{k}") for k in range(size)]
        sums = entries.join(there, "j").groupBy("i").agg(*parts)
        return _kept(sums.select("i", F.array(*(f"s{k}" for k in range(size))).alias("v")), "pmi-step")
    return _iterated(words, n, size, iterations, seed, times)


def _positive(counts: PairSums, value_of: Callable) -> tuple[DataFrame, int]:
    """The positive entries of both directions, dealt by row and written: packed rows with all entries of a word, the
    word's mixed number before the context's, and their counts. With the number of their low bits."""
    width, most, pairs = counts.width, PAIRS_AT_ONCE >> 2, counts.reader()
    n = counts.sums.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = _parts_for(counts.sums.sparkSession, 8 * n, width)  # fewer for a part than of the text's pairs, since none are equal
    low = 2 * width - parts

    def made(held: list) -> pa.RecordBatch:
        keys, n = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(keys)
        return _packed(keys[order], n[order], low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for a, b, n in pairs(batches):
            x, y, m = _both_ways(a, b, n)
            some = value_of(x, y, m) > 0
            x, y = x[some].astype(np.uint64), y[some].astype(np.uint64)
            held.append((_mixed(x, width) << np.uint64(width) | y, m[some]))
            size += len(x)
            if size >= most:
                yield made(held)
                held, size = [], 0
        if size:
            yield made(held)
    packed = counts.sums.mapInArrow(run, PACKED)
    return _kept(_dealt(packed, parts, low, width), "pmi-entries"), low


def _leading_of_pairs(counts: PairSums, size: int, iterations: int, shift: float, seed: int = 1234) -> tuple[np.ndarray, DataFrame]:
    """``leading_vectors`` of the positive mutual information of numbered pairs. Entries keep their counts, and their values
    are computed in each step. A step sends the vectors in blocks of bounded size; the entries' tasks add up their rows."""
    spark, sent, width, n_words = counts.sums.sparkSession, counts.words, counts.width, len(counts.words.value)
    value_of = _pmi_of(counts, shift)
    entries, low = _positive(counts, value_of)

    def rows_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of sorted entries, and where their entries begin."""
        mixed = keys >> np.uint64(width)
        starts = _starts(mixed)
        return _unmixed(mixed[starts], width).astype(np.int64), starts

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(sent.value, pa.string())
        for batch in batches:
            for keys, _ in _unpacked(batch, low):
                i = pa.array(rows_of(keys)[0])
                yield pa.RecordBatch.from_arrays([i, words.take(i)], ["i", "word"])

    words = _kept(entries.mapInArrow(named, "i long, word string"), "pmi-words")
    n = words.count()
    size = min(size, n)
    block = max(1, MAX_BROADCAST_BYTES // (8 * max(size, 1)))

    def summed(vectors: Broadcast, first: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = vectors.value
            for batch in batches:
                for keys, m in _unpacked(batch, low):
                    i, starts = rows_of(keys)
                    y = (keys & np.uint64((1 << width) - 1)).astype(np.int64)
                    value = value_of(np.repeat(i, np.diff(starts, append=len(keys))), y, m)
                    y -= first
                    if len(v) < n_words:
                        value[(y < 0) | (y >= len(v))] = 0.0
                    ends = np.append(starts[1:], len(keys))
                    sums = np.stack([value[a:b] @ v.take(y[a:b], axis=0, mode="clip") for a, b in zip(starts, ends)])
                    offsets = pa.array(np.arange(len(i) + 1, dtype=np.int32) * size)
                    yield pa.RecordBatch.from_arrays([pa.array(i), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))], ["i", "v"])
        return run

    def times(u: DataFrame) -> DataFrame:
        done = []
        for first in range(0, n_words, block):
            there = u.filter((F.col("i") >= first) & (F.col("i") < first + block)).toArrow()
            v = np.zeros((min(block, n_words - first), size))
            v[there["i"].to_numpy() - first] = there["v"].combine_chunks().flatten().to_numpy().reshape(-1, size)
            vectors = spark.sparkContext.broadcast(v)
            done.append(_kept(entries.mapInArrow(summed(vectors, first), "i long, v array<double>"), "pmi-step"))
            vectors.destroy()
        out = done[0]
        for more in done[1:]:
            out = out.unionByName(more)
        if len(done) > 1:
            sums = out.groupBy("i").agg(*(F.sum(F.get("v", F.lit(k))).alias(f"s{k}") for k in range(size)))
            out = _kept(sums.select("i", F.array(*(f"s{k}" for k in range(size))).alias("v")), "pmi-step")
        return out
    return _iterated(words, n, size, iterations, seed, times)


def pmi_vectors(counts: DataFrame | PairSums, size: int, iterations: int = 12, shift: float = 0.0) -> tuple[np.ndarray, DataFrame]:
    """Eigenvalues and (word, vector) of the positive shifted mutual information of ``cooccurrence`` counts."""
    if isinstance(counts, PairSums):
        return _leading_of_pairs(counts, size, iterations, shift)
    positive = pmi(counts, shift).filter("pmi > 0").select("word", "context", F.col("pmi").alias("value"))
    return leading_vectors(positive, size, iterations)
