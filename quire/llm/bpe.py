"""Byte-level BPE encoding and decoding.

Encoding compiles the merges into a finite-state transducer that is made deterministic only
where texts lead it. Reading a piece (a match of the split pattern) byte by byte, the BPE
tokens of every prefix are known: the last token of a prefix is the one suffix token that
forms a valid pair (a pair the merges leave alone) with the last token of what stands before
it. Longer prefixes can still replace tokens at the end, but only back to the place where
some longer token could begin; the tokens before the last place that all still possible
continuations share are final and are emitted. A state is therefore the last final token and
the bytes read since; a transition is computed once and then looked up.

Decoding joins the tokens' bytes and turns them to characters by an incremental UTF-8
machine that keeps the bytes of an unfinished character for the next chunk.

Edge cases: a null text counts as empty and has no tokens; texts of any length are read whole;
ids that the vocabulary lacks are an error; ids whose bytes are no UTF-8 decode to those bytes,
with U+FFFD in the text; repeated rows are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
import types
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import WORKER_MEMORY, documents, slices

#: Pieces up to so many characters are remembered with their tokens,
PIECE_CHARS = 32
#: so many of them in a generation (there are two),
REMEMBERED = 900_000
#: so many states before the machine is begun anew,
STATES = 200_000
#: and transitions into states of so many pending bytes.
SHORT = 5


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class State:
    """``before``: the last final token (-1: none). ``pending``: the bytes read since.
    ``open``: the numbers of pending bytes after which a token may begin that the bytes read so
    far do not rule out. For each number of pending bytes, ``last`` has the last token of that
    prefix (-1 where none can lead on) and ``via`` the token ends on the way to it, as bits."""

    __slots__ = ("before", "pending", "open", "last", "via", "next")

    def __init__(self, before: int, pending: bytes, open: list[int], last: list[int], via: list[int]):
        self.before, self.pending, self.open, self.last, self.via = before, pending, open, last, via
        self.next = {}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        #: Tokens and their proper prefixes: 2 * (id + 1) of a token, and 1 more where a longer token
        #: begins with these bytes.
        self.begun = {b[:n]: 1 for b in ranks for n in range(1, len(b))}
        for b, i in ranks.items():
            self.begun[b] = self.begun.get(b, 0) + 2 * (i + 1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple[int, bytes], State] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.start = self.state(-1, b"", [0], [-1], [1])

    def state(self, before: int, pending: bytes, open: list[int], *rest: list[int]) -> State:
        """The state of these contents. Long ones seldom come again and are not remembered."""
        if open[0]:  # no token can follow the final one directly any more
            before = -1
        if len(pending) > SHORT:
            return State(before, pending, open, *rest)
        key = (before, pending)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(before, pending, open, *rest)
        return found

    def split(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one, (-1, -1) if no merge does."""
        if token not in self.halves:
            data = self.bytes_of[token]
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 60:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else (-1, -1)
        return self.halves[token]

    def made(self, token: int) -> bool:
        """Whether merges alone lead to this token."""
        return len(self.bytes_of[token]) == 1 or self.split(token)[0] >= 0

    def valid(self, a: int, b: int) -> bool:
        """Whether the merges leave these two tokens side by side (a = -1: b alone).

        Their merges are undone, the latest first: the tokens that then meet at the border must
        not merge before the one undone. Of equal ranks, the left one merges first.
        """
        key = (a, b)
        if key not in self.pairs:
            good, limit = self.made(b), 1 << 60
            while good and a >= 0:
                good = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60) >= limit
                if len(self.bytes_of[a]) > 1 and (a > b or len(self.bytes_of[b]) == 1):
                    a, limit = self.split(a)[1], a
                elif len(self.bytes_of[b]) > 1:
                    b, limit = self.split(b)[0], b + 1
                else:
                    break
            self.pairs[key] = good
        return self.pairs[key]

    def step(self, state: State, byte: int) -> tuple[tuple[int, ...], State]:
        pending, old, begun, pairs = state.pending + bytes((byte,)), state.last, self.begun, self.pairs
        m, way, open = len(pending), 0, []
        for at in state.open:  # ascending: the longest token first
            code = begun.get(pending[at:])
            if code is None:
                continue
            if code & 1:
                open.append(at)
            if not way and code > 1:
                token, before = (code >> 1) - 1, old[at] if at else state.before
                good = pairs.get((before, token))
                if good or good is None and self.valid(before, token):
                    way, chosen = state.via[at] | 1 << m, token
        if not way:
            raise ValueError(f"no token for byte {byte}")
        via, common = state.via, way
        for at in open:
            common &= via[at]
        open.append(m)
        cut = common.bit_length() - 1
        if not cut:
            edge = ((), self.state(state.before, pending, open, [*old, chosen], [*via, way]))
        elif cut == m:
            final, at = [chosen], m - len(self.bytes_of[chosen])
            while at:
                final.append(old[at])
                at -= len(self.bytes_of[old[at]])
            edge = (tuple(final[::-1]), self.state(chosen, b"", [0], [-1], [1]))
        else:
            final, at = [], cut
            while at:
                final.append(old[at])
                at -= len(self.bytes_of[old[at]])
            edge = (tuple(final[::-1]), self.state(old[cut], pending[cut:], [at - cut for at in open],
                                                   [-1, *old[cut + 1:], chosen], [v >> cut for v in (*via[cut:], way)]))
        if m <= SHORT:
            state.next[byte] = edge
        return edge

    def ended(self, state: State, byte: int) -> list[int]:
        """The tokens after the last final one when the piece ends with this byte, last one first."""
        pending, last = state.pending + bytes((byte,)), state.last
        for at in state.open:
            code = self.begun.get(pending[at:])
            if code is not None and code > 1 and self.valid(last[at] if at else state.before, (code >> 1) - 1):
                out = [(code >> 1) - 1]
                while at:
                    out.append(last[at])
                    at -= len(self.bytes_of[last[at]])
                return out
        raise ValueError(f"no token for byte {byte}")

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES or len(self.pairs) > REMEMBERED:
            self.clear()
        out, state = [], self.start
        for byte in piece[:-1]:
            tokens, state = state.next.get(byte) or self.step(state, byte)
            if tokens:
                out += tokens
        return out + self.ended(state, piece[-1])[::-1]


class Pieces(dict):
    """Tokens of pieces, packed as little-endian unsigned 32-bit integers. Two generations: what
    the older one alone holds is forgotten when the younger one is full."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.older = transducer, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.transducer.encode(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= PIECE_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Utf8Stream:
    """Incremental decoding of UTF-8. The state is the bytes of a character that has begun."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Length of the begun character at the end of the data."""
        for n in range(1, min(3, len(data)) + 1):
            lead = data[-n]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                return n if n < need else 0
            if lead < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = self.unfinished(data)
        self.held = data[len(data) - n:]
        return data[: len(data) - n].decode("utf-8", "replace")

    def end(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


def decode_stream(chunks: Iterable[np.ndarray], bytes_of: dict[int, bytes]) -> Iterator[tuple[bytes, str]]:
    """Bytes and text of chunks of ids, as they come."""
    machine = Utf8Stream()
    for chunk in chunks:
        data = b"".join(map(bytes_of.__getitem__, chunk.tolist()))
        yield data, machine.feed(data)
    yield b"", machine.end()


def kept_by_worker(name: tuple, make):
    """What this Python worker keeps from task to task: Spark reuses workers, but functions that
    travel by value bring new globals each time."""
    memory = sys.modules.setdefault(WORKER_MEMORY, types.ModuleType(WORKER_MEMORY)).__dict__
    if name not in memory:
        memory[name] = make()
    return memory[name]


def vocabulary(spark: SparkSession, path: str):
    """The rank file, to every executor. A vocabulary's size does not depend on the data; the
    file is a part of an installed package, on the driver's disk."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoder(ranks, pattern: str):
    """Texts to packed ids, in a task."""
    data, split = ranks.value, regex.compile(pattern)
    pieces = kept_by_worker(("pieces", zlib.crc32(data), len(data)), lambda: Pieces(Transducer(read_ranks(data))))
    return lambda text: b"".join(map(pieces.__getitem__, split.findall(text or "")))


def _decoder(ranks):
    """Packed ids to bytes and text, in a task."""
    data = ranks.value
    bytes_of = kept_by_worker(("bytes", zlib.crc32(data), len(data)), lambda: {i: b for b, i in read_ranks(data).items()})

    def decode(packed: bytes) -> tuple[bytes, str]:
        ids = np.frombuffer(packed or b"", dtype="<u4")
        parts = list(decode_stream((ids[i:i + CHUNK] for i in range(0, len(ids), CHUNK)), bytes_of))
        return b"".join(p[0] for p in parts), "".join(p[1] for p in parts)

    return decode


#: Ids that are decoded at once.
CHUNK = 1 << 14


def _ddl(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def encode(docs: DataFrame, path: str, pattern: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` and ``ids``: the tokens of ``text`` as packed little-endian 32-bit integers."""
    ranks = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _encoder(ranks, pattern)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([ids(t.as_py()) for t in batch.column(len(columns))], pa.binary())], [*columns, "ids"])

    return docs.select(*columns, "text").mapInArrow(run, _ddl(docs.select(*columns), "ids binary"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of ``encoded``, ``decoded`` (bytes) and ``text``."""
    ranks, names = vocabulary(encoded.sparkSession, path), encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _decoder(ranks)
        for batch in slices(batches):
            out = [made(p.as_py()) for p in batch.column(names.index("ids"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b for b, _ in out], pa.binary()), pa.array([t for _, t in out], pa.string())],
                [*names, "decoded", "text"])

    return encoded.mapInArrow(run, _ddl(encoded, "decoded binary", "text string"))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding each text, in one pass:
    only digests leave the task, and a Python worker that encodes goes on encoding."""
    ranks = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, made = _encoder(ranks, pattern), _decoder(ranks)
        for batch in slices(batches):
            packed = [ids(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()),
                 pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                 pa.array([hashlib.sha256(made(p)[0]).hexdigest() for p in packed], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                   public_tokenizers.PATTERN)
