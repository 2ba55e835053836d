"""Toxicity by a convolutional text classifier.

A text is lower-cased (A-Z) and cut into words of letters. A word's embedding is the sum of the
embeddings of hashed buckets: its own and those of its first 4, 6 and 8 bytes, so that inflected
forms share a stem. Filters of one, two and three words slide over a text; the largest response
of each, over the whole text, goes through a tanh into two linear layers: the logit of toxicity and
the text's language. Everything is trained together in numpy, by stochastic gradient descent with a
step for each parameter, on all labelled texts: a bounded sample of them gives the weights to start
from, then in each of ``ROUNDS`` every task goes on from these over its part of the texts, and what the
tasks arrive at is averaged, each embedding over the steps that its bucket had a part in. Thresholds
are calibrated by language: on the fifth of the labelled texts that is kept from training the logit at
which a language's toxic rows are told apart best is shifted to the score ``THRESHOLD``. At prediction
the language is the network's own answer, so a score depends on the text alone.

Prediction is one pass over whole texts, without a shuffle; buckets that no labelled text holds
count nothing.

Edge cases: a null or empty text, and one without letters, scores as one without words; rows
without an id, and null labels, are not learned from; of several labels of one id the largest
counts, and of several labels of one text, too; without a toxic (or a clean) row to learn from,
every score is 0 (or 1); repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import grams
from quire.llm.common import discard, documents, forget, result, slices, written
from quire.llm.repeats import unique
from quire.session import read_table

#: A text is predicted toxic from this score on (the contract's).
THRESHOLD = 0.3
#: Rows that give the weights to start from: at most so many toxic and so many clean ones, each of at
#: most so many words; and the rounds over all labelled texts after that.
ROWS_A_LABEL = 2000
MOST_WORDS = 5000
ROUNDS = 2
#: Buckets (0: no such part of the word), length of an embedding, bytes of stems.
BUCKETS = 1 << 18
DIM = 12
STEMS = (4, 6, 8)
WIDTHS = (1, 2, 3)
FILTERS = 12
EPOCHS = 8
BATCH = 16
RATE = 0.1
#: Weight of the language's loss beside that of toxicity.
LANGUAGE_WEIGHT = 0.2
SEED = 11
BLOCK_BYTES = 1 << 18
#: Steps of the logit's scale on which texts are counted for the thresholds, and rows of a batch.
LOGIT_STEPS = 100
OUT_ROWS = 1 << 12
PAD = max(WIDTHS) - 1

#: Bytes that separate words: all ASCII but letters. ASCII capitals become small letters.
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[ord("A"):ord("Z") + 1] += 32
_LETTER[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def word_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each word, a row a word (``int32``), and where each text's words begin."""
    letters = _LETTER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    first, last = grams.word_bounds(letters)
    names = [grams.word_ids(letters, first, last)]
    if len(first):
        stems = grams.gram_ids(grams.BYTE_VALUE[0][letters], list(STEMS))
    out = np.zeros((len(first), 1 + len(STEMS)), dtype=np.int32)
    for i, n in enumerate((0, *STEMS)):
        have = np.flatnonzero(last - first > n)
        if len(have):
            ids = names[0][have] if n == 0 else stems[n][first[have]]
            out[have, i] = (grams.mix(ids + np.uint64(n)) % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return out, np.searchsorted(first, begin)


@dataclass
class Network:
    """Plain arrays, so that it travels without this library. ``filters[w]``: (w, DIM, FILTERS)."""

    table: np.ndarray
    filters: list[np.ndarray]
    toxic: np.ndarray  # pooled + 1
    language: np.ndarray  # (pooled + 1, languages)
    shift: np.ndarray  # of the logit, for each language

    def pooled(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each text (0 without words), and its word."""
        count = np.diff(starts)
        # words without meaning after each text, so that no window reaches into the next one
        place = np.arange(len(ids)) + PAD * np.repeat(np.arange(len(count)), count)
        padded = np.zeros((len(ids) + PAD * (len(count) + 1), DIM), dtype=np.float32)
        padded[place] = self.table[ids].sum(1)
        begin = starts[:-1] + PAD * np.arange(len(count))
        have = np.flatnonzero(count)
        best = np.zeros((len(count), len(WIDTHS) * FILTERS), dtype=np.float32)
        where = np.zeros(best.shape, dtype=np.int64)
        n = len(padded) - PAD
        for j, (w, kernel) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            z = sum(padded[k:n + k] @ kernel[k] for k in range(w))
            cols = slice(j * FILTERS, (j + 1) * FILTERS)
            bounds = np.stack([begin[have], begin[have] + count[have]], 1).ravel()
            if len(bounds):
                best[have, cols] = np.maximum.reduceat(z, np.minimum(bounds, n - 1), axis=0)[::2]
            if self.wants_places:
                for d in have:
                    where[d, cols] = z[begin[d]:begin[d] + count[d]].argmax(0) + starts[d]
        return np.tanh(best), where

    wants_places: bool = False

    def logits(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = np.hstack([pooled, np.ones((len(pooled), 1), np.float32)])
        return one @ self.toxic, one @ self.language

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z, lang = self.logits(self.pooled(*word_buckets(texts))[0])
        return sigmoid(z.astype(float) + self.shift[lang.argmax(1)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Training:
    """A network in training, with the sums of squared gradients of its parameters."""

    net: Network
    past: list[np.ndarray]

    def dense(self) -> list[np.ndarray]:
        """All parameters but the embeddings."""
        return [*self.net.filters, self.net.toxic, self.net.language]

    def step(self, part: list[tuple[int, int, np.ndarray]], share: float) -> np.ndarray:
        """One step on a few (label, language, buckets of each word), where ``share`` of all labels is
        toxic; the buckets that had a part in it."""
        net, past = self.net, self.past

        def step(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
            h += g * g
            x -= RATE * g / np.sqrt(h)

        y, lang = np.array([r[0] for r in part]), np.array([r[1] for r in part])
        ids = np.concatenate([r[2] for r in part])
        starts = np.cumsum([0, *(len(r[2]) for r in part)])
        h, where = net.pooled(ids, starts)
        one = np.hstack([h, np.ones((len(h), 1), np.float32)])
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        dz = ((sigmoid(one @ net.toxic) - y) * weight / len(part)).astype(np.float32)
        dl = softmax(one @ net.language)
        dl[np.arange(len(part)), lang] -= 1
        dl *= LANGUAGE_WEIGHT / len(part)
        dh = (np.outer(dz, net.toxic) + dl @ net.language.T)[:, :-1] * (1 - h * h)
        dh[np.diff(starts) == 0] = 0
        at_bucket, grad = [], []
        for j, (w, kernel) in enumerate(zip(WIDTHS, net.filters, strict=True)):
            cols = slice(j * FILTERS, (j + 1) * FILTERS)
            d, f = np.nonzero(dh[:, cols])
            g, p = dh[:, cols][d, f], where[:, cols][d, f]
            dk = np.zeros_like(kernel)
            for k in range(w):
                inside = p + k < starts[1:][d]
                words = ids[(p + k)[inside]]
                e = net.table[words].sum(1) * g[inside, None]
                np.add.at(dk[k].T, f[inside], e)
                at_bucket.append(words.ravel())
                grad.append(np.repeat(g[inside, None] * kernel[k].T[f[inside]], words.shape[1], 0))
            step(kernel, dk, past[1 + j])
        buckets, number = np.unique(np.concatenate(at_bucket), return_inverse=True)
        total = np.zeros((len(buckets), DIM), dtype=np.float32)
        np.add.at(total, number, np.concatenate(grad))
        total[buckets == 0] = 0
        past[0][buckets] += total * total
        net.table[buckets] -= RATE * total / np.sqrt(past[0][buckets])
        step(net.toxic, one.T @ dz, past[-2])
        step(net.language, one.T @ dl, past[-1])
        return buckets


def train(rows: list[tuple[int, int, np.ndarray]], n_languages: int, seed: int = SEED) -> Training:
    """From (label, language, buckets of each word)."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    used = np.unique(np.concatenate([r[2].ravel() for r in rows]))
    used = used[used > 0]
    table = np.zeros((BUCKETS, DIM), dtype=np.float32)
    table[used] = normal(len(used), DIM)
    size = len(WIDTHS) * FILTERS + 1
    net = Network(table, [3 * normal(w, DIM, FILTERS) for w in WIDTHS], 3 * normal(size), normal(size, n_languages),
                  np.zeros(n_languages), wants_places=True)
    out = Training(net, [np.full(x.shape, 1e-4, np.float32) for x in (table, *net.filters, net.toxic, net.language)])
    share = np.mean([r[0] for r in rows])
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            out.step([rows[i] for i in order[at:at + BATCH]], share)
    return out


def _rounds(sent, languages: dict[str, int], share: float) -> Callable:
    """From (lang, toxic, body): the parameters after a step on every few rows, ``DIM`` of them a row;
    of the embeddings those whose buckets had a part in a step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        net, past = sent.value
        net = Network(**{k: v for k, v in net.items() if k != "wants_places"}, wants_places=True)
        # a task has its own copy
        net.table, net.toxic, net.language = net.table.copy(), net.toxic.copy(), net.language.copy()
        net.filters = [x.copy() for x in net.filters]
        own = Training(net, [x.copy() for x in past])
        parts, steps = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in slices(batches, BATCH):
            rows = [(toxic, languages[lang], word_buckets([body])[0])
                    for lang, toxic, body in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                parts[own.step(rows, share)] += 1
                steps += 1
        if not steps:
            return
        parts[0] = 0
        at = np.flatnonzero(parts)
        rest = np.concatenate([x.ravel() for x in own.dense()])
        rest = np.append(rest, np.zeros(-len(rest) % DIM, np.float32)).reshape(-1, DIM)
        value = np.concatenate([net.table[at], rest])
        weight = np.concatenate([parts[at], np.full(len(rest), steps)])
        at = np.concatenate([at, BUCKETS + np.arange(len(rest))])
        names = ["at", "weight", *(f"v{i}" for i in range(DIM))]
        yield from slices([pa.RecordBatch.from_arrays([pa.array(at), pa.array(weight), *(pa.array(v) for v in value.T.copy())], names)], OUT_ROWS)

    return run


def go_on(state: Training, rows: DataFrame, languages: dict[str, int], share: float) -> None:
    """One round over ``rows`` (lang, toxic, body), a part of them in each task. At most ``BUCKETS`` rows
    of ``DIM`` parameters, and the few others, reach the driver."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((asdict(state.net), state.past))
    values = [f"v{i}" for i in range(DIM)]
    made = rows.select("lang", "toxic", "body").mapInArrow(
        _rounds(sent, languages, share), "at long, weight long, " + ", ".join(f"{v} float" for v in values))
    # sums of whole numbers, so that they do not depend on the order of the tasks
    whole = lambda v: F.sum((F.col(v).cast("double") * F.col("weight") * (1 << 24)).cast("long"))
    means = made.groupBy("at").agg(*((whole(v) / F.sum("weight") / (1 << 24)).cast("float").alias(v) for v in values)).toArrow()
    sent.destroy()
    at = means["at"].to_numpy()
    value = np.stack([means[v].to_numpy() for v in values], 1)
    embedding = at < BUCKETS
    state.net.table[at[embedding]] = value[embedding]
    rest = value[~embedding][np.argsort(at[~embedding])].ravel()
    for x in state.dense():
        x[...] = rest[:x.size].reshape(x.shape)
        rest = rest[x.size:]


def calibrate(net: Network, rows: list[tuple[int, int, int, int]]) -> None:
    """Shifts each language's logits so that the cut with the best F1 on its held-out texts, given
    the cut of all texts as if it had been seen in ``prior`` of them, scores ``THRESHOLD``. ``rows``:
    (language, logit in steps, toxic texts, texts)."""
    lang, at, toxic, count = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
    base = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def cut(mine: np.ndarray) -> float:
        levels, number = np.unique(at[mine], return_inverse=True)
        levels, number = levels[::-1], len(levels) - 1 - number
        hit = np.cumsum(np.bincount(number, toxic[mine]))
        f1 = 2 * hit / (np.cumsum(np.bincount(number, count[mine])) + hit[-1])
        i = int(f1.argmax())
        below = levels[i + 1] + 1 if i + 1 < len(levels) else levels[i] - 2 * LOGIT_STEPS
        return float(levels[i] + below) / 2 / LOGIT_STEPS

    prior = 20
    every = np.ones(len(at), dtype=bool)
    overall = cut(every) if 0 < toxic.sum() < count.sum() else base
    for one in range(len(net.shift)):
        mine = lang == one
        n = int(toxic[mine].sum())
        own = cut(mine) if 0 < n < count[mine].sum() else overall
        net.shift[one] = base - (n * own + prior * overall) / (n + prior)


def _judged(sent) -> Callable:
    """From (toxic, body): the language that the network sees, the logit in steps, and toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(**sent.value)
        for batch in slices(batches, BATCH):
            bodies = batch.column(1).to_pylist()
            if bodies:
                z, lang = net.logits(net.pooled(*word_buckets(bodies))[0])
                at = np.floor(np.clip(z, -40, 40) * LOGIT_STEPS)
                yield pa.RecordBatch.from_arrays([pa.array(lang.argmax(1)), pa.array(at.astype(np.int64)), batch.column(0)],
                                                 ["lang", "at", "toxic"])

    return run


def _least(rows: DataFrame, by: Column, n: int) -> DataFrame:
    """The n clean and the n toxic rows with the least values."""
    parts = [rows.filter(F.col("toxic") == c).orderBy(by).limit(n) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def labelled(docs: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """(unit, lang, toxic, body): every text of ``docs`` with a label in ``labels`` (doc_id, toxic), each
    once, where ``learn_from`` holds. One of the documents of a text brings it along."""
    known = (labels.select("doc_id", "toxic").filter(learn_from & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    texts = (docs.filter(learn_from & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
             .select("doc_id", F.xxhash64(F.lit(SEED), "text").alias("unit"), F.coalesce("lang", F.lit("")).alias("lang"),
                     F.col("text").cast("binary").alias("body")))
    marked = (texts.select("doc_id", "unit", "lang").join(known, "doc_id").groupBy("unit")
              .agg(F.min("doc_id").alias("doc_id"), F.min("lang").alias("lang"), F.max("toxic").alias("toxic")))
    rows = (texts.select("doc_id", "unit", "body").join(unique(marked), ["doc_id", "unit"])
            .groupBy("doc_id", "unit").agg(F.first("lang").alias("lang"), F.first("toxic").alias("toxic"), F.first("body").alias("body")))
    return written(rows.select("unit", "lang", "toxic", "body").sortWithinPartitions("unit"), "labelled")


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, rows_a_label: int = ROWS_A_LABEL) -> Network | float:
    """A network from the rows of ``labels`` (doc_id, toxic) where ``learn_from`` holds; the share of
    toxic rows if all are alike. To start from, at most 2 * ``rows_a_label`` texts of at most
    ``MOST_WORDS`` words reach the driver; all texts are learned from by the tasks that read them."""
    known = labelled(docs, labels, learn_from)
    held = F.pmod("unit", F.lit(5)) == 0
    counts = known.groupBy("lang", held.alias("held")).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()
    total = [(sum(r.n for r in counts if not r.held), sum(r.toxic for r in counts if not r.held)),
             (sum(r.n for r in counts), sum(r.toxic for r in counts))]
    n, toxic = total[1]
    if not 0 < toxic < n:
        discard(known)
        return float(bool(toxic))
    learn, (n, toxic) = (known.filter(~held), total[0]) if 0 < total[0][1] < total[0][0] else (known, total[1])
    languages = {x: i for i, x in enumerate(sorted({r.lang for r in counts}))}
    chosen = F.broadcast(_least(learn.select("unit", "toxic"), F.col("unit"), rows_a_label).select("unit"))
    sample = sorted(learn.join(chosen, "unit", "left_semi").collect(), key=lambda r: r.unit)
    first = [(r.toxic, languages[r.lang], word_buckets([bytes(r.body)])[0]) for r in sample]
    short = [r for r in first if len(r[2]) <= MOST_WORDS]
    state = train(short if len({r[0] for r in short}) == 2 else first, len(languages))
    for _ in range(ROUNDS):
        go_on(state, learn, languages, toxic / n)
    net = state.net
    net.wants_places = False
    sent = docs.sparkSession.sparkContext.broadcast(asdict(net))
    judged = (known.filter(held).select("toxic", "body").mapInArrow(_judged(sent), "lang long, at long, toxic int")
              .groupBy("lang", "at").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n")).collect())
    discard(known)
    if judged:
        calibrate(net, [tuple(r) for r in judged])
    return net


def _scored(sent, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        if isinstance(model, dict):
            table = np.zeros((BUCKETS, DIM), dtype=np.float32)
            table[model["buckets"]] = model["table"]
            model = Network(**{k: v for k, v in model.items() if k != "buckets"} | {"table": table})
        for batch in slices(batches):
            bodies = [b or b"" for b in batch.column(batch.num_columns - 1).to_pylist()]
            score = np.full(len(bodies), model if isinstance(model, float) else 0.0)
            if not isinstance(model, float):
                for part in grams.blocks(iter(range(len(bodies))), lambda i: len(bodies[i]), BLOCK_BYTES):
                    score[part] = model.scores([bodies[i] for i in part])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names)

    return run


def score(docs: DataFrame, model: Network | float, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` and ``score``. The embeddings of the buckets in use are broadcast, as arrays."""
    if isinstance(model, Network):
        plain = asdict(model)
        plain["buckets"] = np.flatnonzero(model.table.any(1)).astype(np.int32)
        plain["table"] = model.table[plain["buckets"]]
    else:
        plain = model
    kept = docs.select(*columns, F.col("text").cast("binary").alias("body"))
    sent = docs.sparkSession.sparkContext.broadcast(plain)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(_scored(sent, [*columns, "score"]), ", ".join([*fields, "score double"]))


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, by their id; rows without an id are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        docs = documents(spark, sf_dir)
        model = fit(docs, read_table(spark, sf_dir, "labels"), ~held_out())
        return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

    return result(make, "op11")
