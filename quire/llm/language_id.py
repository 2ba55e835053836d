"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and cut into words of letters; the byte n-grams (2 to 4) of each word and
its borders are hashed into buckets, each with a small embedding. A document is the mean of its
embeddings, weighted by a linear layer and a softmax; both are trained together by stochastic
gradient descent in numpy on a bounded, hashed sample of labelled rows. Held-out rows of that
sample set the temperature of the softmax, so that scores are probabilities, and the score
below which a document is rejected.

Prediction needs only each bucket's embedding times the linear layer (a table of buckets by
languages), summed over a document's n-grams: one pass over whole texts, without a shuffle.

Edge cases: a text that is null or has no letter is ``und`` with score 0; texts whose letters
give no n-gram are classified by the bias alone; with no labelled row to learn from, every
document is ``und``; null labels, and rows without an id, are not learned from; ties go to the
first language by code point; repeated rows are predicted alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import grams
from quire.llm.common import documents, forget, slices

#: Buckets of hashed n-grams, and the length of their embeddings.
BUCKETS = 1 << 14
WIDTH = 16
SIZES = (2, 3, 4)
#: Rows to learn from: at most about so many of each language, whatever the corpus's size.
ROWS_A_LANGUAGE = 800
EPOCHS = 6
SEED = 3
#: The share of a language's own held-out documents that rejection may cost.
REJECTED = 0.002
#: No document with a higher score is rejected.
SURE = 0.5
BLOCK_BYTES = 1 << 18
UNKNOWN = "und"

#: Bytes that separate words: all ASCII but letters. ASCII capitals become small letters.
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[ord("A"):ord("Z") + 1] += 32
_LETTER[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def buckets(texts: list[bytes], n_buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Document number and bucket of each n-gram that has no word border inside, by n and place."""
    starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])]).astype(np.int64)
    letters = _LETTER[np.frombuffer(b"".join(b" " + t + b" " for t in texts), dtype=np.uint8)]
    ids = grams.gram_ids(grams.BYTE_VALUE[0][letters], list(SIZES))
    border = letters == 0x20
    whole = ~border  # whether the inner bytes from here on are letters
    docs, found = [], []
    for n in SIZES:
        if len(letters) < n:
            continue
        inner = np.ones(len(letters) - n + 1, dtype=bool)
        for i in range(1, n - 1):
            inner &= whole[i:len(letters) - n + 1 + i]
        if n == 2:
            inner &= whole[:-1] | whole[1:]
        at = np.flatnonzero(inner)
        docs.append(np.searchsorted(starts, at, "right") - 1)
        found.append((grams.mix(ids[n][at] + np.uint64(n)) % np.uint64(n_buckets)).astype(np.int32))
    return np.concatenate(docs or [np.empty(0, np.int64)]), np.concatenate(found or [np.empty(0, np.int32)])


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embedding times linear layer
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, texts: list[bytes]) -> np.ndarray:
        doc, bucket = buckets(texts, len(self.table))
        count = np.bincount(doc, minlength=len(texts))
        sums = [np.bincount(doc, weights=self.table[bucket, i], minlength=len(texts))
                for i in range(len(self.languages))]
        return np.stack(sums, 1) / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(1)
        return [self.languages[i] for i in best], p[np.arange(len(p)), best]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], languages: list[str], n_buckets: int = BUCKETS,
          seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Rows of label, buckets and weights (summing to 1): the table and the bias. Stochastic
    gradient descent with a step for each parameter that shrinks with its past gradients."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (n_buckets, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    past = [np.full(x.shape, 1e-6, dtype=np.float32) for x in (embed, layer, bias)]
    number = {x: i for i, x in enumerate(languages)}
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, at, weight = rows[i]
            if not len(at):
                continue
            hidden = weight @ embed[at]
            error = softmax((hidden @ layer + bias)[None])[0]
            error[number[label]] -= 1
            back = layer @ error
            for x, g, h in ((layer, np.outer(hidden, error), past[1]), (bias, error, past[2])):
                h += g * g
                x -= 0.1 * g / np.sqrt(h)
            g = weight[:, None] * back[None]
            past[0][at] += g * g
            embed[at] -= 0.1 * g / np.sqrt(past[0][at])
    return embed @ layer, bias


def calibrate(model: Model, logits: np.ndarray, labels: list[str]) -> None:
    """Temperature by likelihood on held-out rows; rejection by the scores of right answers."""
    truth = np.array([model.languages.index(x) for x in labels])
    grid = np.exp(np.linspace(np.log(0.5), np.log(20), 61))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / model.temperature)
    right = p.argmax(1) == truth
    if right.any():
        model.reject_below = float(min(SURE, np.quantile(p.max(1)[right], REJECTED)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for unit, lang, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _, found = buckets([body])
            at, count = np.unique(found, return_counts=True)
            rows.append((unit, lang, at.astype("<i4").tobytes(), (count / max(1, count.sum())).astype("<f4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            list(zip(*rows, strict=True)) or [[]] * 4, (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)],
            ["unit", "lang", "at", "weight"])


def fit(docs: DataFrame, learn_from: Column, rows_a_language: int = ROWS_A_LANGUAGE) -> Model | None:
    """A model of the languages of the rows where ``learn_from`` holds and ``lang`` is known.

    The driver gets one row for each language and, for about ``rows_a_language`` different texts of
    each at most, counts of at most ``BUCKETS`` buckets. Copies of a text are made one before that, so
    the sample does not grow with the corpus or with its copies.
    """
    known = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select(F.xxhash64(F.lit(SEED), "text").alias("unit"), "lang", F.col("text").cast("binary").alias("body"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    space = 1 << 20
    keep = F.lit(0)
    for lang, n in sorted(counts.items()):
        keep = F.when(F.col("lang") == lang, min(space, rows_a_language * space // n)).otherwise(keep)
    sample = (known.filter(F.pmod(F.xxhash64("unit"), F.lit(space)) < keep)
              .mapInArrow(_features, "unit long, lang string, at binary, weight binary")
              .groupBy("unit", "lang").agg(F.min("at").alias("at"), F.min("weight").alias("weight")).collect())
    languages = sorted(counts)
    rows = sorted({(r.unit, r.lang, bytes(r["at"]), bytes(r["weight"])) for r in sample})
    rows = [(u, lang, np.frombuffer(a, "<i4"), np.frombuffer(w, "<f4")) for u, lang, a, w in rows]
    learn = [r[1:] for r in rows if r[0] % 5]
    held = [r[1:] for r in rows if r[0] % 5 == 0]
    table, bias = train(learn, languages)
    model = Model(languages, table.astype(np.float64), bias.astype(np.float64))
    if held:
        calibrate(model, np.stack([w @ table[a] if len(a) else 0 * bias for _, a, w in held]) + bias, [r[0] for r in held])
    return model


def predict(docs: DataFrame, model: Model | None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns``, ``lang_pred`` and ``score``. Rows without letters are ``und``, whatever the
    score of the others; ``reject`` says whether the model would not vouch for its answer."""
    kept = docs.select(*columns, F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).cast("binary").alias("body"))
    # buckets x languages; arrays and numbers only: a broadcast object would need this library where it is read
    sent = docs.sparkSession.sparkContext.broadcast(asdict(model) if model else None)
    names = [*columns, "lang_pred", "score", "reject"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = Model(**sent.value) if sent.value else None
        for batch in slices(batches):
            bodies = batch.column(len(columns)).to_pylist()
            lang, score = [UNKNOWN] * len(bodies), np.zeros(len(bodies))
            have = [i for i, b in enumerate(bodies) if b is not None] if model else []
            for part in grams.blocks(iter(have), lambda i: len(bodies[i]), BLOCK_BYTES):
                got, p = model.predict([bodies[i] for i in part])
                for i, x in zip(part, got, strict=True):
                    lang[i] = x
                score[part] = np.clip(p, 0.0, 1.0)
            reject = [x == UNKNOWN or s < model.reject_below for x, s in zip(lang, score.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score),
                                              pa.array(reject, pa.bool_())], names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double", "reject boolean"]))


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the documents, by their id; rows without an id are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def learn_from(doc_id: str = "doc_id") -> Column:
    return ~held_out(doc_id) & F.col(doc_id).isNotNull()


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, learn_from())
    return predict(docs, model).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
