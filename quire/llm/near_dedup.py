"""MinHash near-dedup with SetSketch registers.

A document's set is its distinct word shingles (letters A-Z lower-cased). Documents of equal
sets form a class, of which one goes on. Each register of a set's sketch is the least of the
elements' exponential variates, truncated to a logarithmic scale: sketches of unions are the
maxima of the registers, and equal registers are as frequent as the sets are similar.

* Bands of registers, and longer runs of registers from the same places, put sets into
  buckets. A bucket's sets are linked to its centres (the set that shares most buckets with
  others, and the one with the least id), and within a small bucket to each other; larger
  buckets have their sets compared in the longer runs, where only closer ones meet. So a group
  of near copies costs its size, not its square.
* Each candidate pair's similarity is estimated by likelihood from how often either register
  is greater, and pairs far below the threshold drop out.
* What is left is confirmed on the full sets; first each set's most likely partner, then,
  of the other pairs, those not connected yet.
* Members of a crowded bucket that are not connected after that are compared exactly, by prefix
  filter: two sets at the threshold share one of the first few of their shingles in any order that holds
  for all. Shingles within one component come first, being shared with no other, then the rare
  ones; so those of a template come last and are hardly ever among the first few. A set that has
  many shingles of a template among them costs a comparison with each such set of the template.

Edge cases: a text that is null or has no word has an empty set and is linked with nothing;
a text of fewer words than a shingle is one shingle; rows without an id are linked with
nothing and have no component; rows that share an id count as one document, with the set of
one of them; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import grams
from quire.llm.common import discard, documents, result, slices, written
from quire.llm.components import components
from quire.llm.repeats import rows_of, unique

#: Words of a shingle; links have 100 * intersection >= percent * union.
SHINGLE = 5
PERCENT = 80
REGISTERS = 192
#: Pairs at the threshold share no band with at most this probability.
MISSED = 1e-6
#: Base and rate of the registers' scale, and its last value.
BASE, RATE, LAST = 1.005, 20.0, 65_534
#: Sets in a bucket that are compared with each other, not only with the centres.
SMALL = 6
BLOCK_BYTES = 1 << 18

_RNG = np.random.default_rng(99)
_XOR = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)


def band_rows(percent: int) -> int:
    """Registers of a band: as many as leave pairs at the threshold a band in common."""
    p = percent / 100
    return max(r for r in range(1, REGISTERS + 1) if r == 1 or (1 - p**r) ** (REGISTERS // r) <= MISSED)


def depths(percent: int) -> tuple[int, ...]:
    """Registers of the buckets from the beginning of each band on, the next ones included."""
    rows = band_rows(percent)
    return rows, 2 * rows, 4 * rows


def least_estimate(percent: int) -> float:
    """Estimated similarity below which a pair is dropped: 6 standard errors under the threshold."""
    p = percent / 100
    return p - 6 * (p * (1 - p) / REGISTERS) ** 0.5


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and identifiers of the distinct shingles, sorted by both."""
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    buffer = np.frombuffer(b"\n".join(t.lower() for t in texts) + b"\n", dtype=np.uint8)
    first, last = grams.word_bounds(buffer)
    words = grams.word_ids(buffer, first, last)
    at = np.searchsorted(first, starts)
    valid = grams.valid_windows(at, size)
    ids = grams.mix(grams.gram_ids(words, [size])[size][valid]) if len(valid) else np.empty(0, np.uint64)
    docs = np.searchsorted(at, valid, "right") - 1
    count = np.diff(at)
    for doc in np.flatnonzero((count > 0) & (count < size)):  # a short text as a whole
        whole = words[at[doc]:at[doc + 1]]
        value = np.array([len(whole)], dtype=np.uint64)
        for word in whole:
            value = grams.pair(value, np.array([word]), 40)
        docs, ids = np.append(docs, doc), np.append(ids, grams.mix(value))
    order = np.lexsort((ids, docs))
    docs, ids = docs[order], ids[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (docs[1:] != docs[:-1])
    return docs[new], ids[new]


def registers(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sketch of each run of identifiers that begins at ``starts``."""
    out = np.empty((len(starts), REGISTERS), dtype=np.float64)
    for i in range(REGISTERS):
        v = ids ^ _XOR[i]
        v *= _MUL[i]
        out[:, i] = np.minimum.reduceat(v, starts)
    least = -np.log1p(-(out + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(least, 1e-300)) / np.log(BASE)), 0, LAST).astype("<u2")


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((d, b or b"") for d, b in rows_of(batches))
        for part in grams.blocks(rows, lambda r: len(r[1]), BLOCK_BYTES):
            docs, ids = shingles([b for _, b in part], size)
            count = np.bincount(docs, minlength=len(part))
            have = np.flatnonzero(count)
            d1, d2 = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
            sketch = [b""] * len(part)
            if len(have):
                starts = np.cumsum(count[have]) - count[have]
                d1[have] = np.add.reduceat(grams.mix(ids ^ np.uint64(0x5DEECE66D)), starts)
                d2[have] = np.bitwise_xor.reduceat(grams.mix(ids * np.uint64(0x2545F4914F6CDD1D)), starts)
                for i, row in zip(have, registers(ids, starts), strict=True):
                    sketch[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in part], pa.int64()), pa.array(count.astype(np.int64)), pa.array(d1.view(np.int64)),
                 pa.array(d2.view(np.int64)), pa.array(sketch, pa.binary())], ["doc_id", "n_shingles", "d1", "d2", "sketch"])

    return run


def _band_keys(names: list[str], depths: tuple[int, ...]):
    """Rows of columns ``names`` and, last, a sketch: with the keys of its buckets in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.columns[-1].to_pylist()), dtype="<u2").reshape(-1, REGISTERS).astype(np.uint64)
            rows = np.concatenate([rows, rows], axis=1)  # runs go on at the first register
            for band in range(REGISTERS // depths[0]):
                keys, value, done = [], np.full(len(rows), band, dtype=np.uint64), 0
                for depth in depths:
                    for i in range(done, depth):
                        value = grams.pair(value, rows[:, band * depths[0] + i], i)
                    done = depth
                    key = grams.mix(value).view(np.int64)
                    keys.append(pa.array(key))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *keys], [*names, *(f"k{i}" for i in range(len(depths)))])

    return run


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs of sets with sketches a, b (rows) and known sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v, j = 1 - u, np.linspace(0, 1, 201)[None]

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = chance(u - v * j), chance(v - u * j)
    like = sum(n[:, None] * np.log(np.maximum(x, 1e-12)) for n, x in ((more, p), (less, q), (same, 1 - p - q)))
    like[(j > np.minimum(u / v, v / u) + 0.005)] = -np.inf
    return j[0][like.argmax(1)]


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        if not batch.num_rows:
            continue
        a, b, sa, sb, na, nb = (batch.column(i) for i in range(6))
        read = lambda c: np.frombuffer(b"".join(c.to_pylist()), dtype="<u2").reshape(-1, REGISTERS)
        likely = estimate(read(sa), read(sb), np.asarray(na).astype(float), np.asarray(nb).astype(float))
        yield pa.RecordBatch.from_arrays([a, b, pa.array(likely)], ["a", "b", "likely"])


def candidates(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, likely): pairs of sets, a < b, that share a bucket and may be similar enough.
    ``sets`` has (doc_id, n_shingles, sketch)."""
    runs = depths(percent)
    keys = [f"k{i}" for i in range(len(runs))]
    rows = sets.select("doc_id", "sketch").mapInArrow(_band_keys(["doc_id"], runs), "doc_id long, " + ", ".join(f"{k} long" for k in keys))
    shared = rows.groupBy("k0").agg(F.count("*").alias("n0")).filter("n0 > 1")
    rows = written(rows.join(unique(shared), "k0"), "bands")
    popular = rows.groupBy("doc_id").agg(F.sum("n0").alias("meets"))
    banded, rows = rows, written(rows.join(popular, "doc_id"), "popular")
    discard(banded)
    pairs, inside = [], rows
    for k in keys:
        buckets = inside.groupBy(k).agg(F.count("*").alias("n"), F.min("doc_id").alias("least"),
                                        F.max(F.struct("meets", (-F.col("doc_id")).alias("minus"))).alias("centre"))
        buckets = buckets.filter("n > 1")
        star = inside.join(unique(buckets), k)
        pairs.append(star.select("doc_id", F.explode(F.array("least", -F.col("centre.minus"))).alias("other")))
        few = star.filter(F.col("n") <= SMALL).select(k, "doc_id", "n")
        few = few.groupBy(k).agg(F.collect_list("doc_id").alias("all"))  # at most SMALL
        pairs.append(few.select(F.explode("all").alias("doc_id"), "all").select("doc_id", F.explode("all").alias("other"))
                     .filter("doc_id < other"))
        # the whole bucket is one of the longer run's parts where a shorter run's was large
        inside = star.filter(F.col("n") > SMALL).select(*rows.columns)
    out = pairs[0]
    for more in pairs[1:]:
        out = out.union(more)
    out = out.filter("doc_id <> other").select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b"))
    out = written(out.distinct(), "pairs")
    discard(rows)
    return estimated(out, sets, percent)


def estimated(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, likely): the pairs (a, b) that may be similar enough by their sketches."""
    near = (pairs.join(sets.selectExpr("doc_id as a", "sketch as sa", "n_shingles as na"), "a")
            .join(sets.selectExpr("doc_id as b", "sketch as sb", "n_shingles as nb"), "b")
            .filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
            .select("a", "b", "sa", "sb", "na", "nb").mapInArrow(_estimated, "a long, b long, likely double")
            .filter(F.col("likely") >= least_estimate(percent)))
    return written(near, "likely")


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grams.blocks(rows_of(batches), lambda r: len(r[2]), BLOCK_BYTES):
            docs, ids = shingles([b for _, _, b in part], size)
            bounds = np.searchsorted(docs, np.arange(len(part) + 1))
            kept = [(d, ids[x:y].tobytes()) for (d, n, _), x, y in zip(part, bounds[:-1], bounds[1:], strict=True) if y - x == n]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in kept], pa.int64()), pa.array([x for _, x in kept], pa.binary())],
                                             ["doc_id", "ids"])

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(a)):
                p, q = np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())),
                                              batch.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    return written(pairs.join(sets.selectExpr("doc_id as b", "ids as y"), "b")
                   .join(sets.selectExpr("doc_id as a", "ids as x"), "a")
                   .select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long"), "links")


def full_sets(body: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(doc_id, ids): the sets of the documents of ``keys`` (doc_id, n_shingles)."""
    return written(body.filter("body is not null").join(unique(keys), "doc_id").select("doc_id", "n_shingles", "body")
                   .mapInArrow(_sets(size), "doc_id long, ids binary").dropDuplicates(["doc_id"]), "full")


def crowded(sets: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(doc_id, component): the members of all buckets too large to compare their sets with each
    other whose sets are not all of one component."""
    rows = (sets.join(unique(known.selectExpr("node as doc_id", "component")), "doc_id", "left")
            .select("doc_id", F.coalesce("component", "doc_id").alias("component"), "sketch")
            .mapInArrow(_band_keys(["doc_id", "component"], depths(percent)[:1]), "doc_id long, component long, k0 long"))
    rows = written(rows, "buckets")
    mixed = (rows.groupBy("k0").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter((F.col("n") > SMALL) & (F.col("lo") < F.col("hi"))).select("k0"))
    members = written(rows.join(unique(mixed), "k0", "left_semi").select("doc_id", "component").distinct(), "members")
    discard(rows)
    return members


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for doc, component, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = np.frombuffer(ids, np.int64)
            fixed = [pa.array(np.full(len(values), x, dtype=np.int64)) for x in (doc, component, len(values))]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(values)], ["doc_id", "component", "n", "shingle"])


def remainder(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of members of different components that can be similar enough."""
    rows = written(full.join(unique(members), "doc_id").select("doc_id", "component", "ids")
                   .mapInArrow(_spread, "doc_id long, component long, n long, shingle long"), "shingles")
    shared = (rows.groupBy("shingle").agg(F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi"))
              .filter("lo < hi").select("shingle", "df"))
    # places in the order; shingles that only one component has stand before
    one = Window.partitionBy("doc_id")
    placed = (rows.join(unique(shared), "shingle")
              .withColumn("at", F.col("n") - F.count("*").over(one) + F.row_number().over(one.orderBy("df", "shingle"))))
    need = f"(({percent} * n + 99) div 100)"
    prefix = written(placed.filter(f"at <= n - {need} + 1").drop("df"), "prefix")
    discard(rows)
    # what most sets with a shingle are connected to already is not compared within itself
    main = (prefix.groupBy("shingle", "component").agg(F.count("*").alias("c")).groupBy("shingle")
            .agg(F.max(F.struct("c", "component")).alias("most")).select("shingle", F.col("most.component").alias("main")))
    prefix = written(prefix.join(unique(main), "shingle").withColumn("minor", F.expr("component <> main")).drop("main"), "prefix")
    # a set no larger than its partner needs fewer places
    fewer = f"((2 * {percent} * n + {99 + percent}) div {100 + percent})"
    less, more = prefix.filter(f"at <= n - {fewer} + 1").alias("s"), prefix.alias("l")
    fits = F.expr(f"""s.shingle = l.shingle and s.component <> l.component
 and (s.n < l.n or s.n = l.n and s.doc_id < l.doc_id) and 100 * s.n >= {percent} * l.n
 and {100 + percent} * (least(s.n - s.at, l.n - l.at) + 1) >= {percent} * (s.n + l.n)""")
    pairs = (less.filter("s.minor").join(more, fits).select("s.doc_id", F.col("l.doc_id").alias("other"))
             .union(less.filter("not s.minor").join(more.filter("l.minor"), fits).select("s.doc_id", F.col("l.doc_id").alias("other"))))
    return written(pairs.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct(), "pairs")


def near_dedup(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), with shingles of ``size`` words and links from
    ``percent`` hundredths of similarity on."""
    body = docs.select("doc_id", F.col("text").cast("binary").alias("body"))
    sketches = written(body.mapInArrow(_sketch(size), "doc_id long, n_shingles long, d1 long, d2 long, sketch binary"), "sketches")
    classes = (sketches.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
               .agg(F.min("doc_id").alias("first")))
    chosen = classes.groupBy("first").agg(F.min(F.struct("d1", "d2")).alias("d"))
    sets = written(sketches.select("doc_id", "n_shingles", "d1", "d2", "sketch").alias("s")
                   .join(chosen.selectExpr("first as doc_id", "d.d1", "d.d2"), ["doc_id", "d1", "d2"])
                   .dropDuplicates(["doc_id", "d1", "d2"]).select("doc_id", "d1", "d2", "n_shingles", "sketch"), "sets")
    likely = candidates(sets, percent)
    keys = written(sets.select("doc_id", "n_shingles"), "keys")
    ends = likely.selectExpr("a as doc_id").union(likely.selectExpr("b as doc_id")).distinct()
    full = full_sets(body, ends.join(keys, "doc_id"), size)
    best = likely.groupBy("b").agg(F.max(F.struct("likely", (-F.col("a")).alias("minus"))).alias("best"))
    first = confirmed(best.select((-F.col("best.minus")).alias("a"), "b"), full, percent)
    known = written(components(first), "components")
    rest = (likely.join(known.selectExpr("node as a", "component as ca"), "a", "left")
            .join(known.selectExpr("node as b", "component as cb"), "b", "left")
            .filter("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b"))
    second = confirmed(rest, full, percent)
    discard(full)
    known = written(components(known.selectExpr("node as a", "component as b").unionByName(second)), "components")
    members = crowded(sets, known, percent)
    if not members.isEmpty():
        full = full_sets(body, members.join(keys, "doc_id").select("doc_id", "n_shingles"), size)
        third = confirmed(estimated(remainder(members, full, percent), sets, percent).select("a", "b"), full, percent)
        discard(full)
        known = written(components(known.selectExpr("node as a", "component as b").unionByName(third)), "components")
    discard(sets)
    found = (classes.join(known.selectExpr("node as first", "component"), "first", "left")
             .select("d1", "d2", F.coalesce("component", "first").alias("component")))
    return (sketches.select("doc_id", "n_shingles", "d1", "d2").join(found, ["d1", "d2"], "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
                        .otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(lambda: near_dedup(documents(spark, sf_dir), size=3, percent=85), "op10")
