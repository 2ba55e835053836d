"""Whitening, spelling variants and toxicity against plain versions and on edge cases."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF001
from quire.llm import spelling, toxicity, whitening

VECTORS = "vec_id long, embedding array<float>, n string, component int, x string"


# ---- embedding whitening ------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "n", 7, "x") for i, v in rows], VECTORS)


@pytest.mark.parametrize("low, high", [(-200, 200), (0, 1), (5, 6), (-2**62, 2**62)])
def test_scatter_block_is_exact(low, high):
    x = np.random.default_rng(1).integers(low, high, (131, 5))
    x[:, 2] = x[0, 2]
    sums, products = whitening.scatter_block(x)
    o = x.astype(object)
    assert (sums == o.sum(0)).all() and (products == o.T @ o).all()


def plain_whitening(rows):
    kept = [(i, [int(np.floor(np.float64(np.float32(c)) * 256)) for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, width = len(fit), len(fit[0])
    s = [sum(x[d] for x in fit) for d in range(width)]
    v = np.array([[float(sum((x[a] - Fraction(s[a], n)) * (x[b] - Fraction(s[b], n)) for x in fit) / n)
                   for b in range(width)] for a in range(width)])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    white = {x: (np.array([float(x[d] - Fraction(s[d], n)) for d in range(width)]) @ axes / np.sqrt(e)) for x in fit}
    return kept, n, {x: sum((n * x[d] - s[d]) ** 2 for d in range(width)) for x in fit}, white, e / e.sum()


def test_whitening_matches_plain_version(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=6) * [3, 2, 1, .5, .2, .1])]) for i in range(60)]
    rows += [(7, rows[3][1]), (100, rows[4][1]), (None, rows[5][1]), (8, rows[8][1]), (8, rows[8][1])]
    bad = [(200, None), (201, [1.0] * 5 + [None]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5),
           (204, []), (205, [1.0] * 5)]
    kept, n, deviation, white, explained = plain_whitening(rows)
    out = whitening.whiten(vectors(spark, rows + bad).repartition(5)).collect()
    assert len(out) == 4 * len(kept) and {r.n for r in out} == {n}
    assert out[0].identity_error == pytest.approx(0, abs=1e-9)
    got = {}
    for r in out:
        got.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    assert Counter((i, deviation[tuple(x)]) for i, x in kept) == Counter({k: len(v) // 4 for k, v in got.items()})
    for k in range(4):
        a = sorted((r.vec_id or -1, r.deviation, r.whitened) for r in out if r.component == k + 1)
        b = sorted((i or -1, deviation[tuple(x)], white[tuple(x)][k]) for i, x in kept)
        signs = [max(abs(p[2] - sign * q[2]) for p, q in zip(a, b, strict=True)) for sign in (1, -1)]
        assert min(signs) < 1e-9


def test_whitening_edge_cases(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    same = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in
            sorted(same, key=lambda r: (r.vec_id, r.component))] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = whitening.whiten(vectors(spark, [(i, [float(i), float(2 * i), -0.0]) for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line) and line[0].identity_error < 1e-9
    huge = whitening.whiten(vectors(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])])).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in huge) and len(huge) == 6


# ---- spelling variants --------------------------------------------------------

def plain_spelling(docs, min_length=7, min_count=2, ratio=10):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, count = {}, {}
    for w in n:
        others = sorted((-n[v], v) for v in n if near(w, v))
        count[w] = len(others)
        form[w] = others[0][1] if others and -others[0][0] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], count[w], form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


DOCS = "doc_id long, text string, word string, n int, form string"


def corpus(spark, docs):
    return spark.createDataFrame([(i, t, "w", 1, "f") for i, t in docs], DOCS)


def spelled(spark, docs, **kw):
    rows = spelling.spelling_variants(corpus(spark, docs).repartition(3), **kw)
    assert rows.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, rows.collect()))


def test_spelling_matches_plain_version_on_few_letters(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abbbÀ") for _ in range(rng.choice((6, 7, 8, 9)))) for _ in range(300)]
    often = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(w.title() for w in rng.choices(words, often, k=80))) for i in range(60)]
    docs += [(3, docs[3][1]), (None, docs[4][1]), (50, None), (51, ""), (52, "1 2 ,")]
    want = plain_spelling(docs, ratio=2)
    assert max(r[2] for r in want) > 5 and any(r[5] not in (r[0], r[3]) for r in want)
    assert spelled(spark, docs, ratio=2) == want


def test_spelling_follows_forms_to_the_root(spark):
    counts = {"kartoffel": 2500, "kartoffeln": 220, "kartofeln": 20, "kartofelm": 2, "aaaaaaa": 2, "aaaaaaaa": 30, "Straße": 9}
    docs = [(next(i for i in range(100 * k, 100 * k + 99) if zlib.crc32(f"{i}:{w.lower()}".encode()) % 31), " ".join([w] * c))
            for k, (w, c) in enumerate(counts.items())]
    got = spelled(spark, docs)
    assert got == plain_spelling(docs)
    assert {r[0]: r[5] for r in got}["kartofelm"] == "kartoffel"


def test_spelling_of_nothing(spark):
    assert spelled(spark, []) == [] and spelled(spark, [(1, None), (None, "")]) == []


def test_long_words_by_digests(spark):
    """Words around the length from which digests are compared, edits in runs of equal letters among them."""
    rng = random.Random(9)
    base = "".join(rng.choice("aab") for _ in range(spelling.LONG))
    words = [base[:n] for n in range(spelling.LONG - 3, spelling.LONG + 1)] + [base + "a", base + "aa", base + "ab"]
    words += [w[:i] + rng.choice(["", "a", "b", w[i] * 2]) + w[i + 1:] for w in words for i in rng.sample(range(len(w)), 6)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(30)]
    want = plain_spelling(docs, ratio=2)
    assert {len(r[0]) for r in want if r[2]} >= {63, 64, 65, 66}
    assert spelled(spark, docs, ratio=2) == want
    long = "verylongword" * 20000
    docs = [(5, f"{long} {long} {long}x {long}x {long} {long}")]
    assert spelled(spark, docs, ratio=2) == plain_spelling(docs, ratio=2)


# ---- toxicity -----------------------------------------------------------------

LABELS = "doc_id long, toxic int, text string, lang string"


def graded(spark, docs, labels):
    docs = spark.createDataFrame([(i, t, "en", "s", 0.5) for i, t in docs], "doc_id long, text string, lang string, source string, score double")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y, "", "") for i, y in labels], LABELS), ~toxicity.held_out())
    return model, toxicity.score(docs, model)


def test_toxic_stems_are_learned(spark):
    rng = random.Random(2)
    calm = ["".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(700):
        words = [rng.choice(calm) for _ in range(rng.randint(5, 60))]
        if toxic := i % 6 == 0:
            words[rng.randrange(len(words))] = "Zwurghel" + rng.choice(["", "s", "ing", "ed", "ly", "ung"]) + rng.choice(".!,;")
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    long = " ".join(rng.choice(calm) for _ in range(150_000))
    docs += [(9001, long), (9002, long + " zwurghelest"), (9003, None), (9004, ""), (9005, "12 !?"), (None, docs[0][1])]
    _, rows = graded(spark, docs, labels)
    rows = rows.collect()
    score = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(score[i] >= toxicity.THRESHOLD) == (i % 6 == 0) for i in held]) > 0.97
    assert score[9002] >= toxicity.THRESHOLD and score[9002] > score[9001]
    assert score[9003] == score[9004] == score[9005] and score[None] == score[0]


def test_toxicity_learns_from_rows_beyond_the_first_sample(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(8, 9)))
    calm, bad = [word("abdeiklmnorstu") for _ in range(200)], [word("cfghjpqvwxyz") for _ in range(12)]
    docs = [(i, " ".join([rng.choice(calm) for _ in range(rng.randint(5, 30))] + [bad[i // 3 % 12]] * (i % 3 == 0))) for i in range(900)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'en' as lang")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    # four toxic texts to start from have at most four of the twelve words
    model = toxicity.fit(rows, labels, ~toxicity.held_out(), rows_a_label=4)
    score = {r.doc_id: r.score for r in toxicity.score(rows, model).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(score[i] >= toxicity.THRESHOLD) == (i % 3 == 0) for i in held]) > 0.95


def test_toxicity_without_two_classes(spark):
    docs = [(0, "a b"), (0, "c"), (None, "d"), (2, None)]
    for labels, expected in (([], 0.0), ([(0, 0)], 0.0), ([(0, 1), (0, 0)], 1.0), ([(None, 1), (0, None)], 0.0)):
        model, rows = graded(spark, docs, labels)
        assert model == expected and [r.score for r in rows.collect()] == [expected] * 4
    assert graded(spark, [], [])[1].collect() == []


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x, ~toxicity.held_out()) for x in (labels, other))
    assert (a.table == b.table).all() and (a.shift == b.shift).all()
    c = toxicity.score(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), a)
    assert sorted(map(tuple, toxicity.score(docs, a).collect())) == sorted(map(tuple, c.collect()))
