"""Steps that must not grow faster than their input: results and plans against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import cooccurrence, sentence_model, suffix_rules, tfidf, vectors


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [64 << 20, 64])
def test_mean_vectors_shuffle_no_word_vectors(spark, monkeypatch, limit):
    monkeypatch.setattr(vectors, "MAX_BROADCAST_BYTES", limit)
    docs = [(1, ["a", "b", "a", "x"]), (2, []), (3, None), (4, ["b"]), (4, ["b"]), (5, ["x"])]
    df = spark.createDataFrame(docs, "id long, tokens array<string>").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    counts = vectors.word_counts(df, "id")
    known = {(r.id, r.word): r.c for r in counts.filter("id < 4 and word is not null").collect()}
    assert known == {(1, w): c for w, c in Counter(docs[0][1]).items()}
    table = {"a": [1.0, 2.0, 0.5], "b": [0.0, -4.0, 8.0], "c": [9.0, 9.0, 9.0], "d": [7.0, 7.0, 7.0]}
    words = spark.createDataFrame(list(table.items()), "word string, vector array<double>")
    out = vectors.mean_vectors(counts, "id", words, len(table), 3)
    assert "ObjectHashAggregate" not in _plan(out) and "Exchange hashpartitioning(word" not in _plan(out)
    got = {(r.id, r.dim): r.value for r in out.collect()}
    plain = {1: [0.5, 0.0, 2.25], 2: [0.0] * 3, 3: [0.0] * 3, 4: [0.0, -8.0, 16.0], 5: [0.0] * 3}
    assert got == {(i, d): v for i, row in plain.items() for d, v in enumerate(row)}


def test_pairs_are_counted_where_documents_are(spark, monkeypatch):
    docs = [(1, "a b a x c".split()), (2, []), (3, None), (4, "c a".split()), (None, "b b".split())]
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    vocab = spark.createDataFrame([("a", 3), ("b", 3), ("c", 2)], "word string, n long")
    known = cooccurrence.known_tokens(df, "id", vocab)
    assert "Exchange" not in _plan(known)
    again = df.unionByName(df.filter("id = 4"))  # of two rows with an id, the tokens become one list
    got = []
    for limit in (64 << 20, 0):
        monkeypatch.setattr(cooccurrence, "MAX_BROADCAST_BYTES", limit)
        assert sorted(map(tuple, cooccurrence.known_tokens(df, "id", vocab).collect()), key=str) == [
            (1, ["a", "b", "a", "c"]), (4, ["c", "a"]), (None, ["b", "b"])]
        for keep in (False, True):
            pairs = cooccurrence.cooccurrence(cooccurrence.known_tokens(again, "id", vocab), window=2, vocab=vocab, keep=keep)
            got.append(sorted(map(tuple, pairs.collect())))
    assert all(x == got[0] for x in got) and ("b", "b", 2) in got[0]


def _worded(spark):
    """Documents of rare and frequent words, some of them not listed, and their pairs at most 3 tokens apart."""
    draw = random.Random(5)
    docs = [[draw.choice(["w", f"w{draw.randrange(9)}", f"w{draw.randrange(60)}", None, "x"]) for _ in range(draw.randrange(40))] for _ in range(60)]
    listed = sorted({w for d in docs for w in d if w and w != "x"})
    pairs = Counter((d[i], d[j]) for d in docs for i in range(len(d)) for j in range(max(0, i - 3), min(len(d), i + 4))
                    if i != j and {d[i], d[j]} <= set(listed))
    df = spark.createDataFrame([*enumerate(docs), (99, None)], "id long, tokens array<string>").repartition(3)
    return df, listed, pairs


@pytest.mark.parametrize("counted", [True, False])
def test_pairs_are_shuffled_many_in_a_row(spark, monkeypatch, counted):
    for name, value in (("PAIRS_AT_ONCE", 300), ("PAIRS_A_ROW", 16), ("PAIRS_A_PART", 500), ("FEWEST_A_PART", 500)):
        monkeypatch.setattr(cooccurrence, name, value)
    df, listed, pairs = _worded(spark)
    vocab = spark.createDataFrame([(w, 5) for w in listed], "word string, n long").select(*(["word", "n"] if counted else ["word"]))
    out = cooccurrence.cooccurrence(df, window=3, vocab=vocab)
    assert "HashAggregate" not in _plan(out)  # no row of a single pair is shuffled
    assert {(r.word, r.context): r.n for r in out.collect()} == pairs
    sums = cooccurrence.pair_sums(df, window=3, vocab=vocab)
    assert sum(r.size for r in sums.sums.collect()) == len({tuple(sorted(p)) for p in pairs}) and sums.sums.count() < len(pairs) / 5
    assert cooccurrence.cooccurrence(df.limit(0), window=3, vocab=vocab).collect() == []
    assert cooccurrence.cooccurrence(df, window=3, vocab=vocab.limit(0)).collect() == []


def test_numbered_pairs_have_the_vectors_of_rows(spark, monkeypatch):
    df, listed, pairs = _worded(spark)
    vocab = spark.createDataFrame([(w,) for w in listed], "word string")
    sums, rows = (f(df, window=3, vocab=vocab, keep=True) for f in (cooccurrence.pair_sums, cooccurrence.cooccurrence))
    out = cooccurrence.pmi(sums, 0.25)
    assert "Join" not in _plan(out)
    got, want = ({(r.word, r.context, r.n): r.pmi for r in x.collect()} for x in (out, cooccurrence.pmi(rows, 0.25)))
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()), rtol=0, atol=1e-12)
    values, table = cooccurrence.pmi_vectors(rows, 4, iterations=3, shift=0.25)
    want = {r.word: r.vector for r in table.collect()}
    monkeypatch.setattr(cooccurrence, "PAIRS_A_ROW", 16)
    for limit in (64 << 20, 8 * 4 * 7):  # vectors are sent at once, or of 7 words
        monkeypatch.setattr(cooccurrence, "MAX_BROADCAST_BYTES", limit)
        again, table = cooccurrence.pmi_vectors(sums, 4, iterations=3, shift=0.25)
        got = {r.word: r.vector for r in table.collect()}
        assert np.allclose(again, values, rtol=1e-9) and got.keys() == want.keys()
        assert np.allclose(np.array([got[w] for w in want]), np.array(list(want.values())), atol=1e-7)
    none = cooccurrence.pair_sums(df.limit(0), window=3, vocab=vocab)
    assert cooccurrence.pmi(none).collect() == [] and cooccurrence.pmi_vectors(none, 4)[1].collect() == []


def test_rules_are_applied_where_documents_are(spark, monkeypatch):
    rules = spark.createDataFrame([("s", 1, ""), ("ies", 3, "y"), ("boxes", 5, ""), ("", 0, "")], "suffix string, cut int, added string")
    docs = spark.createDataFrame([(1, "Cats, flies boxes"), (2, None), (3, "cats 12"), (3, "dogs"), (None, "cats")], "id long, text string")
    unique = docs.filter("id < 3")
    assert "Exchange" not in _plan(suffix_rules.lemmatize(unique, "id", rules))
    want = [(1, ["cat", "fly", "boxes"]), (2, []), (3, ["cat", "dog"]), (3, ["cat", "dog"]), (None, [])]
    for limit in (200_000, 0):
        monkeypatch.setattr(suffix_rules, "MAX_SENT_RULES", limit)
        got = sorted(((r.id, r.LEMMAS if r.id != 3 else sorted(r.LEMMAS)) for r in suffix_rules.lemmatize(docs, "id", rules).collect()), key=str)
        assert got == sorted(want, key=str)


def test_terms_are_counted_within_the_row(spark):
    docs = [(1, ["a b", "b c", "a b"]), (2, []), (3, None), (4, ["x y", None]), (4, ["x y"])]
    df = spark.createDataFrame(docs, "id long, ngrams array<string>")
    assert "Exchange" not in _plan(tfidf.term_tf(df.filter("id < 4"), "id"))
    assert sorted(map(tuple, tfidf.term_tf(df, "id").collect())) == [(1, "a b", 2), (1, "b c", 1), (4, "x y", 2)]


def test_distinct_tokens_are_typed_once(spark):
    df = spark.createDataFrame([(1, "Mr. Fox ran. Mr. Fox!) 5 ran")] * 50, "doc_id long, text string")
    typed = sentence_model.typed_tokens(df)
    assert typed.count() == 6 and typed.agg(F.sum("n")).first()[0] == 350
    assert {tuple(r) for r in sentence_model.type_counts(typed).collect()} == {
        ("mr", 100, 0), ("fox", 0, 100), ("ran", 50, 50), ("##", 0, 50)}
    ends = sorted(map(tuple, sentence_model.typed_ends(df).select("kind", "dotted", "sure", "next_kind", "n").collect()))
    assert ends == [("fox", False, True, "##", 50), ("mr", True, False, "fox", 50), ("mr", True, False, "fox", 50), ("ran", True, False, "mr", 50)]


def test_large_buckets_are_not_joined_again(spark, monkeypatch):
    from quire.llm import near_dedup

    plans, kept = {}, near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: (plans.setdefault(name, _plan(df)), kept(df, name))[1])
    words = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(i, f"{words} end{i}") for i in range(12)], "doc_id long, text string")
    out = near_dedup.near_dedup(docs).collect()
    assert {r.component_id for r in out} == {0}
    assert "LeftSemi" not in plans["pairs"]
