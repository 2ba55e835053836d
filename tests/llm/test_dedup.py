"""Substring, line and near dedup against plain versions, and their edge cases."""

import random

import brute
import pytest

from quire.llm import line_dedup, near_dedup, substring_dedup, suffix_dedup
from quire.llm.components import components

DOCS = "doc_id long, text string, anchor string, piece long, at int, key int, first string, range int, _n int, n int"


def frame(spark, rows):
    """Extra columns have names that the operators use inside."""
    return spark.createDataFrame([(d, t, "x", 7, 1, 2, "y", 3, 4, 5) for d, t in rows], DOCS)


def corpus(seed, n=60, words="abcdefgh"):
    """Few words, so that passages repeat by chance; copies, near copies, one common passage."""
    rng = random.Random(seed)
    common = " ".join(rng.choice("lmnop") for _ in range(40))
    rows = []
    for d in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 12, 13, 14, 60, 200])))
        if d % 3 == 0:
            text += "\n" + common + "\n" + text[:50]
        if rows and d % 5 == 0:
            text = rng.choice(rows)[1]
        if rows and d % 7 == 0:
            text = rng.choice(rows)[1].replace("a", "b", 1)
        rows.append((d * 3 + 1, text))
    return rows


def passages(seed, n=40):
    """Long passages of rare words that documents share, among other rare words."""
    rng = random.Random(seed)
    shared = [" ".join(f"w{rng.random():.6f}" for _ in range(rng.choice([13, 30, 55]))) for _ in range(5)]
    rows = []
    for d in range(n):
        parts = [" ".join(f"v{rng.random():.6f}" for _ in range(rng.randint(0, 30)))]
        for p in rng.sample(shared, rng.randint(0, 2)):
            cut = p.split(" ")
            parts += [" ".join(cut[rng.randint(0, 3):len(cut) - rng.randint(0, 3)]), f"u{rng.random()}"]
        rows.append((n - d, "\t ".join(parts)))
    return rows


EDGES = [(5, None), (9, ""), (2, " \n\t "), (3, "word"), (4, "é" * 60), (1, "é" * 60), (8, "x " * 300), (7, "x " * 40), (6, "x " * 13)]


@pytest.mark.parametrize("rows", [corpus(1), corpus(2, words="ab"), passages(3), EDGES, [(1, "a b c " * 2000), (0, "b c a " * 30)]])
def test_substring_dedup(spark, rows):
    got = substring_dedup.substring_dedup(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.substring_words(rows))


@pytest.mark.parametrize("rows", [corpus(1), corpus(2, words="ab"), passages(3), EDGES, [(1, "abc" * 3000), (0, "bca" * 90)]])
def test_suffix_dedup(spark, rows):
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.substring_bytes(rows))


def test_substring_dedup_general_parameters(spark):
    rows = corpus(4, 30)
    got = substring_dedup.substring_dedup(frame(spark, rows), k=4, q=4).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.substring_words(rows, 4))


def test_substring_dedup_repeated_rows_and_ids(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(2, passage), (2, passage), (1, passage + " q"), (2, "other " + passage), (None, passage)]
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert got == {(2, 20, 20), (1, 21, 0), (2, 21, 20), (None, 20, 0)}
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).collect()
    assert len(got) == 5 and {r.n_removed for r in got if r.doc_id in (None, 1)} == {0}


def test_verification_drops_a_span_that_differs_at_its_source(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(20))), (2, " ".join(f"b{i}" for i in range(20)))]
    wrong = spark.createDataFrame([(2, 0, 0, 5, 1, 0, 0)], "doc_id long, key int, at int, count int, source_id long, source_key int, source_at int")
    assert substring_dedup.verified(frame(spark, rows), wrong).count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert substring_dedup.substring_dedup(none).collect() == []
    assert suffix_dedup.suffix_dedup(none).collect() == []
    assert line_dedup.line_dedup(none).collect() == []
    assert near_dedup.near_dedup(none).collect() == []


def line_corpus(seed):
    rng = random.Random(seed)
    return [(d, "\n".join(rng.choice(["", " ", "a", "b", "c", "long line"]) for _ in range(rng.randint(0, 25)))) for d in range(40)]


@pytest.mark.parametrize("rows", [line_corpus(1), line_corpus(2), corpus(3), [(1, None), (2, ""), (3, "a\na\na\na\na"), (4, "a\na\na")]])
def test_line_dedup(spark, rows):
    got = line_dedup.line_dedup(frame(spark, rows)).select("doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.lines(rows))


def test_line_dedup_of_short_texts_and_long_lines(spark):
    long, longer = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(400))
    rows = [(1, "a\nb"), (2, "a\n\nb"), (3, "a\nb\nc"), (4, "b"), (5, "b\n"), (6, f"x\n{long}"), (7, f"{long}\ny\n{longer}"),
            (8, f"{longer}\n{long}\n{longer}"), (9, long[:-4]), (10, f"z\n{long[:-4]}")]
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert {d: r.n_removed for d, r in got.items()} == {1: 0, 2: 2, 3: 0, 4: 0, 5: 1, 6: 0, 7: 1, 8: 3, 9: 0, 10: 0}
    assert (got[2].text, got[7].text, got[8].text) == ("", f"y\n{longer}", "")
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.kept_sha256) for r in got.values()) == sorted(brute.lines(rows))


def test_line_dedup_keeps_null_text_null_ids_and_asked_columns(spark):
    rows = [(None, "a\nb\nc"), (2, "a\nb\nc"), (1, "a\nb\nc"), (3, None)]
    got = line_dedup.line_dedup(frame(spark, rows), columns=("doc_id", "at", "first")).collect()
    assert {(r.doc_id, r.text, r["at"], r["first"]) for r in got} == {(None, "a\nb\nc", 1, "y"), (2, "", 1, "y"), (1, "a\nb\nc", 1, "y"), (3, None, 1, "y")}


def test_winnowing_marks_every_window_and_the_rightmost_of_equals():
    assert line_dedup.fingerprints([b"b", b"a", b"a", b"c", b"d", b"a"], 3) == [2, 2, 2, 5]
    assert line_dedup.fingerprints([b"b", b"a"], 3) == []


def near_corpus(seed, n=50):
    """Hubs whose copies are near the hub but not each other, chains, exact copies, short texts."""
    rng = random.Random(seed)
    rows = []
    for hub in range(n // 10):
        words = [f"h{hub}w{i}" for i in range(150)]
        rows.append(words)
        for copy in range(9):
            own = list(words)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
                own[rng.randrange(len(own))] = f"e{rng.random()}"
            rows.append(own)
    rows += [["A", "b"], ["a", "B"], ["a"], [], ["one", "two", "three"], ["One", "two", "three"]]
    rng.shuffle(rows)
    return [(d, " ".join(w)) for d, w in enumerate(rows)]


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 85), (2, 3, 85), (3, 5, 80), (4, 5, 80), (5, 1, 50)])
def test_near_dedup(spark, seed, size, percent):
    rows = near_corpus(seed) + [(900, None), (901, "\n")]
    got = near_dedup.near_dedup(frame(spark, rows), size, percent).collect()
    assert sorted(map(tuple, got)) == sorted(brute.near(rows, size, percent))


@pytest.mark.parametrize("percent,rows", [(85, 6), (80, 5), (95, 11)])
def test_bands_leave_pairs_at_the_threshold_one_in_common(percent, rows):
    assert near_dedup.band_rows(percent) == rows
    assert (1 - (percent / 100) ** rows) ** (192 // rows) <= near_dedup.MISSED


def test_near_dedup_of_one_large_group(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(400):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(300)] = f"e{d}"
        rows.append((d, " ".join(own)))
    assert sorted(map(tuple, near_dedup.near_dedup(frame(spark, rows), 3, 85).collect())) == sorted(brute.near(rows))


@pytest.mark.parametrize("filled,shared", [(20, 3), (24, 6)])
def test_near_dedup_of_a_template_whose_only_links_are_pairs(spark, filled, shared):
    # the template alone makes 0.83 or 0.81, with what a pair shares 0.86
    template = [f"t{i}" for i in range(202)]
    rows = []
    for d in range(120):
        own = [f"p{d // 2}w{i}" for i in range(shared)] + [f"d{d}w{i}" for i in range(filled - shared)]
        rows.append((d, " ".join(template + own)))
    expected = brute.near(rows)
    assert len({component for _, _, component, _ in expected}) == 60
    assert sorted(map(tuple, near_dedup.near_dedup(frame(spark, rows), 3, 85).collect())) == sorted(expected)


def test_near_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = near_dedup.near_dedup(frame(spark, [(None, text), (2, text), (2, text), (1, text), (None, None)])).collect()
    assert sorted((r.component_id or 0, r.kept) for r in got) == [(0, True), (0, True), (1, False), (1, False), (1, True)]


def test_likelihood_estimate_is_near_the_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        ids = rng.integers(0, 1 << 62, 4000, dtype=np.uint64)
        cut = int(4000 * (1 - share) / 2)
        a, b = np.sort(ids[:4000 - cut]), np.sort(ids[cut:])
        rows = near_dedup.registers(np.concatenate([a, b]), np.array([0, len(a)]))
        likely = near_dedup.estimate(rows[:1], rows[1:], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(likely - len(np.intersect1d(a, b)) / 4000) < 0.12


def test_components(spark):
    rng = random.Random(3)
    for edges in ([(i, i + 1) for i in range(0, 60)], [(0, i) for i in range(1, 50)], [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]):
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        nodes = {x for e in edges for x in e if e[0] != e[1]}
        assert got == {n: c for n, c in brute.components(range(200), edges).items() if n in nodes}


def test_components_of_one_task_need_no_round(spark, monkeypatch):
    from quire.llm import components as module

    names = []
    monkeypatch.setattr(module, "written", lambda df, name, keep=module.written: names.append(name) or keep(df, name))
    edges = spark.createDataFrame([(i, i + 1) for i in range(3000)], "a long, b long").coalesce(1)
    assert {r.component for r in components(edges).collect()} == {0} and names == ["edges"]


def test_anchors_are_sought_without_naming_whole_windows(spark, monkeypatch):
    import pyarrow as pa

    from quire.llm import grams, repeats

    asked = []
    monkeypatch.setattr(grams, "gram_ids", lambda t, sizes, lane=0, keep=grams.gram_ids: asked.append(sizes) or keep(t, sizes, lane))
    text = bytes(random.Random(5).choices(b"abcd", k=300))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([text, b"", b"x" + text])], ["doc_id", "body"])
    (out,) = repeats._anchors(repeats.Spec(False, 50, (20, 40, 50)))(iter([batch]))
    assert asked == [[20]] and len(out.column("shared")[0].as_py()) > 5


def test_windows_are_named_in_chunks_that_stay_in_cache(monkeypatch):
    import numpy as np

    from quire.llm import grams

    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab", k=n)) for n in (40_000, 3, 0, 50, 30_000)]
    starts = np.cumsum([0, *map(len, texts)])
    tokens = grams.BYTE_VALUE[0][np.frombuffer(b"".join(texts), np.uint8)]
    longest = []
    monkeypatch.setattr(grams, "gram_ids", lambda t, sizes, lane=0, keep=grams.gram_ids: longest.append(len(t)) or keep(t, sizes, lane))
    chunked = [grams.Windows(tokens, starts, 50, q) for q in (20, 40, 50)]
    assert max(longest) < 20_000 and len(longest) > 9
    monkeypatch.setattr(grams, "CHUNK", 1 << 40)
    for w, q in zip(chunked, (20, 40, 50), strict=True):
        whole = grams.Windows(tokens, starts, 50, q)
        for name in ("window", "at", "count", "anchor"):
            assert np.array_equal(getattr(w, name), getattr(whole, name)), (q, name)
    assert np.array_equal(grams.window_ids(tokens, 50), chunked[0].window)


def test_anchors_and_pieces_are_shuffled_once_for_all_their_reads(spark, monkeypatch):
    from quire.llm import repeats

    dealt = {}

    def kept(df, name, keep=repeats.written):
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        dealt[name] = sum("REPARTITION_BY_COL" in line and "ReusedExchange" not in line for line in plan)
        return keep(df, name)

    monkeypatch.setattr(repeats, "written", kept)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that a plan shows what it reuses before it runs
    try:
        text = "".join(random.Random(9).choices("abcdefgh", k=400))
        docs = spark.createDataFrame([(1, text), (2, "x" * 60 + text[100:300])], "doc_id long, text string")
        places = repeats.repeated_pieces(docs, repeats.Spec(False, 50, (20, 40, 50))).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert {r.doc_id for r in places} == {2}
    assert {n: dealt[n] for n in ("known", "judged0", "judged1", "judged2")} == dict.fromkeys(("known", "judged0", "judged1", "judged2"), 1)
