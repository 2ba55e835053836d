"""Fingerprints, search, tokens, surrogates, mixing and language ID, and their edge cases."""

import hmac
import random
import re
import time
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from quire.llm import bpe, fingerprints, language_id, mixing, surrogates, topk_search
from quire.llm.common import documents

SF001 = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: Extra columns have names that the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, digests string, ids int, range int, unit int, p int, body int, all int"


def frame(spark, rows):
    """Rows of doc_id, text and perhaps lang and source."""
    return spark.createDataFrame([(*r, *(None,) * (4 - len(r)), "d", 1, 2, 3, 4, 5, 6) for r in rows], DOCS)


def texts(seed, n=60):
    rng = random.Random(seed)
    alphabet = ["abcde ", "the and of in 12", "äöü éñ日本語🙂", "\n \t.,!'"]
    return ["".join(rng.choice(rng.choice(alphabet)) for _ in range(rng.choice([0, 1, 3, 20, 200, 900]))) for _ in range(n)]


def edited(docs):
    """(doc_id, text, edited text, next text) in the order of ids."""
    rows = sorted(docs, key=lambda r: r[0])
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        yield d, t, t[:len(t) - len(t) // 4] + after[:len(t) // 4], after


def likeness(a, b):
    a, b = brute.paragraphs(a), brute.paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("rows", [
    [(7 * i - 50, t) for i, t in enumerate(texts(1))], [(1, None), (2, ""), (3, "x"), (9, "\n\n")], [(4, "alone " * 50)],
    [(i, "\n".join(f"line {j} of {i % 3}" for j in range(i * 40))) for i in range(8)]])
def test_fingerprints(spark, rows):
    assert fingerprints.PARAGRAPH == brute.PARAGRAPH
    got = {r.doc_id: r for r in fingerprints.fingerprint_versions(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    prints = {}
    for d, text, other, after in edited(rows):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(other))
        assert r.near_edited == pytest.approx(likeness(text, other)) and r.near_next == pytest.approx(likeness(text, after))
        assert (r.added, r.removed) == (len(brute.paragraphs(other) - brute.paragraphs(text)), len(brute.paragraphs(text) - brute.paragraphs(other)))
        for t, p in ((text, r.fingerprint), (other, r.edited_fingerprint)):
            assert prints.setdefault(t, p) == p  # equal texts have equal fingerprints


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_fingerprints_of_documents_in_many_ranges(spark, monkeypatch, broadcast):
    for name, value in (("RANGE_ROWS", 3), ("QUANTILES", 4), ("BROADCAST_ROWS", broadcast)):
        monkeypatch.setattr(fingerprints, name, value)
    ids = [-(2**63), *random.Random(2).sample(range(-50, 1000), 40), 2**63 - 1, 2**62]
    rows = [(d, f"text {d} " * (d % 7 + 1)) for d in ids]
    got = {r.doc_id: r for r in fingerprints.fingerprint_versions(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for d, text, other, after in edited(rows):
        assert got[d].edited_sha256 == brute.sha(other) and got[d].near_next == pytest.approx(likeness(text, after))


def test_ranges_follow_the_order_of_ids_and_texts(spark, monkeypatch):
    rows = [(d, f"t{i}") for i, d in enumerate([None] * 30 + [7] * 40 + list(range(-5, 30)) + [10**12])]
    df = frame(spark, rows).withColumn("tie", F.xxhash64("text"))
    found = df.withColumn("r", fingerprints._range([-5, 1, 7, 7, 7, 25, 10**12], 5)).collect()
    found.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie))
    assert [r.r for r in found] == sorted(r.r for r in found)
    assert len({r.r for r in found if r.doc_id == 7}) == len({r.r for r in found if r.doc_id is None}) == 5


def test_fingerprints_of_a_megabyte_of_short_lines(spark):
    rows = [(d, "\n".join(f"{d} {i}" for i in range(120_000))) for d in (1, 2)]
    begin = time.monotonic()
    got = fingerprints.fingerprint_versions(frame(spark, rows)).collect()
    assert time.monotonic() - begin < 60  # the square of the lines would take hours
    for r, (_, text, other, after) in zip(sorted(got), edited(rows), strict=True):
        assert r.near_edited == pytest.approx(likeness(text, other), abs=1e-3) and r.near_next == 0


def test_fingerprints_of_null_and_repeated_ids_and_of_nothing(spark):
    rows = [(None, "a"), (2, "b"), (2, "b"), (2, "c"), (None, None)]
    assert len(fingerprints.fingerprint_versions(frame(spark, rows)).collect()) == 5
    assert fingerprints.fingerprint_versions(frame(spark, [])).collect() == []


def test_sketches_use_sql_only(spark):
    plan = fingerprints.fingerprint_versions(frame(spark, [(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def vectors(seed, n=400, size=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, size))
    rows = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, size)) * rng.choice([0.0, 0.3, 2.0], (n, 1))
    return [(int(i), [float(np.float32(x)) for x in row], "x", 1) for i, row in enumerate(rows)]


def nearest(rows, k, every):
    codes = {i: [x is not None and x > 0 for x in v] for i, v, *_ in rows if v and i is not None}
    out = []
    for q in (i for i in codes if i % every == 0):
        order = sorted((sum(a != b for a, b in zip(codes[q], c)), i) for i, c in codes.items() if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("rows,k", [(vectors(1), 10), (vectors(2, 60), 3), (vectors(3, 30, 12), 50),
                                    ([(0, [1.0], "x", 1), (1, None, "x", 1), (2, [], "x", 1), (50, [-1.0], "x", 1), (None, [1.0], "x", 1), (3, [None], "x", 1)], 4)])
def test_top_k(spark, rows, k):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code string, seg int")
    got = topk_search.top_k(table, table.filter(F.col("vec_id") % 10 == 0), k=k)
    assert sorted(map(tuple, got.collect())) == nearest(rows, k, 10)


def crowded(seed):
    """Few codes and ids: a query's id stands several times in its own code and in others."""
    rng = random.Random(seed)
    near = [[1.0 if i > j else -1.0 for i in range(64)] for j in range(12)]
    return ([(0, v) for v in near] + [(0, near[0])] * 14 + [(i, near[0]) for i in range(1, 8)] * 2
            + [(rng.choice([3, 10, 20, 21, 22]), rng.choice(near)) for _ in range(20)])


@pytest.mark.parametrize("rows,k", [([(0, [1.0] * 8)] * 2 + [(i, [1.0] * 8) for i in range(1, 11)] + [(11, [-1.0] * 8)], 10),
                                    ([(0, [1.0] * 8)] * 9 + [(i, [1.0] * 8) for i in range(1, 6)] + [(11, [-1.0] * 8)], 4),
                                    (crowded(1), 3), (crowded(2), 10)])
def test_top_k_of_a_repeated_query_id(spark, rows, k):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk_search.top_k(table, table.filter("vec_id % 10 = 0"), k=k).select("query_id", "neighbour_id", "distance").collect()
    codes = [(i, tuple(x > 0 for x in v)) for i, v in rows]
    expected = []
    for query in {i for i, _ in codes if i % 10 == 0}:
        own = {c for i, c in codes if i == query}
        found = sorted((sum(x != y for x, y in zip(c, o)), i) for c in own for i, o in codes if i != query)
        expected += [(query, i, d) for d, i in found[:k]]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_top_k_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(table, table).collect() == []


def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(open(PATH, "rb").read()), special_tokens={})


def test_bpe_as_the_library(spark):
    rows = [(i, t) for i, t in enumerate(texts(5, 150))] + [(900, None), (901, "a" * 20_000), (902, "\x1c\x85 　 x"), (None, "a")]
    got = {r.doc_id: r for r in bpe.digests(frame(spark, rows), PATH, PATTERN).collect()}
    enc = encoding()
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == brute.sha(np.array(ids, dtype="<u4").tobytes())
        assert got[d].decoded_sha256 == brute.sha(t or "")


def test_bpe_on_documents(spark):
    enc = encoding()
    docs = {r.doc_id: r.text for r in documents(spark, SF001).collect()}
    for r in bpe.encode(documents(spark, SF001), PATH, PATTERN).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(docs[r.doc_id])


def test_bpe_decodes_any_ids_and_keeps_columns(spark):
    ids = spark.createDataFrame([(1, bytearray(np.array([228, 100, 65, 7], "<u4").tobytes()), "k")], "doc_id long, ids binary, kept string")
    bytes_of = {i: b for b, i in bpe.read_ranks(open(PATH, "rb").read()).items()}
    row = bpe.decode(ids, PATH).first()
    want = b"".join(bytes_of[i] for i in (228, 100, 65, 7))
    assert bytes(row.decoded) == want and row.text == want.decode("utf-8", "replace") and row.kept == "k"


def test_utf8_machine_holds_unfinished_characters():
    data = "aé日🙂z".encode()
    for size in (1, 2, 3, 5):
        machine = bpe.Utf8Stream()
        parts = [machine.feed(data[i:i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + machine.end() == "aé日🙂z"
    machine = bpe.Utf8Stream()
    assert machine.feed(b"\xf0\x9f") == "" and machine.end() == "�"


def test_transducer_forgets_and_begins_anew(monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    ranks = bpe.read_ranks(open(PATH, "rb").read())
    pieces, enc = bpe.Pieces(bpe.Transducer(ranks)), encoding()
    for t in texts(8, 40):
        packed = b"".join(pieces[p] for p in regex.findall(PATTERN, t))
        assert np.frombuffer(packed, "<u4").tolist() == enc.encode_ordinary(t)


PRIVATE = [
    (1, "Mail Bob.Smith99@Mail7.Example.com or +1 (743) 555-3824, card 4111 1111 1111 1111 and 4111111111111111."),
    (2, 'bob.smith99@mail7.example.com; IP 233.254.104.120 v 4.0. token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'),
    (3, "Mr. John Smith met Mrs Mary Jones and Mary Smith; Dr. Müller. Frau Иванова and Herr Иван Петров"),
    (4, None), (5, ""), (6, "clean text 2.0. 1999, no 12-34"), (None, "7536784127813050 4845168114407329 123-45-6789"), (1, "10.0.0.1 10.0.0.2")]


def luhn(number):
    digits = [int(c) for c in number][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates(spark):
    got = surrogates.replaced(frame(spark, PRIVATE)).collect()
    assert len(got) == len(PRIVATE)
    by = {(r.doc_id, (r.text or "")[:4]): r for r in got}
    clean = {r.doc_id: r.text for r in got if r.doc_id in (4, 5, 6)}
    assert clean == {4: None, 5: "", 6: PRIVATE[5][1]}
    first, second = by[(1, "Mail")].text, next(r.text for r in got if r.doc_id == 2)
    mail = re.search(r"\S+@\S+", first).group()
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{4}\d\d@[A-Z][a-z]{3}\d\.[A-Z][a-z]{6}\.com", mail)
    assert second.startswith(mail.lower() + ";")                        # one entity however it is written
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4},", first) and "743" not in first
    spaced, plain = re.search(r"card ([\d ]+) and (\d+)\.", first).groups()
    assert spaced.replace(" ", "") == plain and plain[0] == "4" and luhn(plain) and plain != "4" + "1" * 15
    people = next(r.text for r in got if r.doc_id == 3)
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+) and (\w+) (\w+); Dr\. (\w+)\. Frau (\w+) and Herr (\w+) (\w+)", people)
    assert m and m[2] == m[6] and m[3] == m[5] and m[3].endswith("a") and m[1].endswith("n")
    assert re.fullmatch("[А-Яа-я]+", m[8] + m[9] + m[10])
    for secret in ("Smith", "Mary", "233.254", "04dbebab", "75367841", "123-45"):
        assert not any(secret in (r.text or "") for r in got)
    assert {k for r in got for k in r.kinds} == {"mail", "phone", "card", "address", "token", "person", "social"}


NAMES = ["Dr. Anna Maria Schmidt", "John Michael Smith", "Mr. Ludwig van Beethoven", "Frau Dr. Müller", "Mr. McDonald", "Mary O'Brien",
         "Mr. J. Smith", "MRS SMITH", "Hans-Peter Müller", "Dr. von Braun", "Prof. Dr. Jean-Luc de la Cruz", "Mr Smith-Jones"]
KEPT = {"Dr.", "Mr.", "Mr", "Frau", "MRS", "Prof.", "van", "von", "de", "la"}


@pytest.mark.parametrize("name", NAMES)
def test_surrogates_replace_every_word_of_a_name(spark, name):
    [row] = surrogates.replaced(frame(spark, [(1, f"then {name} said so")])).collect()
    assert row.text.startswith("then ") and row.text.endswith(" said so") and row.n_entities == 1 and row.kinds == ["person"]
    new = row.text[5:-8].split(" ")
    assert len(new) == len(name.split(" "))
    assert all((a == b) == (a in KEPT) and a.isupper() == b.isupper() for a, b in zip(name.split(" "), new, strict=True) if a != "J.")


def test_surrogates_of_bare_mentions_and_one_key_for_a_name(spark):
    rows = [(1, "Mr. John Smith's. Later Smith left, Smithers and John stayed; SMITH"), (2, "Smith alone"), (3, "Dr. Emma Jones"),
            (4, "Mrs. Emma Jones"), (5, "call 743-555-3824 or +1 743 555 3824"), (6, "Mr. X Y"), (7, "Dr. Smith I think")]
    got = {r.doc_id: r for r in surrogates.replaced(frame(spark, rows)).collect()}
    m = re.fullmatch(r"Mr\. (\w+) (\w+)'s\. Later (\w+) left, Smithers and (\w+) stayed; SMITH", got[1].text)
    assert m and m[2] == m[3] != "Smith" and m[1] == m[4] != "John" and got[1].n_entities == 3
    assert got[2].text == "Smith alone" and got[7].text == f"Dr. {m[2]} I think"
    assert got[3].text[4:] == got[4].text[5:] and got[3].text.split(" ")[1].endswith("a")
    a, b = re.fullmatch(r"call (\d{3}-\d{3}-\d{4}) or \+1 (\d{3} \d{3} \d{4})", got[5].text).groups()
    assert a.replace("-", "") == b.replace(" ", "") != "7435553824"


def test_surrogates_depend_on_the_key_by_hmac(spark):
    df = spark.createDataFrame([("given", "emma", "", 0)], "kind string, norm string, sex string, tries int")
    for key in ("a", "b" * 100):
        own = df.select(F.expr(surrogates._hash(key, "kind", "norm"))).first()[0]
        assert own == hmac.new(key.encode(), b"given|emma|0|0", "sha256").hexdigest()
    one, two = (surrogates.replaced(frame(spark, [(1, "Mr. Smith")]), key).first().text for key in ("a", "b"))
    assert one != two


def test_surrogates_stay_distinct(spark):
    # far more addresses of one octet pattern than chance keeps apart: tries are needed
    rows = [(i, f"from {i % 250 + 1}.{i // 250 + 1}.7.9 to") for i in range(3000)]
    got = {r.doc_id: r.text.split(" ")[1] for r in surrogates.replaced(frame(spark, rows)).collect()}
    assert len(set(got.values())) == 3000
    assert not set(got.values()) & {t.split(" ")[1] for _, t in rows}
    short = [(i, f"Mr. N{chr(97 + i // 26)}{chr(97 + i % 26)}m here") for i in range(600)]
    names = [r.text.split(" ")[1] for r in surrogates.replaced(frame(spark, short)).collect()]
    assert len(set(names)) == 600
    again = [r.text.split(" ")[1] for r in surrogates.replaced(frame(spark, short[::-1])).collect()]
    assert sorted(names) == sorted(again)


def test_surrogates_use_sql_only(spark):
    df = surrogates.replaced(frame(spark, PRIVATE))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
    assert surrogates.replaced(frame(spark, [])).collect() == []


def mix_corpus(seed, n=300):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "", "w " * rng.randint(1, 40), "w " * rng.choice([1, 3, 900 if i % 97 == 0 else 5])]), None,
             rng.choice([None, "", "b", "a", "é", "z", "hot", "hot", "hot"])) for i in range(n)]


@pytest.mark.parametrize("seed,group", [(1, 2000), (2, 7)])
def test_mixing(spark, monkeypatch, seed, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    rows = mix_corpus(seed)
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    size = {i: len(brute.WORD.findall(t or "")) for i, t, *_ in rows}
    per = Counter()
    for i, _, _, s in rows:
        per[s] += size[i]
    want = brute.targets(per)
    taken = Counter()
    for r in got:
        assert (r["size"], r.source_size) == (size[r.doc_id], per[r.source]) and r.copies in (0, 1, 2)
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        taken[r.source] += r.copies * r["size"]
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(1.5 * sum(per.values()))
    for s in per:
        assert abs(taken[s] - want[s]) <= max(size.values())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    copies = {r.doc_id: r.copies for r in got}
    made = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert made == Counter({i: c for i, c in copies.items() if c})


def test_mixing_keeps_expected_copies(spark):
    rows = [(i, "w " * (i % 9 + 1), None, "a" if i % 3 else "b") for i in range(60)]
    docs = frame(spark, rows)
    rate, total = {}, Counter()
    for seed in range(12):
        for r in mixing.mix(docs, seed=seed).collect():
            rate[r.source] = r.target / r.source_size
            total[r.source] += r.copies
    for s, n in (("a", 40), ("b", 20)):
        assert total[s] / (12 * n) == pytest.approx(rate[s], abs=0.12)


def test_mixing_edges(spark):
    same = [(1, "a b c", None, "x")] * 4 + [(None, "a b", None, None), (None, None, None, None)]
    got = mixing.mix(frame(spark, same)).collect()
    assert len(got) == 6 and {r["size"] for r in got} == {0, 2, 3}
    assert mixing.mix(frame(spark, [])).collect() == [] and mixing.mixed(frame(spark, [])).collect() == []
    only = mixing.mix(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r.target, r.copies) for r in only] == [(0, 0.0, 0)] * 2
    made = mixing.mixed(frame(spark, same)).collect()
    assert len(made) == sum(r.copies for r in got) and mixing.mixed(frame(spark, same)).columns == frame(spark, []).columns


def test_language_id_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = language_id.fit(docs, language_id.learn_from())
    rows = language_id.predict(docs, model, ("doc_id", "lang")).collect()
    held = [r for r in rows if brute.held_out(r.doc_id)]
    assert len(rows) == 1000 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.reject for r in rows) <= 10


def test_language_id_learns_only_from_the_rows_it_may(spark):
    words = {"en": "the and of to in that", "fr": "le la les des que une"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(words[x].split()) for _ in range(12)), x, "s") for i in range(200) for x in [rng.choice(["en", "fr"])]]
    wrong = [(i, t, "zz" if brute.held_out(i) else x, s) for i, t, x, s in rows]
    a = language_id.fit(frame(spark, rows), language_id.learn_from())
    b = language_id.fit(frame(spark, wrong), language_id.learn_from())
    assert a.languages == b.languages == ["en", "fr"] and (a.table == b.table).all()
    odd = [(1, None), (2, ""), (3, "123 !? \n"), (4, "the"), (None, "les des"), (5, "le " * 100_000), (6, "日本語")]
    got = {r.doc_id: r for r in language_id.predict(frame(spark, odd), a).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and [got[i].score for i in (1, 2, 3)] == [0, 0, 0]
    assert (got[4].lang_pred, got[None].lang_pred, got[5].lang_pred) == ("en", "fr", "fr") and got[6].lang_pred in ("en", "fr")
    assert all(got[i].reject for i in (1, 2, 3)) and not got[5].reject


def test_language_id_without_labels(spark):
    rows = [(1, "some text"), (2, None)]
    assert language_id.fit(frame(spark, rows), language_id.learn_from()) is None
    assert {r.lang_pred for r in language_id.predict(frame(spark, rows), None).collect()} == {"und"}
    assert language_id.predict(frame(spark, []), None).collect() == []
