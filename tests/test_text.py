from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import corpus


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_text_ascii_word_class(spark):
    # accents split words; underscore, digits and case are kept; no trim
    assert one(spark, T.clean_text("x"), "état a_b 42") == " tat a_b 42"
    assert one(spark, T.clean_text("x"), "Hello,  World!") == "Hello World "
    assert one(spark, T.clean_text("x"), None) is None


def test_ascii_text_is_one_pass_and_the_collapse_of_each_step(spark):
    rows = [(x,) for x in ["", " ", "\n\n", '"', '""\n"', "中", "中文\n\n é", "a中\"\t b\x0b\n\r\f c", "😀x\u2028\x85y\xa0", "𠀀\n𠀀 z",
                           'q "w"\n\n"\n', " lead", "trail ", "\x00\x7f\x1f", "Kelvin \u212a İ", None]]
    df = spark.createDataFrame(rows, "x string")
    for quotes in (True, False):
        for blank in (True, False):
            step = F.col("x")
            for pattern in [r"\p{IsHan}", r"[^\x00-\x7F]", *(['"'] if quotes else [])]:
                step = F.regexp_replace(step, pattern, " ")
            if blank:
                step = F.regexp_replace(step, r"(?m)^[\t\x0B\f\r ]*$", ".")
            for pattern, by in [(r"\n+", " "), (r"[\t\n\x0B\f\r ]+", " "), (r"^ ?$", ".")]:
                step = F.regexp_replace(step, pattern, by)
            flat = T.ascii_text("x", strip_quotes=quotes, blank_lines=blank)
            for r in df.select("x", flat.alias("got"), step.alias("want")).collect():
                assert r.got == r.want, r
    # a text is read for the whole flattening, and once more for its blank form
    assert str(T.ascii_text("x")).count("regexp_replace") == 2


def test_ascii_text_blank_and_collapse(spark):
    assert one(spark, T.ascii_text("x"), "") == "."
    assert one(spark, T.ascii_text("x"), "  \n") == "."
    assert one(spark, T.ascii_text("x"), None) is None
    assert one(spark, T.ascii_text("x"), 'a "b"\n\nc中文d é') == "a b c d "
    # quotes kept in the sentence-file variant
    assert one(spark, T.ascii_text("x", strip_quotes=False), 'say "hi"') == 'say "hi"'
    # only a fully blank document becomes ".", not a blank line inside it
    assert one(spark, T.ascii_text("x"), "a\n\n  \nb") == "a b"
    assert one(spark, T.ascii_text("x", blank_lines=True), "a\n  \nb") == "a . b"


def test_ocr_ratio(spark):
    assert one(spark, T.ocr_ratio("x"), "!!!!") == 1.0
    assert one(spark, T.ocr_ratio("x"), "ab") == 0.0
    # newline-only text: no byte to count -> undefined -> flagged bad
    assert one(spark, T.ocr_ratio("x"), "\n\n") is None
    assert one(spark, T.is_bad_ocr("x"), "\n\n") is True
    # Han characters count per UTF-8 byte, all non-word: 6 bytes / 6
    assert one(spark, T.ocr_ratio("x"), "中文") == 1.0
    # newline is a non-word byte in the numerator but not in the denominator
    assert one(spark, T.ocr_ratio("x"), "a\n!") == 2 / 2


def test_sentences(spark):
    df = spark.createDataFrame([(1, "One. Two!  Three?\nFour")], "id long, text string")
    rows = corpus.sentences(df, "id").orderBy("sent_no").collect()
    assert [r.sentence for r in rows] == ["One.", "Two!", "Three?", "Four"]
    assert [r.sent_no for r in rows] == [0, 1, 2, 3]


def test_tokens_case_kept_and_null(spark):
    df = spark.createDataFrame([(1, "Bond, issuer;  état"), (2, None)], "id long, text string")
    out = {r.id: r.tokens for r in corpus.tokens(df).collect()}
    assert out[1] == ["Bond", "issuer", "tat"]
    assert out[2] == []


def test_word_tokens_are_the_tokens_of_clean_text(spark):
    rows = [(x,) for x in ["", " ", "a", " a  b ", "état a_b 42", "a\u00a0b\u2028c\x0bd\t", "中文 x 😀y", "...", "-x-", "\x00z\x85", None]]
    df = spark.createDataFrame(rows, "x string")
    out = df.select(T.word_tokens("x").alias("a"), T.whitespace_tokens(T.clean_text("x")).alias("b")).collect()
    assert all(r.a == r.b for r in out) and len(out) == len(rows)


def test_corpus_stats(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id long, text string")
    r = corpus.corpus_stats(df).first()
    assert (r.n_docs, r.n_texts, r.n_chars) == (2, 1, 2)
