from pyspark.sql import functions as F

from quire.functions import features as FE
from quire.functions import lemma as L
from quire.functions.stopwords import default_stop_words, remove_stop_words
from quire.operators import corpus


def arr(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("r")).first()["r"]


def test_lemmas_filter_and_rules(spark):
    got = arr(spark, L.lemmas("x"), "The companies were issuing bonds; it is 42 x-ray Classes ab")
    # 'were'->'be' (too short, dropped), 'is'->'be' dropped, digits / hyphen dropped
    assert got == ["the", "company", "issuing", "bond", "class"]


def test_short_forms_are_dropped_before_their_lemma_unless_listed(spark):
    text = "-a- am is ab s us Ox as axes ied tied dies bus d 7s x-s ÉTÉS İx"
    got = arr(spark, L.lemmas("x"), text)
    every = F.transform(F.transform(L.lemma_tokens_of("x"), F.lower), lambda w: L.lemma_of_lower(w))
    assert got == arr(spark, F.filter(every, L.keep_lemma), text) == ["ied", "tied", "die", "bus", "été"]
    # a listed form counts, however short
    assert arr(spark, L.lemmas("x", [("ox", "oxen"), ("a", "article"), ("zz", "z")]), "Ox a zz b") == ["oxen", "article"]
    # forms too short for a lemma to keep never reach the rules: the length is asked before and after
    plan = spark.createDataFrame([(text,)], "x string").select(L.lemmas("x").alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(">= 3") == 2


def test_rules_are_the_first_match_for_any_ending(spark):
    words = ["classes", "companies", "churches", "dishes", "boxes", "bonds", "bus", "glass", "basis", "tied", "applied",
             "red", "s", "ies", "d", "", "été", "walk"]
    want = ["class", "company", "church", "dish", "box", "bond", "bus", "glass", "basis", "tied", "apply",
            "red", "s", "ies", "d", "", "été", "walk"]
    assert [arr(spark, L.suffix_rule(F.col("x")), w) for w in words] == want


def test_dictionary_join_equals_rowlocal(spark):
    df = spark.createDataFrame([(1, "Children went to the markets"), (2, ""), (3, None)],
                               "doc_id long, text string")
    a = {r.doc_id: r.LEMMAS for r in corpus.lemma_corpus(df).collect()}
    b = {r.doc_id: r.LEMMAS for r in corpus.lemmatize_with_dictionary(df, L.IRREGULAR_FORMS).collect()}
    table = spark.createDataFrame(L.IRREGULAR_FORMS, "form string, lemma string")
    c = {r.doc_id: r.LEMMAS for r in corpus.lemmatize_by_join(df, "doc_id", table).collect()}
    assert a == b == c
    assert a[1] == ["child", "the", "market"]


def test_a_form_listed_twice_adds_no_token(spark):
    pairs = [("bonds", "bondz"), ("Bonds", "bond"), ("issues", "issued")]
    df = spark.createDataFrame([(1, "bonds issues")], "doc_id long, text string")
    assert corpus.lemmatize_with_dictionary(df, pairs).first().LEMMAS == ["bond", "issued"]
    table = spark.createDataFrame(pairs, "form string, lemma string")
    assert corpus.lemmatize_by_join(df, "doc_id", table).first().LEMMAS == ["bond", "issued"]


def test_stop_words_case_insensitive_and_bigrams_bridge(spark):
    words = remove_stop_words(F.split(F.col("x"), " "))
    assert arr(spark, words, "Issuer OF Bonds") == ["Issuer", "Bonds"]
    grams = FE.bigrams(words)
    assert arr(spark, grams, "issuer of bonds") == ["issuer bonds"]
    assert arr(spark, grams, "the") == []
    assert arr(spark, grams, "bond") == []


def test_default_stop_list_is_rule_built():
    sw = default_stop_words()
    assert "the" in sw and "und" in sw and "les" in sw and "della" in sw
    assert "" not in sw and list(sw) == sorted(sw)


def test_stable_bucket_and_split(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("doc_id"))
    frac = df.select(F.avg(FE.train_flag("doc_id").cast("double"))).first()[0]
    assert 0.68 < frac < 0.72
    b = spark.createDataFrame([("hello world",)], "t string").select(FE.stable_bucket("t")).first()[0]
    # md5('hello world') starts with 5eb63bbb -> 1589001147 % 10000
    assert b == 1589001147 % 10000
