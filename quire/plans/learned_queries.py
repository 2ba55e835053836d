"""Registered queries of the models that are fitted as aggregates: forests, word co-occurrence, sentence
ends, suffix rules; and of numbering and worker resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import lemma as L
from quire.functions import text as T
from quire.functions.features import train_flag
from quire.operators import cooccurrence as C
from quire.operators import corpus, forest, numbering, resource, sentence_model, suffix_rules, tfidf, vectors
from quire.session import scratch_path
from quire.sources.tables import documents, read_table

R = 6
#: Trees, levels and bins of the registered forests: their SQL twins unroll each level.
TREES, DEPTH, BINS = 8, 5, 16
#: Buckets of token counts that a document's language is told by.
LANGUAGE_BUCKETS = 64
#: Occurrences that a word of the dictionary has at least.
DICTIONARY_COUNT = 2


def _docs(spark: SparkSession, sf: str, cols=("doc_id", "text")) -> DataFrame:
    return documents(spark, sf, cols)


def _forest(rows: DataFrame, key: str, features: str, label: str) -> DataFrame:
    train = train_flag(key)
    model = forest.forest_fit(rows.filter(train), key, features, label, TREES, DEPTH, BINS)
    out = forest.forest_predict(rows.filter(~train), model, features, [key, label])
    return out.select(key, F.coalesce(F.col(label).cast("string"), F.lit("")).alias("label"), "predicted", F.round("share", R).alias("share"))


def forest_predict(spark, sf):
    """A forest on the vectors of ``embeddings``, for the held-out 30 %."""
    return _forest(read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label"), "vec_id", "embedding", "label")


def forest_language(spark, sf):
    """Languages of held-out documents by a forest on hashed counts of their lemmas."""
    docs = corpus.lemma_corpus(_docs(spark, sf, ("doc_id", "text", "lang")))
    tf = tfidf.hashed_tf(docs, "doc_id", "LEMMAS", num_features=LANGUAGE_BUCKETS)
    counts = tf.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "tf"))).alias("tf"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(LANGUAGE_BUCKETS - 1)), lambda b: F.coalesce(F.element_at("tf", b), F.lit(0)).cast("double"))
    rows = docs.select("doc_id", "lang").join(counts, "doc_id", "left")
    empty = F.array_repeat(F.lit(0.0), LANGUAGE_BUCKETS)
    return _forest(rows.select("doc_id", "lang", F.coalesce(vector, empty).alias("features")), "doc_id", "features", "lang")


def _known(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Documents' tokens of the vocabulary, and the vocabulary."""
    docs = corpus.tokens(_docs(spark, sf))
    words = vectors.vocabulary(docs.select(F.explode_outer("tokens").alias("word")).filter("word is not null"))
    path = scratch_path(spark, "vocabulary")
    words.write.parquet(path)
    words = spark.read.schema(words.schema).parquet(path)
    return C.known_tokens(docs, "doc_id", words), words


def cooccurrence(spark, sf):
    known, words = _known(spark, sf)
    return C.cooccurrence(known, vocab=words)


def pmi(spark, sf):
    known, words = _known(spark, sf)
    return C.pmi(C.pair_sums(known, vocab=words)).select("word", "context", "n", F.round("pmi", R).alias("pmi"))


#: Dimensions of the registered word vectors.
PMI_SIZE = 16


def pmi_vectors(spark, sf):
    """Word vectors of the positive mutual information; they depend on the order of floating-point sums."""
    known, words = _known(spark, sf)
    return C.pmi_vectors(C.pair_sums(known, vocab=words), PMI_SIZE)[1]


def abbreviations(spark, sf):
    counts = sentence_model.type_counts(sentence_model.typed_tokens(_docs(spark, sf)))
    return sentence_model.abbreviation_scores(counts).withColumn("score", F.round("score", R))


def sentence_lists(spark, sf):
    model = sentence_model.learn(_docs(spark, sf))
    one = lambda name, df: df.select(F.lit(name).alias("list"), "kind")
    return one("abbreviation", model.abbreviations).unionByName(one("before_number", model.before_number)).unionByName(one("starter", model.starters))


def learned_sentences(spark, sf):
    docs = _docs(spark, sf)
    return sentence_model.split_sentences(docs, sentence_model.learn(docs), "doc_id")


def _dictionary(spark, sf) -> DataFrame:
    """Pairs of the corpus's words and their lemmas by list and rule."""
    toks = L.lemma_tokens_of(T.ascii_text("text"))
    forms = _docs(spark, sf).select(F.explode_outer(toks).alias("form")).filter("form is not null").select(F.lower("form").alias("form"))
    words = forms.groupBy("form").agg(F.count("*").alias("n")).filter((F.col("n") >= DICTIONARY_COUNT) & F.col("form").rlike("^[a-z]{4,}$"))
    return words.select("form", L.lemma_of_lower(F.col("form")).alias("lemma"))


def suffix_rule_table(spark, sf):
    return suffix_rules.induce(_dictionary(spark, sf))


def lemmatize_rules(spark, sf):
    """Lemmas of all documents by rules induced from the training split of the dictionary."""
    rules = suffix_rules.induce(_dictionary(spark, sf).filter(train_flag("form")))
    out = suffix_rules.lemmatize(_docs(spark, sf), "doc_id", rules, out_col="lemmas")
    return out.select("doc_id", F.size("lemmas").alias("n_lemmas"), F.concat_ws(" ", "lemmas").alias("lemmas"))


def row_numbers(spark, sf):
    """lineitem's rows in the order of order and line."""
    rows = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return numbering.row_numbers(rows, ["l_orderkey", "l_linenumber"])


def label_index_large(spark, sf):
    """The index of a label with as many classes as customers have orders."""
    counts = read_table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("label")).agg(F.count("*").alias("n"))
    numbered = numbering.row_numbers(counts, [F.desc("n"), F.asc("label")], "idx")
    return numbered.select("label", "n", (F.col("idx") - 1).cast("double").alias("idx"))


def worker_lemmas(spark, sf):
    """A user's lemmatizer, made once in each worker, over the texts of all documents."""
    def make():
        import re

        cache: dict[str, str] = {}  # state that a worker keeps

        def lemma(word: str) -> str:
            if word not in cache:
                cache[word] = word[:-1] if len(word) > 3 and word.endswith("s") and not word.endswith("ss") else word
            return cache[word]

        return lambda text: " ".join(lemma(w) for w in re.findall("[a-z]+", (text or "").lower()))

    docs = _docs(spark, sf)
    return resource.with_resource(docs, make, lambda lemmatize, texts: [lemmatize(t) for t in texts], "text", "lemmas", "string").select("doc_id", "lemmas")


LEARNED_QUERIES = {
    "forest_predict": forest_predict,
    "forest_language": forest_language,
    "cooccurrence": cooccurrence,
    "pmi": pmi,
    "pmi_vectors": pmi_vectors,
    "abbreviations": abbreviations,
    "sentence_lists": sentence_lists,
    "learned_sentences": learned_sentences,
    "suffix_rules": suffix_rule_table,
    "lemmatize_rules": lemmatize_rules,
    "row_numbers": row_numbers,
    "label_index_large": label_index_large,
    "worker_lemmas": worker_lemmas,
}
