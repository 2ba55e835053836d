"""Lemmas by suffix rules induced from a dictionary.

A pair (form, lemma) shares a prefix; what the form has beyond it is cut, what the lemma has beyond
it is added. Each pair votes for this rule at every suffix of the form, up to ``MAX_SUFFIX``
characters, that is long enough to hold the cut. A suffix keeps its most frequent rule if that has
enough support among all forms with the suffix. A form is lemmatized by the longest of its suffixes
that has a rule; rules are a trie laid out as a table, looked up by joins or sent to the tasks.

Rules and forms are aggregated; the distinct forms of a corpus, not its tokens, meet the rules.

Edge cases: null or empty forms and lemmas are no pairs; forms and lemmas count in lower case; a form
listed twice votes once with its first lemma in alphabetical order; a form without a rule, or
one that a rule would cut to nothing, is its own lemma; an empty dictionary has no rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import lemma as L
from quire.functions import text as T
from quire.operators.numbering import heavy_light_join, split_repeated

MAX_SUFFIX = 6
#: Forms that must share a rule, and their part of all forms with the suffix, in percent.
MIN_SUPPORT = 5
MIN_PERCENT = 50


def _last(form: str, k: Column) -> Column:
    return F.substring(F.col(form), F.char_length(form) - k + 1, k)


def _suffixes(longest: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.least(F.char_length("form"), F.lit(longest))))


def induce(dictionary: DataFrame, max_suffix: int = MAX_SUFFIX, min_support: int = MIN_SUPPORT,
           min_percent: int = MIN_PERCENT) -> DataFrame:
    """(suffix, cut, added, support, total) from (form, lemma); ``total`` forms have the suffix."""
    pairs = (dictionary.select(F.lower("form").alias("form"), F.lower("lemma").alias("lemma"))
             .filter("form <> '' and lemma <> ''").groupBy("form").agg(F.min("lemma").alias("lemma")))
    both = F.least(F.char_length("form"), F.char_length("lemma"))
    same = lambda i: F.substring("form", i, F.lit(1)) == F.substring("lemma", i, F.lit(1))
    common = F.aggregate(F.sequence(F.lit(0), both), F.lit(0), lambda a, i: F.when((i == a + 1) & same(i), i).otherwise(a))
    cut = pairs.withColumn("p", common).select("form", (F.char_length("form") - F.col("p")).alias("cut"),
                                                F.substring(F.col("lemma"), F.col("p") + 1, F.char_length("lemma")).alias("added"))
    votes = cut.select("form", "cut", "added", _suffixes(max_suffix).alias("k"))
    holds = F.col("k") >= F.col("cut")
    counted = (votes.select(_last("form", F.col("k")).alias("suffix"), F.when(holds, F.col("cut")).alias("cut"),
                            F.when(holds, F.col("added")).alias("added"))
               .groupBy("suffix", "cut", "added").agg(F.count(F.lit(1)).alias("n")))
    # most frequent, then the shorter cut, then the first addition
    rule = F.when(F.col("cut").isNotNull(), F.struct((-F.col("n")).alias("neg"), "cut", "added"))
    best = counted.groupBy("suffix").agg(F.min(rule).alias("r"), F.sum("n").alias("total")).filter("r is not null")
    best = best.select("suffix", "r.cut", "r.added", (-F.col("r.neg")).alias("support"), "total")
    return best.filter((F.col("support") >= min_support) & (100 * F.col("support") >= min_percent * F.col("total")))


def lemmas_of_forms(forms: DataFrame, rules: DataFrame, max_suffix: int = MAX_SUFFIX) -> DataFrame:
    """(form, lemma) of distinct lower-case forms, by the longest suffix with a rule."""
    tried = forms.select("form", _suffixes(max_suffix).alias("k")).select("form", "k", _last("form", F.col("k")).alias("suffix"))
    found = heavy_light_join(tried, rules.select("suffix", "cut", "added"), "suffix", "inner", heavy=[""])  # all forms have the empty suffix
    longest = found.groupBy("form").agg(F.max_by(F.struct("cut", "added"), "k").alias("r"))
    made = F.concat(F.substring(F.col("form"), F.lit(1), F.char_length("form") - F.col("r.cut")), F.col("r.added"))
    return forms.join(longest, "form", "left").select("form", F.coalesce(F.nullif(made, F.lit("")), F.col("form")).alias("lemma"))


#: So many rules are sent to the tasks; more of them meet the forms by joins.
MAX_SENT_RULES = 200_000


def _applied(sent, max_suffix: int):
    """Rows (id, forms) with the lemma of each form, by the longest suffix with a rule."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = sent.value

        def lemma(form: str) -> str:
            for k in range(min(len(form), max_suffix), -1, -1):
                if rule := rules.get(form[len(form) - k:]):
                    return form[:len(form) - rule[0]] + rule[1] or form
            return form

        for batch in batches:
            ids, lists = batch.columns
            forms = lists.flatten().dictionary_encode()
            lemmas = pa.array([lemma(f) for f in forms.dictionary.to_pylist()], pa.string()).take(forms.indices)
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, lemmas)], batch.schema.names)
    return run


def lemmatize(df: DataFrame, id_col: str, rules: DataFrame, text_col: str = "text", out_col: str = "LEMMAS",
              max_suffix: int = MAX_SUFFIX) -> DataFrame:
    """(id, lemmas): the filtered lemmas of each document's tokens, in their order; a row without an
    id has none.

    Rules of bounded number are sent to the tasks, which apply them to the distinct forms of their
    rows. Beyond it, and for ids that several rows have, which get the lemmas of all of them,
    tokens meet their form's lemma by a join whose frequent forms stay in place.
    """
    toks = L.lemma_tokens_of(T.ascii_text(text_col))
    empty = F.array().cast("array<string>")
    listed = rules.select("suffix", "cut", "added").limit(MAX_SENT_RULES + 1).collect()  # a proven bound
    here, rest = split_repeated(df, id_col) if len(listed) <= MAX_SENT_RULES else (None, df)
    out = None
    if here is not None:
        sent = df.sparkSession.sparkContext.broadcast({r.suffix: (r.cut, r.added) for r in listed})
        forms = here.select(id_col, F.coalesce(F.when(F.col(id_col).isNotNull(), F.transform(toks, F.lower)), empty).alias(out_col))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in forms.schema.fields)
        found = forms.mapInArrow(_applied(sent, max_suffix), fields)
        out = found.select(id_col, F.filter(out_col, L.keep_lemma).alias(out_col))
    if rest is None:
        return out
    rows = rest.select(id_col, F.posexplode_outer(F.transform(toks, F.lower)).alias("pos", "form"))
    forms = rows.filter("form is not null").select("form").distinct()
    joined = heavy_light_join(rows.filter("form is not null"), lemmas_of_forms(forms, rules, max_suffix), "form", "inner")
    kept = joined.filter(L.keep_lemma(F.col("lemma"))).groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "lemma"))).alias("_l"))
    met = rest.select(id_col).join(kept, id_col, "left").select(id_col, F.coalesce(F.col("_l.lemma"), empty).alias(out_col))
    return met if out is None else out.unionByName(met)
