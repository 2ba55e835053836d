"""Dictionary-and-rule lemmatizer as Column expressions.

The original job ran a full NLP pipeline per partition. Here a token's lemma is
``dictionary[form]`` if the form is listed, else the first matching suffix
rule, else the form itself; then only lemmas longer than two characters made
of letters only are kept, lower-cased. All of it is a ``transform``/``filter``
over the token array of one row: no shuffle, no Python.

No parity with a statistical lemmatizer is claimed.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------
# Token boundaries: anything that is not a letter, a digit or a hyphen.
TOKEN_SPLIT = r"[^\p{L}\p{N}-]+"
# A kept lemma: longer than this and letters only.
MIN_LEMMA_LENGTH = 3
LETTERS_ONLY = r"^\p{L}+$"

# Irregular English forms -> lemma (form, lemma), in alphabetical order of form.
IRREGULAR_FORMS = [
    ("am", "be"), ("are", "be"), ("ate", "eat"), ("became", "become"),
    ("been", "be"), ("began", "begin"), ("begun", "begin"), ("being", "be"),
    ("bought", "buy"), ("brought", "bring"), ("built", "build"),
    ("came", "come"), ("children", "child"), ("chose", "choose"),
    ("chosen", "choose"), ("did", "do"), ("does", "do"), ("done", "do"),
    ("drew", "draw"), ("drawn", "draw"), ("felt", "feel"), ("found", "find"),
    ("gave", "give"), ("given", "give"), ("gone", "go"), ("got", "get"),
    ("had", "have"), ("has", "have"), ("having", "have"), ("held", "hold"),
    ("is", "be"), ("kept", "keep"), ("knew", "know"), ("known", "know"),
    ("led", "lead"), ("left", "leave"), ("made", "make"), ("meant", "mean"),
    ("men", "man"), ("met", "meet"), ("paid", "pay"), ("people", "person"),
    ("ran", "run"), ("said", "say"), ("saw", "see"), ("seen", "see"),
    ("sent", "send"), ("sold", "sell"), ("spent", "spend"), ("stood", "stand"),
    ("taken", "take"), ("taught", "teach"), ("thought", "think"),
    ("told", "tell"), ("took", "take"), ("understood", "understand"),
    ("was", "be"), ("went", "go"), ("were", "be"), ("women", "woman"),
    ("won", "win"), ("wrote", "write"), ("written", "write"),
]

# Suffix rules, tried in order, first match wins:
# (suffix, endings that block the rule, minimum word length, chars cut, added)
SUFFIX_RULES = [
    ("sses", (), 5, 2, ""),
    ("ies", (), 5, 3, "y"),
    ("ches", (), 5, 2, ""),
    ("shes", (), 5, 2, ""),
    ("xes", (), 4, 2, ""),
    ("s", ("ss", "us", "is"), 4, 1, ""),
    ("ied", (), 5, 3, "y"),
]
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lemma_tokens_of(text) -> Column:
    """Surface tokens of a text: split at non-letter/digit/hyphen runs."""
    return F.filter(F.split(_c(text), TOKEN_SPLIT), lambda t: F.length(t) > 0)


def suffix_rule(w: Column) -> Column:
    """The rule-based lemma of a lower-case form (the form if no rule fits)."""
    out = None
    for suffix, blocked, min_len, cut, add in SUFFIX_RULES:
        cond = w.endswith(suffix) & (F.length(w) >= min_len)
        for b in blocked:
            cond = cond & ~w.endswith(b)
        val = F.concat(w.substr(F.lit(1), F.length(w) - cut), F.lit(add))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    # most forms end with no rule's last letter and skip the rules
    last = [w.endswith(x) for x in sorted({suffix[-1] for suffix, *_ in SUFFIX_RULES})]
    return F.when(functools.reduce(operator.or_, last), out.otherwise(w)).otherwise(w)


def one_lemma_per_form(dictionary) -> list[tuple[str, str]]:
    """Lower-cased pairs, one for each form: the first lemma in alphabetical order."""
    best: dict[str, str] = {}
    for form, lemma in dictionary:
        form, lemma = form.lower(), lemma.lower()
        best[form] = min(lemma, best.get(form, lemma))
    return sorted(best.items())


def lemma_of(token: Column) -> Column:
    """Lemma of one token: dictionary first, then suffix rules."""
    return lemma_of_lower(F.lower(token))


def lemma_of_lower(w: Column, pairs=IRREGULAR_FORMS) -> Column:
    """Lemma of an already lower-cased token."""
    if not pairs:
        return suffix_rule(w)
    table = F.create_map(*(F.lit(x) for pair in pairs for x in pair))
    # the IN list becomes a hash set; the map is only probed on a hit
    return F.when(w.isin([form for form, _ in pairs]), F.element_at(table, w)).otherwise(suffix_rule(w))


def keep_lemma(x: Column) -> Column:
    """Lemma filter: length > 2 and letters only."""
    return (F.length(x) >= MIN_LEMMA_LENGTH) & x.rlike(LETTERS_ONLY)


def lemmas(text, pairs=IRREGULAR_FORMS) -> Column:
    """Array of filtered, lower-cased lemmas of a text (``[]`` for null)."""
    toks = F.coalesce(F.split(_c(text), TOKEN_SPLIT), F.array().cast("array<string>"))
    # A rule never lengthens a form, so shorter ones cannot give a lemma to keep, unless they are listed.
    shortest = min([MIN_LEMMA_LENGTH, *(len(form) for form, lemma in pairs if len(lemma) >= MIN_LEMMA_LENGTH)])
    forms = F.filter(F.transform(toks, F.lower), lambda w: F.length(w) >= max(shortest, 1))
    return F.filter(F.transform(forms, lambda w: lemma_of_lower(w, pairs)), keep_lemma)
