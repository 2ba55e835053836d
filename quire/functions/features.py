"""Feature expressions: n-grams, stable hashing, packed counts, the hash split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------
NUM_FEATURES = 10000          # hashed bigram buckets
SPLIT_SEED = 1234             # seed of the 70/30 split
TRAIN_PREFIX = "b333"         # md5 hex prefix below this -> training (45875/65536)
NGRAM_SEPARATOR = " "
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bigrams(words) -> Column:
    """Adjacent pairs of an array joined by a space; ``[]`` below two words.

    Built with ``zip_with`` over two slices so the array is read once, not
    re-derived per element.
    """
    w = _c(words)
    n = F.size(w)
    pairs = F.zip_with(F.slice(w, 1, F.greatest(n - 1, F.lit(0))),
                       F.slice(w, F.lit(2), F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(NGRAM_SEPARATOR), b))
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def stable_bucket(term, num_features: int = NUM_FEATURES) -> Column:
    """Bucket of a term from the first 32 bits of its md5 (engine-independent)."""
    h = F.conv(F.substring(F.md5(_c(term)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(num_features)).cast("int")


def runs(values) -> tuple[Column, Column]:
    """(distinct values, place of the first of each) of a sorted array without nulls."""
    v = _c(values)
    first = lambda x, i: ~x.eqNullSafe(F.get(v, i - 1))
    places = F.filter(F.transform(v, lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull())
    return F.filter(v, first), places


def run_lengths(starts, size) -> Column:
    """Lengths of the runs that begin at the places ``starts`` of an array with ``size`` entries."""
    s = _c(starts)
    return F.transform(s, lambda i, j: (F.coalesce(F.get(s, j + 1), size) - i).cast("int"))


def train_flag(key, seed: int = SPLIT_SEED, prefix: str = TRAIN_PREFIX) -> Column:
    """Deterministic ~70/30 split on a key, independent of partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return F.substring(digest, 1, 4) < F.lit(prefix)
