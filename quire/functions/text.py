"""Scalar text expressions (Column -> Column), all JVM-side and codegen-able.

Fixed values that must equal the reference's behaviour are kept together in
the block below; everything else is built from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (reference behaviour) ---------------------------------
NON_WORD_RUN = r"\W+"                 # Java \W is ASCII: [^A-Za-z0-9_]
NON_ASCII_RANGE = r"\x{80}-\x{10FFFF}"  # anything outside 7-bit ASCII, Han script included
WHITESPACE = r"[\t\n\x0B\f\r ]"      # Perl/Java \s, spelled out
BLANK_DOC = r"^[\t\n\x0B\f\r ]*$"    # a fully blank document (no /m flag)
BLANK_COLLAPSED = r"^ ?$"             # the same document after whitespace collapse
BLANK_REPLACEMENT = "."
ROC_SEPARATOR = "|"
OCR_BAD_RATIO = 0.9                   # a file is bad when ratio > 0.9
SENTENCE_END = "[.!?]"                # a sentence ends with . ! or ? + space
ASCII_WORD_CHARS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ"
                    "abcdefghijklmnopqrstuvwxyz0123456789_")   # Perl's byte-mode \w
# --------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Runs of non-word characters -> one space; case, digits and ``_`` kept,
    no trim; a null stays null."""
    return F.regexp_replace(_c(c), NON_WORD_RUN, " ")


def ascii_text(c, strip_quotes: bool = True, blank_lines: bool = False) -> Column:
    """Flatten a raw document to one ASCII line.

    Han -> space, non-ASCII -> space, (optionally) ``"`` -> space, a blank
    document -> ``.``, newline runs and then whitespace runs -> one space.
    ``blank_lines=True`` turns every blank *line* into ``.`` instead, which is
    what the original comment meant but not what its regex did.
    """
    flat = NON_ASCII_RANGE + ('"' if strip_quotes else "")
    x = _c(c)
    if blank_lines:
        x = F.regexp_replace(x, f"[{flat}]", " ")
        x = F.regexp_replace(x, r"(?m)^[\t\x0B\f\r ]*$", BLANK_REPLACEMENT)
    # All that becomes a space does so in the same pass that collapses runs (Han is not ASCII).
    x = F.regexp_replace(x, f"[{WHITESPACE[1:-1]}{flat}]+", " ")
    # A blank document is exactly the one that collapses to "" or " "; testing
    # after the collapse keeps the expression tree linear (each step is
    # evaluated once, not once per reference).
    return F.regexp_replace(x, BLANK_COLLAPSED, BLANK_REPLACEMENT)


def strip_label_quotes(c) -> Column:
    """Label values lose their double quotes (removed, not spaced)."""
    return F.regexp_replace(_c(c), '"', "")


def ocr_ratio(c) -> Column:
    """Share of non-word bytes among non-newline bytes of a document.

    Counted on UTF-8 bytes: every byte of a multi-byte character is a
    non-word byte. Null when the document has no non-newline byte.
    """
    x = _c(c)
    octets = F.octet_length(x)
    word = F.length(x) - F.length(F.translate(x, ASCII_WORD_CHARS, ""))
    newlines = F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))
    denom = octets - newlines
    return F.when(denom > 0, (octets - word) / denom)


def is_bad_ocr(c, threshold: float = OCR_BAD_RATIO) -> Column:
    """True when the non-word share exceeds the threshold or is undefined."""
    r = ocr_ratio(c)
    return F.coalesce(r > F.lit(threshold), F.lit(True))


def sentence_array(c) -> Column:
    """Split an already flattened text (single spaces) after ``.``/``!``/``?``."""
    marked = F.regexp_replace(_c(c), f"({SENTENCE_END}) ", "$1\n")
    return F.split(marked, "\n")


def whitespace_tokens(c) -> Column:
    """Tokens between whitespace runs, empty tokens dropped, case kept."""
    return F.filter(F.split(_c(c), r"\s+"), lambda t: F.length(t) > 0)


def word_tokens(c) -> Column:
    """``whitespace_tokens`` of ``clean_text``, which leaves no white space but single blanks."""
    return F.array_remove(F.split(clean_text(c), " "), "")
