"""Text cleaning and tokenising as column expressions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.fixed import (
    CHARSET_RE,
    MIN_TOKEN_LENGTH,
    REPLACEMENT_CHARACTER,
    TOKEN_RE,
)

# Blocks whose characters never combine and are never rewritten by NFC. A text
# made only of them is already in NFC and need not leave the JVM.
NFC_STABLE_LATIN = "\\u0000-\\u02FF"  # Latin, Latin-1, Latin Extended-A/B, IPA
NFC_STABLE_OTHER = (
    "\\u0400-\\u0482"  # Cyrillic
    "\\u1E00-\\u1EFF"  # Latin Extended Additional (Vietnamese)
    "\\u2010-\\u2027\\u2030-\\u205E"  # punctuation
    "\\u3041-\\u3096\\u30A1-\\u30FA"  # kana
    "\\u4E00-\\u9FFF"  # CJK ideographs
    "\\uAC00-\\uD7A3"  # Hangul syllables
    "\\uFFFD"
)
# One range at a time: a single class of many ranges tests them all per character.
NFC_STABLE_RE = (
    f"\\A[{NFC_STABLE_LATIN}]*+(?:[{NFC_STABLE_OTHER}]++[{NFC_STABLE_LATIN}]*+)*+\\z"
)

# TOKEN_RE for Java: nothing follows the repetitions, so possessive ones match the
# same text, but loop instead of recursing on long tokens.
_TOKEN_RE = TOKEN_RE.replace("]+", "]++").replace(")*", ")*+")


def _nfc_udf():
    # a local function travels to the executors by value, so that they need no
    # copy of this package
    def normalise(texts: pa.Array) -> pa.Array:
        return pa.array(
            [v and unicodedata.normalize("NFC", v) for v in texts.to_pylist()], pa.string()
        )

    return F.arrow_udf(normalise, T.StringType())


_nfc = _nfc_udf()


def _is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def nfc(text: Column) -> Column:
    """Unicode NFC. Only texts that may change are sent to the Arrow UDF."""
    may_change = ~(_is_ascii(text) | text.rlike(NFC_STABLE_RE))
    return F.coalesce(_nfc(F.when(may_change, text)), text)


def clean_text(text: Column) -> Column:
    """null -> '', NFC, lower case, replacement characters -> space."""
    return _fold(nfc(F.coalesce(text, F.lit(""))))


def _fold(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(REPLACEMENT_CHARACTER), F.lit(" "))


def literal_tokens(text: str) -> Column:
    """Kept tokens of one given text, as a constant expression."""
    return kept_tokens(_fold(F.lit(unicodedata.normalize("NFC", text))))


def word_tokens(cleaned: Column) -> Column:
    """All words of a cleaned text, in order."""
    return F.regexp_extract_all(cleaned, F.lit(_TOKEN_RE), F.lit(0))


def is_kept(token: Column) -> Column:
    """Long enough and wholly inside the character set.

    For words of a cleaned text: those in ASCII are lower case letters, digits,
    '_', '.' and '-', all of them in the set, and skip the pattern.
    """
    inside = _is_ascii(token) | token.rlike(CHARSET_RE)
    return (F.length(token) >= MIN_TOKEN_LENGTH) & inside


def kept_tokens(cleaned: Column) -> Column:
    return F.filter(word_tokens(cleaned), is_kept)


def token_string(tokens: Column) -> Column:
    return F.array_join(tokens, " ")
