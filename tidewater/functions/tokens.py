"""Tokenizers as array expressions; exploding them keeps word counts in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference programs' tokenizers:
#  - the default tokenizer delimiters: blank, tab, newline, carriage return, form feed
#  - the non-word split used with lower case
#  - the punctuation stripped from both ends of a word: . , ; : ? ! -
WHITESPACE_DELIMS = r"[ \t\n\r\f]+"
NON_WORD = r"\W+"
STRIP_CHARS = ".,;:?!-"
# ASCII whitespace as split by a plain ``str.split()`` (vertical tab included).
ASCII_SPACE = r"[ \t\n\x0B\f\r]+"


def _non_empty(arr: Column) -> Column:
    return F.filter(arr, lambda t: t != "")


def whitespace_tokens(text: Column) -> Column:
    """Tokens between runs of blank/tab/newline/CR/form feed; case kept."""
    return _non_empty(F.split(text, WHITESPACE_DELIMS))


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII word characters."""
    return _non_empty(F.split(F.lower(text), NON_WORD))


def stripped_tokens(text: Column) -> Column:
    """Whitespace tokens with ``.,;:?!-`` stripped from both ends; case kept.
    A token made only of those characters becomes the empty word and is kept."""
    return F.transform(_non_empty(F.split(text, ASCII_SPACE)), lambda t: F.btrim(t, F.lit(STRIP_CHARS)))
