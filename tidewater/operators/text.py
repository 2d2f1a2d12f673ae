"""Word counts and top words over text lines or whole documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.tokens import stripped_tokens, whitespace_tokens, word_tokens

TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "whitespace": whitespace_tokens,   # default tokenizer, case kept
    "words": word_tokens,              # lower case, split on non-word characters
    "stripped": stripped_tokens,       # whitespace tokens, edge punctuation stripped
}


def tokens(df: DataFrame, tokenizer: str | Callable[[Column], Column] = "words", col: str = "value") -> DataFrame:
    fn = TOKENIZERS[tokenizer] if isinstance(tokenizer, str) else tokenizer
    return df.select(F.explode(fn(F.col(col))).alias("word"))


def word_count(df: DataFrame, tokenizer: str | Callable[[Column], Column] = "words", col: str = "value") -> DataFrame:
    """``(word, count)``. Tokens are exploded in the scan stage and counted with a
    partial (map-side) aggregate, so a very frequent word costs one row per task."""
    return tokens(df, tokenizer, col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def vocabulary_size(counts: DataFrame) -> DataFrame:
    """Number of distinct words, one row ``(n)``."""
    return counts.agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent words; ties broken by the word (bounded top-k per task)."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(n)


def top_long_words(counts: DataFrame, n: int = 20, min_len: int = 5) -> DataFrame:
    """Top ``n`` by a key that is 0 for words shorter than ``min_len`` and the count
    otherwise. Short words are ranked low, not removed."""
    key = F.when(F.length("word") < min_len, F.lit(0)).otherwise(F.col("count"))
    return counts.orderBy(key.desc(), F.asc("word")).limit(n)
