"""Tokenizers against plain-Python definitions on random ASCII text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.functions.tokens import stripped_tokens, whitespace_tokens, word_tokens

ALPHABET = st.sampled_from(list("abcXYZ019_ .,;:?!-'\t\n\r\f\x0b\"#é"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30)


def py_whitespace(t):
    return [w for w in re.split(r"[ \t\n\r\f]+", t) if w]


def py_words(t):
    return [w for w in re.split(r"\W+", t.lower(), flags=re.ASCII) if w]


def py_stripped(t):
    return [w.strip(".,;:?!-") for w in re.split(r"[ \t\n\x0b\f\r]+", t) if w]


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_tokenizers_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", whitespace_tokens(F.col("t")).alias("a"), word_tokens(F.col("t")).alias("b"),
                    stripped_tokens(F.col("t")).alias("c")).orderBy("i").collect()
    for r, t in zip(got, texts):
        assert r.a == py_whitespace(t)
        assert r.b == py_words(t)
        assert r.c == py_stripped(t)
