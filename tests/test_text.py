from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import text as T

# Fixed test input: the four lines of the batch word-count program.
SOLILOQUY = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
]


def lines(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_wordcount_whitespace_hello(spark):
    df = lines(spark, ["Hello World Bye World", "Hello Hadoop Goodbye Hadoop"])
    got = dict(rows(T.word_count(df, "whitespace")))
    assert got == {"Bye": 1, "Goodbye": 1, "Hadoop": 2, "Hello": 2, "World": 2}


def test_wordcount_regex(spark):
    counts = T.word_count(lines(spark, SOLILOQUY), "words")
    got = dict(rows(counts))
    assert sum(got.values()) == 34
    assert len(got) == 26
    assert got["to"] == 4 and got["the"] == 3
    assert got["be"] == 2 and got["or"] == 2 and got["of"] == 2
    assert all(v == 1 for k, v in got.items() if k not in {"to", "the", "be", "or", "of"})


def test_wordcount_stripped_keeps_empty_word(spark):
    got = dict(rows(T.word_count(lines(spark, ["a -- b, b."]), "stripped")))
    assert got == {"a": 1, "b": 2, "": 1}


def test_wordcount_counts_sum_to_tokens(spark):
    df = lines(spark, SOLILOQUY)
    total = T.word_count(df, "whitespace").agg(F.sum("count")).first()[0]
    assert total == sum(len(x.split()) for x in SOLILOQUY)


def test_top_long_words_ranks_short_words_low(spark):
    counts = spark.createDataFrame([("the", 50), ("sea", 40), ("troubles", 3), ("fortune", 2)], "word string, count long")
    top = [r.word for r in T.top_long_words(counts, 3).collect()]
    assert top == ["troubles", "fortune", "sea"]
    assert [r.word for r in T.top_words(counts, 2).collect()] == ["the", "sea"]


def test_vocabulary_and_empty_input(spark):
    empty = spark.createDataFrame([], "value string")
    assert T.word_count(empty).count() == 0
    assert T.vocabulary_size(T.word_count(empty)).first()["n"] == 0


def test_table_function_yields_words_of_some_bytes_at_a_time():
    """Not the words of a whole batch, however long its texts are."""
    import pyarrow as pa

    from tidewater.plans import catalog as C
    texts = ["Ab c, d! " * 20_000, None, "", "x" * 3_000_000, *["one Two" * 1000] * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    tables = list(C.WordTokens.func().eval(batch))
    assert max(t.nbytes for t in tables) < 4 << 20 and len(tables) > 4
    got = [w for t in tables for w in t.column("word").to_pylist()]
    assert got == [w for t in texts if t for w in t.lower().replace(",", "").replace("!", "").split()]
