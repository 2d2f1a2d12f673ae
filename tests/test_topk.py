import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import topk as TK


def line(i, rep=None):
    r = f' Reputation="{rep}"' if rep is not None else ""
    return f'  <row Id="{i}"{r} DisplayName="u{i}" />'


def frame(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_top_ten_distinct_and_records(spark):
    xs = [line(i, 100 + i) for i in range(12)] + [line(99, 111), "<users>", line(50)]
    recs = TK.scored_records(frame(spark, xs))
    assert recs.count() == 13
    top = TK.top_distinct_scores(recs, 10).collect()
    assert [r.score for r in top] == list(range(111, 101, -1))
    assert top[0].id == "99"  # tie on 111: the higher id wins
    rec = TK.top_records(recs, 10).collect()
    assert [(r.score, r.id) for r in rec[:2]] == [(111, "11"), (111, "99")]


def test_attribute_map(spark):
    m = frame(spark, [line(7, 101)]).select(TK.attribute_map(F.col("value")).alias("m")).first().m
    assert m == {"Id": "7", "Reputation": "101", "DisplayName": "u7"}
    odd = frame(spark, ['<row Id="1" Id="2" />', "short", None]).select(TK.attribute_map(F.col("value")).alias("m"))
    assert [r.m for r in odd.collect()] == [{"Id": "2"}, {}, {}]


def test_any_id_and_large_scores_stay(spark):
    xs = ['<row Id="a1" Reputation="5" />', '<row Id="7" Reputation="99999999999" />', line(50, 3)]
    recs = TK.scored_records(frame(spark, xs))
    assert [(r.id, r.score) for r in TK.top_records(recs, 10).collect()] == [("7", 99999999999), ("a1", 5), ("50", 3)]
    with pytest.raises(Exception, match="not a whole number"):
        TK.scored_records(frame(spark, ['<row Id="1" Reputation="many" />'])).collect()


def test_attribute_names_with_marks(spark):
    m = frame(spark, ['<row xml:lang="en" data-id="7" a.b="x=y" é="1" lang="de" />']).select(TK.attribute_map(F.col("value")).alias("m"))
    assert m.first().m == {"xml:lang": "en", "data-id": "7", "a.b": "x=y", "é": "1", "lang": "de"}


def test_equal_ids_and_scores_show_the_greatest_line(spark):
    xs = ['<row Id="1" Reputation="5" x="a" />', '<row Id="1" Reputation="5" x="c" />', '<row Id="1" Reputation="5" x="b" />']
    for order in (xs, xs[::-1]):
        assert [r.value for r in TK.top_distinct_scores(TK.scored_records(frame(spark, order).repartition(3)), 10).collect()] == [xs[1]]
