"""Invariants on the driver tables and negative cases (empty inputs, junk)."""

from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidewater.operators import graph as G
from tidewater.operators import keyed as K
from tidewater.operators import logs as L
from tidewater.operators import text as T
from tidewater.operators import topk as TK
from tidewater.plans import catalog as C


def test_component_labels(spark):
    _, e = C._graph(spark, SF)
    cc = G.connected_components(e)
    # label <= id, and both ends of every edge carry the same label
    assert cc.filter(F.col("component") > F.col("id")).count() == 0
    lab = cc.select(F.col("id").alias("src"), F.col("component").alias("cs"))
    lab2 = cc.select(F.col("id").alias("dst"), F.col("component").alias("cd"))
    assert e.join(lab, "src").join(lab2, "dst").filter(F.col("cs") != F.col("cd")).count() == 0
    # every label is the smallest id of its component
    assert cc.groupBy("component").agg(F.min("id").alias("m")).filter(F.col("m") != F.col("component")).count() == 0


def test_degree_sums_and_triangle_parity(spark):
    _, e = C._graph(spark, SF)
    n = e.count()
    assert G.in_degrees(e).agg(F.sum("inDeg")).first()[0] == n
    assert G.out_degrees(e).agg(F.sum("outDeg")).first()[0] == n
    assert G.triangle_counts(e).agg(F.sum("triangles")).first()[0] % 3 == 0


def test_word_count_total_is_token_count(spark):
    docs = C._docs(spark, SF)
    tokens = docs.select(F.size(F.filter(F.split(F.lower("value"), r"\W+"), lambda t: t != "")).alias("n")) \
                 .agg(F.sum("n")).first()[0]
    assert T.word_count(docs, "words").agg(F.sum("count")).first()[0] == tokens


def test_parsed_plus_rejected_is_all_lines(spark):
    lines = C._log_lines(spark, SF)
    good, bad = L.parse_clf(lines)
    assert good.count() + bad.count() == lines.count()


def test_empty_inputs(spark):
    lines = spark.createDataFrame([], "value string")
    good, bad = L.parse_clf(lines)
    assert good.count() == 0 and bad.count() == 0
    assert L.distinct_clients(good).first().n == 0
    assert TK.top_distinct_scores(TK.scored_records(lines)).count() == 0
    kv = spark.createDataFrame([], "k string, v int")
    assert K.reduce_by_key(kv, "k", "v", lambda a, b: a + b).count() == 0
    e = spark.createDataFrame([], "src bigint, dst bigint")
    assert G.pagerank_join(e, 3).count() == 0
    assert G.connected_components(e).count() == 0


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (19, 2), (30, 3), (None, 4)], "age bigint, x int")
    got = sorted(rows(df.groupBy("age").count()), key=str)
    assert got == sorted([(None, 2), (19, 1), (30, 1)], key=str)
