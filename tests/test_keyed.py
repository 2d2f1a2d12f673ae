from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import keyed as K


def test_map_filter_flatmap(spark):
    nums = spark.createDataFrame([(x,) for x in range(1, 7)], "x bigint")
    assert [r[0] for r in nums.select(F.pow("x", 2)).orderBy(1).collect()] == [1, 4, 9, 16, 25, 36]
    assert [r[0] for r in nums.filter(F.col("x") % 2 == 0).orderBy("x").collect()] == [2, 4, 6]
    arr = F.when(F.col("x") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("x") - 1)).otherwise(F.array())
    assert nums.select(F.explode(arr)).count() == 21
    zero = spark.createDataFrame([(0,)], "x bigint").select(arr.alias("a")).first()["a"]
    assert zero == []


# The small users, pets and visits tables below are fixed inputs of FIXTURES.md.
def test_users(spark):
    users = spark.createDataFrame([("A", 20), ("B", 30), ("C", 40)], "k string, v int")
    later = users.select(F.concat("k", F.lit("/later")).alias("k"), (F.col("v") + 1).alias("v"))
    assert rows(later) == [("A/later", 21), ("B/later", 31), ("C/later", 41)]
    assert rows(K.map_values(users, "v", lambda v: F.pow(v, 2)), "v") == [(400.0,), (900.0,), (1600.0,)]
    kv = rows(K.keys_values(users, "k", "v"))
    assert kv == sorted([("key", "A"), ("key", "B"), ("key", "C"), ("value", "20"), ("value", "30"), ("value", "40")])


def test_pets(spark):
    pets = spark.createDataFrame([("cat", 1), ("dog", 2), ("cat", 3)], "k string, v int")
    assert rows(K.lookup(pets, "k", "v", "cat")) == [(1,), (3,)]
    assert rows(K.group_list(pets, "k", "v")) == [("cat", [1, 3]), ("dog", [2])]
    assert rows(K.reduce_sum(pets, "k", "v")) == [("cat", 4), ("dog", 2)]
    assert rows(K.reduce_by_key(pets.repartition(3), "k", "v", lambda a, b: a + b)) == [("cat", 4), ("dog", 2)]
    assert rows(K.reduce_by_key(pets, "k", "v", lambda a, b: F.greatest(a, b))) == [("cat", 3), ("dog", 2)]


def test_as_map_last_value_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 5), (1, "b", 2), (2, "a", 9)], "g int, k string, v int")
    got = {r.g: r.entries for r in K.as_map(df, "g", "k", "v").collect()}
    assert got == {1: {"a": 5, "b": 2}, 2: {"a": 9}}


def test_joins_visits(spark):
    visits = spark.createDataFrame([("index.html", "1.2.3.4"), ("about.html", "3.2.3.4"), ("index.html", "5.4.3.2"),
                                    ("help.html", "7.6.1.2")], "page string, ip string")
    names = spark.createDataFrame([("index.html", "Home"), ("about.html", "About"), ("prod.html", "Products")],
                                  "page string, title string")
    inner = rows(visits.join(names, "page"), "page", "title")
    assert inner == [("about.html", "About"), ("index.html", "Home"), ("index.html", "Home")]
    assert rows(visits.join(names, "page", "left_anti"), "page") == [("help.html",)]
    assert visits.join(names, "page", "full").count() == 5
    cg = {r.page: (r.left_values, r.right_values) for r in K.cogroup_lists(visits, names, "page", "ip", "title").collect()}
    assert cg["prod.html"] == ([], ["Products"]) and cg["help.html"] == (["7.6.1.2"], [])


def test_cogroup_apply(spark):
    a = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, 10.0), (3, 7.0)], "k int, w double")

    def f(x, y):
        import pandas as pd
        k = x["k"].iloc[0] if len(x) else y["k"].iloc[0]
        return pd.DataFrame({"k": [k], "total": [x["v"].sum() + y["w"].sum()]})

    got = rows(K.cogroup_apply(a, b, "k", f, "k int, total double"))
    assert got == [(1, 15.0), (2, 1.0), (3, 7.0)]


def test_sample_n(spark):
    df = spark.range(100)
    s = K.sample_n(df, 10, "id", seed=3)
    assert rows(s) == rows(K.sample_n(df.repartition(7), 10, "id", seed=3))
    got = [r.id for r in s.collect()]
    assert len(got) == 10 and len(set(got)) == 10
    assert K.sample_n(spark.range(4), 10, "id").count() == 4


def test_reduce_by_key_built_in_is_partial(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    assert rows(K.reduce_by_key(df, "k", "v", "max")) == [(0, 99), (1, 97), (2, 98)]
    assert rows(K.reduce_by_key(df, "k", "v", "sum")) == rows(K.reduce_by_key(df, "k", "v", lambda a, b: a + b))
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(K.reduce_by_key(df, "k", "v", "sum")._jdf.queryExecution(), "simple")
    assert "partial_sum" in plan


def test_sample_draws_rows_without_key_one_by_one(spark):
    rows_ = [(None, i) for i in range(300)] + [(5, i) for i in range(300, 600)] + [(i, i) for i in range(600, 1000)]
    df = spark.createDataFrame(rows_, "key int, v int")
    took = [0, 0, 0]
    for seed in range(20):
        for r in K.sample_n(df, 30, "key", seed=seed).collect():
            took[0 if r.key is None else 1 if r.key == 5 else 2] += 1
    assert sum(took) == 600
    assert all(abs(t - want) < 60 for t, want in zip(took, (180, 180, 240))), took


def test_reduce_folds_a_hot_key_in_runs(spark):
    """A third of the rows on one key, runs of 8 rows: three levels, and no array above a run."""
    rows_ = [(0 if i % 3 == 0 else i, i) for i in range(3000)] + [(9999, None), (0, None)]
    df = spark.createDataFrame(rows_, "k int, v int").repartition(4)
    want = {}
    for k, v in rows_:
        want[k] = v if want.get(k) is None else want[k] if v is None else max(v, want[k])
    got = K.reduce_by_key(df, "k", "v", lambda a, b: F.greatest(a, b), run_rows=8)
    assert dict(rows(got)) == want
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert plan.count("collect_list") >= 6  # partial and final aggregate of three levels
