import pytest
import os

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidewater.sources import files as SF_
from tidewater.sources import sinks as SK
from tidewater.sources.tables import load_table


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_people_json_and_txt(spark, tmp_path):
    pj = write(tmp_path, "people.json",
               '{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    df = SF_.read_json(spark, pj)
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields) == {"age": "bigint", "name": "string"}
    assert rows(df.select((F.col("age") + 1).alias("a")), "a") == [(None,), (20,), (31,)]
    assert rows(df.filter(F.col("age") > 21), "name") == [("Andy",)]
    assert sorted(rows(df.groupBy("age").count()), key=str) == sorted([(None, 1), (19, 1), (30, 1)], key=str)
    pt = write(tmp_path, "people.txt", "Michael, 29\nAndy, 30\nJustin, 19\n")
    people = SF_.read_delimited(spark, pt, "name string, age int")
    people.createOrReplaceTempView("people_t")
    teen = spark.sql("SELECT name FROM people_t WHERE age >= 13 AND age <= 19")
    assert [r[0] for r in teen.select(F.concat(F.lit("Name: "), "name")).collect()] == ["Name: Justin"]


def test_graph_load(spark, tmp_path):
    p = write(tmp_path, "edges.txt", "# comment\n1 2\n1 3\n2 3\n3 4\n4 1\n4 3\n")
    e = SF_.read_edge_list(spark, p)
    assert rows(e) == [(1, 2), (1, 3), (2, 3), (3, 4), (4, 1), (4, 3)]
    v = SF_.read_vertices(spark, write(tmp_path, "nodes.txt", "1,user1\n2,user2\n3,user3\n4,user4\n"))
    assert rows(v) == [(1, "user1"), (2, "user2"), (3, "user3"), (4, "user4")]


def test_edge_list_ids(spark, tmp_path):
    p = write(tmp_path, "mixed.txt", "a b c\n1 x\nlonely\n\n# no\na b\n")
    assert rows(SF_.read_edge_list(spark, p, ids="string").distinct()) == [("1", "x"), ("a", "b")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        SF_.read_edge_list(spark, p).collect()


def test_json_column_of_one_late_row(spark, tmp_path):
    p = write(tmp_path, "rows.json", '{"a": 1}\n' * 500 + '{"a": 2, "late": "x"}\n')
    assert SF_.read_json(spark, p).where("late = 'x'").count() == 1


def test_shared_folder_is_required_on_a_cluster():
    from tidewater.session import checkpoint_root

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_text_and_tsv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a b",), ("",), ("c",)], "value string")
    out = SK.write_text(df.repartition(2), str(tmp_path / "t"))
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) >= 1
    assert rows(SF_.read_text(spark, out)) == [("",), ("a b",), ("c",)]
    kv = spark.createDataFrame([("x", 1), ("y", 2)], "key string, value bigint")
    p = SK.write_tsv(kv, str(tmp_path / "tsv"))
    assert open([os.path.join(p, f) for f in os.listdir(p) if f.startswith("part-") and os.path.getsize(os.path.join(p, f))][0]).read().count("\t") >= 1
    assert rows(SK.read_tsv(spark, p, "key string, value bigint")) == [("x", 1), ("y", 2)]


def test_tables_cast_event_time(spark):
    ev = load_table(spark, SF, "events")
    assert ev.schema["ts"].dataType.simpleString() == "timestamp"
    assert ev.count() == 1000


def test_repartition(spark):
    df = spark.range(100)
    assert df.repartition(4).rdd.getNumPartitions() == 4
    assert df.repartition(4).coalesce(2).rdd.getNumPartitions() == 2
    assert df.repartition(3, "id").count() == 100


def test_persist_released(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2).persist(StorageLevel.MEMORY_AND_DISK)
    assert df.count() == 1000
    assert df.storageLevel == StorageLevel.MEMORY_AND_DISK
    df.unpersist(blocking=True)
    assert not df.storageLevel.useMemory and not df.storageLevel.useDisk
