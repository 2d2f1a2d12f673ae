import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import graph as G


@pytest.fixture(scope="module")
def social(spark):
    v = spark.createDataFrame([(1, "Alice", 28), (2, "Bob", 27), (3, "Jussi", 35), (4, "Magnus", 42),
                               (5, "Michael", 53), (6, "Martin", 40)], "id bigint, name string, age int")
    e = spark.createDataFrame([(2, 1, 7), (2, 4, 2), (3, 2, 4), (3, 6, 3), (4, 1, 1), (5, 2, 2), (5, 3, 8), (5, 6, 3)],
                              "src bigint, dst bigint, w int")
    return v, e


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


FOUR = [(1, 2), (1, 3), (2, 3), (3, 4), (4, 1), (4, 3)]


def test_social_basics(spark, social):
    v, e = social
    assert rows(v.filter(F.col("age") > 30), "name") == [("Jussi",), ("Magnus",), ("Martin",), ("Michael",)]
    assert rows(e.filter(F.col("w") > 5), "src", "dst") == [(2, 1), (5, 3)]
    assert rows(G.in_degrees(e)) == [(1, 2), (2, 2), (3, 1), (4, 1), (6, 2)]
    assert rows(G.out_degrees(e)) == [(2, 2), (3, 2), (4, 1), (5, 3)]
    ud = G.with_degrees(v.select("id", "name"), e).filter(F.col("inDeg") > 0)
    assert rows(ud, "name", "inDeg", "outDeg") == [("Alice", 2, 0), ("Bob", 2, 2), ("Jussi", 1, 2),
                                                  ("Magnus", 1, 1), ("Martin", 2, 0)]
    t = G.triplets(v, e, "name").select(F.concat("src_name", F.lit(" likes "), "dst_name"))
    assert "Bob likes Alice" in [r[0] for r in t.collect()]
    # degree sums equal the edge count
    assert G.in_degrees(e).agg(F.sum("inDeg")).first()[0] == e.count()


def test_subgraph_components(spark, social):
    v, e = social
    sv, se = G.subgraph(v, e, F.col("age") > 30)
    assert rows(se, "src", "dst") == [(3, 6), (5, 3), (5, 6)]
    cc = G.connected_components(se, sv)
    assert rows(cc) == [(3, 3), (4, 4), (5, 3), (6, 3)]
    _, se2 = G.subgraph(v, e, F.col("age") > 0, F.col("w") > 2)
    assert rows(se2, "src", "dst") == [(2, 1), (3, 2), (3, 6), (5, 3), (5, 6)]


def test_triangles(spark, social):
    _, e = social
    assert rows(G.triangle_counts(e)) == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 2), (6, 1)]


def test_components_long_path_and_invariants(spark):
    path = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101)]
    cc = G.connected_components(edges(spark, path))
    got = dict(rows(cc))
    assert all(got[i] == 1 for i in range(1, 41))
    assert got[100] == got[101] == got[102] == 100


def pr(df):
    return {r.id: r.rank for r in df.collect()}


def test_pagerank_four_nodes(spark):
    e = edges(spark, FOUR)
    want_join = {1: 0.732390, 2: 0.461320, 3: 1.435762, 4: 1.370528}
    want_pregel = {1: 0.708477, 2: 0.449309, 3: 1.387898, 4: 1.322533}
    want_conv = {1: 0.732441, 2: 0.461287, 3: 1.435823, 4: 1.370449}
    for got, want, tol in [(pr(G.pagerank_join(e, 20)), want_join, 1e-6),
                           (pr(G.pagerank_pregel(e, 20)), want_pregel, 1e-6),
                           (pr(G.pagerank_converged(e, 1e-4)), want_conv, 1e-3)]:
        assert set(got) == set(want)
        for k in want:
            assert abs(got[k] - want[k]) < tol, (k, got[k], want[k])
    assert abs(sum(pr(G.pagerank_join(e, 20)).values()) - 4.0) < 1e-3


def test_pagerank_chain_and_cycle(spark):
    chain = edges(spark, [(1, 2), (2, 3)])
    got = pr(G.pagerank_pregel(chain, 20))
    assert [round(got[i], 6) for i in (1, 2, 3)] == [0.15, 0.2775, 0.385875]
    assert set(pr(G.pagerank_join(chain, 1))) == {2, 3}
    assert set(pr(G.pagerank_join(chain, 2))) == {3}
    assert pr(G.pagerank_join(chain, 3)) == {}
    cyc = edges(spark, [(1, 2), (2, 3), (3, 2)])
    got = pr(G.pagerank_pregel(cyc, 20))
    assert [round(got[i], 6) for i in (1, 2, 3)] == [0.15, 0.967054, 0.972868]
    got = pr(G.pagerank_join(cyc, 20))
    assert set(got) == {2, 3} and abs(got[2] - 1.0) < 1e-5 and abs(got[3] - 1.03876) < 1e-5


def test_edge_weights_neighbors_bfs(spark):
    e = edges(spark, FOUR)
    w = {(r.src, r.dst): r.weight for r in G.edge_weights(e).collect()}
    assert w[(1, 2)] == 0.5 and w[(2, 3)] == 1.0
    assert rows(G.neighbors(e)) == [(1, 2), (1, 3), (2, 3), (3, 4), (4, 1), (4, 3)]
    assert rows(G.neighbors(e, "in")) == sorted((d, s) for s, d in FOUR)
    assert G.neighbors(e, "either").count() == 12
    assert rows(G.bfs_levels(e, 1)) == [(1, 0), (2, 1), (3, 1), (4, 2)]


def test_hub_is_salted_and_ranks_unchanged(spark):
    n = 400
    star = edges(spark, [(0, i) for i in range(1, n + 1)] + [(1, 2)])
    adjacency = G.Adjacency(star)
    assert [r.src for r in adjacency.heavy.collect()] == [0]
    k = adjacency.heavy.first()["_k"]
    assert k > 1 and adjacency.blocks.filter("src = 0").select("_salt").distinct().count() == k
    assert sorted(rows(adjacency.sent(spark.range(n).withColumnRenamed("id", "src")), "src", "dst")) == rows(star)
    adjacency.release()
    got = pr(G.pagerank_pregel(star, 20))
    leaf = 0.15 + 0.85 * 0.15 / n
    assert abs(got[0] - 0.15) < 1e-12
    assert abs(got[3] - leaf) < 1e-12
    assert abs(got[2] - (0.15 + 0.85 * leaf)) < 1e-12  # round 2: only vertex 1 (a receiver) sends
    j = pr(G.pagerank_join(star, 1))
    assert abs(j[3] - (0.15 + 0.85 * 1.0 / n)) < 1e-12 and 0 not in j


def test_loops_run_to_convergence_or_raise(spark):
    path = edges(spark, [(i, i + 1) for i in range(10)])
    assert rows(G.bfs_levels(path, 0)) == [(i, i) for i in range(11)]
    assert {r.component for r in G.connected_components(path).collect()} == {0}
    with pytest.raises(RuntimeError):
        G.connected_components(path, max_rounds=1)
    with pytest.raises(RuntimeError):
        G.pagerank_converged(edges(spark, FOUR), max_rounds=2)


def test_hub_edges_are_spread(spark):
    """One source with two thirds of the edges: results as by plain joins, no task with all of them."""
    pairs = [(0, i) for i in range(1, 2001)] + [(i, i + 1) for i in range(1, 1001)]
    e = edges(spark, pairs).repartition(16)
    degree = {}
    for s, _ in pairs:
        degree[s] = degree.get(s, 0) + 1
    weighted = G.edge_weights(e)
    assert rows(weighted) == sorted((s, d, 1.0 / degree[s]) for s, d in pairs)
    sizes = [r[0] for r in weighted.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2000
    assert {r.component for r in G.connected_components(e).collect()} == {0}
    star = edges(spark, [(0, i) for i in range(1, 301)] + [(i, i + 1) for i in range(1, 300)])
    tri = dict(rows(G.triangle_counts(star)))
    assert tri[0] == 299 and tri[1] == 1 and tri[2] == 2


def test_blocks_are_bounded_and_keep_edge_columns(spark):
    e = spark.range(20_000).select((F.col("id") % 3).alias("src"), F.col("id").alias("dst"), (F.col("id") * 2).alias("w"))
    verts = G.vertices_from_edges(e)
    adjacency = G.Adjacency(e, verts, out_degree=True)
    assert adjacency.blocks.agg(F.max(F.size("dsts"))).first()[0] <= G.BLOCK
    assert adjacency.blocks.count() < 20_000 + 100
    sent = adjacency.sent(verts.withColumnRenamed("id", "src")).where("NOT _self")
    assert sent.agg(F.count("*"), F.sum("w"), F.max("outDeg")).first()[:2] == (20_000, sum(2 * i for i in range(20_000)))
    adjacency.release()


def plain_join_ranks(pairs, rounds):
    """Ranks by dictionaries, as ``pagerank_join`` defines them."""
    pairs, degree = set(pairs), {}
    for s, _ in pairs:
        degree[s] = degree.get(s, 0) + 1
    rank = dict.fromkeys(degree, 1.0)
    for _ in range(rounds):
        got = {}
        for s, d in pairs:
            if s in rank:
                got[d] = got.get(d, 0.0) + rank[s] / degree[s]
        rank = {d: 0.15 + 0.85 * x for d, x in got.items()}
    return rank


@pytest.mark.parametrize("of", [int, str])
def test_join_ranks_equal_a_plain_loop(spark, monkeypatch, of):
    """Hubs that send and get much, parallel edges, vertices that lose their rank, a checkpoint."""
    monkeypatch.setattr(G, "SHARD_EDGES", 50)
    rng = random.Random(3)
    pairs = [(0, i) for i in range(1, 301)] + [(i, 0) for i in range(1, 200)] + [(7, i) for i in range(100, 400)]
    pairs += [(rng.randrange(500), 2 * rng.randrange(250)) for _ in range(1500)] + [(401, 402)] * 900
    pairs = [(of(a), of(b)) for a, b in pairs]
    e = edges(spark, pairs) if of is int else spark.createDataFrame(pairs, "src string, dst string")
    for rounds in (1, 3, 7):
        got, want = pr(G.pagerank_join(e.repartition(5), rounds)), plain_join_ranks(pairs, rounds)
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_a_missing_source_sends_nothing_and_a_missing_end_is_an_end(spark):
    e = spark.createDataFrame([(1, 2), (1, None), (2, 1), (None, 2), (None, 7)], "src bigint, dst int")
    ranks = G.pagerank_join(e, 2)
    assert ranks.dtypes == [("id", "int"), ("rank", "double")]
    one = 0.15 + 0.85
    assert pr(ranks) == pytest.approx({1: 0.15 + 0.85 * (0.15 + 0.85 / 2), 2: 0.15 + 0.85 * one / 2, None: 0.15 + 0.85 * one / 2})


def test_rank_rounds_send_numbers_by_shard(spark, monkeypatch):
    """A round shuffles a row per pair of shards, not one per edge, and no shard has a hub's edges alone."""
    monkeypatch.setattr(G, "SHARD_EDGES", 500)
    e = spark.range(8000).select((F.col("id") % 90).alias("src"), (F.col("id") % 1000).alias("dst")) \
        .union(spark.range(2000).select(F.lit(0).cast("long"), F.col("id") + 5000))
    shards = G.RankShards(e, 0.15)
    sent = shards.next(shards.first())
    assert shards.rows.count() == 8 and sent.count() <= 64
    assert sent.agg(F.sum(F.length("sums"))).first()[0] / 8 <= e.distinct().count()
    held = [r[0] // 4 for r in shards.rows.select(F.length("edges")).collect()]
    assert sum(held) == e.distinct().count() and max(held) < 2000
    assert "FlatMapCoGroupsInArrow" in sent._jdf.queryExecution().executedPlan().toString()
    shards.release()


def test_message_passing_reads_edge_columns(spark):
    e = spark.createDataFrame([(1, 2, 5.0), (1, 3, 1.0), (3, 2, 1.5)], "src long, dst long, w double")
    verts = spark.createDataFrame([(1, 0.0), (2, None), (3, None)], "id long, value double")
    near = G.message_passing(verts, e, None, send=lambda: F.col("src_value") + F.col("w"), combine=F.min,
                             update=lambda v, m: F.when(m.isNull(), v).otherwise(F.least(v, m)),
                             accept=lambda v, m: v.isNull() | (m < v), max_rounds=None)
    assert rows(near) == [(1, 0.0), (2, 2.5), (3, 1.0)]


def plain_components(pairs):
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return sorted((i, find(i)) for i in root)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    import random
    rng = random.Random(seed)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)]
    pairs += [(1000 + i, 1001 + i) for i in range(300)] + [(5000, 5001 + i) for i in range(400)] + [(7, 7), (9000, 9000)]
    assert rows(G.connected_components(edges(spark, pairs))) == plain_components(pairs)


def test_components_shrink_every_round(spark):
    path = edges(spark, [(i, i + 1) for i in range(3000)])
    maps, sizes = G.contraction_rounds(G.undirected(path))
    assert sizes[0] == 3000 and all(b <= 0.8 * a + 2 for a, b in zip(sizes, sizes[1:])), sizes
    assert len(maps) == len(sizes) < 25


def test_components_of_text_ids(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y")], "src string, dst string")
    assert rows(G.connected_components(e)) == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")]


def plain_triangles(pairs):
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return {a: sum(len(near[a] & near[b]) for b in near[a]) // 2 for a in near}


@pytest.mark.parametrize("task_edges", [2_000_000, 50])
def test_triangles_against_plain_count(spark, task_edges):
    import random
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(500)] + [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(100, 200)]
    got = dict(rows(G.triangle_counts(edges(spark, pairs), task_edges=task_edges)))
    assert got == plain_triangles(pairs)


def test_triangle_tasks_are_bounded(spark):
    """A hub with half of the edges: an edge is shipped once per colour, and no task has many times the average."""
    import random
    rng = random.Random(4)
    pairs = {tuple(sorted((rng.randrange(2000), rng.randrange(2000)))) for _ in range(6000)} | {(5000, i) for i in range(2000)}
    pairs = [p for p in pairs if p[0] != p[1]]
    colours = G._colours(len(pairs), 8, 500)
    sizes = [r["count"] for r in G.triangle_tasks(G.undirected(edges(spark, pairs)), colours).groupBy("task").count().collect()]
    assert sum(sizes) == colours * len(pairs)
    assert max(sizes) < 5 * 500


def test_triangles_of_text_ids(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    assert rows(G.triangle_counts(e)) == [("a", 1), ("b", 1), ("c", 1), ("d", 0)]


def test_residual_ranks_read_fewer_edges(spark):
    """A fast tail and a slow cycle: ranks as by many plain rounds, and rounds read fewer and fewer edges."""
    cycle = [(i, (i + 1) % 5) for i in range(5)]
    tail = [(100 + i, 101 + i) for i in range(30)] + [(100, 200 + i) for i in range(50)]
    e = edges(spark, cycle + tail + [(100, 0)])
    ranks, read = G.pagerank_residual(e, bound=1e-3)
    pairs = rows(e)
    out = {a: sum(x == a for x, _ in pairs) for a, _ in pairs}
    want = {v: 1.0 for p in pairs for v in p}
    for _ in range(200):
        want = {v: 0.15 + 0.85 * sum(want[a] / out[a] for a, b in pairs if b == v) for v in want}
    got = pr(ranks)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-2 for k in want)
    assert read[0] == 86 and read[-1] <= 10 and sum(read) < 0.5 * 86 * len(read), read


def test_residual_ranks_with_ends_of_two_types(spark):
    """Equal ids of two types hash apart; no edge may be passed over where only some folders are read."""
    pairs = [(i, (i * 7 + 3) % 40) for i in range(40)] + [(i, (i * i) % 20) for i in range(40)]
    e = spark.createDataFrame(pairs, "src int, dst long")
    out = {a: sum(x == a for x, _ in pairs) for a, _ in pairs}
    want = {v: 1.0 for p in pairs for v in p}
    for _ in range(60):
        want = {v: 0.5 + 0.5 * sum(want[a] / out[a] for a, b in pairs if b == v) for v in want}
    got = pr(G.pagerank_residual(e, bound=1e-5, reset=0.5, blocks=16)[0])
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-3 for k in want)


def test_residual_folders_hold_one_file(spark, monkeypatch):
    """Not one file per folder and writing task."""
    import glob
    folders = []
    monkeypatch.setattr(G, "scratch_path", lambda s, name, real=G.scratch_path: folders.append(real(s, name)) or folders[-1])
    e = edges(spark, [(i, (i * 7 + 3) % 300) for i in range(300)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        G.pagerank_residual(e, bound=1e-1, blocks=16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    path = next(f for f in folders if "residual-blocks" in f).removeprefix("file:")
    assert len(glob.glob(f"{path}/block=*")) == 16 == len(glob.glob(f"{path}/block=*/*.parquet"))


def test_small_rounds_of_components_are_few_files(spark, monkeypatch):
    """A round's tables have a file per so many rows, not one per shuffle partition."""
    import glob
    folders = []
    monkeypatch.setattr(G, "scratch_path", lambda s, name, real=G.scratch_path: folders.append(real(s, name)) or folders[-1])
    monkeypatch.setattr(G, "ROUND_ROWS", 250, raising=False)
    e = edges(spark, [(i, i + 1) for i in range(400) if i % 100])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: r.component for r in G.connected_components(e).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: (i - 1) // 100 * 100 + 1 for i in range(1, 401)}
    files = [len(glob.glob(f"{f.removeprefix('file:')}/*.parquet")) for f in folders if "component-map" in f]
    assert files[0] <= 4 and files[-1] == 1, files


def test_triangle_task_holds_little_beside_its_edges():
    """Some arrays as long as the edges, and pairs of edges half a million at a time."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1500, (2, 300_000))
    key = np.unique(np.minimum(a, b) * 1500 + np.maximum(a, b))
    key = key[key // 1500 != key % 1500]
    zero = np.zeros(len(key), np.int64)
    table = pa.table({"a": key // 1500, "b": key % 1500, "ca": zero, "cb": zero, "task": zero})
    tracemalloc.start()
    out = G._closed(1)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    m = np.zeros((1500, 1500))
    m[key // 1500, key % 1500] = m[key % 1500, key // 1500] = 1
    want = ((m @ m) * m).sum(axis=1) / 2
    assert dict(zip(out.column("id").to_pylist(), out.column("t").to_pylist())) == {i: int(w) for i, w in enumerate(want) if w}
    assert peak < 80 << 20, peak >> 20


def test_triangles_ship_packed_edges(spark, monkeypatch):
    """What goes to the tasks is some bytes an edge and task, not a row for each."""
    import random
    from pyspark.sql import functions as F
    rng = random.Random(5)
    pairs = {tuple(sorted((rng.randrange(3000), rng.randrange(3000)))) for _ in range(40_000)} | {(-1, i) for i in range(2000)}
    pairs = [p for p in pairs if p[0] != p[1]]
    shipped = []
    monkeypatch.setattr(G, "triangle_tasks", lambda rows, c, real=G.triangle_tasks: shipped.append((real(rows, c), c)) or shipped[-1][0])
    got = dict(rows(G.triangle_counts(edges(spark, pairs + pairs[:500]), task_edges=20_000)))
    assert got == plain_triangles(pairs)
    (sent, colours), = shipped
    assert colours == 4
    size = sent.agg(F.count(F.lit(1)), F.sum("n"), *[F.sum(F.length(c)) for c in ("a", "b", "runs", "spots")]).first() if "n" in sent.columns else (sent.count(),)
    assert size[0] < len(pairs) / 50, size
    assert size[1] == colours * len(pairs) and sum(size[2:]) < 5 * size[1], size


@pytest.mark.parametrize("kind", ["long", "int", "string", "timestamp"])
def test_triangles_of_blocks_of_any_ids(spark, monkeypatch, kind):
    """Far apart, negative and repeated ids, loops and missing ends; blocks cut after a few rows."""
    import random
    from pyspark.sql import functions as F
    monkeypatch.setattr(G, "BLOCK_EDGES", 100)
    rng = random.Random(6)
    far = {"long": 2 ** 57, "int": 2 ** 25}.get(kind, 86_400)
    pairs = [((rng.randrange(60) - 30) * far, (rng.randrange(60) - 30) * far) for _ in range(700)]
    raw = spark.createDataFrame(pairs + [(None, 5 * far), (7 * far, None), (99 * (far // 4), 99 * (far // 4))], "src long, dst long")
    e = raw.select(*[(F.timestamp_seconds(c) if kind == "timestamp" else F.col(c).cast(kind)).alias(c) for c in ("src", "dst")])
    out = G.triangle_counts(e, task_edges=50)
    assert out.schema["id"].dataType == e.schema["src"].dataType
    got = dict(rows(out.select(F.col("id").cast("long"), "triangles")))
    want = {v: 0 for p in raw.collect() for v in p} | plain_triangles(pairs)
    assert got == want


def test_edge_blocks_hold_the_edges():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(2)
    a, b = np.unique(rng.integers(-2 ** 63, 2 ** 63 - 1, 300)[rng.integers(0, 300, (2, 5000))], axis=1)
    ca, cb = np.abs(a % 3), np.abs(b % 3)
    batch = pa.RecordBatch.from_arrays([pa.array(v) for v in (a, b, ca, cb)], ["a", "b", "ca", "cb"])
    blocks = pa.Table.from_batches(list(G._edge_blocks(iter([batch.slice(0, 2000), batch.slice(2000)]))))
    assert len(blocks) == 9
    ids, colour, x, y = G._ends(blocks, pa.int64())
    assert sorted(zip(ids[x].tolist(), ids[y].tolist())) == sorted(zip(a.tolist(), b.tolist()))
    assert (colour == np.abs(ids % 3)).all()
