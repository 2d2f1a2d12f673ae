"""Operator 3: approximate nearest neighbours with a navigable small-world graph per shard.

Equal vectors are one point that keeps its ``k + 1`` smallest ids (more can never be among
the ``k`` nearest of a query). Points are dealt to shards of about ``SHARD_POINTS`` by a
hash of the id; each shard builds a hierarchical graph in numpy and stores it as one row
of flat arrays: vectors, levels, and per level the neighbour ids of every point (padded
with -1). Points are inserted in batches: a batch searches the graph so far, sees its own
members too, and links by the diversity rule (a candidate closer to a chosen neighbour than
to the point is passed over). Searches advance a whole batch of queries by one hop at a
time. The stated queries go to every shard in blocks, each shard re-ranks its best points by
the exact double-precision distance on the original vectors, and Spark merges the shards.

Recall against brute force is measured in the tests (at least 0.9 is required).

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take
no part; vectors of another length are another space; rows with the query's own id are
never its answers; a row repeated with id and vector counts once; ties go to the smaller
id; a shard of at most ``ef`` points is searched whole, so small tables are exact; an empty
table gives no rows. Ids must not be null (such rows take no part).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import read_table, sorted_groups, written

K = 10
SHARD_POINTS = 8192
QUERY_BLOCK = 8192
M = 16
EF_BUILD, EF_SEARCH = 80, 128
BATCH = 512


class Graph:
    """Points ``x``; ``points[l]`` are the points of level ``l``, row by row of ``near[l]``, their
    neighbours; ``row[l]`` is the row of a point."""

    def __init__(self, x: np.ndarray, points: list[np.ndarray], near: list[np.ndarray], entry: int):
        self.x, self.points, self.near, self.entry = x, points, near, entry
        self.row = [np.zeros(len(x), np.int64) for _ in points]
        for row, here in zip(self.row, points):
            row[here] = np.arange(len(here))
        self.norm = np.einsum("nd,nd->n", x, x)

    def distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of every query to its row of ids (-1: infinite)."""
        d = self.norm[ids] - 2 * np.einsum("amd,ad->am", self.x[ids], q) + np.einsum("ad,ad->a", q, q)[:, None]
        return np.where(ids < 0, np.inf, np.maximum(d, 0))

    def search_level(self, q: np.ndarray, start: np.ndarray, level: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``ef`` ids and distances per query, nearest first, from ``start`` (queries x any)."""
        near, row = self.near[level], self.row[level]
        n, width = len(q), max(ef, start.shape[1])
        ids = np.full((n, width), -1, np.int64)
        ids[:, :start.shape[1]] = start
        dist = self.distances(q, ids)
        opened = ids < 0
        seen = np.zeros((n, len(self.x)), bool)
        at, to = np.nonzero(start >= 0)
        seen[at, start[at, to]] = True
        live = np.arange(n)
        while len(live):
            d = np.where(opened[live], np.inf, dist[live])
            best = d.argmin(axis=1)
            go = np.isfinite(d[np.arange(len(live)), best])
            live, best = live[go], best[go]
            if not len(live):
                break
            opened[live, best] = True
            new = near[row[ids[live, best]]].astype(np.int64)
            new[(new >= 0) & seen[live[:, None], new]] = -1
            a, m = np.nonzero(new >= 0)
            seen[live[a], new[a, m]] = True
            d_new = self.distances(q[live], new)
            all_d = np.concatenate((dist[live], d_new), axis=1)
            pick = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            dist[live] = np.take_along_axis(all_d, pick, 1)
            ids[live] = np.take_along_axis(np.concatenate((ids[live], new), axis=1), pick, 1)
            opened[live] = np.take_along_axis(np.concatenate((opened[live], new < 0), axis=1), pick, 1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :ef]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)

    def descend(self, q: np.ndarray, level: int, ef: int = 4) -> np.ndarray:
        start = np.full((len(q), 1), self.entry, np.int64)
        for at in range(len(self.near) - 1, level, -1):
            start = self.search_level(q, start, at, ef)[0]
        return start

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        if len(self.x) <= ef:
            return np.broadcast_to(np.arange(len(self.x)), (len(q), len(self.x)))
        return self.search_level(q, self.descend(q, 0), 0, ef)[0]

    def diverse(self, ids: np.ndarray, dist: np.ndarray, keep: int) -> np.ndarray:
        """Per row the candidates (nearest first) not closer to a kept one than to the point;
        places left over are filled with the nearest passed over."""
        x = self.x[ids]
        between = self.norm[ids][:, :, None] + self.norm[ids][:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
        n, c = ids.shape
        kept, closest = np.zeros((n, c), bool), np.full((n, c), np.inf)
        for i in range(c):
            take = (ids[:, i] >= 0) & (closest[:, i] > dist[:, i]) & (kept.sum(axis=1) < keep)
            kept[:, i] = take
            closest = np.where(take[:, None], np.minimum(closest, between[:, i]), closest)
        order = np.argsort(np.where(ids < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :keep]
        out = np.take_along_axis(ids, order, 1)
        return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


def build(x: np.ndarray, seed: int, m: int = M, ef: int = EF_BUILD) -> Graph:
    n = len(x)
    rng = np.random.Generator(np.random.PCG64([3, seed]))
    level = np.minimum((-np.log(1 - rng.random(n)) / np.log(m)).astype(int), 8)
    order = rng.permutation(n)
    order = order[np.argsort(-level[order], kind="stable")]  # a level's points exist before searches pass it
    points = [np.flatnonzero(level >= at).astype(np.int32) for at in range(level.max() + 1)]
    near = [np.full((len(here), m if at else 2 * m), -1, np.int32) for at, here in enumerate(points)]
    g = Graph(x, points, near, int(order[0]))
    done = 1
    while done < n:
        batch = order[done:done + min(BATCH, max(16, done // 2))]
        for at in range(int(level[batch].max()), -1, -1):
            new = batch[level[batch] >= at]
            q = x[new]
            found = g.search_level(q, g.descend(q, at), at, ef)[0]
            own = np.broadcast_to(new, (len(new), len(new)))
            peers = np.argsort(g.distances(q, own), axis=1, kind="stable")[:, :ef // 2 + 1]
            peers = np.where(new[peers] == new[:, None], -1, new[peers])
            cand = np.concatenate((found, peers), axis=1)
            d = g.distances(q, cand)
            near_first = np.argsort(d, axis=1, kind="stable")[:, :ef]
            cand, d = np.take_along_axis(cand, near_first, 1), np.take_along_axis(d, near_first, 1)
            chosen = g.diverse(cand, d, m)
            g.near[at][g.row[at][new], :m] = chosen
            _link_back(g, at, new, chosen)
        done += len(batch)
    return g


def _link_back(g: Graph, level: int, points: np.ndarray, chosen: np.ndarray) -> None:
    a, b = np.nonzero(chosen >= 0)
    to, frm = chosen[a, b], points[a]
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    width = g.near[level].shape[1]
    while len(to):  # a few new links of every point at a time
        start = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
        nth = np.arange(len(to)) - np.repeat(start, np.diff(np.append(start, len(to))))
        now = nth < width
        ids = to[start]
        slot = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(to))))
        new = np.full((len(ids), width), -1, np.int64)
        new[slot[now], nth[now]] = frm[now]
        cand = np.concatenate((g.near[level][g.row[level][ids]].astype(np.int64), new), axis=1)
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        d = g.distances(g.x[ids], cand)
        order = np.argsort(d, axis=1, kind="stable")
        cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
        full = (cand >= 0).sum(axis=1) > width
        out = cand[:, :width].copy()
        if full.any():
            out[full] = g.diverse(cand[full], d[full], width)
        g.near[level][g.row[level][ids]] = out
        to, frm = to[~now], frm[~now]


INDEX = ("dim int, shard int, n int, entry int, vectors binary, ids array<array<long>>, "
         "levels array<struct<points: binary, near: binary, width: int>>")


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("entry", pa.int32()),
                        ("vectors", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64()))),
                        ("levels", pa.list_(pa.struct([("points", pa.binary()), ("near", pa.binary()), ("width", pa.int32())])))])
    for (dim, shard), t in sorted_groups(batches, 2):
        x = np.array(t.column("v").combine_chunks().flatten().to_numpy(), np.float64).reshape(-1, dim)
        g = build(x.astype(np.float32), shard)
        levels = [{"points": p.tobytes(), "near": near.tobytes(), "width": near.shape[1]}
                  for p, near in zip(g.points, g.near)]
        yield pa.RecordBatch.from_pylist([{"dim": dim, "shard": shard, "n": len(x), "entry": g.entry, "vectors": x.tobytes(),
                                           "ids": t.column("ids").to_pylist(), "levels": levels}], schema)


def _searcher(k: int, ef: int):
    def search(_, index: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for part in index.to_pylist():
            x = np.frombuffer(part["vectors"], np.float64).reshape(part["n"], -1)
            g = Graph(x.astype(np.float32), [np.frombuffer(lv["points"], np.int32) for lv in part["levels"]],
                      [np.frombuffer(lv["near"], np.int32).reshape(-1, lv["width"]) for lv in part["levels"]], part["entry"])
            qid, qh = queries.column("vec_id").to_numpy(), queries.column("qh").to_numpy()
            q = np.array(queries.column("v").combine_chunks().flatten().to_numpy(), np.float64).reshape(len(qid), -1)
            for at in range(0, len(q), BATCH):
                best = g.search(q[at:at + BATCH].astype(np.float32), ef)
                for i, ids in enumerate(best):
                    ids = ids[ids >= 0]
                    d = np.sqrt(((x[ids] - q[at + i]) ** 2).sum(axis=1))
                    some = np.argsort(d, kind="stable")
                    some = some[d[some] <= d[some[min(k, len(some) - 1)]]] if len(some) else some
                    rows = sorted((s, v) for s, p in zip(d[some].tolist(), ids[some].tolist())
                                  for v in part["ids"][p] if v != qid[at + i])[:k]
                    for s, v in rows:
                        for c, value in zip(out, (qid[at + i], qh[at + i], v, s)):
                            c.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                         pa.array(out[3], pa.float64())], ["query_id", "qh", "vec_id", "score"])

    return search


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists(v, lambda c: c != 0), F.lit(False))))


def index_shards(points: DataFrame, k: int = K, shard_points: int = SHARD_POINTS) -> DataFrame:
    """The stored graphs, a row per shard of ``(vec_id, v)``."""
    same = Window.partitionBy("v").orderBy("vec_id")
    distinct = written(points.withColumn("r", F.dense_rank().over(same)).where(F.col("r") <= k + 1)
                       .groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
                       .withColumn("dim", F.size("v")), "ann-points")
    sizes = F.broadcast(distinct.groupBy("dim").agg(F.ceil(F.count("*") / shard_points).cast("int").alias("shards")))
    dealt = distinct.join(sizes, "dim").select(
        "dim", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("shards")).cast("int").alias("shard"), "v", "ids")
    return written(dealt.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("ids")[0])
                   .mapInArrow(_build, INDEX), "ann-index")


def in_blocks(asked: DataFrame, query_block: int = QUERY_BLOCK) -> tuple[DataFrame, int]:
    """``asked`` with a ``block`` of about ``query_block`` rows, and the number of blocks; rows
    with equal vectors spread over all of them."""
    blocks = max(1, -(-asked.count() // query_block))
    return asked.withColumn("block", F.pmod(F.xxhash64("qh", "vec_id"), F.lit(blocks).cast("long"))), blocks


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
            ef: int = EF_SEARCH, shard_points: int = SHARD_POINTS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every query row."""
    index = index_shards(usable(vectors, id_col, vec_col), k, shard_points)
    asked = usable(queries, id_col, vec_col).distinct().withColumn("qh", F.xxhash64("v")).withColumn("dim", F.size("v"))
    asked = written(asked, "ann-queries")
    asked, blocks = in_blocks(asked, query_block)
    shards = F.broadcast(index.groupBy(F.col("dim").alias("to_dim")).agg(F.max("shard").alias("last")))  # a row per length of vectors
    sent = (asked.join(shards, F.col("dim") == F.col("to_dim"))
            .select("to_dim", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("to_shard"), F.col("block").alias("to_block"),
                    "vec_id", "qh", "v"))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = (copies.groupBy("dim", "shard", "block").cogroup(sent.groupBy("to_dim", "to_shard", "to_block"))
             .applyInArrow(_searcher(k, ef), "query_id long, qh long, vec_id long, score double"))
    best = Window.partitionBy("query_id", "qh").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES = {"op3_hnsw": op3_hnsw}
ORACLE: dict[str, str] = {}
