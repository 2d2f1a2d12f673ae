"""Property graphs as two DataFrames: ``vertices(id, …)`` and ``edges(src, dst, …)``.

Iterative algorithms run one Spark job per round from a driver loop; the only
driver-side values are round counters and one-row convergence figures. Lineage is
cut with reliable checkpoints (``spark.checkpoint.dir``), so a lost executor costs
at most the rounds since the last checkpoint.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.session import checkpoint_root, scratch_path

RESET = 0.15


# ---------------------------------------------------------------- structure

def vertices_from_edges(edges: DataFrame) -> DataFrame:
    """Vertex ids implied by the edges (both endpoints)."""
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def triplets(vertices: DataFrame, edges: DataFrame, attr: str) -> DataFrame:
    """Edges with one attribute of each endpoint: ``src_<attr>``, ``dst_<attr>``."""
    s = vertices.select(F.col("id").alias("src"), F.col(attr).alias(f"src_{attr}"))
    d = vertices.select(F.col("id").alias("dst"), F.col(attr).alias(f"dst_{attr}"))
    return edges.join(s, "src").join(d, "dst")


def in_degrees(edges: DataFrame) -> DataFrame:
    """``(id, inDeg)``; vertices without in-edges are absent."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDeg"))


def out_degrees(edges: DataFrame) -> DataFrame:
    """``(id, outDeg)``; vertices without out-edges are absent. Parallel edges count."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDeg"))


def subgraph(vertices: DataFrame, edges: DataFrame, vpred: Column | None = None,
             epred: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep vertices satisfying ``vpred`` and edges satisfying ``epred`` whose both
    ends were kept (two semi joins)."""
    v = vertices.filter(vpred) if vpred is not None else vertices
    e = edges.filter(epred) if epred is not None else edges
    ids = v.select("id")
    e = e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi") \
         .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return v, e


def with_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices with ``inDeg`` and ``outDeg`` (0 where none), by two left joins."""
    return (
        vertices.join(in_degrees(edges), "id", "left").join(out_degrees(edges), "id", "left")
        .withColumn("inDeg", F.coalesce("inDeg", F.lit(0)))
        .withColumn("outDeg", F.coalesce("outDeg", F.lit(0)))
    )


def attach(rows: DataFrame, table: DataFrame, key: str, size_col: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one table row per ``key``, without gathering a hot key.

    ``size_col`` is at least the number of rows with that key. Keys with more than
    ``total / (2P)`` rows (at most 2P of them when the sizes sum to ``total``; P = shuffle
    partitions) are joined by broadcast, the others by the plain shuffle join.
    """
    cap = max(1, -(-total // (2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    heavy = F.broadcast(table.filter(F.col(size_col) > cap))
    light = rows.join(F.broadcast(table.filter(F.col(size_col) > cap).select(key)), key, "left_anti")
    return rows.join(heavy, key).unionByName(light.join(table.filter(F.col(size_col) <= cap), key))


def with_out_degree(edges: DataFrame) -> DataFrame:
    """Every edge with ``outDeg`` of its source."""
    return attach(edges, out_degrees(edges).withColumnRenamed("id", "src"), "src", "outDeg", edges.count())


def edge_weights(edges: DataFrame) -> DataFrame:
    """``weight = 1 / outDeg(src)`` on every edge (parallel edges counted)."""
    return with_out_degree(edges).withColumn("weight", F.lit(1.0) / F.col("outDeg")).drop("outDeg")


def neighbors(edges: DataFrame, direction: str = "out") -> DataFrame:
    """``(id, neighbor)``, a row per edge end: ids reached over out-edges, in-edges or
    ``either``. Flat rows, so a hub's neighbours need no common task."""
    out = edges.select(F.col("src").alias("id"), F.col("dst").alias("neighbor"))
    into = edges.select(F.col("dst").alias("id"), F.col("src").alias("neighbor"))
    return {"out": out, "in": into, "either": out.unionByName(into)}[direction]


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct undirected pairs ``(a, b)`` with ``a < b``; self loops dropped."""
    return edges.filter(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()


# ---------------------------------------------------------------- iteration helpers

class _Rounds:
    """Lineage control for driver loops: persist each round's frame, and every
    ``every`` rounds write it to ``spark.checkpoint.dir`` (reliable; keeps its
    partitioning) and drop the older caches. A lost executor then costs at most the
    rounds since the last written state. Loops read the previous state once per
    round, so the plan grows linearly between checkpoints."""

    def __init__(self, every: int, spark: SparkSession):
        self.every = max(1, every)
        self.held: list[DataFrame] = []
        checkpoint_root(spark)  # read spark.checkpoint.dir; set one only if unset

    def due(self, round_no: int) -> bool:
        return round_no % self.every == 0

    def keep(self, df: DataFrame, round_no: int) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.held.append(df)
        if not self.due(round_no):
            return df
        # The checkpoint job counts the frame (filling the cache) and then writes the
        # files from the cache, so the round is computed once.
        saved = df.checkpoint(eager=True)
        self.release()
        return saved

    def finish(self, df: DataFrame) -> DataFrame:
        """Write the result, release every cache, return the written frame."""
        out = df.checkpoint(eager=True)
        self.release()
        return out

    def release(self) -> None:
        for d in self.held:
            d.unpersist()
        self.held.clear()


# ---------------------------------------------------------------- packed adjacency

BLOCK = 4096


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (src, _salt) -> blocks of at most ``BLOCK`` destinations of one source."""
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            src, salt = part.column("src"), part.column("_salt").to_numpy()
            same = pc.equal(src.slice(1), src.slice(0, part.num_rows - 1)).to_numpy(zero_copy_only=False) & (salt[1:] == salt[:-1])
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            ends = pa.array(np.append(first, part.num_rows), pa.int32())
            dsts = pa.ListArray.from_arrays(ends, pa.concat_arrays([part.column("dst")]))
            yield pa.RecordBatch.from_arrays([src.take(pa.array(first)), pa.array(salt[first]), dsts], ["src", "_salt", "dsts"])


class Adjacency:
    """The out-edges of a graph as blocks ``(src, _salt, dsts)``, one cached copy for all rounds
    of a loop.

    A block is a row with up to ``BLOCK`` destinations, so a round joins the state with blocks, not
    with edges, and explodes them behind the join. Blocks are cached sorted and partitioned by ``src``. Sources with
    more than ``cap = |E| / (2P)`` edges (P = shuffle partitions; at most 2P of them, a
    table that is broadcast) are salted: their edges are dealt over ``ceil(d / cap)`` buckets by a hash of the
    destination, blocks are partitioned by ``(src, _salt)``, and the state of such a
    source is repeated per bucket. With ``vertices``, every vertex also has a block that holds
    itself (``_self``), which brings its old value into its own group. ``out_degree`` adds
    the source's number of edges to its blocks.
    """

    def __init__(self, edges: DataFrame, vertices: DataFrame | None = None, out_degree: bool = False):
        spark = edges.sparkSession
        checkpoint_root(spark)
        degrees = _stored(out_degrees(edges).withColumnRenamed("id", "src"), "out-degrees")
        size = degrees.agg(F.sum("outDeg").alias("total"), F.max("outDeg").alias("top")).first()
        cap = max(1, -(-(size["total"] or 0) // (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
        self.heavy = None
        if (size["top"] or 0) > cap:
            self.heavy = _stored(degrees.where(F.col("outDeg") > cap).select("src", F.ceil(F.col("outDeg") / cap).cast("int").alias("_k")), "hubs")
        self.keys = ["src"] if self.heavy is None else ["src", "_salt"]
        self.extra = [c for c in edges.columns if c not in ("src", "dst")]
        end = F.struct("dst", *self.extra) if self.extra else F.col("dst")
        if self.heavy is None:
            e = edges.select("src", F.lit(0).alias("_salt"), end.alias("dst"))
        else:
            salt = F.when(F.col("_k").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("_k"))).cast("int")
            e = edges.join(F.broadcast(self.heavy), "src", "left").select("src", salt.alias("_salt"), end.alias("dst"))
        schema = T.StructType([e.schema["src"], e.schema["_salt"], T.StructField("dsts", T.ArrayType(e.schema["dst"].dataType))])
        blocks = e.repartition(*self.keys).sortWithinPartitions(*self.keys).mapInArrow(_packed, schema)
        if out_degree:
            blocks = blocks.join(degrees, "src")
        if vertices is not None:
            self_end = F.array(F.col("id").cast(edges.schema["dst"].dataType)) if not self.extra else F.array(F.struct(
                F.col("id").alias("dst"), *[F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in self.extra]))
            own = vertices.select(F.col("id").alias("src"), F.lit(0).alias("_salt"), self_end.alias("dsts"), F.lit(True).alias("_self"))
            blocks = blocks.withColumn("_self", F.lit(False)).unionByName(own, allowMissingColumns=True)
        self.blocks = blocks.repartition(*self.keys).sortWithinPartitions(*self.keys).persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks.count()  # only a filled cache tells Spark its partitioning and order

    def sent(self, state: DataFrame) -> DataFrame:
        """A row per edge (and own block) with ``dst`` and the columns of its source's row in
        ``state(src, …)``, which is read once."""
        if self.heavy is not None:
            k = F.coalesce(F.col("_k"), F.lit(1))
            state = state.join(F.broadcast(self.heavy), "src", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), k - 1))).drop("_k")
        joined = self.blocks.join(state, self.keys)
        rows = joined.select(*[c for c in joined.columns if c not in ("dsts", "_salt")], F.explode("dsts").alias("dst"))
        if not self.extra:
            return rows
        return rows.select(*rows.columns[:-1], "dst.dst", *[f"dst.{c}" for c in self.extra])

    def release(self) -> None:
        self.blocks.unpersist()


# ---------------------------------------------------------------- sums at fixed places

# Edges a shard has on average before the graph gets a further one, while these are fewer than the shuffle partitions.
SHARD_EDGES = 50_000
PLAN = {"degrees": np.int64, "edges": np.int32, "runs": np.int32, "slots": np.int32, "targets": np.int32, "bounds": np.int32}
SENT = "to int, sender int, sums binary"


def _bytes(values: np.ndarray, kind: type) -> pa.Array:
    """Numbers as one binary value, which is carried whole and not number by number."""
    return pa.array([np.ascontiguousarray(values, kind).tobytes()], pa.binary())


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of all rows of a binary column, one row after the other."""
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind)


def _lists(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(len(values) > 0, values[1:] != values[:-1]))


def _sending(shards: int):
    """The edges of a shard -> the ids of the sums it sends, a row per shard they go to, and its plan of sending.

    Parallel edges become one. Edges are ordered by destination, so each sum is of one run of them (``runs``).
    ``slots`` are the runs in the order in which they are sent, ``targets`` and ``bounds`` the shards and where
    the slots of each begin."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        src, dst = (pc.dictionary_encode(rows[c].combine_chunks(), null_encoding="encode") for c in ("src", "dst"))
        s, d, to = src.indices.to_numpy(), dst.indices.to_numpy(), rows["to"].to_numpy()
        order = np.lexsort((s, d, to))
        order = order[np.append(True, (s[order][1:] != s[order][:-1]) | (d[order][1:] != d[order][:-1]))]
        degrees = np.bincount(s[order], minlength=len(src.dictionary))
        runs = _runs(d[order])
        first = order[runs]
        copies = np.ones(len(first), np.int64)
        if "copies" in rows.column_names:  # there are hubs
            copies = rows["copies"].to_numpy()[first]
            salted = np.flatnonzero(rows["degree"].is_valid().to_numpy())
            degrees[s[salted]] = rows["degree"].take(pa.array(salted)).to_numpy()
        slots = np.repeat(np.arange(len(first)), copies)
        copy = np.arange(len(slots)) - np.repeat(np.cumsum(copies) - copies, copies)
        target = (to[first[slots]] + copy) % shards
        by = np.argsort(target, kind="stable")
        slots, copy, target = slots[by], copy[by], target[by].astype(np.int32)
        bounds = _runs(target)
        me = np.full(len(bounds), key[0].as_py(), np.int32)
        sums = pa.table({"shard": target[bounds], "sender": me, "copies": _lists(pa.array(copy > 0), bounds),
                         "ids": _lists(dst.dictionary.take(pa.array(d[first[slots]])), bounds)})
        numbers = dict(zip(PLAN, (degrees, s[order], runs, slots, target[bounds], bounds)))
        plan = pa.table({"shard": me[:1], "sources": _lists(src.dictionary, np.array([0])),
                         **{c: _bytes(numbers[c], kind) for c, kind in PLAN.items()}})
        return pa.concat_tables([sums, plan], promote_options="default")

    return run


def _laid_out(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The ids of all sums sent to a shard, and its plan of sending -> its row: vertices (``ids``; ``own``: not as a
    copy), the vertex of every sum (``places``, by sender) and of every source (``back``; -1 gets no sum)."""
    sums = rows.filter(pc.is_valid(rows["sender"])).sort_by("sender")
    ids = pc.dictionary_encode(pc.list_flatten(sums["ids"]).combine_chunks(), null_encoding="encode")
    places = ids.indices.to_numpy()
    own = np.ones(len(ids.dictionary), bool)
    own[places] = ~pc.list_flatten(sums["copies"]).combine_chunks().to_numpy(zero_copy_only=False)
    back = pc.index_in(pc.list_flatten(rows["sources"]).combine_chunks(), value_set=ids.dictionary).fill_null(-1)
    return pa.table({
        "shard": pa.array([key[0].as_py()], pa.int32()), "ids": _lists(ids.dictionary, np.array([0])), "own": _bytes(own, bool),
        "places": _bytes(places, np.int32), "back": _bytes(back.to_numpy(), np.int32),
        **{c: _bytes(_numbers(rows[c], kind), kind) for c, kind in PLAN.items()}})


def _sums(shard: pa.Table, ranks: np.ndarray | None) -> pa.Table:
    """The sums of ``rank / degree`` that a shard sends. A vertex without a rank (NaN) adds nothing, a sum of
    nothing is NaN; without ``ranks`` every source has 1.0."""
    plan = {c: _numbers(shard[c], kind) for c, kind in PLAN.items()}
    back = _numbers(shard["back"], np.int32)
    source = np.ones(len(back)) if ranks is None else np.append(ranks, np.nan)[back]
    sent = []
    if len(plan["edges"]):
        part = (source / plan["degrees"])[plan["edges"]]
        none = np.isnan(part)
        sums = np.add.reduceat(np.where(none, 0.0, part), plan["runs"])
        sums[np.logical_and.reduceat(none, plan["runs"])] = np.nan
        sent = [p.tobytes() for p in np.split(sums[plan["slots"]], plan["bounds"][1:])]
    me = np.repeat(shard["shard"].to_numpy(), len(sent))
    return pa.table({"to": plan["targets"], "sender": me, "sums": pa.array(sent, pa.binary())})


def _ranks(shard: pa.Table, sent: pa.Table, reset: float) -> np.ndarray:
    """The ranks of a shard's vertices from the sums sent to it; NaN where all of these are of nothing."""
    sums, places = _numbers(sent.sort_by("sender")["sums"], np.float64), _numbers(shard["places"], np.int32)
    if len(sums) != len(places):
        raise RuntimeError(f"{len(sums)} sums for {len(places)} places")
    got = np.flatnonzero(~np.isnan(sums))
    ranks = np.full(len(_numbers(shard["own"], bool)), np.nan)
    ranks[places[got]] = 0.0
    return reset + (1.0 - reset) * (ranks + np.bincount(places[got], sums[got], len(ranks)))


class RankShards:
    """The distinct edges in shards, laid out once so that rounds of ranks send numbers without ids.

    A shard has the out-edges of its vertices (hash of the id). In a round it adds up what these bring to each
    destination and sends every shard an array of such sums; whose they are is fixed by the layout, a cached row
    per shard. A round is one shuffle of 8 bytes for each destination of each shard.
    Shards leave out parallel edges. Sources with more than ``cap = |E| / (2 * shards)`` edges, parallel ones counted,
    lose these by an aggregate before and are salted: their ``d`` edges are dealt over ``ceil(d / cap)`` shards, from
    their own on, by a hash of the destination, and each of these shards gets the sums for them.
    """

    def __init__(self, edges: DataFrame, reset: float):
        spark = edges.sparkSession
        checkpoint_root(spark)
        self.reset, self.id = reset, edges.schema["dst"].dataType
        kind = vertices_from_edges(edges).schema["id"].dataType
        e = edges.where("src IS NOT NULL").select(F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst"))
        sizes = out_degrees(e).select(F.col("id").alias("src"), F.col("outDeg").alias("degree"))  # with parallel edges
        size = sizes.agg(F.sum("degree").alias("total"), F.max("degree").alias("top")).first()
        total, parts = size["total"] or 0, int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = max(1, min(parts, -(-total // SHARD_EDGES)), -(-total // TASK_EDGES))
        cap = max(1, -(-total // (2 * shards)))
        place = lambda c, salt=F.lit(0): F.pmod(F.pmod(F.xxhash64(c), F.lit(shards)) + salt, F.lit(shards)).cast("int")
        salt, extra = F.lit(0), []
        if (size["top"] or 0) > cap:
            large = F.broadcast(_stored(sizes.where(F.col("degree") > cap).select("src"), "hubs"))
            theirs = _stored(e.join(large, "src", "left_semi").distinct(), "hub-edges")
            hubs = theirs.groupBy("src").agg(F.count(F.lit(1)).alias("degree")) \
                         .withColumn("k", F.least(F.ceil(F.col("degree") / cap), F.lit(shards)).cast("int"))
            e = e.join(large, "src", "left_anti").unionByName(theirs).join(F.broadcast(hubs), "src", "left") \
                 .join(F.broadcast(hubs.select(F.col("src").alias("dst"), F.col("k").alias("copies"))), "dst", "left")
            salt = F.when(F.col("k").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("k")))
            extra = [F.coalesce("copies", F.lit(1)).alias("copies"), "degree"]
        placed = e.select(place("src", salt).alias("shard"), "src", "dst", place("dst").alias("to"), *extra)
        plan, ids = "".join(f", {c} binary" for c in PLAN), f"array<{kind.simpleString()}>"
        sent = f"shard int, ids {ids}, sender int, copies array<boolean>, sources {ids}{plan}"
        laid = f"shard int, ids {ids}, own binary, places binary, back binary{plan}"
        sending = _stored(placed.groupBy("shard").applyInArrow(_sending(shards), sent), "rank-sends")
        rows = sending.groupBy("shard").applyInArrow(_laid_out, laid)
        self.rows = rows.repartition(parts, "shard").sortWithinPartitions("shard").persist(StorageLevel.MEMORY_AND_DISK)
        self.rows.count()  # only a filled cache tells Spark its partitioning and order

    def _each(self, rows: DataFrame, key: str, fn: Callable[[pa.Table, pa.Table], pa.Table], schema, ids: bool = False) -> DataFrame:
        shards = self.rows if ids else self.rows.drop("ids")
        return rows.groupBy(key).cogroup(shards.groupBy("shard")).applyInArrow(fn, schema)

    def first(self) -> DataFrame:
        """What is sent in the first round, in which every source has rank 1.0."""
        return self.rows.drop("ids").groupBy("shard").applyInArrow(lambda shard: _sums(shard, None), SENT)

    def next(self, sent: DataFrame) -> DataFrame:
        """What is sent in the round after ``sent``."""
        reset = self.reset
        return self._each(sent, "to", lambda got, shard: _sums(shard, _ranks(shard, got, reset)), SENT)

    def state(self, sent: DataFrame) -> DataFrame:
        """The ranks that ``sent`` leads to, an array per shard."""
        reset = self.reset
        return self._each(sent, "to", lambda got, shard: pa.table({
            "shard": shard["shard"], "ranks": _bytes(_ranks(shard, got, reset), np.float64)}), "shard int, ranks binary")

    def after(self, state: DataFrame) -> DataFrame:
        """What is sent in the round after ``state``."""
        return self._each(state, "shard", lambda ranks, shard: _sums(shard, _numbers(ranks["ranks"], np.float64)), SENT)

    def ranks(self, sent: DataFrame) -> DataFrame:
        """``(id, rank)`` that ``sent`` leads to, for the vertices that got something."""
        reset = self.reset

        def run(got: pa.Table, shard: pa.Table) -> pa.Table:
            rank = _ranks(shard, got, reset)
            some = pa.array(np.flatnonzero(_numbers(shard["own"], bool) & ~np.isnan(rank)))
            return pa.table({"id": pc.list_flatten(shard["ids"]).combine_chunks().take(some), "rank": pa.array(rank).take(some)})

        schema = T.StructType([T.StructField("id", self.rows.schema["ids"].dataType.elementType), T.StructField("rank", T.DoubleType())])
        return self._each(sent, "to", run, schema, ids=True).withColumn("id", F.col("id").cast(self.id))

    def release(self) -> None:
        self.rows.unpersist()


# ---------------------------------------------------------------- components

# Rows a task of a contraction round takes on average before the round gets a further task.
ROUND_ROWS = 100_000


def _stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: it survives lost executors, and counting it
    reads file footers only. With ``rows``, the most that it has, it is written by a task per
    ``ROUND_ROWS`` of them, if these are fewer than its partitions: a small table is no file per partition."""
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROUND_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def contraction_rounds(pairs: DataFrame, max_rounds: int | None = None) -> tuple[list[DataFrame], list[int]]:
    """The maps ``(u, to)`` of every round of contraction, and the edges before every round.

    In a round each vertex goes to the one of least priority among itself and its neighbours
    (priorities are a hash of id and round); edges are renamed to where their ends went, and loops
    and repetitions leave. Vertices without an edge are finished and leave with it. A constant share of
    the vertices is expected to vanish in every round whatever the ids or the diameter.
    A round is two written tables: the map, and the edges after it. Both sides of the joins are then
    plain scans, so Spark may broadcast a small map and splits the partition of a hot vertex.
    """
    maps, sizes = [], []
    e = _stored(pairs, "component-edges")
    for i in count(1):
        n = e.count()
        if not n:
            return maps, sizes
        if max_rounds is not None and i > max_rounds:
            raise RuntimeError(f"components did not converge in {max_rounds} rounds")
        sizes.append(n)

        def ranked(c: str, i: int = i) -> Column:
            return F.struct(F.xxhash64(c, F.lit(i)).alias("h"), F.col(c).alias("id"))

        ends = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        near = ends.groupBy("u").agg(F.min(ranked("v")).alias("near"))
        to = _stored(near.select("u", F.least("near", ranked("u"))["id"].alias("to")), "component-map", 2 * n)
        maps.append(to)
        x, y = to.select(F.col("u").alias("a"), F.col("to").alias("x")), to.select(F.col("u").alias("b"), F.col("to").alias("y"))
        moved = e.join(x, "a").join(y, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        e = _stored(moved.distinct(), "component-edges", n)


def connected_components(edges: DataFrame, vertices: DataFrame | None = None, max_rounds: int | None = None) -> DataFrame:
    """``(id, component)``: direction ignored, label = smallest vertex id.

    The graph is contracted until no edge is left (``contraction_rounds``). The maps of the
    rounds form a tree: from the last round back, every vertex takes the root of the one it went
    to. A component's least id then comes from one aggregate; roots of large components meet
    their rows by broadcast (``attach``). A caller's ``max_rounds`` that does not suffice raises.
    """
    checkpoint_root(edges.sparkSession)
    maps, sizes = contraction_rounds(undirected(edges), max_rounds)
    ids = vertices.select("id") if vertices is not None else vertices_from_edges(edges)
    if not maps:
        return ids.select("id", F.col("id").alias("component"))
    roots = None
    for to in reversed(maps):
        if roots is None:
            roots = to.select("u", F.col("to").alias("root"))
        else:
            up = roots.select(F.col("u").alias("to"), "root")
            roots = to.join(up, "to", "left").select("u", F.coalesce("root", "to").alias("root"))
    roots = _stored(roots, "component-roots", 2 * sizes[0])
    n = roots.count()
    least = _stored(roots.groupBy("root").agg(F.min("u").alias("component"), F.count(F.lit(1)).alias("_n")), "component-least", n)
    labels = attach(roots, least, "root", "_n", n).select(F.col("u").alias("id"), "component")
    return _stored(ids.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component")), "components")


# ---------------------------------------------------------------- triangles

# Edges one triangle task holds on average at most (8 bytes each as a key and 8 as two ends before, or 16 bits and more).
TASK_EDGES = 8_000_000
# Tasks per core that are enough, however many partitions a shuffle of rows needs.
CORE_TASKS = 4
# Edges packed at a time; a block has those among them whose ends have the same two colours.
BLOCK_EDGES = 1_000_000
# Edges or pairs of edges looked up at a time, and ids of blocks sorted at a time.
PAIRS = 250_000
IDS = 2_000_000
EDGE_BLOCK = "ca long, cb long, na int, nb int, n int, a binary, b binary, runs binary, spots binary"


def _colours(edges: int, parts: int, task_edges: int) -> int:
    """The least number of colours for which a task has at most ``task_edges`` edges on average and there
    are about as many tasks as partitions."""
    return max(1, math.ceil(math.sqrt(6 * edges / task_edges)), round((6 * parts) ** (1 / 3)) - 1)


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, compressed: their lowest bytes one after the other, then the next ones."""
    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)
    raw = planes[:, : max(1, -(-int(numbers.max()).bit_length() // 8))].T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _loosened(data: pa.Buffer, n: int, kind: type) -> np.ndarray:
    raw = pa.decompress(data.slice(8), int.from_bytes(memoryview(data)[:8], "little"), "zstd", asbytes=True)
    low, *higher = np.frombuffer(raw, np.uint8).reshape(-1, n)
    numbers = low.astype(kind)
    for i, plane in enumerate(higher, 1):
        numbers |= plane.astype(kind) << kind(8 * i)
    return numbers


def _squeezed_ids(ids: np.ndarray, kind: pa.DataType) -> bytes:
    """Sorted ids: whole numbers by their steps, others as an Arrow stream."""
    if pa.types.is_integer(kind):
        return _squeezed(np.diff(ids.astype(np.int64).view(np.uint64), prepend=np.uint64(0)))
    batch = pa.RecordBatch.from_arrays([pa.array(ids.tolist(), kind)], ["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _loosened_ids(data: pa.Buffer, n: int, kind: pa.DataType) -> np.ndarray:
    if pa.types.is_integer(kind):
        return np.cumsum(_loosened(data, n, np.uint64), dtype=np.uint64).view(np.int64)
    return pa.ipc.open_stream(data).read_all().column("id").to_numpy()


def _edge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``a, b`` with the colours of their ends -> blocks of edges of two colours: the ids of either end,
    how many edges each ``a`` has (``runs``), and which of the ids ``b`` they go to (``spots``)."""
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        a, b, ca, cb = (table.column(c).to_numpy() for c in ("a", "b", "ca", "cb"))
        kind, table = table.schema.field("a").type, None
        held.clear()
        order = np.lexsort((cb, ca))
        rows = []
        for part in np.split(order, np.flatnonzero((np.diff(ca[order]) != 0) | (np.diff(cb[order]) != 0)) + 1):
            x, at_x = np.unique(a[part], return_inverse=True)
            y, at_y = np.unique(b[part], return_inverse=True)
            key = np.sort(at_x * len(y) + at_y)
            rows.append((ca[part[0]], cb[part[0]], len(x), len(y), len(part), _squeezed_ids(x, kind), _squeezed_ids(y, kind),
                         _squeezed(np.bincount(key // len(y))), _squeezed(key % len(y))))
        kinds = [pa.int64()] * 2 + [pa.int32()] * 3 + [pa.binary()] * 4
        names = [c.split()[0] for c in EDGE_BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK_EDGES:
            yield packed(held)
            size = 0
    if size:
        yield packed(held)


def _ends(table: pa.Table, kind: pa.DataType) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ids and colours of a task's vertices, and which of them are the ends of its edges (rows or blocks)."""
    if "spots" not in table.column_names:
        a, b = (table.column(c).to_numpy() for c in ("a", "b"))
        ids = np.unique(np.concatenate((a, b)))
        colour = np.empty(len(ids), np.int32)
        x, y = (np.searchsorted(ids, v).astype(np.int32) for v in (a, b))
        for v, c in ((x, "ca"), (y, "cb")):
            colour[v] = table.column(c).to_numpy()
        return ids, colour, x, y
    plain = ("ca", "cb", "na", "nb", "n")
    blocks = [dict(zip(plain, row)) for row in zip(*(table.column(c).to_pylist() for c in plain))]
    for c in ("a", "b", "runs", "spots"):
        for r, data in zip(blocks, table.column(c)):
            r[c] = data.as_buffer()
    ids, new, size = [], [], 0
    for i, r in enumerate(blocks, 1):
        new += [_loosened_ids(r[c], r["n" + c], kind) for c in "ab"]
        size += r["na"] + r["nb"]
        if size > IDS or i == len(blocks):
            ids = np.concatenate((*new, ids) if len(ids) else new)
            ids.sort()
            ids = ids[np.concatenate(([True], ids[1:] != ids[:-1]))]
            new, size = [], 0
    colour = np.empty(len(ids), np.int32)
    x, y = np.empty((2, sum(r["n"] for r in blocks)), np.int32)
    at = 0
    for r in blocks:
        to_a, to_b = (np.searchsorted(ids, _loosened_ids(r[c], r["n" + c], kind)).astype(np.int32) for c in "ab")
        colour[to_a], colour[to_b] = r["ca"], r["cb"]
        x[at : at + r["n"]] = np.repeat(to_a, _loosened(r["runs"], r["na"], np.int32))
        y[at : at + r["n"]] = to_b[_loosened(r["spots"], r["n"], np.int32)]
        at += r["n"]
    return ids, colour, x, y


def _closed(colours: int, kind: pa.DataType | None = None):
    """Triangles of one task: ``a, b`` are its edges (or blocks of edges between ids of ``kind``), ``task`` the
    sorted colours of its triangles."""
    def run(table: pa.Table) -> pa.Table:
        own = np.sort(_split_task(int(table.column("task")[0].as_py()), colours))
        id_kind = kind or table.schema.field("a").type
        ids, colour, x, y = _ends(table, id_kind)
        del table
        n = len(ids)
        name = np.argsort(np.bincount(x, minlength=n) + np.bincount(y, minlength=n), kind="stable").astype(np.int32)
        rank = np.empty(n, np.int32)
        rank[name] = np.arange(n, dtype=np.int32)
        # Edges point to the end of higher degree, so no vertex has more than sqrt(2 edges) of them.
        bits = np.int64(n.bit_length())
        low = np.int64((1 << bits) - 1)
        key = np.empty(len(x), np.int64)
        for at in range(0, len(key), PAIRS):
            one, two = (rank[v[at : at + PAIRS]].astype(np.int64) for v in (x, y))
            key[at : at + PAIRS] = (np.minimum(one, two) << bits) | np.maximum(one, two)
        del x, y, rank
        key.sort()
        last = np.searchsorted(key, np.arange(1, n + 1) << bits)  # behind the last edge of each vertex
        # A bit per hash of an edge rules out most pairs that no edge closes; those left are looked up.
        shift = np.uint64(64 - max(10, (16 * len(key)).bit_length()))
        marks = np.zeros(1 << (61 - int(shift)), np.uint8)
        place = lambda k: (k.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift
        for at in range(0, len(key), PAIRS):
            to = place(key[at : at + PAIRS])
            np.bitwise_or.at(marks, to >> np.uint64(3), np.uint8(1) << (to & np.uint64(7)).astype(np.uint8))
        found = np.zeros(n, np.int64)
        at = 0
        while at < len(key):  # pairs of an edge with the later ones of its vertex, so many at a time
            w = last[key[at : at + PAIRS] >> bits] - np.arange(at, min(at + PAIRS, len(key))) - 1
            w = w[: max(1, int(np.searchsorted(np.cumsum(w), PAIRS, "right")))]
            end = at + len(w)
            first = np.repeat(np.arange(at, end), w)
            second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(w) - w, w)
            closing = ((key[first] & low) << bits) | (key[second] & low)
            to = place(closing)
            maybe = np.flatnonzero((marks[to >> np.uint64(3)] >> (to & np.uint64(7)).astype(np.uint8)) & 1)
            closing = closing[maybe]
            spot = np.minimum(np.searchsorted(key, closing), len(key) - 1)
            ok = maybe[key[spot] == closing]
            one, two = key[first[ok]], key[second[ok]]
            three = name[np.stack((one >> bits, one & low, two & low))]
            mine = (np.sort(colour[three], axis=0) == own[:, None]).all(axis=0)
            np.add.at(found, three[:, mine].ravel(), 1)
            at = end
        some = found > 0
        return pa.table({"id": pa.array(ids[some].tolist(), id_kind), "t": pa.array(found[some])})

    return run


def _split_task(task: int, colours: int) -> np.ndarray:
    return np.array([task // colours // colours, task // colours % colours, task % colours])


def _colour(end: str, colours: int) -> Column:
    return F.pmod(F.xxhash64(end), F.lit(colours)).cast("long")


def _coloured(pairs: DataFrame, colours: int) -> DataFrame:
    """Every edge with the colours of its ends."""
    return pairs.select("a", "b", _colour("a", colours).alias("ca"), _colour("b", colours).alias("cb"))


def triangle_tasks(pairs: DataFrame, colours: int) -> DataFrame:
    """Every edge, or block of edges of two colours, (with the colours of its ends) once per task that may close
    a triangle with it: a task is a sorted triple of colours, so an edge goes to ``colours`` of them."""
    c = F.lit(colours)
    third = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(colours - 1).cast("long")))
    e = pairs if "ca" in pairs.columns else _coloured(pairs, colours)
    triple = F.array_sort(F.array("ca", "cb", "cc"))
    return e.select("*", third.alias("cc")).select(*e.columns, ((triple[0] * c + triple[1]) * c + triple[2]).alias("task"))


def triangle_counts(edges: DataFrame, vertices: DataFrame | None = None, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(id, triangles)`` on the undirected simple graph (every vertex, 0 if none).

    Vertices get one of c colours by hash; every sorted triple of colours is a task that sees
    all edges between its colours and counts the triangles with exactly these colours. An
    edge is shipped c times, c being about ``sqrt(6 |E| / task_edges)``, so a task's input is bounded
    and a hub's edges are spread by the colours of its neighbours. Edges are shipped in packed blocks of two
    colours, some bytes an edge instead of a row. Inside a task, edges point
    to the end of higher degree, which bounds the pairs that are looked up.
    """
    ends = F.xxhash64(F.least("src", "dst"), F.greatest("src", "dst"))
    about = edges.where(F.col("src") != F.col("dst")).agg(F.approx_count_distinct(ends)).first()[0]
    spark = edges.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), CORE_TASKS * spark.sparkContext.defaultParallelism)
    colours = _colours(about, parts, task_edges)
    pairs = undirected(edges)
    id_type = pairs.schema["a"].dataType
    share = F.pmod(F.xxhash64("a", "b"), F.lit(-(-parts // colours**2)))
    dealt = pairs.repartition(_colour("a", colours), _colour("b", colours), share)
    blocks = _coloured(dealt, colours).mapInArrow(_edge_blocks, EDGE_BLOCK)
    closed = _closed(colours, to_arrow_type(id_type))
    found = triangle_tasks(blocks, colours).groupBy("task").applyInArrow(closed, f"id {id_type.simpleString()}, t long")
    per_vertex = found.groupBy("id").agg(F.sum("t").alias("triangles"))
    ids = vertices.select("id") if vertices is not None else vertices_from_edges(edges)
    return ids.join(per_vertex, "id", "left").select("id", F.coalesce("triangles", F.lit(0)).cast("bigint").alias("triangles"))


# ---------------------------------------------------------------- message passing

def message_passing(vertices: DataFrame, edges: DataFrame, init_msg,
                    send: Callable[[], Column],
                    combine: Callable[[Column], Column],
                    update: Callable[[Column, Column], Column],
                    max_rounds: int | None, active: str = "out",
                    accept: Callable[[Column, Column], Column] | None = None,
                    checkpoint_every: int = 5) -> DataFrame:
    """Pregel over DataFrames.

    ``vertices(id, value)``, ``edges(src, dst, …)``. ``update(value, msg)`` is first
    applied with ``init_msg`` to every vertex. Each round, edges whose source is
    active (``active='out'``: received a message in the previous round, every vertex
    in the first; ``'all'``: always) carry ``send()``, a Column over ``src_value``
    and the edge columns; null means no message. What is the same for all edges of a source is
    smaller in its value. Messages are combined per
    destination with the aggregate ``combine`` and applied with ``update``; a vertex
    counts as having received one when ``accept(value, msg)`` holds (default: any
    message). Vertices without a message keep their value. Stops after
    ``max_rounds`` rounds (an operator's own meaning, e.g. 20 rounds of PageRank), or once
    no vertex receives a message; with ``None`` only then.

    Each round is one join with the edge blocks and one aggregation: every vertex has a block of its own, so the
    group of a destination holds its own old value next to its incoming messages and
    the state is read once. ``combine`` is a partial aggregate, so a hub's messages
    are pre-combined in every task before the shuffle.
    """
    rounds = _Rounds(checkpoint_every, edges.sparkSession)
    adjacency = Adjacency(edges, vertices)
    state = vertices.select("id", update(F.col("value"), F.lit(init_msg)).alias("value"),
                            F.lit(True).alias("_active"))
    state = rounds.keep(state, 0)
    for i in count(1) if max_rounds is None else range(1, max_rounds + 1):
        senders = state.select(F.col("id").alias("src"), F.col("value").alias("src_value"),
                               F.col("_active").alias("src_active"))
        t = adjacency.sent(senders)
        sending = ~F.col("_self") & (F.col("src_active") if active == "out" else F.lit(True))
        g = t.groupBy(F.col("dst").alias("id")).agg(
            F.first(F.when(F.col("_self"), F.col("src_value")), ignorenulls=True).alias("_old"),
            combine(F.when(sending, send())).alias("_msg"),
            F.max(F.col("_self")).alias("_vertex"),
        ).filter("_vertex")  # messages to ids outside ``vertices`` are dropped
        got = F.col("_msg").isNotNull()
        if accept is not None:
            got = got & F.coalesce(accept(F.col("_old"), F.col("_msg")), F.lit(False))
        state = g.select("id", F.when(got, update(F.col("_old"), F.col("_msg"))).otherwise(F.col("_old")).alias("value"),
                         got.alias("_active"))
        state = rounds.keep(state, i)
        if rounds.due(i) and not state.filter("_active").take(1):
            break
    out = rounds.finish(state.select("id", "value"))
    adjacency.release()
    return out


# ---------------------------------------------------------------- PageRank (three forms)

def pagerank_pregel(edges: DataFrame, rounds: int = 20, reset: float = RESET, checkpoint_every: int = 5) -> DataFrame:
    """Message-passing PageRank: every vertex starts at ``reset`` (initial message 0),
    messages ``rank * 1/outDeg`` flow along out-edges of vertices that received one
    in the previous round; a vertex without a message keeps its value. A vertex carries
    its weight next to its rank."""
    e = edges.select("src", "dst")
    weight = (F.lit(1.0) / F.col("outDeg")).alias("weight")
    verts = vertices_from_edges(e).join(out_degrees(e), "id", "left").select("id", F.struct(F.lit(1.0).alias("rank"), weight).alias("value"))

    def update(value: Column, msg: Column) -> Column:
        return F.struct((F.lit(reset) + F.lit(1.0 - reset) * msg).alias("rank"), value["weight"].alias("weight"))

    ranks = message_passing(
        _stored(verts, "rank-vertices"), e, 0.0,
        send=lambda: F.col("src_value.rank") * F.col("src_value.weight"),
        combine=F.sum, update=update, max_rounds=rounds, active="out", checkpoint_every=checkpoint_every,
    )
    return ranks.select("id", F.col("value.rank").alias("rank"))


def pagerank_join(edges: DataFrame, rounds: int = 20, reset: float = RESET, checkpoint_every: int = 5) -> DataFrame:
    """PageRank by joins: distinct edges; start 1.0 for vertices with out-edges; each
    round only vertices that receive a contribution keep a rank (no join back). A round joins the sums that
    shards sent each other with the shards' edges (``RankShards``); ranks are written every few rounds."""
    if rounds < 1:
        return edges.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    keeper = _Rounds(checkpoint_every, edges.sparkSession)
    shards = RankShards(edges, reset)
    sent = shards.first()
    for i in range(1, rounds):
        sent = shards.after(keeper.keep(shards.state(sent), i)) if keeper.due(i) else shards.next(sent)
    ranks = _stored(shards.ranks(sent), "ranks")
    keeper.release()
    shards.release()
    return ranks


def pagerank_contributions(ranks: DataFrame, adj: DataFrame) -> DataFrame:
    """Each rank split evenly over the out-neighbours: ``(src, dst, contrib)``.
    ``adj`` carries ``outDeg`` of the source."""
    sized = ranks.withColumnRenamed("id", "src").join(adj.groupBy("src").agg(F.count(F.lit(1)).alias("_n")), "src")
    return attach(adj, sized, "src", "_n", adj.count()) \
              .select("src", "dst", (F.col("rank") / F.col("outDeg")).alias("contrib"))


def pagerank_converged(edges: DataFrame, tol: float = 1e-4, reset: float = RESET, max_rounds: int | None = None,
                       checkpoint_every: int = 5) -> DataFrame:
    """Synchronous PageRank from 1.0 until ``max |new - old| <= tol``:
    ``r = reset + (1 - reset) * Σ r_src / outDeg_src`` over in-edges. Own blocks
    bring each vertex's old rank into its own group (one join, one shuffle a round).
    Raises where a caller's ``max_rounds`` does not suffice."""
    e = edges.select("src", "dst")
    verts = _stored(vertices_from_edges(e), "rank-vertices")
    keeper = _Rounds(checkpoint_every, edges.sparkSession)
    adjacency = Adjacency(e, verts, out_degree=True)
    ranks = keeper.keep(verts.withColumn("rank", F.lit(1.0)), 0)
    for i in count(1):
        t = adjacency.sent(ranks.withColumnRenamed("id", "src"))
        new = t.groupBy(F.col("dst").alias("id")).agg(
            (F.lit(reset) + F.lit(1.0 - reset) *
             F.coalesce(F.sum(F.when(~F.col("_self"), F.col("rank") / F.col("outDeg"))), F.lit(0.0))).alias("rank"),
            F.max(F.when(F.col("_self"), F.col("rank"))).alias("_old"),
        )
        new = keeper.keep(new, i)
        delta = new.agg(F.max(F.abs(F.col("rank") - F.col("_old")))).first()[0]
        ranks = new.select("id", "rank")
        if delta is None or delta <= tol:
            break
        if i == max_rounds:
            raise RuntimeError(f"ranks still moved by {delta} after {max_rounds} rounds")
    ranks = keeper.finish(ranks)
    adjacency.release()
    return ranks


def pagerank_residual(edges: DataFrame, bound: float = 1e-6, reset: float = RESET, blocks: int | None = None,
                      checkpoint_every: int = 4) -> tuple[DataFrame, list[int]]:
    """PageRank by residual propagation: ``(id, rank)`` and the edges that each round read.

    Every vertex has a rank (0 at first) and a residual (``reset``). A round moves the residual of
    all vertices above ``bound`` to their ranks and sends ``(1 - reset) / outDeg`` of it
    along their out-edges; the others keep theirs and send nothing, so rounds read fewer and
    fewer edges. It ends when no residual is above the bound; what is left unsent changes a rank by at most
    about ``bound / reset`` times its share of the paths into it. The packed edges are
    a table with a folder per block of sources (``hash(src) mod blocks``); a round reads only the folders
    that hold a sender. A folder is one file, and one more per salt of its hubs: tasks that each wrote into
    all folders would leave the square of the partitions. Both ends get one type first, because equal ids of two types hash apart.
    """
    spark = edges.sparkSession
    ids = vertices_from_edges(edges)
    kind = ids.schema["id"].dataType
    e = edges.select(F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst"))
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    keeper = _Rounds(checkpoint_every, spark)
    adjacency = Adjacency(e)
    path = scratch_path(spark, "residual-blocks")
    adjacency.blocks.select("src", "dsts", "_salt", block("src").alias("block")).repartition("block", "_salt").drop("_salt") \
        .write.partitionBy("block").parquet(path)
    packed = spark.read.schema(adjacency.blocks.select("src", "dsts").schema.add("block", T.IntegerType())).parquet(path)
    adjacency.release()
    above = F.col("residual") > bound
    state = keeper.keep(ids.join(out_degrees(e), "id", "left").select(
        "id", "outDeg", F.lit(0.0).alias("rank"), F.lit(reset).alias("residual"), F.lit(0).cast("long").alias("_e")), 0)
    read: list[int] = []
    for i in count(1):
        # One row: the blocks with a sender (at most ``blocks`` numbers), whether any residual is above, the edges read.
        now = state.agg(F.collect_set(F.when(above & F.col("outDeg").isNotNull(), block("id"))).alias("wanted"),
                        F.count(F.when(above, 1)).alias("above"), F.sum("_e").alias("read")).first()
        read.append(now["read"] or 0)
        if not now["above"]:
            break
        some = packed.where(F.col("block").isin(now["wanted"])) if now["wanted"] else packed.where(F.lit(False))
        senders = state.where(above & F.col("outDeg").isNotNull()).select(
            F.col("id").alias("src"), (F.col("residual") * (1 - reset) / F.col("outDeg")).alias("part"))
        got = (some.join(senders, "src").select(F.explode("dsts").alias("id"), "part").groupBy("id")
               .agg(F.sum("part").alias("got"), F.count(F.lit(1)).alias("_e")))
        state = keeper.keep(state.drop("_e").join(got, "id", "left").select(
            "id", "outDeg", (F.col("rank") + F.when(above, F.col("residual")).otherwise(0.0)).alias("rank"),
            (F.when(above, 0.0).otherwise(F.col("residual")) + F.coalesce("got", F.lit(0.0))).alias("residual"),
            F.coalesce("_e", F.lit(0)).alias("_e")), i)
    return keeper.finish(state.select("id", (F.col("rank") + F.col("residual")).alias("rank"))), read[1:]


def bfs_levels(edges: DataFrame, source_id) -> DataFrame:
    """Hop distance from ``source_id`` along directed edges, by message passing with
    ``min`` as the combiner; a vertex is active when its level improved. Unreachable
    vertices are absent."""
    e = edges.select("src", "dst")
    verts = vertices_from_edges(e).withColumn(
        "value", F.when(F.col("id") == F.lit(source_id), F.lit(0)).otherwise(F.lit(None).cast("int")))
    levels = message_passing(
        verts, e, None,
        send=lambda: F.when(F.col("src_value").isNotNull(), F.col("src_value") + 1),
        combine=F.min,
        update=lambda v, m: F.when(m.isNull(), v).otherwise(F.least(v, m)),
        accept=lambda v, m: v.isNull() | (m < v),
        max_rounds=None, active="out",
    )
    return levels.filter(F.col("value").isNotNull()).select("id", F.col("value").alias("level"))
