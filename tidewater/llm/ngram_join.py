"""Operator 2: n-gram Jaccard self-join by MinHash banding.

Texts become sets of hashed word 5-grams (a text of one to four words is one gram).
Rows with equal sets are one node. Every node gets ``BANDS`` bands of ``ROWS`` MinHash
values; two sets of similarity s share a band with probability ``1 - (1 - s^5)^28``
(0.99998 at s = 0.8). Band hashes are shuffled, buckets of one node and buckets with the
same members as an earlier band's are dropped, and the full sets of the other members go
to their buckets, where all pairs are compared exactly.

A pair that meets in several buckets counts in the first one. Nodes of buckets with more
than ``CAP`` members or ``BLOCK_GRAMS`` grams are first joined into clusters (components over shared large
buckets); a cluster's pairs are compared once, in pairs of blocks of bounded bytes, instead
of once per band, and each task multiplies 0/1 matrices of its two blocks. Tasks give, per
node, the number of linked rows and one edge to the smallest node it is linked with
inside the task, never the pairs; classes are the components over those edges.

Result: one row per input row with ``class_id`` (the smallest id of its class),
``n_links`` (rows with similarity of at least ``threshold``, found by banding; equal sets
always) and ``kept`` (exactly one row of every class).

Defined cases: words are what is left between white space after lower-casing; null or
blank text has no grams, links to nothing and is its own class; equal rows are links of
each other; rows may share an id; null ids sort last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import numbered, read_table, sorted_groups, written
from tidewater.operators.graph import connected_components

N, THRESHOLD = 5, 0.8
BANDS, ROWS = 28, 5
CAP = 256
BLOCK_NODES, BLOCK_GRAMS = 2048, 2_000_000
CACHED_WORDS = 150_000
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """``word -> 64-bit hash``, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


class Grams:
    def __init__(self, n: int = N, bands: int = BANDS, rows: int = ROWS):
        rng = np.random.Generator(np.random.PCG64(2))
        draw = lambda k: rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.n, self.bands, self.rows, self.words = n, bands, rows, WordHashes()
        self.place, self.a, self.b = draw(n), draw(bands * rows)[:, None], draw(bands * rows)[:, None]
        self.band_mix = draw(rows)

    def of(self, text: str | None) -> np.ndarray:
        """The sorted distinct gram hashes of a text."""
        words = (text or "").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        k = min(self.n, len(h))
        s = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            s += h[i:len(h) - k + 1 + i] * self.place[i]
        return np.unique(mixed(s))

    @staticmethod
    def key(grams: np.ndarray) -> tuple[int, int]:
        """Two 64-bit hashes of a whole set."""
        digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
        return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(self.bands * self.rows, np.iinfo(np.uint64).max)
        for at in range(0, len(grams), 2048):
            low = np.minimum(low, (self.a * grams[at:at + 2048] + self.b).min(axis=1))
        return mixed((mixed(low).reshape(self.bands, self.rows) * self.band_mix).sum(axis=1)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = Grams()
    for b in batches:
        cols: list[list] = [[], [], [], []]
        for text in b.column(1).to_pylist():
            g = grams.of(text)
            for c, v in zip(cols, (*grams.key(g), len(g), grams.band_hashes(g) if len(g) else None)):
                c.append(v)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.int64()))],
            ["doc_id", "rid", "k1", "k2", "n", "bands"])


def _ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node rows with their text -> a row with the full set for every task that needs it."""
    grams = Grams()
    for b in batches:
        d = b.to_pydict()
        keys: list[tuple] = []
        node, own, cluster, copies, bands, sets = [], [], [], [], [], []
        size = 0
        for i, text in enumerate(d["text"]):
            g = grams.of(text)
            tasks = [(x["band"], x["h"], 0, 0) for x in d["small"][i] or []]
            block = -1
            if (blocks := d["blocks"][i]) is not None:
                block = int(mixed(np.array([d["node"][i]], np.uint64))[0] % np.uint64(blocks))
                tasks += [(-1, d["cluster"][i], min(block, o), max(block, o)) for o in range(blocks)]
            raw, signature = g.tobytes(), np.array(d["bands"][i], np.int64).tobytes()
            for t in tasks:
                keys.append(t)
                node.append(d["node"][i])
                own.append(block if t[0] < 0 else 0)
                cluster.append(d["cluster"][i])
                copies.append(d["copies"][i])
                bands.append(signature)
                sets.append(raw)
                size += len(raw) + len(signature)
                if size > 16_000_000:
                    yield _shipped(keys, node, own, cluster, copies, bands, sets)
                    keys, node, own, cluster, copies, bands, sets, size = [], [], [], [], [], [], [], 0
        if keys:
            yield _shipped(keys, node, own, cluster, copies, bands, sets)


def _shipped(keys, node, own, cluster, copies, bands, sets) -> pa.RecordBatch:
    ints = [pa.array([k[i] for k in keys], pa.int64()) for i in range(4)]
    return pa.RecordBatch.from_arrays(
        [*ints, *[pa.array(x, pa.int64()) for x in (node, own, cluster, copies)],
         pa.array(bands, pa.binary()), pa.array(sets, pa.binary())],
        ["band", "h", "p", "q", "node", "own", "cluster", "copies", "bands", "grams"])


SHIPPED = "band long, h long, p long, q long, node long, own long, cluster long, copies long, bands binary, grams binary"


def shared_counts(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections of two lists of sets (of a list with itself), by products
    of 0/1 matrices over the grams that more than one set has, some columns at a time."""
    sets = left + (right or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    many = np.diff(np.append(starts, len(every)))
    wide = np.repeat(many > 1, many)
    column = np.repeat(np.cumsum(many > 1) - 1, many)[wide]
    owner = owner[wide]
    total = np.zeros((len(left), len(right) if right else len(left)), np.float64)
    step = 1024
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        has = np.zeros((len(sets), step), np.float32)
        has[owner[a:b], column[a:b] - k * step] = 1
        total += has[:len(left)] @ (has[len(left):] if right else has).T
    return total


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with similarity of at least ``threshold`` (i < j within one list)."""
    if right is None and len(left) == 2:
        both = len(np.intersect1d(left[0], left[1], assume_unique=True))
        ok = both >= threshold * (len(left[0]) + len(left[1]) - both) - 1e-9
        return (np.array([0]), np.array([1])) if ok else (np.empty(0, int), np.empty(0, int))
    both = shared_counts(left, right)
    n = np.array([len(s) for s in left])
    m = n if right is None else np.array([len(s) for s in right])
    ok = both >= threshold * (n[:, None] + m - both) - 1e-9
    return np.nonzero(np.triu(ok, 1) if right is None else ok)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from every index over the pairs."""
    root = np.arange(n)
    while True:
        low = root.copy()
        m = np.minimum(root[i], root[j])
        np.minimum.at(low, i, m)
        np.minimum.at(low, j, m)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _verifier(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, links, root = [], [], []
        for (band, _, p, q), t in sorted_groups(batches, 4):
            t = t.sort_by("node")
            ids = t.column("node").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
            copies = t.column("copies").to_numpy()
            if p == q:
                i, j = linked(sets, None, threshold)
            else:
                own = t.column("own").to_numpy()
                at, to = np.flatnonzero(own == p), np.flatnonzero(own == q)
                if not len(at) or not len(to):
                    continue
                i, j = linked([sets[k] for k in at], [sets[k] for k in to], threshold)
                i, j = at[i], to[j]
            if band >= 0 and len(i):
                cluster = t.column("cluster").fill_null(-1).to_numpy()
                sig = np.stack([np.frombuffer(x, np.int64) for x in t.column("bands").to_pylist()])
                met = ((cluster[i] >= 0) & (cluster[i] == cluster[j])) | (sig[i, :band] == sig[j, :band]).any(axis=1)
                i, j = i[~met], j[~met]
            if not len(i):
                continue
            n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
            up = roots(len(ids), i, j)
            some = np.flatnonzero(n)
            node += ids[some].tolist()
            links += n[some].astype(np.int64).tolist()
            root += ids[up[some]].tolist()
            if len(node) >= 10_000:
                yield _found(node, links, root)
                node, links, root = [], [], []
        if node:
            yield _found(node, links, root)

    return verify


def _found(node, links, root) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, links, root)], ["node", "links", "root"])


def is_large(cap: int, block_grams: int) -> Column:
    """Whether a bucket of ``c`` members with ``grams`` grams goes to blocks."""
    return (F.col("c") > cap) | (F.col("grams") > block_grams)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               cap: int = CAP, block_nodes: int = BLOCK_NODES, block_grams: int = BLOCK_GRAMS,
               row_col: str | None = None) -> DataFrame:
    """``id_col, class_id, n_links, kept`` of every row; see the module text. ``row_col`` names
    a number that only one row has (see ``numbered``) and comes with the result; without it
    the texts are numbered here."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        *([F.col(row_col).alias("rid")] if row_col else []))
    if row_col is None:
        texts = numbered(texts, "rid")
    sig = written(texts.mapInArrow(_signatures, "doc_id long, rid long, k1 long, k2 long, n long, bands array<long>"),
                  "join-signatures")
    key = ["k1", "k2", "n"]
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    sets = written(sig.where("n > 0").groupBy(*key).agg(F.min("rid").alias("node"), F.count("*").alias("copies"),
                                                        F.min(lead).alias("lead")), "join-sets")

    # Buckets of at least two nodes, one of every kind of membership.
    nodes = sets.join(sig.select("rid", "bands"), F.col("node") == F.col("rid")).drop("rid")
    nodes = written(nodes, "join-nodes")
    banded = nodes.select("node", "n", F.posexplode("bands").alias("band", "h"))
    buckets = (banded.groupBy("band", "h").agg(
        F.count("*").alias("c"), F.sum("n").alias("grams"), F.min("node").alias("pivot"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x1"),
        F.bit_xor(F.xxhash64("node", F.lit(2))).alias("x2")).where("c > 1")
        .groupBy("c", "grams", "pivot", "x1", "x2").agg(F.min(F.struct("band", "h")).alias("b"))
        .select("b.band", "b.h", "c", "grams", "pivot"))
    members = written(banded.drop("n").join(written(buckets, "join-buckets"), ["band", "h"]), "join-members")

    # Clusters of the nodes of large buckets, in blocks of bounded size.
    stars = members.where(is_large(cap, block_grams)).select(F.col("node").alias("src"), F.col("pivot").alias("dst")).distinct()
    clusters = written(connected_components(stars).select(F.col("id").alias("node"), F.col("component").alias("cluster")),
                       "join-clusters")
    sized = (clusters.join(nodes.select("node", "n"), "node").groupBy("cluster")
             .agg(F.greatest(F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n") / block_grams)).cast("long").alias("blocks")))
    clusters = clusters.join(written(sized, "join-cluster-sizes"), "cluster")

    small = (members.where(~is_large(cap, block_grams)).groupBy("node")
             .agg(F.collect_list(F.struct(F.col("band").cast("long").alias("band"), "h")).alias("small")))
    wanted = (nodes.join(small.join(clusters, "node", "full"), "node")
              .select("node", "copies", "bands", "small", "cluster", "blocks"))
    shipped = (texts.join(wanted, F.col("rid") == F.col("node"))
               .select("text", "node", "copies", "bands", "small", "cluster", "blocks")
               .mapInArrow(_ship, SHIPPED))
    task = ["band", "h", "p", "q"]
    found = written(shipped.repartition(*task).sortWithinPartitions(*task)
                    .mapInArrow(_verifier(threshold), "node long, links long, root long"), "join-links")

    # Classes: components over the links, named by the smallest id.
    comps = connected_components(found.where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classed = written(sets.join(links, "node", "left").join(comps.withColumnRenamed("id", "node"), "node", "left")
                      .withColumn("component", F.coalesce("component", "node")), "join-classes")
    names = written(classed.groupBy("component").agg(F.min("lead").alias("first")), "join-names")
    named = written(classed.join(names, "component").select(
        *[F.col(k).alias(f"c_{k}") for k in key], F.col("first.doc_id").alias("class_id"), F.col("first.rid").alias("keep"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "join-named")
    same = (F.col("k1") == F.col("c_k1")) & (F.col("k2") == F.col("c_k2")) & (F.col("n") == F.col("c_n"))
    return sig.drop("bands").join(named, same, "left").select(
        *([F.col("rid").alias(row_col)] if row_col else []), F.col("doc_id").alias(id_col), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.col("keep") == F.col("rid"), F.lit(True)).alias("kept"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op2_ngram_join": op2_ngram_join}
ORACLE: dict[str, str] = {}
