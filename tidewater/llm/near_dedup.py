"""Operator 11: near-duplicate classes by b-bit MinHash.

Texts become sets of hashed 5-word shingles (one to four words are one shingle); rows with
equal sets are one node. ``HASHES`` minima per set give ``BANDS`` band hashes of ``ROWS``
minima, and the low ``BITS`` bits of every minimum, packed into bit planes, are the signature
(64 bytes). Two sets share a band with probability ``1 - (1 - s^5)^25`` (0.9999996 at
s = 0.85). Of band candidates the share of equal low bits, counted by XOR, OR and bit counts and
corrected for chance agreements (2^-b), estimates the similarity; pairs that
estimate at least ``CUTOFF`` (six standard errors below 0.85) are confirmed on full sets.

Classes need a spanning set of links, not all of them, so groups of copies are not compared
pair by pair:

1. Every member of a bucket is compared with the bucket's smallest node. Members of one
   pivot are spread over tasks, each with its own copy of the pivot's text.
2. Buckets (of three members or more) whose members are not yet one class give the candidates
   between their classes: buckets of up to ``CAP`` members by signatures alone, larger ones as a whole.
   Nodes connected by them form clusters, whose classes are cut into blocks of bounded size (small classes
   share blocks); pairs of blocks meet in one task, but never two blocks of one class.

Only edges to the smallest node of a class inside a task are emitted; the classes are the
components over the edges of both steps.

Result: one row per input row with ``n_shingles``, ``component_id`` (the smallest id of its
class) and ``kept`` (whether that is its own id).

Defined cases: words are what is left between ASCII white space after lower-casing A-Z; null,
empty or blank text has no shingles, links to nothing and is its own class; equal rows are one
class; rows may share an id (each with the smallest id of its class is kept); null ids sort
last and are kept only in classes without any id; ties (exactly 0.85) are links; texts of any
length are used whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import numbered, read_table, sorted_groups, written
from tidewater.llm.ngram_join import mixed, roots, shared_counts
from tidewater.llm.words import byte_kinds, chunks, words
from tidewater.operators.graph import connected_components

N, PERCENT = 5, 85
BANDS, ROWS, HASHES, BITS = 25, 5, 128, 4
CUTOFF = 0.65
CAP, BLOCK, BLOCK_SHINGLES = 512, 1024, 1_000_000
STAR = 1024
FEW_PAIRS, MATRIX_AFTER = 2000, 4
SPACE = byte_kinds(b"\x20\x09\x0a\x0b\x0c\x0d")


class Shingles:
    def __init__(self, n: int = N):
        rng = np.random.Generator(np.random.PCG64(11))
        self.n = n
        self.place = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.a = (rng.integers(0, 2**31, HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
        self.band_mix = rng.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band_salt = np.arange(1, HASHES + 1, dtype=np.uint64) << np.uint64(32)

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of every text (binary, no nulls)."""
        w = words(texts, SPACE)
        spelled = np.fromiter((xxhash.xxh3_64_intdigest(v) for v in w.values.to_pylist()), np.uint64, len(w.values))
        h = spelled[w.codes]
        cuts = np.searchsorted(w.text, np.arange(len(texts) + 1))
        s = np.zeros(max(0, len(h) - self.n + 1), np.uint64)
        for i in range(self.n):
            s += h[i:len(h) - self.n + 1 + i] * self.place[i]
        s = mixed(s)
        out = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if hi - lo >= self.n:
                out.append(np.unique(s[lo:hi - self.n + 1]))
            elif hi > lo:
                k = hi - lo
                out.append(mixed((h[lo:hi] * self.place[:k]).sum(keepdims=True) + np.uint64(k)))
            else:
                out.append(np.empty(0, np.uint64))
        return out

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(HASHES, np.iinfo(np.uint32).max)
        for at in range(0, len(x), 1024):
            low = np.minimum(low, (self.a * x[at:at + 1024] + self.b).min(axis=1))
        return low

    def bands(self, minima: np.ndarray) -> np.ndarray:
        """A band hash per row of ``minima`` and band."""
        used = BANDS * ROWS
        m = mixed(minima[:, :used].astype(np.uint64) + self.band_salt[:used]).reshape(-1, BANDS, ROWS)
        return mixed((m * self.band_mix).sum(axis=2)).view(np.int64)


def packed(minima: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of every row's minima as bit planes: ``BITS`` x (HASHES / 64) longs a row."""
    low = mixed(minima.astype(np.uint64))
    planes = [np.packbits((low >> np.uint64(j) & np.uint64(1)).astype(np.uint8), axis=1) for j in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


LANES = HASHES // 64
CHANCE = 2.0**-BITS
LEAST_EQUAL = (CUTOFF * (1 - CHANCE) + CHANCE) * HASHES  # equal low bits that estimate ``CUTOFF``


def equal_bits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many minima of every left and every right signature agree in their low bits."""
    unlike = np.zeros((len(left), len(right)), np.int64)
    for lane in range(LANES):
        x = np.zeros((len(left), len(right)), np.int64)
        for j in range(BITS):
            x |= left[:, None, j * LANES + lane] ^ right[None, :, j * LANES + lane]
        unlike += np.bitwise_count(x.view(np.uint64))
    return HASHES - unlike


def estimate(equal):
    """Similarity for a number of equal low bits, corrected for agreement by chance."""
    return (equal / HASHES - CHANCE) / (1 - CHANCE)


def equal_bits_of(a: str, b: str) -> Column:
    """``equal_bits`` of two array columns, JVM-side."""
    lanes = []
    for lane in range(LANES):
        x = None
        for j in range(BITS):
            i = j * LANES + lane
            y = F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))
            x = y if x is None else x.bitwiseOR(y)
        lanes.append(F.bit_count(x))
    return F.lit(HASHES) - sum(lanes[1:], lanes[0])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles()
    for batch in batches:
        for b in chunks(batch, 2):
            sets = shingles.of(b.column(2))
            n = np.array([len(s) for s in sets], np.int64)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            minima = np.stack([shingles.minima(s) for s in sets])
            some = pa.array(n == 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(keys[:, i]) for i in (0, 1)], pa.array(n),
                 *[_lists(x, some) for x in (shingles.bands(minima), packed(minima))]],
                ["doc_id", "rid", "k1", "k2", "n", "bands", "sig"])


def _lists(x: np.ndarray, absent: pa.Array) -> pa.Array:
    at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
    return pa.ListArray.from_arrays(at, pa.array(x.ravel()), mask=absent)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _star_checker(percent: int):
    """Rows sorted by (pivot, part, member): the pivot's own row first, then members."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        at, pivot = None, None
        for batch in batches:
            for b in chunks(batch, 4):
                node, root = [], []
                sets = shingles.of(b.column(4))
                for p, part, member, i, s in zip(*[b.column(c).to_pylist() for c in range(4)], sets):
                    if not member:
                        at, pivot = (p, part), s
                    elif at == (p, part) and similar(pivot, s, percent):
                        node.append(i)
                        root.append(p)
                yield _edges(node, root)

    return check


def _edges(node, root) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, root)], ["node", "root"])


def candidates(sig: np.ndarray, n: np.ndarray, comp: np.ndarray, left: np.ndarray, right: np.ndarray,
               percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (index, index, equal bits) between different classes that may be links."""
    equal = equal_bits(sig[left], sig[right])
    small, large = np.minimum(n[left][:, None], n[right]), np.maximum(n[left][:, None], n[right])
    ok = (equal >= LEAST_EQUAL) & (comp[left][:, None] != comp[right]) & (100 * small >= percent * large)
    if left is right:
        ok = np.triu(ok, 1)
    i, j = np.nonzero(ok)
    return left[i], right[j], equal[i, j]


def _bucket_candidates(percent: int):
    """Buckets sorted by (band, h) -> an edge to the smallest node that candidates connect."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in sorted_groups(batches, 2):
            ids, comp, n = (t.column(c).to_numpy() for c in ("node", "comp", "n"))
            sig = np.array(t.column("sig").to_pylist(), np.int64)
            order = np.argsort(ids)
            ids, comp, n, sig = ids[order], comp[order], n[order], sig[order]
            every = np.arange(len(ids))
            i, j, _ = candidates(sig, n, comp, every, every, percent)
            if len(i):
                up = roots(len(ids), i, j)
                some = np.unique(np.concatenate((i, j)))
                yield _edges(ids[some], ids[up[some]])

    return check


def spanning(sets: list[np.ndarray], comp: np.ndarray, i: np.ndarray, j: np.ndarray, equal: np.ndarray,
             percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed pairs that connect all classes which any confirmed pair of (i, j) connects."""
    order = np.argsort(-equal, kind="stable")
    i, j = i[order], j[order]
    names, start = np.unique(comp, return_inverse=True)
    group, found, rounds = start, [], 0
    while len(i):
        if rounds >= MATRIX_AFTER and len(i) > FEW_PAIRS:  # all pairs left at once
            used = np.unique(np.concatenate((i, j)))
            both = shared_counts([sets[k] for k in used])[np.searchsorted(used, i), np.searchsorted(used, j)].astype(np.int64)
            size = np.array([len(s) for s in sets])
            ok = 100 * both >= percent * (size[i] + size[j] - both)
            found += list(zip(i[ok].tolist(), j[ok].tolist()))
            break
        now = np.zeros(len(i), bool)
        for g in (group[i], group[j]):  # the surest pair of every class
            now[np.unique(g, return_index=True)[1]] = True
        found += [(a, b) for a, b in zip(i[now].tolist(), j[now].tolist()) if similar(sets[a], sets[b], percent)]
        i, j, rounds = i[~now], j[~now], rounds + 1
        if found:
            x, y = start[np.array(found)].T
            group = roots(len(names), x, y)[start]
            apart = group[i] != group[j]
            i, j = i[apart], j[apart]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _block_checker(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for _, t in sorted_groups(batches, 1):
            t = t.sort_by("node").combine_chunks()
            ids, comp, n = (t.column(c).to_numpy() for c in ("node", "comp", "n"))
            sig = np.array(t.column("sig").to_pylist(), np.int64)
            side = t.column("side").to_numpy()
            left = np.flatnonzero(side != 1)
            right = left if (side == 2).any() else np.flatnonzero(side == 1)
            i, j, equal = candidates(sig, n, comp, left, right, percent)
            if not len(i):
                continue
            used = np.unique(np.concatenate((i, j)))
            sets = [None] * len(ids)
            texts = t.column("body").combine_chunks().take(pa.array(used))
            for b in chunks(pa.RecordBatch.from_arrays([pa.array(used), texts], ["at", "body"]), 1):
                for k, s in zip(b.column(0).to_pylist(), shingles.of(b.column(1))):
                    sets[k] = s
            sets = [np.empty(0, np.uint64) if s is None else s for s in sets]
            i, j = spanning(sets, comp, i, j, equal, percent)
            if len(i):
                up = roots(len(ids), i, j)
                some = np.unique(np.concatenate((i, j)))
                yield _edges(ids[some], ids[up[some]])

    return check


PAIR = "node long, root long"


def _star_links(members: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, star: int) -> DataFrame:
    """Step 1: confirmed links of bucket members with the pivots of their buckets."""
    pairs = members.where("node <> pivot").select("node", "pivot").distinct()
    a = nodes.select("node", "n", "sig")
    b = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("sig").alias("psig"))
    likely = (F.lit(100) * F.least("n", "pn") >= F.lit(percent) * F.greatest("n", "pn")) & (equal_bits_of("sig", "psig") >= LEAST_EQUAL)
    pairs = written(pairs.join(a, "node").join(b, "pivot").where(likely).select("node", "pivot"), "near-pairs")
    parts = written(pairs.groupBy("pivot").agg(F.ceil(F.count("*") / star).cast("int").alias("parts")), "near-pivots")
    dealt = pairs.join(parts, "pivot").select(
        F.col("pivot"), F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("member"), "node")
    own = parts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"),
                       F.col("pivot").alias("node"))
    return (dealt.unionByName(own).join(texts, F.col("node") == F.col("rid")).select("pivot", "part", "member", "node", "body")
            .repartition("pivot", "part").sortWithinPartitions("pivot", "part", "member").mapInArrow(_star_checker(percent), PAIR))


def _cluster_links(members: DataFrame, links: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, cap: int,
                   block: int, block_shingles: int) -> DataFrame | None:
    """Step 2: links between classes of ``links`` that meet in a bucket; None where none do."""
    comps = written(connected_components(links.select(F.col("node").alias("src"), F.col("root").alias("dst")))
                    .select(F.col("id").alias("node"), F.col("component").alias("comp")), "near-classes")
    classed = written(members.where("c > 2").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "near-members")
    apart = classed.groupBy("band", "h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band", "h")
    open_ = written(classed.join(written(apart, "near-open"), ["band", "h"]), "near-open-members")
    small = (open_.where(F.col("c") <= cap).join(nodes.select("node", "n", "sig"), "node").select("band", "h", "node", "comp", "n", "sig")
             .repartition("band", "h").sortWithinPartitions("band", "h").mapInArrow(_bucket_candidates(percent), PAIR))
    large = open_.where(F.col("c") > cap).select("node", F.col("pivot").alias("root"))
    met = written(small.unionByName(large), "near-met")
    if met.isEmpty():
        return None
    clusters = connected_components(met.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    clusters = clusters.select(F.col("id").alias("node"), F.col("component").alias("cluster"))
    inside = written(clusters.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
                     .join(nodes.select("node", "n", "sig"), "node"), "near-clusters")
    # Blocks of a class, or shared by the classes that are smaller than one block.
    blocks = lambda rows, size: F.greatest(F.ceil(rows / block), F.ceil(size / block_shingles)).cast("long")
    sized = inside.groupBy("cluster", "comp").agg(F.count("*").alias("rows"), F.sum("n").alias("size"))
    sized = sized.withColumn("owner", F.when(blocks(F.col("rows"), F.col("size")) > 1, F.col("comp")).otherwise(F.lit(-1)))
    owners = sized.groupBy("cluster", "owner").agg(blocks(F.sum("rows"), F.sum("size")).alias("blocks"))
    sized = written(sized.select("cluster", "comp", "owner"), "near-sized")
    owners = written(owners, "near-owners")
    placed = written(inside.join(sized, ["cluster", "comp"]).join(owners, ["cluster", "owner"])
                     .withColumn("at", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks"), "near-placed")
    ones = owners.select("cluster", "owner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("at"))
    two = ones.select("cluster", F.col("owner").alias("owner2"), F.col("at").alias("at2"))
    order = F.struct("owner", "at") <= F.struct(F.col("owner2").alias("owner"), F.col("at2").alias("at"))
    tasks = written(ones.join(two, "cluster").where(order & ((F.col("owner") == -1) | (F.col("owner") != F.col("owner2"))))
                    .withColumn("task", F.monotonically_increasing_id()), "near-tasks")
    same = (F.col("owner") == F.col("owner2")) & (F.col("at") == F.col("at2"))
    first = tasks.select("cluster", "owner", "at", "task", F.when(same, 2).otherwise(0).alias("side"))
    second = tasks.where(~same).select("cluster", F.col("owner2").alias("owner"), F.col("at2").alias("at"), "task", F.lit(1).alias("side"))
    sent = placed.join(written(first.unionByName(second), "near-sides"), ["cluster", "owner", "at"])
    return (sent.join(texts, F.col("node") == F.col("rid")).select("task", "side", "node", "comp", "n", "sig", "body")
            .repartition("task").sortWithinPartitions("task").mapInArrow(_block_checker(percent), PAIR))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, cap: int = CAP,
               block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES, star: int = STAR) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row; see the module text."""
    texts = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                 F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")), "rid")
    sig = written(texts.select("doc_id", "rid", "body").mapInArrow(
        _signatures, "doc_id long, rid long, k1 long, k2 long, n long, bands array<long>, sig array<long>"), "near-signatures")
    texts = texts.select("rid", "body")
    key = ["k1", "k2", "n"]
    sets = written(sig.where("n > 0").groupBy(*key).agg(F.min("rid").alias("node"), F.min("doc_id").alias("least")), "near-sets")
    nodes = written(sets.select("node").join(sig.select(F.col("rid").alias("node"), "n", "bands", "sig"), "node"), "near-nodes")

    # Buckets of at least two nodes, one of every kind of membership.
    banded = nodes.select("node", F.posexplode("bands").alias("band", "h")).withColumn("band", F.col("band").cast("long"))
    buckets = (banded.groupBy("band", "h").agg(
        F.count("*").alias("c"), F.min("node").alias("pivot"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x1"),
        F.bit_xor(F.xxhash64("node", F.lit(2))).alias("x2")).where("c > 1")
        .groupBy("c", "pivot", "x1", "x2").agg(F.min(F.struct("band", "h")).alias("b")).select("b.band", "b.h", "c", "pivot"))
    members = written(banded.join(written(buckets, "near-buckets"), ["band", "h"]), "near-bucket-members")

    links = written(_star_links(members, nodes, texts, percent, star), "near-stars")
    more = _cluster_links(members, links, nodes, texts, percent, cap, block, block_shingles)
    if more is not None:
        links = written(links.unionByName(more), "near-links")
    comps = connected_components(links.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    classed = written(sets.join(comps.withColumnRenamed("id", "node"), "node", "left")
                      .withColumn("component", F.coalesce("component", "node")), "near-classed")
    names = written(classed.groupBy("component").agg(F.min("least").alias("component_id")), "near-names")
    named = written(classed.join(names, "component").select(*[F.col(k).alias(f"c_{k}") for k in key], "component_id"), "near-named")
    same = (F.col("k1") == F.col("c_k1")) & (F.col("k2") == F.col("c_k2")) & (F.col("n") == F.col("c_n"))
    out = sig.select("doc_id", *key).join(named, same, "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op11_minhash_near_dedup": op11_minhash_near_dedup}
ORACLE: dict[str, str] = {}
