"""Operator 13: phrase collocations by best-first branch-and-bound growth.

Phrases grow word by word. Counts of all words come first; words with fewer than ``least``
occurrences start no phrase. Every other word is expanded to its two-word phrases (a word alone bounds no
score: a phrase with equally frequent words may score 1,000,000). For a two-word prefix with
counts f(w1 w2), f(w1), every extension scores at most ``1000000 f(w1 w2) / f(w1)``, because
the extension is no more frequent than its prefix and its rest; the last two words give a bound
``1000000 f(w2 w3) / f(w3)`` likewise. The frontier is expanded best first, a batch of bounds
at a time: a round takes a score ``cut`` per language and counts the extensions of all
prefixes that may reach it, and those that decide whether a two-word phrase above it is
dropped. All surviving phrases of at least the cut are then known exactly; a language with
``top`` of them (or with its whole frontier expanded) is settled with all its ties, the others go on with a
lower cut.

A pass over the texts counts in numpy, per chunk of a task; Spark adds the counts up. So that
passes ship only counts that can matter, tasks hold a two-hash filter of the words or prefixes
to expand (four bits a slot, at most ``MAX_SLOTS`` / 2 bytes whatever the corpus). False
positives of the filter only count phrases in vain: a counted phrase is counted everywhere.

Result: per language the first ``top`` phrases with their count ``a``, the counts ``l`` and
``r`` of the two parts of the lowest-scoring cut, the number ``n`` of word occurrences, and the
score. Quotients are taken of 38-digit integers.

Defined cases: null, empty or blank texts have no words; a null language counts as ``und``;
words never cross a border byte or a text; texts of any length are used whole; repeated rows
count repeatedly; equal scores and counts go by the phrase's bytes; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import read_table, written
from tidewater.llm.ngram_join import mixed
from tidewater.llm.words import byte_kinds, chunks, words

TOP, LEAST, INSIDE = 2000, 10, 50
MILLION, GRAIN = 1_000_000, 50
KINDS = byte_kinds(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")
CHUNK = 2_000_000
MIN_SLOTS, MAX_SLOTS = 2**16, 2**26
FIRST, WIDER = 2, 8
PLACE = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
# Flags of a prefix: it is frequent, its extensions may reach the cut, so may phrases it ends, it reaches the cut itself.
FREQUENT, OPENS, CLOSES, REACHES = 1, 2, 4, 8


def hashes(values: list) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), np.uint64, len(values))


def phrase_hash(lang: np.ndarray, *parts: np.ndarray) -> np.ndarray:
    h = lang
    for part, place in zip(parts, PLACE):
        h = mixed(h + part * place)
    return h


class Filter:
    """Four flag bits for every phrase put in, at two slots each; ``table`` packs 16 slots a word."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, np.uint64(len(table) * 16 - 1)

    def flags(self, h: np.ndarray) -> np.ndarray:
        out = None
        for slot in slots(h, self.mask):
            bits = self.table[slot >> np.uint64(4)] >> ((slot & np.uint64(15)) << np.uint64(2))
            out = bits if out is None else out & bits
        return (out & np.uint64(15)).astype(np.uint8)


def slots(h: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    return h & mask, (h >> np.uint64(32)) & mask


def make_filter(phrases: DataFrame, parts: list[str], rows: int) -> Broadcast:
    """The filter of ``phrases(lang, *parts, flag)``, made in Spark; at most ``MAX_SLOTS`` slots."""
    size = int(np.clip(2 ** int(np.ceil(np.log2(max(1, 16 * rows)))), MIN_SLOTS, MAX_SLOTS))
    mask = np.uint64(size - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = phrase_hash(*[hashes(b.column(i).to_pylist()) for i in range(1 + len(parts))])
            flag = b.column(1 + len(parts)).to_numpy(zero_copy_only=False).astype(np.uint64)
            at = np.concatenate(slots(h, mask))
            bits = np.concatenate((flag, flag)) << ((at & np.uint64(15)) << np.uint64(2))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(4)).astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    words_ = (phrases.select("lang", *parts, "flag").mapInArrow(place, "word long, bits long")
              .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    table = np.zeros(size // 16, np.uint64)
    table[words_.column("word").to_numpy()] = words_.column("bits").to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(table)


def _count(size: int, known: Broadcast | None):
    """Counts of the phrases of ``size`` words that the filter lets through, per chunk; for
    single words all, and the number of words of a language under the null word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = Filter(known.value) if known is not None else None
        for batch in batches:
            for b in chunks(batch, 1, CHUNK):
                yield from _counted(b, size, accept)

    return run


def _counted(b: pa.RecordBatch, size: int, accept: Filter | None) -> Iterator[pa.RecordBatch]:
    w = words(b.column(1), KINDS)
    langs = b.column(0).dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.text]
    code, v = w.codes, len(w.values)
    if len(code) < size:
        return
    if size == 1:
        key, f = np.unique(lang * v + code, return_counts=True)
        yield _found(langs.dictionary, w.values, [key // v], [key % v], f)
        some = np.unique(lang)
        none = pa.nulls(len(some), pa.string())
        yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(some)).cast(pa.string()), none,
                                          pa.array(np.bincount(lang)[some])], ["lang", "w1", "f"])
        return
    hl, hw = hashes(langs.dictionary.to_pylist()), hashes(w.values.to_pylist())
    if size == 2:
        ok = accept.flags(phrase_hash(hl[lang], hw[code])) > 0
        at = np.flatnonzero((w.piece[:-1] == w.piece[1:]) & ok[:-1] & ok[1:])
        key, f = np.unique((lang[at] * v + code[at]) * v + code[at + 1], return_counts=True)
        if len(f):
            yield _found(langs.dictionary, w.values, [key // v // v], [key // v % v, key % v], f)
        return
    flag = accept.flags(phrase_hash(hl[lang[:-1]], hw[code[:-1]], hw[code[1:]]))
    x, y = flag[:-1], flag[1:]
    grows = ((x & OPENS) > 0) & ((y & CLOSES) > 0) | ((x | y) & REACHES > 0)
    at = np.flatnonzero((w.piece[:-2] == w.piece[2:]) & (x & y & FREQUENT > 0) & grows)
    if not len(at):
        return
    pair, of = np.unique((lang[at] * v + code[at]) * v + code[at + 1], return_inverse=True)
    key, f = np.unique(of * v + code[at + 2], return_counts=True)
    first = pair[key // v]
    yield _found(langs.dictionary, w.values, [first // v // v], [first // v % v, first % v, key % v], f)


def _found(langs: pa.Array, values: pa.Array, lang: list, parts: list, f: np.ndarray) -> pa.RecordBatch:
    names = [f"w{i + 1}" for i in range(len(parts))]
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(lang[0])).cast(pa.string()), *[values.take(pa.array(p)).cast(pa.binary()).cast(pa.string()) for p in parts],
         pa.array(f.astype(np.int64))], ["lang", *names, "f"])


def counted(texts: DataFrame, size: int, known: Broadcast | None = None) -> DataFrame:
    """``lang, w1, .., f``: counts over all texts."""
    parts = [f"w{i + 1}" for i in range(size)]
    rows = texts.mapInArrow(_count(size, known), ", ".join(["lang string", *[f"{p} string" for p in parts], "f long"]))
    return rows.groupBy("lang", *parts).agg(F.sum("f").alias("f"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact."""
    wide = lambda c: c.cast("decimal(15,0)")
    top = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(MILLION).cast("decimal(7,0)")
    bottom = (wide(left) * wide(right)).cast("decimal(31,0)")
    # The remainder turns the decimal quotient into an exact one.
    return ((top - top % bottom) / bottom).cast("long")


def _with(rows: DataFrame, table: DataFrame, keys: list[str], names: list[str], out: str) -> DataFrame:
    """``rows`` with the count ``f`` of the phrase in ``keys`` as ``out``."""
    t = table.select("lang", *[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("f").alias(out))
    return rows.join(t, ["lang", *keys])


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, least: int = LEAST,
            first: int = FIRST, wider: int = WIDER) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``; see the module text. A round takes the cut at
    about the ``first * top``-th two-word score, later ones ``wider`` times as far down."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    uni = written(counted(texts, 1).where(F.col("w1").isNull() | (F.col("f") >= least)), "phrase-words")
    totals = uni.where("w1 is null").select("lang", F.col("f").alias("n"))
    uni = uni.where("w1 is not null")
    accept = make_filter(uni.withColumn("flag", F.lit(FREQUENT)), ["w1"], uni.count())
    bi = written(counted(texts, 2, accept).where(F.col("f") >= least), "phrase-pairs")
    pairs = _with(_with(bi, uni, ["w1"], ["w1"], "l"), uni, ["w2"], ["w1"], "r").withColumnRenamed("f", "a")
    bound = lambda part: F.floor(F.col("a") * MILLION / F.col(part)) + 1  # noqa: E731  (a double; one more is safe)
    pairs = written(pairs.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
                    .withColumn("opens", bound("l")).withColumn("closes", bound("r")), "phrase-scored")
    size = pairs.count()

    going, done, rank = totals.select("lang"), [], first * top
    while True:
        going = written(going, "phrase-languages")
        if going.isEmpty():
            break
        mine = pairs.join(going, "lang", "left_semi")
        # The cut comes from a histogram: at most a million / GRAIN rows a language meet in a task.
        bars = mine.groupBy("lang", F.floor(F.col("score") / GRAIN).alias("bar")).count()
        above = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("bar")))
        cuts = bars.withColumn("above", above).where(F.col("above") >= rank).groupBy("lang").agg((F.max("bar") * GRAIN).alias("cut"))
        cuts = written(going.join(cuts, "lang", "left").select("lang", F.coalesce("cut", F.lit(0)).alias("cut")), "phrase-cuts")
        found = written(_reaching(texts, mine.join(cuts, "lang"), uni, bi, cuts, least, size), "phrase-found")
        settled = written(cuts.join(found.groupBy("lang").count(), "lang", "left")
                          .select("lang", ((F.col("cut") == 0) | (F.coalesce("count", F.lit(0)) >= top)).alias("settled")), "phrase-settled")
        done.append(found.join(settled.where("settled"), "lang", "left_semi"))
        going, rank = settled.where("not settled").select("lang"), rank * wider
    every = done[0] if done else None
    for d in done[1:]:
        every = every.unionByName(d)
    if every is None:
        return docs.sparkSession.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    firsts = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return firsts.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _reaching(texts: DataFrame, mine: DataFrame, uni: DataFrame, bi: DataFrame, cuts: DataFrame, least: int, size: int) -> DataFrame:
    """All surviving phrases of a score of at least the language's ``cut``."""
    flag = (F.lit(FREQUENT) + F.when(F.col("opens") >= F.col("cut"), OPENS).otherwise(0)
            + F.when(F.col("closes") >= F.col("cut"), CLOSES).otherwise(0) + F.when(F.col("score") >= F.col("cut"), REACHES).otherwise(0))
    accept = make_filter(mine.withColumn("flag", flag), ["w1", "w2"], size)
    some = texts.join(cuts.select(F.col("lang").cast("binary").alias("lang")), "lang", "left_semi").select("lang", "body")
    tri = written(counted(some, 3, accept).where(F.col("f") >= least), "phrase-triples")
    three = _with(_with(tri, bi, ["w1", "w2"], ["w1", "w2"], "f12"), bi, ["w2", "w3"], ["w1", "w2"], "f23")
    three = _with(_with(three, uni, ["w1"], ["w1"], "f1"), uni, ["w3"], ["w1"], "f3")
    by1, by2 = score(F.col("f"), F.col("f1"), F.col("f23")), score(F.col("f"), F.col("f12"), F.col("f3"))
    three = three.withColumn("by1", by1).withColumn("by2", by2)
    one = F.col("by1") <= F.col("by2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
                         F.when(one, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(one, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("by1", "by2").alias("score"))
    inside = tri.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "f")
    inside = inside.groupBy("lang", "p.w1", "p.w2").agg(F.max("f").alias("longer"))
    two = (mine.where(F.col("score") >= F.col("cut")).join(inside, ["lang", "w1", "w2"], "left")
           .where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(INSIDE) * F.col("a")))
           .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score"))
    reached = three.join(cuts, "lang").where(F.col("score") >= F.col("cut")).drop("cut")
    return two.unionByName(reached)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(read_table(spark, sf_dir, "documents"))


QUERIES = {"op13_phrase_collocations": op13_phrase_collocations}
ORACLE = {"op13_phrase_collocations": r"""
    WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    piece AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
    ws AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
    spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
    one AS (SELECT lang, w[i] AS w1, count(*) AS f FROM spot GROUP BY ALL),
    two AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM spot WHERE i < len(w) GROUP BY ALL),
    three AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM spot WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
    cut AS (
        SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, 1 AS k, x.f AS l, y.f AS r
        FROM two b JOIN one x ON x.lang = b.lang AND x.w1 = b.w1 JOIN one y ON y.lang = b.lang AND y.w1 = b.w2
        WHERE b.f >= 10 AND NOT EXISTS (SELECT 1 FROM three c WHERE c.lang = b.lang AND 100 * c.f >= 50 * b.f
            AND ((c.w1 = b.w1 AND c.w2 = b.w2) OR (c.w2 = b.w1 AND c.w3 = b.w2)))
        UNION ALL
        SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
        FROM three c JOIN one x ON x.lang = c.lang AND x.w1 = c.w1 JOIN two y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
        UNION ALL
        SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
        FROM three c JOIN two x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN one y ON y.lang = c.lang AND y.w1 = c.w3),
    scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut),
    worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""}
