"""Operator 6: mixing sources to target weights.

Every row gets a hash-random key from its id and text, so rows that share an id, or have none, spread. The
key's leading bits cut each source into key ranges of about ``RANGE_ROWS`` rows; ranges are
summed, prefix sums over groups of ranges and over the ranges of a group (about the square root
of their number each) give each range its start, and a sort inside the range finishes the
prefix sum of token counts in key order. So a source of any size is split over many tasks. A source is
taken ``target // size`` whole epochs and then in key order up to its exact budget; the
document on the cut gives the words that still fit.

Weights go round over the sources in code-point order (null last). A target stops at
``max_repeat`` times the source's size and the excess is dealt again by weight until no
source is above (one small aggregate per round over the table of sources).

Defined cases: a null text has size 0; null sources form one source; a null id is keyed like
the id ``null``; rows with equal keys are ordered by id, size and row number (rows equal in id and text are
interchangeable and share a range); texts of any length count whole; columns of the input
that are named like a result do not matter; an empty table or one without words gives targets and takes of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, numbered, read_table, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
KEY_BITS = 60
RANGE_ROWS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_col: Column, text: Column, seed: str) -> Column:
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, source_size)`` plus ``target``: shares by weight, capped, excess dealt again."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    index = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    t = written(totals.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (index + 1).cast("int")))
                .withColumn("most", F.col("source_size") * max_repeat), "mix-sources")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    capped, level = -1, 0.0
    is_capped = F.lit(False)
    while True:
        n, most, w = t.agg(F.count(F.when(is_capped, 1)), F.sum(F.when(is_capped, F.col("most")).otherwise(0)),
                           F.sum(F.when(is_capped, 0).otherwise(F.col("w")))).first()
        if n == capped or not w:
            break
        capped, level = n, (total - most) / w
        is_capped = F.col("most") < F.col("w") * F.lit(level)
    return t.select("source", "source_size",
                    F.when(is_capped, F.col("most").cast("double")).otherwise(F.col("w") * F.lit(level)).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = "mix",
                range_rows: int = RANGE_ROWS, row_col: str | None = None) -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``, ``target``, ``taken``, and
    ``row_col`` if it is given (a number that only one row has)."""
    number = F.col(row_col) if row_col else F.lit(0)
    sized = written(docs.select(F.col(id_col).alias("id"), number.alias("number"), F.col(source_col).alias("source"),
                                word_count(F.col(text_col)).alias("size"),
                                random_key(F.col(id_col), F.col(text_col), seed).alias("key")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    bits = max(0, (max(1, sized.count()) // range_rows).bit_length())
    ranged = sized.withColumn("rng", F.shiftright("key", KEY_BITS - bits))
    def before(keys: list[str], order: str, size: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(earlier), F.lit(0))

    ranges = ranged.groupBy("source", "rng").agg(F.sum("size").alias("range_size")).withColumn("block", F.shiftright("rng", bits // 2))
    blocks = (ranges.groupBy("source", "block").agg(F.sum("range_size").alias("block_size"))
              .select(F.col("source").alias("s"), F.col("block").alias("g"), before(["source"], "block", "block_size").alias("base")))
    starts = (ranges.withColumn("inner", before(["source", "block"], "rng", "range_size"))
              .join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("g")))
              .select("source", "rng", (F.col("base") + F.col("inner")).alias("start"))
              .join(source_targets(totals, weights, max_repeat).withColumnRenamed("source", "s"),
                    F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    rows = ranged.alias("r").join(
        starts.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.rng") == F.col("b.rng"))).select(
            "r.id", "r.number", "r.source", "r.size", "r.key", "r.rng", "b.start", "b.source_size", "b.target")
    inside = Window.partitionBy("source", "rng").orderBy("key", "id", "size", "number").rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    return (rows.withColumn("before", prefix).withColumn("epochs", epochs)
            .withColumn("last", F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before"))).cast("long"))
            .select(*([F.col("number").alias(row_col)] if row_col else []), F.col("id").alias(id_col), "source", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + F.col("last")).cast("long").alias("taken"),
                    "epochs", "last"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **kw) -> DataFrame:
    """The mix itself: a row per whole epoch of a document and one cut to the words of the
    last, partial epoch; columns as in ``docs`` (``n_chars`` follows a cut text). Documents
    without any word carry nothing into the mix. Rows may share an id."""
    row, epoch, last, n, size, mix_row = fresh(docs, "row_no", "epochs", "last", "copy", "size", "mix_row")
    rows = numbered(docs, row)
    taken = mix_sources(rows, id_col, text_col, source_col, row_col=row, **kw).where(F.col("taken") > 0).select(
        F.col(row).alias(mix_row), F.col("epochs").alias(epoch), F.col("last").alias(last), F.col("size").alias(size))
    joined = rows.join(taken, F.col(row) == F.col(mix_row))
    copies = joined.withColumn(n, F.explode(F.sequence(F.lit(0), F.col(epoch)))) \
        .where((F.col(n) < F.col(epoch)) | (F.col(last) > 0))
    cut = (F.col(n) == F.col(epoch)) & (F.col(last) < F.col(size))
    pattern = F.concat(F.lit(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){0,"),
                       F.col(last).cast("string"), F.lit("}+"))
    head = F.regexp_substr(F.col(text_col), pattern)
    out = copies.withColumn(text_col, F.when(cut, head).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length(text_col).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op6_mix_sources": op6_mix_sources}
ORACLE = {"op6_mix_sources": r"""
    WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                      ('0x' || substr(sha256('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key
               FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size,
                 [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
          FROM d GROUP BY source),
    q AS (SELECT *, 3 * source_size AS most, row_number() OVER r AS k,
                 (sum(source_size) OVER ())::BIGINT AS total,
                 (coalesce(sum(3 * source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS used,
                 (sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS w_left
          FROM s WINDOW r AS (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST)),
    lev AS (SELECT (total - used) / w_left::DOUBLE AS level, k FROM q
            WHERE (total - used) / w_left::DOUBLE * w <= most ORDER BY k LIMIT 1),
    t AS (SELECT q.source, q.source_size, CASE WHEN q.k < lev.k THEN q.most::DOUBLE ELSE w * level END AS target
          FROM q, lev),
    p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
                 (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
    SELECT doc_id, size, source_size, target,
           (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
    FROM e"""}
