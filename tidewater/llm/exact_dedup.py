"""Operator 8: exact dedup by content sort.

Texts are normalised (every run of space, TAB, LF, VT, FF or CR becomes one space) and
range-partitioned on ``(first 32 characters, 64-bit content hash, salt)`` with splitters
that Spark samples from those short keys; each partition is sorted externally by the same
key followed by the full normalised text and the id, so equal texts are adjacent. The
window over the sorted rows starts a new group where the full text differs from its
neighbour's and keeps the smallest id.

A text with more copies than ``cap`` rows is spread over several salts by the row's place in the
input, so that copies that share an id, or have none, spread too. The runs of such texts are
written once (the salts then hold for all later reads), merged by full text, and the
at most ``8 * partitions`` merged runs are broadcast.

Defined cases: a null text counts as empty; a null id sorts last (``keep_id`` is null only
if every id of the group is); of fully repeated rows exactly one is ``kept``; texts of any length are normalised and
compared whole; an empty
table gives an empty result; input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, heavy_keys, read_table, shuffle_partitions, written

SPACE_RUN = r"[\x20\x09-\x0D]+"
PREFIX = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                cap_least: int = 256) -> DataFrame:
    """Every input row and column plus ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256``."""
    parts = shuffle_partitions(docs.sparkSession)
    norm, h, salt, head, run_keep, run_size, first, mh, ms, rk, gk, gn, lead = fresh(
        docs, "norm", "content_hash", "salt", "prefix", "run_keep", "run_size", "first",
        "merged_hash", "merged_salt", "merged_run", "group_keep", "group_rows", "lead")
    hashed = docs.withColumn(norm, normalised(F.col(text_col))).withColumn(h, F.xxhash64(norm))

    heavy, cap = heavy_keys(hashed.select(h), h, docs.count(), parts, cap_least)
    salts = F.broadcast(written(heavy.select(F.col(h), F.ceil(F.col("n") / cap).alias(salt)), "dedup-heavy"))
    light = hashed.join(salts.select(h), h, "left_anti").withColumn(salt, F.lit(-1).cast("long"))
    salted = hashed.join(salts, h).withColumn(salt, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(salt)).cast("long"))

    def runs_of(rows: DataFrame) -> DataFrame:
        ordered = rows.withColumn(head, F.substring(norm, 1, PREFIX)).repartitionByRange(F.col(head), F.col(h), F.col(salt))
        run = Window.partitionBy(head, h, salt, norm)
        return (ordered
                .withColumn(first, F.row_number().over(run.orderBy(F.col(id_col).asc_nulls_last())) == 1)
                .withColumn(run_keep, F.min(id_col).over(run))
                .withColumn(run_size, F.count("*").over(run)))

    copies = written(runs_of(salted), "dedup-runs")
    group = Window.partitionBy(h, norm)
    merged = F.broadcast(copies.where(F.col(first)).select(
        F.col(h).alias(mh), F.col(salt).alias(ms), F.col(run_keep).alias(rk),
        F.min(run_keep).over(group).alias(gk), F.sum(run_size).over(group).alias(gn),
        (F.row_number().over(group.orderBy(F.col(run_keep).asc_nulls_last(), F.col(salt))) == 1).alias(lead)))
    same = (F.col(h) == F.col(mh)) & (F.col(salt) == F.col(ms)) & F.col(run_keep).eqNullSafe(F.col(rk))
    joined = (copies.join(merged, same, "left").drop(mh, ms, rk)
              .unionByName(runs_of(light), allowMissingColumns=True))
    out = {
        "keep_id": F.when(F.col(gn).isNotNull(), F.col(gk)).otherwise(F.col(run_keep)),
        "group_size": F.coalesce(F.col(gn), F.col(run_size)),
        "kept": F.col(first) & F.coalesce(F.col(lead), F.lit(True)),
        "text_sha256": F.sha2(F.col(norm).cast("binary"), 256),
    }
    keep = [c for c in docs.columns if c.lower() not in out]
    return joined.select(*[F.col(c) for c in keep], *[v.alias(k) for k, v in out.items()])


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
ORACLE = {"op8_exact_dedup": r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM n"""}
