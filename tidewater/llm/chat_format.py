"""Operator 10: chat formatting with cumulative-snapshot collapse.

A service that logs the whole conversation after every turn leaves snapshots: logs whose
turns are a prefix of a longer log. Every turn gets a rolling prefix hash: the XOR of two
64-bit hashes of ``(position, role, text)`` over the turns so far. XOR is associative, so
the distinct turns of all conversations are dealt by ranges of (conversation, turn, role,
text), a conversation's share of a range is numbered and hashed on its own, and a prefix over
the ranges completes positions and hashes: whatever the turn numbers, no conversation has to
fit one task. (Turns alike in all but what follows the first ``KEY_CHARS`` characters of their
text share a range.) A log is dropped (left anti join on length and hash) if a longer one has the
same prefix hash at its length; of equal logs the smallest ``conv_id`` stays. What is left
is rendered turn by turn, one row per conversation and part. A turn weighs its bytes, at least
``TURN_BYTES``; a part takes the turns that start in the same ``PART_TURNS * TURN_BYTES`` of a conversation's
running weight, so a part holds at most that weight and one turn more, and has at most
``PART_TURNS`` turns (part 0 alone unless a conversation is longer; numbers are skipped inside a turn that
outweighs a part).

Defined cases: turns sort by (turn, role, text), null first; null role and text count as
empty; repeated identical turn rows count once; rows without ``conv_id`` form one
conversation with a null id; turns of any length stay whole; an empty table gives no rows; other columns are ignored.
The marker ``<|`` inside a text is written ``< |`` so that a text cannot forge a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import read_table, shuffle_partitions, written

PART_TURNS, TURN_BYTES = 4096, 4096
KEY_CHARS = 512


def rolling_turns(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``(conv_id, part, pos, role, text, h1, h2, n)``: position and rolling prefix hashes of
    every distinct turn and the length of its conversation."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    dealt = written(rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "conv_id", "turn", "role",
                                            F.substring("text", 1, KEY_CHARS))
                    .withColumn("part", F.spark_partition_id()), "chat-ranges")
    by_part = Window.partitionBy("conv_id", "part")
    local = written(dealt.withColumn("i", F.row_number().over(by_part.orderBy("turn", "role", "text"))).drop("turn"), "chat-turns")

    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.greatest(F.octet_length("text") + F.octet_length("role"), F.lit(TURN_BYTES)).cast("long")
    starts = (local.groupBy("conv_id", "part").agg(F.max("i").alias("m"), F.sum(weight).alias("w"))
              .withColumn("start", F.coalesce(F.sum("m").over(earlier), F.lit(0)))
              .withColumn("heavy", F.coalesce(F.sum("w").over(earlier), F.lit(0)))
              .withColumn("n", F.sum("m").over(Window.partitionBy("conv_id"))).drop("m", "w"))
    placed = _with_part(local, starts).withColumn("pos", F.col("start") + F.col("i"))
    hashed = placed.withColumns({f"h{k}": F.xxhash64("pos", "role", "text", F.lit(k)) for k in (1, 2)})

    sums = (hashed.groupBy("conv_id", "part").agg(*[F.bit_xor(f"h{k}").alias(f"x{k}") for k in (1, 2)])
            .withColumns({f"b{k}": F.coalesce(F.bit_xor(f"x{k}").over(earlier), F.lit(0)) for k in (1, 2)})
            .drop("x1", "x2"))
    upto = by_part.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (_with_part(hashed, sums)
            .withColumns({f"h{k}": F.bit_xor(f"h{k}").over(upto).bitwiseXOR(F.col(f"b{k}")) for k in (1, 2)})
            .withColumn("part", F.floor((F.col("heavy") + F.sum(weight).over(upto) - weight) / (part_turns * TURN_BYTES)))
            .select("conv_id", "part", "pos", "role", "text", "h1", "h2", "n"))


def _with_part(rows: DataFrame, parts: DataFrame) -> DataFrame:
    p = parts.withColumnsRenamed({"conv_id": "p_conv", "part": "p_part"})
    return rows.join(p, rows["conv_id"].eqNullSafe(p["p_conv"]) & (rows["part"] == p["p_part"])).drop("p_conv", "p_part")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``(keep_conv, n_turns, copies, last_part)`` of the logs that no longer log starts with."""
    logs = (turns.where(F.col("pos") == F.col("n")).groupBy("n", "h1", "h2")
            .agg(F.min("conv_id").alias("keep_conv"), F.count("*").alias("copies"), F.max("part").alias("last_part")))
    inner = (turns.where(F.col("pos") < F.col("n")).groupBy("pos", "h1", "h2").agg(F.count("*").alias("longer"))
             .withColumnsRenamed({"pos": "i_pos", "h1": "i1", "h2": "i2"}))
    return logs.join(inner, (F.col("n") == F.col("i_pos")) & (F.col("h1") == F.col("i1"))
                     & (F.col("h2") == F.col("i2")), "left_anti").select("keep_conv", F.col("n").alias("n_turns"), "copies", "last_part")


def format_chats(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, part, n_turns, copies, text`` of the maximal conversations."""
    turns = written(rolling_turns(conversations, part_turns), "chat-rolling")
    kept = maximal_conversations(turns)
    piece = F.concat(F.lit("<|"), F.regexp_replace("role", r"<\|", "< |"), F.lit("|>\n"),
                     F.regexp_replace("text", r"<\|", "< |"), F.lit("\n<|end|>\n"))
    parts = kept.withColumnRenamed("keep_conv", "conv_id").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_part"))))
    joined = _with_part(turns, parts)
    return (joined.select("conv_id", "part", "pos", "n_turns", "copies", piece.alias("piece"))
            .groupBy("conv_id", "part", "n_turns", "copies")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))),
                                          lambda t: t["piece"]), "").alias("text")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read_table(spark, sf_dir, "conversations"))


QUERIES = {"op10_chat_format": op10_chat_format}
ORACLE = {"op10_chat_format": r"""
    WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
    l AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns,
                 count(*) AS n, min(turn) AS lo FROM t GROUP BY conv_id),
    inner_prefix AS (SELECT DISTINCT unnest([turns[1:k] FOR k IN range(1, n)]) AS pre FROM l),
    g AS (SELECT turns, n, min(conv_id) AS conv_id, count(*) AS copies FROM l GROUP BY turns, n)
    SELECT conv_id, 0::BIGINT AS part, n AS n_turns, copies,
           array_to_string([('<|' || replace(x.role, '<|', '< |') || '|>' || chr(10) || replace(x.text, '<|', '< |')
                             || chr(10) || '<|end|>' || chr(10)) FOR x IN turns], '') AS text
    FROM g WHERE turns NOT IN (SELECT pre FROM inner_prefix)"""}
