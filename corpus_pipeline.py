"""A training corpus from ``documents``: language ID, exact and near dedup, source mixing,
tokenizing. Every stage takes all rows its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import exact_dedup, language_id, mix_sources, ngram_join, sentencepiece_codec
from tidewater.llm.common import fresh, numbered, read_table, written


def _filtered(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], results: list[str], condition: str,
              **replaced: Column) -> DataFrame:
    """The rows of ``docs`` whose ``results``, as ``judge`` adds them, meet ``condition``; columns
    of ``docs`` that are named like a result keep their values, those in ``replaced`` get new ones."""
    clash = [c for c in docs.columns if c.lower() in results]
    away = dict(zip(clash, fresh(docs, *clash)))
    judged = judge(docs.withColumnsRenamed(away)).where(condition)
    return judged.select(*[replaced.get(c, F.col(away.get(c, c))).alias(c) for c in docs.columns])


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that get a language, with it as their ``lang``: labels teach the prototypes, the
    prototypes decide. Null or empty texts and those without a letter go, whatever their label;
    where no label says a language all others stay as they are. A label ``und`` is a language like
    any other. Repeated rows and ids, null ids and very long texts are judged row by row, ties
    go to the language first by code point, an empty table gives no rows."""
    protos = {f"lang {k}": v for k, v in language_id.trained_on_folds(docs).items()}
    found = F.substr(F.col("lang_pred"), F.lit(len("lang ") + 1)) if protos else F.col("lang")
    protos = protos or {"any": np.zeros(language_id.DIM)}
    return _filtered(docs, lambda d: language_id.identify(d, protos), ["lang_pred", "score"], "lang_pred <> 'und'", lang=found)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every group of equal texts (white space runs count as
    one blank). Null texts equal empty ones, a null id sorts last, of repeated rows one stays,
    texts are compared whole, an empty table gives no rows."""
    return _filtered(docs, exact_dedup.exact_dedup, ["keep_id", "group_size", "kept", "text_sha256"], "kept")


def distinct_grams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every class of near copies; one row too where ids repeat
    or are null. Texts without a word are in no class and stay, similarity of exactly the threshold is a
    copy, texts of any length are compared whole, an empty table gives no rows."""
    row, keep = fresh(docs, "row_no", "keep_no")
    rows = numbered(docs, row)
    kept = ngram_join.ngram_join(rows, row_col=row).where("kept").select(F.col(row).alias(keep))
    return rows.join(kept, F.col(row) == F.col(keep), "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; texts of repeated epochs appear repeatedly. A null
    source is a source, texts without a word go, the text on a source's cut keeps its first words, rows
    may share an id or have none, an empty table gives no rows."""
    return mix_sources.mixed_documents(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every text; ``text`` is what they decode to. A null text counts as empty and
    has no tokens, texts of any length are encoded whole, repeated rows give repeated rows, an empty
    table gives no rows."""
    coded = sentencepiece_codec.encode_decode(docs)
    ids = F.when(F.col("ids_text") == "", F.array().cast("array<int>")).otherwise(F.split("ids_text", ",").cast("array<int>"))
    return coded.select("doc_id", "lang", "source", F.col("decoded").alias("text"), ids.alias("ids"), "n_tokens")


STAGES = [
    ("language_id", identified),
    ("exact_dedup", distinct_texts),
    ("ngram_join", distinct_grams),
    ("mix_sources", mixed),
    ("sentencepiece", tokenized),
]

# Hyperdimensional language profiles and MinHash banding have no SQL form; tests/llm holds
# the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
