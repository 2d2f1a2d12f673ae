"""Top-k over attribute lines (``<row Id="…" Reputation="…" … />``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed attribute names read by the top-ten program.
ID_ATTR = "Id"
SCORE_ATTR = "Reputation"


def attribute(value: Column, name: str) -> Column:
    """Value of ``name="…"`` in an attribute line, null when absent."""
    pattern = rf'\s{name}="([^"]*)"'
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, 1))


def attribute_map(value: Column) -> Column:
    """All ``key="value"`` pairs of a line as a map; a key is whatever stands between white space
    and ``=`` (``xml:lang``, ``data-id``). Of a repeated key the last value stays,
    a line without pairs (or null) gives an empty map."""
    line = F.coalesce(value, F.lit(""))
    names = F.regexp_extract_all(line, F.lit(r'([^\s="]+)="[^"]*"'), F.lit(1))
    values = F.regexp_extract_all(line, F.lit(r'[^\s="]+="([^"]*)"'), F.lit(1))
    pairs = F.zip_with(names, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), p["k"]))
    return F.map_from_entries(last)


def scored_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(id, score, value)`` for lines that carry both attributes; others are skipped. Ids
    are kept as text; a score that is no whole number stops the job."""
    v = F.col(col)
    return (
        lines.select(
            attribute(v, ID_ATTR).alias("id"), attribute(v, SCORE_ATTR).alias("score"), v.alias("value"),
        )
        .filter(F.col("id").isNotNull() & F.col("score").isNotNull())
        .withColumn("score", F.coalesce(F.col("score").try_cast("bigint"), F.raise_error(
            F.concat(F.lit("not a whole number: "), F.col("score"))).cast("bigint")))
    )


def id_order(id_col: str = "id") -> Column:
    """Numeric ids by value before the others by text."""
    number = F.col(id_col).try_cast("decimal(38,0)")
    return F.struct(number.isNull().alias("text"), number.alias("number"), F.col(id_col).alias("id"))


def top_distinct_scores(records: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest *distinct* scores with one record each (the highest id, of equal ids
    the greatest line), descending. Partial aggregation leaves one row per score and task."""
    best = F.max_by(F.struct("id", "value"), F.struct(id_order().alias("by"), "value")).alias("best")
    per_score = records.groupBy("score").agg(best).select("score", "best.id", "best.value")
    return per_score.orderBy(F.desc("score")).limit(n)


def top_records(records: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest-scoring records, equal scores ordered by id."""
    return records.orderBy(F.desc("score"), id_order().asc()).limit(n)
