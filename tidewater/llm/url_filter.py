"""Operator 7: URL allow/block rules by a sort-merge range join.

A host is keyed by its reversed labels and a closing dot (``www.example.net`` ->
``net.example.www.``), so a rule's host with all subdomains is the key interval
``[rev + '.', rev + '/')`` and intervals nest or are disjoint. Rule hosts and URLs are sorted together,
range-partitioned by key, with a hash behind it so that a common host is split. One sweep per
partition keeps the stack: per depth (number of labels) the rule host last met, which is on the
stack for a URL as long as its interval has not ended; of two intervals of one depth only the later can
be open. What is open at the border of a partition is carried into it from the partitions
before: the last rule host per partition and depth, then per depth the last one of all earlier partitions, put in
front of the partition's rows. So a rule is sent to the partition of its key and to those
that begin inside its interval, never to all. Of the open rules whose path starts the URL's path
the longest wins.

Defined cases: null URL or no ``://`` gives empty host and path and no rule; rules with a
null host never fit, a null path counts as empty; among equally long rules the one with the
longer host wins, then the greater text, then block; repeated rows each get their verdict; URLs of
any length are used whole; columns of the input named like a result are replaced, other clashing names
are kept; an empty table gives no rows, without rules every URL gets the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, fresh, read_table, shuffle_partitions, written

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
PART_ROWS = 200_000


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return F.coalesce(F.when(F.instr(url, "://") > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(F.instr(url, "://") > 0, path), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_hosts(rules: DataFrame) -> DataFrame:
    """``(key, depth, entry)`` per rule host: where its interval starts, its number of labels, and its end with its rules."""
    r = rules.where(F.col("host").isNotNull()).select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct()
    rule = F.struct(F.length(F.concat("host", "path")).alias("len"), F.length("host").alias("host_len"),
                    F.concat("host", "path").alias("rule"), F.col("verdict"), F.col("path"))
    rev = reversed_host(F.col("host"))
    return r.groupBy("host").agg(F.collect_list(rule).alias("rules")).select(
        F.concat(rev, F.lit(".")).alias("key"), F.size(F.split("host", r"\.")).alias("depth"),
        F.struct(F.concat(rev, F.lit("/")).alias("end"), F.col("rules")).alias("entry"))


def borders(sorted_hosts: DataFrame, parts: int, depths: int) -> DataFrame:
    """``(pid, depth, entry)``: per partition and depth the last rule host of all partitions before it."""
    last = sorted_hosts.groupBy("pid", "depth").agg(F.max_by("entry", "key").alias("entry"))
    grid = sorted_hosts.sparkSession.range(parts).select(F.col("id").cast("int").alias("pid"), F.explode(F.sequence(F.lit(1), F.lit(depths))).alias("depth"))
    before = Window.partitionBy("depth").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return (grid.join(last, ["pid", "depth"], "left").withColumn("entry", F.last("entry", ignorenulls=True).over(before))
            .where(F.col("entry").isNotNull()))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every input row and column plus ``host``, ``path``, ``rule`` and ``verdict``."""
    spark = pages.sparkSession
    parts = max(shuffle_partitions(spark), -(-pages.count() // PART_ROWS))
    key, kind, salt, depth, entry, pid, stack, host, path = fresh(
        pages, "key", "kind", "salt", "depth", "entry", "pid", "stack", "host", "path")
    hosts = written(rule_hosts(rules), "url-rules")
    depths = hosts.agg(F.max("depth")).first()[0] or 0
    urls = (pages.withColumn(host, host_of(F.col(url_col))).withColumn(path, path_of(F.col(url_col)))
            .withColumn(key, F.concat(reversed_host(F.col(host)), F.lit(".")))
            .withColumn(kind, F.lit(1)).withColumn(salt, F.xxhash64(F.monotonically_increasing_id())))
    starts = hosts.select(F.col("key").alias(key), F.col("depth").alias(depth), F.col("entry").alias(entry),
                          F.lit(0).alias(kind), F.lit(0).cast("long").alias(salt))
    dealt = written(urls.unionByName(starts, allowMissingColumns=True).repartitionByRange(parts, key, kind, salt)
                    .withColumn(pid, F.spark_partition_id()), "url-ranges")
    met = dealt.where(F.col(kind) == 0).select(F.col(pid).alias("pid"), F.col(depth).alias("depth"), F.col(entry).alias("entry"), F.col(key).alias("key"))
    carried = borders(met, parts, depths).select(
        F.col("pid").alias(pid), F.col("depth").alias(depth), F.col("entry").alias(entry), F.lit(-1).alias(kind)) if depths else None
    rows = dealt.unionByName(carried, allowMissingColumns=True) if carried is not None else dealt
    sweep = Window.partitionBy(pid).orderBy(F.col(kind) >= 0, key, kind).rowsBetween(Window.unboundedPreceding, 0)
    levels = [F.last(F.when(F.col(depth) == d, F.col(entry)), ignorenulls=True).over(sweep) for d in range(1, depths + 1)]
    swept = rows.withColumn(stack, F.array(*levels) if levels else F.array().cast("array<struct<end:string,rules:array<struct<"
                            "len:int,host_len:int,rule:string,verdict:string,path:string>>>>")).where(F.col(kind) == 1)
    open_ = F.flatten(F.transform(F.filter(F.col(stack), lambda e: e["end"] > F.col(key)), lambda e: e["rules"]))
    best = F.array_max(F.filter(open_, lambda r: F.startswith(F.col(path), r["path"])))
    out = {"host": F.col(host), "path": F.col(path), "rule": best["rule"],
           "verdict": F.coalesce(best["verdict"], F.lit(default))}
    keep = [c for c in pages.columns if c.lower() not in out]
    return swept.select(*keep, *[v.alias(k) for k, v in out.items()])


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES])))
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).drop("url")


QUERIES = {"op7_url_filter": op7_url_filter}
ORACLE = {"op7_url_filter": r"""
    WITH rules(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
    u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    m AS (SELECT u.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                 arg_max(rverdict, length(rhost || rpath)) AS verdict
          FROM u JOIN rules ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)
          GROUP BY u.page_id)
    SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
    FROM u LEFT JOIN m USING (page_id)"""}
