"""URL filters: sort-merge range join of host and path prefixes, DataFrame functions only.

A rule (host, path) becomes the canonical key ``reversed host labels + NUL + path``; what it fits is the interval
of keys that start with it. A URL gives one point for each host suffix as deep as some rule's host. Rules and points
are range-partitioned on the key by sampled splitters, written, and swept in order: the last rule that began holds
the stack of rules nested around it, and the deepest one whose interval is still open fits the point. A rule that is
open across a partition's edge is handed on as the partition's first stack.

Equal keys are spread by row number, so a host or a whole URL that holds a third of all rows is cut by the
splitters like any other range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import save, table

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# What holds for a URL that no rule fits.
OTHERWISE = "allow"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = "\u0000"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit(_GAP), path)


def nested_rules(rules: DataFrame) -> DataFrame:
    """Each rule's key with the stack of rules around it, outermost first, itself last.

    ``rules`` has columns verdict, host, path. Null rules are left out; of rules with the same host and path
    ``block`` wins.
    """
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    one = (
        rules.where("host is not null and path is not null and verdict is not null")
        .select(host.alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", _key(F.split("host", r"\."), F.col("path")))
    )
    entry = F.struct(
        F.length("key").alias("depth"), "key", F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "verdict"
    )
    around = one.select(F.col("key").alias("outer"), entry.alias("entry"))
    prefixes = one.select("key", F.explode(F.expr("transform(sequence(1, length(key)), n -> substring(key, 1, n))")).alias("outer"))
    return prefixes.join(around, "outer").groupBy("key").agg(F.sort_array(F.collect_list("entry")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    The longest rule wins (host and path together; at the same length the longer host). Null URLs and those
    without ``://`` have an empty host and path, fit no rule and get ``otherwise``, like all others that none fits. Repeated rows are
    judged each for itself; an empty table or an empty rule table is no special case.
    """
    stacks = save(nested_rules(rules), "url-rules")
    depth = F.size(F.split(F.substring_index("key", _GAP, 1), r"\."))
    depths = [r[0] for r in stacks.select(depth.alias("d")).distinct().orderBy("d").collect()]  # depths of hosts: a few small numbers

    judged = pages.select(F.col("page_id").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    suffix = lambda d: F.when(F.size(labels) >= d, _key(F.slice(labels, F.size(labels) - d + 1, d), F.col("path")))
    hosts = stacks.select(F.substring_index("key", _GAP, 1).alias("rule_host")).distinct()
    keys = F.array(*[suffix(d) for d in depths]) if depths else F.expr("cast(array() as array<string>)")
    points = judged.withColumn("key", F.explode_outer(F.filter(keys, lambda k: k.isNotNull())))
    # A point below no rule's host cannot fit, but its page must stay: it is kept without a key.
    known = points.withColumn("rule_host", F.substring_index("key", _GAP, 1)).join(
        hosts.withColumn("has_rules", F.lit(True)), "rule_host", "left"
    )
    kept = known.withColumn("key", F.when(F.col("has_rules"), F.col("key"))).drop("rule_host", "has_rules")

    begun = stacks.select(
        F.lit(None).cast("long").alias("row"), F.lit(None).cast(judged.schema["page_id"].dataType).alias("page_id"),
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "key", "stack",
    )
    lines = kept.select("row", "page_id", "host", "path", "key", F.lit(None).cast(begun.schema["stack"].dataType).alias("stack"))
    order = [F.col("key").asc_nulls_last(), F.col("row").asc_nulls_first()]
    ranges = save(
        lines.unionByName(begun).repartitionByRange(*order).withColumn("bucket", F.spark_partition_id()), "url-ranges"
    )

    last = ranges.where("stack is not null").groupBy("bucket").agg(F.max_by("stack", "key").alias("ending"))
    edges = ranges.select("bucket").distinct().join(last, "bucket", "left")  # one row for each partition
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select("bucket", F.last("ending", ignorenulls=True).over(before).alias("carried"))
    swept = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    current = F.coalesce(F.last("stack", ignorenulls=True).over(swept), F.col("carried"))
    fitting = F.expr("try_element_at(filter(current, r -> startswith(key, r.key)), -1)")
    fitted = ranges.join(carried, "bucket").withColumn("current", current).where("row is not null").select(
        "row", "page_id", "host", "path", fitting.alias("fit")
    )
    best = F.max(F.when(F.col("fit").isNotNull(), F.struct(F.length("fit.rule").alias("length"), F.col("fit.host_length").alias("h"), F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"))))
    return (
        fitted.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
    )


def rule_table(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return spark.sql(f"select * from values {rows} as t(verdict, host, path)")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))


def op9_sql() -> str:
    """Every rule against every URL: the same rules without a range join."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""
with u as (
  select row_number() over () as row, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages
), r as (select * from (values {rules}) as t(v, h, p)
), m as (
  select u.row, arg_max(h || p, length(h || p) * 1000 + length(h)) as rule, arg_max(v, length(h || p) * 1000 + length(h)) as v
  from u join r on (host = h or host like '%.' || h) and starts_with(path, p) group by u.row
)
select page_id, host, path, rule, coalesce(v, '{OTHERWISE}') as verdict from u left join m using (row)"""
