"""URL filters as a sort-merge range join.

A rule is (action, host, path): it fits its host and all subdomains of it, on
paths that start with the rule's path; the longest rule that fits wins. A url
has one key for each suffix of its host, written with reversed labels
(``com.example.www``), followed by the path. On such a key a rule covers one
interval: the paths that its own path begins. Rules and urls of a host are
sorted by path; as the sweep passes a rule it carries the rule's stack (the
rule and those that enclose it), and at a url the active rule is the deepest
of the last stack whose path still begins the url's path.

Only DataFrame functions. Distinct (host, path) pairs are judged once, on no
more suffixes than the longest rule has labels. Urls are counted per suffix with
partial sums; they meet those counts by suffix and a share of ``SPREAD``, so that
no suffix is one task's. A host with many urls is spread over groups of about
``rows_per_group`` urls, and its rules are copied to each of those groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii

#: Shares of a suffix's urls in the join with the suffix's count; skewed shares are split by Spark.
SPREAD = 64


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: the host after the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A-Z lower-cased; the path from there up to ``?``,
    ``#`` or the end. Null or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, path, stack): the stack holds this rule and the rules of the same
    host whose paths begin its path, shortest first, as structs (path, rule,
    action). Of equal rules the alphabetically first action stays."""
    host = lower_ascii(F.coalesce("host", F.lit("")))
    r = (rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action")
         .groupBy("host", "path").agg(F.min("action").alias("action"))
         .where(F.col("action").isNotNull() & (F.col("host") != "")))
    r = r.select(reversed_host(F.col("host")).alias("key"), "path",
                 F.struct("path", F.concat("host", "path").alias("rule"), "action").alias("item"))
    begun = r.select("key", F.col("path").alias("full"), F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("path"))
    return (begun.join(r, ["key", "path"]).groupBy("key", F.col("full").alias("path"))
            .agg(F.sort_array(F.collect_list("item")).alias("stack")))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
          rows_per_group: int = 4096) -> DataFrame:
    """``pages`` with host, path, rule and verdict. ``rules`` has action, host
    and path; ``default`` is the verdict where no rule fits (rule is then
    null). Columns of ``pages`` with those four names are replaced; others
    stay. Repeated rows stay repeated; null or malformed urls get the default;
    an empty rule table gives every page the default.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = url_parts(F.col(url))
    parsed = pages.withColumns({"host": host, "path": path}).select(*keep, "host", "path")
    targets = parsed.select("host", "path").distinct()

    stacks = rule_stacks(rules)
    longest = stacks.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    levels = F.when((F.col("host") == "") | F.lit(longest == 0), F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(longest))))
    keyed = (targets.withColumn("labels", labels)
             .select("host", "path", "labels", F.explode(levels).alias("n"))
             .withColumn("key", F.array_join(F.reverse(F.slice("labels", -F.col("n"), F.col("n"))), "."))
             .select("key", "host", "path"))

    groups = (keyed.groupBy("key").agg((F.floor(F.count(F.lit(1)) / rows_per_group) + 1).alias("groups"))
              .join(stacks.select("key").distinct(), "key"))
    shares = groups.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    salted = (keyed.withColumn("share", F.pmod(F.xxhash64("path", "host"), F.lit(SPREAD)).cast("int"))
              .join(shares, ["key", "share"])
              .select("key", F.pmod(F.xxhash64("host", "path"), "groups").alias("salt"), "host", "path",
                      F.lit(1).alias("kind"), F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")))
    starts = (stacks.join(groups, "key")
              .select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)).alias("salt"),
                      F.lit("").alias("host"), "path", F.lit(0).alias("kind"), "stack"))
    sweep = Window.partitionBy("key", "salt").orderBy("path", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # by key alone the window would be satisfied with all of a host in one task
    swept = (salted.unionByName(starts).repartition("key", "salt")
             .withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
             .where("kind = 1"))
    active = F.filter("stack", lambda s: F.startswith(F.col("path"), s["path"]))
    top = F.element_at(active, -1)
    best = (swept.where(F.size(active) > 0)
            .select("host", "path", F.struct(F.length(top["rule"]).alias("n"), top["rule"].alias("rule"),
                                             top["action"].alias("action")).alias("top"))
            .groupBy("host", "path").agg(F.max("top").alias("top")))
    return parsed.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("top.rule").alias("rule"),
        F.coalesce(F.col("top.action"), F.lit(default)).alias("verdict"))
