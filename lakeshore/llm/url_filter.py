"""URL filter: domain rules, and a path-template tree per host for the rest.

Variable parts of a path (numbers, hashes) become wildcards by form; then, level by level,
segments that take many rare values below one parent become wildcards by count.  The rules'
verdicts label the templates.  From template to branch (the first segment) to host, a node
whose share of blocked urls does not differ significantly from its parent's is merged into
it; a template is rejected by the smoothed purity of the node it ends in.  Only built-in
column functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import saved, work_folder
from lakeshore.sources.tables import read_table

#: Rules of the contract: (verdict, host and beginning of the path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Levels below the host whose segments are generalised by count; deeper ones are by form only.
LEVELS = 4
#: A parent's segments are variable from so many values on, with fewer urls each than this.
MANY_VALUES = 20
FEW_URLS = 3
#: Two-sided 95 % test of a node's share against its parent's.
SIGNIFICANT = 1.96
#: Weight of the overall share in a node's purity, and the purity that rejects.
PRIOR_URLS = 5.0
REJECT_PURITY = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def by_form(path: Column) -> Column:
    """The path with identifiers, hashes and numbers as wildcards."""
    path = F.regexp_replace(path, r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "{u}")
    path = F.regexp_replace(path, r"(?<=/)[0-9a-fA-F]{16,}(?=[/.]|$)", "{h}")
    return F.regexp_replace(path, r"[0-9]+", "{n}")


def templates(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, shape, urls, labelled, blocked; a row per distinct shape) with the
    ``template`` and ``branch`` of each."""
    tree = shapes.withColumns({"parts": F.split("shape", "/"), "before": F.lit("")})
    for level in range(1, LEVELS + 1):
        part = F.get("parts", F.lit(level))
        tree = tree.withColumn("part", part)
        each = tree.where("part IS NOT NULL").groupBy("host", "before", "part").agg(F.sum("urls").alias("urls"))
        variable = (each.groupBy("host", "before").agg(F.count("*").alias("values"), F.sum("urls").alias("total"))
                    .where((F.col("values") >= MANY_VALUES) & (F.col("total") < FEW_URLS * F.col("values")))
                    .select("host", "before", F.lit(True).alias("variable")))
        tree = tree.join(variable, ["host", "before"], "left")
        seen = F.when(F.col("variable"), F.lit("{*}")).otherwise(F.col("part"))
        tree = tree.withColumn("before", F.when(F.col("part").isNull(), F.col("before")).otherwise(F.concat("before", F.lit("/"), seen)))
        tree = tree.drop("variable")
        if level == 1:
            tree = tree.withColumn("branch", F.col("before"))
    rest = F.slice("parts", LEVELS + 2, F.greatest(F.size("parts"), F.lit(1)))
    template = F.when(F.size(rest) > 0, F.concat("before", F.lit("/"), F.array_join(rest, "/"))).otherwise(F.col("before"))
    return tree.withColumn("template", template).drop("parts", "part", "before")


def _alike(n: str, b: str, parent_n: str, parent_b: str) -> Column:
    """Whether a node's share of blocked urls is within the test's bounds of its parent's."""
    share, parent = F.try_divide(b, n), F.try_divide(parent_b, parent_n)
    slack = SIGNIFICANT * F.sqrt(F.try_divide(parent * (1 - parent), F.col(n))) + F.try_divide(F.lit(0.5), F.col(n))
    return F.coalesce(F.abs(share - parent) <= slack, F.lit(False))


def purity(tree: DataFrame) -> DataFrame:
    """``host, template, purity``: the smoothed share of blocked urls of the node that a
    template is merged into; null where neither it nor its branch has a labelled url."""
    leaf = tree.groupBy("host", "branch", "template").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    branch = leaf.groupBy("host", "branch").agg(F.sum("n").alias("n_1"), F.sum("b").alias("b_1"))
    host = branch.groupBy("host").agg(F.sum("n_1").alias("n_2"), F.sum("b_1").alias("b_2"))
    overall = host.agg(F.sum("n_2").alias("n_3"), F.sum("b_2").alias("b_3"))  # one row
    nodes = leaf.join(branch, ["host", "branch"]).join(host, "host").join(F.broadcast(overall))
    up_1 = (F.col("n") == 0) | _alike("n", "b", "n_1", "b_1")
    up_2 = up_1 & _alike("n_1", "b_1", "n_2", "b_2")
    n = F.when(up_2, F.col("n_2")).when(up_1, F.col("n_1")).otherwise(F.col("n"))
    b = F.when(up_2, F.col("b_2")).when(up_1, F.col("b_1")).otherwise(F.col("b"))
    prior = F.try_divide("b_3", "n_3")
    return nodes.select("host", "template", F.when(n > 0, (b + PRIOR_URLS * prior) / (n + PRIOR_URLS)).alias("purity"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``key, host, path, rule, verdict, template, purity`` of every row.

    A null url has empty host and path and is allowed, as is any url whose template has no
    evidence.  Repeated rows count as often as they stand; other columns are ignored.
    """
    spark = pages.sparkSession
    host, path = host_and_path(pages[url])
    urls = pages.select(pages[key].alias("key"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "ruled": verdict, "shape": by_form(F.col("path"))})
    shapes = urls.groupBy("host", "shape").agg(
        F.count("*").alias("urls"), F.count("ruled").alias("labelled"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"))
    folder = work_folder(spark, "url-filter")
    tree = saved(templates(saved(shapes, f"{folder}/shapes")), f"{folder}/tree")
    known = tree.select("host", "shape", "template").join(purity(tree), ["host", "template"])
    method = F.when(F.col("purity") >= REJECT_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(known, ["host", "shape"], "left").select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity")


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return judge(read_table(spark, sf_dir, "pages")).drop("purity")
