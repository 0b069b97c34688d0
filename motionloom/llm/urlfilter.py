"""URL filter with a path-template tree for each host, in DataFrame expressions alone.

Rules decide the URLs that they fit and label them.  For the others, a tree of path templates is grown for each host, level by level:
a segment stays as it is if its node has few distinct segments of its shape or if it holds a good share of them, and becomes the shape's
wildcard otherwise.  Literals of a node are therefore bounded in number, whatever the pages are.  From the deepest level up, branches
under one parent are compared with what all branches of that parent hold together: a branch whose templates are distributed like the
whole (chi-squared) and whose labels do not contradict the whole's (normal test) is statistically similar, and similar branches merge.
A template is rejected if the share of blocked pages among its labelled ones, smoothed towards one half, is high enough; its unlabelled
pages are then blocked.  A template without enough evidence rejects nothing.

Pages are counted before they are shuffled; the templates of a host, bounded in number, are all that is compared.  Lookups by node go
through the library's ``attach``, which sends small tables to all tasks and salts crowded keys of large ones.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.operators.layout import attach

from .tables import stored

# The rules and what they say.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DEPTH = 3
#: Distinct segments of a shape that a node keeps, and the share of them that a segment needs beyond that.
FEW, SHARE = 16, 0.05
#: Shapes longer than this are one shape.
LONGEST_SHAPE = 12
#: Standard deviations that a similar branch may be off, weight of the even prior, and purity that rejects.
DEVIATIONS, PRIOR_WEIGHT, PUREST = 2.33, 10.0, 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of a URL; empty for NULL and without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits; of equally long ones, one that blocks, then the first in text order."""
    found = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[1] != "block", r[0])):
        domain, slash, prefix = rule.partition("/")
        found.append(F.when(((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + prefix)), F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def shape(segment: Column) -> Column:
    """Runs of digits as 0, other runs between punctuation as A."""
    plain = F.regexp_replace(F.regexp_replace(segment, "[0-9]+", "0"), "[^-_.%+=,;:@0]+", "A")
    return F.when(F.length(plain) > LONGEST_SHAPE, F.lit("X")).otherwise(plain)


def _judged(pages: DataFrame, rules) -> DataFrame:
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    says = F.coalesce(*(F.when(F.col("rule") == rule, F.lit(verdict)) for rule, verdict in rules), F.lit(None).cast("string"))
    return rows.withColumn("said", says)


def templates(judged: DataFrame) -> DataFrame:
    """``judged`` (host, path, ...) with t1 to t{DEPTH}, a literal, a wildcard or NULL beyond the path's end, and ``tail``."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = judged.withColumn("_s", F.when(F.col("path") != "", segments).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("tail", F.when(F.size("_s") > DEPTH, F.lit("**")).otherwise("")).withColumn("_node", F.lit(""))
    for level in range(1, DEPTH + 1):
        segment = F.get("_s", F.lit(level - 1))
        rows = rows.withColumn("_seg", segment).withColumn("_shape", shape(F.col("_seg")))
        counted = rows.filter("_seg is not null").groupBy("host", "_node", "_shape", "_seg").agg(F.count("*").alias("_n"))
        counted = stored(counted, "segments")
        nodes = counted.groupBy("host", "_node", "_shape").agg(F.sum("_n").alias("_all"), F.count("*").alias("_distinct"))
        known = attach(counted, nodes, ["host", "_node", "_shape"], "inner", costly=True)
        literal = known.filter((F.col("_distinct") < FEW) | (F.col("_n") >= SHARE * F.col("_all"))).select("host", "_node", "_seg", F.lit(True).alias("_kept"))
        rows = attach(rows, literal, ["host", "_node", "_seg"], costly=True)
        name = F.when(F.col("_kept"), F.col("_seg")).when(F.col("_seg").isNotNull(), F.concat(F.lit("<"), "_shape", F.lit(">")))
        rows = rows.withColumn(f"t{level}", name).withColumn("_node", F.concat_ws("/", "_node", F.coalesce(F.col(f"t{level}"), F.lit("")))).drop("_kept")
        rows = stored(rows, "level")
    return rows.drop("_s", "_seg", "_shape", "_node")


def tree(placed: DataFrame) -> DataFrame:
    """One row for each host and template: pages, labelled and blocked of it, and m1 to m{DEPTH}, the template after merging."""
    names = [f"t{k}" for k in range(1, DEPTH + 1)]
    # A path that ends before a level and one with an empty segment there are one template.
    rows = placed.withColumns({t: F.coalesce(F.col(t), F.lit("")) for t in names})
    rows = rows.groupBy("host", *names, "tail").agg(F.count("*").alias("pages"), F.count("said").alias("labelled"), F.count_if(F.col("said") == "block").alias("blocked"))
    for k, t in enumerate(names, 1):
        rows = rows.withColumn(f"m{k}", F.col(t))
    for level in range(DEPTH, 0, -1):
        above = ["host", *(f"m{k}" for k in range(1, level))]
        branch, rest = f"m{level}", [*(f"m{k}" for k in range(level + 1, DEPTH + 1)), "tail"]

        def over(value: Column, *by: str) -> Column:
            return value.over(Window.partitionBy(*by))

        n = F.sum("pages")
        rows = rows.withColumns({"_cell": over(n, *above, branch, *rest), "_branch": over(n, *above, branch), "_pool": over(n, *above, *rest), "_all": over(n, *above),
                                 "_kinds": F.size(over(F.collect_set(F.struct(*rest)), *above)),
                                 "_l": over(F.sum("labelled"), *above, branch), "_b": over(F.sum("blocked"), *above, branch),
                                 "_pl": over(F.sum("labelled"), *above), "_pb": over(F.sum("blocked"), *above)})
        # Over cells: observed squared over expected; a row brings its part of its cell.
        part = F.col("pages").cast("double") * F.col("_cell") * F.col("_all") / (F.col("_branch").cast("double") * F.col("_pool"))
        rows = rows.withColumn("_chi", over(F.sum(part), *above, branch) - F.col("_branch"))
        freedom = F.col("_kinds") - 1
        expected = (F.col("_pb") + 1.0) / (F.col("_pl") + 2.0)
        agree = (F.col("_l") == 0) | (F.abs(F.col("_b") / F.col("_l") - expected) <= DEVIATIONS * F.sqrt(expected * (1 - expected) / F.col("_l")))
        alike = (F.col(branch) != "") & (F.col("_chi") <= freedom + DEVIATIONS * F.sqrt(2.0 * freedom) + 1e-6) & agree
        rows = rows.withColumn("_alike", alike)
        several = F.size(over(F.collect_set(F.when(F.col("_alike"), F.col(branch))), *above)) > 1
        rows = rows.withColumn(branch, F.when(F.col("_alike") & several, F.lit("*")).otherwise(F.col(branch)))
        rows = rows.select("host", *names, "tail", "pages", "labelled", "blocked", *(f"m{k}" for k in range(1, DEPTH + 1)))
    return rows


def rejected(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`tree` with the smoothed purity of their merged template and whether it is rejected."""
    merged = Window.partitionBy("host", *(f"m{k}" for k in range(1, DEPTH + 1)), "tail")
    purity = (F.sum("blocked").over(merged) + PRIOR_WEIGHT / 2) / (F.sum("labelled").over(merged) + PRIOR_WEIGHT)
    return rows.withColumn("purity", purity).withColumn("rejected", F.col("purity") >= PUREST)


def judged_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """Every row of ``pages`` (page_id, url) with host, path, rule, verdict and template (NULL parts left out).

    A NULL URL or one without ``://`` has an empty host and path, so its rule is NULL.  Repeated rows count as often as they occur.
    Ties between rules are settled in ``fitting_rule``; page ids may be NULL or repeat.  Very long segments have one shape.  Other
    columns are ignored, and an empty table gives an empty result.
    """
    placed = templates(_judged(pages, rules))
    names = [f"t{k}" for k in range(1, DEPTH + 1)]
    found = stored(rejected(tree(placed)), "tree").filter("rejected").select("host", *(F.col(t).alias(f"_{t}") for t in names), "tail", "rejected")
    keyed = placed.withColumns({f"_{t}": F.coalesce(F.col(t), F.lit("")) for t in names})
    told = attach(keyed, found, ["host", *(f"_{t}" for t in names), "tail"], costly=True)
    template = F.concat_ws("/", *names, F.nullif("tail", F.lit("")))
    return told.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("rejected"), F.lit("block")).otherwise("allow")).alias("verdict"), template.alias("template"))
