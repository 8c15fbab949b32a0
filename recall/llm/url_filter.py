"""URL filter: rules first, then a path-template tree judged by smoothed labelled purity.

All of it is DataFrame operations.  Level by level, down to the deepest path, a segment below (host, template so far) stays
literal if it has ``SUPPORT`` pages, is no number, and its share of good labels differs significantly from that of the
rest of its parent; all others become ``*``.  Literal branches of one parent whose shares are alike (they fall into the
same of ``ALIKE`` steps of the arcsine scale, on which a share's error does not depend on it) are merged into one branch,
named by its first segment and the number of the others.  A template whose labels all agree is not divided further.
The purity of a final template is its share of good labelled pages, smoothed towards its host, which is smoothed towards
all pages.

Every step is a sum by key (added up in each task first) and a join of its small result on host, template and
segment; a join that a hot host makes uneven is split by adaptive execution, since nothing above it needs the
rows of a key together.  Each level's result is written, so that plans stay small.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: (verdict, rule), a rule being host and path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: A segment stays literal from this count of pages on.
SUPPORT = 5
#: Steps of the arcsine scale; literal branches of one step are merged.
ALIKE = 6
#: Standard errors by which a branch differs from its parent, else it is merged.
DIFFERS = 1.96
#: Labelled pages that the prior counts as; templates of a lower purity are blocked.
PRIOR, LEAST = 10.0, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z as a-z) and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (its host or a subdomain, its path a prefix), and its verdict; null if none does."""
    name = verdict = None
    for does, rule in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, does) if verdict is None else verdict.when(fits, does)
    return name, verdict


def _level(rows: DataFrame, level: int) -> DataFrame:
    """``rows`` with column ``t`` of open templates extended by the generalised segment of one level."""
    sums = [F.sum("n").alias("n"), F.sum("rated").alias("rated"), F.sum("good").alias("good")]
    live = rows.filter("open").withColumn("seg", F.coalesce(F.try_element_at("segs", F.lit(level)), F.lit("")))
    child = live.groupBy("host", "t", "seg").agg(*sums)
    parent = child.groupBy("host", "t").agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "rated", "good")))
    both = child.join(parent, ["host", "t"])
    number = F.col("seg").rlike(r"^[0-9]+(\.[A-Za-z]+)?$")
    share = F.try_divide(F.col("all_good"), F.col("all_rated"))
    rest = F.col("all_rated") - F.col("rated")
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), F.col("rated")) + F.try_divide(F.lit(1.0), rest)))
    gap = F.abs(F.try_divide(F.col("good"), F.col("rated")) - F.try_divide(F.col("all_good") - F.col("good"), rest))
    differs = F.coalesce(gap > DIFFERS * error, F.lit(False))
    step = F.floor(F.round(F.asin(F.sqrt((F.col("good") + 1) / (F.col("rated") + 2))) / F.lit(math.pi / 2 / ALIKE), 9))
    literal = both.filter((F.col("n") >= SUPPORT) & ~number & differs).select("host", "t", "seg", step.alias("step"))
    merged = literal.groupBy("host", "t", "step").agg(F.min("seg").alias("first"), F.count("*").alias("k"))
    name = F.concat("first", F.when(F.col("k") > 1, F.concat(F.lit(" +"), (F.col("k") - 1).cast("string"))).otherwise(""))
    kept = literal.join(merged, ["host", "t", "step"]).select("host", "t", "seg", name.alias("name"))
    out = live.join(kept, ["host", "t", "seg"], "left")
    ended = F.size("segs") < level
    t = F.when(ended, F.col("t")).otherwise(F.concat("t", F.lit("/"), F.coalesce("name", F.lit("*"))))
    return out.select("host", "segs", "n", "rated", "good", t.alias("t"), (~ended).alias("open"))


def _opened(rows: DataFrame, level: int) -> DataFrame:
    """``rows`` whose ``open`` says whether their template has deeper paths, enough pages, and labels that disagree."""
    per = rows.filter("open").groupBy("host", "t").agg(F.sum("n").alias("n"), F.sum("rated").alias("rated"), F.sum("good").alias("good"), F.max(F.size("segs")).alias("deep"))
    per = per.filter((F.col("deep") > level) & (F.col("n") >= SUPPORT) & (F.col("good") > 0) & (F.col("good") < F.col("rated")))
    per = per.select("host", "t", F.lit(True).alias("again"))
    return rows.join(per, ["host", "t"], "left").select("host", "segs", "n", "rated", "good", "t", (F.col("open") & F.coalesce("again", F.lit(False))).alias("open"))


def url_filter(pages: DataFrame, ratings: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, template, purity.

    ``ratings`` (page_id, good boolean) labels some pages; of several ratings of a page the worst counts.

    A null url, or one without ``://``, has empty host and path, fits no rule and is judged with all such urls.
    Without any rating every template has purity 1 and is allowed.  Of rules that fit the longest wins, and of equally long
    ones, which can only differ by host, the first by name; a purity of exactly ``LEAST`` is allowed.  Repeated rows count
    as often as they occur and get equal results; a null page_id has no rating.  A url of any length is read whole, its
    path to the last segment.  Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rated = ratings.select(F.col("page_id").cast("long").alias("page_id"), F.col("good").cast("int").alias("good")).dropna().groupBy("page_id").agg(F.min("good").alias("good"))
    rows = rows.join(rated, "page_id", "left")
    rows = rows.withColumn("segs", F.split(F.substring("path", 2, 1 << 30), "/"))
    shapes = rows.groupBy("host", "segs").agg(F.count("*").alias("n"), F.count("good").alias("rated"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    tree = shared.save(_opened(shapes.withColumns({"t": F.lit(""), "open": F.lit(True)}), 0), "shapes")
    done: list[DataFrame] = []
    level = 0
    while not tree.filter("open").isEmpty():  # as often as the deepest template whose labels disagree has segments
        level += 1
        deeper = shared.save(_opened(_level(tree, level), level), "shapes")
        done.append(tree.filter(~F.col("open")))
        tree = deeper
    tree = shared.save(reduce(DataFrame.unionByName, done, tree), "tree")
    leaf = tree.groupBy("host", "t").agg(F.sum("rated").alias("rated"), F.sum("good").alias("good"))
    leaf = shared.save(leaf, "templates")
    hosts = leaf.groupBy("host").agg(F.sum("rated").alias("host_rated"), F.sum("good").alias("host_good"))
    all_ = hosts.agg(F.coalesce(F.try_divide(F.sum("host_good"), F.sum("host_rated")), F.lit(1.0)).alias("all_share"))
    hosts = hosts.crossJoin(F.broadcast(all_))  # one row
    prior = (F.col("host_good") + PRIOR * F.col("all_share")) / (F.col("host_rated") + PRIOR)
    judged = leaf.join(hosts, "host").select("host", "t", F.round((F.col("good") + PRIOR * prior) / (F.col("rated") + PRIOR), 9).alias("purity"))
    of = shared.save(tree.select("host", "segs", "t").join(judged, ["host", "t"]), "judged")
    shared.forget(tree)
    shared.forget(leaf)
    out = rows.select("page_id", "host", "path", "segs").join(of, ["host", "segs"])
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < LEAST, "block").otherwise("allow")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.concat("host", "t").alias("template"), "purity")


def page_ratings(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Ratings of pages from labels of documents: the last number in a page's path is the id of its document."""
    _, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"([0-9]{1,18})[^0-9]*$", 1).try_cast("long")
    of = pages.select("page_id", number.alias("doc_id")).filter(F.col("doc_id").isNotNull())
    good = ((F.col("quality") > 0) & (F.coalesce(F.col("toxic"), F.lit(0)) <= 0)).alias("good")
    return of.join(labels.select("doc_id", good), "doc_id").select("page_id", "good")
