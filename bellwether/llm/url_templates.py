"""Operator 11, URL filters: a tree of path templates per host (native).

A url is judged by the longest rule that fits it.  The urls that rules judge
are the labelled ones; all urls, labelled or not, form the tree:

1. Descent, level by level.  A node of a host's tree has a child for each
   segment.  Segments that are numbers (with or without a file ending) or
   long hexadecimal strings are the wildcard ``*``; where a node has more
   than ``MANY`` kinds of segments, and more than the square root of its
   urls, those that hold under a tenth of its urls are too.  Below level
   ``DEPTH`` the rest of a path is the one wildcard ``**``.
2. Merging, from the leaves up.  A literal branch is compared with all of
   its siblings together: the distribution over the templates below it
   (chi-square test of homogeneity) and the labels (the same test; a branch
   with labels is not like one without).  Branches that differ in neither
   become one branch ``~``.  Every branch is compared with a sum, never with
   each other branch.
3. Purity.  A template's share of blocked among its labelled urls, smoothed
   by ``STRENGTH`` urls of the overall share; from ``REJECT`` on the template
   is rejected, and its urls that no rule fits are blocked.  A template
   without blocked urls is never rejected.

DataFrame functions only.  Urls are counted before they are shuffled, and
look-ups go through a join that broadcasts the boundedly many hot keys.

Defined cases: null urls and urls without ``://`` have the host and path
``''``, which is a host like others; an empty path has the template of no
segments; a single ``/`` at the end of a path plays no part in its template;
very long paths are kept whole in the result, and their template ends in
``**``; ties between rules of one length go to the longer host; repeated
rows are judged each; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import lookup_join, materialize

#: The rules of the contract (host and path, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
DEPTH = 6
MANY = 8
CRITICAL = 3.0902             # normal quantile of the tests' level, 0.001
CRITICAL_LABELS = 10.828      # chi-square quantile of the same level, one degree of freedom
STRENGTH = 2.0
REJECT = 0.9
NUMBER = "^[0-9]+([.][A-Za-z0-9]+)?$"
HEX = "^[0-9A-Fa-f-]{8,}$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    parts = "^([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(rest, parts, 1), _UPPER, _LOWER), F.regexp_extract(rest, parts, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null: none fits).  ``rules`` are constants of the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):     # the longest is tested first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    bare = F.regexp_replace(path, "^/|/$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "/"))


def _token(segment: Column) -> Column:
    """``*`` or the literal segment (written with a slash, so that no literal is taken for a wildcard)."""
    variable = segment.rlike(NUMBER) | (segment.rlike(HEX) & segment.rlike("[0-9]"))
    return F.when(variable, F.lit("*")).otherwise(F.concat(F.lit("/"), segment))


def grow(urls: DataFrame) -> DataFrame:
    """``urls`` (host, path, n, a, b) with ``tmpl``, the tokens of its path's template."""
    rows = materialize(urls.select("*", segments(F.col("path")).alias("segs"),
                                   F.array().cast("array<string>").alias("tmpl")), "urls")
    done = []
    for level in range(1, DEPTH + 2):
        done.append(rows.where(F.size("segs") < level))
        active = rows.where(F.size("segs") >= level)
        if level > DEPTH:
            done.append(active.withColumn("tmpl", F.concat("tmpl", F.array(F.lit("**")))))
            break
        active = materialize(active.withColumn("s", _token(F.get("segs", F.lit(level - 1)))).withColumn(
            "prefix", F.array_join("tmpl", "")), "level")
        node = ["host", "prefix"]
        kids = materialize(active.groupBy(*node, "s").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("n_rows")), "kids")
        n_rows, n_kids = kids.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.count(F.lit(1))).first()
        if not n_kids:
            break
        nodes = materialize(kids.groupBy(*node).agg(
            F.sum("m").alias("node_n"), F.count_if(F.col("s") != "*").alias("kinds"), F.count(F.lit(1)).alias("n_kids")),
            "nodes")
        rare = ((F.col("s") != "*") & (F.col("kinds") > MANY) & (F.col("kinds") * F.col("kinds") > F.col("node_n"))
                & (F.col("m") * 10 < F.col("node_n")))
        told = materialize(lookup_join(kids, nodes, node, "n_kids", n_kids).select(
            *node, "s", F.when(rare, F.lit("*")).otherwise(F.col("s")).alias("token"), "n_rows"), "tokens")
        stepped = lookup_join(active, told, [*node, "s"], "n_rows", n_rows)
        rows = materialize(stepped.withColumn("tmpl", F.concat("tmpl", F.array("token"))).select(*rows.columns), "urls")
    return reduce(DataFrame.unionByName, done)


def _alike(chi: Column, freedom: Column) -> Column:
    """Is a chi-square value under its critical value (Wilson and Hilferty's approximation)?"""
    part = F.lit(2.0) / (F.lit(9.0) * freedom)
    return (freedom == 0) | (chi <= freedom * F.pow(F.lit(1.0) - part + F.lit(CRITICAL) * F.sqrt(part), F.lit(3.0)))


def merge(templates: DataFrame) -> DataFrame:
    """``templates`` (host, tmpl, n, a, b) with ``merged``, the tokens after like branches became one."""
    table = materialize(templates.withColumn("merged", F.col("tmpl")), "templates")
    deepest = table.agg(F.coalesce(F.max(F.size("tmpl")), F.lit(0))).first()[0]
    node = ["host", "prefix"]
    for level in range(min(deepest, DEPTH), 0, -1):
        placed = table.select(
            "*", F.array_join(F.slice("merged", 1, level - 1), "").alias("prefix") if level > 1 else F.lit("").alias("prefix"),
            F.get("merged", F.lit(level - 1)).alias("tok"),
            F.array_join(F.expr(f"slice(merged, {level + 1}, greatest(size(merged) - {level}, 0))"), "").alias("suffix"))
        cells = placed.where(F.col("tok").startswith("/")).groupBy(*node, "tok", "suffix").agg(
            *[F.sum(c).alias(c) for c in ("n", "a", "b")])
        cells = materialize(cells, "cells")
        below = cells.groupBy(*node, "suffix").agg(F.sum("n").alias("pool_n"))
        branch = cells.groupBy(*node, "tok").agg(*[F.sum(c).alias(f"own_{c}") for c in ("n", "a", "b")])
        whole = branch.groupBy(*node).agg(F.count(F.lit(1)).alias("branches"),
                                          *[F.sum(f"own_{c}").alias(f"all_{c}") for c in ("n", "a", "b")])
        kinds = below.groupBy(*node).agg((F.count(F.lit(1)) - 1).cast("double").alias("freedom"))
        many = whole.where("branches > 1").join(kinds, node)
        facts = branch.join(many, node)
        x, pool = F.col("n").cast("double"), F.col("pool_n").cast("double")
        own, rest = F.col("own_n").cast("double"), (F.col("all_n") - F.col("own_n")).cast("double")
        y = pool - x
        joined = cells.select(*node, "tok", "suffix", "n").join(below, [*node, "suffix"]).join(facts, [*node, "tok"])
        term = (x * rest - y * own) * (x * rest - y * own) / (own * rest * pool)
        tests = joined.groupBy(*node, "tok").agg(
            (F.sum(term) + F.max(own / rest) * (F.max(rest) - F.sum(y))).alias("chi"), F.max("freedom").alias("freedom"),
            *[F.max(c).alias(c) for c in ("own_a", "own_b", "all_a", "all_b")])
        a, b = F.col("own_a").cast("double"), F.col("own_b").cast("double")
        c, d = F.col("all_a") - a, F.col("all_b") - b
        same_kind = ((a + b) > 0) == ((c + d) > 0)
        same_labels = ((a * d - b * c) * (a * d - b * c) * (a + b + c + d)
                       <= F.lit(CRITICAL_LABELS) * (a + b) * (c + d) * (a + c) * (b + d))
        like = tests.where(_alike(F.col("chi"), F.col("freedom")) & same_kind & same_labels).select(
            *node, "tok", F.lit(True).alias("like"))
        new = F.transform("merged", lambda t, i: F.when(F.col("like") & (i == level - 1), F.lit("~")).otherwise(t))
        table = materialize(placed.join(like, [*node, "tok"], "left").withColumn("merged", new).select(*table.columns),
                            "templates")
    return table


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, n_allow, n_block`` of every row of ``pages`` (page_id, url).

    ``template``: that of the url after merging; ``n_allow``, ``n_block``: its labelled urls.
    """
    host, path = host_and_path("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    split = materialize(split.select("*", rule.alias("rule"), says.alias("says")), "pages")
    count = F.count(F.lit(1))
    urls = split.groupBy("host", "path").agg(
        count.alias("n"), F.count_if(F.col("says") == "allow").alias("a"), F.count_if(F.col("says") == "block").alias("b"))
    grown = materialize(grow(urls).select("host", "path", "tmpl", "n", "a", "b"), "grown")
    sums = [F.sum(c).alias(c) for c in ("n", "a", "b")]
    merged = merge(grown.groupBy("host", "tmpl").agg(*sums, count.alias("n_urls")))
    final = merged.groupBy("host", "merged").agg(F.sum("a").alias("n_allow"), F.sum("b").alias("n_block"))
    overall = final.agg(((F.coalesce(F.sum("n_block"), F.lit(0)) + 1)
                         / (F.coalesce(F.sum("n_allow") + F.sum("n_block"), F.lit(0)) + 2)).alias("prior"))     # one row
    purity = ((F.col("n_block") + F.lit(STRENGTH) * F.col("prior"))
              / (F.col("n_allow") + F.col("n_block") + F.lit(STRENGTH)))
    verdicts = final.crossJoin(F.broadcast(overall)).select(
        "host", "merged", "n_allow", "n_block",
        F.when((F.col("n_block") > 0) & (purity >= REJECT), F.lit("block")).otherwise(F.lit("allow")).alias("by_template"))
    known = materialize(merged.select("host", "tmpl", "merged", "n_urls").join(verdicts, ["host", "merged"]).select(
        "host", "tmpl", F.array_join("merged", "").alias("template"), "n_allow", "n_block", "by_template", "n_urls"), "verdicts")
    n_urls = known.agg(F.coalesce(F.sum("n_urls"), F.lit(0))).first()[0]
    told = materialize(lookup_join(grown.select("host", "path", "tmpl", "n"), known, ["host", "tmpl"], "n_urls", n_urls)
                       .drop("tmpl", "n_urls"), "told")
    n_pages = told.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return lookup_join(split, told, ["host", "path"], "n", n_pages).select(
        "page_id", "host", "path", "rule", F.coalesce("says", "by_template").alias("verdict"), "template", "n_allow", "n_block")


def query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The result of the contract, with each url's template and its labelled urls."""
    return judge(pages)
