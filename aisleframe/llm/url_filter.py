"""URL verdicts from host rules and, where none fits, from a tree of path templates learned on the ruled URLs.

Per host, paths are cut into segments; runs of digits are one wildcard from the start. The tree is generalised level by level,
each below the already generalised segments above: a position whose segments are spread as evenly as VARIETY equally frequent
ones is variable, and its rare segments become `*`; so do branches whose share of blocked URLs does not differ from that of all
branches beside them beyond chance. What lies below DEPTH segments is one segment as it stands. Templates under the same parent
are merged in the same way at the last segment, there also those without any ruled URL. The share of blocked among ruled URLs
of a template is smoothed by that of its host, which is smoothed by that of the template over all hosts, and that by the share
over all; templates with a share of half or more are rejected.

Each distinct host and path counts once, so a table that repeats its URLs gets the same verdicts and a hot host adds one row per
distinct path. All steps are grouped tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleframe.llm.shared import stash

#: (host, path, verdict) of the rules
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DEPTH = 8
VARIETY = 8  # a position is variable from this many segments on, counted by the chance that two of its paths agree
RARE = 20  # of a variable position, segments with less than 1/RARE of its paths become `*`
SMOOTHING = 5
CHANCE = 3.84

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _ruled(rules) -> tuple[Column, Column]:
    """Name and verdict of the longest rule whose host is the URL's or above it and whose path starts the URL's path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, host + path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def _tokens() -> Column:
    parts = F.split("path", "/")
    cut = F.transform(F.slice(parts, 2, F.size(parts)), lambda s: F.regexp_replace(s, "[0-9]+", "<n>"))
    rest = F.array_join(F.slice(cut, DEPTH, F.size(parts)), "/")
    return F.when(F.size(cut) > DEPTH, F.concat(F.slice(cut, 1, DEPTH - 1), F.array(rest))).otherwise(cut)


def _alike(a: str, b: str, pa: str, pb: str) -> Column:
    """Whether a share of blocked URLs does not differ from the common one beyond chance."""
    share = (F.col(pb) + 0.5) / (F.col(pa) + F.col(pb) + 1)
    n = F.col(a) + F.col(b)
    off = F.col(b) / F.greatest(n, F.lit(1)) - share
    return off * off * n <= share * (1 - share) * CHANCE


def _generalised(paths: DataFrame) -> DataFrame:
    """Paths (host, path, a, b, tokens) with ts, their segments from the first level to the last with wildcards."""
    deepest = paths.agg(F.max(F.size("tokens"))).first()[0] or 0  # at most DEPTH
    state = paths.withColumn("ts", F.array().cast("array<string>"))
    for d in range(1, deepest + 1):
        state = state.withColumns({"above": F.array_join("ts", "/"), "token": F.try_element_at("tokens", F.lit(d))})
        children = stash(state.filter("token is not null").groupBy("host", "above", "token").agg(
            F.count("*").alias("n"), F.sum("a").alias("ca"), F.sum("b").alias("cb")))
        n = F.col("n").cast("double")
        places = stash(children.groupBy("host", "above").agg(
            F.sum(n).alias("m"), F.sum(n * n).alias("q"), F.sum("ca").alias("pa"), F.sum("cb").alias("pb"),
            F.count(F.when(F.col("ca") + F.col("cb") > 0, 1)).alias("ruled")))
        rare = (F.col("m") * F.col("m") >= F.col("q") * VARIETY) & (F.col("n") * RARE < F.col("m"))
        branch = (F.col("ruled") > 1) & (F.col("ca") + F.col("cb") > 0) & _alike("ca", "cb", "pa", "pb")
        marks = stash(children.join(places, ["host", "above"]).select(
            "host", "above", "token", rare.alias("rare"), branch.alias("branch")).filter("rare or branch"))
        wild = F.coalesce(F.col("rare") | F.col("branch") & (F.size("tokens") > d), F.lit(False))
        more = F.concat("ts", F.array(F.when(wild, "*").otherwise(F.col("token"))))
        state = stash(state.join(marks, ["host", "above", "token"], "left").select(
            "host", "path", "a", "b", "tokens", F.when(F.col("token").isNull(), F.col("ts")).otherwise(more).alias("ts")))
    return state


def _templates(paths: DataFrame) -> DataFrame:
    """(host, path, a, b, parent, last): each path's template, cut before its last segment."""
    return _generalised(paths).select(
        "host", "path", "a", "b", F.expr("array_join(slice(ts, 1, greatest(size(ts) - 1, 0)), '/')").alias("parent"),
        F.coalesce(F.try_element_at("ts", F.lit(-1)), F.lit("")).alias("last"))


def _smoothed(above: Column) -> Column:
    return (F.col("b") + above * SMOOTHING) / (F.col("a") + F.col("b") + SMOOTHING)


def learned_verdicts(urls: DataFrame) -> DataFrame:
    """(host, path, template, purity) of each distinct host and path; urls: host, path, verdict (allow, block or null).

    purity is the smoothed share of blocked URLs of the path's template, 0 where no URL at all has a verdict.
    """
    says = lambda v: F.max(F.when(F.col("verdict") == v, 1).otherwise(0)).cast("long")
    paths = stash(urls.groupBy("host", "path").agg(says("allow").alias("a"), says("block").alias("b"))
        .withColumn("tokens", _tokens()))
    leaves = stash(_templates(paths))
    siblings = leaves.groupBy("host", "parent", "last").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    pooled = stash(siblings.groupBy("host", "parent").agg(F.sum("a").alias("pa"), F.sum("b").alias("pb")))
    alike = (F.col("a") + F.col("b") == 0) | _alike("a", "b", "pa", "pb")
    merged = stash(siblings.join(pooled, ["host", "parent"]).select(
        "host", "parent", "last", "a", "b", F.concat("parent", F.lit("/"), F.when(alike, "*").otherwise(F.col("last"))).alias("template")))
    whole = merged.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()  # one row
    ruled = (whole["a"] or 0) + (whole["b"] or 0)
    everywhere = F.lit(float((whole["b"] or 0) / ruled) if ruled else 0.0)
    sums = lambda *by: merged.groupBy(*by).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    by_template = stash(sums("template").select("template", _smoothed(everywhere).alias("of_template")))
    by_host = stash(sums("host").select("host", F.col("a").alias("ha"), F.col("b").alias("hb")))
    of_host = (F.col("hb") + F.col("of_template") * SMOOTHING) / (F.col("ha") + F.col("hb") + SMOOTHING)
    purity = stash(sums("host", "template").join(by_template, "template").join(by_host, "host").select(
        "host", "template", _smoothed(of_host).alias("purity")))
    named = merged.select("host", "parent", "last", "template").join(purity, ["host", "template"])
    return leaves.select("host", "path", "parent", "last").join(stash(named), ["host", "parent", "last"]).select(
        "host", "path", "template", "purity")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of each row of pages (page_id, url).

    Where a rule fits, the longest one's verdict holds; rule is null elsewhere, and the verdict is block where the purity of the
    URL's template is 0.5 or more, else allow. A null url and one without `://` have an empty host and path, fit no rule and
    are judged by the template of the empty path. Rows that repeat count and are judged each. An empty table gives none. Other
    columns of pages are not looked at.
    """
    host, path = host_and_path(F.col("url"))
    name, says = _ruled(rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": name, "verdict": says})
    learned = stash(learned_verdicts(urls.select("host", "path", "verdict")))
    by_method = F.when(F.col("purity") >= 0.5, "block").otherwise("allow")
    return urls.join(learned, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "template", "purity")
