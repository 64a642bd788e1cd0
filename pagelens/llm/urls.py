"""URL filters: a path-template tree of each host, pruned by labelled purity.

1. A URL's host and path give a template: path segments that look variable (numbers, numbers with an extension, long hexadecimal
   or mixed strings) become wildcards. Pages are counted by (host, template) first, with map-side partial sums, so a host
   with a third of all pages is a few rows from here on.
2. From the leaves up, siblings whose share of bad labels doesn't differ from that of all of them by a two-proportion test, neither as a whole nor in
   one of the merged paths below, are merged into one branch. The others stay branches of their own.
3. A branch's purity is its share of good labels, smoothed towards its parent's, the host's towards the whole table's. A template
   is rejected where its merged branch's purity is below the limit.
4. For reports, crowded levels' alike children become wildcards from the top down (templates); that has no part in the verdict.

Block and allow rules come first: the longest rule whose host (or a parent domain of it) and path prefix fit decides.

Defined cases: a null URL or one without `://` has empty host and path, no rule fits, and the tree judges it as the host '';
repeated rows each count and get the same verdict; a page with several labels is bad if one says so; rules of equal length: the last in sort order
decides; a path of any length is read whole, with segments beyond the depth as one; without labels nothing is rejected; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does. Equal lengths: the later name in sort order first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def segments(path: Column, depth: int) -> Column:
    """The path's segments with variable ones generalised; those beyond the depth are one `**`."""

    def general(s: Column) -> Column:
        bare = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
        ext = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        return (
            F.when(bare.rlike(r"^[0-9]+$"), F.concat(F.lit("{n}"), ext))
            .when(bare.rlike(r"^[0-9a-fA-F-]{12,}$"), F.concat(F.lit("{hex}"), ext))
            .when(bare.rlike(r"[0-9]") & (F.length(bare) >= 16), F.concat(F.lit("{id}"), ext))
            .otherwise(s)
        )

    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.when(F.size(parts) > depth, F.concat(F.transform(F.slice(parts, 1, depth), general), F.array(F.lit("**")))).otherwise(F.transform(parts, general))


def differs(bad: Column, n: Column, of_bad: Column, of_n: Column, z_limit: float) -> Column:
    """Whether a share of bad labels differs significantly from that of the whole it is part of."""
    rate = of_bad / F.greatest(of_n, F.lit(1))
    z = F.abs(bad / F.greatest(n, F.lit(1)) - rate) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-6)) / F.greatest(n, F.lit(1)))
    return (n > 0) & (z > z_limit)


def deepest(tree: DataFrame) -> int:
    """Segments of the longest template."""
    return tree.agg(F.max(F.size(F.split("raw", "/", -1)))).first()[0] or 0


def templates(pages: DataFrame, url: str, bad: Column, depth: int, max_children: int, z_limit: float = 2.58) -> DataFrame:
    """host, raw (the template as generalised row by row), branch (with alike children of crowded levels as wildcards), n, labelled, bad."""
    sums = lambda b, n: [F.sum("bad").alias(b), F.sum("labelled").alias(n)]
    apart = differs(F.col("bad"), F.col("labelled"), F.col("of_bad"), F.col("of_n"), z_limit)
    at = pages.select(host(F.col(url)).alias("host"), F.array_join(segments(path(F.col(url)), depth), "/").alias("raw"), bad.alias("bad"))
    found = shared.written(at.groupBy("host", "raw").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "templates")
    tree = found.withColumn("parts", F.split("raw", "/", -1)).withColumn("branch", F.lit(""))
    for level in range(deepest(found)):
        here = F.get("parts", F.lit(level))
        tree = tree.withColumn("child", here)
        children = tree.where("child IS NOT NULL").groupBy("host", "branch", "child").agg(*sums("bad", "labelled"))
        crowded = children.groupBy("host", "branch").agg(F.count("*").alias("children"), *sums("of_bad", "of_n")).where(F.col("children") > max_children)
        below = tree.where("child IS NOT NULL AND labelled > 0").join(crowded.select("host", "branch"), ["host", "branch"]).withColumn("rest", F.array_join(F.slice("parts", level + 2, depth + 1), "/"))
        alike = below.groupBy("host", "branch", "rest").agg(*sums("of_bad", "of_n"))
        own = children.join(crowded, ["host", "branch"]).where(apart).select("host", "branch", "child")
        own = own.union(below.join(alike, ["host", "branch", "rest"]).where(apart).select("host", "branch", "child")).distinct().withColumn("own", F.lit(True))
        tree = tree.join(crowded.select("host", "branch", F.lit(True).alias("crowded")), ["host", "branch"], "left").join(own, ["host", "branch", "child"], "left")
        name = F.when(F.col("crowded") & F.col("own").isNull(), F.lit("*")).otherwise(F.col("child"))
        tree = tree.withColumn("branch", F.when(F.col("child").isNull(), F.col("branch")).otherwise(F.concat("branch", F.lit("/"), name))).drop("crowded", "own", "child")
        tree = shared.written(tree, "tree")
    return tree.drop("parts")


def merged(found: DataFrame, z_limit: float = 2.58) -> DataFrame:
    """host, raw, path: from the leaves up, siblings whose share of bad labels doesn't differ from that of all of them, neither as a whole nor in one of
    the merged paths below, become one branch `*`. found: host, raw, labelled, bad."""
    sums = lambda b, n: [F.sum("bad").alias(b), F.sum("labelled").alias(n)]
    apart = differs(F.col("bad"), F.col("labelled"), F.col("of_bad"), F.col("of_n"), z_limit)
    tree = found.select("host", "raw", "labelled", "bad").withColumn("parts", F.split("raw", "/", -1)).withColumn("path", F.lit(""))
    for level in reversed(range(deepest(found))):
        tree = tree.withColumn("parent", F.array_join(F.slice("parts", 1, level), "/")).withColumn("child", F.get("parts", F.lit(level)))
        here = tree.where("child IS NOT NULL")
        children = here.groupBy("host", "parent", "child").agg(*sums("bad", "labelled"))
        whole = children.groupBy("host", "parent").agg(F.count("*").alias("children"), *sums("of_bad", "of_n")).where("children > 1")
        below = here.where("labelled > 0").groupBy("host", "parent", "child", "path").agg(*sums("bad", "labelled"))
        alike = below.groupBy("host", "parent", "path").agg(*sums("of_bad", "of_n"))
        own = children.join(whole, ["host", "parent"]).where(apart).select("host", "parent", "child")
        own = own.union(below.join(alike, ["host", "parent", "path"]).where(apart).select("host", "parent", "child")).distinct().withColumn("own", F.lit(True))
        tree = tree.join(whole.select("host", "parent", F.lit(True).alias("several")), ["host", "parent"], "left").join(own, ["host", "parent", "child"], "left")
        name = F.when(F.col("several") & F.col("own").isNull(), F.lit("*")).otherwise(F.col("child"))
        tree = tree.withColumn("path", F.when(F.col("child").isNull(), F.col("path")).otherwise(F.concat(F.lit("/"), name, F.col("path"))))
        tree = shared.written(tree.select("host", "raw", "labelled", "bad", "parts", "path"), "merged")
    return tree


def purity(tree: DataFrame, prior_weight: float = 5.0) -> DataFrame:
    """host, raw, purity. A branch's share of good labels is smoothed towards its parent's, the host's towards the whole table's. tree: see merged."""
    total = tree.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    whole = 1.0 if not total["labelled"] else 1 - total["bad"] / total["labelled"]
    smooth = lambda prior: (F.col("n") - F.col("b") + F.lit(prior_weight) * prior) / (F.col("n") + F.lit(prior_weight))
    sums = [F.sum("bad").alias("b"), F.sum("labelled").alias("n")]
    nodes = tree.groupBy("host", "path").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).withColumn("purity", F.lit(whole))
    steps = F.split("path", "/", -1)
    for level in range(deepest(tree) + 1):
        nodes = nodes.withColumn("node", F.array_join(F.slice(steps, 1, level + 1), "/"))
        here = nodes.where(F.size(steps) > level).groupBy("host", "node").agg(*sums)
        nodes = nodes.join(here, ["host", "node"], "left").withColumn("purity", F.when(F.size(steps) > level, smooth(F.col("purity"))).otherwise(F.col("purity"))).drop("node", "b", "n")
    return tree.join(nodes.select("host", "path", "purity"), ["host", "path"]).select("host", "raw", F.col("path").alias("merged"), "purity")


def judge(
    pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, depth: int = 6, max_children: int = 64, min_purity: float = 0.5,
    z_limit: float = 2.58, prior_weight: float = 5.0,
) -> DataFrame:
    """key, host, path, rule, template, merged, purity, verdict for each page. labels: key and bad (0 or 1).

    depth: segments of a path that are told apart. max_children: children up to which a level's templates are reported by name; verdicts don't depend on it."""
    plain = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    known = labels.where(F.col("bad").isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max("bad").cast("long").alias("bad"))
    with shared.scratch(pages.sparkSession):
        tree = templates(plain.join(known, "key", "left"), "url", F.col("bad"), depth, max_children, z_limit)
        judged = purity(merged(tree, z_limit), prior_weight)
        verdicts = shared.written(judged.join(tree.select("host", "raw", "branch"), ["host", "raw"]), "purity", outlive=True)
    at = plain.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    at = at.withColumn("raw", F.array_join(segments(F.col("path"), depth), "/")).drop("url")
    name, fixed = rule_of(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return at.join(verdicts, ["host", "raw"], "left").select(F.col("key").alias(key), "host", "path", name.alias("rule"), F.col("branch").alias("template"), "merged", "purity", F.coalesce(fixed, by_tree).alias("verdict"))
