"""Dimensions: chain lists, districts, branch patterns, robots rules. Ids S15, S17-S19, X55 of the survey."""

from __future__ import annotations

import json

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BranchPattern

#: Chains: id, tokens of the name (all have to stand in a name), kinds of place.
CHAINS = [
    ("billa", ["billa"], ["shop=supermarket"]),
    ("spar", ["spar"], ["shop=supermarket"]),
    ("hofer", ["hofer"], ["shop=supermarket"]),
    ("penny", ["penny"], ["shop=supermarket"]),
    ("lidl", ["lidl"], ["shop=supermarket"]),
    ("rewe", ["rewe"], ["shop=supermarket"]),
    ("eurospar", ["eurospar"], ["shop=supermarket"]),
    ("interspar", ["interspar"], ["shop=supermarket"]),
    ("dm", ["dm"], ["shop=chemist"]),
    ("bipa", ["bipa"], ["shop=chemist"]),
    ("mueller", ["mueller"], ["shop=chemist"]),
    ("mcdonalds", ["mcdonald"], ["amenity=fast_food"]),
    ("burger-king", ["burger", "king"], ["amenity=fast_food"]),
    ("kfc", ["kfc"], ["amenity=fast_food"]),
    ("subway", ["subway"], ["amenity=fast_food"]),
    ("starbucks", ["starbucks"], ["amenity=fast_food"]),
    ("omv", ["omv"], ["amenity=fuel"]),
    ("shell", ["shell"], ["amenity=fuel"]),
    ("bp", ["bp"], ["amenity=fuel"]),
    ("jet", ["jet"], ["amenity=fuel"]),
    ("turmoel", ["turmoel"], ["amenity=fuel"]),
    ("a1", ["a1"], ["shop=mobile_phone"]),
    ("magenta", ["magenta"], ["shop=mobile_phone"]),
    ("drei", ["drei"], ["shop=mobile_phone"]),
    ("erste-bank", ["erste", "bank"], ["amenity=bank"]),
    ("bank-austria", ["bank", "austria"], ["amenity=bank"]),
    ("bawag", ["bawag"], ["amenity=bank"]),
    ("raiffeisen", ["raiffeisen"], ["amenity=bank"]),
    ("oberbank", ["oberbank"], ["amenity=bank"]),
    ("volksbank", ["volksbank"], ["amenity=bank"]),
]
#: Kinds of places that are never chains.
KEPT_KINDS = {
    "shop": ("jewelry", "watches", "antiques", "art", "gallery", "boutique", "interior_decoration", "musical_instrument"),
    "office": ("lawyer", "notary", "engineer", "architect", "accountant", "tax_advisor"),
    "amenity": ("arts_centre", "gallery", "auction_house"),
}
#: Vienna's districts in order of their numbers; the postal code of number n is 1000 + 10 n.
DISTRICTS = (
    "Innere Stadt", "Leopoldstadt", "Landstraße", "Wieden", "Margareten", "Mariahilf", "Neubau", "Josefstadt", "Alsergrund", "Favoriten", "Simmering", "Meidling", "Hietzing", "Penzing",
    "Rudolfsheim-Fünfhaus", "Ottakring", "Hernals", "Währing", "Döbling", "Brigittenau", "Floridsdorf", "Donaustadt", "Liesing",
)
#: Branch pages: pattern, chain, kind of chain.
BRANCH_PAGES = (
    ("anker.at/filialen*", "Anker", "bakery"), ("baeckerei-felber.at/*", "Felber", "bakery"), ("billa.at/filialen/*", "Billa", "supermarket"), ("billa-corso.at/*", "Billa Corso", "supermarket"),
    ("billaplus.at/*", "Billa Plus", "supermarket"), ("bipa.at/*", "Bipa", "drugstore"), ("dermann.at/filiale/*", "Dermann", "bakery"), ("dm.at/*", "dm", "drugstore"), ("eurospar.at/*", "Eurospar", "supermarket"),
    ("felber.at/*", "Felber", "bakery"), ("hofer.at/filialen*", "Hofer", "discount-supermarket"), ("libro.at/filialen*", "Libro", "stationery"), ("lidl.at/*", "Lidl", "supermarket"),
    ("müller.at/filialen*", "Müller", "drugstore"), ("oberlaa-wien.at/*", "Oberlaa", "confectionery/cafe"), ("pagro.at/filialen*", "Pagro", "stationery"), ("penny.at/*", "Penny", "supermarket"),
    ("spar.at/standorte/*", "Spar", "supermarket"), ("ströck.at/*", "Ströck", "bakery"),
)


def blacklist(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Id, tokens, categories, ordinal; the built-in chains, or a JSON file's `chains`."""
    if path:
        found = spark.read.option("multiLine", True).schema("chains array<struct<id:string,tokens:array<string>,categories:array<string>>>").json(path)
        return found.select(F.posexplode("chains").alias("ordinal", "c")).select("c.id", "c.tokens", "c.categories", "ordinal")
    rows = [(*chain, i) for i, chain in enumerate(CHAINS)]
    return spark.createDataFrame(rows, "id string, tokens array<string>, categories array<string>, ordinal int")


def whitelist(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Key, value; the built-in kinds, or a JSON file's."""
    if path:
        found = spark.read.option("multiLine", True).schema("shop array<string>, office array<string>, amenity array<string>").json(path)
        pairs = F.flatten(F.array(*[F.transform(k, _pair(k)) for k in ("shop", "office", "amenity")]))
        return found.select(F.inline(pairs))
    return spark.createDataFrame([(k, v) for k, values in KEPT_KINDS.items() for v in values], "key string, value string")


def _pair(key: str):
    return lambda v: F.struct(F.lit(key).alias("key"), v.alias("value"))


def districts(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Number, name, plz."""
    if path:
        return spark.read.option("multiLine", True).schema("number int, name string, plz string").json(path)
    return spark.createDataFrame([(i, n, str(1000 + 10 * i)) for i, n in enumerate(DISTRICTS, 1)], "number int, name string, plz string")


def suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """Name, plain, wildcard, exception, private of a public-suffix file: a rule a line, up to the first space; `//` comments, `*.` any label, `!` an exception.

    Names beyond ASCII are in punycode. What stands behind the mark of the private section is private."""
    whole = spark.read.text(path, wholetext=True).withColumn("_at", F.instr("value", "===BEGIN PRIVATE DOMAINS==="))
    parts = whole.select(F.inline(F.array(*[F.struct(t.alias("text"), F.lit(private).alias("private")) for t, private in (
        (F.when(F.col("_at") > 0, F.left("value", F.col("_at"))).otherwise(F.col("value")), False), (F.when(F.col("_at") > 0, F.substr("value", F.col("_at"))), True))])))
    lines = parts.select("private", F.explode(F.split("text", r"\r?\n", -1)).alias("line"))
    rules = lines.select("private", F.lower(F.regexp_extract("line", r"\A\s*(\S+)", 1)).alias("rule")).where((F.col("rule") != "") & ~F.col("rule").startswith("//") & ~F.col("rule").startswith("="))
    return suffix_table(rules)


def suffix_table(rules: DataFrame) -> DataFrame:
    """The same from rows of rule and private."""
    bare = F.regexp_replace("rule", r"\A(\*\.|!)", "")
    name = F.when(bare.rlike(r"[^\x00-\x7F]"), F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), bare)).otherwise(bare)
    wildcard, exception = F.col("rule").startswith("*."), F.col("rule").startswith("!")
    return rules.select(name.alias("name"), (~wildcard & ~exception).alias("plain"), wildcard.alias("wildcard"), exception.alias("exception"), "private").where(F.col("name").isNotNull())


def number_plan(spark: SparkSession, path: str) -> DataFrame:
    """Prefix, region, least, most of a CSV file with a header."""
    return spark.read.option("header", True).schema("prefix string, region string, least int, most int").csv(path)


def branch_patterns(text: str | None = None) -> list[BranchPattern]:
    """Patterns in order, the first that fits counts. text: YAML, a list of pattern, chain_name and reason; else the built-in ones."""
    if text is None:
        return [BranchPattern(p, c, f"B2C {kind} chain — branch page") for p, c, kind in BRANCH_PAGES]
    entries = yaml.safe_load(text)
    if not isinstance(entries, list):
        raise ValueError("branch patterns have to be a list")
    for e in entries:
        if not isinstance(e, dict) or not all(e.get(k) for k in ("pattern", "chain_name", "reason")):
            raise ValueError(f"a branch pattern lacks a field: {json.dumps(e, ensure_ascii=False)}")
    return [BranchPattern(e["pattern"], e["chain_name"], e["reason"]) for e in entries]


def robots_rules(fetches: DataFrame) -> DataFrame:
    """Origin, rules (array of structs allow, path) and crawl_delay_ms of fetched robots files (origin, status, body, error).

    Rules are those of the groups for all agents; a file that couldn't be fetched gives none, which allows everything. The file's lines are folded in one expression: a
    group starts with agent lines, and the first other line ends their run."""
    lines = F.transform(F.split(F.coalesce("body", F.lit("")), r"\r?\n", -1), lambda x: F.trim(F.split(x, "#", 2)[0]))
    fields = F.transform(
        F.filter(lines, lambda x: x.contains(":")),
        lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("field"), F.trim(F.regexp_replace(x, r"(?s)\A[^:]*:", "")).alias("value")),
    )
    rule = "array<struct<allow:boolean,path:string>>"
    start = F.struct(F.lit(False).alias("star"), F.lit(False).alias("agents"), F.array().cast(rule).alias("rules"), F.lit(0).cast("bigint").alias("delay"))

    def step(s, x):
        agent = x["field"] == "user-agent"
        star = F.when(agent, F.when(s["agents"], s["star"]).otherwise(F.lit(False)) | (x["value"] == "*")).otherwise(s["star"])
        applies = ~agent & s["star"]
        new = F.when(
            applies & (x["field"] == "disallow"),
            F.array(F.struct((x["value"] == "").alias("allow"), F.when(x["value"] == "", F.lit("/")).otherwise(x["value"]).alias("path"))),
        ).when(applies & (x["field"] == "allow"), F.array(F.struct(F.lit(True).alias("allow"), x["value"].alias("path"))))
        seconds = F.regexp_extract(x["value"], r"\A\s*([0-9]*\.?[0-9]+)", 1)
        delay = F.when(applies & (x["field"] == "crawl-delay") & (seconds != ""), F.round(F.nullif(seconds, F.lit("")).cast("double") * 1000).cast("bigint"))
        return F.struct(
            star.alias("star"), agent.alias("agents"), F.when(new.isNotNull(), F.concat(s["rules"], new.cast(rule))).otherwise(s["rules"]).alias("rules"), F.when(delay > 0, delay).otherwise(s["delay"]).alias("delay")
        )

    folded = F.aggregate(fields, start, step)
    good = F.col("error").isNull() & (F.col("status") == 200) & (F.coalesce("body", F.lit("")) != "")
    out = fetches.withColumn("_f", F.when(good, folded))
    return out.select("origin", F.coalesce("_f.rules", F.array().cast(rule)).alias("rules"), F.coalesce("_f.delay", F.lit(0).cast("bigint")).alias("crawl_delay_ms"))
