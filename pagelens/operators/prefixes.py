"""Longest match of keys against a table of rules: registrable domains by suffix rules (X4), phone numbers by a number plan.

Each length that the table has is one equi-join on the key's part of that length. No join multiplies rows and no row is gathered with others of its key, so
a host or a prefix that a third of all rows share costs no more than any other; rules are broadcast when they are counted to be small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url
from . import joins


def by_length(df: DataFrame, part: Callable[[int], Column], rules: DataFrame, key: str, size: Column) -> tuple[DataFrame, dict[int, Column]]:
    """df with a column for each length of the rules' keys: the rule (struct) whose key is the part of that length, or null. rules: one row for each key."""
    lengths = sorted(r[0] for r in rules.select(size.alias("n")).distinct().collect())
    rest = [F.col(c) for c in rules.columns if c != key]
    out = df
    for n in lengths:
        own = rules.where(size == n).select(F.col(key).alias("_part"), F.struct(F.lit(True).alias("hit"), *rest).alias(f"_rule{n}"))
        out = out.withColumn("_part", part(n)).join(joins.dimension(own), "_part", "left").drop("_part")
    return out, {n: F.col(f"_rule{n}") for n in lengths}


def longest(found: dict[int, Column]) -> Column:
    """Of the rules by length the longest that matched."""
    return F.coalesce(*[found[n] for n in sorted(found, reverse=True)])


def with_apex(df: DataFrame, url_column: str, suffixes: DataFrame, private: bool = False, name: str = "apex") -> DataFrame:
    """Df with the registrable domain: the public suffix and one label more; null for addresses, hosts that are a suffix and what isn't a URL.

    suffixes: name, plain, wildcard, exception, private (`dimensions.suffix_rules`). An exception beats all; else the longest rule counts, a wildcard with the label before
    its name; a host without rule has its last label as suffix. private: whether rules of private registries count."""
    rules = suffixes if private else suffixes.where(~F.col("private"))
    rules = rules.groupBy("name").agg(*[F.bool_or(c).alias(c) for c in ("plain", "wildcard", "exception")])
    host = F.regexp_replace(url.hostname(F.col(url_column)), r"\.\z", "")
    good = ~host.rlike(r"\A[0-9.]+\z") & ~host.startswith("[") & ~host.rlike(r"(^|\.)(\.|$)")
    labelled = df.withColumn("_labels", F.when(good, F.split(host, r"\.", -1)))
    labels, size = F.col("_labels"), F.size("_labels")

    def tail(n: Column | int) -> Column:
        return F.when(size >= n, F.concat_ws(".", F.slice(labels, F.greatest(size - n + 1, F.lit(1)), F.lit(n) if isinstance(n, int) else n)))

    joined, found = by_length(labelled, tail, rules, "name", F.size(F.split("name", r"\.", -1)))
    no = F.lit(None).cast("int")
    exception = F.coalesce(*[F.when(found[n]["exception"], F.lit(n - 1)) for n in sorted(found, reverse=True)], no)
    plain = [F.when(found[n]["plain"], F.lit(n)) for n in found]
    wild = [F.when(found[n]["wildcard"] & (size > n), F.lit(n + 1)) for n in found]
    suffix = F.coalesce(exception, F.greatest(F.lit(1), F.lit(1), *plain, *wild))
    return joined.withColumn(name, F.when(size > suffix, tail(suffix + 1))).drop("_labels", *[f"_rule{n}" for n in found])


def with_phone(df: DataFrame, raw: str, plan: DataFrame, country: str = "AT", code: str = "43", name: str = "phone") -> DataFrame:
    """Df with the number in international form if the plan has it as a number of the country, else null.

    plan: prefix (digits from the country's code on), region, least, most: digits of the national number under that prefix; the longest prefix counts.
    A number is international behind `+` or `00`; else, and behind the code, one leading 0 is the trunk prefix."""
    text = F.regexp_replace(F.col(raw), r"\A\s*(?i:tel:)?\s*", "")
    digits = F.regexp_replace(text, "[^0-9]", "")
    abroad = F.when(text.startswith("+"), digits).when(digits.startswith("00"), F.substring(digits, 3, 30))
    own = F.when(abroad.startswith(code), F.substring(abroad, len(code) + 1, 30)).when(abroad.isNull(), digits)
    number = F.coalesce(F.concat(F.lit(code), F.regexp_replace(own, r"\A0", "")), abroad)
    able = F.when(text.rlike(r"\A\+?[0-9\s()/.\-\x{2010}-\x{2015}\x{a0}]+\z") & F.length(number).between(5, 15), number)
    joined, found = by_length(df.withColumn("_number", able), lambda n: F.left("_number", F.lit(n)), plan.select("prefix", "region", "least", "most"), "prefix", F.length("prefix"))
    rule = longest(found)
    fits = (rule["region"] == country) & (F.length("_number") - len(code)).between(rule["least"], rule["most"])
    return joined.withColumn(name, F.when(fits, F.concat(F.lit("+"), "_number"))).drop("_number", *[f"_rule{n}" for n in found])
