"""Report aggregates. Ids A3-A10, A14, A18, O3 of the survey.

All aggregate with partial results before the exchange. Fixed domains keep their empty groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIERS, SUB_TIERS = ("A", "B1", "B2", "B3", "C"), ("A1", "A2", "A3", "null")
YEAR_BUCKETS = ("<2000", "2000-2009", "2010-2019", "2020+", "null")


def over_domain(df: DataFrame, key: Column, domain: tuple[str, ...], name: str) -> DataFrame:
    """A3, A4: counts over a fixed domain in its order (ordinal), zero for what doesn't occur; null counts as `null`."""
    found = df.groupBy(F.coalesce(key.cast("string"), F.lit("null")).alias(name)).agg(F.count("*").alias("count"))
    dim = df.sparkSession.range(len(domain)).select(F.get(F.array(*[F.lit(x) for x in domain]), F.col("id").cast("int")).alias(name), F.col("id").cast("int").alias("ordinal"))
    return dim.join(found, name, "left").select("ordinal", name, F.coalesce("count", F.lit(0)).alias("count")).orderBy("ordinal")


def by_tier(rows: DataFrame) -> DataFrame:
    """A3."""
    return over_domain(rows, F.col("tier"), TIERS, "tier")


def by_sub_tier(rows: DataFrame) -> DataFrame:
    """A4."""
    return over_domain(rows, F.col("sub_tier"), SUB_TIERS, "sub_tier")


def by_intent(rows: DataFrame) -> DataFrame:
    """A5: counts over an open domain, in the keys' order."""
    return rows.groupBy(F.coalesce("intent_tier", F.lit("null")).alias("intent_tier")).agg(F.count("*").alias("count")).orderBy("intent_tier")


def five_numbers(rows: DataFrame, key: Column, value: str, name: str = "key") -> DataFrame:
    """Least, quartiles and largest value of each group by nearest rank, index floor(q n) capped at n - 1; null values don't count.

    Values are counted first, so that a group is as many rows as it has different values, and ranks come from running sums."""
    from pyspark.sql import Window

    counts = rows.where(F.col(value).isNotNull()).groupBy(key.alias(name), F.col(value).alias("v")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(name).orderBy("v")
    ranked = counts.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(name)))
    at = lambda q: F.least(F.col("total") - 1, F.floor(F.col("total") * F.lit(q)))
    pick = lambda q: F.min(F.when(F.col("upto") > at(q), F.col("v")))
    return ranked.groupBy(name).agg(F.min("v").alias("min"), pick(0.25).alias("p25"), pick(0.5).alias("median"), pick(0.75).alias("p75"), F.max("v").alias("max"))


def score_by_sub_tier(rows: DataFrame) -> DataFrame:
    """A6 over the fixed sub-tiers; empty ones have nulls."""
    found = five_numbers(rows, F.coalesce("sub_tier", F.lit("null")), "score", "sub_tier")
    dim = over_domain(rows.limit(0), F.lit(None), SUB_TIERS, "sub_tier").select("ordinal", "sub_tier")
    return dim.join(found, "sub_tier", "left").orderBy("ordinal")


def worst(rows: DataFrame, n: int = 10) -> DataFrame:
    """O3: the n worst reachable sites."""
    return rows.where((F.col("tier") == "A") & F.col("score").isNotNull()).orderBy(F.desc("score"), F.asc("place_id")).limit(n)


def by_cms(rows: DataFrame) -> DataFrame:
    """Counts, most first; equal counts in the names' order; an empty name is `(empty)`."""
    return rows.groupBy(F.when(F.col("cms") == "", F.lit("(empty)")).otherwise(F.col("cms")).alias("cms")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "cms")


def year_bucket(year: Column) -> Column:
    return F.when(year.isNull(), F.lit("null")).when(year < 2000, F.lit("<2000")).when(year < 2010, F.lit("2000-2009")).when(year < 2020, F.lit("2010-2019")).otherwise(F.lit("2020+"))


def by_year(rows: DataFrame) -> DataFrame:
    """A8."""
    return over_domain(rows, year_bucket(F.col("last_modified_signal")), YEAR_BUCKETS, "bucket")


def email_counts(rows: DataFrame) -> DataFrame:
    """One row: counts of personal, generic and other rows, and of rows with an address."""
    g = F.col("email_is_generic")
    return rows.agg(F.count_if(g == 0).alias("personal"), F.count_if(g == 1).alias("generic"), F.count_if(g.isNull() | ~g.isin(0, 1)).alias("none"), F.count("email").alias("with_email"))


def suspected_chains(places: DataFrame, name_key: Column, category: str = "primary_type", district: str = "district", more_than: int = 3, districts: int = 3) -> DataFrame:
    """Names with more than three places of a category in at least three districts."""
    return (
        places.groupBy(name_key.alias("name_key"), F.col(category).alias("category")).agg(F.count("*").alias("places"), F.countDistinct(district).alias("districts"))
        .where((F.col("places") > more_than) & (F.col("districts") >= districts))
    )


def report_cube(rows: DataFrame) -> DataFrame:
    """Counts and mean score by tier, content system and both, with subtotals (an addition to the report)."""
    return rows.rollup("tier", "cms").agg(F.count("*").alias("count"), F.avg("score").alias("mean_score"), F.grouping_id().alias("level"))
