"""Values that are bound once, and joins that don't send pages through the driver."""

from pyspark.sql import functions as F

from pagelens.functions import contact, html, url
from pagelens.operators import joins

FACTS = "f struct<body_text:string,links:array<struct<href:string,text:string>>,directory_links:map<string,array<string>>>"


def _plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_a_directory_link_is_taken_apart_a_few_times_only(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    df = spark.createDataFrame([], f"page string, {FACTS}")
    assert _plan(df.select(html.directory_site(F.col("page"), F.col("f")))).count("regexp_extract(") < 100  # was 1,000 and more


def test_pages_are_merge_joined(spark):
    """However small Spark guesses them to be."""
    pages = spark.range(3).select(F.concat(F.lit("https://a.at/"), "id").alias("url"), F.lit(200).alias("status"), F.lit("x").alias("body"), F.lit("x").alias("final_url"), F.lit(None).cast("string").alias("error"))
    names = spark.range(3).select(F.col("id").cast("string").alias("place_id"), F.lit("Ort").alias("name"), F.lit("1010").alias("plz"), F.lit("01").alias("phone"))
    links = names.select("place_id", F.lit(1).alias("query_rank"), F.lit(1).alias("link_rank"), F.concat(F.lit("https://a.at/"), "place_id").alias("link"))
    sites = spark.createDataFrame([], f"place_id string, discovered_url string, final_url string, {FACTS.replace('f struct', 'facts struct', 1)}")
    for df in (joins.by_directory_search(names, links, pages), joins.imprints(sites, pages), joins.by_dns_guess(names, pages)):
        assert "Broadcast" not in _plan(df, "sparkPlan")


def test_a_host_can_be_grouped_by(spark):
    rows = spark.createDataFrame([("https://Ä.at/x",), ("http://www.ä.at",), ("https://b.at:443/",)], "u string")
    assert {r[0]: r[1] for r in rows.groupBy(url.apex(F.col("u"))).count().collect()} == {"xn--4ca.at": 2, "b.at": 1}


def test_an_address_is_read_from_the_place_that_was_found(spark):
    rows = spark.createDataFrame([("x Mariahilfer  Straße 12/3, 1060 Wien",), ("Am Hof 1-2 8010 Graz.",), ("none",), (None,)], "t string")
    got = [tuple(r) for r in rows.select(contact.address(F.col("t")), contact.strict_address(F.col("t"))["plz"]).collect()]
    assert got == [("Mariahilfer Straße 12/3, 1060 Wien", "1060"), ("Am Hof 1-2, 8010 Graz.", None), (None, None), (None, None)]
