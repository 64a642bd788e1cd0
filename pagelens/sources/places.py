"""Candidate sources over stored dumps. Ids S1-S9, U6 of the survey. The engine reads what was fetched; it opens no connections."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contact, js, score
from ..operators import dedupe
from ..schemas import CANDIDATE, conform

ELEMENTS = (
    "elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
)
PLACES = (
    "places array<struct<id:string,displayName:struct<text:string>,formattedAddress:string,addressComponents:array<struct<longText:string,shortText:string,types:array<string>>>,"
    "location:struct<latitude:double,longitude:double>,types:array<string>,primaryType:string,websiteUri:string,nationalPhoneNumber:string,internationalPhoneNumber:string,businessStatus:string>>"
)


@dataclass(frozen=True)
class Source:
    """A source is configured if its dump is named; search gives candidates, optionally of one postal code."""

    id: str
    label: str
    path: str | None
    read: Callable[[SparkSession, str, str | None], DataFrame]

    @property
    def configured(self) -> bool:
        return bool(self.path)

    def search(self, spark: SparkSession, plz: str | None = None) -> DataFrame:
        return self.read(spark, self.path, plz)


def active(sources: list[Source]) -> list[Source]:
    """The configured sources in order."""
    found = [s for s in sources if s.configured]
    if not found:
        raise ValueError("no source is configured: " + ", ".join(s.id for s in sources))
    return found


def first_that_works(sources: list[Source], spark: SparkSession, plz: str | None = None) -> DataFrame:
    """Candidates of the first source that can be read; the next one is asked only if reading failed. An empty result is a result."""
    failures = []
    for s in active(sources):
        try:
            found = s.search(spark, plz)
            found.limit(1).count()
            return found.withColumn("source", F.lit(s.id))
        except Exception as e:  # noqa: BLE001
            failures.append(f"{s.id}: {str(e).splitlines()[0]}")
    raise RuntimeError("all sources failed: " + "; ".join(failures))


def map_elements(elements: DataFrame) -> DataFrame:
    """Map elements (type, id, lat, lon, center, tags) as candidates; those without a known tag or a name are left out."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    key = score.tag_key(F.col("tags"))
    brand = F.coalesce(tag("brand"), tag("brand:wikidata"))
    named = elements.withColumn("_key", key).withColumn("_name", js.null_if_empty(F.coalesce(tag("name"), tag("brand")))).where(F.col("_key").isNotNull() & F.col("_name").isNotNull())
    out = named.select(
        F.concat_ws(":", F.lit("osm"), "type", F.col("id").cast("string")).alias("place_id"), F.col("_name").alias("name"), contact.postal_address(F.col("tags")).alias("address"), tag("addr:postcode").alias("plz"),
        contact.district(tag("addr:postcode")).alias("district"), F.array_compact(F.array("_key", F.when(F.coalesce(brand, F.lit("")) != "", F.concat(F.lit("brand:"), brand)))).alias("types"),
        score.type_of_tag(F.col("_key")).alias("primary_type"), F.coalesce(tag("website"), tag("contact:website")).alias("website"), F.coalesce(tag("phone"), tag("contact:phone")).alias("phone"),
        F.coalesce("lat", "center.lat", F.lit(0.0)).alias("lat"), F.coalesce("lon", "center.lon", F.lit(0.0)).alias("lng"),
    )
    return conform(out, CANDIDATE)


def map_dump(spark: SparkSession, path: str, plz: str | None = None) -> DataFrame:
    """A stored map dump (JSON) as candidates, of one postal code if given."""
    elements = spark.read.schema(ELEMENTS).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.*")
    found = map_elements(elements)
    return found if plz is None else found.where(F.col("plz") == plz)


def _plz(place: Column) -> Column:
    component = F.get(F.filter(place["addressComponents"], lambda c: F.array_contains(c["types"], "postal_code")), F.lit(0))["longText"]
    return contact.plz_of_place(component, place["formattedAddress"])


def _complete(place: Column) -> Column:
    """Whether a raw place has id, name and location."""
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    return there(place["id"]) & there(place["displayName"]["text"]) & place["location"]["latitude"].isNotNull() & place["location"]["longitude"].isNotNull()


def raw_places(places: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Raw places as candidates; those without id, name or location are left out. more: columns that stay in front."""
    place = F.struct("*")
    plz, named = _plz(place), places.where(_complete(place))
    out = named.select(
        *more, F.col("id").alias("place_id"), F.col("displayName.text").alias("name"), F.col("formattedAddress").alias("address"), plz.alias("plz"), contact.district(plz).alias("district"),
        F.coalesce("types", F.array().cast("array<string>")).alias("types"), F.col("primaryType").alias("primary_type"), F.col("websiteUri").alias("website"),
        F.coalesce("internationalPhoneNumber", "nationalPhoneNumber").alias("phone"), F.col("location.latitude").alias("lat"), F.col("location.longitude").alias("lng"),
    )
    ddl = "".join(f"{c} {out.schema[c].dataType.simpleString()}, " for c in more) + CANDIDATE
    return conform(out, ddl)


#: Pages that a search reads at most, and places that one page has at most.
MOST_PAGES, PAGE_SIZE = 5, 20


def paged_search(pages: DataFrame, most: int = PAGE_SIZE, plz: Column | None = None) -> DataFrame:
    """Query and candidates of stored answer pages, as a search with `most` results reads them: page after page, each asked for what is lacking (20 at most), until
    there is enough, the fifth page, the last one, or one that failed; then each place once.

    pages: query, page (from 0), more (whether another page follows), error, places. plz: of the rows of `pages`, the postal codes (array) that places may have, or null for any.
    What a page may give depends on those before it: a query's five pages at most are folded in one expression. Pages with a null query or number don't count; of equal ones the first by content does."""
    wanted = F.lit(None).cast("array<string>") if plz is None else plz
    read = pages.where(F.col("query").isNotNull() & F.col("page").between(0, MOST_PAGES - 1)).withColumn("_wanted", wanted)
    first = F.slice(F.coalesce("places", F.array()), 1, PAGE_SIZE)
    good = F.transform(first, lambda p: F.struct(p.alias("place"), (_complete(p) & F.coalesce(F.col("_wanted").isNull() | F.array_contains("_wanted", _plz(p)), F.lit(False))).alias("good")))
    one = read.select("query", F.struct("page", (F.coalesce("more", F.lit(False)) & F.col("error").isNull()).alias("more"), F.when(F.col("error").isNull(), good).otherwise(F.slice(good, 1, 0)).alias("found")).alias("_page"))
    listed = one.groupBy("query").agg(F.collect_list("_page").alias("_list"))
    by_page = lambda i: F.filter("_list", lambda x: x["page"] == i)
    pages_in_order = F.array_compact(F.array(*[F.get(by_page(i), F.lit(0)) for i in range(MOST_PAGES)]))
    start = F.struct(F.lit(0).alias("next"), F.lit(True).alias("open"), F.slice(F.flatten(F.transform("_list", lambda x: x["found"])), 1, 0).alias("taken"))

    def step(s: Column, x: Column) -> Column:
        on = s["open"] & (x["page"] == s["next"]) & (F.size(s["taken"]) < most)
        taken = F.filter(F.slice(x["found"], 1, F.least(F.lit(PAGE_SIZE), F.greatest(F.lit(most) - F.size(s["taken"]), F.lit(0)))), lambda p: p["good"])
        after = F.struct((s["next"] + 1).alias("next"), x["more"].alias("open"), F.concat(s["taken"], taken).alias("taken"))
        return F.when(on, after).otherwise(F.struct(s["next"], F.lit(False).alias("open"), s["taken"]))

    kept = listed.select("query", F.posexplode(F.aggregate(pages_in_order, start, step)["taken"]).alias("_nth", "_p")).select("query", "_nth", "_p.place.*")
    best = kept.groupBy("query", "id").agg(F.min_by(F.struct(*[c for c in kept.columns if c != "query"]), "_nth").alias("_r")).select("query", "_r.*")
    return raw_places(best, ("query", "_nth")).withColumnRenamed("_nth", "nth")


def places_dump(spark: SparkSession, path: str, plz: str | None = None) -> DataFrame:
    """Stored search answers (one JSON page each) as candidates, each place once."""
    pages = spark.read.schema(PLACES).option("multiLine", True).json(path)
    found = raw_places(pages.select(F.explode("places").alias("p")).select("p.*"))
    found = found if plz is None else found.where(F.col("plz") == plz)
    return dedupe.first_seen(found, "place_id", ["place_id"])
