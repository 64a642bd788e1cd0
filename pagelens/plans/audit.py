"""The audit from candidates to stored rows, export and report, as DataFrame stages.

Everything up to the audit rows is narrow but for key joins with fetched pages; then the apex groups, the URL groups and the upsert each shuffle once.
What several later stages read is written to the shared folder once: discovered pages, parsed pages, contacts, audit rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..config import Settings
from ..functions import detect, html, score
from ..operators import dedupe, filters, joins, rows
from ..schemas import AUDIT, conform


@dataclass(frozen=True)
class Inputs:
    """What was fetched: fetches (pages), psi, robots (origin, rules), place matches, search links, public-suffix rules; all but the first may be missing."""

    fetches: DataFrame
    psi: DataFrame | None = None
    robots: DataFrame | None = None
    matches: DataFrame | None = None
    search_links: DataFrame | None = None
    suffixes: DataFrame | None = None


@dataclass(frozen=True)
class Result:
    rows: DataFrame
    filtered_log: DataFrame
    collapsed_log: DataFrame
    duplicate_log: DataFrame


def _robots(inputs: Inputs) -> DataFrame:
    spark = inputs.fetches.sparkSession
    return inputs.robots if inputs.robots is not None else spark.range(0).select(F.lit("").alias("origin"), F.array().cast("array<struct<allow:boolean,path:string>>").alias("rules"))


def audit_rows(candidates: DataFrame, inputs: Inputs, settings: Settings) -> DataFrame:
    """One audit row for each candidate (none for permanently closed places)."""
    if settings.b3_enrichment and inputs.matches is not None:
        matched = joins.place_matches(candidates, inputs.matches, F.lit(settings.as_of).cast("timestamp"), settings.places_ttl_days)
        # only candidates without a site ask for a match
        lacking = F.coalesce(F.nullif(F.col("website"), F.lit("")), F.lit("")) == ""
        plain = candidates.where(~lacking)
        candidates = plain.unionByName(matched.join(candidates.where(lacking).select("place_id"), "place_id", "left_semi").where("verdict <> 'drop'").select(*plain.columns))
    found = joins.discovered(candidates, inputs.fetches, inputs.search_links, settings.dns_probe)
    found = found.withColumn("body", F.when(F.col("fetch_error").isNull(), F.col("body"))).withColumn("headers", F.when(F.col("fetch_error").isNull(), F.col("headers")))
    has_url = F.col("discovered_url").isNotNull()
    tier = score.tier(has_url, F.col("fetch_error"), F.lit(0), F.lit(0))
    intent = score.intent(tier, has_url, F.col("fetch_error"))
    verdict = F.when(F.col("body").isNotNull(), detect.parking(F.col("body"), F.col("headers"))["verdict"])
    tier_now, intent_now = score.parked(tier, intent, F.col("_verdict"))
    staged = tables.written(found.withColumn("_verdict", verdict).withColumns({"tier": tier_now, "intent_tier": intent_now}).drop("_verdict"), "discovered")

    others = rows.empty_rows(staged.where("tier <> 'A'"), settings)
    live = joins.with_robots(staged.where("tier = 'A'"), _robots(inputs), "discovered_url")
    excluded = rows.robots_rows(live.where("NOT robots_allowed"), settings)
    pages = tables.written(live.where("robots_allowed").withColumn("facts", html.page_facts("body")), "parsed")
    imprint = tables.written(joins.imprints(pages.select("place_id", "discovered_url", "final_url", "facts"), inputs.fetches), "imprints")
    pages = pages.join(imprint, "place_id", "left")
    if settings.impressum_scraper:
        scraped = joins.contacts(pages.where(F.col("website").isNotNull()).select("place_id", "website", "final_url", "facts"), inputs.fetches, _robots(inputs))
        scraped = tables.written(scraped, "contacts")
        pages = pages.join(scraped, "place_id", "left")
        absent = F.struct(F.lit(False).alias("present"), *[F.lit(None).cast("string").alias(n) for n in ("url", "uid", "company_name", "address", "phone", "email")], F.lit(False).alias("complete"))
        pages = pages.withColumn("impressum", rows.merged_impressum(F.coalesce("impressum", absent), F.col("contact")))
        pages = pages.withColumns({"address": F.coalesce("address", "contact.address"), "phone": F.coalesce("phone", "contact.phone")})
    body, headers = F.col("body"), F.col("headers")
    stack = detect.tech_stack(body, headers)
    pages = tables.written(pages.withColumn("_stack", stack), "stacks")
    named = F.array(detect.cms(body, headers, F.col("_stack.cms")))
    pages = pages.withColumns(
        {
            "viewport": F.struct(F.col("facts.has_viewport").alias("present"), F.col("facts.viewport").alias("content")),
            "tech_stack": F.col("_stack").withField("cms", named),
            "social_links": detect.social_links(html.hrefs(F.col("facts"))),
            "schema_org": html.schema_org(F.col("facts")),
            "last_modified_signal": detect.last_modified_year(body, headers, settings.as_of.year),
        }
    )
    if inputs.psi is not None:
        pages = joins.with_psi(pages, inputs.psi, "discovered_url")
    else:
        pages = pages.withColumn("psi", F.lit(None).cast("struct<performance:int,seo:int,accessibility:int,best_practices:int,fetched_at:timestamp,error:string>"))
    audited = rows.audited_rows(pages, settings)
    return tables.written(conform(others.unionByName(excluded).unionByName(audited), AUDIT), "audited")


def run(candidates: DataFrame, inputs: Inputs, settings: Settings, patterns: list[joins.BranchPattern], apex_audits: DataFrame | None = None, only_tier: str | None = None) -> Result:
    """Audit rows without branch pages, collapsed by apex, one for each page, of one tier if asked for; and this run's logs."""
    audited = audit_rows(candidates, inputs, settings)
    kept, filtered = filters.branch_pages(audited, patterns, settings)
    if apex_audits is None:
        apex_audits = audited.limit(0).withColumn("apex", F.lit(""))
    survivors, dropped, collapsed = dedupe.by_apex(conform(kept, AUDIT), apex_audits, settings, inputs.suffixes)
    unique, duplicates = dedupe.by_url(survivors, settings)
    return Result(filters.of_tier(unique, only_tier), filtered.unionByName(dropped), collapsed, duplicates)
