"""Projections that build audit rows and export rows. Ids P1-P7, K2 of the survey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import contact, score, text, url
from ..schemas import AUDIT, EXPORT, TECH_STACK, conform

FEATURES = (
    "tier", "discovered_url", "discovery_method", "ssl_valid", "http_to_https_redirect", "has_viewport_meta", "viewport_meta_content", "psi_mobile_performance", "psi_mobile_seo",
    "psi_mobile_accessibility", "psi_mobile_best_practices", "impressum_url", "impressum_present", "impressum_uid", "impressum_company_name", "impressum_address", "impressum_phone", "impressum_email",
    "impressum_complete", "tech_stack", "generic_emails", "social_links", "intent_tier", "last_modified_signal", "has_structured_data",
)


def no_strings() -> Column:
    return F.array().cast("array<string>")


def no_tech() -> Column:
    return F.struct(*[no_strings().alias(b) for b in ("cms", "pageBuilder", "analytics", "tracking", "payment", "cdn")]).cast(TECH_STACK)


def no_links() -> Column:
    return F.create_map().cast("map<string,string>")


def breakdown_of(tier: Column | None = None, intent: Column | None = None) -> Column:
    """A2 of a row with audit columns."""
    c = F.col
    return score.breakdown(
        c("tier") if tier is None else tier, c("intent_tier") if intent is None else intent, c("ssl_valid"), c("http_to_https_redirect"), c("has_viewport_meta"), c("psi_mobile_performance"), c("impressum_present"),
        c("impressum_complete"), c("impressum_uid"), c("tech_stack.cms"), c("tech_stack.analytics"), c("tech_stack.tracking"), F.size("social_links"), F.coalesce("has_structured_data", F.lit(False)),
    )


def _days_after(at: Column, days: int) -> Column:
    return at + F.make_dt_interval(F.lit(days))


def empty_rows(df: DataFrame, settings: Settings) -> DataFrame:
    """Rows without signals. df: candidate columns, discovered_url, discovery_method, fetch_error, tier, intent_tier.

    The candidate's own contact stays visible; a broken site's intent is NONE; the score follows from the tier (6 for a reachable site that robots rules exclude)."""
    now = F.lit(settings.as_of).cast("timestamp")
    intent = F.when((F.col("tier") == "C") & (F.col("intent_tier") == "DEAD"), F.lit("NONE")).otherwise(F.col("intent_tier"))
    out = df.select(
        "place_id", now.alias("audited_at"), "tier", "discovered_url", "discovery_method", F.lit(False).alias("impressum_present"), F.col("address").alias("impressum_address"), F.col("phone").alias("impressum_phone"),
        no_tech().alias("tech_stack"), no_strings().alias("generic_emails"), no_links().alias("social_links"), "fetch_error", F.when(F.col("fetch_error").isNotNull(), now).alias("fetch_error_at"),
        intent.alias("intent_tier"), _days_after(now, settings.static_ttl_days).alias("static_signals_expires_at"), F.lit(False).alias("chain_detected"), F.lit(1).alias("branch_count"), F.lit(False).alias("has_structured_data"),
    )
    out = conform(out, AUDIT)
    return conform(out.withColumn("score", score.total(breakdown_of())), AUDIT)


def robots_rows(df: DataFrame, settings: Settings) -> DataFrame:
    """Rows of reachable sites that robots rules exclude."""
    return empty_rows(df.withColumns({"tier": F.lit("A"), "intent_tier": F.lit("LIVE"), "fetch_error": F.lit("ROBOTS_DISALLOWED")}), settings)


def audited_rows(df: DataFrame, settings: Settings) -> DataFrame:
    """Rows of reachable sites. df: candidate and discovery columns, intent_tier, the transport columns, viewport, tech_stack, social_links, schema_org,
    impressum, last_modified_signal, and psi (struct)."""
    now, c = F.lit(settings.as_of).cast("timestamp"), F.col
    none = F.lit(None)
    out = df.select(
        "place_id", now.alias("audited_at"), F.lit("A").alias("tier"), "discovered_url", "discovery_method", "ssl_valid", "ssl_expires_at", c("http_to_https").alias("http_to_https_redirect"),
        c("viewport.present").alias("has_viewport_meta"), c("viewport.content").alias("viewport_meta_content"), c("psi.performance").alias("psi_mobile_performance"), c("psi.seo").alias("psi_mobile_seo"),
        c("psi.accessibility").alias("psi_mobile_accessibility"), c("psi.best_practices").alias("psi_mobile_best_practices"), c("psi.fetched_at").alias("psi_fetched_at"), c("impressum.url").alias("impressum_url"),
        F.coalesce(c("impressum.present"), F.lit(False)).alias("impressum_present"), c("impressum.uid").alias("impressum_uid"), text.company_name(c("impressum.company_name")).alias("impressum_company_name"),
        F.coalesce(c("impressum.address"), c("address")).alias("impressum_address"), c("impressum.phone").alias("impressum_phone"), c("impressum.email").alias("impressum_email"),
        c("impressum.complete").alias("impressum_complete"), "tech_stack", F.array_compact(F.array("impressum.email")).alias("generic_emails"), "social_links", c("psi.error").alias("fetch_error"),
        F.when(c("psi.error").isNotNull(), now).alias("fetch_error_at"), "intent_tier", _days_after(now, settings.static_ttl_days).alias("static_signals_expires_at"),
        _days_after(now, settings.psi_ttl_days).alias("psi_signals_expires_at"), F.lit(False).alias("chain_detected"), none.alias("chain_name"), F.lit(1).alias("branch_count"), "last_modified_signal",
        c("schema_org.has_schema_org").alias("has_structured_data"),
    )
    out = conform(out, AUDIT)
    return conform(out.withColumn("score", score.total(breakdown_of())), AUDIT)


def error_rows(df: DataFrame, settings: Settings, tier: str = "C") -> DataFrame:
    """K2: marker rows of failed audits. df: place_id and error. Score and intent are null."""
    now = F.lit(settings.as_of).cast("timestamp")
    out = df.select(
        "place_id", now.alias("audited_at"), F.lit(tier).alias("tier"), F.col("error").alias("fetch_error"), now.alias("fetch_error_at"), F.lit(False).alias("impressum_present"), no_tech().alias("tech_stack"),
        no_strings().alias("generic_emails"), no_links().alias("social_links"), _days_after(now, settings.static_ttl_days).alias("static_signals_expires_at"), F.lit(False).alias("chain_detected"),
        F.lit(1).alias("branch_count"), F.lit(False).alias("has_structured_data"),
    )
    return conform(out, AUDIT)


def export_rows(audits: DataFrame) -> DataFrame:
    """The 25 columns of the export; sub_tier and the breakdown are derived here."""
    c = F.col
    out = audits.select(
        "place_id", "tier", score.sub_tier(c("tier"), c("score")).alias("sub_tier"), "intent_tier", "chain_detected", "chain_name", "branch_count", "score",
        F.coalesce("impressum_company_name", url.host_title(c("discovered_url"))).alias("name"), c("discovered_url").alias("url"), c("impressum_phone").alias("phone"), c("impressum_email").alias("email"),
        contact.generic_class(c("impressum_email")).alias("email_is_generic"), c("impressum_address").alias("address"), contact.plz_of_address(c("impressum_address")).alias("plz"), c("impressum_uid").alias("uid"),
        "impressum_complete", "psi_mobile_performance", "ssl_valid", F.array_join("tech_stack.cms", ",").alias("cms"), "has_structured_data", "last_modified_signal", (F.size("social_links") > 0).alias("has_social"),
        "audited_at", breakdown_of().alias("score_breakdown"),
    )
    return conform(out, EXPORT)


def feature_snapshot() -> Column:
    """P5: the features of an audit row as one struct."""
    return F.struct(*[F.col(f) for f in FEATURES])


def filled(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Columns whose gaps another column fills: existing first."""
    return df.withColumns({to: F.coalesce(to, of) for to, of in pairs.items()})


def merged_impressum(own: Column, scraped: Column) -> Column:
    """An imprint filled from a scraped contact; completeness is judged anew where there is one."""
    first = {n: F.coalesce(own[n], scraped[n]) for n in ("uid", "company_name", "address", "phone", "email")}
    complete = first["uid"].isNotNull() & first["company_name"].isNotNull() & first["address"].isNotNull()
    merged = F.struct(
        (own["present"] | scraped["impressum_url"].isNotNull()).alias("present"), F.coalesce(own["url"], scraped["impressum_url"]).alias("url"),
        *[first[n].alias(n) for n in ("uid", "company_name", "address", "phone", "email")], complete.alias("complete"),
    )
    return F.when(scraped.isNull(), own).otherwise(merged)


def renamed(audits: DataFrame) -> DataFrame:
    """The rows whose company name today's rules would write differently, with the new name."""
    new = text.company_name(F.col("impressum_company_name"))
    changed = audits.where(~F.col("impressum_company_name").eqNullSafe(new))
    return conform(changed.withColumn("impressum_company_name", new), AUDIT)
