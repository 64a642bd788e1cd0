"""Filters and row checks. Ids F1-F11, O1-O4, U6 of the survey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import contact, score
from ..schemas import FILTERED_LOG, conform
from . import joins, rows

ERROR_INTENTS = ("AUDIT_ERROR", "TIMEOUT")
CLOSED_SITE_INTENTS = ("AUDIT_ERROR", "TIMEOUT", "PARKED", "NONE")


def export_filter(df: DataFrame, tiers: list[str] | None = None, plz: list[str] | None = None, min_score: int = 0, max_score: int = 30) -> DataFrame:
    """F1, F2: rows with a score in range, of the tiers and postal codes. None is no filter, an empty list keeps nothing."""
    out = df.where(F.col("score").between(min_score, max_score))
    for name, wanted in (("tier", tiers), ("plz", plz)):
        if wanted is not None:
            out = out.where(F.col(name).isin(*wanted)) if wanted else out.limit(0)
    return out


def export_order(df: DataFrame, limit: int | None = None) -> DataFrame:
    """O1, O2: worst first: score down (null last), newest audit, then id; with a limit one top-k pass."""
    out = df.orderBy(F.desc_nulls_last("score"), F.desc("audited_at"), F.asc("place_id"))
    return out if limit is None else out.limit(limit)


def plz_filter(df: DataFrame, plz: list[str] | None, mode: str) -> DataFrame:
    """export rows whose effective postal code is wanted; `off`, or no list, keeps all."""
    if mode == "off" or not plz:
        return df
    return df.where(contact.effective_plz(mode, F.col("plz"), F.lit(None).cast("string"), F.col("name"), F.col("url")).isin(*plz))


def chain_candidates(candidates: DataFrame, blacklist: DataFrame, whitelist: DataFrame) -> DataFrame:
    """candidates with kept and reason: a whitelisted kind of place stays; a brand with a chain's name tokens and category goes."""
    return joins.chain_reasons(candidates, blacklist, whitelist)


def branch_pages(audits: DataFrame, patterns: list[joins.BranchPattern], settings: Settings) -> tuple[DataFrame, DataFrame]:
    """rows whose URL isn't a chain's branch page, and the log of the others."""
    matched = joins.branch_matches(audits, patterns, "discovered_url")
    kept = matched.where(F.col("_match").isNull()).drop("_match")
    log = matched.where(F.col("_match").isNotNull()).select(
        "place_id", F.col("_match.chain_name").alias("chain_name"), F.col("discovered_url").alias("url"), F.col("_match.pattern").alias("matched_pattern"), F.col("_match.reason").alias("reason"),
        F.lit(settings.as_of).cast("timestamp").alias("filtered_at"),
    )
    return kept, conform(log, FILTERED_LOG)


def of_tier(df: DataFrame, tier: str | None) -> DataFrame:
    """F6."""
    return df if tier is None else df.where(F.col("tier") == tier)


def stale(candidates: DataFrame, audits: DataFrame, settings: Settings) -> DataFrame:
    """Candidates to audit again: those without an audit whose static and speed signals both still hold."""
    now = F.lit(settings.as_of).cast("timestamp")
    fresh = audits.where((F.col("static_signals_expires_at") > now) & (F.col("psi_signals_expires_at") > now)).select("place_id").distinct()
    return candidates.join(fresh, "place_id", "left_anti")


def open_places(df: DataFrame, status: str = "business_status") -> DataFrame:
    """F8: without permanently closed places; an unknown status stays."""
    return df.where(~F.col(status).eqNullSafe("CLOSED_PERMANENTLY"))


def violations(audits: DataFrame, this_year: int) -> DataFrame:
    """place_id and rule of every broken invariant of an audit row."""
    c = F.col
    sub = score.sub_tier(c("tier"), c("score"))
    generic, email = contact.generic_class(c("impressum_email")), c("impressum_email")
    closed = c("tier") == "C"
    error = c("intent_tier").isNull() | c("intent_tier").isin(*ERROR_INTENTS)
    rules = {
        "score_without_tier": c("score").isNotNull() & (F.coalesce("tier", F.lit("")) == ""),
        "intent_without_score": c("intent_tier").isNotNull() & c("score").isNull() & ~c("intent_tier").isin(*ERROR_INTENTS),
        "closed_site_intent": closed & c("intent_tier").isNotNull() & ~c("intent_tier").isin(*CLOSED_SITE_INTENTS),
        "closed_site_score": closed & error & c("score").isNotNull(),
        "branch_count": c("branch_count").isNull() | (c("branch_count") < 1),
        "chain_name": c("chain_detected") & c("chain_name").isNull(),
        "chain_branches": c("chain_detected") & (c("branch_count") < 2),
        "no_chain_name": ~c("chain_detected") & c("chain_name").isNotNull(),
        "no_chain_branches": ~c("chain_detected") & (c("branch_count") != 1),
        "last_modified": c("last_modified_signal").isNotNull() & ~c("last_modified_signal").between(1995, this_year + 1),
        "sub_tier_of_other_tier": sub.isNotNull() & (c("tier") != "A"),
        "sub_tier_missing": sub.isNull() & (c("tier") == "A") & c("score").isNotNull(),
        "generic_without_email": generic.isNotNull() & email.isNull(),
        "email_without_generic": generic.isNull() & email.contains("@"),
    }
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return audits.select("place_id", F.explode(broken).alias("rule"))


def checked(audits: DataFrame, this_year: int) -> DataFrame:
    """the rows themselves; the first broken invariant ends the query that reads them."""
    bad = violations(audits, this_year).limit(1).collect()
    if bad:
        raise ValueError(f"export invariant violated (row {bad[0].place_id}): {bad[0].rule}")
    return audits


def score_drift(audits: DataFrame) -> DataFrame:
    """rows whose stored score isn't what their signals give now."""
    now = score.total(rows.breakdown_of())
    return audits.select("place_id", F.col("score").alias("stored"), now.alias("recomputed")).where(F.col("stored").isNotNull() & (F.col("stored") != F.col("recomputed")))


def budgeted(df: DataFrame, seed: str, order: list[str], per_seed: int, most: int) -> DataFrame:
    """At most per_seed rows of each seed and `most` in all, in the order of seed and place."""
    w = Window.partitionBy(seed).orderBy(*order)
    within = df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= per_seed).drop("_nth")
    return within.orderBy(seed, *order).limit(most)


def within_daily_quota(requests: DataFrame, at: str, tie: str, quota: int) -> DataFrame:
    """Requests with allowed: the first `quota` of each UTC day."""
    w = Window.partitionBy(F.to_date(at)).orderBy(at, tie)
    return requests.withColumn("allowed", F.row_number().over(w) <= quota)


def longest_rule(path: Column, rules: Column) -> Column:
    """whether robots rules (array of structs allow, path) allow a path: the longest prefix decides, allow wins ties, none allows."""
    fits = F.filter(rules, lambda r: path.startswith(r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["path"]).alias("n"), r["allow"].alias("allow"))))
    return F.coalesce(best["allow"], F.lit(True))


def unexpired(cache: DataFrame, at: str, as_of: Column, ttl_days: int) -> DataFrame:
    """Cache entries younger than their time to live, with their age in days."""
    age = (F.unix_seconds(as_of) - F.unix_seconds(F.col(at).cast("timestamp"))) / 86_400
    return cache.withColumn("age_days", age).where(F.col("age_days") < ttl_days)
