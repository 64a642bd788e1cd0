"""Joins with dimensions and side tables. Ids J1-J14 of the survey.

Dimensions are tables of fixed, small size that the package ships or that are counted before they are broadcast; side tables that grow with the data are joined on keys.
Pages carry a merge hint: Spark guesses their size from the compressed files and would send them whole through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html, js, score, text, url

#: Rows and characters (as JSON) up to which a counted dimension is broadcast.
BROADCAST_ROWS, BROADCAST_CHARS = 100_000, 16_000_000


@dataclass(frozen=True)
class BranchPattern:
    pattern: str
    chain_name: str
    reason: str


def dimension(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint if it is counted to be small, in rows and in size."""
    rows, chars = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and chars <= BROADCAST_CHARS else df


def chain_reasons(candidates: DataFrame, blacklist: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Kept and reason of each candidate. blacklist: id, tokens, categories, ordinal; whitelist: key, value.

    The blacklist is joined on category, then its tokens have to be among the name's; the first entry in file order counts."""
    base = candidates.withColumn("_tag", text.osm_tag(F.col("types"))).withColumn("_tokens", text.name_tokens(F.col("name"))).withColumn("_brand", text.has_brand(F.col("types")))
    white = dimension(whitelist.select(F.concat_ws("=", "key", "value").alias("_tag"), F.concat(F.lit("whitelist:"), F.concat_ws(":", "key", "value")).alias("_white")).distinct())
    entries = blacklist.select(F.explode("categories").alias("_tag"), "id", "tokens", "ordinal")
    by_category = dimension(entries.groupBy("_tag").agg(F.sort_array(F.collect_list(F.struct("ordinal", "id", "tokens"))).alias("_entries")))
    joined = base.join(white, "_tag", "left").join(by_category, "_tag", "left")
    hit = F.get(F.filter("_entries", lambda e: F.size(F.array_except(e["tokens"], F.col("_tokens"))) == 0), F.lit(0))
    bad = F.when(F.col("_brand") & hit.isNotNull(), F.concat(F.lit("blacklist:"), F.col("_tag"), F.lit(":"), hit["id"]))
    out = joined.withColumn("kept", F.col("_white").isNotNull() | bad.isNull()).withColumn("reason", F.coalesce("_white", bad, F.lit("keep:no-match")))
    return out.select(*candidates.columns, "kept", "reason")


def branch_matches(df: DataFrame, patterns: list[BranchPattern], url_column: str) -> DataFrame:
    """Df with _match: the first pattern that a URL fits (struct of pattern, chain_name, reason), else null. The few patterns are one expression."""
    kind = "struct<pattern:string,chain_name:string,reason:string>"
    page, out = F.col("_page"), F.lit(None).cast(kind)
    for p in reversed(patterns):
        value = F.struct(F.lit(p.pattern).alias("pattern"), F.lit(p.chain_name).alias("chain_name"), F.lit(p.reason).alias("reason"))
        out = F.when(page.rlike(url.pattern_regex(p.pattern)), value).otherwise(out)
    return df.withColumn("_page", url.host_and_path(F.col(url_column))).withColumn("_match", out).drop("_page")


def with_industry(candidates: DataFrame) -> DataFrame:
    """J4."""
    return candidates.withColumn("industry", score.industry(F.col("types"), F.col("primary_type")))


def with_robots(df: DataFrame, robots: DataFrame, url_column: str) -> DataFrame:
    """Df with robots_allowed. robots: origin, rules (array of structs allow, path). A site without rules allows all."""
    from .filters import longest_rule

    origin = F.concat(url.scheme(F.col(url_column)), F.lit("://"), url.host(F.col(url_column)))
    joined = df.withColumn("_origin", origin).join(robots.select(F.col("origin").alias("_origin"), "rules"), "_origin", "left")
    allowed = F.when(F.col("rules").isNull(), F.lit(True)).otherwise(longest_rule(url.pathname(F.col(url_column)), F.col("rules")))
    return joined.withColumn("robots_allowed", allowed).select(*df.columns, "robots_allowed")


def labelled(outcomes: DataFrame, audits: DataFrame) -> DataFrame:
    """Outcomes, newest first, with score and features of the lead's audit; a lead without audit has null ones."""
    from .rows import feature_snapshot

    snapshot = audits.select(F.col("place_id").alias("lead_id"), "score", feature_snapshot().alias("features"))
    return outcomes.join(snapshot, "lead_id", "left").select("lead_id", "status", "channel", "notes", "created_at", "score", "features", "id").orderBy(F.desc("created_at"), F.desc("id")).drop("id")


def place_matches(candidates: DataFrame, matches: DataFrame, as_of: Column, ttl_days: int) -> DataFrame:
    """Candidates with verdict and gaps filled from a place match on name and address that isn't older than its time to live.

    matches: key, website, phone, address, business_status, created_at."""
    keyed = candidates.withColumn("_key", text.cache_key(F.col("name"), F.col("address")))
    status = F.when(F.col("business_status").isin("OPERATIONAL", "CLOSED_TEMPORARILY", "CLOSED_PERMANENTLY"), F.col("business_status"))
    fresh = matches.where(F.col("created_at") + F.make_dt_interval(F.lit(ttl_days)) > as_of).select(
        F.col("key").alias("_key"), F.col("website").alias("_website"), F.col("phone").alias("_phone"), F.col("address").alias("_address"), status.alias("_status"), F.lit(True).alias("_found")
    )
    joined = keyed.join(fresh, "_key", "left")
    out = joined.withColumns({"website": F.coalesce("website", "_website"), "phone": F.coalesce("phone", "_phone"), "address": F.coalesce("address", "_address")})
    return out.withColumn("verdict", score.match_verdict(F.coalesce("_found", F.lit(False)), F.col("_status"))).select(*candidates.columns, "verdict")


def by_dns_guess(candidates: DataFrame, fetches: DataFrame) -> DataFrame:
    """place_id and url of the first guessed domain whose page is the candidate's. Names of branches, and none, have no guess."""
    able = candidates.where(F.col("name").isNotNull() & (F.trim("name") != "") & ~text.is_branch_name(F.col("name")))
    guessed = able.select("place_id", "name", "plz", "phone", F.posexplode(text.domain_guesses(F.col("name"))).alias("_nth", "_domain"))
    pages = fetches.where(F.col("error").isNull() & (F.col("status") < 400)).select(F.col("url").alias("_url"), "body")
    met = guessed.withColumn("_url", F.concat(F.lit("https://"), "_domain")).join(pages.hint("merge"), "_url").where(text.validates(F.col("body"), F.col("name"), F.col("plz"), F.col("phone")))
    return met.groupBy("place_id").agg(F.min_by("_url", "_nth").alias("url"))


def by_directory_search(candidates: DataFrame, search_links: DataFrame, fetches: DataFrame) -> DataFrame:
    """place_id and url of the first directory hit whose page names a public site that is the candidate's.

    search_links: place_id, query_rank, link_rank, link."""
    pages = fetches.where(F.col("error").isNull() & (F.col("status") < 400)).select(F.col("url").alias("link"), F.col("body").alias("_page"))
    met = search_links.join(pages.hint("merge"), "link").withColumn("_facts", html.page_facts("_page")).withColumn("url", html.directory_site(F.col("link"), F.col("_facts"))).where(F.col("url").isNotNull())
    sites = fetches.where(F.col("error").isNull() & (F.col("status") < 400)).select(F.col("url"), F.col("body").alias("_site"))
    good = met.join(sites.hint("merge"), "url").join(candidates.select("place_id", "name", "plz", "phone").hint("merge"), "place_id").where(text.validates(F.col("_site"), F.col("name"), F.col("plz"), F.col("phone")))
    return good.groupBy("place_id").agg(F.min_by("url", F.struct("query_rank", "link_rank")).alias("url"))


def discovered(candidates: DataFrame, fetches: DataFrame, search_links: DataFrame | None = None, dns: bool = False) -> DataFrame:
    """Candidates with discovered_url, discovery_method and the page's fetch columns: the map's own site, else a guessed domain, else a directory hit."""
    out = candidates.withColumn("_dns", F.lit(None).cast("string")).withColumn("_cse", F.lit(None).cast("string"))
    if dns:
        out = out.drop("_dns").join(by_dns_guess(candidates, fetches).withColumnRenamed("url", "_dns"), "place_id", "left")
    if search_links is not None:
        out = out.drop("_cse").join(by_directory_search(candidates, search_links, fetches).withColumnRenamed("url", "_cse"), "place_id", "left")
    site = js.null_if_empty(F.col("website"))
    method = F.when(site.isNotNull(), F.lit("osm-tag")).when(F.col("_dns").isNotNull(), F.lit("dns-probe")).when(F.col("_cse").isNotNull(), F.lit("cse"))
    out = out.withColumn("discovered_url", F.coalesce(site, "_dns", "_cse")).withColumn("discovery_method", method).drop("_dns", "_cse")
    pages = fetches.withColumnRenamed("url", "discovered_url").withColumnRenamed("error", "fetch_error").withColumn("_fetched", F.lit(True))
    joined = out.join(pages.hint("merge"), "discovered_url", "left")
    missing = F.col("discovered_url").isNotNull() & F.col("_fetched").isNull()
    return joined.withColumn("fetch_error", F.when(missing, F.lit("UNKNOWN")).otherwise(F.col("fetch_error"))).drop("_fetched")


def resolved_districts(inputs: DataFrame, districts: DataFrame, column: str) -> DataFrame:
    """Df with the district's plz by postal code, number or name; null if none fits. districts: number, name, plz."""
    raw = js.trim(F.col(column))
    by = F.when(raw.rlike(r"\A[0-9]{4}\z"), raw).when(raw.rlike(r"\A[0-9]{1,2}\z"), raw.cast("int").cast("string")).otherwise(text.canonical(raw))
    keys = districts.select(F.explode(F.array(F.col("plz"), F.col("number").cast("string"), text.canonical(F.col("name")))).alias("_key"), F.col("plz").alias("district_plz"))
    return inputs.withColumn("_key", by).join(dimension(keys), "_key", "left").drop("_key")


def imprints(sites: DataFrame, fetches: DataFrame, site: str = "discovered_url") -> DataFrame:
    """place_id and impressum (struct) of each site: of the imprint links on its home page and the usual paths, the first page that answers.

    sites: place_id, the site's column, facts of its home page, final_url."""
    links = html.joined_urls(F.coalesce("final_url", site), html.imprint_links(F.col("facts")))
    paths = html.joined_urls(F.col(site), F.array(*[F.lit(p) for p in html.IMPRESSUM_PATHS]))
    tried = sites.select("place_id", F.posexplode(F.array_distinct(F.concat(links, paths))).alias("_nth", "_url"))
    pages = fetches.where((F.col("status") == 200) & (F.length("body") > 0)).select(F.col("url").alias("_url"), F.col("body").alias("_body"), F.col("final_url").alias("_final"))
    first = tried.join(pages.hint("merge"), "_url").groupBy("place_id").agg(F.min_by(F.struct("_url", "_body", "_final"), "_nth").alias("_page"))
    parsed = first.withColumn("_facts", html.page_facts("_page._body"))
    return parsed.select("place_id", html.imprint(F.col("_facts"), F.coalesce("_page._final", "_page._url")).alias("impressum"))


def contacts(sites: DataFrame, fetches: DataFrame, robots: DataFrame, site: str = "website") -> DataFrame:
    """place_id and contact of each site: its home page and contact pages, at most three, that robots rules allow, merged in order.

    sites: place_id, the site's column, facts of its home page, final_url."""
    words = ("impressum", "imprint", "kontakt")
    links = html.joined_urls(F.coalesce("final_url", site), html.imprint_links(F.col("facts"), words))
    paths = html.joined_urls(F.col(site), F.array(*[F.lit(p) for p in html.CONTACT_PATHS]))
    every = F.array_distinct(F.concat(F.array(F.col(site)), links, paths))
    tried = with_robots(sites.select("place_id", F.posexplode(every).alias("_nth", "_url")), robots, "_url")
    # the first three allowed pages are visited, whatever they answer
    per = tried.groupBy("place_id").agg(F.max(~F.col("robots_allowed")).alias("robots_blocked"), F.slice(F.sort_array(F.collect_list(F.when(F.col("robots_allowed"), F.struct("_nth", "_url")))), 1, html.MAX_CONTACT_PAGES).alias("_visits"))
    visits = per.select("place_id", "robots_blocked", F.inline_outer("_visits"))
    pages = fetches.where((F.col("status") == 200) & F.col("error").isNull() & (F.length("body") > 0)).select(F.col("url").alias("_url"), F.col("body").alias("_body"), F.coalesce("final_url", "url").alias("_final"))
    met = visits.join(pages.hint("merge"), "_url", "left").withColumn("_facts", html.page_facts("_body")).withColumn("_parsed", F.when(F.col("_body").isNotNull(), html.contact_page(F.col("_facts"), F.col("_body"))))
    known = (F.coalesce("_parsed.email", F.lit("")) != "") | (F.coalesce("_parsed.phone", F.lit("")) != "") | (F.coalesce("_parsed.address", F.lit("")) != "")
    found = met.groupBy("place_id").agg(
        F.max("robots_blocked").alias("robots_blocked"), F.sort_array(F.collect_list(F.when(F.col("_parsed").isNotNull(), F.struct("_nth", "_parsed")))).alias("_pages"),
        F.min_by("_final", F.when(known & (F.col("_nth") > 0), F.col("_nth"))).alias("impressum_url"),
    )
    best = html.merged_pages(F.transform("_pages", lambda p: p["_parsed"]))
    from ..functions import contact

    out = found.withColumn("_best", best)
    return out.select(
        "place_id",
        F.struct(
            "impressum_url", *[F.col(f"_best.{n}").alias(n) for n in ("email", "emails", "phone", "address", "plz", "company_name", "uid")],
            contact.coverage(F.col("_best.phone"), F.col("_best.email"), F.col("_best.address")).alias("coverage"), "robots_blocked",
        ).alias("contact"),
    )


def with_psi(df: DataFrame, psi: DataFrame, url_column: str) -> DataFrame:
    """Df with psi (struct of scores 0 to 100). psi: url and raw scores 0 to 1, fetched_at, error."""
    scaled = [F.round(F.col(c) * 100).cast("int").alias(c) for c in ("performance", "seo", "accessibility", "best_practices")]
    return df.join(psi.select(F.col("url").alias(url_column), F.struct(*scaled, F.col("fetched_at").cast("timestamp").alias("fetched_at"), "error").alias("psi")), url_column, "left")


