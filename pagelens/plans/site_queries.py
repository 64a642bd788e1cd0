"""Queries over made sites: every row's page, headers and outcome follow from its number and host, so that rules meet in many combinations; SQL derives the results from the same numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contact, detect, html, score, text
from ..operators import filters, joins, rows
from ..schemas import AUDIT, conform
from . import audit as audit_plan
from .queries import _BARE as _BARE_HOST
from .queries import SETTINGS, query, table


def _n() -> Column:
    return F.col("page_id")


def _part(test: Column, html: str | Column) -> Column:
    """HTML that stands in the page where the test holds."""
    return F.when(test, F.lit(html) if isinstance(html, str) else html).otherwise(F.lit(""))


# --- the audit

_KIND = "CASE WHEN page_id % 13 = 3 THEN 'none' WHEN page_id % 11 = 5 THEN 'error' WHEN page_id % 17 = 2 AND page_id % 31 >= 2 THEN 'robots' WHEN page_id % 19 = 4 THEN 'parked' ELSE 'live' END"
_SITE = "CASE WHEN page_id % 23 = 0 THEN 'filiale.s' || page_id || '.at' WHEN page_id % 29 = 0 THEN 'b' || page_id || '.kette' || (page_id % 3) || '.at' WHEN page_id % 31 < 2 THEN 'dup' || (page_id % 10) || '.at' ELSE 's' || page_id || '.at' END"
_URL = f"'https://' || CASE WHEN page_id % 3 = 0 THEN 'www.' ELSE '' END || {_SITE} || '/' || CASE WHEN page_id % 31 < 2 AND page_id % 23 <> 0 AND page_id % 29 <> 0 THEN '?utm_source=x' || page_id ELSE '' END"
_ERRORS = ("CERT_EXPIRED", "HTTP_5XX", "DNS_FAIL", "TIMEOUT", "HTTP_4XX", "UNKNOWN")
_RULES = (
    ("NO_WEBSITE", 20, "tier = 'B3'"), ("DOMAIN_REGISTERED_NO_SITE", 22, "tier = 'C' AND kind = 'parked'"), ("DEAD_WEBSITE", 9, "tier = 'C' AND kind = 'error'"), ("NO_SSL", 3, "seen AND NOT ssl"), ("NO_HTTPS_REDIRECT", 2, "seen AND NOT redirect"),
    ("NO_MOBILE_VIEWPORT", 3, "seen AND NOT viewport"), ("PSI_POOR", 3, "seen AND psi < 50"), ("PSI_MEDIUM", 1, "seen AND psi >= 50 AND psi < 75"), ("PSI_EXCELLENT", -1, "seen AND psi > 85"),
    ("NO_IMPRESSUM", 3, "tier = 'A' AND NOT coalesce(imprint, FALSE)"), ("IMPRESSUM_INCOMPLETE", 2, "seen AND imprint AND NOT has_uid"), ("NO_UID", 1, "seen AND imprint AND NOT has_uid"), ("WIX_OR_JIMDO_OR_WEEBLY", 2, "seen AND cms = 'wix'"),
    ("NO_ANALYTICS", 1, "tier = 'A' AND NOT coalesce(analytics, FALSE)"), ("NO_MODERN_TRACKING", 1, "tier = 'A' AND NOT coalesce(tracking, FALSE)"), ("NO_SOCIAL_LINKS", 1, "tier = 'A' AND NOT coalesce(social, FALSE)"), ("HAS_STRUCTURED_DATA", -1, "seen AND structured"),
)
_STATE = f"""a AS (SELECT page_id AS i, {_KIND} AS kind, {_SITE} AS site, {_URL} AS url, {list(_ERRORS)}[CAST(page_id % 6 AS INTEGER) + 1] AS error FROM pages),
b AS (SELECT *, CASE WHEN kind = 'none' THEN 'B3' WHEN kind = 'error' THEN CASE WHEN error IN ('CERT_EXPIRED', 'HTTP_5XX', 'DNS_FAIL') THEN 'C' ELSE 'B3' END WHEN kind = 'parked' THEN 'C' ELSE 'A' END AS tier, kind = 'live' AS seen FROM a),
c AS (SELECT i, kind, site, CASE WHEN kind <> 'none' THEN url END AS url, tier, seen, CASE WHEN seen THEN i % 10 <> 0 END AS ssl, CASE WHEN seen THEN i % 8 <> 0 END AS redirect, CASE WHEN seen THEN i % 2 = 0 END AS viewport,
CASE WHEN seen AND i % 12 <> 0 THEN i % 101 END AS psi, CASE WHEN seen THEN i % 3 = 1 AND NOT starts_with(site, 'dup') END AS imprint, i % 9 <> 1 AS has_uid, CASE WHEN seen THEN (['static_or_custom', 'wix', 'wordpress', 'joomla', 'nextjs'])[CAST(i % 5 AS INTEGER) + 1] END AS cms,
CASE WHEN seen THEN i % 6 < 3 END AS analytics, CASE WHEN seen THEN i % 4 = 0 END AS tracking, CASE WHEN seen THEN i % 7 < 4 END AS social, CASE WHEN seen THEN i % 6 = 0 END AS structured FROM b),
d AS (SELECT *, list_filter([{', '.join(f"{{'k': '{k}', 'd': {d}, 'o': coalesce({on}, FALSE)}}" for k, d, on in _RULES)}], lambda r: r.o) AS fired FROM c),
e AS (SELECT *, CAST(greatest(0, least(30, coalesce(list_sum(list_transform(fired, lambda r: r.d)), 0))) AS INTEGER) AS score, array_to_string(list_transform(fired, lambda r: r.k || CASE WHEN r.d >= 0 THEN '+' ELSE '' END || r.d), '; ') AS breakdown FROM d WHERE url IS NULL OR NOT starts_with(site, 'filiale.')),
g AS (SELECT regexp_extract(site, 'kette[0-9]') AS chain, count(*) AS branches FROM e WHERE tier = 'A' AND contains(site, '.kette') GROUP BY 1),
h AS (SELECT e.*, CASE WHEN g.branches >= 2 THEN g.chain END AS chain FROM e LEFT JOIN g ON tier = 'A' AND contains(site, '.kette') AND g.chain = regexp_extract(site, 'kette[0-9]')),
k AS (SELECT *, CASE WHEN url IS NULL THEN NULL ELSE regexp_replace(regexp_replace(url, '\\?.*$', ''), '^https://(www\\.)?', '') END AS page FROM h WHERE chain IS NULL OR chain = 'kette2'),
u AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, 'p' || i) AS nth FROM k)"""


def _made_sites(spark, sf_dir: str) -> tuple[DataFrame, audit_plan.Inputs, DataFrame]:
    """Candidates, what was fetched for them, and audits of two chains' main sites."""
    none = F.lit(None).cast("string")
    base = table(spark, sf_dir, "pages").select("page_id", F.expr(_KIND).alias("kind"), F.expr(_URL).alias("url"))
    site = F.when(F.col("kind") != "none", F.col("url"))
    candidates = base.select(
        F.concat(F.lit("p"), _n().cast("string")).alias("place_id"), F.lit("Ort").alias("name"), none.alias("address"), none.alias("plz"), none.alias("district"), F.array(F.lit("shop=books")).alias("types"), none.alias("primary_type"), site.alias("website"),
        none.alias("phone"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"),
    )
    body = F.concat(
        F.lit("<html><head><title>Seite</title>"), _part(_n() % 2 == 0, '<meta name="viewport" content="width=device-width">'), _part(_n() % 5 == 1, '<meta name="x" content="by Wix.com"><img src="https://static.wixstatic.com/a.png">'),
        _part(_n() % 5 == 2, '<link href="/wp-content/a.css"><script src="/wp-includes/b.js"></script>'), _part(_n() % 5 == 3, '<meta name="generator" content="Joomla! 4">'), _part(_n() % 6 < 3, '<script src="/matomo.js"></script><script>var _paq = [];</script>'),
        _part(_n() % 4 == 0, '<script src="https://static.hotjar.com/c/hotjar-1.js">_hjSettings</script>'), _part(_n() % 6 == 0, '<script type="application/ld+json">{"@type": "Restaurant"}</script>'), F.lit("</head><body><p>"), F.repeat(F.lit("Willkommen im Haus. "), F.lit(60)), F.lit("</p>"),
        _part(_n() % 7 < 4, F.concat(F.lit('<a href="https://www.facebook.com/b'), _n().cast("string"), F.lit('">f</a>'))), _part(_n() % 3 == 1, '<a href="/impressum">Impressum</a>'), F.lit("</body></html>"),
    )
    parked = F.lit("<html><title>This domain is for sale</title><body>Sedo</body></html>")
    error = F.when(F.col("kind") == "error", F.get(F.array(*[F.lit(e) for e in _ERRORS]), (_n() % 6).cast("int")))
    headers = F.when(_n() % 5 == 4, F.create_map(F.lit("X-Powered-By"), F.lit("Next.js 14"))).otherwise(rows.no_links())
    fetch = lambda address, page, failure: [
        address.alias("url"), F.when(failure.isNull(), F.lit(200)).otherwise(F.lit(0)).alias("status"), headers.alias("headers"), page.alias("body"), address.alias("final_url"), failure.alias("error"), (_n() % 10 != 0).alias("ssl_valid"),
        F.lit(None).cast("timestamp").alias("ssl_expires_at"), (_n() % 8 != 0).alias("http_to_https"),
    ]
    number = F.lpad(_n().cast("string"), 7, "0")
    imprint = F.concat(
        F.lit("<body>Impressum\nFirmenname: Huber "), number, F.lit(" GmbH\nUID: "), F.when(_n() % 9 != 1, F.concat(F.lit("ATU1"), number)).otherwise(F.lit("beantragt")), F.lit("\n| Hauptgasse 5, 1030 Wien |\nTel: +43 1 "), number,
        F.lit('\n<a href="mailto:'), F.when(_n() % 2 == 0, F.lit("office")).otherwise(F.lit("anna.huber")), F.lit('@haus.at?subject=x">Mail</a></body>'),
    )
    pages = base.where("kind <> 'none'").select(*fetch(F.col("url"), F.when(F.col("kind") == "parked", parked).otherwise(body), error))
    imprints = base.where((F.col("kind") == "live") & (_n() % 3 == 1) & ~F.col("url").contains("dup")).select(*fetch(F.concat(F.regexp_extract("url", "^(https://[^/]*)", 1), F.lit("/impressum")), imprint, none))
    fetched = pages.unionByName(imprints)
    psi = base.where((F.col("kind") == "live") & (_n() % 12 != 0)).select("url", *[((_n() % 101) / 100).alias(c) for c in ("performance", "seo", "accessibility", "best_practices")], F.lit(None).cast("timestamp").alias("fetched_at"), none.alias("error"))
    rules = F.array(F.struct(F.lit(False).alias("allow"), F.lit("/").alias("path")))
    robots = base.where("kind = 'robots'").select(F.regexp_extract("url", "^(https://[^/]*)", 1).alias("origin"), rules.alias("rules")).distinct()
    chains = spark.createDataFrame([("kette0.at", 12), ("kette1.at", 2)], "apex string, score int")
    made = chains.select(F.concat(F.lit("apex:"), "apex").alias("place_id"), F.lit("A").alias("tier"), F.lit("LIVE").alias("intent_tier"), "score", F.concat(F.lit("https://"), "apex", F.lit("/")).alias("discovered_url"), rows.no_tech().alias("tech_stack"), rows.no_links().alias("social_links"), "apex")
    return candidates, audit_plan.Inputs(fetched, psi=psi, robots=robots), conform(made, AUDIT).join(made.select("place_id", "apex"), "place_id")


@query(f"""WITH {_STATE} SELECT 'p' || i AS place_id, tier, CASE WHEN tier = 'A' THEN CASE WHEN score >= 9 THEN 'A1' WHEN score >= 5 THEN 'A2' ELSE 'A3' END END AS sub_tier,
CASE WHEN tier = 'A' THEN 'LIVE' WHEN kind = 'parked' THEN 'PARKED' WHEN tier = 'C' THEN 'NONE' ELSE 'DEAD_WEBSITE' END AS intent_tier, score, CAST(1 AS INTEGER) AS branch_count, url, coalesce(cms, '') AS cms, coalesce(social, FALSE) AS has_social,
coalesce(structured, FALSE) AS has_structured_data, CAST(psi AS INTEGER) AS psi_mobile_performance, ssl AS ssl_valid, breakdown FROM u WHERE page IS NULL OR nth = 1
UNION ALL SELECT 'apex:kette0.at', 'A', 'A1', 'LIVE', 12, CAST(branches AS INTEGER), 'https://kette0.at/', '', FALSE, NULL, NULL, NULL, 'NO_ANALYTICS+1; NO_MODERN_TRACKING+1; NO_SOCIAL_LINKS+1' FROM g WHERE chain = 'kette0' AND branches >= 2""")
def audit_sites(spark, sf_dir):
    """P1-P4, X61, F5, W1, W2 together: the audit of made sites, from candidates to export rows."""
    candidates, inputs, chains = _made_sites(spark, sf_dir)
    result = audit_plan.run(candidates, inputs, SETTINGS, [joins.BranchPattern("filiale.*", "Filiale", "branch")], chains)
    out = rows.export_rows(result.rows)
    return out.select("place_id", "tier", "sub_tier", "intent_tier", "score", "branch_count", "url", "cms", "has_social", "has_structured_data", "psi_mobile_performance", "ssl_valid", text.breakdown_text(F.col("score_breakdown")).alias("breakdown"))


@query(f"""WITH {_STATE} SELECT 'p' || i AS place_id, CASE WHEN seen AND imprint THEN 'Huber ' || lpad(CAST(i AS VARCHAR), 7, '0') || ' GmbH' ELSE 'w' END AS name, CASE WHEN seen AND imprint AND has_uid THEN 'ATU1' || lpad(CAST(i AS VARCHAR), 7, '0') END AS uid,
CASE WHEN seen AND imprint THEN 'Hauptgasse 5, 1030 Wien' END AS address, CASE WHEN seen AND imprint THEN '1030' END AS plz, CASE WHEN seen AND imprint THEN CASE WHEN i % 2 = 0 THEN 'office@haus.at' ELSE 'anna.huber@haus.at' END END AS email, CASE WHEN seen AND imprint THEN CAST(i % 2 = 0 AS INTEGER) END AS email_is_generic,
CASE WHEN seen THEN imprint AND has_uid END AS impressum_complete FROM u WHERE url IS NOT NULL AND starts_with(site, 's') AND tier = 'A' AND nth = 1""")
def audit_imprints(spark, sf_dir):
    """The imprint's part of the same audit's rows, for sites of their own. The name is `w` where it comes from the host."""
    candidates, inputs, chains = _made_sites(spark, sf_dir)
    result = audit_plan.run(candidates, inputs, SETTINGS, [joins.BranchPattern("filiale.*", "Filiale", "branch")], chains)
    out = rows.export_rows(result.rows.where("tier = 'A'")).where(F.col("url").rlike(r"^https://(www\.)?s[0-9]+\.at/"))
    name = F.when(F.col("name").startswith("Huber"), F.col("name")).otherwise(F.lit("w"))
    return out.select("place_id", name.alias("name"), "uid", "address", "plz", "email", "email_is_generic", "impressum_complete")


# --- X47: every step of the content system's cascade

#: HTML, header and its value, and the system that is found.
_CASCADE = (
    ('<img src="typo3conf/a.png"><img src="typo3temp/b.png">', "X-Drupal-Cache", "HIT", "typo3"), ('<meta name="generator" content="WordPress 6.4">', "X-Shopify-Stage", "x", "wordpress"), ("<meta content='Joomla! 5' name='generator'>", "", "", "joomla"),
    ('<meta name="generator" content="Wix.com Website Builder">', "", "", "wix"), ('<meta name="generator" content="Gatsbyjs 5">', "", "", "gatsby"), ('<meta name="generator" content="CraftCMS">', "", "", "craft"), ('<meta name="generator" content="Ghost 5.1">', "", "", "ghost"),
    ('<meta name="generator" content="Homemade"><img src="/_next/a">', "X-Powered-By", "Nuxt.js", "nuxt"), ("<p>a</p>", "x-drupal-cache", "MISS", "drupal"), ("<p>b</p>", "X-TYPO3-Parsedbody", "1", "typo3"), ("<p>c</p>", "X-Shopify-Stage", "p", "shopify"),
    ("<p>d</p>", "X-Generator", "Kirby 4", "kirby"), ("<p>e</p>", "X-Powered-By", "PHP/8", "static_or_custom"), ('<img src="/wp-content/a.png">', "", "", "wordpress"), ('<img src="/sites/default/a.png">', "", "", "drupal"), ('<img src="/typo3conf/a.png">', "", "", "typo3"),
    ('<script src="/_next/a.js"></script>', "", "", "nextjs"), ('<script src="/_nuxt/a.js"></script>', "", "", "nuxt"), ('<img src="/joomla/a.png">', "", "", "joomla"), ('<img src="https://shopify.com/s/files/1">', "", "", "shopify"), ('<img src="https://images.squarespace-cdn.com/1">', "", "", "squarespace"),
    ('<img src="https://a.wixstatic.com/1">', "", "", "wix"), ('<a href="https://webflow.com">w</a>', "", "", "webflow"), ('<a href="https://x.jimdo.com">j</a>', "", "", "jimdo"), ('<a href="https://weebly.com">w</a>', "", "", "weebly"), ("", "", "", "static_or_custom"),
)


def _nth(values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (_n() % len(values)).cast("int"))


def _texts(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


@query(f"SELECT page_id, CASE WHEN page_id % 53 = 52 THEN 'unknown' ELSE {_texts([c[3] for c in _CASCADE])}[CAST(page_id % {len(_CASCADE)} AS INTEGER) + 1] END AS cms FROM pages")
def cms_cascade(spark, sf_dir):
    """Fingerprints, the generator tag, headers and asset paths, each before the next, planted into the pages; an empty page is unknown."""
    planted = table(spark, sf_dir, "pages").select("page_id", F.when(_n() % 53 != 52, F.concat("html", _nth([c[0] for c in _CASCADE]))).otherwise(F.lit("")).alias("body"), _nth([c[1] for c in _CASCADE]).alias("name"), _nth([c[2] for c in _CASCADE]).alias("value"))
    headers = F.when((F.col("name") != "") & (F.col("body") != ""), F.create_map("name", "value")).otherwise(rows.no_links())
    found = planted.withColumn("_headers", headers).withColumn("_cms", detect.tech_stack(F.col("body"), F.col("_headers"))["cms"])
    return found.select("page_id", detect.cms(F.col("body"), F.col("_headers"), F.col("_cms")).alias("cms"))


# --- F10: every invariant

#: What is broken, and the columns that break it in a row that is sound otherwise.
_BROKEN = (
    ("", {}), ("score_without_tier", {"tier": "''"}), ("intent_without_score", {"score": "CAST(NULL AS INT)"}), ("closed_site_intent", {"tier": "'C'", "intent_tier": "'LIVE'"}), ("closed_site_score", {"tier": "'C'", "intent_tier": "'TIMEOUT'"}),
    ("branch_count", {"branch_count": "CAST(NULL AS INT)"}), ("chain_name", {"chain_detected": "TRUE", "branch_count": "3"}), ("chain_branches", {"chain_detected": "TRUE", "chain_name": "'k'"}), ("no_chain_name", {"chain_name": "'k'"}), ("no_chain_branches", {"branch_count": "2"}),
    ("last_modified", {"last_modified_signal": "2028 + CAST(page_id % 3 AS INT)"}), ("email_without_generic", {"impressum_email": "concat('@', page_id)"}), ("", {"last_modified_signal": "1995 + CAST(page_id % 33 AS INT)", "impressum_email": "concat('info', page_id, '@x.at')"}),
    ("", {"tier": "'C'", "intent_tier": "'AUDIT_ERROR'", "score": "CAST(NULL AS INT)"}), ("", {"chain_detected": "TRUE", "chain_name": "'k'", "branch_count": "2 + CAST(page_id % 5 AS INT)"}), ("last_modified", {"last_modified_signal": "1900 + CAST(page_id % 95 AS INT)"}),
)
_SOUND = {"tier": "'A'", "intent_tier": "'LIVE'", "score": "CAST(page_id % 30 AS INT)", "branch_count": "1", "chain_detected": "FALSE", "chain_name": "CAST(NULL AS STRING)", "last_modified_signal": "CAST(NULL AS INT)", "impressum_email": "CAST(NULL AS STRING)"}


@query(f"""SELECT place_id, unnest(rules) AS rule FROM (SELECT 'p' || page_id AS place_id, CASE CAST(page_id % {len(_BROKEN)} AS INTEGER)
WHEN 1 THEN ['score_without_tier'] WHEN 2 THEN ['intent_without_score'] WHEN 3 THEN ['closed_site_intent'] WHEN 4 THEN ['closed_site_score'] WHEN 5 THEN ['branch_count'] WHEN 6 THEN ['chain_name'] WHEN 7 THEN ['chain_branches'] WHEN 8 THEN ['no_chain_name']
WHEN 9 THEN ['no_chain_branches'] WHEN 10 THEN ['last_modified'] WHEN 11 THEN ['email_without_generic'] WHEN 15 THEN ['last_modified'] ELSE [] END AS rules FROM pages)""")
def invariant_rules(spark, sf_dir):
    """rows that break one rule each, and sound ones at the rules' edges. The other three can't be broken: they follow from the tier, the score and the address by construction."""
    case = lambda name: F.expr("CASE CAST(page_id % " + str(len(_BROKEN)) + " AS INT) " + "".join(f"WHEN {i} THEN {c[name]} " for i, (_, c) in enumerate(_BROKEN) if name in c) + f"ELSE {_SOUND[name]} END")
    made = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), _n().cast("string")).alias("place_id"), *[case(n).alias(n) for n in _SOUND])
    return filters.violations(conform(made, AUDIT), 2026)


# --- J4: every type of every industry

_TYPES = [(t, industry) for industry, types in score.INDUSTRIES.items() for t in types]


@query(f"""WITH t AS (SELECT page_id, {_texts([t for t, _ in _TYPES])} AS t, {_texts([i for _, i in _TYPES])} AS i, CAST(page_id % {len(_TYPES)} AS INTEGER) + 1 AS a, CAST(page_id * 7 % {len(_TYPES)} AS INTEGER) + 1 AS b FROM pages),
m AS (SELECT t, any_value(i) AS i FROM (SELECT unnest(t) AS t, unnest(i) AS i FROM t LIMIT {len(_TYPES)}) GROUP BY 1)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN i[a] WHEN 1 THEN i[b] WHEN 2 THEN i[b] ELSE 'other' END AS industry FROM t""")
def industry_types(spark, sf_dir):
    """The primary type counts, else the first known one of the others, else `other`."""
    of = lambda step: F.get(F.array(*[F.lit(t) for t, _ in _TYPES]), (_n() * step % len(_TYPES)).cast("int"))
    unknown = F.concat(F.lit("kind_"), _n().cast("string"))
    primary = F.when(_n() % 4 == 0, of(1)).when(_n() % 4 == 1, unknown)
    types = F.when(_n() % 4 == 3, F.array(unknown)).otherwise(F.array(unknown, of(7), of(1)))
    made = table(spark, sf_dir, "pages").select("page_id", primary.alias("primary_type"), types.alias("types"))
    return joins.with_industry(made).select("page_id", "industry")


# --- X36-X43, O5, U3: addresses of a page, written in many ways

_WAYS = ("{l}@{h}", "{l} (at) {h}", "{l}[at]{h}", "{l}&#64;{h}", "{l} at {h}")


@query(f"""WITH r AS (SELECT page_id, {_BARE_HOST} AS h, (['info', 'anna', 'office2', 'max.huber', 'noreply', 'kontakt.wien'])[CAST(page_id % 6 AS INTEGER) + 1] AS l, (['team', 'eva', 'root', 'sales-at'])[CAST(page_id % 4 AS INTEGER) + 1] AS m FROM pages),
e AS (SELECT page_id, l || '@' || replace(h, 'example.', 'firma.') AS a, m || '@shop.' || replace(h, 'example.', 'firma.') AS b, l = 'noreply' AS na, m = 'root' AS nb, l IN ('info', 'office2', 'kontakt.wien') AS ra, m IN ('team', 'sales-at') AS rb FROM r),
f AS (SELECT page_id, a, b, CASE WHEN na AND nb THEN [] WHEN na THEN [b] WHEN nb THEN [a] WHEN ra AND NOT rb THEN [b, a] ELSE [a, b] END AS found, CASE WHEN page_id % 3 = 0 THEN CASE WHEN rb THEN b END WHEN ra THEN a WHEN rb THEN b END AS generic, page_id % 3 = 0 AS linked FROM e)
SELECT page_id, array_to_string(found, ',') AS emails, CASE WHEN linked THEN b END AS mailto FROM f""")
def email_spellings(spark, sf_dir):
    """Two addresses of a page, written out in five ways; noise goes, personal ones come first; one in three is a link."""
    host = F.replace(F.regexp_extract("url", "^[a-z]+://(?:www\\.)?([^/?#]*)", 1), F.lit("example."), F.lit("firma."))
    first, second = _nth(["info", "anna", "office2", "max.huber", "noreply", "kontakt.wien"]), _nth(["team", "eva", "root", "sales-at"])
    ways = [F.concat(F.lit(w.split("{h}")[0].replace("{l}", "")), F.lit("")) for w in _WAYS]
    a = F.concat(first, F.get(F.array(*ways), (_n() % len(_WAYS)).cast("int")), host)
    b = F.concat(second, F.lit("@shop."), host)
    body = F.concat(F.lit("Schreiben: "), a, F.lit(" ; oder "), F.upper(b), F.lit(" ; danke "), b)
    made = table(spark, sf_dir, "pages").select("page_id", body.alias("body"), F.when(_n() % 3 == 0, F.array(F.concat(F.lit("MAILTO: "), F.upper(b), F.lit("?subject=x")), F.lit("/x"))).otherwise(F.array(F.lit("/y"))).alias("links"))
    return made.select("page_id", F.array_join(contact.emails(F.col("body")), ",").alias("emails"), F.get(contact.mailto_emails(F.col("links")), F.lit(0)).alias("mailto"))


# --- O6, U4: types of structured data

_LD = ("Restaurant", "Thing", "LocalBusiness", "Event", "Offer")
_MICRO = ("Person", "Restaurant", "Place", "Product")


@query(f"""WITH t AS (SELECT page_id, {_texts(_LD)}[CAST(page_id % 5 AS INTEGER) + 1] AS a, {_texts(_LD)}[CAST(page_id * 3 % 5 AS INTEGER) + 1] AS b, {_texts(_MICRO)}[CAST(page_id % 4 AS INTEGER) + 1] AS c, page_id % 7 < 5 AS has_ld, page_id % 3 < 2 AS has_micro FROM pages),
l AS (SELECT page_id, has_ld OR has_micro AS has_schema_org, list_concat(CASE WHEN has_ld THEN [a, b] ELSE [] END, CASE WHEN has_micro THEN [c] ELSE [] END) AS l FROM t)
SELECT page_id, has_schema_org, array_to_string(list_sort(list_distinct(list_filter(l, lambda x: x IN ('Restaurant', 'LocalBusiness', 'Event', 'Person', 'Product')))), ',') AS types FROM l""")
def schema_types(spark, sf_dir):
    """Types of JSON-LD, nested ones too, and of microdata, each once, those of interest in order."""
    pick = lambda values, step: F.get(F.array(*[F.lit(v) for v in values]), (_n() * step % len(values)).cast("int"))
    ld = F.concat(F.lit('<script type="application/ld+json">{"@type": "http://schema.org/'), pick(_LD, 1), F.lit('", "x": [{"@type": ["'), pick(_LD, 3), F.lit('"]}]}</script>'))
    micro = F.concat(F.lit('<div itemscope itemtype="https://schema.org/'), pick(_MICRO, 1), F.lit('">x</div>'))
    made = table(spark, sf_dir, "pages").select("page_id", F.concat(_part(_n() % 7 < 5, ld), "html", _part(_n() % 3 < 2, micro)).alias("body"))
    found = made.withColumn("_s", html.schema_org(html.page_facts("body")))
    return found.select("page_id", F.col("_s.has_schema_org").alias("has_schema_org"), F.array_join("_s.types", ",").alias("types"))
