"""The registry: each query runs an operator over the driver's tables, beside the same result in DuckDB's SQL where SQL can express it.

Pages, orders and parts stand in for places. Dimensions that only a query needs are inline on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import contact, detect, html, score, text, url
from ..operators import aggregates, dedupe, filters, joins, rows, upsert
from ..schemas import AUDIT, conform
from ..sinks import files
from ..sources import dimensions, places
from . import audit as audit_plan

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = Settings(as_of=datetime(2026, 4, 20, 12))


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None):
    """Registers a function under its name."""

    def add(f: Query) -> Query:
        REGISTRY[f.__name__] = Entry(f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1))"
_PATH = "regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)"
_BARE = f"regexp_replace({_HOST}, '^www\\.', '')"
_QUERY = "list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_'))"
_KEY = f"'http' || CASE WHEN starts_with(url, 'https') THEN 's' ELSE '' END || '://' || {_BARE} || regexp_replace({_PATH}, '/$', '') || CASE WHEN len({_QUERY}) > 0 THEN '?' || array_to_string({_QUERY}, '&') ELSE '' END"
_SCORE = "CASE WHEN page_id % 11 = 0 THEN NULL ELSE CAST(page_id % 17 AS INTEGER) END"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("score", F.when(F.col("page_id") % 11 == 0, F.lit(None)).otherwise((F.col("page_id") % 17).cast("int"))).withColumn("audited_at", F.timestamp_seconds(F.col("page_id") % 5))


# --- URLs


@query(f"SELECT page_id, {_KEY} AS url_key FROM pages")
def url_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url.dedupe_key(F.col("url")).alias("url_key"))


@query(f"SELECT page_id, {_BARE} || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END AS host_path FROM pages")
def url_host_and_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url.host_and_path(F.col("url")).alias("host_path"))


@query(f"""SELECT page_id, regexp_replace('http' || CASE WHEN starts_with(url, 'https') THEN 's' ELSE '' END || '://' || {_HOST} || {_PATH} || CASE WHEN contains(url, 'utm_source=') THEN '' ELSE regexp_extract(url, '(\\?[^#]*)', 1) END
|| regexp_extract(url, '(#.*)$', 1), '/$', '') AS link FROM pages""")
def url_directory_link(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url.directory_link(F.col("url")).alias("link"))


@query(f"""SELECT page_id, list_transform(string_split(string_split({_BARE}, '.')[1], '-'), lambda s: upper(s[1]) || lower(s[2:])).array_to_string('-') AS title, {_HOST} AS fetch_host, FALSE AS is_platform FROM pages""")
def host_title_case(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", url.host_title(u).alias("title"), url.scheduling_host(u).alias("fetch_host"), url.is_platform(u).alias("is_platform"))


@query(f"SELECT array_to_string(string_split({_HOST}, '.')[-2:], '.') AS apex, count(*) AS pages FROM pages GROUP BY 1")
def apex_group_counts(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(url.apex(F.col("url")).alias("apex")).agg(F.count("*").alias("pages"))


@query(f"SELECT {_BARE} AS host, count(*) AS pages FROM pages GROUP BY 1 HAVING count(*) > 1")
def host_group_counts(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(url.without_www(url.host(F.col("url"))).alias("host")).agg(F.count("*").alias("pages")).where("pages > 1")


_RANKED = f"""SELECT page_id, {{key}} AS k, score, row_number() OVER (PARTITION BY {{key}} ORDER BY score DESC NULLS LAST, page_id % 5, page_id) AS n,
first_value(page_id) OVER (PARTITION BY {{key}} ORDER BY score DESC NULLS LAST, page_id % 5, page_id) AS kept FROM (SELECT page_id, url, {_SCORE} AS score FROM pages)"""


@query("SELECT page_id, k AS url_key, score FROM (" + _RANKED.format(key=_KEY) + ") WHERE n = 1")
def url_dedupe_keep_best(spark, sf_dir):
    best = dedupe.keep_best(_scored(spark, sf_dir), url.dedupe_key(F.col("url")), dedupe.score_order(), "page_id")
    return best.where("_rank = 1").select("page_id", F.col("_key").alias("url_key"), "score")


@query("SELECT kept AS kept_id, page_id AS dropped_id, k AS host FROM (" + _RANKED.format(key=_BARE) + ") WHERE n > 1")
def url_dedupe_log(spark, sf_dir):
    best = dedupe.keep_best(_scored(spark, sf_dir), url.without_www(url.host(F.col("url"))), dedupe.score_order(), "page_id")
    return best.where("_rank = 2").select(F.col("_kept").alias("kept_id"), F.col("page_id").alias("dropped_id"), F.col("_key").alias("host"))


def _audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows made up from pages: tiers, signals and scores follow from page_id."""
    i = F.col("page_id")
    flag = lambda n: F.when(i % n == 0, F.lit(None)).otherwise(i % 2 == 0)
    strings = lambda cond, v: F.when(cond, F.array(F.lit(v))).otherwise(F.array().cast("array<string>"))
    tech = F.struct(
        strings(i % 6 == 1, "Wix").alias("cms"), rows.no_strings().alias("pageBuilder"), strings(i % 3 == 0, "matomo").alias("analytics"), strings(i % 4 == 0, "hotjar").alias("tracking"), rows.no_strings().alias("payment"), rows.no_strings().alias("cdn")
    )
    made = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), i.cast("string")).alias("place_id"), F.timestamp_seconds(i % 5).alias("audited_at"), F.element_at(F.array(*[F.lit(t) for t in ("A", "A", "A", "B1", "B2", "B3", "C")]), (i % 7 + 1).cast("int")).alias("tier"),
        F.when(i % 7 < 3, F.col("url")).alias("discovered_url"), flag(5).alias("ssl_valid"), flag(3).alias("http_to_https_redirect"), flag(9).alias("has_viewport_meta"), F.when(i % 13 != 0, (i % 101).cast("int")).alias("psi_mobile_performance"),
        (i % 4 != 0).alias("impressum_present"), flag(8).alias("impressum_complete"), F.when(i % 10 < 6, F.lit("ATU12345678")).alias("impressum_uid"), tech.alias("tech_stack"),
        F.when(i % 5 == 0, rows.no_links()).otherwise(F.create_map(F.lit("facebook"), F.lit("https://facebook.com/x"))).alias("social_links"), F.when(i % 7 == 6, F.when(i % 2 == 0, F.lit("PARKED")).otherwise(F.lit("NONE"))).alias("intent_tier"),
        F.lit(False).alias("chain_detected"), F.lit(1).alias("branch_count"), (i % 12 == 0).alias("has_structured_data"), F.when(i % 3 == 0, (1990 + i % 40).cast("int")).alias("last_modified_signal"),
    )
    made = conform(made, AUDIT)
    return conform(made.withColumn("score", score.total(rows.breakdown_of())), AUDIT)


_FLAG = "CASE WHEN page_id % {n} = 0 THEN NULL ELSE page_id % 2 = 0 END"
_AUDITS = f"""a AS (SELECT 'p' || page_id AS place_id, page_id AS i, url, (['A', 'A', 'A', 'B1', 'B2', 'B3', 'C'])[CAST(page_id % 7 AS INTEGER) + 1] AS tier, page_id % 7 = 6 AND page_id % 2 = 0 AS parked,
{_FLAG.format(n=5)} AS ssl, {_FLAG.format(n=3)} AS redirect, {_FLAG.format(n=9)} AS viewport, CASE WHEN page_id % 13 <> 0 THEN page_id % 101 END AS psi, page_id % 4 <> 0 AS imp, {_FLAG.format(n=8)} AS complete, page_id % 10 < 6 AS uid FROM pages),
rules AS (SELECT place_id, i, tier, url, unnest([
{{k: 'NO_WEBSITE', d: 20, on_: tier = 'B3'}}, {{k: 'DOMAIN_REGISTERED_NO_SITE', d: 22, on_: tier = 'C' AND parked}}, {{k: 'DEAD_WEBSITE', d: 9, on_: tier = 'C' AND NOT parked}}, {{k: 'ONLY_SOCIAL', d: 7, on_: tier = 'B1'}}, {{k: 'ONLY_DIRECTORY', d: 6, on_: tier = 'B2'}},
{{k: 'NO_SSL', d: 3, on_: tier = 'A' AND ssl = FALSE}}, {{k: 'NO_HTTPS_REDIRECT', d: 2, on_: tier = 'A' AND redirect = FALSE}}, {{k: 'NO_MOBILE_VIEWPORT', d: 3, on_: tier = 'A' AND viewport = FALSE}},
{{k: 'PSI_POOR', d: 3, on_: tier = 'A' AND psi < 50}}, {{k: 'PSI_MEDIUM', d: 1, on_: tier = 'A' AND psi >= 50 AND psi < 75}}, {{k: 'PSI_EXCELLENT', d: -1, on_: tier = 'A' AND psi > 85}},
{{k: 'NO_IMPRESSUM', d: 3, on_: tier = 'A' AND NOT imp}}, {{k: 'IMPRESSUM_INCOMPLETE', d: 2, on_: tier = 'A' AND imp AND complete = FALSE}}, {{k: 'NO_UID', d: 1, on_: tier = 'A' AND imp AND NOT uid}},
{{k: 'WIX_OR_JIMDO_OR_WEEBLY', d: 2, on_: tier = 'A' AND i % 6 = 1}}, {{k: 'NO_ANALYTICS', d: 1, on_: tier = 'A' AND i % 3 <> 0}}, {{k: 'NO_MODERN_TRACKING', d: 1, on_: tier = 'A' AND i % 4 <> 0}}, {{k: 'NO_SOCIAL_LINKS', d: 1, on_: tier = 'A' AND i % 5 = 0}},
{{k: 'HAS_STRUCTURED_DATA', d: -1, on_: tier = 'A' AND i % 12 = 0}}]) AS r FROM a),
s AS (SELECT a.place_id, a.i, a.tier, a.url, a.parked, CAST(greatest(0, least(30, coalesce(sum(r.d) FILTER (r.on_), 0))) AS INTEGER) AS score FROM a JOIN rules USING (place_id) GROUP BY ALL)"""
_SUB = "CASE WHEN tier = 'A' THEN CASE WHEN score >= 9 THEN 'A1' WHEN score >= 5 THEN 'A2' ELSE 'A3' END END"


@query(f"WITH {_AUDITS} SELECT place_id, r.k AS rule, CAST(r.d AS INTEGER) AS delta FROM rules WHERE r.on_")
def score_breakdown_rows(spark, sf_dir):
    entries = _audits(spark, sf_dir).select("place_id", F.explode(rows.breakdown_of()).alias("e"))
    return entries.select("place_id", F.col("e.key").alias("rule"), F.col("e.delta").alias("delta"))


@query(f"WITH {_AUDITS} SELECT place_id, score, {_SUB} AS sub_tier FROM s")
def score_total(spark, sf_dir):
    return _audits(spark, sf_dir).select("place_id", "score", score.sub_tier(F.col("tier"), F.col("score")).alias("sub_tier"))


_ERRORS = "(['', 'CERT_EXPIRED', 'HTTP_5XX', 'DNS_FAIL', 'TIMEOUT', ''])[CAST(page_id % 6 AS INTEGER) + 1]"


@query(f"""WITH t AS (SELECT page_id, page_id % 4 <> 3 AS has_url, nullif({_ERRORS}, '') AS error, page_id % 5 = 0 AS social, page_id % 3 = 0 AS directory FROM pages),
u AS (SELECT *, CASE WHEN has_url AND error IS NULL THEN 'A' WHEN has_url AND error IN ('CERT_EXPIRED', 'HTTP_5XX', 'DNS_FAIL') THEN 'C' WHEN social THEN 'B1' WHEN directory THEN 'B2' ELSE 'B3' END AS tier FROM t)
SELECT page_id, tier, CASE tier WHEN 'A' THEN 'LIVE' WHEN 'C' THEN 'DEAD' WHEN 'B3' THEN 'DEAD_WEBSITE' ELSE 'NONE' END AS intent_tier FROM u""")
def tier_classify(spark, sf_dir):
    i = F.col("page_id")
    error = F.nullif(F.element_at(F.array(*[F.lit(x) for x in ("", "CERT_EXPIRED", "HTTP_5XX", "DNS_FAIL", "TIMEOUT", "")]), (i % 6 + 1).cast("int")), F.lit(""))
    tier = score.tier(i % 4 != 3, error, (i % 5 == 0).cast("int"), (i % 3 == 0).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", tier.alias("tier"), score.intent(tier, i % 4 != 3, error).alias("intent_tier"))


@query(f"""WITH {_AUDITS}, g AS (SELECT *, array_to_string(string_split(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '.')[-2:], '.') AS apex FROM s WHERE tier = 'A'),
n AS (SELECT apex, CAST(count(*) AS INTEGER) AS branches, CASE apex WHEN 'example.com' THEN 12 WHEN 'example.org' THEN 2 END AS apex_score, apex <> 'example.net' AS audited FROM g GROUP BY 1),
k AS (SELECT *, CASE WHEN branches < 2 OR NOT audited THEN 'pass' WHEN apex_score < 5 THEN 'drop' ELSE 'collapse' END AS action FROM n)
SELECT place_id, CAST(1 AS INTEGER) AS branch_count, score FROM s WHERE tier <> 'A' UNION ALL SELECT place_id, 1, score FROM g JOIN k USING (apex) WHERE action = 'pass' UNION ALL SELECT 'apex:' || apex, branches, apex_score FROM k WHERE action = 'collapse'""")
def apex_collapse_or_drop(spark, sf_dir):
    apexes = conform(spark.range(2).select(F.get(F.array(F.lit("example.com"), F.lit("example.org")), F.col("id").cast("int")).alias("a"), F.get(F.array(F.lit(12), F.lit(2)), F.col("id").cast("int")).alias("score")).select(F.concat(F.lit("apex:"), "a").alias("place_id"), "score", F.col("a").alias("discovered_url")), AUDIT)
    out, _, _ = dedupe.by_apex(_audits(spark, sf_dir), apexes.withColumn("apex", F.col("discovered_url")), SETTINGS)
    return out.select("place_id", "branch_count", "score")


_PATTERNS = [joins.BranchPattern("m.*/en/*", "mobile", "english"), joins.BranchPattern("blog.*", "blog", "any"), joins.BranchPattern("*.example.org/en/*", "org", "english")]


@query(f"""WITH p AS (SELECT page_id, {_BARE} || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END AS page FROM pages)
SELECT page_id, CASE WHEN regexp_full_match(page, 'm\\..+/en/.+') THEN 'mobile' WHEN regexp_full_match(page, 'blog\\..+') THEN 'blog' WHEN regexp_full_match(page, '.+\\.example\\.org/en/.+') THEN 'org' END AS chain_name FROM p""")
def branch_pattern_filter(spark, sf_dir):
    return joins.branch_matches(table(spark, sf_dir, "pages"), _PATTERNS, "url").select("page_id", F.col("_match.chain_name").alias("chain_name"))


# --- report aggregates


@query(f"WITH {_AUDITS} SELECT CAST(d.o AS INTEGER) AS ordinal, d.t AS tier, count(s.tier) AS count FROM (VALUES (0, 'A'), (1, 'B1'), (2, 'B2'), (3, 'B3'), (4, 'C')) d(o, t) LEFT JOIN s ON s.tier = d.t GROUP BY ALL")
def tier_distribution_zero_fill(spark, sf_dir):
    return aggregates.by_tier(_audits(spark, sf_dir))


@query(f"WITH {_AUDITS} SELECT CAST(d.o AS INTEGER) AS ordinal, d.t AS sub_tier, count(x.sub) AS count FROM (VALUES (0, 'A1'), (1, 'A2'), (2, 'A3'), (3, 'null')) d(o, t) LEFT JOIN (SELECT coalesce({_SUB}, 'null') AS sub FROM s) x ON x.sub = d.t GROUP BY ALL")
def sub_tier_distribution(spark, sf_dir):
    return aggregates.by_sub_tier(rows.export_rows(_audits(spark, sf_dir)))


@query(f"WITH {_AUDITS} SELECT coalesce(CASE WHEN tier = 'C' THEN CASE WHEN parked THEN 'PARKED' ELSE 'NONE' END END, 'null') AS intent_tier, count(*) AS count FROM s GROUP BY 1")
def intent_distribution(spark, sf_dir):
    return aggregates.by_intent(rows.export_rows(_audits(spark, sf_dir)))


@query("""SELECT o_orderpriority AS priority, l[1] AS min, l[1 + least(n - 1, CAST(floor(0.25 * n) AS BIGINT))] AS p25, l[1 + least(n - 1, CAST(floor(0.5 * n) AS BIGINT))] AS median, l[1 + least(n - 1, CAST(floor(0.75 * n) AS BIGINT))] AS p75, l[n] AS max
FROM (SELECT o_orderpriority, list_sort(list(o_totalprice)) AS l, count(*) AS n FROM orders GROUP BY 1)""")
def score_five_number(spark, sf_dir):
    return aggregates.five_numbers(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), "o_totalprice", "priority")


@query(f"WITH {_AUDITS} SELECT CASE WHEN i % 6 = 1 THEN 'Wix' ELSE '(empty)' END AS cms, count(*) AS count FROM s GROUP BY 1")
def cms_distribution(spark, sf_dir):
    return aggregates.by_cms(rows.export_rows(_audits(spark, sf_dir)))


@query("""SELECT CAST(d.o AS INTEGER) AS ordinal, d.t AS bucket, count(x.b) AS count FROM (VALUES (0, '<2000'), (1, '2000-2009'), (2, '2010-2019'), (3, '2020+'), (4, 'null')) d(o, t)
LEFT JOIN (SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'null' WHEN year(o_orderdate) < 2000 THEN '<2000' WHEN year(o_orderdate) < 2010 THEN '2000-2009' WHEN year(o_orderdate) < 2020 THEN '2010-2019' ELSE '2020+' END AS b FROM orders) x ON x.b = d.t GROUP BY ALL""")
def year_buckets(spark, sf_dir):
    year = F.when(F.col("o_orderkey") % 9 != 0, F.year("o_orderdate"))
    return aggregates.by_year(table(spark, sf_dir, "orders").select(year.alias("last_modified_signal")))



@query(f"WITH {_AUDITS} SELECT place_id, score FROM s WHERE tier = 'A' ORDER BY score DESC, place_id LIMIT 10")
def top10_worst(spark, sf_dir):
    return aggregates.worst(rows.export_rows(_audits(spark, sf_dir))).select("place_id", "score")


@query(f"WITH {_AUDITS} SELECT tier, CASE WHEN i % 6 = 1 THEN 'Wix' ELSE '' END AS cms, count(*) AS count, avg(score) AS mean_score FROM s GROUP BY ROLLUP (1, 2)")
def report_rollup(spark, sf_dir):
    return aggregates.report_cube(rows.export_rows(_audits(spark, sf_dir))).select("tier", "cms", "count", "mean_score")


# --- detectors


@query("""WITH p AS (SELECT page_id, CAST(length(html) < 1024 AS INTEGER) + CAST(regexp_matches(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '(?i)^\\s*(for sale|to buy|coming soon|this domain|parked|default web page)')
OR regexp_matches(html, '(?i)this domain is (?:for sale|parked)|buy this domain|godaddy|sedoparking|afternic|dan\\.com|uniregistry|bodis') AS INTEGER) + CAST(page_id % 50 = 0 AS INTEGER) AS n FROM pages)
SELECT page_id, CASE WHEN n >= 2 THEN 'parked' WHEN n = 1 THEN 'inconclusive' ELSE 'not-parked' END AS verdict FROM p""")
def parking_vote(spark, sf_dir):
    headers = F.when(F.col("page_id") % 50 == 0, F.create_map(F.lit("SERVER"), F.lit("Sedo"))).otherwise(rows.no_links())
    return table(spark, sf_dir, "pages").select("page_id", detect.parking(F.col("html"), headers)["verdict"].alias("verdict"))


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, regexp_matches(html, '(?i)name\\s*=\\s*[\"'']viewport') AS has_viewport FROM pages")
def viewport_and_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", detect.title(F.col("html")).alias("title"), detect.viewport(F.col("html"))["present"].alias("has_viewport"))



@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'nginx' END AS server, 'static_or_custom' AS cms, CASE WHEN page_id % 4 = 1 THEN 'cloudflare' ELSE '' END AS cdn FROM pages")
def tech_and_cms(spark, sf_dir):
    i = F.col("page_id")
    headers = F.when(i % 4 == 0, F.create_map(F.lit("Server"), F.lit("nginx"))).when(i % 4 == 1, F.create_map(F.lit("SERVER"), F.lit("cloudflare"), F.lit("CF-Ray"), F.lit("x"))).otherwise(rows.no_links())
    stack = detect.tech_stack(F.col("html"), headers)
    out = table(spark, sf_dir, "pages").select("page_id", headers.alias("h"), stack.alias("t"), "html")
    return out.select("page_id", F.when(i % 4 == 0, detect.header(detect.lower_headers(F.col("h")), "server")).alias("server"), detect.cms(F.col("html"), F.col("h"), F.col("t.cms")).alias("cms"), F.array_join("t.cdn", ",").alias("cdn"))


# --- texts


_MAILS = "regexp_extract_all(text, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}')"


@query(f"""SELECT doc_id, e AS email, regexp_matches(split_part(e, '@', 2), '(^|\\.)(example\\.com|example\\.org|example\\.net|domain\\.tld|test\\.com|localhost)$') OR split_part(e, '@', 1) IN ('noreply', 'no-reply', 'donotreply', 'do-not-reply', 'webmaster', 'postmaster', 'abuse', 'hostmaster', 'wp', 'root') AS is_noise,
regexp_matches(e, '^(info|office|kontakt|contact|hello|hallo|mail|service|support|sales|vertrieb|team|verwaltung|sekretariat|anfrage|anfragen|willkommen|buero|büro)(@|[._0-9-])') AS is_role,
CAST(regexp_matches(e, '^(info|office|kontakt|contact|hello|hallo|mail|welcome|service|support|sales|admin|team|buero|kanzlei|praxis|ordination|rezeption|empfang|anfrage)[0-9]*@') AS INTEGER) AS generic
FROM (SELECT DISTINCT doc_id, lower(unnest({_MAILS})) AS e FROM documents)""")
def email_extract(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(contact.raw_emails(F.col("text"))).alias("email"))
    e = F.col("email")
    return found.select("doc_id", "email", contact.is_noise(e).alias("is_noise"), contact.is_role(e).alias("is_role"), contact.generic_class(e).alias("generic"))


@query("""SELECT doc_id, nullif(regexp_extract(text, '\\b(1\\d{2}0)\\b', 1), '') AS plz, nullif(regexp_extract(text, '\\b(1[0-2]\\d0)\\b', 1), '') AS city_plz FROM documents""")
def plz_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", contact.plz_of_address(F.col("text")).alias("plz"), contact.plz_in_text(F.col("text")).alias("city_plz"))


@query("""SELECT p_partkey, regexp_replace(trim(regexp_replace(replace(lower(p_name), '&', ' and '), '[^a-z0-9]+', ' ', 'g')), ' +', '-', 'g') AS slug, regexp_replace(regexp_replace(lower(p_name), '\\s+(gmbh|og|kg|eu|ag)\\b', '', 'g'), '[^a-z0-9]+', '', 'g') AS name_key FROM part""")
def slugify_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.name_key(F.col("p_name")).alias("name_key"))


@query("""WITH n AS (SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN ' GmbH Telefon: 1' WHEN 1 THEN ' AG - ,' WHEN 2 THEN chr(10) || 'Fax' ELSE '' END AS raw FROM customer)
SELECT c_custkey, trim(regexp_replace(trim(split_part(split_part(raw, chr(10), 1), 'Telefon', 1)), '[:;,|\\-\\s]+$', '')) AS name FROM n""")
def company_name_sanitize(spark, sf_dir):
    i = F.col("c_custkey") % 4
    raw = F.concat("c_name", F.when(i == 0, F.lit(" GmbH Telefon: 1")).when(i == 1, F.lit(" AG - ,")).when(i == 2, F.lit("\nFax")).otherwise(F.lit("")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.company_name(raw).alias("name"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'ATU1' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS uid, CASE WHEN c_custkey % 2 = 0 THEN '+431' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS phone,
CASE WHEN c_custkey % 2 = 0 THEN 'P' ELSE '' END || CASE WHEN c_custkey % 3 = 0 THEN 'A' ELSE '' END AS coverage FROM customer""")
def contact_extract(spark, sf_dir):
    i = F.col("c_custkey")
    body = F.concat(F.lit("Impressum "), F.when(i % 3 == 0, F.concat(F.lit("UID: AT U 1"), F.lpad((i % 10_000_000).cast("string"), 7, "0"))).otherwise(F.lit("")), F.when(i % 2 == 0, F.concat(F.lit(" Tel: 0043 1 "), F.lpad((i % 10_000_000).cast("string"), 7, "0"))).otherwise(F.lit("")), F.lit(" Ende"))
    out = table(spark, sf_dir, "customer").select("c_custkey", body.alias("body"))
    found = out.select("c_custkey", contact.uid(F.col("body")).alias("uid"), contact.phone_e164(contact.phone(F.col("body"))).alias("phone"))
    return found.withColumn("coverage", contact.coverage(F.col("phone"), F.lit(None).cast("string"), F.col("uid")))


@query("""SELECT p_partkey, unnest(list_distinct([p || '.at', 'www.' || p || '.at', p || '.wien', p || '-wien.at', p || '.co.at', split_part(p, '-', 1) || '.at'])) AS domain FROM (SELECT p_partkey, regexp_replace(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' +', '-', 'g') AS p FROM part)""")
def domain_guesses(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(text.domain_guesses(F.col("p_name"))).alias("domain"))


@query("SELECT c_custkey, sha256(c_name || '|' || CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END) AS key FROM customer")
def cache_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.cache_key(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("key"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS registered, CASE c_custkey % 2 WHEN 0 THEN 'whois.nic.at' ELSE 'whois.iana.org' END AS server FROM customer")
def whois_answers(spark, sf_dir):
    i = F.col("c_custkey")
    raw = F.when(i % 3 == 0, F.lit("% Nothing found")).when(i % 3 == 1, F.lit("Registrar: x\nCreation Date: y")).otherwise(F.lit("?"))
    return table(spark, sf_dir, "customer").select("c_custkey", detect.whois_registered(raw).alias("registered"), detect.whois_server(F.when(i % 2 == 0, F.lit("a.AT")).otherwise(F.lit("a.xyz"))).alias("server"))


# --- joins and filters


@query("""SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN 'gastronomy' WHEN p_size % 3 = 1 THEN CASE WHEN p_size % 2 = 0 THEN 'health' ELSE 'crafts' END END, 'other') AS industry FROM part""")
def industry_map(spark, sf_dir):
    s = F.col("p_size")
    types = F.array(F.lit("unknown_type"), F.when(s % 2 == 0, F.lit("dentist")).otherwise(F.lit("plumber")))
    made = table(spark, sf_dir, "part").select("p_partkey", F.when(s % 3 == 2, F.array(F.lit("unknown_type"))).otherwise(types).alias("types"), F.when(s % 3 == 0, F.lit("cafe")).alias("primary_type"))
    return joins.with_industry(made).select("p_partkey", "industry")


@query("""WITH c AS (SELECT p_partkey, (['shop=supermarket', 'shop=art', 'amenity=bank', 'amenity=fast_food'])[CAST(p_partkey % 4 AS INTEGER) + 1] AS tag, (['Billa Plus', 'Erste Bank Wien', 'Spar', 'Burger King'])[CAST(p_partkey % 4 AS INTEGER) + 1] AS name, p_partkey % 3 <> 0 AS brand FROM part)
SELECT p_partkey, CASE WHEN tag = 'shop=art' THEN TRUE WHEN brand AND tag IN ('shop=supermarket', 'amenity=fast_food') THEN FALSE ELSE TRUE END AS kept,
CASE WHEN tag = 'shop=art' THEN 'whitelist:shop:art' WHEN brand AND tag = 'shop=supermarket' THEN 'blacklist:shop=supermarket:billa' WHEN brand AND tag = 'amenity=fast_food' THEN 'blacklist:amenity=fast_food:burger-king' ELSE 'keep:no-match' END AS reason FROM c""")
def chain_blacklist(spark, sf_dir):
    i = F.col("p_partkey")
    pick = lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), (i % 4 + 1).cast("int"))
    types = F.array_compact(F.array(pick("shop=supermarket", "shop=art", "amenity=bank", "amenity=fast_food"), F.when(i % 3 != 0, F.lit("brand:x"))))
    made = table(spark, sf_dir, "part").select("p_partkey", pick("Billa Plus", "Erste Bank Wien", "Spar", "Burger King").alias("name"), types.alias("types"))
    return filters.chain_candidates(made, dimensions.blacklist(spark), dimensions.whitelist(spark)).select("p_partkey", "kept", "reason")


_RULES = "(VALUES (FALSE, '/en/'), (TRUE, '/en/1'), (FALSE, '/en/12'), (TRUE, '/de/'), (FALSE, '/de/'), (FALSE, '/fr')) r(allow, path)"


@query(f"""WITH p AS (SELECT page_id, CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END AS path FROM pages)
SELECT page_id, coalesce(arg_max(r.allow, length(r.path) * 2 + CAST(r.allow AS INTEGER)), TRUE) AS allowed FROM p LEFT JOIN {_RULES} ON starts_with(p.path, r.path) GROUP BY page_id""")
def robots_longest_prefix(spark, sf_dir):
    body = "User-agent: x\nDisallow: /\n\nUser-agent: *\nDisallow: /en/\nAllow: /en/1\nDisallow: /en/12 # not these\nAllow: /de/\nDisallow: /de/\nDisallow: /fr\nCrawl-delay: 0.5"
    pages = table(spark, sf_dir, "pages")
    origins = pages.select(F.concat(url.scheme(F.col("url")), F.lit("://"), url.host(F.col("url"))).alias("origin")).distinct()
    robots = dimensions.robots_rules(origins.withColumns({"status": F.lit(200), "body": F.lit(body), "error": F.lit(None).cast("string")}))
    return joins.with_robots(pages.select("page_id", "url"), robots, "url").select("page_id", F.col("robots_allowed").alias("allowed"))


@query(f"WITH {_AUDITS} SELECT place_id, score FROM s WHERE tier IN ('A', 'C') AND score BETWEEN 3 AND 25 ORDER BY score DESC, i % 5 DESC, place_id LIMIT 40")
def export_filter_sort_limit(spark, sf_dir):
    out = filters.export_filter(rows.export_rows(_audits(spark, sf_dir)), tiers=["A", "C"], min_score=3, max_score=25)
    return filters.export_order(out, 40).select("place_id", "score")


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '10' || CAST(1 + c_custkey % 9 AS VARCHAR) || '0' END AS own, CASE WHEN c_custkey % 2 = 0 THEN '1020' END AS in_name FROM customer)
SELECT 'strict' AS mode, c_custkey FROM c WHERE own IN ('1010', '1020', '1040') UNION ALL SELECT 'permissive', c_custkey FROM c WHERE coalesce(own, in_name) IN ('1010', '1020', '1040') UNION ALL SELECT 'off', c_custkey FROM c""")
def plz_fallback_modes(spark, sf_dir):
    i = F.col("c_custkey")
    made = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(i % 3 == 0, F.concat(F.lit("10"), (1 + i % 9).cast("string"), F.lit("0"))).alias("plz"), F.when(i % 2 == 0, F.lit("Shop 1020")).otherwise(F.lit("Shop")).alias("name"), F.lit("http://x.at/").alias("url")
    )
    parts = [filters.plz_filter(made, ["1010", "1020", "1040"], m).select(F.lit(m).alias("mode"), "c_custkey") for m in ("strict", "permissive", "off")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""WITH d AS (SELECT * FROM (VALUES ('3', '1030'), ('1030', '1030'), ('landstraße', '1030'), ('LANDSTRASSE', '1030'), ('0', NULL), ('24', NULL), ('1121', NULL), ('x', NULL)) v(raw, plz))
SELECT c_custkey, d.plz AS district_plz FROM (SELECT c_custkey, (['3', '1030', 'landstraße', 'LANDSTRASSE', '0', '24', '1121', 'x'])[CAST(c_custkey % 8 AS INTEGER) + 1] AS raw FROM customer) c JOIN d USING (raw)""")
def district_resolve(spark, sf_dir):
    raw = F.element_at(F.array(*[F.lit(x) for x in ("3", "1030", "landstraße", "LANDSTRASSE", "0", "24", "1121", "x")]), (F.col("c_custkey") % 8 + 1).cast("int"))
    made = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return joins.resolved_districts(made, dimensions.districts(spark), "raw").select("c_custkey", "district_plz")


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def label_left_join(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("place_id"), F.col("quality").alias("score"), F.col("toxic").alias("psi_mobile_performance"))
    outcomes = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("lead_id"), F.col("lang").alias("status"), F.lit(None).cast("string").alias("channel"), F.lit(None).cast("string").alias("notes"), F.col("doc_id").alias("created_at"))
    joined = joins.labelled(outcomes, conform(labels, AUDIT))
    return joined.select(F.col("lead_id").cast("long").alias("doc_id"), F.col("status").alias("lang"), F.col("score").alias("quality"), F.col("features.psi_mobile_performance").alias("toxic"))


@query("SELECT user_id, arg_max(event_id, ROW(ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1")
def latest_per_key(spark, sf_dir):
    return dedupe.latest(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id").select("user_id", "event_id", "ts")


@query("SELECT event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS nth_newest, lead(event_type) OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS previous_status FROM events")
def history_desc(spark, sf_dir):
    made = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("lead_id"), F.col("event_type").alias("status"), F.unix_millis(F.col("ts").cast("timestamp")).alias("created_at"))
    return dedupe.history(made).select("id", F.col("nth_newest").cast("long").alias("nth_newest"), "previous_status")


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def first_seen(spark, sf_dir):
    return dedupe.first_seen(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", ["event_id"])



@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT c_custkey + 10000000, c_acctbal FROM customer WHERE c_custkey % 5 = 0")
def upsert_merge(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit(1).alias("at"))
    changed = old.where("c_custkey % 3 = 0")
    new = changed.select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit(3).alias("at")).unionByName(changed.select("c_custkey", F.lit(-1.0).alias("c_acctbal"), F.lit(2).alias("at")))
    new = new.unionByName(old.where("c_custkey % 5 = 0").select((F.col("c_custkey") + 10_000_000).alias("c_custkey"), "c_acctbal", F.lit(2).alias("at")))
    return upsert.merged(old, new, "c_custkey", "at").select("c_custkey", "c_acctbal")


@query("SELECT event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 20 AS allowed FROM events")
def daily_quota(spark, sf_dir):
    return filters.within_daily_quota(table(spark, sf_dir, "events"), "ts", "event_id", 20).select("event_id", "allowed")


@query("SELECT c_mktsegment AS name_key, CAST(c_custkey % 10 AS VARCHAR) AS category, count(*) AS places, count(DISTINCT n_name) AS districts FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 HAVING count(*) > 3 AND count(DISTINCT n_name) >= 3")
def suspected_chain(spark, sf_dir):
    made = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    made = made.select("c_mktsegment", (F.col("c_custkey") % 10).cast("string").alias("primary_type"), F.col("n_name").alias("district"))
    return aggregates.suspected_chains(made, F.col("c_mktsegment"))


@query("""SELECT 'p' || page_id AS place_id, 'last_modified' AS rule FROM pages WHERE page_id % 3 = 0 AND (1990 + page_id % 40 < 1995 OR 1990 + page_id % 40 > 2027) UNION ALL SELECT 'p' || page_id, 'closed_site_intent' FROM pages WHERE page_id % 7 = 6 AND page_id % 2 = 1 AND page_id % 5 = 0
UNION ALL SELECT 'p' || page_id, 'no_chain_branches' FROM pages WHERE page_id % 19 = 0""")
def invariant_violations(spark, sf_dir):
    """Rows with seeded faults: closed sites with an intent of live ones, branches without a chain."""
    i = F.substring("place_id", 2, 20).cast("long")
    bad = _audits(spark, sf_dir).withColumn("intent_tier", F.when((F.col("tier") == "C") & (i % 2 == 1) & (i % 5 == 0), F.lit("LIVE")).otherwise(F.col("intent_tier"))).withColumn("branch_count", F.when(i % 19 == 0, F.lit(2)).otherwise(F.col("branch_count")))
    return filters.violations(bad, 2026)


@query(f"WITH {_AUDITS} SELECT place_id, score AS stored, CAST(score - 1 AS INTEGER) AS recomputed FROM (SELECT place_id, i, score + 1 AS score FROM s) WHERE i % 10 = 0")
def score_drift(spark, sf_dir):
    i = F.substring("place_id", 2, 20).cast("long")
    return filters.score_drift(_audits(spark, sf_dir).withColumn("score", F.when(i % 10 == 0, F.col("score") + 1).otherwise(F.col("score"))))


@query("SELECT user_id % 5 AS seed, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) AS n FROM events) WHERE n <= 20 ORDER BY 1, 2 LIMIT 70")
def seed_budget(spark, sf_dir):
    made = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("seed"), "event_id")
    return filters.budgeted(made, "seed", ["event_id"], 20, 70)


_LINE = '''SELECT o_orderkey, o_orderkey || ';' || CASE WHEN o_orderkey % 2 = 0 THEN '"a;""b"""' ELSE o_orderpriority END || ';' || CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END
|| ';' || strftime(o_orderdate, '%Y-%m-%d') || ';"NO_SSL+3; PSI_EXCELLENT-1"' AS line FROM orders'''


@query(_LINE)
def csv_line_format(spark, sf_dir):
    k = F.col("o_orderkey")
    entries = F.array(F.struct(F.lit("NO_SSL").alias("key"), F.lit(3).alias("delta")), F.struct(F.lit("PSI_EXCELLENT").alias("key"), F.lit(-1).alias("delta")))
    made = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 2 == 0, F.lit('a;"b"')).otherwise(F.col("o_orderpriority")).alias("name"), F.when(k % 3 != 0, k % 2 == 0).alias("flag"), F.col("o_orderdate").cast("timestamp").alias("at"), entries.alias("e"))
    cells = [files.cell(f) for f in made.schema]
    return made.select(F.col("id").alias("o_orderkey"), F.concat_ws(";", *cells).alias("line"))


@query("""SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"status":' || CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE '"' || o_orderstatus || '"' END || ',"at":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS value FROM orders""")
def json_shape(spark, sf_dir):
    made = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderstatus")).alias("status"), F.col("o_orderdate").cast("timestamp").alias("at"))
    values = files.json_rows(made, "o_orderkey long, status string, at timestamp")
    return values.select(F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"), "value")


@query("""SELECT 'osm:node:' || s_suppkey AS place_id, s_name AS name, nullif(CASE WHEN s_suppkey % 2 = 0 THEN 'Gasse ' || s_suppkey || ', 1030 Wien' ELSE '1030 Wien' END, '') AS address, '03' AS district, CASE WHEN s_suppkey % 3 = 0 THEN 'cafe' ELSE 'bakery' END AS primary_type, s_suppkey % 5 = 0 AS brand FROM supplier WHERE s_suppkey % 7 <> 0""")
def osm_elements(spark, sf_dir):
    k = F.col("s_suppkey")
    tags = F.map_from_entries(
        F.array_compact(
            F.array(
                F.struct(F.when(k % 3 == 0, F.lit("amenity")).otherwise(F.lit("shop")).alias("key"), F.when(k % 3 == 0, F.lit("cafe")).otherwise(F.lit("bakery")).alias("value")),
                F.when(k % 7 != 0, F.struct(F.lit("name").alias("key"), F.col("s_name").alias("value"))), F.when(k % 2 == 0, F.struct(F.lit("addr:street").alias("key"), F.lit("Gasse").alias("value"))),
                F.struct(F.lit("addr:housenumber").alias("key"), k.cast("string").alias("value")), F.struct(F.lit("addr:postcode").alias("key"), F.lit("1030").alias("value")),
                F.struct(F.lit("addr:city").alias("key"), F.lit("Wien").alias("value")), F.when(k % 5 == 0, F.struct(F.lit("brand:wikidata").alias("key"), F.lit("Q1").alias("value"))),
            )
        )
    )
    made = table(spark, sf_dir, "supplier").select(F.lit("node").alias("type"), k.alias("id"), F.lit(1.0).alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("struct<lat:double,lon:double>").alias("center"), tags.alias("tags"))
    return places.map_elements(made).select("place_id", "name", "address", "district", "primary_type", text.has_brand(F.col("types")).alias("brand"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'no-match' WHEN s_suppkey % 4 = 1 THEN 'drop' WHEN s_suppkey % 4 = 2 THEN 'no-match' ELSE 'updated' END AS verdict, CASE s_suppkey % 4 WHEN 1 THEN 'http://m.at' WHEN 3 THEN 'http://m.at' END AS website FROM supplier")
def place_match_fill(spark, sf_dir):
    k = F.col("s_suppkey")
    none = F.lit(None).cast("string")
    made = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"), none.alias("address"), none.alias("website"), none.alias("phone"))
    created = F.when(k % 4 == 2, F.lit("2026-01-01 00:00:00")).otherwise(F.lit("2026-04-19 00:00:00")).cast("timestamp")
    matches = made.where(k % 4 != 0).select(
        text.cache_key(F.col("name"), F.col("address")).alias("key"), F.lit("http://m.at").alias("website"), F.lit("1").alias("phone"), none.alias("address"), F.when(k % 4 == 1, F.lit("CLOSED_PERMANENTLY")).otherwise(F.lit("OPERATIONAL")).alias("business_status"), created.alias("created_at")
    )
    return joins.place_matches(made, matches, F.lit(SETTINGS.as_of).cast("timestamp"), SETTINGS.places_ttl_days).select("s_suppkey", "verdict", "website")


@query()
def audit_pipeline(spark, sf_dir):
    """The whole audit with the driver's pages as the fetched sites."""
    pages = table(spark, sf_dir, "pages")
    fetches = pages.groupBy("url").agg(F.min_by("html", "page_id").alias("body")).select(
        "url", F.lit(200).alias("status"), F.create_map(F.lit("Server"), F.lit("nginx")).alias("headers"), "body", F.col("url").alias("final_url"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("ssl_valid"), F.lit(None).cast("timestamp").alias("ssl_expires_at"), F.lit(True).alias("http_to_https")
    )
    none = F.lit(None).cast("string")
    candidates = pages.select(
        F.concat(F.lit("p"), "page_id").alias("place_id"), F.lit("Ort").alias("name"), none.alias("address"), none.alias("plz"), none.alias("district"), F.array(F.lit("shop=books")).alias("types"), none.alias("primary_type"),
        F.when(F.col("page_id") % 6 != 0, F.col("url")).alias("website"), none.alias("phone"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"),
    )
    result = audit_plan.run(candidates, audit_plan.Inputs(fetches), SETTINGS, _PATTERNS)
    out = rows.export_rows(result.rows)
    return out.select("place_id", "tier", "sub_tier", "intent_tier", "score", "name", "url", "cms", text.breakdown_text(F.col("score_breakdown")).alias("breakdown"))


def queries() -> dict[str, Query]:
    from . import detail_queries, page_queries, site_queries, state_queries  # noqa: F401 (they register their own)

    return {name: e.run for name, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    from . import detail_queries, page_queries, site_queries, state_queries  # noqa: F401

    return {name: e.sql for name, e in REGISTRY.items() if e.sql}
