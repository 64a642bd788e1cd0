"""Queries of single functions and small operators. Texts are made from the rows' numbers, hosts and labels, so that values vary by row; SQL derives the results from the same parts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..functions import contact, detect, html, text, url
from ..operators import dedupe, filters, joins, rows, upsert
from ..schemas import AUDIT, OUTCOME, conform, struct
from ..sinks import files
from ..sources import lines
from .queries import _BARE, SETTINGS, query, table



def _n() -> Column:
    return F.col("page_id")


def _host() -> Column:
    return F.regexp_extract("url", "^[a-z]+://(?:www\\.)?([^/?#]*)", 1)


def _now() -> Column:
    return F.lit(SETTINGS.as_of).cast("timestamp")


def _nth(values, of: Column | None = None) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), ((_n() if of is None else of) % len(values)).cast("int"))


def _sql(values, of: str = "page_id") -> str:
    listed = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)
    return f"([{listed}])[CAST({of} % {len(values)} AS INTEGER) + 1]"


def _pages(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


# --- URLs and texts

_LABELS = ("müller", "STRÖCK", "plain", "café", "日本")


@query(f"SELECT page_id, {_sql([u.lower().encode('idna').decode() for u in _LABELS])} || '.' || {_BARE} AS host, CASE WHEN page_id % 2 = 0 THEN 'https://' || {_BARE} || '/a b?x=' || page_id END AS target FROM pages")
def punycode_and_shims(spark, sf_dir):
    """International hosts, and targets of redirect links."""
    shim = F.when(_n() % 2 == 0, F.concat(F.lit("https://l.instagram.com/?e=1&u="), F.url_encode(F.concat(F.lit("https://"), _host(), F.lit("/a b?x="), _n().cast("string"))), F.lit("&s=2"))).otherwise(F.concat(F.lit("https://"), _host(), F.lit("/?u=https%3A%2F%2Fa.at")))
    made = F.concat(F.lit("HTTPS://"), _nth(_LABELS), F.lit("."), _host(), F.lit(":443/p"))
    return _pages(spark, sf_dir).select("page_id", url.hostname(made).alias("host"), url.unshimmed(shim).alias("target"))


@query(f"""SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'Haus ' || page_id || ' GmbH' WHEN 1 THEN 'Betrieb ' || page_id WHEN 2 THEN 'Laden ' || page_id || ' e.U.' WHEN 3 THEN 'Wirt ' || page_id ELSE NULL END AS company,
'Gasse ' || (1 + page_id % 90) || ', 1' || lpad(CAST(page_id % 30 AS VARCHAR), 2, '0') || '0 Wien' AS address, page_id % 30 BETWEEN 1 AND 23 AS viennese FROM pages""")
def imprint_fields(spark, sf_dir):
    """Company names behind labels and before legal forms, addresses, and whether their postal code is a Viennese one."""
    number = _n().cast("string")
    name = (
        F.when(_n() % 5 == 0, F.concat(F.lit("firmenname :  Haus "), number, F.lit(" GmbH\nweiter"))).when(_n() % 5 == 1, F.concat(F.lit("Inhaber: Betrieb "), number, F.lit(" Telefon: 1")))
        .when(_n() % 5 == 2, F.concat(F.lit("wir, Laden "), number, F.lit(" e.U. in Wien"))).when(_n() % 5 == 3, F.concat(F.lit("Unternehmen: Wirt "), number, F.lit(" | "))).otherwise(F.lit("nur kleingeschrieben"))
    )
    code = F.concat(F.lit("1"), F.lpad((_n() % 30).cast("string"), 2, "0"), F.lit("0"))
    place = F.concat(F.lit("| Gasse  "), (1 + _n() % 90).cast("string"), F.lit(",\n "), code, F.lit(" Wien |"))
    found = contact.strict_address(place)
    return _pages(spark, sf_dir).select("page_id", text.company_name_in(name).alias("company"), contact.address(place).alias("address"), (found["plz"].isNotNull() & contact.is_vienna_plz(code)).alias("viennese"))


@query(f"""SELECT page_id, replace({_BARE} || '/x', '/', '/') || '/' || page_id AS cell, CASE WHEN length({_BARE}) <= 18 THEN {_BARE} ELSE left({_BARE}, 17) || '…' END AS short,
page_id % 4 <> 3 AND page_id % 5 <> 4 AND length({_BARE}) + 12 BETWEEN 20 AND 140 AS valid FROM pages""")
def cells_and_opportunities(spark, sf_dir):
    """Cells of tables, cut texts, and texts that are offered as opportunities."""
    items = F.when(_n() % 4 == 3, F.array(*[F.concat(F.lit("Verbessern: "), _host())] * 4)).otherwise(F.array(F.concat(F.lit("Verbessern: "), _host())))
    items = F.when(_n() % 5 == 4, F.array(F.concat(F.lit("Verbessere Deine Seite "), _host()))).otherwise(items)
    return _pages(spark, sf_dir).select("page_id", text.table_cell(F.concat(_host(), F.lit("/x|"), _n().cast("string"))).alias("cell"), text.truncated(_host(), 18).alias("short"), text.opportunities_valid(items).alias("valid"))


_LOCALS = ("office", "anna", "info2", "kontakt.wien", "buero", "welcome", "sales_at", "Team")


@query(f"""WITH l AS (SELECT page_id, {_BARE} AS h, {_sql(_LOCALS)} AS a, {_sql(_LOCALS, 'page_id // 8')} AS b FROM pages)
SELECT page_id, regexp_matches(lower(a), '^(office|info|kontakt|buero|sales|team)([._0-9-]|$)') AND a <> 'buero' AS business,
CASE WHEN page_id % 3 = 0 AND a NOT IN ('anna', 'buero', 'welcome') THEN a || '@' || h WHEN b NOT IN ('anna', 'buero', 'welcome') THEN b || '@' || h END AS email FROM l""")
def business_emails(spark, sf_dir):
    """Business mailboxes, and the first of a page: of its links, else of its text."""
    a, b = (F.concat(_nth(_LOCALS, of), F.lit("@"), _host()) for of in (_n(), F.floor(_n() / 8)))
    links = F.when(_n() % 3 == 0, F.array(F.lit("/x"), F.concat(F.lit("mailto: "), a, F.lit("?subject=y")))).otherwise(F.array(F.lit("tel:1")))
    return _pages(spark, sf_dir).select("page_id", contact.is_generic_business(a).alias("business"), contact.generic_email(links, F.concat(F.lit("Mail: "), b, F.lit(" ."))).alias("email"))


_NAMES = ("AbortError", "TimeoutError", "TypeError", "TypeError", "Error", "Error", "Error", "Error", "Error", "Error")
_CODES = (None, "ENOTFOUND", "ENOTFOUND", "ECONNREFUSED", "CERT_HAS_EXPIRED", "SELF_SIGNED_CERT_IN_CHAIN", "ERR_SSL_PROTOCOL_ERROR", "ERR_TLS_CERT_ALTNAME_INVALID", "EPIPE", None)
_CLASSES = ("TIMEOUT", "TIMEOUT", "DNS_FAIL", "CONNECTION_REFUSED", "CERT_EXPIRED", "CERT_INVALID", "SSL_HANDSHAKE", "SSL_HANDSHAKE", "UNKNOWN", "UNKNOWN")


@query(f"SELECT page_id, {_sql(_CLASSES)} AS error, {_sql(('AUTH_ERROR', 'QUOTA_EXCEEDED', 'CLIENT_ERROR', 'CLIENT_ERROR'))} AS forbidden FROM pages")
def error_classes(spark, sf_dir):
    """X57."""
    message = F.concat(_host(), _nth((": the API key is bad", ": Quota used up", ": no", "")))
    return _pages(spark, sf_dir).select("page_id", detect.fetch_error(_nth(_NAMES), _nth(_CODES)).alias("error"), detect.forbidden_error(F.when(_n() % 4 != 3, message)).alias("forbidden"))


# --- contact pages

_CONTACT_SITE = "'https://k' || page_id || '.at'"


@query(f"""WITH k AS (SELECT page_id, page_id % 5 <> 4 AS linked, page_id % 7 = 3 AS blocked, page_id % 2 = 0 AS has_uid, 1 + page_id % 30 AS code, lpad(CAST(page_id % 1000000 AS VARCHAR), 7, '1') AS n FROM pages),
f AS (SELECT *, linked AND NOT blocked AS there, code BETWEEN 1 AND 23 AS viennese FROM k)
SELECT page_id, CASE WHEN there THEN 'https://k' || page_id || '.at/wir/kontakt' END AS impressum_url, 'office@k' || page_id || '.at' AS email,
CASE WHEN there THEN 'eva' || page_id || '@k' || page_id || '.at,office@k' || page_id || '.at' ELSE 'office@k' || page_id || '.at' END AS emails, CASE WHEN there THEN '+431' || n END AS phone,
CASE WHEN there AND viennese THEN 'Kaigasse 3, 1' || lpad(CAST(code AS VARCHAR), 2, '0') || '0 Wien' END AS address, CASE WHEN there AND has_uid THEN 'ATU2' || n END AS uid,
CASE WHEN there THEN 'P' ELSE '' END || 'E' || CASE WHEN there AND viennese THEN 'A' ELSE '' END AS coverage, linked AND blocked AS robots_blocked FROM f""")
def contact_pages(spark, sf_dir):
    """A home page with a role's address, and a contact page, linked from four in five, that robots rules keep closed at one in seven. The first page's address counts, in the list personal ones come first."""
    made = _pages(spark, sf_dir)
    n, site = _n().cast("string"), F.expr(_CONTACT_SITE)
    home = F.concat(F.when(_n() % 5 != 4, F.lit('<a href="/wir/kontakt">So finden Sie uns</a>')).otherwise(F.lit("")), F.lit("<p>Mail: OFFICE (at) k"), n, F.lit(".at</p>"))
    digits = F.lpad((_n() % 1_000_000).cast("string"), 7, "1")
    page = F.concat(
        F.lit("<body>| Kaigasse 3, 1"), F.lpad((1 + _n() % 30).cast("string"), 2, "0"), F.lit("0 Wien |\n"), F.when(_n() % 2 == 0, F.concat(F.lit("UID: ATU2"), digits)).otherwise(F.lit("UID folgt")),
        F.lit('\n<a href="tel:+43 1 '), digits, F.lit('">Anruf</a> office@k'), n, F.lit('.at <a href="mailto:Eva'), n, F.lit("@k"), n, F.lit('.at?x=1">Eva</a></body>'),
    )
    none = F.lit(None).cast("string")
    fetch = lambda address, body: [address.alias("url"), F.lit(200).alias("status"), body.alias("body"), address.alias("final_url"), none.alias("error")]
    fetches = made.select(*fetch(site, home)).unionByName(made.select(*fetch(F.concat(site, F.lit("/wir/kontakt")), page)))
    robots = made.where("page_id % 7 = 3").select(site.alias("origin"), F.array(F.struct(F.lit(False).alias("allow"), F.lit("/wir").alias("path"))).alias("rules"))
    # the usual paths of a site answer nothing here; they count as visits all the same
    sites = made.select(n.alias("place_id"), site.alias("website"), site.alias("final_url"), html.page_facts(home).alias("facts"))
    found = joins.contacts(sites, fetches, robots).select(F.col("place_id").cast("long").alias("page_id"), "contact.*")
    return found.select("page_id", "impressum_url", "email", F.array_join("emails", ",").alias("emails"), "phone", "address", "uid", "coverage", F.col("robots_blocked").alias("robots_blocked"))


# --- small operators


@query("""SELECT page_id, CAST(round((page_id % 101) / 100.0 * 100) AS INTEGER) AS performance, CAST(round(page_id % 7 / 8.0 * 100) AS INTEGER) AS seo FROM pages WHERE page_id % 5 <> 0
UNION ALL SELECT page_id, NULL, NULL FROM pages WHERE page_id % 5 = 0""")
def speed_scores(spark, sf_dir):
    """Shares as rounded percents; pages without a measurement have none."""
    made = _pages(spark, sf_dir).withColumn("at", F.concat(F.lit("u"), _n().cast("string")))
    none = F.lit(None).cast("string")
    psi = made.where("page_id % 5 <> 0").select(F.col("at").alias("url"), (_n() % 101 / 100).alias("performance"), (_n() % 7 / 8).alias("seo"), F.lit(0.5).alias("accessibility"), F.lit(0.5).alias("best_practices"), none.alias("fetched_at"), none.alias("error"))
    return joins.with_psi(made.select("page_id", "at"), psi, "at").select("page_id", "psi.performance", "psi.seo")


def _statuses(spark, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", _nth(("A", "B1", "C", "A", "B3")).alias("tier"), _nth(("OPERATIONAL", "CLOSED_PERMANENTLY", None, "CLOSED_TEMPORARILY")).alias("business_status"), F.timestamp_seconds(F.lit(1_776_600_000) - _n() * 7919 % 2_000_000).alias("created_at"))


@query(f"""SELECT page_id, CAST(floor(seconds / 86400) AS BIGINT) AS days FROM (SELECT page_id, epoch(TIMESTAMP '{SETTINGS.as_of}') - 1776600000 + page_id * 7919 % 2000000 AS seconds FROM pages
WHERE page_id % 5 IN (0, 3) AND page_id % 4 <> 1) WHERE seconds < 14 * 86400""")
def open_fresh_places(spark, sf_dir):
    """Rows of a tier, without places closed for good, younger than 14 days."""
    kept = filters.open_places(filters.of_tier(_statuses(spark, sf_dir), "A"))
    return filters.unexpired(kept, "created_at", _now(), 14).select("page_id", F.floor("age_days").alias("days"))


_MARKED = ("TIMEOUT", "UNKNOWN", "DNS_FAIL")


@query(f"""SELECT 'p' || page_id AS place_id, 'C' AS tier, {_sql(_MARKED)} AS fetch_error, CAST(NULL AS INTEGER) AS score, CAST(NULL AS VARCHAR) AS intent_tier, FALSE AS impressum_present, CAST(1 AS INTEGER) AS branch_count,
TIMESTAMP '{SETTINGS.as_of}' + INTERVAL 30 DAY AS static_signals_expires_at FROM pages WHERE page_id % 3 <> 1""")
def failed_audits(spark, sf_dir):
    """K2: marker rows."""
    made = _pages(spark, sf_dir).where("page_id % 3 <> 1").select(F.concat(F.lit("p"), _n().cast("string")).alias("place_id"), _nth(_MARKED).alias("error"))
    return rows.error_rows(made, SETTINGS).select("place_id", "tier", "fetch_error", "score", "intent_tier", "impressum_present", "branch_count", F.col("static_signals_expires_at").cast("timestamp_ntz").alias("static_signals_expires_at"))


@query(f"""SELECT 'p' || page_id AS place_id, CASE page_id % 4 WHEN 0 THEN 'Haus ' || page_id WHEN 1 THEN NULL ELSE rtrim(left('Name ' || page_id || repeat(' x', 60), 80)) END AS name FROM pages WHERE page_id % 4 <> 3""")
def renamed_rows(spark, sf_dir):
    """Stored names that today's rules write differently: labels inside, too short ones, too long ones."""
    number = _n().cast("string")
    stored = F.when(_n() % 4 == 0, F.concat(F.lit("Haus "), number, F.lit(" Telefon: 1"))).when(_n() % 4 == 1, F.lit("x:")).when(_n() % 4 == 2, F.concat(F.lit("Name "), number, F.repeat(F.lit(" x"), F.lit(60)))).otherwise(F.concat(F.lit("Laden "), number))
    made = _pages(spark, sf_dir).select(F.concat(F.lit("p"), number).alias("place_id"), stored.alias("impressum_company_name"))
    return rows.renamed(conform(made, AUDIT)).select("place_id", F.col("impressum_company_name").alias("name"))


# --- outcomes and files


def _outcomes(spark, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    made = table(spark, sf_dir, "labels").select(i.alias("id"), F.concat(F.lit("p"), (i % 97).cast("string")).alias("lead_id"), F.when(F.col("quality") == 1, F.lit("INTERESSIERT")).otherwise(F.lit("NO_ANSWER")).alias("status"), _nth(("MAIL", None, "CALL"), i).alias("channel"), F.when(i % 4 == 0, F.concat(F.lit('said "'), i.cast("string"), F.lit('"'))).alias("notes"), (1_000_000 + i * 7919 % 500_000).alias("created_at"))
    return conform(made, OUTCOME)


def _place(spark, name: str) -> str:
    return f"{tables.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""SELECT doc_id AS id, 'p' || (doc_id % 97) AS lead_id, CASE WHEN quality = 1 THEN 'INTERESSIERT' ELSE 'NO_ANSWER' END AS status, 1000000 + doc_id * 7919 % 500000 AS created_at FROM labels
UNION ALL SELECT doc_id, 'p' || (doc_id % 97), CASE WHEN quality = 1 THEN 'INTERESSIERT' ELSE 'NO_ANSWER' END, 1000000 + doc_id * 7919 % 500000 FROM labels WHERE doc_id % 10 = 0""")
def outcome_log(spark, sf_dir):
    """K3, T4: outcomes appended in two batches; the log keeps every row, also equal ones."""
    made, path = _outcomes(spark, sf_dir), _place(spark, "outcomes")
    upsert.append_outcomes(made, path)
    upsert.append_outcomes(made.where("id % 10 = 0"), path)
    return spark.read.schema(struct(OUTCOME)).parquet(path).select("id", "lead_id", "status", "created_at")


@query("""WITH o AS (SELECT doc_id, doc_id % 97 AS lead, CASE WHEN quality = 1 THEN 'INTERESSIERT' ELSE 'NO_ANSWER' END AS status, CASE doc_id % 3 WHEN 0 THEN '"MAIL"' WHEN 2 THEN '"CALL"' ELSE 'null' END AS channel, CASE WHEN doc_id % 4 = 0 THEN '"said \\"' || doc_id || '\\""' ELSE 'null' END AS notes,
1000000 + doc_id * 7919 % 500000 AS created_at FROM labels)
SELECT row_number() OVER (ORDER BY created_at DESC, doc_id DESC) AS row, '{"lead_id":"p' || lead || '","status":"' || status || '","channel":' || channel || ',"notes":' || notes || ',"created_at":' || created_at || ',"score":' || CASE WHEN lead % 2 = 0 THEN CAST(lead % 31 AS VARCHAR) ELSE 'null' END
|| ',"features":{' || CASE WHEN lead % 2 = 0 THEN '"tier":"A","psi_mobile_performance":' || CASE WHEN lead % 3 = 0 THEN 'null' ELSE CAST(lead % 101 AS VARCHAR) END ELSE '' END || '}}' AS line FROM o""")
def label_export_file(spark, sf_dir):
    """Labels, newest first, with two features of their audits, as the lines of an exported file."""
    lead = F.col("id")
    audits = spark.range(0, 97, 2).select(F.concat(F.lit("p"), lead.cast("string")).alias("lead_id"), (lead % 31).cast("int").alias("score"), F.struct(F.lit("A").alias("tier"), F.when(lead % 3 != 0, (lead % 101).cast("int")).alias("psi_mobile_performance")).alias("features"))
    labelled = _outcomes(spark, sf_dir).join(audits, "lead_id", "left").orderBy(F.desc("created_at"), F.desc("id")).drop("id")
    path = f"{_place(spark, 'labels')}.jsonl"
    files.write_jsonl(files.label_lines(labelled), path)
    return lines.numbered(spark, path).select("row", "line")


@query(f"""SELECT page_id, 'p' || page_id || chr(9) || {_BARE} || chr(9) || CASE WHEN page_id % 2 = 0 THEN 'gastronomy' ELSE 'other' END || chr(9) || CASE WHEN page_id % 3 = 0 THEN '1030' ELSE '' END || chr(9) || url AS line FROM pages""")
def discover_listing(spark, sf_dir):
    """K9."""
    made = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), _n().cast("string")).alias("place_id"), _host().alias("name"), F.when(_n() % 3 == 0, F.lit("1030")).alias("plz"), F.col("url").alias("website"), F.array(F.lit("x")).alias("types"), F.when(_n() % 2 == 0, F.lit("cafe")).alias("primary_type"))
    placed = joins.with_industry(made)
    return files.listing(placed).select(F.regexp_extract("line", "^p([0-9]+)", 1).cast("long").alias("page_id"), "line")


@query(f"""WITH s AS (SELECT {_BARE} AS host, arg_min((['osm', 'places', 'dns'])[CAST(page_id % 3 AS INTEGER) + 1], page_id) AS source FROM pages GROUP BY 1) SELECT source, count(*) AS added FROM s GROUP BY 1""")
def source_contributions(spark, sf_dir):
    """How many hosts each source found first."""
    made = table(spark, sf_dir, "pages").select(_host().alias("place_id"), _nth(("osm", "places", "dns")).alias("source"), "page_id")
    return dedupe.contributions(made, ["page_id"])
