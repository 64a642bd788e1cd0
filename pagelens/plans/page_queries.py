"""Queries over made pages with planted facts: every case has its own rows, and SQL derives the expected values from the row number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contact, detect, html, text, url
from ..operators import dedupe, joins
from ..sources import places
from .queries import query, table

#: A technology, its bucket, HTML with two of its signals, and headers with two where it has no signal in HTML.
SAMPLES = (
    ("wordpress", "cms", '<link href="/wp-content/a.css"><script src="/wp-includes/b.js"></script>', {}),
    ("joomla", "cms", '<script src="/media/jui/a.js"></script><a href="/components/com_x">x</a>', {}),
    ("drupal", "cms", '<img src="/sites/default/files/a.png"><img src="/sites/all/themes/b.png">', {}),
    ("typo3", "cms", '<img src="typo3conf/a.png"><img src="typo3temp/b.png">', {}),
    ("contao", "cms", '<script src="/bundles/contao/a.js"></script><img src="/files/tx_contao/a.png">', {}),
    ("wix", "cms", '<img src="https://static.wixstatic.com/a.png">', {"X-Wix-Request-Id": "7"}),
    ("squarespace", "cms", '<meta name="g" content="Squarespace"><img src="https://static1.squarespace.com/a">', {}),
    ("jimdo", "cms", '<script src="https://assets.jimstatic.com/a.js"></script><a href="https://x.jimdofree.com/">x</a>', {}),
    ("shopify", "cms", '<script src="https://cdn.shopify.com/a.js"></script><script>Shopify.theme = 1</script>', {}),
    ("webflow", "cms", '<html data-wf-site="1" data-wf-page="2">', {}),
    ("hubspot", "cms", '<script src="https://js.hs-scripts.com/1.js"></script><script src="https://js.hs-analytics.net/1.js"></script>', {}),
    ("divi", "pageBuilder", '<div class="et_pb_section"><div class="et_pb_row"></div></div>', {}),
    ("oxygen", "pageBuilder", '<div id="oxy-section-12" class="ct_builder"></div>', {}),
    ("beaver-builder", "pageBuilder", '<div class="fl-builder-content"><div class="fl-node-1"></div></div>', {}),
    ("visual-composer", "pageBuilder", '<div class="vc_row"><div class="vc_column"></div></div>', {}),
    ("gutenberg", "pageBuilder", '<p class="wp-block-quote has-text-align-center">x</p>', {}),
    ("google-analytics", "analytics", "<script>ga('create', 1); gtag('config', 'UA-123')</script>", {}),
    ("matomo", "analytics", "<script>var _paq = []; load('matomo.js')</script>", {}),
    ("plausible", "analytics", '<script src="https://plausible.io/js/a.js"></script><a href="https://plausible.io/api/event">x</a>', {}),
    ("fathom", "analytics", '<script src="https://cdn.usefathom.com/x.js" data-site="ABCDEFGH"></script>', {}),
    ("facebook-pixel", "tracking", "<script src='https://connect.facebook.net/en_US/fbevents.js'></script><script>fbq('init', 1)</script>", {}),
    ("google-tag-manager", "tracking", "<script src='https://www.googletagmanager.com/gtm.js?id=GTM-ABC1'></script>", {}),
    ("hotjar", "tracking", "<script>window._hjSettings = {hjid: 77}</script>", {}),
    ("mouseflow", "tracking", "<script>_mfq = []; load('//cdn.mouseflow.com/a.js')</script>", {}),
    ("stripe", "payment", "<script src='https://js.stripe.com/v3'></script><a href='https://checkout.stripe.com/x'>x</a>", {}),
    ("paypal", "payment", "<script src='https://www.paypal.com/sdk/js'></script><script>paypal.Buttons()</script>", {}),
    ("klarna", "payment", "<script src='https://js.klarna.com/a.js'></script><klarna-placement></klarna-placement>", {}),
    ("cloudflare", "cdn", "", {"SERVER": "cloudflare", "CF-Ray": "x"}),
    ("fastly", "cdn", "", {"X-Served-By": "cache-vie1", "X-Fastly-Request-Id": "1"}),
    ("aws-cloudfront", "cdn", "", {"X-Amz-Cf-Id": "1", "Via": "1.1 CloudFront"}),
    ("netlify", "cdn", "", {"Server": "Netlify", "X-Nf-Request-Id": "1"}),
    ("vercel", "cdn", "", {"Server": "Vercel", "X-Vercel-Id": "1"}),
    ("none", "none", "<p>wp-content/ alone is one signal</p>", {"Server": "nginx"}),
)


def _nth(i: Column, values, kind: str = "string") -> Column:
    """The value for row i, in turn."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) if v is None else F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def _customers(spark, sf_dir: str) -> DataFrame:
    """Customers' numbers, dealt over all cores: a file with few row groups is few tasks, and the pages are made and parsed where the rows lie."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("i")).repartition(n, "i")


_ROWS = "SELECT c_custkey AS i FROM customer"
_TECH = ", ".join(f"({n}, '{name}', '{bucket}')" for n, (name, bucket, _, _) in enumerate(SAMPLES))


@query(f"""SELECT page_id, CASE WHEN bucket = 'none' THEN '' ELSE bucket || '=' || name END AS tech FROM pages JOIN (VALUES {_TECH}) s(n, name, bucket) ON n = page_id % {len(SAMPLES)}""")
def tech_stack_planted(spark, sf_dir):
    i = F.col("page_id")
    headers = F.element_at(F.array(*[F.create_map(*[F.lit(x) for kv in h.items() for x in kv]) if h else F.lit(None).cast("map<string,string>") for _, _, _, h in SAMPLES]), (i % len(SAMPLES) + 1).cast("int"))
    body = F.concat(F.col("html"), _nth(i, [h for _, _, h, _ in SAMPLES]))
    stack = table(spark, sf_dir, "pages").select("page_id", detect.tech_stack(body, F.coalesce(headers, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))).alias("t"))

    def named(bucket: str) -> Column:
        return F.transform(F.col(f"t.{bucket}"), lambda x: F.concat(F.lit(bucket + "="), x))

    found = F.concat(*[named(b) for b in detect.BUCKETS])
    return stack.select("page_id", F.array_join(found, ",").alias("tech"))


_SOCIAL = (
    ("", ""),
    ('<a href="https://www.facebook.com/shop1">f</a><a href="https://facebook.com/other">f</a>', "facebook=https://www.facebook.com/shop1"),
    ('<a href="https://www.facebook.com/sharer/x">f</a><a href="https://m.facebook.com/real">f</a>', "facebook=https://m.facebook.com/real"),
    ('<a href=" https://instagram.com/me "><b>i</b></a><a href="https://x.com/intent/t">x</a>', "instagram=https://instagram.com/me"),
    ('<a href="https://www.instagram.com/p/1">i</a><a href="https://twitter.com/us">t</a>', "twitter=https://twitter.com/us"),
    ('<a href="https://at.linkedin.com/in/x">l</a><a href="https://de.linkedin.com/company/y">l</a>', "linkedin=https://de.linkedin.com/company/y"),
    ('<a href="https://www.xing.com/pages/z">x</a><a href="https://www.youtube.com/watch?v=1">y</a><a href="https://m.youtube.com/c/k">y</a>', "xing=https://www.xing.com/pages/z,youtube=https://m.youtube.com/c/k"),
    ('<a href="https://www.tiktok.com/">t</a><a href="mailto:a@facebook.com">m</a><a href="https://www.tiktok.com/@q">t</a>', "tiktok=https://www.tiktok.com/@q"),
)
_TYPED = (
    ("", ""),
    ('<script type="application/ld+json">{"@type": "Restaurant"}</script>', "Restaurant"),
    ('<script type="application/ld+json">{"@graph": [{"@type": ["LocalBusiness", "Thing"]}, {"@type": "WebPage"}]}</script>', "LocalBusiness,Thing,WebPage"),
    ('<div itemscope itemtype="https://schema.org/Store"><span itemtype="http://schema.org/PostalAddress"></span></div>', "Store,PostalAddress"),
    ('<script type="application/ld+json">{broken</script><div itemtype="https://example.org/Store"></div>', ""),
)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join([str(n), *["'" + x.replace("'", "''") + "'" for x in r]]) + ")" for n, r in enumerate(rows))


@query(f"""SELECT page_id, len(regexp_extract_all(html || s.added, '(?i)<a\\s[^>]*href')) AS n_links, s.expected AS social, t.expected <> '' AS has_schema_org, t.expected AS types
FROM pages JOIN (VALUES {_values(_SOCIAL)}) s(n, added, expected) ON s.n = page_id % {len(_SOCIAL)} JOIN (VALUES {_values(_TYPED)}) t(n, added, expected) ON t.n = page_id % {len(_TYPED)}""")
def html_facts(spark, sf_dir):
    i = F.col("page_id")
    body = F.concat("html", _nth(i, [a for a, _ in _SOCIAL]), _nth(i, [a for a, _ in _TYPED]))
    facts = table(spark, sf_dir, "pages").select("page_id", html.page_facts(body).alias("f"))
    social = F.transform(F.map_entries(detect.social_links(html.hrefs(F.col("f")))), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return facts.select(
        "page_id", F.size("f.links").cast("long").alias("n_links"), F.array_join(social, ",").alias("social"), html.schema_org(F.col("f"))["has_schema_org"].alias("has_schema_org"), F.array_join("f.schema_types", ",").alias("types")
    )


@query(f"""SELECT i, CASE i % 8 WHEN 0 THEN 2000 + i % 20 WHEN 1 THEN 2021 WHEN 2 THEN 2000 + i % 24 WHEN 3 THEN 2019 WHEN 4 THEN NULL WHEN 5 THEN 2003 WHEN 6 THEN NULL ELSE 2018 END AS year FROM ({_ROWS})""")
def last_modified_years(spark, sf_dir):
    i = F.col("i")
    at = lambda n: (F.lit(2000) + i % n).cast("string")
    body = (
        F.when(i % 8 == 0, F.concat(F.lit("<p>© 1999 - "), at(20), F.lit("</p><p>&copy; 1998</p>")))
        .when(i % 8 == 1, F.lit("<p>© Copyright 2012</p><p>© 2021</p><time datetime='2025-01-01'>"))
        .when(i % 8 == 2, F.lit("<p>none</p><time datetime='2001-01-01'>x</time>"))
        .when(i % 8 == 3, F.lit('<time class="a" datetime="2019-05-06T10:00:00Z">x</time><time datetime="2011-01-01">y</time>'))
        .when(i % 8 == 4, F.lit("<p>© 1980 and © 2090</p>"))
        .when(i % 8 == 5, F.lit('<meta property="article:modified_time" content="2003-02-01">'))
        .when(i % 8 == 6, F.lit("<p>Copyright 2020 without the sign</p>"))
        .otherwise(F.lit('<meta content="2018" property="article:modified_time"><time datetime="soon">'))
    )
    headers = F.create_map(F.lit("LAST-Modified"), F.when(i % 8 == 2, F.concat(F.lit("Mon, 01 Mar "), at(24), F.lit(" 10:00:00 GMT"))))
    return _customers(spark, sf_dir).select("i", detect.last_modified_year(body, headers, 2026).alias("year"))


_DIRECTORY_PAGES = (
    ("herold", "https://www.herold.at/p/{}", '<a data-testid="website-link" href="https://www.yelp.com/x">y</a><a class="big website" href="{}">w</a><a class="website" href="https://facebook.com/x">f</a>'),
    ("firmenabc", "https://www.firmenabc.at/p/{}", '<div class="company-website"><p><a href="{}">w</a></p></div>'),
    ("wko", "https://firmen.wko.at/p/{}", '<script type="application/ld+json">{{"url": "https://firmen.wko.at/p", "sameAs": ["{}"]}}</script>'),
    ("facebook", "https://www.facebook.com/p{}", '<a aria-label="Website besuchen" href="{}">w</a>'),
    ("falstaff", "https://www.falstaff.at/p/{}", '<div class="restaurant-info"><a class="website" href="{}">w</a></div>'),
    ("gaultmillau", "https://www.gaultmillau.at/p/{}", '<div class="restaurant-details"><a href="{}">w</a></div>'),
    (None, "https://other.at/p/{}", '<a class="website" href="{}">w</a>'),
)
_SITE = "https://firma{}.at/start?utm_source=d"


@query(f"""SELECT i, (['herold', 'firmenabc', 'wko', 'facebook', 'falstaff', 'gaultmillau', NULL])[CAST(i % 7 AS INTEGER) + 1] AS directory, CASE WHEN i % 7 < 6 THEN 'https://firma' || i || '.at/start' END AS site FROM ({_ROWS})""")
def directory_sites(spark, sf_dir):
    i = F.col("i")
    site = F.format_string(_SITE.replace("{}", "%d"), i)
    pages = _customers(spark, sf_dir).select(
        "i", F.replace(_nth(i, [p for _, p, _ in _DIRECTORY_PAGES]), F.lit("{}"), i.cast("string")).alias("page"),
        F.replace(_nth(i, [b.replace("{{", "{").replace("}}", "}") for _, _, b in _DIRECTORY_PAGES]), F.lit("{}"), site).alias("body"),
    )
    facts = pages.withColumn("f", html.page_facts("body"))
    return facts.select("i", detect.directory(F.col("page")).alias("directory"), html.directory_site(F.col("page"), F.col("f")).alias("site"))


def _fetch(url_: Column, body: Column, status: Column | None = None, error: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("string")
    return [url_.alias("url"), (F.lit(200) if status is None else status).alias("status"), body.alias("body"), url_.alias("final_url"), (none if error is None else error).alias("error")]


def _candidates(spark, sf_dir: str) -> DataFrame:
    i = F.col("i")
    name = F.when(i % 6 == 5, F.format_string("Filiale Gruber%d", i)).otherwise(F.format_string("Blumenhaus Gruber%d", i))
    return _customers(spark, sf_dir).select("i", i.cast("string").alias("place_id"), name.alias("name"), F.lit("1070").alias("plz"), F.format_string("+43 1 99%07d", i).alias("phone"))


@query(f"""SELECT CAST(i AS VARCHAR) AS place_id, CASE i % 6 WHEN 0 THEN 'https://blumenhaus-gruber' || i || '.wien' WHEN 1 THEN 'https://www.blumenhaus-gruber' || i || '.at' ELSE 'https://blumenhaus-gruber' || i || '-wien.at' END AS url FROM ({_ROWS}) WHERE i % 6 IN (0, 1, 4)""")
def dns_guesses(spark, sf_dir):
    """A guess counts if its page is the candidate's: by postal code, phone or two words of the name; wrong pages, errors and branch names don't."""
    made = _candidates(spark, sf_dir)
    i, domain = F.col("i"), F.format_string("gruber%d", F.col("i"))
    at = lambda head, tail: F.concat(F.lit("https://"), F.lit(head), F.lit("blumenhaus-"), domain, F.lit(tail))
    parts = [
        made.where("i % 6 = 0").select(*_fetch(at("", ".at"), F.lit("another shop"))),
        made.where("i % 6 = 0").select(*_fetch(at("", ".wien"), F.lit("<p>A-1070 Wien</p>"))),
        made.where("i % 6 = 1").select(*_fetch(at("www.", ".at"), F.format_string("call 0199%07d", i))),
        made.where("i % 6 = 1").select(*_fetch(at("", ".co.at"), F.lit("1070"))),
        made.where("i % 6 = 2").select(*_fetch(at("", ".at"), F.lit("1070"), status=F.lit(404))),
        made.where("i % 6 = 3").select(*_fetch(at("", ".at"), F.lit("1070"), error=F.lit("TIMEOUT"))),
        made.where("i % 6 = 4").select(*_fetch(at("", "-wien.at"), F.format_string("BLUMENHAUS of gruber%d", i))),
        made.where("i % 6 = 5").select(*_fetch(F.concat(F.lit("https://filiale-"), domain, F.lit(".at")), F.lit("1070"))),
    ]
    fetches = parts[0]
    for p in parts[1:]:
        fetches = fetches.unionByName(p)
    return joins.by_dns_guess(made, fetches)


@query(f"""SELECT CAST(i AS VARCHAR) AS place_id, 'https://firma' || (i * 10 + CASE WHEN i % 3 = 0 THEN 2 ELSE 1 END) || '.at/start' AS url FROM ({_ROWS}) WHERE i % 3 <> 2""")
def directory_search(spark, sf_dir):
    """The first search hit whose directory page names a site that is the candidate's."""
    made, i = _candidates(spark, sf_dir), F.col("i")
    n = i * 10 + F.col("nth")
    hits = made.select("i", "place_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("nth"))
    link = F.format_string("https://www.firmenabc.at/p/%d", n)
    links = hits.select("place_id", F.lit(1).alias("query_rank"), F.col("nth").alias("link_rank"), link.alias("link"))
    directories = hits.select(*_fetch(link, F.format_string('<div class="company-website"><a href="https://firma%d.at/start?utm_source=d">w</a></div>', n)))
    good = (i % 3 == 1) | ((i % 3 == 0) & (F.col("nth") == 2))
    sites = hits.select(*_fetch(F.format_string("https://firma%d.at/start", n), F.when(good, F.lit("in 1070 Wien")).otherwise(F.lit("somewhere else"))))
    return joins.by_directory_search(made, links, directories.unionByName(sites))


@query(f"""SELECT CAST(i AS VARCHAR) AS place_id, 'https://s' || i || '.at/' || CASE WHEN i % 4 = 0 THEN 'rechtliches' ELSE 'impressum' END AS url, CASE WHEN i % 4 <> 2 THEN 'ATU1' || lpad(CAST(i AS VARCHAR), 7, '0') END AS uid,
CASE WHEN i % 5 = 0 THEN 'Gruber' || i || ' GmbH' ELSE 'Haus ' || i || ' e.U.' END AS company_name, i % 4 <> 2 AS complete FROM ({_ROWS}) WHERE i % 4 <> 3""")
def imprint_pages(spark, sf_dir):
    """Linked pages come before the usual paths; a page that doesn't answer is passed over."""
    made, i = _customers(spark, sf_dir), F.col("i")
    site = F.format_string("https://s%d.at/", i)
    home = F.when(i % 4 == 0, F.lit('<a href="/rechtliches">Impressum</a>')).when(i % 4 == 1, F.lit('<a href="/imprint-gone">x</a>')).otherwise(F.lit("<p>no link</p>"))
    sites = made.select(i.cast("string").alias("place_id"), site.alias("discovered_url"), site.alias("final_url"), html.page_facts(home).alias("facts"))
    name = F.when(i % 5 == 0, F.format_string("Firmenname: Gruber%d GmbH", i)).otherwise(F.format_string("Medieninhaber: Haus %d e.U.", i))
    uid = F.when(i % 4 != 2, F.format_string("UID: ATU 1%07d", i)).otherwise(F.lit("ohne"))
    body = F.concat(F.lit("<html><body><p>"), name, F.lit("\n</p><p>Mariahilfer Straße 12, 1060 Wien\n</p><p>"), uid, F.lit("\n</p></body></html>"))
    fetches = made.where("i % 4 <> 3").select(*_fetch(F.concat(site, F.lit("impressum")), body)).unionByName(made.where("i % 4 = 0").select(*_fetch(F.concat(site, F.lit("rechtliches")), body)))
    fetches = fetches.unionByName(made.where("i % 4 = 1").select(*_fetch(F.concat(site, F.lit("imprint-gone")), body, status=F.lit(404))))
    found = joins.imprints(sites, fetches).select("place_id", "impressum.*")
    return found.select("place_id", "url", "uid", "company_name", "complete")


@query(f"""SELECT 'g' || i AS place_id, 'Ort ' || i AS name, CASE i % 4 WHEN 0 THEN '10' || (1 + i % 9) || '0' WHEN 1 THEN '1190' ELSE NULL END AS plz, CASE i % 4 WHEN 0 THEN '0' || (1 + i % 9) WHEN 1 THEN '19' ELSE NULL END AS district,
CASE WHEN i % 2 = 0 THEN '+43 1 ' || i ELSE '01 ' || i END AS phone FROM ({_ROWS}) WHERE i % 7 NOT IN (5, 6)""")
def place_search(spark, sf_dir):
    """Raw places as candidates, each once though it stands on two result pages: no id, name or location leaves one out."""
    i = F.col("i")
    component = F.struct(F.lit("x").alias("longText"), F.lit("x").alias("shortText"), F.array(F.lit("route")).alias("types"))
    code = F.struct(F.format_string("10%d0", 1 + i % 9).alias("longText"), F.lit("").alias("shortText"), F.array(F.lit("postal_code")).alias("types"))
    raw = _customers(spark, sf_dir).withColumn("page", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.format_string("g%d", i).alias("id"), F.struct(F.when(i % 7 != 5, F.format_string("Ort %d", i)).otherwise("").alias("text")).alias("displayName"),
        F.when(i % 4 == 1, F.lit("Weg 2, 1190 Wien")).otherwise(F.lit("Wien")).alias("formattedAddress"), F.when(i % 4 == 0, F.array(component, code)).otherwise(F.array(component)).alias("addressComponents"),
        F.when(i % 7 != 6, F.struct(F.lit(48.2).alias("latitude"), F.lit(16.3).alias("longitude"))).alias("location"), F.array(F.lit("cafe")).alias("types"), F.lit("cafe").alias("primaryType"), F.lit(None).cast("string").alias("websiteUri"),
        F.format_string("01 %d", i).alias("nationalPhoneNumber"), F.when(i % 2 == 0, F.format_string("+43 1 %d", i)).alias("internationalPhoneNumber"), F.lit("OPERATIONAL").alias("businessStatus"),
    )
    return dedupe.first_seen(places.raw_places(raw), "place_id", ["place_id"]).select("place_id", "name", "plz", "district", "phone")


_EMAILS = (
    ("anna.b@firma.at", 0), ("Büro12@firma.at", 1), ("office@firma.at", 1), ("officer@firma.at", 0), ("info7@firma.at", 1), ("info.wien@firma.at", 0), ("kanzlei@x.at", 1), ("praxis3@x.at", 1), ("mailer@x.at", 0), (None, None),
)


@query(f"""SELECT count(*) FILTER (g = 0) AS personal, count(*) FILTER (g = 1) AS generic, count(*) FILTER (g IS NULL) AS none, count(*) FILTER (g IS NOT NULL) AS with_email
FROM (SELECT ({[g for _, g in _EMAILS[:-1]]} || [NULL])[CAST(page_id % {len(_EMAILS)} AS INTEGER) + 1] AS g FROM pages)""")
def email_generic_counts(spark, sf_dir):
    from ..operators import aggregates

    email = _nth(F.col("page_id"), [e for e, _ in _EMAILS])
    return aggregates.email_counts(table(spark, sf_dir, "pages").select(email.alias("email"), contact.generic_class(email).alias("email_is_generic")))


_TITLES = (
    (None, None), ("https://www.facebook.com/x", "Facebook"), ("https://shop.herold.at/y", "Shop"), ("http://herold.at", "Herold"), ("http://notherold.at", "Notherold"), ("https://maps.google.com/a", "Maps"),
    ("https://gruber-und-SOHN.at/", "Gruber-Und-Sohn"), ("no url", ""),
)


@query(f"""SELECT i, coalesce((['', 'Facebook', 'Shop', 'Herold', 'Notherold', 'Maps', 'Gruber-Und-Sohn', ''])[CAST(i % {len(_TITLES)} AS INTEGER) + 1], '') AS title, i % {len(_TITLES)} NOT IN (4, 6) AS is_platform FROM ({_ROWS})""")
def platform_hosts(spark, sf_dir):
    u = _nth(F.col("i"), [u for u, _ in _TITLES])
    return _customers(spark, sf_dir).select("i", url.host_title(u).alias("title"), url.is_platform(u).alias("is_platform"))


@query("""SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND event_id % 23 = 0 AND ts + INTERVAL 30 DAY > TIMESTAMP '2024-02-05 00:00:00' AND ts + INTERVAL 14 DAY > TIMESTAMP '2024-02-05 00:00:00')""")
def ttl_freshness_anti(spark, sf_dir):
    from datetime import datetime

    from ..config import Settings
    from ..operators import filters

    events, at = table(spark, sf_dir, "events"), Settings(as_of=datetime(2024, 2, 5))
    audits = events.where("event_type = 'purchase' AND event_id % 23 = 0").select(
        F.col("user_id").alias("place_id"), (F.col("ts") + F.make_dt_interval(F.lit(at.static_ttl_days))).alias("static_signals_expires_at"), (F.col("ts") + F.make_dt_interval(F.lit(at.psi_ttl_days))).alias("psi_signals_expires_at")
    )
    return filters.stale(events.select(F.col("user_id").alias("place_id")).distinct(), audits, at).select(F.col("place_id").alias("user_id"))


_NAMES = (
    ("Gruber GmbH Telefon: 1", "Gruber GmbH"), ("Gruber AG - ,", "Gruber AG"), ("Gruber\nFax", "Gruber"), ("Gruber", "Gruber"), ("  Haus Tel. 01 ", None), ("ab", None), ("Gruber KG;|:", "Gruber KG"),
    ("x" * 100, "x" * 80), ("Gruber\r\nmore", "Gruber"), (None, None),
)


@query("SELECT i, name FROM (" + _ROWS + f") JOIN (VALUES {', '.join(f'''({n}, {'NULL' if b is None else repr(b)})''' for n, (_, b) in enumerate(_NAMES) if n != 4)}) v(n, name) ON n = i % {len(_NAMES)}")
def company_names(spark, sf_dir):
    made = _customers(spark, sf_dir).where(F.col("i") % len(_NAMES) != 4)
    return made.select("i", text.company_name(_nth(F.col("i"), [a for a, _ in _NAMES])).alias("name"))
