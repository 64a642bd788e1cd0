"""Detectors over HTML and response headers. Ids X44, X46-X49, X51, X56, X57 and J10, J11 of the survey.

All are generated expressions over one row. Scans look at the first 256 Ki characters. `headers` is a map with any spelling of its keys.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import js, url

SCAN_CHARS = 256 * 1024
#: A technology counts with at least so many distinct signals.
MIN_SIGNALS = 2
MIN_YEAR = 1995
SMALL_BODY_CHARS = 1024

_GENERATOR = r"""<meta\s+name=["']generator["']\s+content=["']"""
#: Fingerprints in order: name, bucket, patterns in HTML, patterns of headers, patterns of cookie names. `(?-i)` marks those that mind case.
FINGERPRINTS = (
    ("wordpress", "cms", ("wp-content/", "wp-includes/", _GENERATOR + "WordPress"), {}, ("wordpress_logged_in", "wp-settings")),
    ("joomla", "cms", (_GENERATOR + "Joomla", "/media/jui/", "/components/com_"), {}, ("joomla_user_state",)),
    ("drupal", "cms", (_GENERATOR + "Drupal", "/sites/all/(?:modules|themes)/", "/sites/default/files/"), {"x-generator": "Drupal"}, ()),
    ("typo3", "cms", (_GENERATOR + "TYPO3", "typo3conf/", "typo3temp/"), {}, ()),
    ("contao", "cms", (_GENERATOR + "Contao", "/bundles/contao", "/files/tx_contao"), {}, ()),
    ("wix", "cms", (r"""<meta[^>]+content=["'][^"']*Wix\.com""", r"static\.wixstatic\.com", "X-Wix-Request-Id"), {"x-wix-request-id": ".+", "server": "wix"}, ()),
    ("squarespace", "cms", (r"static1\.squarespace\.com", """<meta[^>]+content=["']Squarespace"""), {"x-contextid": ".+"}, ("crumb",)),
    ("jimdo", "cms", ("""<meta[^>]+content=["']Jimdo""", r"assets\.jimstatic\.com", r"jimdofree\.com"), {}, ()),
    ("shopify", "cms", (r"cdn\.shopify\.com", r"Shopify\.theme", """<meta[^>]+content=["']Shopify"""), {"x-shopify-stage": ".+", "x-shardid": ".+"}, ("_shopify_",)),
    ("webflow", "cms", ("""<meta[^>]+content=["']Webflow""", r"assets\.website-files\.com", "data-wf-site=", "data-wf-page="), {}, ()),
    ("hubspot", "cms", ("""<meta[^>]+content=["']HubSpot""", r"js\.hs-scripts\.com", r"js\.hs-analytics\.net"), {}, ("hubspotutk",)),
    ("prestashop", "cms", (_GENERATOR + "PrestaShop", "/modules/prestashop", r"prestashop\s*=\s*\{"), {}, ("PrestaShop-[a-f0-9]",)),
    ("magento", "cms", (r"Mage\.Cookies", "/skin/frontend/", "/mage/"), {}, ("frontend_cid", "X-Magento-Vary")),
    ("elementor", "pageBuilder", ("elementor-(?:frontend|pro)", "/wp-content/plugins/elementor", """class=["'][^"']*elementor-""", _GENERATOR + "Elementor"), {}, ()),
    ("divi", "pageBuilder", ("/wp-content/themes/Divi", "et_pb_section", "et_pb_row", "divi-module"), {}, ()),
    ("oxygen", "pageBuilder", ("/wp-content/plugins/oxygen", r"oxy-[a-z]+-\d+", "ct_builder"), {}, ()),
    ("beaver-builder", "pageBuilder", ("/wp-content/plugins/bb-plugin", "fl-builder-content", "fl-node-"), {}, ()),
    ("visual-composer", "pageBuilder", ("/js_composer/", "vc_row", "vc_column"), {}, ()),
    ("gutenberg", "pageBuilder", ("wp-block-library", """class=["'][^"']*wp-block-""", "has-text-align-"), {}, ()),
    (
        "google-analytics", "analytics",
        (r"googletagmanager\.com/gtag/js", r"google-analytics\.com/analytics\.js", r"""ga\(['"]create['"]""", r"""gtag\(['"]config['"],\s*['"]G-[A-Z0-9]+""", r"""gtag\(['"]config['"],\s*['"]UA-\d+"""),
        {}, ("^_ga", "_gid"),
    ),
    ("matomo", "analytics", (r"matomo\.js", r"piwik\.js", r"var\s+_paq\s*="), {}, ("_pk_id", "_pk_ses")),
    ("plausible", "analytics", (r"plausible\.io/js/", r"""data-domain=["'][^"']+["']\s+src=["'][^"']*plausible""", r"plausible\.io/api/event"), {}, ()),
    ("fathom", "analytics", (r"cdn\.usefathom\.com", """(?-i)data-site=["'][A-Z]{8}["']""", r"usefathom\.com/script\.js"), {}, ()),
    ("cloudflare-web-analytics", "analytics", (r"static\.cloudflareinsights\.com/beacon\.min\.js", "__cfBeacon", r"cloudflareinsights\.com"), {}, ()),
    ("facebook-pixel", "tracking", (r"connect\.facebook\.net/[a-z_]+/fbevents\.js", r"""fbq\(['"]init['"]""", r"www\.facebook\.com/tr\?id="), {}, ("^_fbp",)),
    ("google-tag-manager", "tracking", (r"googletagmanager\.com/gtm\.js", "(?-i)GTM-[A-Z0-9]+", r"dataLayer\s*=\s*dataLayer"), {}, ()),
    ("google-ads", "tracking", (r"googleadservices\.com/pagead", r"""gtag\(['"]config['"],\s*['"]AW-\d+""", r"googleads\.g\.doubleclick\.net"), {}, ("^_gcl_",)),
    ("linkedin-insight", "tracking", (r"snap\.licdn\.com/li\.lms-analytics", "_linkedin_partner_id", r"px\.ads\.linkedin\.com"), {}, ()),
    ("tiktok-pixel", "tracking", (r"analytics\.tiktok\.com/i18n/pixel", r"""(?-i)ttq\.load\(['"][A-Z0-9]+""", r"tiktok\.com/pixel"), {}, ()),
    ("hotjar", "tracking", (r"static\.hotjar\.com/c/hotjar-", r"hjid:\s*\d+", "_hjSettings"), {}, ("_hjSession", "_hjid")),
    ("mouseflow", "tracking", (r"cdn\.mouseflow\.com", "mouseflow.*?apikey", r"_mfq\s*="), {}, ()),
    ("stripe", "payment", (r"js\.stripe\.com/v\d", r"""Stripe\(['"]pk_(?:live|test)_""", r"checkout\.stripe\.com"), {}, ("__stripe_mid", "__stripe_sid")),
    ("paypal", "payment", (r"www\.paypal\.com/sdk/js", r"paypal\.Buttons\(", r"paypalobjects\.com", "paypal-button"), {}, ()),
    ("klarna", "payment", (r"x\.klarnacdn\.net", r"js\.klarna\.com", "klarna-placement"), {}, ()),
    ("mollie", "payment", (r"js\.mollie\.com", r"mollie\.createToken", "mollie-component"), {}, ()),
    ("adyen", "payment", (r"checkoutshopper-live\.adyen\.com", r"AdyenCheckout\(", r"adyen\.com/hpp"), {}, ()),
    ("shopify-pay", "payment", (r"shop\.app/pay", r"shopify\.com/checkouts", "shopify-payment-button"), {}, ()),
    ("cloudflare", "cdn", (), {"server": "cloudflare", "cf-ray": ".+", "cf-cache-status": ".+"}, ("__cfduid", "__cf_bm")),
    ("fastly", "cdn", (), {"x-served-by": "cache-", "x-fastly-request-id": ".+", "fastly-debug-digest": ".+", "x-cache": "HIT|MISS"}, ()),
    ("akamai", "cdn", (), {"x-akamai-transformed": ".+", "akamai-grn": ".+", "server": "AkamaiGHost"}, ()),
    ("aws-cloudfront", "cdn", (), {"x-amz-cf-id": ".+", "via": "CloudFront", "x-cache": "cloudfront"}, ()),
    ("netlify", "cdn", (), {"server": "Netlify", "x-nf-request-id": ".+", "x-served-by-netlify": ".+"}, ()),
    ("vercel", "cdn", (), {"server": "Vercel", "x-vercel-id": ".+", "x-vercel-cache": ".+"}, ()),
    ("github-pages", "cdn", (_GENERATOR + "Jekyll",), {"server": r"GitHub\.com", "x-github-request-id": ".+"}, ()),
)
BUCKETS = ("cms", "pageBuilder", "analytics", "tracking", "payment", "cdn")
#: Content systems that have a name of their own in results.
CMS_SLUGS = (
    "wordpress", "drupal", "joomla", "typo3", "wix", "squarespace", "shopify", "webflow", "nextjs", "nuxt", "gatsby", "ghost", "jimdo", "weebly", "contao", "hubspot", "kirby", "craft",
)
#: First words of a generator and what they mean, beside the slugs themselves.
GENERATOR_WORDS = {"joomla!": "joomla", "wix.com": "wix", "next.js": "nextjs", "nuxt.js": "nuxt", "gatsbyjs": "gatsby", "craftcms": "craft"}
#: Marks in asset paths, in order.
ASSET_MARKS = (
    ("wordpress", ("/wp-content/",)), ("drupal", ("/sites/default/",)), ("typo3", ("/typo3conf/",)), ("nextjs", ("/_next/",)), ("nuxt", ("/_nuxt/",)),
    ("joomla", ("/joomla", "/media/jui/")), ("shopify", ("cdn.shopify.com", "shopify.com/s/files")), ("squarespace", ("squarespace-cdn", "static1.squarespace.com")),
    ("wix", ("wixstatic.com",)), ("webflow", ("webflow.com", "assets.website-files.com")), ("jimdo", ("jimdo.com", "jimdofree.com")), ("weebly", ("weebly.com",)),
)
#: Platforms in order: hosts, and starts of paths that are no profile.
SOCIAL = (
    ("facebook", r"^(?:www\.|de-de\.|m\.)?facebook\.com$", "sharer|share|plugins|dialog|tr|events/shared"),
    ("instagram", r"^(?:www\.)?instagram\.com$", "share|explore|p|reel"),
    ("linkedin", r"^(?:www\.|de\.)?linkedin\.com$", "shareArticle|sharing|feed|pulse"),
    ("xing", r"^(?:www\.)?xing\.com$", "app/share|spi"),
    ("twitter", r"^(?:www\.)?(?:twitter|x)\.com$", "intent|share|home"),
    ("youtube", r"^(?:www\.|m\.)?youtube\.com$", "embed|watch|results"),
    ("tiktok", r"^(?:www\.)?tiktok\.com$", "embed|tag|discover"),
)
#: Directories in order, by host.
DIRECTORIES = (
    ("herold", r"^(www\.)?herold\.at$"), ("firmenabc", r"^(www\.)?firmenabc\.at$"), ("wko", r"^firmen\.wko\.at$"), ("facebook", r"^(www\.)?facebook\.com$"),
    ("instagram", r"^(www\.)?instagram\.com$"), ("falstaff", r"^(www\.)?falstaff\.at$"), ("gaultmillau", r"^(www\.)?gaultmillau\.at$"),
)
PARKING_TITLE = r"(?i)\A\s*(for sale|to buy|coming soon|this domain|parked|default web page)"
PARKING_BODY = r"(?i)this domain is (?:for sale|parked)|buy this domain|godaddy|sedoparking|afternic|dan\.com|uniregistry|bodis"
#: One of these is in every text that PARKING_BODY fits.
PARKING_PARTS = ("this domain", "godaddy", "sedoparking", "afternic", "dan.com", "uniregistry", "bodis")
PARKING_SERVER = "(?i)sedo|parkingcrew|bodis|afternic"
WHOIS_FREE = ("no match", "not found", "no entries found", "no data found", "status: free", "status: available", "% nothing found", "domain not found", "is available for registration")
WHOIS_TAKEN = ("registrar:", "creation date", "created:", "changed:", "registered:", "domain:", "registrant", "updated date")
WHOIS_SERVERS = {
    "at": "whois.nic.at", "com": "whois.verisign-grs.com", "net": "whois.verisign-grs.com", "org": "whois.publicinterestregistry.org", "de": "whois.denic.de", "eu": "whois.eu", "io": "whois.nic.io",
}
ERROR_OF_CODE = {
    "ENOTFOUND": "DNS_FAIL", "ECONNREFUSED": "CONNECTION_REFUSED", "CERT_HAS_EXPIRED": "CERT_EXPIRED", "UNABLE_TO_VERIFY_LEAF_SIGNATURE": "CERT_INVALID", "SELF_SIGNED_CERT_IN_CHAIN": "CERT_INVALID",
    "DEPTH_ZERO_SELF_SIGNED_CERT": "CERT_INVALID", "ERR_SSL_PROTOCOL_ERROR": "SSL_HANDSHAKE",
}


def scanned(body: Column) -> Column:
    return F.left(body, F.lit(SCAN_CHARS))


def lower_headers(headers: Column) -> Column:
    """The headers with lower-case names; of names that differ in case only, the last wins."""

    def of(entries: Column) -> Column:
        last = lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"]
        return js.let(F.array_distinct(F.transform(entries, lambda e: e["key"])), lambda names: F.map_from_arrays(names, F.transform(names, last)))

    return js.let(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))), of)


def header(lowered: Column, name: str) -> Column:
    return F.try_element_at(lowered, F.lit(name))


def cookie_names(lowered: Column) -> Column:
    """Names of the cookies that a response sets."""
    parts = F.split(header(lowered, "set-cookie"), r",(?=\s*[A-Za-z0-9_-]+=)", -1)
    named = F.transform(F.filter(parts, lambda p: F.instr(p, "=") > 1), lambda p: js.trim(F.substring_index(p, "=", 1)))
    return F.coalesce(F.filter(named, lambda n: n != ""), F.array().cast("array<string>"))


def fixed_part(pattern: str) -> str:
    """The longest run of plain characters, in lower case, that every match of a fingerprint's pattern holds; empty if there is none."""
    bare = re.sub(r"\\[wdsS][+*?]?|\[[^\]]*\][+*?]?(?:\{\d+\})?|\((?!\?-i)[^()]*\)|\.[+*]\??", "\0", pattern.removeprefix("(?-i)").replace(r"\(", "\1"))
    bare = re.sub(r"[^\\][*?]", "\0", bare)
    return max(re.split("[\0^$|]", re.sub(r"\\(.)", r"\1", bare).replace("\1", "(")), key=len).lower()


def _seen(html: Column, low: Column, pattern: str) -> Column:
    """Whether a pattern is in the page. Its plain part is looked for first, in the lower-case page: most pages lack it, and a search that minds no case is slow."""
    search = html.rlike(pattern.removeprefix("(?-i)") if pattern.startswith("(?-i)") else "(?i)" + pattern)
    return low.contains(fixed_part(pattern)) & search


def tech_stack(body: Column, headers: Column) -> Column:
    """Struct of six arrays with the technologies found, in the fingerprints' order."""

    def of(page: Column) -> Column:
        html, low, lowered, cookies = page["html"], page["low"], page["lowered"], page["cookies"]
        found: dict[str, list[Column]] = {b: [] for b in BUCKETS}
        for name, bucket, patterns, of_headers, of_cookies in FINGERPRINTS:
            signals = [_seen(html, low, p) for p in patterns]
            signals += [F.coalesce(header(lowered, h).rlike("(?i)" + p), F.lit(False)) for h, p in of_headers.items()]
            signals += [_any_matches(cookies, "(?i)" + p) for p in of_cookies]
            hits = F.lit(0)
            for s in signals:
                hits = hits + s.cast("int")
            found[bucket].append(F.when(hits >= MIN_SIGNALS, F.lit(name)))
        return F.struct(*[F.array_compact(F.array(*found[b])).alias(b) for b in BUCKETS])

    names = F.struct(F.coalesce(scanned(body), F.lit("")).alias("html"), lower_headers(headers).alias("lowered"))
    return js.let(names, lambda x: js.let(F.struct(x["html"].alias("html"), F.lower(x["html"]).alias("low"), x["lowered"].alias("lowered"), cookie_names(x["lowered"]).alias("cookies")), of))


def _any_matches(values: Column, pattern: str) -> Column:
    return F.exists(values, lambda v: v.rlike(pattern))


def _slug_of_word(word: Column) -> Column:
    def of(word: Column) -> Column:
        out = F.when(word.isin(*CMS_SLUGS), word)
        for w, slug in GENERATOR_WORDS.items():
            out = out.when(word == w, F.lit(slug))
        return out

    return js.let(word, of)


def _first_word(c: Column) -> Column:
    return F.lower(F.regexp_extract(js.trim(c), r"\A(\S+)", 1))


def generator(body: Column) -> Column:
    """Content of the page's generator tag; empty if there is none."""
    a = r"""(?i)<meta\s+[^>]*name\s*=\s*["']generator["'][^>]*content\s*=\s*["']([^"']*)["']"""
    b = r"""(?i)<meta\s+[^>]*content\s*=\s*["']([^"']*)["'][^>]*name\s*=\s*["']generator["']"""
    html = scanned(body)
    return F.when(html.rlike(a), F.regexp_extract(html, a, 1)).otherwise(F.regexp_extract(html, b, 1))


def cms(body: Column, headers: Column, known: Column) -> Column:
    """The content system: of the fingerprints, else the generator tag, else headers, else asset paths; `static_or_custom` for other pages, `unknown` without one."""
    of_prints = F.get(F.filter(F.transform(known, F.lower), lambda k: k.isin(*CMS_SLUGS)), F.lit(0))
    lowered = lower_headers(headers)
    set_ = lambda name: F.coalesce(header(lowered, name), F.lit("")) != ""
    powered = _first_word(F.coalesce(header(lowered, "x-powered-by"), header(lowered, "x-generator")))
    of_headers = F.when(set_("x-drupal-cache"), F.lit("drupal")).when(set_("x-typo3-parsedbody"), F.lit("typo3")).when(set_("x-shopify-stage"), F.lit("shopify")).otherwise(_slug_of_word(powered))
    html = scanned(body)
    of_assets = F.lit(None).cast("string")
    for slug, marks in reversed(ASSET_MARKS):
        of_assets = F.when(js.contains_any(html, marks), F.lit(slug)).otherwise(of_assets)
    rest = F.when(F.length(body) > 0, F.lit("static_or_custom")).otherwise(F.lit("unknown"))
    return F.coalesce(of_prints, _slug_of_word(_first_word(generator(body))), of_headers, of_assets, rest)


def _years(texts: Column) -> Column:
    """UTC years of dates in the forms that pages use; null for others."""

    def year(t: Column) -> Column:
        return js.let(F.regexp_replace(js.trim(t), r"(?i)\A[a-z]{3,9},?\s+", ""), of)

    def of(bare: Column) -> Column:
        iso = F.try_to_timestamp(F.regexp_extract(bare, r"\A(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?)\z", 1))
        rfc = F.try_to_timestamp(F.regexp_replace(bare, r"\s+(GMT|UTC|Z)\z", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z"))
        only = F.when(bare.rlike(r"\A\d{4}(-\d{2})?\z"), F.left(bare, F.lit(4)).cast("int"))
        return F.coalesce(F.year(iso), F.year(rfc), only)

    return F.transform(texts, year)


def _newest(years: Column, last: int) -> Column:
    return F.array_max(F.filter(years, lambda y: y.between(MIN_YEAR, last)))


def last_modified_year(body: Column, headers: Column, this_year: int) -> Column:
    """The year of a page's last change: newest copyright year, else the Last-Modified header's, else the newest time tag's; 1995 to next year."""
    html, last = F.coalesce(scanned(body), F.lit("")), this_year + 1
    mark = r"(?i)(?:©|&copy;)\s*(?:copyright|c)?\s*\(?c?\)?\s*((?:19|20)\d{2})(?:\s*[-–]\s*((?:19|20)\d{2}))?"
    ends = F.arrays_zip(F.regexp_extract_all(html, F.lit(mark), F.lit(1)).alias("a"), F.regexp_extract_all(html, F.lit(mark), F.lit(2)).alias("b"))
    copyright_ = F.transform(ends, lambda e: F.when(F.coalesce(e["b"], F.lit("")) != "", e["b"]).otherwise(e["a"]).cast("int"))
    of_header = _years(F.array(header(lower_headers(headers), "last-modified")))
    patterns = (
        r"""(?i)<time\s+[^>]*datetime\s*=\s*["']([^"']+)["']""",
        r"""(?i)<meta\s+[^>]*property\s*=\s*["']article:modified_time["'][^>]*content\s*=\s*["']([^"']+)["']""",
        r"""(?i)<meta\s+[^>]*content\s*=\s*["']([^"']+)["'][^>]*property\s*=\s*["']article:modified_time["']""",
    )
    tags = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in patterns])
    return F.coalesce(_newest(copyright_, last), _newest(of_header, last), _newest(_years(tags), last))


def social_platform(href: Column) -> Column:
    """The platform whose profile a link leads to; null for shares, front pages and other links."""

    def of(at: Column) -> Column:
        host, path, out = at["host"], at["path"], F.lit(None).cast("string")
        for name, hosts, reject in reversed(SOCIAL):
            out = F.when(host.rlike("(?i)" + hosts) & ~path.rlike(f"(?i)^/(?:{reject})") & (path != "/") & (path != ""), F.lit(name)).otherwise(out)
        return out

    link = js.trim(href)
    parts = F.struct(url.hostname(link).alias("host"), url.pathname(link).alias("path"))
    return F.when(url.scheme(link).isin("http", "https"), js.let(parts, of))


def social_links(hrefs: Column) -> Column:
    """Map from platform to the first link of it."""

    def of(found: Column) -> Column:
        first = lambda n: F.get(F.filter(found, lambda x: x["platform"] == n), F.lit(0))["href"]
        return js.let(F.array_distinct(F.transform(found, lambda x: x["platform"])), lambda names: F.map_from_arrays(names, F.transform(names, first)))

    return js.let(F.filter(F.transform(hrefs, lambda h: F.struct(social_platform(h).alias("platform"), js.trim(h).alias("href"))), lambda x: x["platform"].isNotNull()), of)


def directory(page: Column) -> Column:
    """The directory that a URL belongs to, by host; the first that fits."""

    def of(host: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, hosts in reversed(DIRECTORIES):
            out = F.when(host.rlike(hosts), F.lit(name)).otherwise(out)
        return out

    return js.let(url.hostname(page), of)


def title(body: Column) -> Column:
    return js.trim(F.regexp_extract(body, r"(?is)<title[^>]*>(.*?)</title>", 1))


def parking(body: Column, headers: Column) -> Column:
    """Struct of verdict (`parked` from two signals on, `inconclusive` for one, `not-parked`) and the signals joined by `+` if parked."""
    html = F.coalesce(body, F.lit(""))
    signals = F.array_compact(
        F.array(
            F.when(F.length(html) < SMALL_BODY_CHARS, F.lit("small-body")),
            F.when(title(html).rlike(PARKING_TITLE) | (js.contains_any(F.lower(html), PARKING_PARTS) & html.rlike(PARKING_BODY)), F.lit("parking-text")),
            F.when(F.coalesce(header(lower_headers(headers), "server"), F.lit("")).rlike(PARKING_SERVER), F.lit("server-header")),
        )
    )


    def of(found: Column) -> Column:
        n = F.size(found)
        verdict = F.when(n >= 2, F.lit("parked")).when(n == 1, F.lit("inconclusive")).otherwise(F.lit("not-parked"))
        return F.struct(verdict.alias("verdict"), F.when(n >= 2, F.array_join(found, "+")).alias("fingerprint"))

    return js.let(signals, of)


def viewport(body: Column) -> Column:
    """Struct of present and content (trimmed, null if empty) of the first viewport tag."""
    tag = F.regexp_extract(body, r"""(?is)<meta\s[^>]*name\s*=\s*["']?viewport["']?[\s/>][^>]*>|<meta\s[^>]*name\s*=\s*["']?viewport["']?\s*/?>""", 0)
    content = js.null_if_empty(js.trim(F.regexp_extract(tag, r"""(?is)content\s*=\s*["']([^"']*)["']""", 1)))
    return F.struct(F.coalesce(tag != "", F.lit(False)).alias("present"), content.alias("content"))


def whois_registered(raw: Column) -> Column:
    """Whether a registry's answer says that a domain is taken; null if it says neither."""
    low = F.lower(raw)
    return F.when(js.contains_any(low, WHOIS_FREE), F.lit(False)).when(js.contains_any(low, WHOIS_TAKEN), F.lit(True))


def whois_server(domain: Column) -> Column:
    """The registry's server by the last label."""
    tld, out = F.lower(F.substring_index(domain, ".", -1)), F.lit("whois.iana.org")
    for t, server in WHOIS_SERVERS.items():
        out = F.when(tld == t, F.lit(server)).otherwise(out)
    return out


def fetch_error(name: Column, code: Column) -> Column:
    """A fetch's error class from the failure's name and code."""
    out = F.when(name.isin("AbortError", "TimeoutError"), F.lit("TIMEOUT"))
    for c, error in ERROR_OF_CODE.items():
        out = out.when(code == c, F.lit(error))
    return out.when(code.startswith("ERR_TLS"), F.lit("SSL_HANDSHAKE")).otherwise(F.lit("UNKNOWN"))


def forbidden_error(message: Column) -> Column:
    """What a 403 of the speed service means."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.when(low.contains("api key"), F.lit("AUTH_ERROR")).when(low.contains("quota"), F.lit("QUOTA_EXCEEDED")).otherwise(F.lit("CLIENT_ERROR"))
