"""Scalar functions on tables of inputs and expected results."""

import pytest
from pyspark.sql import functions as F

from pagelens.config import Settings, plz_mode
from pagelens.functions import contact, detect, html, score, text, url


def rows(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


CASES = {
    "dedupe_key": (url.dedupe_key, [
        ("https://www.Shop.at/", "https://shop.at"), ("https://shop.at/a/#top", "https://shop.at/a"), ("https://shop.at/?b=2&a=1&utm_source=x", "https://shop.at?b=2&a=1"), ("https://shop.at/?GCLID=1", "https://shop.at"),
        ("http://u:p@shop.at:80/x/../y", "http://shop.at/y"), ("https://shop.at:8443/", "https://shop.at:8443"), ("https://shop.at/a b?q=1 2", "https://shop.at/a%20b?q=1+2"), ("", None), ("no url", None), (None, None), ("http:///x", None),
    ]),
    "apex": (url.apex, [("https://a.b.shop.at/x", "shop.at"), ("https://a.b.co.at/", "b.co.at"), ("https://co.at/", None), ("http://10.0.0.1/", None), ("http://localhost/", None), ("garbage", None), (None, None)]),
    "host_title": (url.host_title, [("https://www.gasthaus-ADLER.at/x", "Gasthaus-Adler"), ("", ""), (None, ""), ("x", "")]),
    "is_platform": (url.is_platform, [("https://www.facebook.com/x", True), ("https://sub.herold.at/", True), ("https://myfacebook.com/", False), ("bad", True)]),
    "unshimmed": (url.unshimmed, [("https://l.instagram.com/?u=https%3A%2F%2Fx.at&e=1", "https://x.at"), ("https://x.at/?u=1", None)]),
    "directory_link": (url.directory_link, [(" https://x.at/a/?fbclid=1&q=2 ", "https://x.at/a/?q=2"), ("ftp://x.at/", None), ("https://x.at/?UTM_SOURCE=1", "https://x.at/?UTM_SOURCE=1"), ("", None)]),
    "slug": (text.slug, [("Café Müller & Söhne", "cafe-mueller-and-soehne"), ("  ", ""), ("Straße 7", "strasse-7")]),
    "name_key": (text.name_key, [("Huber & Co GmbH", "huberco"), ("Alt KG Neu", "altneu")]),
    "company_name": (text.company_name, [
        ("Muster AG\r\nZeile", "Muster AG"), ("Muster GmbH - ,;|", "Muster GmbH"), ("Firma e.U.", "Firma e.U."), ("X Telefon: 1", None), ("Telefonladen Huber", "Telefonladen Huber"), ("Huber UID: ATU1", "Huber"), ("ab", None), (None, None), ("n" * 90, "n" * 80),
    ]),
    "company_name_in": (text.company_name_in, [("Impressum\nFirmenname: Huber Bau\nTel", "Huber Bau"), ("willkommen bei Muster Handels GmbH in Wien", "Muster Handels GmbH"), ("nichts", None)]),
    "is_branch_name": (text.is_branch_name, [("Bäckerei FILIALE 3", True), ("Bäckerei", False)]),
    "csv_cell": (lambda c: text.csv_cell(c, ";"), [("a;b", '"a;b"'), ('a"b', '"a""b"'), ("a,b", "a,b"), ("a\nb", '"a\nb"')]),
    "truncated": (lambda c: text.truncated(c, 4), [("abcd", "abcd"), ("abcde", "abc…")]),
    "plz_of_address": (contact.plz_of_address, [("Gasse 1, 1030 Wien", "1030"), ("1990 X", "1990"), ("11030", None), (None, None)]),
    "plz_in_text": (contact.plz_in_text, [("Shop 1010", "1010"), ("1300", None), ("x1010y", None)]),
    "is_vienna_plz": (contact.is_vienna_plz, [("1010", True), ("1230", True), ("1240", False), ("1121", False), (None, False)]),
    "district": (contact.district, [("1010", "01"), ("1230", "23"), ("1121", None), ("1015", None), ("2000", None), (None, None)]),
    "uid": (contact.uid, [("UID: AT U 1234 5678", "ATU12345678"), ("atu1234567", None), ("ATU 1 x ATU87654321", "ATU87654321")]),
    "phone": (contact.phone, [("Tel: +43 1 / 234 56 78 x", "+43 1 / 234 56 78"), ("0800", None), ("Tel 01 2345678", "01 2345678")]),
    "phone_e164": (contact.phone_e164, [("0043 1 234 56 78", "+4312345678"), ("+43 (0)664 1234567", "+436641234567"), ("01 2345678", "+4312345678"), ("+49 30 1234567", None), ("123", None)]),
    "address": (contact.address, [("Huber\nHauptstraße 14a, 1010 Wien", "Huber Hauptstraße 14a, 1010 Wien"), ("keine", None)]),
    "deobfuscated": (contact.deobfuscated, [("max [at] haus", "max@haus"), ("a (ät) b", "a@b"), ("a[æt]b", "a@b"), ("a&#64;b&#x2E;c", "a@b.c"), ("a [at] b [dot] c", "a@b.c"), ("we meet at noon", "we meet at noon")]),
    "is_noise": (contact.is_noise, [("a@example.com", True), ("a@x.example.org", True), ("noreply@x.at", True), ("info@x.at", False), ("admin@wordpress.org", True), ("admin@x.at", False), ("@x", True), ("x@", True)]),
    "is_role": (contact.is_role, [("info.wien@x.at", True), ("info42@x.at", True), ("information@x.at", False), ("anna@x.at", False), ("büro@x.at", True)]),
    "generic_class": (contact.generic_class, [("Büro@x.at", 1), ("info12@x.at", 1), ("anna@x.at", 0), ("no at", None), ("@x", None), ("", None), (None, None)]),
    "whois": (detect.whois_registered, [("No match for X", False), ("Registrar: Y", True), ("?", None), ("", None)]),
    "social": (detect.social_platform, [
        ("https://www.facebook.com/huber", "facebook"), ("https://facebook.com/sharer.php?u=1", None), ("https://x.com/huber", "twitter"), ("https://x.com/", None), ("https://m.youtube.com/c/h", "youtube"), ("mailto:a@b.at", None), ("https://notfacebook.com/a", None),
    ]),
    "forbidden": (detect.forbidden_error, [("API key not valid", "AUTH_ERROR"), ("Quota exceeded", "QUOTA_EXCEEDED"), (None, "CLIENT_ERROR")]),
}


@pytest.mark.parametrize("name", CASES)
def test_function(spark, name):
    make, cases = CASES[name]
    assert rows(spark, [a for a, _ in cases], make) == [b for _, b in cases]


def test_emails_in_order(spark):
    got = rows(spark, ["info@huber.at, Anna@Huber.at noreply@huber.at anna@huber.at x [at] y [dot] at"], contact.emails)
    assert got == [["anna@huber.at", "x@y.at", "info@huber.at"]]


HTML = """<html><head><title> Coming soon </title><meta content="width=device-width" name="viewport"><meta name="generator" content="Joomla! 4">
<script type="application/ld+json">{"@graph":[{"@type":"Restaurant"},{"@type":["http://schema.org/Store","Zoo"]}]}</script><script type="application/ld+json">{bad</script></head>
<body itemscope itemtype="https://schema.org/Person"><div>Huber GmbH</div><p>Gasse 4, 1030 Wien</p><span>UID ATU12345678, Tel 01 2345678</span>
<a href="/kontakt?x">Kontakt</a><a href="imp.html">Impressum</a><a href="https://instagram.com/h1">1</a><a href="https://instagram.com/h2">2</a><a href="mailto:Office@huber.at?subject=a">m</a></body></html>"""


def test_html_facts(spark):
    df = spark.createDataFrame([(HTML,), (None,), ("<p>open",)], "html string").withColumn("f", html.page_facts("html"))
    f = F.col("f")
    r, empty, broken = df.select(
        html.schema_org(f).alias("schema"), detect.social_links(html.hrefs(f)).alias("social"), html.imprint_links(f).alias("links"), html.imprint(f, F.lit("u")).alias("imprint"), html.contact_page(f, F.coalesce("html", F.lit(""))).alias("page"), f["has_viewport"].alias("view"),
        html.joined_urls(F.lit("https://huber.at/de/x"), html.imprint_links(f, ("impressum", "kontakt"))).alias("full"), f["body_text"].alias("body"),
    ).collect()
    assert (r.schema.has_schema_org, r.schema.types) == (True, ["Person", "Restaurant", "Store"])
    assert r.social == {"instagram": "https://instagram.com/h1"} and r.view
    assert r.links == ["imp.html"] and r.full == ["https://huber.at/kontakt?x", "https://huber.at/de/imp.html"]
    assert "Huber GmbHGasse 4, 1030 Wien" in r.body and r.imprint.uid == "ATU12345678" and r.imprint.email == "Office@huber.at" and r.imprint.complete
    assert r.page.emails == ["office@huber.at"] and r.page.phone == "+4312345678" and r.page.plz == "1030"
    assert empty.body == "" and not empty.schema.has_schema_org and broken.body == "open"


def test_directories_name_a_site(spark):
    pages = [
        ("https://www.herold.at/x", '<a data-testid="website-link" href="https://facebook.com/x">f</a><a class="btn website" href="https://huber.at/?utm_source=h">w</a>', "https://huber.at"),
        ("https://firmen.wko.at/x", '<script type="application/ld+json">[{"url":"https://wko.at/y","sameAs":["https://huber.at/"]}]</script>', "https://huber.at"),
        ("https://www.instagram.com/x", '<a href="https://l.instagram.com/?u=https%3A%2F%2Fhuber.at%2Fm">l</a>', "https://huber.at/m"),
        ("https://falstaff.at/x", '<dl><dt>Website</dt><dd><a href="https://huber.at/f">w</a></dd></dl>', "https://huber.at/f"),
        ("https://facebook.com/x", '<script>{"website":"https://huber.at/s"}</script>', "https://huber.at/s"),
        ("https://firmenabc.at/x", '<div class="company-website"><a href="https://huber.at/c">w</a></div>', "https://huber.at/c"),
        ("https://gaultmillau.at/x", '<div class="restaurant-details"><a href="https://huber.at/g">w</a></div>', "https://huber.at/g"),
        ("https://other.at/x", '<a class="website" href="https://huber.at/">w</a>', None),
    ]
    df = spark.createDataFrame(pages, "u string, html string, want string").withColumn("f", html.page_facts("html"))
    for r in df.select("want", html.directory_site(F.col("u"), F.col("f")).alias("got")).collect():
        assert r.got == r.want


def test_detectors(spark):
    kind = "html string, headers map<string,string>"
    data = [
        (HTML, {"SERVER": "Cloudflare", "cf-ray": "1"}),
        ("x" * 2000 + " /wp-content/ &copy; 2010-2019 © 2015", {"Last-Modified": "Wed, 21 Oct 2020 07:28:00 GMT"}),
        ('<time datetime="2018-05-01T10:00:00Z"></time>', {"server": "sedoparking"}),
        ("© 2099", {}),
        ("", {"X-Powered-By": "PHP/8"}),
        ("<p>", {"X-Generator": "Drupal 9"}),
        ("wp-includes/ <i>" + "x" * 300_000 + "wp-content/", {"Set-Cookie": "a=1, WP-Settings-1=x; path=/"}),
    ]
    df = spark.createDataFrame(data, kind)
    h, hd = F.col("html"), F.col("headers")
    stack = detect.tech_stack(h, hd)
    got = df.select(stack.alias("t"), detect.cms(h, hd, stack["cms"]).alias("cms"), detect.last_modified_year(h, hd, 2026).alias("year"), detect.parking(h, hd).alias("p")).collect()
    assert got[0].t.cdn == ["cloudflare"] and got[0].cms == "joomla" and (got[0].p.verdict, got[0].p.fingerprint) == ("parked", "small-body+parking-text")
    assert (got[1].cms, got[1].year, got[1].t.cms, got[1].p.verdict) == ("wordpress", 2019, [], "not-parked")
    assert got[2].year == 2018 and (got[2].p.verdict, got[2].p.fingerprint) == ("parked", "small-body+server-header")
    assert got[3].year is None and (got[4].cms, got[5].cms) == ("unknown", "drupal")
    assert got[6].t.cms == ["wordpress"]


def test_scores_stay_below_no_website(spark):
    from itertools import product

    flags = [None, True, False]
    data = [(s, r, v, p, i, c, u, n, d) for s, r, v in product(flags, repeat=3) for p, i, c, u, n, d in [(49, True, False, None, 0, None), (50, False, None, "x", 1, True), (75, True, True, "", 0, False), (86, True, None, "x", 2, True), (None, False, None, None, 0, None)]]
    df = spark.createDataFrame(data, "s boolean, r boolean, v boolean, p int, i boolean, c boolean, u string, n int, d boolean")
    c = F.col
    none = F.array().cast("array<string>")
    for tier, fixed in (("A", None), ("B1", 7), ("B2", 6), ("B3", 20), ("C", 9)):
        entries = score.breakdown(F.lit(tier), F.lit(None).cast("string"), c("s"), c("r"), c("v"), c("p"), c("i"), c("c"), c("u"), F.array(F.lit("WIX")), none, none, c("n"), c("d"))
        for r in df.select("*", entries.alias("e"), score.total(entries).alias("t")).collect():
            keys = [e.key for e in r.e]
            assert r.t == max(0, min(30, sum(e.delta for e in r.e)))
            if fixed is not None:
                assert r.t == fixed and len(keys) == 1
            else:
                assert r.t < 20 and keys == [k for k in score.WEIGHTS if k in keys]
                assert ("NO_SSL" in keys) == (r.s is False) and ("PSI_POOR" in keys) == (r.p == 49) and ("PSI_EXCELLENT" in keys) == (r.p == 86)
    assert spark.range(1).select(score.total(score.breakdown(F.lit("C"), F.lit("PARKED"), *[F.lit(None).cast("boolean")] * 3, F.lit(None).cast("int"), *[F.lit(None).cast("boolean")] * 2, F.lit(None).cast("string"), none, none, none, F.lit(0), F.lit(None).cast("boolean")))).first()[0] == 22


def test_settings():
    s = Settings.from_mapping({"DNS_PROBE": "true", "MAX_LEADS": "7", "PSI_TTL_DAYS": ""})
    assert s.dns_probe and s.max_leads == 7 and s.psi_ttl_days == 14
    with pytest.raises(ValueError):
        Settings.from_mapping({"DNS_PROBE": "maybe"})
    assert plz_mode(None) == "permissive" and plz_mode("off") == "off"
    with pytest.raises(ValueError):
        plz_mode("loose")
