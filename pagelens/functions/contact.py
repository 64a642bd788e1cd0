"""Postal codes, addresses, numbers and e-mail addresses. Ids X27-X43 of the survey.

There are four notions of a postal code and three of a role mailbox; each has its own use, and they are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import js
from .text import csv_cell  # noqa: F401  (re-exported beside the log formats)

#: Fixed values.
NOISE_DOMAINS = ("example.com", "example.org", "example.net", "domain.tld", "test.com", "localhost")
NOISE_LOCALS = ("noreply", "no-reply", "donotreply", "do-not-reply", "webmaster", "postmaster", "abuse", "hostmaster", "wp", "root")
ROLE_LOCALS = (
    "info", "office", "kontakt", "contact", "hello", "hallo", "mail", "service", "support", "sales", "vertrieb", "team", "verwaltung", "sekretariat",
    "anfrage", "anfragen", "willkommen", "buero", "büro",
)
BUSINESS_LOCALS = (
    "office", "info", "kontakt", "contact", "hello", "hallo", "mail", "service", "support", "sales", "vertrieb", "team", "verwaltung", "sekretariat",
    "anfrage", "anfragen", "willkommen",
)
GENERIC_LOCALS = (
    "info", "office", "kontakt", "contact", "hello", "hallo", "mail", "welcome", "service", "support", "sales", "admin", "team", "buero", "office1",
    "kanzlei", "praxis", "ordination", "rezeption", "empfang", "anfrage",
)
#: Patterns of addresses, numbers and places.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = rf"(?:\+{js.S}*43|0043|{js.LEFT}0)[{js.SPACE}\-/().0-9]{{6,24}}[0-9]"
_W = r"A-Za-z0-9_"
ADDRESS = rf"([A-ZÄÖÜ][{_W}ÄÖÜäöüß.\- ]{{2,60}}?{js.S}+[0-9]{{1,4}}[a-zA-Z]?(?:{js.S}*[-/]{js.S}*[0-9]{{1,4}})?)[,{js.SPACE}]+([0-9]{{4}}){js.S}+([A-ZÄÖÜ][{_W}ÄÖÜäöüß .\-]{{2,60}})"


def plz_of_address(address: Column) -> Column:
    """`1dd0` as a word of an address."""
    return js.group(address, rf"{js.LEFT}(1[0-9]{{2}}0){js.RIGHT}")


def plz_of_place(component: Column, address: Column) -> Column:
    """The postal component if it is `1dd0`, else that of the address."""
    return F.coalesce(F.when(component.rlike(r"\A1[0-9]{2}0\z"), component), plz_of_address(address))


def plz_in_text(c: Column) -> Column:
    """`1000` to `1290` in steps of ten as a word of any text."""
    return js.group(c, rf"{js.LEFT}(1[0-2][0-9]0){js.RIGHT}")


def is_vienna_plz(c: Column) -> Column:
    """1010 to 1230 in steps of ten."""
    return F.coalesce(c.rlike(r"\A1(0[1-9]|1[0-9]|2[0-3])0\z"), F.lit(False))


def district(plz: Column) -> Column:
    """`01` to `23` of a postal code `1dd0`."""
    return js.group(plz, r"\A1(0[1-9]|1[0-9]|2[0-3])0\z")


def _address(text: Column) -> Column:
    """Struct of address and plz. The text is searched once, and only where four digits stand before a capital: the groups are read from the place that was found."""
    able = text.rlike(rf"[,{js.SPACE}][0-9]{{4}}{js.S}+[A-ZÄÖÜ]")
    found = F.when(able, F.regexp_extract(js.trim(js.squeeze(text)), ADDRESS, 0)).otherwise(F.lit(""))

    def of(place: Column) -> Column:
        street, plz, city = (F.regexp_extract(place, rf"\A{ADDRESS}\z", i) for i in (1, 2, 3))
        whole = js.let(street, lambda s: F.when(s != "", F.concat(js.trim(s), F.lit(", "), plz, F.lit(" "), js.trim(city))))
        return F.struct(whole.alias("address"), js.let(plz, js.null_if_empty).alias("plz"))

    return js.let(found, of)


def address(text: Column) -> Column:
    """`street number, plz city` found in a text."""
    return _address(text)["address"]


def strict_address(text: Column) -> Column:
    """Struct of address and plz; both null unless the postal code is a Viennese one."""

    def of(found: Column) -> Column:
        good = is_vienna_plz(found["plz"])
        return F.struct(F.when(good, found["address"]).alias("address"), F.when(good, found["plz"]).alias("plz"))

    return js.let(_address(text), of)


def uid(text: Column) -> Column:
    """`ATU` and eight digits, from the first place with enough digits."""
    found = F.transform(F.regexp_extract_all(text, F.lit(rf"(?i)AT{js.S}*U{js.S}*([0-9][0-9{js.SPACE}]{{7,}})"), F.lit(1)), lambda m: F.regexp_replace(m, f"{js.S}+", ""))
    return F.concat(F.lit("ATU"), F.left(F.get(F.filter(found, lambda d: F.length(d) >= 8), F.lit(0)), F.lit(8)))


def phone(text: Column) -> Column:
    """The first number of 7 to 13 digits with an Austrian prefix or leading zero."""
    found = F.regexp_extract_all(text, F.lit(PHONE), F.lit(0))
    good = F.filter(found, lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(7, 13))
    return js.trim(js.squeeze(F.get(good, F.lit(0))))


def phone_e164(raw: Column) -> Column:
    """An Austrian number in international form; null if it isn't one.

    Without a number plan at hand the test is on form: country code or trunk prefix, an area or mobile code that doesn't start with 0, and 7
    to 13 national digits in all (4 to 13 for the capital's code 1 with at least 6 digits after it)."""
    of = lambda d: F.when(d.startswith("+43"), F.substring(d, 4, 30)).when(d.startswith("0043"), F.substring(d, 5, 30)).when(d.rlike(r"\A0[1-9]"), F.substring(d, 2, 30))
    national = js.let(F.regexp_replace(raw, r"[^0-9+]", ""), of)
    return js.let(F.regexp_replace(national, r"\A0", ""), lambda bare: F.when(bare.rlike(r"\A[1-9][0-9]{6,12}\z"), F.concat(F.lit("+43"), bare)))


def deobfuscated(text: Column) -> Column:
    """Written-out at signs and dots as characters; three rounds reach the fixed point of chained forms.

    The replacements start at any letter, which is slow; they run only on texts with a bracketed word or an ` at ` before a domain, without which none of them fits."""
    plain = F.regexp_replace(F.regexp_replace(text, "(?i)&#64;|&#x40;", "@"), r"(?i)&#46;|&#x2e;", ".")
    w = r"[A-Za-z0-9_]"
    host = rf"{w}[A-Za-z0-9_.-]*\.[A-Za-z]{{2,}}"
    written_out = rf"(?iu)[\[({{]{js.S}*(?:at|ät|æt|dot|punkt){js.S}*[\])}}]|{js.S}(?:at|ät){js.S}+{host}"

    def of(s: Column) -> Column:
        for _ in range(3):
            s = F.regexp_replace(s, rf"(?iu)({w}){js.S}*[\[({{]{js.S}*(?:at|ät|æt){js.S}*[\])}}]{js.S}*({w})", "$1@$2")
            s = F.regexp_replace(s, rf"(?i)({w}){js.S}*[\[({{]{js.S}*(?:dot|punkt){js.S}*[\])}}]{js.S}*({w})", "$1.$2")
            s = F.regexp_replace(s, rf"(?iu)({w}+){js.S}+(?:at|ät){js.S}+({host})", "$1@$2")
        return s

    return js.let(plain, lambda s: F.when(s.rlike(written_out), of(s)).otherwise(s))


def raw_emails(text: Column) -> Column:
    """All matches, lower-cased, each once in the order of first occurrence."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), F.lower))


def _local(email: Column) -> Column:
    return F.lower(F.substring_index(email, "@", 1))


def _domain(email: Column) -> Column:
    return F.lower(F.regexp_replace(email, r"(?s)\A[^@]*@", ""))


def is_noise(email: Column) -> Column:
    """Addresses of examples, machines and unreachable mailboxes, and malformed ones."""

    def of(at: Column) -> Column:
        local, domain = at["local"], at["domain"]
        bad = domain.isin(*NOISE_DOMAINS)
        for d in NOISE_DOMAINS:
            bad = bad | domain.endswith("." + d)
        malformed = ~email.contains("@") | email.startswith("@") | (domain == "")
        return malformed | bad | local.isin(*NOISE_LOCALS) | ((local == "admin") & (domain == "wordpress.org"))

    return js.let(F.struct(_local(email).alias("local"), _domain(email).alias("domain")), of)


def _starts_role(local: Column, roles) -> Column:
    return local.rlike(r"\A(?:" + "|".join(r.replace("-", r"\-") for r in roles) + r")(?:\z|[.\-_0-9])")


def is_role(email: Column) -> Column:
    """A role's mailbox, alone or before `. - _` or a digit."""
    return email.contains("@") & ~email.startswith("@") & _starts_role(_local(email), ROLE_LOCALS)


def is_generic_business(email: Column) -> Column:
    """X40."""
    return email.contains("@") & ~email.startswith("@") & _starts_role(js.trim(_local(email)), BUSINESS_LOCALS)


def generic_class(email: Column) -> Column:
    """1 for a generic mailbox (digits at the end don't count), 0 for another, null for what isn't an address."""
    local = _local(email)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        local = F.replace(local, F.lit(a), F.lit(b))
    generic = local.isin(*GENERIC_LOCALS) | F.regexp_replace(local, r"[0-9]+\z", "").isin(*GENERIC_LOCALS)
    return F.when(email.contains("@") & ~email.startswith("@"), generic.cast("int"))


def prioritised(emails: Column) -> Column:
    """Personal mailboxes before role mailboxes, each in order."""
    return js.let(emails, lambda all_: F.concat(F.filter(all_, lambda e: ~is_role(e)), F.filter(all_, lambda e: is_role(e))))


def emails(text: Column) -> Column:
    """Addresses in a text, written-out ones too, without noise, personal ones first."""
    return prioritised(F.filter(raw_emails(deobfuscated(text)), lambda e: ~is_noise(e)))


def mailto_emails(hrefs: Column) -> Column:
    """Addresses of `mailto:` links, without their query."""
    links = F.filter(hrefs, lambda h: F.lower(h).startswith("mailto:"))
    bare = F.transform(links, lambda h: F.lower(js.trim(F.substring_index(F.substring(h, 8, 1 << 20), "?", 1))))
    return F.filter(bare, lambda e: e != "")


def generic_email(hrefs: Column, text: Column) -> Column:
    """The first generic business address, of links first, then of the text."""
    bare = F.transform(F.filter(hrefs, lambda h: F.lower(h).startswith("mailto:")), lambda h: js.trim(F.substring_index(F.substring(h, 8, 1 << 20), "?", 1)))
    of_links = F.filter(bare, lambda e: (e != "") & is_generic_business(e))
    of_text = F.filter(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), lambda e: is_generic_business(e))
    return F.coalesce(F.get(of_links, F.lit(0)), F.get(of_text, F.lit(0)))


def coverage(phone: Column, email: Column, address: Column) -> Column:
    """`P`, `E` and `A` for what is there; empty text counts as missing."""
    flag = lambda c, x: F.when(F.coalesce(c, F.lit("")) != "", F.lit(x)).otherwise("")
    return F.concat(flag(phone, "P"), flag(email, "E"), flag(address, "A"))


def postal_address(tags: Column) -> Column:
    """`street number, plz city` from map tags; missing parts are left out, a number counts only with a street."""
    tag = lambda k: js.null_if_empty(F.try_element_at(tags, F.lit(k)))
    street = F.when(tag("addr:housenumber").isNotNull(), F.concat(tag("addr:street"), F.lit(" "), tag("addr:housenumber"))).otherwise(tag("addr:street"))
    place = js.null_if_empty(F.concat_ws(" ", tag("addr:postcode"), tag("addr:city")))
    return js.null_if_empty(F.concat_ws(", ", street, place))


def effective_plz(mode: str, own: Column, of_map: Column, name: Column, url: Column) -> Column:
    """Strict: the imprint's code only; permissive: else the map's, else one in the name or the URL; off: none. Empty text is none."""
    if mode == "off":
        return F.lit(None).cast("string")
    if mode == "strict":
        return js.null_if_empty(own)
    return F.coalesce(js.null_if_empty(own), js.null_if_empty(of_map), plz_in_text(name), plz_in_text(url))
