"""URLs: parsing, normal forms, registrable domains. Ids X1-X9, X11 of the survey.

Parsing follows the browsers' standard for http(s) URLs: scheme and host in lower case, default port and user information dropped, dot segments
resolved, other characters of the path percent-encoded, international hosts in punycode. Text that isn't a URL gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import js

#: Parameters that carry no identity of a page, beside all that start with `utm_`.
TRACKING = ("gclid", "fbclid", "mc_eid", "mc_cid", "yclid", "_hsenc", "_hsmi")
#: Parameters that directory links lose, by exact name.
DIRECTORY_TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")
#: Hosts that are never a business's own site.
PLATFORM_HOSTS = (
    "facebook.com", "instagram.com", "herold.at", "firmenabc.at", "firmen.wko.at", "wko.at", "falstaff.at", "gaultmillau.at",
    "linkedin.com", "xing.com", "maps.google.com", "google.com", "yelp.com", "tripadvisor.com", "tripadvisor.at",
)
#: Public suffixes of two labels that are common in practice; every other top-level label is a suffix of its own.
TWO_LABEL_SUFFIXES = (
    "co.at", "or.at", "ac.at", "gv.at", "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "ltd.uk", "plc.uk", "com.au", "net.au", "org.au", "co.nz", "org.nz",
    "co.jp", "or.jp", "ne.jp", "ac.jp", "com.br", "org.br", "com.tr", "co.za", "com.mx", "com.ar", "com.pl", "com.cn", "com.hk", "com.sg", "co.in", "co.kr",
    "com.tw", "co.il", "com.ua", "co.hu", "com.hr", "com.ro", "com.gr", "com.pt", "com.es", "org.es", "co.it", "com.ru", "com.my", "com.ph", "co.id", "co.th",
)

_SHAPE = r"(?is)\A([a-z][a-z0-9+.\-]*):(?://([^/?#\\]*))?([^?#]*)(\?[^#]*)?(#.*)?\z"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(js.trim(url), _SHAPE, i)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def hostname(url: Column) -> Column:
    """Host without port, lower-cased and in punycode; null for what isn't a URL with a valid host."""

    def of(part: Column) -> Column:
        fits = part.rlike(r"(?s)\A(.*@)?(\[[0-9a-fA-F:.]+\]|[^:]*)(:[0-9]*)?\z")
        bare = F.regexp_replace(F.regexp_replace(part, r"\A.*@", ""), r":[0-9]*\z", "")
        return js.let(bare, lambda raw: F.when((raw != "") & ~raw.rlike(r"[\x00-\x20<>\^|%\\]") & fits, F.lower(raw)))

    good = js.let(_part(url, 2), of)  # the call of Java stays outside of lambdas, so that a host can be grouped by
    return F.when(good.rlike(r"[^\x00-\x7F]"), F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), good)).otherwise(good)


def host(url: Column) -> Column:
    """Host with a port that isn't the scheme's default."""
    default = js.let(scheme(url), lambda s: F.when(s == "https", F.lit("443")).when(s == "http", F.lit("80")).when(s == "ftp", F.lit("21")))
    number = F.regexp_replace(js.group(_part(url, 2), r":([0-9]+)\z"), "^0+(?=[0-9])", "")
    return F.concat(hostname(url), js.let(number, lambda n: F.when(n.isNotNull() & ~n.eqNullSafe(default), F.concat(F.lit(":"), n)).otherwise("")))


def _resolved(path: Column) -> Column:
    """Dot segments taken out."""
    dot = lambda s: F.lower(s).isin(".", "%2e")
    dots = lambda s: F.lower(s).isin("..", ".%2e", "%2e.", "%2e%2e")
    parts = F.slice(F.split(path, "/", -1), 2, F.lit(1 << 30))
    n = F.size(parts)
    empty = F.array().cast("array<string>")

    def step(done: Column, x: Column) -> Column:
        return F.when(dots(x), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(dot(x), done).otherwise(F.concat(done, F.array(x)))

    last = F.get(parts, n - 1)
    kept = F.aggregate(parts, empty, step)
    return F.concat(F.lit("/"), F.array_join(F.when(dot(last) | dots(last), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))


def _encoded(path: Column) -> Column:
    """Characters that a path can't hold as percent escapes of their UTF-8 bytes."""
    one = lambda c: F.when(c.rlike(r"[^\x21-\x7E]|[\x22<>`{}]"), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c)
    return js.let(path, lambda p: F.when(p.rlike(r"[^\x21-\x7E]|[\x22<>`{}]"), F.array_join(F.transform(F.split(p, "", -1), one), "")).otherwise(p))


def pathname(url: Column) -> Column:
    raw = F.regexp_replace(_part(url, 3), r"\\", "/")
    path = js.let(raw, lambda r: F.when(r == "", F.lit("/")).otherwise(r))
    return _encoded(js.let(path, lambda p: F.when(p.rlike(r"(?i)/(\.|%2e){1,2}(/|\z)"), _resolved(p)).otherwise(p)))


def query(url: Column) -> Column:
    """Without the question mark."""
    return F.substring(_part(url, 4), 2, 1 << 30)


def is_url(url: Column) -> Column:
    return hostname(url).isNotNull()


def without_www(c: Column) -> Column:
    return F.regexp_replace(c, r"\Awww\.", "")


def _kept_query(url: Column, drop) -> Column:
    """Parameters that aren't dropped, in order, form-encoded."""
    pairs = F.filter(F.split(query(url), "&", -1), lambda p: p != "")
    decode = lambda s: F.coalesce(F.try_url_decode(s), s)
    name = lambda p: decode(F.substring_index(p, "=", 1))
    value = lambda p: F.when(p.contains("="), decode(F.regexp_replace(p, r"(?s)\A[^=]*=", ""))).otherwise(F.lit(""))
    kept = F.filter(pairs, lambda p: js.let(name(p), lambda n: ~drop(n)))
    return F.array_join(F.transform(kept, lambda p: F.concat(F.url_encode(name(p)), F.lit("="), F.url_encode(value(p)))), "&")


def _with_mark(rest: Column) -> Column:
    return js.let(rest, lambda r: F.when(r != "", F.concat(F.lit("?"), r)).otherwise(""))


def dedupe_key(url: Column) -> Column:
    """The form in which two URLs are the same page: no `www.`, no trailing slash, no tracking parameters, no fragment."""
    path = F.regexp_replace(pathname(url), r"/\z", "")
    rest = _kept_query(url, lambda n: F.lower(n).startswith("utm_") | F.lower(n).isin(*TRACKING))
    return F.concat(scheme(url), F.lit("://"), without_www(host(url)), path, _with_mark(rest))


def directory_link(url: Column) -> Column:
    """A link as directories give it: http(s) only, named tracking parameters dropped, one trailing slash less, fragment kept."""
    touched = query(url).rlike(r"(^|&)(" + "|".join(DIRECTORY_TRACKING) + ")(=|&|$)")
    rest = F.when(touched, _kept_query(url, lambda n: n.isin(*DIRECTORY_TRACKING))).otherwise(query(url))
    whole = F.concat(scheme(url), F.lit("://"), host(url), pathname(url), _with_mark(rest), _part(url, 5))
    return F.when(scheme(url).isin("http", "https"), F.regexp_replace(whole, r"/\z", ""))


def host_and_path(url: Column) -> Column:
    """What branch patterns are matched with: host without `www.`, then the path; no port, no query."""
    return F.concat(without_www(hostname(url)), pathname(url))


def apex(url: Column) -> Column:
    """The registrable domain; null for addresses, single labels and what isn't a URL."""

    def of(h: Column) -> Column:
        labels = F.split(h, r"\.", -1)
        n = F.size(labels)
        two = F.concat_ws(".", F.slice(labels, F.greatest(n - 1, F.lit(1)), F.lit(2)))
        deep = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.lit(3)).otherwise(F.lit(2))
        address = h.rlike(r"\A[0-9.]+\z") | h.startswith("[")
        return F.when(~address & (n >= deep) & ~h.rlike(r"(^|\.)(\.|$)"), F.concat_ws(".", F.slice(labels, n - deep + 1, deep)))

    return js.let(F.regexp_replace(hostname(url), r"\.\z", ""), of)


def host_title(url: Column) -> Column:
    """A name from the host: its first label, words at hyphens capitalised; empty for what isn't a URL."""
    label = F.substring_index(without_www(host(url)), ".", 1)
    words = F.transform(F.split(label, "-", -1), lambda s: F.concat(F.upper(F.left(s, F.lit(1))), F.lower(F.substring(s, 2, 1 << 20))))
    return F.coalesce(F.array_join(words, "-"), F.lit(""))


def is_platform(url: Column) -> Column:
    """Whether the host is a platform's or directory's, or the URL is unusable."""
    hosts = "|".join(p.replace(".", r"\.") for p in PLATFORM_HOSTS)
    return F.coalesce(without_www(hostname(url)).rlike(rf"(?:\A|\.)(?:{hosts})\z"), F.lit(True))


def scheduling_host(url: Column) -> Column:
    """The host by which fetches are spaced; candidates without a site share one."""
    return F.coalesce(hostname(url), F.lit("__discovery__"))


def unshimmed(url: Column) -> Column:
    """X11: the target of an Instagram redirect link; null for other links."""
    target = js.group(query(url), r"(?:^|&)u=([^&]*)")
    return F.when(hostname(url).endswith("l.instagram.com"), F.try_url_decode(target))


def pattern_regex(pattern: str) -> str:
    """The anchored expression of a branch pattern: `*` is one or more characters, the host is lower-cased, without `www.`, in punycode."""
    head, slash, tail = pattern.partition("/")
    head = head.lower().removeprefix("www.")
    try:
        head = head.encode("idna").decode() if not head.isascii() else head
    except UnicodeError:
        pass
    special = ".+?^${}()|[]\\"
    return "^" + "".join(".+" if c == "*" else "\\" + c if c in special else c for c in head + slash + tail) + "$"
