"""Facts of HTML pages that need a parser. Ids X10, X43, X45, X49, X50, X52-X55 of the survey.

One Arrow function parses each page once and returns all facts as one struct; everything downstream is built-in expressions on it. A page that
can't be parsed gives empty facts.
"""

from __future__ import annotations

import json
import sys
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import contact, detect, js, text, url

# the parser travels to the executors by value: they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values.
SCHEMA_TYPES = (
    "Organization", "LocalBusiness", "Restaurant", "Store", "Service", "Product", "WebSite", "BreadcrumbList", "Person", "Article", "BlogPosting", "Event", "FAQPage",
)
IMPRESSUM_PATHS = ("/impressum", "/imprint", "/legal", "/kontakt", "/about", "/ueber-uns")
CONTACT_PATHS = ("/impressum", "/imprint", "/kontakt", "/contact", "/legal", "/about", "/ueber-uns")
MAX_CONTACT_PAGES = 3

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
FACTS = T.StructType(
    [
        T.StructField("body_text", T.StringType()),
        T.StructField("links", T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))),
        T.StructField("schema_types", T.ArrayType(T.StringType())),
        T.StructField("viewport", T.StringType()),
        T.StructField("has_viewport", T.BooleanType()),
        T.StructField("json_ld", T.ArrayType(T.StringType())),
        T.StructField("directory_links", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)


#: Classes of the elements inside which directories put links to a business's own site.
_PLACES = {"company-website", "restaurant-info", "restaurant-details"}


class _Node:
    """start and end: the element's pieces of the page's text. inside: what of interest the elements around it are."""

    __slots__ = ("tag", "attrs", "parent", "start", "end", "before", "inside", "marks")

    def __init__(self, tag, attrs, parent, start):
        self.tag, self.attrs, self.parent, self.start, self.end, self.before = tag, attrs, parent, start, start, None
        self.inside = parent.inside | parent.marks if parent and parent.marks else parent.inside if parent else frozenset()
        self.marks = frozenset()

    def has(self, cls: str) -> bool:
        return cls in (self.attrs.get("class") or "").split()


class _Page(HTMLParser):
    """All elements in order, and the text's pieces; each element keeps the bounds of its own, so that nesting costs nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.root = self.now = _Node("", {}, None, 0)
        self.nodes: list[_Node] = []
        self.last: dict = {}
        self.open: dict[str, int] = {}

    def text(self, node: _Node) -> str:
        return "".join(self.pieces[node.start : node.end])

    def _mark(self, node: _Node) -> None:
        found = set(_PLACES.intersection((node.attrs.get("class") or "").split()))
        if node.tag == "div" and node.attrs.get("data-key") == "website":
            found.add("website-key")
        if node.tag == "header":
            found.add("header")
        if node.tag == "section" and "header" in node.inside:
            found.add("header-section")
        if node.tag == "dd" and node.before is not None and node.before.tag == "dt" and "Website" in self.text(node.before):
            found.add("website-label")
        node.marks = frozenset(found)

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.now, len(self.pieces))
        node.before = self.last.get(self.now)
        self.last[self.now] = node
        self._mark(node)
        self.nodes.append(node)
        if tag not in _VOID:
            self.now = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._up()

    def _up(self) -> None:
        self.now.end = len(self.pieces)
        self.open[self.now.tag] -= 1
        self.now = self.now.parent

    def handle_endtag(self, tag):
        if self.open.get(tag):
            while self.now.tag != tag:
                self._up()
            self._up()

    def handle_data(self, data):
        self.pieces.append(data)

    def finish(self) -> None:
        self.close()
        while self.now is not self.root:
            self._up()
        self.root.end = len(self.pieces)


def _types(node, out: list) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            t = x.get("@type")
            out += [_tail(v) for v in (t if isinstance(t, list) else [t]) if isinstance(v, str)]
            stack.extend(v for v in reversed(list(x.values())) if isinstance(v, (dict, list)))


def _tail(name: str) -> str:
    for sep in "#/:":
        name = name.rpartition(sep)[2]
    return name.strip()


def _directory_links(page: _Page, html: str, blocks: list[str]) -> dict[str, list[str]]:
    """Candidate links to the business's own site, by directory, in the order in which they are tried."""
    a = [n for n in page.nodes if n.tag == "a"]
    href = lambda nodes: [n.attrs.get("href", "") for n in nodes[:1]]
    meta = [n for n in page.nodes if n.tag == "meta" and n.attrs.get("property") == "og:website"]
    start = html.find('"website":"http')
    quoted = html[start + 11 :].partition('"')[0] if start >= 0 else ""
    shim = [n for n in a if "l.instagram.com/?u=" in n.attrs.get("href", "")]
    ld = []
    for raw in blocks:
        try:
            nodes = json.loads(raw)
        except ValueError:
            continue
        for n in nodes if isinstance(nodes, list) else [nodes]:
            if isinstance(n, dict):
                ld += [n["url"]] if isinstance(n.get("url"), str) else []
                ld += [s for s in n.get("sameAs") or [] if isinstance(s, str)] if isinstance(n.get("sameAs"), list) else []
    inside = lambda mark: href([n for n in a if mark in n.inside])
    return {
        "herold": href([n for n in a if n.attrs.get("data-testid") == "website-link"]) + href([n for n in a if n.has("website")]) + [n.attrs.get("content", "") for n in meta[:1]],
        "firmenabc": inside("company-website") + href([n for n in a if n.attrs.get("rel") == "external noopener" and n.attrs.get("href", "").startswith("http")]),
        "wko": ld,
        "facebook": href([n for n in a if "Website" in n.attrs.get("aria-label", "")]) + inside("website-key") + ([quoted] if quoted.startswith(("http://", "https://")) else []),
        "instagram": href(shim) + href([n for n in a if n.attrs.get("target") == "_blank" and "header-section" in n.inside]),
        "falstaff": href([n for n in a if n.has("website") and "restaurant-info" in n.inside]) + inside("website-label"),
        "gaultmillau": href([n for n in a if "http" in n.attrs.get("href", "") and "restaurant-details" in n.inside]),
    }


def parse(html: str | None) -> dict:
    empty = {"body_text": "", "links": [], "schema_types": [], "viewport": None, "has_viewport": False, "json_ld": [], "directory_links": {}}
    if not html:
        return empty
    page = _Page()
    try:
        page.feed(html)
        page.finish()
    except (AssertionError, RecursionError, ValueError):
        return empty
    bodies = [n for n in page.nodes if n.tag == "body"]
    heads = [n for n in page.nodes if n.tag in ("head", "html")]
    body = page.text(bodies[0]) if bodies else page.text(page.root) if not heads else ""
    blocks = [page.text(n) for n in page.nodes if n.tag == "script" and n.attrs.get("type") == "application/ld+json"]
    types: list[str] = []
    for raw in blocks:
        try:
            _types(json.loads(raw), types)
        except (ValueError, RecursionError):
            continue
    for n in page.nodes:
        types += [_tail(p) for p in n.attrs.get("itemtype", "").split() if "schema.org" in p.lower()]
    views = [n for n in page.nodes if n.tag == "meta" and n.attrs.get("name") == "viewport"]
    return {
        "body_text": body,
        "links": [{"href": n.attrs["href"], "text": page.text(n)} for n in page.nodes if n.tag == "a" and n.attrs.get("href")],
        "schema_types": list(dict.fromkeys(types)),
        "viewport": (views[0].attrs.get("content", "").strip() or None) if views else None,
        "has_viewport": bool(views),
        "json_ld": blocks,
        "directory_links": _directory_links(page, html, blocks),
    }


@F.pandas_udf(FACTS)
def page_facts(pages: pd.Series) -> pd.DataFrame:
    rows = [parse(p) for p in pages]
    return pd.DataFrame({f.name: [r[f.name] for r in rows] for f in FACTS})


@F.pandas_udf(T.ArrayType(T.StringType()))
def joined_urls(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    """Links made absolute, in order; those that can't be are left out."""

    def one(b, hs):
        out = []
        for h in hs if hs is not None else []:
            try:
                full = urljoin(b or "", h.strip())
            except ValueError:
                continue
            if ":" in full:
                out.append(full)
        return out

    return pd.Series([one(b, hs) for b, hs in zip(base, hrefs)])


def schema_org(facts: Column) -> Column:
    """Struct of has_schema_org and the types of interest, sorted."""
    return F.struct((F.size(facts["schema_types"]) > 0).alias("has_schema_org"), F.sort_array(F.filter(facts["schema_types"], lambda t: t.isin(*SCHEMA_TYPES))).alias("types"))


def hrefs(facts: Column) -> Column:
    return F.transform(facts["links"], lambda x: x["href"])


def directory_site(page_url: Column, facts: Column) -> Column:
    """The business's own site that a directory page names: the first candidate that is public."""
    links = F.try_element_at(facts["directory_links"], detect.directory(page_url))
    plain = F.transform(links, lambda h: js.let(F.coalesce(url.unshimmed(h), h), url.directory_link))
    return F.get(F.filter(plain, lambda h: h.isNotNull() & ~url.is_platform(h)), F.lit(0))


def imprint_links(facts: Column, words: tuple[str, ...] = ("impressum", "imprint")) -> Column:
    """Links that lead to an imprint by their text or address, as they stand in the page."""
    hit = lambda x: js.contains_any(F.lower(x["text"]), words) | js.contains_any(F.lower(x["href"]), words)
    return F.transform(F.filter(facts["links"], hit), lambda x: x["href"])


def imprint(facts: Column, page_url: Column) -> Column:
    """Struct of an imprint page: complete with uid, company name and address."""
    body = facts["body_text"]
    names = ("uid", "company_name", "address")
    found = F.struct(*[c.alias(n) for c, n in zip((contact.uid(body), text.company_name_in(body), contact.address(body)), names, strict=True)])

    def of(x: Column) -> Column:
        return F.struct(
            F.lit(True).alias("present"), page_url.alias("url"), *[x[n].alias(n) for n in names], contact.phone(body).alias("phone"),
            contact.generic_email(hrefs(facts), body).alias("email"), (x["uid"].isNotNull() & x["company_name"].isNotNull() & x["address"].isNotNull()).alias("complete"),
        )

    return js.let(found, of)


def contact_page(facts: Column, html: Column) -> Column:
    """Struct of a contact page; addresses of `mailto:` links skip the noise filter."""
    body = facts["body_text"]
    every = contact.prioritised(F.array_distinct(F.concat(contact.mailto_emails(hrefs(facts)), contact.emails(html))))
    tel = F.transform(F.filter(hrefs(facts), lambda h: F.lower(h).startswith("tel:")), lambda h: contact.phone_e164(F.substring(h, 5, 100)))
    in_text = F.transform(F.regexp_extract_all(body, F.lit(contact.PHONE), F.lit(0)), contact.phone_e164)
    found = F.struct(every.alias("emails"), contact.strict_address(body).alias("place"))

    def of(x: Column) -> Column:
        return F.struct(
            F.get(x["emails"], F.lit(0)).alias("email"), x["emails"].alias("emails"), js.first_not_null(F.concat(tel, in_text)).alias("phone"), x["place"]["address"].alias("address"),
            x["place"]["plz"].alias("plz"), text.company_name_in(body).alias("company_name"), contact.uid(body).alias("uid"),
        )

    return js.let(found, of)


def merged_pages(pages: Column) -> Column:
    """Contact pages in order as one: of each field the first that is there; all addresses, personal ones first."""
    first = lambda name: js.first_not_null(F.transform(pages, lambda p: p[name]))
    all_ = contact.prioritised(F.array_distinct(F.flatten(F.transform(pages, lambda p: p["emails"]))))
    return F.struct(F.coalesce(first("email"), F.get(all_, F.lit(0))).alias("email"), all_.alias("emails"), *[first(n).alias(n) for n in ("phone", "address", "plz", "company_name", "uid")])
