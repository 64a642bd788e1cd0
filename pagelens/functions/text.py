"""Names, slugs and text tests. Ids X12-X26 of the survey."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import js

#: Fixed values.
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "ae", "Ö": "oe", "Ü": "ue"}
NAME_STOP_WORDS = (
    "Telefon", "Fax", "E-Mail", "UID", "ATU", "Firmenbuch", "Gerichtsstand", "Handelsgericht", "Unternehmensgegenstand", "Geschäftsführer",
    "Medieninhaber", "Adresse", "Website", "Impressum", "Datenschutz", "Menü", "Speisekarte", "Öffnungszeiten",
)
BRANCH_WORDS = ("filiale", "standort", "zweigstelle")
TAG_KEYS = ("shop", "office", "amenity", "craft", "healthcare", "leisure")
LEGAL_FORMS = ("GmbH & Co KG", "GmbH", "AG", "OG", "KG", r"e\.U\.", "eU", r"Ges\.m\.b\.H\.?", r"Gesellschaft m\.b\.H\.?")
#: Characters whose compatibility decomposition holds a plain letter, digit or `&`: those that become one character, and those that become several.
_DECOMPOSED: tuple[dict[str, str], dict[str, str]] = ({}, {})


def decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """By rule from the Unicode tables: what NFKD makes of a lower-case character, without the marks U+0300 to U+036F, where a slug keeps any of it. What
    it drops stands for a separator (a space)."""
    one, many = _DECOMPOSED
    if not one:
        import sys
        import unicodedata

        for c in map(chr, range(0x80, sys.maxunicode + 1)):
            plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not "\u0300" <= x <= "\u036f")
            if plain != c and any(x.isascii() and (x.islower() or x.isdigit() or x == "&") for x in plain):
                kept = "".join(x if x.isascii() and (x.islower() or x.isdigit() or x == "&") else " " for x in plain)
                (one if len(plain) == 1 else many)[c] = kept
    return _DECOMPOSED


def fold_umlauts(c: Column) -> Column:
    """Umlauts and sharp s as two letters."""
    for a, b in UMLAUTS.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _plain(c: Column) -> Column:
    """Umlauts folded, lower case, characters decomposed, marks off.

    Characters that become one are translated; only texts that hold one that becomes several (ligatures, fractions, units) are taken apart and joined with the table."""
    one, many = decompositions()
    low = F.translate(F.lower(fold_umlauts(c)), "".join(one), "".join(one.values()))
    table = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    apart = F.array_join(F.transform(F.split(low, ""), lambda x: F.when(x < "\u0080", x).otherwise(F.coalesce(F.try_element_at(table, x), x))), "")
    rare = low.rlike("[" + "".join(f"\\x{{{ord(x):x}}}" for x in many) + "]")
    return F.regexp_replace(F.when(rare, apart).otherwise(low), r"[\x{300}-\x{36f}]", "")


def slug(c: Column) -> Column:
    """Letters and digits with hyphens between; `&` is `and`."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.replace(_plain(c), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")), " +", "-")


def name_key(c: Column) -> Column:
    """A name without legal form and separators."""
    forms = rf"{js.S}+(gmbh|og|kg|eu|e\.u\.|e\.k\.|ag|ges\.m\.b\.h\.?){js.RIGHT}"
    return F.regexp_replace(F.regexp_replace(_plain(c), forms, ""), "[^a-z0-9]+", "")


def name_tokens(c: Column) -> Column:
    """Distinct tokens of the slug."""
    return F.array_distinct(F.filter(F.split(F.coalesce(slug(c), F.lit("")), "-", -1), lambda t: t != ""))


def osm_tag(types: Column) -> Column:
    """The first `key=value` of the types whose key is a known one and whose value isn't empty."""
    known = F.filter(types, lambda t: t.rlike("^(" + "|".join(TAG_KEYS) + ")=.+"))
    return F.get(known, F.lit(0))


def has_brand(types: Column) -> Column:
    """Whether a type names a brand."""
    return F.coalesce(F.exists(types, lambda t: t.startswith("brand:")), F.lit(False))


def canonical(c: Column) -> Column:
    """Folded, lower case, single spaces."""
    return js.squeeze(js.trim(F.lower(fold_umlauts(c))))


def is_branch_name(c: Column) -> Column:
    """X19."""
    return js.contains_any(F.lower(fold_umlauts(c)), BRANCH_WORDS)


def domain_guesses(name: Column) -> Column:
    """Up to six domains that a business of this name may have."""
    s = slug(name)
    first = F.substring_index(s, "-", 1)
    guesses = F.array(
        F.concat(s, F.lit(".at")), F.concat(F.lit("www."), s, F.lit(".at")), F.concat(s, F.lit(".wien")), F.concat(s, F.lit("-wien.at")), F.concat(s, F.lit(".co.at")), F.concat(first, F.lit(".at"))
    )
    return F.when(F.coalesce(s, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(guesses, lambda g: F.length(g) <= 63)))


def company_name(c: Column) -> Column:
    """A company name cut at a line's end or a stop word inside it, without trailing punctuation, 3 to 80 characters; else null."""

    def cut(line: Column) -> Column:
        places = js.let(F.lower(line), lambda low: F.array(*[F.instr(low, w.lower()) for w in NAME_STOP_WORDS]))
        return js.let(F.filter(places, lambda i: i > 1), lambda at: F.when(F.size(at) > 0, F.left(line, F.array_min(at) - 1)).otherwise(line))

    head = js.let(F.regexp_replace(c, r"(?s)\r?\n.*\z", ""), cut)
    bare = js.trim(F.regexp_replace(js.trim(head), rf"[:;,|\-{js.SPACE}]+\z", ""))
    short = js.let(bare, lambda b: F.when(F.length(b) > 80, js.trim(F.left(b, F.lit(80)))).otherwise(b))
    return js.let(short, lambda s: F.when(F.length(s) >= 3, s))


#: A name before a legal form, and behind a label.
_NAME = r"([A-ZÄÖÜ][A-Za-z0-9_ÄÖÜäöüß&.,'\- ]{1,60}?" + js.S + "(?:" + "|".join(LEGAL_FORMS) + "))"
_LABELLED = r"(?i)(?:Firmenname|Firmenwortlaut|Unternehmen|Inhaber|Medieninhaber)" + js.S + r"*:" + js.S + r"*([^\n\r<]{2,100})"


def company_name_in(text: Column) -> Column:
    """The company's name in an imprint: after a label, else before a legal form."""

    def finished(raw: Column) -> Column:
        head = js.trim(F.regexp_replace(raw, r"(?s)\r?\n.*\z", ""))
        return js.let(head, lambda h: F.when(F.length(h) >= 3, company_name(h)))

    labelled = finished(js.group(text, _LABELLED))
    has_form = text.rlike(js.S + "(?:" + "|".join(LEGAL_FORMS) + ")")
    return F.coalesce(labelled, F.when(has_form, finished(js.group(F.regexp_replace(text, r"[ \t]+", " "), _NAME))))


def validates(html: Column, name: Column, plz: Column, phone: Column) -> Column:
    """Whether a page is the candidate's: two long words of the name, or the postal code, or the phone's last seven digits, near its top."""

    def of(top: Column) -> Column:
        words = F.filter(F.regexp_extract_all(F.coalesce(F.lower(fold_umlauts(name)), F.lit("")), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: F.length(w) >= 4)
        by_name = F.size(F.filter(words, lambda w: top.contains(w))) >= 2
        by_plz = (F.coalesce(plz, F.lit("")) != "") & top.contains(F.coalesce(plz, F.lit("")))
        digits = F.regexp_replace(F.coalesce(phone, F.lit("")), "[^0-9]", "")
        by_phone = (F.length(digits) >= 7) & F.regexp_replace(top, "[^0-9]", "").contains(F.right(digits, F.lit(7)))
        return F.coalesce(by_name | by_plz | by_phone, F.lit(False))

    return js.let(F.left(F.lower(html), F.lit(20_000)), of)


def cache_key(*parts: Column) -> Column:
    """SHA-256 of the parts joined by `|`; null counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def table_cell(c: Column) -> Column:
    """Text for a cell of a Markdown table."""
    return F.replace(F.replace(c, F.lit("|"), F.lit("/")), F.lit("\n"), F.lit(" "))


def truncated(c: Column, n: int) -> Column:
    """At most n characters, the last an ellipsis if cut."""
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.left(c, F.lit(n - 1)), F.lit("…")))


def csv_cell(c: Column, separator: str = ",") -> Column:
    """Quoted where it holds the separator, a quote or a line break."""
    return F.when(c.rlike(f'[{separator}"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def breakdown_text(entries: Column) -> Column:
    """`KEY+3; KEY-1`."""
    one = lambda e: F.concat(e["key"], F.when(e["delta"] >= 0, F.lit("+")).otherwise(F.lit("")), e["delta"].cast("string"))
    return F.array_join(F.transform(entries, one), "; ")


def opportunities_valid(items: Column) -> Column:
    """One to three texts of 20 to 140 characters without exclamation mark and informal pronoun."""
    good = lambda t: F.length(t).between(20, 140) & ~t.contains("!") & ~t.rlike(rf"(?i){js.LEFT}(du|dein|deine|dir|dich){js.RIGHT}")
    return F.size(items).between(1, 3) & F.forall(items, good)
