"""Awkward documents that every operator has to survive, and plain-Python definitions to compare with."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

_rng = random.Random(5)
_WORDS = ["alpha", "Beta", "gamma", "dÉlta", "of", "the", "and", "zwölf", "naïve", "x1", "7", "licence", "Ω", "🙂ok"]


def prose(n, seed=None):
    r = random.Random(seed) if seed is not None else _rng
    out = []
    for _ in range(n):
        out.append("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) if r.random() < 0.7 else r.choice(_WORDS))
    return " ".join(out)


def lines(n, seed):
    r = random.Random(seed)
    return "\n".join(prose(r.randint(1, 14), r.random()) for _ in range(n))


BASE = prose(120, 1)
TEXTS = [
    None,
    "",
    " ",
    "\n\n \t\n",
    "one",
    "a b",
    "Hello\u00a0world\u2003again",
    "é",
    BASE,
    BASE,
    BASE.replace("alpha", "ALPHA"),
    BASE + " tail",
    BASE.replace(BASE.split()[60], "changed", 1),
    lines(12, 3),
    lines(12, 3) + "\n" + lines(4, 4),
    "same line here again and again\n" * 6,
    " ".join(["the cat sat on the mat"] * 30),
    prose(6000, 9),
    "x" * 30000,
    "a.b@c.d " * 300,
    "\x00\x01 control \x7f chars \r\nline",
    "Ends without newline\n\n\nand blanks",
    "# % & | < > * $ " * 8,
]


def documents(extra=()):
    """Rows (doc_id, text, lang, source, n_chars); ids aren't in the rows' order."""
    texts = [*TEXTS, *extra]
    rows = [(7 * i % 1009, t, "en" if i % 2 else None, "src0" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    return rows


def lower_ascii(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def space_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def alnum_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()
