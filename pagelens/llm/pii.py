"""Personal data by candidate gradient boosting, in DataFrame operations only.

High-recall patterns propose spans for each kind, which may overlap. Base patterns' matches that pass their checks (octets, Luhn, numbers
of digits) always stay. The other candidates are scored by boosted trees over format and context features; a threshold for each kind,
calibrated on held-out candidates, selects those to redact.

The trees are trained here, on sentences composed by rule from a seeded hash (no personal data exists in them): forms that people use for
addresses and numbers, and look-alikes such as order numbers, versions, dates and amounts. Their number is a parameter.

Spans come from one row's text alone: the pieces between matches and the matches, in order, give every start by prefix sums of their lengths in
code points. Nothing is shuffled.

Defined cases: a null or empty text has no span; repeated rows are scanned each; a very long text is scanned whole, in time that grows with its length;
matches of one pattern don't overlap, so there are no ties; an empty table gives an empty result; columns beside key and text are ignored,
whatever their names. Digits are ASCII digits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

#: Base patterns. Look-behinds (with \G, the end of the last match) and possessive groups change no match; they keep the search linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall patterns beyond the base ones.
WIDE = {
    "email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]{0,63}+\x20?(?:\(at\)|\[at\]|\{at\}|\x20at\x20|@)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z]{2,12}){1,3}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.-])[0-9](?:[\x20._-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:00[1-9][0-9]{0,2}[\x20.-]?|\(?0?)[0-9]{2,5}\)?[\x20./-]{1,2}[0-9]{2,4}[\x20.-]?[0-9]{2,5}(?![0-9])",
}
#: What a text must hold for a kind to be tried at all.
GATES = {"email": r"@|[(\[{\x20]at[)\]}\x20]", "ip": r"[0-9A-Fa-f][.:][0-9A-Fa-f]", "card": r"[0-9][\x20._-]?[0-9]", "phone": r"[0-9]"}
CUES = {
    "email": r"(?i)(mail|contact|write|reach|address)",
    "ip": r"(?i)(\bip|host|server|client|login)",
    "card": r"(?i)(card|visa|payment|credit|iban|account)",
    "phone": r"(?i)(call|tel|phone|fax|mobile|ring)",
}
ANTI_CUES = r"(?i)(order|version|invoice|isbn|part|serial|ticket|page|total|room|build|no\.|id)[^a-z]*$"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        double = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def base_valid(kind: str, body: Column) -> Column:
    """The checks that a base match has to pass."""
    if kind == "ip":
        parts = F.transform(F.split(body, r"\.", -1), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        d = _digits(body)
        return F.when((F.length(d) >= 16) & (F.length(d) <= 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(body)).between(8, 15)
    return F.lit(True)


def _count(s: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(s, f"[^{chars}]", ""))


FEATURES = ("length", "digits", "letters", "spaces", "dots", "dashes", "brackets", "at", "parts", "leading_zeros", "cue", "anti_cue", "money", "joined", "luhn")


def features(kind: str, c: Column) -> Column:
    """FEATURES of a candidate struct as an array of doubles."""
    body, before, after = c["body"], c["before"], c["after"]
    digits = _digits(body)
    values = (
        F.length(body), F.length(digits), _count(body, "A-Za-z"), _count(body, r"\x20"), _count(body, "."), _count(body, r"\-/"), _count(body, r"()\[\]{}"), _count(body, "@"),
        F.size(F.split(body, "[^0-9A-Za-z]+", -1)), F.length(F.regexp_extract(body, r"^\(?(0{0,2})", 1)), before.rlike(CUES[kind]), before.rlike(ANTI_CUES),
        before.rlike(r"[$€£#]\x20?$") | after.rlike(r"^\x20?(?:[$€£%]|[.,][0-9])"), before.rlike("[A-Za-z0-9_=/]$") | after.rlike("^[A-Za-z0-9_=]"),
        F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False),
    )
    return F.array(*[v.cast("double") for v in values])


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _sums_before(values: Column, levels: int = 2, block: int = 64) -> Column:
    """For each element the sum of those before it: the sum before its block, found in the same way from the blocks' sums, and that inside the block."""
    each = F.sequence(F.lit(0), F.size(values) - 1)
    if not levels:
        return F.transform(each, lambda i: _total(F.slice(values, F.lit(1), i)))
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
    sums = F.transform(blocks, lambda b: _total(F.slice(values, b * block + 1, F.lit(block))))
    inside = lambda i: _total(F.slice(values, i - i % block + 1, i % block))
    return _let(sums, lambda s: _let(_sums_before(s, levels - 1), lambda before: F.transform(each, lambda i: F.get(before, F.floor(i / block).cast("int")) + inside(i))))


def spans(pieces: Column, hits: Column) -> Column:
    """Array of structs start, end, body, before, after of a pattern's matches, from the pieces between them and the matches, in linear time."""
    each = F.sequence(F.lit(0), F.size(hits) - 1)
    steps = F.transform(each, lambda i: F.length(F.get(pieces, i)) + F.length(F.get(hits, i)))

    def one(i: Column, before: Column) -> Column:
        body = F.get(hits, i)
        start = F.get(before, i) + F.length(F.get(pieces, i))
        return F.struct(
            start.alias("start"), (start + F.length(body)).alias("end"), body.alias("body"),
            F.right(F.get(pieces, i), F.lit(32)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(8)).alias("after"),
        )

    found = _let(steps, lambda s: _let(_sums_before(s), lambda before: F.transform(each, lambda i: one(i, before))))
    return F.when(F.size(hits) > 0, found).otherwise(F.lit(None))


def _first_from(items: Column, limit: Column) -> Column:
    """How many of the items, which are in order and don't overlap, start before a limit, by bisection."""
    ends = F.struct(F.lit(0).alias("lo"), F.size(items).alias("hi"))

    def halve(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        less = (at["lo"] < at["hi"]) & (F.get(items, mid)["start"] < limit)
        return F.when(at["lo"] >= at["hi"], at).when(less, F.struct((mid + 1).alias("lo"), at["hi"].alias("hi"))).otherwise(F.struct(at["lo"].alias("lo"), mid.alias("hi")))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(items) + 1)).cast("int"))
    return F.aggregate(rounds, ends, halve)["lo"]


def candidates(docs: DataFrame, key: str, text: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """key, extra columns, and base_<kind> and wide_<kind>: arrays of candidate structs, null where there is none."""
    t = F.col("_text")
    out = docs.select(F.col(key).alias("_key"), *[F.col(x) for x in extra], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    out = out.withColumns({f"_gate_{k}": t.rlike(GATES[k]) for k in KINDS})
    made = {}
    for group, patterns in (("base", BASE), ("wide", WIDE)):
        for k in KINDS:
            made[f"_h_{group}_{k}"] = F.when(F.col(f"_gate_{k}"), F.regexp_extract_all(t, F.lit(patterns[k]), F.lit(0)))
    out = out.withColumns(made)
    pieces = {}
    for group, patterns in (("base", BASE), ("wide", WIDE)):
        for k in KINDS:
            pieces[f"_p_{group}_{k}"] = F.when(F.size(f"_h_{group}_{k}") > 0, F.split(t, patterns[k], -1))
    out = out.withColumns(pieces)
    found = {f"{group}_{k}": F.when(F.col(f"_p_{group}_{k}").isNotNull(), spans(F.col(f"_p_{group}_{k}"), F.col(f"_h_{group}_{k}"))) for group in ("base", "wide") for k in KINDS}
    return out.select("_key", *extra, *[v.alias(n) for n, v in found.items()])


# --- boosted trees


@dataclass(frozen=True)
class Node:
    feature: int
    limit: float
    low: object
    high: object


def _leaf(grad: np.ndarray, hess: np.ndarray, shrink: float) -> float:
    return float(-shrink * grad.sum() / (hess.sum() + 1.0))


def _grow(x, grad, hess, depth, shrink):
    """A regression tree on gradients; splits by the usual second-order gain."""
    if depth == 0 or len(x) < 8:
        return _leaf(grad, hess, shrink)
    score = lambda g, h: g * g / (h + 1.0)
    best, whole = (1e-3, None, None), score(grad.sum(), hess.sum())
    for j in range(x.shape[1]):
        for limit in np.unique(np.quantile(x[:, j], np.linspace(0.05, 0.95, 13), method="lower")):
            low = x[:, j] <= limit
            if 0 < low.sum() < len(x):
                gain = score(grad[low].sum(), hess[low].sum()) + score(grad[~low].sum(), hess[~low].sum()) - whole
                if gain > best[0]:
                    best = (gain, j, float(limit))
    _, j, limit = best
    if j is None:
        return _leaf(grad, hess, shrink)
    low = x[:, j] <= limit
    return Node(j, limit, _grow(x[low], grad[low], hess[low], depth - 1, shrink), _grow(x[~low], grad[~low], hess[~low], depth - 1, shrink))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Node):
        return np.full(len(x), tree)
    low = x[:, tree.feature] <= tree.limit
    out = np.empty(len(x))
    out[low], out[~low] = _value(tree.low, x[low]), _value(tree.high, x[~low])
    return out


@dataclass(frozen=True)
class Model:
    """For each kind: trees and the probability from which a candidate is redacted."""

    trees: dict
    thresholds: dict

    def score(self, kind: str, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-sum(_value(t, x) for t in self.trees[kind])))

    def column(self, kind: str, values: Column) -> Column:
        """The score as a column of an array of features."""

        def of(tree) -> Column:
            return F.when(F.get(values, F.lit(tree.feature)) <= tree.limit, of(tree.low)).otherwise(of(tree.high)) if isinstance(tree, Node) else F.lit(tree)

        total = F.lit(0.0)
        for t in self.trees[kind]:
            total = total + of(t)
        return 1 / (1 + F.exp(-total))


#: Sentences for training, by kind: (label, form). In a form 0 is a random digit, 9 one from 1 to 9, Z the digit zero, X a random hexadecimal digit, W a random word.
FORMS = {
    "email": [
        (1, "write to W.W (at) W.com today"), (1, "mail W [at] W [dot] org"), (1, "contact: W00 at W dot net"), (1, "reach me, W_W @ W.com, soon"),
        (1, "W00 {at} W.org is the address"), (1, "questions to W at W dot de"), (1, "W.W @ W dot com for more"),
        (0, "we met at W. then"), (0, "look at W. W came"), (0, "she was at W dot"), (0, "sold 900 @ 9.00 each"), (0, "the W at W. W is"), (0, "stayed at W. and"),
    ],
    "ip": [
        (1, "client ip XXXX:XXXX:XXXX:XXXX:XXXX:XXXX:XXXX:XXXX logged in"), (1, "host XXXX:XX:XXX:XXXX:X:XXXX seen"), (1, "server at XXXX:XXXX:X:X:XXX:XXXX up"),
        (0, "took 00:00:00:00:00:00 in total"), (0, "serial XX:XX:XX:XX:XX:XX printed"), (0, "build 0:0:0:0:0:0 of it"), (0, "ratio 9:9:9:9:9:9 here"),
    ],
    "card": [
        (1, "card 9000.0000.0000.0000 expires"), (1, "my visa 9000_0000_0000_0000 ok"), (1, "payment by 9000 0000 0000 000 card"), (1, "credit card 90000000000000000 on file"),
        (0, "order 900000000000000 shipped"), (0, "serial number 0000-0000-0000-0"), (0, "isbn 000-0-00-000000-0 printed"), (0, "total 0.00 0.00 0.00 0.00 0.00"), (0, "invoice id 90000000000000000 paid"), (0, "seen 90000000000000 times"),
    ],
    "phone": [
        (1, "call (900) 900-0000 now"), (1, "tel. Z900/000000 or so"), (1, "phone 900-900-0000 any time"), (1, "fax ZZ90 90 000000 only"), (1, "my mobile is Z900 00000000"),
        (0, "on 0000-00-00 we"), (0, "order 0000-0000-0000 came"), (0, "version 90.00.0000 is"), (0, "pages 000-0000 of it"), (0, "room 000-000"), (0, "total 900.000 0000 units"), (0, "in 9000-0000 and"), (0, "part no. 90-00000"),
    ],
}


def composed(spark: SparkSession, forms: list[tuple[int, str]], rows: int, seed: int) -> DataFrame:
    """id, text, label: sentences from the forms; every random choice is a hash of seed, row and place."""
    pick = lambda i, n: F.pmod(F.xxhash64(F.lit(seed), "id", i), F.lit(n)).cast("int")
    chosen = F.get(F.array(*[F.struct(F.lit(t).alias("form"), F.lit(y).alias("label")) for y, t in forms]), pick(F.lit(-1), len(forms)))
    letters = F.lit("bcdfglmnprstvaeiou")
    word = lambda i: F.left(F.concat(*[F.substring(letters, pick(i * 16 + j + 10_000, 18) + 1, F.lit(1)) for j in range(9)]), pick(i + 5_000, 8) + 2)

    def fill(i: Column) -> Column:
        ch = F.substring(F.col("form"), i, F.lit(1))
        return (
            F.when(ch == "W", word(i)).when(ch == "0", pick(i, 10).cast("string")).when(ch == "9", (pick(i, 9) + 1).cast("string"))
            .when(ch == "X", F.lower(F.hex(pick(i, 16).cast("long")))).when(ch == "Z", F.lit("0")).otherwise(ch)
        )

    rows_of = spark.range(rows).withColumn("chosen", chosen).select("id", "chosen.form", "chosen.label")
    return rows_of.select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.length("form")), fill), "").alias("text"), "label")


def train(spark: SparkSession, rows: int = 3000, trees: int = 24, depth: int = 3, shrink: float = 0.3, precision: float = 0.97, seed: int = 11) -> Model:
    """Trees from `rows` composed sentences of each kind. Half of the candidates fit, the other half calibrates: the threshold is the lowest with the wanted precision."""
    grown, limits = {}, {}
    for kind in KINDS:
        found = candidates(composed(spark, FORMS[kind], rows, seed), "id", "text", ("label",)).select("_key", "label", F.explode(f"wide_{kind}").alias("c"))
        got = found.select("_key", F.col("label").cast("double").alias("y"), features(kind, F.col("c")).alias("x")).orderBy("_key").collect()
        x, y, held = np.array([r[2] for r in got], float), np.array([r[1] for r in got]), np.array([r[0] % 2 == 0 for r in got])
        fit, total, steps = ~held, np.zeros(len(y)), []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            steps.append(_grow(x[fit], (p - y)[fit], (p * (1 - p))[fit], depth, shrink))
            total += _value(steps[-1], x)
        p, limits[kind] = 1 / (1 + np.exp(-total[held])), 1.0
        for limit in np.unique(p)[::-1]:
            if y[held][p >= limit].mean() < precision:
                break
            limits[kind] = float(limit)
        grown[kind] = tuple(steps)
    return Model(grown, limits)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """key, base and spans: arrays of structs (kind, start, end, score), base ones with score 1; ordered by kind as in KINDS, then start."""
    model = model or train(docs.sparkSession)
    found = candidates(docs, key, text)
    kind_type = "array<struct<kind:string,start:int,end:int,score:double>>"

    def plain(kind: str, c: Column, score: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), score.alias("score"))

    none = F.array().cast(kind_type)

    def base(kind: str) -> Column:
        good = F.filter(f"base_{kind}", lambda c: base_valid(kind, c["body"]))
        return F.coalesce(F.transform(good, lambda c: plain(kind, c, F.lit(1.0))), none)

    def every(kind: str) -> Column:
        """The base spans and the candidates that overlap none of them and score enough."""
        own = F.col(f"_b_{kind}")
        last = lambda c: F.get(own, _first_from(own, c["end"]) - 1)
        fresh = F.when(F.size(own) == 0, F.col(f"wide_{kind}")).otherwise(F.filter(f"wide_{kind}", lambda c: F.coalesce(last(c)["end"] <= c["start"], F.lit(True))))
        described = F.transform(fresh, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), features(kind, c).alias("f")))
        scored = F.transform(described, lambda c: plain(kind, c, model.column(kind, c["f"])))
        kept = F.filter(scored, lambda c: c["score"] >= model.thresholds[kind])
        return F.when(F.col(f"wide_{kind}").isNull(), own).otherwise(F.array_sort(F.concat(own, kept), lambda a, b: a["start"] - b["start"]))

    found = found.withColumns({f"_b_{k}": base(k) for k in KINDS})
    found = found.withColumns({f"_m_{k}": every(k) for k in KINDS})
    return found.select(F.col("_key").alias(key), F.concat(*[F.col(f"_b_{k}") for k in KINDS]).alias("base"), F.concat(*[F.col(f"_m_{k}") for k in KINDS]).alias("spans"))
