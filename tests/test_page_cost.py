"""Searches of pages are spared where a plain part is missing, and find the same as without that."""

import re
import time

from pyspark.sql import functions as F

from pagelens.functions import contact, detect


def test_plain_parts_belong_to_their_patterns():
    known = {
        r"static\.hotjar\.com/c/hotjar-": "static.hotjar.com/c/hotjar-", r"oxy-[a-z]+-\d+": "oxy-", "elementor-(?:frontend|pro)": "elementor-", r"(?-i)ttq\.load\(['\"][A-Z0-9]+": "ttq.load(", "mouseflow.*?apikey": "mouseflow",
        r"tr\?id=": "tr?id=", r"""gtag\(['"]config['"],\s*['"]G-[A-Z0-9]+""": "config", "[a-z]+": "", "ab?c": "a",
    }
    for pattern, part in known.items():
        assert detect.fixed_part(pattern) in (part, "c" if pattern == "ab?c" else part)
    for _, _, patterns, *_ in detect.FINGERPRINTS:
        for p in patterns:
            part = detect.fixed_part(p)
            assert len(part) > 3 and part in re.sub(r"\\(.)", r"\1", p).lower()


def test_written_out_addresses_as_without_the_first_look(spark):
    texts = ["max [at] haus [dot] at", "max at haus.at", "max at haus", "A (ÄT) b {punkt} c", "x[ at ]y(dot)z at q.at", "a\u00a0at\u00a0b.wien", "plain", "", "wat (dot", "a (dot) b", "ſ at k.at", "a &#64; b&#46;c", None]
    s, w = "[\\s\u00a0\ufeff]", "[A-Za-z0-9_]"

    def plain(t):
        t = re.sub(r"(?i)&#46;|&#x2e;", ".", re.sub("(?i)&#64;|&#x40;", "@", t))
        for _ in range(3):
            t = re.sub(rf"(?i)({w}){s}*[\[({{]{s}*(?:at|ät|æt){s}*[\])}}]{s}*({w})", r"\1@\2", t)
            t = re.sub(rf"(?i)({w}){s}*[\[({{]{s}*(?:dot|punkt){s}*[\])}}]{s}*({w})", r"\1.\2", t)
            t = re.sub(rf"(?i)({w}+){s}+(?:at|ät){s}+({w}[A-Za-z0-9_.-]*\.[A-Za-z]{{2,}})", r"\1@\2", t)
        return t

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.o for r in df.select("i", contact.deobfuscated(F.col("t")).alias("o")).orderBy("i").collect()]
    assert got == [None if t is None else plain(t) for t in texts]


def test_texts_without_written_out_addresses_cost_little(spark):
    long = "Gasthaus Huber in der Hauptgasse, offen von Montag bis Freitag. " * 400

    def seconds(text: str) -> float:
        df = spark.range(64).repartition(4).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t")).select(contact.deobfuscated(F.col("t")))
        df.write.format("noop").mode("overwrite").save()
        began = time.time()
        df.write.format("noop").mode("overwrite").save()
        return time.time() - began

    assert seconds(long) * 2 < seconds(long + " max [at] haus ")
