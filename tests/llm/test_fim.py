import hashlib
import re

import pytest
from cases import SCHEMA, documents, prose, sha

from pagelens.llm import fim, queries

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
EXTRA = ["with <P> inside", "<S>", "almost <M", "<P", "> ends", "tail spaces   \n", "\n lead", "🙂 🙂é x", "a" * 1_500_000, "word " * 400_000]


def plain(key, text, seed=42, rate=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    x = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows():
    docs = documents(EXTRA)
    return [*docs, docs[0], docs[5], (None, prose(50, 4), None, None, None), (None, None, None, None, None), *((10_000 + i, prose(i % 7, i), "en", "s", 1) for i in range(200))]


def test_equal_to_plain_definition_and_restored(spark):
    docs = rows()
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    cut = fim.transform(frame)
    got = cut.withColumn("back", fim.restored(cut.output, cut.form)).collect()
    want = sorted((r[0] is None, r[0] or 0, r[1] or "", *plain(r[0], r[1])) for r in docs)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.back, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)
    assert sorted(map(key, got)) == want
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_query_columns(spark, tmp_path):
    docs = rows()
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_fill_in_middle(spark, str(tmp_path)).collect()
    want = [(r[0], *(p := plain(r[0], r[1]))[:4], sha(p[4]), sha(r[1] or "")) for r in docs]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_parameters_empty_tables_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "one two three", 5, "x")], "n long, output string, key long, form string")
    (r,) = fim.transform(frame, "n", "output", rate=100, spm=0, marks=("[pre]", "[suf]", "[mid]")).toDF("id", "n", "form", "p", "m", "output").collect()
    assert r.form == "psm" and r.output.startswith("[pre]") and r.output.replace("[pre]", "").count("[") == 2
    assert fim.transform(spark.createDataFrame([], SCHEMA)).count() == 0
    for marks in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("<P>", "P", "<M>"), ("ab", "bc", "<M>")):
        with pytest.raises(ValueError):
            fim.check(marks)
    fim.check(fim.MARKS)
