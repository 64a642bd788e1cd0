import re

import pytest
from cases import SCHEMA, documents, sha

from pagelens.llm import pii, queries

EXTRA = [
    "mail a.b+c@ex-ample.co.uk, x@y (no) x@y.z. a@b.c_x@d.e.f @no.de é@é.de",
    "ips 1.2.3.4 999.1.1.1 1.2.3.4.5 01.002.0003.255 1.2.3.256 000000000000000000001.1.1.1 1..2.3.4",
    "cards 4539 1488 0343 6467 4539148803436467 4539-1488-0343-6467 4539148803436468 1234567 49927398716 4539  1488 0343 6467 00000000000000000000",
    "phones +1 (988) 555-2485 and +49 30 1234567, +1234567 +12345678 +1234567890123456 +1..... ++49(0)30-12345678",
    "🙂 x@y.zz 🙂🙂 +43 1 234 56 78 😀1.1.1.1",
    "9" * 5000,
    "1.1.1.1 " * 700,
    "a" * 5000 + "@" + "b.c" * 3,
    "call (988) 555-2485 or mail jim (at) example.com; order 123456789012345, version 10.20.3000",
    "+1234567812345678 4111111111111111",
]


def old_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def expected(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and old_luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark, rows=800, trees=10)


def test_base_spans(spark, model):
    rows = documents(EXTRA)
    got = pii.find(spark.createDataFrame(rows, SCHEMA), model=model).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        want = expected(texts[r.doc_id])
        assert [(s.kind, s.start, s.end) for s in r.base] == want, texts[r.doc_id]
        all_spans = [(s.kind, s.start, s.end) for s in r.spans]
        assert set(want) <= set(all_spans)
        assert all_spans == sorted(all_spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


def test_model_adds_what_looks_personal(spark, model):
    text = EXTRA[8]
    (r,) = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), model=model).collect()
    found = {text[s.start : s.end] for s in r.spans}
    assert any("988" in f for f in found) and any("jim" in f for f in found)
    assert not any("12345678901" in f or "3000" in f for f in found)


def test_query_and_empty_table(spark, tmp_path, monkeypatch, model):
    monkeypatch.setattr(pii, "train", lambda *_: model)
    rows = documents(EXTRA)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r[0]: r[1] for r in rows}
    for r in queries.op1_pii(spark, str(tmp_path)).collect():
        want = expected(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want))
    assert pii.find(spark.createDataFrame([], SCHEMA), model=model).count() == 0


#: Sentences in forms that the training never sees.
HELD_OUT = {
    "email": [(1, "my mail is W.W {at} W.com ok"), (1, "send it to W-W@ W dot org please"), (1, "ask W00W (at) W (dot) net"), (0, "they sat at W. Then"), (0, "900 W @ 90.00 per unit"), (0, "arrived at W. org charts")],
    "ip": [(1, "login from XXXX:XXXX:XXXX:XXXX:XXXX:XXXX:XXXX:XXXX failed"), (1, "the server XXXX:XXX:XXXX:XX:XXXX:XXXX answered"), (0, "clock 00:00:00:00:00:00 stopped"), (0, "mac serial XX:XX:XX:XX:XX:XX label")],
    "card": [(1, "paid by card 9000.0000.0000.0000 yesterday"), (1, "charge my visa 9000 0000 0000 000 please"), (0, "ticket 900000000000000 closed"), (0, "part no. 0000-0000-0000-0 in stock"), (0, "isbn 900-0-00-000000-0 sold")],
    "phone": [(1, "ring me on (900) 900-0000 later"), (1, "mobile Z900/0000000 works"), (1, "telephone 900 900 0000 daily"), (0, "dated 0000-00-00 and"), (0, "serial 0000-0000-0000 of"), (0, "invoice 90-00000 sent"), (0, "build 90.00.0000 out")],
}


@pytest.mark.parametrize(("kind", "recall", "precision"), [("email", 0.6, 0.8), ("ip", 0.9, 0.9), ("card", 0.5, 0.7), ("phone", 0.8, 0.7)])
def test_recall_and_precision_on_held_out_forms(spark, model, kind, recall, precision):
    docs = pii.composed(spark, HELD_OUT[kind], 400, 77).withColumnRenamed("id", "doc_id")
    label = {r.doc_id: r.label for r in docs.collect()}
    hit = {r.doc_id for r in pii.find(docs, model=model).collect() if any(s.kind == kind for s in r.spans)}
    good = sum(label[i] for i in hit)
    print(kind, "recall", good / sum(label.values()), "precision", good / max(len(hit), 1))
    assert good >= recall * sum(label.values()) and good >= precision * len(hit)


def test_dense_texts_take_linear_time(spark, model):
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, "call 0900/123456 or 1.1.1.1, " * n)], "doc_id long, text string")
        began = time.time()
        (r,) = pii.find(docs, model=model).collect()
        assert len(r.base) == n and r.spans[-1].end <= 29 * n
        assert [s.start for s in r.base] == [20 + 29 * i for i in range(n)]
        return time.time() - began

    seconds(10)
    a, b = seconds(2000), seconds(16000)
    assert b < 30 * max(a, 0.3)
