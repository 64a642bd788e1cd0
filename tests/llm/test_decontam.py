from cases import SCHEMA, alnum_words, documents, prose, sha

from pagelens.llm import decontam, queries

ITEMS = [(0, prose(30, 100)), (1, prose(12, 101)), (2, "The of and The of and the of and the of"), (3, "Two words"), (4, "solo"), (5, None), (6, " ... "), (7, prose(30, 100)), (10, prose(9, 102)), (11, "a b c")]
EXTRA = [
    "start " + ITEMS[0][1] + " end " + ITEMS[0][1].upper(),
    " ".join(ITEMS[0][1].split()[5:16]) + " x " + " ".join(ITEMS[0][1].split()[3:12]),
    ITEMS[1][1].replace(" ", " - "),
    "of the of and the of and the of and the of and the of and the of",
    "here two words there, solo and TWO-WORDS",
    prose(9, 102) + " and more",
    prose(8, 102),
    "a b c a b c",
    ITEMS[0][1] + "é",
]


def expected(t, items):
    w, hit, found = alnum_words(t), set(), set()
    for i, it in items:
        iw = alnum_words(it)
        n = min(10, len(iw))
        for s in range(len(iw) - n + 1) if n else []:
            for at in range(len(w) - n + 1):
                if w[at : at + n] == iw[s : s + n]:
                    hit |= set(range(at, at + n))
                    found.add(str(i))
    return len(w), len(hit), sorted(found)


def check(spark, items):
    rows = documents(EXTRA)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = decontam.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert (r.n_words, r.n_hit, r.items) == expected(texts[r.doc_id], items), texts[r.doc_id]


def test_all_item_lengths(spark):
    check(spark, ITEMS)


def test_long_items_only(spark):
    check(spark, ITEMS[:3])


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", -1)
    check(spark, ITEMS[:4])


def test_empty_tables_and_filter(spark):
    rows = documents(EXTRA)
    docs, none = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in decontam.contamination(docs, none).collect())
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    assert decontam.contamination(spark.createDataFrame([], SCHEMA), items).count() == 0
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if not expected(r[1], ITEMS[:2])[1]}


def test_query(spark, tmp_path):
    rows = documents(EXTRA)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = {r[0]: r[1] for r in rows}
    for r in queries.op9_decontamination(spark, str(tmp_path)).collect():
        n, hit, found = expected(texts[r.doc_id], ITEMS)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), sha(",".join(found)), hit > 0)


def test_repeated_keys_and_items(spark):
    a, b = prose(30, 1), prose(30, 2)
    items = spark.createDataFrame([(1, a), (1, b), (None, prose(12, 3)), (1, a)], "item_id long, text string")
    rows = [(5, a, 1), (5, "nothing here", 1), (5, "nothing here", 1), (None, b, 1), (None, "clean words", 2), (7, prose(12, 3), 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc int")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, tuple(r.items)) for r in decontam.contamination(docs, items).collect()))
    assert got == sorted([(5, 30, 30, ("1",)), (5, 2, 0, ()), (5, 2, 0, ()), (0, 30, 30, ("1",)), (0, 2, 0, ()), (7, 12, 12, ())])
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "clean words"), (5, "nothing here"), (5, "nothing here")]
