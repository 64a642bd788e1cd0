from collections import Counter

from cases import SCHEMA, prose

from pagelens.llm import neardup


def test_rows_with_null_keys_stay(spark):
    a, b, c = prose(40, 1), prose(40, 2), prose(40, 3)
    rows = [(i, t, "en", "test", len(t)) for i, t in [(None, a), (None, b), (1, c), (1, c)]]
    got = neardup.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(None, a), (None, b), (1, c)])


def test_rows_that_share_a_key_only_are_nodes_of_their_own(spark):
    a, b, odd = prose(300, 1), prose(300, 2), prose(40, 3)
    rows = [(1, a), (1, b), (2, b + " word"), (3, a + " word"), (9, odd), (9, odd), (None, odd), (None, odd + " more")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, id int, node int, least int")
    got = Counter((r.doc_id, r.component_id) for r in neardup.classes(docs).collect())
    assert got == Counter([(1, 1), (1, 1), (2, 1), (3, 1), (9, 9), (9, 9), (None, 9), (None, 9)])
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 1, 9, None, None])
