from collections import Counter

from cases import SCHEMA, documents, space_words

from pagelens.llm import quality


def expected(t):
    w = space_words(t)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    ls = [x for x in (t or "").split("\n") if space_words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(ls) - len(set(ls)), len(hit)


def test_counts_and_base_rules(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        e = expected(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e, t
        if e[0] < 10 or 100 * e[4] > 20 * e[0]:
            assert not r.kept
        assert r.kept == (r.failed_rule is None)


def test_order_of_rules_never_changes_the_verdict(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    a = {(r.doc_id, r.kept) for r in quality.judge(docs).collect()}
    b = {(r.doc_id, r.kept) for r in quality.judge(docs, rules=quality.RULES[::-1], counts=False).collect()}
    assert a == b


def test_filter_keeps_columns_even_if_their_names_clash(spark):
    docs = spark.createDataFrame([(*r, True) for r in documents()], SCHEMA + ", kept boolean")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.judge(docs).collect() if r.kept}


def test_repeated_rows_and_empty_tables(spark):
    rows = documents()
    assert quality.judge(spark.createDataFrame(rows + rows, SCHEMA)).count() == 2 * len(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.judge(empty).count() == 0
    assert quality.keep_good(empty).count() == 0


def test_sample_orders_rules_by_rejection_per_cost():
    order = quality.estimate(["word " * 50, "a b"] * 5)
    rates = [x["rejected"] / x["seconds"] for x in order]
    assert rates == sorted(rates, reverse=True)
