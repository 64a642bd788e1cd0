import random

import numpy as np
import pytest
from cases import BASE, SCHEMA, documents, lower_ascii, prose, space_words

from pagelens.llm import groups, neardup, queries


def edited(base, n, seed):
    r, w = random.Random(seed), base.split()
    for _ in range(n):
        w[r.randrange(len(w))] = "".join(r.choice("klmnop") for _ in range(6))
    return " ".join(w)


EXTRA = [edited(BASE, 1 + i % 4, i) for i in range(60)] + [edited(prose(40, 77), 1, i) for i in range(20)] + [prose(2, 5), prose(2, 5), "q w", "Q  W\n"]


def shingles(t, k):
    w = space_words(lower_ascii(t))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def expected(rows, k, percent):
    s = {i: shingles(t, k) for i, t, *_ in rows}
    up = {i: i for i in s}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(s)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s[i]), root(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent", "rows_of_block"), [(3, 85, 1024), (5, 80, 1024), (3, 85, 8)])
def test_classes(spark, monkeypatch, k, percent, rows_of_block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", rows_of_block)
    rows = documents(EXTRA)
    got = neardup.classes(spark.createDataFrame(rows, SCHEMA), params=neardup.Params(k, percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected(rows, k, percent)


def test_repeated_rows_empty_tables_and_filter(spark):
    rows = documents(EXTRA[:10])
    docs = spark.createDataFrame(rows + rows, SCHEMA)
    want = expected(rows, 5, 80)
    assert {(r.doc_id, r.component_id) for r in neardup.classes(docs).collect()} == {(i, c) for i, (_, c) in want.items()}
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})
    assert neardup.classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(1)
    for j in (0.0, 0.5, 0.9, 1.0):
        n = 4000
        common = rng.integers(0, 2**64, int(n * 2 * j / (1 + j)), dtype=np.uint64)
        sides = [np.concatenate([common, rng.integers(0, 2**64, n - len(common), dtype=np.uint64)]) for _ in range(2)]
        low = neardup.minima(np.concatenate(sides), np.array([0, n, 2 * n]))
        sig = np.frombuffer(neardup.signatures(low).tobytes(), np.uint64).reshape(2, -1)
        assert abs(neardup.estimates(sig[1:], sig[0])[0] - j) < 0.15


def test_query(spark, tmp_path):
    rows = documents(EXTRA)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = expected(rows, 3, 85)
    for r in queries.op4_minhash(spark, str(tmp_path)).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], r.doc_id == want[r.doc_id][1])


def test_repeated_rows_are_one_set_and_later_rounds_shuffle_large_groups_only(spark, monkeypatch):
    r = random.Random(8)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    rows, at = [], 0
    for size in (40, 3, 3, 3):  # near copies: one class beyond the bound of a block, three small ones
        base = words(60)
        for i in range(size):
            rows.append((at, " ".join([*base[:58], f"end{i}"])))
            at += 1
    made, sent = [], []
    members, filtered = neardup._members, groups.filtered

    def counted(docs, p):
        made.append(docs.count())
        return members(docs, p)

    def seen(df, key, bits, member):
        out = filtered(df, key, bits, member)
        if "members" in df.columns:
            sent.append((df.count(), out.count()))
        return out

    monkeypatch.setattr(neardup, "_members", counted)
    monkeypatch.setattr(groups, "filtered", seen)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 16)
    docs = spark.createDataFrame(rows * 5, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.component_id for x in neardup.classes(docs, params=neardup.Params(3, 85)).collect()}
    assert got == {i: 0 if i < 40 else 40 + (i - 40) // 3 * 3 for i in range(at)}
    assert made == [at]
    assert [(a, 40 <= b < a) for a, b in sent] == [(at, True)]
