import random

import pytest
from cases import SCHEMA, documents, lines, lower_ascii, prose, sha, space_words

from pagelens.llm import linededup, queries


def variants(seed, n):
    r, base = random.Random(seed), prose(30, seed).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "".join(r.choice("klmnop") for _ in range(5))
        out.append(" ".join(w))
    return out


EXTRA = [
    *["\n".join([prose(6, i), v, "Shared footer of the site, all rights", prose(3, i)]) for i, v in enumerate(variants(50, 30))],
    *["\n".join(variants(51, 12)), "a b c d e\nb c d e f\na b c d e f\na b c d\nA B  C D E", "x\n\nx\ny", lines(40, 8)],
    "\n" + "Shared footer of the site, all rights" + "\r\n",
]


def tokens(line):
    return frozenset(space_words(lower_ascii(line)))


def expected(rows, percent=80):
    seen, out = [], {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        if t is None:
            out[i] = (0, 0, None)
            continue
        kept, ls = [], t.split("\n")
        for line in ls:
            s = tokens(line)
            if not s or not any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                kept.append(line)
            if s:
                seen.append(s)
        out[i] = (len(ls), len(ls) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize(("block", "frequent", "small"), [(2048, 1_000_000, 512), (5, 20, 512), (2048, 1_000_000, 3)])
def test_lines(spark, monkeypatch, block, frequent, small):
    """With small groups of 3 and blocks of 10, groups larger than a block pass on to be cut."""
    monkeypatch.setattr(linededup, "BLOCK_RECORDS", block)
    monkeypatch.setattr(linededup, "SMALL_GROUP", small)
    monkeypatch.setattr(linededup, "FREQUENT", frequent)
    monkeypatch.setattr(linededup, "FREQUENT_BLOCK", 10)
    rows = documents(EXTRA)
    got = linededup.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), counts=True).collect()
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        n, gone, text = want[r.doc_id]
        assert (r.n_lines, r.n_removed, r.text) == (n, gone, text), r.doc_id


def test_columns_emptied_documents_and_empty_tables(spark):
    rows = documents(EXTRA)
    docs = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_removed long")
    got = linededup.dedup(docs, drop_emptied=True)
    assert got.columns == docs.columns
    want = expected(rows)
    assert {r.doc_id for r in got.collect()} == {i for i, (_, gone, t) in want.items() if not gone or space_words(t)}
    assert linededup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, tmp_path):
    rows = documents(EXTRA)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = expected(rows)
    for r in queries.op2_line_dedup(spark, str(tmp_path)).collect():
        n, gone, text = want[r.doc_id]
        assert (r.n_lines, r.n_removed, r.text_sha256) == (n, gone, sha(text or ""))


def test_repeated_keys_rows_and_clashing_columns(spark):
    a, b = "\n".join([prose(9, 1), prose(9, 2)]), "\n".join([prose(9, 3), prose(9, 1), prose(9, 4)])
    rows = [(1, a, 1, 2, 3, 4, 5), (1, b, 1, 2, 3, 4, 5), (1, b, 1, 2, 3, 4, 6), (2, a + "\n" + prose(9, 5), 1, 2, 3, 4, 5), (None, prose(9, 5), 1, 2, 3, 4, 5), (None, None, 1, 2, 3, 4, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int, _lines int, n_lines int, n_removed int, th int")
    assert linededup.dedup(docs).columns == docs.columns
    got = linededup.dedup(docs, counts=True)
    assert got.columns == ["doc_id", "text", "_key", "_lines", "th", "n_lines", "n_removed"]
    got = got.collect()
    assert sorted(r.n_removed for r in got if r.doc_id == 2) == [3]  # the last line equals that of the row without a key, which comes first
    assert [(r.n_lines, r.n_removed, r.text) for r in got if r.doc_id is None and r.text is None] == [(0, 0, None)]
    one = {r.text for r in got if r.doc_id == 1}
    assert len([r for r in got if r.doc_id == 1]) == 3 and len(one) == 2  # equal rows lose the same lines
    assert sum(t.split("\n").count(prose(9, 1)) for t in one) == 1


def test_tokens_that_share_rank_and_hash_bits_count_each():
    import numpy as np

    hashes = np.array([7 << 32 | 5, 7 << 32 | 9, 7 << 32 | 5, 3 << 32], np.uint64)
    ids, bounds = linededup.ranked(hashes, np.array([0, 4]), np.zeros(linededup.RARITY_BUCKETS, np.uint16))
    assert bounds.tolist() == [0, 3] and ids.tolist() == [3, 7, 7]


def test_a_large_group_of_one_token_is_passed_on_in_blocks():
    import time

    import numpy as np
    import pyarrow as pa

    m = 100_000
    n = np.sort(np.random.default_rng(1).integers(1, 400, m))
    token, set_, pos = np.full(m, 77, np.uint64), np.arange(m, dtype=np.uint64) * np.uint64(7919) + np.uint64(1), np.zeros(m, np.int64)
    sig = np.random.default_rng(2).integers(0, 1 << 62, (m, linededup._SIG_WORDS)).astype(np.uint64)
    sig[np.arange(linededup._SIG_WORDS) >= linededup._widths(n)[:, None]] = 0
    blob = linededup._pack(token, set_, sig, n, pos)
    began = time.process_time()
    out = linededup._meet(80)(pa.table({"part": pa.array([0]), "records": pa.array([blob], pa.binary())}))
    assert time.process_time() - began < 5 and out.num_rows == -(-m // linededup.FREQUENT_BLOCK) and out.column("a").null_count == out.num_rows
    back = [np.concatenate(x) for x in zip(*[linededup._unpack(b.as_py()) for b in out.column("records")], strict=True)]
    order = np.argsort(back[1])
    assert np.array_equal(back[1][order], np.sort(set_)) and np.array_equal(back[2][order], n[np.argsort(set_)])
    assert len(back[4]) == linededup._widths(n).sum()


def test_block_hashes_tell_words_apart():
    import numpy as np

    from pagelens.llm import text as X

    words = [b"a", b"a\0", b"\0", b"abcdefgh", b"abcdefgh\0", b"abcdefghi", b"x" * 64, b"x" * 65, b"x" * 63 + b"\0", b"ABC", b"abc", "zwölf".encode(), b"q" * 1000, b"q" * 999 + b"r", b""]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    plain, lower = X.block_hashes(data, starts, ends), X.block_hashes(data, starts, ends, lower=True)
    assert len(set(plain.tolist())) == len(words) and len(set(lower.tolist())) == len(words) - 1 and lower[9] == lower[10]
    again = np.frombuffer(b"--" + b" ".join(words), np.uint8)
    at = 2 + np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])[:-1]])
    assert np.array_equal(X.block_hashes(again, at, at + (ends - starts)), plain)
