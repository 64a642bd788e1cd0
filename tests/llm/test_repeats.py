from collections import Counter

import numpy as np
import pytest
from cases import BASE, SCHEMA, documents, prose, sha

from pagelens.llm import groups, queries, repeats, suffixes

P = prose(60, 201)
EXTRA = [
    "head " + P + " tail",
    P[:250] + "X" + P[251:],
    "é" * 150 + P[100:310],
    "zzz" + P[50:249] + "q",
    "zzz" + P[50:250] + "q",
    "ab" * 400,
    "Q" * 199,
    "Q" * 200,
    prose(50, 202) + BASE[200:450] + prose(50, 203) + BASE[100:380],
    *[prose(10, 300 + i) + P[i : i + 205 + i] + prose(5, 400 + i) for i in range(25)],
]


def expected(rows, n=200):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(d[s : s + n] for _, d in data for s in range(len(d) - n + 1))
    out = {}
    for i, d in data:
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - n + 1):
            if seen[d[s : s + n]] > 1:
                gone[s : s + n] = True
        left = bytes(b for b, g in zip(d, gone) if not g)
        out[i] = (len(d), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), sha(left))
    return out


@pytest.mark.parametrize("mode", ["plain", "blocks", "pieces"])
def test_repeats(spark, monkeypatch, mode):
    if mode == "blocks":
        monkeypatch.setattr(repeats, "MOST_VARIANTS", 3)
        monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
        monkeypatch.setattr(groups, "HOT_ROWS", 4)
    if mode == "pieces":
        monkeypatch.setattr(repeats, "PIECE", 300)
    rows = documents(EXTRA)
    got = repeats.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert sha(bytes(r.kept)) == r.kept_sha256


def test_query_and_empty_table(spark, tmp_path):
    rows = documents(EXTRA)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = expected(rows)
    for r in queries.op6_suffix_dedup(spark, str(tmp_path)).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert repeats.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("cap", [3, 255, 1000])
@pytest.mark.parametrize("memory", [96, 640, 1 << 20])
def test_suffix_order_and_common_prefixes(cap, memory):
    r = np.random.default_rng(0)
    for trial in range(60):
        t = r.integers(1, r.integers(1, 5) + 1, r.integers(0, 70))
        t = np.append(np.tile(t, 4) if trial % 3 == 0 else t, 0)
        got, common = suffixes.order(t, cap, memory)
        l = t.tolist()
        want = sorted(range(len(l)), key=lambda i: l[i:])
        assert got.tolist() == want
        for i in range(1, len(l)):
            a, b = l[want[i - 1] :], l[want[i] :]
            k = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert common[i] == min(k, cap)


def test_shards_are_larger_than_the_queues_memory(monkeypatch):
    spills = []
    monkeypatch.setattr(suffixes.Queue, "spill", lambda self, spill=suffixes.Queue.spill: (spills.append(self.bytes), spill(self))[1])
    data = np.frombuffer((prose(50_000, 1) + prose(1000, 2) * 2).encode()[: 1 << 18], np.uint8).astype(np.int16) + 1
    t = np.append(data, 0)
    small, values = suffixes.order(t, 200, 1 << 14)
    assert len(spills) > 20 and len(t) * 18 > 100 * (1 << 14)
    large, same = suffixes.order(t, 200, 1 << 26)
    assert (small == large).all() and (values == same).all()
    raw = t.astype(">i2").tobytes()
    for i in range(1, len(t), 97):
        assert raw[2 * int(small[i - 1]) :] < raw[2 * int(small[i]) :]
    del spills[:]
    whole = np.append(np.random.default_rng(2).integers(1, 200, repeats.SHARD_BYTES).astype(np.int16), 0)
    found, _ = suffixes.order(whole, 200)
    assert spills and (np.sort(found) == np.arange(len(whole))).all()  # a shard of the default size spills at the default bound


@pytest.mark.parametrize("length", [5, 64, 300])
def test_lengths_repeated_keys_and_null_keys(spark, length):
    a, b, c = prose(90, 1), prose(90, 2), prose(90, 3)
    rows = [(1, a + b[:40], 0), (1, b, 0), (2, a, 0), (None, c, 0), (3, "xy" + c, 0), (4, b, 0), (4, b, 0), (None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gram int")
    want = expected([(i, t) for i, (_, t, _) in enumerate(rows)], length)
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.dedup(docs, length=length).collect()))
    assert got == sorted((rows[i][0] or 0, *want[i]) for i in want)
