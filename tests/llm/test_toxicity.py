import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, documents

from pagelens.llm import queries, toxicity
from pagelens.llm import text as X


def corpus(n=1500):
    r = random.Random(4)
    rows = []
    for i in range(n):
        w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7))) for _ in range(r.randint(5, 60))] + ["the", "of"]
        bad = i % 4 == 0
        if bad:
            w[r.randrange(len(w))] = r.choice(["zworthless", "qxstupid", "vilen" + r.choice(["er", "es", "o", "ish"])])
        rows.append((i, " ".join(w), int(bad)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tox"))
    rows = corpus()
    docs = [(i, t, "en", "s", len(t)) for i, t, _ in rows] + [(i + 100_000, *x) for i, *x in documents()]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows, docs


def test_held_out_accuracy_and_columns(spark, tables):
    at, rows, docs = tables
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, at).collect()}
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.93


def test_score_depends_on_the_text_alone(spark, tables):
    at, rows, _ = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    labels = spark.read.parquet(f"{at}/labels.parquet")
    net = toxicity.train(docs, labels, max_rows=400)
    a = {r.doc_id: r.score for r in toxicity.score(docs.repartition(5), net).collect()}
    twice = docs.selectExpr("doc_id + 1 as doc_id", "text").union(docs.selectExpr("doc_id + 1 as doc_id", "text"))
    for r in toxicity.score(twice, net).collect():
        assert abs(r.score - a[r.doc_id - 1]) < 1e-6


def test_few_or_no_labels(spark, tables):
    at, *_ = tables
    docs = spark.read.parquet(f"{at}/documents.parquet").limit(20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, none)).count() == 20
    one = spark.createDataFrame([(0, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, one)).count() == 20
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0


def test_pooling_stops_at_the_bounds_of_texts():
    net = toxicity.Network()
    texts = ["a b c", "", "d", "e f", "a b c d e f g"]
    whole = net.logits(toxicity.features(next(X.chunked(pa.array(texts)))))
    alone = [float(net.logits(toxicity.features(next(X.chunked(pa.array([t])))))[0]) for t in texts]
    assert np.allclose(whole, alone, atol=1e-5)


def test_repeated_rows_in_any_order_give_one_network(spark, tables):
    _, rows, _ = tables
    some = [(i, t, y) for i, t, y in rows[:60]]
    docs = [(i, t) for i, t, _ in some] + [some[0][:2], some[7][:2]] * 40 + [(some[3][0], "another text"), (None, "no key")]
    labels = spark.createDataFrame([(i, y) for i, _, y in some], "doc_id long, toxic int")
    nets = []
    for seed in range(3):
        random.Random(seed).shuffle(docs)
        net = toxicity.train(spark.createDataFrame(docs, "doc_id long, text string").repartition(seed + 1), labels, max_rows=50)
        nets.append(pickle.dumps(net.__dict__))
    once = toxicity.train(spark.createDataFrame(sorted(set(docs), key=repr), "doc_id long, text string"), labels, max_rows=50)
    assert nets[0] == nets[1] == nets[2] == pickle.dumps(once.__dict__)


def test_every_labelled_row_counts(spark):
    r = random.Random(6)
    rude = ["q" + "".join(r.choice("uvwxyz") for _ in range(6)) for _ in range(40)]  # each in a few rows only: a draw of 60 rows misses most
    plain = lambda: ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(12)]
    rows = [(i, " ".join([*plain(), rude[i // 2 % 40], *plain()] if i % 2 else plain() + plain()), i % 2) for i in range(1200)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, max_rows=60)
    new = spark.createDataFrame([(i, " ".join([*plain(), rude[i], *plain()])) for i in range(40)], "doc_id long, text string")
    assert sum(x.score >= 0.5 for x in toxicity.score(new, net).collect()) >= 38
    words = toxicity.features(next(X.chunked(pa.array(rude)))).word
    assert (net.word[words, 0] > 1).sum() >= 38


def test_thresholds_are_the_best_steps():
    r = np.random.default_rng(2)
    y = r.integers(0, 2, 500)
    logit = r.normal(2.0 * y, 1.0)
    counts = np.zeros((2, 2 * toxicity._MOST * toxicity._STEPS), np.int64)
    np.add.at(counts, (y, np.floor(toxicity._STEPS * (logit + toxicity._MOST)).astype(int)), 1)
    f1 = lambda at: 2 * (y[logit >= at].sum()) / ((logit >= at).sum() + y.sum())
    assert f1(toxicity._threshold(counts)) >= max(map(f1, logit)) - 0.01
    assert toxicity._threshold(counts * [[0], [1]]) == 0.0
