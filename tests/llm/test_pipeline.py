import os

import public_tokenizers
from cases import SCHEMA, documents, prose, space_words
from test_decontam import ITEMS
from test_decontam import expected as leaks
from test_linededup import expected as line_expected
from test_neardup import EXTRA as NEAR
from test_neardup import expected as near_expected
from test_quality import expected as counts
from tokenizers import Tokenizer

import corpus_pipeline
from pagelens.llm import quality, shared


def test_every_stage_against_plain_python(spark, tmp_path):
    clean = [prose(40, 900 + i) for i in range(10)]
    rows = documents([*NEAR[:20], *clean, clean[0], clean[1] + "\n" + clean[2], ITEMS[0][1] + " and more words here", "junk # $ % & *" * 9])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        plain = [(i, t) for i, t in before.items()]
        if name == "quality_rules":
            for i, t in plain:
                n, _, symbols, _, repeats = counts(t)
                if n < 10 or 100 * repeats > 20 * n or 10 * symbols > n:
                    assert i not in kept[name]
            assert {i for i, t, *_ in rows if t in clean} <= set(kept[name])
        if name == "line_dedup":
            want = {i: t for i, (_, gone, t) in line_expected(plain).items() if not gone or space_words(t)}
            assert kept[name] == want
        if name == "near_dedup":
            assert set(kept[name]) == {i for i, (_, c) in near_expected(plain, 5, 80).items() if i == c}
        if name == "decontamination":
            assert set(kept[name]) == {i for i, t in plain if not leaks(t, ITEMS)[1]}
    folder = shared.folder(spark).removeprefix("file://")
    there = set(os.listdir(folder))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = {f.rpartition("-")[0] for f in os.listdir(folder) if f not in there}
    assert left & {name for name, _ in corpus_pipeline.STAGES} == {"decontamination"}, left  # earlier results are deleted
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {}
    for p in sorted(pieces, key=lambda p: p.start):
        found.setdefault(p.doc_id, []).extend(p.ids)
    assert found == {i: exact.encode(t, add_special_tokens=False).ids + [0] for i, t in kept["decontamination"].items()}
    assert len(quality.RULES) > 2


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
