import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
from cases import SCHEMA, documents
from tokenizers import Tokenizer

from pagelens.llm import packing

EXTRA = ["special <|endoftext|> inside", "tabs\t\tand  spaces   end  ", "日本語のテキスト", "e\u0301 combining \u200b zero \u0085 nel", "it's we'll I'D don't", "12345 678,90 €5"]


def test_round_trip(spark):
    rows = documents(EXTRA)
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: exact.encode(t or "", add_special_tokens=False).ids + [0] for i, t, *_ in rows}
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3), length=64).collect()
    got: dict = {}
    windows: dict = {}
    for p in pieces:
        assert p.length == len(p.ids) > 0 and p.offset + p.length <= 64
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        assert p.doc_tokens == len(want[p.doc_id])
        got.setdefault(p.doc_id, []).append((p.start, p.ids))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, ids in want.items():
        parts = sorted(got[i])
        assert [x for _, part in parts for x in part] == ids
        assert [s for s, _ in parts] == list(np.cumsum([0] + [len(p) for _, p in parts])[:-1])
    assert sorted(windows) == list(range(len(windows)))
    for s, parts in windows.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or s == max(windows)


def test_both_libraries_agree_on_all_common_characters():
    encode = packing.encoder(*packing.default_paths())
    chars = [chr(c) for c in range(0x3000) if packing._COMMON.fullmatch(chr(c))]
    assert len(chars) > 500
    for c in chars:
        for t in (c, f"a{c}b", f" {c} {c}{c}", f"1{c} \n{c}\n\n", f"{c}'s {c}9"):
            assert encode.fast.encode_ordinary(t) == encode.exact.encode(t, add_special_tokens=False).ids, (hex(ord(c)), t)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_both_libraries_agree_on_whole_documents(spark):
    encode = packing.encoder(*packing.default_paths())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert len(texts) > 100
    for t in filter(None, texts):
        assert encode(t) == encode.exact.encode(t, add_special_tokens=False).ids


def test_repeated_rows_and_null_keys(spark):
    rows = [(1, "one two", 0), (1, "one two", 0), (1, "other", 0), (None, "x", 0), (None, None, 0)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, start long"), length=4).collect()
    assert sorted({(p.sequence_id, p.offset + i) for p in got for i in range(p.length)}) == [(i // 4, i % 4) for i in range(sum(p.length for p in got))]
    assert sum(p.start == 0 for p in got) == len(rows)


def test_long_runs_are_found_as_by_a_pattern_and_cheaply():
    r = random.Random(9)
    run = re.compile(r"\S{2000}")
    texts = ["", "a" * 1999, "a" * 2000, " " + "a" * 2000, "a" * 1999 + " " + "b" * 1999, "a" * 1999 + "\t" + "b" * 2000, "x\n" * 3000, "a " * 900 + "b" * 2000 + " c", " " * 5000, "\n".join("y" * 1990 for _ in range(4))]
    texts += ["".join(r.choice([" ", "\n", "\t", "z" * r.choice([1, 600, 1400])]) for _ in range(30)) for _ in range(300)]
    assert [packing.has_long_run(t) for t in texts] == [bool(run.search(t)) for t in texts]
    prose = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(200_000))
    encode = packing.encoder(*packing.default_paths())
    began = time.process_time()
    encode.fast.encode_ordinary(prose)
    coded = time.process_time()
    assert not packing.has_long_run(prose)
    assert time.process_time() - coded < (coded - began) / 10
