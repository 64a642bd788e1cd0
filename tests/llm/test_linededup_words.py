import random

import pytest
from cases import SCHEMA, prose, space_words, lower_ascii
from test_linededup import EXTRA

from pagelens.llm import linededup


def words(line):
    return frozenset(space_words(lower_ascii(line)))


def expected(rows, percent=80):
    seen, out = [], {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        kept, ls = [], t.split("\n")
        for line in ls:
            s = words(line)
            if not s or not any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                kept.append(line)
            if s:
                seen.append(s)
        out[i] = "\n".join(kept)
    return out


def edited(n, seed):
    """Lines of 4 to 40 words, each after an earlier one with some words replaced, dropped, doubled or moved."""
    r, out = random.Random(seed), []
    for _ in range(n):
        w = out[r.randrange(len(out))].split() if out and r.random() < 0.7 else prose(r.randint(4, 40), r.random()).split()
        for _ in range(r.randint(0, 4)):
            i, kind = r.randrange(len(w)), r.randrange(4)
            w[i : i + 1] = [["".join(r.choice("klmnop") for _ in range(5))], [], [w[i]] * 2, [w[i]]][kind] or [w[i]]
            if kind == 3:
                r.shuffle(w)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block, small", [(2048, 512), (5, 2)])
def test_tokens_are_words(spark, monkeypatch, block, small):
    monkeypatch.setattr(linededup, "BLOCK_RECORDS", block)
    monkeypatch.setattr(linededup, "SMALL_GROUP", small, raising=False)
    footer = "Last updated on {} by the editorial team of this little site"
    texts = [*EXTRA, *[f"{prose(8, i)}\n{footer.format(d)}" for i, d in enumerate(["monday", "tuesday", "friday"])], *["\n".join(edited(20, s)) for s in range(15)], "\n".join(edited(200, 99))]
    rows = [(i, t, "en", "test", len(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    want = expected(rows)
    assert got == want
    assert footer.format("friday") not in "\n".join(got.values())


def test_the_survey_passes_over_its_table_once_for_many_small_batches(monkeypatch):
    """Counts are those of all batches together, and few batches don't each cost a pass over all buckets."""
    import numpy as np
    import pyarrow as pa

    from pagelens.llm import linededup

    class Docs:
        def mapInArrow(self, run, schema):
            return run

    passes, whole = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, minlength=0, **k: (passes.append(minlength), whole(*a, minlength=minlength, **k))[1])
    texts = [f"a b c{i}\nb " + "x" * (300 + i) for i in range(20)]
    batches = [pa.record_batch([pa.array([i]), pa.array([i]), pa.array([t])], names=["id", "th", "text"]) for i, t in enumerate(texts)]
    out = list(linededup.survey(Docs())(iter(batches)))
    assert sum(np.frombuffer(x, np.int64).sum() for x in out[-1].column("counts").to_pylist()) == 100
    assert passes.count(linededup.RARITY_BUCKETS) == 1
