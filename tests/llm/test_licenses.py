from cases import SCHEMA, alnum_words, documents

from pagelens.llm import licenses, queries

EXTRA = [
    "Released under the MIT License. under the mit license, UNDER-THE-MIT-LICENSE",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed undr the Apachee License, Version 2.0.",
    "apache license version 20 and cc by-nc, CC BY NC",
    "GNU General Public License, version 3. Licensed under the GNU Generol Public License, version 3",
    "xunder the mit license under the mit licenses",
    "Ümlaut under the mit license",
    "under the mit license" + "\n" + "under" ,
]


def base(t):
    w, out = alnum_words(t), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), sorted(out)


def test_base_places(spark):
    rows = documents(EXTRA)
    for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        t = next(x[1] for x in rows if x[0] == r.doc_id)
        n, places = base(t)
        assert r.n_words == n and [(p.word, p.label) for p in r.base] == places, t


def test_fuzzy_matches_are_verified_and_located(spark):
    text = "Some words. Licensed undr the Apachee License, Version 2.0. More"
    (r,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    (m,) = [m for m in r.matches if m.label == "apache-2"]
    assert alnum_words(text)[m.first_word : m.end_word] == "licensed undr the apachee license version 2 0".split()
    assert m.edits == 2 and 0 < m.score < 1 and not r.base
    (clean,) = licenses.scan(spark.createDataFrame([(1, "under a general public library license nobody reads 3")], "doc_id long, text string")).collect()
    assert not clean.matches and clean.score == 0


def test_pieces_find_every_place_within_the_edits():
    import random

    import pyarrow as pa

    from pagelens.llm import text as X

    r = random.Random(3)
    scan = licenses.Scanner(licenses.compile_notices(), licenses.PHRASES)
    for p in licenses.compile_notices():
        stem = p.notice.decode()
        for _ in range(20):
            s = list(stem.rstrip("0123456789 "))
            for _ in range(p.edits):
                at = r.randrange(1, len(s) - 1)
                s[at] = r.choice("abcxyz")
            t = "intro words " + "".join(s) + stem[len(stem.rstrip("0123456789 ")) :] + " outro"
            (found,) = scan(next(X.chunked(pa.array([t]))))
            assert any(m[0] == p.label for m in found[2]), (t, found)


def test_query_columns(spark, tmp_path):
    rows = documents(EXTRA)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op8_license_scan(spark, str(tmp_path)).collect():
        t = next(x[1] for x in rows if x[0] == r.doc_id)
        _, places = base(t)
        assert r.n_base == len(places) and r.base_labels == ",".join(sorted({x for _, x in places}))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def best(t):
    """Label -> the fewest edits of a match anywhere, by a search of the whole text."""
    import regex

    text, out = " ".join(alnum_words(t)), {}
    for p in licenses.compile_notices():
        m = regex.search(p.fuzzy, text)
        if m:
            out[p.label] = min(out.get(p.label, (99, 0)), (sum(m.fuzzy_counts) / len(p.notice), sum(m.fuzzy_counts)))
    return {k: 1 - v[0] for k, v in out.items()}


def test_labels_and_score_against_a_search_of_whole_texts(spark, tmp_path):
    import random

    r, extra = random.Random(8), list(EXTRA)
    for _, notice in licenses.NOTICES:
        for edits in (0, 1, 2, 4, 9):
            s = list(notice)
            for _ in range(edits):
                s[r.randrange(len(s))] = r.choice(["", "x", " ", "é", "ss"])
            extra.append(f"words before {''.join(s)} and {notice[: len(notice) // 2]} after")
    rows = documents(extra)
    spark.createDataFrame([*rows, rows[0], rows[-1]], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_license_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 2
    for g in got:
        t = next(x[1] for x in rows if x[0] == g.doc_id)
        want, exact = best(t), {x for _, x in base(t)[1]}
        assert g.labels == ",".join(sorted(set(want) | exact)), t
        assert abs(g.score - (1 if exact else max(want.values(), default=0))) < 1e-12, t
        assert {m.split(":")[0] for m in filter(None, g.matches.split(","))} == set(want)


def test_repeated_seeds_take_linear_time():
    import time

    import numpy as np

    from pagelens.llm import text as X

    for piece in (b"all right s reserved ", b"allrights", b"under the mit " * 3):
        data = np.frombuffer(piece * ((1 << 20) // len(piece)), np.uint8)
        began = time.process_time()
        licenses.Scanner(licenses.compile_notices(), licenses.PHRASES)(X.Texts(data, np.array([0, len(data)]), 0))
        assert time.process_time() - began < 20
