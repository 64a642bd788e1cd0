"""Operators of the survey that keep state, layouts or rule tables: budgets, attempts, caches, buckets, quotas, suffixes, number plans, numbered lines, exports."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagelens.functions import text
from pagelens.operators import asof, discovery, fetches, filters, prefixes, quota
from pagelens.operators.buckets import BucketedTable
from pagelens.sinks import files
from pagelens.sources import dimensions, labels, lines
from pagelens.streaming import streams

RULES = """// ===BEGIN ICANN DOMAINS===
com
at
co.at
// a comment
*.ck
!www.ck
jp
*.kawasaki.jp
!city.kawasaki.jp
公司.cn  trailing words
a.b.c.deep
// ===END ICANN DOMAINS===
// ===BEGIN PRIVATE DOMAINS===
blogspot.com
"""


def test_registrable_domains_by_suffix_rules(spark, tmp_path):
    (tmp_path / "psl.dat").write_text(RULES)
    rules = dimensions.suffix_rules(spark, f"{tmp_path}/psl.dat")
    want = {
        "https://a.b.example.com/x": "example.com", "https://com/": None, "https://shop.co.at": "shop.co.at", "https://co.at": None, "http://x.y.ck": "x.y.ck", "http://y.ck": None,
        "http://a.www.ck": "www.ck", "http://www.ck": "www.ck", "http://a.b.kawasaki.jp": "a.b.kawasaki.jp", "http://x.city.kawasaki.jp": "city.kawasaki.jp", "http://kawasaki.jp": "kawasaki.jp",
        "http://a.b.unknown": "b.unknown", "http://localhost": None, "http://10.0.0.1/": None, "http://[::1]/": None, "not a url": None, "http://w.公司.cn/": "w.xn--55qx5d.cn", "http://x.a.b.c.deep": "x.a.b.c.deep",
        "http://b.c.deep": "c.deep", "https://me.blogspot.com": "blogspot.com", "http://A.CO.AT.": "a.co.at", None: None,
    }
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r.u: r.apex for r in prefixes.with_apex(df, "u", rules).collect()} == want
    assert prefixes.with_apex(df.where("u like '%blogspot%'"), "u", rules, private=True).first().apex == "me.blogspot.com"
    plan = prefixes.with_apex(df, "u", rules)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_phone_numbers_by_plan(spark, tmp_path):
    (tmp_path / "plan.csv").write_text("prefix,region,least,most\n43,AT,7,13\n431,AT,6,13\n43800,AT,9,9\n49,DE,6,11\n4366,AT,10,12\n423,LI,7,7\n")
    plan = dimensions.number_plan(spark, f"{tmp_path}/plan.csv")
    want = {
        "0043 1 234 56 78": "+4312345678"[:3] + "12345678", "+43 1 234-5678": "+4312345678", "01/2345678": "+4312345678", "tel:+43 (0)1 2345678": "+4312345678", "123": None, "0800 123456": "+43800123456", "0800 1234567": None,
        "0660 1234567": "+436601234567", "0660 123456": None, "+49 30 123456": None, "+423 1234567": None, "1 2345678": "+4312345678", "+43": None, "": None, "call us": None, "+44 20 1234567": None, None: None,
    }
    got = prefixes.with_phone(spark.createDataFrame([(x,) for x in want], "raw string"), "raw", plan)
    assert {r.raw: r.phone for r in got.collect()} == want
    assert prefixes.with_phone(spark.createDataFrame([("+49 30 123456",)], "raw string"), "raw", plan, country="DE", code="49").first().phone == "+4930123456"


def budget(answers, most):
    """Seeds in order; what one offers is cut before places that are known already are left out."""
    seen, trace = [], []
    for seed in sorted({a[0] for a in answers}):
        left = most - len(seen)
        if left <= 0:
            break
        n = min(20, -(-3 * left // 2))
        offered = [p for s, _, p in sorted(answers) if s == seed][:n]
        added = []
        for p in offered:
            if p not in seen and len(seen) < most:
                seen.append(p)
                added.append(p)
        trace.append((seed, n, len(offered), len(added)))
    return seen, trace


def test_budget_runs_down_over_seeds(spark):
    r = random.Random(3)
    runs = {f"run{i}": [(s, k, r.randrange(r.choice([5, 40, 400]))) for s in range(r.randint(1, 9)) for k in range(r.choice([0, 3, 25, 60]))] for i in range(40)}
    runs["hot"] = [(s, k, k * 7 + s) for s in range(3) for k in range(2000)]
    df = spark.createDataFrame([(n, *a) for n, rows in runs.items() for a in rows] + [("run0", None, 1, 5), ("run0", 0, 0, None)], "run string, seed int, nth int, place int")
    for most in (1, 7, 50):
        kept = discovery.within_budget(df, "run", "seed", ["nth"], "place", most).collect()
        trace = discovery.seed_trace(df, "run", "seed", ["nth"], "place", most).collect()
        for name, rows in runs.items():
            seen, steps = budget(rows, most)
            assert [x.place for x in sorted((x for x in kept if x.run == name), key=lambda x: x.ordinal)] == seen, (name, most)
            assert sorted((x.seed, x.budget, x.offered, x.added) for x in trace if x.run == name) == steps
    plan = discovery.within_budget(df, "run", "seed", ["nth"], "place", 50)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fetch_attempts(spark):
    a = [
        ("ok", 0, 200, "body", "https://ok/2", None, None), ("again", 0, 503, "x", "", None, None), ("again", 1, 0, None, None, "TimeoutError", None), ("again", 2, 200, "late", None, None, None),
        ("busy", 0, 429, "1", None, None, None), ("busy", 1, 429, "2", None, None, None), ("busy", 2, 429, "3", None, None, None), ("busy", 3, 200, "beyond", None, None, None),
        ("dns", 0, None, None, None, "TypeError", "ENOTFOUND"), ("dns", 1, 200, "no", None, None, None), ("slow", 0, None, None, None, "AbortError", None), ("slow", 1, None, None, None, "AbortError", None), ("slow", 2, None, None, None, "AbortError", None),
        ("gone", 0, 404, "n", None, None, None), ("cut", 0, 503, "x", None, None, None), ("cut", 1, 504, "x", None, None, None), ("never", 0, None, None, None, "TimeoutError", None), (None, 0, 200, "x", None, None, None),
    ]
    df = spark.createDataFrame(a, "url string, attempt int, status int, body string, final_url string, failure string, code string").repartition(5)
    got = {r.url: (r.status, r.body, r.final_url, r.error, r.attempts, r.waited_ms) for r in fetches.outcomes(df).collect()}
    assert got == {
        "ok": (200, "body", "https://ok/2", None, 1, 0), "again": (200, "late", "again", None, 3, 8000), "busy": (429, "3", "busy", "HTTP_4XX", 3, 8000), "dns": (0, "", "dns", "DNS_FAIL", 1, 0),
        "slow": (0, "", "slow", "TIMEOUT", 3, 8000), "gone": (404, "n", "gone", "HTTP_4XX", 1, 0), "cut": (504, "", "cut", "HTTP_5XX", 2, 2000), "never": (0, "", "never", "UNKNOWN", 1, 0),
    }
    assert fetches.outcomes(df.where("url = 'busy'"), retries=5).first()[1:] == ("beyond", "busy", None, 4, 26_000)[0:0] or fetches.outcomes(df.where("url = 'busy'"), retries=5).first().waited_ms == 26_000


def test_bodies_are_cut_by_utf16_units(spark):
    for body in ("abcdef", "ab🙂cd", "abc🙂d", "🙂🙂🙂", "", "éééééé", None):
        cut = spark.createDataFrame([(body,)], "b string").select(fetches.capped(F.col("b"), 4).alias("c")).first().c
        want = None if body is None else body.encode("utf-16-le")[:8].decode("utf-16-le", "ignore")
        assert cut == want, body


def test_cache_answers(spark):
    t = datetime(2026, 4, 20, 12)
    r = random.Random(5)
    entries = [(f"k{r.randrange(8)}", t - timedelta(minutes=r.randrange(60 * 24 * 30)), f"e{i}" if i % 9 else None) for i in range(300)] + [("hot", t - timedelta(minutes=i), f"h{i}") for i in range(3000)]
    requests = [(i, f"k{r.randrange(10)}", t - timedelta(minutes=r.randrange(60 * 24 * 30))) for i in range(400)] + [(1000 + i, "hot", t - timedelta(seconds=37 * i)) for i in range(3000)] + [(5000, None, t), (5001, "k1", None)]
    attempts = [(q[0], f"n{q[0]}" if q[0] % 3 else None, "HTTP 503" if q[0] % 3 == 0 else None) for q in requests if q[0] % 5]
    ttl = 2
    made = {a[0]: a[1] for a in attempts if a[2] is None}
    want = {}
    for i, key, at in requests:
        known = [(c, a) for k, c, a in entries if k == key and a is not None and at is not None and c <= at] if key and at else []
        best = max(known, default=None)
        age = (at - best[0]).total_seconds() / 86_400 if best else None
        if best and age < ttl:
            want[i] = ("fresh", best[1], int(age))
        elif made.get(i):
            want[i] = ("new", made[i], None)
        else:
            want[i] = ("stale", best[1], int(age)) if best else ("failed", None, None)
    frames = spark.createDataFrame(requests, "request_id long, key string, at timestamp"), spark.createDataFrame(entries, "key string, created_at timestamp, answer string"), spark.createDataFrame(attempts, "request_id long, answer string, error string")
    got = {x.request_id: (x.source, x.answer, x.age_days) for x in asof.answered(*frames, ttl).collect()}
    assert got == want and {v[0] for v in want.values()} == {"fresh", "new", "stale", "failed"}


def test_quota_equals_a_ranking_of_whole_days(spark):
    r = random.Random(7)
    t = datetime(2026, 4, 20)
    rows = [(i, t + timedelta(seconds=r.choice([r.randrange(3 * 86_400), 50_000, 86_399, 0]), microseconds=r.choice([0, 0, r.randrange(10**6)]))) for i in range(3000)] + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, at timestamp")
    for q in (0, 1, 100, 700, 5000):
        got = {x.id: x.allowed for x in quota.within_daily(df, "at", "id", q).collect()}
        want = {x.id: x.allowed for x in filters.within_daily_quota(df.where("at is not null"), "at", "id", q).collect()} | {9999: False}
        assert got == want, q
    assert not quota.within_daily(df.limit(0), "at", "id", 5).count()
    plan = quota.within_daily(df, "at", "id", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_day" in plan and "_second" in plan.split("windowspecdefinition(_day", 1)[1][:40]


SCHEMA = "place_id string, score int, audited_at timestamp"


def audits(spark, keys, score, at):
    return spark.createDataFrame([(f"p{k}", score, at) for k in keys], SCHEMA)


def test_bucketed_upsert_touches_only_its_buckets(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/t", SCHEMA, buckets=32)
    t = datetime(2026, 1, 1)
    assert table.read().count() == 0 and table.lookup(audits(spark, [1], 0, t)).count() == 0
    assert table.upsert(audits(spark, range(3000), 1, t)) == 1
    before = table.manifest()["buckets"]
    new = audits(spark, [3, 5000], 2, t).unionByName(audits(spark, [3], 7, t + timedelta(days=1)))
    assert table.upsert(new) == 2
    after = table.manifest()["buckets"]
    changed = {b for b in after if before.get(b) != after[b]}
    assert 1 <= len(changed) <= 2 and len(before) == 32
    got = {r.place_id: r.score for r in table.read().collect()}
    assert len(got) == 3001 and got["p3"] == 7 and got["p5000"] == 2 and got["p4"] == 1
    assert table.read(1).count() == 3000  # readers keep their version
    with pytest.raises(ValueError):
        BucketedTable(spark, f"{tmp_path}/t", SCHEMA, buckets=8).upsert(new)


def test_lookup_reads_only_the_keys_buckets(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/t", SCHEMA, buckets=16)
    table.upsert(audits(spark, range(2000), 1, datetime(2026, 1, 1)))
    one = table.lookup(audits(spark, [77, 77, 99999], 0, None))
    assert [r.place_id for r in one.collect()] == ["p77"]
    assert 1 <= len({f.rsplit("_bucket=")[1].split("/")[0] for f in one.inputFiles()}) <= 2
    many = table.lookup(audits(spark, range(500, 2500), 0, None))
    assert many.count() == 1500 and table.lookup(audits(spark, [], 0, None)).count() == 0
    assert table.lookup(spark.createDataFrame([(None,)], "k string")).count() == 0


def test_null_keys_writers_in_conflict_and_vacuum(spark, tmp_path):
    table, other = (BucketedTable(spark, f"{tmp_path}/t", SCHEMA, buckets=4) for _ in range(2))
    t = datetime(2026, 1, 1)
    null = spark.createDataFrame([(None, 1, t)], SCHEMA)
    table.upsert(null.unionByName(audits(spark, range(50), 1, t)))
    table.upsert(null.withColumn("score", F.lit(5)))
    assert [r.score for r in table.read().where("place_id is null").collect()] == [5]
    stale = table.manifest()
    real, calls = other.manifest, []

    def late(version=None):
        if not calls:  # another writer commits behind the first reading
            calls.append(table.upsert(audits(spark, [1], 9, t)))
            return stale
        return real(version)

    other.manifest = late
    assert other.upsert(audits(spark, [2], 8, t)) == 4
    assert {r.place_id: r.score for r in table.read().where("score > 5").collect()} == {"p1": 9, "p2": 8}
    assert table.upsert(audits(spark, [1], 3, t), batch=("w", 0)) == 5 and table.upsert(audits(spark, [1], 4, t), batch=("w", 0)) == 5
    rows = table.read().count()
    assert table.vacuum(keep=1) > 0 and table.versions() == [5] and table.read().count() == rows
    audits(spark, [7], 77, t + timedelta(days=1)).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        streams.upserting(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), table, f"{tmp_path}/cp").awaitTermination(120)
    assert table.versions()[-1] == 6 and table.lookup(audits(spark, [7], 0, None)).first().score == 77


def test_lines_are_numbered_over_splits(spark, tmp_path):
    r = random.Random(2)
    want = {}
    for name in ("a.txt", "b.txt", "c.txt"):
        rows = ["" if r.random() < 0.1 else f"{name} {i} " + "x" * r.randrange(60) for i in range(r.choice([1, 700, 2000]))] + ["last"]
        (tmp_path / name).write_bytes(("\r\n" if name == "b.txt" else "\n").join(rows).encode())
        want |= {(name, i): x for i, x in enumerate((x for x in rows if x), 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = {(x.file.rsplit("/")[-1], x.row): x.line for x in lines.numbered(spark, f"{tmp_path}/*.txt").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


def test_cells_of_a_line(spark):
    want = {'a,b,,d': ["a", "b", "", "d"], '"x, ""y"" z",2': ['x, "y" z', "2"], 'p"q,r"s,t': ["pq,rs", "t"], '"open, end': ["open, end"], '"",x': ["", "x"], '"a""b"c': ['a"bc'], "": [""], ",": ["", ""]}
    got = {r.line: r.c for r in spark.createDataFrame([(x,) for x in want], "line string").select("line", labels.cells(F.col("line")).alias("c")).collect()}
    for line, cells in want.items():
        assert got[line][: len(cells)] == cells and all(c == "" for c in got[line][len(cells) :]), line
    long = "word " * 60_000 + '"' + "quoted, " * 20_000 + '",end'
    assert spark.createDataFrame([(long,)], "line string").select(F.size(labels.cells(F.col("line")))).first()[0] >= 2


def test_label_faults_by_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Notes, LEAD_ID ,status,channel\n\n"hi, ""you""",p1,FOLLOWUP,MAIL\n,,FOLLOWUP,\nn,p3,MAYBE,\n\nn,p4,NO_ANSWER,FAX\n,p5,NO_ANSWER\n')
    (tmp_path / "b.csv").write_text("lead_id,status\np9,FOLLOWUP\n")
    rows = {(r.file.rsplit("/")[-1], r.row): r for r in labels.checked_rows(spark, f"{tmp_path}/*.csv").collect()}
    assert {k: r.fault for k, r in rows.items()} == {
        ("a.csv", 2): None, ("a.csv", 3): "lead_id is missing", ("a.csv", 4): 'invalid status "MAYBE"', ("a.csv", 5): 'invalid channel "FAX"', ("a.csv", 6): None, ("b.csv", 1): "header lacks the column channel",
    }
    assert rows["a.csv", 2].notes == 'hi, "you"' and rows["a.csv", 2].lead_id == "p1" and rows["a.csv", 6].channel is None
    with pytest.raises(ValueError, match="row 3 of"):
        labels.read_labels(spark, f"{tmp_path}/a.csv", 1)


def test_slugs_by_compatibility_decomposition(spark):
    import re
    import unicodedata

    names = ["Café Müßig", "ﬁne ﬂow ﬃ", "Ｆｕｌｌ Ｗｉｄｔｈ １２", "x² + ½ kg ㎏ ①⑳", "Å Å ℌ ǆ Ǆ", "naïve Ελλάδα Straße", "étude & ﹠ ＆", "𝒶𝓫𝔠 𝟙𝟚", "…™ ℡ ㏒", "İstanbul ŉ ſt", "ⅷ Ⅷ ª º", "한국 ㍿", "", "🙂 ok", "ệ ǖ ṩ"]
    fold = lambda s: "".join(text.UMLAUTS.get(c, c) for c in s).lower()
    plain = lambda s: re.sub("[̀-ͯ]", "", unicodedata.normalize("NFKD", fold(s)))
    want = {s: re.sub(" +", "-", re.sub("[^a-z0-9]+", " ", plain(s).replace("&", " and ")).strip()) for s in names}
    got = {r.s: r.slug for r in spark.createDataFrame([(s,) for s in names], "s string").select("s", text.slug(F.col("s")).alias("slug")).collect()}
    assert got == want


def test_exports_in_parts_give_the_bytes_of_one_file(spark, tmp_path):
    ddl = "id long, name string, ok boolean, tags array<string>"
    rows = [(i, None if i % 7 == 0 else f'n;"{i}"\né🙂', i % 2 == 0, ["a", "b"][: i % 3]) for i in range(500)]
    df = spark.createDataFrame(rows, ddl).repartition(7).orderBy("id")
    for data, n in ((df, 500), (df.where("id = 3"), 1), (df.limit(0), 0)):
        files.write_csv(data, f"{tmp_path}/x.csv", ddl)
        body = "".join(";".join(["" if v is None else ("1" if v else "0") if isinstance(v, bool) else files_cell(v) for v in r]) + "\r\n" for r in sorted(data.collect()))
        assert open(f"{tmp_path}/x.csv", "rb").read() == ("﻿id;name;ok;tags\r\n" + body).encode()
        files.write_json(data, f"{tmp_path}/x.json", ddl)
        whole = [dict(zip(("id", "name", "ok", "tags"), r, strict=True)) for r in sorted(data.collect())]
        assert open(f"{tmp_path}/x.json", "rb").read() == json.dumps(whole, indent=2, ensure_ascii=False).encode()
        files.write_jsonl(data.select(F.to_json(F.struct("id", "ok")).alias("value")), f"{tmp_path}/x.jsonl")
        assert open(f"{tmp_path}/x.jsonl").read().count("\n") == n
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["x.csv", "x.json", "x.jsonl"]


def files_cell(v):
    s = ",".join(v) if isinstance(v, list) else str(v)
    return '"' + s.replace('"', '""') + '"' if any(c in s for c in ';"\r\n') else s


def test_deep_pages_are_parsed_in_linear_time():
    import time

    from pagelens.functions import html

    began = time.process_time()
    facts = html.parse("<body>" + "<div>t " * 30_000 + "<a href=x>y</a>" * 3000)
    assert len(facts["links"]) == 3000 and facts["body_text"].count("t ") == 30_000 and time.process_time() - began < 5
    label = "<dl><dt>Website</dt><dd><p><a href='http://a.at'>x</a></dd><dt>Mail</dt><dd><a href='http://b.at'>y</a></dd></dl><header><section><a target=_blank href=c>z</a></section></header>"
    links = html.parse(label)["directory_links"]
    assert links["falstaff"] == ["http://a.at"] and links["instagram"] == ["c"]


def test_history_of_a_lead_over_many_days(spark):
    from pagelens.operators import dedupe

    r = random.Random(4)
    rows = [(i, r.choice(["hot", "hot", "a", "b", None]), r.choice(["X", "Y", None]), r.randrange(0, 40 * 86_400_000, 7_200_000)) for i in range(1500)]
    got = dedupe.history(spark.createDataFrame(rows, "id long, lead_id string, status string, created_at long")).collect()
    want = {}
    for lead in {x[1] for x in rows}:
        own = sorted((x for x in rows if x[1] == lead), key=lambda x: (-x[3], -x[0]))
        want |= {x[0]: (n, own[n][2] if n < len(own) else None) for n, x in enumerate(own, 1)}
    assert {x.id: (x.nth_newest, x.previous_status) for x in got} == want
    assert [x.created_at for x in got] == sorted((x[3] for x in rows), reverse=True)
