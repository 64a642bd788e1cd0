"""Queries of the operators that keep state, layouts or rule tables. Values are derived from the rows' keys, hosts and texts; dimensions of a few rows are inline on both sides."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..functions import text
from ..operators import asof, discovery, fetches, prefixes, quota
from ..operators.buckets import BucketedTable
from ..sinks import files
from ..sources import dimensions, labels, lines, places
from .queries import _BARE, query, table


def _pick(i: Column, values) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (i % len(values)).cast("int"))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _place(spark, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{tables.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _at(i: Column, step: int, days: int, start: int = 1_776_600_000) -> Column:
    return F.timestamp_seconds(start + i * step % (days * 86_400))


def _sql_at(step: int, days: int, start: int = 1_776_600_000) -> str:
    return f"(TIMESTAMP '1970-01-01' + to_seconds({start} + page_id * {step} % {days * 86_400}))"


# --- X4, X35: longest match against rule tables

_RULES = ("com", "at", "co.at", "*.ck", "!www.ck", "jp", "*.kawasaki.jp", "!city.kawasaki.jp", "公司.cn", "deep", "b.c.deep")
_TAILS = ("com", "co.at", "x.ck", "ck", "www.ck", "kawasaki.jp", "a.kawasaki.jp", "city.kawasaki.jp", "公司.cn", "c.deep", "b.c.deep", "unlisted", "more.unlisted")


def _sql_rule(r: str) -> str:
    name, kind = r.removeprefix("*.").removeprefix("!"), "wildcard" if r[0] == "*" else "exception" if r[0] == "!" else "plain"
    return f"('{name.encode('idna').decode()}', '{kind}')"


@query(f"""WITH p AS (SELECT page_id, regexp_replace({_BARE}, '\\.example\\..*$', '') || '.' || replace({_sql_list(_TAILS)}[CAST(page_id % {len(_TAILS)} AS INTEGER) + 1], '公司.cn', 'xn--55qx5d.cn') AS host FROM pages),
l AS (SELECT page_id, string_split(host, '.') AS l FROM p), t AS (SELECT page_id, l, d, array_to_string(l[len(l) - d + 1 :], '.') AS tail FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS d FROM l)),
m AS (SELECT page_id, max(CASE WHEN kind = 'exception' THEN d - 1 END) AS exception, max(CASE WHEN kind = 'plain' THEN d WHEN kind = 'wildcard' AND len(l) > d THEN d + 1 END) AS best
FROM t JOIN (VALUES {', '.join(map(_sql_rule, _RULES))}) r(name, kind) ON name = tail GROUP BY 1),
s AS (SELECT page_id, l, coalesce(exception, best, 1) AS n FROM l LEFT JOIN m USING (page_id)) SELECT page_id, CASE WHEN len(l) > n THEN array_to_string(l[len(l) - n :], '.') END AS apex FROM s""")
def apex_by_suffix_rules(spark, sf_dir):
    """Hosts of the pages under plain, deep, wildcard and exception suffixes."""
    rules = dimensions.suffix_table(spark.createDataFrame([(r, False) for r in _RULES], "rule string, private boolean"))
    i = F.col("page_id")
    made = F.concat(F.lit("https://"), F.regexp_replace(F.regexp_extract("url", "^[a-z]+://(?:www\\.)?([^/?#]*)", 1), "\\.example\\..*$", ""), F.lit("."), _pick(i, _TAILS), F.lit("/p"))
    return prefixes.with_apex(table(spark, sf_dir, "pages").select("page_id", made.alias("made")), "made", rules).select("page_id", "apex")


_PLAN = (("43", "AT", 7, 13), ("431", "AT", 6, 13), ("43800", "AT", 9, 9), ("43660", "AT", 10, 12), ("437", "AT", 5, 9), ("49", "DE", 6, 11), ("423", "LI", 7, 7))
_FORMS = ("+43 1 ", "0043 (0)660/", "0800-", "+49 30 ", "tel:+431", "", "0", "+423 ", "call ", "00 43 7", "+43-800 ")


@query(f"""WITH r AS (SELECT page_id, {_sql_list(_FORMS)}[CAST(page_id % {len(_FORMS)} AS INTEGER) + 1] || lpad(CAST(page_id * 7919 % 1000000007 AS VARCHAR), CAST(3 + page_id % 9 AS INTEGER), '7') AS raw FROM pages),
t AS (SELECT page_id, regexp_replace(raw, '^tel:', '') AS t FROM r), d AS (SELECT page_id, t, regexp_replace(t, '[^0-9]', '', 'g') AS d FROM t WHERE NOT regexp_matches(t, '[a-z]')),
a AS (SELECT page_id, d, CASE WHEN t[1] = '+' THEN d WHEN d[1:2] = '00' THEN d[3:] END AS abroad FROM d),
n AS (SELECT page_id, CASE WHEN abroad IS NULL THEN '43' || regexp_replace(d, '^0', '') WHEN abroad[1:2] = '43' THEN '43' || regexp_replace(abroad[3:], '^0', '') ELSE abroad END AS number FROM a),
m AS (SELECT page_id, number, arg_max(region, length(prefix)) AS region, arg_max(least, length(prefix)) AS least, arg_max(most, length(prefix)) AS most
FROM n JOIN (VALUES {', '.join(map(str, _PLAN))}) p(prefix, region, least, most) ON starts_with(number, prefix) WHERE length(number) BETWEEN 5 AND 15 GROUP BY ALL)
SELECT pages.page_id, CASE WHEN region = 'AT' AND length(number) - 2 BETWEEN least AND most THEN '+' || number END AS phone FROM pages LEFT JOIN m USING (page_id)""")
def phone_by_number_plan(spark, sf_dir):
    """Numbers in many forms and lengths against a plan."""
    i = F.col("page_id")
    raw = F.concat(_pick(i, _FORMS), F.expr("lpad(CAST(page_id * 7919 % 1000000007 AS STRING), CAST(3 + page_id % 9 AS INT), '7')"))
    plan = spark.createDataFrame(_PLAN, "prefix string, region string, least int, most int")
    return prefixes.with_phone(table(spark, sf_dir, "pages").select("page_id", raw.alias("raw")), "raw", plan).select("page_id", "phone")


# --- O4, A13: a budget that runs down

_MOST = 45
_FOLD = f"""WITH RECURSIVE a AS (SELECT page_id % 37 AS run, CAST(page_id * 7 % 9 AS INTEGER) AS seed, {_BARE} AS host, page_id FROM pages),
b AS (SELECT run, seed, list(host ORDER BY page_id, host)[1:20] AS hosts FROM a GROUP BY ALL), s AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY seed) AS nth FROM b),
f(run, nth, seen, seed, budget, offered, added) AS (SELECT DISTINCT run, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(NULL AS INTEGER), CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]) FROM s UNION ALL
SELECT run, nth, list_concat(seen, fresh[1 : {_MOST} - len(seen)]), seed, budget, offered, fresh[1 : {_MOST} - len(seen)] FROM (
SELECT f.run, s.nth, f.seen, s.seed, x.budget, s.hosts[1 : x.budget] AS offered, list_filter(s.hosts[1 : x.budget], lambda h, k: NOT list_contains(f.seen, h) AND list_position(s.hosts, h) = k) AS fresh
FROM f JOIN s ON s.run = f.run AND s.nth = f.nth + 1, LATERAL (SELECT least(20, CAST(ceil(1.5 * ({_MOST} - len(f.seen))) AS BIGINT)) AS budget) x WHERE len(f.seen) < {_MOST}))"""


def _answers(spark, sf_dir: str) -> DataFrame:
    """Of each run (37 of them) the hosts that nine seeds would give."""
    host = F.regexp_extract("url", "^[a-z]+://(?:www\\.)?([^/?#]*)", 1)
    return table(spark, sf_dir, "pages").select((F.col("page_id") % 37).alias("run"), (F.col("page_id") * 7 % 9).cast("int").alias("seed"), host.alias("host"), "page_id")


@query(_FOLD + " SELECT run, seed, host, CAST(o AS INTEGER) AS ordinal FROM (SELECT run, seed, unnest(added) AS host, unnest(range(len(seen) - len(added) + 1, len(seen) + 1)) AS o FROM f)")
def running_seed_budget(spark, sf_dir):
    return discovery.within_budget(_answers(spark, sf_dir), "run", "seed", ["page_id"], "host", _MOST).select("run", "seed", "host", "ordinal")


@query(_FOLD + " SELECT run, seed, CAST(budget AS INTEGER) AS budget, CAST(len(offered) AS INTEGER) AS offered, CAST(len(added) AS INTEGER) AS added FROM f WHERE seed IS NOT NULL")
def seed_contributions(spark, sf_dir):
    return discovery.seed_trace(_answers(spark, sf_dir), "run", "seed", ["page_id"], "host", _MOST)


# --- S10: attempts

_STATUS = (200, 503, 404, 429, 504, 200, 500, 301, 503, 410, 503)
_CODES = ("ENOTFOUND", "ECONNREFUSED", "CERT_HAS_EXPIRED", "ERR_TLS_X", "OTHER")


@query(f"""WITH a AS (SELECT page_id, n AS attempt, {list(_STATUS)}[CAST((page_id * 31 + n * 17) % {len(_STATUS)} AS INTEGER) + 1] AS status, (page_id + n * n) % 7 AS kind, html FROM (SELECT page_id, html, unnest(range(0, 2 + page_id % 3)) AS n FROM pages)),
c AS (SELECT *, CASE WHEN kind = 1 THEN 'TIMEOUT' WHEN kind = 3 THEN (['DNS_FAIL', 'CONNECTION_REFUSED', 'CERT_EXPIRED', 'SSL_HANDSHAKE', 'UNKNOWN'])[CAST(page_id % 5 AS INTEGER) + 1] END AS failure FROM a WHERE attempt <= 2),
d AS (SELECT *, attempt < 2 AND (coalesce(failure = 'TIMEOUT', FALSE) OR (failure IS NULL AND status IN (429, 503, 504))) AS again FROM c),
w AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY again, CASE WHEN again THEN -attempt ELSE attempt END) AS k, max(attempt) OVER (PARTITION BY page_id) AS last,
max(CASE WHEN again AND failure IS NULL THEN attempt * 1000 + status END) OVER (PARTITION BY page_id) AS retried FROM d)
SELECT page_id, CASE WHEN again THEN coalesce(retried % 1000, 0) WHEN failure IS NOT NULL THEN 0 ELSE status END AS status, CASE WHEN again OR failure IS NOT NULL THEN '' ELSE left(html, 700) END AS body,
CASE WHEN again THEN CASE WHEN retried % 1000 >= 500 THEN 'HTTP_5XX' ELSE 'UNKNOWN' END WHEN failure IS NOT NULL THEN failure WHEN status >= 500 THEN 'HTTP_5XX' WHEN status >= 400 THEN 'HTTP_4XX' END AS error,
CAST(CASE WHEN again THEN last ELSE attempt END + 1 AS INTEGER) AS attempts, CAST((['0', '2000', '8000'])[CAST(CASE WHEN again THEN last ELSE attempt END AS INTEGER) + 1] AS BIGINT) AS waited_ms FROM w WHERE k = 1""")
def fetch_attempts(spark, sf_dir):
    """Two to four logged attempts for each page; bodies are cut at 700 units."""
    i, n = F.col("page_id"), F.col("attempt")
    kind = (i + n * n) % 7
    log = table(spark, sf_dir, "pages").select("page_id", F.left("html", F.lit(900)).alias("body"), F.explode(F.sequence(F.lit(0), (i % 3 + 1).cast("int"))).alias("attempt"))
    failure = F.when(kind == 1, F.lit("TimeoutError")).when(kind == 3, F.lit("TypeError"))
    made = log.select(i.cast("string").alias("url"), "attempt", _pick(i * 31 + n * 17, _STATUS).alias("status"), "body", F.lit(None).cast("string").alias("final_url"), failure.alias("failure"), F.when(kind == 3, _pick(i, _CODES)).alias("code"))
    found = fetches.outcomes(made, body_units=700)
    return found.select(F.col("url").cast("long").alias("page_id"), "status", "body", "error", "attempts", "waited_ms")


# --- T2: stale answers


@query(f"""WITH r AS (SELECT page_id AS request_id, {_BARE} AS key, {_sql_at(7919, 30)} AS asked FROM pages),
e AS (SELECT key, created_at, max(answer) AS answer FROM (SELECT {_BARE} AS key, {_sql_at(104729, 30, 1_775_700_000)} AS created_at, CASE WHEN page_id % 10 <> 0 THEN 'c' || page_id END AS answer FROM pages WHERE page_id % 4 = 0) WHERE answer IS NOT NULL GROUP BY ALL),
j AS (SELECT request_id, created_at, answer, epoch_us(asked) - epoch_us(created_at) AS age, CASE WHEN request_id % 3 = 0 THEN NULL WHEN request_id % 3 = 1 THEN 'n' || request_id END AS made FROM r ASOF LEFT JOIN e ON r.key = e.key AND r.asked >= e.created_at)
SELECT request_id, CASE WHEN age < 3 * 86400000000 THEN 'fresh' WHEN made IS NOT NULL THEN 'new' WHEN answer IS NOT NULL THEN 'stale' ELSE 'failed' END AS source,
CASE WHEN age < 3 * 86400000000 THEN answer WHEN made IS NOT NULL THEN made ELSE answer END AS answer, CASE WHEN age < 3 * 86400000000 OR made IS NULL THEN CAST(floor(age / 86400000000) AS BIGINT) END AS age_days FROM j""")
def stale_answers(spark, sf_dir):
    """Requests by host with entries of the last weeks; one attempt in three fails, one in three isn't made."""
    i, host = F.col("page_id"), F.regexp_extract("url", "^[a-z]+://(?:www\\.)?([^/?#]*)", 1)
    pages = table(spark, sf_dir, "pages")
    requests = pages.select(i.alias("request_id"), host.alias("key"), _at(i, 7919, 30).alias("at"))
    entries = pages.where(i % 4 == 0).select(host.alias("key"), _at(i, 104729, 30, 1_775_700_000).alias("created_at"), F.when(i % 10 != 0, F.concat(F.lit("c"), i.cast("string"))).alias("answer"))
    attempts = pages.where(i % 3 < 2).select(i.alias("request_id"), F.concat(F.lit("n"), i.cast("string")).alias("answer"), F.when(i % 3 == 0, F.lit("HTTP 503")).alias("error"))
    return asof.answered(requests, entries, attempts, 3).select("request_id", "source", "answer", "age_days")


# --- K1, S21: buckets

_ROW = "place_id string, url string, score int, audited_at timestamp"


def _bucketed(spark, sf_dir: str) -> tuple[BucketedTable, DataFrame]:
    """All pages in a table of hashed buckets, and the pages."""
    i = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), i.cast("string")).alias("place_id"), "url", (i % 31).cast("int").alias("score"), _at(i, 7919, 30).alias("audited_at"), "page_id")
    out = BucketedTable(spark, _place(spark, "buckets"), _ROW, buckets=32)
    out.upsert(pages)
    return out, pages


@query(f"""SELECT CASE WHEN page_id % 100 = 9 THEN 'n' ELSE 'p' END || page_id AS place_id, CASE WHEN page_id % 100 = 7 THEN '/new' ELSE url END AS url, CAST(CASE WHEN page_id % 100 = 7 THEN 40 ELSE page_id % 31 END AS INTEGER) AS score FROM pages WHERE page_id % 100 IN (7, 9)
UNION ALL SELECT 'p' || page_id, url, CAST(page_id % 31 AS INTEGER) FROM pages WHERE page_id % 100 <> 7""")
def bucket_upsert(spark, sf_dir):
    """An upsert of one page in fifty, one in two of them new; changed ones come twice and the newer counts."""
    out, pages = _bucketed(spark, sf_dir)
    late = F.col("audited_at") + F.make_dt_interval(F.lit(1))
    changed = pages.where("page_id % 100 = 7").withColumn("url", F.lit("/new"))
    added = pages.where("page_id % 100 = 9").withColumn("place_id", F.concat(F.lit("n"), F.col("page_id").cast("string")))
    out.upsert(changed.withColumn("score", F.lit(39)).unionByName(changed.withColumns({"score": F.lit(40), "audited_at": late})).unionByName(added))
    return out.read().select("place_id", "url", "score")


@query("SELECT 'p' || page_id AS place_id, url, CAST(page_id % 31 AS INTEGER) AS score FROM pages JOIN labels ON doc_id = page_id")
def point_lookup(spark, sf_dir):
    """The pages whose numbers are labelled, by key."""
    out, _ = _bucketed(spark, sf_dir)
    return out.lookup(table(spark, sf_dir, "labels").select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("place_id"))).select("place_id", "url", "score")


# --- A19: quotas


@query(f"SELECT page_id, row_number() OVER (PARTITION BY asked::DATE ORDER BY asked, page_id) <= 60 AS allowed FROM (SELECT page_id, date_trunc('minute', {_sql_at(7919, 3)}) AS asked FROM pages)")
def daily_quota_by_histogram(spark, sf_dir):
    made = table(spark, sf_dir, "pages").select("page_id", F.date_trunc("minute", _at(F.col("page_id"), 7919, 3)).alias("at"))
    return quota.within_daily(made, "at", "page_id", 60).select("page_id", "allowed")


# --- S23: labels with faults

_STATUSES, _FAULTS = ("INTERESSIERT", "FOLLOWUP", "NO_ANSWER", "GESCHLOSSEN"), 40


@query(f"""WITH l AS (SELECT doc_id % 4 AS part, doc_id, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) + 1 AS row FROM labels)
SELECT part, row, CASE WHEN doc_id % {_FAULTS} <> 0 THEN 'p' || doc_id END AS lead_id, CASE WHEN doc_id % {_FAULTS} = 1 THEN 'MAYBE' || doc_id ELSE {_sql_list(_STATUSES)}[CAST(doc_id % 4 AS INTEGER) + 1] END AS status,
CASE WHEN doc_id % {_FAULTS} = 2 THEN 'FAX' WHEN doc_id % 3 = 0 THEN 'MAIL' END AS channel, CASE WHEN doc_id % 5 = 0 THEN 'said "no", ' || doc_id WHEN doc_id % 5 = 1 THEN 'plain ' || doc_id END AS notes,
CASE doc_id % {_FAULTS} WHEN 0 THEN 'lead_id is missing' WHEN 1 THEN 'invalid status "MAYBE' || doc_id || '"' WHEN 2 THEN 'invalid channel "FAX"' END AS fault FROM l""")
def label_file_faults(spark, sf_dir):
    """The labels as four CSV files with headers in other orders, empty lines and faults, read back with their row numbers."""
    i, path = F.col("doc_id"), _place(spark, "labels")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    number = i.cast("string")
    notes = F.when(i % 5 == 0, quoted(F.concat(F.lit('said "no", '), number))).when(i % 5 == 1, F.concat(F.lit("plain "), number)).otherwise(F.lit(""))
    cells = {
        "lead_id": F.when(i % _FAULTS != 0, F.concat(F.lit(" p"), number)).otherwise(F.lit(" ")), "status": F.when(i % _FAULTS == 1, F.concat(F.lit("MAYBE"), number)).otherwise(_pick(i, _STATUSES)),
        "channel": F.when(i % _FAULTS == 2, F.lit("FAX")).when(i % 3 == 0, F.lit("MAIL")).otherwise(F.lit("")), "notes": notes,
    }
    orders = (("lead_id", "status", "channel", "notes"), ("notes", "channel", "status", "lead_id"))
    line = F.when(i % 2 == 0, F.concat_ws(",", *[cells[c] for c in orders[0]])).otherwise(F.concat_ws(",", *[cells[c] for c in orders[1]]))
    part = (i % 4).cast("int").alias("part")
    data = table(spark, sf_dir, "labels").select(part, i.alias("nth"), F.concat(line, F.when(i % 7 == 0, F.lit("\n")).otherwise(F.lit("\r"))).alias("value"))
    head = data.select("part").distinct().select("part", F.lit(-1).cast("long").alias("nth"), F.when(F.col("part") % 2 == 0, F.lit(", ".join(orders[0]).upper())).otherwise(F.lit(",".join(orders[1]))).alias("value"))
    data.unionByName(head).repartition(4, "part").sortWithinPartitions("part", "nth").select("part", "value").write.partitionBy("part").text(path)
    rows = labels.checked_rows(spark, f"{path}/part=*")
    return rows.select(F.regexp_extract("file", "/part=([0-9]+)/", 1).cast("long").alias("part"), "row", "lead_id", "status", "channel", "notes", "fault")


# --- X13: compatibility decomposition

#: What is planted and its slug.
_NAMES = (
    ("ﬁne ﬂow", "fine-flow"), ("Ｆｕｌｌ　Ｗｉｄｔｈ", "full-width"), ("x² + ½", "x2-1-2"), ("㎏ ㎞", "kg-km"), ("① ⑳", "1-20"), ("naïve ệ", "naive-e"), ("Ελλάδα", ""), ("Müßig ß", "mussig-ss"),
    ("Müßig", "muessig"), ("ǆ ŉ", "dz-n"), ("a ﹠ b ＆ c", "a-and-b-and-c"), ("𝒶𝓫𝔠 𝟙𝟚", "abc-12"), ("℡ ™", ""), ("ª º", "a-o"), ("…", ""), ("ⅷ", "viii"),
)


@query(f"""SELECT page_id, regexp_replace(lower(regexp_replace({_BARE}, '[^A-Za-z0-9]+', '-', 'g')), '-$', '') || CASE WHEN s = '' THEN '' ELSE '-' || s END AS slug
FROM (SELECT page_id, url, {_sql_list([s for _, s in _NAMES])}[CAST(page_id % {len(_NAMES)} AS INTEGER) + 1] AS s FROM pages)""")
def slugify_unicode(spark, sf_dir):
    """Hosts with ligatures, full-width forms, combining marks, numbers in circles, units and mathematical letters behind them."""
    host = F.regexp_extract("url", "^[a-z]+://(?:www\\.)?([^/?#]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", text.slug(F.concat_ws(" ", host, _pick(F.col("page_id"), [n for n, _ in _NAMES]))).alias("slug"))


# --- K4, K5: exports

_EXPORT = "page_id long, url string, ok boolean, score int"


def _exported(spark, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    url = F.when(i % 9 == 0, F.concat(F.lit('a "b";'), "url")).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"), F.when(i % 5 != 0, i % 2 == 0).alias("ok"), (i % 31).cast("int").alias("score")).orderBy(F.desc("score"), "page_id")


_EXPORTED = "e AS (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'a \"b\";' || url ELSE url END AS url, CASE WHEN page_id % 5 <> 0 THEN page_id % 2 = 0 END AS ok, page_id % 31 AS score, row_number() OVER (ORDER BY page_id % 31 DESC, page_id) AS n FROM pages)"


@query(f"""WITH {_EXPORTED} SELECT n + 1 AS row, page_id || ';' || CASE WHEN contains(url, ';') OR contains(url, '"') THEN '"' || replace(url, '"', '""') || '"' ELSE url END || ';' || CASE WHEN ok THEN '1' WHEN NOT ok THEN '0' ELSE '' END || ';' || score AS line FROM e
UNION ALL SELECT 1, 'page_id;url;ok;score'""")
def csv_export_file(spark, sf_dir):
    """K4: the lines of an exported file, with their numbers; Spark's reader leaves out the byte order mark."""
    path = f"{_place(spark, 'export')}.csv"
    files.write_csv(_exported(spark, sf_dir), path, _EXPORT)
    return lines.numbered(spark, path).select("row", "line")


@query(f"""WITH {_EXPORTED}, c AS (SELECT max(n) AS last FROM e) SELECT 6 * (n - 1) + k + 1 AS row, CASE k WHEN 1 THEN '  {{' WHEN 2 THEN '    "page_id": ' || page_id || ',' WHEN 3 THEN '    "url": "' || replace(url, '"', '\\"') || '",' WHEN 4 THEN '    "ok": ' || coalesce(CAST(ok AS VARCHAR), 'null') || ','
WHEN 5 THEN '    "score": ' || score ELSE '  }}' || CASE WHEN n < last THEN ',' ELSE '' END END AS line FROM e, c, (SELECT unnest(range(1, 7)) AS k) UNION ALL SELECT 1, '[' UNION ALL SELECT 6 * last + 2, ']' FROM c""")
def json_export_file(spark, sf_dir):
    """K5: the lines of an exported file, with their numbers."""
    path = f"{_place(spark, 'export')}.json"
    files.write_json(_exported(spark, sf_dir), path, _EXPORT)
    return lines.numbered(spark, path).select("row", "line")


# --- S7: paged searches

_RESULTS = 45
_PLACE = "(q * 13 + p * 11 + k * (1 + q % 3)) % 60"


@query(f"""WITH RECURSIVE r AS (SELECT page_id AS q, p, k, {_PLACE} AS id FROM pages, (SELECT unnest(range(0, 7)) AS p), (SELECT unnest(range(0, 23)) AS k) WHERE k < 5 + (page_id + p) % 18),
g AS (SELECT q, p, list(id ORDER BY k)[1:20] AS ids, (q + p) % 5 <> 4 AS more, (q + 2 * p) % 11 = 10 AS failed FROM r GROUP BY ALL),
f AS (SELECT page_id AS q, 0 AS p, CAST([] AS BIGINT[]) AS taken, TRUE AS more FROM pages UNION ALL SELECT f.q, f.p + 1, CASE WHEN g.failed THEN f.taken ELSE
list_concat(f.taken, list_filter(g.ids[1 : least(20, {_RESULTS} - len(f.taken))], lambda x: (x + f.q) % 7 <> 0 AND (f.q % 2 = 0 OR x % 9 = 2 OR x % 9 = 4))) END, g.more AND NOT g.failed
FROM f JOIN g ON g.q = f.q AND g.p = f.p WHERE f.more AND f.p < 5 AND len(f.taken) < {_RESULTS}),
l AS (SELECT q, taken FROM f QUALIFY row_number() OVER (PARTITION BY q ORDER BY p DESC) = 1),
u AS (SELECT q, id, min(n) AS n FROM (SELECT q, unnest(taken) AS id, unnest(range(0, len(taken))) AS n FROM l) GROUP BY ALL)
SELECT q AS query, CAST(n AS INTEGER) AS nth, 'g' || id AS place_id, '10' || (1 + id % 9) || '0' AS plz FROM u WHERE q % 2 = 0 OR id % 9 IN (2, 4)""")
def paged_place_search(spark, sf_dir):
    """Seven stored pages for each of the queries, some failed, some the last, with places that come again or lack a name; every other query wants the codes 1030 and 1050 only."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("query"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("page"))
    place = F.expr("transform(sequence(0, CAST(4 + (query + page) % 18 AS INT)), k -> (query * 13 + page * 11 + k * (1 + query % 3)) % 60)")

    def raw(i: Column) -> Column:
        code = F.struct(F.format_string("10%d0", 1 + i % 9).alias("longText"), F.lit("").alias("shortText"), F.array(F.lit("postal_code")).alias("types"))
        return F.struct(
            F.format_string("g%d", i).alias("id"), F.struct(F.when((i + F.col("query")) % 7 != 0, F.format_string("Ort %d", i)).alias("text")).alias("displayName"), F.lit("Wien").alias("formattedAddress"), F.array(code).alias("addressComponents"),
            F.struct(F.lit(48.2).alias("latitude"), F.lit(16.3).alias("longitude")).alias("location"), F.array(F.lit("cafe")).alias("types"), F.lit("cafe").alias("primaryType"), F.lit(None).cast("string").alias("websiteUri"),
            F.lit(None).cast("string").alias("nationalPhoneNumber"), F.lit(None).cast("string").alias("internationalPhoneNumber"), F.lit("OPERATIONAL").alias("businessStatus"),
        )

    failed = (F.col("query") + 2 * F.col("page")) % 11 == 10
    stored = pages.select("query", "page", ((F.col("query") + F.col("page")) % 5 != 4).alias("more"), F.when(failed, F.lit("HTTP 500")).alias("error"), F.transform(place, raw).alias("places"))
    codes = F.when(F.col("query") % 2 == 1, F.array(F.lit("1030"), F.lit("1050")))
    return places.paged_search(stored, _RESULTS, codes).select("query", "nth", "place_id", "plz")

