"""Runs from candidates to files, on small fixtures."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagelens import tables
from pagelens.config import Settings
from pagelens.functions import text
from pagelens.operators import dedupe, filters, joins, rows
from pagelens.operators.upsert import VersionedTable, append_outcomes
from pagelens.plans import audit, report
from pagelens.schemas import AUDIT, CANDIDATE, EXPORT, FETCH, OUTCOME, conform, struct
from pagelens.sinks import files
from pagelens.sources import dimensions, labels, places
from pagelens.streaming import streams

NOW = Settings(as_of=datetime(2026, 4, 20, 12), b3_enrichment=True, dns_probe=True)
GOOD = '<html><head><meta name="viewport" content="w"></head><body>' + "Beispiel Backstube Huber " * 60 + '<a href="/impressum">Impressum</a> &copy; 2024</body></html>'
IMPRINT = "<body><p>Firmenname: Huber Back GmbH</p>\n<p>Gasse 4, 1030 Wien</p>\n<p>UID: ATU12345678</p>\nTel 01 2345678 office@huber.at</body>"


def candidate(i, website=None, name="Backstube Huber", types=("shop=bakery",), address=None, phone=None):
    return (i, name, address, None, None, list(types), None, website, phone, 0.0, 0.0)


def fetch(u, body=None, status=200, error=None, ssl=True, headers=None):
    return (u, status, headers or {}, body, u if error is None else None, error, ssl, None, True)


@pytest.fixture(scope="module")
def result(spark):
    cands = spark.createDataFrame(
        [
            candidate("ok", "https://huber.at/"), candidate("none", None, "Ohne Netz"), candidate("broken", "https://kaputt.at/"), candidate("forbidden", "https://verboten.at/x"), candidate("parked", "https://parked.at/"),
            candidate("branch", "https://billa.at/filialen/1"), candidate("twin", "http://www.twin.at/?utm_source=x"), candidate("twin2", "http://twin.at"), candidate("sub1", "https://a.kette.at/"), candidate("sub2", "https://b.kette.at/"),
            candidate("guess", None, "Beispiel Backstube"), candidate("timeout", "https://langsam.at/"), candidate("closed", None, "Geschlossen"), candidate("match", None, "Gefunden"),
        ],
        struct(CANDIDATE),
    )
    good = [fetch(u, GOOD) for u in ("https://huber.at/", "https://verboten.at/x", "https://billa.at/filialen/1", "http://www.twin.at/?utm_source=x", "http://twin.at", "https://a.kette.at/", "https://b.kette.at/", "https://beispiel-backstube.at", "https://gefunden.at/")]
    fetches = spark.createDataFrame(
        [*good, fetch("https://huber.at/impressum", IMPRINT), fetch("https://kaputt.at/", error="DNS_FAIL"), fetch("https://parked.at/", "<title>For sale</title>"), fetch("https://langsam.at/", error="TIMEOUT")], struct(FETCH)
    )
    robots = dimensions.robots_rules(spark.createDataFrame([("https://verboten.at", 200, "User-agent: *\nDisallow: /", None)], "origin string, status int, body string, error string"))
    key = lambda name: spark.range(1).select(text.cache_key(F.lit(name), F.lit(None).cast("string"))).first()[0]
    matches = spark.createDataFrame(
        [(key("Geschlossen"), None, None, None, "CLOSED_PERMANENTLY", datetime(2026, 4, 1)), (key("Gefunden"), "https://gefunden.at/", "01 1", "Weg 1", "OPERATIONAL", datetime(2026, 4, 1)), (key("Ohne Netz"), "https://alt.at", None, None, None, datetime(2020, 1, 1))],
        "key string, website string, phone string, address string, business_status string, created_at timestamp",
    )
    psi = spark.createDataFrame([("https://huber.at/", 0.49, 0.9, 1.0, 0.5, datetime(2026, 4, 20), None)], "url string, performance double, seo double, accessibility double, best_practices double, fetched_at timestamp, error string")
    apex = conform(spark.createDataFrame([("apex:kette.at", "A", "https://kette.at/", 12)], "place_id string, tier string, discovered_url string, score int"), AUDIT).withColumn("apex", F.lit("kette.at"))
    got = audit.run(cands, audit.Inputs(fetches, psi, robots, matches), NOW, dimensions.branch_patterns(), apex)
    return audit.Result(*[tables.written(df, "result") for df in (got.rows, got.filtered_log, got.collapsed_log, got.duplicate_log)])


def test_audit_end_to_end(result):
    got = {r.place_id: r for r in result.rows.collect()}
    ok = got["ok"]
    assert (ok.tier, ok.intent_tier, ok.impressum_company_name, ok.impressum_uid, ok.impressum_complete, ok.last_modified_signal) == ("A", "LIVE", "Huber Back GmbH", "ATU12345678", True, 2024)
    assert ok.psi_mobile_performance == 49 and ok.tech_stack.cms == ["static_or_custom"] and ok.score == 3 + 1 + 1 + 1
    assert (got["none"].tier, got["none"].score, got["none"].discovered_url) == ("B3", 20, None)
    assert (got["broken"].tier, got["broken"].intent_tier, got["broken"].score) == ("C", "NONE", 9)
    assert (got["forbidden"].fetch_error, got["forbidden"].score) == ("ROBOTS_DISALLOWED", 6)
    assert (got["parked"].tier, got["parked"].intent_tier, got["parked"].score) == ("C", "PARKED", 22)
    assert (got["timeout"].tier, got["timeout"].intent_tier, got["timeout"].score) == ("B3", "DEAD_WEBSITE", 20)
    assert got["guess"].discovery_method == "dns-probe" and got["match"].discovered_url == "https://gefunden.at/"
    assert "closed" not in got and "branch" not in got and ("twin" in got) != ("twin2" in got)
    assert (got["apex:kette.at"].chain_detected, got["apex:kette.at"].branch_count) == (True, 2) and "sub1" not in got
    assert [r.chain_name for r in result.filtered_log.collect()] == ["Billa"]
    assert result.collapsed_log.count() == 2 and result.duplicate_log.count() == 1


def test_export_files(result, spark, tmp_path):
    assert filters.violations(result.rows, 2026).count() == 0 and filters.score_drift(result.rows.where("place_id <> 'apex:kette.at'")).count() == 0
    exported = rows.export_rows(result.rows)
    assert exported.schema.simpleString() == struct(EXPORT).simpleString()
    ordered = filters.export_order(exported)
    files.write_csv(ordered, f"{tmp_path}/x.csv")
    raw = open(f"{tmp_path}/x.csv", "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfplace_id;tier;sub_tier") and raw.count(b"\r\n") == exported.count() + 1 and raw.endswith(b"\r\n")
    assert "NO_WEBSITE+20" in raw.decode()
    files.write_json(ordered, f"{tmp_path}/x.json")
    loaded = json.load(open(f"{tmp_path}/x.json"))
    assert list(loaded[0]) == [f.name for f in struct(EXPORT)] and [x["score"] for x in loaded] == sorted((x["score"] for x in loaded), reverse=True)
    for _ in range(2):
        files.append_log(result.duplicate_log, f"{tmp_path}/logs/d.csv")
    lines = open(f"{tmp_path}/logs/d.csv").read().splitlines()
    assert len(lines) == 3 and lines[0].startswith("kept_place_id,") and "2026-04-20T12:00:00.000Z" in lines[1]


def test_report(result):
    md = report.summary(rows.export_rows(result.rows), datetime(2026, 4, 20, 12), filtered=1)
    assert md.count("## (") == 11 and "| timestamp | 2026-04-20T12:00:00.000Z |" in md and "| B1 | 0 |" in md and "kette.at | 2" in md
    assert "| A1 | 12 | 12 | 12 | 12 | 12 |" in md


def test_labels_and_history(spark, result, tmp_path):
    with open(f"{tmp_path}/l.csv", "w") as f:
        f.write('lead_id,status,channel,notes\nok,FOLLOWUP,MAIL,"said ""yes"", twice"\nghost,NO_ANSWER,,\n')
    append_outcomes(labels.read_labels(spark, f"{tmp_path}/l.csv", 1000), f"{tmp_path}/out")
    outcomes = spark.read.schema(struct(OUTCOME)).parquet(f"{tmp_path}/out")
    assert outcomes.count() == 2 and dedupe.history(outcomes).count() == 2
    lines = {x["lead_id"]: x for x in map(json.loads, (r[0] for r in files.label_lines(joins.labelled(outcomes, result.rows)).collect()))}
    assert lines["ghost"]["features"] == {} and lines["ghost"]["score"] is None and lines["ok"]["notes"] == 'said "yes", twice'
    assert list(lines["ok"]["features"]) == list(rows.FEATURES)
    with open(f"{tmp_path}/bad.csv", "w") as f:
        f.write("lead_id,status,channel,notes\nok,MAYBE,,\n")
    with pytest.raises(ValueError, match="MAYBE"):
        labels.read_labels(spark, f"{tmp_path}/bad.csv", 1)


def test_upsert_versions_and_stream(spark, result, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/audits", struct(AUDIT))
    assert table.upsert(result.rows) == 1
    n = table.read().count()
    newer = result.rows.where("place_id = 'ok'").withColumn("score", F.lit(1)).withColumn("audited_at", F.lit(datetime(2027, 1, 1)))
    newer.write.parquet(f"{tmp_path}/in")
    q = streams.upserting(spark.readStream.schema(struct(AUDIT)).parquet(f"{tmp_path}/in"), table, f"{tmp_path}/cp")
    q.awaitTermination(120)
    assert table.versions() == [1, 2] and table.read().count() == n and table.read().where("place_id = 'ok'").first().score == 1
    cands = result.rows.select("place_id").union(spark.createDataFrame([("new",)], "place_id string"))
    due = {r.place_id for r in filters.stale(cands, table.read(), Settings(as_of=datetime(2026, 4, 21))).collect()}
    assert "new" in due and "none" in due and "ok" not in due
    events = spark.createDataFrame([(1, "a", "x", None, None, 1000), (2, "b", "x", None, None, 90_000_000)], struct(OUTCOME))
    assert streams.outcome_counts(events).count() == 2 and streams.sessions(events.withColumn("at", F.timestamp_millis("created_at")), "lead_id", "at").count() == 2
    assert rows.error_rows(spark.createDataFrame([("e", "TIMEOUT")], "place_id string, error string"), NOW).first().score is None


def test_sources(spark, tmp_path):
    with open(f"{tmp_path}/map.json", "w") as f:
        json.dump({"elements": [{"type": "node", "id": 1, "lat": 1.5, "lon": 2, "tags": {"shop": "bakery", "brand": "B", "addr:postcode": "1030", "addr:housenumber": "4", "contact:phone": "1"}}, {"type": "way", "id": 2, "center": {"lat": 3, "lon": 4}, "tags": {"name": "x"}}]}, f)
    with open(f"{tmp_path}/places.json", "w") as f:
        p = {"id": "g1", "displayName": {"text": "G"}, "formattedAddress": "Weg 1, 1040 Wien", "location": {"latitude": 1, "longitude": 2}, "types": ["cafe"], "nationalPhoneNumber": "01"}
        json.dump({"places": [p, p, {"id": "g2", "displayName": {"text": "no location"}}]}, f)
    (m,) = places.map_dump(spark, f"{tmp_path}/map.json").collect()
    assert (m.place_id, m.name, m.address, m.plz, m.district, m.types, m.primary_type, m.lat) == ("osm:node:1", "B", "1030", "1030", "03", ["shop=bakery", "brand:B"], "bakery", 1.5)
    (g,) = places.places_dump(spark, f"{tmp_path}/places.json").collect()
    assert (g.plz, g.district, g.phone) == ("1040", "04", "01") and places.places_dump(spark, f"{tmp_path}/places.json", "1010").count() == 0
    gone = places.Source("gone", "x", f"{tmp_path}/missing.json", places.map_dump)
    there = places.Source("map", "x", f"{tmp_path}/map.json", places.map_dump)
    assert places.first_that_works([gone, there], spark).first().source == "map"
    with pytest.raises(ValueError):
        places.active([places.Source("off", "x", None, places.map_dump)])
    with pytest.raises(ValueError):
        dimensions.branch_patterns("- pattern: a\n  reason: b")
    with pytest.raises(ValueError):
        dimensions.branch_patterns("a: 1")
    assert dimensions.blacklist(spark).count() == 30 and dimensions.whitelist(spark).count() == 17 and dimensions.districts(spark).count() == 23 and len(dimensions.branch_patterns()) == 19


def test_robots(spark):
    body = "User-agent: bot\nDisallow: /\n\nUser-agent: a\nUser-agent: *\nDisallow: /x # c\nAllow: /x/ok\nCrawl-delay: 0.5\nUser-agent: late\nDisallow: /late"
    got = dimensions.robots_rules(spark.createDataFrame([("https://a.at", 200, body, None), ("https://b.at", 404, body, None), ("https://c.at", 200, "User-agent: *\nDisallow:", None)], "origin string, status int, body string, error string"))
    rules = {r.origin: r for r in got.collect()}
    assert [(x.allow, x.path) for x in rules["https://a.at"].rules] == [(False, "/x"), (True, "/x/ok")] and rules["https://a.at"].crawl_delay_ms == 500
    assert rules["https://b.at"].rules == [] and [(x.allow, x.path) for x in rules["https://c.at"].rules] == [(True, "/")]
    urls = spark.createDataFrame([("https://a.at/x/1",), ("https://a.at/x/ok/1",), ("https://a.at/y",), ("https://d.at/x",)], "u string")
    assert {r.u: r.robots_allowed for r in joins.with_robots(urls, got, "u").collect()} == {"https://a.at/x/1": False, "https://a.at/x/ok/1": True, "https://a.at/y": True, "https://d.at/x": True}
