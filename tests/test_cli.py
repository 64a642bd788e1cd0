import json

from pyspark.sql import functions as F

from pagelens import cli
from pagelens.operators import filters
from pagelens.operators.upsert import VersionedTable
from pagelens.schemas import AUDIT, FETCH, struct


def test_audit_export_label(spark, tmp_path, capsys):
    tags = {"shop": "books", "name": "Buch Huber", "addr:postcode": "1030", "website": "https://huber.at/"}
    chain = {"shop": "supermarket", "name": "Billa Plus", "brand": "Billa"}
    with open(f"{tmp_path}/m.json", "w") as f:
        json.dump({"elements": [{"type": "node", "id": 1, "lat": 1, "lon": 1, "tags": tags}, {"type": "node", "id": 2, "lat": 1, "lon": 1, "tags": chain}, {"type": "node", "id": 3, "lat": 1, "lon": 1, "tags": {"shop": "gift", "name": "Laden 1010"}}]}, f)
    spark.createDataFrame([("https://huber.at/", 200, {}, "<body>" + "text " * 400 + "</body>", "https://huber.at/", None, False, None, True)], struct(FETCH)).write.parquet(f"{tmp_path}/f")
    run = lambda *a: cli.main(["--as-of", "2026-04-20T12:00:00", *a], spark)
    run("discover", "--map", f"{tmp_path}/m.json", "--district", "Landstraße")
    assert capsys.readouterr().out == "osm:node:1\tBuch Huber\tretail\t1030\thttps://huber.at/\n"
    audit = ("audit", "--map", f"{tmp_path}/m.json", "--fetches", f"{tmp_path}/f", "--table", f"{tmp_path}/t", "--logs", f"{tmp_path}/logs", "--report", f"{tmp_path}/r.md")
    run(*audit)
    table = VersionedTable(spark, f"{tmp_path}/t", struct(AUDIT))
    assert {r.place_id: (r.tier, r.score) for r in table.read().collect()} == {"osm:node:1": ("A", 3 + 3 + 3 + 1 + 1 + 1), "osm:node:3": ("B3", 20)}
    assert "## (k)" in open(f"{tmp_path}/r.md").read()
    run("export", "--table", f"{tmp_path}/t", "--output", f"{tmp_path}/e.json", "--format", "json", "--tier", "A")
    assert [x["name"] for x in json.load(open(f"{tmp_path}/e.json"))] == ["Huber"]
    run("export", "--table", f"{tmp_path}/t", "--output", f"{tmp_path}/e.csv", "--district", "1", "--limit", "5")
    assert open(f"{tmp_path}/e.csv").read().count("\n") == 1
    with open(f"{tmp_path}/l.csv", "w") as f:
        f.write("lead_id,status,channel,notes\nosm:node:1,FOLLOWUP,CALL,\n")
    run("label", "--csv", f"{tmp_path}/l.csv", "--outcomes", f"{tmp_path}/o")
    run("export-labels", "--table", f"{tmp_path}/t", "--outcomes", f"{tmp_path}/o", "--output", f"{tmp_path}/l.jsonl")
    assert json.loads(open(f"{tmp_path}/l.jsonl").read())["score"] == 12
    table.upsert(table.read().where("tier = 'A'").withColumn("impressum_company_name", F.lit("Huber Telefon: 1")))
    run("sanitize-names", "--table", f"{tmp_path}/t")
    assert "1 names changed" in capsys.readouterr().out and table.read().where("impressum_company_name = 'Huber'").count() == 1
    ages = filters.unexpired(table.read(), "audited_at", F.lit("2026-04-22 12:00:00").cast("timestamp"), 3)
    assert ages.count() == 2 and ages.first().age_days == 2


def test_bucketed_table_suffixes_and_lookup(spark, tmp_path, capsys):
    tags = lambda name, site: {"shop": "books", "name": name, "website": site}
    with open(f"{tmp_path}/m.json", "w") as f:
        sites = ["https://a.huber.co.at/", "https://huber.at/"]
        json.dump({"elements": [{"type": "node", "id": i, "lat": 1, "lon": 1, "tags": tags(f"Laden {i}", s)} for i, s in enumerate(sites, 1)]}, f)
    (tmp_path / "psl.dat").write_text("at\nco.at\n")
    page = "<body>" + "text " * 400 + "</body>"
    spark.createDataFrame([(s, 200, {}, page, s, None, True, None, True) for s in sites], struct(FETCH)).write.parquet(f"{tmp_path}/f")
    run = lambda *a: cli.main(["--as-of", "2026-04-20T12:00:00", *a], spark)
    at = ("--table", f"{tmp_path}/t", "--buckets", "4")
    run("audit", "--map", f"{tmp_path}/m.json", "--fetches", f"{tmp_path}/f", *at, "--suffixes", f"{tmp_path}/psl.dat", "--logs", f"{tmp_path}/logs", "--report", f"{tmp_path}/r.md", "--force")
    assert (tmp_path / "r.md").read_text().count("## (") == 11
    capsys.readouterr()
    run("lookup", *at, "osm:node:2", "osm:node:9")
    (line,) = capsys.readouterr().out.splitlines()
    assert json.loads(line)["place_id"] == "osm:node:2" and json.loads(line)["url"] == "https://huber.at/"
    run("export", *at, "--output", f"{tmp_path}/e.csv")
    assert (tmp_path / "e.csv").read_text().count("osm:node:") == 2
