"""The summary of a run as Markdown. Ids K8, A10 and report sections of the survey.

Aggregates reach the driver; sections that list rows, whose number grows with the run, are frames of lines that the tasks write."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates
from ..sinks import files


def _table(title: str, columns: list[str], rows: list, empty: list | None = None) -> str:
    lines = [f"## {title}", "", "| " + " | ".join(columns) + " |", "| " + " | ".join("---" for _ in columns) + " |"]
    for r in rows or ([empty] if empty else []):
        lines.append("| " + " | ".join("-" if v is None else str(v) for v in r) + " |")
    return "\n".join(lines)


def _listed(title: str, columns: list[str], rows: DataFrame, empty: list) -> list:
    """A section as pieces: its head, and a frame of lines, one for each row in their order."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in rows.columns]), F.lit(" |"))
    head = _table(title, columns, []) + "\n"
    if not rows.limit(1).count():
        return [_table(title, columns, [], empty) + "\n"]
    return [head, rows.select(line.alias("line"))]


def sections(rows: DataFrame, run_at: datetime, filtered: int = 0, collapsed: int = 0, duplicates: int = 0) -> list:
    """The eleven sections over export rows, as texts and frames of lines in their order. The drop counts are those of this run's logs."""
    c = F.col
    cell = lambda e, none: text.table_cell(F.coalesce(F.nullif(e, F.lit("")), F.lit(none)))
    stamp = run_at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{run_at.microsecond // 1000:03d}Z"
    worst = aggregates.worst(rows).select(cell(c("name"), "(no name)"), cell(c("url"), "-"), F.coalesce("sub_tier", F.lit("null")), "score", text.truncated(F.replace(F.to_json("score_breakdown"), F.lit("|"), F.lit("/")), 80))
    b3 = rows.where("tier = 'B3'").orderBy("place_id").select("place_id", cell(c("name"), "(no name)").alias("name"), cell(c("address"), "(no address)").alias("address"), "score")
    chains = rows.where("chain_detected").orderBy("chain_name", "place_id").select(cell(c("chain_name"), "-").alias("chain_name"), "branch_count", cell(c("url"), "-").alias("url"), "score")
    emails = aggregates.email_counts(rows).first()
    stats = aggregates.score_by_sub_tier(rows).select("sub_tier", "min", "p25", "median", "p75", "max")
    before = [
        _table("(a) Run metadata", ["metric", "value"], [("timestamp", stamp), ("total_rows", rows.count()), ("filtered_chain_branches", filtered), ("collapsed_branches", collapsed), ("duplicate_urls", duplicates)]),
        _table("(b) Tier distribution", ["tier", "count"], aggregates.by_tier(rows).select("tier", "count").collect()),
        _table("(c) Sub_tier distribution", ["sub_tier", "count"], aggregates.by_sub_tier(rows).select("sub_tier", "count").collect()),
        _table("(d) Intent_tier distribution", ["intent_tier", "count"], aggregates.by_intent(rows).collect(), ["(none)", 0]),
        _table("(e) Score per sub_tier", ["sub_tier", "min", "p25", "median", "p75", "max"], stats.collect()),
        _table("(f) Top-10 worst Tier-A", ["name", "url", "sub_tier", "score", "score_breakdown"], worst.collect(), ["(none)", "-", "-", "-", "-"]),
    ]
    after = [
        _table("(i) CMS distribution", ["cms", "count"], aggregates.by_cms(rows).collect(), ["(none)", 0]),
        _table("(j) last_modified_signal decade buckets", ["bucket", "count"], aggregates.by_year(rows).select("bucket", "count").collect()),
        _table("(k) email_is_generic counts", ["value", "count"], [(0, emails.personal), (1, emails.generic), ("null", emails.none), ("total_with_email", emails.with_email)]),
    ]
    listed = _listed("(g) All B3 records", ["place_id", "name", "address", "score"], b3, ["(none)", "-", "-", "-"]) + ["\n"]
    listed += _listed("(h) Chain summary", ["chain_name", "branch_count", "canonical_url", "canonical_score"], chains, ["(none)", "-", "-", "-"]) + ["\n"]
    return ["\n\n".join(before) + "\n\n", *listed, "\n\n".join(after)]


def summary(rows: DataFrame, run_at: datetime, filtered: int = 0, collapsed: int = 0, duplicates: int = 0) -> str:
    """The report as text, for small runs."""
    pieces = sections(rows, run_at, filtered, collapsed, duplicates)
    return "".join(p if isinstance(p, str) else "".join(r.line + "\n" for r in p.toLocalIterator()) for p in pieces)


def write_summary(rows: DataFrame, path: str, run_at: datetime, filtered: int = 0, collapsed: int = 0, duplicates: int = 0) -> None:
    """K8: the report as a file; listed rows don't pass through the driver."""
    files.write_pieces(rows.sparkSession, path, sections(rows, run_at, filtered, collapsed, duplicates))
