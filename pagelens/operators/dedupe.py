"""De-duplication by keys. Ids W1-W7, U1, U2, A11-A13, K7 of the survey.

Nothing here depends on the physical order of rows: every choice has a full order with a tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import score, url
from ..schemas import AUDIT, COLLAPSED_LOG, DUPLICATE_LOG, FILTERED_LOG, conform
from . import prefixes


def keep_best(df: DataFrame, key: Column, order: list[Column], tie: str) -> DataFrame:
    """Per key its first row by the order; rows with a null key all stay. Adds _key, _rank and _kept (the first row's tie-break value).

    The best row of a key is an aggregate with map-side partial results, joined back; so a key with very many rows, or none of them (null), is never
    gathered in one task."""
    keyed = df.withColumn("_key", key).withColumn("_order", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(tie).alias("tie")))
    best = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_order").alias("_best"))
    joined = keyed.join(best, "_key", "left")
    first = F.col("_best").isNull() | (F.col("_order") == F.col("_best"))
    return joined.withColumn("_rank", F.when(first, F.lit(1)).otherwise(F.lit(2))).withColumn("_kept", F.coalesce(F.col("_best.tie"), F.col(tie))).drop("_order", "_best")


def score_order() -> list[Column]:
    """Best score first, null last; then the earlier audit."""
    return [F.when(F.col("score").isNull(), F.lit(1)).otherwise(F.lit(0)), -F.col("score"), F.col("audited_at")]


def by_url(audits: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Survivors, and the log of the rows dropped as another's page."""
    ranked = keep_best(audits, url.dedupe_key(F.col("discovered_url")), score_order(), "place_id")
    kept = ranked.where("_rank = 1")
    losers = ranked.where("_rank = 2").join(audits.select(F.col("place_id").alias("_kept"), F.col("score").alias("_kept_score")), "_kept", "left")
    log = losers.select(
        F.col("_kept").alias("kept_place_id"), F.col("place_id").alias("dropped_place_id"), F.col("_key").alias("normalized_url"), F.col("_kept_score").alias("kept_score"), F.col("score").alias("dropped_score"),
        F.lit("same_normalized_url").alias("duplicate_reason"), F.lit(settings.as_of).cast("timestamp").alias("filtered_at"),
    )
    return conform(kept, AUDIT), conform(log, DUPLICATE_LOG)


def by_apex(audits: DataFrame, apex_audits: DataFrame, settings: Settings, suffixes: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Survivors, the log of branches dropped as those of a good site, and the log of branches collapsed into one row.

    apex_audits: apex and audit columns, one row for each apex that could be audited. Groups of one, and groups without such a row, pass.
    suffixes: public-suffix rules (`dimensions.suffix_rules`); without them common suffixes of two labels count."""
    if suffixes is None:
        rows = audits.withColumn("_apex", url.apex(F.col("discovered_url")))
    else:
        rows = prefixes.with_apex(audits, "discovered_url", suffixes, name="_apex")
    rows = rows.withColumn("_apex", F.when(F.col("tier") == "A", F.col("_apex")))
    sizes = rows.where(F.col("_apex").isNotNull()).groupBy("_apex").agg(F.count("*").cast("int").alias("_branches")).where("_branches > 1")
    canon = apex_audits.withColumn("_has", F.lit(True)).withColumnRenamed("apex", "_apex")
    groups = sizes.join(canon.select("_apex", "_has", F.col("score").alias("_score")), "_apex", "left")
    groups = groups.withColumn("_action", score.apex_action(F.col("_branches"), F.coalesce("_has", F.lit(False)), F.col("_score"))).select("_apex", "_branches", "_score", "_action")
    marked = rows.join(groups, "_apex", "left").withColumn("_action", F.coalesce("_action", F.lit("pass")))
    now = F.lit(settings.as_of).cast("timestamp")
    passed = conform(marked.where("_action = 'pass'"), AUDIT)
    made = groups.where("_action = 'collapse'").join(canon, "_apex")
    canonical = made.withColumns({"chain_detected": F.lit(True), "chain_name": F.col("_apex"), "branch_count": F.col("_branches")})
    dropped = marked.where("_action = 'drop'").select(
        "place_id", F.col("_apex").alias("chain_name"), F.coalesce("discovered_url", F.lit("")).alias("url"), F.lit("<apex-dedupe>").alias("matched_pattern"),
        F.concat(F.lit("good_apex_branch — parent site scored "), F.col("_score").cast("string")).alias("reason"), now.alias("filtered_at"),
    )
    collapsed = marked.where("_action = 'collapse'").select(
        F.col("_apex").alias("apex"), F.col("_apex").alias("chain_name"), F.col("place_id").alias("branch_place_id"), F.coalesce("discovered_url", F.lit("")).alias("branch_url"), F.col("score").alias("branch_score"), now.alias("collapsed_at"),
    )
    return passed.unionByName(conform(canonical, AUDIT)), conform(dropped, FILTERED_LOG), conform(collapsed, COLLAPSED_LOG)


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per key its first row by the order; ties by the whole row's hash."""
    rest = [F.xxhash64(*[F.col(c) for c in df.columns if not str(df.schema[c].dataType).startswith("MapType")])]
    columns = [F.col(c) for c in df.columns]
    best = df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], rest[0].alias("tie"))).alias("_row"))
    return best.select("_row.*")


def latest(df: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """Per key its newest row; ties by the larger tie-break."""
    columns = [F.col(c) for c in df.columns]
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"))).alias("_row")).select("_row.*")


#: Milliseconds of a span of a lead's outcomes that are ranked together.
SPAN_MS = 86_400_000


def history(outcomes: DataFrame) -> DataFrame:
    """Outcomes with the number of each lead's newer ones and the status before; newest first.

    A lead's outcomes are ranked by days: what stands in newer days is added, and the status before a day's first outcome comes from the day before, both from one row for each
    lead and day. So a lead with very many outcomes is spread over its days."""
    day = F.floor(F.col("created_at") / SPAN_MS)
    order = [F.desc("created_at"), F.desc("id")]
    inside = Window.partitionBy("lead_id", "_day").orderBy(*order)
    ranked = outcomes.withColumn("_day", day).withColumn("_nth", F.row_number().over(inside)).withColumn("_before", F.lead("status").over(inside))
    days = outcomes.groupBy(F.col("lead_id").alias("_lead"), day.alias("_of")).agg(F.count("*").alias("_n"), F.max_by(F.struct("status"), F.struct("created_at", "id")).alias("_newest"))
    newer = Window.partitionBy("_lead").orderBy(F.desc("_of"))
    spans = days.withColumn("_newer", F.sum("_n").over(newer) - F.col("_n")).withColumn("_older", F.lead("_newest").over(newer)["status"]).drop("_newest")
    joined = ranked.join(spans, F.col("lead_id").eqNullSafe(F.col("_lead")) & F.col("_day").eqNullSafe(F.col("_of")))
    last = F.col("_nth") == F.col("_n")
    out = joined.withColumn("nth_newest", (F.col("_nth") + F.col("_newer")).cast("int")).withColumn("previous_status", F.when(last, F.col("_older")).otherwise(F.col("_before")))
    return out.select(*outcomes.columns, "nth_newest", "previous_status").orderBy(*order)


def contributions(discovered: DataFrame, order: list[str]) -> DataFrame:
    """How many places each source added first. discovered: place_id, source and the order's columns."""
    return first_seen(discovered, "place_id", order).groupBy("source").agg(F.count("*").alias("added"))
