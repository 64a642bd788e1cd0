"""Logged fetch attempts as outcomes. Id S10 of the survey.

The first attempt that isn't to be repeated decides, which is a minimum with map-side partial results: attempts of one URL are never gathered, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detect

#: Answers that are tried again, milliseconds before the next attempt (the last for all later ones), UTF-16 units that a body keeps.
RETRIED, BACKOFFS_MS, BODY_UNITS = (429, 503, 504), (2_000, 6_000, 18_000), 2 << 20


def capped(body: Column, units: int = BODY_UNITS) -> Column:
    """The first so many UTF-16 units of a text; a character of two units that would be halved goes."""
    utf16 = F.encode(F.left(body, F.lit(units)), "UTF-16BE")
    halved = F.hex(F.substring(utf16, 2 * units - 1, 1)).between("D8", "DB") & (F.length(utf16) > 2 * units)
    cut = F.decode(F.substring(utf16, 1, F.when(halved, F.lit(2 * units - 2)).otherwise(F.lit(2 * units))), "UTF-16BE")
    return F.when(F.length(body) * 2 <= units, body).otherwise(cut)  # most bodies are short


def status_error(status: Column) -> Column:
    return F.when(status >= 500, F.lit("HTTP_5XX")).when(status >= 400, F.lit("HTTP_4XX"))


def waited(attempts: Column) -> Column:
    """Milliseconds between so many attempts."""
    return F.aggregate(
        F.sequence(F.lit(0), F.greatest(attempts - 1, F.lit(0))), F.lit(0).cast("bigint"),
        lambda s, i: s + F.when(i < attempts - 1, F.get(F.array(*[F.lit(b) for b in BACKOFFS_MS]), F.least(i, F.lit(len(BACKOFFS_MS) - 1)))).otherwise(F.lit(0)),
    )


def outcomes(attempts: DataFrame, retries: int = 2, body_units: int = BODY_UNITS) -> DataFrame:
    """Url, status, body, final_url, error, attempts, waited_ms.

    attempts: url, attempt (from 0), status, body, final_url, and failure and code where no answer came. Statuses 429, 503, 504 and timeouts are tried again, `retries` times;
    then the last answer stands. Failures have status 0 and an empty body. Where the log ends before a decision, the last status is known but no body. Attempts beyond the retries, and null URLs, don't count."""
    failed = F.col("failure").isNotNull()
    error = F.when(failed, detect.fetch_error(F.col("failure"), F.col("code"))).otherwise(status_error(F.col("status")))
    again = F.when(failed, error == "TIMEOUT").otherwise(F.col("status").isin(*RETRIED)) & (F.col("attempt") < retries)
    tried = attempts.where(F.col("url").isNotNull() & (F.col("attempt") <= retries))
    answer = F.struct(
        F.when(failed, F.lit(0)).otherwise(F.col("status")).alias("status"), F.when(failed | F.col("body").isNull(), F.lit("")).otherwise(capped(F.col("body"), body_units)).alias("body"),
        F.when(failed, F.col("url")).otherwise(F.coalesce(F.nullif("final_url", F.lit("")), "url")).alias("final_url"), error.alias("error"), (F.col("attempt") + 1).cast("int").alias("attempts"),
    )
    log = tried.select("url", "attempt", F.when(~again, answer).alias("_answer"), F.when(~again, F.col("attempt")).alias("_ends"), F.when(again & ~failed, F.struct("attempt", "status")).alias("_retried"))
    ends = log.groupBy("url").agg(F.min_by("_answer", "_ends").alias("a"), F.max("_retried").alias("_last"), F.max("attempt").alias("_n"))
    status = F.coalesce("_last.status", F.lit(0))
    cut_off = F.struct(
        status.alias("status"), F.lit("").alias("body"), F.col("url").alias("final_url"), F.when(status >= 500, F.lit("HTTP_5XX")).otherwise(F.lit("UNKNOWN")).alias("error"), (F.col("_n") + 1).cast("int").alias("attempts")
    )
    out = ends.select("url", F.coalesce("a", cut_off).alias("a"))
    return out.select("url", "a.status", "a.body", "a.final_url", "a.error", "a.attempts", waited(F.col("a.attempts")).alias("waited_ms"))
