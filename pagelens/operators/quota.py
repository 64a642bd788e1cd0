"""Daily quotas without a day in one task. Id A19 of the survey.

Requests are counted by second, with partial counts before the shuffle; a fold over a day's counts (86,400 at most) finds the second in which the quota is used
up. Seconds before it are allowed and later ones aren't, without any order among them; only that second's requests are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins

_SECONDS = 86_400


def _second(at: str) -> Column:
    return F.pmod(F.unix_seconds(F.col(at).cast("timestamp")), F.lit(_SECONDS)).cast("int")


def crossings(requests: DataFrame, at: str, quota: int) -> DataFrame:
    """_day, _crossing and _left: the second in which a UTC day's quota is used up, and how many of its requests are allowed; 86,400 where it isn't."""
    counts = requests.groupBy(F.to_date(at).alias("_day"), _second(at).alias("second")).agg(F.count("*").alias("n"))
    days = counts.groupBy("_day").agg(F.sort_array(F.collect_list(F.struct("second", "n"))).alias("_counts"))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(_SECONDS).alias("second"), F.lit(0).cast("bigint").alias("left"))

    def step(s: Column, x: Column) -> Column:
        over = (s["second"] == _SECONDS) & (s["seen"] + x["n"] >= quota)
        after = F.struct((s["seen"] + x["n"]).alias("seen"), F.when(over, x["second"]).otherwise(s["second"]).alias("second"), F.when(over, quota - s["seen"]).otherwise(s["left"]).alias("left"))
        return after

    folded = F.aggregate("_counts", start, step)
    return days.select("_day", folded["second"].alias("_crossing"), folded["left"].alias("_left"))


def within_daily(requests: DataFrame, at: str, tie: str, quota: int) -> DataFrame:
    """Requests with allowed: the first `quota` of each UTC day by time and tie-break. Requests without a time are none of any day and not allowed."""
    days = joins.dimension(crossings(requests.where(F.col(at).isNotNull()), at, quota))
    marked = requests.withColumn("_day", F.to_date(at)).join(days, "_day", "left").withColumn("_second", _second(at))
    edge = F.coalesce(F.col("_second") == F.col("_crossing"), F.lit(False))
    sure = marked.where(~edge).withColumn("allowed", F.coalesce(F.col("_second") < F.col("_crossing"), F.lit(False)))
    w = Window.partitionBy("_day", "_second").orderBy(at, tie)
    ranked = marked.where(edge).withColumn("allowed", F.row_number().over(w) <= F.col("_left"))
    return sure.unionByName(ranked).select(*requests.columns, "allowed")
