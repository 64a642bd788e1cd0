"""Discovery under a budget that runs down. Ids O4, A13 of the survey.

A run asks its seeds in order. What a seed may answer depends on what earlier ones left: the smaller of a page (20) and 1.5 times the places still wanted; places
that an earlier seed gave aren't added again, and a run that has enough asks no more. So a seed gives 20 answers at most: they are cut to that before the
shuffle (a limit for each group in every task), and a run's few short lists are folded in one expression. A seed with a third of all answers costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Answers that one seed gives at most, and how many it is asked for with each place still wanted.
PER_SEED, ASKED = 20, 1.5


def budgets(answers: DataFrame, run: str, seed: str, order: list[str], place: str, most: int) -> DataFrame:
    """run, asked (array of structs seed, budget, offered, added) in the order of seeds; added: the places (array). The seed's type gives the order.

    answers: one row for each place that a seed would give, best first by `order`. Null seeds and places aren't answers."""
    w = Window.partitionBy(run, seed).orderBy(*order, place)
    known = answers.where(F.col(seed).isNotNull() & F.col(place).isNotNull())
    first = known.select(run, seed, place, F.row_number().over(w).alias("_nth")).where(F.col("_nth") <= PER_SEED)
    lists = first.groupBy(run, seed).agg(F.transform(F.sort_array(F.collect_list(F.struct("_nth", F.col(place).alias("place")))), lambda x: x["place"]).alias("places"))
    runs = lists.groupBy(run).agg(F.sort_array(F.collect_list(F.struct(F.col(seed).alias("seed"), "places"))).alias("_seeds"))
    kinds = {f.name: f.dataType.simpleString() for f in answers.schema}
    asked = f"array<struct<seed:{kinds[seed]},budget:int,offered:int,added:array<{kinds[place]}>>>"
    start = F.struct(F.array().cast(f"array<{kinds[place]}>").alias("seen"), F.array().cast(asked).alias("asked"))

    def step(s: Column, x: Column) -> Column:
        left = F.lit(most) - F.size(s["seen"])
        budget = F.least(F.lit(PER_SEED), F.ceil(left * ASKED).cast("int"))
        offered = F.slice(x["places"], 1, F.greatest(budget, F.lit(0)))
        added = F.slice(F.array_except(offered, s["seen"]), 1, F.greatest(left, F.lit(0)))
        new = F.struct(x["seed"].alias("seed"), budget.alias("budget"), F.size(offered).alias("offered"), added.alias("added"))
        after = F.struct(F.concat(s["seen"], added).alias("seen"), F.concat(s["asked"], F.array(new)).alias("asked"))
        return F.when(left > 0, after).otherwise(s)

    return runs.select(run, F.aggregate("_seeds", start, step)["asked"].alias("asked"))


def within_budget(answers: DataFrame, run: str, seed: str, order: list[str], place: str, most: int) -> DataFrame:
    """The answers that a run keeps, each place once, from the seed that gave it first, with its ordinal in the run."""
    asked = budgets(answers, run, seed, order, place, most).select(run, F.explode("asked").alias("a")).select(run, F.col("a.seed").alias(seed), F.col("a.added").alias("_added"))
    w = Window.partitionBy(run).orderBy(seed)
    before = F.sum(F.size("_added")).over(w) - F.size("_added")  # of one row for each seed of a run
    kept = asked.select(run, seed, before.alias("_before"), "_added").select(run, seed, "_before", F.posexplode("_added").alias("_i", place))
    best = [F.col(c) for c in answers.columns if c not in (run, seed, place)]
    rows = answers.join(kept, [run, seed, place]).groupBy(run, seed, place).agg(F.min(F.col("_before") + F.col("_i") + 1).cast("int").alias("ordinal"), F.min_by(F.struct(*best), F.struct(*order)).alias("_row"))
    return rows.select(run, seed, place, "_row.*", "ordinal")


def seed_trace(answers: DataFrame, run: str, seed: str, order: list[str], place: str, most: int) -> DataFrame:
    """Of each asked seed its budget, what it offered and how many places it added."""
    asked = budgets(answers, run, seed, order, place, most).select(run, F.explode("asked").alias("a"))
    return asked.select(run, F.col("a.seed").alias(seed), F.col("a.budget").alias("budget"), F.col("a.offered").alias("offered"), F.size("a.added").alias("added"))
