"""Yearly index of datasets and its roll-up to people and organisations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import clamp_score, number_or_default
from siltstone.plans.normalize import CTW, FT, MTW


def dataset_index(datasets: DataFrame, citations: DataFrame, mentions: DataFrame, factors: DataFrame, as_of_year: int) -> DataFrame:
    """datasets (id, pubyear, score), citations and mentions (id, year, weight),
    factors (id, ft, ctw, mtw) -> (id, year, score).

    A row for the year of publication and each year with an event; all events up
    to the year count, those before publication from publication on and in the
    years before alike. No year at all: one row at as_of_year. Weights null or 0
    are 1, factors null or not positive the fixed ones.
    """
    w = lambda c: number_or_default(F.nanvl(F.col(c), F.lit(None).cast("double")), 1.0)
    events = citations.select("id", F.coalesce("year", F.lit(as_of_year)).alias("year"), w("weight").alias("c"), F.lit(0.0).alias("m")).unionByName(
        mentions.select("id", F.coalesce("year", F.lit(as_of_year)).alias("year"), F.lit(0.0).alias("c"), w("weight").alias("m"))
    )
    d = datasets.select("id", "pubyear", clamp_score(F.col("score")).alias("fi"))
    # Each dataset's own row; without a year it only counts if no event gives one.
    own = d.select("id", F.col("pubyear").alias("year"), F.lit(0.0).alias("c"), F.lit(0.0).alias("m"))
    by_year = events.unionByName(own).groupBy("id", "year").agg(F.sum("c").alias("c"), F.sum("m").alias("m"))
    n_years = F.count("year").over(Window.partitionBy("id"))
    grid = by_year.join(d, "id").withColumn("n_years", n_years).where("year is not null or n_years = 0").withColumn("year", F.coalesce("year", F.lit(as_of_year)))
    run = Window.partitionBy("id").orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    ever = Window.partitionBy("id")
    early = F.col("year") <= F.col("pubyear")
    upto = lambda c: F.when(early, F.sum(F.when(early, F.col(c)).otherwise(0.0)).over(ever)).otherwise(F.sum(c).over(run))
    g = grid.withColumns({"cs": upto("c"), "ms": upto("m")}).join(factors.select("id", "ft", "ctw", "mtw"), "id", "left")
    f = lambda c, default: F.when(F.col(c) > 0, F.col(c)).otherwise(default)
    return g.select("id", "year", ((F.col("fi") / f("ft", FT) + F.col("cs") / f("ctw", CTW) + F.col("ms") / f("mtw", MTW)) / 3).alias("score"))


def latest_index(index: DataFrame) -> DataFrame:
    return index.groupBy("id").agg(F.max_by("score", "year").alias("score"), F.max("year").alias("year"))


def entity_index(links: DataFrame, index: DataFrame, as_of_year: int) -> DataFrame:
    """links (entity, id), index (id, year, score) -> (entity, year, score): the sum
    of each linked dataset's latest score by then, for every year from the first
    to the last, the one before as_of_year at most.

    Each dataset's series becomes its yearly changes, changes are summed per
    entity and year, and a running sum restores the level: entities times datasets
    times years is never laid out.
    """
    w = Window.partitionBy("id").orderBy("year")
    change = index.withColumn("change", F.col("score") - F.coalesce(F.lag("score").over(w), F.lit(0.0))).select("id", "year", "change")
    per = links.select("entity", "id").distinct().join(change, "id").groupBy("entity", "year").agg(F.sum("change").alias("change"))
    run = Window.partitionBy("entity").orderBy("year")
    level = per.withColumns({"score": F.sum("change").over(run.rowsBetween(Window.unboundedPreceding, 0)), "until": F.coalesce(F.lead("year").over(run) - 1, "year")})
    level = level.withColumn("until", F.least("until", F.lit(as_of_year - 1))).where("until >= year")
    return level.select("entity", F.explode(F.sequence("year", "until")).alias("year"), "score")
