"""Normalisation factors by subfield and year, as of the year asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Factors where none are known.
FT, CTW, MTW = 13.46, 1.0, 1.0
DEFAULT = "DEFAULT"
LAST_YEAR = 2100


def _by_year(norms: DataFrame, last_year: int) -> DataFrame:
    """One row for each subfield and year from its first on: the latest factors by then.

    Subfields and years are few whatever the number of datasets, and an equal
    join on both shuffles or broadcasts as its size asks for, without range scans.
    """
    n = norms.where("pubyear >= 0")
    until = F.lead("pubyear").over(Window.partitionBy("subfield_id").orderBy("pubyear"))
    n = n.withColumn("_to", F.least(F.coalesce(until - 1, F.lit(last_year)), F.lit(last_year))).where("_to >= pubyear")
    known = lambda c, d: F.coalesce(c, F.lit(d))
    return n.select(
        "subfield_id", F.col("pubyear").alias("matched"), F.explode(F.sequence("pubyear", "_to")).alias("year"),
        known("ft", FT).alias("ft"), known("ctw", CTW).alias("ctw"), known("mtw", MTW).alias("mtw"),
    )


def normalization_factors(requests: DataFrame, norms: DataFrame, last_year: int = LAST_YEAR) -> DataFrame:
    """requests (id, subfield, year), norms (subfield_id, pubyear, ft, ctw, mtw) ->
    (id, ft, ctw, mtw, subfield_used, year_used, method).

    The row of the subfield with the latest year not after the one asked for, else
    of DEFAULT, else fixed factors with null method. A null year gets fixed ones.
    """
    grid = _by_year(norms, last_year)
    own = grid.where(F.col("subfield_id") != DEFAULT).select(F.col("subfield_id").alias("subfield"), "year", F.struct("matched", "ft", "ctw", "mtw").alias("own"))
    rest = grid.where(F.col("subfield_id") == DEFAULT).select("year", F.struct("matched", "ft", "ctw", "mtw").alias("rest"))
    r = requests.withColumn("subfield", F.coalesce(F.nullif("subfield", F.lit("")), F.lit(DEFAULT))).withColumn("asked", F.col("year")).withColumn("year", F.when(F.col("year") > last_year, last_year).otherwise(F.col("year")))
    j = r.join(own, ["subfield", "year"], "left").join(rest, "year", "left")
    hit = F.coalesce("own", "rest")
    method = F.when(hit.isNull(), F.lit(None)).when(F.col("own").isNull(), "Default").when(F.col("own.matched") == F.col("asked"), "Exact Year").otherwise("Closest Past Year")
    used = F.when(hit.isNull(), DEFAULT).otherwise(F.col("subfield"))
    value = lambda c, d: F.round(F.coalesce(hit[c], F.lit(d)), 6).alias(c)
    return j.select("id", value("ft", FT), value("ctw", CTW), value("mtw", MTW), used.alias("subfield_used"), F.col("asked").alias("year_used"), method.alias("method"))


def optional_factors(requests: DataFrame, norms: DataFrame) -> DataFrame:
    """As normalization_factors, each factor by itself: the subfield's latest row by
    the year asked for, and where that row lacks a factor, DEFAULT's latest row of
    any year -> (id, ft, ctw, mtw, year_gap, method); no fixed factors.

    The subfield's rows are few per year; they are laid out by year as there. A
    null subfield or year has DEFAULT's factors only.
    """
    until = F.lead("pubyear").over(Window.partitionBy("subfield_id").orderBy("pubyear"))
    grid = norms.withColumn("_to", F.least(F.coalesce(until - 1, F.lit(LAST_YEAR)), F.lit(LAST_YEAR))).where("_to >= pubyear")
    row = F.struct("pubyear", "ft", "ctw", "mtw").alias("own")
    grid = grid.select(F.col("subfield_id").alias("subfield"), F.explode(F.sequence("pubyear", "_to")).alias("year"), row)
    rest = norms.where(F.col("subfield_id") == DEFAULT).agg(F.max_by(F.struct("ft", "ctw", "mtw"), "pubyear").alias("rest"))
    j = requests.withColumn("asked", F.col("year")).withColumn("year", F.least("year", F.lit(LAST_YEAR))).join(grid, ["subfield", "year"], "left").join(F.broadcast(rest), how="left")
    method = F.when(F.col("own").isNull(), "Default").when(F.col("own.pubyear") == F.col("asked"), "Exact Year").otherwise("Closest Past Year")
    return j.select("id", *[F.coalesce(F.col(f"own.{c}"), F.col(f"rest.{c}")).alias(c) for c in ("ft", "ctw", "mtw")], (F.col("asked") - F.col("own.pubyear")).alias("year_gap"), method.alias("method"))


def subfields_of_topics(rows: DataFrame, topic: str, dictionary: DataFrame, order: str) -> DataFrame:
    """rows with the subfield of their topic, null if the dictionary (topic_id,
    subfield_id) lacks it. Topics are compared by their digits; of several entries
    the last in order counts, entries without digits are none."""
    only_digits = lambda c: F.nullif(F.regexp_replace(F.col(c), r"\D", ""), F.lit(""))
    d = dictionary.select(only_digits("topic_id").alias("_topic"), F.coalesce(F.trim("subfield_id"), F.lit("")).alias("subfield_id"), order).where("_topic is not null")
    last = d.groupBy("_topic").agg(F.max_by("subfield_id", order).alias("subfield_id"))
    return rows.withColumn("_topic", only_digits(topic)).join(last, "_topic", "left").drop("_topic")


def cascade_factors(requests: DataFrame, norms: DataFrame, any_topic: str = "ALL", unknown_year: int = -1) -> DataFrame:
    """requests (id, topic, year), norms (topic_id, year, ft, ctw, mtw) -> factors of
    the first that exists of: topic and year, all topics and year, topic and
    unknown year, all topics and unknown year; with the year brought into the
    topic's range first."""
    span = norms.where(F.col("year") != unknown_year).groupBy(F.col("topic_id").alias("topic")).agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    r = requests.join(span, "topic", "left").withColumn("y", F.when(F.col("lo").isNull(), F.col("year")).otherwise(F.least("hi", F.greatest("lo", "year"))))
    c = r.select("id", F.posexplode(F.array(F.struct(F.col("topic").alias("t"), F.col("y").alias("y")), F.struct(F.lit(any_topic).alias("t"), F.col("y").alias("y")), F.struct(F.col("topic").alias("t"), F.lit(unknown_year).alias("y")), F.struct(F.lit(any_topic).alias("t"), F.lit(unknown_year).alias("y")))).alias("rank", "c"))
    n = norms.select(F.col("topic_id").alias("t"), F.col("year").alias("y"), "ft", "ctw", "mtw")
    got = c.select("id", "rank", "c.t", "c.y").join(n, ["t", "y"]).groupBy("id").agg(F.min_by(F.struct("t", "y", "ft", "ctw", "mtw"), "rank").alias("b"))
    return requests.select("id").distinct().join(got, "id", "left").select(
        "id", F.coalesce("b.ft", F.lit(FT)).alias("ft"), F.coalesce("b.ctw", F.lit(CTW)).alias("ctw"), F.coalesce("b.mtw", F.lit(MTW)).alias("mtw"), F.col("b.t").alias("topic_used"), F.col("b.y").alias("year_used")
    )
