"""Quality scores: sampling, consistency, extrapolation, estimates by prefix, import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import doi_prefix, iso_timestamp_or, map_key, safe_float, version_or_estimated
from siltstone.plans.entities import with_ids
from siltstone.plans.resolve import first_per_key, resolve

LOW = 14.0
SAMPLE = 100


def _hashed(id_: str, seed: int) -> Column:
    """An order that no row's place has a say in."""
    return F.md5(F.concat_ws("-", F.col(id_).cast("string"), F.lit(seed)))


def low_score_candidates(scored: DataFrame, size: int = SAMPLE, low: float = LOW, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """scored (id, publisherId, identifierType, score) -> counts of each publisher,
    and its sample of low scores drawn by hash of the id; only dois of known publishers."""
    d = scored.where("identifierType = 'doi' and publisherId <> 'unknown'")
    low_ = F.col("score") <= low
    lowest = d.groupBy("publisherId", "score").agg(F.count("*").alias("n")).groupBy("publisherId").agg(
        F.sum("n").alias("totalCount"), F.coalesce(F.sum(F.when(low_, F.col("n"))), F.lit(0)).alias("lowScoreCount"), F.min("score").alias("lowestScore"), F.min_by("n", F.struct(F.col("score").isNull().alias("z"), "score")).alias("k")
    )
    counts = lowest.select("publisherId", "totalCount", "lowScoreCount", "lowestScore", F.when(F.col("lowestScore").isNotNull(), F.col("k")).alias("lowestScoreCount"))
    w = Window.partitionBy("publisherId").orderBy(_hashed("id", seed), "id")
    sample = d.where(low_).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size).select("publisherId", "rank", "id")
    return counts, sample


def consistency(samples: DataFrame, after: DataFrame) -> DataFrame:
    """samples (publisherId, id, score), after (id, score) -> whether a publisher's
    sampled datasets agree, before and after they were scored again."""
    a = samples.withColumnRenamed("score", "before").join(after.select("id", F.col("score").alias("after")), "id", "left")
    g = a.groupBy("publisherId").agg(
        F.count("*").alias("n"), F.count("after").alias("n_after"), F.array_sort(F.collect_set("before")).alias("b"), F.array_sort(F.collect_set("after")).alias("a")
    )
    join = lambda c: F.array_join(F.transform(c, lambda x: F.format_string("%.2f", x)), ",")
    return g.select(
        "publisherId", "n", "n_after", join("b").alias("beforeUniqueScores"), (F.size("b") == 1).alias("beforeConsistent"), join("a").alias("afterUniqueScores"), (F.size("a") == 1).alias("afterConsistent"),
        F.when(F.size("a") == 1, F.col("a")[0]).alias("score"),
    )


def extrapolate(scored: DataFrame, after: DataFrame, low: float = LOW) -> DataFrame:
    """scored (id, publisherId, score), after (publisherId, score) of the sample ->
    (id, score, metricVersion, softwareVersion) to write.

    Publishers whose sample agrees pass its score to each dataset that differs or
    has none; others the median of the distinct scores to those below low.
    """
    s = after.where("score is not null").select("publisherId", "score").distinct().groupBy("publisherId").agg(F.median("score").alias("new"), F.count("*").alias("k"))
    j = scored.join(s, "publisherId")
    take = F.when(F.col("k") == 1, ~F.col("score").eqNullSafe(F.col("new"))).otherwise(F.coalesce(F.col("score") < low, F.lit(False)))
    return j.where(take).select("id", F.col("new").alias("score"), F.lit("0.8").alias("metricVersion"), F.when(F.col("k") == 1, "extrapolated").otherwise("extrapolated-inconsistent").alias("softwareVersion"))


def prefix_histogram(scored: DataFrame) -> DataFrame:
    """(prefix, score, n) of scored dois."""
    d = scored.where("score is not null").select(doi_prefix(F.col("identifier")).alias("prefix"), F.format_string("%.2f", "score").alias("score"), "id").where("prefix is not null")
    return d.groupBy("prefix", "score").agg(F.count("*").alias("n"), F.min("id").alias("first_seen"))


def prefix_modes(histogram: DataFrame) -> DataFrame:
    """The most frequent score of each prefix, the one seen first on ties."""
    return first_per_key(histogram, ["prefix"], [F.desc("n"), F.col("first_seen")]).select("prefix", "score", "n")


def estimate_by_prefix(queue: DataFrame, modes: DataFrame) -> DataFrame:
    """queue (id, identifier) with the score that its prefix most often has, null if none."""
    return queue.withColumn("prefix", doi_prefix(F.col("identifier"))).join(modes.select("prefix", "score"), "prefix", "left").select("id", "prefix", F.col("score").cast("double").alias("score"))


def estimated_with_score(rows: DataFrame, estimated: Column) -> DataFrame:
    """Rows marked as estimated that have a score."""
    return rows.where(F.coalesce(estimated, F.lit(False)) & F.col("score").isNotNull())


def score_constants(consistent: DataFrame, extra: dict[str, float]) -> DataFrame:
    """consistent (publisherId, score, n) -> (key, score, pos): what a constant map of
    scores lists, largest publishers first, fixed ones last; a fixed score takes the
    place of the publisher's own."""
    own = consistent.where(~F.col("publisherId").isin(*extra)).select(F.col("publisherId").alias("key"), "score", "n")
    fixed = consistent.sparkSession.createDataFrame([(k, float(v), -1 - i) for i, (k, v) in enumerate(extra.items())], "key string, score double, n long")
    every = with_ids(own.unionByName(fixed).withColumn("_size", -F.col("n")), ["_size", "key"], 0, "pos")
    return every.select("key", "score", "pos")


def import_score_files(rows: DataFrame, entries: DataFrame, as_of: Column) -> DataFrame:
    """Score exports of both shapes, (doi, ...) and (dataset_id, ...), field names in
    either spelling -> (datasetId, identifier, score, evaluationDate, metricVersion,
    softwareVersion, seq) of the rows whose identifier stands for a dataset. A score
    that is no number is null, a date that is none as_of, a blank version estimated."""
    either = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), F.nullif(F.col(b), F.lit("")))
    r = rows.withColumn("identifier", map_key(either("doi", "dataset_id"))).where("identifier <> ''")
    out = resolve(r, "identifier", entries)
    return out.select(
        "datasetId", "identifier", safe_float(F.col("score")).alias("score"), iso_timestamp_or(either("evaluationDate", "evaluation_date"), as_of).alias("evaluationDate"),
        version_or_estimated(either("metricVersion", "metric_version")).alias("metricVersion"), version_or_estimated(either("softwareVersion", "software_version")).alias("softwareVersion"), "seq",
    )


def import_scores(rows: DataFrame) -> DataFrame:
    """(seq, datasetId, score, evaluationDate, metricVersion, softwareVersion) -> one
    row for each dataset, the last one; blank versions become estimated."""
    r = first_per_key(rows.where("datasetId is not null"), ["datasetId"], [F.desc("seq")])
    return r.select("datasetId", F.nanvl("score", F.lit(None).cast("double")).alias("score"), "evaluationDate", version_or_estimated(F.col("metricVersion")).alias("metricVersion"), version_or_estimated(F.col("softwareVersion")).alias("softwareVersion"))
