"""Resolving identifiers to datasets, and reports on what does not resolve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import map_key


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; ties by the given order, which must be total.

    Spark limits each key to its first row before the shuffle (WindowGroupLimit),
    so hot keys shrink on the map side.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def identifier_map(entries: DataFrame, keep: str = "last") -> DataFrame:
    """(seq, identifier, datasetId) -> (key, datasetId), one row for each key:
    the entry added last, or first."""
    picked = F.max_by if keep == "last" else F.min_by
    e = entries.where("identifier is not null and datasetId is not null").select(map_key(F.col("identifier")).alias("key"), "datasetId", "seq").where("key <> ''")
    return e.groupBy("key").agg(picked("datasetId", "seq").alias("datasetId"))


def resolve(rows: DataFrame, key: str, entries: DataFrame, keep: str = "last") -> DataFrame:
    """Rows with the datasetId that their identifier stands for; others are left out."""
    m = identifier_map(entries, keep)
    return rows.withColumn("key", map_key(F.col(key))).join(m, "key").drop("key")


def unmatched(rows: DataFrame, key: str, entries: DataFrame) -> DataFrame:
    """(key, n): identifiers that stand for nothing, and how often they are used."""
    used = rows.select(map_key(F.col(key)).alias("key")).where("key is not null and key <> ''").groupBy("key").agg(F.count("*").alias("n"))
    return used.join(identifier_map(entries), "key", "left_anti")


def map_conflicts(entries: DataFrame) -> DataFrame:
    """(key, n, n_ids, first_id) of keys with several entries."""
    e = entries.where("identifier is not null").select(map_key(F.col("identifier")).alias("key"), "datasetId", "seq")
    return e.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("datasetId").alias("n_ids"), F.min_by("datasetId", "seq").alias("first_id")).where("n > 1")


def first_seen(rows: DataFrame, key: str, order: str, entries: DataFrame) -> DataFrame:
    """Each row with its status: a key is taken when first seen, staged or
    unmatched; every later row of it is a duplicate. order must be unique.

    Firsts come from an aggregation and are joined back, so that a key with a
    large share of all rows is not ranked in one task.
    """
    r = rows.withColumn("key", map_key(F.col(key))).where("key is not null and key <> ''")
    firsts = r.groupBy("key").agg(F.min(order).alias("_first")).join(identifier_map(entries), "key", "left")
    is_first = F.col(order) == F.col("_first")
    status = F.when(~is_first, "duplicate").when(F.col("datasetId").isNull(), "unmatched").otherwise("staged")
    return r.join(firsts, "key").withColumn("status", status).withColumn("datasetId", F.when(is_first, F.col("datasetId"))).drop("_first")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a primary key would refuse, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def without_parent(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows that a foreign key would refuse."""
    return df.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
