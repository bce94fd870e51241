"""People and organisations from the creators of records, by exact keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import affiliations, canonical_identifier, name_identifiers, organization_key, strip, strip_parentheses
from siltstone.runtime import materialise


def creators_of(records: DataFrame, id_: str = "id", creators: str = "creators") -> DataFrame:
    """(id, pos, name_type, name, identifiers, affiliations), null creators left out."""
    c = records.select(F.col(id_).alias("id"), F.posexplode(creators).alias("pos", "c")).where("c is not null")
    return c.select("id", "pos", "c.name_type", "c.name", "c.identifiers", "c.affiliations")


def author_key(with_type: bool = False) -> Column:
    """By identifier if there is one, else by name and affiliations."""
    ids = name_identifiers(F.col("identifiers"))
    by_id = F.concat(F.lit("id:"), canonical_identifier(ids))
    kind = F.concat(F.lower(F.coalesce("name_type", F.lit(""))), F.lit("\x1f")) if with_type else F.lit("")
    by_name = F.concat(F.lit("name:"), kind, F.lower(strip(F.col("name"))), F.lit("\x1f"), F.lower(F.array_join(affiliations(F.col("affiliations")), "\x1e")))
    return F.coalesce(by_id, by_name)


def _people(creators: DataFrame) -> DataFrame:
    named = (strip(F.coalesce("name", F.lit(""))) != "") & (F.lower(strip(F.coalesce("name_type", F.lit("")))) != "organizational")
    return creators.where(named).withColumn("key", author_key())


def authors(creators: DataFrame) -> DataFrame:
    """(key, name, nameIdentifiers, affiliations, n_datasets, first_id, first_pos):
    one row for each person, shown as first seen; organisations and blank names are
    left out."""
    p = _people(creators).withColumn("at", F.struct("id", "pos"))
    shown = F.struct("name", name_identifiers(F.col("identifiers")).alias("nameIdentifiers"), affiliations(F.col("affiliations")).alias("affiliations"))
    return p.groupBy("key").agg(F.min_by(shown, "at").alias("x"), F.countDistinct("id").alias("n_datasets"), F.min("at").alias("at")).select("key", "x.*", "n_datasets", F.col("at.id").alias("first_id"), F.col("at.pos").alias("first_pos"))


def author_links(creators: DataFrame) -> DataFrame:
    return _people(creators).select("key", "id").distinct()


def _orgs(creators: DataFrame) -> DataFrame:
    a = creators.select("id", "pos", F.posexplode("affiliations").alias("item", "raw"))
    a = a.select("id", "pos", "item", strip_parentheses(F.col("raw")).alias("name")).where("name is not null and name <> ''")
    return a.withColumn("key", organization_key(F.col("name"), stripped=True)).where("key <> ''")


def organizations(creators: DataFrame) -> DataFrame:
    """(key, name, n_datasets): one row for each organisation, named as first seen."""
    return _orgs(creators).groupBy("key").agg(F.min_by("name", F.struct("id", "pos", "item")).alias("name"), F.countDistinct("id").alias("n_datasets"))


def organization_links(creators: DataFrame) -> DataFrame:
    return _orgs(creators).select("key", "id").distinct()


def with_ids(df: DataFrame, order: list[str], start: int = 0, name: str = "new_id") -> DataFrame:
    """Consecutive ids from start in the given order.

    The rows are sorted by ranges and numbered within each partition; the
    partitions' sizes, one row each, give the offsets. No task sees all rows.
    """
    low = F.lit((1 << 33) - 1)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialise(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(low)}), "numbered")
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return stored.join(offsets, "_part").withColumn(name, F.col("_offset") + F.col("_row") + start).drop("_part", "_row", "_offset", "_n")
