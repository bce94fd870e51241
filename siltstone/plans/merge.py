"""Merging incoming rows into tables, as plans over both; nothing is updated in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import clean_link, lower_sources
from siltstone.plans.entities import with_ids
from siltstone.plans.resolve import first_per_key, resolve, unmatched

FLAGS = {"datacite": "datacite", "mdc": "mdc", "openAlex": "openalex"}


# Names that exports give the fields of a citation.
FIELD_NAMES = {
    "dataset_id": ("dataset_id", "datasetId"), "doi": ("doi",), "citation_link": ("citation_link", "citationLink", "link"), "source": ("source",),
    "citation_weight": ("citation_weight", "citationWeight"), "citation_date": ("citation_date", "citedDate", "cited_date"), "seq": ("seq",),
}


def with_plain_names(rows: DataFrame) -> DataFrame:
    """An export of citations under the names used here, with its reference: the
    first of a field's names that holds something counts, a missing field is null;
    the reference is the dataset's identifier, else the doi."""
    here = lambda names: [F.col(n) for n in names if n in rows.columns]
    kinds = {"source": "array<string>", "citation_weight": "double", "seq": "long"}
    cols = {k: F.coalesce(*here(v)) if here(v) else F.lit(None) for k, v in FIELD_NAMES.items()}
    r = rows.select(*[c.cast(kinds.get(k, "string")).alias(k) for k, c in cols.items()])
    return r.withColumn("reference", F.coalesce(F.nullif("dataset_id", F.lit("")), "doi"))


def citations_by_link(rows: DataFrame, weight: str = "max") -> DataFrame:
    """(datasetId, citation_link, source, citation_weight, citation_date, seq) ->
    one row for each dataset and cleaned link: flags of all, the largest weight or
    the first that is there, and the first date. Rows whose link has nothing left are left out."""
    src = lower_sources(F.col("source"))
    r = rows.select("datasetId", clean_link(F.col("citation_link")).alias("citationLink"), src.alias("src"), F.nanvl("citation_weight", F.lit(None).cast("double")).alias("w"), F.col("citation_date").alias("citedDate"), "seq")
    r = r.where("citationLink is not null and citationLink <> ''")
    w = F.max("w") if weight == "max" else F.min_by("w", F.when(F.col("w").isNotNull(), F.col("seq")))
    flags = [F.bool_or(F.array_contains("src", name)).alias(flag) for flag, name in FLAGS.items()]
    return r.groupBy("datasetId", "citationLink").agg(*flags, w.alias("citationWeight"), F.min_by(F.struct("citedDate"), "seq").alias("d"), F.min("seq").alias("seq")).select(
        "datasetId", "citationLink", *FLAGS, "citationWeight", F.col("d.citedDate").alias("citedDate"), "seq"
    )


def merge_citations(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Both as citations_by_link gives them -> each pair of dataset and link with
    action keep, update or insert and the values after the merge: flags of either,
    the larger weight, the existing date."""
    keys = ["datasetId", "citationLink"]
    cols = [*FLAGS, "citationWeight", "citedDate"]
    i = incoming.select(*keys, *[F.col(c).alias(f"i_{c}") for c in cols], F.lit(True).alias("is_in"))
    e = existing.select(*keys, *[F.col(c).alias(f"e_{c}") for c in cols], F.lit(True).alias("is_old"))
    j = e.join(i, keys, "full_outer")
    after = {c: F.coalesce(F.col(f"e_{c}") | F.col(f"i_{c}"), f"e_{c}", f"i_{c}") for c in FLAGS}
    after["citationWeight"] = F.greatest("e_citationWeight", "i_citationWeight")
    after["citedDate"] = F.when(F.col("is_old").isNotNull(), F.col("e_citedDate")).otherwise(F.col("i_citedDate"))
    changed = None
    for c in [*FLAGS, "citationWeight"]:
        x = ~F.col(f"e_{c}").eqNullSafe(after[c])
        changed = x if changed is None else changed | x
    action = F.when(F.col("is_old").isNull(), "insert").when(F.col("is_in").isNull() | ~changed, "keep").otherwise("update")
    return j.select(*keys, action.alias("action"), *[v.alias(c) for c, v in after.items()], *[F.col(f"e_{c}").alias(f"before_{c}") for c in cols])


def merged_table(merged: DataFrame) -> DataFrame:
    return merged.select("datasetId", "citationLink", *FLAGS, "citationWeight", "citedDate")


def merge_changes(merged: DataFrame) -> DataFrame:
    """Only what a merge would change, with the values before."""
    return merged.where("action <> 'keep'")


def with_inserted_ids(merged: DataFrame, existing_ids: DataFrame) -> DataFrame:
    """merged with an id: that of the existing row (datasetId, citationLink, id),
    and for inserts consecutive ones behind the largest, in key order."""
    keys = ["datasetId", "citationLink"]
    top = existing_ids.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("top"))
    new = with_ids(merged.where("action = 'insert'").select(*keys), keys, 1, "n").join(F.broadcast(top)).select(*keys, (F.col("top") + F.col("n")).alias("id"))
    return merged.join(existing_ids.select(*keys, F.col("id").cast("long").alias("id")).unionByName(new), keys, "left")


def topics_by_dataset(rows: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (dataset_id, topic_id, score, seq, ...) -> the best row of each dataset
    that its identifier stands for, with datasetId, and the identifiers that stand
    for none with their number of rows. Rows without identifier are left out."""
    r = rows.where("dataset_id is not null and dataset_id <> ''")
    best = best_per_key(resolve(r, "dataset_id", entries), ["datasetId"], "score", [F.col("seq")])
    return best, unmatched(r, "dataset_id", entries)


def mentions_by_link(rows: DataFrame) -> DataFrame:
    """(datasetId, mention_link, source, mention_weight, mention_date, seq) -> one
    row for each dataset and cleaned link: sources in the order in which they came,
    each once, the first weight and date."""
    r = rows.select("datasetId", clean_link(F.col("mention_link")).alias("mentionLink"), F.explode_outer(lower_sources(F.col("source"))).alias("s"), "mention_weight", "mention_date", "seq")
    r = r.where("mentionLink is not null and mentionLink <> ''")
    once = r.groupBy("datasetId", "mentionLink", "s").agg(F.min("seq").alias("at"), F.min_by(F.struct("mention_weight", "mention_date"), "seq").alias("v"))
    by = once.groupBy("datasetId", "mentionLink").agg(F.array_sort(F.collect_list(F.struct("at", "s"))).alias("all"), F.min_by("v", "at").alias("v"))
    names = F.filter(F.transform("all", lambda x: x["s"]), lambda x: x.isNotNull())
    return by.select("datasetId", "mentionLink", names.alias("source"), F.col("v.mention_weight").alias("mentionWeight"), F.col("v.mention_date").alias("mentionedDate"))


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], order: str, last: bool = True) -> DataFrame:
    """target with incoming's rows in place of its own; of several incoming rows of
    a key the last (or first) in order counts."""
    new = first_per_key(incoming, keys, [F.col(order).desc() if last else F.col(order).asc()])
    new = new.select(*target.columns)
    return target.join(new.select(*keys), keys, "left_anti").select(*target.columns).unionByName(new)


def upsert_if_higher(target: DataFrame, incoming: DataFrame, keys: list[str], score: str, order: str, parents: DataFrame | None = None) -> DataFrame:
    """As upsert, but a row gives way only to a higher score; the target's goes first on ties.
    With parents, keys that these lack are left out of what comes in."""
    if parents is not None:
        incoming = incoming.join(parents.select(*keys).distinct(), keys, "left_semi")
    both = target.withColumn("_new", F.lit(0)).withColumn(order, F.lit(None).cast("long")) if order not in target.columns else target.withColumn("_new", F.lit(0))
    both = both.unionByName(incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc_nulls_last(), "_new", order)
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*target.columns)


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming keys that the target lacks, each once."""
    return incoming.select(*keys).distinct().join(target.select(*keys), keys, "left_anti")


def update_from(target: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """target with the columns' values of the same key where there are any."""
    v = values.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return target.join(v, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*[f"_{c}" for c in columns])


def best_per_key(rows: DataFrame, keys: list[str], score: str, order: list[Column | str]) -> DataFrame:
    """The row with the highest score of each key, null scores last, first seen on ties."""
    return first_per_key(rows, keys, [F.col(score).desc_nulls_last(), *order])
