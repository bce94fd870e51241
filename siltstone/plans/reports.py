"""Nested dumps, search documents, rankings and dashboard figures."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import blank_to_null, strip
from siltstone.plans.resolve import first_per_key


def nested(parents: DataFrame, key: str, children: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """parents with, under each child's name, the array of its rows (child table, its
    key, the columns to keep) in the columns' order; none gives an empty array."""
    out = parents
    for name, (rows, child_key, cols) in children.items():
        held = rows.groupBy(F.col(child_key).alias(key)).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
        kind = held.schema[name].dataType
        out = out.join(held, key, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return out


def dump(datasets: DataFrame, one: dict[str, tuple[DataFrame, str, list[str]]], many: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """datasets (id, ...) with a struct for each table of at most one row a dataset,
    null where it has none, and an array for each table of several."""
    out = datasets
    for name, (rows, key, cols) in one.items():
        out = out.join(rows.select(F.col(key).alias("id"), F.struct(*cols).alias(name)), "id", "left")
    return nested(out, "id", many)


def person_documents(people: DataFrame) -> DataFrame:
    """(id, name, nameIdentifiers, affiliations) for a search index of people; lists are never null."""
    none = F.array().cast("array<string>")
    return people.where("id is not null").select("id", "name", F.coalesce("nameIdentifiers", none).alias("nameIdentifiers"), F.coalesce("affiliations", none).alias("affiliations"))


def organisation_documents(organisations: DataFrame) -> DataFrame:
    return organisations.where("id is not null").select("id", "name")


def search_documents(datasets: DataFrame, creators: DataFrame) -> DataFrame:
    """datasets (id, identifier, title, publishedAt, subjects) with authors and
    nameIdentifiers: names in order, blank ones left out, identifiers each once in
    the order in which they come."""
    c = creators.select("id", "pos", strip(F.col("name")).alias("name"), F.coalesce("identifiers", F.array().cast("array<string>")).alias("ids"))
    g = c.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "ids"))).alias("all"))
    names = F.filter(F.transform("all", lambda x: x["name"]), lambda n: n.isNotNull() & (n != ""))
    ids = F.array_distinct(F.filter(F.flatten(F.transform("all", lambda x: x["ids"])), lambda i: i.isNotNull() & (F.trim(i) != "")))
    g = g.select("id", names.alias("authors"), ids.alias("nameIdentifiers"))
    none = F.array().cast("array<string>")
    return datasets.join(g, "id", "left").select("id", "identifier", "title", "publishedAt", "subjects", F.coalesce("authors", none).alias("authors"), F.coalesce("nameIdentifiers", none).alias("nameIdentifiers"))


def ranked_entities(links: DataFrame, citations_per_dataset: DataFrame, index: DataFrame, least_datasets: int = 5, least_citations: int = 5, least_mean: float = 1.0) -> DataFrame:
    """links (entity, id), citations_per_dataset (id, n), index (entity, year, score)
    -> entities with more than so many datasets and citations and a higher mean.
    Citations are counted per dataset before the links fan them out."""
    l = links.select("entity", "id").distinct()  # noqa: E741
    per = l.join(citations_per_dataset, "id", "left").groupBy("entity").agg(F.count("*").alias("n_datasets"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_citations"))
    latest = index.groupBy("entity").agg(F.max_by("score", "year").alias("score"), F.max("year").alias("year"))
    j = per.where((F.col("n_datasets") > least_datasets) & (F.col("n_citations") > least_citations)).join(latest, "entity")
    return j.withColumn("mean", F.try_divide("score", F.nullif("n_datasets", F.lit(0)))).where(F.col("mean") > least_mean)


def top_ranked(ranked: DataFrame, by: list[str], tie: str, limit: int, digits: int = 3) -> DataFrame:
    """The first rows of a ranking: largest first, rounded, ties by name; the limit is the report's."""
    rounded = ranked.withColumns({c: F.round(c, digits) for c in by})
    return rounded.orderBy(*[F.desc_nulls_last(c) for c in by], tie).limit(limit)


def ranked_datasets(datasets: DataFrame, mentions: DataFrame, citations: DataFrame, latest: DataFrame, least: int = 0) -> DataFrame:
    """Datasets by mentions: more than `least`, with the sum of weights, citations and latest score."""
    m = mentions.groupBy("id").agg(F.count("*").alias("n_mentions"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("mention_weight")).where(F.col("n_mentions") > least)
    c = citations.groupBy("id").agg(F.count("*").alias("n_citations"))
    return datasets.join(m, "id").join(c, "id", "left").join(latest.select("id", "score"), "id", "left").withColumn("n_citations", F.coalesce("n_citations", F.lit(0)))


def by_buckets(df: DataFrame, bucket: Column, domain: list[str]) -> DataFrame:
    """(bucket, n) for each bucket of a fixed domain, 0 where there is none."""
    every = df.sparkSession.createDataFrame([(i, b) for i, b in enumerate(domain)], "pos int, bucket string")
    n = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return every.join(n, "bucket", "left").select("pos", "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def top_and_other(df: DataFrame, name: Column, top: int, other: str = "Other") -> DataFrame:
    """(name, n): the most frequent names, by name on ties, and all others in one row;
    null and blank names count with the others.

    The ranking's limit is the report's; what is counted is every row.
    """
    counts = df.groupBy(blank_to_null(name).alias("name")).agg(F.count("*").alias("n"))
    best = counts.where((F.col("name").isNotNull()) & (F.col("name") != other)).orderBy(F.desc("n"), "name").limit(top).select("name", F.lit(True).alias("is_top"))
    j = counts.join(best, "name", "left")
    return j.groupBy(F.when(F.col("is_top"), F.col("name")).otherwise(other).alias("name")).agg(F.sum("n").alias("n"))


def latest_per_dataset(rows: DataFrame) -> DataFrame:
    """(datasetId, score, year, created) -> the last year's row, the one made last on ties."""
    return first_per_key(rows, ["datasetId"], [F.desc("year"), F.desc("created"), F.desc("score")])


def totals(df: DataFrame, flag: str, count: str) -> DataFrame:
    """(flag, n_rows, total): rows and sum of a count by a flag."""
    return df.groupBy(flag).agg(F.count("*").alias("n_rows"), F.sum(count).alias("total"))


def shuffled(df: DataFrame, seed: int = 0) -> DataFrame:
    """The rows in an order drawn anew for each seed."""
    return df.orderBy(F.rand(seed))


def source_map(df: DataFrame, key: str, value: str, name: str) -> str:
    """A small table as the source text of a constant map, in key order; keys and
    values are JSON literals, which scripts read as they are."""
    rows = df.select(key, value).orderBy(key).collect()
    text = lambda x: json.dumps(x, ensure_ascii=False, default=str)
    return f"export const {name} = {{\n" + "".join(f"  {text(str(r[0]))}: {text(r[1])},\n" for r in rows) + "};\n"
