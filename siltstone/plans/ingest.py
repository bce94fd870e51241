"""Raw records to dataset tables, with what can't be used set aside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import clean_string, clean_uri, main_identifier, or_default, published_at, safe_int, strip
from siltstone.operators.flatten import json_object, variant_creators
from siltstone.plans.entities import with_ids
from siltstone.plans.resolve import resolve, unmatched


def _identifiers(raw: DataFrame) -> DataFrame:
    """Identifiers in lower case, each once, blank ones left out, with the type under either name."""
    kind = lambda x: F.lower(F.coalesce(x["identifier_type"], x["identifierType"], F.lit("")))
    all_ = F.transform(F.coalesce("identifiers", F.array().cast(raw.schema["identifiers"].dataType)), lambda x: F.struct(F.lower(strip(clean_string(x["identifier"]))).alias("identifier"), kind(x).alias("identifierType")))
    return raw.withColumn("ids", F.array_distinct(F.filter(all_, lambda x: x["identifier"] != "")))


def ingest(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Datasets and the records set aside for want of an identifier.

    The first identifier is the main one. Texts lose control characters, the title
    stays as it is; publisherId '' becomes unknown, a pubyear that is no number 0.
    """
    r = _identifiers(raw)
    good = r.where(F.size("ids") > 0)
    text = lambda c: clean_string(F.col(c)).alias(c)
    datasets = good.select(
        F.col("seq").alias("id"), text("source"), F.get("ids", F.lit(0))["identifier"].alias("identifier"), F.get("ids", F.lit(0))["identifierType"].alias("identifierType"),
        F.coalesce("title", F.lit("")).alias("title"), text("description"), text("version"), text("publisher"), or_default(clean_string(F.col("publisher_id")), F.lit("unknown")).alias("publisherId"),
        published_at(F.coalesce("publication_date", F.lit(""))).alias("publishedAt"), F.coalesce(safe_int(F.col("pubyear")), F.lit(0)).alias("pubYear"), "subjects", "creators", "ids",
    )
    return datasets, r.where(F.size("ids") == 0).select("seq", F.lit("no identifier").alias("reason"))


#: Fields of a raw record and of the lines of exports in JSON.
RAW = ("source", "title", "description", "version", "publisher", "publisher_id", "publication_date", "pubyear")
Parser = Callable[[DataFrame], DataFrame]


def records_of_lines(lines: DataFrame, key: str = "seq", line: str = "line") -> DataFrame:
    """One JSON object per line -> raw records as ingest takes them; lines that hold
    no object, or one with a field given twice, are left out."""
    v = F.col("v")
    text = lambda f: F.try_variant_get(v, f"$.{f}", "string").alias(f)
    as_list = lambda f, kind: F.coalesce(F.try_variant_get(v, f"$.{f}", f"array<{kind}>"), F.array(F.try_variant_get(v, f"$.{f}", kind)))
    ids = F.filter(as_list("identifiers", "struct<identifier:string,identifier_type:string,identifierType:string>"), lambda x: x.isNotNull())
    subjects = F.filter(as_list("subjects", "string"), lambda x: x.isNotNull())
    d = lines.select(F.col(key).alias("seq"), json_object(F.col(line)).alias("v")).where("v is not null")
    return d.select("seq", *[text(f) for f in RAW], subjects.alias("subjects"), variant_creators(v).alias("creators"), ids.alias("identifiers"))


def ingest_lines(lines: DataFrame, parser: Parser = records_of_lines, main_type: str | None = None) -> tuple[DataFrame, DataFrame]:
    """As ingest, over lines that a parser brings to raw records. With main_type the
    main identifier is of that type, whatever its own among all identifiers is."""
    datasets, bad = ingest(parser(lines))
    return (datasets.withColumn("identifierType", F.lit(main_type)) if main_type else datasets), bad


def dataset_identifiers(datasets: DataFrame) -> DataFrame:
    return datasets.select(F.col("id").alias("datasetId"), F.posexplode("ids").alias("pos", "x")).select("datasetId", "pos", "x.identifier", "x.identifierType")


def dataset_authors(datasets: DataFrame) -> DataFrame:
    a = datasets.select(F.col("id").alias("datasetId"), F.posexplode("creators").alias("pos", "c")).where("c is not null")
    items = lambda c: F.array_join(F.filter(F.transform(F.coalesce(F.col(f"c.{c}"), F.array().cast("array<string>")), lambda x: clean_string(x)), lambda x: x != ""), "; ")
    return a.select("datasetId", "pos", clean_string(F.col("c.name_type")).alias("nameType"), clean_string(F.col("c.name")).alias("name"), items("identifiers").alias("nameIdentifiers"), items("affiliations").alias("affiliations"))


def licences(records: DataFrame, entries: DataFrame, start: int = 1) -> tuple[DataFrame, DataFrame]:
    """Rights by dataset with consecutive ids, and the keys that stand for no dataset
    with their number of records."""
    keyed = records.select("seq", main_identifier(F.col("identifiers"))["identifier"].alias("main"))
    rows = resolve(rights_rows(records), "key", entries)
    return with_ids(rows, ["seq", "datasetId", "name", "uri", "identifier"], start, "id"), unmatched(keyed, "main", entries)


def authors_with_ids(datasets: DataFrame, start: int = 1) -> DataFrame:
    """dataset_authors with consecutive ids in the order of datasets and places."""
    return with_ids(dataset_authors(datasets), ["datasetId", "pos"], start, "id")


def rights_rows(records: DataFrame) -> DataFrame:
    """(seq, identifiers, rights array) -> (seq, identifier, name, identifier_, uri):
    a row for each right with anything in it, by the record's main identifier."""
    r = records.select("seq", main_identifier(F.col("identifiers"))["identifier"].alias("key"), F.explode("rights").alias("x")).where("key is not null")
    out = r.select("seq", "key", F.nullif(F.col("x.rights"), F.lit("")).alias("name"), strip(F.nullif(F.col("x.rights_identifier"), F.lit(""))).alias("identifier"), clean_uri(F.col("x.rights_uri")).alias("uri"))
    return out.where("coalesce(name, identifier, uri) is not null")
