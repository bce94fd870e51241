"""Queries of the text operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import canonical_identifier, is_orcid, name_identifiers
from siltstone.llm.collapse import collapse, copies, letters_and_digits, link_letters_and_digits
from siltstone.llm.encoding import garbled_texts
from siltstone.llm.language import document_languages, fit_languages, language_segments, main_languages, normal_label_column
from siltstone.llm.leakage import leaked_items
from siltstone.llm.names import resolve_organisations, resolve_persons, restored_names, same_entity_pairs
from siltstone.llm.packing import pack, token_sizes
from siltstone.operators.flatten import flatten_creators
from siltstone.runtime import materialise, read_table

Query = Callable[[SparkSession, str], DataFrame]


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    titles = read_table(spark, d, "dataset").select(F.concat(F.lit("dataset/"), F.coalesce("source", F.lit(""))).alias("source"), "id", F.lit(-1).alias("pos"), F.col("title").alias("text"))
    raw = read_table(spark, d, "raw_datacite")
    names = flatten_creators(raw).where("child = 'creator'").select(F.lit("raw_datacite/").alias("source"), F.col("key").alias("id"), F.col("creator_pos").alias("pos"), F.col("name").alias("text"))
    found = garbled_texts(titles.unionByName(names))
    return found.select(F.when(F.col("pos") < 0, "dataset").otherwise("raw_datacite").alias("tab"), F.col("id").alias("row_key"), F.col("pos").alias("creator_pos"), "text", "restored", "written_in", "read_in")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_restored(spark, d).select("tab", "row_key", "creator_pos").distinct()


def _citations(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    given = F.coalesce(F.nullif("dataset_id", F.lit("")), F.col("doi")).alias("reference")
    return read_table(spark, d, "citations").select("seq", given, "citation_link"), {"reference": letters_and_digits, "citation_link": link_letters_and_digits}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    c, fields = _citations(spark, d)
    return copies(c, "seq", fields).select(F.col("first").alias("seq_a"), F.col("copy").alias("seq_b"))


def p4_collapsed(spark: SparkSession, d: str) -> DataFrame:
    c, fields = _citations(spark, d)
    return collapse(c, "seq", fields).select(F.col("first").alias("seq"), F.col("copies").alias("n_copies"))


def _names(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Names of persons and of organisations with what they say, and the identifiers of persons' names."""
    rows = flatten_creators(read_table(spark, d, "raw_datacite"))
    creators = rows.where("child = 'creator'")
    is_org = F.coalesce(F.col("name_type") == "Organizational", F.lit(False))
    orgs = (
        creators.where(is_org).select("name")
        .unionByName(rows.where("child = 'affiliation'").select(F.col("value").alias("name")))
        .unionByName(read_table(spark, d, "automated_organization").select("name"))
    )
    every = creators.where(~is_org).select("name", F.lit(True).alias("person")).unionByName(orgs.withColumn("person", F.lit(False))).distinct()
    said = materialise(every.join(restored_names(every), "name"), "names-said")
    ids = rows.where("child = 'identifier'").select("key", "creator_pos", canonical_identifier(name_identifiers(F.array("value"))).alias("identifier")).where(is_orcid(F.col("identifier")))
    evidence = creators.where(~is_org).select("key", "creator_pos", "name").join(ids, ["key", "creator_pos"]).select("name", "identifier").distinct()
    return said.where("person"), said.where("not person"), evidence


def _entities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Persons and organisations, one after the other: side by side their plans ask too much of a small driver."""
    persons, orgs, evidence = _names(spark, d)
    return resolve_persons(persons, evidence), resolve_organisations(orgs)


def p6_entities(spark: SparkSession, d: str) -> DataFrame:
    persons, orgs = _entities(spark, d)
    return persons.withColumn("kind", F.lit("person")).unionByName(orgs.withColumn("kind", F.lit("org")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    persons, orgs = _entities(spark, d)
    a = same_entity_pairs(persons).withColumn("kind", F.lit("person"))
    b = same_entity_pairs(orgs).withColumn("kind", F.lit("org"))
    return a.unionByName(b).select("kind", "name_a", "name_b")


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    sizes = token_sizes(read_table(spark, d, "documents"), "doc_id", "text")
    return pack(sizes).withColumnRenamed("key", "doc_id")


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_passages(spark, d).select("doc_id", "item_id")


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    return language_segments(docs, fit_languages(docs)).withColumnRenamed("key", "doc_id")


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    return main_languages(docs, language_segments(docs, fit_languages(docs))).withColumnRenamed("key", "doc_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    by_doc = document_languages(language_segments(docs, fit_languages(docs)))
    label = docs.select(F.col("doc_id").alias("key"), normal_label_column("lang").alias("label"))
    wrong = (F.col("n_langs") > 1) | (F.col("label") != F.col("lang"))
    return by_doc.join(label, "key").where(wrong).select(F.col("key").alias("doc_id"), "lang")


QUERIES: dict[str, Query] = {"p3_found": p3_found, "p3_restored": p3_restored, "p4_found": p4_found, "p4_collapsed": p4_collapsed, "p6_found": p6_found, "p6_entities": p6_entities, "p7_pack": p7_pack, "p8_found": p8_found, "p8_passages": p8_passages, "p9_found": p9_found, "p9_segments": p9_segments, "p9_documents": p9_documents}

_P4 = """
with v as (select seq, coalesce(nullif(dataset_id,''), doi) r, citation_link l from citations),
k as (select seq, regexp_replace(lower(r), '[^\\p{L}\\p{N}]', '', 'g') rk,
  regexp_replace(lower(split_part(l, '?', 1)), '[^\\p{L}\\p{N}]', '', 'g') || case when contains(l, '?') then
  array_to_string(list_sort(list_transform(string_split(substr(l, strpos(l, '?') + 1), '&'), lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{N}]', '', 'g'))), '') else '' end lk from v),
g as (select seq, min(seq) over (partition by rk, lk) first from k where rk <> '' and lk <> '')
"""
ORACLE: dict[str, str] = {
    "p4_found": _P4 + "select first seq_a, seq seq_b from g where seq > first",
    "p4_collapsed": _P4 + "select first seq, count(*) n_copies from g group by first",
}
