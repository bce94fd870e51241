"""The plans over the test tables, and their SQL.

Mentions are taken from events, topic candidates and order tables from the star
schema, everything else from the domain tables. As-of dates are constants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as X
from siltstone.plans import entities, fair, impact, ingest, merge, normalize, reports, resolve
from siltstone.runtime import materialise
from siltstone.runtime import read_table as table

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = 2026

# ------------------------------------------------------------------ shared tables


def _citations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "citations").withColumn("reference", F.coalesce(F.nullif("dataset_id", F.lit("")), "doi"))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve(_citations(spark, d), "reference", table(spark, d, "identifier_map"))


def _cited(spark: SparkSession, d: str) -> DataFrame:
    """(id, year, weight) of citations."""
    return _resolved(spark, d).select(F.col("datasetId").alias("id"), F.year(X.iso_timestamp(F.col("citation_date"))).alias("year"), F.col("citation_weight").alias("weight"))


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select((F.col("event_id") % 2000).cast("int").alias("id"), F.col("event_id").alias("seq"), F.col("user_id"), F.col("ts"), F.col("event_type"), X.year_of_text(F.col("ts").cast("string")).alias("year"), (F.col("value") / 100).alias("weight"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return fair.import_scores(table(spark, d, "fuji_score"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    s = _scores(spark, d).select(F.col("datasetId").alias("id"), "score")
    return table(spark, d, "dataset").select("id", "identifier", "identifierType", F.coalesce("publisherId", F.lit("unknown")).alias("publisherId"), "pubYear", "subjects", "publishedAt").join(s, "id", "left")


def _subfield() -> Column:
    return F.lower(F.try_element_at("subjects", F.lit(1)))


def _norms(spark: SparkSession, d: str) -> DataFrame:
    """Medians of scores by subfield and year, and a DEFAULT series."""
    s = _scored(spark, d).where("score is not null and pubYear > 0").select(F.coalesce(_subfield(), F.lit(normalize.DEFAULT)).alias("subfield_id"), F.col("pubYear").alias("pubyear"), "score")
    every = s.unionByName(s.withColumn("subfield_id", F.lit(normalize.DEFAULT)))
    return every.groupBy("subfield_id", "pubyear").agg(F.round(F.median("score"), 4).alias("ft"), F.lit(2.0).alias("ctw"), F.lit(None).cast("double").alias("mtw"))


def _factors(spark: SparkSession, d: str) -> DataFrame:
    asked = _scored(spark, d).select("id", _subfield().alias("subfield"), F.when(F.col("pubYear") > 0, F.col("pubYear")).alias("year"))
    return normalize.normalization_factors(asked, _norms(spark, d))


def _index(spark: SparkSession, d: str) -> DataFrame:
    ds = _scored(spark, d).select("id", F.year("publishedAt").alias("pubyear"), "score")
    return impact.dataset_index(ds, _cited(spark, d), _mentions(spark, d), _factors(spark, d), AS_OF)


def _creators(spark: SparkSession, d: str) -> DataFrame:
    return entities.creators_of(table(spark, d, "raw_datacite"), "seq")


def _record_dataset(spark: SparkSession, d: str) -> DataFrame:
    """(seq, id): the dataset that a raw record's main identifier stands for."""
    r = ingest.ingest(table(spark, d, "raw_datacite"))[0]
    return resolve.resolve(r.select(F.col("id").alias("seq"), "identifier"), "identifier", table(spark, d, "identifier_map")).select("seq", F.col("datasetId").alias("id"))


def _user_links(spark: SparkSession, d: str) -> DataFrame:
    l = entities.author_links(_creators(spark, d)).select(F.col("key").alias("entity"), F.col("id").alias("seq"))  # noqa: E741
    return l.join(_record_dataset(spark, d), "seq").select("entity", "id").distinct()


def _org_links(spark: SparkSession, d: str) -> DataFrame:
    l = entities.organization_links(_creators(spark, d)).select(F.col("key").alias("entity"), F.col("id").alias("seq"))  # noqa: E741
    return l.join(_record_dataset(spark, d), "seq").select("entity", "id").distinct()


_KEY = "lower(regexp_replace({}, '^[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}]+|[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}]+$', '', 'g'))"


def _key(c: str) -> str:
    return _KEY.format(c)


_ISO = r"regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}([T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{{1,6}})?)?(Z|[+-](0\d|1[0-4]):[0-5]\d)?)?')"
_YEAR = "case when " + _ISO.format("citation_date") + " then year(try_cast(citation_date as timestamptz) at time zone 'UTC') end"
_MAP = f"m as (select {_key('identifier')} k, arg_max(datasetId, seq) datasetId from identifier_map where identifier is not null and datasetId is not null group by 1 having k <> '')"
_CIT = f"c as (select *, {_key("coalesce(nullif(dataset_id,''),doi)")} k from citations)"
_RES = f"{_MAP}, {_CIT}, r as (select c.*, m.datasetId from c join m using (k))"
_SCORES = """sc as (select datasetId, case when isnan(score) then null else score end score, evaluationDate, coalesce(nullif(trim(metricVersion),''),'estimated') metricVersion,
  coalesce(nullif(trim(softwareVersion),''),'estimated') softwareVersion from (select *, row_number() over (partition by datasetId order by seq desc) n from fuji_score where datasetId is not null) where n = 1)"""
_SCORED = _SCORES + """, sd as (select d.id, identifier, identifierType, coalesce(publisherId,'unknown') publisherId, pubYear, lower(subjects[1]) subfield, publishedAt, score from dataset d left join sc on sc.datasetId = d.id)"""
_NORMS = """n0 as (select coalesce(subfield,'DEFAULT') subfield_id, pubYear pubyear, score from sd where score is not null and pubYear > 0),
norms as (select subfield_id, pubyear, round(median(score),4) ft, 2.0 ctw, cast(null as double) mtw from (select * from n0 union all select 'DEFAULT', pubyear, score from n0) group by 1, 2)"""
_FACTORS = """req as (select id, coalesce(nullif(subfield,''),'DEFAULT') subfield, case when pubYear > 0 then pubYear end "year" from sd),
own as (select req.id, max(n.pubyear) py from req join norms n on n.subfield_id = req.subfield and n.subfield_id <> 'DEFAULT' and n.pubyear <= req."year" group by 1),
dflt as (select req.id, max(n.pubyear) py from req join norms n on n.subfield_id = 'DEFAULT' and n.pubyear <= req."year" group by 1),
fac as (select req.id, round(coalesce(a.ft, b.ft, 13.46),6) ft, round(cast(coalesce(a.ctw, b.ctw, 1.0) as double),6) ctw, round(cast(coalesce(a.mtw, b.mtw, 1.0) as double),6) mtw,
  case when own.py is null and dflt.py is null then 'DEFAULT' else req.subfield end subfield_used, req."year" year_used,
  case when own.py is null and dflt.py is null then null when own.py is null then 'Default' when own.py = req."year" then 'Exact Year' else 'Closest Past Year' end "method"
  from req left join own using (id) left join dflt using (id) left join norms a on a.subfield_id = req.subfield and a.pubyear = own.py
  left join norms b on own.py is null and b.subfield_id = 'DEFAULT' and b.pubyear = dflt.py)"""
_INDEX = f"""{_RES}, {_SCORED}, {_NORMS}, {_FACTORS},
ev as (select datasetId id, coalesce({_YEAR}, {AS_OF}) y, case when citation_weight is null or isnan(citation_weight) or citation_weight = 0 then 1.0 else citation_weight end c, 0.0 m from r
  union all select cast(event_id % 2000 as int), year(ts at time zone 'UTC'), 0.0, case when "value" = 0 then 1.0 else "value" / 100 end from events),
g as (select id, y, sum(c) c, sum(m) m from (select ev.* from ev join sd using (id) union all select id, year(publishedAt at time zone 'UTC'), 0, 0 from sd where publishedAt is not null
  union all select id, {AS_OF}, 0, 0 from sd where publishedAt is null and id not in (select id from ev)) group by 1, 2),
p as (select g.*, year(sd.publishedAt at time zone 'UTC') py, greatest(0, least(100, coalesce(score,0))) fi from g join sd using (id)),
ix as (select p.id, p.y, (p.fi / fac.ft + sum(q.c) / fac.ctw + sum(q.m) / fac.mtw) / 3 score from p join p q on q.id = p.id and q.y <= greatest(p.y, coalesce(p.py, p.y)) join fac on fac.id = p.id group by p.id, p.y, p.fi, fac.ft, fac.ctw, fac.mtw)"""

Q: dict[str, Query] = {}
S: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        Q[name] = f
        if sql:
            S[name] = sql
        return f

    return add


# ------------------------------------------------------------------ resolving


@query("identifier_resolve", f"with {_RES} select seq, datasetId from r")
def _(spark, d):
    return _resolved(spark, d).select("seq", "datasetId")


@query("identifier_unmatched", f"with {_MAP}, {_CIT} select k as \"key\", count(*) n from c where k is not null and k <> '' and k not in (select k from m) group by 1")
def _(spark, d):
    return resolve.unmatched(_citations(spark, d), "reference", table(spark, d, "identifier_map"))


@query("identifier_conflicts", f"select {_key('identifier')} as \"key\", count(*) n, count(distinct datasetId) n_ids, arg_min(datasetId, seq) first_id from identifier_map where identifier is not null group by 1 having count(*) > 1")
def _(spark, d):
    return resolve.map_conflicts(table(spark, d, "identifier_map"))


_P15 = f"""with {_MAP}, raw as (select seq, pubyear, publisher_id, {_key('identifiers[1].identifier')} k from raw_datacite), f as (select *, row_number() over (partition by k order by seq) n from raw where k is not null and k <> '')
select seq, k as "key", case when n > 1 then 'duplicate' when m.datasetId is null then 'unmatched' else 'staged' end status, case when n = 1 then m.datasetId end datasetId, try_cast(pubyear as int) pubYear, coalesce(publisher_id,'') publisherId from f left join m using (k)"""


@query("pubyear_backfill", _P15)
def _(spark, d):
    raw = table(spark, d, "raw_datacite").select("seq", F.try_element_at("identifiers", F.lit(1))["identifier"].alias("first_id"), "pubyear", "publisher_id")
    r = resolve.first_seen(raw, "first_id", "seq", table(spark, d, "identifier_map"))
    return r.select("seq", "key", "status", "datasetId", X.safe_int(F.col("pubyear")).alias("pubYear"), F.coalesce("publisher_id", F.lit("")).alias("publisherId"))


@query("duplicate_keys", "select datasetId, identifier, identifierType, count(*) n from identifier_map group by all having count(*) > 1")
def _(spark, d):
    return resolve.duplicate_keys(table(spark, d, "identifier_map"), ["datasetId", "identifier", "identifierType"])


@query("without_parent", "select seq, datasetId from fuji_score where datasetId not in (select id from dataset)")
def _(spark, d):
    return resolve.without_parent(table(spark, d, "fuji_score"), "datasetId", table(spark, d, "dataset"), "id").select("seq", "datasetId")


@query("distinct_links", "select distinct l_suppkey entity, l_partkey id from lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_partkey").alias("id")).distinct()


# ------------------------------------------------------------------ merging

_LINK = r"regexp_replace(citation_link, '[^\p{L}\p{N}./:_~-]', '', 'g')"
_BY_LINK = f"""by_link as (select par, datasetId, {_LINK} citationLink, bool_or(list_contains(list_transform(src, lambda x: lower(x)), 'datacite')) datacite, bool_or(list_contains(list_transform(src, lambda x: lower(x)), 'mdc')) mdc,
 bool_or(list_contains(list_transform(src, lambda x: lower(x)), 'openalex')) openAlex, max(case when isnan(citation_weight) then null else citation_weight end) citationWeight, arg_min_null(citation_date, seq) citedDate
 from (select *, seq % 2 par, coalesce(source, []) src from r) where {_LINK} <> '' group by 1, 2, 3)"""
_MERGE = f"""with {_RES}, {_BY_LINK}, o as (select * from by_link where par = 0), i as (select * from by_link where par = 1),
j as (select coalesce(o.datasetId, i.datasetId) datasetId, coalesce(o.citationLink, i.citationLink) citationLink, o.datasetId is not null old, i.datasetId is not null inn,
 coalesce(o.datacite or i.datacite, o.datacite, i.datacite) datacite, coalesce(o.mdc or i.mdc, o.mdc, i.mdc) mdc, coalesce(o.openAlex or i.openAlex, o.openAlex, i.openAlex) openAlex,
 greatest(o.citationWeight, i.citationWeight) citationWeight, case when o.datasetId is not null then o.citedDate else i.citedDate end citedDate,
 o.datacite b1, o.mdc b2, o.openAlex b3, o.citationWeight b4, o.citedDate b5 from o full join i on o.datasetId = i.datasetId and o.citationLink = i.citationLink),
a as (select *, case when not old then 'insert' when not inn or (datacite is not distinct from b1 and mdc is not distinct from b2 and openAlex is not distinct from b3 and citationWeight is not distinct from b4) then 'keep' else 'update' end "action" from j)"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    r = _resolved(spark, d)
    return merge.merge_citations(merge.citations_by_link(r.where("seq % 2 = 1")), merge.citations_by_link(r.where("seq % 2 = 0")))


@query("citation_merge", _MERGE + ' select datasetId, citationLink, "action", datacite, mdc, openAlex, citationWeight, citedDate from a')
def _(spark, d):
    return _merged(spark, d).select("datasetId", "citationLink", "action", *merge.FLAGS, "citationWeight", "citedDate")


@query("citation_merge_dryrun", _MERGE + ' select datasetId, citationLink, "action", datacite, mdc, openAlex, citationWeight, b1 before_datacite, b2 before_mdc, b3 before_openAlex, b4 before_citationWeight from a where "action" <> \'keep\'')
def _(spark, d):
    m = merge.merge_changes(_merged(spark, d))
    return m.select("datasetId", "citationLink", "action", *merge.FLAGS, "citationWeight", *[f"before_{c}" for c in (*merge.FLAGS, "citationWeight")])


@query("citation_first_weight", f"with {_RES} select datasetId, {_LINK} citationLink, arg_min(w, seq) filter (w is not null) citationWeight from (select *, case when isnan(citation_weight) then null else citation_weight end w from r) where {_LINK} <> '' group by 1, 2")
def _(spark, d):
    r = _resolved(spark, d)
    return merge.citations_by_link(r, weight="first").select("datasetId", "citationLink", "citationWeight")


_MENTION = f"""with {_RES}, base as (select datasetId, {_LINK} mentionLink, citation_date dt, seq, source from r where {_LINK} <> ''),
x as (select datasetId, mentionLink, seq, unnest(list_transform(source, lambda s: lower(s))) s from base where source is not null),
o as (select datasetId, mentionLink, s, min(seq) t from x where s is not null group by 1, 2, 3), oo as (select datasetId, mentionLink, string_agg(s, ',' order by t, s) sources from o group by 1, 2),
b as (select datasetId, mentionLink, arg_min_null(dt, seq) mentionedDate from base group by 1, 2)
select b.datasetId, b.mentionLink, coalesce(oo.sources, '') sources, b.mentionedDate from b left join oo using (datasetId, mentionLink)"""


@query("mention_merge", _MENTION)
def _(spark, d):
    rows = _resolved(spark, d).withColumnsRenamed({"citation_link": "mention_link", "citation_weight": "mention_weight", "citation_date": "mention_date"})
    return merge.mentions_by_link(rows).select("datasetId", "mentionLink", F.array_join("source", ",").alias("sources"), "mentionedDate")


def _topics(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")  # noqa: E741
    return l.select(F.col("l_partkey").alias("datasetId"), F.concat("l_returnflag", "l_linestatus").alias("topicId"), F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_tax")).alias("score"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))


_TOPICS = "t as (select l_partkey datasetId, l_returnflag || l_linestatus topicId, nullif(l_tax, 0) score, l_orderkey * 8 + l_linenumber seq from lineitem)"


@query("topic_best", f"with {_TOPICS} select datasetId, topicId, score from t qualify row_number() over (partition by datasetId order by score desc nulls last, seq) = 1")
def _(spark, d):
    return merge.best_per_key(_topics(spark, d), ["datasetId"], "score", [F.col("seq")]).select("datasetId", "topicId", "score")


@query("topic_upsert", f"""with {_TOPICS}, o as (select * from t where seq % 3 = 0 qualify row_number() over (partition by datasetId order by score desc nulls last, seq) = 1),
 i as (select * from t where seq % 3 <> 0 qualify row_number() over (partition by datasetId order by seq desc) = 1)
 select datasetId, topicId, score from i union all select datasetId, topicId, score from o where datasetId not in (select datasetId from i)""")
def _(spark, d):
    t = _topics(spark, d)
    old = merge.best_per_key(t.where("seq % 3 = 0"), ["datasetId"], "score", [F.col("seq")])
    return merge.upsert(old, t.where("seq % 3 <> 0"), ["datasetId"], "seq").select("datasetId", "topicId", "score")


@query("topic_conditional_upsert", f"""with {_TOPICS}, o as (select * from t where seq % 3 = 0 qualify row_number() over (partition by datasetId order by score desc nulls last, seq) = 1)
 select datasetId, topicId, score from (select *, 0 n from o union all select *, 1 from t where seq % 3 <> 0) qualify row_number() over (partition by datasetId order by score desc nulls last, n, seq) = 1""")
def _(spark, d):
    t = _topics(spark, d)
    old = merge.best_per_key(t.where("seq % 3 = 0"), ["datasetId"], "score", [F.col("seq")])
    return merge.upsert_if_higher(old, t.where("seq % 3 <> 0"), ["datasetId"], "score", "seq").select("datasetId", "topicId", "score")


@query("job_insert_if_absent", "select distinct datasetId from fuji_score where seq % 2 = 1 and datasetId is not null and datasetId not in (select datasetId from fuji_score where seq % 2 = 0 and datasetId is not null)")
def _(spark, d):
    f = table(spark, d, "fuji_score").where("datasetId is not null")
    return merge.insert_if_absent(f.where("seq % 2 = 0"), f.where("seq % 2 = 1"), ["datasetId"])


@query("update_from_values", "with v as (select seq id, try_cast(pubyear as int) y from raw_datacite) select d.id, coalesce(v.y, d.pubYear) pubYear from dataset d left join v using (id)")
def _(spark, d):
    v = table(spark, d, "raw_datacite").select(F.col("seq").cast("int").alias("id"), X.safe_int(F.col("pubyear")).alias("pubYear"))
    return merge.update_from(table(spark, d, "dataset").select("id", "pubYear"), v, "id", ["pubYear"])


# ------------------------------------------------------------------ factors and index


@query("norm_factor_asof", f"with {_SCORED}, {_NORMS}, {_FACTORS} select * from fac")
def _(spark, d):
    return _factors(spark, d)


@query("norm_factor_cascade", f"""with {_SCORED}, {_NORMS}, cn as (select subfield_id topic, pubyear y, ft from norms where subfield_id <> 'DEFAULT' union all select 'ALL', pubyear, ft from norms where subfield_id = 'DEFAULT' union all select 'ALL', -1, 9.5),
 span as (select topic, min(y) lo, max(y) hi from cn where y <> -1 group by 1),
 q as (select id, coalesce(subfield,'none') topic, pubYear yr from sd), c as (select q.id, q.topic, case when lo is null then yr else least(hi, greatest(lo, yr)) end y from q left join span using (topic))
 select c.id, coalesce(a.ft, b.ft, e.ft, f.ft, 13.46) ft, case when a.ft is not null or e.ft is not null and b.ft is null then c.topic else 'ALL' end topic_used, case when a.ft is not null or b.ft is not null then c.y else -1 end year_used
 from c left join cn a on a.topic = c.topic and a.y = c.y left join cn b on b.topic = 'ALL' and b.y = c.y left join cn e on e.topic = c.topic and e.y = -1 left join cn f on f.topic = 'ALL' and f.y = -1""")
def _(spark, d):
    n = _norms(spark, d).select(F.when(F.col("subfield_id") == normalize.DEFAULT, "ALL").otherwise(F.col("subfield_id")).alias("topic_id"), F.col("pubyear").alias("year"), "ft", "ctw", "mtw")
    n = n.unionByName(spark.range(1).select(F.lit("ALL").alias("topic_id"), F.lit(-1).alias("year"), F.lit(9.5).alias("ft"), F.lit(1.0).alias("ctw"), F.lit(1.0).alias("mtw")))
    asked = _scored(spark, d).select("id", F.coalesce(_subfield(), F.lit("none")).alias("topic"), F.col("pubYear").alias("year"))
    return normalize.cascade_factors(asked, n).select("id", "ft", "topic_used", "year_used")


@query("impact_series", f"with {_INDEX} select id, cast(y as int) as \"year\", round(score, 5) score from ix")
def _(spark, d):
    return _index(spark, d).select("id", "year", F.round("score", 5).alias("score"))


@query("impact_latest", f"with {_INDEX}, l as (select id, arg_max(score, y) score, max(y) y from ix group by 1) select l.id, d.identifier, d.identifierType, cast(l.y as int) as \"year\", round(l.score, 5) score from l join dataset d using (id)")
def _(spark, d):
    latest = impact.latest_index(_index(spark, d))
    return latest.join(table(spark, d, "dataset").select("id", "identifier", "identifierType"), "id").select("id", "identifier", "identifierType", "year", F.round("score", 5).alias("score"))


_CARRY = """, {links}, ch as (select id, y, score - coalesce(lag(score) over (partition by id order by y), 0) v, score, lead(y) over (partition by id order by y) nx from ix),
 sp as (select lk.entity, min(y) lo, least(max(y), 2025) hi from lk join ix using (id) group by 1 having hi >= lo), ys as (select entity, unnest(range(lo, hi + 1)) y from sp),
 s as (select ys.entity, ys.y, sum(ch.score) score from ys join lk using (entity) join ch on ch.id = lk.id and ch.y <= ys.y and (ch.nx is null or ch.nx > ys.y) group by 1, 2)"""
_SUPP = "lk as (select distinct cast(l_suppkey as bigint) entity, cast(l_partkey as int) id from lineitem)"
_NAT = "lk as (select distinct s_nationkey entity, cast(l_partkey as int) id from lineitem join supplier on s_suppkey = l_suppkey)"


def _supplier_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_partkey").cast("int").alias("id"))


def _nation_links(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("entity"), "s_nationkey")
    return _supplier_links(spark, d).join(s, "entity").select(F.col("s_nationkey").alias("entity"), "id")


@query("impact_users", f"with {_INDEX}{_CARRY.format(links=_SUPP)} select entity, cast(y as int) as \"year\", round(score, 4) score from s")
def _(spark, d):
    return impact.entity_index(_supplier_links(spark, d), _index(spark, d), AS_OF).select("entity", "year", F.round("score", 4).alias("score"))


@query("impact_orgs", f"with {_INDEX}{_CARRY.format(links=_NAT)} select entity, cast(y as int) as \"year\", round(score, 3) score from s")
def _(spark, d):
    return impact.entity_index(_nation_links(spark, d), _index(spark, d), AS_OF).select("entity", "year", F.round("score", 3).alias("score"))


_TOP = 100


def _ranked(spark: SparkSession, d: str, links: DataFrame, named: DataFrame) -> DataFrame:
    per = _cited(spark, d).groupBy("id").agg(F.count("*").alias("n"))
    shared = materialise(links, "links")
    ranked = reports.ranked_entities(shared, per, impact.entity_index(shared, _index(spark, d), AS_OF))
    return reports.top_ranked(ranked.join(named, "entity"), ["score"], "entity", _TOP)


@query("top_datasets_by_mentions", f"""with {_INDEX}, mn as (select cast(event_id % 2000 as int) id, count(*) n_mentions, sum("value" / 100) w from events group by 1), nc as (select datasetId id, count(*) n from r group by 1), la as (select id, arg_max(score, y) score from ix group by 1)
 select d.id, d.identifier, d.identifierType, d.title, d.publisher, n_mentions, round(w, 4) mention_weight, coalesce(nc.n, 0) n_citations, round(la.score, 4) score from dataset d join mn using (id) left join nc using (id) left join la using (id)
 order by n_mentions desc, mention_weight desc, d.id limit {_TOP}""")
def _(spark, d):
    ds = table(spark, d, "dataset").select("id", "identifier", "identifierType", "title", "publisher")
    r = reports.ranked_datasets(ds, _mentions(spark, d), _cited(spark, d), impact.latest_index(_index(spark, d)))
    top = reports.top_ranked(r, ["n_mentions", "mention_weight"], "id", _TOP, digits=4)
    return top.select("id", "identifier", "identifierType", "title", "publisher", "n_mentions", "mention_weight", "n_citations", F.round("score", 4).alias("score"))


# ------------------------------------------------------------------ entities and ingest

_CTRL = "regexp_replace(coalesce({0},''), '[\\x{{FFFD}}\\x00-\\x1F\\x7F-\\x{{9F}}]', '', 'g')"


_AUTH = r"""with c0 as (select seq id, unnest(creators) c, generate_subscripts(creators, 1) - 1 pos from raw_datacite),
c1 as (select id, pos, c.name_type kind, c."name" nm, list_filter(list_transform(coalesce(c.identifiers, []), lambda x: regexp_replace(x, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g')), lambda x: x is not null) raw_ids, c.affiliations aff from c0 where c is not null),
c2 as (select id, pos, nm, list_sort(list_filter(list_transform(raw_ids, lambda x: lower(trim(case when contains(x, 'orcid.org/') then substr(x, strpos(x, 'orcid.org/') + 10) when starts_with(lower(x), 'orcid:') and contains(x, 'orcid:') then substr(x, strpos(x, 'orcid:') + 6) else x end))), lambda x: x <> '')) ids,
 list_filter(coalesce(aff, []), lambda x: x is not null and x <> '') aff from c1 where coalesce(regexp_replace(nm, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g'), '') <> '' and lower(trim(coalesce(kind, ''))) <> 'organizational'),
c3 as (select *, list_transform(aff, lambda x: trim(x)) a0 from c2), """ + ", ".join(
    f"c{i + 4} as (select * exclude (a{i}), list_transform(a{i}, lambda x: case when regexp_full_match(x, '(?s)\\(.*\\)') then trim(regexp_replace(x, '(?s)^\\((.*)\\)$', '\\1')) else x end) a{i + 1} from c{i + 3})" for i in range(3)
) + r""", k as (select id, pos, nm, ids, list_sort(a3) afs, coalesce('id:' || coalesce(list_filter(ids, lambda x: regexp_full_match(x, '([0-9a-f]{4}-){3}[0-9a-f]{3}[0-9a-fx]'))[1], ids[1]),
 'name:' || lower(regexp_replace(nm, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g')) || chr(31) || lower(array_to_string(list_sort(a3), chr(30)))) as kk from c6)"""


@query("author_resolution", _AUTH + """ select kk as "key", arg_min(nm, (id, pos)) as "name", arg_min(array_to_string(ids, ';'), (id, pos)) nameIdentifiers, arg_min(array_to_string(afs, ';'), (id, pos)) affiliations, count(distinct id) n_datasets from k group by 1""")
def _(spark, d):
    a = entities.authors(_creators(spark, d))
    return a.select("key", "name", F.array_join("nameIdentifiers", ";").alias("nameIdentifiers"), F.array_join("affiliations", ";").alias("affiliations"), "n_datasets")


@query("author_ids", _AUTH + ', g as (select kk, min((id, pos)) t from k group by 1) select kk as "key", cast(row_number() over (order by t) + 99 as bigint) new_id from g')
def _(spark, d):
    return entities.with_ids(entities.authors(_creators(spark, d)), ["first_id", "first_pos"], 100).select("key", "new_id")


@query("author_links", _AUTH + ' select distinct kk as "key", id from k')
def _(spark, d):
    return entities.author_links(_creators(spark, d))


def _nested_parens(inner: str) -> str:
    """The same, as steps of one query."""
    steps = [f"p0 as ({inner})"]
    for i in range(4):
        steps.append(f"p{i + 1} as (select * replace (case when regexp_full_match(nm, '(?s)\\(.*\\)') then trim(regexp_replace(nm, '(?s)^\\((.*)\\)$', '\\1')) else nm end as nm) from p{i})")
    return ", ".join(steps)


_ORGS = "with c as (select seq id, unnest(creators) c, generate_subscripts(creators, 1) pos from raw_datacite), a as (select id, pos, unnest(c.affiliations) raw, generate_subscripts(c.affiliations, 1) item from c), " + _nested_parens(
    "select id, pos, item, trim(raw) nm from a where raw is not null"
) + ", k as (select *, lower(trim(regexp_replace(nm, '\\(.*?\\)', '', 'g'))) as kk from p4 where nm <> '')"


@query("org_resolution", _ORGS + ' select kk as "key", arg_min(nm, (id, pos, item)) "name", count(distinct id) n_datasets from k where kk <> \'\' group by 1')
def _(spark, d):
    return entities.organizations(_creators(spark, d))


@query("org_links", _ORGS + " select distinct kk as \"key\", id from k where kk <> ''")
def _(spark, d):
    return entities.organization_links(_creators(spark, d))


_RECORD = f""", u as (select seq, unnest(identifiers) x, generate_subscripts(identifiers, 1) p from raw_datacite), v as (select seq, p, lower(trim({_CTRL.format('x.identifier')})) i from u),
 f as (select * from v where i <> '' qualify row_number() over (partition by seq order by p) = 1), {_MAP}, rd as (select f.seq, m.datasetId id from f join m on m.k = f.i)"""


@query("user_dataset_links", _AUTH + _RECORD + " select distinct k.kk entity, rd.id from k join rd on rd.seq = k.id")
def _(spark, d):
    return _user_links(spark, d)


@query("org_dataset_links", _ORGS + _RECORD + " select distinct k.kk entity, rd.id from k join rd on rd.seq = k.id where k.kk <> ''")
def _(spark, d):
    return _org_links(spark, d)


_RANKED = """, nc as (select datasetId id, count(*) n from r group by 1), pe as (select entity, count(*) n_datasets, cast(coalesce(sum(n),0) as bigint) n_citations from lk left join nc using (id) group by 1),
 la as (select entity, arg_max(score, y) score, max(y) y from s group by 1), rk as (select entity, n_datasets, n_citations, round(score, 3) score, cast(y as int) as "year" from pe join la using (entity) where n_datasets > 5 and n_citations > 5 and score / n_datasets > 1)"""
_LINKED = _RECORD.replace(f", {_MAP}", "")


@query("top_users", _AUTH + ", " + _INDEX + _LINKED + _CARRY.format(links="lk as (select distinct k.kk entity, rd.id from k join rd on rd.seq = k.id)") + _RANKED + f"""
 , nm as (select kk entity, arg_min(nm, (id, pos)) "name", arg_min(array_to_string(afs[1:2], '; '), (id, pos)) affiliations from k group by 1) select rk.*, "name", affiliations from rk join nm using (entity) order by score desc, entity limit {_TOP}""")
def _(spark, d):
    named = entities.authors(_creators(spark, d)).select(F.col("key").alias("entity"), "name", X.first_two(F.col("affiliations")).alias("affiliations"))
    return _ranked(spark, d, _user_links(spark, d), named).select("entity", "name", "affiliations", "n_datasets", "n_citations", "score", "year")


@query("top_orgs", _ORGS.replace("with c as (", "with oc as (").replace("from c)", "from oc)") + ", " + _INDEX + _LINKED + _CARRY.format(links="lk as (select distinct k.kk entity, rd.id from k join rd on rd.seq = k.id where k.kk <> '')") + _RANKED + f"""
 , nm as (select kk entity, arg_min(nm, (id, pos, item)) "name" from k where kk <> '' group by 1) select rk.*, "name" from rk join nm using (entity) order by score desc, entity limit {_TOP}""")
def _(spark, d):
    named = entities.organizations(_creators(spark, d)).select(F.col("key").alias("entity"), "name")
    return _ranked(spark, d, _org_links(spark, d), named).select("entity", "name", "n_datasets", "n_citations", "score", "year")


_RAW_INGEST = f"""with u as (select seq, unnest(identifiers) x, generate_subscripts(identifiers, 1) p from raw_datacite), v as (select seq, p, lower(trim({_CTRL.format('x.identifier')})) i, lower(coalesce(x.identifier_type, x."identifierType", '')) t from u),
 f as (select * from v where i <> '' qualify row_number() over (partition by seq order by p) = 1)
 select seq id, {_CTRL.format('source')} source, i identifier, t identifierType, coalesce(title,'') title, {_CTRL.format('description')} description, {_CTRL.format('"version"')} "version", {_CTRL.format('publisher')} publisher,
 coalesce(nullif({_CTRL.format('publisher_id')}, ''), 'unknown') publisherId, coalesce(try_cast(pubyear as int), 0) pubYear,
 strftime(coalesce(case when {_ISO.format('pd')} then try_cast(pd as timestamptz) at time zone 'UTC' end, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') publishedAt, array_to_string(list_transform(subjects, lambda x: coalesce(x, '')), '|') subjects
 from (select *, regexp_replace(regexp_replace(publication_date, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g'), '[+-](1[5-9]|[2-9]\\d):?\\d{{2}}$', '') pd from raw_datacite) join f using (seq)"""


@query("raw_ingest", _RAW_INGEST)
def _(spark, d):
    ds, _bad = ingest.ingest(table(spark, d, "raw_datacite"))
    return ds.select("id", "source", "identifier", "identifierType", "title", "description", "version", "publisher", "publisherId", "pubYear",
        F.date_format("publishedAt", "yyyy-MM-dd HH:mm:ss").alias("publishedAt"), F.array_join("subjects", "|", "").alias("subjects"))


@query("raw_quarantine", f"""with u as (select seq, unnest(identifiers) x from raw_datacite), g as (select distinct seq from u where trim({_CTRL.format('x.identifier')}) <> '') select seq, 'no identifier' reason from raw_datacite where seq not in (select seq from g)""")
def _(spark, d):
    return ingest.ingest(table(spark, d, "raw_datacite"))[1]


@query("raw_identifiers", f"""with u as (select seq, unnest(identifiers) x, generate_subscripts(identifiers, 1) p from raw_datacite), v as (select seq, p, lower(trim({_CTRL.format('x.identifier')})) i, lower(coalesce(x.identifier_type, x."identifierType", '')) t from u),
 f as (select seq, i, t, min(p) p from v where i <> '' group by 1, 2, 3) select seq datasetId, i identifier, t identifierType, cast(row_number() over (partition by seq order by p) - 1 as int) pos from f""")
def _(spark, d):
    return ingest.dataset_identifiers(ingest.ingest(table(spark, d, "raw_datacite"))[0])


def _list(c: str) -> str:
    return f"array_to_string(list_filter(list_transform(coalesce({c}, []), lambda x: {_CTRL.format('x')}), lambda y: y <> ''), '; ')"


@query("raw_authors", _RECORD.replace(", u as", "with u as", 1) + f""", c as (select seq, unnest(creators) c, generate_subscripts(creators, 1) - 1 pos from raw_datacite where seq in (select seq from f))
 select seq datasetId, cast(pos as int) pos, {_CTRL.format('c.name_type')} nameType, {_CTRL.format('c."name"')} "name", {_list('c.identifiers')} nameIdentifiers, {_list('c.affiliations')} affiliations from c where c is not null""")
def _(spark, d):
    return ingest.dataset_authors(ingest.ingest(table(spark, d, "raw_datacite"))[0])


def _rights(spark: SparkSession, d: str) -> DataFrame:
    right = lambda s: F.struct(s.alias("rights"), F.concat(F.when(F.length(s) % 2 == 0, "https://rights.example/").otherwise("info:eu-repo/"), s).alias("rights_uri"), F.lit(" ").alias("rights_identifier"))
    ids = F.transform("identifiers", lambda x: F.struct(x["identifier"].alias("identifier"), x["identifier_type"].alias("identifier_type")))
    return table(spark, d, "raw_datacite").select("seq", ids.alias("identifiers"), F.transform("subjects", right).alias("rights"))


@query("license_explode", """with u as (select seq, coalesce(list_filter(identifiers, lambda x: x.identifier_type = 'doi')[1], identifiers[1]).identifier k, unnest(subjects) s from raw_datacite)
 select seq, k as "key", nullif(s, '') "name", '' identifier, case when length(s) % 2 = 0 then 'https://rights.example/' || s end uri from u where k is not null""")
def _(spark, d):
    return ingest.rights_rows(_rights(spark, d))


# ------------------------------------------------------------------ scores


@query("fuji_upsert", f"with {_SCORES} select * from sc")
def _(spark, d):
    return _scores(spark, d)


_CAND = f"with {_SCORED}, c as (select * from sd where identifierType = 'doi' and publisherId <> 'unknown')"


@query("fuji_candidates", _CAND + """, lo as (select publisherId, min(score) m from c group by 1) select c.publisherId, count(*) totalCount, count(case when score <= 14 then 1 end) lowScoreCount, lo.m lowestScore, case when lo.m is not null then count(case when score = lo.m then 1 end) end lowestScoreCount from c join lo using (publisherId) group by c.publisherId, lo.m""")
def _(spark, d):
    return fair.low_score_candidates(_scored(spark, d))[0]


@query("fuji_sample", _CAND + " select publisherId, cast(row_number() over (partition by publisherId order by md5(id || '-0'), id) as int) as rank, id from c where score <= 40 qualify rank <= 100")
def _(spark, d):
    return fair.low_score_candidates(_scored(spark, d), low=40.0)[1]


def _after(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("id", "publisherId", F.when(F.col("id") % 7 != 0, F.round(F.length("publisherId") + F.when(F.col("publisherId").endswith("1"), 0).otherwise(F.col("id") % 3), 2).cast("double")).alias("score"))


_AFTER = "af as (select id, publisherId, case when id % 7 <> 0 then cast(length(publisherId) + case when publisherId like '%1' then 0 else id % 3 end as double) end score from sd)"


_LISTED = "coalesce(array_to_string(list_transform(list_sort(list_distinct(list({0}) filter ({0} is not null))), lambda x: printf('%.2f', x)), ','), '')"


@query("fuji_consistency", f"with {_SCORED}, {_AFTER}, s as (select * from sd) select s.publisherId, count(*) n, count(af.score) n_after, {_LISTED.format('s.score')} beforeUniqueScores, {_LISTED.format('af.score')} afterUniqueScores, count(distinct s.score) = 1 beforeConsistent, count(distinct af.score) = 1 afterConsistent, case when count(distinct af.score) = 1 then max(af.score) end score from s left join af using (id) group by 1")
def _(spark, d):
    c = fair.consistency(_scored(spark, d).select("publisherId", "id", "score"), _after(spark, d))
    return c.select("publisherId", "n", "n_after", "beforeUniqueScores", "afterUniqueScores", "beforeConsistent", "afterConsistent", "score")


@query("fuji_extrapolate", f"with {_SCORED}, {_AFTER}, m as (select publisherId, median(distinct score) nw, count(distinct score) k from af where score is not null group by 1) select sd.id, m.nw score, '0.8' metricVersion, case when k = 1 then 'extrapolated' else 'extrapolated-inconsistent' end softwareVersion from sd join m using (publisherId) where case when k = 1 then sd.score is distinct from m.nw else coalesce(sd.score < 14, false) end")
def _(spark, d):
    return fair.extrapolate(_scored(spark, d), _after(spark, d))


_HIST = f"with {_SCORED}, h as (select split_part(identifier, '/', 1) prefix, printf('%.2f', score) score, count(*) n, min(id) first_seen from sd where score is not null and identifier like '10.%' group by 1, 2)"


@query("doi_prefix_histogram", _HIST + " select prefix, score, n, first_seen from h")
def _(spark, d):
    return fair.prefix_histogram(_scored(spark, d))


@query("doi_prefix_mode", _HIST + " select prefix, score, n from h qualify row_number() over (partition by prefix order by n desc, first_seen) = 1")
def _(spark, d):
    return fair.prefix_modes(fair.prefix_histogram(_scored(spark, d)))


@query("doi_prefix_estimate", _HIST + ", md as (select prefix, score from h qualify row_number() over (partition by prefix order by n desc, first_seen) = 1), q as (select id, case when identifier like '10.%' then split_part(identifier, '/', 1) end prefix from sd where score is null) select id, q.prefix, cast(md.score as double) score from q left join md using (prefix)")
def _(spark, d):
    s = _scored(spark, d)
    return fair.estimate_by_prefix(s.where("score is null").select("id", "identifier"), fair.prefix_modes(fair.prefix_histogram(s)))


# ------------------------------------------------------------------ dumps and reports


@query("nested_dump", """with l as (select l_orderkey k, count(*) n_lines, string_agg(l_linenumber || ':' || l_partkey, ',' order by l_linenumber, l_linenumber || ':' || l_partkey) lines from lineitem group by 1) select o_orderkey id, coalesce(n_lines, 0) n_lines, coalesce(lines, '') lines from orders left join l on k = o_orderkey""")
def _(spark, d):
    l = table(spark, d, "lineitem").withColumn("line", F.concat_ws(":", "l_linenumber", "l_partkey"))  # noqa: E741
    n = reports.nested(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id", {"lines": (l, "l_orderkey", ["l_linenumber", "line"])})
    return n.select("id", F.size("lines").cast("long").alias("n_lines"), F.array_join(F.transform("lines", lambda x: x["line"]), ",").alias("lines"))


@query("search_docs", f"with ri as ({_RAW_INGEST}), " + r"""c as (select seq id, unnest(creators) c, generate_subscripts(creators, 1) pos from raw_datacite), s as (select id, pos, regexp_replace(c."name", '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') nm, coalesce(c.identifiers, []) ids from c where c is not null),
 a as (select id, string_agg(nm, '|' order by pos) filter (nm <> '') authors from s group by 1), i as (select id, pos, unnest(ids) x, generate_subscripts(ids, 1) p from s), j as (select id, x, min((pos, p)) t from i where trim(x) <> '' group by 1, 2), k as (select id, string_agg(x, '|' order by t) nids from j group by 1)
 select r.id, r.identifier, r.title, r.publishedAt, r.subjects, coalesce(authors, '') authors, coalesce(nids, '') nameIdentifiers from ri r left join a on a.id = r.id left join k on k.id = r.id""")
def _(spark, d):
    r = ingest.ingest(table(spark, d, "raw_datacite"))[0].select("id", "identifier", "title", "publishedAt", "subjects")
    s = reports.search_documents(r, _creators(spark, d))
    return s.select("id", "identifier", "title", F.date_format("publishedAt", "yyyy-MM-dd HH:mm:ss").alias("publishedAt"), F.array_join("subjects", "|", "").alias("subjects"), F.array_join("authors", "|").alias("authors"), F.array_join("nameIdentifiers", "|").alias("nameIdentifiers"))


_BUCKETS = ["unknown", "before 2000", "2000-2009", "2010-2019", "2020 on"]


@query("datasets_by_year", """with d(pos, bucket) as (values (0,'unknown'),(1,'before 2000'),(2,'2000-2009'),(3,'2010-2019'),(4,'2020 on')), c as (select case when coalesce(pubYear,0) = 0 then 'unknown' when pubYear < 2000 then 'before 2000' when pubYear between 2000 and 2009 then '2000-2009' when pubYear between 2010 and 2019 then '2010-2019' else '2020 on' end bucket, count(*) n from dataset group by 1)
 select pos, bucket, cast(coalesce(n,0) as bigint) n from d left join c using (bucket)""")
def _(spark, d):
    y = F.coalesce("pubYear", F.lit(0))
    b = F.when(y == 0, _BUCKETS[0]).when(y < 2000, _BUCKETS[1]).when(y.between(2000, 2009), _BUCKETS[2]).when(y.between(2010, 2019), _BUCKETS[3]).otherwise(_BUCKETS[4])
    return reports.by_buckets(table(spark, d, "dataset"), b, _BUCKETS)


def _top(c: str, n: int) -> str:
    return f"with c as (select nullif(trim({c}),'') nm, count(*) n from dataset group by 1), b as (select nm from c where nm is not null and nm <> 'Other' order by n desc, nm limit {n}) select case when nm in (select nm from b) then nm else 'Other' end \"name\", cast(sum(n) as bigint) n from c group by 1"


@query("publishers_topn_other", _top("publisher", 10))
def _(spark, d):
    return reports.top_and_other(table(spark, d, "dataset"), F.col("publisher"), 10)


@query("fields_topn_other", _top("lower(subjects[1])", 5))
def _(spark, d):
    return reports.top_and_other(table(spark, d, "dataset"), _subfield(), 5)


@query("latest_per_dataset", "select datasetId, score, \"year\" from (select l_partkey datasetId, l_quantity score, cast(year(l_shipdate at time zone 'UTC') as int) \"year\", l_shipdate created from lineitem) qualify row_number() over (partition by datasetId order by \"year\" desc, created desc, score desc) = 1")
def _(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_partkey").alias("datasetId"), F.col("l_quantity").alias("score"), F.year("l_shipdate").alias("year"), F.col("l_shipdate").alias("created"))  # noqa: E741
    return reports.latest_per_dataset(l).select("datasetId", "score", "year")


@query("analysis_totals", f"with {_SCORED}, {_AFTER}, s as (select * from sd), g as (select s.publisherId, count(distinct af.score) k, count(*) n from s left join af using (id) group by 1) select k = 1 consistent, count(*) n_publishers, cast(sum(n) as bigint) n_datasets from g group by 1")
def _(spark, d):
    c = fair.consistency(_scored(spark, d).select("publisherId", "id", "score"), _after(spark, d))
    return reports.totals(c, "afterConsistent", "n").select(F.col("afterConsistent").alias("consistent"), F.col("n_rows").alias("n_publishers"), F.col("total").alias("n_datasets"))


@query("union_inputs", "select 'raw_datacite' tab, seq from raw_datacite union all select 'raw_emdb', seq from raw_emdb")
def _(spark, d):
    one = lambda t: table(spark, d, t).select(F.lit(t).alias("tab"), "seq")
    return one("raw_datacite").unionByName(one("raw_emdb"))


@query("set_difference", "select datasetId id from identifier_map where datasetId is not null except select id from dataset")
def _(spark, d):
    ids = table(spark, d, "identifier_map").where("datasetId is not null").select(F.col("datasetId").alias("id"))
    return ids.join(table(spark, d, "dataset").select("id"), "id", "left_anti").distinct()


@query("semi_join", "select seq, datasetId, score from fuji_score where datasetId in (select datasetId from identifier_map where identifierType = 'emdb_id')")
def _(spark, d):
    m = table(spark, d, "identifier_map").where("identifierType = 'emdb_id'").select("datasetId")
    return table(spark, d, "fuji_score").join(m, "datasetId", "left_semi").select("seq", "datasetId", "score")


@query("topic_year_ranges", "select lower(subjects[1]) topic, min(pubYear) lo, max(pubYear) hi from dataset where pubYear > 0 and len(subjects) > 0 and subjects[1] is not null group by 1")
def _(spark, d):
    t = table(spark, d, "dataset").where("pubYear > 0").select(_subfield().alias("topic"), "pubYear").where("topic is not null")
    return t.groupBy("topic").agg(F.min("pubYear").alias("lo"), F.max("pubYear").alias("hi"))


@query("json_report", "select publisherId as \"key\", '{\"n\":' || count(*) || ',\"last\":' || max(id) || '}' \"json\" from dataset where publisherId is not null group by 1")
def _(spark, d):
    from siltstone.sources.io import json_report

    g = table(spark, d, "dataset").where("publisherId is not null").groupBy(F.col("publisherId").alias("key")).agg(F.count("*").alias("n"), F.max("id").alias("last"))
    return json_report(g, "key")


# ------------------------------------------------------------------ scalar rules


@query("clean_text", f"select seq, {_CTRL.format('description')} description from raw_datacite")
def _(spark, d):
    return table(spark, d, "raw_datacite").select("seq", X.clean_string(F.col("description")).alias("description"))


@query("clean_link", f"select seq, {_LINK} link from citations")
def _(spark, d):
    return table(spark, d, "citations").select("seq", X.clean_link(F.col("citation_link")).alias("link"))


@query("iso_dates", f"select seq, strftime(case when {_ISO.format('citation_date')} then try_cast(citation_date as timestamptz) at time zone 'UTC' end, '%Y-%m-%d %H:%M:%S') instant, try_cast(case when regexp_matches(trim(citation_date), '^[0-9]{{4}}') then substr(trim(citation_date), 1, 4) end as int) year_text from citations")
def _(spark, d):
    c = table(spark, d, "citations")
    return c.select("seq", F.date_format(X.iso_timestamp(F.col("citation_date")), "yyyy-MM-dd HH:mm:ss").alias("instant"), X.year_of_text(F.col("citation_date")).alias("year_text"))


@query("scalar_rules", """select id, case when identifier like '10.%' then split_part(identifier, '/', 1) end prefix, regexp_replace(identifier, '\\D', '', 'g') digits, case when regexp_matches(identifier, '(?i)^https?://[^/?#]+') then identifier end uri,
 coalesce(nullif("version",''),'estimated') "version", array_to_string(subjects[1:2], '; ') two, strftime(publishedAt at time zone 'UTC', '%Y-%m-%d') "day", regexp_replace(coalesce(description,''), '[\\t\\n\\r]', ' ', 'g') tsv, cast(year(publishedAt at time zone 'UTC') as int) "year" from dataset""")
def _(spark, d):
    i = F.col("identifier")
    return table(spark, d, "dataset").select(
        "id", X.doi_prefix(i).alias("prefix"), X.digits(i).alias("digits"), X.clean_uri(i).alias("uri"), X.or_default(F.col("version"), F.lit("estimated")).alias("version"),
        X.first_two(F.col("subjects")).alias("two"), X.day(F.col("publishedAt")).alias("day"), X.tsv_escape(F.col("description")).alias("tsv"), F.year("publishedAt").alias("year"),
    )


QUERIES, ORACLE = Q, S
