"""More plans over the test tables, and their SQL: whole exports as they are delivered.

Topics are the subjects of raw records; the dictionary of topics is made from the
supplier table, each second supplier listed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import domain_queries as D
from siltstone.functions import text as X
from siltstone.plans import entities, fair, ingest, merge, normalize, reports, resolve
from siltstone.runtime import read_table as table

Q: dict[str, D.Query] = {}
S: dict[str, str] = {}
AS_OF = "2026-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    def add(f: D.Query) -> D.Query:
        Q[name] = f
        if sql:
            S[name] = sql
        return f

    return add


# ------------------------------------------------------------------ search documents


@query("search_users", D._AUTH + """, g as (select kk, min((id, pos)) t from k group by 1), n as (select kk, cast(row_number() over (order by t) as bigint) id from g)
 select n.id, arg_min(nm, (k.id, pos)) as "name", arg_min(array_to_string(ids, ';'), (k.id, pos)) nameIdentifiers, arg_min(array_to_string(afs, ';'), (k.id, pos)) affiliations from k join n using (kk) group by n.id""")
def _(spark, d):
    people = entities.with_ids(entities.authors(D._creators(spark, d)), ["first_id", "first_pos"], 1, "id")
    return reports.person_documents(people).select("id", "name", F.array_join("nameIdentifiers", ";").alias("nameIdentifiers"), F.array_join("affiliations", ";").alias("affiliations"))


@query("search_orgs", D._ORGS + """, g as (select kk, arg_min(nm, (id, pos, item)) nm from k where kk <> '' group by 1) select cast(row_number() over (order by kk) as bigint) id, nm as "name" from g""")
def _(spark, d):
    return reports.organisation_documents(entities.with_ids(entities.organizations(D._creators(spark, d)), ["key"], 1, "id"))


# ------------------------------------------------------------------ records from lines

_LINES = """with e as (select seq, try_cast(line as json) j from raw_emdb where json_valid(line) and json_type(line) = 'OBJECT'),
 i0 as (select seq, case json_type(json_extract(j, '$.identifiers')) when 'ARRAY' then cast(json_extract(j, '$.identifiers') as json[]) when 'OBJECT' then [json_extract(j, '$.identifiers')] end l from e),
 i as (select seq, unnest(l) x, generate_subscripts(l, 1) p from i0),
 f as (select seq, lower(trim(x->>'identifier')) identifier, lower(coalesce(x->>'identifier_type', x->>'identifierType', '')) own_type from i where trim(coalesce(x->>'identifier', '')) <> '' qualify row_number() over (partition by seq order by p) = 1)"""


@query("emdb_ingest", _LINES + f""" select f.seq id, coalesce(j->>'source', '') source, identifier, 'emdb' identifierType, own_type, coalesce(j->>'title', '') title,
 strftime(coalesce(case when {D._ISO.format("j->>'publication_date'")} then try_cast(j->>'publication_date' as timestamptz) at time zone 'UTC' end, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') publishedAt from f join e using (seq)""")
def _(spark, d):
    ds, _bad = ingest.ingest_lines(table(spark, d, "raw_emdb"), main_type="emdb")
    return ds.select("id", "source", "identifier", "identifierType", F.get("ids", F.lit(0))["identifierType"].alias("own_type"), "title", F.date_format("publishedAt", "yyyy-MM-dd HH:mm:ss").alias("publishedAt"))


@query("raw_author_ids", D._RECORD.replace(", u as", "with u as", 1) + f""", c as (select seq, unnest(creators) c, generate_subscripts(creators, 1) - 1 pos from raw_datacite where seq in (select seq from f))
 select seq datasetId, cast(pos as int) pos, cast(row_number() over (order by seq, pos) as bigint) id from c where c is not null""")
def _(spark, d):
    return ingest.authors_with_ids(ingest.ingest(table(spark, d, "raw_datacite"))[0]).select("datasetId", "pos", "id")


# ------------------------------------------------------------------ topics

# The map as it stood on a day.
MAP_DAY = "2020-01-01 00:00:00"
_LIVING = D._MAP.replace("where identifier", f"where added_at <= timestamptz '{MAP_DAY}+00' and (deleted_at is null or deleted_at > timestamptz '{MAP_DAY}+00') and identifier")


def _living(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "identifier_map").where(f"added_at <= timestamp '{MAP_DAY}' and (deleted_at is null or deleted_at > timestamp '{MAP_DAY}')")


_TOPIC_ROWS = """tr as (select identifiers[1].identifier dataset_id, s topic_id, cast((length(s) * 7 + p) % 10 as double) / 10 score, seq * 1000 + p seq
 from (select seq, identifiers, unnest(subjects) s, generate_subscripts(subjects, 1) - 1 p from raw_datacite) where s is not null)"""


def _topic_rows(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_datacite").select("seq", F.try_element_at("identifiers", F.lit(1))["identifier"].alias("dataset_id"), F.posexplode("subjects").alias("p", "topic_id")).where("topic_id is not null")
    return r.select("dataset_id", "topic_id", (((F.length("topic_id") * 7 + F.col("p")) % 10).cast("double") / 10).alias("score"), (F.col("seq") * 1000 + F.col("p")).alias("seq"))


@query("topics_by_dataset", f"with {D._MAP}, {_TOPIC_ROWS} select m.datasetId, topic_id, score from tr join m on m.k = {D._key('dataset_id')} qualify row_number() over (partition by m.datasetId order by score desc, seq) = 1")
def _(spark, d):
    return merge.topics_by_dataset(_topic_rows(spark, d), table(spark, d, "identifier_map"))[0].select("datasetId", "topic_id", "score")


@query("topics_unmatched", f"with {_LIVING}, {_TOPIC_ROWS} select {D._key('dataset_id')} as \"key\", count(*) n from tr where {D._key('dataset_id')} <> '' and {D._key('dataset_id')} not in (select k from m) group by 1")
def _(spark, d):
    return merge.topics_by_dataset(_topic_rows(spark, d), _living(spark, d))[1]


@query("topic_subfields", """with dict as (select regexp_replace(t, '\\D', '', 'g') k, arg_max(s, n) s from (select 'T' || s_suppkey t, cast(s_nationkey as varchar) s, s_suppkey n from supplier union all select 'T-' || s_suppkey, ' ' || (s_nationkey + 100) || ' ', s_suppkey + 1000000 from supplier where s_suppkey % 2 = 0) group by 1)
 select distinct l_suppkey * 2 topic, trim(s) subfield_id from lineitem left join dict on k = cast(l_suppkey * 2 as varchar)""")
def _(spark, d):
    s = table(spark, d, "supplier")
    one = s.select(F.concat(F.lit("T"), "s_suppkey").alias("topic_id"), F.col("s_nationkey").cast("string").alias("subfield_id"), F.col("s_suppkey").cast("long").alias("n"))
    two = s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("T-"), "s_suppkey").alias("topic_id"), F.concat(F.lit(" "), F.col("s_nationkey") + 100, F.lit(" ")).alias("subfield_id"), (F.col("s_suppkey") + 1_000_000).cast("long").alias("n"))
    asked = table(spark, d, "lineitem").select((F.col("l_suppkey") * 2).alias("topic")).distinct().withColumn("full", X.topic_full_id(F.concat(F.lit("T"), "topic")))
    return normalize.subfields_of_topics(asked, "full", one.unionByName(two), "n").select("topic", "subfield_id")


@query("norm_factor_optional", f"""with {D._SCORED}, {D._NORMS}, nf as (select subfield_id, pubyear, ft, case when pubyear % 4 <> 0 then ctw end ctw, case when subfield_id = 'DEFAULT' then 1.5 end mtw from norms),
 own as (select sd.id, arg_max(nf, nf.pubyear) o from sd join nf on nf.subfield_id = sd.subfield and nf.pubyear <= sd.pubYear group by 1), rest as (select arg_max(nf, pubyear) r from nf where subfield_id = 'DEFAULT')
 select sd.id, coalesce(o.ft, r.ft) ft, cast(coalesce(o.ctw, r.ctw) as double) ctw, cast(coalesce(o.mtw, r.mtw) as double) mtw, pubYear - o.pubyear year_gap, case when o is null then 'Default' when o.pubyear = pubYear then 'Exact Year' else 'Closest Past Year' end "method" from sd left join own using (id), rest""")
def _(spark, d):
    n = D._norms(spark, d).withColumns({"ctw": F.when(F.col("pubyear") % 4 != 0, F.col("ctw")), "mtw": F.when(F.col("subfield_id") == normalize.DEFAULT, F.lit(1.5))})
    asked = D._scored(spark, d).select("id", D._subfield().alias("subfield"), F.col("pubYear").alias("year"))
    return normalize.optional_factors(asked, n)


# ------------------------------------------------------------------ merges


@query("citation_merge_ids", D._MERGE + """, fs as (select datasetId, citationLink, min(seq) id from (select *, regexp_replace(citation_link, '[^\\p{L}\\p{N}./:_~-]', '', 'g') citationLink from r where seq % 2 = 0) where citationLink <> '' group by 1, 2)
 select datasetId, citationLink, "action", cast(coalesce(fs.id, (select max(id) from fs) + row_number() over (partition by "action" order by datasetId, citationLink)) as bigint) id from a left join fs using (datasetId, citationLink)""")
def _(spark, d):
    r = D._resolved(spark, d)
    old = merge.citations_by_link(r.where("seq % 2 = 0"))
    m = merge.merge_citations(merge.citations_by_link(r.where("seq % 2 = 1")), old)
    return merge.with_inserted_ids(m, old.select("datasetId", "citationLink", F.col("seq").alias("id"))).select("datasetId", "citationLink", "action", "id")


@query("citation_field_names", f"with {D._RES}, b as (select datasetId, {D._LINK} citationLink, citation_date, seq from r) select datasetId, citationLink, arg_min_null(citation_date, seq) citedDate from b where citationLink <> '' group by 1, 2")
def _(spark, d):
    """Exports of three spellings of the field names, one after another."""
    c = table(spark, d, "citations")
    parts = [
        c.where("seq % 3 = 0"),
        c.where("seq % 3 = 1").withColumnsRenamed({"citation_link": "citationLink", "citation_date": "citedDate", "dataset_id": "datasetId", "citation_weight": "citationWeight"}),
        c.where("seq % 3 = 2").withColumnsRenamed({"citation_link": "link", "citation_date": "cited_date"}),
    ]
    rows = merge.with_plain_names(parts[0]).unionByName(merge.with_plain_names(parts[1])).unionByName(merge.with_plain_names(parts[2]))
    return merge.citations_by_link(resolve.resolve(rows, "reference", table(spark, d, "identifier_map"))).select("datasetId", "citationLink", "citedDate")


@query("topic_conditional_with_parents", f"""with {D._TOPICS}, o as (select * from t where seq % 3 = 0 qualify row_number() over (partition by datasetId order by score desc nulls last, seq) = 1)
 select datasetId, topicId, score from (select *, 0 n from o union all select *, 1 from t where seq % 3 <> 0 and datasetId in (select id from dataset)) qualify row_number() over (partition by datasetId order by score desc nulls last, n, seq) = 1""")
def _(spark, d):
    t = D._topics(spark, d)
    old = merge.best_per_key(t.where("seq % 3 = 0"), ["datasetId"], "score", [F.col("seq")])
    parents = table(spark, d, "dataset").select(F.col("id").cast("long").alias("datasetId"))
    return merge.upsert_if_higher(old, t.where("seq % 3 <> 0"), ["datasetId"], "score", "seq", parents).select("datasetId", "topicId", "score")


@query("mention_weights", f"""with {D._RES}, b as (select datasetId, {D._LINK} mentionLink, citation_weight, seq from r) select datasetId, mentionLink, arg_min_null(citation_weight, seq) mentionWeight from b where mentionLink <> '' group by 1, 2""")
def _(spark, d):
    rows = D._resolved(spark, d).withColumnsRenamed({"citation_link": "mention_link", "citation_weight": "mention_weight", "citation_date": "mention_date"})
    return merge.mentions_by_link(rows).select("datasetId", "mentionLink", "mentionWeight")


# ------------------------------------------------------------------ licences

_RIGHTS = """u as (select seq, coalesce(list_filter(identifiers, lambda x: x.identifier_type = 'doi')[1], identifiers[1]).identifier k, unnest(subjects) s from raw_datacite),
 rt as (select seq, k, nullif(s, '') "name", case when length(s) % 2 = 0 then 'https://rights.example/' || s end uri from u where k is not null)"""


@query("license_datasets", f"with {D._MAP}, {_RIGHTS} select seq, m.datasetId, \"name\", uri, cast(row_number() over (order by seq, m.datasetId, \"name\" nulls first, uri nulls first) as bigint) id from rt join m on m.k = {D._key('rt.k')}")
def _(spark, d):
    return ingest.licences(D._rights(spark, d), table(spark, d, "identifier_map"))[0].select("seq", "datasetId", "name", "uri", "id")


@query("license_unmatched", f"with {_LIVING}, u as (select {D._key('coalesce(list_filter(identifiers, lambda x: x.identifier_type = $$doi$$)[1], identifiers[1]).identifier')} kk from raw_datacite) select kk as \"key\", count(*) n from u where kk <> '' and kk not in (select k from m) group by 1")
def _(spark, d):
    return ingest.licences(D._rights(spark, d), _living(spark, d))[1]


# ------------------------------------------------------------------ scores


def _score_files(spark: SparkSession, d: str) -> DataFrame:
    """Even lines by doi, odd ones by dataset_id under the other field names."""
    f = table(spark, d, "fuji_score").join(table(spark, d, "dataset").select(F.col("id").alias("datasetId"), "identifier"), "datasetId")
    even = F.col("seq") % 2 == 0
    put = lambda c, when: F.when(when, F.col(c)).otherwise("")
    return f.select(
        "seq", F.when(even, F.upper("identifier")).alias("doi"), F.when(~even, F.concat(F.lit(" "), "identifier", F.lit(" "))).alias("dataset_id"), F.when(F.col("seq") % 7 == 0, "n/a").otherwise(F.col("score").cast("string")).alias("score"),
        put("evaluationDate", even).alias("evaluationDate"), put("evaluationDate", ~even).alias("evaluation_date"), put("metricVersion", even).alias("metricVersion"), put("metricVersion", ~even).alias("metric_version"),
        put("softwareVersion", even).alias("softwareVersion"), put("softwareVersion", ~even).alias("software_version"),
    )


@query("fuji_files", f"""with {D._MAP}, x as (select f.*, d.identifier from fuji_score f join dataset d on d.id = f.datasetId)
 select x.seq, m.datasetId, {D._key('identifier')} identifier, case when x.seq % 7 <> 0 and not isnan(score) then score end score, strftime(coalesce(case when {D._ISO.format('evaluationDate')} then try_cast(evaluationDate as timestamptz) at time zone 'UTC' end, timestamp '{AS_OF}'), '%Y-%m-%d %H:%M:%S') evaluationDate,
 coalesce(nullif(trim(metricVersion),''),'estimated') metricVersion, coalesce(nullif(trim(softwareVersion),''),'estimated') softwareVersion from x join m on m.k = {D._key('identifier')}""")
def _(spark, d):
    out = fair.import_score_files(_score_files(spark, d), table(spark, d, "identifier_map"), F.lit(AS_OF).cast("timestamp"))
    return out.withColumns({"evaluationDate": F.date_format("evaluationDate", "yyyy-MM-dd HH:mm:ss"), "score": F.nanvl("score", F.lit(None).cast("double"))})


@query("estimated_scores", "select seq, datasetId, score from fuji_score where softwareVersion = 'estimated' and score is not null")
def _(spark, d):
    return fair.estimated_with_score(table(spark, d, "fuji_score"), F.col("softwareVersion") == "estimated").select("seq", "datasetId", "score")


_EXTRA = {"emdb": 42.31}


@query("score_constants", f"""with {D._SCORED}, {D._AFTER}, g as (select sd.publisherId, count(distinct af.score) k, max(af.score) score, count(*) n from sd left join af using (id) group by 1),
 e as (select publisherId as "key", score, n from g where k = 1 and publisherId <> 'emdb' union all select 'emdb', 42.31, -1) select "key", cast(score as double) score, cast(row_number() over (order by n desc, "key") - 1 as bigint) pos from e""")
def _(spark, d):
    c = fair.consistency(D._scored(spark, d).select("publisherId", "id", "score"), D._after(spark, d)).where("afterConsistent")
    return fair.score_constants(c, _EXTRA).select("key", "score", F.col("pos").cast("long").alias("pos"))


@query("score_queue", "with j as (select distinct datasetId from fuji_score where seq % 2 = 1 and datasetId is not null) select d.id, d.identifier, d.identifierType from dataset d join j on j.datasetId = d.id")
def _(spark, d):
    jobs = table(spark, d, "fuji_score").where("seq % 2 = 1 and datasetId is not null").select(F.col("datasetId").alias("id")).distinct()
    return table(spark, d, "dataset").select("id", "identifier", "identifierType").join(jobs, "id")


@query("scored_datasets", f"with {D._SCORES} select d.id, d.publisher, sc.score, sc.metricVersion from dataset d join sc on sc.datasetId = d.id where sc.score is not null")
def _(spark, d):
    s = D._scores(spark, d).where("score is not null").select(F.col("datasetId").alias("id"), "score", "metricVersion")
    return table(spark, d, "dataset").select("id", "publisher").join(s, "id")


# ------------------------------------------------------------------ the whole dump


@query("dataset_dump", f"""with {D._RES}, {D._SCORED}, {D._NORMS}, {D._FACTORS}, {_TOPIC_ROWS}, tp as (select m.datasetId id, topic_id from tr join m on m.k = {D._key('dataset_id')} qualify row_number() over (partition by m.datasetId order by score desc, seq) = 1),
 ct as (select datasetId id, count(*) n, string_agg(seq, ',' order by seq) seqs from r group by 1), mn as (select cast(event_id % 2000 as int) id, count(*) n from events group by 1)
 select d.id, d.identifier, coalesce(d.publisherId, 'unknown') publisherId, sc.score fuji_score, sc.metricVersion fuji_version, fac.ft factor, fac."method" factor_method, tp.topic_id topic, cast(coalesce(ct.n, 0) as bigint) n_citations, coalesce(ct.seqs, '') citations, cast(coalesce(mn.n, 0) as bigint) n_mentions
 from dataset d left join sc on sc.datasetId = d.id left join fac on fac.id = d.id left join tp on tp.id = d.id left join ct on ct.id = d.id left join mn on mn.id = d.id""")
def _(spark, d):
    ds = table(spark, d, "dataset").select("id", "identifier", "identifierType", "publishedAt", "pubYear", F.coalesce("publisherId", F.lit("unknown")).alias("publisherId"))
    topics = merge.topics_by_dataset(_topic_rows(spark, d), table(spark, d, "identifier_map"))[0]
    cited = D._resolved(spark, d).select("datasetId", "seq", "citation_link", "citation_weight", "citation_date")
    dumped = reports.dump(
        ds,
        {"fuji": (D._scores(spark, d), "datasetId", ["score", "evaluationDate", "metricVersion"]), "normalizationFactor": (D._factors(spark, d), "id", ["ft", "ctw", "mtw", "method"]), "datasetTopic": (topics, "datasetId", ["topic_id", "score"])},
        {"citations": (cited, "datasetId", ["seq", "citation_link", "citation_weight", "citation_date"]), "mentions": (D._mentions(spark, d), "id", ["seq", "weight", "year"])},
    )
    return dumped.select(
        "id", "identifier", "publisherId", F.col("fuji.score").alias("fuji_score"), F.col("fuji.metricVersion").alias("fuji_version"), F.col("normalizationFactor.ft").alias("factor"), F.col("normalizationFactor.method").alias("factor_method"), F.col("datasetTopic.topic_id").alias("topic"),
        F.size("citations").cast("long").alias("n_citations"), F.array_join(F.transform("citations", lambda x: x["seq"].cast("string")), ",").alias("citations"), F.size("mentions").cast("long").alias("n_mentions"),
    )


# ------------------------------------------------------------------ scalar rules


@query("scalar_rules_more", f"""select seq, lower(citation_link) legacy, regexp_replace(citation_date, '\\+00:00$', '') bare, strftime(coalesce(case when {D._ISO.format('citation_date')} then try_cast(citation_date as timestamptz) at time zone 'UTC' end, timestamp '{AS_OF}'), '%Y-%m-%d %H:%M:%S') instant,
 'https://openalex.org/T' || seq topic, 'T' || seq short, strftime(to_timestamp(seq * 1000) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') epoch, printf('%.2f', citation_weight) weight, try_cast(citation_date as int) as_int, try_cast(citation_date as double) as_float from citations""")
def _(spark, d):
    topic = F.concat(F.lit("T"), "seq")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    dates = F.col("citation_date")
    return table(spark, d, "citations").select(
        "seq", X.legacy_map_key(F.col("citation_link")).alias("legacy"), X.without_utc_offset(dates).alias("bare"), stamp(X.iso_timestamp_or(dates, F.lit(AS_OF).cast("timestamp"))).alias("instant"),
        X.topic_full_id(topic).alias("topic"), X.topic_short_id(X.topic_full_id(topic)).alias("short"), stamp(X.epoch_seconds(F.col("seq") * 1000)).alias("epoch"),
        F.when(F.col("citation_weight").isNotNull(), X.two_decimals(F.col("citation_weight"))).alias("weight"), X.safe_int(dates).alias("as_int"), X.safe_float(dates).alias("as_float"),
    )


QUERIES, ORACLE = Q, S
