"""Queries of the core operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.flatten import flatten_creators, flatten_json_lines
from siltstone.operators.orphans import add_counts, count_changes, orphan_references, orphan_report, orphans_of
from siltstone.operators.timestamps import ABBREVIATIONS, CANONICAL, MONTHS, NOTATIONS, normalise_timestamps
from siltstone.runtime import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _date_values(spark: SparkSession, d: str) -> DataFrame:
    """The three date fields as one table; the source of a citation is who reported it."""
    c = read_table(spark, d, "citations").select(
        F.lit("citations").alias("tab"), F.col("seq").alias("row_key"), F.array_join(F.array_sort(F.array_distinct(F.transform("source", F.lower))), ",").alias("src"), "seq", F.col("citation_date").alias("value")
    )
    f = read_table(spark, d, "fuji_score").select(F.lit("fuji_score").alias("tab"), F.col("seq").alias("row_key"), F.col("softwareVersion").alias("src"), "seq", F.col("evaluationDate").alias("value"))
    r = read_table(spark, d, "raw_datacite").select(F.lit("raw_datacite").alias("tab"), F.col("seq").alias("row_key"), F.col("source").alias("src"), "seq", F.col("publication_date").alias("value"))
    return c.unionByName(f).unionByName(r)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return normalise_timestamps(_date_values(spark, d), emit=~F.col("value").rlike(CANONICAL))


def p1_by_context(spark: SparkSession, d: str) -> DataFrame:
    """The same values with the conventions left out: what they leave open is decided
    by the records around alone."""
    return normalise_timestamps(_date_values(spark, d), emit=~F.col("value").rlike(CANONICAL), conventions=False)


def compact(c: Column) -> Column:
    """Letters and digits only, without case; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", ""), F.lit(""))


def _references(spark: SparkSession, d: str) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """References and records: citations to identifiers, and identifiers and scores to datasets."""
    c, m, f, s = (read_table(spark, d, t) for t in ("citations", "identifier_map", "fuji_score", "dataset"))
    given = F.coalesce(F.nullif("dataset_id", F.lit("")), F.nullif("doi", F.lit("")))
    refs = c.where(given.isNotNull()).select(F.lit("citations").alias("tab"), F.col("seq").alias("row_key"), F.coalesce(compact(given), F.lit("")).alias("key"), F.col("ingested_at").alias("at"))
    ids = m.select(compact(F.col("identifier")).alias("key"), "added_at", "deleted_at")
    number = F.coalesce(F.col("datasetId").cast("string"), F.lit("")).alias("key")
    to_dataset = m.select(F.lit("identifier_map").alias("tab"), F.col("seq").alias("row_key"), number, F.col("added_at").alias("at")).unionByName(
        f.select(F.lit("fuji_score").alias("tab"), F.col("seq").alias("row_key"), number, F.col("ingested_at").alias("at"))
    )
    sets = s.select(F.col("id").cast("string").alias("key"), F.col("created").alias("added_at"), F.lit(None).cast("timestamp").alias("deleted_at"))
    return (refs, ids), (to_dataset, sets)


BATCH_DAY = "2021-01-01 00:00:00"


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    to_map, to_dataset = _references(spark, d)
    return orphan_references(*to_map).unionByName(orphan_references(*to_dataset))


def p2_current(spark: SparkSession, d: str) -> DataFrame:
    """From counts kept batch by batch: what came by a day, and what came later."""
    out = None
    for references, records in _references(spark, d):
        day = F.lit(BATCH_DAY).cast("timestamp")
        early = count_changes(references, records, day)
        # The later batch: rows behind the day, and deletions behind it of records before it.
        added = records.where(F.coalesce(F.col("added_at") > day, F.lit(False)))
        gone = records.where((F.col("added_at") <= day) & (F.col("deleted_at") > day) & (F.col("deleted_at") > F.col("added_at")))
        gone = gone.select("key", F.col("deleted_at").alias("added_at"), F.lit(None).cast("timestamp").alias("deleted_at"), F.lit(-1).alias("sign"))
        later = count_changes(references.where(F.col("at") > day), added.select("key", "added_at", "deleted_at", F.lit(1).alias("sign")).unionByName(gone))
        part = orphans_of(add_counts(later, early))
        out = part if out is None else out.unionByName(part)
    return out


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d)


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(_orphans(spark, d))


def _children(spark: SparkSession, d: str) -> DataFrame:
    a = flatten_creators(read_table(spark, d, "raw_datacite")).withColumn("tab", F.lit("raw_datacite"))
    return a.unionByName(flatten_json_lines(read_table(spark, d, "raw_emdb")).withColumn("tab", F.lit("raw_emdb")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _children(spark, d).select("tab", F.col("key").alias("seq"), "child", "creator_pos", "item_pos")


def p5_tables(spark: SparkSession, d: str) -> DataFrame:
    return _children(spark, d).select("tab", F.col("key").alias("seq"), "child", "creator_pos", "item_pos", "name", "name_type", "value")


QUERIES: dict[str, Query] = {"p1_found": p1_found, "p1_by_context": p1_by_context, "p2_found": p2_found, "p2_report": p2_report, "p2_current": p2_current, "p5_found": p5_found, "p5_tables": p5_tables}



def _p1_sql() -> str:
    """The instants in SQL: the notations' patterns without what RE2 lacks, everything
    behind them by DuckDB's own dates and zones."""
    # At most nine groups here: the separator of dates is no group of its own.
    known = [(n, p.replace("([-/.])", "[-/.]"), tuple(g - (g > 2) for g in groups)) if r"\2" in p else (n, p, groups) for n, p, groups in NOTATIONS]
    plain = lambda p: p.replace(r"\2", "[-/.]").replace(r"\.?(?![A-Za-z])", r"(?:\.|\b)").replace("'", "''")
    kinds = "".join(f" when regexp_matches(s, '{plain(p)}') then {i}" for i, (_, p, _) in enumerate(known))
    parts = "".join(
        f" when {i} then [" + ", ".join(f"regexp_extract(s, '{plain(p)}', {g})" if g else "''" for g in (*groups, *[0] * (9 - len(groups)))) + "]" for i, (_, p, groups) in enumerate(known)
    )
    at = {name: i for i, (name, _, _) in enumerate(NOTATIONS)}
    names = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
    long = "january|february|march|april|may|june|july|august|september|october|november|december|sept"
    abbreviations = "map {" + ", ".join(f"'{k}': {v}" for k, v in ABBREVIATIONS.items()) + "}"
    number = lambda i, d: f"coalesce(try_cast(p[{i}] as bigint), {d})"
    return f"""
with v as (select 'citations' tab, seq row_key, citation_date x from citations union all select 'fuji_score', seq, evaluationDate from fuji_score union all select 'raw_datacite', seq, publication_date from raw_datacite),
t as (select tab, row_key, regexp_replace(regexp_replace(x, '^[\\s\\p{{C}}\\p{{Z}}]+|[\\s\\p{{C}}\\p{{Z}}]+$', '', 'g'), '[\\x{{A0}}\\x{{2007}}\\x{{202F}}]', ' ', 'g') s from v where x is not null and not regexp_matches(x, '{CANONICAL}')),
n as (select *, case {kinds} end k from t), g as (select *, case k {parts} end p from n where k is not null and not (k = {at['iso']} and regexp_extract(s, '^\\d{{4}}(.)', 1) <> regexp_extract(s, '^\\d{{4}}.\\d{{1,2}}(.)', 1))),
c as (select *, try_cast(p[1] as hugeint) big, {number(1, 0)} y, case when p[2] = '' then 1 when regexp_full_match(p[2], '[0-9]+') then cast(p[2] as bigint) when regexp_full_match(lower(p[2]), '[a-z]{{3}}|{long}') then nullif(list_position({names}, lower(p[2])[1:3]), 0) end mo,
 {number(3, 1)} d, case when p[7] = '' then {number(4, 0)} when {number(4, 0)} between 1 and 12 then {number(4, 0)} % 12 + case when lower(p[7]) = 'p' then 12 else 0 end else 99 end h, {number(5, 0)} mi, {number(6, 0)} se, p[8] off, p[9] zone from g),
w as (select *, case when k = {at['week']} then case when y between 1 and 9999 and mo between 1 and 53 and d between 1 and 7 and isoyear(date_trunc('week', make_date(y, 1, 4)) + to_days(cast((mo - 1) * 7 + d - 1 as int))) = y then cast(date_trunc('week', make_date(y, 1, 4)) + to_days(cast((mo - 1) * 7 + d - 1 as int)) as date) end
 else try_cast(printf('%04d-%02d-%02d', y, mo, d) as date) end "day" from c),
l as (select *, case when "day" is not null and mi < 60 and se < 60 and (h < 24 or h = 24 and mi = 0 and se = 0) then "day" + to_seconds(h * 3600 + mi * 60 + se) end local,
 case when regexp_matches(off, '^[+-]') then (cast(off[2:3] as int) * 60 + coalesce(try_cast(nullif(replace(off, ':', '')[4:5], '') as int), 0)) * case when off like '-%' then -1 else 1 end end off_min from w),
z as (select l.*, tz.name zn, case when off = '' and zone = '' then 0 when off_min is not null then case when abs(off_min) <= 840 then off_min else 0 end when off <> '' then {abbreviations}[upper(off)] end fixed
 from l left join (select distinct name from pg_timezone_names()) tz on tz.name = l.zone),
o as (select *, epoch(timezone(coalesce(zn, 'UTC'), local)) one from z),
e as (select tab, row_key, case when k = {at['epoch_s']} then big when k = {at['epoch_ms']} then big // 1000 when k = {at['epoch_us']} then big // 1000000 when k = {at['epoch_ns']} then big // 1000000000
 when zone <> '' and off = '' then case when zn is not null then case when timezone(zn, to_timestamp(one - 3600)) = local then one - 3600 when timezone(zn, to_timestamp(one - 1800)) = local then one - 1800 else one end end
 else epoch(local) - fixed * 60 end u from o)
select tab, row_key, strftime(to_timestamp(u) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') utc from e where u between -62135596800 and 253402300799"""


_P2 = """
with refs as (select seq, ingested_at as t, regexp_replace(lower(coalesce(nullif(dataset_id,''),doi)), '[^\\p{L}\\p{N}]', '', 'g') k
  from citations where coalesce(nullif(dataset_id,''),nullif(doi,'')) is not null),
ids as (select regexp_replace(lower(identifier), '[^\\p{L}\\p{N}]', '', 'g') k, added_at, deleted_at from identifier_map),
c as (select r.seq, r.t, count(i.k) n, count(case when i.added_at <= r.t and (i.deleted_at is null or i.deleted_at > r.t) then 1 end) living, max(i.added_at) latest
  from refs r left join ids i on r.k = i.k group by r.seq, r.t),
d as (select 'identifier_map' tab, seq, datasetId, added_at as t from identifier_map union all select 'fuji_score', seq, datasetId, ingested_at from fuji_score),
found as (
select 'citations' tab, seq row_key, strftime(t at time zone 'UTC', '%Y-%m') period, case when n = 0 then 'missing' when latest > t then 'late' else 'deleted' end reason from c where living = 0
union all
select d.tab, d.seq, strftime(d.t at time zone 'UTC', '%Y-%m'), case when s.id is null then 'missing' else 'late' end from d left join dataset s on s.id = d.datasetId where s.id is null or s.created > d.t)
"""
_P5 = """
with c as (select seq, unnest(creators) c, generate_subscripts(creators, 1) - 1 creator_pos from raw_datacite),
e as (select seq, try_cast(line as json) j from raw_emdb where json_valid(line) and json_type(line) = 'OBJECT'),
ec0 as (select seq, case json_type(json_extract(j, '$.creators')) when 'ARRAY' then cast(json_extract(j, '$.creators') as json[]) when 'NULL' then null else [json_extract(j, '$.creators')] end l from e where json_exists(j, '$.creators')),
ec as (select *, case when json_type(c) <> 'OBJECT' then c->>'$' when json_type(n) <> 'OBJECT' then n->>'$' else coalesce(n->>'name', concat_ws(', ', n->>'family', n->>'given')) end name,
  case when json_type(c) = 'OBJECT' then coalesce(c->>'name_type', c->>'nameType') end name_type from (select *, json_extract(c, '$.name') n from (select seq, unnest(l) c, generate_subscripts(l, 1) - 1 creator_pos from ec0))),
ek as (select seq, creator_pos, child, case json_type(v) when 'ARRAY' then cast(v as json[]) when 'NULL' then null else [v] end l from (
  select seq, creator_pos, 'identifier' child, json_extract(c, '$.identifiers') v from ec where json_type(c) <> 'NULL' union all select seq, creator_pos, 'affiliation', json_extract(c, '$.affiliations') from ec where json_type(c) <> 'NULL') where v is not null),
ei as (select *, case when json_type(v) <> 'OBJECT' then v->>'$' when child = 'identifier' then coalesce(v->>'value', v->>'identifier') else v->>'name' end said from (select seq, creator_pos, child, unnest(l) v, generate_subscripts(l, 1) - 1 item_pos from ek)),
i as (select seq, creator_pos, 'identifier' child, unnest(c.identifiers) v, generate_subscripts(c.identifiers, 1) - 1 item_pos from c
  union all select seq, creator_pos, 'affiliation', unnest(c.affiliations), generate_subscripts(c.affiliations, 1) - 1 from c),
every as (
select 'raw_datacite' tab, seq, 'creator' child, cast(creator_pos as int) creator_pos, cast(-1 as int) item_pos, c."name" "name", c.name_type name_type, null as "value" from c where c is not null
union all select 'raw_datacite', seq, child, cast(creator_pos as int), cast(item_pos as int), null, null, v from i where v is not null
union all select 'raw_emdb', seq, 'creator', cast(creator_pos as int), cast(-1 as int), name, name_type, null from ec where json_type(c) <> 'NULL'
union all select 'raw_emdb', seq, child, cast(creator_pos as int), cast(item_pos as int), null, null, said from ei where json_type(v) <> 'NULL')
"""
_P5_ROWS = "select tab, seq, child, creator_pos, item_pos{} from every"
ORACLE: dict[str, str] = {
    "p1_found": _p1_sql(),
    "p2_found": _P2 + "select * from found",
    "p2_current": _P2 + """ select 'citations' tab, k as "key", count(*) n_references from refs where k not in (select k from ids where deleted_at is null) group by 2
 union all select tab, cast(datasetId as varchar), count(*) from d where datasetId not in (select id from dataset) group by 1, 2""",
    "p2_report": _P2 + "select tab, period, reason, count(*) n_orphans from found group by all",
    "p5_found": _P5 + _P5_ROWS.format(""),
    "p5_tables": _P5 + _P5_ROWS.format(", name, name_type, value"),
}
