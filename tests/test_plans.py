import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltstone.plans import entities, fair, impact, ingest, merge, normalize, reports, resolve

NORMS = "subfield_id string, pubyear int, ft double, ctw double, mtw double"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_map_keeps_last_or_first(spark):
    e = spark.createDataFrame([(1, " A", 10), (2, "a", 20), (3, None, 5), (4, "b", None), (5, "", 6)], "seq long, identifier string, datasetId int")
    assert rows(resolve.identifier_map(e)) == [("a", 20)]
    assert rows(resolve.identifier_map(e, "first")) == [("a", 10)]
    used = spark.createDataFrame([("A ",), ("x",), ("X",), (None,)], "r string")
    assert rows(resolve.resolve(used, "r", e)) == [("A ", 20)]
    assert rows(resolve.unmatched(used, "r", e)) == [("x", 2)]
    assert rows(resolve.map_conflicts(e)) == [("a", 2, 2, 10)]


def test_first_seen(spark):
    e = spark.createDataFrame([(1, "a", 10)], "seq long, identifier string, datasetId int")
    r = spark.createDataFrame([(1, "A"), (2, "a"), (3, "z"), (4, "z"), (5, None)], "n long, k string")
    assert rows(resolve.first_seen(r, "k", "n", e), "n", "status", "datasetId") == [(1, "staged", 10), (2, "duplicate", None), (3, "unmatched", None), (4, "duplicate", None)]


CIT = "datasetId int, citation_link string, source array<string>, citation_weight double, citation_date string, seq long"


def test_citation_merge(spark):
    new = merge.citations_by_link(spark.createDataFrame([(1, "l?", ["MDC"], 2.0, "d1", 1), (1, "l", None, 3.0, "d2", 2), (2, "m", ["datacite"], None, None, 3), (3, "", ["mdc"], 1.0, "x", 4), (4, "k", ["mdc"], 1.0, "x", 5)], CIT))
    old = merge.citations_by_link(spark.createDataFrame([(1, "l", ["mdc"], 5.0, "d0", 1), (4, "k", ["openalex"], 0.5, "o", 2), (9, "z", ["mdc"], 1.0, "o", 3)], CIT))
    m = merge.merge_citations(new, old)
    assert rows(m, "datasetId", "action", "mdc", "openAlex", "citationWeight", "citedDate") == [
        (1, "keep", True, False, 5.0, "d0"), (2, "insert", False, False, None, None), (4, "update", True, True, 1.0, "o"), (9, "keep", True, False, 1.0, "o")
    ]
    again = merge.merge_citations(new, merge.merged_table(m))
    assert merge.merge_changes(again).count() == 0


def test_mentions_keep_order(spark):
    df = spark.createDataFrame([(1, "u", ["HF", "x"], 1.0, "a", 1), (1, "u", ["x", None, "Y"], 2.0, "b", 2), (2, "v", None, None, None, 3)], "datasetId int, mention_link string, source array<string>, mention_weight double, mention_date string, seq long")
    assert rows(merge.mentions_by_link(df)) == [(1, "u", ["hf", "x", "y"], 1.0, "a"), (2, "v", [], None, None)]


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a", 0.5, 1), (2, "b", 0.9, 2)], "id int, v string, score double, seq long")
    i = spark.createDataFrame([(1, "c", 0.5, 3), (2, "d", 0.95, 4), (2, "e", 0.99, 5), (3, "f", None, 6)], "id int, v string, score double, seq long")
    assert rows(merge.upsert(t, i, ["id"], "seq"), "id", "v") == [(1, "c"), (2, "e"), (3, "f")]
    assert rows(merge.upsert_if_higher(t, i, ["id"], "score", "seq"), "id", "v") == [(1, "a"), (2, "e"), (3, "f")]
    assert rows(merge.insert_if_absent(t, i, ["id"])) == [(3,)]
    assert rows(merge.update_from(t, spark.createDataFrame([(1, "n")], "id int, v string"), "id", ["v"]), "id", "v") == [(1, "n"), (2, "b")]
    topics = spark.createDataFrame([(1, None, 1), (1, 0.5, 2), (1, 0.5, 3), (1, 0.9, 4), (2, None, 5), (2, None, 6)], "id int, score double, seq long")
    assert rows(merge.best_per_key(topics, ["id"], "score", ["seq"]), "id", "seq") == [(1, 4), (2, 5)]


def test_factors(spark):
    norms = spark.createDataFrame([("s", 2000, 1.0, 2.0, 3.0), ("s", 2004, None, 4.0, 5.0), ("DEFAULT", 1990, 9.0, 9.0, 9.0)], NORMS)
    asked = spark.createDataFrame([(i, "s", y) for i, y in enumerate([1985, 1999, 2000, 2003, 2010, 2500])] + [(6, "s", None), (7, None, 2000), (8, "other", 2000)], "id int, subfield string, year int")
    got = {r.id: (r.method, r.ft, r.subfield_used) for r in normalize.normalization_factors(asked, norms).collect()}
    assert got == {
        0: (None, 13.46, "DEFAULT"), 1: ("Default", 9.0, "s"), 2: ("Exact Year", 1.0, "s"), 3: ("Closest Past Year", 1.0, "s"), 4: ("Closest Past Year", 13.46, "s"),
        5: ("Closest Past Year", 13.46, "s"), 6: (None, 13.46, "DEFAULT"), 7: ("Default", 9.0, "DEFAULT"), 8: ("Default", 9.0, "other"),
    }


def test_index_by_hand(spark):
    d = spark.createDataFrame([(1, 2005, 13.46), (2, None, 150.0), (3, 2000, float("nan"))], "id int, pubyear int, score double")
    c = spark.createDataFrame([(1, 2003, 2.0), (1, 2007, 1.0), (3, None, 0.0)], "id int, year int, weight double")
    m = spark.createDataFrame([(3, 1990, None)], "id int, year int, weight double")
    f = spark.createDataFrame([(2, 0.0, -1.0, None)], "id int, ft double, ctw double, mtw double")
    got = {(r.id, r.year): round(r.score, 6) for r in impact.dataset_index(d, c, m, f, 2020).collect()}
    assert got == {(1, 2003): 1.0, (1, 2005): 1.0, (1, 2007): 1.333333, (2, 2020): round(100 / 13.46 / 3, 6), (3, 1990): 0.333333, (3, 2000): 0.333333, (3, 2020): 0.666667}


def test_roll_up_against_loops(spark):
    rng = random.Random(3)
    index = [(i, y, rng.random()) for i in range(12) for y in rng.sample(range(2000, 2020), 4)]
    links = [(e, rng.randrange(14)) for e in range(6) for _ in range(5)]
    got = {(r.entity, r.year): r.score for r in impact.entity_index(spark.createDataFrame(links, "entity int, id int"), spark.createDataFrame(index, "id int, year int, score double"), 2015).collect()}
    want = {}
    for e in {e for e, _ in links}:
        series = {i: sorted((y, s) for j, y, s in index if j == i) for i in {i for k, i in links if k == e}}
        ys = [y for s in series.values() for y, _ in s]
        for y in range(min(ys), min(2014, max(ys)) + 1) if ys else ():
            want[(e, y)] = sum([s for z, s in v if z <= y][-1] for v in series.values() if v and v[0][0] <= y)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


CREATORS = "seq long, creators array<struct<name_type:string,name:string,identifiers:array<string>,affiliations:array<string>>>"


def test_people_and_organisations(spark):
    p = lambda n, i, a, k=None: {"name_type": k, "name": n, "identifiers": i, "affiliations": a}
    df = spark.createDataFrame(
        [
            (1, [p("A", ["https://orcid.org/0000-0001-0000-000X"], ["(Univ (X))", None]), p("Org", None, ["UNIV (Y)"], "Organizational"), None]),
            (2, [p("B", ["orcid:0000-0001-0000-000x"], ["Univ"]), p("C", None, ["(A)"]), p(" ", None, None)]),
            (3, [p("c", [" "], ["a"]), p("C", None, None), p("D", ["ORCID:0000-0001-0000-000x"], None)]),
        ],
        CREATORS,
    )
    c = entities.creators_of(df, "seq")
    got = {r.key.split("\x1f")[0]: (r.name, r.n_datasets) for r in entities.authors(c).collect()}
    assert got["id:0000-0001-0000-000x"] == ("A", 2) and got["id:orcid:0000-0001-0000-000x"] == ("D", 1)
    assert entities.authors(c).count() == 4
    assert {r.key: (r.name, r.n_datasets) for r in entities.organizations(c).collect()} == {"univ": ("Univ (X)", 2), "a": ("A", 2)}
    assert entities.organization_links(c).count() == 4
    assert [r.new_id for r in entities.with_ids(entities.organizations(c), ["key"], 5).orderBy("key").collect()] == [5, 6]
    assert sorted(r.new_id for r in entities.with_ids(spark.range(100).repartition(7), ["id"]).where("new_id = id").collect()) == list(range(100))


def test_ingest(spark):
    kind = "seq long, source string, title string, description string, version string, publisher string, publisher_id string, publication_date string, pubyear string, subjects array<string>, creators array<struct<name_type:string,name:string,identifiers:array<string>,affiliations:array<string>>>, identifiers array<struct<identifier:string,identifier_type:string,identifierType:string>>"
    one = {"identifier": " A\x00 ", "identifier_type": "DOI", "identifierType": None}
    df = spark.createDataFrame([(1, "s", "t\x00", "d\x00", None, None, "", "2020-01-01", "x", None, None, [one, None, one]), (2, *[None] * 11), (3, *[None] * 10, [])], kind)
    good, bad = ingest.ingest(df)
    r = good.first()
    assert (r.identifier, r.identifierType, r.title, r.description, r.version, r.publisherId, r.pubYear) == ("a", "doi", "t\x00", "d", "", "unknown", 0)
    assert rows(bad, "seq") == [(2,), (3,)] and ingest.dataset_identifiers(good).count() == 1 and ingest.dataset_authors(good).count() == 0


def test_scores(spark):
    s = spark.createDataFrame([(1, "p", 14.0), (2, "p", 13.9), (3, "p", None), (4, "q", None), (5, "q", 7.0), (6, "z", 1.0)], "id int, publisherId string, score double")
    after = spark.createDataFrame([("p", 1.0), ("p", 1.0), ("p", 4.0), ("q", 7.0), ("z", None)], "publisherId string, score double")
    assert rows(fair.extrapolate(s, after), "id", "score", "softwareVersion") == [(2, 2.5, "extrapolated-inconsistent"), (4, 7.0, "extrapolated")]
    counts, sample = fair.low_score_candidates(s.withColumn("identifierType", F.lit("doi")), size=1)
    assert rows(counts, "publisherId", "totalCount", "lowScoreCount", "lowestScore", "lowestScoreCount") == [("p", 3, 2, 13.9, 1), ("q", 2, 1, 7.0, 1), ("z", 1, 1, 1.0, 1)]
    assert sample.count() == 3
    h = fair.prefix_histogram(spark.createDataFrame([(1, "10.1/a", 2.0), (2, "10.1/b", 3.0), (3, "10.2/c", None), (4, "emd", 1.0)], "id int, identifier string, score double"))
    assert rows(fair.prefix_modes(h), "prefix", "score") == [("10.1", "2.00")]
    c = fair.consistency(s.where("publisherId = 'p'"), spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, score double")).first()
    assert (c.n, c.n_after, c.beforeConsistent, c.afterConsistent, c.score) == (3, 2, False, True, 5.0)


def test_reports(spark):
    df = spark.createDataFrame([("a",), ("a ",), ("b",), ("c",), (None,), (" ",)], "x string")
    assert rows(reports.top_and_other(df, F.col("x"), 2)) == [("Other", 3), ("a", 2), ("b", 1)]
    assert rows(reports.by_buckets(df, F.trim("x"), ["a", "q"])) == [(0, "a", 2), (1, "q", 0)]
    n = reports.nested(spark.range(2).select(F.col("id")), "id", {"kids": (spark.createDataFrame([(0, 2), (0, 1)], "p long, v int"), "p", ["v"])})
    assert [[k.v for k in r.kids] for r in n.orderBy("id").collect()] == [[1, 2], []]
    l = spark.createDataFrame([(1, 5.0, 2001, dt.datetime(2020, 1, 1)), (1, 6.0, 2001, dt.datetime(2020, 1, 2)), (1, 7.0, 2000, dt.datetime(2021, 1, 1))], "datasetId int, score double, year int, created timestamp")  # noqa: E741
    assert rows(reports.latest_per_dataset(l), "datasetId", "score") == [(1, 6.0)]
