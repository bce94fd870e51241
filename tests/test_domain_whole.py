"""Queries over small tables written here: every row counts."""

import pytest

from siltstone.domain_queries import QUERIES

DATASET = "id int, identifier string, identifierType string, publisherId string, pubYear int, subjects array<string>, publishedAt timestamp"
SCORE = "seq long, datasetId int, score double, evaluationDate string, metricVersion string, softwareVersion string"


@pytest.fixture
def scored(spark, tmp_path):
    def write(rows):
        """(id, publisherId, pubYear, subject, score) as the tables dataset and fuji_score."""
        spark.createDataFrame([(i, f"10.1/{i}", "doi", p, y, [s], None) for i, p, y, s, _ in rows], DATASET).write.parquet(f"{tmp_path}/dataset.parquet")
        spark.createDataFrame([(n, r[0], r[4], "d", "1", "1") for n, r in enumerate(rows) if r[4] is not None], SCORE).write.parquet(f"{tmp_path}/fuji_score.parquet")
        return str(tmp_path)

    return write


def test_odd_years_have_factors_and_missing_years_take_the_latest_before(spark, scored):
    d = scored([(1, "p", 2001, "a", 10.0), (2, "p", 2001, "a", 20.0), (3, "p", 2004, "a", 40.0), (4, "p", 2003, "a", None), (5, "p", 2005, "a", None), (6, "p", 2002, "b", None), (7, "p", 2000, "a", None)])
    got = {r.id: (r.ft, r.method) for r in QUERIES["norm_factor_asof"](spark, d).collect()}
    assert got == {
        1: (15.0, "Exact Year"), 2: (15.0, "Exact Year"), 3: (40.0, "Exact Year"), 4: (15.0, "Closest Past Year"), 5: (40.0, "Closest Past Year"), 6: (15.0, "Default"), 7: (13.46, None),
    }


def test_consistency_is_of_all_datasets(spark, scored):
    """p disagrees only at ids that 5 doesn't divide, q has no other."""
    d = scored([(5, "p", 2001, "a", 10.0), (10, "p", 2001, "a", 10.0), (11, "p", 2001, "a", 12.0), (1, "q1", 2001, "a", 9.0), (2, "q1", 2001, "a", 9.0)])
    got = {r.publisherId: (r.n, r.n_after, r.beforeConsistent, r.afterConsistent) for r in QUERIES["fuji_consistency"](spark, d).collect()}
    assert got == {"p": (3, 3, False, False), "q1": (2, 2, True, True)}
    assert sorted(map(tuple, QUERIES["analysis_totals"](spark, d).collect())) == [(False, 1, 3), (True, 1, 2)]


def test_each_topic_row_is_target_or_incoming(spark, tmp_path):
    """l_orderkey 0, so seq is the line number; dataset 3 stands only where seq % 3 = 2."""
    lines = [(0, 1, 3, 0.1, "A", "F"), (0, 1, 4, 0.2, "B", "F"), (0, 1, 5, 0.3, "C", "F"), (0, 2, 6, 0.4, "D", "F"), (0, 3, 2, 0.5, "E", "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("topic_upsert", "topic_conditional_upsert"):
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) == [(1, "CF", 0.3), (2, "DF", 0.4), (3, "EF", 0.5)], name
