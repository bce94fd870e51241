import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as X

CASES = [
    (X.clean_string, "a\x00b\x85c�d", "abcd"), (X.clean_string, None, ""), (X.strip, "  x ", "x"), (X.map_key, "  DOI:X ", "doi:x"), (X.legacy_map_key, " A", " a"),
    (X.clean_link, "https://é.example/a?b=1&c (x)", "https://é.example/ab1cx"), (X.name_identifier, " https://orcid.org/0000-0001-0000-000X ", "0000-0001-0000-000x"),
    (X.name_identifier, "orcid:0000-0001-0000-000x", "0000-0001-0000-000x"), (X.name_identifier, "ORCID:0000-0001-0000-000x", "orcid:0000-0001-0000-000x"),
    (X.strip_parentheses, "(Univ (X))", "Univ (X)"), (X.strip_parentheses, "(( a ) )", "a"), (X.strip_parentheses, "(a) (b)", "a) (b"), (X.strip_parentheses, "(", "("), (X.strip_parentheses, None, None),
    (X.organization_key, "(Univ (X))", "univ"), (X.organization_key, "UNIV (Y)", "univ"), (X.doi_prefix, "10.1/x/y", "10.1"), (X.doi_prefix, "10.1", "10.1"), (X.doi_prefix, "emd-1", None),
    (X.digits, "https://openalex.org/T12", "12"), (X.topic_full_id, "T1", "https://openalex.org/T1"), (X.topic_full_id, "ALL", "ALL"), (X.topic_short_id, "https://openalex.org/T1", "T1"),
    (X.clean_uri, "info:eu-repo/x", None), (X.clean_uri, " HTTPS://a.b/c ", "HTTPS://a.b/c"), (X.clean_uri, "https://", None), (X.year_of_text, " 2020-01", 2020), (X.year_of_text, "20", None),
    (X.safe_int, "7", 7), (X.safe_int, "x", None), (X.safe_float, "1e3", 1000.0), (X.tsv_escape, "a\tb\nc", "a b c"), (X.blank_to_null, "  ", None), (X.version_or_estimated, " ", "estimated"),
    (X.without_utc_offset, "2020-01-01T00:00:00+00:00", "2020-01-01T00:00:00"), (X.is_orcid, "0000-0001-0000-000x", True), (X.is_orcid, "0000-0001-0000", False),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(spark, i):
    f, value, want = CASES[i]
    assert spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y == want


@pytest.mark.parametrize("value, want", [("2020-01-02", "2020-01-02 00:00:00"), ("2020-01-02T03:04Z", "2020-01-02 03:04:00"), ("2020-01-02T03:04:05.5+05:00", "2020-01-01 22:04:05"), ("2009", None), ("2009-1-1", None), (None, None)])
def test_iso(spark, value, want):
    got = spark.createDataFrame([(value,)], "x string").select(F.date_format(X.iso_timestamp(F.col("x")), "yyyy-MM-dd HH:mm:ss").alias("y")).first().y
    assert got == want


def test_published_and_numbers(spark):
    df = spark.createDataFrame([("2020-01-02T03:04:05+22:00", 0.0), ("x", None), (None, float("nan"))], "x string, n double")
    got = df.select(F.date_format(X.published_at(F.coalesce("x", F.lit(""))), "yyyy-MM-dd HH:mm").alias("p"), X.number_or_default(F.col("n"), 1.0).alias("w"), X.clamp_score(F.col("n")).alias("c")).collect()
    assert [r.p for r in got] == ["2020-01-02 03:04", "1970-01-01 00:00", "1970-01-01 00:00"]
    assert [r.c for r in got] == [0.0, 0.0, 0.0] and got[0].w == got[1].w == 1.0


def test_lists(spark):
    df = spark.createDataFrame([(["b", None, "", "(A)"],), (None,)], "x array<string>")
    got = df.select(X.affiliations(F.col("x")).alias("a"), X.lower_sources(F.col("x")).alias("s"), X.first_two(F.col("x")).alias("t"), X.canonical_identifier(X.name_identifiers(F.col("x"))).alias("c")).collect()
    assert got[0].a == ["A", "b"] and got[1].a == [] and got[0].s == ["b", "", "(a)"] and got[0].t == "b" and got[0].c == "(a)" and got[1].c is None
