import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import timestamps as T

SCHEMA = "tab string, row_key long, src string, seq long, value string, emit int, cands string"
CASES = {
    "2020-01-02T03:04:05Z": "2020-01-02T03:04:05Z",
    "2020-01-02T24:00:00Z": "2020-01-03T00:00:00Z",
    "2020-01-02T24:00:01Z": None,
    "2021-02-30": None,
    "2016-02-29": "2016-02-29T00:00:00Z",
    " 2020-01-02 \t": "2020-01-02T00:00:00Z",
    "2020-01-02T03:04": "2020-01-02T03:04:00Z",
    "2020-01-02 03:04:05.987+05:45": "2020-01-01T21:19:05Z",
    "2020-01-02T03:04:05+22:00": "2020-01-02T03:04:05Z",
    "2020-01-02T03:04:05-14:00": "2020-01-02T17:04:05Z",
    "2018-11-30T23:22:39+01:00[Asia/Tokyo]": "2018-11-30T22:22:39Z",
    "2020-07-01 12:00:00 PDT": "2020-07-01T19:00:00Z",
    "2020-11-03 12:00:00 CST": "2020-11-03T18:00:00Z",
    "2014-11-02T01:35:12 America/Chicago": "2014-11-02T06:35:12Z",
    "2020-03-08T02:10:00[America/Chicago]": "2020-03-08T08:10:00Z",
    "2020-03-08 02:10:00 Nowhere/City": None,
    "2020-03-08 02:10:00 Etc/UTC": "2020-03-08T02:10:00Z",
    "05/13/2019": "2019-05-13T00:00:00Z",
    "13/05/2019": None,
    "03/04/2019": "2019-03-04T00:00:00Z",
    "03.04.2019 10:00": "2019-04-03T10:00:00Z",
    "1/20/2021 12:33:20 AM": "2021-01-20T00:33:20Z",
    "1/20/2021 13:33:20 PM": None,
    "November 19, 2014 4:17 PM": "2014-11-19T16:17:00Z",
    "Mon, 06 Jul 2009 02:32:29 +0200": "2009-07-06T00:32:29Z",
    "10-Mar-2009 11:35": "2009-03-10T11:35:00Z",
    "17 Dec 2020": "2020-12-17T00:00:00Z",
    "2011-W11-4": "2011-03-17T00:00:00Z",
    "2011-W53-1": None,
    "2020": "2020-01-01T00:00:00Z",
    "2020-07": "2020-07-01T00:00:00Z",
    "20080622": "2008-06-22T00:00:00Z",
    "20150123T084701Z": "2015-01-23T08:47:01Z",
    "1585462116": "2020-03-29T06:08:36Z",
    "1445138363963": "2015-10-18T03:19:23Z",
    "12345": None,
    "1998-2001": None,
    "Spring 2020": None,
    "unknown": None,
    "": None,
    None: None,
    "x" * 100_000: None,
    "2" * 5000: None,
}


def test_values(spark):
    rows = [("t", i, "s", i, v, 1, "x") for i, v in enumerate(CASES)]
    got = {r.row_key: r.utc for r in T.normalise_timestamps(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (v, want) in enumerate(CASES.items()):
        assert got.get(i) == want, v


def test_rows_of_every_kind(spark):
    rows = [("t", 1, None, None, "2020", 1, ""), ("t", 1, None, None, "2020", 1, ""), ("t", None, "s", 5, "2021", 1, ""), (None, 3, "s", 5, "2022", 1, "")]
    got = sorted((r.tab or "", r.row_key or 0, r.utc[:4]) for r in T.normalise_timestamps(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("", 3, "2022"), ("t", 0, "2021"), ("t", 1, "2020"), ("t", 1, "2020")]
    assert T.normalise_timestamps(spark.createDataFrame([], SCHEMA)).count() == 0


def _brute(cands):
    def cost(path):
        total = sum(c[i][2] for c, i in zip(cands, path))
        for (a, i), (b, j) in zip(zip(cands, path), zip(cands[1:], path[1:])):
            total += T.SWITCH_COST * (a[i][0] != b[j][0]) + T.BACKWARD_COST * (b[j][1] < a[i][1])
        return total

    return min(cost(p) for p in itertools.product(*[range(len(c)) for c in cands])), cost


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_path_is_the_cheapest_whatever_the_blocks(spark, block):
    """Runs of open records over block borders against all paths."""
    for seed in range(4):
        rng = random.Random(seed)
        cands = [[(rng.randint(0, 2), rng.randint(0, 9) * 10 + k, rng.choice([0.0, 0.5, 2.0])) for k in range(rng.choice([1, 2, 2, 3]))] for _ in range(9)]
        if seed == 3:
            cands = [c * 2 if len(c) == 1 else c for c in cands]
        rows = [("t", i, "s", i, True, c) for i, c in enumerate(cands)]
        df = spark.createDataFrame(rows, "tab string, row_key long, src string, seq long, emit boolean, cands array<struct<fmt:int,utc_s:bigint,cost:double>>")
        got = {r.row_key: (r.fmt, r.utc_s) for r in T.choose_interpretations(df, block).collect()}
        least, cost = _brute(cands)
        assert len(got) == len(cands)
        path = [min((i for i, c in enumerate(cs) if (c[0], c[1]) == got[k]), key=lambda i: cs[i][2]) for k, cs in enumerate(cands)]
        assert cost(path) == pytest.approx(least)


def test_context_decides_where_priors_leave_it_open():
    chain = T.Chain(np.array([1, 1, 2, 1]), np.array([0, 5, 5, 9]), np.zeros(4), np.array([0, 1, 3, 4]))
    assert chain.best(0, 2) == [0, 0, 0]


def test_blanks_before_a_value_do_not_count(spark):
    rows = [("t", 1, "s", 1, " " * 81 + "2020-01-02" + "\t" * 100, 1, "x")]
    assert [r.utc for r in T.normalise_timestamps(spark.createDataFrame(rows, SCHEMA)).collect()] == ["2020-01-02T00:00:00Z"]


def test_without_conventions_the_records_around_decide(spark):
    """Against every path, by cost, over a source whose order of day and month is unknown."""
    rng = random.Random(3)
    said = ["25/03/2019", "26/03/2019", "03/04/2019", "05/04/2019", "2019-04-06", "04.07.2019", "07/08/2019", "2014-11-02T01:35:12 America/Chicago", "12/13/2019"]
    rows = [("t", i, "s", i, rng.choice(said), 1, "x") for i in range(11)]
    df = spark.createDataFrame(rows, SCHEMA)
    cands = [[(c.fmt, c.utc_s) for c in r.cands] for r in T.with_interpretations(df, "value", conventions=False).orderBy("seq").collect()]
    cost = lambda path: sum((a[0] != b[0]) + (b[1] < a[1]) for a, b in zip(path, path[1:]))
    least = min(map(cost, itertools.product(*cands)))
    for block in (3, 100):
        chosen = {r.row_key: (r.fmt, r.utc_s) for r in T.choose_interpretations(T.with_interpretations(df, "value", conventions=False).withColumn("emit", F.lit(True)), block).collect()}
        assert cost([chosen[i] for i in range(len(rows))]) == least
    first = [("t", i, "s", i, v, 1, "x") for i, v in enumerate(["25/03/2019", "01/04/2019", "02/04/2019", "13/04/2019"])]
    first = spark.createDataFrame(first, SCHEMA)
    assert [r.utc[:10] for r in T.normalise_timestamps(first, conventions=False).orderBy("row_key").collect()] == ["2019-03-25", "2019-04-01", "2019-04-02", "2019-04-13"]
    assert [r.utc[:10] for r in T.normalise_timestamps(first).orderBy("row_key").collect()] == ["2019-01-04", "2019-02-04"]
