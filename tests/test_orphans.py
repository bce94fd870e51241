import datetime as dt
import random

from pyspark.sql import functions as F

from siltstone.operators.orphans import COUNTS, add_counts, count_changes, current_orphans, orphan_references, orphan_report, orphans_of

REFS = "tab string, row_key long, key string, at timestamp, n int"
RECS = "key string, added_at timestamp, deleted_at timestamp, n int"


def t(h):
    return None if h is None else dt.datetime(2020, 1, 1) + dt.timedelta(hours=h)


def brute(refs, recs):
    out = []
    for tab, k, key, at, _ in refs:
        if key is None or at is None:
            continue
        mine = [r for r in recs if r[0] == key and r[1] is not None]
        if not any(a <= at and (d is None or d > at) for _, a, d, _ in mine):
            out.append((tab, k, at.strftime("%Y-%m"), "missing" if not mine else "late" if any(a > at for _, a, _, _ in mine) else "deleted"))
    return sorted(out, key=str)


def run(spark, refs, recs, bucket="day"):
    df = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(recs, RECS), bucket)
    return sorted(map(tuple, df.collect()), key=str)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    keys = [None, "", "a", "a", "a", "b", "c", "d"]
    recs = [(rng.choice(keys), t(rng.choice([None, *range(0, 2000, 7)])), t(rng.choice([None, None, *range(0, 2000, 5)])), 1) for _ in range(60)]
    refs = [(rng.choice(["x", "y"]), i % 150, rng.choice([*keys, "zz"]), t(rng.choice([None, *range(0, 2000, 3)])), 1) for i in range(200)]
    assert run(spark, refs, recs) == brute(refs, recs)
    assert run(spark, refs, recs, "month") == brute(refs, recs)


def test_moments(spark):
    recs = [("a", t(10), t(20), 0), ("e", t(5), t(5), 0)]
    refs = [("x", h, "a", t(h), 0) for h in (9, 10, 19, 20)] + [("x", 50, "e", t(5), 0)]
    assert run(spark, refs, recs) == brute(refs, recs)
    assert {r[1] for r in run(spark, refs, recs)} == {9, 20, 50}


def test_empty_sides(spark):
    assert run(spark, [], [("a", t(1), None, 0)]) == []
    assert run(spark, [("x", 1, "a", t(1), 0)], []) == [("x", 1, "2020-01", "missing")]


def test_report(spark):
    df = orphan_references(spark.createDataFrame([("x", 1, "a", t(1), 0)] * 3, REFS), spark.createDataFrame([], RECS))
    assert [tuple(r) for r in orphan_report(df).select("tab", "period", "reason", F.col("n_orphans")).collect()] == [("x", "2020-01", "missing", 3)]


def test_current(spark):
    recs = spark.createDataFrame([("a", t(1), None, 0), ("b", t(1), t(9), 0), ("b", t(2), t(9), 0), ("c", t(5), None, 0), (None, t(1), None, 0), ("e", t(4), t(4), 0)], RECS)
    refs = spark.createDataFrame([("x", i, k, t(3), 0) for i, k in enumerate(["a", "b", "b", "c", "z", "e", None])] + [("y", 1, "b", t(20), 0)], REFS)
    assert sorted(map(tuple, current_orphans(refs, recs).collect())) == [("x", "b", 2), ("x", "e", 1), ("x", "z", 1), ("y", "b", 1)]
    assert sorted(map(tuple, current_orphans(refs, recs, F.lit(t(4))).collect())) == [("x", "c", 1), ("x", "e", 1), ("x", "z", 1)]
    assert current_orphans(refs.limit(0), recs).count() == 0


def test_counts_kept_by_batches(spark):
    """Changes in random batches, some taken back later, against the state of the rest."""
    rng = random.Random(5)
    keys = [None, "a", "b", "c", "d"]
    recs = [(rng.choice(keys), t(rng.randrange(50)), None, rng.choice([1, 1, -1])) for _ in range(40)]
    refs = [(rng.choice(["x", "y"]), 0, rng.choice([*keys, "zz"]), t(1), rng.choice([1, 1, -1])) for _ in range(60)]
    counts = spark.createDataFrame([], COUNTS)
    for n in range(3):
        f = spark.createDataFrame(refs[n::3], REFS).withColumnRenamed("n", "sign")
        r = spark.createDataFrame(recs[n::3], RECS).withColumnRenamed("n", "sign")
        counts = add_counts(count_changes(f, r), counts)
    net, living = {}, {}
    for tab, _, k, _, n in refs:
        net[(tab, k)] = net.get((tab, k), 0) + n
    for k, _, _, n in recs:
        living[k] = living.get(k, 0) + n
    want = sorted((tab, k, n) for (tab, k), n in net.items() if k is not None and n > 0 and living.get(k, 0) <= 0)
    assert sorted(map(tuple, orphans_of(counts).collect())) == want
