import pytest
from pyspark.sql import functions as F

from siltstone.plans.merge import upsert
from siltstone.runtime import materialise, shared_dir
from siltstone.sources import io
from siltstone.streaming.merge import VersionedTable, merge_stream


def test_ndjson(spark, tmp_path):
    (tmp_path / "a-2.ndjson").write_text('{"id": "2", "x": [1]}\n\n{broken\n')
    (tmp_path / "a-10.ndjson").write_text('{"id": "10", "extra": 1}\n[1]\n{"id": 7}\n')
    good, bad = io.read_ndjson(spark, [str(tmp_path / "*.ndjson"), str(tmp_path / "missing")], "id string, x array<int>")
    assert [r.id for r in good.orderBy(*io.natural_order()).collect() if r.id] == ["2", "10", "7"]
    assert "{broken" in {r.line for r in bad.collect()}
    none, _ = io.read_ndjson(spark, str(tmp_path / "missing"), "id string")
    assert none.count() == 0
    with pytest.raises(Exception):  # noqa: B017
        io.read_ndjson(spark, str(tmp_path / "a-2.ndjson"), "id string", fail_fast=True)[0].collect()


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else "a\tb\n", i / 3) for i in range(25)], "id int, s string, d double").coalesce(1)
    io.write_ndjson(df, str(tmp_path / "j"), rows_per_file=10)
    assert len(list((tmp_path / "j").glob("part-*"))) == 3
    assert io.read_ndjson(spark, str(tmp_path / "j"), "id int, s string, d double")[0].count() == 25
    io.write_tsv(df, str(tmp_path / "t"))
    head = next((tmp_path / "t").glob("part-*")).read_text().split("\n")[:3]
    assert head == ["id\ts\td", "0\ta b \t0.00", "1\t\t0.33"]
    io.replace(df, str(tmp_path / "p"))
    io.append(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 50
    io.write_csv(df.select("id"), str(tmp_path / "c"))
    assert io.read_csv(spark, str(tmp_path / "c"), "n int").agg(F.sum("n")).first()[0] == 300
    assert io.json_report(df.select("id", "d").where("id < 2"), "id").first().json == '{"d":0.0}'


def test_dimension_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("﻿topic_id\t subfield_id \n1\t2\n")
    df = io.read_dimension_csv(spark, str(tmp_path / "d.csv"), ["topic_id", "subfield_id"])
    assert df.columns == ["topic_id", "subfield_id"] and df.first().subfield_id.strip() == "2"
    with pytest.raises(ValueError):
        io.read_dimension_csv(spark, str(tmp_path / "d.csv"), ["nope"])


def test_shared_dir_is_the_sessions(spark, tmp_path):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialise(spark.range(5).withColumn("x", F.lit(None).cast("string")), "t")
    assert df.count() == 5 and df.schema["x"].dataType.simpleString() == "string"


def test_stream_merges_each_batch_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    schema = "id int, v string, seq long"
    table = VersionedTable(spark, out, schema, ["id"], buckets=8)
    for n, rows in enumerate([[(1, "a", 1), (2, "b", 2)], [(2, "c", 3), (3, "d", 4)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        merge_stream(stream, table, lambda new, old: upsert(old, new, ["id"], "seq"), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(tuple(r) for r in table.read().select("id", "v").collect()) == [(1, "a"), (2, "c"), (3, "d")]
    table.apply(spark.createDataFrame([(9, "x", 9)], schema), 0, lambda new, old: new)
    assert table.read().count() == 3


def test_a_head_that_cannot_be_read_loses_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id int, seq long", ["id"], buckets=4)
    merge = lambda new, old: upsert(old, new, ["id"], "seq")
    one = lambda i: spark.createDataFrame([(i, i)], "id int, seq long")
    table.apply(one(1), 0, merge)
    head = next((tmp_path / "t" / "_heads" / "0").glob("part-*"))
    kept = head.read_text()
    head.write_text("{broken")
    for crc in head.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception):  # noqa: B017
        table.apply(one(2), 1, merge)
    head.write_text(kept)
    table.apply(one(2), 1, merge)
    assert sorted(r.id for r in table.read().collect()) == [1, 2]


def test_a_batch_writes_only_what_it_touches(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id int, seq long", ["id"], buckets=16)
    merge = lambda new, old: upsert(old, new, ["id"], "seq")
    rows = lambda ids, seq: spark.createDataFrame([(i, seq) for i in ids], "id int, seq long")
    table.apply(rows(range(200), 0), 0, merge)
    first = table._head(0)
    table.apply(rows([5], 1), 1, merge)
    second = table._head(1)
    assert sum(first[k] != second[k] for k in first) == 1 and table.read().count() == 200
    for n in range(2, 6):
        table.apply(rows([5], n), n, merge)
    versions = {v for h in (4, 5) for v in table._head(h).values()}
    assert {p.name for p in (tmp_path / "t").glob("v-*")} == versions and table._heads() == [4, 5]
    # A merge that leaves nothing of a bucket, and a batch without rows.
    table.apply(rows([5], 9), 6, lambda new, old: old.join(new.select("id"), "id", "left_anti"))
    table.apply(rows([], 9), 7, merge)
    assert table.read().count() == 199 and table.last_batch() == 7


def test_counts_of_references_from_a_stream(spark, tmp_path):
    """Orphans from a table of signed counts that batches of changes keep."""
    from siltstone.operators.orphans import COUNTS, add_counts, count_changes, orphans_of

    table = VersionedTable(spark, str(tmp_path / "t"), COUNTS, ["tab", "key"], buckets=4)
    refs = "tab string, key string, at timestamp, sign int"
    recs = "key string, added_at timestamp, deleted_at timestamp, sign int"
    import datetime as dt

    now = dt.datetime(2020, 1, 1)
    batches = [([("c", "a", now, 1), ("c", "b", now, 1)], []), ([], [("a", now, None, 1)]), ([("c", "b", now, -1)], [("a", now, None, -1)])]
    seen = []
    for n, (f, r) in enumerate(batches):
        table.apply(count_changes(spark.createDataFrame(f, refs), spark.createDataFrame(r, recs)), n, add_counts)
        seen.append(sorted((x.key, x.n_references) for x in orphans_of(table.read()).collect()))
    assert seen == [[("a", 1), ("b", 1)], [("b", 1)], [("a", 1)]]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_json_document_and_batches(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "a": {"n": 1},\n "b": [1, 2]\n}')
    assert io.read_json_document(spark, str(tmp_path / "d.json")).first().asDict(recursive=True) == {"a": {"n": 1}, "b": [1, 2]}
    out = str(tmp_path / "sent")
    import os

    os.mkdir(out)

    def send(batch):
        import uuid

        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(batch)))

    io.document_batches(spark.range(25).coalesce(1), send, rows_per_batch=10)
    assert sorted(int(p.read_text()) for p in (tmp_path / "sent").iterdir()) == [5, 10, 10]


def test_jdbc_by_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).write.jdbc(url, "numbers", mode="overwrite", properties=driver)
    df = io.read_jdbc(spark, url, "numbers", "id", 0, 100, 4, properties=driver)
    assert df.rdd.getNumPartitions() == 4 and df.agg(F.sum("id")).first()[0] == 4950


def test_constant_map_and_shuffle(spark):
    from siltstone.plans import reports

    df = spark.createDataFrame([("b", 1.5), ('a"q', None)], "k string, v double")
    assert reports.source_map(df, "k", "v", "M") == 'export const M = {\n  "a\\"q": null,\n  "b": 1.5,\n};\n'
    assert sorted(r.id for r in reports.shuffled(spark.range(20), 3).collect()) == list(range(20))
