import json

from siltstone.operators.flatten import canonical_creators, flatten_creators, flatten_json_lines

NESTED = "seq long, name string, creators array<struct<name_type:string,name:string,identifiers:array<string>,affiliations:array<string>>>"


def brute(records):
    out = []
    for key, creators in records:
        for i, c in enumerate(creators or []):
            if c is None:
                continue
            out.append((key, "creator", i, -1, c["name"], c["name_type"], None))
            for child, f in (("identifier", "identifiers"), ("affiliation", "affiliations")):
                out += [(key, child, i, j, None, None, v) for j, v in enumerate(c[f] or []) if v is not None]
    return sorted(out, key=str)


def c(name, ids, aff, kind=None):
    return {"name_type": kind, "name": name, "identifiers": ids, "affiliations": aff}


RECORDS = [
    (1, [c("A", ["x", None, ""], None), None, c(None, [], ["u"], "Personal")]),
    (2, None),
    (3, []),
    (4, [None]),
    (1, [c("A", ["x", None, ""], None), None, c(None, [], ["u"], "Personal")]),
    (None, [c("B", None, [None, "v" * 10_000])]),
]


def test_nested(spark):
    df = spark.createDataFrame([(k, "clash", v) for k, v in RECORDS], NESTED)
    assert sorted(map(tuple, flatten_creators(df).collect()), key=str) == brute(RECORDS)
    assert sorted(map(tuple, flatten_creators(df.repartition(3)).collect()), key=str) == brute(RECORDS)
    assert flatten_creators(df.limit(0)).count() == 0


def test_lines(spark):
    lines = [
        None, "", "  ", "{", "[1]", "7", "null", '{"creators": NaN}', '{"creators": null}', '{"a": 1}',
        json.dumps({"creators": {"name": "One", "affiliations": "u", "identifiers": {"scheme": "s", "value": "9"}}}),
        json.dumps({"creators": [None, {"name": {"family": "F", "given": "G"}, "affiliations": [None, {"name": "n", "place": {"city": "c"}}, ""]}, "Plain"]}),
    ]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(lines)], "seq long, line string, key string")
    got = sorted((tuple(r) for r in flatten_json_lines(df).collect()), key=str)
    assert got == sorted(
        [
            (10, "creator", 0, -1, "One", None, None), (10, "affiliation", 0, 0, None, None, "u"), (10, "identifier", 0, 0, None, None, "9"),
            (11, "creator", 1, -1, "F, G", None, None), (11, "affiliation", 1, 1, None, None, "n"), (11, "affiliation", 1, 2, None, None, ""), (11, "creator", 2, -1, "Plain", None, None),
        ],
        key=str,
    )


def test_shapes_of_one_record():
    assert canonical_creators([1]) is None
    assert canonical_creators({"creators": []}) == []
    assert canonical_creators({"creators": 5})[0]["name"] == "5"


def test_fields_in_any_order(spark):
    df = spark.createDataFrame([(1, [{"x": 1, "affiliations": ["u"], "name": "A", "identifiers": None, "name_type": None}])], "seq long, creators array<struct<x:int,affiliations:array<string>,name:string,identifiers:array<string>,name_type:string>>")
    assert sorted((r.child, r.name, r.value) for r in flatten_creators(df).collect()) == [("affiliation", None, "u"), ("creator", "A", None)]


def test_lone_surrogates(spark):
    df = spark.createDataFrame([(1, '{"creators": [{"name": "a\\ud83d"}]}')], "seq long, line string")
    assert [r.name for r in flatten_json_lines(df).collect()] == ["a?"]


def test_lines_parsed_in_the_jvm_are_those_parsed_here(spark, sf):
    """Every line of the table, and shapes that it lacks."""
    odd = [
        '{"creators":[{"name":"a"}]} x', '{"creators":["a"]}{"b":1}', '{"creators":"a","creators":["b","c"]}', "[1]", "{'creators':['a']}", '{"creators":[1, true, null, "q", {"name":{"given":"G","family":"F"}}]}',
        '{"creators":{"name":"solo","identifiers":{"identifier":"i","scheme":"s"},"affiliations":{"city":"c"}}}', '{"creators":[{"nameType":"Personal","affiliations":["", null, 5]}]}', '{"creators":[]}', '{"creators":null}', '{"a":NaN}', " ", None,
    ]
    lines = spark.read.parquet(f"{sf}/raw_emdb.parquet").unionByName(spark.createDataFrame([(10_000 + i, x) for i, x in enumerate(odd)], "seq long, line string"))
    rows = lambda canonical: sorted(map(str, flatten_json_lines(lines, canonical=canonical).collect()))
    assert rows(None) == rows(canonical_creators)
