import random

from siltstone.llm.collapse import collapse, copies, letters_and_digits, link_letters_and_digits

FIELDS = {"reference": letters_and_digits, "link": link_letters_and_digits}
SCHEMA = "seq long, reference string, link string, first long"


def plain(s):
    return "".join(c for c in s.lower() if c.isalnum())


def link(s):
    head, _, q = s.partition("?")
    return plain(head) + "".join(sorted(plain(x) for x in q.split("&")))


def brute(rows):
    groups = {}
    for seq, r, l, _ in rows:  # noqa: E741
        if r and l and plain(r) and link(l):
            groups.setdefault((plain(r), link(l)), []).append(seq)
    return groups


def test_against_brute_force(spark):
    rng = random.Random(0)
    refs = [None, "", " ", "10.1/Ab", "10.1 / ab.", "101ab", "Ünï"]
    links = [None, "", "?", "http://x/?a=1&b=2", "HTTP://x?b=2&a=1;", "httpx a1b2", "http://x?a=1&b=2&a=1", "ÜNÏ", "ünï/", "z" * 50_000]
    rows = [(i, rng.choice(refs), rng.choice(links), 1) for i in range(300)]
    rows += [(i, "hot", "one", 1) for i in range(300, 400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    groups = brute(rows)
    assert {(r["first"], r["copies"]) for r in collapse(df, "seq", FIELDS).collect()} == {(min(g), len(g)) for g in groups.values()}
    assert {(r["first"], r["copy"]) for r in copies(df, "seq", FIELDS).collect()} == {(min(g), s) for g in groups.values() for s in g if s != min(g)}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert collapse(df, "seq", FIELDS).count() == 0 and copies(df, "seq", FIELDS).count() == 0
    none = spark.createDataFrame([(1, None, None, 1)], SCHEMA)
    assert collapse(none, "seq", FIELDS).count() == 0
