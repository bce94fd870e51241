import random

import pytest

from siltstone.llm import names as N


def groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.entity, set()).add(r.name)
    return sorted(map(sorted, out.values()))


def one(spark, f, names, **kw):
    return groups(f(spark.createDataFrame([(n, 1) for n in names], "name string, entity int"), **kw))


def test_persons(spark):
    smith = ["Sokenezek, William", "William Sokenezek", "SOKENEZEK, William", "Sokenezek,William", "Sokenezek W", "Sokenezek, W.", "Dr. Bill Sokenezek", "Sokenezek, William T.", "Soknezek, William", "Sokénezek, Willaim", "William Sokenezek, PhD"]
    other = ["Sokenezek, Yolanda", "Yola Sokenezek"]
    more = [f"Tosesod{c}ius, {g}" for c, g in zip("bcdfghklmn", ["William"] * 5 + ["Yolanda"] * 5)]
    got = one(spark, N.resolve_persons, [*smith, *other, *more, None, "", " ", "n/a", "Unknown", "x" * 5000])
    assert sorted(smith) in got and sorted(other) in got


def test_initials_of_two_people_stand_for_neither(spark):
    got = one(spark, N.resolve_persons, ["Varamitov, Victoria", "Varamitov, Vincent", "Varamitov, V."])
    assert got == [["Varamitov, Victoria"], ["Varamitov, Vincent"]]


def test_organisations(spark):
    a = ["Plezeport General Hospital", "General Hospital of Plezeport", "plezeport gen. hosp.", "(Plezeport General Hospital)", "General Hosp., Plezeport", "The Plezeprot General Hospital", "Plezeport General Hospital, Estrana"]
    b = ["Plezeport Botanical Garden", "Garden, Botanical, Plezeport"]
    c = ["Whavedoholm General Hospital"]
    got = one(spark, N.resolve_organisations, [*a, *b, *c, None, "", "n/a", "-"])
    assert got == sorted(map(sorted, [a, b, c]))


def test_a_place_behind_a_comma_is_no_mere_addition(spark):
    """An unknown short form and a place behind the comma: the places still tell them apart."""
    names = ["Hsop Gen, Plezeport", "Hsop Gen, Whavedoholm", "Plezeport General Hospital", "Whavedoholm General Hospital", "Tirland General Hospital, Plezeport"]
    assert not any({"Hsop Gen, Plezeport", "Hsop Gen, Whavedoholm"} <= set(g) for g in one(spark, N.resolve_organisations, names))


def test_pairs(spark):
    df = spark.createDataFrame([("b", "e"), ("a", "e"), ("Z", "e"), ("q", "f"), ("a", "e")], "name string, entity string")
    assert sorted(map(tuple, N.same_entity_pairs(df).collect())) == [("Z", "a"), ("Z", "b"), ("a", "b")]
    assert N.same_entity_pairs(df.limit(0)).count() == 0


def test_empty(spark):
    assert one(spark, N.resolve_persons, []) == [] and one(spark, N.resolve_organisations, []) == []


def slipped(rng, w):
    i = rng.randrange(len(w) - 1)
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :]])


def test_every_single_slip_shares_a_suffix_and_a_shape():
    rng = random.Random(1)
    for _ in range(2000):
        w = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 12)))
        v = slipped(rng, w)
        assert set(N.suffixes(w)) & set(N.suffixes(v)), (w, v)
        assert set(N.shapes(w)) & set(N.shapes(v)) and N.one_slip(w, v), (w, v)


def test_common_subsequences():
    rng = random.Random(2)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for _ in range(1000):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(90))) for _ in range(2))
        assert N.common_subsequence(a, b) == slow(a, b)


@pytest.mark.parametrize("block", [30, 4, 1])
def test_close_tokens_against_all_pairs(spark, monkeypatch, block):
    """With large blocks refined, every pair of one slip is still compared, also in short tokens."""
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(block)
    tokens = {"".join(rng.choice("abcde") for _ in range(rng.randint(3, 5))) + rng.choice(["ov", "ek", "ius", ""]) for _ in range(150)}
    tokens |= {slipped(rng, w) for w in sorted(tokens)[:60]}
    df = spark.createDataFrame([(t, c, 1) for t in tokens for c in ("k", "l")], "token string, context string, n long")
    got = {(r.context, r.x, r.y): r.slips for r in N.close_tokens(df).collect()}
    want = {(x, y) for x in tokens for y in tokens if x < y and N.one_slip(x, y) and N.ratio(x, y) >= N.LEAST_RATIO}
    assert {(x, y) for (c, x, y), k in got.items() if k == 1} == want and len(want) > 30
    assert all(N.ratio(x, y) >= N.LEAST_RATIO for _, x, y in got)


def test_two_slips_in_a_long_token(spark):
    """Only against a form of many names."""
    many = [f"{f}Konstabelmaierin, Ann{x}" for f in ("", "Dr ", "Prof ") for x in ("", "a", "e", " B.", " C.", ", PhD")]
    got = one(spark, N.resolve_persons, [*many, "Konstibelmeierin, Ann"])
    assert any({"Konstabelmaierin, Ann", "Konstibelmeierin, Ann"} <= set(g) for g in got)


def test_a_slip_of_many_spellings_against_a_form_of_more(spark):
    """As many spellings of the slip as of a short list of the right form, ten times as many."""
    right = [f"{t}Brakenhorster, W{x}" for t in ("", "Dr ", "Prof ", "Mr ", "Sir ") for x in ("illiam", ".", "illiam T.", "illiam A.", "illiam B.", "illiam C.", "illiam D.", "illiam, PhD")]
    slip = ["Brakenhoster, William", "William Brakenhoster", "Brakenhoster, W.", "BRAKENHOSTER, William"]
    got = one(spark, N.resolve_persons, [*right, *slip])
    assert any(set(slip) | {"Brakenhorster, William"} <= set(g) for g in got)


def test_short_forms_of_no_list_are_learned_from_identifiers(spark):
    """Given names and short forms made up here; the half of the people without identifiers are linked too."""
    rng = random.Random(6)
    part = lambda n: "".join(rng.choice("bdgklmnprstvz") + rng.choice("aeiou") for _ in range(n))
    pets = {part(4).capitalize(): part(2).capitalize() for _ in range(8)}
    rows, ids, want = [], [], []
    for k in range(60):
        family, given = part(4).capitalize() + "mann", rng.choice(sorted(pets))
        pair = [f"{family}, {given}", f"{pets[given]} {family}"]
        want.append(pair)
        rows += pair
        if k < 30:
            ids += [(n, f"0000-{k}") for n in (*pair, f"{given} {family}")]
            rows.append(f"{given} {family}")
    names = spark.createDataFrame([(n,) for n in rows], "name string")
    got = groups(N.resolve_persons(names, spark.createDataFrame(ids, "name string, identifier string")))
    together = sum(any(set(p) <= set(g) for g in got) for p in want)
    assert together >= 0.9 * len(want) and max(map(len, got)) <= 3
    assert not any(set(p) <= set(g) for g in groups(N.resolve_persons(names)) for p in want)


def test_unrelated_names_change_nothing(spark):
    """Whether a word says the kind or the place doesn't hang on the size of the table."""
    few = ["Plezeport General Hospital", "General Hosp., Plezeport", "Plezeprot General Hospital", "Univ. of Plezeport, Estrana", "University of Plezeport", "Whavedoholm University"]
    rng = random.Random(8)
    more = ["".join(rng.choice("bdgklmnprstvz") + rng.choice("aeiou") for _ in range(5)).capitalize() + " Institute" for _ in range(1500)]
    assert one(spark, N.resolve_organisations, few) == [g for g in one(spark, N.resolve_organisations, few + more) if set(g) & set(few)]


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(60):02}", f"n{rng.randrange(60):02}") for _ in range(45)] + [(f"c{i:02}", f"c{i + 1:02}") for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for x in root}


@pytest.mark.parametrize("a, b, want", [("", "", 1.0), ("abc", "abc", 1.0), ("sirovedov", "sirovedv", 16 / 17), ("ab", "ba", 0.5)])
def test_ratio(a, b, want):
    assert N.ratio(a, b) == pytest.approx(want)


def test_lone_initials_that_spell_a_title():
    assert N.person_parts("Dozazarius DR") == ("dozazarius", "", ["d", "r"], True)
    assert N.person_parts("Dr Dozazarius")[0] == "dozazarius"
