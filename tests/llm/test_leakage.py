import random

from siltstone.llm import leakage as L

DOC, ITEM = "doc_id long, text string, item_id int", "item_id long, text string, suite string"
rng = random.Random(2)
RARE = ["".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(400)]


def item(k):
    w = RARE[k * 40 : k * 40 + 40]
    return "Think step by step. " + " ".join(w) + f". Options: {k}, {k + 1}, none of these."


ITEMS = [(k, item(k), "s") for k in range(6)]


def words(k, lo=0, hi=40):
    return RARE[k * 40 + lo : k * 40 + hi]


def found(spark, docs, items=ITEMS, **kw):
    d = spark.createDataFrame([(i, t, 9) for i, t in docs], DOC)
    return {(r.doc_id, r.item_id): (r.n_words, r.n_altered) for r in L.leaked_items(d, spark.createDataFrame(items, ITEM), **kw).collect()}


def test_lead_ins_and_options_are_no_content(spark):
    contents, members = L.item_contents(spark.createDataFrame(ITEMS, ITEM), "item_id", "text")
    of = {r.whole: r.words for r in contents.collect()}
    assert {r.item: of[r.whole] for r in members.collect()} == {k: [L.number(w) for w in words(k)] for k in range(6)}


def test_passages(spark):
    typo = words(2, 0, 24)
    typo[3] += "x"
    typo[10] = "some"
    typo[18] = typo[18][1:]
    wrong = words(2, 0, 24)
    for i in (3, 8, 13, 18):
        wrong[i] = "some"
    docs = [
        (1, "x " * 30 + " ".join(words(0))),
        (2, "Y " + ", ".join(words(1, 5, 21)).upper() + " z"),
        (3, " ".join(words(1, 5, 20))),
        (4, " ".join(typo)),
        (5, " ".join(wrong)),
        (6, "<p>" + "<br>".join(f"**{w}**" for w in words(3, 2, 30)) + "</p>"),
        (7, "> " + "\n> ".join(words(4, 0, 12)) + " (my friend said so long ago when it was cold) " + " ".join(words(4, 12, 30))),
        (8, "Think step by step. Options: 1, 2, none of these."),
        (9, None), (10, ""), (11, "b " * 200_000 + " ".join(words(5, 0, 20))),
        (12, " ".join(words(0)) + " q " * 300 + " ".join(words(1))),
        (12, " ".join(words(0))),
    ]
    got = found(spark, docs)
    assert set(got) == {(1, 0), (2, 1), (4, 2), (6, 3), (7, 4), (11, 5), (12, 0), (12, 1)}
    assert got[(1, 0)] == (40, 0) and got[(2, 1)] == (16, 0) and got[(4, 2)] == (24, 3) and got[(7, 4)] == (30, 0)


def test_nothing_to_find(spark):
    assert found(spark, []) == {} and found(spark, [(1, "a b c")], items=[(1, None, "s"), (2, "", "s"), (3, "short", "s")]) == {}
    assert found(spark, [(1, "a b c")], items=[]) == {}


def test_prefixes_lose_no_passage():
    """Whatever half of its own words a passage keeps, one of them is in the prefix."""
    r = random.Random(5)
    for _ in range(200):
        w = L.np.array([r.randrange(200) for _ in range(r.randint(16, 80))])
        own = L.np.array([r.random() < 0.3 for _ in w])
        rarity = L.np.array([x % 7 for x in w])
        got = L.prefix(w, own, rarity)
        for _ in range(20):
            lo = r.randrange(len(w) - 15)
            at = [i for i in range(lo, r.randint(lo + 16, len(w))) if own[i]]
            if at:
                kept = r.sample(at, -(-len(at) // 2))
                assert any(w[i] in got for i in kept)


def test_a_repeated_item_leaks_under_both_ids(spark):
    docs = [(1, " ".join(words(0))), (2, " ".join(words(1)))]
    once = found(spark, docs)
    twice = found(spark, docs, items=[*ITEMS, (70, item(0).upper(), "t")])
    assert twice == once | {(1, 70): once[(1, 0)]} and set(once) == {(1, 0), (2, 1)}


def test_another_version_of_an_item_is_found_whole(spark):
    """Items that share all but a sentence: what they share is no lead-in."""
    a = ". ".join(" ".join(x).capitalize() for x in (words(0, 0, 20), words(0, 20, 40), words(1, 0, 10)))
    b = ". ".join(" ".join(x).capitalize() for x in (words(0, 0, 20), words(0, 20, 40), words(2, 0, 10)))
    got = found(spark, [(1, " ".join(words(0, 0, 20)))], items=[(1, a, "s"), (2, b, "s")])
    assert set(got) == {(1, 1), (1, 2)}


def test_unrelated_items_change_no_verdict(spark):
    """Problems of a make, their own texts and one with other names and numbers."""
    r = random.Random(9)
    name = lambda: "".join(r.choice("bcdfgklmnprstvz") + r.choice("aeiou") for _ in range(4))
    make = lambda: f"The {name()} beetle of the harbour at {name()} sheds its shell {r.randrange(1000)} times and feeds on {name()} moss for {r.randrange(1000)} nights while its gland turns {name()} at {r.randrange(1000)} degrees"
    items = [(k, make(), "s") for k in range(40)]
    more = [(100 + k, " ".join(name() for _ in range(30)), "t") for k in range(1000)]
    docs = [(k, items[k][1]) for k in range(5)] + [(50, make()), (51, " ".join(items[7][1].split()[:16]))]
    assert found(spark, docs, items=items) == found(spark, docs, items=items + more)
    assert set(found(spark, docs, items=items)) == {(k, k) for k in range(5)} | {(51, 7)}


def test_recall_of_planted_passages(spark):
    """16 words with none, one and two altered between the first and last, anywhere in a text."""
    r = random.Random(3)
    docs, want = [], set()
    for n in range(90):
        k, at = r.randrange(6), r.randrange(24)
        w = words(k, at, at + 16)
        for i in r.sample(range(1, 15), n % 3):
            w[i] = r.choice(["some", w[i] + "x"])
        docs.append((n, " ".join(["lorem"] * r.randrange(300) + w + ["ipsum"] * r.randrange(300))))
        want.add((n, k))
    assert set(found(spark, docs)) == want


def test_tags_of_any_length_are_no_words(spark):
    tag = '<a title="' + "word " * 500 + '">'
    assert set(found(spark, [(1, " ".join(words(0, 0, 10)) + f" {tag}x</a> "[:-6] + " ".join(words(0, 10, 20)))])) == {(1, 0)}
    assert L.words_of("a <b and c, d") == ["a", "b", "and", "c", "d"]


def test_filters_let_everything_through(spark):
    n = spark.range(5000).selectExpr("xxhash64(id) x")
    bits = L.bitmap(n, 5000)
    assert L._in(bits, L.np.array([r.x for r in n.collect()])).all()
    assert L._in(bits, L.np.arange(100_000)).mean() < 0.05


def test_a_passage_beside_a_longer_text_of_the_same_make():
    """The better chain keeps too few own words; its ends come before the passage's."""
    doc = L.np.concatenate([L.np.arange(20, 60), L.np.full(10, -1), L.np.arange(20)])
    assert L.passage(doc, L.np.arange(60), L.np.arange(60) < 20) == (20, 0)
    assert L.passage(doc[:50], L.np.arange(60), L.np.arange(60) < 20) == (0, 0)
    altered = L.np.arange(20)
    altered[[5, 12]] = -1
    assert L.passage(L.np.concatenate([altered, L.np.full(10, -1), L.np.arange(20)]), L.np.arange(60), L.np.arange(60) < 20) == (20, 0)
