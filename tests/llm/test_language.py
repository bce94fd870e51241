import numpy as np
import pytest

from siltstone.llm import language as L

SAMPLE = {
    "en": "the file is only read by the second call and this is why the first result is always wrong when you start",
    "de": "die datei wird erst beim zweiten aufruf gelesen und deshalb ist das erste ergebnis immer falsch wenn man beginnt",
    "fr": "le fichier est seulement lu par le deuxième appel et c'est pourquoi le premier résultat est toujours faux",
    "ru": "файл читается только при втором вызове и поэтому первый результат всегда неверный когда вы начинаете",
}


def test_codewords_are_far_apart():
    c = L.codewords()
    assert min(int((c[i] != c[j]).sum()) for i in range(len(c)) for j in range(i)) >= 8


def test_prose_without_code():
    text = "One two\n\n```\nfor x in y:\n```\n\n    code here\n\n---\n[+5 ✓]\nThree `inline` four <b>five</b> http://a.b/c\n\n> six\n> seven\n\nfoo_bar(x) = y; z{}"
    assert [w for _, _, w in L.paragraphs(text)] == [["one", "two"], ["three", "four", "five"], ["six", "seven"]]
    for start, end, words in L.paragraphs(text):
        assert words[0] in text[start:end].lower() and words[-1] in text[start:end].lower()
    assert len(L.mask_code(text)) == len(text)
    assert list(L.paragraphs("")) == []


@pytest.fixture(scope="module")
def model():
    langs = list(SAMPLE)
    texts = [SAMPLE[k].split() for k in langs for _ in range(5)]
    return L.fit(texts, np.repeat(np.arange(len(langs)), 5), len(langs)), tuple(langs)


def test_segments_and_documents(spark, model):
    m, langs = model
    mixed = f"{SAMPLE['de']}. {SAMPLE['de']}\n\nok\n\n{SAMPLE['en']} {SAMPLE['en']}"
    rows = [(1, SAMPLE["fr"] + " " + SAMPLE["fr"]), (2, mixed), (3, None), (4, ""), (5, "123 !!"), (6, "ok"), (7, (SAMPLE["ru"] + "\n\n") * 300), (7, SAMPLE["ru"])]
    seg = L.language_segments(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string"), m, languages=langs)
    got = sorted((r.key, r.start, r.lang) for r in seg.collect())
    assert [(k, y) for k, _, y in got if k in (1, 2)] == [(1, "fr"), (2, "de"), (2, "en")]
    assert {k for k, _, _ in got} == {1, 2, 6, 7}
    assert all(0 < r.confidence <= 1 for r in seg.collect())
    assert all(r.ambiguous == (r.confidence < L.AMBIGUOUS) for r in seg.collect())
    table = spark.createDataFrame([(k, "x") for k in (1, 2, 3)], "doc_id long, lang string")
    assert {(r.key, r.lang, r.n_langs) for r in L.main_languages(table, seg).collect()} == {(1, "fr", 1), (2, "en" if len(SAMPLE["en"].split()) >= len(SAMPLE["de"].split()) else "de", 2), (3, None, 0)}
    docs = {(r.key, r.lang, r.n_langs) for r in L.document_languages(seg).collect()}
    assert {(1, "fr", 1), (2, "de", 2), (2, "en", 2)} <= docs and not any(k == 6 for k, _, _ in docs)
    assert L.language_segments(spark.createDataFrame([], "doc_id long, text string"), m, languages=langs).count() == 0


def test_held_out_accuracy(spark, sf):
    """Fitted on half of the labelled documents, most labels of the other half agree; the rest are the wrong ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = L.fit_languages(docs.where("doc_id % 2 = 0"))
    seg = L.document_languages(L.language_segments(docs.where("doc_id % 2 = 1"), m)).where("n_langs = 1")
    j = seg.join(docs.selectExpr("doc_id key", "lower(substring(lang, 1, 2)) label"), "key").where("label in ('en','de','fr','es','pt','it','nl','ru','pl')").selectExpr("avg(int(label = lang)) a").first().a
    assert j > 0.9


def test_no_labels_at_all(spark):
    df = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id long, text string, lang string")
    L.language_segments(df, L.fit_languages(df)).collect()


def test_prose_between_lines_of_code_counts():
    """One paragraph with more marks of code than a fourth of its words keeps its lines of prose."""
    text = "a = b[0]; c = {d: e}\nthis line is only prose and says what the code does\nf(x) -> y; g::h(z) | w[1]"
    assert [w for _, _, w in L.paragraphs(text)] == [SAMPLE_LINE.split()]
    assert list(L.paragraphs("a = b[0]; c = {d: e}\nf(x) -> y; g::h(z)")) == []


SAMPLE_LINE = "this line is only prose and says what the code does"


def test_long_tags_and_long_words_are_read_whole():
    tag = '<a title="' + "mot " * 200 + '">'
    assert [w for _, _, w in L.paragraphs(f"one {tag}two</a> three")] == [["one", "two", "three"]]
    assert len(L.features("b" * 39 + "xyz")) > len(L.features("b" * 39)) and not np.array_equal(L.features("b" * 45 + "x"), L.features("b" * 45 + "y"))
