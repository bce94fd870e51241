import pytest

from siltstone.llm import encoding as E

CLEAN = ["Übersicht der Höhenmoore", "Données d’été près de", "Измерения влажности почвы", "Каталог лесных птиц", "Měření průtoků řeky", "森林の鳥類調査", "Pollen – naïve baseline", "São Paulo ± 3 °C"]
SCHEMA = "source string, id long, pos int, text string, restored string"


def table(spark):
    rows, i = [], 0
    for k in range(60):
        for t in CLEAN:
            rows.append(("s", i, 0, f"{t} {k}", "clash"))
            i += 1
    return rows


def test_swaps_are_found_and_undone(spark):
    rows = table(spark)
    swaps = [("utf-8", "cp1252", CLEAN[0]), ("utf-8", "cp1251", CLEAN[1]), ("cp1251", "cp1252", CLEAN[2]), ("utf-8", "koi8-r", CLEAN[3]), ("utf-8", "cp437", CLEAN[6]), ("utf-8", "gbk", CLEAN[3])]
    want = {}
    for n, (right, wrong, t) in enumerate(swaps):
        garbled = t.encode(right, "ignore").decode(wrong, "replace")
        rows.append(("s", 10_000 + n, 0, garbled, ""))
        want[10_000 + n] = t if "�" not in garbled else None
    twice = CLEAN[0].encode().decode("cp1252").encode().decode("cp1252")
    rows += [("s", 10_100, 0, twice, ""), ("s", 10_101, 0, "H�henmoore", ""), ("s", 10_102, 0, "a\x93b\x94", ""), (None, 10_103, 0, None, ""), ("s", None, None, "", ""), ("s", 10_105, 0, "ascii " * 20_000, "")]
    rows += [("s", 10_106, 1, f"{CLEAN[0]} und {CLEAN[1].encode().decode('cp1252')}", ""), ("s", 10_106, 1, f"{CLEAN[0]} und {CLEAN[1].encode().decode('cp1252')}", "")]
    got = {}
    for r in E.garbled_texts(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.id, []).append(r.restored)
    assert set(got) == {*want, 10_100, 10_101, 10_102, 10_106} and len(got[10_106]) == 2
    for k, t in want.items():
        assert t is None or got[k] == [t], (k, got[k])
    assert got[10_100] == [CLEAN[0]] and got[10_106][0] == f"{CLEAN[0]} und {CLEAN[1]}"


def test_empty_and_plain(spark):
    assert E.garbled_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    assert E.garbled_texts(spark.createDataFrame([("s", 1, 0, "plain", ""), (None, 2, 0, None, "")], SCHEMA)).count() == 0


def test_reading_under_a_cipher():
    assert E.read_as("Ã¼", (("utf-8", "cp1252"),)) == "ü"
    assert E.read_as("ü", (("utf-8", "cp1252"),)) is None
    assert E.read_as("Ç", (("cp1251", "cp1252"),)) == "З"


TURKISH = ["Göl suyu sıcaklığı ölçümleri", "Kuş göçü gözlem kayıtları", "Dağ çayırlarının bitki örtüsü", "Şehir içi hava kirliliği ölçümleri", "Yağış ve akış ölçüm istasyonları", "Ağaç halkası genişlikleri", "Kıyı şeridi değişimi"]
BALTIC = ["Ežerų vandens temperatūros matavimai", "Paukščių migracijos stebėjimai", "Miško augalų rūšių įvairovė", "Upių nuotėkio duomenų rinkinys", "Dirvožemio drėgmės matavimų sąrašas", "Medžių rievių pločiai", "Krantų kaita žiemą"]
RUSSIAN = ["Измерения влажности почвы", "Каталог лесных птиц", "Наблюдения за миграцией птиц", "Толщина снежного покрова", "Температура воды озера", "Расход воды в реке", "Ширина годичных колец деревьев", "Состав воздуха в городе", "Растения горных лугов"]


def mixed(lines, garble, rounds=12):
    """Clean texts of one source, and of another where one in four is garbled."""
    rows, want = [], {}
    for k in range(rounds):
        for j, t in enumerate(lines):
            rows.append(("clean", len(rows), 0, f"{t} {k}", ""))
            said = f"{t} {k} {lines[(j + k) % len(lines)]}"
            bad = garble(said) if (j + k) % 4 == 0 else said
            if bad != said:
                want[len(rows)] = said
            rows.append(("other", len(rows), 0, bad, ""))
    return rows, want


@pytest.mark.parametrize(
    "lines, written, read",
    [(TURKISH, "cp1254", "cp1252"), (BALTIC, "cp1257", "cp1252"), (BALTIC, "utf-8", "cp1257"), (RUSSIAN, "mac_cyrillic", "cp1252"), (RUSSIAN, "cp1251", "koi8-r"), (RUSSIAN, "cp1251", "cp866")],
)
def test_swaps_that_no_list_names(spark, lines, written, read):
    rows, want = mixed(lines, lambda t: t.encode(written).decode(read, "replace"))
    got = {r.id: r.restored for r in E.garbled_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == set(want)
    right = [got[k] == t for k, t in want.items() if "\ufffd" not in t.encode(written).decode(read, "replace")]
    assert all(right), [(t, got[k]) for k, t in want.items() if got[k] != t][:3]


def test_a_page_that_no_codec_has_is_learned(spark):
    """Four letters stand for one another, as in no code page: only the bigrams tell."""
    ring = str.maketrans("аоие", "оиеа")
    rows, want = mixed(RUSSIAN, lambda t: t.translate(ring).encode("cp1251").decode("cp1252"), rounds=40)
    got = {r.id: r.restored for r in E.garbled_texts(spark.createDataFrame(rows, SCHEMA), rounds=6).collect()}
    assert set(got) == set(want)
    letters = [(a, b) for k, t in want.items() for a, b in zip(t, got[k]) if a > "\x7f"]
    assert sum(a == b for a, b in letters) > 0.95 * len(letters), sorted({(a, b) for a, b in letters if a != b})


def test_no_letter_stands_for_two_symbols():
    import pandas as pd

    counts = pd.DataFrame([("x", "а", 9.0), ("y", "а", 8.0), ("y", "о", 1.0), ("z", "о", 5.0)], columns=["symbol", "letter", "n"])
    assert E.one_to_one(counts, {ord("y"): "э"}).table == {ord("x"): "а", ord("z"): "о", ord("y"): "э"}
