"""Texts that were decoded with the wrong character encoding.

An unknown swap of code pages is a substitution cipher of its source. Two kinds
are told apart. Where one letter became one symbol, the cipher is learned: of all
pairs of single-byte pages that there are, the one that gains most against the
letter bigrams gives each text a start value, and expectation-maximisation over
the texts of a source then estimates what letter each symbol stands for, whatever
the page says: every symbol may stand for every letter of the page it was written
in, no two for the same. The table that is learned is applied with translate().
Where one letter became several symbols, as UTF-8 read in a single-byte page does,
the bytes themselves say where a letter begins; such swaps are read as they are.

Which swaps a source has is learned too, and so are the bigrams: counted over all
texts, each weighted by how likely it is clean, or as it was restored. A text's
units are its runs of characters beyond ASCII with their neighbours; the gain in
bigram likelihood, summed over the units that gain, weighs the ciphers of a text
against its being clean.

What is gathered on the driver are counts of letter pairs, whose number follows
the alphabets. Tables and shares of sources stay tables and are joined.
"""

from __future__ import annotations

import codecs
import functools
import json
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from encodings.aliases import aliases

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import materialise

# The pages that come first where several read alike, pages of several bytes a letter that text is written in, and that UTF-8 is read in by mistake.
COMMON = ("cp1252", "latin_1", "cp1251", "koi8_r", "cp437", "cp850", "cp866", "mac_roman", "cp1250", "iso8859_2")
RIGHT_MULTI = ("shift_jis", "euc_jp", "gbk", "big5", "euc_kr")
WRONG_MULTI = ("gbk", "shift_jis", "big5")

#: Rounds in which the tables of swaps are learned.
ROUNDS = 4
#: Log odds that a text gains under a cipher before it counts as garbled, on top of the cipher's share.
THRESHOLD = 3.0
#: Share of all texts that a cipher has before anything is learned; a pair of pages is one of many.
FIRST_SHARE, FIRST_SHARE_OF_PAIR = 1e-3, 1e-4
#: Weight of a symbol's letter in the start value, against all other letters of its page together.
START_TRUST = 0.5
#: Letters seen that the start value weighs as much as.
START_COUNT = 4.0
#: Texts that one task takes.
PER_TASK = 4_000
PAIRS_AT_ONCE = 2_000
CACHED_UNITS = 20_000
_FLOOR = 0.02
_LOST = -30.0
#: What a text that some UTF-8 cipher explains counts as clean at first.
_DOUBTFUL = 0.05
_UNIT = re.compile(r"[^\x00-\x7f]+")
#: Characters that only a wrong decoding leaves.
_CERTAIN = re.compile("[\x80-\x9f�]")
_BAD = "\x00"


@functools.cache
def pages() -> dict[str, str]:
    """Every single-byte page over ASCII that Python knows, with its upper half;
    controls that a page leaves undefined stand for themselves."""
    out: dict[str, str] = {}
    for name in (*COMMON, *sorted(set(aliases.values()) - set(COMMON))):
        try:
            if bytes(range(128)).decode(name) != bytes(range(128)).decode("ascii"):
                continue
            each = [bytes([b]).decode(name, "ignore") for b in range(128, 256)]
            if bytes(range(128, 256)).decode(name, "replace").replace("�", "") != "".join(each) or not any(each) or any(len(c) > 1 for c in each):
                continue
        except (UnicodeError, LookupError, TypeError, AssertionError):
            continue
        upper = "".join(c or (chr(b) if b < 160 else "�") for b, c in zip(range(128, 256), each))
        if upper not in out.values():
            out[name] = upper
    return out


def ciphers() -> list[tuple[tuple[str, str], ...]]:
    """Swaps of several symbols a letter, as steps (written in, read in), the last step of a double swap first."""
    one = [("utf-8", w) for w in (*pages(), *WRONG_MULTI)]
    multi = [(r, w) for r in RIGHT_MULTI for w in ("cp1252", "latin_1")]
    double = [(("utf-8", a), ("utf-8", b)) for a in ("cp1252", "latin_1") for b in ("cp1252", "latin_1")]
    return [(s,) for s in (*one, *multi)] + double


@functools.cache
def _led() -> tuple[dict[str, frozenset], dict[str, frozenset]]:
    """The pages, by place in ciphers(), in which a character is the first byte of a letter in UTF-8, or a later one."""
    first, later = defaultdict(set), defaultdict(set)
    for k, w in enumerate(pages()):
        for b, c in enumerate(pages()[w], 128):
            (later if b < 192 else first)[c].add(k)
    return {c: frozenset(s) for c, s in first.items()}, {c: frozenset(s) for c, s in later.items()}


@functools.cache
def _back(page: str) -> dict[int, int]:
    return {ord(c): b for b, c in enumerate(pages()[page], 128) if c != "�"}


def _bytes(s: str, page: str) -> bytes | None:
    """s in a code page; None if a third of it has no place there."""
    if page in WRONG_MULTI:
        try:
            return s.encode(page)
        except UnicodeEncodeError:
            return None
    back, lost, out = _back(page), 0, bytearray()
    for c in s:
        o = ord(c)
        b = o if o < 128 else back.get(o)
        if b is None:
            b, lost = 255, lost + 1
        out.append(b)
    return bytes(out) if lost * 3 <= len(s) else None


def read_as(s: str, cipher: tuple[tuple[str, str], ...]) -> str | None:
    """What s stands for under a cipher; None if nothing or mostly nonsense."""
    for right, wrong in cipher:
        b = _bytes(s, wrong)
        if b is None:
            return None
        t = b.decode(right, "replace")
        bad = t.count("�")
        if bad * (2 if right == "utf-8" and wrong not in WRONG_MULTI else 4) > len(t) or t == s:
            return None
        s = t
    return s


@functools.cache
def _kind(c: str) -> str:
    """Ideographs and syllables share one place each in the bigram table."""
    o = ord(c)
    if 0x3400 <= o <= 0x9FFF or o >= 0x20000:
        return "一"
    if 0xAC00 <= o <= 0xD7A3:
        return "가"
    return "0" if c.isdigit() else c


@dataclass
class Letters:
    """Counts of letter pairs and, for ideographs, of letters."""

    pairs: dict[tuple[str, str], float] = field(default_factory=dict)
    ideographs: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.n = math.log(sum(self.pairs.values()) + 1)
        self.n_i = math.log(sum(self.ideographs.values()) + 1)
        self.floor, self.floor_i = math.log(_FLOOR) - self.n, math.log(_FLOOR) - self.n_i
        self.log = {p: math.log(x + _FLOOR) - self.n for p, x in self.pairs.items()}
        self.log_i = {c: math.log(x + _FLOOR) - self.n_i for c, x in self.ideographs.items()}

    def score(self, s: str) -> float:
        kinds = [_kind(c) for c in s]
        get, floor = self.log.get, self.floor
        total = sum([get(p, floor) for p in zip(kinds, kinds[1:])])
        if "一" in kinds or "가" in kinds:
            total += sum(self.log_i.get(c, self.floor_i) for c, k in zip(s[1:], kinds[1:]) if k in "一가")
        return total


def units(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end and neighbours of each run beyond ASCII."""
    return [(m.start(), m.end(), text[m.start() - 1] if m.start() else "^", text[m.end()] if m.end() < len(text) else "$") for m in _UNIT.finditer(text)]


class Swaps:
    """Gains of texts under all pairs of single-byte pages, by letter pairs."""

    def __init__(self, letters: Letters):
        mass = Counter()
        for (a, b), x in letters.pairs.items():
            mass[a] += x
            mass[b] += x
        seen = {n: u for n, u in pages().items() if any(mass[_kind(c)] > 0.5 for c in u if c.isalpha())}
        chars = sorted({c for u in seen.values() for c in u if c != "�"} | {chr(i) for i in range(128)} | {"^", "$"})
        self.chars, self.at = chars, {c: i for i, c in enumerate(chars)}
        self.other = len(chars)
        place = {_kind(c): i for c, i in reversed(self.at.items())} | self.at
        lm = np.full((len(chars) + 1,) * 2, letters.floor, np.float32)
        for (a, b), x in letters.log.items():
            if a in place and b in place:
                lm[place[a], place[b]] = x
        for c, i in self.at.items():
            if c.isdigit() and c != "0":
                lm[i], lm[:, i] = lm[self.at["0"]], lm[:, self.at["0"]]
        bad = self.at[_BAD]
        lm[bad], lm[:, bad] = _LOST, _LOST
        self.lm = lm
        rows, self.labels = [], []
        same = np.arange(len(chars) + 1)
        for w, read in seen.items():
            for r, written in seen.items():
                if r != w:
                    m = same.copy()
                    m[128:] = bad
                    m[[self.at[c] for c in map(chr, range(1, 128))]] = [self.at[c] for c in map(chr, range(1, 128))]
                    m[self.at["^"]], m[self.at["$"]] = self.at["^"], self.at["$"]
                    for x, y in zip(read, written):
                        if x != "�":
                            m[self.at[x]] = self.at[y] if y != "�" else bad
                    rows.append(m)
                    self.labels.append((r, w))
        self.seen: dict[tuple[str, str, str], tuple[np.ndarray, np.ndarray]] = {}
        self.maps = np.array(rows, np.int16) if rows else np.zeros((0, len(chars) + 1), np.int16)

    def best(self, texts: list[list[tuple[str, str, str]]]) -> list[tuple[int, float]]:
        """Of each text, given as its units (before, run, after), the pair of pages with the largest gain."""
        if not len(self.maps):
            return [(-1, 0.0)] * len(texts)
        if len(self.seen) > CACHED_UNITS:
            self.seen.clear()
        part, n = [], 0
        for u in {u for t in texts for u in t if u not in self.seen}:
            part.append(u)
            n += len(u[1]) + 1
            if n >= PAIRS_AT_ONCE:
                self._gains(part)
                part, n = [], 0
        if part:
            self._gains(part)
        out = []
        for t in texts:
            known = [self.seen[u] for u in t]
            if len(known) == 1:
                at, gain = known[0]
            else:
                at = np.arange(len(self.maps))
                gain = np.bincount(np.concatenate([k for k, _ in known]), np.concatenate([g for _, g in known]), len(self.maps))
            k = int(gain.argmax()) if len(gain) else -1
            out.append((int(at[k]), float(gain[k])) if k >= 0 and gain[k] > 0 else (-1, 0.0))
        return out

    def _gains(self, some: list[tuple[str, str, str]]) -> None:
        """Remembers of each unit the pairs of pages that it gains under, and how much."""
        get, other = self.at.get, self.other
        first, second, starts = [], [], []
        for before, run, after in some:
            starts.append(len(first))
            ids = [get(c, other) for c in before + run + after]
            first += ids[:-1]
            second += ids[1:]
        size = len(self.chars) + 1
        pairs, where = np.unique(np.array(first) * size + np.array(second), return_inverse=True)
        x, y = pairs // size, pairs % size
        gain = self.lm[self.maps[:, x], self.maps[:, y]] - self.lm[x, y][None, :]
        by_unit = np.add.reduceat(gain[:, where], starts, axis=1)
        for j, u in enumerate(some):
            at = np.flatnonzero(by_unit[:, j] > 0)
            self.seen[u] = (at, by_unit[at, j])


class Reader:
    """Gains of units under all ciphers, kept per worker."""

    def __init__(self, letters: Letters, known: list):
        self.letters, self.known, self.seen, self.tables = letters, known, {}, {}
        self.n_pages = len(pages())

    def gains(self, before: str, run: str, after: str) -> dict[str, tuple[float, str]]:
        key = (before, run, after)
        if key not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            # A symbol may end on an ASCII byte only in the multi-byte pages, whose traces are certain anyway.
            own = self.letters.score(before + run + after)
            out = {}
            first, later = _led()
            led = {k for x, y in zip(run, run[1:]) if x in first and y in later for k in first[x] & later[y]}
            for k in (*sorted(led), *range(self.n_pages, len(self.known))):
                t = read_as(run, self.known[k])
                if t is not None:
                    g = self.letters.score(before + t + after) - own
                    if g > 0:
                        out[str(k)] = (g, t)
            self.seen[key] = out
        return self.seen[key]

    def learned(self, label: str, table: dict[int, str], before: str, run: str, after: str) -> tuple[float, str] | None:
        """The gain of a unit by a learned table, which must have all of its symbols."""
        t = run.translate(table)
        if t == run or not all(ord(c) in table for c in run):
            return None
        g = self.letters.score(before + t + after) - self.letters.score(before + run + after)
        return (g, t) if g > 0 else None

    def judge(self, text: str, model: dict) -> tuple[str, float, list]:
        """Best cipher ('': none), its log odds against clean, and the units it changes."""
        found = units(text)
        gains = []
        for s, e, b, a in found:
            g = dict(self.gains(b, text[s:e], a))
            for label, table in model["tables"].items():
                x = self.learned(label, table, b, text[s:e], a)
                if x:
                    g[label] = x
            gains.append(g)
        total: dict[str, float] = defaultdict(float)
        for g in gains:
            for k, (x, _) in g.items():
                total[k] += x
        for k in total:
            total[k] += math.log((model["shares"].get(k, 0.0) + FIRST_SHARE * 100) / (model["n"] + 100))
        best = max(total, key=lambda k: (round(total[k], 6), -int(k) if k.isdigit() else -len(self.known)), default="")
        if not best:
            return "", -math.inf, []
        return best, total[best], [(s, e, g[best][1]) for (s, e, _, _), g in zip(found, gains) if best in g]


_NOTHING = {"n": 0, "shares": {}, "tables": {}}


def _source_model(said: str | None, cache: dict) -> dict:
    """A source's number of texts, shares of ciphers and tables, from its column."""
    if not said:
        return _NOTHING
    if said not in cache:
        if len(cache) > 1000:
            cache.clear()
        m = json.loads(said)
        cache[said] = {"n": m["n"], "shares": m["shares"], "tables": {k: {ord(x): y for x, y in zip(*t)} for k, t in m["tables"].items()}}
    return cache[said]


def _apply(text: str, changes: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, t in changes:
        out += [text[at:s], t]
        at = e
    return "".join([*out, text[at:]])


class _Counts:
    """Letter pairs and ideographs of texts with weights."""

    def __init__(self) -> None:
        self.pairs, self.letters = Counter(), Counter()

    def add(self, text: str, weight: float) -> None:
        if weight <= 0.01 or _CERTAIN.search(text):
            return
        for s, e, before, after in units(text):
            run = before + text[s:e] + after
            kinds = [_kind(c) for c in run]
            for p in zip(kinds, kinds[1:]):
                self.pairs[p] += weight
            if "一" in kinds or "가" in kinds:
                for c, k in zip(run, kinds):
                    if k in "一가":
                        self.letters[c] += weight


_JUDGED = "what string, source string, text string, label string, n double"
_JUDGED_ARROW = pa.schema([("what", pa.string()), ("source", pa.string()), ("text", pa.string()), ("label", pa.string()), ("n", pa.float64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _JUDGED_ARROW)], schema=_JUDGED_ARROW)


def _counted(c: _Counts) -> list[tuple]:
    return [("pair", a, b, None, n) for (a, b), n in c.pairs.items()] + [("letter", a, None, None, n) for a, n in c.letters.items()]


def _first_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter pairs before anything is learned: what some UTF-8 cipher explains hardly counts."""
    counts, known = _Counts(), [(("utf-8", w),) for w in ("cp1252", "cp1251", "cp437", "koi8_r", "mac_roman", "gbk")]
    for b in batches:
        for text, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            doubtful = any(read_as(text[s:e], k) for s, e, _, _ in units(text) if e - s > 1 for k in known)
            counts.add(text, n * (_DOUBTFUL if doubtful else 1.0))
    if counts.pairs:
        yield _batch(_counted(counts))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _first_judgement(batches: Iterator[pa.RecordBatch], letters: Letters, known: list) -> Iterator[pa.RecordBatch]:
    """Each text's likeliest cipher, of those of several symbols a letter and of all
    pairs of single-byte pages; and the letter pairs of the texts as they then were."""
    counts, reader, swaps = _Counts(), Reader(letters, known), Swaps(letters)
    for b in batches:
        sources, texts, ns = (b.column(i).to_pylist() for i in range(3))
        single = swaps.best([[(x, t[s:e], y) for s, e, x, y in units(t)] for t in texts])
        rows = []
        for source, text, n, (k, gain) in zip(sources, texts, ns, single):
            label, odds, changes = reader.judge(text, _NOTHING)
            by_pair = gain + math.log(FIRST_SHARE_OF_PAIR)
            if k >= 0 and by_pair > odds:
                r, w = swaps.labels[k]
                label, odds = f"{r}>{w}", by_pair
                table = start_table(label)
                changes = [(s, e, text[s:e].translate(table)) for s, e, x, y in units(text) if reader.learned(label, table, x, text[s:e], y)]
            p = _sigmoid(odds) if label else 0.0
            rows.append(("share", source, None, "", float(n)))
            if p > 0.01:
                rows.append(("share", source, None, label, p * n))
                if p > 0.5 and ">" in label:
                    rows.append(("text", source, text, label, p * n))
            counts.add(text, n * (0.0 if _CERTAIN.search(text) else 1 - p))
            if changes:
                counts.add(_apply(text, changes), n * p)
        if rows:
            yield _batch(rows)
    if counts.pairs:
        yield _batch(_counted(counts))


@functools.cache
def start_table(label: str) -> dict[int, str]:
    """What symbols stand for if a pair of pages, written>read, is all there is to a swap."""
    written, read = (pages()[x] for x in label.split(">"))
    return {ord(x): y for x, y in zip(read, written) if x != "�" and y != "�"}


@dataclass
class Learned:
    """Of one swap of one source: what each symbol stands for, and how likely each letter is."""

    table: dict[int, str]
    chances: dict[str, dict[str, float]]


def start_value(label: str) -> Learned:
    table = start_table(label)
    return Learned(table, {chr(x): {y: START_TRUST} for x, y in table.items()})


def expected_letters(texts: list[tuple[str, float]], now: Learned, label: str, letters: Letters) -> Counter:
    """Expected count of each (symbol, letter): every letter of the page written in is
    held against the neighbours as they are now read."""
    alphabet = [c for c in pages()[label.split(">")[0]] if c != "�"]
    kinds, place = [_kind(c) for c in alphabet], {c: i for i, c in enumerate(alphabet)}
    get, floor, out, seen, priors = letters.log.get, letters.floor, Counter(), {}, {}
    for symbol, chances in now.chances.items():
        p = np.full(len(alphabet), (1 - START_TRUST) / len(alphabet))
        for c, x in chances.items():
            if c in place:
                p[place[c]] += x
        priors[symbol] = np.log(p)
    for text, n in texts:
        for s, e, before, after in units(text):
            read = before + text[s:e].translate(now.table) + after
            for i, symbol in enumerate(text[s:e], 1):
                if symbol not in priors:
                    continue
                key = (symbol, _kind(read[i - 1]), _kind(read[i + 1]))
                if key not in seen:
                    logs = np.array([get((key[1], k), floor) + get((k, key[2]), floor) for k in kinds]) + priors[symbol]
                    p = np.exp(logs - logs.max())
                    p /= p.sum()
                    seen[key] = [(alphabet[j], float(p[j])) for j in np.flatnonzero(p > 1e-3)]
                for letter, p in seen[key]:
                    out[(symbol, letter)] += n * p
    return out


def one_to_one(counts: pd.DataFrame, start: dict[int, str]) -> Learned:
    """Symbols to letters, the most counted first, no letter twice; a symbol that gets
    none keeps its start value. The start value counts as START_COUNT letters seen."""
    n = Counter({(chr(x), y): START_COUNT * START_TRUST for x, y in start.items()})
    for symbol, letter, x in counts.itertuples(index=False):
        n[(symbol, letter)] += x
    table, taken, chances, total = {}, set(), defaultdict(dict), Counter()
    for (symbol, letter), x in sorted(n.items(), key=lambda r: (-r[1], r[0])):
        if ord(symbol) not in table and letter not in taken:
            table[ord(symbol)] = letter
            taken.add(letter)
        chances[symbol][letter] = x
        total[symbol] += x
    return Learned(start | table, {s: {c: x / (total[s] + START_COUNT * (1 - START_TRUST)) for c, x in cs.items()} for s, cs in chances.items()})


def _collected(counts: DataFrame) -> Letters:
    rows = counts.where("what in ('pair', 'letter')").groupBy("what", F.col("source").alias("a"), F.col("text").alias("b")).agg(F.sum("n").alias("n")).collect()
    return Letters({(r["a"], r["b"]): r["n"] for r in rows if r["what"] == "pair"}, {r["a"]: r["n"] for r in rows if r["what"] == "letter"})


@dataclass
class Model:
    letters: Letters
    #: (source, model): the number of texts, shares of ciphers and learned tables of each source.
    sources: DataFrame


def learn(texts: DataFrame, rounds: int = ROUNDS) -> Model:
    """(source, text, n) to a model; n counts how often a text occurs in its source."""
    spark, known = texts.sparkSession, ciphers()
    letters = _collected(texts.mapInArrow(_first_counts, _JUDGED))
    sent = spark.sparkContext.broadcast(letters)
    judged = materialise(texts.mapInArrow(lambda it: _first_judgement(it, sent.value, known), _JUDGED), "judged-texts")
    letters = _collected(judged)
    sent = spark.sparkContext.broadcast(letters)
    by_table = judged.where("what = 'text'").select("source", "label", "text", "n")
    tables, kind = None, "map<string,map<string,double>>"
    # Without texts of such a swap there is nothing to learn.
    for _ in range(1 if by_table.isEmpty() else max(1, rounds)):
        none = [F.lit(None).cast("map<string,string>").alias("table"), F.lit(None).cast(kind).alias("chances")]
        here = by_table.select("*", *none) if tables is None else by_table.join(tables, ["source", "label"])

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                groups: dict[tuple, list] = defaultdict(list)
                values: dict[tuple, Learned] = {}
                table, chances = b.column(4), b.column(5)
                for i, (source, label, text, n) in enumerate(zip(*(b.column(i).to_pylist() for i in range(4)))):
                    key = (source, label)
                    groups[key].append((text, n))
                    if key not in values:
                        t = table[i].as_py()
                        values[key] = Learned({ord(x): y for x, y in t}, {x: dict(cs) for x, cs in chances[i].as_py()}) if t else start_value(label)
                rows = []
                for key, held in groups.items():
                    rows += [(*key, x, y, n) for (x, y), n in expected_letters(held, values[key], key[1], sent.value).items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["source", "label", "symbol", "letter", "n"])

        counts = here.select("source", "label", "text", "n", "table", "chances").mapInArrow(expect, "source string, label string, symbol string, letter string, n double")
        counts = counts.groupBy("source", "label", "symbol", "letter").agg(F.sum("n").alias("n"))

        def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            # A group has one row at most for each symbol and letter of a page.
            got = one_to_one(rows[["symbol", "letter", "n"]], start_table(key[1]))
            return pd.DataFrame([(*key, {chr(x): y for x, y in got.table.items()}, got.chances)], columns=["source", "label", "table", "chances"])

        tables = materialise(counts.groupBy("source", "label").applyInPandas(settle, f"source string, label string, table map<string,string>, chances {kind}"), "swap-tables")
    shares = judged.where("what = 'share'").groupBy("source", "label").agg(F.sum("n").alias("n"))
    n = F.max(F.when(F.col("label") == "", F.col("n"))).alias("n")
    shares = shares.groupBy("source").agg(n, F.map_from_entries(F.collect_list(F.when(F.col("label") != "", F.struct("label", "n")))).alias("shares"))
    symbols = F.struct(F.array_join(F.map_keys("table"), "").alias("a"), F.array_join(F.map_values("table"), "").alias("b"))
    by_source = tables.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("label", F.array(symbols["a"], symbols["b"])))).alias("tables"))
    whole = shares.join(by_source, "source", "left").withColumn("tables", F.coalesce("tables", F.create_map().cast("map<string,array<string>>")))
    return Model(letters, materialise(whole.select("source", F.to_json(F.struct("n", "shares", "tables")).alias("model")), "source-models"))


_FOUND = "id long, pos int, text string, restored string, written_in string, read_in string, log_odds double"
_FOUND_ARROW = pa.schema([("id", pa.int64()), ("pos", pa.int32()), ("text", pa.string()), ("restored", pa.string()), ("written_in", pa.string()), ("read_in", pa.string()), ("log_odds", pa.float64())])


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """df over as many tasks as its rows ask for; sizes in bytes say nothing here."""
    df = materialise(df, "texts")
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PER_TASK))
    return df.repartition(tasks, *by)


def garbled_texts(df: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(source, id, pos, text) -> (id, pos, text, restored, written_in, read_in,
    log_odds) of each text that holds characters from a wrong decoding.

    restored is null where nothing can be restored; characters that were lost
    stay U+FFFD in it. Null, empty and plain ASCII texts have no row; null source
    is a source of its own; repeated rows each get a row. Texts are read whole.
    """
    beyond = df.where(F.col("text").rlike(r"[^\x00-\x7F]")).select(F.coalesce("source", F.lit("")).alias("source"), F.col("id").cast("long").alias("id"), F.col("pos").cast("int").alias("pos"), "text")
    texts = _spread(beyond.groupBy("source", "text").agg(F.count("*").alias("n")), "text")
    model, known = learn(texts, rounds), ciphers()
    sent = df.sparkSession.sparkContext.broadcast(model.letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, cache = Reader(sent.value, known), {}
        for b in batches:
            out = []
            for text, said in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                best, odds, changes = reader.judge(text, _source_model(said, cache))
                if not (best and odds > threshold) and not _CERTAIN.search(text):
                    out.append((False, None, None, None, None))
                    continue
                restored, swap = None, (None, None)
                if best and odds > threshold:
                    restored = _apply(text, changes)
                    swap = tuple(best.split(">")) if ">" in best else ("+".join(r for r, _ in known[int(best)]), "+".join(w for _, w in known[int(best)]))
                out.append((True, restored, *swap, odds if best else None))
            cols = list(zip(*out)) or [[]] * 5
            new = [pa.array(c, t) for c, t in zip(cols, (pa.bool_(), pa.string(), pa.string(), pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *new], names=["source", "text", "found", "restored", "written_in", "read_in", "log_odds"])

    judged = texts.join(model.sources, "source", "left").select("source", "text", "model")
    judged = judged.mapInArrow(run, "source string, text string, found boolean, restored string, written_in string, read_in string, log_odds double").where("found").drop("found")
    return beyond.join(judged, ["source", "text"]).select("id", "pos", "text", "restored", "written_in", "read_in", "log_odds")
