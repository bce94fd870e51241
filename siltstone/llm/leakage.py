"""Held-out items that stand, whole or in part, in a corpus.

A prefix-filtered set join. Items are brought to word numbers, equal items become
one, and sentences at an item's ends that other items have too are cut off. A
passage must keep half of the words that an item owns, those that hardly any
other item of its make has, so of every stretch of 16 to 31 item words the rarest
half of its own words and one more are a prefix that any passage shares with its
document. Prefixes are joined with the corpus by equality; rarity is counted over
all documents. One-word shingles are the tokens, as two altered words may leave
no longer shingle whole around a kept word. Candidates are then held against
bounds on number and place of shared three-word shingles and own words, and
aligned word by word.

The corpus is read once. Three bitmaps of fixed largest size, made from the items
in the JVM, say which of its words and shingles may be those of an item; only
stretches around shared shingles go on, as numbers. A bitmap may let too much
through, never too little, and what it lets through is joined by the numbers
themselves. Items are tables all the way; nothing of them but the bitmaps is
gathered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.runtime import materialise

WINDOW = 16
#: One word in so many may be altered.
PER_ALTERED = 8
SHINGLE = 3
#: A word of more other items than this belongs to a make in which more than one item, and one in so many, has it.
MAKE, MAKE_SHARE = 3, 50
#: Shingles of an item, the most common ones, that each stand for a make.
MAKES = 8
#: Words put in between that count as a remark and not as altered words.
REMARK = (4, 40)
#: A window of 16 words, 3 of them altered and a remark put in: whole shingles left of 14.
LEAST_SHARED = WINDOW - SHINGLE + 1 - 3 * SHINGLE - (SHINGLE - 1)
CHUNK_CHARS = 1_000_000
#: Least and most bits of a bitmap, and bits for each number in it between them.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 16, 1 << 30, 64
CACHED_WORDS = 1_000_000
ROWS_AT_ONCE = 512
#: Candidates that one task aligns.
PER_TASK = 5_000

_TAG = r"""</?[a-z][a-z0-9]*+(?:\s++[a-z_:][a-z0-9_:.-]*+(?:\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'<>=]++))?+)*+\s*+/?+>|<!--.*?-->"""
_MARKUP = re.compile(_TAG + r"|&[a-z]{2,8};|&#\d+;|[\u00ad\u200b\ufeff]", re.S)
_WORD = re.compile(r"\x00|[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.?!:])\s+|\s+(?=[A-Z]\w+:\s)")


def words_of(text: str) -> list[str]:
    return _WORD.findall(_MARKUP.sub(" ", text.lower().replace("\x00", " ")))


def number(word: str) -> int:
    """A word's 64-bit number; never 0, which stands for words of no item."""
    return (xxhash.xxh3_64_intdigest(word) - (1 << 63)) or 1


def sentences(text: str) -> list[tuple[int, list[int]]]:
    """Form, whatever its numbers, and words of each sentence of an item; "Options:" and
    what follows it are one."""
    cut = [s for s in _SENTENCE.split(text) if s.strip()]
    for i in range(len(cut) - 2, -1, -1):
        if cut[i].endswith(":"):
            cut[i : i + 2] = [cut[i] + " " + cut[i + 1]]
    out = []
    for s in cut:
        w = words_of(s)
        out.append((number(" ".join("#" if x.isdigit() else x for x in w)), [number(x) for x in w]))
    return out


def content(sents: list[list[int]], forms: list[int], shared: set[int]) -> list[int]:
    """The words of an item without the sentences at its ends that other items have
    too: lead-ins, answer options and requests. Shared ends that hold more than half
    of the item make it another version of those items, and nothing is cut."""
    lo, hi = 0, len(sents)
    while lo < hi - 1 and forms[lo] in shared:
        lo += 1
    while hi > lo + 1 and forms[hi - 1] in shared:
        hi -= 1
    whole = [w for s in sents for w in s]
    kept = [w for s in sents[lo:hi] for w in s]
    return kept if 2 * len(kept) >= len(whole) else whole


def _mixed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    # Odd factors, so that each word's number decides all bits of its product.
    a, b, c = a * np.uint64(0x9E3779B97F4A7C15), b * np.uint64(0xC2B2AE3D27D4EB4F), c * np.uint64(0x165667B19E3779F9)
    x = (a ^ (b >> np.uint64(31))) + (b ^ (c >> np.uint64(29))) + c
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def shingles(w: np.ndarray) -> np.ndarray:
    """One number for each three consecutive words."""
    u = w.view(np.uint64)
    if len(u) < SHINGLE:
        return np.zeros(0, np.int64)
    return _mixed(u[:-2], u[1:-1], u[2:])


def prefix(words: np.ndarray, own: np.ndarray, rarity: np.ndarray) -> set[int]:
    """Own words of which any passage keeps one: of each stretch of 16 to 31 words the
    rarest half and one more. A passage can be cut into such stretches, and keeps
    half of the own words of one that has any."""
    at = np.flatnonzero(own)
    order = np.lexsort((words[at], rarity[at]))
    rank = np.empty(len(at), np.int64)
    rank[order] = np.arange(len(at))
    found: set[int] = set()
    seen = set()
    for size in range(WINDOW, 2 * WINDOW):
        for lo in range(max(0, len(words) - size) + 1 if len(words) >= size else 0):
            a, b = np.searchsorted(at, (lo, lo + size))
            if b > a and (a, b) not in seen:
                seen.add((a, b))
                found.update(words[at[a:b][np.argsort(rank[a:b])[: (b - a) // 2 + 1]]].tolist())
    return found


_PARSED = "item long, whole long, forms array<long>, sents array<array<long>>"
_CONTENT = "whole long, words array<long>"
_LONGS = pa.list_(pa.int64())


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sentences(t) for t in b.column(1).to_pylist()]
        whole = [xxhash.xxh3_64_intdigest(np.array([w for _, ws in s for w in ws], np.int64).tobytes()) - (1 << 63) for s in found]
        cols = [b.column(0).cast(pa.int64()), pa.array(whole, pa.int64()), pa.array([[f for f, _ in s] for s in found], _LONGS), pa.array([[w for _, w in s] for s in found], pa.list_(_LONGS))]
        yield pa.RecordBatch.from_arrays(cols, names=["item", "whole", "forms", "sents"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        forms, sents, shared = (b.column(i).to_pylist() for i in (1, 2, 3))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([content(s, f, set(x or ())) for f, s, x in zip(forms, sents, shared)], _LONGS)], names=["whole", "words"])


def _rows(col: pa.Array) -> list[np.ndarray]:
    """Each list of a column as an array."""
    off, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
    return [flat[x:y] if v else flat[:0] for x, y, v in zip(off, off[1:], col.is_valid().to_numpy(zero_copy_only=False))]


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own = [~np.isin(w, c) for w, c in zip(_rows(b.column(1)), _rows(b.column(3)))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([o.tolist() for o in own], pa.list_(pa.bool_())), b.column(2)], names=["whole", "words", "own", "keys"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([shingles(w) for w in _rows(b.column(1))], _LONGS)], names=["whole", "words", "keys"])


def item_contents(items: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(whole, words, own, keys) of each different item with words enough for a
    passage, and (whole, item) of all items. Counts run over the different items.

    A word belongs to a make, and is no item's own, if several items of the make have
    it; items that share nothing with an item have no say in its words."""
    parsed = materialise(items.where(F.col(text).isNotNull()).select(F.col(key).cast("long"), text).mapInArrow(_parse, _PARSED), "items")
    once = parsed.groupBy("whole").agg(F.min_by(F.struct("forms", "sents"), "item").alias("x")).select("whole", "x.forms", "x.sents")
    forms = once.select("whole", F.explode(F.array_distinct("forms")).alias("form"))
    several = forms.groupBy("form").agg(F.count("*").alias("n")).where("n > 1").select("form")
    shared = forms.join(several, "form").groupBy("whole").agg(F.collect_list("form").alias("shared"))
    cut = once.join(shared, "whole", "left").select("whole", "forms", "sents", "shared").mapInArrow(_cut, _CONTENT)
    cut = materialise(cut.where(F.size("words") >= WINDOW).mapInArrow(_shingled, "whole long, words array<long>, keys array<long>"), "item-contents")
    # An item belongs to the makes of the shingles that most items have of those in it.
    keys = cut.select("whole", F.explode(F.array_distinct("keys")).alias("k"))
    counted = keys.join(keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "k")
    first = counted.withColumn("i", F.row_number().over(Window.partitionBy("whole").orderBy(F.desc("n"), "k"))).where(F.col("i") <= MAKES)
    makes = first.select("whole", "k", "n")
    each = cut.select("whole", F.explode(F.array_distinct("words")).alias("w")).join(makes, "whole")
    in_make = each.groupBy("k", "w").agg(F.count("*").alias("c"), F.max("n").alias("n")).where((F.col("c") > 1) & (F.col("c") * MAKE_SHARE > F.col("n")))
    everywhere = each.groupBy("w").agg(F.countDistinct("whole").alias("all")).where(F.col("all") > MAKE + 1)
    made = in_make.join(everywhere, "w").select("k", "w")
    common = each.join(made, ["k", "w"]).groupBy("whole").agg(F.collect_set("w").alias("common"))
    own = cut.join(common, "whole", "left").select("whole", "words", "keys", F.coalesce("common", F.array().cast("array<long>")).alias("common"))
    out = materialise(own.mapInArrow(_own, "whole long, words array<long>, own array<boolean>, keys array<long>"), "item-words")
    return out, parsed.select("whole", "item").distinct()


def bitmap(numbers: DataFrame, n: int) -> np.ndarray:
    """Bits of the values in a column of n numbers, gathered as pieces of 4 kB each."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (n * BITS_EACH - 1).bit_length()))
    (name,) = numbers.columns
    at = numbers.select((F.pmod(F.col(name), F.lit(size)) + 1).alias("at"))
    out = np.zeros(size // 8, np.uint8)
    for k, bits in at.groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect():
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _in(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = numbers & (len(bits) * 8 - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


@dataclass
class Filters:
    """Bitmaps of the items' words, own words and shingles; at most MOST_BITS each."""

    words: np.ndarray
    own: np.ndarray
    shingles: np.ndarray


class _Numbers(dict):
    """Words to numbers, 0 for what is no item's word; looked up once per worker."""

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits, self.mask = bits, len(bits) * 8 - 1

    def __missing__(self, word: str) -> int:
        n = number(word)
        at = n & self.mask
        self[word] = n = n if (self.bits[at >> 3] >> (at & 7)) & 1 else 0
        return n


_HITS = "doc long, words array<long>, tokens array<long>, token long, n long"
_HITS_ARROW = pa.schema([("doc", pa.int64()), ("words", _LONGS), ("tokens", _LONGS), ("token", pa.int64()), ("n", pa.int64())])
_REACH = 48


def _stretches(at: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Ranges of words around the places of shared shingles, with the number of places in each."""
    cuts = np.flatnonzero(np.diff(at) > 2 * _REACH) + 1
    return [(max(0, int(a[0]) - _REACH), min(n, int(a[-1]) + SHINGLE + _REACH), len(a)) for a in np.split(at, cuts)]


def shared_stretches(batches: Iterator[pa.RecordBatch], filters: Filters) -> Iterator[pa.RecordBatch]:
    """(doc, words, tokens) of each stretch of a text that may hold a passage, words of
    no item as 0, tokens its possible own words; and (token, n) of possible own
    words, the number of texts that have them."""
    numbers, docs_with = _Numbers(filters.words), Counter()
    for b in batches:
        keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size < CHUNK_CHARS):
                size += len(texts[hi] or "")
                hi += 1
            text = "\x00".join((t or "").replace("\x00", " ") for t in texts[lo:hi]).lower()
            found = _WORD.findall(_MARKUP.sub(" ", text))
            ids = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
            ends = np.array([i for i, w in enumerate(found) if w == "\x00"] + [len(found)]) if hi - lo > 1 else np.array([len(found)])
            starts = np.concatenate([[0], ends[:-1] + 1])
            # A bitmap bit may be set for the mark between texts too.
            ids[ends[:-1]] = 0
            if len(numbers) > CACHED_WORDS:
                numbers.clear()
            mine = np.flatnonzero(ids)
            mine = mine[_in(filters.own, ids[mine])]
            owned = np.zeros(len(ids), bool)
            owned[mine] = True
            pairs = np.unique(np.stack([np.searchsorted(ends, mine, side="right"), ids[mine]]), axis=1)
            docs_with.update(Counter(pairs[1].tolist()))
            whole = np.flatnonzero((ids[:-2] != 0) & (ids[1:-1] != 0) & (ids[2:] != 0)) if len(ids) > 2 else np.zeros(0, np.int64)
            if len(whole):
                u = np.stack([ids[whole], ids[whole + 1], ids[whole + 2]], axis=1).view(np.uint64)
                whole = whole[_in(filters.shingles, _mixed(u[:, 0], u[:, 1], u[:, 2]))]
            doc = np.searchsorted(ends, whole, side="right")
            out = []
            for part in np.split(np.arange(len(whole)), np.flatnonzero(np.diff(doc)) + 1) if len(whole) else ():
                d = int(doc[part[0]])
                at, n = starts[d], int(ends[d] - starts[d])
                for x, y, n_hits in _stretches(whole[part] - at, n):
                    tokens = np.unique(ids[at + x : at + y][owned[at + x : at + y]])
                    if n_hits >= LEAST_SHARED and len(tokens):
                        out.append((keys[lo + d], ids[at + x : at + y], tokens))
            if out:
                doc_, words, tokens = zip(*out)
                none = pa.nulls(len(out), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(doc_, pa.int64()), pa.array(words, _LONGS), pa.array(tokens, _LONGS), none, none], schema=_HITS_ARROW)
            lo = hi
    if docs_with:
        none = pa.nulls(len(docs_with), _LONGS)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(docs_with), pa.int64()), none, none, pa.array(docs_with.keys(), pa.int64()), pa.array(docs_with.values(), pa.int64())], schema=_HITS_ARROW)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        who, tokens = [], []
        for k, w, own, known, n in zip(b.column(0).to_pylist(), _rows(b.column(1)), b.column(2).to_pylist(), *(_rows(b.column(i)) for i in (3, 4))):
            rarity = dict(zip(known.tolist(), n.tolist()))
            found = prefix(w, np.array(own, bool), np.array([rarity.get(x, 0) for x in w.tolist()]))
            who += [k] * len(found)
            tokens += found
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(tokens, pa.int64())], names=["whole", "token"])


def passage(doc: np.ndarray, item: np.ndarray, own: np.ndarray) -> tuple[int, int]:
    """The longest passage of consecutive item words in a stretch of a document
    with no more altered words than allowed: its words and the altered ones
    among them, (0, 0) if there is none. At least half of the item's own words in
    it must be unaltered, else it is of a problem of the same make.

    Equal words are chained in order; between two of them, as many words are
    altered as the longer of the two gaps has, but a remark put in between is
    none.
    """
    common = np.isin(doc, item)
    places = np.flatnonzero(common)
    if len(places) < WINDOW - WINDOW // PER_ALTERED:
        return 0, 0
    d, i = np.nonzero(doc[places][:, None] == item[None, :])
    d = places[d]
    n = len(d)
    score, back = np.ones(n), np.full(n, -1)
    for k in range(1, n):
        lo = int(np.searchsorted(d, d[k] - REMARK[1] - 4))
        hi = int(np.searchsorted(d, d[k]))
        if hi <= lo:
            continue
        gap_d, gap_i = d[k] - d[lo:hi] - 1, i[k] - i[lo:hi] - 1
        cost = _altered(gap_d, gap_i) + 0.25 * ((gap_d - gap_i) >= REMARK[0])
        via = np.where((gap_i >= 0) & (gap_i <= 4), score[lo:hi] - cost, -np.inf)
        j = int(via.argmax())
        # Where a chain begins with altered words it may score nothing and yet be longer.
        if via[j] > -WINDOW // PER_ALTERED - 1:
            score[k], back[k] = max(1.0, via[j] + 1), lo + j
    best = (0, 0)
    used = np.zeros(n, bool)
    first = np.arange(n)
    for k in range(1, n):
        if back[k] >= 0:
            first[k] = first[back[k]]
    # No passage is longer than its chain reaches in the item.
    reach = i - i[first] + 1
    for k in np.argsort(-score, kind="stable"):
        if score[k] < WINDOW / 2:
            break
        if used[k] or reach[k] < max(WINDOW, best[0]):
            continue
        chain = [int(k)]
        while back[chain[-1]] >= 0:
            chain.append(int(back[chain[-1]]))
        chain = np.array(chain[::-1])
        used[chain] = True
        best = max(best, _longest(d[chain], i[chain], own), key=lambda x: (x[0], -x[1]))
    return best


def _altered(gap_d: np.ndarray, gap_i: np.ndarray) -> np.ndarray:
    return np.where(gap_d - gap_i >= REMARK[0], gap_i, np.maximum(gap_d, gap_i))


def _longest(d: np.ndarray, i: np.ndarray, own: np.ndarray) -> tuple[int, int]:
    """Words and altered words of the longest passage in a chain."""
    altered = np.concatenate([[0], np.cumsum(_altered(np.diff(d) - 1, np.diff(i) - 1))])
    upto = np.concatenate([[0], np.cumsum(own)])
    kept = np.concatenate([[0], np.cumsum(own[i])])
    best = (0, 0)
    for lo in range(0, len(i), ROWS_AT_ONCE):
        a = slice(lo, lo + ROWS_AT_ONCE)
        length = i[None, :] - i[a, None] + 1
        errors = altered[None, :] - altered[a, None]
        n_own = upto[i + 1][None, :] - upto[i[a]][:, None]
        n_kept = kept[1:][None, :] - kept[:-1][a, None]
        ok = (length >= WINDOW) & (errors * PER_ALTERED <= length) & (n_own > 0) & (n_kept * 2 >= n_own)
        if ok.any():
            x, y = np.unravel_index(np.where(ok, length, 0).argmax(), length.shape)
            best = max(best, (int(length[x, y]), int(errors[x, y])), key=lambda z: (z[0], -z[1]))
    return best


def least_own(words: np.ndarray, own: np.ndarray) -> int:
    """How many different own words any passage of an item keeps at least: half of
    those in the stretch of 16 to 31 words with the fewest, each counted as often as
    it can repeat."""
    if len(words) < WINDOW or not own.any():
        return len(words) + 1
    repeats = int(np.unique(words[own], return_counts=True)[1].max())
    in_window = np.convolve(own, np.ones(WINDOW, int), "valid")
    return min(-(-(-(-int(n) // 2)) // repeats) for n in in_window if n) if in_window.any() else 1


_FOUND = "doc_id long, whole long, n_words int, n_altered int"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, stretch, whole, item words, own, item shingles) -> the passages among them."""
    for b in batches:
        out = []
        for doc, w, k, item, own, keys in zip(b.column(0).to_pylist(), _rows(b.column(1)), b.column(2).to_pylist(), _rows(b.column(3)), b.column(4).to_pylist(), _rows(b.column(5))):
            own = np.array(own, bool)
            places = np.flatnonzero(np.isin(shingles(w), keys))
            if len(places) < LEAST_SHARED or len(np.intersect1d(w, item[own])) < least_own(item, own):
                continue
            lo, hi = max(0, int(places[0]) - WINDOW), int(places[-1]) + SHINGLE + WINDOW
            length, errors = passage(w[lo:hi], item, own)
            if length:
                out.append((doc, k, length, errors))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc_id", "whole", "n_words", "n_altered"])


def leaked_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_words, n_altered) of each document that holds a passage of an item.

    A passage is at least 16 consecutive words of an item, no more than one in
    eight altered, left out or put in; it begins and ends with an unaltered word, so
    a shorter quote is none. It may stand in whatever case, punctuation, markup and
    line breaks, with remarks of 4 to 40 words put in between. At least
    half of the item's own words in it must be unaltered. Sentences at an item's
    ends that other items share don't count. Items of equal words leak together.
    Null and empty texts hold nothing; items of less than 16 such words can't be
    found. Equal texts give a row each; rows with equal ids are one document. Texts
    are read whole. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    contents, members = item_contents(items, item_key, item_text)
    n = contents.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    owned = F.filter(F.zip_with("words", "own", lambda w, o: F.when(o, w)), lambda x: x.isNotNull())
    filters = Filters(bitmap(contents.select(F.explode("words").alias("x")), n), bitmap(contents.select(F.explode(owned).alias("x")), n), bitmap(contents.select(F.explode("keys").alias("x")), n))
    sent = spark.sparkContext.broadcast(filters)  # at most three times MOST_BITS
    hits = docs.select(F.col(key).cast("long"), text).mapInArrow(lambda it: shared_stretches(it, sent.value), _HITS)
    hits = materialise(hits.withColumn("stretch", F.monotonically_increasing_id()), "shared-stretches")
    rarity = hits.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    known = contents.select("whole", F.explode(F.array_distinct(owned)).alias("token")).join(rarity, "token")
    known = known.groupBy("whole").agg(F.collect_list("token").alias("known"), F.collect_list("n").alias("n"))
    prefixes = contents.join(known, "whole").select("whole", "words", "own", "known", "n").mapInArrow(_prefixes, "whole long, token long")
    asked = hits.where("doc is not null").select("stretch", F.explode("tokens").alias("token"))
    pairs = materialise(asked.join(prefixes, "token").select("stretch", "whole").distinct(), "leak-candidates")
    tasks = max(spark.sparkContext.defaultParallelism, -(-pairs.count() // PER_TASK))
    whole = pairs.join(hits.where("doc is not null").select("stretch", "doc", F.col("words").alias("text")), "stretch").join(contents, "whole")
    held = whole.repartition(tasks, "stretch", "whole").select("doc", "text", "whole", "words", "own", "keys").mapInArrow(_verify, _FOUND)
    best = held.join(members, "whole").groupBy("doc_id", F.col("item").alias("item_id")).agg(F.max(F.struct("n_words", "n_altered")).alias("x"))
    return best.select("doc_id", "item_id", "x.n_words", "x.n_altered")
