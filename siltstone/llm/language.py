"""Languages of documents and of their paragraphs, by error-correcting output codes.

Each language has a codeword. One binary classifier per bit, over hashed
character n-grams of words, says which side of its bit a text is on; the
language is the codeword with the least logistic loss against all the bits'
margins, so that a few bits in error are made good, and the distance to the next
codeword gives the confidence. The classifiers are fitted on a bounded sample of
labelled rows, cleaned of its wrong labels by fitting twice; every text is then
read whole. The weights of a word are summed once and kept per worker, so a
paragraph costs one look-up per word and one sum per bit.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "nl", "ru", "pl")
#: Most labelled rows per language that the classifiers are fitted on.
SAMPLE_PER_LANGUAGE = 300
#: Words that a paragraph of prose has at least, to give its document a language.
LEAST_WORDS = 20
CODE_BITS = 24
N_FEATURES = 1 << 15
CACHED_WORDS = 400_000
WORDS_AT_ONCE = 200_000
#: Below this confidence another codeword is about as near.
AMBIGUOUS = 0.6

_CODE = re.compile(
    r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|<pre\b.*?(?:</pre>|\Z)|\{\{\{.*?(?:\}\}\}|\Z)|\[code\].*?(?:\[/code\]|\Z)|^(?: {4}|\t)[^\n]*$|`[^`\n]*`|<[/!]?[a-zA-Z][^<>\n]*>"
    r"|\]\([^)\s]*\)|\bhttps?://\S+|&[a-zA-Z]{2,8};|^\s*---\s*$|^\[[+-]\d+[^\]\n]*\]\s*$",
    re.S | re.M,
)
_BREAK = re.compile(r"\n[\s>]*\n")
_QUOTED = re.compile(r"^[\s>]+", re.M)
_WORD = re.compile(r"[^\W\d_]+")
#: Marks of code that stands between prose without any notation.
_CODELIKE = re.compile(r"[=;{}()\[\]<>|$\\]|\w_\w|\w\.\w+\(|--\w|::|->")


def codewords(n: int = len(LANGUAGES), bits: int = CODE_BITS, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1, the farthest apart of many random ones; no bit is the same for all."""
    rng, best, found = np.random.default_rng(seed), -1, None
    for _ in range(2000):
        c = np.where(rng.random((n, bits)) < 0.5, -1, 1).astype(np.int8)
        if (np.abs(c.sum(axis=0)) == n).any():
            continue
        d = min(int((c[i] != c[j]).sum()) for i in range(n) for j in range(i))
        if d > best:
            best, found = d, c
    return found


def mask_code(text: str) -> str:
    """The text with everything that is no prose blanked out, places unchanged."""
    return _CODE.sub(lambda m: "\n" + " " * (m.end() - m.start() - 2) + "\n" if m.end() - m.start() > 1 and m.group()[0] in "`~<{[" and "\n" in m.group() else " " * (m.end() - m.start()), text)


def _is_code(part: str, n_words: int) -> bool:
    """A mark of code to every four words."""
    return len(_CODELIKE.findall(_QUOTED.sub("", part))) * 4 >= n_words


def _line_words(line: str) -> list[str]:
    words = _WORD.findall(line.lower())
    return [] if _is_code(line, len(words)) else words


def paragraphs(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of each paragraph of prose."""
    masked, at = mask_code(text), 0
    for part in _BREAK.split(masked):
        start = masked.index(part, at) if part else at
        at = start + len(part)
        words = _WORD.findall(part.lower())
        if words and _is_code(part, len(words)):
            # Mostly code: its lines that are none.
            words = [w for line in part.split("\n") for w in _line_words(line)]
        if words:
            yield start, at, words


def features(word: str) -> np.ndarray:
    """Hashed character n-grams of a word, of one to four characters, and the word itself."""
    w = f"<{word}>"
    grams = [w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]
    grams += [f"={word}", *(c for c in word if c > "\x7f")]
    return np.fromiter((zlib.crc32(g.encode()) & (N_FEATURES - 1) for g in grams), np.int64, len(grams))


@dataclass
class Model:
    """weights: of each feature for each bit; scale: typical margin of each bit."""

    weights: np.ndarray
    scale: np.ndarray
    code: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and confidence of each row of margins, weighted by logistic loss."""
        m = margins / self.scale
        loss = np.logaddexp(0, -m[:, None, :] * self.code[None, :, :]).sum(axis=2)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


class Scorer:
    """A model with the summed weights of the words seen so far."""

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.rows = np.zeros((1024, model.weights.shape[1]), np.float32)

    def margins(self, texts: list[list[str]]) -> np.ndarray:
        """Of each text and bit, in parts so that the memory has a bound."""
        out, part, n = [np.zeros((0, self.rows.shape[1]))], [], 0
        for t in texts:
            part.append(t)
            n += len(t)
            if n >= WORDS_AT_ONCE:
                out.append(self._margins(part))
                part, n = [], 0
        return np.concatenate([*out, self._margins(part)] if part else out)

    def _margins(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.index) > CACHED_WORDS:
            self.index = {}
        index, n = self.index, len(self.index)
        flat = [w for t in texts for w in t]
        at = np.empty(len(flat), np.int64)
        get = index.get
        for i, w in enumerate(flat):
            k = get(w)
            if k is None:
                if n == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[n] = self.model.weights[features(w)].mean(axis=0)
                index[w] = k = n
                n += 1
            at[i] = k
        size = np.array([len(t) for t in texts])
        starts = np.cumsum(size) - size
        return np.add.reduceat(self.rows[at], starts, axis=0) / size[:, None] if len(flat) else np.zeros((0, self.rows.shape[1]))


def fit(texts: list[list[str]], labels: np.ndarray, n_languages: int, rounds: int = 2) -> Model:
    """Classifiers of the bits from labelled paragraphs, some of them labelled wrongly."""
    code = codewords(n_languages)
    known: dict[str, int] = {}
    rows = [[known.setdefault(w, len(known)) for w in t] for t in texts]
    grams = [features(w) for w in known]
    labels = labels.copy()
    model = None
    for _ in range(rounds):
        counts = np.zeros((n_languages, N_FEATURES))
        for k in range(n_languages):
            ids = [w for r, y in zip(rows, labels) if y == k for w in r]
            per_word = np.bincount(ids, minlength=len(known)) if ids else np.zeros(len(known))
            used = np.flatnonzero(per_word)
            if len(used):
                flat = np.concatenate([grams[i] for i in used])
                weight = np.repeat(np.log1p(per_word[used]), [len(grams[i]) for i in used])
                np.add.at(counts[k], flat, weight)
        share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * N_FEATURES)
        sides = [(np.log(share[code[:, b] == 1].mean(axis=0)) - np.log(share[code[:, b] == -1].mean(axis=0))) for b in range(code.shape[1])]
        model = Model(np.stack(sides, axis=1).astype(np.float32), np.ones(code.shape[1]), code)
        margins = Scorer(model).margins(texts)
        model.scale = np.maximum(np.abs(margins).mean(axis=0), 1e-6) / 2
        labels, _ = model.decode(margins)
    return model


def normal_label_column(lang: str) -> Column:
    """The first two letters of a label, in lower case; '' if there are none."""
    return F.lower(F.substring(F.coalesce(F.trim(lang), F.lit("")), 1, 2))


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", languages: tuple[str, ...] = LANGUAGES, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from a sample of at most about per_language labelled rows a language, drawn by hash of the key.

    Languages without any labelled row can't be found later. Rows with null or
    empty text give nothing.
    """
    label = normal_label_column(lang)
    n_of = {r["y"]: r["count"] for r in docs.where(label.isin(*languages)).groupBy(label.alias("y")).count().collect()}
    share = F.coalesce(*[F.when(label == y, F.lit(min(1.0, per_language / n))) for y, n in n_of.items()]) if n_of else F.lit(0.0)
    drawn = F.pmod(F.xxhash64(key, F.lit("language")), F.lit(1_000_000)) < share * 1_000_000
    rows = docs.where(label.isin(*languages) & drawn).select(text, label.alias("y")).collect()
    texts, labels = [], []
    for r in rows:
        for _, _, words in paragraphs(r[0] or ""):
            if len(words) >= 8:
                texts.append(words)
                labels.append(languages.index(r["y"]))
    if not texts:
        texts, labels = [["a"]], [0]
    return fit(texts, np.array(labels), len(languages))


def language_segments(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """(key, start, end, words, n_words, lang, confidence, ambiguous): one row for
    each stretch of consecutive paragraphs of prose in one language; words are its
    words, n_words those of its longest paragraph, confidence the mean over words.

    Null and empty texts, and texts without words, have no rows. Paragraphs of
    less than eight words join the stretch that they follow, or open the text in
    the language of the next. Texts are read whole; repeated rows give repeated
    results.
    """
    send = docs.sparkSession.sparkContext.broadcast(model)  # its size is N_FEATURES times CODE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(send.value)
        for b in batches:
            where, texts = [], []
            for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for start, end, words in paragraphs(s) if s else ():
                    where.append((k, start, end))
                    texts.append(words)
            if not texts:
                continue
            who, sure = scorer.model.decode(scorer.margins(texts))
            out: list[list] = []
            for (k, start, end), words, y, p in zip(where, texts, who.tolist(), sure.tolist()):
                n = len(words)
                last = out[-1] if out and out[-1][0] == k else None
                if last and (last[4] == y or n < 8 or last[6] < 8):
                    if last[4] != y and last[6] < 8 <= n:
                        last[4] = y
                    last[2], last[3] = end, max(last[3], n)
                    last[5] += p * n if last[4] == y else 0
                    last[6] += n
                else:
                    out.append([k, start, end, n, y, p * n, n])
            cols = list(zip(*out))
            means = np.minimum(1.0, np.array(cols[5]) / np.array(cols[6]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[6], pa.int32()), pa.array(cols[3], pa.int32()),
                    pa.array([languages[y] for y in cols[4]]), pa.array(means), pa.array(means < AMBIGUOUS),
                ],
                names=["key", "start", "end", "words", "n_words", "lang", "confidence", "ambiguous"],
            )

    return docs.select(key, text).mapInArrow(run, "key long, start int, end int, words int, n_words int, lang string, confidence double, ambiguous boolean")


def document_languages(segments: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(key, lang, confidence, n_langs): the languages that have a paragraph of at least so many words."""
    long = segments.where(F.col("n_words") >= least_words).groupBy("key", "lang").agg(F.max("confidence").alias("confidence"))
    # A document has one entry at most for each of the few languages.
    by = long.groupBy("key").agg(F.collect_list(F.struct("lang", "confidence")).alias("all"))
    return by.select("key", F.size("all").alias("n_langs"), F.explode("all").alias("x")).select("key", "x.lang", "x.confidence", "n_langs")


def main_languages(docs: DataFrame, segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, lang, confidence, share, n_langs) of each document: the language of most
    of its words, with their share; lang is null and n_langs 0 where there are none."""
    by = segments.groupBy("key", "lang").agg(F.sum("words").alias("w"), F.sum(F.col("confidence") * F.col("words")).alias("c"), F.max("n_words").alias("longest"))
    top = by.groupBy("key").agg(F.max_by(F.struct("lang", "w", "c"), F.struct("w", "lang")).alias("t"), F.sum("w").alias("all"), F.count_if(F.col("longest") >= LEAST_WORDS).alias("n_langs"))
    j = docs.select(F.col(key).cast("long").alias("key")).join(top, "key", "left")
    return j.select("key", "t.lang", (F.col("t.c") / F.col("t.w")).alias("confidence"), (F.col("t.w") / F.col("all")).alias("share"), F.coalesce("n_langs", F.lit(0)).alias("n_langs"))
