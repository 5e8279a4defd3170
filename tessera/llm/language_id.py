"""Language identification by script ranges and Viterbi over words.

Training counts words (runs of letters, lower-cased) per language over all training
rows in Spark, then the hashed 1- to 4-grams of every distinct word, weighted by its count, in
``BUCKETS`` buckets; the model has that many numbers per language however large the corpus. A
word's score for a language is the mean log probability of its grams, the whole
word among them, times ``WEIGHT``.

Prediction takes a text's words in order. The script of a word (ranges of its first
letter) narrows its languages to those that training saw in that script; a script never seen leaves all. Viterbi then finds
the best sequence of languages, with a penalty for each switch, which labels spans of
mixed text. The prediction is the language with most letters, its share the score;
texts go through it whole, all of a batch at once, word by word.

Nulls: a null text and one without a letter are ``und`` with score 0; rows with null
text or lang teach nothing. Ties go to the least language by code point. With nothing to learn from every
text is ``und``. Repeated rows are predicted alike. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shingles import mix
from tessera.llm.words import LETTERS, letter_words
from tessera.shared import map_arrow, materialize

BUCKETS = 1 << 16
WEIGHT = 2.0
SWITCH = 6.0
#: First code points of blocks and their scripts.
SCRIPTS = [(0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "gurmukhi"), (0xA80, "gujarati"), (0xB00, "oriya"), (0xB80, "tamil"), (0xC00, "telugu"), (0xC80, "kannada"), (0xD00, "malayalam"), (0xD80, "sinhala"), (0xE00, "thai"), (0xE80, "lao"), (0xF00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"), (0x30000, "other")]
_STARTS = [s for s, _ in SCRIPTS]


def script_of(word: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, bucket) of every gram of the words: 1 to 4 letters, with marks at both ends, and each whole word."""
    text = "^" + "$^".join(words) + "$"
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    left = ends[owner] - np.arange(len(code))
    owners, hashes, acc = [], [], np.full(len(code), _FACTORS[7])
    for n in range(1, 5):
        acc = acc.copy()
        acc[: len(code) - n + 1] += code[n - 1 :] * _FACTORS[n]
        fits = left >= n
        owners.append(owner[fits])
        hashes.append(mix(acc[fits] + np.uint64(n)))
    # A whole word: its letters by place, places up to 4096 told apart.
    place = _FACTORS[5] * (np.arange(len(code)) - (ends - np.diff(ends, prepend=0))[owner]).astype(np.uint64) + _FACTORS[6]
    owners.append(np.arange(len(words)))
    hashes.append(mix(np.add.reduceat(mix(code * _FACTORS[0] + place), ends - np.diff(ends, prepend=0))))
    return np.concatenate(owners), (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n -> lang, bucket or -1 - script number, n."""
    names = sorted({s for _, s in SCRIPTS})
    for batch in batches:
        langs, words, n = (c.to_pylist() for c in batch.columns)
        if not words:
            continue
        kinds = sorted(set(langs))
        lang = np.array([kinds.index(x) for x in langs])
        owner, bucket = gram_buckets(words)
        script = -1 - np.array([names.index(script_of(w)) for w in words])
        size, weight = BUCKETS + len(names), np.array(n, np.float64)
        key = np.concatenate((lang[owner] * size + bucket, lang * size + BUCKETS - 1 - script))
        totals = np.bincount(key, weights=np.concatenate((weight[owner], weight)), minlength=size * len(kinds))
        hit = np.flatnonzero(totals)
        where = hit % size
        yield pa.record_batch([pa.array([kinds[i] for i in (hit // size).tolist()], pa.string()), pa.array(np.where(where < BUCKETS, where, BUCKETS - 1 - where)), pa.array(totals[hit].astype(np.int64))], names=["lang", "bucket", "n"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smooth: float = 0.5) -> dict:
    """The model: languages, their log probabilities by bucket, and the languages of each script."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    words = rows.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    found = words.transform(map_arrow, _counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS numbers per language come to the driver.
    table = materialize(found, "grams").toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    at = {x: i for i, x in enumerate(langs)}
    row = np.array([at[x] for x in table["lang"].to_pylist()], np.int64)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy().astype(np.float64)
    counts = np.zeros((len(langs), BUCKETS))
    real = bucket >= 0
    counts[row[real], bucket[real]] = n[real]
    scripts: dict[str, list[int]] = {}
    names = sorted({s for _, s in SCRIPTS})
    for r, b, c in zip(row[~real].tolist(), bucket[~real].tolist(), n[~real].tolist(), strict=True):
        scripts.setdefault(names[-1 - b], []).append((r, c))
    # A language has a script if at least one in a hundred of its words is in it: quotations don't count.
    total = np.zeros(len(langs))
    for pairs in scripts.values():
        for r, c in pairs:
            total[r] += c
    allowed = {s: kept for s, pairs in scripts.items() if (kept := sorted(r for r, c in pairs if c >= 0.01 * total[r]))}
    logs = np.log((counts + smooth) / (counts.sum(axis=1, keepdims=True) + smooth * BUCKETS)) if langs else counts
    return {"langs": langs, "logs": logs.astype(np.float32), "scripts": allowed}


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best labels of sequences that lie end to end in scores (words x labels)."""
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # sequences longer than t
    labels = scores.shape[1]
    came = np.zeros(scores.shape, np.int16)
    out = np.zeros(len(scores), np.int16)
    value = np.zeros((len(sizes), labels))
    own = np.arange(labels)
    for t in range(steps):
        a = active[t]
        at = begin[:a] + t
        before = value[:a]
        best = before.argmax(axis=1)
        switched = before[np.arange(a), best][:, None] - penalty
        stay = before >= switched
        came[at] = np.where(stay, own, best[:, None])
        value[:a] = np.where(stay, before, switched) + scores[at]
    label = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = begin[:a] + t
        out[at] = label[:a]
        label[:a] = came[at, label[:a]]
    return out


class Labeller:
    """Scores words, remembering those seen, and labels texts."""

    def __init__(self, model: dict, remembered: int = 300_000):
        self.model, self.most, self.known = model, remembered, {}
        self.table = np.zeros((0, len(model["langs"])))

    def _score(self, words: list[str]) -> np.ndarray:
        logs, scripts, n = self.model["logs"], self.model["scripts"], len(self.model["langs"])
        if not words:
            return np.zeros((0, n))
        owner, bucket = gram_buckets(words)
        sizes = np.bincount(owner)
        out = np.stack([WEIGHT * np.bincount(owner, weights=row[bucket]) / sizes for row in logs], axis=1)
        kinds = [script_of(w) for w in words]
        for kind in set(kinds):
            allowed = scripts.get(kind)
            if allowed is not None and len(allowed) < n:
                closed = np.ones(n, bool)
                closed[allowed] = False
                out[np.ix_([k == kind for k in kinds], closed)] -= 1e6
        return out

    def label(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """The texts' words, their numbers, and the language number of each word of all texts in turn."""
        found = [letter_words(t) for t in texts]
        if len(self.known) > self.most:
            self.known, self.table = {}, self.table[:0]
        new = sorted({w for ws in found for w in ws} - self.known.keys())
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.table = np.concatenate((self.table, self._score(new)))
        lengths = np.array([len(ws) for ws in found])
        ids = np.fromiter((self.known[w] for ws in found for w in ws), np.int64, int(lengths.sum()))
        labels = viterbi(self.table[ids], lengths)
        return found, lengths, labels

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs = self.model["langs"]
        if not langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        found, lengths, labels = self.label(texts)
        sizes = np.fromiter((len(w) for ws in found for w in ws), np.int64, len(labels))
        share = np.zeros((len(texts), len(langs)))
        np.add.at(share, (np.repeat(np.arange(len(texts)), lengths), labels), sizes)
        total, best = share.sum(axis=1), share.argmax(axis=1)
        return [langs[b] if t else "und" for b, t in zip(best, total, strict=True)], (share.max(axis=1) / np.maximum(total, 1)).tolist()


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                cut = batch.slice(at, 2000)
                langs, scores = labeller.predict(cut.column(1).to_pylist())
                yield pa.record_batch([cut.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).transform(map_arrow, run, "doc_id long, lang_pred string, score double")


def spans(text: str | None, model: dict) -> list[tuple[int, int, str]]:
    """Spans of a text in one language each: start, end, language."""
    labeller = Labeller(model)
    if not model["langs"]:
        return []
    lowered = (text or "").lower()
    _, _, labels = labeller.label([text])
    out: list[list] = []
    for m, label in zip(LETTERS.finditer(lowered), labels.tolist(), strict=True):
        lang = model["langs"][label]
        if out and out[-1][2] == lang:
            out[-1][1] = m.end()
        else:
            out.append([m.start(), m.end(), lang])
    return [tuple(x) for x in out]


def held_out_quarter(id_col: str = "doc_id") -> Column:
    """The rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
