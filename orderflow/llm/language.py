"""Language of the words of code-switched text: a linear-chain CRF.

A word's features are its affixes and character n-grams (hashed) and the
learned lexicons it belongs to; transitions between the languages of
neighbouring words are learnt with them.  Forward-backward gives every
word its posterior over languages, a whole text the mean over its words.

The model is fitted on a bounded sample: of each language the
``SAMPLE_DOCS`` labelled documents with the smallest hash of their id,
with their whole texts.  Runs of words of different
documents are joined to training sequences, so that switches occur.
Prediction reads whole texts and nothing else.

Defined cases: NULL text and text without a letter is ``und`` with score
0; with no labelled document all is ``und``; equal posteriors go to the
language first in the alphabet; rows that repeat are predicted alike.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, map_batches, texts_of, worker_cache

#: Bound of the training sample: documents per language.
SAMPLE_DOCS = 500
#: A language's sample ends with the text that reaches so many characters.
SAMPLE_CHARS = 8_000_000
#: Words of a language's lexicon, and sample occurrences a word needs.
LEXICON_WORDS = 5000
LEXICON_COUNT = 3
BUCKETS = 1 << 16
SEQUENCE_WORDS = 60
RUN_WORDS = 25
EPOCHS = 3
BATCH = 48
STEP = 0.15
DECAY = 1e-5
UNKNOWN = "und"
#: Words whose emissions a worker remembers.
CACHE_WORDS = 300_000

_WORDS = re.compile(r"[^\W\d_]+").findall
_FIRST, _LAST = 1, 2


def words_of(text: str | None) -> list[str]:
    """Lower-case words; none if the text has no letter."""
    words = _WORDS((text or "").lower())
    if words and not words[0].isalpha() and not any(c.isalpha() for w in words for c in w):
        return []
    return words


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hashed feature) pairs: n-grams of two and three
    characters with word ends, and affixes of up to three characters."""
    joined = "".join(["\x01" + w + "\x02" for w in words])
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.cumsum(c == _FIRST) - 1
    index, feature = [], []
    for n in (2, 3, 4):
        m = len(c) - n + 1
        if m <= 0:
            continue
        ok = word[:m] == word[n - 1:]
        if n == 4:
            ok &= (c[:m] == _FIRST) | (c[n - 1:] == _LAST)
        at = np.flatnonzero(ok)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ c[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        index.append(word[at])
        feature.append((h >> np.uint64(17)) % np.uint64(BUCKETS))
    return np.concatenate(index), np.concatenate(feature).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages)
    lexicon_weights: np.ndarray  # (languages, languages)
    lexicons: dict[str, list[int]]  # word -> numbers of the languages that list it
    transitions: np.ndarray  # (languages, languages)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potentials (words, languages)."""
        k = len(self.languages)
        index, feature = word_features(words)
        out = np.empty((len(words), k))
        for j in range(k):
            out[:, j] = np.bincount(index, self.weights[feature, j], len(words))
        return out + membership(self.lexicons, words, k) @ self.lexicon_weights


def membership(lexicons: dict[str, list[int]], words: list[str], k: int) -> np.ndarray:
    """(words x languages) whether a language's lexicon lists the word."""
    out = np.zeros((len(words), k))
    for i, w in enumerate(words):
        listed = lexicons.get(w)
        if listed:
            out[i, listed] = 1
    return out


def forward_backward(emission: np.ndarray, transitions: np.ndarray, counts: np.ndarray,
                     moves: np.ndarray | None = None) -> np.ndarray:
    """Posteriors of time-major sequences; the expected number of every
    transition is added to ``moves``, if given.

    Rows of ``emission`` are ordered by position, then sequence; sequences
    are sorted by length, longest first, so position t has ``counts[t]``
    of them.
    """
    pot = np.exp(emission - emission.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    edges = np.concatenate([[0], np.cumsum(counts)])
    alpha = np.empty_like(pot)
    last = None
    for t, n in enumerate(counts):
        a = pot[edges[t]:edges[t] + n]
        if last is not None:
            a = a * (last[:n] @ move)
        a = a / a.sum(axis=1, keepdims=True)
        alpha[edges[t]:edges[t] + n] = a
        last = a
    back = move.T
    beta = np.ones((counts[-1], pot.shape[1]))
    for t in range(len(counts) - 2, -1, -1):
        n, m = counts[t], counts[t + 1]
        ahead = pot[edges[t + 1]:edges[t + 1] + m] * beta
        b = ahead @ back
        if moves is not None:  # pair marginals: alpha * move * potential * beta, normalised
            before = alpha[edges[t]:edges[t] + m]
            moves += move * (before.T @ (ahead / (before * b).sum(axis=1, keepdims=True)))
        b /= b.sum(axis=1, keepdims=True)
        if n > m:
            b = np.concatenate([b, np.ones((n - m, pot.shape[1]))])
        alpha[edges[t]:edges[t] + n] *= b
        beta = b
    return alpha / alpha.sum(axis=1, keepdims=True)


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(lang, text) rows to learn from: at most ``SAMPLE_DOCS`` whole texts a
    language, and no further one beyond ``SAMPLE_CHARS`` characters."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    wide = known.select("lang", "text", draw.alias("draw"))
    # Twice the sample by a draw, then exactly the smallest draws.
    near = wide.join(F.broadcast(sizes), "lang").filter(
        F.col("draw") * F.col("n") < 2 * SAMPLE_DOCS * 1_000_000)
    order = Window.partitionBy("lang").orderBy("draw", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = near.withColumn("_r", F.row_number().over(order)).withColumn(
        "_c", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))).filter(
        (F.col("_r") <= SAMPLE_DOCS) & (F.col("_c") < SAMPLE_CHARS))
    return sorted((r["lang"], r["text"]) for r in rows.select("lang", "text").collect())


def _lexicons(texts: list[tuple[int, list[str]]], k: int) -> dict[str, list[int]]:
    counts: dict[str, np.ndarray] = {}
    for lang, words in texts:
        for w in words:
            if w not in counts:
                counts[w] = np.zeros(k)
            counts[w][lang] += 1
    out: dict[str, list[int]] = {}
    for j in range(k):
        mine = [(-c[j], w) for w, c in counts.items() if c[j] >= LEXICON_COUNT and 2 * c[j] > c.sum()]
        for _, w in sorted(mine)[:LEXICON_WORDS]:
            out.setdefault(w, []).append(j)
    return out


def train(rows: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Fit by stochastic gradient ascent on the sequence likelihood."""
    languages = sorted({lang for lang, _ in rows})
    k = len(languages)
    texts = [(languages.index(lang), words_of(t)) for lang, t in rows]
    texts = [(lang, words) for lang, words in texts if words]
    model = Model(languages, np.zeros((BUCKETS, k)), np.zeros((k, k)), _lexicons(texts, k), np.zeros((k, k)))
    if k < 2 or not texts:
        return model
    vocabulary = list(dict.fromkeys(w for _, words in texts for w in words))
    number = {w: i for i, w in enumerate(vocabulary)}
    index, feature = word_features(vocabulary)
    first = np.searchsorted(index[np.argsort(index, kind="stable")], np.arange(len(vocabulary) + 1))
    by_word = feature[np.argsort(index, kind="stable")]
    member = membership(model.lexicons, vocabulary, k)
    rng = np.random.default_rng(seed)
    runs = [(lang, words[i:i + RUN_WORDS]) for lang, words in texts for i in range(0, len(words), RUN_WORDS)]
    square, lex_square, move_square = (np.full(x.shape, 1e-3) for x in
                                       (model.weights, model.lexicon_weights, model.transitions))
    for _ in range(epochs):
        ids, gold = [], []
        for r in rng.permutation(len(runs)):
            lang, words = runs[r]
            ids += [number[w] for w in words]
            gold += [lang] * len(words)
        n = len(ids) // SEQUENCE_WORDS or 1
        length = min(SEQUENCE_WORDS, len(ids))
        ids = np.array(ids[:n * length]).reshape(n, length)
        gold = np.array(gold[:n * length]).reshape(n, length)
        for at in range(0, n, BATCH):
            w, y = ids[at:at + BATCH].T.ravel(), gold[at:at + BATCH].T.ravel()  # time-major
            b = len(w) // length
            sizes = first[w + 1] - first[w]
            owner = np.repeat(np.arange(len(w)), sizes)
            spots = np.repeat(first[w] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            feats = by_word[spots]
            use = rng.random(len(w)) < 0.5  # half of the words do without lexicons
            lex = member[w] * use[:, None]
            emission = np.stack([np.bincount(owner, model.weights[feats, j], len(w)) for j in range(k)], 1) \
                + lex @ model.lexicon_weights
            moves = np.zeros((k, k))
            post = forward_backward(emission, model.transitions, np.full(length, b), moves)
            delta = np.eye(k)[y] - post
            grad = np.stack([np.bincount(feats, delta[owner, j], BUCKETS) for j in range(k)], 1)
            lex_grad = lex.T @ delta
            pairs = np.zeros((k, k))
            np.add.at(pairs, (y[:-b], y[b:]), 1)
            move_grad = pairs - moves
            for value, g, sq in ((model.weights, grad, square), (model.lexicon_weights, lex_grad, lex_square),
                                 (model.transitions, move_grad, move_square)):
                g = g / b - DECAY * value
                sq += g * g
                value += STEP * g / np.sqrt(sq)
    return model


class Tagger:
    """Posteriors of whole texts, with remembered word emissions."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages)), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        number = self.number
        new = [w for w in dict.fromkeys(words) if w not in number]
        if new:
            at = len(number)
            number.update(zip(new, range(at, at + len(new))))
            if len(number) > len(self.table):
                grown = np.zeros((2 * len(number), self.table.shape[1]), np.float32)
                grown[:at] = self.table[:at]
                self.table = grown
            for i in range(0, len(new), 20_000):
                part = new[i:i + 20_000]
                self.table[at + i:at + i + len(part)] = self.model.emissions(part)
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def posteriors(self, texts: list[str | None]):
        """(mean posterior or None, words, per-word language) per text."""
        if len(self.number) > CACHE_WORDS:
            self.number = {}
        ids = [self._ids(words_of(t)) for t in texts]
        order = sorted((i for i in range(len(texts)) if len(ids[i])), key=lambda i: -len(ids[i]))
        out: list = [None] * len(texts)
        if not order or not self.model.languages:
            return out
        lengths = np.array([len(ids[i]) for i in order])
        counts = len(order) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
        edges = np.concatenate([[0], np.cumsum(counts)])[:-1]
        flat = np.empty(int(lengths.sum()), np.int64)
        places = [edges[:len(ids[i])] + j for j, i in enumerate(order)]
        for i, place in zip(order, places):
            flat[place] = ids[i]
        post = forward_backward(self.table[flat].astype(np.float64), self.model.transitions, counts)
        for i, place in zip(order, places):
            own = post[place]
            out[i] = (own.mean(axis=0), own.argmax(axis=1))
        return out


def _runs(labels: np.ndarray, languages: list[str]) -> list[dict]:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
    return [{"lang": languages[labels[a]], "words": int(b - a)} for a, b in zip(cuts[:-1], cuts[1:])]


def with_language(docs: DataFrame, model: Model, text: str = "text", runs: bool = False) -> DataFrame:
    """Every column of ``docs`` plus ``lang_pred``, ``score`` and, on
    request, ``lang_runs``: the text's runs of words of one language."""
    key = f"tagger_{zlib.crc32(model.weights.tobytes())}"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_runs")]

    def run(batch):
        tagger = worker_cache(key, lambda: Tagger(shared.value))
        langs = tagger.model.languages
        pred, score, spans = [], [], []
        for got in tagger.posteriors(texts_of(batch, text)):
            pred.append(langs[int(got[0].argmax())] if got else UNKNOWN)
            score.append(float(min(1.0, got[0].max())) if got else 0.0)
            spans.append(_runs(got[1], langs) if got and runs else [])
        out = {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())}
        if runs:
            out["lang_runs"] = pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())])))
        return out

    schema = "lang_pred string, score double" + ", lang_runs array<struct<lang: string, words: int>>" * runs
    return map_batches(docs.select(*keep), run, schema, keep=keep, rows=1024)


def op1(docs: DataFrame) -> DataFrame:
    model = train(sample(docs))
    tagged = with_language(docs.select("doc_id", "text").withColumn("held_out", held_out()), model)
    return tagged.select("doc_id", "held_out", "lang_pred", "score")
