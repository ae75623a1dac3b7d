"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import labelled
from .common import crc_mod, free_name, mix64, packed, pieces, slices, table, word_spans
from .textstats import BANGS, DIGIT, FOLDED, KEPT, LOWER, PLAIN, PLAIN_KEPT, PUNCT, SIGNS, STOPS, UPPER, doc_sums, folded_hashes, word_hash

FOLD = (5, 0)
TERMS = 256  # most terms in the lexicon
STEMS = (4, 5, 6)  # bytes of the word beginnings that count as terms beside whole words
NEAR = 5  # words between a second person and a term that count as near
SECOND_PERSON = ["you", "your", "yours", "u", "ur", "thou", "du", "dich", "dir", "dein", "ihr", "euch", "tu", "toi", "te", "vous", "votre", "ton", "ti", "usted", "ustedes", "vos", "su"]


@dataclass
class Lexicon:
    """Terms (hashes, ascending) that tell toxic texts from others, with their log odds."""

    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def weigh(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, self.odds[at], 0.0)


def term_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = FOLDED, kept: np.ndarray = KEPT) -> np.ndarray:
    """A column of hashes for the whole words and one for each length of STEMS; 0 where a word is no longer than that."""
    whole, size = folded_hashes(data, starts, ends, fold, kept)
    where = np.flatnonzero(kept[data])
    first = np.searchsorted(where, starts)
    cols = [np.where(size > 1, whole, 0)]
    for k in STEMS:
        stem = np.flatnonzero(size > k)
        col = np.zeros(len(starts), np.uint64)
        if len(stem):
            col[stem] = mix64(folded_hashes(data, starts[stem], where[first[stem] + k - 1] + 1, fold, kept)[0] + np.uint64(k))
        cols.append(col)
    return np.column_stack(cols)


def distinct_terms(texts: pa.Array, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms, each once for a text that has it, and the label of that text; some texts at a time."""
    for lo, hi, data, off in slices(texts):
        starts, ends = word_spans(data, off)
        h = term_hashes(data, starts, ends)
        doc = np.repeat(np.searchsorted(off, starts, "right") - 1, h.shape[1])
        h = h.ravel()
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = (h != 0) & np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])[: len(h)]
        yield h[new], y[lo:hi][doc[new]]


def learn_lexicon(texts: pa.Array, y: np.ndarray) -> Lexicon:
    """The TERMS words and stems with the most evidence of lying in toxic texts more often than in others."""
    first: list[np.ndarray] = []
    for terms, label in distinct_terms(texts, y):
        first.append(terms[label == 1])
    tox, t = np.unique(np.concatenate(first), return_counts=True) if first else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    tox, t = tox[t >= 3], t[t >= 3]
    if not len(tox):
        return Lexicon()
    clean = np.zeros(len(tox), np.int64)
    for terms, label in distinct_terms(texts, y):
        other = terms[label == 0]
        at = np.minimum(np.searchsorted(tox, other), len(tox) - 1)
        clean += np.bincount(at[tox[at] == other], minlength=len(tox))
    n = {k: max(int((y == k).sum()), 1) for k in (0, 1)}
    odds = np.log((t + 0.5) / (n[1] + 1)) - np.log((clean + 0.5) / (n[0] + 1))
    gain = t * odds
    good = np.flatnonzero(odds > 1)
    good = good[np.argsort(-gain[good], kind="stable")][:TERMS]
    good = good[np.argsort(tox[good])]
    return Lexicon(tox[good], odds[good])


def features(data: np.ndarray, off: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Per text: densities and strengths of lexicon hits, hits near a second person, capitals, punctuation, obfuscation."""
    n = len(off) - 1
    starts, ends = word_spans(data, off)
    doc = np.searchsorted(off, starts, "right") - 1
    words = np.bincount(doc, minlength=n)
    nw, nb = np.maximum(words, 1), np.maximum(np.diff(off), 1)
    of = lambda v: np.bincount(doc, weights=v, minlength=n)
    open_, _ = folded_hashes(data, starts, ends)
    hidden, _ = folded_hashes(data, starts, ends, PLAIN, PLAIN_KEPT)
    w_open = lexicon.weigh(term_hashes(data, starts, ends).ravel()).reshape(-1, 1 + len(STEMS)).max(1)
    w_hidden = lexicon.weigh(hidden)
    disguised = np.where(w_open > 0, 0.0, w_hidden)
    weight = np.maximum(w_open, w_hidden)
    hit, strong = weight > 0, weight > 3
    person = np.isin(open_, np.array([word_hash(w) for w in SECOND_PERSON], np.uint64))
    at = np.flatnonzero(person)
    near = np.zeros(len(starts), bool)
    if len(at):
        hits = np.flatnonzero(hit)
        right = np.searchsorted(at, hits)
        for side in (np.minimum(right, len(at) - 1), np.maximum(right - 1, 0)):
            near[hits] |= (np.abs(at[side] - hits) <= NEAR) & (doc[at[side]] == doc[hits])
    strongest = np.zeros(n)
    np.maximum.at(strongest, doc, weight)
    cum = lambda t: np.concatenate([[0], np.cumsum(t[data])])
    up, low, sig = cum(UPPER), cum(LOWER), cum(SIGNS)
    w_up, w_low, w_sig = up[ends] - up[starts], low[ends] - low[starts], sig[ends] - sig[starts]
    per = lambda t: doc_sums(t[data], off)
    cols = [of(hit) / nw, of(strong) / nw, np.log1p(of(hit)), np.log1p(of(strong)), of(weight) / nw, strongest, of(near) / nw, np.log1p(of(near)), of(person) / nw, of(disguised > 0) / nw, np.log1p(of(disguised > 0)), of((w_sig > 0) & (w_up + w_low > 0)) / nw, per(UPPER) / np.maximum(per(UPPER) + per(LOWER), 1), of((w_up >= 2) & (w_low == 0)) / nw, per(BANGS) / nw, per(STOPS) / nw, per(PUNCT) / nb, per(DIGIT) / nb]
    return np.column_stack(cols)


def matrix(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    parts = [features(data, off, lexicon) for _, _, data, off in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, 18))


class Boosted:
    """Binary log-loss boosting of depth-limited trees over quantile bins."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least
        self.fitted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base, self.edges = 0.0, []

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]) if len(self.edges) else np.zeros((len(x), 0), np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        cuts = np.linspace(0, 1, self.bins)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], np.concatenate([cuts, [0.98, 0.99, 0.995]]))) for j in range(x.shape[1])]
        b = self.binned(x)
        width = max((len(e) for e in self.edges), default=0) + 1
        f = np.full(len(y), self.base)
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, q * (1 - q)
            node = np.zeros(len(y), np.int64)
            col, cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, width, np.int64)
            for d in range(self.depth):
                m, first = 1 << d, (1 << d) - 1
                best = np.zeros(m)
                for j in range(b.shape[1]):
                    key = node * width + b[:, j]
                    gs = np.bincount(key, g, m * width).reshape(m, width).cumsum(1)
                    hs = np.bincount(key, h, m * width).reshape(m, width).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(hs < self.least) | (ht - hs < self.least)] = 0
                    at = gain.argmax(1)
                    won = gain[np.arange(m), at]
                    better = won > best + 1e-9
                    best = np.where(better, won, best)
                    col[first : first + m][better] = j
                    cut[first : first + m][better] = at[better]
                node = 2 * node + (b[np.arange(len(y)), col[first + node]] > cut[first + node])
            gs, hs = np.bincount(node, g, 1 << self.depth), np.bincount(node, h, 1 << self.depth)
            leaf = self.rate * gs / (hs + self.ridge)
            f += leaf[node]
            self.fitted.append((col, cut, leaf))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        f, rows = np.full(len(x), self.base), np.arange(len(x))
        b = self.binned(x)
        for col, cut, leaf in self.fitted:
            node = np.zeros(len(x), np.int64)
            for d in range(self.depth):
                at = (1 << d) - 1 + node
                node = 2 * node + (b[rows, col[at]] > cut[at])
            f += leaf[node]
        return f


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: block centres and the non-decreasing means of y over them."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, sum of x, rows
    for a, b in zip(x[order], y[order]):
        blocks.append([float(b), float(a), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][2] >= blocks[-1][0] * blocks[-2][2]:
            s, c, k = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += c
            blocks[-1][2] += k
    return np.array([b[1] / b[2] for b in blocks]), np.array([b[0] / b[2] for b in blocks])


@dataclass
class Model:
    lexicon: Lexicon
    boosted: Boosted | None
    at: np.ndarray
    rate: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """0 to 1, higher: likelier toxic. Calibrated rates, with a thousandth left to the margin to order equal rates."""
        if self.boosted is None:
            return np.full(len(texts), float(self.rate[0]))
        f = self.boosted.margin(matrix(texts, self.lexicon))
        return 0.999 * np.interp(f, self.at, self.rate) + 0.001 / (1 + np.exp(-f))


def fit(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, max_rows: int = labelled.MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> Model:
    """Learns lexicon, trees and calibration from at most max_rows labelled documents outside the held-out fold.

    Half of the rows fit the lexicon and so the trees see its densities on rows that did not choose its terms;
    the trees take the next three tenths, the calibration the rest. Where one of these parts lacks one of the two
    labels, each part is all rows. Without labels, or with one class only, every score is the share of positives (0 without labels).
    """
    texts, y = labelled.sample(docs, labels, label, fold, id_col, text_col, max_rows)
    none = np.array([float(y.mean()) if len(y) else 0.0])
    if not len(y) or y.min() == y.max():
        return Model(Lexicon(), None, none, none)
    a, b = len(y) // 2, len(y) * 8 // 10
    parts = [slice(0, a), slice(a, b), slice(b, len(y))]
    if any(len(set(y[p])) < 2 for p in parts):
        parts = [slice(0, len(y))] * 3
    words, grown, scaled = parts
    lexicon = learn_lexicon(texts.slice(words.start, words.stop - words.start), y[words])
    x = matrix(texts, lexicon)
    trees = Boosted().fit(x[grown], y[grown])
    at, rate = isotonic(trees.margin(x[scaled]), y[scaled])
    return Model(lexicon, trees, at, rate)


def score(docs: DataFrame, model: Model, out: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and the score of each row's whole text in the column `out` (which replaces one of that name).

    A null text scores as an empty one; equal texts score equally; ids are not used and may repeat or be null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    bare = docs.select(packed(docs, out).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([bare.schema["row"], T.StructField("out", T.DoubleType())])

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1, 8 << 20)):
            s = sent.value.score(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["row", "out"])

    return bare.mapInArrow(run, schema).select("row.*", F.col("out").alias(out))


def reject(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score is below the threshold, with all their columns."""
    out = free_name(docs, "__toxicity")
    return score(docs, model, out, text_col).where(F.col(out) < threshold).drop(out)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Per document: held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod("doc_id", FOLD[0]) == FOLD[1]).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
