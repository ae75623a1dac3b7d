"""Dense numeric features of texts, computed over whole Arrow buffers with numpy."""

from __future__ import annotations

import numpy as np

from .common import BYTE_CODE, doc_sums, mix64, powers, rolling, span_hash, spaces, word_spans

_B = np.arange(256)
UPPER = (_B >= 65) & (_B <= 90)
LOWER = (_B >= 97) & (_B <= 122)
DIGIT = (_B >= 48) & (_B <= 57)
HIGH = _B >= 128
PUNCT = ((_B >= 33) & (_B < 127)) & ~UPPER & ~LOWER & ~DIGIT
STOPS = np.isin(_B, [ord(c) for c in ".,;:?"])
BANGS = _B == ord("!")
SYMBOLS = PUNCT & ~STOPS & ~BANGS & ~np.isin(_B, [ord(c) for c in "'\"-()"])
FOLDED = np.where(UPPER, _B + 32, _B).astype(np.uint8)
KEPT = UPPER | LOWER | DIGIT | HIGH
#: Signs that stand in for letters in disguised words.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
PLAIN = FOLDED.copy()
for _sign, _letter in DISGUISE.items():
    PLAIN[ord(_sign)] = ord(_letter)
PLAIN_KEPT = KEPT | np.isin(_B, [ord(c) for c in DISGUISE])
SIGNS = np.isin(_B, [ord(c) for c in DISGUISE])


def folded_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = FOLDED, kept: np.ndarray = KEPT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words with ASCII case folded and other signs left out, and how many bytes they keep."""
    keep = kept[data]
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.where(keep, BYTE_CODE[fold[data]] * up[place[:-1]], np.uint64(0)), out=prefix[1:])
    size = place[ends] - place[starts]
    return mix64((prefix[ends] - prefix[starts]) * down[place[starts]] + size.astype(np.uint64)), size


def word_hash(word: str) -> int:
    """The hash that folded_hashes gives to a word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(folded_hashes(data, np.array([0]), np.array([len(data)]))[0][0])


NAMES = ["log_bytes", "log_words", "word_bytes", "word_spread", "upper", "caps_words", "digits", "high", "stops", "bangs", "symbols", "signed_words", "spaces", "lines", "line_words", "distinct", "top_word", "repeated_lines", "one_letter", "long_words", "initials", "bare_words", "echoes"]


def repeats(docs: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: items, distinct items, and the count of its most frequent item."""
    total = np.bincount(docs, minlength=n)
    if not len(docs):
        return total, total.copy(), total.copy()
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(docs[order], kind="stable")]
    d, h = docs[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])]))
    runs = np.diff(np.concatenate([first, [len(d)]]))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, d[first], runs)
    return total, np.bincount(d[first], minlength=n), most


def dense(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The features NAMES of each text (rows); an empty text has zeros."""
    n = len(off) - 1
    size = np.diff(off)
    per = lambda table: doc_sums(table[data], off)
    starts, ends = word_spans(data, off)
    doc = (np.searchsorted(off, starts, "right") - 1).astype(np.int64)
    # empty texts share an offset with the next one; searchsorted gives the last of them, which is the one with bytes
    words = np.bincount(doc, minlength=n)
    length = ends - starts
    cum = lambda table: np.concatenate([[0], np.cumsum(table[data])])
    up, low, sym = cum(UPPER), cum(LOWER), cum(SYMBOLS)
    w_up, w_low, w_sym = up[ends] - up[starts], low[ends] - low[starts], sym[ends] - sym[starts]
    of = lambda mask: np.bincount(doc, weights=mask, minlength=n)
    nw, nb = np.maximum(words, 1), np.maximum(size, 1)
    letters = np.maximum(per(UPPER) + per(LOWER), 1)
    mean = of(length) / nw
    spread = np.sqrt(np.maximum(of(length.astype(float) ** 2) / nw - mean**2, 0))
    hashes = folded_hashes(data, starts, ends)[0]
    _, distinct, most = repeats(doc, hashes, n)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    brk = data == 10
    line_end = np.flatnonzero(brk | edge[1:][: len(data)]) + 1 if len(data) else np.zeros(0, np.int64)
    line_start = np.concatenate([[0], line_end[:-1]]) if len(line_end) else line_end
    line_doc = np.searchsorted(off, line_start, "right") - 1
    trim = line_end - brk[line_end - 1]
    solid = trim > line_start
    line_hash = span_hash(rolling(BYTE_CODE[data]), line_start[solid], trim[solid])
    lines, line_kinds, _ = repeats(line_doc[solid], line_hash, n)
    initial = UPPER[data[starts]] if len(starts) else np.zeros(0, bool)
    echo = np.zeros(len(starts), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    out = [np.log1p(size), np.log1p(words), mean, spread, per(UPPER) / letters, of((w_up >= 2) & (w_low == 0)) / nw, per(DIGIT) / nb, per(HIGH) / nb, per(STOPS) / nw, per(BANGS) / nw, per(SYMBOLS) / nw, of(w_sym > 0) / nw, doc_sums(spaces(data), off) / nb, lines / nw, np.log1p(words / np.maximum(lines, 1)), distinct / nw, most / nw, 1 - line_kinds / np.maximum(lines, 1), of(length == 1) / nw, of(length >= 12) / nw, of(initial) / nw, of(w_up + w_low == 0) / nw, of(echo) / nw]
    return np.where(size[:, None] > 0, np.column_stack(out), 0.0)
