"""Removal of repeated runs of words, found through anchors at the positions of a difference cover.

A window is a run of `span` words. Every difference modulo the period is that of two positions of its cover, so two equal
windows, wherever they start, hold one pair of anchors (runs of span - period + 1 words) that lie at cover positions of both
documents and at one distance from both starts. Only runs at cover positions are hashed: 4 of 13 for windows of 20 words.

An anchor is then extended to its context, the words of all windows that hold it. All anchors are sorted over all tasks by
anchor, context and place. One that stands behind another with its context is settled: every window that holds it occurs
earlier. Of the others only the first of each context, where an anchor has several contexts, can still be part of a match
(on the border of a repeated passage). Their windows, each once, are sorted in the same way by all their words. Anchors and
contexts, and windows, are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, find_package, mix64, pieces, rolling, settle, slices, span_hash, table, text_of, tidy, word_spans

SPAN = 20
#: Perfect difference sets by their period; each difference is that of exactly one pair.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
PIECE = 1 << 20  # bytes whose words are hashed at once
OTHER = np.uint64(0xD6E8FEB86659FD93)  # added to a word's code, it gives the code of the second hash
LOW = np.int64((1 << 32) - 1)


def period_for(span: int) -> int:
    """The largest period that leaves a third of a window to the anchor."""
    if span < 5:
        raise ValueError("windows have five words at least")
    return max(p for p in COVERS if 3 * p <= 2 * span)


def word_codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the words of a run of texts, and where the words of each text begin and end among them."""
    starts, ends = word_spans(data, off)
    codes, lo = np.empty(len(starts), np.uint64), 0
    while lo < len(starts):
        a = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, a + PIECE, "right")))
        codes[lo:hi] = span_hash(rolling(BYTE_CODE[data[a : ends[hi - 1]]]), starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return codes, np.searchsorted(starts, off)


def second(codes: np.ndarray) -> np.ndarray:
    return rolling(mix64(codes + OTHER))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def alike(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Where two arrays are equal; nulls are."""
    return pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y))).to_numpy(zero_copy_only=False)


def place_of(pos: np.ndarray, twin: np.ndarray) -> pa.Array:
    return pa.array((pos.astype(np.int64) << 32) | twin.astype(np.int64))


def places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, twin): twin tells texts of one id apart, in 32 bits."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).bitwiseAND(F.lit(int(LOW))).alias("twin"))


def anchored(texts: DataFrame, kind: str, span: int) -> DataFrame:
    """(id, text, twin) -> (a, b, id, place): fingerprints of each anchor and its context, and place = (word, twin)."""
    period = period_for(span)
    size, reach = span - period + 1, period - 1
    covered = np.isin(np.arange(period), COVERS[period])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            twin = batch.column(2).to_numpy()
            for lo, hi, data, off in slices(batch.column(1)):
                codes, first = word_codes(data, off)
                n = np.diff(first)
                doc = np.repeat(np.arange(hi - lo), n)
                pos = np.arange(len(codes)) - first[doc]
                at = np.flatnonzero(covered[pos % period] & (pos + size <= n[doc]) & (n[doc] >= span))
                doc, pos = doc[at], pos[at]
                left = np.minimum(pos, reach)
                context = span_hash(second(codes), at - left, at + np.minimum(n[doc] - pos, span))
                context = mix64(context + left.astype(np.uint64) * OTHER)
                anchor = span_hash(rolling(codes), at, at + size)
                yield pa.RecordBatch.from_arrays([signed(anchor), signed(context), batch.column(0).take(pa.array(doc + lo)), place_of(pos, twin[lo + doc])], ["a", "b", "id", "place"])

    return texts.mapInArrow(run, f"a long, b long, id {kind}, place long")


def behind(rows: DataFrame, kind: str, firsts: bool) -> DataFrame:
    """(a, b, id, place) -> (id, place, later, edge, a, b), of rows sorted over all tasks.

    later: the row stands behind the first of its (a, b); rows of that first's id and word are as early as it is. `edge` rows
    are first in what their task saw of an (a, b) that may go on beyond it; only they have a and b. With `firsts`, the
    other first rows of a's that have several b's come too. A row that is repeated comes once.
    """
    order = ["a", "b", "id", "place"]
    names = ["id", "place", "later", "edge", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # a and b of the row before, and the id and word of the first row that had them
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b, place = (batch.column(i).to_numpy() for i in (0, 1, 3))
            ids, pos = batch.column(2), place >> 32
            new = np.ones(n, bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            new[0] = last is None or a[0] != last[0] or b[0] != last[1]
            starts, group = np.flatnonzero(new), np.cumsum(new)  # group 0 goes on from the batch before
            lead = np.where(group == 0, 0, np.concatenate([[0], starts + 1])[group])
            known = pa.concat_arrays([ids.slice(0, 1) if last is None else last[2], ids])
            one = known.take(pa.array(lead))
            later = ~(alike(ids, one) & (pos == np.concatenate([[0 if last is None else last[3]], pos])[lead]))
            of = np.concatenate([[0 if last is None else last[0]], a[starts]])  # the a of each group
            several = np.zeros(len(of) + 1, bool)
            again = of[1:] == of[:-1]
            again[:1] &= last is not None
            several[1:-1] |= again
            several[:-2] |= again
            edge = np.zeros(len(of), bool)
            edge[-1] = len(starts) > 0  # what follows is not known yet
            if last is None:
                edge[1] = True
            edge_row = edge[group] & ~later
            fresh = np.ones(n, bool)  # not the row before once more
            fresh[1:] = new[1:] | (place[1:] != place[:-1]) | ~alike(ids.slice(1), ids.slice(0, n - 1))
            out = np.flatnonzero(fresh & (later | edge_row | (several[group] & firsts)))
            take, seen = pa.array(out), pa.array(~edge_row[out])
            yield pa.RecordBatch.from_arrays([ids.take(take), pa.array(place[out]), pa.array(later[out]), pa.array(edge_row[out]), *[pc.if_else(seen, pa.scalar(None, pa.int64()), pa.array(x[out])) for x in (a, b)]], names)
            last = a[-1], b[-1], known.slice(int(lead[-1]), 1), int(np.concatenate([[0 if last is None else last[3]], pos])[lead[-1]])

    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(run, f"id {kind}, place long, later boolean, edge boolean, a long, b long")


def spread(pos: np.ndarray, text: np.ndarray, first: np.ndarray, span: int, reach: int) -> np.ndarray:
    """Which windows, by the word they start at, hold an anchor at `pos` of `text`; first as word_codes gives it."""
    n = np.diff(first)[text]
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(edge, first[text] + np.maximum(pos - reach, 0), 1)
    np.add.at(edge, first[text] + np.minimum(pos, n - span) + 1, -1)
    return np.cumsum(edge)[:-1] > 0


def windows(texts: DataFrame, kind: str, span: int) -> DataFrame:
    """(id, text, twin, marks) -> (a, b, id, place): the windows of open anchors that no settled one holds, by two hashes of their words.

    A mark is twice an anchor's word, plus one if it is settled.
    """
    reach = period_for(span) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in pieces(whole, 1)):
            twin, base = batch.column(2).to_numpy(), 0
            marks = batch.column(3)
            count = pc.list_value_length(marks).to_numpy(zero_copy_only=False)
            mark, whose = marks.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), count)
            for lo, hi, data, off in slices(batch.column(1)):
                codes, first = word_codes(data, off)
                end = base + int(count[lo:hi].sum())
                text, pos, done = whose[base:end] - lo, mark[base:end] >> 1, (mark[base:end] & 1) > 0
                base = end
                todo = spread(pos[~done], text[~done], first, span, reach) & ~spread(pos[done], text[done], first, span, reach)
                at = np.flatnonzero(todo)
                doc = np.searchsorted(first, at, "right") - 1
                one, two = (span_hash(x, at, at + span) for x in (rolling(codes), second(codes)))
                yield pa.RecordBatch.from_arrays([signed(one), signed(two), batch.column(0).take(pa.array(doc + lo)), place_of(at - first[doc], twin[lo + doc])], ["a", "b", "id", "place"])

    return texts.mapInArrow(run, f"a long, b long, id {kind}, place long")


def by_text(rows: DataFrame) -> DataFrame:
    """(id, place, mark) -> (id, twin, marks), a row for each text that has any."""
    twin = F.col("place").bitwiseAND(F.lit(int(LOW))).alias("twin")
    return rows.groupBy("id", twin).agg(F.collect_list("mark").alias("marks"))


def word_of(place: str = "place") -> Column:
    return F.shiftright(place, 32)


def with_marks(texts: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """(id, text, twin, marks): a hash join on the marks, so that the texts are shuffled but not sorted; ids may be null."""
    m = marks.select(F.col("id").alias("m_id"), F.col("twin").alias("m_twin"), "marks").hint("shuffle_hash")
    return texts.join(m, texts.id.eqNullSafe(m.m_id) & (texts.twin == m.m_twin), how).select("id", "text", "twin", "marks")


@tidy
def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(id, n_words, spans, kept): per document its words, the spans [start, end) of words to remove, and what remains, joined by one space.

    Words are runs of bytes other than ASCII white space. Removed is each word that lies in a window of `span` words whose sequence
    also starts earlier: in a document with a smaller id (null first), or in the same document at an earlier word. Windows are judged on
    the input and do not cross documents. A null text has no words; texts shorter than a window keep all of theirs. Rows of
    one id are one place each: none is earlier than the other at one word, so repeated rows lose the same words, and those of the
    first copy of a text stay in all rows of its id.
    """
    find_package(docs.sparkSession)
    kind, texts = docs.schema[id_col].dataType.simpleString(), places(docs, id_col, text_col)
    reach = period_for(span) - 1
    found = settle(behind(anchored(texts, kind, span), kind, True).select("id", "place", "later"))
    marks = found.select("id", "place", (2 * word_of() + F.col("later").cast("long")).alias("mark"))
    open_ = by_text(marks).where(F.exists("marks", lambda m: m % 2 == 0))
    rows = settle(windows(with_marks(texts, open_, "inner"), kind, span))
    second_ = settle(behind(rows, kind, False))
    edges = second_.where("edge").select("a", "b", "id", "place", F.struct("id", word_of().alias("word")).alias("at"))
    least = edges.groupBy("a", "b").agg(F.min("at").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    late = second_.where("later").select("id", "place").unionByName(edges.join(least, ["a", "b"]).where(F.col("at") > F.col("least")).select("id", "place"))
    # of the marks now, even ones are settled anchors, odd ones windows
    all_marks = found.where("later").select("id", "place", (2 * word_of()).alias("mark")).unionByName(late.select("id", "place", (2 * word_of() + 1).alias("mark")))
    removed = settle(by_text(all_marks), keep=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in pieces(whole, 1)):
            size, spans, kept = [], [], []
            for text, marks in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(3)):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                if marks.is_valid:
                    mark = marks.values.to_numpy()
                    pos, window = mark >> 1, (mark & 1) > 0
                    np.add.at(gone, np.where(window, pos, np.maximum(pos - reach, 0)), 1)
                    np.add.at(gone, np.where(window, pos, np.minimum(pos, len(words) - span)) + span, -1)
                left = np.cumsum(gone)[:-1] == 0
                edge = np.flatnonzero(np.diff(np.concatenate([[1], left.astype(np.int8), [1]])))
                size.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()])
                kept.append(b" ".join(compress(words, left.tolist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "spans", "kept"])

    return with_marks(texts, removed, "left").mapInArrow(run, f"id {kind}, n_words long, spans array<struct<start:long,end:long>>, kept string")


def op11_substrings(spark, sf_dir: str) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256."""
    out = dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
x as (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d),
k as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as k from x),
late as (select doc_id, i from (select doc_id, i, row_number() over (partition by k order by doc_id, i) as r from k) where r > 1),
gone as (select distinct doc_id, i + j as i from late, range(20) r(j)),
words as (select doc_id, unnest(w) as w, unnest(range(1, len(w) + 1)) as i from d),
kept as (select doc_id, string_agg(w, ' ' order by i) as kept from words anti join gone using (doc_id, i) group by doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id) left join n using (doc_id)
"""
