"""Approximate matching of adapters and leaders: one alignment table for a batch of reads, column by column in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "Y": "CT", "R": "AG", "N": "ACGT"}
READS = 2_000  # reads whose tables are filled side by side
ERROR = np.int64(1) << 32  # an error in a packed cell (errors, start of the match)


def coded(seqs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the sequences as a matrix, one column a sequence, zero behind their ends; and their lengths."""
    raw = [s.encode("ascii", "replace") for s in seqs]
    size = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((int(size.max(initial=0)), len(raw)), np.uint8)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    who = np.repeat(np.arange(len(raw)), size)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), who] = flat
    return out, size


def columns(letters: np.ndarray, pattern: str) -> Iterator[tuple[int, np.ndarray]]:
    """(j, cells) for each end j of a match: cells[i] packs the least errors of pattern[:i] against letters that end at j, and
    where they begin (the first place of equals). A match may begin anywhere."""
    accept = np.zeros((len(pattern), 256), bool)
    for i, c in enumerate(pattern):
        accept[i, [ord(x) for x in IUPAC.get(c, c)]] = True
    down = (np.arange(len(pattern) + 1, dtype=np.int64) * ERROR)[:, None]
    cells = np.repeat(down, letters.shape[1], 1)
    for j in range(letters.shape[0]):
        miss = ~accept[:, letters[j]]
        new = np.empty_like(cells)
        new[0] = j + 1
        np.minimum(cells[:-1] + miss * ERROR, cells[1:] + ERROR, out=new[1:])
        cells = np.minimum.accumulate(new - down, axis=0) + down  # gaps in the read: each step down costs an error
        yield j + 1, cells


def find_adapters(seqs: list[str], adapter: str, rate: float, overlap: int, front: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Best (start, end) of the adapter in each sequence, -1 without one: semi-global alignment with at most rate * matched length errors.

    A 3' adapter may run over the end of the read with `overlap` bases in it; most matched bases wins, then least errors,
    then the leftmost; for a 5' adapter the rightmost.
    """
    n, m = len(seqs), len(adapter)
    best, first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for lo in range(0, n, READS):
        letters, size = coded(seqs[lo : lo + READS])
        view = slice(lo, lo + letters.shape[1])
        for j, cells in columns(letters, adapter):
            for i in range(m if front else overlap, m + 1):
                live = (size >= j) if i == m else (size == j)
                if i < m and not live.any():
                    continue
                errors, start = cells[i] >> 32, cells[i] & (ERROR - 1)
                rank = ((i - errors) << 48) | ((m - errors) << 32) | (start if front else (1 << 31) - start)
                take = live & (errors <= rate * i) & (rank > best[view])
                best[view][take], first[view][take], last[view][take] = rank[take], start[take], j
    return first, last


def find_adapter(seq: str, adapter: str, rate: float, overlap: int, front: bool = False) -> tuple[int, int] | None:
    """find_adapters of one sequence."""
    first, last = find_adapters([seq], adapter, rate, overlap, front)
    return (int(first[0]), int(last[0])) if last[0] >= 0 else None


def trim(df: DataFrame, seq: str, adapters: list[tuple[str, str]], rate: float = 0.1, overlap: int = 9) -> DataFrame:
    """Adds kept and trimmed; adapters (bases, end 3 or 5) apply in the order of the list. A null sequence is an empty one."""

    ship(df.sparkSession)

    @F.pandas_udf("kept string, trimmed boolean")
    def run(s: pd.Series) -> pd.DataFrame:
        kept, hit = [x or "" for x in s], np.zeros(len(s), bool)
        for bases, end in adapters:
            first, last = find_adapters(kept, bases, rate, min(overlap, len(bases)), end == "5")
            for i in np.flatnonzero(last >= 0):
                kept[i] = kept[i][last[i] :] if end == "5" else kept[i][: first[i]]
            hit |= last >= 0
        return pd.DataFrame({"kept": kept, "trimmed": hit})

    return df.withColumn("__t", run(seq)).withColumn("kept", F.col("__t.kept")).withColumn("trimmed", F.col("__t.trimmed")).drop("__t")


def best_places(seqs: list[str], pattern: str, upto: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, start, end) of the pattern's best approximate occurrence in each sequence, the first end of equals; only the letters before `upto` count."""
    n, m = len(seqs), len(pattern)
    best, start, end = np.full(n, m, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for lo in range(0, n, READS):
        letters, size = coded(seqs[lo : lo + READS])
        view = slice(lo, lo + letters.shape[1])
        limit = size if upto is None else np.minimum(size, upto[view])
        for j, cells in columns(letters, pattern) if m else ():
            errors = cells[m] >> 32
            take = (limit >= j) & (errors < best[view])
            best[view][take], start[view][take], end[view][take] = errors[take], (cells[m] & (ERROR - 1))[take], j
    return best, start, end


def least_distance(text: str, pattern: str) -> tuple[int, int]:
    """(distance, end) of the pattern's best approximate occurrence in the text."""
    d, _, end = best_places([text], pattern)
    return int(d[0]), int(end[0])


def leaders(df: DataFrame, seq: str, found: list[tuple[str, str]], most: int = 3, call: str | None = None, before: str | None = None) -> DataFrame:
    """Adds leader, distance, leader_start and leader_end of the leader sequences (id, bases) within `most` errors.

    A perfect occurrence of a leader whose id names the contig's call (in the column `call`, up to a word's end; any id without it) is taken at once, in the
    order of the list; else the first of the least distance. Only what comes before the first occurrence of the text in `before` is
    searched; without such text, or without the text in the sequence, all of it. Nulls without a leader.
    """

    ship(df.sparkSession)

    @F.pandas_udf("leader string, distance int, leader_start int, leader_end int")
    def run(s: pd.Series, v: pd.Series, c: pd.Series) -> pd.DataFrame:
        seqs = [x or "" for x in s]
        n = len(seqs)
        at = [x.find(y) if y else -1 for x, y in zip(seqs, c)]
        upto = np.array([a if a >= 0 else len(x) for a, x in zip(at, seqs)], np.int64)
        calls = [re.compile(re.escape(x) + r"\b") if x else None for x in v]
        best, which = np.full(n, most + 1, np.int64), np.full(n, -1, np.int64)
        place = np.zeros((2, n), np.int64)
        done = np.zeros(n, bool)
        for k, (name, bases) in enumerate(found):
            d, start, end = best_places(seqs, bases, upto)
            named = np.array([p is None or p.search(name) is not None for p in calls]) if n else done
            take = ~done & (((d == 0) & named) | (d < best)) & (d <= most) & (end > 0)
            best[take], which[take] = d[take], k
            place[:, take] = start[take], end[take]
            done |= take & (d == 0) & named
        ok = which >= 0
        number = lambda x: pd.Series(x).where(ok).astype("Int32")
        return pd.DataFrame({"leader": [found[k][0] if k >= 0 else None for k in which], "distance": number(best), "leader_start": number(place[0]), "leader_end": number(place[1])})

    none = F.lit(None).cast("string")
    d = df.withColumn("__l", run(seq, F.col(call) if call else none, F.col(before) if before else none))
    return d.select(*df.columns, "__l.*")


def regions(df: DataFrame, seq: str, parts: list[str]) -> DataFrame:
    """Adds <part>_start for sequences given in columns, each searched behind the one before; 0 where it or an earlier one is absent."""
    at: Column = F.lit(1)
    for p in parts:
        df = df.withColumn("__from", at)
        found = F.when(F.length(p) == 0, F.col("__from")).otherwise(F.expr(f"locate({p}, {seq}, __from)"))
        df = df.withColumn(f"{p}_start", F.when(F.col("__from") > 0, found).otherwise(0))
        at = F.when(F.col(f"{p}_start") > 0, F.col(f"{p}_start") + F.length(p)).otherwise(0)
    return df.drop("__from")


#: Fixed values of the methylation layout: bases dropped at an adapter, start without one, longest insert, least length.
DROP, START, LONGEST, LEAST = 9, 52, 81, 18


def methyl_trim(df: DataFrame, r1: str, r2: str, adapter: str, reverse: str) -> DataFrame:
    """Adds r1_kept and r2_kept.

    r1: behind the adapter and DROP more bases, else from START; where the reverse adapter lies, up to DROP bases before it;
    then at most LONGEST bases, empty unless more than LEAST are left. r2: without its first DROP bases, and up to DROP
    bases before the reverse adapter.
    """

    ship(df.sparkSession)

    @F.pandas_udf("a string, b string")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        one, two = [v or "" for v in x], [v or "" for v in y]
        _, last = find_adapters(one, adapter, 0.1, DROP)
        kept = [v[e + DROP :] if e >= 0 else v[START:] for v, e in zip(one, last)]
        first, _ = find_adapters(kept, reverse, 0.1, DROP)
        kept = [(v[: max(0, b - DROP)] if b >= 0 else v)[:LONGEST] for v, b in zip(kept, first)]
        first, _ = find_adapters(two, reverse, 0.1, DROP)
        two = [(v[: max(0, b - DROP)] if b >= 0 else v)[DROP:] for v, b in zip(two, first)]
        return pd.DataFrame({"a": [v if len(v) > LEAST else "" for v in kept], "b": two})

    return df.withColumn("__m", run(r1, r2)).withColumn("r1_kept", F.col("__m.a")).withColumn("r2_kept", F.col("__m.b")).drop("__m")
