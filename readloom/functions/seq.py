"""Sequence functions as column expressions; offsets are 0-based as in read layouts unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "TCGA"


def dna(col: Column) -> Column:
    """32 bases that stand for a value."""
    return F.translate(F.md5(col.cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT")


def cut(seq: Column, start: int, length: int | None = None) -> Column:
    return F.substring(seq, start + 1, length if length is not None else 1 << 30)


def letters(seq: Column) -> Column:
    return F.when(F.length(seq) > 0, F.split(seq, "")).otherwise(F.array().cast("array<string>"))


def hamming(a: Column, b: Column) -> Column:
    """Positions that differ, over the length of the shorter one."""
    n = F.least(F.length(a), F.length(b))
    same = F.zip_with(F.slice(letters(a), 1, n), F.slice(letters(b), 1, n), lambda x, y: (x != y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x)


def neighbours(seq: Column) -> Column:
    """All sequences at one substitution; with an N in it only the four that replace the first N."""
    n_at = F.locate("N", seq)
    at = lambda i, b: F.concat(F.substring(seq, F.lit(1), i - 1), b, F.substring(seq, i + 1, F.length(seq)))
    bases = F.array(*[F.lit(b) for b in BASES])
    every = F.flatten(F.transform(F.sequence(F.lit(1), F.length(seq)), lambda i: F.transform(F.filter(bases, lambda b: b != F.substring(seq, i, F.lit(1))), lambda b: at(i, b))))
    return F.when(n_at > 0, F.transform(bases, lambda b: at(n_at, b))).when(F.length(seq) > 0, every).otherwise(F.array().cast("array<string>"))


def neighbours_all(seq: Column) -> Column:
    """One-substitution neighbours at every position, an N anywhere being a base like others."""
    bases = F.array(*[F.lit(b) for b in BASES])
    at = lambda i, b: F.concat(F.substring(seq, F.lit(1), i - 1), b, F.substring(seq, i + 1, F.length(seq)))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(seq)), lambda i: F.transform(F.filter(bases, lambda b: b != F.substring(seq, i, F.lit(1))), lambda b: at(i, b))))


def with_n(seq: Column) -> Column:
    """The sequence with an N in each place: what reads whose first N may stand for it look like."""
    at = lambda i: F.concat(F.substring(seq, F.lit(1), i - 1), F.lit("N"), F.substring(seq, i + 1, F.length(seq)))
    return F.when(F.length(seq) > 0, F.transform(F.sequence(F.lit(1), F.length(seq)), at)).otherwise(F.array().cast("array<string>"))


def wildcards(seq: Column) -> Column:
    """array<struct<i, rest>>: the sequence without its i-th letter, for each i. Two of one length at distance 1 share exactly one."""
    at = lambda i: F.struct(i.alias("i"), F.concat(F.substring(seq, F.lit(1), i - 1), F.substring(seq, i + 1, F.length(seq))).alias("rest"))
    return F.when(F.length(seq) > 0, F.transform(F.sequence(F.lit(1), F.length(seq)), at)).otherwise(F.array().cast("array<struct<i:int,rest:string>>"))


def blocks(seq: Column, count: int) -> Column:
    """array<struct<i, n, piece>>: the sequence in `count` pieces of nearly equal length, the longer ones first, with its length."""
    n = F.length(seq)
    size, more = F.floor(n / count).cast("int"), (n % count).cast("int")
    piece = lambda i: F.struct(F.lit(i).alias("i"), n.alias("n"), F.substring(seq, F.lit(i) * size + F.least(F.lit(i), more) + 1, size + (F.lit(i) < more).cast("int")).alias("piece"))
    return F.array(*[piece(i) for i in range(count)])


def phred(qual: Column) -> Column:
    return F.transform(letters(qual), lambda c: F.ascii(c) - 33)


def mean_phred(qual: Column) -> Column:
    return F.aggregate(phred(qual), F.lit(0), lambda s, x: s + x) / F.greatest(F.length(qual), F.lit(1))


def base_code(base: Column) -> Column:
    """A 0, T and U 1, C 2, G 3, anything else 4."""
    return F.when(base == "A", 0).when(base.isin("T", "U"), 1).when(base == "C", 2).when(base == "G", 3).otherwise(4)


def is_poly(seq: Column) -> Column:
    return seq == F.repeat(F.substring(seq, 1, 1), F.length(seq))


def alteration(raw: Column, corrected: Column, same: str = "M") -> Column:
    """<position><old base> of each mismatch, `same` if there is none."""
    n = F.length(raw)
    marks = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(F.substring(raw, i, F.lit(1)) != F.substring(corrected, i, F.lit(1)), F.concat((i - 1).cast("string"), F.substring(raw, i, F.lit(1)))))
    found = F.array_join(F.filter(marks, lambda m: m.isNotNull()), "")
    return F.when(found == "", F.lit(same)).otherwise(found)


def undo_alteration(corrected: Column, alt: Column) -> Column:
    """The raw barcode that an alteration string was made from."""
    at = F.transform(F.regexp_extract_all(alt, F.lit(r"(\d+)([A-Z])"), F.lit(1)), lambda x: x.cast("int"))
    base = F.regexp_extract_all(alt, F.lit(r"(\d+)([A-Z])"), F.lit(2))
    marks = F.arrays_zip(at.alias("at"), base.alias("base"))
    put = lambda s, m: F.concat(F.substring(s, F.lit(1), m["at"]), m["base"], F.substring(s, m["at"] + 2, F.length(s)))
    return F.when(alt == "M", corrected).otherwise(F.aggregate(marks, corrected, put))


def structure(text: Column) -> Column:
    """array<struct<code,length>> of a read structure such as B8L10U8 (see chemistry.parse_structure)."""
    code, n = (F.regexp_extract_all(text, F.lit(r"([BLUXT])(\d+)"), F.lit(g)) for g in (1, 2))
    return F.zip_with(code, n, lambda c, k: F.struct(c.alias("code"), k.cast("int").alias("length")))


def read_structure(text: Column) -> Column:
    """bc:0:16,um:17:28 -> 17C12M+T; ends count, other parts than bc and um do not (see chemistry.read_structure)."""
    part = lambda p, i: F.get(F.split(p, ":"), F.lit(i))
    parts = F.filter(F.split(text, ","), lambda p: part(p, 0).isin("bc", "um"))
    parts = F.transform(parts, lambda p: F.struct(part(p, 1).cast("int").alias("first"), part(p, 2).cast("int").alias("last"), F.when(part(p, 0) == "bc", "C").otherwise("M").alias("code")))
    return F.concat(F.array_join(F.transform(F.array_sort(parts), lambda p: F.concat((p["last"] - p["first"] + 1).cast("string"), p["code"])), ""), F.lit("+T"))
