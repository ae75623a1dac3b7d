"""Secret scans: fixed patterns, and a battery of randomness tests under length-aware false-discovery control.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, settle, table, text_of, tidy

_EITHER = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
_WORDS = "|".join(_EITHER(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: kind, pattern, group whose length counts, least length of that group
BASE = [
    ("assign", rf"({_WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # a run of at least 24 is what is left of [0-9a-f]+
]
KINDS = [k for k, *_ in BASE] + ["random"]
LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"
FDR = 0.01
BINS = 400  # tenths of a decade of p that are told apart
TYPICAL = 32.0  # characters of a token of weight 1 before the weights are scaled to mean 1
#: The null hypothesis. Coincidence of letters: the known index of English prose, which German, French and Spanish exceed;
#: of hexadecimal runs in structured text (counters, dates, padded numbers) it is taken as 0.12, twice that of random ones. A change of character
#: class once in eight places and a serial correlation of 0.3 are bounds that hyphenated words, paths, numbered names and dates keep.
COINCIDENCE, COINCIDENCE_HEX, CHANGES, SERIAL = 0.066, 0.12, 0.125, 0.3
SPAN = "struct<kind:int,start:bigint,end:bigint>"


def running(lengths: Column) -> Column:
    """Sums of the elements before each element, by blocks of about the square root of their number."""
    n = F.size(lengths)
    step = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / step).cast("int")), lambda i: F.slice(lengths, i * step + 1, step))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    grow = lambda a, first: F.aggregate(a, F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out")), lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
    heads = grow(F.transform(blocks, total), F.lit(0).cast("long"))
    return F.when(n > 0, F.flatten(F.zip_with(blocks, heads, lambda b, h: grow(b, h)))).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start,end,part>> of the leftmost non-overlapping matches, in code points; part is the group's text.

    Spark gives the matches and, by split, what lies between them; their lengths give the positions. A text without a match is
    scanned once.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(between, whole, lambda b, w: F.struct(F.length(b).cast("long").alias("gap"), F.length(w).cast("long").alias("n")))
    pairs = F.filter(pairs, lambda x: x["n"].isNotNull())
    before = running(F.transform(pairs, lambda x: x["gap"] + x["n"]))
    found = F.zip_with(F.zip_with(before, pairs, lambda at, x: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["n"]).alias("end"))), part, lambda s, p: F.struct(s["start"].alias("start"), s["end"].alias("end"), p.alias("part")))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,part:string>>"))


def left_of(run: Column, base: Column) -> Column:
    """array<struct<start,end,part>>: the pieces of at least LEAST characters that the base spans, sorted by start, leave of a run."""
    touching = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    piece = lambda lo, hi: F.struct(lo.alias("start"), hi.alias("end"), F.substring(run["part"], (lo - run["start"] + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int")).alias("part"))
    first = F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,part:string>>").alias("out"))
    cut = F.aggregate(touching, first, lambda s, b: F.struct(F.greatest(s["at"], b["end"]).alias("at"), F.concat(s["out"], F.array(piece(s["at"], b["start"]))).alias("out")), lambda s: F.concat(s["out"], F.array(piece(s["at"], run["end"]))))
    return F.when(F.size(touching) == 0, F.array(piece(run["start"], run["end"]))).otherwise(F.filter(cut, lambda p: p["end"] - p["start"] >= LEAST))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by the rational approximation 26.2.17 of Abramowitz and Stegun."""
    a = F.least(F.abs(z), F.lit(12.0))
    t = 1 / (1 + 0.2316419 * a)
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(token: Column) -> Column:
    """Bin of the length-weighted p-value of a token under the hypothesis that it is natural or structured text.

    The encoding is the smallest alphabet (hex, one case of letters, base32, letters, alphanumeric, base64) that holds the token. Against it,
    with n characters: (1) chi-squared distance from uniform use of the alphabet, which for natural text has
    the mean df + n * (K * coincidence - 1) and for random text df; (2) runs of one character class, which
    change in natural text after about one character in eight; (3) serial correlation of neighbouring
    character codes, of which structured text has 0.3 or more. The z values count equally. A token without digits
    is tested by (1) and (3) only: paths and joined capitalised words change class as often as random letters. The p-value
    is divided by n / TYPICAL: long tokens, which the tests tell apart well, get more of the error budget. scan scales these weights
    to mean 1 over all candidates, as weighted Benjamini-Hochberg control asks.
    """
    n = F.length(token).cast("double")
    size = F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(16.0)).when(token.rlike("^([a-z]+|[A-Z]+)$"), F.lit(26.0)).when(token.rlike("^[A-Z2-7]+$"), F.lit(32.0)).when(token.rlike("^[A-Za-z]+$"), F.lit(52.0)).when(token.rlike("^[A-Za-z0-9]+$"), F.lit(62.0)).otherwise(F.lit(64.0))
    coincidence = F.when(size == 16, F.lit(COINCIDENCE_HEX)).otherwise(F.lit(COINCIDENCE))
    letters = F.split(token, "")
    squares = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda s, c: s + F.pow(F.length(token) - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
    chi, df, extra = size / n * squares - n, size - 1, n * (size * coincidence - 1)
    z_chi = (df + extra - chi) / F.sqrt(2 * (df + 2 * extra))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[0-9]", "#"), "[A-Z]", "U"), "[a-z]", "l"), "[+/_-]", "/")
    changes = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1.0
    z_runs = (changes - (n - 1) * CHANGES) / F.sqrt((n - 1) * CHANGES * (1 - CHANGES))
    codes = F.transform(letters, lambda c: F.ascii(c).cast("double"))
    mean = F.aggregate(codes, F.lit(0.0), lambda s, x: s + x) / n
    spread = F.aggregate(codes, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    shared = F.aggregate(F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda x, y: (x - mean) * (y - mean)), F.lit(0.0), lambda s, x: s + x)
    z_serial = (SERIAL - F.abs(F.when(spread > 0, shared / spread).otherwise(F.lit(1.0)))) * F.sqrt(n)
    z = F.when(~token.rlike("[0-9]"), (z_chi + z_serial) / 1.4142135623730951).otherwise((z_chi + z_runs + z_serial) / 1.7320508075688772)
    p = upper_tail(z) * TYPICAL / n
    return F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300)))).cast("int")))


def threshold(counts: dict[int, int], length: int, fdr: float) -> int:
    """The least bin that passes Benjamini-Hochberg over the candidates, counted per bin; `length` is the sum of their lengths.

    The bins hold p * TYPICAL / n; weights n / mean(n) have mean 1, so a bin's p-value is 10 ** (-bin / 10) * mean(n) / TYPICAL, 1 at most.
    """
    total, ahead, limit = sum(counts.values()), 0, BINS + 1
    for b in range(BINS, -1, -1):
        ahead += counts.get(b, 0)
        if ahead and min(1.0, 10 ** (-b / 10) * length / total / TYPICAL) <= fdr * ahead / total:
            limit = b
    return limit


@tidy
def scan(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, fdr: float = FDR) -> DataFrame:
    """(row, spans): the columns of `carry` as a struct, and all spans as array<kind,start,end> sorted by start, then kind.

    Kinds are numbers into KINDS. Base spans are the matches of BASE, leftmost and not overlapping within a
    kind, whose group is long enough. A further span, of kind random, is a run of CANDIDATE characters, or what base
    spans leave of one if it is still LEAST long, whose weighted p-value passes the Benjamini-Hochberg
    threshold at `fdr` over the candidates of all documents. The threshold is found on a histogram of
    BINS + 1 bins with each p-value rounded up, so it never lets more through. Null and empty texts have no spans.
    Positions count code points; ends are exclusive.
    """
    t = F.col("text")
    rows = docs.select(F.struct(*[column(c).alias(c) for c in (carry or [])], F.lit(True).alias("__row")).alias("row"), text_of(text_col).alias("text"))
    for k, (name, pattern, group, least) in enumerate(BASE):
        number, short = F.lit(k), F.lit(least)  # a lambda's second parameter would be the index
        kept = F.filter(matches(t, pattern, group), lambda m: F.length(m["part"]) >= short)  # noqa: B023
        rows = rows.withColumn(name, F.transform(kept, lambda m: F.struct(number.alias("kind"), m["start"].alias("start"), m["end"].alias("end"))))  # noqa: B023
    rows = rows.withColumn("base", F.array_sort(F.concat(*[F.col(n) for n, *_ in BASE]), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["kind"] - b["kind"])))
    runs = F.flatten(F.transform(matches(t, CANDIDATE), lambda m: left_of(m, F.col("base"))))
    rows = rows.withColumn("tested", F.transform(runs, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), battery(m["part"]).alias("bin"))))
    rows = settle(rows.select("row", "base", "tested"), keep=True)
    each = rows.select(F.explode("tested").alias("x"))
    per = each.groupBy("x.bin").agg(F.count("*").alias("n"), F.sum(F.col("x.end") - F.col("x.start")).alias("length")).collect()  # BINS + 1 rows at most
    limit = threshold({r.bin: r.n for r in per}, sum(r.length for r in per), fdr)
    picked = F.transform(F.filter("tested", lambda x: x["bin"] >= limit), lambda x: F.struct(F.lit(len(BASE)).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    spans = F.array_sort(F.concat("base", picked), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["kind"] - b["kind"]))
    return rows.select("row", "base", spans.alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows of `docs` with each run of overlapping spans in the text replaced by the mark; all columns stay.

    A text without spans is left as it is, a null text stays null.
    """
    found = scan(docs, text_col, carry=docs.columns)
    text = text_of(F.col("row")[text_col])
    step = lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(x["end"].alias("at"), F.concat(s["out"], F.when(x["start"] < s["at"], F.lit("")).otherwise(F.concat(F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark)))).alias("out")))
    clean = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    new = F.when(F.size("spans") > 0, clean).otherwise(F.col("row")[text_col])
    return found.select(*[(new if c == text_col else column(c, "row")).alias(c) for c in docs.columns])


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("row.doc_id", *[count(k).alias(f"n_{n}") for k, (n, *_) in enumerate(BASE)], F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))


def _found(kind: int, pattern: str, group: int, least: int) -> str:
    """SQL of the matches of a pattern and of what lies between them."""
    p = pattern.replace("'", "''")
    return f"select doc_id, {kind} as kind, {least} as least, regexp_extract_all(t, '{p}', 0) as w, regexp_extract_all(t, '{p}', {group}) as part, string_split_regex(t, '{p}') as b from d"


_FOUND = " union all ".join([_found(k, *x[1:]) for k, x in enumerate(BASE)] + [_found(9, CANDIDATE, 0, 0)])
ORACLE = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
found as ({_FOUND}),
u as (select doc_id, kind, least, unnest(w) as w, unnest(part) as part, unnest(b[1:len(w)]) as gap, unnest(range(1, len(w) + 1)) as i from found where len(w) > 0),
placed as (select *, cast(coalesce(sum(length(gap) + length(w)) over (partition by doc_id, kind order by i rows between unbounded preceding and 1 preceding), 0) as bigint) + length(gap) as a from u),
spans as (select doc_id, kind, a, a + length(w) as z, w from placed where length(part) >= least),
base as (select doc_id, kind, a, z from spans where kind < 9),
runs as (select doc_id, a, z, w from spans where kind = 9),
hit as (select r.doc_id, r.a, r.z, r.w, b.a as ba, b.z as bz, greatest(r.a, coalesce(max(b.z) over (partition by r.doc_id, r.a order by b.a, b.kind rows between unbounded preceding and 1 preceding), r.a)) as at_, max(b.z) over (partition by r.doc_id, r.a) as far from runs r join base b on b.doc_id = r.doc_id and b.a < r.z and r.a < b.z),
cand as (select doc_id, a, z, w as tok from runs where not exists (select 1 from hit where hit.doc_id = runs.doc_id and hit.a = runs.a)
  union all select doc_id, at_, ba, substr(w, at_ - a + 1, ba - at_) from hit where ba - at_ >= {LEAST}
  union all select distinct doc_id, greatest(a, far), z, substr(w, greatest(a, far) - a + 1, z - greatest(a, far)) from hit where z - greatest(a, far) >= {LEAST}),
c1 as (select *, cast(length(tok) as double) as n, string_split(tok, '') as ch, cast(case when regexp_full_match(tok, '[0-9a-f]+|[0-9A-F]+') then 16 when regexp_full_match(tok, '[a-z]+|[A-Z]+') then 26 when regexp_full_match(tok, '[A-Z2-7]+') then 32 when regexp_full_match(tok, '[A-Za-z]+') then 52 when regexp_full_match(tok, '[A-Za-z0-9]+') then 62 else 64 end as double) as size from cand),
c2 as (select *, case when size = 16 then {COINCIDENCE_HEX} else {COINCIDENCE} end as co, list_sum(list_transform(list_distinct(ch), lambda x: cast(pow(len(list_filter(ch, lambda y: y = x)), 2) as double))) as sq,
  list_transform(ch, lambda x: case when x between '0' and '9' then 1 when x between 'A' and 'Z' then 2 when x between 'a' and 'z' then 3 else 4 end) as cls, list_transform(ch, lambda x: cast(ascii(x) as double)) as codes from c1),
c3 as (select *, size / n * sq - n as chi, size - 1 as df, n * (size * cast(co as double) - 1) as extra, cast(len(list_filter(list_zip(cls[1:len(cls) - 1], cls[2:]), lambda p: p[1] <> p[2])) as double) as changes, list_sum(codes) / n as mean from c2),
c4 as (select *, list_sum(list_transform(codes, lambda x: (x - mean) * (x - mean))) as spread, list_sum(list_transform(list_zip(codes[1:len(codes) - 1], codes[2:]), lambda p: (p[1] - mean) * (p[2] - mean))) as shared from c3),
c5 as (select *, (df + extra - chi) / sqrt(2 * (df + 2 * extra)) as z1, (changes - (n - 1) * {CHANGES}e0) / sqrt((n - 1) * {CHANGES}e0 * (1 - {CHANGES}e0)) as z2, ({SERIAL}e0 - abs(case when spread > 0 then shared / spread else 1 end)) * sqrt(n) as z3 from c4),
c6 as (select *, case when not regexp_matches(tok, '[0-9]') then (z1 + z3) / 1.4142135623730951e0 else (z1 + z2 + z3) / 1.7320508075688772e0 end as zz from c5),
c7 as (select *, least(abs(zz), 12e0) as x, 1 / (1 + 0.2316419e0 * least(abs(zz), 12e0)) as k from c6),
c8 as (select *, exp(-x * x / 2) * 0.3989422804014327e0 * k * (0.319381530e0 + k * (-0.356563782e0 + k * (1.781477937e0 + k * (-1.821255978e0 + k * 1.330274429e0)))) as tail from c7),
c9 as (select doc_id, a, z, n, cast(greatest(0, least({BINS}, floor(-10 * log10(greatest((case when zz >= 0 then tail else 1 - tail end) * {TYPICAL} / n, 1e-300))))) as integer) as bin from c8),
per as (select bin, count(*) as m, sum(n) as length from c9 group by bin),
tot as (select cast(sum(m) as double) as total, cast(sum(length) as double) as length from per),
ahead as (select bin, cast(sum(m) over (order by bin desc) as double) as ahead from per),
lim as (select min(bin) as lim from ahead, tot where least(1.0, pow(10, -bin / 10.0) * length / total / {TYPICAL}) <= {FDR}e0 * ahead / total),
every as (select doc_id, kind, a, z from base union all select doc_id, 3, a, z from c9, lim where bin >= lim),
txt as (select doc_id, string_agg(['assign', 'access', 'hex', 'random'][kind + 1] || ':' || a || ':' || z, ',' order by a, kind) as spans, coalesce(string_agg(['assign', 'access', 'hex', 'random'][kind + 1] || ':' || a || ':' || z, ',' order by a, kind) filter (kind < 3), '') as base,
  count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex from every group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join txt using (doc_id)
"""
