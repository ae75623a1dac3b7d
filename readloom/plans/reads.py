"""Read-level queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..chemistry import Chemistry, five_prime, parse_structure
from ..functions import seq as S
from ..operators import barcodes as B
from ..operators import names as N
from ..operators import reads as R
from ..operators.counts import with_barcode
from .base import READS, WHITE, D, query, reads, t, whitelist

CORRECT = f"""with {READS}, {WHITE},
raw as (select distinct substr(seq, 1, 8) as raw from reads),
exact as (select raw, raw as candidate, 0 as distance from raw where raw in (select barcode from white)),
near as (select distinct raw, substr(raw, 1, i - 1) || b || substr(raw, i + 1) as candidate from raw, (select unnest(range(1, 9)) as i), (select unnest(['A', 'C', 'G', 'T']) as b)
         where raw not in (select raw from exact) and substr(raw, i, 1) <> b),
found as (select * from exact union all select raw, candidate, 1 from near where candidate in (select barcode from white)),
per as (select raw, min(distance) as d, count(*) as n, min(candidate) as c from found group by raw),
fixed as (select event_id, substr(seq, 1, 8) as raw, coalesce(n, 0) as n_candidates,
                 case when d = 0 then 'exact' when n = 1 then 'one' when n > 1 then 'multi' else 'none' end as status,
                 case when d = 0 or n = 1 then c end as corrected from reads left join per on substr(seq, 1, 8) = per.raw)"""


def raws(spark, sf):
    return reads(spark, sf).select("event_id", F.substring("seq", 1, 8).alias("raw"))


@query("parse_structure", """with s as (select p_partkey, 'B' || p_size || 'U' || (p_partkey % 12 + 1) || 'X3' as structure from part),
e as (select p_partkey, unnest(regexp_extract_all(structure, '([BLUXT])(\\d+)', 1)) as code, unnest(regexp_extract_all(structure, '([BLUXT])(\\d+)', 2)) as len, unnest(range(3)) as i from s)
select p_partkey, cast(i as integer) as nth, code, cast(len as integer) as length from e""")
def _(spark, sf):
    s = F.concat(F.lit("B"), F.col("p_size").cast("string"), F.lit("U"), (F.col("p_partkey") % 12 + 1).cast("string"), F.lit("X3"))
    d = t(spark, sf, "part").select("p_partkey", F.posexplode(S.structure(s)).alias("nth", "s"))
    return d.select("p_partkey", "nth", "s.code", "s.length")


@query("anchor_shift", f"with {READS} select event_id, cast(case when strpos(substr(seq, 1, 7), 'AC') > 0 then strpos(substr(seq, 1, 7), 'AC') end as integer) as start, case when strpos(substr(seq, 1, 7), 'AC') > 0 then 'valid' else 'no_anchor' end as status from reads")
def _(spark, sf):
    return R.anchor_shift(reads(spark, sf), "seq", "AC").select("event_id", "start", "status")


@query("extract_segments", f"with {READS}, a as (select event_id, seq, nullif(strpos(substr(seq, 1, 7), 'AC'), 0) as p0 from reads) select event_id, substr(seq, p0 + 1, 4) || substr(seq, p0 + 8, 4) as barcode, substr(seq, p0 + 5, 3) as linker, substr(seq, p0 + 14, 6) as umi, substr(seq, p0 + 20) as rest from a")
def _(spark, sf):
    d = R.anchor_shift(reads(spark, sf), "seq", "AC")
    return R.extract_segments(d, "seq", parse_structure("B4L3B4X2U6"), "start").select("event_id", "barcode", "linker", "umi", "rest")

@query("read_format", "select p_partkey, cast(p_size + 1 as varchar) || 'C' || cast(p_partkey % 12 + 1 as varchar) || 'M+T' as structure from part")
def _(spark, sf):
    size, umi = F.col("p_size"), F.col("p_partkey") % 12
    text = F.concat(F.lit("um:"), (size + 1).cast("string"), F.lit(":"), (size + 1 + umi).cast("string"), F.lit(",bc:0:"), size.cast("string"))
    return t(spark, sf, "part").select("p_partkey", S.read_structure(text).alias("structure"))


ALT = f"with {READS}, a as (select event_id, substr(seq, 1, 6) as raw, substr(seq, 1, 2) || 'G' || substr(seq, 4, 2) || 'A' as fixed from reads)"
ALT_OF = "coalesce(nullif((case when substr(raw, 3, 1) <> 'G' then '2' || substr(raw, 3, 1) else '' end) || (case when substr(raw, 6, 1) <> 'A' then '5' || substr(raw, 6, 1) else '' end), ''), 'M')"


def altered(spark, sf):
    d = reads(spark, sf).select("event_id", F.substring("seq", 1, 6).alias("raw"), F.concat(F.substring("seq", 1, 2), F.lit("G"), F.substring("seq", 4, 2), F.lit("A")).alias("fixed"), "umi", "cell")
    return d.withColumn("alt", S.alteration(F.col("raw"), F.col("fixed")))


@query("alt_string", f"{ALT} select event_id, {ALT_OF} as alt from a")
def _(spark, sf):
    return altered(spark, sf).select("event_id", "alt")


@query("alt_invert", f"{ALT} select event_id, raw from a")
def _(spark, sf):
    return altered(spark, sf).select("event_id", S.undo_alteration(F.col("fixed"), F.col("alt")).alias("raw"))


@query("tag_projection", f"{ALT} select event_id, fixed as cb, raw as cr, umi as ub, umi as ur, 'read' || event_id as qname from a join reads using (event_id)")
def _(spark, sf):
    d = altered(spark, sf).withColumn("qname", F.concat_ws("_", "fixed", "umi", "alt", F.concat(F.lit("read"), F.col("event_id").cast("string"))))
    return N.tags(d).select("event_id", "cb", "cr", "ub", "ur", "qname")

@query("name_parts", f"with {READS} select event_id, cell as barcode, umi, 'read' || event_id || ':' || cell as renamed from reads")
def _(spark, sf):
    d = reads(spark, sf).withColumn("name", F.concat_ws("_", "cell", "umi", F.lit("M"), F.concat(F.lit("read"), F.col("event_id").cast("string"))))
    p = N.name_parts("name")
    return d.select("event_id", p["barcode"].alias("barcode"), p["umi"].alias("umi"), N.barcode_behind("name").alias("renamed"))

@query("name_mate", "select p_partkey, replace(p_name || ' 2:N:0', ' 2:', ' 1:') as name from part")
def _(spark, sf):
    return t(spark, sf, "part").select("p_partkey", N.mate(F.concat("p_name", F.lit(" 2:N:0"))).alias("name"))


QUAL = "translate(md5('q' || cast(event_id as varchar)), '0123456789abcdef', '!#%+/59;?ACEFGHI')"


def with_quality(spark, sf):
    return reads(spark, sf).withColumn("qual", F.translate(F.md5(F.concat(F.lit("q"), F.col("event_id").cast("string"))), "0123456789abcdef", "!#%+/59;?ACEFGHI"))


@query("mean_phred", f"with {READS} select event_id, round(cast(list_sum(list_transform(string_split(substr({QUAL}, 1, 7), ''), lambda c: ascii(c) - 33)) as double) / 7, 9) as mean_q from reads")
def _(spark, sf):
    return with_quality(spark, sf).select("event_id", F.round(S.mean_phred(S.cut(F.col("qual"), 0, 7)), 9).alias("mean_q"))


@query("phred_ints", f"with {READS}, q as (select event_id, unnest(range(32)) as i, {QUAL} as q from reads) select event_id, cast(i as integer) as pos, cast(ascii(substr(q, i + 1, 1)) - 33 as integer) as quality from q")
def _(spark, sf):
    return with_quality(spark, sf).select("event_id", F.posexplode(S.phred(F.col("qual"))).alias("pos", "quality"))


CONV = f"""with {READS}, q as (select event_id, seq, {QUAL} as qual from reads),
m as (select *, substr(seq, 3, 1) = 'A' and (ascii(substr(qual, 3, 1)) - 33) >= 30 and substr(seq, 6, 1) in ('C', 'T') and substr(seq, 8, 1) in ('C', 'T') as ok, substr(seq, 11, 1) || substr(seq, 12, 1) as pair from q),
l as (select event_id, case when ok and pair = 'TT' then 'A' when ok and pair = 'CC' then 'B' end as line, seq from m),
h as (select event_id, line, case when line is not null then cast(substr(seq, 6, 1) = case line when 'A' then 'T' else 'C' end as integer) + cast(substr(seq, 8, 1) = case line when 'A' then 'T' else 'C' end as integer) end as hits from l)"""


def converted(spark, sf):
    return R.conversion(with_quality(spark, sf), "seq", "qual", (2, "A"), [5, 7], (10, 11), 20)


@query("conversion_motif", f"{CONV} select event_id, line, cast(hits as integer) as hits from h")
def _(spark, sf):
    return converted(spark, sf).select("event_id", "line", "hits")


@query("conversion_rates", f"{CONV} select count(*) filter (line = 'A') as line_a, count(*) filter (line = 'B') as line_b, round(cast(sum(hits) filter (line = 'A') as double) / nullif(2 * count(*) filter (line = 'A'), 0), 9) as ct_mean, round(cast(sum(hits) filter (line = 'B') as double) / nullif(2 * count(*) filter (line = 'B'), 0), 9) as cc_mean from h")
def _(spark, sf):
    return R.conversion_rates(converted(spark, sf), 2)


@query("poly_filter", f"with {READS} select event_id, substr(seq, 1, 3) as umi from reads where substr(seq, 1, 3) <> repeat(substr(seq, 1, 1), 3)")
def _(spark, sf):
    return reads(spark, sf).select("event_id", F.substring("seq", 1, 3).alias("umi")).where(~S.is_poly(F.col("umi")))


@query("length_filter", "select doc_id, case when length(text) < 300 or n_chars < 300 then 'too_short' else 'valid' end as status from documents")
def _(spark, sf):
    return t(spark, sf, "documents").select("doc_id", B.length_status(F.length("text"), F.col("n_chars"), (300, 300)).alias("status"))

@query("correct_exact_one_multi", CORRECT + " select event_id, raw, status, n_candidates, corrected from fixed")
def _(spark, sf):
    return R.correct(raws(spark, sf), whitelist(spark, sf)).select("event_id", "raw", "status", "n_candidates", "corrected")


RESCUE = """, options as (select f.raw, f.candidate, coalesce(n, 0) as n from found f left join counts using (candidate) where raw in (select raw from fixed where status = 'multi')),
ranked as (select *, row_number() over w as r, coalesce(lead(n) over w, 0) as second from options window w as (partition by raw order by n desc, candidate))
select event_id, fixed.raw, n_candidates, case when {ok} then candidate end as chosen from fixed join ranked using (raw) where status = 'multi' and r = 1"""


@query("rescue_raw_count", CORRECT + ", counts as (select corrected as candidate, count(*) as n from fixed where status = 'exact' group by 1)" + RESCUE.format(ok="n > 0"))
def _(spark, sf):
    return R.rescue(raws(spark, sf), whitelist(spark, sf)).select("event_id", "raw", "n_candidates", "chosen")


@query("rescue_strict", CORRECT + ", counts as (select corrected as candidate, count(*) as n from fixed where status in ('exact', 'one') group by 1)" + RESCUE.format(ok="n > second"))
def _(spark, sf):
    return R.rescue(raws(spark, sf), whitelist(spark, sf), strict=True).select("event_id", "raw", "n_candidates", "chosen")


@query("read_pass", CORRECT + " select event_id, case when status = 'exact' then corrected || '_' || substr(seq, 9, 6) || '_M' else corrected || '_' || substr(seq, 9, 6) || '_' || (select min(i) - 1 from (select unnest(range(1, 9)) as i) where substr(fixed.raw, i, 1) <> substr(corrected, i, 1)) || substr(fixed.raw, cast((select min(i) from (select unnest(range(1, 9)) as i) where substr(fixed.raw, i, 1) <> substr(corrected, i, 1)) as bigint), 1) end as header from fixed join reads using (event_id) where corrected is not null")
def _(spark, sf):
    d = B.assign(reads(spark, sf), Chemistry("B8U6"), [whitelist(spark, sf)], seq="seq").where("barcode is not null")
    return d.select("event_id", F.concat_ws("_", "barcode", "umi", "alt").alias("header"))


#: A layout with everything in it: an anchor, two barcode segments with lists of their own, a linker between them.
LAYOUT = Chemistry("B4L2B3U5", True, "AC")
LEAST = (14, 30)
STATES = f"""with {READS}, w1 as (select distinct substr({D('p_partkey')}, 1, 4) as b from part where p_partkey <= 60), w2 as (select distinct substr({D('p_partkey')}, 1, 3) as b from part where p_partkey <= 12), lk as (select distinct substr({D('s_suppkey')}, 1, 2) as b from supplier where s_suppkey <= 3),
places as (select unnest(range(1, 5)) as i), bases as (select unnest(['A', 'C', 'G', 'T']) as c),
n1 as (select distinct substr(b, 1, i - 1) || c || substr(b, i + 1) as raw, b from w1, places, bases where i <= 4 and substr(b, i, 1) <> c),
n2 as (select distinct substr(b, 1, i - 1) || c || substr(b, i + 1) as raw, b from w2, places, bases where i <= 3 and substr(b, i, 1) <> c),
nl as (select distinct substr(b, 1, i - 1) || c || substr(b, i + 1) as raw from lk, places, bases where i <= 2 and substr(b, i, 1) <> c union select b from lk),
m1 as (select b as raw, true as exact, [b] as cs from w1 union all select raw, false, list_sort(list(b)) from n1 where raw not in (select b from w1) group by raw),
m2 as (select b as raw, true as exact, [b] as cs from w2 union all select raw, false, list_sort(list(b)) from n2 where raw not in (select b from w2) group by raw),
a as (select event_id, seq, strpos(substr(seq, 1, 7), 'AC') as p0 from reads),
g as (select event_id, p0, substr(seq, p0 + 1, 4) as b1, substr(seq, p0 + 5, 2) as l, substr(seq, p0 + 7, 3) as b2, substr(seq, p0 + 10, 5) as umi, substr(seq, p0 + 15) as rest from a),
j as (select g.*, m1.raw as r1, m2.raw as r2, nl.raw as rl, m1.cs as c1, m2.cs as c2, (not m1.exact and len(m1.cs) = 1) or (not m2.exact and len(m2.cs) = 1) as fixed from g left join m1 on m1.raw = b1 left join m2 on m2.raw = b2 left join nl on nl.raw = l),
st as (select *, case when p0 = 0 then 'no_anchor' when r1 is null then 'no_barcode' when rl is null then 'no_linker' when r2 is null then 'no_barcode' when len(c1) > 1 or len(c2) > 1 then 'multi' else 'valid' end as status from j),
live as (select event_id, status, case when status in ('valid', 'multi') then b1 || b2 end as raw, case when status in ('valid', 'multi') then umi end as umi, case when status in ('valid', 'multi') then rest end as rest,
  case when status in ('valid', 'multi') then flatten(list_transform(c1, lambda x: list_transform(c2, lambda y: x || y))) end as candidates, coalesce(status in ('valid', 'multi') and fixed, false) as corrected from st),
alts as (select event_id, candidates[1] as barcode, string_agg((i - 1) || substr(raw, i, 1), '' order by i) filter (substr(raw, i, 1) <> substr(candidates[1], i, 1)) as diff from live, (select unnest(range(1, 8)) as i) where status = 'valid' group by all),
assigned as (select live.*, barcode, case when status = 'valid' then case when corrected then diff else 'M' end end as alt from live left join alts using (event_id)),
seen as (select raw as c, count(*) as n from assigned where raw is not null group by raw),
options as (select distinct raw, unnest(candidates) as c from assigned where status = 'multi'),
best as (select raw, c as chosen from (select raw, c, row_number() over (partition by raw order by n desc, c) as r from options join seen using (c)) where r = 1),
rescued as (select event_id, case when status <> 'multi' then status when chosen is null then 'no_rescue' else 'rescued' end as status, raw, umi, rest, corrected, case when status = 'multi' then chosen else barcode end as barcode, alt from assigned left join best using (raw)),
outcome as (select *, case when barcode is null then null when length(rest) < {LEAST[0]} or 30 < {LEAST[1]} then 'too_short' else 'kept' end as outcome from rescued)"""


def states(spark, sf):
    cut = lambda table, key, n, top: t(spark, sf, table).where(F.col(key) <= top).select(F.substring(S.dna(F.col(key)), 1, n).alias("barcode"))
    lists = [cut("part", "p_partkey", 4, 60), cut("part", "p_partkey", 3, 12)]
    return B.assign(reads(spark, sf).select("event_id", "seq"), LAYOUT, lists, [cut("supplier", "s_suppkey", 2, 3)], seq="seq")


@query("read_states", STATES + " select event_id, status, raw, umi, rest, array_to_string(candidates, ':') as candidates, corrected, barcode, alt from assigned")
def _(spark, sf):
    return states(spark, sf).select("event_id", "status", "raw", "umi", "rest", F.array_join("candidates", ":").alias("candidates"), "corrected", "barcode", "alt")


@query("read_rescue", STATES + " select event_id, status, barcode from rescued")
def _(spark, sf):
    return B.rescue_multi(states(spark, sf)).select("event_id", "status", "barcode")


@query("multi_candidates", STATES + " select event_id, raw || '_' || array_to_string(candidates, ':') || '_' || umi || '_r' || event_id as header from assigned where status = 'multi'")
def _(spark, sf):
    from ..sinks import multi_candidates

    d = states(spark, sf).withColumn("name", F.concat(F.lit("r"), F.col("event_id").cast("string")))
    return multi_candidates(d).select("event_id", "header")


@query("read_counters", STATES + """ select count(*) as total, count(*) filter (status in ('valid', 'rescued')) as valid, count(*) filter (status = 'no_anchor') as no_anchor, count(*) filter (outcome = 'too_short') as too_short, count(*) filter (outcome = 'trimmed') as trimmed,
count(*) filter (corrected and (status in ('rescued', 'no_rescue') or (status = 'valid' and outcome <> 'too_short'))) as B_corrected, count(*) filter (status in ('no_barcode', 'no_rescue')) as B_no_correction, count(*) filter (status = 'no_linker') as L_no_correction from outcome""")
def _(spark, sf):
    d = B.rescue_multi(states(spark, sf)).withColumn("r2_seq", F.repeat(F.lit("A"), F.lit(30)))
    return B.counters(B.finish(d, LAYOUT, adapters=False, least=LEAST))


@query("valid_share", CORRECT + " select round(cast(count(*) filter (status <> 'none') as double) / count(*), 9) as valid_share from fixed")
def _(spark, sf):
    return R.correct(raws(spark, sf), whitelist(spark, sf)).agg(F.round(F.count_if(F.col("status") != "none") / F.count("*"), 9).alias("valid_share"))


@query("nearest_barcode_k", f"""with a as (select distinct substr({D('s_suppkey')}, 1, 12) as raw from supplier), b as (select distinct substr({D('p_partkey')}, 1, 12) as barcode from part),
p as (select raw, barcode, cast(hamming(raw, barcode) as integer) as distance from a, b), m as (select raw, min(distance) as least from p group by raw)
select p.raw, barcode, distance from p join m on p.raw = m.raw and distance = least where distance < 4""")
def _(spark, sf):
    q = t(spark, sf, "supplier").select(F.substring(S.dna(F.col("s_suppkey")), 1, 12).alias("raw"))
    w = t(spark, sf, "part").select(F.substring(S.dna(F.col("p_partkey")), 1, 12).alias("barcode"))
    return R.nearest(q, w, 3, 4)


@query("base_profile", f"with {READS}, b as (select unnest(range(32)) as pos, seq from reads) select cast(pos as integer) as pos, substr(seq, pos + 1, 1) as base, count(*) as n from b group by 1, 2")
def _(spark, sf):
    return R.base_profile(reads(spark, sf), "seq")


@query("base_stat", f"with {READS}, b as (select unnest(range(32)) as i, seq from reads) select cast(i as integer) as pos, " + ", ".join(f"count(*) filter (substr(seq, i + 1, 1) = '{b}') as n_{b}" for b in "ACGTN") + " from b group by 1")
def _(spark, sf):
    return R.wide_profile(R.base_profile(reads(spark, sf), "seq"), "base", list("ACGTN"))


QP = f"with {READS}, b as (select unnest(range(32)) as pos, {QUAL} as q from reads), p as (select cast(pos as integer) as pos, cast(ascii(substr(q, pos + 1, 1)) - 33 as integer) as quality, count(*) as n from b group by 1, 2)"


@query("qual_profile", f"{QP} select * from p")
def _(spark, sf):
    return R.quality_profile(with_quality(spark, sf), "qual")


@query("q30_share", f"{QP} select round(cast(sum(case when quality >= 30 then n else 0 end) as double) / cast(sum(n) as double), 9) as q30 from p")
def _(spark, sf):
    return R.q30_share(R.quality_profile(with_quality(spark, sf), "qual"))


@query("cap_reads", f"with {READS}, r as (select event_id, cell, row_number() over (partition by cell order by event_id) as n from reads) select event_id, cell from r where n <= 5")
def _(spark, sf):
    return R.cap_reads(reads(spark, sf), "cell", "event_id", 5).select("event_id", "cell")


@query("drop_missing", f"with {READS} select event_id, cell from reads where event_id % 7 <> 0 and cell is not null")
def _(spark, sf):
    named = F.when(F.col("event_id") % 7 == 0, "missing_barcode").otherwise(F.col("cell"))  # every seventh read has none
    return with_barcode(reads(spark, sf).withColumn("cell", named)).select("event_id", "cell")


@query("whitelist_scan", f"with {WHITE} select barcode from white")
def _(spark, sf):
    from ..sources.text import clean_list

    lines = t(spark, sf, "part").select(F.concat(F.lit(" "), F.substring(S.dna(F.col("p_partkey")), 1, 8), F.lit(" ")).alias("value"))
    return clean_list(lines.unionByName(lines.sparkSession.createDataFrame([("# comment",), ("  ",)], "value string"))).withColumnRenamed("value", "barcode")


@query("det_umi", f"with {READS} select event_id, substr(translate(md5('umi' || event_id), '0123456789abcdef', 'ABCDEFGHIJKLMNOP'), 1, 12) as umi from reads")
def _(spark, sf):
    return reads(spark, sf).select("event_id", N.made_umi("event_id").alias("umi"))

@query("hamming_expr", f"with {READS} select event_id, cast(hamming(substr(seq, 1, 16), substr(seq, 17, 16)) as integer) as distance from reads")
def _(spark, sf):
    return reads(spark, sf).select("event_id", S.hamming(F.substring("seq", 1, 16), F.substring("seq", 17, 18)).alias("distance"))


NB = "select {key}, substr(s, 1, i - 1) || b || substr(s, i + 1) as neighbour from {src}, (select unnest(range(1, 9)) as i), (select unnest(['A', 'C', 'G', 'T']) as b) where substr(s, i, 1) <> b"


@query("neighbours", f"with {WHITE}, s as (select barcode as s from white) " + NB.format(key="s as barcode", src="s"))
def _(spark, sf):
    return whitelist(spark, sf).select("barcode", F.explode(S.neighbours(F.col("barcode"))).alias("neighbour"))


@query("n_rule", f"with {WHITE}, s as (select barcode, 'AN' || substr(barcode, 3, 3) || 'N' as s from white) select barcode, substr(s, 1, 1) || b || substr(s, 3) as neighbour from s, (select unnest(['A', 'C', 'G', 'T']) as b)")
def _(spark, sf):
    return whitelist(spark, sf).select("barcode", F.explode(S.neighbours(F.concat(F.lit("AN"), F.substring("barcode", 3, 3), F.lit("N")))).alias("neighbour"))


@query("base_code", f"with {READS}, b as (select event_id, unnest(range(32)) as pos, seq from reads) select event_id, cast(pos as integer) as pos, cast(case substr(seq, pos + 1, 1) when 'A' then 0 when 'T' then 1 when 'U' then 1 when 'C' then 2 when 'G' then 3 else 4 end as integer) as code from b")
def _(spark, sf):
    return reads(spark, sf).select("event_id", F.posexplode(S.letters(F.col("seq"))).alias("pos", "b")).select("event_id", "pos", S.base_code(F.col("b")).alias("code"))


@query("candidate_product", f"with {WHITE}, a as (select distinct substr(barcode, 1, 2) as x from white), b as (select distinct substr(barcode, 3, 2) as y from white) select x || y as candidate from a, b")
def _(spark, sf):
    w = whitelist(spark, sf).agg(F.collect_set(F.substring("barcode", 1, 2)).alias("x"), F.collect_set(F.substring("barcode", 3, 2)).alias("y"))
    return w.select(F.explode(B.product([F.col("x"), F.col("y")])).alias("candidate"))


@query("adapter_exact", f"with {READS} select event_id, strpos(seq, 'ACGT') > 0 as trimmed, case when strpos(seq, 'ACGT') > 0 then substr(seq, 1, strpos(seq, 'ACGT') - 1) else seq end as kept from reads")
def _(spark, sf):
    from ..operators.matching import trim

    # an adapter without errors that must lie in the read as a whole
    return trim(reads(spark, sf).select("event_id", "seq"), "seq", [("ACGT", "3")], rate=0.0, overlap=4).select("event_id", "trimmed", "kept")


@query("quality_tail", f"""with {READS}, q as (select event_id, unnest(range(1, 33)) as i, {QUAL} as q from reads) select event_id, cast(coalesce(max(case when ascii(substr(q, i, 1)) - 33 >= 3 then i end), 0) as integer) as kept from q group by 1""")
def _(spark, sf):
    q = F.transform(S.phred(F.col("qual")), lambda x, i: F.when(x >= 3, i + 1).otherwise(0))
    return with_quality(spark, sf).select("event_id", F.array_max(q).alias("kept"))


def _rate(name: str, start: int) -> str:
    """SQL of the share of reads whose eight bases from `start` lead to a barcode, rescue included."""
    return f"""{name}raw as (select substr(seq, {start}, 8) as raw, count(*) as n from head group by 1),
{name}near as (select distinct raw, substr(raw, 1, i - 1) || b || substr(raw, i + 1) as candidate from {name}raw, (select unnest(range(1, 9)) as i), (select unnest(['A', 'C', 'G', 'T']) as b) where raw not in (select barcode from white) and substr(raw, i, 1) <> b),
{name}hit as (select raw, count(*) as k, count(*) filter (candidate in (select raw from {name}raw)) as seen from {name}near where candidate in (select barcode from white) group by raw),
{name} as (select cast(sum(case when raw in (select barcode from white) or k = 1 or seen > 0 then n else 0 end) as double) / cast(sum(n) as double) as rate from {name}raw left join {name}hit using (raw))"""


@query("chemistry_choice", f"with {READS}, {WHITE}, head as (select seq from reads order by event_id limit 5000), {_rate('mm', 1)}, {_rate('dd', 9)} select round(mm.rate, 9) as mm, round(dd.rate, 9) as dd, case when dd.rate > mm.rate then 'DDV2' else 'MM' end as chemistry, case when mm.rate > 2 * dd.rate then 'true' when mm.rate < 0.5 * dd.rate then 'false' else 'none' end as five_prime from mm, dd")
def _(spark, sf):
    w = whitelist(spark, sf)
    options = {"MM": (Chemistry("B8U4"), [w]), "DDV2": (Chemistry("X8B8U4"), [w])}
    best, rates = B.autodetect(reads(spark, sf), options, 5000, ["event_id"], "seq")
    side = five_prime(rates["MM"] / rates["DDV2"]) if rates["DDV2"] else None
    text = {True: "true", False: "false", None: "none"}[side]
    return spark.createDataFrame([(round(rates["MM"], 9), round(rates["DDV2"], 9), best, text)], "mm double, dd double, chemistry string, five_prime string")


@query("remap_barcode", f"with s as (select s_suppkey, substr({D('s_suppkey')}, 1, 8) as bc from supplier), o as (select bc, row_number() over (order by bc) as i from (select distinct bc from s)), n as (select name, row_number() over (order by name) as i from (select 'NEW' || lpad(cast(p_partkey as varchar), 6, '0') as name from part where p_partkey <= 8)) select s_suppkey, coalesce(name, 'AAAAAAAA') as barcode, substr(bc, 1, 4) as umi from s join o using (bc) left join n using (i)")
def _(spark, sf):
    new = t(spark, sf, "part").where("p_partkey <= 8").select(F.concat(F.lit("NEW"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("barcode"))
    s = t(spark, sf, "supplier").select("s_suppkey", F.substring(S.dna(F.col("s_suppkey")), 1, 8).alias("barcode")).withColumn("umi", F.col("barcode"))
    return N.remap(s, "barcode", new, "umi", 4)
