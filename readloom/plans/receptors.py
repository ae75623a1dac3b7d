"""Receptor, UMI graph and matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clones as K
from ..operators import matching as M
from ..operators import names as N
from ..operators import receptors as V
from ..operators import umi as U
from .base import READS, D, query, reads, t

HITS = "hits as (select l_orderkey as qname, substr(case cast(l_suppkey % 4 as integer) when 0 then 'TRAV1' when 1 then 'TRBV2' when 2 then 'IGHV3' else 'IGKV4' end, 1, 3) as chain from lineitem)"


def hits(spark, sf):
    m = F.col("l_suppkey") % 4
    ref = F.when(m == 0, "TRAV1").when(m == 1, "TRBV2").when(m == 2, "IGHV3").otherwise("IGKV4")
    return t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("qname"), N.chain(ref).alias("chain"))


@query("chain_prefix", f"with {HITS} select chain, count(*) as n from hits group by chain")
def _(spark, sf):
    return hits(spark, sf).groupBy("chain").agg(F.count("*").alias("n"))


@query("chain_votes", f"with {HITS}, p as (select qname, chain, count(*) as n from hits group by all), r as (select *, row_number() over w as r, lead(n) over w as second from p window w as (partition by qname order by n desc, chain)) select case when n = second then 'unknown' else chain end as chain, count(*) as reads from r where r = 1 group by 1")
def _(spark, sf):
    return V.chain_counts(hits(spark, sf))


VOTES = "votes as (select l_suppkey as umi, l_partkey % 7 as contig, count(*) as n from lineitem group by all), r as (select *, row_number() over (partition by umi order by n desc, contig) as r from votes), b as (select umi, max(n) as first, max(case when r = 2 then n end) as second from r group by umi), kept as (select umi, contig, n from r join b using (umi) where r = 1 or not (second is null or cast(second as double) / first < 0.9))"


def votes(spark, sf):
    v = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("umi"), (F.col("l_partkey") % 7).alias("contig")).agg(F.count("*").alias("n"))
    return V.top_unless_close(v, "umi", "contig", 0.9)


@query("contig_votes", f"with {VOTES} select contig, count(distinct umi) as umis from kept group by contig")
def _(spark, sf):
    return votes(spark, sf).groupBy("contig").agg(F.countDistinct("umi").alias("umis"))


@query("cdr3_rewrite", f"with {VOTES}, c as (select contig, count(distinct umi) as n from kept group by contig) select o_orderkey, n from orders join c on o_custkey % 9 = contig")
def _(spark, sf):
    c = votes(spark, sf).groupBy("contig").agg(F.countDistinct("umi").alias("n"))
    o = t(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 9).alias("contig"), F.lit(0).alias("reads"))
    return K.rewrite_field(o, c, "contig", "reads").select("o_orderkey", F.col("reads").alias("n"))


@query("contig_reads", "with p as (select l_orderkey as contig, l_linenumber as pos, cast(floor(l_quantity) as bigint) as total, l_partkey as part, l_suppkey as supp from lineitem), s as (select contig, greatest(total - coalesce(lag(total) over (partition by contig order by pos, part, supp, total), 0), 0) as step from p) select contig, cast(sum(step) as bigint) as reads from s group by contig")
def _(spark, sf):
    p = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("contig"), F.col("l_linenumber").alias("pos"), F.floor("l_quantity").alias("total"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))
    return V.contig_reads(p, ["pos", "part", "supp", "total"])


CL = "cl as (select o_orderkey as cell, o_custkey % 40 as clone, case when o_orderstatus = 'F' then 'TRB:' || o_orderpriority else '' end as h, case when o_orderkey % 2 = 0 then 'TRA:' || cast(o_orderkey % 3 as varchar) else '' end as l from orders), ct as (select cell, clone, trim(case when h <> '' and l <> '' then h || ';' || l else h || l end, ';') as nt from cl where h <> '' or l <> '')"


def chains(spark, sf):
    o = t(spark, sf, "orders")
    h = F.when(F.col("o_orderstatus") == "F", "TRB").otherwise(K.NONE)
    light = F.when(F.col("o_orderkey") % 2 == 0, "TRA").otherwise(K.NONE)
    d = o.select(F.col("o_orderkey").alias("cell"), (F.col("o_custkey") % 40).alias("clone"), h.alias("locus_VDJ"), light.alias("locus_VJ"), F.col("o_orderpriority").alias("junction_VDJ"), (F.col("o_orderkey") % 3).cast("string").alias("junction_VJ"))
    return d.withColumn("nt", K.cdr3("junction")).where("nt != ''")


@query("cdr3_string", f"with {CL} select cell, nt from ct")
def _(spark, sf):
    return chains(spark, sf).select("cell", "nt")


@query("clonotype_table", f"with {CL}, p as (select clone, nt, count(*) as n from ct group by all), r as (select *, row_number() over (partition by clone order by (nt like '%;%') desc, n desc, nt desc) as r, sum(n) over (partition by clone) as f, sum(n) over () as total from p) select clone, cast(f as bigint) as frequency, lower(nt) as cdr3s_aa, nt as cdr3s_nt, round(cast(f as double) / cast(total as double), 9) as proportion from r where r = 1")
def _(spark, sf):
    return V.clonotypes(chains(spark, sf).select(F.col("cell").alias("cell_id"), "clone", "nt", F.lower("nt").alias("aa")))


@query("diversity", f"with {CL}, f as (select count(*) as n from ct group by clone), p as (select cast(n as double) / cast(sum(n) over () as double) as p from f) select round(1 / sum(p * p), 6) as diversity from p")
def _(spark, sf):
    return V.diversity(chains(spark, sf).groupBy("clone").agg(F.count("*").alias("frequency")))


META = "meta as (select case cast(o_orderkey % 3 as integer) when 0 then '{h}' else 'None' end as locus_vdj, case cast(o_orderkey % 4 as integer) when 0 then '{a}' when 1 then '{b}' else 'None' end as locus_vj, case when o_orderstatus = 'F' then 'T' else 'F' end as productive_vdj, case when o_orderstatus <> 'P' then 'T' else 'F' end as productive_vj, o_custkey % 9 as u, o_custkey % 7 as v from orders)"


def meta(spark, sf, heavy, one, two, umis):
    k = F.col("o_orderkey")
    yes = lambda c: F.when(c, "T").otherwise("F")
    locus = F.when(k % 4 == 0, one).when(k % 4 == 1, two).otherwise(K.NONE)
    return t(spark, sf, "orders").select(F.when(k % 3 == 0, heavy).otherwise(K.NONE).alias("locus_VDJ"), locus.alias("locus_VJ"), yes(F.col("o_orderstatus") == "F").alias("productive_VDJ"), yes(F.col("o_orderstatus") != "P").alias("productive_VJ"), (F.col("o_custkey") % 9).alias(f"umi_count_{umis}_VDJ"), (F.col("o_custkey") % 7).alias(f"umi_count_{umis}_VJ"))


def _shares(tests: dict) -> str:
    one = "round(cast(count(*) filter ({t}) as double) / count(*), 9) as {n}"
    out = ["count(*) as cells", "count(*) filter (productive_vdj = 'T' and productive_vj = 'T') as pairs", one.format(t="productive_vdj = 'T' and productive_vj = 'T'", n="pair_share")]
    for name, (test, umis) in tests.items():
        out.append(one.format(t=test, n=name))
        if umis:
            out.append(f"coalesce(median({umis}) filter ({test}), 0) as {name}_umis")
    return "select " + ", ".join(out) + " from meta"


IG = {"igk_igh": ("locus_vj = 'IGK' and locus_vdj = 'IGH'", ""), "igl_igh": ("locus_vj = 'IGL' and locus_vdj = 'IGH'", ""), "igh": ("productive_vdj = 'T' and locus_vdj = 'IGH'", "u"), "igk": ("productive_vj = 'T' and locus_vj = 'IGK'", "v"), "igl": ("productive_vj = 'T' and locus_vj = 'IGL'", "v")}
TR = {"tra_trb": ("locus_vdj = 'TRB' and locus_vj = 'TRA'", ""), "tra": ("productive_vdj = 'T' and locus_vj = 'TRA'", "v"), "trb": ("productive_vj = 'T' and locus_vdj = 'TRB'", "u")}


@query("clone_shares", "with " + META.format(h="IGH", a="IGK", b="IGL") + " " + _shares(IG))
def _(spark, sf):
    return K.clone_matrix(meta(spark, sf, "IGH", "IGK", "IGL", "B"), "IG")


@query("clone_matrix_tr", "with " + META.format(h="TRB", a="TRA", b="TRG") + " " + _shares(TR))
def _(spark, sf):
    return K.clone_matrix(meta(spark, sf, "TRB", "TRA", "TRG", "abT"), "TR")


@query("consensus_pick", f"with s as (select o_custkey % 40 as clone, o_orderstatus as locus, substr({D('o_custkey % 11')}, 1, 10 + cast(o_orderkey % 3 as integer)) as seq from orders), p as (select *, count(*) as n from s group by all), r as (select *, row_number() over (partition by clone, locus order by length(seq) desc, n desc, seq) as r from p) select clone, locus, seq, n from r where r = 1")
def _(spark, sf):
    from ..functions.seq import dna

    s = t(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("clone"), F.col("o_orderstatus").alias("locus"), F.substring(dna(F.col("o_custkey") % 11), F.lit(1), (F.col("o_orderkey") % 3 + 10).cast("int")).alias("seq"))
    return V.consensus(s)


@query("clone_ids", f"with {CL}, s as (select clone, count(*) as n from ct group by clone) select clone, n, cast(row_number() over (order by n desc, clone) as integer) as new_id from s")
def _(spark, sf):
    return V.ranked_ids(chains(spark, sf), [], "clone", ["clone"], "new_id")


SUB = "sub as (select o_custkey % 40 as clone, case cast(o_orderkey % 4 as integer) when 0 then 'c_VDJ_1_VJ_2' when 1 then 'c_VDJ_3' when 2 then 'c_VJ_4' else 'c_VDJ_5_VJ_6' end as name from orders)"
WEIGHT = "case when name like '%VDJ%' and name like '%VJ%' then 3 when name like '%VDJ%' then 2 else 1 end"


def subclones(spark, sf):
    m = F.col("o_orderkey") % 4
    name = F.when(m == 0, "c_VDJ_1_VJ_2").when(m == 1, "c_VDJ_3").when(m == 2, "c_VJ_4").otherwise("c_VDJ_5_VJ_6")
    return t(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 40).alias("clone"), name.alias("name"))


@query("clone_weight", f"with {SUB} select name, {WEIGHT} as weight, count(*) as n from sub group by all")
def _(spark, sf):
    return subclones(spark, sf).groupBy("name", K.weight("name").alias("weight")).agg(F.count("*").alias("n"))


@query("subclone_ids", f"with {SUB}, s as (select clone, name, {WEIGHT} as weight, count(*) as n from sub group by all) select clone, name, n, cast(row_number() over (partition by clone order by n desc, weight desc, name) as integer) as subclone from s")
def _(spark, sf):
    return K.subclones(subclones(spark, sf), "clone", "name")


AIRR = "airr as (select l_orderkey as cell, l_linenumber as contig, case when l_returnflag = 'R' then 'IGH' else 'TRA' end as locus, cast(floor(l_quantity) as bigint) as cons, l_linenumber as dup from lineitem), sat as (select *, case when cons <> 0 then 1 - cast(dup as double) / cons else 0 end as saturation from airr)"


def airr(spark, sf):
    a = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_linenumber").alias("contig"), F.when(F.col("l_returnflag") == "R", "IGH").otherwise("TRA").alias("locus"), F.floor("l_quantity").alias("consensus_count"), F.col("l_linenumber").alias("duplicate_count"))
    return a.withColumn("saturation", K.saturation())


@query("saturation_filter", f"with {AIRR}, f as (select *, sum(dup) over (partition by cell) as total from sat where locus like 'TR%' and saturation > 0.94) select cell, contig, locus, round(saturation, 9) as saturation from f where total >= 3")
def _(spark, sf):
    d = K.contig_filter(airr(spark, sf), "TR")
    return d.select(F.col("cell_id").alias("cell"), "contig", "locus", F.round("saturation", 9).alias("saturation"))


@query("cell_sum_filter", f"with {AIRR}, s as (select *, sum(dup) over (partition by cell) as total from sat where locus like 'TR%') select cell, contig, cast(total as bigint) as total from s where total >= 3")
def _(spark, sf):
    d = K.cell_sum(airr(spark, sf).where("locus like 'TR%'"), 3)
    return d.select(F.col("cell_id").alias("cell"), "contig", "total")


CLONES = "clones as (select distinct 'clone_VDJ_' || (c_custkey % 30) || '_VJ_' || (c_custkey % 50) as clone from customer), single as (select s_suppkey, s_suppkey % 30 as n from supplier)"


def clone_names(spark, sf):
    c = F.col("c_custkey")
    return t(spark, sf, "customer").select(F.concat(F.lit("clone_VDJ_"), (c % 30).cast("string"), F.lit("_VJ_"), (c % 50).cast("string")).alias("clone")).distinct()


@query("substring_match", f"with {CLONES} select s_suppkey, clone from single join clones on clone like '%\\_VJ\\_' || n || '%' escape '\\'")
def _(spark, sf):
    s = t(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("_VJ_"), (F.col("s_suppkey") % 30).cast("string")).alias("key"))
    return K.names_containing(s, "key", clone_names(spark, sf), "clone", "_VJ_").select("s_suppkey", "clone")


#: Cells of complete and of single-chain clones, sizes very unequal.
CELLCLONE = "cc as (select o_orderkey as cell_id, o_custkey % 13 as a, o_custkey % 11 as b, case cast(o_orderkey % 6 as integer) when 0 then 'c_VDJ_' || (o_custkey % 13) when 1 then 'c_VJ_' || (o_custkey % 11) else 'c_VDJ_' || least(o_custkey % 13, o_custkey % 3) || '_VJ_' || least(o_custkey % 11, o_custkey % 5) end as clone_id, 1 + (o_custkey % 700) * (o_custkey % 700) as umi_count from orders), kk as (select *, case when contains(clone_id, 'VDJ_') and contains(clone_id, '_VJ_') then 'pair' when contains(clone_id, 'VDJ_') then 'vdj' else 'vj' end as kind from cc)"


def cell_clones(spark, sf):
    k, a, b = F.col("o_orderkey") % 6, F.col("o_custkey") % 13, F.col("o_custkey") % 11
    text = lambda c: c.cast("string")
    pair = F.concat(F.lit("c_VDJ_"), text(F.least(a, F.col("o_custkey") % 3)), F.lit("_VJ_"), text(F.least(b, F.col("o_custkey") % 5)))
    name = F.when(k == 0, F.concat(F.lit("c_VDJ_"), text(a))).when(k == 1, F.concat(F.lit("c_VJ_"), text(b))).otherwise(pair)
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderkey").alias("sequence_id"), name.alias("clone_id"), (1 + (F.col("o_custkey") % 700) * (F.col("o_custkey") % 700)).alias("umi_count"))


@query("single_chain_filter", f"""with {CELLCLONE}, want as (select distinct clone_id, kind, case kind when 'vj' then '_VJ_' || regexp_extract(clone_id, 'VD?J_(\\d+)', 1) when 'vdj' then 'VDJ_' || regexp_extract(clone_id, 'VD?J_(\\d+)', 1) end as w from kk where kind <> 'pair'),
m as (select w.w, k.umi_count as u from (select distinct w, kind from want) w join kk k on (k.kind = 'pair' or k.kind = w.kind) and contains(k.clone_id, w.w)),
r as (select w, u, sum(u) over (partition by w order by u desc range between unbounded preceding and current row) as run, sum(u) over (partition by w) as total from m),
n as (select w, max(u) as n50 from r where run * 2 >= total group by w)
select cell_id as sequence_id from kk join want using (clone_id) join n on n.w = want.w where umi_count < 0.01 * n50""")
def _(spark, sf):
    return K.weak_single_chains(cell_clones(spark, sf))


@query("attach_single", f"""with {CELLCLONE}, size as (select clone_id, count(*) as n from kk where kind = 'pair' group by clone_id),
want as (select distinct clone_id, case kind when 'vj' then '_VJ_' || regexp_extract(clone_id, 'VD?J_(\\d+)', 1) when 'vdj' then 'VDJ_' || regexp_extract(clone_id, 'VD?J_(\\d+)', 1) end as w from kk where kind <> 'pair'),
c as (select distinct want.w, s.clone_id, s.n from want join size s on contains(s.clone_id, want.w)), r as (select *, row_number() over p as r, lead(n) over p as second from c window p as (partition by w order by n desc, clone_id)),
best as (select w, clone_id as clone from r where r = 1 and (second is null or cast(second as double) / n < 0.15))
select cell_id, coalesce(clone, kk.clone_id) as clone_id_by_size from kk left join want using (clone_id) left join best on best.w = want.w""")
def _(spark, sf):
    d = cell_clones(spark, sf).withColumn("clone_id_by_size", F.col("clone_id"))
    return K.attach_single_chains(d).select("cell_id", "clone_id_by_size")


CLONE = f"{READS}, c as (select event_id as contig, gene as v, substr(seq, 1, 1) as j, case when event_id % 50 = 0 then null else substr(seq, 2, 5) end as junction from reads), n as (select distinct v, j, junction, v || '|' || j || '|' || junction as node from c where junction is not null)"


@query("clone_identity", f"""with recursive {CLONE}, s as (select x.node as a, y.node as b from n x join n y on x.v = y.v and x.j = y.j and hamming(x.junction, y.junction) = 1),
lab(node, comp) using key (node) as (select node, node from n union select s.a, min(lab.comp) from lab join s on s.b = lab.node join recurring.lab as me on me.node = s.a where lab.comp < me.comp group by s.a)
select contig, v || '|' || j || '|5|' || split_part(comp, '|', 3) as clone from c left join lab on lab.node = v || '|' || j || '|' || junction""")
def _(spark, sf):
    r = reads(spark, sf)
    junction = F.when(F.col("event_id") % 50 != 0, F.substring("seq", 2, 5))
    return V.clone_groups(r.select(F.col("event_id").alias("contig"), F.col("gene").alias("v"), F.substring("seq", 1, 1).alias("j"), junction.alias("junction")), 0.8)


@query("clone_identity_tr", f"with {READS} select event_id as contig, gene || '|' || substr(seq, 1, 1) || '|5|' || substr(seq, 2, 5) as clone from reads")
def _(spark, sf):
    return V.clone_names(reads(spark, sf).select(F.col("event_id").alias("contig"), F.col("gene").alias("v"), F.substring("seq", 1, 1).alias("j"), F.substring("seq", 2, 5).alias("junction")))


#: Every seventh read has an N in its UMI, a letter like another.
UM = f"{READS}, um as (select cell, gene, case when event_id % 7 = 0 then 'N' || substr(seq, 2, 3) else substr(seq, 1, 4) end as umi, count(*) as num from reads group by all)"


def umis(spark, sf):
    umi = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("N"), F.substring("seq", 2, 3))).otherwise(F.substring("seq", 1, 4))
    return reads(spark, sf).withColumn("umi", umi).groupBy("cell", "gene", "umi").agg(F.count("*").alias("num"))


EDGES = f"with {UM}, e as (select a.cell, a.gene, a.umi as a, b.umi as b from um a join um b on a.cell = b.cell and a.gene = b.gene and a.umi < b.umi where hamming(a.umi, b.umi) = 1) select * from e"


@query("umi_edges", EDGES)
def _(spark, sf):
    return U.edges(umis(spark, sf), ["cell", "gene"])


@query("umi_blocking", EDGES)
def _(spark, sf):
    return U.blocked_edges(umis(spark, sf), ["cell", "gene"], 2)


#: Connected components to their end: the least node reached, over paths of any length.
CC = "cc as (select node, node as other from n union select cc.node, s.b from cc join s on s.a = cc.other), comp as (select node, min(other) as comp from cc group by node)"
NODES = f"{UM}, n as (select cell || '|' || gene || '|' || umi as node, cell, gene, umi, num from um), e as (select x.node as a, y.node as b from n x join n y on x.cell = y.cell and x.gene = y.gene and x.umi <> y.umi where length(x.umi) = length(y.umi) and hamming(x.umi, y.umi) = 1)"


@query("umi_components", f"with recursive {NODES}, s as (select * from e), {CC} select node, comp from comp")
def _(spark, sf):
    name = lambda u: F.concat_ws("|", "cell", "gene", u)
    u = umis(spark, sf)
    e = U.edges(u, ["cell", "gene"]).select(name("a").alias("a"), name("b").alias("b"))
    return U.components(e, u.select(name("umi").alias("node")))


#: To each UMI the lead that claims it. cluster: the first of its component in order of (-num, umi). directional: the first that leads to it.
#: adjacency: leads are the shortest prefix of the component's order whose neighbours cover it; of these the first next to the UMI.
CLAIMS = {
    "cluster": f"with recursive {NODES}, s as (select * from e), {CC}, ranked as (select n.*, comp, row_number() over (partition by comp order by num desc, umi) as r from n join comp using (node)), claim as (select x.node, y.node as lead from ranked x join ranked y on x.comp = y.comp and y.r = 1)",
    "directional": f"""with recursive {NODES}, o as (select *, row_number() over (partition by cell, gene order by num desc, umi) as r, row_number() over () as id from n),
s as (select x.id as a, y.id as b from e join o x on x.node = e.a join o y on y.node = e.b where x.num >= 2 * y.num - 1), reach as (select id, id as other from o union select reach.id, s.b from reach join s on s.a = reach.other),
firsts as (select reach.other as id, min(o.r) as r from reach join o on o.id = reach.id group by reach.other), claim as (select o.node, l.node as lead from firsts join o on o.id = firsts.id join o l on l.cell = o.cell and l.gene = o.gene and l.r = firsts.r)""",
    "adjacency": f"""with recursive {NODES}, s as (select * from e), {CC}, ranked as (select n.*, comp, row_number() over (partition by comp order by num desc, umi) as r from n join comp using (node)),
near as (select x.node, min(y.r) as first from ranked x join e on e.a = x.node join ranked y on y.node = e.b group by x.node), need as (select comp, max(least(r, coalesce(first, r))) as k from ranked left join near using (node) group by comp),
claim as (select ranked.node, case when r <= k then ranked.node else (select arg_min(y.node, y.r) from e join ranked y on y.node = e.b where e.a = ranked.node and y.r <= k) end as lead from ranked join need using (comp))""",
}
MERGED = " select l.cell, l.gene, l.umi, cast(sum(n.num) as bigint) as num from claim join n on n.node = claim.node join n l on l.node = claim.lead group by all"


for _m in CLAIMS:

    @query(f"umi_{_m}", CLAIMS[_m] + MERGED)
    def _(spark, sf, m=_m):
        return U.cluster(umis(spark, sf), m)


LOG = " select n.cell, n.gene, n.umi || ':' || n.num as \"from\", l.umi || ':' || l.num as \"to\" from claim join n on n.node = claim.node join n l on l.node = claim.lead where claim.node <> claim.lead"


@query("umi_merge_log", CLAIMS["directional"] + LOG)
def _(spark, sf):
    return U.merge_log(umis(spark, sf), "directional")


CUT = f"{UM}, rr as (select cell, num, sum(num) over (partition by cell order by num desc range between unbounded preceding and current row) as run, sum(num) over (partition by cell) as total from um), n50 as (select cell, max(num) as n50 from rr where run * 2 >= total group by cell)"


@query("vdj_umi_filter", CLAIMS["adjacency"].replace(UM, CUT).replace("n as (select cell || '|' || gene || '|' || umi as node, cell, gene, umi, num from um)", "n as (select cell || '|' || gene || '|' || umi as node, cell, gene, umi, num from um join n50 using (cell) where num > 0.1 * n50)") + " select l.cell, l.gene, l.umi, l.num from claim join n l on l.node = claim.lead group by all")
def _(spark, sf):
    return U.receptor_filter(umis(spark, sf))


@query("umi_chain", """with recursive c as (select p_partkey as start, p_partkey as cur, 0 as level from part union all select start, cur // 3, level + 1 from c where cur > 2 and level < 12) select cast(start as varchar) as umi, cast(min(cur) as varchar) as corrected from c group by start""")
def _(spark, sf):
    p = t(spark, sf, "part").select(F.lit("c").alias("cell"), F.lit("g").alias("gene"), F.col("p_partkey").alias("k"))
    to = F.expr("k div 3").cast("string")
    log = p.where("k > 2").select("cell", "gene", F.concat(F.col("k").cast("string"), F.lit(":1")).alias("from"), F.concat(to, F.lit(":1")).alias("to"))
    return U.follow_merges(p.select("cell", "gene", F.col("k").cast("string").alias("umi")), log, recursive=True).select("umi", "corrected")


@query("adapter_fuzzy")
def _(spark, sf):
    return M.trim(reads(spark, sf).select("event_id", "seq"), "seq", [("ACGYACGRA", "3"), ("TTGCA", "5")], overlap=4)


@query("leader_search")
def _(spark, sf):
    return M.leaders(reads(spark, sf).select("event_id", "seq"), "seq", [("L1", "ACGTACGTAC"), ("L2", "TTGACCAGTA")])


@query("region_slices", "with p as (select doc_id, text, split_part(text, ' ', 2) as fwr1, split_part(text, ' ', 4) as cdr1 from documents), a as (select *, cast(case when fwr1 = '' then 1 else strpos(text, fwr1) end as integer) as fwr1_start from p), b as (select *, case when fwr1_start > 0 then cast(fwr1_start + length(fwr1) as integer) else 0 end as nxt from a) select doc_id, fwr1_start, cast(case when nxt = 0 then 0 when cdr1 = '' then case when nxt <= length(text) + 1 then nxt else 0 end when strpos(substr(text, nxt), cdr1) = 0 then 0 else nxt - 1 + strpos(substr(text, nxt), cdr1) end as integer) as cdr1_start from b")
def _(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "text", F.split_part("text", F.lit(" "), F.lit(2)).alias("fwr1"), F.split_part("text", F.lit(" "), F.lit(4)).alias("cdr1"))
    return M.regions(d, "text", ["fwr1", "cdr1"]).select("doc_id", "fwr1_start", "cdr1_start")


@query("gene_hit", "with h as (select p_partkey, 'IGHV' || p_size || '*0' || (p_partkey % 3) || '(300):(' || p_size || '-' || (p_size + 20) || '):(1-20):99.1' as hit from part) select p_partkey, split_part(split_part(hit, '(', 1), '*', 1) as gene, cast(regexp_extract(hit, ':\\((\\d+)-(\\d+)\\)', 1) as integer) as start, cast(regexp_extract(hit, ':\\((\\d+)-(\\d+)\\)', 2) as integer) as \"end\" from h")
def _(spark, sf):
    from ..sources.receptors import parse_hit

    s = F.col("p_size").cast("string")
    hit = F.concat(F.lit("IGHV"), s, F.lit("*0"), (F.col("p_partkey") % 3).cast("string"), F.lit("(300):("), s, F.lit("-"), (F.col("p_size") + 20).cast("string"), F.lit("):(1-20):99.1"))
    return t(spark, sf, "part").select("p_partkey", parse_hit(hit).alias("h")).select("p_partkey", "h.gene", "h.start", "h.end")


@query("gene_positions", "with c as (select l_orderkey as contig, l_linenumber as nth, 'IGHV' || (l_suppkey % 9) as gene, l_partkey % 100 as start from lineitem), w as (select contig, min_by(gene, nth * 1000 + cast(substr(gene, 5) as integer)) as call from c group by contig) select contig, call, min(start) as start, count(*) as hits from c join w using (contig) where gene = call group by all")
def _(spark, sf):
    c = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("contig"), F.col("l_linenumber").alias("nth"), F.concat(F.lit("IGHV"), (F.col("l_suppkey") % 9).cast("string")).alias("gene"), (F.col("l_partkey") % 100).alias("start"))
    called = c.groupBy("contig").agg(F.min_by("gene", F.struct("nth", "gene")).alias("call"))
    return K.gene_positions(called, c)


@query("cell_from_contig", "select l_orderkey, l_linenumber, regexp_replace(l_orderkey || '_contig_' || l_linenumber, '_.*', '') as cell from lineitem")
def _(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", N.cell_of(F.concat(F.col("l_orderkey").cast("string"), F.lit("_contig_"), F.col("l_linenumber").cast("string"))).alias("cell"))


@query("ref_rename", "with r as (select s_suppkey, case when s_suppkey % 4 = 0 then 'XX' else 'TR' || s_suppkey || 'V1' end || '|x' as name from supplier), k as (select s_suppkey, regexp_extract(name, '((TR|IG)\\S+?)[|\\s:]', 1) as base from r) select s_suppkey, base || '_' || row_number() over (order by s_suppkey) as name from k where base <> ''")
def _(spark, sf):
    name = F.concat(F.when(F.col("s_suppkey") % 4 == 0, F.lit("XX")).otherwise(F.concat(F.lit("TR"), F.col("s_suppkey").cast("string"), F.lit("V1"))), F.lit("|x"))
    return N.numbered_references(t(spark, sf, "supplier").select("s_suppkey", name.alias("name")), "name", "s_suppkey")


@query("contig_projection", "select l_orderkey || '_' || l_linenumber as contig_id, cast(l_orderkey as varchar) as barcode, true as is_cell, l_quantity >= 30 as high_confidence, cast(floor(l_quantity) as bigint) as reads, l_linenumber as umis, '' as fwr1, '' as d_gene, case when l_returnflag = 'R' then 'IGH' else 'TRA' end as chain from lineitem")
def _(spark, sf):
    li = t(spark, sf, "lineitem")
    key = F.col("l_orderkey").cast("string")
    d = li.select(F.concat_ws("_", key, F.col("l_linenumber").cast("string")).alias("sequence_id"), key.alias("cell_id"), (F.col("l_quantity") >= 30).alias("high_confidence"), F.floor("l_quantity").alias("consensus_count"), F.col("l_linenumber").alias("duplicate_count"), F.when(F.col("l_returnflag") == "R", "IGH").otherwise("TRA").alias("locus"))
    return K.contig_annotations(d).select("contig_id", "barcode", "is_cell", "high_confidence", "reads", "umis", "fwr1", "d_gene", "chain")


@query("chain_share", "select round(cast(count(*) filter (l_returnflag = 'R') as double) / count(*), 9) as igh, round(cast(count(*) filter (l_returnflag <> 'R') as double) / count(*), 9) as tra from lineitem where l_quantity > 5")
def _(spark, sf):
    d = t(spark, sf, "lineitem").where("l_quantity > 5").select(F.when(F.col("l_returnflag") == "R", "IGH").otherwise("TRA").alias("chain"))
    return K.chain_counts(d, "chain", ["IGH", "TRA"])
