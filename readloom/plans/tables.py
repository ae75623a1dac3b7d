"""Annotation, join, set, marker, report and scalar queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import clones as V
from ..operators import intervals as I
from ..operators import markers as K
from ..operators import reports as P
from ..operators.ranking import ordinals
from ..sources import annotation as G
from ..sources.text import ascii_only
from .base import READS, query, reads, t
from .counts import CELLS, DET, cells, cnt

GTF = """gtf as (select p_partkey as line, case when p_partkey % 10 = 0 then 'chrM' else 'chr' || (p_partkey % 3) end as chrom, case cast(p_partkey % 3 as integer) when 0 then 'gene' when 1 then 'exon' else 'CDS' end as feature, cast(p_size as bigint) as start, cast(p_size + p_partkey % 7 as bigint) as "end",
'gene_id "G' || (p_partkey % 401) || '"; gene_name "' || (case when p_partkey % 20 = 0 then 'mt-' else '' end) || replace(p_brand, ' ', '') || '"; gene_type "' || (case when p_partkey % 5 = 0 then 'lncRNA' else 'protein_coding' end) || '";' as attributes from part),
g as (select *, 'G' || (line % 401) as gene_id, (case when line % 20 = 0 then 'mt-' else '' end) || regexp_extract(attributes, 'gene_name "([^"]*)"', 1) as x, regexp_extract(attributes, 'gene_name "([^"]*)"', 1) as name from gtf)"""


def gtf(spark, sf):
    k = F.col("p_partkey")
    chrom = F.when(k % 10 == 0, "chrM").otherwise(F.concat(F.lit("chr"), (k % 3).cast("string")))
    feature = F.when(k % 3 == 0, "gene").when(k % 3 == 1, "exon").otherwise("CDS")
    att = F.concat(F.lit('gene_id "G'), (k % 401).cast("string"), F.lit('"; gene_name "'), F.when(k % 20 == 0, "mt-").otherwise(""), F.replace("p_brand", F.lit(" "), F.lit("")), F.lit('"; gene_type "'), F.when(k % 5 == 0, "lncRNA").otherwise("protein_coding"), F.lit('";'))
    return t(spark, sf, "part").select(k.alias("line"), chrom.alias("chrom"), feature.alias("feature"), F.col("p_size").cast("long").alias("start"), (F.col("p_size") + k % 7).cast("long").alias("end"), att.alias("attributes"))


@query("gtf_first_seen", f"with {GTF}, f as (select gene_id, min(line) as first, min_by(chrom, line) as chrom, min_by(name, line) as name from g where feature in ('gene', 'transcript', 'exon') group by gene_id) select gene_id, case when chrom in ('chrM', 'MT', 'mt') and not regexp_matches(name, '^(MT|mt|Mt)-') then 'MT-' || name else name end as symbol, cast(row_number() over (order by first) as integer) as ordinal from f")
def _(spark, sf):
    return G.gene_symbols(gtf(spark, sf))


@query("gtf_biotypes", f"with {GTF} select gene_id, case when regexp_extract(attributes, 'gene_type \"([^\"]*)\"', 1) in ('lincRNA', 'antisense', 'lncRNA') then 'lnc' else 'coding' end as kind from g where feature = 'gene'")
def _(spark, sf):
    return G.biotypes(gtf(spark, sf))


@query("gtf_feature_stat", f"with {GTF} select feature, chrom, count(*) as n from g group by all order by n")
def _(spark, sf):
    return G.feature_stats(gtf(spark, sf))


@query("gtf_group", f"with {GTF} select line, chrom, cast(sum(cast(feature = 'gene' as integer)) over (partition by chrom order by line rows between unbounded preceding and current row) as bigint) as block from g")
def _(spark, sf):
    return G.gene_blocks(gtf(spark, sf)).select("line", "chrom", "block")


@query("gtf_dup", f"with {GTF} select gene_id, 'duplicate' as problem from g where feature = 'gene' group by gene_id having count(*) > 1")
def _(spark, sf):
    return G.problems(gtf(spark, sf))


@query("attr_map", f"with {GTF} select line, gene_id, name as gene_name, regexp_extract(attributes, 'gene_type \"([^\"]*)\"', 1) as gene_type, cast(3 as integer) as n from g")
def _(spark, sf):
    m = gtf(spark, sf).select("line", G.attributes().alias("m"))
    return m.select("line", *[F.try_element_at("m", F.lit(c)).alias(c) for c in ("gene_id", "gene_name", "gene_type")], F.size("m").alias("n"))


BLOCK = GTF + ", b as (select *, sum(cast(feature = 'gene' as integer)) over (partition by chrom order by line rows between unbounded preceding and current row) as block from g)"


@query("exon_from_cds", f"with {BLOCK}, c as (select *, max(cast(feature = 'exon' as integer)) over (partition by chrom, block) as has from b) select line, feature from c union all select line, 'exon' from c where has = 0 and feature = 'CDS'")
def _(spark, sf):
    return G.exons_from_cds(G.gene_blocks(gtf(spark, sf)), ["chrom", "block"]).select("line", "feature")


@query("gene_id_clean", f"with {GTF} select line, 'gene_id ' || gene_id || '; gene_name \"' || name || '\"; gene_type \"' || regexp_extract(attributes, 'gene_type \"([^\"]*)\"', 1) || '\";' as attributes from g")
def _(spark, sf):
    return gtf(spark, sf).select("line", G.unquoted_ids().alias("attributes"))


@query("feature_fallback", f"with {GTF} select case when count(*) filter (feature = 'transcript') > 0 then 'transcript' else 'gene' end as feature, count(*) filter (feature = 'exon') > 0 as has_exon from g")
def _(spark, sf):
    return G.counted_feature(gtf(spark, sf))


@query("biotype_blocks", f"with {BLOCK}, k as (select chrom, block from b where feature = 'gene' and attributes like '%protein_coding%') select line, b.chrom, cast(b.block as bigint) as block from b join k using (chrom, block)")
def _(spark, sf):
    return G.blocks_of_biotypes(G.gene_blocks(gtf(spark, sf)), ["protein_coding"]).select("line", "chrom", "block")


@query("long_sequences", "select doc_id, length(text) as length from documents where length(text) > 5000")
def _(spark, sf):
    d = t(spark, sf, "documents").select(F.col("doc_id").alias("name"), F.col("text").alias("seq"))
    return I.long_sequences(d, 5000).withColumnRenamed("name", "doc_id")


@query("fasta_lengths", "with r as (select doc_id, string_split(text, chr(10)) as lines from documents) select doc_id, cast(len(lines) as integer) as lines, cast(list_sum(list_transform(lines, lambda x: length(x))) as bigint) as length from r")
def _(spark, sf):
    lines = F.split("text", "\n", -1)
    return t(spark, sf, "documents").select("doc_id", F.size(lines).alias("lines"), F.aggregate(lines, F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("length"))


#: Codons, miRNA and exons by line number; on both strands, with and without either codon.
@query("bed12", """with r as (select l_orderkey as tx, (l_linenumber * 1000 + l_partkey % 100) * 100 + cast(floor(l_quantity) as bigint) as line, case when l_linenumber = 3 then 'start_codon' when l_linenumber = 5 then 'stop_codon' when l_linenumber = 7 then 'miRNA' when l_partkey % 11 = 0 then 'CDS' else 'exon' end as feature,
 l_linenumber * 1000 + l_partkey % 100 as s, l_linenumber * 1000 + l_partkey % 100 + cast(floor(l_quantity) as bigint) as e, l_returnflag as f, case when l_orderkey % 2 = 0 then '+' else '-' end as strand from lineitem),
x as (select tx, arg_min(f, line) as chrom, any_value(strand) as strand, min(s) as b, arg_max(e, (s, line)) as e, list(struct_pack(s := s, line := line, e := e) order by s, line) as ex from r where feature in ('exon', 'miRNA') group by tx),
c as (select tx, arg_max(s, line) filter (feature = 'start_codon') as sc, arg_max(e, line) filter (feature = 'stop_codon') as tc from r group by tx),
k as (select x.*, case when strand = '-' then tc - 2 else sc end as cds, case when strand = '-' then sc + 2 else tc end as cde from x join c using (tx))
select chrom, b - 1 as start, e as "end", tx, strand, coalesce(cds, b) - 1 as thick_start, coalesce(cde, e) as thick_end, cast(len(ex) as integer) as blocks, array_to_string(list_transform(ex, lambda q: cast(q.e - q.s + 1 as varchar)), ',') as sizes, array_to_string(list_transform(ex, lambda q: cast(q.s - b as varchar)), ',') as starts from k""")
def _(spark, sf):
    s, n = F.col("l_linenumber").cast("long") * 1000 + F.col("l_partkey") % 100, F.col("l_linenumber")
    feature = F.when(n == 3, "start_codon").when(n == 5, "stop_codon").when(n == 7, "miRNA").when(F.col("l_partkey") % 11 == 0, "CDS").otherwise("exon")
    # rows of one line number are in the order of the file
    line = F.struct((s * 100 + F.floor("l_quantity")).alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    r = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_returnflag").alias("chrom"), F.when(F.col("l_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"), feature.alias("feature"), s.alias("start"), (s + F.floor("l_quantity")).alias("end"), line.alias("line"))
    return G.bed12(r)


@query("clean_text", "select doc_id, regexp_replace(text, '[^\\x00-\\x7F]+', 'N', 'g') as text from documents")
def _(spark, sf):
    return t(spark, sf, "documents").select("doc_id", ascii_only("text").alias("text"))


@query("log_metric", "with l as (select 'Number of input reads |\t' || page_id as value from pages union all select 'Mapping efficiency:\t' || (page_id % 100) || '.5%' from pages), m as (select regexp_extract(value, 'Number of input reads \\|\\s+(\\d+)', 1) as a, regexp_extract(value, 'Mapping efficiency:\\s+([\\d.]+)%', 1) as b from l) select max(case when a <> '' then cast(a as double) end) as input_reads, max(case when b <> '' then cast(b as double) end) as efficiency from m")
def _(spark, sf):
    from ..sources.files import BISMARK_LOG, STAR_LOG, log_metrics

    p = t(spark, sf, "pages").select(F.explode(F.array(F.concat(F.lit("Number of input reads |\t"), F.col("page_id").cast("string")), F.concat(F.lit("Mapping efficiency:\t"), (F.col("page_id") % 100).cast("string"), F.lit(".5%")))).alias("value"))
    return log_metrics(p, {"input_reads": STAR_LOG["input_reads"], "efficiency": BISMARK_LOG["efficiency"]})


# joins and sets


@query("semi_cells", f"with {DET}, {CELLS} select * from cnt where cell in (select cell from cells)")
def _(spark, sf):
    return cnt(spark, sf).join(cells(spark, sf), "cell", "left_semi")


@query("anti_cells", f"with {DET}, {CELLS} select * from cnt where cell not in (select cell from cells)")
def _(spark, sf):
    return cnt(spark, sf).join(cells(spark, sf), "cell", "left_anti")


@query("inner_merge3", "select o_orderkey, c_name, n_name, o_totalprice as price_x, c_acctbal as price_y from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey")
def _(spark, sf):
    o, c, n = t(spark, sf, "orders"), t(spark, sf, "customer"), t(spark, sf, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation is a fixed list
    return j.select("o_orderkey", "c_name", "n_name", F.col("o_totalprice").alias("price_x"), F.col("c_acctbal").alias("price_y"))


@query("left_annotate", "select p_partkey, coalesce(s_name, 'na') as annotation from part left join supplier on p_partkey = s_suppkey")
def _(spark, sf):
    p, s = t(spark, sf, "part"), t(spark, sf, "supplier")
    return p.join(s, p.p_partkey == s.s_suppkey, "left").select("p_partkey", F.coalesce("s_name", F.lit("na")).alias("annotation"))


@query("lookup_map", f"with {READS} select event_id, gene, coalesce(case gene when 'click' then 'c' when 'view' then 'v' end, gene) as mapped from reads")
def _(spark, sf):
    m = F.create_map(*[F.lit(x) for x in ("click", "c", "view", "v")])
    return reads(spark, sf).select("event_id", "gene", F.coalesce(F.try_element_at(m, F.col("gene")), "gene").alias("mapped"))


@query("flags", f"with {DET}, {CELLS}, o as (select distinct cast(o_custkey as varchar) as cell from orders) select cells.cell, o.cell is not null as tcr, s.cell is not null as bcr from cells left join o using (cell) left join (select distinct cell from cnt) s using (cell)")
def _(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("cell"))
    return V.flags(cells(spark, sf), tcr=o, bcr=cnt(spark, sf))


@query("sets_union", "select c_nationkey as k from customer union all select s_nationkey from supplier")
def _(spark, sf):
    return t(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).unionByName(t(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")))


@query("sets_intersect", "select c_custkey as k from customer intersect select o_custkey from orders")
def _(spark, sf):
    return t(spark, sf, "customer").select(F.col("c_custkey").alias("k")).intersect(t(spark, sf, "orders").select(F.col("o_custkey").alias("k")))


@query("sets_except", "select o_custkey as k from orders except select o_custkey from orders where o_orderstatus = 'F'")
def _(spark, sf):
    o = t(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("k")).subtract(o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")))


@query("sets_distinct", "select distinct o_custkey as k from (select o_custkey from orders union all select c_custkey from customer)")
def _(spark, sf):
    return t(spark, sf, "orders").select(F.col("o_custkey").alias("k")).union(t(spark, sf, "customer").select("c_custkey")).distinct()


@query("first_seen", f"with {READS} select cell, min(event_id) as first from reads group by cell")
def _(spark, sf):
    return reads(spark, sf).groupBy("cell").agg(F.min("event_id").alias("first"))


@query("value_counts", "select o_orderpriority, count(*) as n from orders group by 1")
def _(spark, sf):
    return t(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("suffix_order", "select c_custkey, cast(regexp_extract('clonotype' || c_custkey, '(\\d+)$', 1) as bigint) as suffix, cast(row_number() over (order by c_custkey) as integer) as rank from customer")
def _(spark, sf):
    name = F.concat(F.lit("clonotype"), F.col("c_custkey").cast("string"))
    d = t(spark, sf, "customer").select("c_custkey", F.regexp_extract(name, r"(\d+)$", 1).cast("long").alias("suffix"))
    return ordinals(d, "suffix", "rank", "int")


@query("drop_empty", "select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where l_discount > 0")
def _(spark, sf):
    return t(spark, sf, "lineitem").where("l_discount > 0").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# markers

MK = "mk as (select l_returnflag as cluster, l_partkey as gene, round(sum(l_extendedprice), 2) as fc, round(avg(l_discount), 9) as p from lineitem group by all)"


def marks(spark, sf):
    return t(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("cluster"), F.col("l_partkey").alias("gene")).agg(F.round(F.sum("l_extendedprice"), 2).alias("fc"), F.round(F.avg("l_discount"), 9).alias("p"))


@query("top_markers", f"with {MK}, r as (select *, row_number() over (partition by cluster order by p, fc desc, gene) as r from mk) select cluster, gene, fc, p from r where r <= 20")
def _(spark, sf):
    return K.top_markers(marks(spark, sf), "cluster", ["p", F.desc("fc"), "gene"], 20)


@query("pivot_markers", "select l_suppkey as gene, round(avg(case when l_returnflag = 'A' then l_quantity end), 6) as \"A\", round(avg(case when l_returnflag = 'N' then l_quantity end), 6) as \"N\", round(avg(case when l_returnflag = 'R' then l_quantity end), 6) as \"R\" from lineitem group by 1")
def _(spark, sf):
    d = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("gene")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.round(F.avg("l_quantity"), 6))
    return d


@query("biotype_split", f"with {GTF}, b as (select distinct line, case when line % 5 = 0 then 'lncRNA' else 'protein_coding' end as biotype from g), {MK} select cluster, gene, fc, biotype from mk join b on gene = line where biotype = 'lncRNA'")
def _(spark, sf):
    b = gtf(spark, sf).select(F.col("line").alias("gene"), G.attribute("gene_type").alias("biotype"))
    return marks(spark, sf).join(b, "gene").where("biotype = 'lncRNA'").select("cluster", "gene", "fc", "biotype")


@query("marker_pct", f"""with {DET}, {CELLS}, grp as (select cell, case when cast(cell as bigint) % 2 = 0 then 'even' else 'odd' end as cluster from (select distinct cell from cnt)),
nm as (select cell, gene, 10000 * cast(umis as double) / cast(sum(umis) over (partition by cell) as double) as x from cnt),
sz as (select cluster, count(*) as cells from grp group by 1), al as (select sum(cells) as total from sz),
p as (select gene, cluster, count(*) as w, sum(x) as s from nm join grp using (cell) group by all), q as (select *, sum(w) over (partition by gene) as wa, sum(s) over (partition by gene) as sa from p)
select gene, cluster, round(cast(w as double) / cells, 6) as pct_1, round(cast(wa - w as double) / cast(total - cells as double), 6) as pct_2, round(log2((s / cells + 1) / ((sa - s) / cast(total - cells as double) + 1)), 6) as log2_fc from q join sz using (cluster), al""")
def _(spark, sf):
    c = cnt(spark, sf)
    g = c.select("cell").distinct().withColumn("cluster", F.when(F.col("cell").cast("long") % 2 == 0, "even").otherwise("odd"))
    return K.marker_table(c, g)


GRP = "grp as (select cell, case when cast(cell as bigint) % 2 = 0 then 'even' else 'odd' end as cluster from (select distinct cell from cnt))"


def halves(c):
    return c.select("cell").distinct().withColumn("cluster", F.when(F.col("cell").cast("long") % 2 == 0, "even").otherwise("odd"))


@query("variable_genes", f"with {DET}, nm as (select cell, gene, ln(1 + 10000 * cast(umis as double) / cast(sum(umis) over (partition by cell) as double)) as x from cnt), n as (select count(distinct cell) as cells from cnt), p as (select gene, sum(x) as s, sum(x * x) as q from nm group by gene) select gene, round(((q - s * (s / cells)) / greatest(cells - 1, 1)) / (s / cells), 6) as dispersion from p, n order by dispersion desc, gene limit 4")
def _(spark, sf):
    return K.variable_genes(cnt(spark, sf), 4)


@query("rank_test", f"""with {DET}, {GRP}, full_ as (select g.gene, grp.cell, cluster, coalesce(umis, 0) as u from (select distinct gene from cnt) g cross join grp left join cnt c on c.gene = g.gene and c.cell = grp.cell),
r as (select *, rank() over (partition by gene order by u) as lo, count(*) over (partition by gene, u) as m from full_), a as (select gene, cluster, sum(lo + (m - 1) / 2.0) as r, cast(count(*) as double) as n1 from r group by all),
ti as (select gene, sum(cast(m * m - 1 as double)) as ties, cast(count(*) as double) as n from r group by gene)
select gene, cluster, round((r - n1 * (n + 1) / 2) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))), 6) as z from a join ti using (gene)""")
def _(spark, sf):
    c = cnt(spark, sf)
    return K.rank_test(c, halves(c))


@query("find_markers", f"""with {DET}, {GRP}, tot as (select cell, sum(umis) as t from cnt group by cell), nm as (select c.cell, gene, 10000 * cast(umis as double) / cast(t as double) as v from cnt c join tot using (cell)),
full_ as (select g.gene, grp.cell, cluster, coalesce(ln(1 + v), 0) as u, coalesce(v, 0) as v, v is not null as has from (select distinct gene from cnt) g cross join grp left join nm on nm.gene = g.gene and nm.cell = grp.cell),
r as (select *, rank() over (partition by gene order by u) as lo, count(*) over (partition by gene, u) as m from full_),
a as (select gene, cluster, sum(lo + (m - 1) / 2.0) as r, cast(count(*) as double) as n1, count_if(has) as w, sum(v) as s from r group by all),
ti as (select gene, sum(cast(m * m - 1 as double)) as ties, cast(count(*) as double) as n, count_if(has) as wa, sum(v) as sa from r group by gene),
m as (select gene, cluster, round(w / n1, 6) as pct_1, round((wa - w) / (n - n1), 6) as pct_2, round(log2((s / n1 + 1) / ((sa - s) / (n - n1) + 1)), 6) as log2_fc, r - n1 * (n + 1) / 2 as above, sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))) as sd from a join ti using (gene)),
z as (select *, case when abs(above) <= 0.5 then 0 else (above - sign(above) * 0.5) / sd end as z from m where greatest(pct_1, pct_2) >= 0.1 and log2_fc >= 0.001),
y as (select *, abs(z) as x from z),
p as (select *, least(0, ln(2) + case when x < 3 then ln(0.5 - exp(-x * x / 2) / sqrt(2 * pi()) * list_reduce(range(120, 0, -1), lambda f, k: x + f * x * x / (2 * k + 1), x))
  else -x * x / 2 - ln(2 * pi()) / 2 - ln(list_reduce(range(400, 0, -1), lambda f, k: x + k / f, x)) end) as log_p from y)
select cluster, gene, pct_1, pct_2, log2_fc, round(z, 6) as z, round(log_p, 6) as log_p, round(least(0, log_p + ln((select count(distinct gene) from cnt))), 6) as log_p_adj from p where exp(log_p) < 0.9""")
def _(spark, sf):
    c = cnt(spark, sf)
    d = K.find_markers(c, halves(c), least_change=0.001, keep=0.9)
    return d.select("cluster", "gene", "pct_1", "pct_2", "log2_fc", *[F.round(x, 6).alias(x) for x in ("z", "log_p", "log_p_adj")])


@query("cluster_cells")
def _(spark, sf):
    """Communities of the graph of shared neighbours of the embeddings, at the resolution that names clusters."""
    from ..operators import clusters as U

    return U.communities(neighbour_graph(spark, sf)).withColumnRenamed("node", "vec_id")


def neighbour_graph(spark, sf):
    from ..operators import clusters as U

    e = t(spark, sf, "embeddings")
    return U.shared_neighbours(K.knn(e, e, "vec_id", "embedding", U.neighbours_for(e.count())), "vec_id")


@query("marker_filter", f"""with {DET}, {CELLS}, grp as (select cell, case when cast(cell as bigint) % 2 = 0 then 'even' else 'odd' end as cluster from (select distinct cell from cnt)),
nm as (select cell, gene, 10000 * cast(umis as double) / cast(sum(umis) over (partition by cell) as double) as x from cnt),
sz as (select cluster, count(*) as cells from grp group by 1), al as (select sum(cells) as total from sz),
p as (select gene, cluster, count(*) as w, sum(x) as s from nm join grp using (cell) group by all), q as (select *, sum(w) over (partition by gene) as wa, sum(s) over (partition by gene) as sa from p),
m as (select gene, cluster, round(cast(w as double) / cells, 6) as pct_1, round(cast(wa - w as double) / cast(total - cells as double), 6) as pct_2, round(log2((s / cells + 1) / ((sa - s) / cast(total - cells as double) + 1)), 6) as log2_fc from q join sz using (cluster), al)
select * from m where greatest(pct_1, coalesce(pct_2, 0)) >= 0.1 and log2_fc >= 0.001""")
def _(spark, sf):
    from ..operators.clusters import filtered_markers

    c = cnt(spark, sf)
    return filtered_markers(K.marker_table(c, halves(c)), 0.1, 0.001)


@query("regressed_scaling", f"""with {DET}, x as (select cell, gene, ln(1 + 10000 * cast(umis as double) / cast(sum(umis) over (partition by cell) as double)) as x from cnt), c as (select cell, cast(sum(umis) as double) as c from cnt group by cell),
g as (select distinct gene from cnt), full_ as (select c.cell, g.gene, c, coalesce(x, 0) as y from c cross join g left join x on x.cell = c.cell and x.gene = g.gene),
f as (select gene, regr_slope(y, c) as b, regr_intercept(y, c) as a from full_ group by gene), r as (select cell, gene, y - a - coalesce(b, 0) * c as r from full_ join f using (gene)), d as (select gene, sqrt(sum(r * r) / (count(*) - 1)) as sd from r group by gene)
select cell, string_agg(format('{{:.4f}}', round(greatest(-10, least(10, r / (case when sd < 1e-9 then 1 else sd end))) + 1e-9, 4)), ',' order by gene) as features from r join d using (gene) group by cell""")
def _(spark, sf):
    from ..operators.clusters import scaled

    c = cnt(spark, sf)
    x = c.select("cell", "gene", F.log1p(10000 * F.col("umis") / F.sum("umis").over(Window.partitionBy("cell"))).alias("x"))
    d = scaled(x, c.select("gene").distinct(), c.groupBy("cell").agg(F.sum("umis").cast("double").alias("c")))
    return d.select("cell", F.array_join(F.transform("features", lambda v: F.format_string("%.4f", F.round(v + 1e-9, 4))), ",").alias("features"))


@query("standardised_variance")
def _(spark, sf):
    from ..operators.clusters import standardised_variance

    return standardised_variance(cnt(spark, sf), 2000)


@query("methyl_trim")
def _(spark, sf):
    from ..operators.matching import methyl_trim

    d = reads(spark, sf).select("event_id", F.concat("seq", "seq", "seq").alias("r1"), F.reverse(F.concat("seq", "seq")).alias("r2"))
    return methyl_trim(d, "r1", "r2", "TYGTCGGYAG", "CTRCCGACRA").select("event_id", "r1_kept", "r2_kept")


@query("hash_sample", f"with {READS} select event_id from reads where cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) < floor(0.3 * 4294967296)")
def _(spark, sf):
    from ..operators.names import sampled

    return sampled(reads(spark, sf), "event_id", 0.3).select("event_id")


@query("first_reads", f"with {READS} select event_id, cell from reads order by event_id limit 1000")
def _(spark, sf):
    from ..operators.reads import first_reads

    return first_reads(reads(spark, sf).select("event_id", "cell"), "event_id", 1000)


@query("clone_matrix", "with c as (select o_orderkey as cell, case when o_orderkey % 3 = 0 then 'TRB' when o_orderkey % 3 = 1 then 'TRA' end as vdj, case when o_orderkey % 2 = 0 then 'TRA' end as vj, o_orderstatus = 'F' as p_vdj, o_orderstatus <> 'P' as p_vj, o_custkey % 9 as umis from orders) select round(cast(count(*) filter (vdj = 'TRB' and vj = 'TRA') as double) / count(*), 9) as pair, round(cast(count(*) filter (p_vdj and vj = 'TRA') as double) / count(*), 9) as tra, round(cast(count(*) filter (p_vj and vdj = 'TRB') as double) / count(*), 9) as trb, coalesce(median(case when vdj = 'TRB' then umis end), 0) as trb_umis from c")
def _(spark, sf):
    k = F.col("o_orderkey")
    c = t(spark, sf, "orders").select(F.when(k % 3 == 0, "TRB").when(k % 3 == 1, "TRA").alias("vdj"), F.when(k % 2 == 0, "TRA").alias("vj"), (F.col("o_orderstatus") == "F").alias("p_vdj"), (F.col("o_orderstatus") != "P").alias("p_vj"), (F.col("o_custkey") % 9).alias("umis"))
    share = lambda x: F.round(F.count_if(x) / F.count("*"), 9)
    a, b = F.col("vj") == "TRA", F.col("vdj") == "TRB"
    # which flag goes with which chain is as the contract has it
    return c.agg(share(b & a).alias("pair"), share(F.col("p_vdj") & a).alias("tra"), share(F.col("p_vj") & b).alias("trb"), F.coalesce(F.median(F.when(b, F.col("umis"))), F.lit(0.0)).alias("trb_umis"))


@query("marker_map", "with m as (select p_type, trim(unnest(string_split(p_name || ',' || p_brand, ','))) as gene from part) select gene, array_to_string(list_sort(list(distinct p_type)), ';') as types from m group by gene")
def _(spark, sf):
    return P.marker_map(t(spark, sf, "part"), "p_type", ["p_name", "p_brand"])


@query("head10", "select l_returnflag, l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_returnflag, l_extendedprice desc, l_orderkey, l_linenumber limit 10")
def _(spark, sf):
    d = t(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return d.orderBy("l_returnflag", F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10)


# reports

RT = "select round(cast(count(*) filter (o_orderstatus = 'F') + count(*) filter (o_orderstatus = 'O') as double) / count(*), 9) as mapped, round(cast(count(*) filter (o_orderpriority < '3') as double) / count(*), 9) as confident, cast(floor(count(*) / 2) as bigint) as pairs from orders"


@query("mapping_rates", RT)
def _(spark, sf):
    s = F.col("o_orderstatus")
    return P.mapping_rates(t(spark, sf, "orders"), s == "F", s == "O", F.col("o_orderpriority") < "3")


KINDS = ["protein_coding", "lincRNA", "antisense", "rRNA", "Mt_rRNA", "snoRNA", "rRNA_pseudogene"]
BIO = "case ['protein_coding', 'lincRNA', 'antisense', 'rRNA', 'Mt_rRNA', 'snoRNA', 'rRNA_pseudogene'][p_partkey % 7 + 1] when 'protein_coding' then 'protein_coding' when 'lincRNA' then 'lncRNA' when 'antisense' then 'lncRNA' when 'rRNA' then 'rRNA' when 'Mt_rRNA' then 'Mt_rRNA' else 'others' end"


def biotype():
    return P.biotype_class(F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("p_partkey") % 7 + 1).cast("int")))


@query("biotype_class", f"select p_partkey, {BIO} as class from part")
def _(spark, sf):
    return t(spark, sf, "part").select("p_partkey", biotype().alias("class"))


@query("biotype_share", f"with b as (select {BIO} as class, sum(p_size) as n from part group by 1) select class, cast(n as bigint) as n, round(cast(n as double) / cast(sum(n) over () as double), 9) as share from b")
def _(spark, sf):
    return P.shares(t(spark, sf, "part"), biotype(), "p_size")


@query("format_row", "select o_orderkey, format('{:.2f}%', cast(o_orderkey % 1000 as double) / 1000 * 100) as pct, format('{:,}', o_orderkey) as num from orders")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", P.percent((F.col("o_orderkey") % 1000) / 1000).alias("pct"), P.comma(F.col("o_orderkey")).alias("num"))


@query("shade_bucket", "select c_custkey, cast(case when c_custkey % 101 = 100 then 10 when c_custkey % 101 = 0 then -1 else floor((c_custkey % 101) / 10) end as bigint) as shade from customer")
def _(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", P.shade_percent(F.col("c_custkey") % 101).alias("shade"))


@query("joint_summary", f"with {DET}, a as (select count(distinct cell) as cells, cast(sum(reads) as bigint) as reads, cast(sum(umis) as bigint) as umis from cnt), b as (select count(*) as lines, round(avg(l_discount), 9) as rate from lineitem) select * from a, b")
def _(spark, sf):
    return P.joint_summary(cnt(spark, sf), t(spark, sf, "lineitem"), "l_discount")


# scalar functions


@query("regex_set", "select p_partkey, regexp_extract(p_name, '([a-z]+)', 1) as first, cast(len(regexp_extract_all(p_name, '[a-z]+')) as integer) as words, regexp_replace(p_name, '[aeiou]', '*', 'g') as masked, regexp_matches(p_name, '^[a-m]') as early from part")
def _(spark, sf):
    n = F.col("p_name")
    return t(spark, sf, "part").select("p_partkey", F.regexp_extract(n, "([a-z]+)", 1).alias("first"), F.size(F.regexp_extract_all(n, F.lit("[a-z]+"), F.lit(0))).alias("words"), F.regexp_replace(n, "[aeiou]", "*").alias("masked"), n.rlike("^[a-m]").alias("early"))


@query("json_get", "select event_id, json_extract_string(props, '$.k') as k, cast(json_extract_string(props, '$.k') as bigint) + 1 as k1 from events")
def _(spark, sf):
    return t(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), (F.from_json("props", "k long")["k"] + 1).alias("k1"))


@query("math_set", "select gene, cast(floor(count(*) / 7) as bigint) as q, round(log2(count(*)), 9) as l, round(avg(value), 6) as mean, round(median(value), 6) as med, round(stddev_samp(value), 6) as sd, round(sum(value), 4) as total, cast(greatest(15, floor(2 * log2(count(*)))) as bigint) as k from (select event_type as gene, value from events) group by gene")
def _(spark, sf):
    n = F.count("*")
    return reads(spark, sf).groupBy("gene").agg(F.floor(n / 7).alias("q"), F.round(F.log2(n), 9).alias("l"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("med"), F.round(F.stddev_samp("value"), 6).alias("sd"), F.round(F.sum("value"), 4).alias("total"), F.greatest(F.lit(15).cast("long"), F.floor(2 * F.log2(n))).alias("k"))


@query("empty_clones", "select cast(null as varchar) as cell_id, c_mktsegment as clone_id, cast(null as integer) as clone_id_by_size, cast(null as varchar) as locus_VDJ, cast(null as varchar) as locus_VJ, cast(null as varchar) as productive_VDJ, cast(null as varchar) as productive_VJ, cast(null as varchar) as junction_VDJ, cast(null as varchar) as junction_VJ, cast(null as varchar) as junction_aa_VDJ, cast(null as varchar) as junction_aa_VJ from customer group by c_mktsegment having count(*) > 1")
def _(spark, sf):
    from ..sinks import CLONE_COLUMNS, with_header

    found = t(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("clone_id")).count().where("count > 1")
    return with_header(found, CLONE_COLUMNS)


@query("json_payload", f"""with {MK}, g as (select cluster, count(*) as genes from mk group by cluster) select '{{"cards":[' || string_agg('{{"cluster":"' || cluster || '","genes":' || genes || '}}', ',' order by cluster) || ']}}' as payload from g""")
def _(spark, sf):
    from ..sinks import json_section

    return json_section(marks(spark, sf).groupBy("cluster").agg(F.count("*").alias("genes")), "cards")


PAGE = """with o as (select o_orderpriority as label, count(*) as n from orders group by 1),
c as (select '"summary":{{"id":0,"name":"Card","title":"Sequencing","data":{{"Number of Reads":"' || format('{:,}', count(*)) || '","Fulfilled":"' || format('{:.2f}%', cast(count(*) filter (o_orderstatus = 'F') as double) / count(*) * 100) || '"}},"description":{{"Number of Reads":"all","Fulfilled":""}}}}' as x from orders),
p as (select '"biotypes":{{"id":1,"name":"PlotlyPie","title":"Pie","data":{{"values":[' || string_agg(n, ',' order by label) || '],"labels":[' || string_agg('"' || label || '"', ',' order by label) || ']}},"description":"parts"}}' as x from o),
b as (select '"top":[' || string_agg('{{"label":"' || label || '","n":' || n || '}}', ',' order by n desc, label) || ']' as x from (select * from o order by n desc, label limit 3))
select '{{' || p.x || ',' || c.x || ',' || b.x || '}}' as payload from c, p, b""".replace("{{", "{").replace("}}", "}")


@query("report_payload", PAGE)
def _(spark, sf):
    o = t(spark, sf, "orders")
    parts = o.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n"))
    fields = {"Number of Reads": P.comma(F.count("*")), "Fulfilled": P.percent(F.count_if(F.col("o_orderstatus") == "F") / F.count("*"))}
    card = o.agg(P.card("Sequencing", fields, 0, texts={"Number of Reads": "all"}).alias("item"))
    return P.payload(summary=card, biotypes=P.pie(parts, "Pie", "label", "n", 1, "parts"), top=P.top_table(parts, ["label", "n"], [F.desc("n"), "label"], 3))


@query("sparse_columns", f"""with {DET}, g as (select gene, row_number() over (order by gene) - 1 as i from (select distinct gene from cnt)), b as (select cell, row_number() over (order by cell) - 1 as j from (select distinct cell from cnt)),
m as (select j, count(*) as n, string_agg(i, ',' order by i) as index, string_agg(umis, ',' order by i) as vals from cnt join g using (gene) join b using (cell) group by j)
select j as cell_idx, cast(coalesce(sum(n) over (order by j rows between unbounded preceding and 1 preceding), 0) as bigint) as ptr, index, vals as values from m""")
def _(spark, sf):
    from ..sinks import sparse_columns

    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return sparse_columns(cnt(spark, sf), "gene", "cell", "umis").select("cell_idx", "ptr", text("index"), text("values"))


@query("metrics_table", """with a as (select count(*) as n, count(*) filter (o_orderstatus = 'F') as f, format('{:,}', count(*)) as text from orders) select 'n,"done, in all",text' as line from a union all select n || ',' || f || ',' || case when contains(text, ',') then '"' || text || '"' else text end from a""")
def _(spark, sf):
    from ..sinks import metrics_table

    return metrics_table(t(spark, sf, "orders").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done, in all"), F.format_number(F.count("*"), 0).alias("text")))


@query("image_uri", "select s_suppkey, 'data:image/png;base64, ' || base64(encode(s_name)) as uri from supplier")
def _(spark, sf):
    return t(spark, sf, "supplier").select("s_suppkey", P.image(F.col("s_name").cast("binary")).alias("uri"))


@query("metrics_line", "with a as (select count(*) as n, format('{:,}', count(*)) as text from orders) select n || ',' || case when contains(text, ',') then '\"' || text || '\"' else text end as line from a")
def _(spark, sf):
    from ..sinks import metrics_row

    return metrics_row(t(spark, sf, "orders").agg(F.count("*").alias("n"), F.format_number(F.count("*"), 0).alias("text")))
