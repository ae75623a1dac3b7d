"""From annotated contigs to clones: filters, single chains, clone names, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .counts import n50

NONE = "None"  # how missing values are written in contig tables


def saturation(consensus: str = "consensus_count", duplicates: str = "duplicate_count") -> Column:
    """1 - duplicates / consensus reads; 0 without consensus reads."""
    return F.when(F.col(consensus) != 0, 1 - F.col(duplicates) / F.col(consensus)).otherwise(F.lit(0.0))


def contig_filter(contigs: DataFrame, prefix: str, least_saturation: float = 0.94, least_sum: int = 3, cell: str = "cell_id", locus: str = "locus", duplicates: str = "duplicate_count") -> DataFrame:
    """Contigs of loci with the prefix (TR or IG), saturation above the limit, in cells whose contigs have least_sum UMIs or more together.

    Adds saturation. Cells without such a contig are gone; null loci are dropped.
    """
    d = contigs.withColumn("saturation", saturation(duplicates=duplicates) if "saturation" not in contigs.columns else F.col("saturation"))
    d = d.where(F.col(locus).startswith(prefix) & (F.col("saturation") > least_saturation))
    return cell_sum(d, least_sum, cell, duplicates).drop("total")


def cell_sum(contigs: DataFrame, least: int, cell: str = "cell_id", duplicates: str = "duplicate_count") -> DataFrame:
    """Contigs, with `total`, of cells whose contigs have at least so many UMIs together."""
    return contigs.withColumn("total", F.sum(duplicates).over(Window.partitionBy(cell))).where(F.col("total") >= least)


def chain_counts(df: DataFrame, chain: str, chains: list[str]) -> DataFrame:
    """One row: the share of rows of each chain."""
    return df.agg(*[F.round(F.count_if(F.col(chain) == c) / F.count("*"), 9).alias(c.lower()) for c in chains])


def kind(clone: str | Column) -> Column:
    """pair, vdj or vj: what a clone name (..._VDJ_<n>_VJ_<m>, either part may be missing) is made of."""
    c = F.col(clone) if isinstance(clone, str) else clone
    vdj, vj = c.contains("VDJ_"), c.contains("_VJ_") | c.startswith("VJ_")
    return F.when(vdj & vj, "pair").when(vdj, "vdj").when(vj, "vj")


def weight(clone: str | Column) -> Column:
    """3 for names with VDJ and VJ, 2 with VDJ, else 1."""
    c = F.col(clone) if isinstance(clone, str) else clone
    return F.when(c.contains("VDJ") & c.contains("VJ"), 3).when(c.contains("VDJ"), 2).otherwise(1)


def number_keys(clone: str, mark: str) -> Column:
    """Every prefix of the number behind `mark` in a name, mark included: a name contains <mark><n> if and only if that is one of them."""
    number = F.regexp_extract(clone, mark + r"(\d+)", 1)
    return F.when(F.length(number) > 0, F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: F.concat(F.lit(mark), F.substring(number, F.lit(1), i)))).otherwise(F.array().cast("array<string>"))


def names_containing(queries: DataFrame, key: str, clones: DataFrame, clone: str, mark: str) -> DataFrame:
    """queries joined with the clones whose name contains the text in `key` (<mark><number>): an equality join on the prefixes of the
    numbers, unanchored as it is meant to be: <mark>1 is in <mark>12."""
    c = clones.select(*clones.columns, F.explode(number_keys(clone, mark)).alias("__key"))
    return queries.join(c, F.col(key) == F.col("__key")).drop("__key")


def _sides(named: DataFrame) -> list[tuple[DataFrame, str, str]]:
    """Rows of single chains with the text that their partners' names contain: (rows, mark, kind)."""
    after = lambda m: F.concat(F.lit(m), F.regexp_extract("clone_id", r"VD?J_(\d+)", 1))
    return [(named.where(kind("clone_id") == "vj").withColumn("__want", after("_VJ_")), "_VJ_", "vj"), (named.where(kind("clone_id") == "vdj").withColumn("__want", after("VDJ_")), "VDJ_", "vdj")]


def weak_single_chains(contigs: DataFrame, share: float = 0.01) -> DataFrame:
    """(sequence_id): contigs of single-chain clones with fewer UMIs than share of the N50 of all contigs that have their chain.

    contigs: sequence_id, clone_id, umi_count. These are the contigs of complete clones whose name contains the chain's
    number and those of single-chain clones of the same kind that do; umi_count of null counts as 0.
    """
    d = contigs.select("sequence_id", "clone_id", F.coalesce("umi_count", F.lit(0)).cast("long").alias("umi_count"))
    d = d.withColumn("__kind", kind("clone_id"))
    out = None
    for rows, mark, side in _sides(d):
        wants = rows.select("__want").distinct()
        name = "clone_id" if mark == "VDJ_" else "__name"
        # a name that begins with VJ_ has its chain number behind the same mark as one that has it further on
        others = d.where(F.col("__kind").isin("pair", side)).withColumn("__name", F.when(F.col("clone_id").startswith("VJ_"), F.concat(F.lit("_"), "clone_id")).otherwise(F.col("clone_id")))
        per = names_containing(wants, "__want", others.select(F.col(name).alias("__n"), F.col("umi_count").alias("__u")), "__n", mark)
        cut = n50(per.select("__want", F.col("__u").alias("umi_count")), "umi_count", ["__want"])
        weak = rows.join(cut, "__want").where(F.col("umi_count") < share * F.col("n50")).select("sequence_id")
        out = weak if out is None else out.unionByName(weak)
    return out


def drop_weak_single_chains(contigs: DataFrame, share: float = 0.01) -> DataFrame:
    """The contigs without those of weak_single_chains."""
    return contigs.join(weak_single_chains(contigs, share), "sequence_id", "left_anti")


def attach_single_chains(cells: DataFrame, ratio: float = 0.15) -> DataFrame:
    """Cells (cell_id, clone_id, clone_id_by_size, ...), those of a single chain with the clone_id_by_size of the complete clone that they belong to.

    Candidates are the complete clones whose name contains the chain's number. One alone is taken; of several that with most
    cells, if the second has under `ratio` of its cells (of equals the first in text order). clone_id stays.
    """
    size = cells.where(kind("clone_id") == "pair").groupBy("clone_id").agg(F.count("*").alias("__n"), F.min("clone_id_by_size").alias("__by"))
    found = None
    for rows, mark, _ in _sides(cells):
        wants = rows.select("__want").distinct()
        c = names_containing(wants, "__want", size.withColumnRenamed("clone_id", "__clone"), "__clone", mark)
        best = best_unless_close(c, "__want", "__clone", "__n", ratio).join(size.select(F.col("clone_id").alias("__clone"), "__by"), "__clone")
        got = rows.join(best, "__want").select("cell_id", F.col("__by").alias("__new"))
        found = got if found is None else found.unionByName(got)
    return cells.join(found, "cell_id", "left").withColumn("clone_id_by_size", F.coalesce("__new", "clone_id_by_size")).drop("__new")


def best_unless_close(options: DataFrame, by: str, option: str, count: str, ratio: float) -> DataFrame:
    """(by, option): the option with most, if it is alone or the second has under ratio of its count; by without one are left out."""
    w = Window.partitionBy(by).orderBy(F.desc(count), option)
    r = options.withColumn("__r", F.row_number().over(w)).withColumn("__second", F.lead(count).over(w)).where("__r = 1")
    return r.where(F.col("__second").isNull() | (F.col("__second") / F.col(count) < ratio)).select(by, option)


def subclones(cells: DataFrame, by: str, clone: str) -> DataFrame:
    """(by, clone, n, subclone): names inside a clone numbered from 1 by cells, then weight, then name."""
    d = cells.groupBy(by, clone).agg(F.count("*").alias("n"))
    order = Window.partitionBy(by).orderBy(F.desc("n"), F.desc(weight(clone)), clone)
    return d.select(by, clone, "n", F.row_number().over(order).alias("subclone"))


def cdr3(value: str, locus_1: str = "locus_VDJ", locus_2: str = "locus_VJ") -> Column:
    """locus:sequence of the heavy, then of the light chain, joined by ;. `value` is the columns' beginning (junction, junction_aa); missing chains are left out."""
    one = lambda locus, column: F.when(F.coalesce(F.col(locus), F.lit(NONE)) != NONE, F.concat(locus, F.lit(":"), F.coalesce(F.col(column), F.lit(NONE))))
    return F.concat_ws(";", one(locus_1, f"{value}_VDJ"), one(locus_2, f"{value}_VJ"))


def filled(cells: DataFrame) -> DataFrame:
    """The metadata columns that shares need, those that are absent filled as contig tables have them."""
    want = {c: F.lit(NONE) for c in ("productive_VDJ", "productive_VJ", "locus_VDJ", "locus_VJ")} | {c: F.lit(0) for c in ("umi_count_B_VDJ", "umi_count_B_VJ", "umi_count_abT_VDJ", "umi_count_abT_VJ")}
    return cells.withColumns({c: v for c, v in want.items() if c not in cells.columns}) if set(want) - set(cells.columns) else cells


def clone_matrix(cells: DataFrame, chain: str) -> DataFrame:
    """One row of counts and shares of cells by chain (IG or TR), with median UMIs of productive chains (0 without any).

    For TR the flags are tested crosswise, as reports have always had it: TRA cells by productive_VDJ, TRB cells by productive_VJ.
    """
    d = filled(cells)
    n, t = F.count("*"), lambda c: F.col(c) == "T"
    is_ = lambda c, v: F.col(c) == v
    share = lambda c: F.round(F.coalesce(F.try_divide(F.count_if(c), n), F.lit(0.0)), 9)
    median = lambda c, v: F.coalesce(F.median(F.when(c, F.col(v))), F.lit(0.0))
    pair = t("productive_VDJ") & t("productive_VJ")
    out = [n.alias("cells"), F.count_if(pair).alias("pairs"), share(pair).alias("pair_share")]
    if chain == "IG":
        for light in ("IGK", "IGL"):
            out.append(share(is_("locus_VJ", light) & is_("locus_VDJ", "IGH")).alias(f"{light.lower()}_igh"))
        tests = {"igh": (t("productive_VDJ") & is_("locus_VDJ", "IGH"), "umi_count_B_VDJ"), "igk": (t("productive_VJ") & is_("locus_VJ", "IGK"), "umi_count_B_VJ"), "igl": (t("productive_VJ") & is_("locus_VJ", "IGL"), "umi_count_B_VJ")}
    elif chain == "TR":
        out.append(share(is_("locus_VDJ", "TRB") & is_("locus_VJ", "TRA")).alias("tra_trb"))
        tests = {"tra": (t("productive_VDJ") & is_("locus_VJ", "TRA"), "umi_count_abT_VJ"), "trb": (t("productive_VJ") & is_("locus_VDJ", "TRB"), "umi_count_abT_VDJ")}
    else:
        raise ValueError(f"{chain} is neither IG nor TR")
    for name, (test, umis) in tests.items():
        out += [share(test).alias(name), median(test, umis).alias(f"{name}_umis")]
    return d.agg(*out)


def contig_annotations(contigs: DataFrame) -> DataFrame:
    """The annotation table of contigs, as downstream tools name its columns; what is not known stays empty."""
    empty = [F.lit("").alias(c) for c in ("fwr1", "fwr1_nt", "cdr1", "cdr1_nt", "fwr2", "fwr2_nt", "cdr2", "cdr2_nt", "fwr3", "fwr3_nt")]
    col = lambda a, b: (F.col(a) if a in contigs.columns else F.lit("")).alias(b)
    named = [col("cell_id", "barcode"), F.lit(True).alias("is_cell"), col("sequence_id", "contig_id"), col("high_confidence", "high_confidence"), col("length", "length"), col("locus", "chain"), col("v_call", "v_gene"), col("d_call", "d_gene"), col("j_call", "j_gene"), col("c_call", "c_gene"), col("complete_vdj", "full_length"), col("productive", "productive")]
    rest = [col("junction_aa", "cdr3"), col("junction", "cdr3_nt"), col("consensus_count", "reads"), col("duplicate_count", "umis"), col("clone_id", "raw_clonotype_id")]
    return contigs.select(*named, *empty, *rest)


def gene_positions(contigs: DataFrame, hits: DataFrame) -> DataFrame:
    """contigs (contig, call) with start and hits: where the called gene begins among the contig's hits (contig, gene, start), and how many there are."""
    per = hits.groupBy("contig", F.col("gene").alias("call")).agg(F.min("start").alias("start"), F.count("*").alias("hits"))
    return contigs.join(per, ["contig", "call"])


def rewrite_field(rows: DataFrame, votes: DataFrame, key: str, value: str) -> DataFrame:
    """rows with `value` replaced by the votes (key, n) of their contig; rows of unknown contigs are dropped."""
    return rows.drop(value).join(votes.select(key, F.col("n").alias(value)), key)


def flags(cells: DataFrame, **tables: DataFrame) -> DataFrame:
    """cells with a boolean for each named table (cell): whether it lists the cell."""
    d = cells
    for name, t in tables.items():
        d = d.join(t.select("cell").distinct().withColumn(name, F.lit(True)), "cell", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return d
