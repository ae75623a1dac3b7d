"""Receptor contigs and clonotypes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.seq import hamming
from ..scratch import settle, tidy
from .ranking import ordinals
from .umi import components

CANDIDATES = 50  # pairs to compare for each junction, beyond which pieces are cut finer


def chain_counts(hits: DataFrame) -> DataFrame:
    """(qname, chain) hits -> (chain, reads): the chain most hits of a read have; unknown where two tie."""
    per = hits.groupBy("qname", "chain").agg(F.count("*").alias("n"))
    w = Window.partitionBy("qname").orderBy(F.desc("n"), "chain")
    best = per.withColumn("r", F.row_number().over(w)).withColumn("second", F.lead("n").over(w)).where("r = 1")
    return best.select(F.when(F.col("n") == F.col("second"), "unknown").otherwise(F.col("chain")).alias("chain")).groupBy("chain").agg(F.count("*").alias("reads"))


def top_unless_close(votes: DataFrame, by: str, option: str, ratio: float = 0.15) -> DataFrame:
    """Per `by` the option with most votes n if it is alone or the second has under ratio of its votes, else all."""
    w = Window.partitionBy(by).orderBy(F.desc("n"), option)
    d = votes.withColumn("r", F.row_number().over(w))
    both = d.groupBy(by).agg(F.max("n").alias("first"), F.max(F.when(F.col("r") == 2, F.col("n"))).alias("second"))
    clear = F.col("second").isNull() | (F.col("second") / F.col("first") < ratio)
    return d.join(both, by).where((F.col("r") == 1) | ~clear).select(by, option, "n")


def contig_reads(pileup: DataFrame, order: list[str]) -> DataFrame:
    """Per contig the first sum plus all increases along it."""
    w = Window.partitionBy("contig").orderBy(*order)
    step = F.greatest(F.col("total") - F.coalesce(F.lag("total").over(w), F.lit(0)), F.lit(0))
    return pileup.withColumn("step", step).groupBy("contig").agg(F.sum("step").alias("reads"))


def clonotypes(cells: DataFrame) -> DataFrame:
    """(cell_id, clone, nt, aa) -> frequency, proportion and the cdr3 that most cells have; paired ones (with a ;) first."""
    per = cells.groupBy("clone", "nt").agg(F.count("*").alias("n"), F.min("aa").alias("aa"))
    key = F.struct(F.col("nt").contains(";").cast("int").alias("paired"), "n", "nt")
    out = per.groupBy("clone").agg(F.sum("n").alias("frequency"), F.max_by("aa", key).alias("cdr3s_aa"), F.max_by("nt", key).alias("cdr3s_nt"))
    total = out.agg(F.sum("frequency").alias("__all"))  # one row
    return out.crossJoin(F.broadcast(total)).withColumn("proportion", F.round(F.col("frequency") / F.col("__all"), 9)).drop("__all")


def diversity(clones: DataFrame) -> DataFrame:
    total = clones.agg(F.sum("frequency").alias("__all"))  # one row
    return clones.crossJoin(F.broadcast(total)).select((F.col("frequency") / F.col("__all")).alias("p")).agg(F.round(F.coalesce(F.try_divide(F.lit(1.0), F.sum(F.pow("p", F.lit(2)))), F.lit(0.0)), 6).alias("diversity"))


def ranked_ids(df: DataFrame, by: list[str], key: str, order: list, name: str) -> DataFrame:
    """Numbers keys from 1 by descending size inside `by`, then by `order`."""
    per = df.groupBy(*by, key).agg(F.count("*").alias("n"))
    if not by:  # all keys are one list: ranges of it are sorted over all tasks
        return ordinals(per, [F.desc("n"), *order], name, "int")
    w = Window.partitionBy(*by).orderBy(F.desc("n"), *order)
    return per.withColumn(name, F.row_number().over(w))


def consensus(contigs: DataFrame) -> DataFrame:
    """Per (clone, locus) the longest sequence, of equals the most frequent, then the first in text order."""
    per = contigs.groupBy("clone", "locus", "seq").agg(F.count("*").alias("n"))
    w = Window.partitionBy("clone", "locus").orderBy(F.desc(F.length("seq")), F.desc("n"), "seq")
    return per.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def piece_keys(text: Column, mismatches: Column, shared: int) -> Column:
    """array<struct<which,what>>: all choices of `shared` of the mismatches + shared pieces that a text is cut into.

    Two texts of one length with no more mismatches agree in `shared` pieces at least, so in one of these.
    """
    count = (mismatches + shared).cast("int")
    cut = lambda i: F.floor(i * F.length(text) / count).cast("int")
    piece = lambda i: F.substring(text, cut(i) + 1, cut(i + 1) - cut(i))
    out = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(F.array(i).alias("which"), piece(i).alias("what")))
    for _ in range(shared - 1):
        more = lambda x: F.transform(F.sequence(F.element_at(x["which"], -1) + 1, count - 1), lambda i: F.struct(F.concat(x["which"], F.array(i)).alias("which"), F.concat(x["what"], piece(i)).alias("what")))
        out = F.flatten(F.transform(F.filter(out, lambda x: F.element_at(x["which"], -1) < count - 1), more))
    return out


@tidy
def clone_groups(contigs: DataFrame, identity: float) -> DataFrame:
    """(contig, v, j, junction) -> (contig, clone): same V, J and junction length, single linkage at the identity over the
    distinct junctions. A contig without a junction or a call has no clone (null); clone is v|j|length|the least junction.

    Junctions that are alike enough have pieces in common: an equality join on these finds the candidates, which are verified, and components
    link them, over all tasks. Pieces are cut finer, and more of them must agree, while that leaves many candidates to a junction.
    """
    whole = F.col("junction").isNotNull() & F.col("v").isNotNull() & F.col("j").isNotNull()
    name = F.concat_ws("|", "v", "j", F.length("junction").cast("string"), "junction")
    named = settle(contigs.withColumn("node", F.when(whole, name)).select("contig", "node", "v", "j", "junction"))
    nodes = settle(named.where("node is not null").select("node", "v", "j", "junction").distinct())
    size = F.length("junction")
    most = F.floor(size * (1 - F.lit(identity)) + 1e-9)
    count = nodes.count()
    for shared in (1, 2, 3):
        keys = nodes.select("node", "junction", most.alias("most"), F.explode(piece_keys(F.col("junction"), most, shared)).alias("k"))
        keys = keys.select("node", "junction", "most", F.struct("k", F.regexp_replace("node", r"\|[^|]*$", "").alias("group")).alias("key"))
        per = settle(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
        pairs = per.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
        if pairs <= CANDIDATES * count:
            break
    some = settle(keys.join(per.select("key"), "key", "left_semi"))
    other = some.select("key", F.col("node").alias("b"), F.col("junction").alias("right"))
    near = some.select("key", F.col("node").alias("a"), F.col("junction").alias("left"), "most").join(other, "key").where("a < b")
    edges = near.where(hamming(F.col("left"), F.col("right")) <= F.col("most")).select("a", "b").distinct()
    linked = components(edges, nodes.select("node"))
    return settle(named.join(linked, "node", "left").select("contig", F.col("comp").alias("clone")), keep=True)


def clone_names(contigs: DataFrame) -> DataFrame:
    """As clone_groups at full identity: (contig, clone) by V, J and the very junction."""
    whole = F.col("junction").isNotNull() & F.col("v").isNotNull() & F.col("j").isNotNull()
    return contigs.select("contig", F.when(whole, F.concat_ws("|", "v", "j", F.length("junction").cast("string"), "junction")).alias("clone"))
