"""Names: of reads, mates, contigs and references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as S


def name_parts(name: str | Column) -> Column:
    """struct<barcode, umi, alt, read>: what <barcode>_<umi>_<alt>_<read> was made from; with three parts alt is M. read may hold underscores."""
    parts = F.split(F.col(name) if isinstance(name, str) else name, "_", 4)
    four = F.size(parts) == 4
    return F.struct(F.get(parts, F.lit(0)).alias("barcode"), F.get(parts, F.lit(1)).alias("umi"), F.when(four, F.get(parts, F.lit(2))).otherwise(F.lit("M")).alias("alt"), F.when(four, F.get(parts, F.lit(3))).otherwise(F.get(parts, F.lit(2))).alias("read"))


def tags(df: DataFrame, name: str = "qname", corrected: str | None = None) -> DataFrame:
    """Adds cb, cr, ub, ur (barcode and UMI, corrected and raw) taken from the read name, which becomes the original one.

    `corrected` is a column with the corrected UMI, null where none is known.
    """
    p = name_parts(name)
    ub = p["umi"] if corrected is None else F.coalesce(F.col(corrected), p["umi"])
    d = df.withColumns({"cb": p["barcode"], "cr": S.undo_alteration(p["barcode"], p["alt"]), "ub": ub, "ur": p["umi"]})
    return d.withColumn(name, p["read"])


def tagged(df: DataFrame, name: str = "qname", corrected: str | None = None, tags_col: str = "tags") -> DataFrame:
    """Alignment records with the tags CB, CR, UB and UR beside their own, under their original read names."""
    d = tags(df, name, corrected)
    own = F.create_map(*[x for t in ("cb", "cr", "ub", "ur") for x in (F.lit(t.upper()), F.col(t))])
    rest = F.map_filter(F.coalesce(tags_col, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("CB", "CR", "UB", "UR"))
    return d.withColumn(tags_col, F.map_concat(rest, own)).drop("cb", "cr", "ub", "ur")


def barcode_behind(name: str | Column) -> Column:
    """<read>:<barcode>, for tools that remove duplicates by what ends a read name."""
    p = name_parts(name)
    return F.concat_ws(":", p["read"], p["barcode"])


def mate(name: str | Column) -> Column:
    """The first mate's name, from the second's."""
    return F.replace(F.col(name) if isinstance(name, str) else name, F.lit(" 2:"), F.lit(" 1:"))


def made_umi(key: str | Column, length: int = 12) -> Column:
    """Letters that stand in for the UMI of a read that has none: always the same for a key."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.substring(F.translate(F.md5(F.concat(F.lit("umi"), k)), "0123456789abcdef", "ABCDEFGHIJKLMNOP"), 1, length)


def chain(locus: str | Column) -> Column:
    """TRA of TRAV1-2, and so on."""
    return F.substring(F.col(locus) if isinstance(locus, str) else locus, 1, 3)


def numbered_references(fasta: DataFrame, name: str, order: str) -> DataFrame:
    """References named after a receptor gene, renamed <gene>_<running number>; others are dropped. A reference set is small."""
    d = fasta.withColumn("__base", F.regexp_extract(name, r"((TR|IG)\S+?)[|\s:]", 1)).where("__base != ''")
    number = F.row_number().over(Window.orderBy(order)).cast("string")
    return d.withColumn(name, F.concat_ws("_", "__base", number)).drop("__base")


def cell_of(contig: str | Column) -> Column:
    """What comes before a contig name's first underscore."""
    return F.regexp_replace(F.col(contig) if isinstance(contig, str) else contig, "_.*", "")


def sampled(df: DataFrame, key: str, share: float) -> DataFrame:
    """About `share` of the rows, the same in every run: those with a low hash of the key."""
    return df.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") < F.lit(int(share * 2**32)))


def remap(df: DataFrame, barcode: str, barcodes: DataFrame, umi: str | None = None, umi_length: int | None = None) -> DataFrame:
    """Replaces barcodes by entries of another list (barcode): the i-th distinct one, in text order, by the i-th entry; what is left over
    when the list ends becomes a run of A. UMIs are cut to umi_length."""
    old = df.select(F.col(barcode).alias("__old")).where("__old is not null").distinct()
    new = barcodes.select(F.col("barcode").alias("__new")).distinct()
    from .ranking import ordinals

    pairs = ordinals(old, "__old", "__i").join(ordinals(new, "__new", "__i"), "__i", "left").select("__old", "__new")
    d = df.join(pairs, F.col(barcode) == F.col("__old"), "left")
    spare = F.repeat(F.lit("A"), F.length(barcode))
    d = d.withColumn(barcode, F.when(F.col(barcode).isNotNull(), F.coalesce("__new", spare))).drop("__old", "__new")
    return d.withColumn(umi, F.substring(umi, 1, umi_length)) if umi and umi_length else d


def natural_key(name: str) -> Column:
    """Orders names as sorting by name does: runs of digits as numbers, all other characters by their code."""
    parts = F.regexp_extract_all(name, F.lit(r"(?s)(\d+|\D)"), F.lit(1))
    digits = lambda x: F.ltrim(x, F.lit("0"))
    return F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.struct(F.lit(48).alias("code"), F.length(digits(x)).alias("size"), digits(x).alias("number"))).otherwise(F.struct(F.ascii(x).alias("code"), F.lit(0).alias("size"), F.lit("").alias("number"))))
