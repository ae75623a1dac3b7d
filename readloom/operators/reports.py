"""Report figures: formats, cards, curves, tables, and the payload that a page shows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Biotypes by the class that reports count them in.
BIOTYPES = {
    "protein_coding": ["protein_coding"],
    "lncRNA": ["lncRNA", "lincRNA", "non_coding", "3prime_overlapping_ncRNA", "antisense", "sense_overlapping", "retained_intron", "sense_intronic", "macro_lncRNA", "bidirectional_promoter_lncRNA"],
    "rRNA": ["rRNA"],
    "Mt_rRNA": ["Mt_rRNA"],
}
#: Texts and colours of the report page.
NO_CLONES, BACKGROUND, CELL_TEXT = "No clonotype data available", "Background", "%.0f%% Cells<br>%d/%d"
BACKGROUND_COLOR, CELL_COLOR = "rgba(221, 221, 221, 1.0)", "rgba(80, 80, 201, %.2f)"


def percent(share: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", share * 100)


def comma(n: Column) -> Column:
    return F.format_number(n, 0)


def shade(share: Column, buckets: int = 10) -> Column:
    """Which of the buckets a share falls in; -1 for none at all, `buckets` for all."""
    return F.when(share >= 1, buckets).when(share <= 0, -1).otherwise(F.floor(share * buckets)).cast("long")


def shade_percent(value: Column) -> Column:
    """shade of a share in whole percent, without rounding on the way."""
    return F.when(value >= 100, 10).when(value <= 0, -1).otherwise(F.floor(value / 10)).cast("long")


def biotype_class(biotype: Column) -> Column:
    out = None
    for name, members in BIOTYPES.items():
        test = biotype.isin(members)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("others")


def shares(df: DataFrame, by: Column | str, value: str, name: str = "class") -> DataFrame:
    """(name, n, share): sums of the value per class and their share of all."""
    per = df.groupBy((F.col(by) if isinstance(by, str) else by).alias(name)).agg(F.sum(value).alias("n"))
    total = per.agg(F.sum("n").alias("__all"))  # one row
    return per.crossJoin(F.broadcast(total)).select(name, "n", F.round(F.col("n") / F.col("__all"), 9).alias("share"))


def mapping_rates(reads: DataFrame, unique: Column, multi: Column, confident: Column) -> DataFrame:
    """One row: shares of reads mapped at all and mapped confidently, and read pairs."""
    n = F.count("*")
    return reads.agg(F.round((F.count_if(unique) + F.count_if(multi)) / n, 9).alias("mapped"), F.round(F.count_if(confident) / n, 9).alias("confident"), F.floor(n / 2).alias("pairs"))


def joint_summary(counts: DataFrame, sites: DataFrame, rate: str) -> DataFrame:
    """One row over both halves of a joint run: cells, reads and UMIs of the counts (cell, umis, reads), lines and mean rate of the sites."""
    a = counts.agg(F.countDistinct("cell").alias("cells"), F.sum("reads").alias("reads"), F.sum("umis").alias("umis"))
    b = sites.agg(F.count("*").alias("lines"), F.round(F.avg(rate), 9).alias("rate"))
    return a.crossJoin(F.broadcast(b))  # one row each


def marker_map(df: DataFrame, types: str, genes: list[str], sep: str = ",") -> DataFrame:
    """(gene, types): the cell types that list a gene, sorted and joined by ;. The gene columns hold lists of names."""
    m = df.select(types, F.explode(F.split(F.concat_ws(sep, *genes), sep)).alias("g")).select(types, F.trim("g").alias("gene")).where("gene != ''")
    return m.groupBy("gene").agg(F.array_join(F.sort_array(F.collect_set(types)), ";").alias("types"))


def described(fields: dict[str, Column], texts: dict[str, str] | None = None) -> Column:
    """A map of the fields' descriptions; empty where none is known."""
    return F.create_map(*[x for k in fields for x in (F.lit(k), F.lit((texts or {}).get(k, "")))])


def card(title: str, fields: dict[str, Column], id_: int, name: str = "Card", texts: dict[str, str] | None = None) -> Column:
    """A titled box of named figures."""
    data = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))])
    return F.struct(F.lit(id_).alias("id"), F.lit(name).alias("name"), F.lit(title).alias("title"), data.alias("data"), described(fields, texts).alias("description"))


def curve(points: DataFrame, title: str, x: str, y: str, x_title: str, y_title: str, id_: int, about: str = "", lead: bool = True) -> DataFrame:
    """One row `item`: a line over the points in order of x, from (0, 0) on. Points are the few that a report draws."""
    pair = F.sort_array(F.collect_list(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))))
    first = F.array(F.lit(0.0)) if lead else F.array().cast("array<double>")
    xs, ys = F.concat(first, F.transform("p", lambda v: v["x"])), F.concat(first, F.transform("p", lambda v: v["y"]))
    axis = lambda t: F.struct(F.lit(t).alias("title"))
    data = F.struct(xs.alias("x"), ys.alias("y"), axis(x_title).alias("xaxis"), axis(y_title).alias("yaxis"))
    return points.agg(pair.alias("p")).select(F.struct(F.lit(id_).alias("id"), F.lit("PlotlyLine").alias("name"), F.lit(title).alias("title"), data.alias("data"), F.lit(about).alias("description")).alias("item"))


def pie(parts: DataFrame, title: str, label: str, value: str, id_: int, about: str = "") -> DataFrame:
    """One row `item`: values and labels in label order."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(label).alias("l"), F.col(value).alias("v"))))
    data = F.struct(F.transform("r", lambda x: x["v"]).alias("values"), F.transform("r", lambda x: x["l"]).alias("labels"))
    return parts.agg(rows.alias("r")).select(F.struct(F.lit(id_).alias("id"), F.lit("PlotlyPie").alias("name"), F.lit(title).alias("title"), data.alias("data"), F.lit(about).alias("description")).alias("item"))


def bars(rows: DataFrame, title: str, x: str, y: str, x_title: str, y_title: str, id_: int, order: list, n: int = 10, about: str = "") -> DataFrame:
    """One row `item`: the first n rows as bars; a placeholder where there are none."""
    top = rows.orderBy(*order).limit(n)
    pair = F.collect_list(F.struct(F.col(x).cast("string").alias("x"), F.col(y).cast("double").alias("y")))
    axis = lambda t: F.struct(F.lit(t).alias("title"))
    data = F.struct(F.transform("p", lambda v: v["x"]).alias("x"), F.transform("p", lambda v: v["y"]).alias("y"), axis(x_title).alias("xaxis"), axis(y_title).alias("yaxis"))
    text = F.when(F.size("p") > 0, F.lit(about)).otherwise(F.lit(NO_CLONES))
    return top.agg(pair.alias("p")).select(F.struct(F.lit(id_).alias("id"), F.lit("PlotlyBar").alias("name"), F.lit(title).alias("title"), data.alias("data"), text.alias("description")).alias("item"))


def top_table(rows: DataFrame, columns: list[str], order: list, n: int = 10) -> DataFrame:
    """One row `item`: the first n rows as records in that order; an empty list where there are none."""
    return rows.orderBy(*order).limit(n).agg(F.collect_list(F.struct(*columns)).alias("item"))


def rank_blocks(ranked: DataFrame, first: int = 1000, factor: int = 4, last: int | None = None) -> DataFrame:
    """(x, text, color, barcodes, cells) of the blocks of a barcode rank curve (cell, umis, is_cell, idx), from the left.

    The colour's strength is the share of cells, a tenth at least.
    """
    from .counts import rank_segments

    s = rank_segments(ranked, first, factor, last).withColumn("share", F.col("cells") / F.col("barcodes"))
    cells = F.format_string(CELL_TEXT, F.col("share") * 100, F.col("cells"), F.col("barcodes"))
    strong = F.greatest(F.col("share"), F.lit(0.1))
    text = F.when(F.col("segment") == "background", BACKGROUND).otherwise(cells)
    color = F.when(F.col("segment") == "background", BACKGROUND_COLOR).otherwise(F.format_string(CELL_COLOR, F.when(F.col("segment") == "leading", 1.0).otherwise(strong)))
    return s.select(F.col("first_rank").alias("x"), text.alias("text"), color.alias("color"), "barcodes", "cells")


def embedding_payload(table: DataFrame, cell: str, cluster: str, x: str, y: str, counts: list[str], shares: list[str] = ()) -> DataFrame:
    """One row `item`: ranges and columns of an embedding table, in the order of its cells. A report's page holds all cells, so does this row."""
    cols = [F.col(x).alias("x"), F.col(y).alias("y"), F.col(cluster).cast("string").alias("cluster"), *[F.col(c).cast("long").alias(c) for c in counts], *[F.round(c, 2).alias(c) for c in shares]]
    rows = F.sort_array(F.collect_list(F.struct(F.col(cell).alias("cell"), *cols))).alias("r")
    ranges = [F.array(F.min(F.col(c).cast("long")), F.max(F.col(c).cast("long"))).alias(c) for c in counts] + [F.array(F.round(F.min(c), 2), F.round(F.max(c), 2)).alias(c) for c in shares]
    d = table.agg(rows, F.sort_array(F.collect_set(F.col(cluster))).alias("k"), F.struct(*ranges).alias("m"))
    of = lambda c: F.transform("r", lambda v: v[c])
    range_ = F.struct(F.transform("k", lambda v: v.cast("string")).alias("cluster"), "m.*")
    return d.select(F.struct(range_.alias("range"), F.struct(of("x").alias("x"), of("y").alias("y")).alias("coordinate"), of("cluster").alias("cluster"), *[of(c).alias(c) for c in [*counts, *shares]]).alias("item"))


def payload(**items: DataFrame | Column) -> DataFrame:
    """One row `payload`: a JSON object of the items, which are one-row DataFrames with a column `item`."""
    names = sorted(items)
    d = None
    for n in names:
        one = items[n].select(F.col("item").alias(n))
        d = one if d is None else d.crossJoin(F.broadcast(one))  # one row each
    return d.select(F.to_json(F.struct(*names)).alias("payload"))


def placeholder(title: str, name: str, about: str = "No data available") -> str:
    """The JSON of an item that has no data."""
    return json.dumps({"name": name, "title": title, "description": about, "data": []})


def render(template: str, payload_json: str, mark: str = "{{ data }}") -> str:
    """The page: the template with the payload in place of the mark; </ is escaped, so that the data cannot end a script."""
    return template.replace(mark, payload_json.replace("</", "<\\/"))


def image(content: str | Column = "content", kind: str = "png") -> Column:
    """A binary column as a data URI."""
    return F.concat(F.lit(f"data:image/{kind};base64, "), F.regexp_replace(F.base64(content), r"\s", ""))
