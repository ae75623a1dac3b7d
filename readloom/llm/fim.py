"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put together in another order.

Each Arrow batch is registered as a table of an in-memory DuckDB, one to a task, whose SQL cuts and joins the texts; Python
never sees a row. The way back needs the form and the output alone and is a Spark expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import find_package, pieces, table, text_of

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TOKEN = "[A-Za-z]+|[^A-Za-z]"
PLAIN_FROM = 90  # of 100: documents whose third number reaches it stay as they are
SPM_BELOW = 20  # of 100: of the others, those whose fourth number lies below have the suffix first
SEED = "1"
BATCH_BYTES = 2 << 20  # text to a table in DuckDB: its list of tokens takes several times as much


def cut_sql(token: str, plain_from: int, spm_below: int) -> str:
    """SQL over a table batch (id, text, key) for (id, n, form, prefix_chars, middle_chars, output, output_sha256)."""
    number = lambda i: f"cast('0x' || substr(h, {8 * i - 7}, 8) as ubigint)"
    part = lambda a, b: f"coalesce(array_to_string(list_slice(tokens, {a}, {b}), ''), '')"
    marks = " or ".join(f"contains(text, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
    with a as (select id, text, regexp_extract_all(text, '{token}') as tokens, sha256(key) as h from batch),
    b as (select id, text, tokens, h, cast(len(tokens) as bigint) as n, cast({number(1)} % (len(tokens) + 1) as bigint) as u, cast({number(2)} % (len(tokens) + 1) as bigint) as v from a),
    c as (select id, text, tokens, n, least(u, v) as lo, greatest(u, v) as hi,
                 case when text = '' or {marks} or {number(3)} % 100 >= {plain_from} then 'plain' when {number(4)} % 100 < {spm_below} then 'spm' else 'psm' end as form from b),
    d as (select id, text, n, form, {part(1, "lo")} as prefix, {part("lo + 1", "hi")} as middle, {part("hi + 1", "n")} as suffix from c),
    e as (select id, n, form, prefix, middle, case form when 'plain' then text when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                 else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end as output from d)
    select id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars, output, sha256(output) as output_sha256 from e"""


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED, token: str = TOKEN, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, output_sha256), a row for each row of docs.

    n tokens, matched left to right over code points, are cut at two places that the sha256 of `seed:id` draws. form is plain (the text
    itself), psm (prefix, suffix, middle) or spm (suffix, prefix, middle); the two lengths are code points, null where plain. Texts
    that hold one of the three marks stay plain, so that every output can be undone.

    A null text is an empty one, which is plain with n = 0; a null id counts as the empty text in the seed. Rows of one id are
    cut by the same draws; repeated rows give repeated results. Long texts are whole. `token` is a regular expression
    without quotes that matches every character.
    """
    find_package(docs.sparkSession)
    sql = cut_sql(token, plain_from, spm_below)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(":memory:", config={"threads": 1}) as con:
            for batch in (p for whole in batches for p in pieces(whole, 1, BATCH_BYTES)):
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(sql).to_arrow_table().to_batches()
                con.unregister("batch")

    return rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string")


def restored(form: Column, output: Column) -> Column:
    """The text that transform made an output of. No mark occurs in a text that was cut, nor across a text and a mark, so the first of each is the one put there."""
    part = lambda text, mark, i: F.split_part(text, F.lit(mark), F.lit(i))

    def back(outer: str, inner: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(outer) + 1))
        rest = part(body, inner, 2)
        return part(body, inner, 1), part(rest, MIDDLE, 1), part(rest, MIDDLE, 2)

    prefix, suffix, middle = back(PREFIX, SUFFIX)
    suffix_, prefix_, middle_ = back(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_, middle_, suffix_))


def op12_fim(spark, sf_dir: str) -> DataFrame:
    """Per document: n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    out = transform(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


#: Cut by code points from the lengths of the tokens, not by lists of them; what is restored is the text itself.
ORACLE = r"""
with a as (select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as h from documents),
b as (select *, list_transform(regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]'), lambda x: length(x)) as size from a),
c as (select *, cast(len(size) as bigint) as n, list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(h, i, 8) as ubigint)) as k from b),
d as (select *, least(k[1] % (n + 1), k[2] % (n + 1)) as lo, greatest(k[1] % (n + 1), k[2] % (n + 1)) as hi from c),
e as (select *, cast(coalesce(list_sum(size[1:lo]), 0) as bigint) as p, cast(coalesce(list_sum(size[lo + 1:hi]), 0) as bigint) as m,
             case when t = '' or t like '%<P>%' or t like '%<S>%' or t like '%<M>%' or k[3] % 100 >= 90 then 'plain' when k[4] % 100 < 20 then 'spm' else 'psm' end as form from d)
select doc_id, n, form, case when form <> 'plain' then p end as prefix_chars, case when form <> 'plain' then m end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then concat('<P>', substr(t, 1, p), '<S>', substr(t, p + m + 1), '<M>', substr(t, p + 1, m))
              else concat('<S>', substr(t, p + m + 1), '<P>', substr(t, 1, p), '<M>', substr(t, p + 1, m)) end) as output_sha256,
       sha256(t) as restored_sha256
from e
"""
