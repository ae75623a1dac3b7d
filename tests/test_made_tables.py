"""Queries against their SQL on tables made for what the given ones are too small or too tidy for."""

import duckdb

from readloom.plans import registry


def agree(spark, folder, name):
    """Number of rows, after comparing them with DuckDB's."""
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for table in folder.iterdir():
        con.sql(f"create view {table.stem} as select * from '{table}/*.parquet'")
    df = registry.QUERIES[name](spark, str(folder))
    rel = con.sql(registry.ORACLE[name])
    at = [rel.columns.index(c) for c in df.columns]
    got, want = sorted(map(tuple, df.collect())), sorted(tuple(r[i] for i in at) for r in rel.fetchall())
    assert got == want
    return len(got)


def put(folder, **tables):
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_every_candidate_has_a_likelihood(spark, tmp_path):
    """More candidates than are tested by simulations."""
    put(tmp_path, events=spark.range(21_000 * 6).selectExpr("id as event_id", "timestamp '2024-01-01' as ts", "id % 21000 as user_id", "'e' || id % 4 as event_type", "1.0D as value", """'{"k": "u' || id || '"}' as props"""))
    assert agree(spark, tmp_path, "ambient_loglik") == 20_900


def test_the_last_mixed_block_is_open(spark, tmp_path):
    """Cells behind the seventh mixed block of 10, 40, 160, ... ranks."""
    cells = spark.range(60_000).selectExpr("id as c_custkey", "if(id = 5, -1D, 1D) as c_acctbal")
    events = spark.range(60_003).selectExpr("id as event_id", "timestamp '2024-01-01' as ts", "case when id < 60000 then id when id < 60002 then 7 else 5 end as user_id", "'e' as event_type", "1.0D as value", """'{"k": "u' || id || '"}' as props""")
    put(tmp_path, customer=cells, events=events)
    assert agree(spark, tmp_path, "rank_segments") == 8
    assert agree(spark, tmp_path, "rank_blocks") == 8


def lines(spark, rows):
    return spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp").selectExpr("*", "1L as l_suppkey", "'O' as l_linestatus", "0.05D as l_discount")


def test_blocks_of_one_line_number_are_in_file_order(spark, tmp_path):
    data = [(tx, 101 + 100 * i, n, 7.0, flag, None) for n in (2, 1, 1) for tx in range(40) for i, flag in enumerate("RNA" if tx % 2 else "ANR")]
    put(tmp_path, lineitem=lines(spark, data))
    assert agree(spark, tmp_path, "bed12") == 40


def test_equal_records_on_parts_of_chromosomes(spark, tmp_path):
    from datetime import datetime, timedelta

    day = lambda n: datetime(1992, 1, 1) + timedelta(n)
    data = [(k, p, 1, 10.0, flag, day(n)) for k, (flag, n) in enumerate([("A", 1800), ("A", 1000), ("A", 20), ("N", 1300), ("R", 1300)]) for p in range(1 + k % 3)]
    put(tmp_path, lineitem=lines(spark, data))
    assert agree(spark, tmp_path, "split_shift") == 5
