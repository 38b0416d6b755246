"""Queries on reads where an id stands for several lines of one order, against their check SQL."""

import random
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

#: aln_id adds 1,000,000 a line number and 50 a part, so 20,000 parts up and one line number down is the same id
SAME_ID = 20_000


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A folder whose lineitem has one row in four a second time under the same id, at another place of the read."""
    rng, rows = random.Random(3), []
    for order in range(15000):
        for line in range(1, rng.randint(3, 7)):
            part, supp, qty = rng.randrange(SAME_ID), rng.randrange(1000), float(rng.randint(1, 50))
            rows.append((order, part, supp, line, qty, 100.0, 0.05, 0.02))
            if line > 1 and rng.random() < 0.25:
                rows.append((order, part + SAME_ID, rng.randrange(1000), line - 1, qty, 100.0, 0.05, 0.02))
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.float64()] * 4]
    folder = tmp_path_factory.mktemp("tables")
    pq.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names), folder / "lineitem.parquet")
    return str(folder)


def same(spark, tables, name):
    got = entry.queries()[name](spark, tables)
    with duckdb.connect() as con:
        con.sql(f"create view lineitem as select * from '{tables}/lineitem.parquet'")
        want = con.sql(entry.oracle_sql()[name])
        columns, rows = want.columns, want.fetchall()
    assert rows and Counter(map(tuple, got.select(columns).collect())) == Counter(rows)


def test_frequent_signals(spark, tables):
    same(spark, tables, "frequent_signals")


def test_intron_reads(spark, tables):
    same(spark, tables, "intron_reads")


def test_linear_and_trans_introns(spark, tables):
    same(spark, tables, "linear_and_trans_introns")


def test_signals_by_reads(spark, tables):
    same(spark, tables, "signals_by_reads")


def test_top_signals(spark, tables):
    same(spark, tables, "top_signals")
