"""Hot keys: one part, one rep and one customer each hold a third of the rows.

The skewed tables are derived from sf0.001 with DuckDB; every query must still
match its SQL oracle, i.e. no row is dropped, capped or sampled to cope.
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver test data not present")

SKEWED = {
    "lineitem": """SELECT l_orderkey,
                          CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS l_partkey,
                          CASE WHEN l_orderkey % 3 = 1 THEN 0 ELSE l_suppkey END AS l_suppkey,
                          l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                          l_returnflag, l_linestatus, l_shipdate FROM src_lineitem""",
    "orders": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 0 ELSE o_custkey END AS o_custkey,
                        o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM src_orders""",
}
QUERIES = ("overall_performance", "revenue_by_state", "revenue_by_product", "salesperson_performance",
           "actual_vs_target", "top_customers", "pipeline_by_stage", "win_rate_by_salesperson",
           "state_variance", "target_miss_rate", "assign_territory", "price_sales")


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW src_{t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        sql = SKEWED.get(t, f"SELECT * FROM src_{t}")
        con.execute(f"COPY ({sql}) TO '{out}/{t}.parquet' (FORMAT PARQUET)")
    return str(out)


def test_hot_keys_really_are_hot(skewed_dir):
    con = duckdb.connect()
    share = con.sql(f"""SELECT avg(CASE WHEN l_partkey = 0 THEN 1 ELSE 0 END),
                               avg(CASE WHEN l_suppkey = 0 THEN 1 ELSE 0 END)
                        FROM read_parquet('{skewed_dir}/lineitem.parquet')""").fetchall()[0]
    assert all(s > 0.3 for s in share)


def test_queries_match_oracle_under_skew(spark, skewed_dir):
    import __spark_entry__ as entry_mod
    from check_oracle import compare, duck

    con = duck(skewed_dir)
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    failures = []
    for name in QUERIES:
        ok, msg, _ = compare(spark, con, skewed_dir, name, qs[name], sqls[name])
        if not ok:
            failures.append((name, msg))
    assert not failures


def test_top_customers_ignores_sales_without_a_known_customer(spark):
    from conftest import DictTables
    from quotalake.operators import reports
    from quotalake.sources.star import Star

    plain = Star.from_parquet(spark, SF_SMALL)
    orders = plain.t("orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
        "o_orderdate", "o_totalprice")
    tables = {t: plain.t(t) for t in ("region", "nation", "customer", "supplier", "part", "lineitem")}
    star = Star(spark, DictTables({**tables, "orders": orders}))
    rows = reports.top_customers(star).collect()
    assert len(rows) == 20 and all(r.customer_id is not None for r in rows)
