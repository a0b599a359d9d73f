"""Plain SQL over the reference-named tables gives the DataFrame reports' results."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest

from quotalake.operators import reports
from quotalake.plans.sql_tables import register_tables
from quotalake.sources.star import Star

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver test data not present")


@pytest.fixture(scope="module")
def star(spark):
    s = Star.from_parquet(spark, SF_SMALL)
    register_tables(s, prefix="t_")
    return s


def test_margin_by_industry_and_discount_in_sql(spark, star):
    rows = spark.sql("""
        SELECT cu.industry, CASE WHEN x.discount_percent >= 5 THEN 'deep' ELSE 'light' END AS level,
               ROUND(100 * SUM(x.profit) / NULLIF(SUM(x.revenue), 0), 1) AS margin, COUNT(x.sale_id) AS n
        FROM t_customers cu JOIN t_sales x USING (customer_id)
        GROUP BY ALL""").collect()
    want = {}
    industry = {r.customer_id: r.industry for r in star.customers.collect()}
    for r in star.sales.select("customer_id", "discount_percent", "revenue", "profit").collect():
        key = (industry[r.customer_id], "deep" if r.discount_percent >= 5 else "light")
        rev, prof, n = want.get(key, (Decimal(0), Decimal(0), 0))
        want[key] = (rev + r.revenue, prof + r.profit, n + 1)
    assert {(r.industry, r.level): r.n for r in rows} == {k: v[2] for k, v in want.items()}
    for r in rows:
        rev, prof, _ = want[(r.industry, r.level)]
        assert abs(Decimal(r.margin) - 100 * prof / rev) <= Decimal("0.0501")


def test_filter_clause_and_window_in_sql(spark, star):
    r = spark.sql("""
        SELECT COUNT(opportunity_id) FILTER (WHERE stage = 'Closed Won') AS won,
               COUNT(opportunity_id) FILTER (WHERE stage IN ('Closed Won', 'Closed Lost')) AS closed
        FROM t_pipeline""").first()
    w = reports.win_rate_overall(star).first()
    assert (r.won, r.closed) == (w.deals_won, w.total_closed)
    avg = spark.sql("""
        SELECT DISTINCT ROUND(AVG(total) OVER (), 2) AS a FROM (
            SELECT c.state, SUM(s.revenue) AS total FROM t_sales s
            JOIN t_customers c ON c.customer_id = s.customer_id GROUP BY c.state)""").first().a
    assert avg == reports.vw_underperforming_states(star).first().company_avg_revenue


def test_targets_and_names_in_sql(spark, star):
    n = spark.sql("""
        SELECT COUNT(*) AS n FROM t_targets t JOIN t_salespeople sp ON sp.salesperson_id = t.salesperson_id
        WHERE sp.hire_date IS NULL""").first().n
    assert n == reports.vw_actual_vs_target(star).count()
    name = spark.sql("SELECT INITCAP(first_name || ' ' || last_name) AS n FROM t_salespeople "
                     "ORDER BY salesperson_id LIMIT 1").first().n
    assert name == reports.vw_salesperson_performance(star).orderBy("salesperson_id").first().full_name


def test_cli_runs_a_report(spark, tmp_path, capsys):
    from quotalake.__main__ import main

    assert main(["--tables", SF_SMALL, "--list"]) == 0
    assert "target_miss_rate" in capsys.readouterr().out
    out = str(tmp_path / "q")
    assert main(["--tables", SF_SMALL, "--report", "revenue_by_state", "--out", out]) == 0
    assert spark.read.parquet(out).count() == 25


def test_star_over_catalog_tables_equals_parquet_star(spark, star):
    from quotalake.sources.tables import CatalogTables, ParquetTables

    ParquetTables(spark, SF_SMALL).register(["region", "nation", "customer", "supplier", "part",
                                             "orders", "lineitem"])
    cat = Star(spark, CatalogTables(spark), star.config)
    for fn in (reports.vw_revenue_by_state, reports.vw_win_rate_by_salesperson):
        assert sorted(map(tuple, fn(cat).collect())) == sorted(map(tuple, fn(star).collect()))
