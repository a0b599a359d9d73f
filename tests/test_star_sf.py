"""End-to-end checks on the driver tables at sf0.001: pricing, invariants,
materialization, audits and the SQL oracle."""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from quotalake.operators import audits, reports
from quotalake.sources.star import Star

from conftest import SF_SMALL, DictTables, star_with

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver test data not present")


@pytest.fixture(scope="module")
def star(spark):
    return Star.from_parquet(spark, SF_SMALL)


def _q2(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_pricing_matches_decimal_arithmetic(spark, star):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount").collect()
    parts = {r.p_partkey: (r.p_retailprice, r.p_size)
             for r in spark.read.parquet(f"{SF_SMALL}/part.parquet").collect()}
    want = {}
    for r in li:
        price, size = parts[r.l_partkey]
        lp = Decimal(repr(price)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        cost = _q2(lp * (56 + 4 * (size % 6)) * Decimal("0.01"))
        disc = Decimal(round(r.l_discount * 10000)) / 100
        qty = int(r.l_quantity)
        gross = lp * (100 - disc) * Decimal("0.01") * qty
        key = (r.l_orderkey, r.l_partkey, qty, disc)
        want.setdefault(key, []).append((_q2(gross), _q2(cost * qty), _q2(gross - cost * qty),
                                         _q2(lp * (100 - disc) * Decimal("0.01"))))
    got = {}
    for r in star.sales_lines.collect():
        key = (r.order_id, r.product_id, r.quantity, r.discount_percent)
        got.setdefault(key, []).append((r.revenue, r.cost, r.profit, r.unit_price))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_revenue_invariants(star):
    total = reports.overall_performance(star).first().total_revenue
    by_state = sum(r.total_revenue for r in reports.vw_revenue_by_state(star).collect())
    by_product = sum(r.total_revenue for r in reports.vw_revenue_by_product(star).collect())
    by_month = sum(r.total_revenue for r in reports.vw_revenue_by_month(star).collect())
    by_rep = sum(r.total_revenue for r in reports.vw_salesperson_performance(star).collect())
    by_customer = sum(r.total_revenue for r in reports.vw_top_customers(star).collect())
    assert total == by_state == by_product == by_month == by_rep == by_customer
    counts = reports.vw_revenue_by_state(star).agg(F.sum("sales_count")).first()[0]
    assert counts == star.t("lineitem").count()


def test_pipeline_invariants(star):
    w = reports.win_rate_overall(star).first()
    assert w.deals_won + w.deals_lost == w.total_closed
    deals = reports.vw_pipeline_by_stage(star).agg(F.sum("num_deals")).first()[0]
    orders = star.t("orders").count()
    assert deals == orders == star.pipeline.count()          # no opportunity dropped
    assert star.pipeline.where("salesperson_id IS NULL").count() == 0
    assert star.pipeline.select("salesperson_id").distinct().count() > 1   # not collapsed onto one rep


def test_products_and_reps_are_all_reachable(spark):
    star = Star.from_parquet(spark, "/root/testdata/sf0.1")
    picked = star.pipeline.agg(F.countDistinct("product_id"), F.countDistinct("salesperson_id")).first()
    assert picked[0] > 19_000 and picked[1] == 1_000


def test_stage_reports_read_orders_alone(star):
    for fn in (reports.pipeline_by_stage, reports.win_rate_overall):
        plan = fn(star)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Join" not in plan
        assert "supplier" not in plan and "part.parquet" not in plan


def test_discounts_keep_hundredths_of_a_percent(spark, star):
    t = {name: star.t(name) for name in ("region", "nation", "customer", "supplier", "part", "orders")}
    t["lineitem"] = star.t("lineitem").withColumn("l_discount", F.lit(0.075))
    bent = Star(spark, DictTables(t))
    r = bent.sales.join(bent.products, "product_id").select("discount_percent", "unit_price", "list_price").first()
    assert r.discount_percent == Decimal("7.50")
    assert r.unit_price == _q2(r.list_price * Decimal("0.925"))


def test_miss_rate_aggregates_the_fact_once_and_q1_shuffles_no_rep(star):
    miss = reports.target_miss_rate(star)
    miss.collect()
    plan = miss._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    q1 = reports.overall_performance(star)._jdf.queryExecution().executedPlan().toString()
    assert "salesperson_id" not in q1


def test_month_report_reads_no_fact_on_a_built_star(spark, star, tmp_path):
    m = star.materialize(str(tmp_path / "star"))
    files = reports.revenue_by_month(m).inputFiles()
    assert files and all("/totals_sale_date/" in f for f in files)


def test_materialize_needs_a_shared_folder_off_local(monkeypatch, spark):
    from quotalake import session

    class Elsewhere:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://host:7077"}.get(key, default)

    with pytest.raises(ValueError):
        session.shared_scratch(Elsewhere())


def test_target_rows_cover_every_rep_month(star):
    start, end = star.calendar_range
    assert (start, end) == (dt.date(1994, 1, 1), dt.date(2001, 12, 31))     # a year before the first order
    assert (star.target_years, star.miss_from_year) == (7, 1995)
    months = (end.year - start.year) * 12 + end.month - start.month + 1
    assert reports.vw_actual_vs_target(star).count() == star.t("supplier").count() * months
    miss = reports.vw_target_miss_rate(star).collect()
    assert all(r.total_months == months - 12 for r in miss)      # from 1995 on


def test_materialized_star_gives_identical_reports(spark, star, tmp_path):
    m = star.materialize(str(tmp_path / "star"), partitions=3)
    for fn in (reports.vw_revenue_by_state, reports.vw_actual_vs_target, reports.vw_win_rate_by_salesperson,
               reports.vw_revenue_by_product, reports.vw_pipeline_by_stage, reports.vw_target_miss_rate,
               reports.vw_salesperson_performance, reports.vw_underperforming_states, reports.top_customers,
               reports.overall_performance, reports.vw_revenue_by_month):
        a = sorted(map(tuple, fn(star).collect()))
        b = sorted(map(tuple, fn(m).collect()))
        assert a == b, fn.__name__


def test_audits_clean_on_driver_data(star):
    rows = {r.rule: r.violations for r in audits.audit_fk(star).collect()}
    assert rows and all(v == 0 for v in rows.values())
    nn = {r.rule: r.violations for r in audits.audit_not_null(star).collect()}
    assert all(v == 0 for v in nn.values())
    checks = {r.rule: r.violations for r in audits.audit_check(star).collect()}
    assert all(v == 0 for v in checks.values())


def _violations(df):
    return {r.rule: r.violations for r in df.collect() if r.violations}


def test_audits_find_injected_violations(spark, star):
    """Every rule family through its public function, on rows that the star's joins would drop."""
    t = {name: star.t(name) for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    t["lineitem"] = t["lineitem"].selectExpr(
        "CASE WHEN l_linenumber = 7 THEN -1 ELSE l_orderkey END AS l_orderkey", "l_linenumber",
        "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN -5 ELSE l_partkey END AS l_partkey",
        "CASE WHEN l_linenumber = 3 THEN -6 ELSE l_suppkey END AS l_suppkey", "l_quantity", "l_discount")
    t["orders"] = t["orders"].selectExpr(
        "CASE WHEN o_orderkey = 2 THEN 1 ELSE o_orderkey END AS o_orderkey",
        "CASE WHEN o_orderkey < 10 THEN NULL WHEN o_orderkey < 30 THEN -7 ELSE o_custkey END AS o_custkey",
        "o_orderdate", "CASE WHEN o_orderkey = 40 THEN -1.0 ELSE o_totalprice END AS o_totalprice")
    t["customer"] = t["customer"].selectExpr("c_custkey", "CASE WHEN c_custkey < 3 THEN NULL ELSE c_name END AS c_name",
                                             "c_mktsegment", "c_nationkey")
    count = {n: t["lineitem"].where(f"l_linenumber = {n}").count() for n in (1, 2, 3, 7)}
    orders = t["orders"].selectExpr("count(CASE WHEN o_custkey IS NULL THEN 1 END) n",
                                    "count(CASE WHEN o_custkey = -7 THEN 1 END) o").first()
    bad = Star(spark, DictTables(t))
    fk = _violations(audits.audit_fk(bad))
    assert fk["fk:sales.product_id"] == count[2] and fk["fk:sales.salesperson_id"] == count[3]
    assert fk["fk:sales.order_id"] >= count[7] > 0
    assert fk["fk:sales.customer_id"] == fk["fk:pipeline.customer_id"] == orders.o > 0
    nulls = _violations(audits.audit_not_null(bad))
    assert nulls["not_null:sales.product_id"] == count[1] > 0
    assert nulls["not_null:sales.customer_id"] == nulls["not_null:pipeline.customer_id"] == orders.n > 0
    assert nulls["not_null:customers.company_name"] == t["customer"].where("c_name IS NULL").count() > 0
    unique = _violations(audits.audit_unique(bad))
    assert unique["unique:pipeline(opportunity_id)"] == 1
    assert _violations(audits.audit_check(bad)) == {"check:pipeline.expected_revenue": 1}


def test_all_registered_queries_match_sql_oracle(spark):
    import __spark_entry__ as entry_mod
    from check_oracle import compare, duck

    con = duck(SF_SMALL)
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sqls) <= set(qs)
    failures = []
    for name, fn in qs.items():
        if name not in sqls:  # queries that SQL cannot express have tests of their own
            continue
        ok, msg, _ = compare(spark, con, SF_SMALL, name, fn, sqls[name])
        if not ok:
            failures.append((name, msg))
    assert not failures


def test_entry_smoke(spark):
    import __spark_entry__ as entry_mod

    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "pct_of_target" in df.columns


def test_views_registered_and_published(spark, star, tmp_path):
    names = reports.register_views(star)
    assert len(names) == 10
    a = spark.sql("SELECT sum(total_revenue) AS t FROM vw_revenue_by_state").first().t
    b = spark.sql("SELECT sum(total_revenue) AS t FROM vw_revenue_by_month").first().t
    assert a == b == reports.overall_performance(star).first().total_revenue
    m = star.materialize(str(tmp_path / "star"))
    paths = reports.publish_views(m, str(tmp_path / "views"))
    back = spark.read.parquet(paths["vw_pipeline_by_stage"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, reports.vw_pipeline_by_stage(star).collect()))
