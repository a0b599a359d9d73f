"""All reports over hand-made tables that already have the star's schema."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from quotalake.operators import audits, reports
from quotalake.sources.native_star import NativeStar

D = dt.date


def _m(x):
    return Decimal(x).quantize(Decimal("0.01"))


@pytest.fixture(scope="module")
def frames(spark):
    make = spark.createDataFrame
    return {
        "customers": make([(1, "Acme", "Mining", "NSW", "Perth", "Small", D(2021, 1, 1)),
                           (2, "Bolt", "Civil", "VIC", "Melbourne", "Large", D(2021, 1, 1))],
                          "customer_id int, company_name string, industry string, state string, city string, "
                          "customer_size string, created_date date"),
        "products": make([(1, "Digger", "Earthmoving", _m(60), _m(100)), (2, "Forklift", "Handling", _m(20), _m(40))],
                         "product_id int, product_name string, category string, standard_cost decimal(10,2), "
                         "list_price decimal(10,2)"),
        "salespeople": make([(1, "ann", "o'lee", "NSW", "East", "Max", D(2019, 5, 1), _m(1200)),
                             (2, "bob", "ray", "VIC", "South", "Max", D(2020, 6, 2), _m(600))],
                            "salesperson_id int, first_name string, last_name string, state string, region string, "
                            "manager string, hire_date date, annual_target decimal(14,2)"),
        "sales": make([(1, 1, 1, 1, D(2022, 1, 5), 2, _m(0), _m(100), _m(200), _m(120), _m(80)),
                       (2, 2, 2, 2, D(2022, 2, 6), 1, _m("7.5"), _m(37), _m(37), _m(20), _m(17)),
                       (3, 1, 1, 2, D(2022, 2, 7), 1, _m(0), _m(40), _m(40), _m(20), _m(20))],
                      "sale_id int, customer_id int, salesperson_id int, product_id int, sale_date date, quantity int, "
                      "discount_percent decimal(5,2), unit_price decimal(12,2), revenue decimal(14,2), "
                      "cost decimal(14,2), profit decimal(14,2)"),
        "pipeline": make([(1, 1, 1, 1, "Closed Won", _m(100), D(2022, 7, 1), _m(500)),
                          (2, 2, 1, 2, "Closed Lost", _m(0), D(2022, 8, 1), _m(300)),
                          (3, 2, 2, 2, "Proposal", _m(50), D(2022, 9, 1), _m(200))],
                         "opportunity_id int, customer_id int, salesperson_id int, product_id int, stage string, "
                         "probability decimal(5,2), expected_close_date date, expected_revenue decimal(14,2)"),
        "targets": make([(1, 1, 2022, 1, _m(150)), (2, 1, 2022, 2, _m(50)), (3, 2, 2022, 1, _m(10)),
                         (4, 2, 2022, 2, _m(37)), (5, 1, 2021, 12, _m(99))],
                        "target_id int, salesperson_id int, year int, month int, monthly_target decimal(14,2)"),
        "calendar": make([(D(2022, m, d), 2022, 1, m, n, 1, d, "FY2022") for m, d, n in
                          ((1, 5, "January"), (2, 6, "February"), (2, 7, "February"))],
                         "date date, year int, quarter int, month int, month_name string, week int, day int, "
                         "financial_year string"),
    }


@pytest.fixture(scope="module")
def star(spark, frames):
    return NativeStar.from_frames(spark, frames)


def test_sales_reports(star):
    q1 = reports.overall_performance(star).first()
    assert (q1.total_revenue, q1.total_profit, q1.margin_pct) == (_m(277), _m(117), _m("42.24"))
    assert [(r.month_name, r.total_revenue) for r in reports.revenue_by_month(star).collect()] == [
        ("January", _m(200)), ("February", _m(77))]
    assert [(r.state, r.total_revenue, r.sales_count) for r in reports.revenue_by_state(star).collect()] == [
        ("NSW", _m(240), 2), ("VIC", _m(37), 1)]
    assert [(r.product_name, r.sales_count, r.avg_profit, r.profit_tier) for r in
            reports.revenue_by_product(star).collect()] == [("Digger", 1, _m(80), "Low"), ("Forklift", 2, _m("18.5"), "Low")]
    assert [(r.company_name, r.num_purchases) for r in reports.top_customers(star).collect()] == [("Acme", 2), ("Bolt", 1)]
    assert [(r.state, r.variance_from_avg) for r in reports.state_variance(star).collect()] == [
        ("VIC", _m("-101.5")), ("NSW", _m("101.5"))]


def test_hire_date_is_carried(star):
    rows = reports.salesperson_performance(star).collect()
    assert [(r.full_name, r.hire_date, r.avg_deal_size) for r in rows] == [
        ("Ann O'Lee", D(2019, 5, 1), _m(120)), ("Bob Ray", D(2020, 6, 2), _m(37))]


def test_stored_targets_decide(spark, frames, star):
    rows = [(r.salesperson_id, r.year, r.month, r.monthly_target, r.actual_revenue)
            for r in reports.actual_vs_target(star).collect()]
    assert rows == [(1, 2021, 12, _m(99), _m(0)), (1, 2022, 1, _m(150), _m(200)), (1, 2022, 2, _m(50), _m(40)),
                    (2, 2022, 1, _m(10), _m(0)), (2, 2022, 2, _m(37), _m(37))]
    miss = {r.salesperson_id: (r.months_missed, r.total_months) for r in reports.target_miss_rate(star).collect()}
    assert miss == {1: (1, 2), 2: (1, 2)}
    edited = frames["targets"].selectExpr("target_id", "salesperson_id", "year", "month",
                                          "CAST(1 AS DECIMAL(14,2)) AS monthly_target")
    again = NativeStar.from_frames(spark, {**frames, "targets": edited})
    assert {r.salesperson_id: r.months_missed for r in reports.target_miss_rate(again).collect()} == {1: 0, 2: 1}


def test_pipeline_reports(star):
    assert [(r.stage, r.num_deals, r.weighted_pipeline_value) for r in reports.pipeline_by_stage(star).collect()] == [
        ("Proposal", 1, _m(100)), ("Closed Won", 1, _m(500)), ("Closed Lost", 1, _m(0))]
    w = reports.win_rate_overall(star).first()
    assert (w.deals_won, w.deals_lost, w.win_rate_pct) == (1, 1, Decimal("50.0"))
    assert [(r.full_name, r.win_rate_pct) for r in reports.win_rate_by_salesperson(star).collect()] == [
        ("bob ray", None), ("ann o'lee", Decimal("50.0"))]


def test_rescale_audits_and_files(spark, frames, star, tmp_path):
    assert {r.salesperson_id: r.annual_target for r in star.salespeople.collect()} == {1: _m(216), 2: _m("33.3")}
    assert all(r.violations == 0 for fn in (audits.audit_unique, audits.audit_fk, audits.audit_check,
                                            audits.audit_not_null)
               for r in fn(star).collect() if r.rule != "not_null:targets.target_id")
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    back = NativeStar.from_parquet(spark, str(tmp_path))
    assert reports.overall_performance(back).first().total_revenue == _m(277)
    assert len(reports.register_views(back)) == 10
