"""Hand-made micro-fixtures for the semantic traps of the reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quotalake.operators import reports
from quotalake.sources.star import StarConfig

from conftest import star_with

SALES_SCHEMA = ("customer_id long, salesperson_id long, product_id long, sale_date date, quantity int, "
                "discount_percent decimal(5,2), unit_price_cents long, revenue_cents long, "
                "cost_cents long, profit_cents long")
REPS_SCHEMA = ("salesperson_id long, first_name string, last_name string, state string, region string, "
               "annual_target decimal(14,2), n_nationkey int")
PIPE_SCHEMA = ("opportunity_id long, customer_id long, salesperson_id long, stage string, "
               "probability decimal(5,2), expected_close_date date, expected_revenue_cents long")

D = dt.date


def sale(cust, rep, prod, day, rev_c, prof_c):
    return (cust, rep, prod, day, 1, Decimal("0.00"), rev_c, rev_c, rev_c - prof_c, prof_c)


def pipeline_df(spark, rows):
    df = spark.createDataFrame(rows, PIPE_SCHEMA)
    return df.withColumn("expected_revenue", (F.col("expected_revenue_cents") / 100).cast("decimal(14,2)"))


def reps_df(spark, rows):
    return spark.createDataFrame(rows, REPS_SCHEMA)


def test_margin_is_null_when_revenue_is_zero(spark):
    star = star_with(spark, sales=spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 1), 0, 0)], SALES_SCHEMA))
    r = reports.overall_performance(star).first()
    assert r.total_revenue == Decimal("0.00") and r.margin_pct is None


def test_margin_of_a_tiny_revenue_is_no_error(spark):
    star = star_with(spark, sales=spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 1), 1, -900_000_000_000)], SALES_SCHEMA))
    assert reports.overall_performance(star).first().margin_pct == Decimal("-90000000000000.00")


def test_margin_half_up(spark):
    # profit / revenue = 1 / 8 = 12.5 % exactly; 1/3 -> 33.33 %
    star = star_with(spark, sales=spark.createDataFrame(
        [sale(1, 1, 1, D(1995, 1, 1), 800, 100)], SALES_SCHEMA))
    assert reports.overall_performance(star).first().margin_pct == Decimal("12.50")
    star = star_with(spark, sales=spark.createDataFrame(
        [sale(1, 1, 1, D(1995, 1, 1), 300, 100)], SALES_SCHEMA))
    assert reports.overall_performance(star).first().margin_pct == Decimal("33.33")


def _product_star(spark, profits_c):
    sales = spark.createDataFrame([sale(1, 1, 7, D(1995, 1, 1), 2_000_000, p) for p in profits_c], SALES_SCHEMA)
    products = spark.createDataFrame([(7, "widget")], "product_id long, product_name string")
    return star_with(spark, StarConfig(tier_high=8000, tier_medium=5000), sales=sales, products=products)


def test_tier_on_rounded_vs_exact_mean(spark):
    # mean profit 7999.995: the report rounds to 8000.00 first (High), the view
    # tiers the exact mean (Medium).
    star = _product_star(spark, [799_999, 800_000])
    q4 = reports.revenue_by_product(star).first()
    v3 = reports.vw_revenue_by_product(star).first()
    assert q4.avg_profit == Decimal("8000.00")
    assert q4.profit_tier == "High" and v3.profit_tier == "Medium"


def test_tier_exact_threshold_is_inclusive(spark):
    star = _product_star(spark, [800_000, 800_000])
    assert reports.vw_revenue_by_product(star).first().profit_tier == "High"


def test_actual_equal_to_target_is_not_missed_and_empty_month_is(spark):
    # Rep 1: 1200.00 of revenue, all in January -> annual 1200.00, 100.00 a month;
    # January beats the target, February has no sales (actual 0, missed).
    # Rep 2: no sales, opening target 0 -> target 0 == actual 0: not missed,
    # and the % of target is NULL (NULLIF on a zero target).
    cfg = StarConfig(calendar_start=D(1995, 1, 1), calendar_end=D(1995, 2, 28), target_years=1,
                     target_share_pct=100, miss_from_year=1995)
    sales = spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 15), 120_000, 0)], SALES_SCHEMA)
    reps = reps_df(spark, [(1, "Ann", "Lee", "S", "R", Decimal("0.00"), 0),
                           (2, "Bob", "Ray", "S", "R", Decimal("0.00"), 0)])
    star = star_with(spark, cfg, sales=sales, salespeople_opening=reps)
    rows = {(r.salesperson_id, r.month): r for r in reports.actual_vs_target(star).collect()}
    assert len(rows) == 4
    assert rows[(1, 1)].monthly_target == Decimal("100.00")
    assert rows[(1, 1)].actual_revenue == Decimal("1200.00")
    assert rows[(1, 2)].actual_revenue == Decimal("0.00") and rows[(1, 2)].variance == Decimal("-100.00")
    assert rows[(2, 1)].monthly_target == Decimal("0.00") and rows[(2, 1)].pct_of_target is None
    miss = {r.salesperson_id: r for r in reports.target_miss_rate(star).collect()}
    assert (miss[1].months_missed, miss[1].total_months, miss[1].pct_months_missed) == (1, 2, Decimal("50.0"))
    assert (miss[2].months_missed, miss[2].pct_months_missed) == (0, Decimal("0.0"))


def test_equal_actual_and_target_exactly(spark):
    cfg = StarConfig(calendar_start=D(1995, 1, 1), calendar_end=D(1995, 1, 31), target_years=1,
                     target_share_pct=100, miss_from_year=1995)
    # revenue 1200.00 in the single month -> annual 1200.00 -> monthly 100.00; actual 1200 >= 100
    sales = spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 15), 1_200, 0)], SALES_SCHEMA)
    reps = reps_df(spark, [(1, "Ann", "Lee", "S", "R", Decimal("0.00"), 0)])
    star = star_with(spark, cfg, sales=sales, salespeople_opening=reps)
    r = reports.actual_vs_target(star).first()
    # 12.00 revenue -> annual 12.00 -> monthly 1.00; actual 12.00
    assert r.monthly_target == Decimal("1.00") and r.actual_revenue == Decimal("12.00")
    assert r.pct_of_target == Decimal("1200.0") and r.variance == Decimal("11.00")


def test_rep_without_sales_keeps_opening_target(spark):
    cfg = StarConfig(calendar_start=D(1995, 1, 1), calendar_end=D(1995, 1, 31), target_years=1)
    sales = spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 15), 1_000, 0)], SALES_SCHEMA)
    reps = reps_df(spark, [(1, "Ann", "Lee", "S", "R", Decimal("5.00"), 0),
                           (2, "Bob", "Ray", "S", "R", Decimal("24.00"), 0)])
    star = star_with(spark, cfg, sales=sales, salespeople_opening=reps)
    got = {r.salesperson_id: r.annual_target for r in star.salespeople.collect()}
    assert got == {1: Decimal("9.00"), 2: Decimal("24.00")}
    t = {r.salesperson_id: r.monthly_target for r in star.targets.collect()}
    assert t == {1: Decimal("0.75"), 2: Decimal("2.00")}


def test_win_rate_null_first_and_unknown_stage_last(spark):
    rows = [(1, 1, 1, "Closed Won", Decimal(100), D(1995, 1, 1), 100),
            (2, 1, 1, "Closed Lost", Decimal(0), D(1995, 1, 1), 100),
            (3, 1, 2, "Prospecting", Decimal(10), D(1995, 1, 1), 100),   # rep 2: nothing closed
            (4, 1, 3, "Closed Won", Decimal(100), D(1995, 1, 1), 100),
            (5, 1, 3, "Mystery", Decimal(5), D(1995, 1, 1), 100)]
    reps = reps_df(spark, [(i, "A", str(i), "S", "R", Decimal(0), 0) for i in (1, 2, 3, 4)])
    star = star_with(spark, pipeline=pipeline_df(spark, rows), salespeople_opening=reps)
    by_rep = reports.win_rate_by_salesperson(star).collect()
    assert [r.salesperson_id for r in by_rep] == [2, 3, 1]       # NULL first, then 100 %, 50 %
    assert by_rep[0].win_rate_pct is None and by_rep[2].win_rate_pct == Decimal("50.0")
    stages = [r.stage for r in reports.pipeline_by_stage(star).collect()]
    assert stages == ["Prospecting", "Closed Won", "Closed Lost", "Mystery"]
    overall = reports.win_rate_overall(star).first()
    assert (overall.deals_won, overall.deals_lost, overall.total_closed) == (2, 1, 3)
    assert overall.win_rate_pct == Decimal("66.7")


def test_weighted_pipeline_value_is_exact(spark):
    # 0.05 * 25 % = 0.0125 and 0.03 * 25 % = 0.0075: each alone rounds differently than their sum
    rows = [(1, 1, 1, "Qualification", Decimal(25), D(1995, 1, 1), 5),
            (2, 1, 1, "Qualification", Decimal(25), D(1995, 1, 1), 3)]
    star = star_with(spark, pipeline=pipeline_df(spark, rows))
    r = reports.vw_pipeline_by_stage(star).first()
    assert r.num_deals == 2 and r.total_expected_revenue == Decimal("0.08")
    assert r.weighted_pipeline_value == Decimal("0.02")


def test_state_variance_lists_all_states_sorted(spark):
    sales = spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 1), 100, 0),
                                   sale(2, 1, 1, D(1995, 1, 1), 200, 0),
                                   sale(3, 1, 1, D(1995, 1, 1), 201, 0)], SALES_SCHEMA)
    customers = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "customer_id long, state string")
    star = star_with(spark, sales=sales, customers=customers)
    rows = reports.state_variance(star).collect()
    assert [r.state for r in rows] == ["A", "B", "C"]
    # mean of 1.00, 2.00, 2.01 = 1.67 (1.6666..); differences rounded once from exact values
    assert [r.company_avg_revenue for r in rows] == [Decimal("1.67")] * 3
    assert [r.variance_from_avg for r in rows] == [Decimal("-0.67"), Decimal("0.33"), Decimal("0.34")]


def test_top_customers_limit_and_tie_break(spark):
    sales = spark.createDataFrame([sale(c, 1, 1, D(1995, 1, 1), 100 * (c % 3), 0) for c in range(1, 30)],
                                  SALES_SCHEMA)
    customers = spark.createDataFrame([(c, f"C{c}", "I", "S") for c in range(1, 30)],
                                      "customer_id long, company_name string, industry string, state string")
    star = star_with(spark, sales=sales, customers=customers)
    top = reports.top_customers(star, 5).collect()
    assert [r.customer_id for r in top] == [2, 5, 8, 11, 14]
    assert reports.vw_top_customers(star).count() == 29


def test_revenue_by_month_drops_month_after_sorting(spark):
    cfg = StarConfig(calendar_start=D(1995, 1, 1), calendar_end=D(1995, 12, 31))
    sales = spark.createDataFrame([sale(1, 1, 1, D(1995, m, 3), 100 * m, 0) for m in (11, 2, 9)], SALES_SCHEMA)
    star = star_with(spark, cfg, sales=sales)
    rows = reports.revenue_by_month(star).collect()
    assert [r.month_name for r in rows] == ["February", "September", "November"]
    assert rows[0].__fields__ == ["year", "month_name", "total_revenue"]


def test_salesperson_name_title_case(spark):
    sales = spark.createDataFrame([sale(1, 1, 1, D(1995, 1, 1), 100, 10)], SALES_SCHEMA)
    reps = reps_df(spark, [(1, "jANE", "doe", "S", "R", Decimal(0), 0)])
    star = star_with(spark, sales=sales, salespeople_opening=reps)
    assert reports.salesperson_performance(star).first().full_name == "Jane Doe"


def test_title_case_breaks_words_like_sql_initcap(spark):
    from quotalake.functions.text import title_case

    df = spark.createDataFrame([("o'brien-smith",), ("jANE doe",), ("",), (None,), ("élan 2nd",)], "s string")
    got = [r.t for r in df.select(title_case(F.col("s")).alias("t")).collect()]
    assert got == ["O'Brien-Smith", "Jane Doe", "", None, "Élan 2nd"]
