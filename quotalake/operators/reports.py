"""The analysis reports (Q1-Q10b) and the published views.

Each ``vw_*`` function returns the unsorted view; the matching report adds
the sort, limit or final projection.  Money stays DECIMAL(p, 2); every ratio
is rounded once, exactly, half away from zero (``functions.exact``).

Plan shape: the sales fact is aggregated on its own foreign key first (map-side
partial aggregation collapses hot keys before the shuffle), and only then
joined to the dimension that supplies the grouping attribute.  Dimension
attributes that depend on the key (names, state) are carried through that
join instead of being grouped on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotalake.functions.exact import (
    as_int,
    half_up_quotient,
    money_from_cents,
    pct,
    unscale,
)
from quotalake.functions.text import full_name, title_case
from quotalake.operators.build import STAGES
from quotalake.sources.star import Star, totals_by
from quotalake.sources.yearly import YearlyStar

# Profit tiers of the product report.
TIER_HIGH = "High"
TIER_MEDIUM = "Medium"
TIER_LOW = "Low"

# A calendar of more days (some 270 years; a date far out) is joined by a shuffle.
MAX_BROADCAST_DAYS = 100_000


def _margin(rev_c: str = "rev_c", prof_c: str = "prof_c"):
    # As wide as a DECIMAL goes: a tiny revenue beside a large loss is no error.
    return pct(F.col(prof_c), F.col(rev_c), 2)


def _money(c: str, name: str):
    return money_from_cents(F.col(c), 24).alias(name)


def _avg(c: str, n: str, name: str):
    """ROUND(sum / n, 2) from a cents sum, exactly."""
    return unscale(half_up_quotient(F.col(c), F.col(n)), 2, 24).alias(name)


# --- Q1 ---------------------------------------------------------------------

def overall_performance(star: Star) -> DataFrame:
    """Q1: total revenue, total profit, margin % (NULL when revenue is 0)."""
    return (star.grand_totals()
            .select(_money("rev_c", "total_revenue"), _money("prof_c", "total_profit"),
                    _margin().alias("margin_pct")))


# --- Q2 / V1 ----------------------------------------------------------------

def vw_revenue_by_month(star: Star) -> DataFrame:
    """V1: revenue per calendar (year, month, month_name).

    Sales are first summed per day (partial aggregation, at most one group per
    day), then joined to the calendar, which is broadcast if its row count is
    known to be small; the final aggregation has one group per month.
    """
    cal = star.calendar.select("date", "year", "month", "month_name")
    if star.calendar_rows is not None and star.calendar_rows <= MAX_BROADCAST_DAYS:
        cal = F.broadcast(cal)
    daily = star.sales_totals("sale_date").select("sale_date", "rev_c")
    return (daily.join(cal, daily["sale_date"] == cal["date"], "inner")
            .groupBy("year", "month", "month_name")
            .agg(F.sum("rev_c").alias("rev_c"))
            .select("year", "month", "month_name", _money("rev_c", "total_revenue")))


def revenue_by_month_of(star: YearlyStar, financial_year: str) -> DataFrame:
    """V1 for one financial year, over sales stored by calendar year.

    The calendar rows of that year decide at run time which partitions of the
    sales are read: the join has the partition column in its key, and the days
    are summed by it as well, so the pruning reaches the scan.
    """
    cal = star.calendar.where(F.col("financial_year") == financial_year).select("date", "year", "month", "month_name")
    if star.calendar_rows is not None and star.calendar_rows <= MAX_BROADCAST_DAYS:
        cal = F.broadcast(cal)
    daily = totals_by(star.sales_by_year, "sale_year", "sale_date").select("sale_year", "sale_date", "rev_c")
    return (daily.join(cal, (daily["sale_year"] == cal["year"]) & (daily["sale_date"] == cal["date"]), "inner")
            .groupBy("year", "month", "month_name")
            .agg(F.sum("rev_c").alias("rev_c"))
            .select("year", "month", "month_name", _money("rev_c", "total_revenue")))


def revenue_by_month(star: Star) -> DataFrame:
    """Q2: V1 sorted by (year, month), with ``month`` dropped after the sort."""
    return (vw_revenue_by_month(star).orderBy("year", "month")
            .select("year", "month_name", "total_revenue"))


# --- Q3 / V2 ----------------------------------------------------------------

def _state_summary(star: Star) -> DataFrame:
    per_customer = star.sales_totals("customer_id")
    cust = star.customers.select("customer_id", "state")
    return (per_customer.join(cust, "customer_id", "inner")
            .groupBy("state")
            .agg(F.sum("rev_c").alias("rev_c"), F.sum("prof_c").alias("prof_c"),
                 F.sum("sales_count").alias("sales_count"))
            .select("state", _money("rev_c", "total_revenue"), _money("prof_c", "total_profit"),
                    _margin().alias("margin_pct"), "sales_count", "rev_c"))


def vw_revenue_by_state(star: Star) -> DataFrame:
    """V2: revenue, profit, margin % and sale count per customer state."""
    return _public(_state_summary(star))


def revenue_by_state(star: Star) -> DataFrame:
    """Q3: V2 by revenue, largest first."""
    return vw_revenue_by_state(star).orderBy(F.desc_nulls_first("total_revenue"))


def _public(df: DataFrame) -> DataFrame:
    """Drop the helper cents columns a view keeps for its dependants."""
    return df.drop(*[c for c in df.columns if c.endswith("_c")])


# --- Q4 / V3 ----------------------------------------------------------------

def _product_summary(star: Star) -> DataFrame:
    per_product = star.sales_totals("product_id")
    names = star.products.select("product_id", "product_name")
    return (per_product.join(names, "product_id", "inner")
            .select("product_id", "product_name", _money("rev_c", "total_revenue"),
                    _money("prof_c", "total_profit"), "sales_count",
                    _avg("rev_c", "sales_count", "avg_revenue"),
                    _avg("prof_c", "sales_count", "avg_profit"), "prof_c"))


def _tier(at_least_high, at_least_medium):
    return (F.when(at_least_high, F.lit(TIER_HIGH))
            .when(at_least_medium, F.lit(TIER_MEDIUM))
            .otherwise(F.lit(TIER_LOW)))


def vw_revenue_by_product(star: Star) -> DataFrame:
    """V3: product summary, tiered on the exact (unrounded) mean profit.

    ``avg >= t`` is tested as ``sum >= t * count``, which is exact.
    """
    c = star.config
    s = as_int(F.col("prof_c"))
    n = as_int(F.col("sales_count"))
    tier = _tier(s >= F.lit(c.tier_high * 100) * n, s >= F.lit(c.tier_medium * 100) * n)
    return _public(_product_summary(star).withColumn("profit_tier", tier))


def revenue_by_product(star: Star) -> DataFrame:
    """Q4: product summary tiered on the mean profit rounded to cents, by revenue."""
    c = star.config
    a = F.col("avg_profit")
    tier = _tier(a >= F.lit(c.tier_high), a >= F.lit(c.tier_medium))
    return (_public(_product_summary(star).withColumn("profit_tier", tier))
            .orderBy(F.desc_nulls_first("total_revenue")))


# --- Q5 / V4 ----------------------------------------------------------------

def vw_salesperson_performance(star: Star) -> DataFrame:
    """V4: per rep with sales: title-cased name, hire date, totals, mean deal size, count.

    ``hire_date`` is there if the source has it (the driver tables do not).
    """
    per_rep = star.sales_totals("salesperson_id")
    hired = [c for c in ("hire_date",) if c in star.salespeople_opening.columns]
    reps = star.salespeople_opening.select("salesperson_id", "first_name", "last_name", *hired)
    return (per_rep.join(reps, "salesperson_id", "inner")
            .select("salesperson_id",
                    title_case(full_name(F.col("first_name"), F.col("last_name"))).alias("full_name"), *hired,
                    _money("rev_c", "total_revenue"), _money("prof_c", "total_profit"),
                    _avg("rev_c", "sales_count", "avg_deal_size"), "sales_count"))


def salesperson_performance(star: Star) -> DataFrame:
    """Q5: V4 by revenue, largest first."""
    return vw_salesperson_performance(star).orderBy(F.desc_nulls_first("total_revenue"))


# --- Q6 / V5 ----------------------------------------------------------------

def _target_months(star: Star, from_year: int | None = None) -> DataFrame:
    """Every (rep, month) target with the rep's name and actual revenue (0 if none).

    The left join keeps months without sales.  The actuals are the same plan
    that the rescale rolls up, so the fact is aggregated once.
    """
    return (star.target_rows(from_year).join(star.actuals_since(from_year), ["salesperson_id", "year", "month"], "left")
            .withColumn("actual_cents", F.coalesce(F.col("actual_cents"), F.lit(0).cast("decimal(30,0)"))))


def vw_actual_vs_target(star: Star) -> DataFrame:
    """V5: every target month with actual, variance and % of target (1 dp)."""
    t = _target_months(star)
    return t.select(
        "salesperson_id", "full_name", "year", "month", "monthly_target",
        _money("actual_cents", "actual_revenue"),
        money_from_cents(F.col("actual_cents") - F.col("target_cents"), 24).alias("variance"),
        pct(F.col("actual_cents"), F.col("target_cents"), 1)
        .alias("pct_of_target"))


def actual_vs_target(star: Star) -> DataFrame:
    """Q6: V5 by rep, year, month."""
    return vw_actual_vs_target(star).orderBy("salesperson_id", "year", "month")


# --- Q7 / V6 ----------------------------------------------------------------

def vw_top_customers(star: Star) -> DataFrame:
    """V6: every customer with sales, with revenue, profit and purchase count."""
    per_customer = star.sales_totals("customer_id")
    cust = star.customers.select("customer_id", "company_name", "industry", "state")
    return (per_customer.join(cust, "customer_id", "inner")
            .select("customer_id", "company_name", "industry", "state",
                    _money("rev_c", "total_revenue"), _money("prof_c", "total_profit"),
                    F.col("sales_count").alias("num_purchases")))


def top_customers(star: Star, n: int | None = None) -> DataFrame:
    """Q7: the n largest customers by revenue (ties broken by customer id).

    The top n are taken from the totals of known customers (a semi-join on the
    key, then a distributed top-k), and only these n rows, a bound given by
    ``n``, are broadcast into the join that fetches the attributes.
    """
    n = star.config.top_customers if n is None else n
    known = star.customers.select("customer_id")
    top = (star.sales_totals("customer_id").join(known, "customer_id", "left_semi")
           .orderBy(F.desc_nulls_first("rev_c"), F.asc("customer_id")).limit(n))
    cust = star.customers.select("customer_id", "company_name", "industry", "state")
    return (cust.join(F.broadcast(top), "customer_id", "inner")
            .select("customer_id", "company_name", "industry", "state",
                    _money("rev_c", "total_revenue"), _money("prof_c", "total_profit"),
                    F.col("sales_count").alias("num_purchases"))
            .orderBy(F.desc_nulls_first("total_revenue"), F.asc("customer_id")))


# --- Q8 / V7 ----------------------------------------------------------------

def vw_pipeline_by_stage(star: Star) -> DataFrame:
    """V7: deals, expected revenue and probability-weighted value per stage.

    Aggregated in two steps: BIGINT cents per (stage, probability) over the
    fact, then the exact weighted sum ``sum(p * E) / 100`` over those few
    groups in DECIMAL -- no per-row DECIMAL multiplication.
    """
    per_prob = star.stage_values()
    hundredths = as_int(F.col("probability") * F.lit(100))
    per_stage = (per_prob.groupBy("stage")
                 .agg(F.sum("n").alias("num_deals"),
                      F.sum("e_c").alias("e_c"),
                      F.sum(as_int(F.col("e_c")) * hundredths).alias("w")))
    return per_stage.select(
        "stage", "num_deals", _money("e_c", "total_expected_revenue"),
        unscale(half_up_quotient(F.col("w"), F.lit(10000)), 2, 38).alias("weighted_pipeline_value"))


def stage_rank(stage):
    """Funnel position of a stage (1-6), NULL for an unknown stage."""
    expr = None
    for i, name in enumerate(STAGES, start=1):
        expr = F.when(stage == F.lit(name), F.lit(i)) if expr is None else expr.when(stage == F.lit(name), F.lit(i))
    return expr


def pipeline_by_stage(star: Star) -> DataFrame:
    """Q8: V7 in funnel order, unknown stages last."""
    v = vw_pipeline_by_stage(star)
    return v.orderBy(F.asc_nulls_last(stage_rank(F.col("stage")))).select(*v.columns)


# --- Q9a / Q9b / V8 ---------------------------------------------------------

def _win_rate():
    return pct(F.col("deals_won"), F.col("total_closed"), 1)


def win_rate_overall(star: Star) -> DataFrame:
    """Deals won, lost, closed and win % over all opportunities."""
    return (star.deal_counts()
            .select("deals_won", "deals_lost", "total_closed", _win_rate().alias("win_rate_pct")))


def vw_win_rate_by_salesperson(star: Star) -> DataFrame:
    """V8: per rep with opportunities: won, closed, win % (NULL if none closed)."""
    per_rep = star.deal_counts("salesperson_id").drop("deals_lost")
    reps = star.salespeople_opening.select("salesperson_id", "first_name", "last_name")
    return (per_rep.join(reps, "salesperson_id", "inner")
            .select("salesperson_id",
                    full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
                    "deals_won", "total_closed", _win_rate().alias("win_rate_pct")))


def win_rate_by_salesperson(star: Star) -> DataFrame:
    """V8 by win rate, highest first, NULL rates first (SQL DESC order)."""
    return vw_win_rate_by_salesperson(star).orderBy(F.desc_nulls_first("win_rate_pct"),
                                                   F.asc("salesperson_id"))


# --- Q10a / V9 ----------------------------------------------------------------

def vw_underperforming_states(star: Star) -> DataFrame:
    """V9: each state's revenue, the mean over states, and the difference (2 dp).

    The mean is a window over the per-state aggregate, i.e. over one row per
    state, never over the fact table.
    """
    by_state = _state_summary(star).select("state", "total_revenue", "rev_c")
    everything = Window.partitionBy()
    c = as_int(F.col("rev_c"))
    total = F.sum(c).over(everything)
    n = F.count(F.lit(1)).over(everything)
    return by_state.select(
        "state", "total_revenue",
        unscale(half_up_quotient(as_int(total), n), 2, 38).alias("company_avg_revenue"),
        unscale(half_up_quotient(as_int(n) * c - as_int(total), n), 2, 38).alias("variance_from_avg"))


def state_variance(star: Star) -> DataFrame:
    """V9 by revenue, smallest first (lists every state)."""
    return vw_underperforming_states(star).orderBy(F.asc_nulls_last("total_revenue"))


# --- Q10b / V10 -------------------------------------------------------------

def vw_target_miss_rate(star: Star, from_year: int | None = None) -> DataFrame:
    """Per rep, months with actual < target since ``from_year``, and the share."""
    from_year = star.miss_from_year if from_year is None else from_year
    t = _target_months(star, from_year)
    missed = F.count(F.when(F.col("actual_cents") < F.col("target_cents"), F.col("month")))
    return (t.groupBy("salesperson_id", "full_name")
            .agg(missed.alias("months_missed"), F.count("month").alias("total_months"))
            .select("salesperson_id", "full_name", "months_missed", "total_months",
                    pct(F.col("months_missed"), F.col("total_months"), 1).alias("pct_months_missed")))


def target_miss_rate(star: Star, from_year: int | None = None) -> DataFrame:
    """V10 by miss share, highest first."""
    return vw_target_miss_rate(star, from_year).orderBy(F.desc_nulls_first("pct_months_missed"),
                                                        F.asc("salesperson_id"))


VIEWS = {
    "vw_revenue_by_month": vw_revenue_by_month,
    "vw_revenue_by_state": vw_revenue_by_state,
    "vw_revenue_by_product": vw_revenue_by_product,
    "vw_salesperson_performance": vw_salesperson_performance,
    "vw_actual_vs_target": vw_actual_vs_target,
    "vw_top_customers": vw_top_customers,
    "vw_pipeline_by_stage": vw_pipeline_by_stage,
    "vw_win_rate_by_salesperson": vw_win_rate_by_salesperson,
    "vw_underperforming_states": vw_underperforming_states,
    "vw_target_miss_rate": vw_target_miss_rate,
}


def register_views(star: Star) -> list[str]:
    """Publish the ten views as temp views (plain, recomputed on every read)."""
    for name, fn in VIEWS.items():
        fn(star).createOrReplaceTempView(name)
    return list(VIEWS)


def publish_views(star: Star, out_dir: str) -> dict[str, str]:
    """Write every view as a versioned table under ``out_dir``; returns the folder of each new version.

    The tables a BI layer reads without re-running the joins
    (``SnapshotTable.read`` finds the newest).  A refresh that fails leaves all
    readers the earlier rows.
    """
    from quotalake.sources.snapshots import SnapshotTable

    found = {}
    for name, fn in VIEWS.items():
        table = SnapshotTable(star.spark, f"{out_dir.rstrip('/')}/{name}")
        table.replace(fn(star))
        found[name] = f"{table.path}/_data/{table.manifest()['parts']['']}"
    return found
