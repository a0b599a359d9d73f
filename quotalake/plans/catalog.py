"""Registry of every query the package answers, keyed like the oracle SQL.

``QUERIES[name](star)`` returns the exact-decimal DataFrame;
``driver_queries()`` adapts each to the ``(spark, sf_dir) -> DataFrame``
contract and casts DECIMAL columns to DOUBLE (and DATE to ISO text) so both sides of the SQL-oracle
comparison carry the same type.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from quotalake.functions.draws import CUSTOMER, key_draw
from quotalake.operators import audits, reports
from quotalake.operators.build import beaten_targets, target_validation, value_opportunity
from quotalake.operators.kept import KeptStar, KeptTotals
from quotalake.operators.load_audit import materialize_audited
from quotalake.operators.ranking import kth_pick
from quotalake.session import apply_defaults, shared_scratch
from quotalake.sources.snapshots import SnapshotTable
from quotalake.sources.star import Star, StarConfig
from quotalake.sources.yearly import YearlyStar

def _without_cents(df: DataFrame) -> DataFrame:
    """The public columns of a star table (the BIGINT-cents carriers dropped)."""
    return df.drop(*[c for c in df.columns if c.endswith("_cents")], "order_id", "line_number")


def _value_opportunities(star: Star) -> DataFrame:
    """B11 over every line item as an opportunity line: list price x quantity, undiscounted."""
    li = star.t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = star.products.select("product_id", "list_price")
    quantity = F.col("l_quantity").cast("int")
    return (li.join(p, li["l_partkey"] == p["product_id"])
            .select(F.col("l_orderkey").alias("opportunity_id"), F.col("l_linenumber").alias("line_number"),
                    "product_id", quantity.alias("quantity"),
                    value_opportunity(F.col("list_price"), quantity).alias("expected_revenue")))


def _pick_customers(star: Star) -> DataFrame:
    """Ungrouped B8: one customer picked for every order."""
    orders = star.t("orders").select(F.col("o_orderkey").alias("opportunity_id"))
    drawn = orders.withColumn("_draw", key_draw("opportunity_id", CUSTOMER))
    return (kth_pick(drawn, "_draw", F.lit(star.customers.count()), star.customers, "customer_id", "picked_customer_id")
            .select("opportunity_id", "picked_customer_id"))


def _scratch(star: Star, name: str) -> str:
    return f"{shared_scratch(star.spark)}/quotalake-{name}-{uuid.uuid4().hex}"


def _merge_targets(star: Star) -> DataFrame:
    """B3's UPDATE ... FROM on stored targets: rep-months of the last year that beat their target get a new one."""
    table = SnapshotTable(star.spark, _scratch(star, "targets"))
    table.replace(star.targets.select("salesperson_id", "year", "month", "monthly_target"), ["year"])
    table.merge(beaten_targets(star.targets, star.monthly_actuals, star.calendar_range[1].year),
                ["salesperson_id", "year", "month"])
    return table.read()


def _territory_with_fallback(star: Star) -> DataFrame:
    """B9 with reps in part of the nations only, so that the others' opportunities take the fallback."""
    config = replace(star.config, territory_nations="n_nationkey % 5 <> 4")
    return _without_cents(Star(star.spark, star.source, config).pipeline)


class _EditedOrders:
    """A source whose orders are those of an earlier time."""

    def __init__(self, inner, edit: Callable[[DataFrame], DataFrame]):
        self.inner, self.edit = inner, edit

    def table(self, name: str) -> DataFrame:
        df = self.inner.table(name)
        return self.edit(df) if name == "orders" else df


def _kept(view: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """A view over kept totals that began with another state of the orders and folded in all that changed.

    At first the last half year's orders are not there, the orders of the 15th
    of each month come late, and those of the 16th stand under a day before the
    first one.  Three folds take in the late days, the changed ones and the new ones.
    """
    def run(star: Star) -> DataFrame:
        first, last = star.order_years
        new, ghost = dt.date(last, 2, 1), dt.date(first - 1, 12, 31)
        day = F.dayofmonth("o_orderdate")
        stored = star.t("orders").schema["o_orderdate"].dataType
        before = _EditedOrders(star.source, lambda orders: orders.where(
            (F.to_date("o_orderdate") < F.lit(new)) & (day != 15)).withColumn(
            "o_orderdate", F.when(day == 16, F.lit(ghost).cast(stored)).otherwise(F.col("o_orderdate"))))
        kept = KeptTotals(star.spark, _scratch(star, "kept"), "year").load(Star(star.spark, before, star.config))
        days = [ghost + dt.timedelta(i) for i in range((dt.date(last, 12, 31) - ghost).days + 1)]
        kept.fold(star, [d for d in days if d.day == 15 and d < new])
        kept.fold(star, [ghost, *[d for d in days if d.day == 16 and d < new]])
        kept.fold(star, [d for d in days if d >= new])
        return view(KeptStar(star, kept))
    return run


def _yearly(view: Callable[[YearlyStar], DataFrame]) -> Callable[[Star], DataFrame]:
    """A view over sales stored by year."""
    return lambda star: view(YearlyStar(star, _scratch(star, "yearly")).load())


def _reloaded(star: Star) -> DataFrame:
    """V5 over sales by year that were first stored without the last year and with half the one before it."""
    last = star.order_years[1]
    day = F.to_date("o_orderdate")
    before = Star(star.spark, _EditedOrders(star.source, lambda orders: orders.where(day < F.lit(dt.date(last - 1, 7, 1)))),
                  star.config)
    path = _scratch(star, "yearly")
    YearlyStar(before, path).load()
    return reports.vw_actual_vs_target(YearlyStar(star, path).reload([last - 1, last]))


def _load_audit(star: Star) -> DataFrame:
    """D3 and D4, counted by the writes of the star."""
    return materialize_audited(star)[1]


QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    # reports and their views
    "overall_performance": reports.overall_performance,
    "revenue_by_month": reports.revenue_by_month,
    "vw_revenue_by_month": reports.vw_revenue_by_month,
    "revenue_by_state": reports.revenue_by_state,
    "vw_revenue_by_state": reports.vw_revenue_by_state,
    "revenue_by_product": reports.revenue_by_product,
    "vw_revenue_by_product": reports.vw_revenue_by_product,
    "salesperson_performance": reports.salesperson_performance,
    "vw_salesperson_performance": reports.vw_salesperson_performance,
    "actual_vs_target": reports.actual_vs_target,
    "vw_actual_vs_target": reports.vw_actual_vs_target,
    "top_customers": reports.top_customers,
    "vw_top_customers": reports.vw_top_customers,
    "pipeline_by_stage": reports.pipeline_by_stage,
    "vw_pipeline_by_stage": reports.vw_pipeline_by_stage,
    "win_rate_overall": reports.win_rate_overall,
    "win_rate_by_salesperson": reports.win_rate_by_salesperson,
    "vw_win_rate_by_salesperson": reports.vw_win_rate_by_salesperson,
    "state_variance": reports.state_variance,
    "vw_underperforming_states": reports.vw_underperforming_states,
    "target_miss_rate": reports.target_miss_rate,
    "vw_target_miss_rate": reports.vw_target_miss_rate,
    # data-building operators
    "build_calendar": lambda star: star.calendar,
    "build_products": lambda star: _without_cents(star.products),
    "build_customers": lambda star: star.customers,
    "price_sales": lambda star: _without_cents(star.sales),
    "rescale_targets": lambda star: _without_cents(star.salespeople),
    "build_targets": lambda star: _without_cents(star.targets),
    "target_validation": lambda star: target_validation(
        star.salespeople, star.rep_revenue, star.target_years),
    "assign_territory": lambda star: _without_cents(star.pipeline),
    "value_opportunity": _value_opportunities,
    "pick_customer": _pick_customers,
    # integrity audits
    "audit_unique": audits.audit_unique,
    "audit_fk": audits.audit_fk,
    "audit_check": audits.audit_check,
    "audit_not_null": audits.audit_not_null,
    "audit_unique_integral": audits.audit_unique_integral,
    "audit_load": _load_audit,
    # stored tables: merge, fallback, views kept by increments
    "merge_targets": _merge_targets,
    "assign_territory_fallback": _territory_with_fallback,
    "kept_revenue_by_state": _kept(reports.vw_revenue_by_state),
    "kept_target_miss_rate": _kept(reports.vw_target_miss_rate),
    "kept_pipeline_by_stage": _kept(reports.vw_pipeline_by_stage),
    # sales stored by year: pruned reports, reload of some years
    "yearly_revenue_by_month": _yearly(lambda star: reports.revenue_by_month_of(star, f"FY{star.order_years[1]}")),
    "yearly_target_miss_rate": _yearly(lambda star: reports.vw_target_miss_rate(star, star.order_years[1] - 2)),
    "yearly_actual_vs_target": _reloaded,
}


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Comparison form: DECIMAL -> DOUBLE, DATE -> 'yyyy-MM-dd' text (same on the SQL side)."""
    def conv(f):
        if isinstance(f.dataType, DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)
    return df.select(*[conv(f) for f in df.schema.fields])


def driver_queries(config: StarConfig | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return decimals_to_double(fn(Star.from_parquet(spark, sf_dir, config)))
        return run
    return {name: make(fn) for name, fn in QUERIES.items()}
