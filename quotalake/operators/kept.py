"""The views V1-V10 as kept aggregates, maintained per day (08: "pre-aggregated").

A view is a short roll-up over totals that merge by addition: cents and counts
per customer, product or rep and day of sale, and opportunities and expected
cents per rep, stage, probability and closing day.  ``KeptTotals`` keeps these in
one versioned table, partitioned by grain and period (month or year).  ``fold``
takes in a set of days: it aggregates these days' facts and writes the periods that
hold them again, the other days' rows copied.  The days may be new ones, days for which rows came
late, and days whose rows went: what a day had before is replaced, never added to.
All grains switch together with the table's pointer, so views never mix states,
and a fold that fails leaves the earlier state; folding the same days twice is
folding them once.

``KeptStar`` gives every report and view the kept totals instead of the facts.
Rows without a date are the day NULL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalake.functions.exact import sum_cents
from quotalake.operators import build
from quotalake.sources.snapshots import SnapshotTable
from quotalake.sources.star import Star, rolled_up, totals_by

#: Key columns of the grains of sales.
SALES_GRAINS = ("customer_id", "product_id", "salesperson_id")
DEALS = "deals"
PERIODS = {"month": lambda day: F.year(day) * 100 + F.month(day), "year": F.year}
_COLUMNS = ("grain", "period", "day", "key", "stage", "probability", "amount", "profit", "n")

Days = Iterable[dt.date | None]


def _on(day: Column, days: Days) -> Column:
    dates = sorted({d for d in days if d is not None})
    found = day.isin(dates) if dates else F.lit(False)
    return F.coalesce(found, F.lit(False)) | day.isNull() if None in set(days) else F.coalesce(found, F.lit(False))


def daily_totals(star: Star, days: Days | None = None, period: str = "month") -> DataFrame:
    """All grains of the facts of ``days`` (of all days if None)."""
    part = PERIODS[period]
    days = None if days is None else list(days)
    deals = star.opportunities_with_rep
    if days is None:
        sales = star.sales
    else:
        sales = star.sales_on(_on(F.col("sale_date"), days))
        deals = deals.where(_on(F.col("expected_close_date"), days))
    no = F.lit(None)
    # one pass over the priced sales, whose joins cost more than three rows for each
    grains = F.explode(F.array(*[F.struct(F.lit(key).alias("grain"), F.col(key).cast("long").alias("key")) for key in SALES_GRAINS]))
    per_key = totals_by(sales.select(grains.alias("g"), "sale_date", "revenue_cents", "profit_cents")
                        .select("g.grain", "g.key", "sale_date", "revenue_cents", "profit_cents"), "grain", "key", "sale_date")
    per_key = per_key.select(
        "grain", part(F.col("sale_date")).alias("period"), F.col("sale_date").alias("day"), "key",
        no.cast("string").alias("stage"), no.cast("decimal(5,2)").alias("probability"), F.col("rev_c").alias("amount"),
        F.col("prof_c").alias("profit"), F.col("sales_count").alias("n"))
    per_deal = deals.groupBy("salesperson_id", "stage", "probability", "expected_close_date").agg(
        sum_cents(F.col("expected_revenue_cents")).alias("e_c"), F.count("opportunity_id").alias("n"))
    day = F.col("expected_close_date")
    per_stage = per_deal.select(
        F.lit(DEALS).alias("grain"), part(day).alias("period"), day.alias("day"),
        F.col("salesperson_id").cast("long").alias("key"), "stage", F.col("probability").cast("decimal(5,2)").alias("probability"),
        F.col("e_c").alias("amount"), no.cast(per_deal.schema["e_c"].dataType).alias("profit"), "n")
    return per_key.unionByName(per_stage).select(*_COLUMNS)


class KeptTotals:
    """The kept totals in the folder ``path``; ``period`` is what a fold writes again at least."""

    def __init__(self, spark, path: str, period: str = "month"):
        self.table = SnapshotTable(spark, path)
        self.period = period

    def load(self, star: Star) -> "KeptTotals":
        """Build the state from all facts."""
        # years are few, so that a task's files of each are not too small and another shuffle can be spared
        self.table.replace(daily_totals(star, period=self.period), ["grain", "period"], deal=self.period != "year")
        return self

    def fold(self, star: Star, days: Days) -> "KeptTotals":
        """Take in the facts of ``days`` as they are now; an unknown day without facts changes nothing."""
        days = list(days)
        if not days:
            return self
        base = self.table.version()
        periods = (self.table.spark.createDataFrame([(d,) for d in days], "day date")
                   .select(PERIODS[self.period](F.col("day")).alias("period")))
        grains = self.table.spark.createDataFrame([(g,) for g in (*SALES_GRAINS, DEALS)], "grain string")
        touched = self.table.partition_names(periods.distinct().crossJoin(grains))  # a few names, no rows
        others = self.table.read(base, touched).where(~_on(F.col("day"), days))
        # the copied rows come from files of their partitions: only the new ones are dealt out
        fresh = daily_totals(star, days, self.period).hint("rebalance", "grain", "period")
        self.table.rewrite(others.unionByName(fresh), touched, base, deal=False)
        return self

    def grain(self, name: str) -> DataFrame:
        return self.table.read().where(F.col("grain") == name)


class KeptStar(Star):
    """A star whose reports read kept totals; dimensions are those of ``star``."""

    def __init__(self, star: Star, kept: KeptTotals):
        super().__init__(star.spark, star.source, star.config)
        self.kept = kept
        for name in ("customers", "products", "salespeople_opening", "order_years"):
            self.__dict__[name] = getattr(star, name)

    def _sales(self, key: str) -> DataFrame:
        return self.kept.grain(key).select(F.col("key").alias(key), "day", F.col("amount").alias("rev_c"),
                                           F.col("profit").alias("prof_c"), F.col("n").alias("sales_count"))

    def sales_totals(self, key: str) -> DataFrame:
        if key == "sale_date":
            return rolled_up(self._sales("product_id").withColumnRenamed("day", "sale_date"), "sale_date")
        return rolled_up(self._sales(key), key)

    def grand_totals(self) -> DataFrame:
        return rolled_up(self._sales("product_id"))

    @cached_property
    def rep_months(self) -> DataFrame:
        dated = self._sales("salesperson_id").select(
            "salesperson_id", F.coalesce(F.year("day"), F.lit(0)).alias("year"),
            F.coalesce(F.month("day"), F.lit(0)).alias("month"), "rev_c", "prof_c", "sales_count")
        return rolled_up(dated, "salesperson_id", "year", "month")

    def _deals(self) -> DataFrame:
        return self.kept.grain(DEALS).select(F.col("key").alias("salesperson_id"), "stage", "probability", "amount", "n")

    def stage_values(self) -> DataFrame:
        return self._deals().groupBy("stage", "probability").agg(F.sum("n").alias("n"), F.sum("amount").alias("e_c"))

    def deal_counts(self, *keys: str) -> DataFrame:
        def count(*stages: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("stage").isin(*stages), F.col("n"))), F.lit(0))

        return self._deals().groupBy(*keys).agg(
            count(build.CLOSED_WON).alias("deals_won"), count(build.CLOSED_LOST).alias("deals_lost"),
            count(build.CLOSED_WON, build.CLOSED_LOST).alias("total_closed"))
