"""Data-building operators (B1-B7, B11, B12): calendar, pricing, targets, stages.

Each is a narrow column expression or a small aggregate; none needs a
nested-loop or cross join.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotalake.functions.calendar_fns import financial_year, iso_week, month_name
from quotalake.functions.draws import weighted_choice
from quotalake.functions.exact import (
    as_int,
    half_up_long,
    half_up_quotient,
    money_cents,
    money_from_cents,
    round_ratio,
    to_money,
)

# Opportunity stages in funnel order, their win probability (%)
# and their share of opportunities (per mille).
STAGES = ("Prospecting", "Qualification", "Proposal", "Negotiation", "Closed Won", "Closed Lost")
STAGE_PROBABILITY = (10, 25, 50, 75, 100, 0)
STAGE_WEIGHTS = (300, 250, 200, 150, 60, 40)
CLOSED_WON = "Closed Won"
CLOSED_LOST = "Closed Lost"

# Customer size split (per mille).
CUSTOMER_SIZES = ("Small", "Medium", "Large", "Enterprise")
CUSTOMER_SIZE_WEIGHTS = (400, 300, 200, 100)


# --- B1 -------------------------------------------------------------------

def build_calendar(spark: SparkSession, start: dt.date, end: dt.date,
                   num_partitions: int | None = None) -> DataFrame:
    """One row per day in [start, end] with its date attributes.

    Generated with ``spark.range`` (no driver-side list); the row count is
    ``(end - start).days + 1``, known before any job runs, which is what makes
    broadcasting it safe.
    """
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError("calendar end must not precede its start")
    ids = spark.range(0, days, 1, num_partitions) if num_partitions else spark.range(0, days)
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return ids.select(d.alias("date")).select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        month_name(F.col("date")).alias("month_name"),
        iso_week(F.col("date")).alias("week"),
        F.dayofmonth("date").alias("day"),
        financial_year(F.col("date")).alias("financial_year"),
    )


def calendar_rows(start: dt.date, end: dt.date) -> int:
    return (end - start).days + 1


# --- B5 -------------------------------------------------------------------

def price_sales(list_cents: Column, cost_cents: Column, quantity: Column,
                discount_hundredths: Column) -> dict[str, Column]:
    """Unit price, revenue, cost and profit in BIGINT cents, each rounded once.

    Inputs: list price and standard cost in cents, quantity, and the discount
    in hundredths of a percent (NULL counts as 0, the column default).
    ``gross = list * (10000 - discount) * quantity`` is the exact revenue in
    units of 10^-4 cent; revenue is ``round(gross / 10^4)``, so revenue is
    generally not unit_price * quantity.
    """
    keep = F.lit(10000) - F.coalesce(discount_hundredths, F.lit(0)).cast("long")
    qty = quantity.cast("long")
    gross = list_cents * keep * qty
    cost = cost_cents * qty
    return {
        "unit_price_cents": half_up_long(list_cents * keep, 10000),
        "revenue_cents": half_up_long(gross, 10000),
        "cost_cents": cost,
        "profit_cents": half_up_long(gross - cost * F.lit(10000), 10000),
    }


# --- B11 ------------------------------------------------------------------

def value_opportunity(list_price: Column, quantity: Column) -> Column:
    """Undiscounted opportunity value round(list_price * quantity, 2)."""
    return to_money(F.round(list_price * quantity, 2))


# --- B7 -------------------------------------------------------------------

def stage_and_probability(draw: Column) -> tuple[Column, Column]:
    """Stage and probability from one draw, so the two can never disagree."""
    stage = weighted_choice(draw, STAGE_WEIGHTS, STAGES)
    prob = weighted_choice(draw, STAGE_WEIGHTS, STAGE_PROBABILITY).cast("decimal(5,2)")
    return stage, prob


def customer_size(draw: Column) -> Column:
    """B6 on the customer key: Small/Medium/Large/Enterprise by weight."""
    return weighted_choice(draw, CUSTOMER_SIZE_WEIGHTS, CUSTOMER_SIZES)


# --- B3 / B2 / B4 -----------------------------------------------------------

def rescale_targets(salespeople: DataFrame, per_rep: DataFrame, years: int,
                    share_pct: int = 90) -> DataFrame:
    """annual_target = round(sum(revenue) / years * share, 2) per rep with sales.

    ``per_rep`` holds (salesperson_id, revenue_cents).  Reps without sales keep
    their previous ``annual_target`` (UPDATE ... FROM semantics: a left join
    plus COALESCE).  Only one row per rep crosses the join.  Adds
    ``annual_cents`` next to the DECIMAL ``annual_target``.
    """
    new_cents = half_up_quotient(as_int(F.col("revenue_cents")) * F.lit(share_pct),
                                 F.lit(years * 100)).cast("long")
    return (salespeople.join(per_rep.select("salesperson_id", new_cents.alias("_new")),
                             "salesperson_id", "left")
            .withColumn("annual_cents", F.coalesce(F.col("_new"), money_cents(F.col("annual_target"))))
            .withColumn("annual_target", money_from_cents(F.col("annual_cents"), 14))
            .drop("_new"))


def monthly_target_cents(annual_cents: Column) -> Column:
    """round(annual / 12, 2) exactly, in cents."""
    return half_up_long(annual_cents, 12)


def build_targets(salespeople: DataFrame, start: dt.date, end: dt.date,
                  carry: list[str] | None = None) -> DataFrame:
    """B2: one target row per rep and calendar month in [start, end].

    The months of a calendar that covers every day of the range are exactly
    the months of the range, so each rep row is expanded with a generator
    (``explode(sequence(...))``) -- a narrow operation, no join or shuffle.
    ``carry`` lists rep columns (e.g. the name) to keep on every target row.
    Needs ``annual_cents`` on the rep rows.
    """
    first = dt.date(start.year, start.month, 1)
    last = dt.date(end.year, end.month, 1)
    months = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH")))
    carry = list(carry or [])
    return (salespeople.select("salesperson_id", *carry, "annual_cents", months.alias("_m"))
            .select("salesperson_id", *carry,
                    F.year("_m").alias("year"),
                    F.month("_m").alias("month"),
                    monthly_target_cents(F.col("annual_cents")).alias("target_cents"))
            .withColumn("monthly_target", money_from_cents(F.col("target_cents"), 14)))


def beaten_targets(targets: DataFrame, actuals: DataFrame, year: int) -> DataFrame:
    """Changes for a merge: a rep-month of ``year`` that beat its target gets its actual as the new one."""
    met = targets.where(F.col("year") == year).join(
        actuals.where(F.col("year") == year), ["salesperson_id", "year", "month"])
    return (met.where(F.col("actual_cents") > F.col("target_cents"))
            .select("salesperson_id", "year", "month", money_from_cents(F.col("actual_cents"), 14).alias("monthly_target")))


def target_validation(salespeople: DataFrame, per_rep: DataFrame, years: int) -> DataFrame:
    """Per rep with sales, annual and monthly target against mean monthly revenue.

    ``avg_actual_monthly_revenue`` is sum(revenue) / (12 * years), given to 6
    decimals (half away from zero).
    """
    months = 12 * years
    return (salespeople.select("salesperson_id", "annual_target", "annual_cents")
            .join(per_rep, "salesperson_id", "inner")
            .select("salesperson_id", "annual_target",
                    money_from_cents(monthly_target_cents(F.col("annual_cents")), 14).alias("monthly_target"),
                    round_ratio(F.col("revenue_cents"), F.lit(months * 100), 6, precision=24)
                    .alias("avg_actual_monthly_revenue")))


# --- B12 ------------------------------------------------------------------

def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """TRUNCATE + INSERT of a plain Parquet folder, which ``df`` may read.

    The new rows go to a folder beside ``path`` and take its place by renaming
    when all are written: a write that fails leaves the old rows where they are.
    Between the two renames there is no ``path``; readers that must never meet
    that, and stores whose renames copy, want ``snapshots.SnapshotTable``.
    """
    sc = df.sparkSession.sparkContext
    name, tag = path.rstrip("/"), uuid.uuid4().hex
    target, staged, old = (sc._jvm.org.apache.hadoop.fs.Path(p) for p in (name, f"{name}.new-{tag}", f"{name}.old-{tag}"))
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    try:
        df.write.partitionBy(*(partition_by or [])).parquet(staged.toString())
        if fs.exists(target) and not fs.rename(target, old):
            raise OSError(f"{name} cannot be renamed")
        if not fs.rename(staged, target):
            fs.rename(old, target)
            raise OSError(f"{name} cannot be replaced")
    finally:
        fs.delete(staged, True)
    fs.delete(old, True)
    return path
