"""The star under the reference's table and column names, for plain SQL.

``register_tables(star)`` publishes ``customers``, ``products``,
``salespeople``, ``sales``, ``pipeline``, ``targets`` and ``calendar`` as temp
views with the reference's column names, so SQL against that schema (FILTER
clauses, INITCAP, EXTRACT, NULLIF, ``AVG() OVER ()``) runs in ``spark.sql`` on
the same lazy plans the DataFrame reports use.  One thing must be rewritten:
Spark wants every selected column that is not aggregated in the GROUP BY, also
where it depends on a grouped key.

Two columns have no source in the driver tables: ``sales.sale_id`` is a
deterministic row tag, a hash of order, line number and row; line items that
repeat in all of these share it, so ``COUNT(DISTINCT sale_id)`` misses such
repeats.  ``salespeople.hire_date`` / ``manager`` are NULL.  A ``NativeStar`` registers its
tables as they are stored, ``sale_id``, ``target_id``, ``city``, ``hire_date`` and
``customer_master`` included.  Reads of these views are
recomputed each time, like the reference's plain views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.sources.star import Star

_SALES_ROW = ("order_id", "line_number", "customer_id", "salesperson_id", "product_id", "sale_date", "quantity",
              "discount_percent", "revenue_cents", "cost_cents")


def reference_tables(star: Star) -> dict[str, DataFrame]:
    if star.stored_frames is not None:
        return star.stored_frames
    sales = star.sales
    return {
        "customers": star.customers.select("customer_id", "company_name", "industry", "state",
                                           "customer_size"),
        "products": star.products.select("product_id", "product_name", "category", "standard_cost",
                                         "list_price"),
        "salespeople": star.salespeople.select(
            "salesperson_id", "first_name", "last_name", "state", "region",
            F.lit(None).cast("string").alias("manager"), F.lit(None).cast("date").alias("hire_date"),
            "annual_target"),
        "sales": sales.select(
            F.xxhash64(*[F.col(c) for c in _SALES_ROW]).alias("sale_id"),
            "customer_id", "salesperson_id", "product_id", "sale_date", "quantity", "discount_percent",
            "unit_price", "revenue", "cost", "profit"),
        "pipeline": star.pipeline.select("opportunity_id", "customer_id", "salesperson_id", "product_id",
                                         "stage", "probability", "expected_close_date", "expected_revenue"),
        "targets": star.targets.select("salesperson_id", "year", "month", "monthly_target"),
        "calendar": star.calendar,
    }


def register_tables(star: Star, prefix: str = "") -> list[str]:
    """Register the star's tables as temp views named ``prefix + table``."""
    names = []
    for name, df in reference_tables(star).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
