"""The star over tables that already have its schema.

For holders of ``customers``, ``products``, ``salespeople``, ``sales``,
``pipeline``, ``targets`` and ``calendar`` tables: the reports, views, rescale
and audits read them as stored.  Stored targets are used as they are, so an
edited target has its effect; ``hire_date`` is carried into the salesperson
report.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.functions.exact import money_cents, to_money
from quotalake.functions.text import full_name
from quotalake.sources.star import Star, StarConfig
from quotalake.sources.tables import ParquetTables

# The names of the stored tables (``customer_master`` may be missing).
TABLES = ("customers", "products", "salespeople", "sales", "pipeline", "targets", "calendar")
_SALES_MONEY = ("unit_price", "revenue", "cost", "profit")


class NativeStar(Star):
    """Star frames read from a table source (``table(name)``) with the star's own tables."""

    @classmethod
    def from_parquet(cls, spark, base_dir: str, config: StarConfig | None = None,
                     spread: int | None = None) -> "NativeStar":
        if spread:
            raise ValueError("stored tables are read as they are")
        return cls(spark, ParquetTables(spark, base_dir), config)

    @classmethod
    def from_frames(cls, spark, frames: dict[str, DataFrame], config: StarConfig | None = None) -> "NativeStar":
        """Star over given DataFrames by table name."""
        return cls(spark, _Frames(frames), config)

    @cached_property
    def customers(self) -> DataFrame:
        return self.t("customers")

    @cached_property
    def products(self) -> DataFrame:
        return (self.t("products").withColumn("list_cents", money_cents(to_money(F.col("list_price"))))
                .withColumn("cost_cents", money_cents(to_money(F.col("standard_cost")))))

    @cached_property
    def salespeople_opening(self) -> DataFrame:
        return self.t("salespeople")

    @cached_property
    def sales(self) -> DataFrame:
        return self.t("sales").withColumns(
            {f"{c}_cents": money_cents(to_money(F.col(c))) for c in _SALES_MONEY})

    @cached_property
    def sales_lines(self) -> DataFrame:
        return self.sales

    @cached_property
    def pipeline(self) -> DataFrame:
        return self.t("pipeline").withColumn("expected_revenue_cents", money_cents(to_money(F.col("expected_revenue"))))

    @property
    def opportunities(self) -> DataFrame:
        return self.pipeline

    @property
    def opportunities_with_rep(self) -> DataFrame:
        return self.pipeline

    @cached_property
    def calendar(self) -> DataFrame:
        return self.t("calendar")

    @property
    def calendar_rows(self) -> int | None:
        """Not known of a stored table."""
        return None

    @cached_property
    def targets(self) -> DataFrame:
        return self.t("targets").withColumn("target_cents", money_cents(to_money(F.col("monthly_target"))))

    def target_rows(self, from_year: int | None = None) -> DataFrame:
        reps = self.salespeople_opening.select(
            "salesperson_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))
        rows = self.targets if from_year is None else self.targets.where(F.col("year") >= F.lit(from_year))
        return rows.join(reps, "salesperson_id").select(
            "salesperson_id", "full_name", "year", "month", "target_cents", "monthly_target")

    @cached_property
    def order_years(self) -> tuple[int, int]:
        """First and last year of the sale dates (one aggregate job)."""
        row = self.sales.agg(F.min("sale_date").alias("lo"), F.max("sale_date").alias("hi")).first()
        if row is None or row["lo"] is None:
            raise ValueError("sales has no dates; set target_years and miss_from_year explicitly")
        return row["lo"].year, row["hi"].year

    more_foreign_keys = ()

    @cached_property
    def audit_frames(self) -> dict[str, DataFrame]:
        frames = {"customers_source": self.customers, "customers_lookup": self.customers,
                  "salespeople_source": self.salespeople_opening, "salespeople_lookup": self.salespeople_opening,
                  "salespeople": self.salespeople_opening, "sales_source": self.sales,
                  "sales_order_source": self.sales, "target_keys": self.targets}
        master = self.optional("customer_master")
        return frames if master is None else frames | {"customer_master": master}

    def optional(self, name: str) -> DataFrame | None:
        """A table that need not be there."""
        try:
            return self.t(name)
        except (KeyError, AnalysisException):
            return None

    @property
    def stored_frames(self) -> dict[str, DataFrame]:
        frames = {name: self.t(name) for name in TABLES}
        master = self.optional("customer_master")
        return frames if master is None else frames | {"customer_master": master}

    def materialize(self, path: str | None = None, partitions: int | None = None):
        raise TypeError("the tables are stored already")


class _Frames:
    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    def table(self, name: str) -> DataFrame:
        return self.frames[name]
