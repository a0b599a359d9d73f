"""Sales stored by calendar year, so that a report on some years reads these years.

``YearlyStar`` keeps three versioned tables (``snapshots.SnapshotTable``):

    sales        the priced fact, partitioned by ``sale_year``
    rep_months   totals per rep and month, partitioned by ``year``
    salespeople  reps with the rescaled annual target (B3), as the reference stores it

A bound on the year is a partition filter that Spark settles before any file is
opened.  A join to the calendar on (year, date) prunes at run time: the years of
the calendar rows that a condition leaves decide which partitions are read
(dynamic partition pruning, by the broadcast calendar itself).  As the rescaled
target is stored, the miss rate since a year reads the rep-months since then
instead of all.

``reload`` takes in years whose source rows changed: their sales are priced
again and only their partitions written; all other years keep their files.  It
gives the same tables when run again, so a reload that failed between two tables
is mended by another.  Each task that prices sales writes a file for every year
it has, without another shuffle of the fact, so a year that holds most rows is
many files of many tasks.

Sales without a date are in the partition of no year (NULL), and in year 0 of
the rep-months, as in ``rep_months_of``.
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
from quotalake.sources.star import SALES_CENTS, Star, rep_months_of, with_money_columns

Years = Iterable[int | None]


def in_years(day: Column, years: Years) -> Column:
    """Whether a date lies in one of the years, as ranges that a scan can use; None: there is no date."""
    years = set(years)
    found = F.lit(False)
    for year in sorted(y for y in years if y is not None):
        found = found | ((day >= F.lit(dt.date(year, 1, 1))) & (day <= F.lit(dt.date(year, 12, 31))))
    found = F.coalesce(found, F.lit(False))
    return found | day.isNull() if None in years else found


class YearlyStar(Star):
    """A star with its sales stored by year under ``path``; dimensions and pipeline are those of ``star``."""

    def __init__(self, star: Star, path: str):
        super().__init__(star.spark, star.source, star.config)
        self.star = star
        base = path.rstrip("/")
        self.sales_table, self.months_table, self.reps_table = (
            SnapshotTable(star.spark, f"{base}/{name}") for name in ("sales", "rep_months", "salespeople"))
        for name in ("customers", "products", "salespeople_opening", "order_years"):
            self.__dict__[name] = getattr(star, name)

    # --- writing ---------------------------------------------------------------

    def _priced(self, years: Years | None = None) -> DataFrame:
        sales = self.star.sales if years is None else self.star.sales_on(in_years(F.col("sale_date"), years))
        return sales.select("order_id", "line_number", "customer_id", "salesperson_id", "product_id", "sale_date",
                            "quantity", "discount_percent", *SALES_CENTS, F.year("sale_date").alias("sale_year"))

    def _write_reps(self) -> None:
        totals = (self.months_table.read().groupBy("salesperson_id").agg(sum_cents(F.col("rev_c")).alias("revenue_cents")))
        self.reps_table.replace(build.rescale_targets(self.star.salespeople_opening, totals, self.target_years,
                                                      self.config.target_share_pct))

    def load(self) -> "YearlyStar":
        """Write all years."""
        self.sales_table.replace(self._priced(), ["sale_year"], deal=False)
        self.months_table.replace(rep_months_of(self.sales_table.read()), ["year"])
        self._write_reps()
        self._forget()
        return self

    def reload(self, years: Years) -> "YearlyStar":
        """Take in ``years`` as they are in the source now; a year without sales ends up empty."""
        years = sorted(set(years), key=lambda y: (y is None, y or 0))
        if not years:
            return self
        spark = self.spark
        touched = self.sales_table.partition_names(spark.createDataFrame([(y,) for y in years], "sale_year int"))
        self.sales_table.rewrite(self._priced(years), touched, deal=False)
        months = self.months_table.partition_names(spark.createDataFrame([(y or 0,) for y in years], "year int"))
        self.months_table.rewrite(rep_months_of(self.sales_table.read(partitions=touched)), months)
        self._write_reps()
        self._forget()
        return self

    def _forget(self) -> None:
        """Read the new versions from now on."""
        for name in ("sales", "sales_lines", "sales_by_year", "rep_months", "rep_revenue", "salespeople", "targets", "_totals"):
            self.__dict__.pop(name, None)

    # --- reading -----------------------------------------------------------------

    @cached_property
    def sales_by_year(self) -> DataFrame:
        """The stored sales with ``sale_year``, the column they are partitioned by."""
        return self.sales_table.read()

    @cached_property
    def sales(self) -> DataFrame:
        return with_money_columns(self.sales_by_year.drop("sale_year"))

    @cached_property
    def sales_lines(self) -> DataFrame:
        return self.sales

    @cached_property
    def rep_months(self) -> DataFrame:
        return self.months_table.read()

    def actuals_since(self, from_year: int | None) -> DataFrame:
        """Only the partitions since ``from_year``: the stored targets need no other ones."""
        months = self.monthly_actuals
        return months if from_year is None else months.where(F.col("year") >= from_year)

    @cached_property
    def salespeople(self) -> DataFrame:
        return self.reps_table.read()
