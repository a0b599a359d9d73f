"""The star's tables and the ten views as objects of the session's catalog, with SQL text.

``CatalogStar.create`` writes the tables of ``sql_tables.reference_tables`` as
Parquet folders and names each by a catalog view over its folder; ``vw_*`` are
views over these names.  Other sessions of the catalog read both by name, and
a view follows its tables, since it is stored as text and planned on each read.

``replace`` swaps the rows of one table: they are written to a fresh folder first,
then its name is pointed there.  (A catalog *table* moved to another location
would not do: sessions that have read it keep the old files in their relation
cache.)  A write that fails leaves the old rows; a table may be replaced from
itself; columns must be the same, so no view breaks.  The old folder stays for
its readers until ``drop_old``.

Ratios are rounded by the same exact integer recipe as the DataFrame reports, so
views and reports give equal numbers.  The catalog is whatever the session has
configured (with none, Spark's in-memory catalog, which sessions of one application
share).  The start of the miss rate is written into its view when it is created.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quotalake.operators.reports import TIER_HIGH, TIER_LOW, TIER_MEDIUM
from quotalake.plans.sql_tables import reference_tables
from quotalake.sources.star import Star

_INT = "DECIMAL(38,0)"


def _cents(total: str) -> str:
    return f"CAST({total} * 100 AS {_INT})"


def _half_up(a: str, b: str) -> str:
    """ROUND(a / b), half away from zero, of two integral expressions; NULL where b is 0."""
    a, b = f"CAST({a} AS {_INT})", f"NULLIF(CAST({b} AS {_INT}), CAST(0 AS {_INT}))"
    rest = f"(ABS({a}) % ABS({b}))"
    return (f"CAST(CASE WHEN ({a} < 0) != ({b} < 0) THEN -1 ELSE 1 END * (CAST((ABS({a}) - {rest}) / ABS({b}) AS {_INT})"
            f" + CASE WHEN {rest} * 2 >= ABS({b}) THEN 1 ELSE 0 END) AS {_INT})")


def _ratio(a: str, b: str, digits: int) -> str:
    """ROUND(a / b, digits) of two integral expressions in one unit."""
    return f"CAST({_half_up(f'{a} * {10 ** digits}', b)} * 1E-{digits}BD AS DECIMAL(38,{digits}))"


def _mean_money(total: str, n: str) -> str:
    return f"CAST({_half_up(_cents(total), n)} * 0.01BD AS DECIMAL(38,2))"


_MARGIN = _ratio(f"100 * {_cents('total_profit')}", _cents("total_revenue"), 2)
_NAME = "(r.first_name || ' ' || r.last_name)"
#: a letter or digit after anything else starts a word
_TITLE = (f"array_join(transform(regexp_extract_all({_NAME}, '[\\\\p{{L}}\\\\p{{N}}]+|[^\\\\p{{L}}\\\\p{{N}}]+', 0), "
          f"x -> upper(left(x, 1)) || lower(substr(x, 2))), '')")
_TOTALS = "SUM(revenue) AS total_revenue, SUM(profit) AS total_profit, COUNT(*) AS n"


def view_sql(db: str, tier_high: int, tier_medium: int, from_year: int, hire_date: bool) -> dict[str, str]:
    """View name -> query text over the tables of ``db``."""
    by_state = (f"SELECT c.state, SUM(s.total_revenue) AS total_revenue, SUM(s.total_profit) AS total_profit, SUM(s.n) AS n "
                f"FROM (SELECT customer_id, {_TOTALS} FROM {db}.sales GROUP BY customer_id) s "
                f"JOIN {db}.customers c ON c.customer_id = s.customer_id GROUP BY c.state")
    months = (f"SELECT t.salesperson_id, {_NAME} AS full_name, t.year, t.month, t.monthly_target, "
              f"COALESCE(a.actual, 0) AS actual_revenue FROM {db}.targets t "
              f"JOIN {db}.salespeople r ON r.salesperson_id = t.salesperson_id "
              f"LEFT JOIN (SELECT salesperson_id, year(sale_date) AS y, month(sale_date) AS m, SUM(revenue) AS actual "
              f"FROM {db}.sales GROUP BY salesperson_id, year(sale_date), month(sale_date)) a "
              f"ON a.salesperson_id = t.salesperson_id AND a.y = t.year AND a.m = t.month")
    hired = "r.hire_date, " if hire_date else ""
    return {
        "vw_revenue_by_month":
            f"SELECT d.year, d.month, d.month_name, SUM(s.revenue) AS total_revenue FROM "
            f"(SELECT sale_date, SUM(revenue) AS revenue FROM {db}.sales GROUP BY sale_date) s "
            f"JOIN {db}.calendar d ON d.date = s.sale_date GROUP BY d.year, d.month, d.month_name",
        "vw_revenue_by_state":
            f"SELECT state, total_revenue, total_profit, {_MARGIN} AS margin_pct, n AS sales_count FROM ({by_state})",
        "vw_revenue_by_product":
            f"SELECT p.product_id, p.product_name, s.total_revenue, s.total_profit, s.n AS sales_count, "
            f"{_mean_money('s.total_revenue', 's.n')} AS avg_revenue, {_mean_money('s.total_profit', 's.n')} AS avg_profit, "
            f"CASE WHEN s.total_profit >= {tier_high} * s.n THEN '{TIER_HIGH}' "
            f"WHEN s.total_profit >= {tier_medium} * s.n THEN '{TIER_MEDIUM}' ELSE '{TIER_LOW}' END AS profit_tier "
            f"FROM (SELECT product_id, {_TOTALS} FROM {db}.sales GROUP BY product_id) s "
            f"JOIN {db}.products p ON p.product_id = s.product_id",
        "vw_salesperson_performance":
            f"SELECT r.salesperson_id, {_TITLE} AS full_name, {hired}s.total_revenue, s.total_profit, "
            f"{_mean_money('s.total_revenue', 's.n')} AS avg_deal_size, s.n AS sales_count "
            f"FROM (SELECT salesperson_id, {_TOTALS} FROM {db}.sales GROUP BY salesperson_id) s "
            f"JOIN {db}.salespeople r ON r.salesperson_id = s.salesperson_id",
        "vw_actual_vs_target":
            f"SELECT salesperson_id, full_name, year, month, monthly_target, actual_revenue, "
            f"actual_revenue - monthly_target AS variance, "
            f"{_ratio('100 * ' + _cents('actual_revenue'), _cents('monthly_target'), 1)} AS pct_of_target FROM ({months})",
        "vw_top_customers":
            f"SELECT c.customer_id, c.company_name, c.industry, c.state, s.total_revenue, s.total_profit, "
            f"s.n AS num_purchases FROM (SELECT customer_id, {_TOTALS} FROM {db}.sales GROUP BY customer_id) s "
            f"JOIN {db}.customers c ON c.customer_id = s.customer_id",
        "vw_pipeline_by_stage":
            f"SELECT stage, SUM(n) AS num_deals, SUM(expected) AS total_expected_revenue, CAST("
            f"{_half_up(f'SUM({_cents('expected')} * CAST(probability * 100 AS {_INT}))', '10000')}"
            f" * 0.01BD AS DECIMAL(38,2)) AS weighted_pipeline_value "
            f"FROM (SELECT stage, probability, COUNT(*) AS n, SUM(expected_revenue) AS expected FROM {db}.pipeline "
            f"GROUP BY stage, probability) GROUP BY stage",
        "vw_win_rate_by_salesperson":
            f"SELECT r.salesperson_id, {_NAME} AS full_name, o.won AS deals_won, o.closed AS total_closed, "
            f"{_ratio('100 * o.won', 'o.closed', 1)} AS win_rate_pct FROM (SELECT salesperson_id, "
            f"COUNT(*) FILTER (WHERE stage = 'Closed Won') AS won, "
            f"COUNT(*) FILTER (WHERE stage IN ('Closed Won', 'Closed Lost')) AS closed "
            f"FROM {db}.pipeline GROUP BY salesperson_id) o JOIN {db}.salespeople r ON r.salesperson_id = o.salesperson_id",
        "vw_underperforming_states":
            f"SELECT state, total_revenue, {_mean_money('whole', 'k')} AS company_avg_revenue, "
            f"{_mean_money('(k * total_revenue - whole)', 'k')} AS variance_from_avg "
            f"FROM (SELECT state, total_revenue, SUM(total_revenue) OVER () AS whole, COUNT(*) OVER () AS k FROM ({by_state}))",
        "vw_target_miss_rate":
            f"SELECT salesperson_id, full_name, missed AS months_missed, months AS total_months, "
            f"{_ratio('100 * missed', 'months', 1)} AS pct_months_missed FROM (SELECT salesperson_id, full_name, "
            f"COUNT(month) FILTER (WHERE actual_revenue < monthly_target) AS missed, COUNT(month) AS months "
            f"FROM ({months}) WHERE year >= {from_year} GROUP BY salesperson_id, full_name)",
    }


class CatalogStar:
    """The tables and views of one database of the session's catalog."""

    def __init__(self, spark: SparkSession, database: str, base: str):
        self.spark, self.database, self.base = spark, database, base.rstrip("/")

    @classmethod
    def create(cls, star: Star, database: str, base: str) -> "CatalogStar":
        """Write ``star``'s tables below ``base`` and create the database's tables and views."""
        made = cls(star.spark, database, base)
        made.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, df in reference_tables(star).items():
            made._point(name, made._write(name, df))
        views = view_sql(database, star.config.tier_high, star.config.tier_medium, star.miss_from_year,
                         "hire_date" in star.salespeople_opening.columns)
        for name, text in views.items():
            made.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
        return made

    def _write(self, name: str, df: DataFrame) -> str:
        folder = f"{self.base}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def _point(self, name: str, folder: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} TBLPROPERTIES ('folder' = '{folder}') "
                       f"AS SELECT * FROM parquet.`{folder}`")

    def folder(self, name: str) -> str:
        """The folder that holds a table's rows now."""
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.database}.{name} ('folder')").first()["value"]

    def replace(self, name: str, rows: DataFrame) -> str:
        """Give a table new rows; returns the folder that held the old ones."""
        declared = self.spark.table(f"{self.database}.{name}").schema
        if [(f.name, f.dataType) for f in rows.schema] != [(f.name, f.dataType) for f in declared]:
            raise ValueError(f"{name}: columns must stay {declared.simpleString()}")
        old = self.folder(name)
        self._point(name, self._write(name, rows))
        return old

    def drop_old(self, folder: str) -> None:
        """Delete a folder that ``replace`` returned; one that a table still uses is refused."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        name = path.getParent().getName()
        if folder == self.folder(name):
            raise ValueError(f"{folder} holds the rows of {name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
