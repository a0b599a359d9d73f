"""Sales stored by year: same reports, other years not opened, years reloaded alone."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from quotalake.operators import reports
from quotalake.sources.snapshots import SnapshotTable
from quotalake.sources.star import Star
from quotalake.sources.yearly import YearlyStar, in_years
from tests.conftest import SF_SMALL, star_with


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


class Edited:
    """The small tables with other orders."""

    def __init__(self, source, edit):
        self.source, self.edit = source, edit

    def table(self, name):
        df = self.source.table(name)
        return self.edit(df) if name == "orders" else df


@pytest.fixture(scope="module")
def star(spark):
    return Star.from_parquet(spark, SF_SMALL)


def spoil(path: str, keep) -> int:
    """Make the data files of the years that ``keep`` refuses unreadable; returns how many."""
    doomed = [f for f in glob.glob(f"{path}/_data/*/*/*.parquet") if not keep(int(f.split("year=")[1].split("/")[0]))]
    for f in doomed:
        with open(f, "wb") as out:
            out.write(b"not a file of this table")
    return len(doomed)


def test_all_reports_equal_those_of_the_plain_star(star, tmp_path):
    yearly = YearlyStar(star, str(tmp_path)).load()
    assert {p for p in yearly.sales_table.manifest()["parts"]} == {f"sale_year={y}" for y in range(1995, 2002)}
    of_pipeline = ("vw_pipeline_by_stage", "vw_win_rate_by_salesperson")  # not stored by year
    for name in set(reports.VIEWS) - set(of_pipeline):
        assert rows(reports.VIEWS[name](yearly)) == rows(reports.VIEWS[name](star)), name


def test_reports_on_some_years_open_no_other_years(star, tmp_path):
    yearly = YearlyStar(star, str(tmp_path)).load()
    calendar = star.calendar.where("financial_year = 'FY2000'").select("date", "year", "month", "month_name")
    months = (star.sales.join(calendar, F.col("sale_date") == F.col("date")).groupBy("year", "month", "month_name")
              .agg(F.sum("revenue").cast("decimal(26,2)").alias("total_revenue")))
    months, missed = rows(months), rows(reports.vw_target_miss_rate(star, 1999))
    assert len(months) == 12
    assert spoil(yearly.sales_table.path, lambda y: y in (1999, 2000)) >= 5
    assert spoil(yearly.months_table.path, lambda y: y >= 1999) >= 4
    again = YearlyStar(star, str(tmp_path))
    assert rows(reports.revenue_by_month_of(again, "FY2000")) == months
    assert rows(reports.vw_target_miss_rate(again, 1999)) == missed
    with pytest.raises(Exception):
        again.sales.agg(F.sum("revenue")).collect()


def test_reload_writes_the_changed_years_alone(spark, star, tmp_path):
    day = F.to_date("o_orderdate")
    before = Star(spark, Edited(star.source, lambda o: o.where((day < "2001-03-01") & (F.month(day) + F.year(day) * 12 != 1997 * 12 + 5))),
                  star.config)
    yearly = YearlyStar(before, str(tmp_path)).load()
    parts = yearly.sales_table.manifest()["parts"]
    now = YearlyStar(star, str(tmp_path)).reload([1997, 2001])
    after = now.sales_table.manifest()["parts"]
    assert {p for p in after if after[p] != parts[p]} == {"sale_year=1997", "sale_year=2001"}
    for view in (reports.vw_actual_vs_target, reports.vw_revenue_by_month, reports.vw_revenue_by_state):
        assert rows(view(now)) == rows(view(star))
    again = YearlyStar(star, str(tmp_path)).reload([1997])  # the same rows once more change nothing
    assert rows(reports.vw_actual_vs_target(again)) == rows(reports.vw_actual_vs_target(star))
    assert YearlyStar(star, str(tmp_path)).reload([]).sales_table.version() == 3


def test_years_that_go_and_sales_without_a_date(spark, star, tmp_path):
    undated = Star(spark, Edited(star.source, lambda o: o.withColumn(
        "o_orderdate", F.when(F.year("o_orderdate") != 1996, F.col("o_orderdate")))), star.config)
    yearly = YearlyStar(undated, str(tmp_path)).load()
    assert "sale_year=__HIVE_DEFAULT_PARTITION__" in yearly.sales_table.manifest()["parts"]
    assert rows(reports.vw_actual_vs_target(yearly)) == rows(reports.vw_actual_vs_target(undated))
    assert rows(reports.overall_performance(yearly)) == rows(reports.overall_performance(star))
    dated = YearlyStar(star, str(tmp_path)).reload([None, 1996])  # the dates were mended
    assert "sale_year=__HIVE_DEFAULT_PARTITION__" not in dated.sales_table.manifest()["parts"]
    assert rows(reports.vw_actual_vs_target(dated)) == rows(reports.vw_actual_vs_target(star))


def test_in_years(spark):
    days = spark.sql("SELECT explode(array(date'1999-12-31', date'2000-01-01', date'2000-12-31', date'2001-01-01', null)) AS d")
    assert rows(days.where(in_years(F.col("d"), [2000])).select(F.col("d").cast("string"))) == [("2000-01-01",), ("2000-12-31",)]
    assert days.where(in_years(F.col("d"), [2000, None])).count() == 3
    assert days.where(in_years(F.col("d"), [])).count() == 0


def test_the_fact_is_not_dealt_out_by_year(spark, tmp_path, monkeypatch):
    dealt, write = {}, SnapshotTable._write

    def seen(self, df, number, by, deal=True):
        dealt[self.path.rsplit("/", 1)[1]] = deal
        return write(self, df, number, by, deal)

    monkeypatch.setattr(SnapshotTable, "_write", seen)
    yearly = YearlyStar(Star.from_parquet(spark, SF_SMALL), str(tmp_path / "y")).load()
    assert dealt == {"sales": False, "rep_months": True, "salespeople": True}
    dealt.clear()
    yearly.reload([1997, 1998])
    assert dealt["sales"] is False


def test_sales_of_some_days_meet_their_orders_first(spark, monkeypatch):
    star = Star.from_parquet(spark, SF_SMALL)
    some = (F.dayofmonth("sale_date") == 15) | F.col("sale_date").isNull()
    names = [c for c in star.sales.columns]
    expected = sorted(map(tuple, star.sales.where(some).collect()))
    for few in (1 << 21, 0):
        monkeypatch.setattr("quotalake.sources.star.FEW_ORDERS", few)
        got = Star.from_parquet(spark, SF_SMALL).sales_on(some)
        assert sorted(got.columns) == sorted(names)
        assert sorted(map(tuple, got.select(*names).collect())) == expected
        assert ("strategy=broadcast" in got._jdf.queryExecution().optimizedPlan().toString()) == (few > 0)
    # frames that a star was given are kept
    given = star_with(spark, sales=star.sales.where("quantity > 10").select(*[c for c in names if c not in ("unit_price", "revenue", "cost", "profit")]))
    assert given.sales_on(some).count() == star.sales.where(some & (F.col("quantity") > 10)).count()
