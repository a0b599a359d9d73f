"""Kept totals: any sequence of folds equals the views over all facts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotalake.operators import reports
from quotalake.operators.kept import KeptStar, KeptTotals
from quotalake.sources.snapshots import SnapshotTable
from quotalake.sources.native_star import NativeStar
from tests.test_native_star import D, _m, frames  # noqa: F401


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same(star, kept, views=tuple(reports.VIEWS)):
    again = KeptStar(star, kept)
    again.__dict__["targets"] = star.targets
    for name in views:
        view = reports.VIEWS[name]
        if name not in ("vw_actual_vs_target", "vw_target_miss_rate"):
            assert rows(view(again)) == rows(view(star)), name
    assert rows(again.rep_months.select("salesperson_id", "year", "month", "rev_c", "prof_c", "sales_count")) == rows(
        star.rep_months.select("salesperson_id", "year", "month", "rev_c", "prof_c", "sales_count"))
    assert rows(reports.overall_performance(again)) == rows(reports.overall_performance(star))
    assert rows(reports.win_rate_overall(again)) == rows(reports.win_rate_overall(star))


@pytest.fixture
def stars(spark, frames):  # noqa: F811
    """A state of the star by the ids of its sales and opportunities."""
    sales = frames["sales"].unionByName(spark.createDataFrame(
        [(4, 1, 1, 1, None, 1, _m(0), _m(10), _m(10), _m(4), _m(6)), (5, 2, 2, 1, D(2022, 2, 6), 1, _m(0), _m(90), _m(90), _m(1), _m(89))],
        frames["sales"].schema))

    def make(sale_ids, deal_ids):
        return NativeStar.from_frames(spark, {**frames, "sales": sales.where(F.col("sale_id").isin(sale_ids)),
                                              "pipeline": frames["pipeline"].where(F.col("opportunity_id").isin(deal_ids))})

    return make


FEW = ("vw_revenue_by_month", "vw_pipeline_by_stage")


@pytest.mark.parametrize("period", ["month", "year"])
def test_new_late_and_removed_days(spark, stars, tmp_path, period):
    first = stars([1], [1])
    kept = KeptTotals(spark, str(tmp_path / period), period).load(first)
    same(first, kept, FEW)
    later = stars([1, 2, 3], [1, 2, 3])
    kept.fold(later, [D(2022, 2, 6), D(2022, 2, 7), D(2022, 8, 1), D(2022, 9, 1)])  # new days
    same(later, kept, FEW)
    late = stars([1, 2, 3, 4, 5], [1, 2, 3])
    kept.fold(late, [D(2022, 2, 6), None])  # a late row of a known day, and one without a date
    same(late, kept, FEW)
    kept.fold(late, [D(2022, 2, 6), None])  # once more: nothing is added twice
    same(late, kept)
    removed = stars([1, 3], [2])
    kept.fold(removed, [D(2022, 2, 6), None, D(2022, 7, 1), D(2022, 9, 1), D(1999, 1, 1)])
    same(removed, kept, FEW)
    kept.fold(stars([], []), [D(2022, 1, 5), D(2022, 2, 7), D(2022, 8, 1)])
    assert kept.table.read().count() == 0


def test_a_fold_writes_only_its_periods_and_keeps_the_state_when_it_fails(spark, stars, tmp_path):
    kept = KeptTotals(spark, str(tmp_path / "t")).load(stars([1, 2, 3], [1, 2, 3]))
    before = kept.table.manifest()["parts"]
    kept.fold(stars([1, 2, 3, 5], [1, 2, 3]), [D(2022, 2, 6)])
    after = kept.table.manifest()["parts"]
    assert {p for p in before if before[p] != after[p]} == {
        f"grain={g}/period=202202" for g in ("customer_id", "product_id", "salesperson_id")}
    broken = stars([1, 2, 3], [1, 2, 3])
    broken.__dict__["sales"] = broken.sales.withColumn(
        "revenue_cents", F.when(F.col("sale_id") == 2, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("revenue_cents")))
    with pytest.raises(PySparkException):
        kept.fold(broken, [D(2022, 2, 6), dt.date(2022, 2, 7)])
    same(stars([1, 2, 3, 5], [1, 2, 3]), kept, FEW)


def test_a_fold_deals_out_new_totals_only(spark, stars, tmp_path, monkeypatch):
    kept = KeptTotals(spark, str(tmp_path / "kept"), "year").load(stars([1, 2], [1, 2]))
    found, write = [], SnapshotTable._write

    def seen(self, df, number, by, deal=True):
        found.append((deal, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, df, number, by, deal)

    monkeypatch.setattr(SnapshotTable, "_write", seen)
    later = stars([1, 2, 3, 4, 5], [1, 2, 3])
    kept.fold(later, [D(2022, 2, 6), D(2022, 2, 7), D(2022, 8, 1), D(2022, 9, 1), None])
    (deal, plan), = found
    assert not deal and plan.count("RebalancePartitions") == 1 and plan.index("Union") < plan.index("RebalancePartitions")
    same(later, kept, FEW)
