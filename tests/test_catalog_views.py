"""The ten views stored in the catalog: equal to the reports, read by another session, following their tables."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotalake.operators import reports
from quotalake.plans.catalog_views import CatalogStar
from quotalake.sources.star import Star

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver test data not present")


@pytest.fixture(scope="module")
def star(spark):
    return Star.from_parquet(spark, SF_SMALL).materialize()


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    made = CatalogStar.create(star, "kept_star", str(tmp_path_factory.mktemp("catalog")))
    yield made
    spark.sql("DROP DATABASE kept_star CASCADE")


def rows(df, columns):
    def plain(x):
        return x.normalize() if isinstance(x, Decimal) else x

    return sorted((tuple(plain(x) for x in r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("name", sorted(reports.VIEWS))
def test_view_equals_report(spark, star, stored, name):
    want = reports.VIEWS[name](star)
    got = spark.newSession().table(f"kept_star.{name}")
    assert set(got.columns) == set(want.columns)
    left, right = rows(got, sorted(want.columns)), rows(want, sorted(want.columns))
    assert left == right and left


def test_views_follow_a_replaced_table(spark, stored):
    other = spark.newSession()
    before = {r.state: r.sales_count for r in other.table("kept_star.vw_revenue_by_state").collect()}
    sales = spark.table("kept_star.sales")
    old = stored.replace("sales", sales.unionByName(sales))  # from itself
    after = {r.state: r.sales_count for r in other.table("kept_star.vw_revenue_by_state").collect()}
    assert after == {k: 2 * n for k, n in before.items()}
    with pytest.raises(ValueError):
        stored.drop_old(stored.folder("sales"))
    stored.drop_old(old)
    assert {r.state: r.sales_count for r in other.table("kept_star.vw_revenue_by_state").collect()} == after


def test_a_failed_write_leaves_the_old_rows(spark, stored):
    n = spark.table("kept_star.customers").count()
    broken = spark.table("kept_star.customers").withColumn("state", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        stored.replace("customers", broken)
    assert spark.newSession().table("kept_star.customers").count() == n
    with pytest.raises(ValueError, match="columns must stay"):
        stored.replace("customers", spark.table("kept_star.customers").drop("state"))
