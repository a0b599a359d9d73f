"""Audits on stored tables: every declared rule finds its planted violations."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotalake.operators import audits
from quotalake.operators.load_audit import materialize_audited
from quotalake.plans.sql_tables import register_tables
from quotalake.sources.native_star import NativeStar
from quotalake.sources.star import Star
from tests.conftest import SF_SMALL, DictTables
from tests.test_native_star import frames  # noqa: F401

#: The columns of each stored table that may be NULL.
NULLABLE = {"sales": {"discount_percent"}}
KEYS = {"customers": ["customer_id"], "products": ["product_id", "product_name"], "salespeople": ["salesperson_id"],
        "sales": ["sale_id"], "pipeline": ["opportunity_id"], "targets": ["target_id"], "calendar": ["date"],
        "customer_master": ["customer_master_id", "company_name"]}


@pytest.fixture(scope="module")
def stored(spark, frames):  # noqa: F811
    master = spark.createDataFrame([(1, "Acme", "Mining"), (2, "Bolt", "Civil")],
                                   "customer_master_id int, company_name string, industry string")
    return {**frames, "customer_master": master}


def violations(df):
    return {r.rule: r.violations for r in df.collect()}


def test_clean_tables_break_no_rule_and_all_rules_apply(spark, stored):
    star = NativeStar.from_frames(spark, stored)
    found = violations(audits.audit_unique(star)) | violations(audits.audit_not_null(star))
    assert set(found.values()) == {0} and audits.not_applicable(star) == []
    for table, df in stored.items():
        for column in set(df.columns) - NULLABLE.get(table, set()):
            assert f"not_null:{table}.{column}" in found
        for key in KEYS[table]:
            assert f"unique:{table}({key})" in found


def test_planted_nulls_and_duplicates_are_counted(spark, stored):
    spoilt = {}
    for table, df in stored.items():
        empty = df.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
        spoilt[table] = df.unionByName(df.limit(1)).unionByName(empty)
    star = NativeStar.from_frames(spark, spoilt)
    nulls, keys = violations(audits.audit_not_null(star)), violations(audits.audit_unique(star))
    assert nulls == {f"not_null:{t}.{c}": 1 for t, df in stored.items() for c in set(df.columns) - NULLABLE.get(t, set())}
    assert all(keys[f"unique:{t}({key})"] == 1 for t in KEYS for key in KEYS[t])
    integral = violations(audits.audit_unique_integral(star))
    assert all(keys[rule] == n for rule, n in integral.items()) and len(integral) == 7


def test_source_without_the_columns_lists_its_rules_as_not_applicable(spark):
    star = Star.from_parquet(spark, SF_SMALL)
    lacking = audits.not_applicable(star)
    assert {"unique:sales(sale_id)", "unique:targets(target_id)", "unique:customer_master(company_name)",
            "not_null:customers.city", "not_null:salespeople.hire_date"} <= set(lacking)
    assert not set(lacking) & set(violations(audits.audit_not_null(star)))


def test_sql_on_stored_tables_uses_their_own_columns(spark, stored, tmp_path):
    for name, df in stored.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    names = register_tables(NativeStar.from_parquet(spark, str(tmp_path)), "st_")
    assert sorted(names) == sorted(f"st_{t}" for t in stored)
    rows = spark.sql("""SELECT s.sale_id, c.city, p.hire_date, m.industry FROM st_sales s
                        JOIN st_customers c USING (customer_id) JOIN st_salespeople p USING (salesperson_id)
                        JOIN st_customer_master m ON m.company_name = c.company_name ORDER BY s.sale_id""").collect()
    assert [tuple(r) for r in rows] == [(1, "Perth", dt.date(2019, 5, 1), "Mining"), (2, "Melbourne", dt.date(2020, 6, 2), "Civil"),
                                        (3, "Perth", dt.date(2019, 5, 1), "Mining")]
    assert spark.sql("SELECT count(target_id) AS n FROM st_targets").first().n == 5
    without = register_tables(NativeStar.from_frames(spark, {k: v for k, v in stored.items() if k != "customer_master"}), "sx_")
    assert "sx_customer_master" not in without


@pytest.mark.parametrize("dense", [1, 10**9])
def test_duplicate_keys_by_bitmaps_and_by_groups(spark, dense):
    values = [*range(-40_000, 100_000, 3), 5, 5, -32_768, -32_768, 0, 0, 1, 32_768, 32_769, 2**62, 2**62, None, None]
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    want = sum(n > 1 for v, n in seen.items() if v is not None)
    df = spark.createDataFrame([(v,) for v in values], "k long").repartition(4)
    assert audits.duplicate_keys(df, "k", dense) == want > 0
    assert audits.duplicate_keys(spark.range(100_000).selectExpr("id AS k"), "k", dense) == 0
    assert audits.duplicate_keys(df.where("false"), "k", dense) == 0


def test_load_time_counts_equal_the_audits(spark):
    star = Star.from_parquet(spark, SF_SMALL)
    built, found = materialize_audited(star)
    assert rows(found) == rows(audits.audit_check(star).unionByName(audits.audit_not_null(star)))
    assert built.sales.count() == star.sales.count()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_load_time_counts_of_planted_violations(spark):
    tables = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet")
              for n in ("nation", "region", "customer", "supplier", "part", "orders", "lineitem")}
    tables["lineitem"] = tables["lineitem"].withColumn("l_suppkey", F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_suppkey")))
    tables["orders"] = tables["orders"].withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.lit(-1.0)).otherwise(
        F.when(F.col("o_orderkey") % 7 == 1, F.lit(None)).otherwise(F.col("o_totalprice"))))
    star = Star(spark, DictTables(tables))
    _, found = materialize_audited(star)
    want = violations(audits.audit_check(star).unionByName(audits.audit_not_null(star)))
    assert violations(found) == want
    assert want["not_null:sales.salesperson_id"] > 0 < want["check:pipeline.expected_revenue"]
    assert want["not_null:pipeline.expected_revenue"] > 0


def test_load_reads_the_fact_once(spark):
    star = Star.from_parquet(spark, SF_SMALL)
    from quotalake.operators.load_audit import LoadAudit, _ObservedTables
    audit = LoadAudit({"lineitem": [("not_null:sales.quantity", "sales", F.col("l_quantity").isNull())]})
    sales = Star(spark, _ObservedTables(star.source, audit), star.config).sales.select("revenue_cents", "sale_date")
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "CollectMetrics" in plan  # line items, parts, orders
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "l_orderkey" in x)
    assert "l_shipdate" not in scan and "l_extendedprice" not in scan
