"""Column helpers: exact rounding, draws, weighted buckets, calendar attributes."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotalake.functions.calendar_fns import financial_year, iso_week, month_name
from quotalake.functions.draws import key_draw, kth_of, weighted_choice
from quotalake.functions.exact import half_up_long, half_up_quotient, pct, round_ratio
from quotalake.operators.build import STAGE_PROBABILITY, STAGES, build_calendar, stage_and_probability


def _half_up(a: int, b: int) -> int:
    return int((Decimal(a) / Decimal(b)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) \
        if abs(a) < 10 ** 25 else None


def test_half_up_quotient_ties_and_signs(spark):
    cases = [(5, 2), (-5, 2), (7, 2), (-7, 2), (1, 3), (2, 3), (-2, 3), (0, 7), (10, 4), (-10, 4),
             (15, -2), (-15, -2), (999999999999999999, 1000000000000000000)]
    df = spark.createDataFrame(cases, "a long, b long")
    got = [r.q for r in df.select(half_up_quotient(F.col("a"), F.col("b")).alias("q")).collect()]
    assert [int(g) for g in got] == [_half_up(a, b) for a, b in cases]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0), (None, 3)], "a long, b long")
    rows = df.select(pct(F.col("a"), F.col("b"), 2).alias("p")).collect()
    assert [r.p for r in rows] == [None, None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10 ** 15, 10 ** 15), st.integers(1, 10 ** 12)),
                min_size=1, max_size=30))
def test_round_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.q for r in df.select(round_ratio(F.col("a"), F.col("b"), 2).alias("q")).collect()]
    want = [(Decimal(a) / Decimal(b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for a, b in pairs]
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-10 ** 17, 10 ** 17), min_size=1, max_size=30),
       st.sampled_from([2, 3, 12, 10000]))
def test_half_up_long_matches_decimal(spark, values, b):
    df = spark.createDataFrame([(v,) for v in values], "a long")
    got = [r.q for r in df.select(half_up_long(F.col("a"), b).alias("q")).collect()]
    assert got == [_half_up(v, b) for v in values]


def test_weighted_choice_boundaries(spark):
    df = spark.createDataFrame([(d,) for d in (0, 299, 300, 549, 550, 749, 750, 899, 900, 959, 960, 999)], "d int")
    stage, prob = stage_and_probability(F.col("d"))
    rows = df.select("d", stage.alias("s"), prob.alias("p")).collect()
    want = ["Prospecting", "Prospecting", "Qualification", "Qualification", "Proposal", "Proposal",
            "Negotiation", "Negotiation", "Closed Won", "Closed Won", "Closed Lost", "Closed Lost"]
    assert [r.s for r in rows] == want
    # stage and probability come from one draw, so they always agree
    for r in rows:
        assert int(r.p) == STAGE_PROBABILITY[STAGES.index(r.s)]


def test_weighted_choice_rejects_bad_weights():
    import pytest
    with pytest.raises(ValueError):
        weighted_choice(F.lit(1), [500, 400], ["a", "b"])


def test_key_draw_is_the_leading_md5_bits(spark):
    import hashlib

    rows = spark.range(0, 500).select("id", key_draw("id", "stage").alias("d")).collect()
    assert all(r.d == int(hashlib.md5(f"{r.id}:stage".encode()).hexdigest()[:15], 16) for r in rows)
    null = spark.sql("SELECT CAST(NULL AS BIGINT) AS k").select(key_draw("k", "stage").alias("d")).first()
    assert null.d is None


def test_kth_of(spark):
    picks = spark.createDataFrame([(0, 7), (6, 7), (7, 7), (1 << 59, 10), (5, 0), (5, None)], "d long, n long") \
        .select(kth_of(F.col("d"), F.col("n")).alias("k")).collect()
    assert [r.k for r in picks] == [1, 7, 1, 1 + (1 << 59) % 10, None, None]


def test_draws_are_independent(spark):
    df = spark.range(0, 20_000).select(*[F.pmod(key_draw("id", n), F.lit(10)).alias(n)
                                         for n in ("stage", "territory", "product")])
    for other in ("territory", "product"):
        cells = df.groupBy("stage", other).count().collect()
        assert len(cells) == 100                       # every combination occurs
        chi2 = sum((r["count"] - 200) ** 2 / 200 for r in cells)
        assert chi2 < 160                              # 99 degrees of freedom


def test_calendar_attributes(spark):
    cal = build_calendar(spark, dt.date(2020, 12, 31), dt.date(2021, 7, 1))
    rows = {r.date: r for r in cal.collect()}
    assert len(rows) == (dt.date(2021, 7, 1) - dt.date(2020, 12, 31)).days + 1
    jan1 = rows[dt.date(2021, 1, 1)]
    assert (jan1.year, jan1.quarter, jan1.month, jan1.week, jan1.day) == (2021, 1, 1, 53, 1)
    assert jan1.month_name == "January"
    assert rows[dt.date(2021, 6, 30)].financial_year == "FY2021"
    assert rows[dt.date(2021, 7, 1)].financial_year == "FY2022"
    assert rows[dt.date(2020, 12, 31)].quarter == 4


def test_calendar_helpers_on_columns(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),)], "d date")
    r = df.select(iso_week(F.col("d")).alias("w"), month_name(F.col("d")).alias("m"),
                  financial_year(F.col("d")).alias("fy")).first()
    assert (r.w, r.m, r.fy) == (1, "December", "FY2026")


def test_value_opportunity_and_replace_table(spark, tmp_path):
    from decimal import Decimal as Dec

    from quotalake.operators.build import replace_table, value_opportunity

    df = spark.createDataFrame([(Dec("123456.78"), 3), (Dec("0.35"), 7)], "p decimal(10,2), q int")
    vals = [r.v for r in df.select(value_opportunity(F.col("p"), F.col("q")).alias("v")).collect()]
    assert vals == [Dec("370370.34"), Dec("2.45")]
    path = str(tmp_path / "t")
    replace_table(df, path)
    replace_table(df.limit(1), path)           # overwrite, not append
    assert spark.read.parquet(path).count() == 1
