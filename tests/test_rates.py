"""IRR and XIRR against a brute-force search in plain Python."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import returns
from folioforge.operators.keys import number_within
from folioforge.params import SolverParams

P = SolverParams()
BY = ["portfolio_id"]


def newton(amounts, exponents, slope):
    """Damped Newton; ``slope(rate, value)`` gives the derivative."""
    if len(amounts) < 2 or not min(amounts) < 0 < max(amounts):
        return None

    def value_at(rate):
        if max(exponents) * abs(rate) > 50 and slope is None:
            return np.inf
        # The tolerance is absolute, so the terms are added one by one in flow order.
        total = 0.0
        for a, e in zip(amounts, exponents):
            total += a / (1 + rate) ** e
        return total

    rate = 0.10
    for _ in range(100):
        if not -0.99 <= rate <= 100:
            return None
        value = value_at(rate)
        if not np.isfinite(value) or (slope is None and abs(value) >= 1e15):
            return None
        if abs(value) < 1e-7:
            return rate
        d = slope(amounts, exponents, rate) if slope else (value_at(rate + 1e-7) - value) / 1e-7
        if not np.isfinite(d) or abs(d) < 1e-10:
            return None
        rate -= float(np.clip(value / d, -0.5, 0.5))
    return None


def analytic(amounts, exponents, rate):
    return -sum(e * a / (1 + rate) ** (e + 1) for a, e in zip(amounts, exponents))


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(7)
    made = {}
    for i in range(400):
        n = int(rng.integers(1, 14))
        days = np.sort(rng.integers(0, 2500, n))
        amounts = np.round(rng.normal(0, 5000, n) + (0 if i % 3 else 4000), 2)
        if i % 2:
            amounts[0] = -abs(amounts).sum() * rng.uniform(0.5, 1.2)
        made[f"S{i}"] = [(date(2015, 1, 1) + timedelta(int(d)), float(a)) for d, a in zip(days, amounts)]
    made["same_day"] = [(date(2020, 1, 1), -100.0), (date(2020, 1, 1), 100.0)]
    made["all_positive"] = [(date(2020, 1, 1), 5.0), (date(2020, 6, 1), 100.0)]
    made["single"] = [(date(2020, 1, 1), -100.0)]
    made["doubling"] = [(date(2020, 1, 1), -100.0), (date(2020, 12, 31), 200.0)]
    return made


@pytest.fixture(scope="module")
def flows(spark, series):
    data = [(k, d, a) for k, fs in series.items() for d, a in fs]
    return spark.createDataFrame(data, "portfolio_id string, cashflow_dt date, cashflow_amount double")


def close(found, expected):
    return (found is None and expected is None) or (
        found is not None and expected is not None and abs(found - expected) < 1e-6
    )


def test_irr(flows, series):
    found = {r.portfolio_id: r.irr for r in returns.irr_results(flows, BY).collect()}
    assert set(found) == set(series)
    solved = 0
    for key, fs in series.items():
        amounts = [a for _, a in sorted(fs)]
        expected = newton(amounts, range(len(amounts)), analytic)
        assert close(found[key], expected), (key, found[key], expected)
        solved += expected is not None
    assert solved > 100


def test_xirr(flows, series):
    found = {r.portfolio_id: r.xirr for r in returns.xirr_results(flows, BY).collect()}
    assert set(found) == set(series)
    solved = 0
    for key, fs in series.items():
        ordered = sorted(fs, key=lambda f: f[0])
        years = [(d - ordered[0][0]).days / 365.25 for d, _ in ordered]
        expected = newton([a for _, a in ordered], years, None)
        assert close(found[key], expected), (key, found[key], expected)
        solved += expected is not None
    assert solved > 100
    assert found["same_day"] == pytest.approx(0.10)
    assert found["all_positive"] is None and found["single"] is None


def test_value_at_the_rate_is_zero(flows, series):
    for r in returns.irr_results(flows, BY).where("irr is not null").collect():
        amounts = [a for _, a in sorted(series[r.portfolio_id])]
        assert abs(sum(a / (1 + r.irr) ** i for i, a in enumerate(amounts))) < 1e-4


def test_flows_without_amount_or_date_are_left_out(spark):
    cashflows = spark.createDataFrame(
        [("A", date(2020, 1, 1), -100.0, "202001"), ("A", date(2020, 1, 2), None, "202001"),
         ("A", None, 50.0, "202001")],
        "portfolio_id string, cashflow_dt date, cashflow_amount double, cashflow_yyyymm string",
    )
    bounds = spark.createDataFrame(
        [("A", date(2020, 12, 31), 110.0)], "portfolio_id string, valuation_dt date, ending_value double"
    )
    united = returns.flows_with_terminal(cashflows, bounds, BY)
    assert united.count() == 2
    assert returns.irr_results(united, BY).first().irr == pytest.approx(0.10)


def long_flows(spark, n, first):
    return spark.range(n).select(
        F.lit("long").alias("portfolio_id"),
        F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("cashflow_dt"),
        F.when(F.col("id") == 0, first).otherwise(1.0).alias("cashflow_amount"),
    )


def test_series_of_ten_thousand_flows(spark, flows):
    united = long_flows(spark, 10_000, -9.0).unionByName(flows.where("portfolio_id = 'doubling'"))
    numbered = returns.flow_series(united, BY)
    assert {tuple(r) for r in numbered.groupBy("portfolio_id").agg(F.max("period"), F.countDistinct("period")).collect()} == {
        ("long", 10_000, 10_000), ("doubling", 2, 2)
    }
    assert numbered.where("portfolio_id = 'long' and period = datediff(cashflow_dt, date'2000-01-01') + 1").count() == 10_000
    found = {r.portfolio_id: r for r in returns.irr_results(united, BY).collect()}
    # the value of 1 a period for ever is 1 / rate
    assert found["long"].irr == pytest.approx(1 / 9) and found["long"].flow_count == 10_000
    assert found["doubling"].irr == pytest.approx(1.0)
    assert returns.xirr_results(long_flows(spark, 10_000, -1000.0), BY).first().xirr is not None


def test_long_series_step_by_step_equal_the_search_in_one_array(spark, flows, series, monkeypatch):
    together = {r.portfolio_id: (r.flow_count, r.irr) for r in returns.irr_results(flows, BY).collect()}
    monkeypatch.setattr(returns, "CHUNK", 4)
    apart = {r.portfolio_id: (r.flow_count, r.irr) for r in returns.irr_results(flows, BY).collect()}
    assert set(apart) == set(together) == set(series)
    for key, (n, rate) in together.items():
        assert apart[key][0] == n and close(apart[key][1], rate), key


def test_a_group_over_many_partitions_is_numbered(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), (F.col("id") % 50).alias("v")
    )
    rows = number_within(df, ["k"], ["v"], "n").collect()
    for key in {r.k for r in rows}:
        own = sorted((r.n, r.v) for r in rows if r.k == key)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)


def test_one_day_has_no_growth_rate(spark):
    positions = spark.createDataFrame(
        [("A", date(2020, 1, 1), 10.0, "202001"), ("B", date(2020, 1, 1), 10.0, "202001"),
         ("B", date(2021, 1, 1), 20.0, "202101"), ("B", date(2021, 1, 1), 1.0, "202101"),
         ("C", date(2020, 1, 1), 0.0, "202001"), ("C", date(2021, 1, 1), 5.0, "202101")],
        "portfolio_id string, position_dt date, market_value double, position_yyyymm string",
    )
    bounds = returns.valuation_bounds(returns.daily_values(positions, BY), BY)
    found = {r.portfolio_id: r for r in returns.cagr(bounds, BY).collect()}
    assert found["A"].cagr is None and found["A"].years_held == 0
    assert found["B"].ending_value == 21.0
    assert found["B"].cagr == pytest.approx(2.1 ** (365.25 / 366) - 1)
    assert found["C"].cagr is None
    monthly = returns.daily_values(positions, list(returns.MONTHLY))
    assert returns.valuation_bounds(monthly, list(returns.MONTHLY)).count() == 5
