"""Rates to the last digit: a search against an absolute tolerance ends differently with other powers or sums."""

import math
from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from folioforge.functions import rates
from folioforge.operators import returns

BY = ["portfolio_id"]
START = date(2015, 1, 1)


def search(value_and_slope, lost=lambda rate, value: False):
    rate = 0.1
    for _ in range(100):
        if rate < -0.99 or rate > 100:
            return None
        value, slope = value_and_slope(rate)
        if math.isnan(value) or lost(rate, value):
            return None
        if abs(value) < 1e-7:
            return rate
        if math.isnan(slope) or abs(slope) < 1e-10:
            return None
        rate -= max(-0.5, min(0.5, value / slope))
    return None


def plain_irr(amounts):
    def value_and_slope(rate):
        value = slope = 0.0
        for k, a in enumerate(amounts):
            value += a / math.pow(1 + rate, k)
            slope += -(k * a) / math.pow(1 + rate, k + 1)
        return value, slope

    return search(value_and_slope) if min(amounts) < 0 < max(amounts) else None


def plain_xirr(days, amounts):
    years = [(d - days[0]) / 365.25 for d in days]

    def value(rate):
        total = 0.0
        for t, a in zip(years, amounts, strict=True):
            total += a / math.pow(1 + rate, t)
        return total

    def value_and_slope(rate):
        at = value(rate)
        slope = (value(rate + 1e-7) - at) / 1e-7
        lost = years[-1] * abs(rate + 1e-7) > 50 or abs(slope) >= 1e15
        return at, math.nan if lost else slope

    lost = lambda rate, at: years[-1] * abs(rate) > 50 or abs(at) >= 1e15
    return search(value_and_slope, lost) if min(amounts) < 0 < max(amounts) else None


def amounts_of(rng, n):
    return [float(a) for a in np.round(rng.uniform(1_000, 300_000, n) * rng.choice([-1, 1], n), 2)]


def frame(spark, series):
    data = [(k, START + timedelta(int(d)), a) for k, fs in series.items() for d, a in fs]
    return spark.createDataFrame(data, "portfolio_id string, cashflow_dt date, cashflow_amount double")


def test_power_is_that_of_the_c_library(spark):
    rng = np.random.default_rng(1)
    data = [(float(b), float(e)) for b, e in zip(rng.uniform(0.1, 9, 20_000), rng.uniform(0.1, 30, 20_000), strict=True)]
    df = spark.createDataFrame([*data, (None, 1.0)], "b double, e double")
    found = df.select("b", "e", rates.power(F.col("b"), F.col("e")).alias("p")).collect()
    assert all(r.p == (None if r.b is None else math.pow(r.b, r.e)) for r in found)


def test_irr_equals_a_plain_search_to_the_last_digit(spark):
    rng = np.random.default_rng(2)
    series = {f"S{i}": [(7 * k, a) for k, a in enumerate(amounts_of(rng, int(rng.integers(2, 25))))] for i in range(1_500)}
    found = {r.portfolio_id: r.irr for r in returns.irr_results(frame(spark, series), BY).collect()}
    expected = {k: plain_irr([a for _, a in fs]) for k, fs in series.items()}
    assert found == expected
    assert sum(r is not None for r in expected.values()) > 500


def test_xirr_adds_single_flows_of_a_day_in_order(spark):
    rng = np.random.default_rng(3)
    series = {}
    for i in range(1_500):
        n = int(rng.integers(2, 25))
        series[f"S{i}"] = sorted(zip((int(d) for d in rng.integers(0, 40, n) * 50), amounts_of(rng, n), strict=True))
    found = {r.portfolio_id: r.xirr for r in returns.xirr_results(frame(spark, series), BY).collect()}
    expected = {k: plain_xirr([d for d, _ in fs], [a for _, a in fs]) for k, fs in series.items()}
    assert found == expected
    assert sum(r is not None for r in expected.values()) > 500


def test_a_month_of_five_thousand_flows_is_solved_in_one_array(spark, monkeypatch):
    """Step by step, such a series takes a hundred jobs."""
    monkeypatch.setattr(returns, "_long_irr", None)
    amounts = [-9.0] + [1.0] * 4_999
    series = {"P": [(k, a) for k, a in enumerate(amounts)]}
    [row] = returns.irr_results(frame(spark, series), BY).collect()
    assert (row.flow_count, row.irr) == (5_000, plain_irr(amounts))
