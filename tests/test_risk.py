"""Quantile ranks, stress window, look-back and groups of any size."""

import math
import random
from datetime import date, timedelta

import pytest

from folioforge.operators import reports, risk
from folioforge.params import RunParams

PARAMS = RunParams(as_of_ts="2026-01-01 00:00:00", stress_start="2024-09-01", stress_end="2024-11-30")
START = date(2024, 1, 1)


def book(spark, n_days, instruments=1, portfolios=("P",)):
    """Each instrument has one return a day; the position is held on the last day only."""
    last = START + timedelta(n_days - 1)
    prices = [(f"I{i}", START + timedelta(d), ((d * 37 + i * 11) % n_days - n_days / 2) / 1000)
              for i in range(instruments) for d in range(n_days)]
    positions = [(p, f"I{i}", last, 1000.0 * (i + 1), last.strftime("%Y%m"))
                 for p in portfolios for i in range(instruments)]
    return (
        spark.createDataFrame(
            positions, "portfolio_id string, instrument_id string, position_dt date, market_value double, "
            "position_yyyymm string"),
        spark.createDataFrame(prices, "instrument_id string, price_dt date, return_pct double"),
        prices,
    )


@pytest.mark.parametrize("n", [1, 19, 20, 21, 100, 140])
def test_rank_is_exact_at_multiples_of_twenty(spark, n):
    positions, prices, raw = book(spark, n)
    ordered = sorted(1000.0 * r for _, _, r in raw)
    found = {r.confidence_level: r for r in risk.position_level_var(positions, prices, PARAMS).collect()}
    for level, permille in ((0.95, 50), (0.99, 10)):
        rank = max(1, -(-n * permille // 1000))
        assert found[level].var_amount == pytest.approx(-ordered[rank - 1])
        assert found[level].simulations_count == n
        assert found[level].var_pct_market_value == pytest.approx(-ordered[rank - 1] / (1000.0 * n))
    assert found[0.99].var_amount >= found[0.95].var_amount


@pytest.mark.parametrize("instruments", [5, 2001, 5000])
def test_quantile_equals_a_plain_sort_for_any_number_of_positions(spark, instruments):
    positions, prices, raw = book(spark, 6, instruments=instruments)
    ordered = sorted(1000.0 * (int(name[1:]) + 1) * r for name, _, r in raw)
    found = {r.confidence_level: r for r in risk.position_level_var(positions, prices, PARAMS).collect()}
    for level, permille in ((0.95, 50), (0.99, 10)):
        assert found[level].var_amount == pytest.approx(-ordered[max(1, -(-len(ordered) * permille // 1000)) - 1])
        assert found[level].simulations_count == len(ordered)


def test_quantiles_with_ties_and_many_groups(spark):
    rng = random.Random(1)
    groups = {k: [float(rng.randrange(1 + k * 50)) for _ in range(1 + k * 700)] for k in range(6)}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double")
    got = {r.k: r._losses for r in risk.exact_quantiles(df, ["k"], "v", [50, 10, 500]).collect()}
    assert got == {
        k: [sorted(vs)[max(1, -(-len(vs) * m // 1000)) - 1] for m in (50, 10, 500)] for k, vs in groups.items()
    }


def test_portfolio_level_adds_up_days_and_counts_a_position_once(spark):
    positions, prices, raw = book(spark, 60, instruments=3)
    pnl = risk.simulated_pnl(positions, prices, PARAMS)
    assert pnl.count() == 180
    daily = {}
    for name, day, value in raw:
        daily[day] = daily.get(day, 0.0) + 1000.0 * (int(name[1:]) + 1) * value
    ordered = sorted(daily.values())
    r = risk.portfolio_level_var(pnl, positions, PARAMS).where("confidence_level = 0.95").first()
    assert r.tail_days == 3 and r.simulations_count == 60
    assert r.var_amount == pytest.approx(-ordered[2])
    assert r.expected_shortfall == pytest.approx(-sum(ordered[:3]) / 3)
    assert r.portfolio_market_value == 6000.0
    assert r.var_pct_market_value == pytest.approx(-ordered[2] / 6000.0)


def test_stress_window_and_lookback(spark):
    positions, prices, raw = book(spark, 366)
    inside = sorted(1000.0 * r for _, d, r in raw if date(2024, 9, 1) <= d <= date(2024, 11, 30))
    r = risk.stressed_var(positions, prices, PARAMS).where("confidence_level = 0.95").first()
    assert r.simulations_count == len(inside) == 91
    assert r.svar_amount == pytest.approx(-inside[math.ceil(91 * 0.05) - 1])
    short = RunParams(as_of_ts=PARAMS.as_of_ts, price_lookback_months=1)
    assert risk.simulated_pnl(positions, prices, short).count() == 31
    nothing = RunParams(as_of_ts=PARAMS.as_of_ts, month="202401")
    assert risk.position_level_var(positions, prices, nothing).count() == 0
    calm = RunParams(as_of_ts=PARAMS.as_of_ts, stress_start="2030-01-01", stress_end="2030-02-01")
    assert risk.stressed_var(positions, prices, calm).count() == 0


def test_summary_joins_on_the_full_key(spark):
    positions, prices, _ = book(spark, 366)
    var = risk.position_level_var(positions, prices, PARAMS)
    svar = risk.stressed_var(positions, prices, PARAMS)
    assert reports.risk_summary(var, svar.unionByName(svar.replace({"202412": "202501"}))).count() == 2


def test_tail_shares_add_up(spark):
    positions, prices, _ = book(spark, 80, instruments=4)
    classified = positions.selectExpr("*", "if(instrument_id < 'I2', 'BOND', 'EQUITY') asset_class_code")
    pnl = risk.simulated_pnl(classified, prices, PARAMS, carry=["asset_class_code"])
    found = risk.tail_contribution(pnl, PARAMS).collect()
    assert {r.asset_class_code for r in found} == {"BOND", "EQUITY"}
    assert sum(r.tail_share for r in found) == pytest.approx(1.0)
    es = risk.portfolio_level_var(pnl, positions, PARAMS).where("confidence_level = 0.95").first()
    assert sum(r.tail_loss for r in found) == pytest.approx(es.expected_shortfall)


def test_returns_volatility_beta(spark):
    closes = [("A", START + timedelta(d), c, c / 1000) for d, c in enumerate([100.0, 110.0, 99.0])]
    closes += [("B", START + timedelta(d), c, c / 500) for d, c in enumerate([50.0, 55.0, 49.5])]
    prices = spark.createDataFrame(closes, "instrument_id string, price_dt date, close_price double, return_pct double")
    returns = risk.derived_returns(prices)
    assert [r.derived_return for r in returns.where("instrument_id = 'A'").orderBy("price_dt").collect()] == [
        None, pytest.approx(0.1), pytest.approx(-0.1)]
    v = risk.volatility(returns).where("instrument_id = 'A'").first()
    assert v.return_count == 2 and v.volatility == pytest.approx(math.sqrt(0.02))
    betas = {r.instrument_id: r.beta for r in risk.beta(prices).collect()}
    assert betas["A"] == pytest.approx(1.0) and betas["B"] == pytest.approx(1.0)


@pytest.fixture(params=[risk.TOGETHER, 0])
def either_way(request, monkeypatch):
    """Values of a group together, and every group through brackets."""
    monkeypatch.setattr(risk, "TOGETHER", request.param)


def plain_losses(values, permilles=(50, 10)):
    ordered = sorted(v for v in values if v is not None)
    return [ordered[max(1, -(-len(ordered) * m // 1000)) - 1] if ordered else None for m in permilles]


def test_one_null_among_many_values(spark, either_way):
    values = [float(v) for v in range(20_000)] + [None]
    df = spark.createDataFrame([("P", v) for v in values], "k string, v double")
    [row] = risk.exact_quantiles(df, ["k"], "v", [50, 10]).collect()
    assert row._losses == [999.0, 199.0]


def test_null_returns_and_market_values(spark, either_way):
    positions, prices, raw = book(spark, 200, instruments=3, portfolios=("P", "Q"))
    holes = [(i, d, None if n % 3 == 0 else r) for n, (i, d, r) in enumerate(raw)]
    prices = spark.createDataFrame(holes, prices.schema)
    rows = [tuple(r) for r in positions.collect()]
    rows = [(*r[:3], None if r[0] == "Q" and r[1] == "I1" else r[3], r[4]) for r in rows]
    rows += [("R", "I0", rows[0][2], None, rows[0][4])]
    positions = spark.createDataFrame(rows, positions.schema)
    params = RunParams(as_of_ts="2026-01-01 00:00:00", stress_start="2024-02-01", stress_end="2024-03-01")
    measures = risk.position_measures(positions, prices, params)
    for kind, results in (("var", risk.measured_results(measures, params, "var")), ("svar", risk.stressed_results(measures, params))):
        used = [h for h in holes if kind == "var" or date(2024, 2, 1) <= h[1] <= date(2024, 3, 1)]
        found = {(r.portfolio_id, r.confidence_level): r for r in results.collect()}
        for portfolio in "PQR":
            held = {r[1]: r[3] for r in rows if r[0] == portfolio}
            pnl = [None if held[i] is None or r is None else held[i] * r for i, _, r in used if i in held]
            for level, loss in zip((0.95, 0.99), plain_losses(pnl), strict=True):
                r = found[portfolio, level]
                assert r.simulations_count == len(pnl)
                amount = r[f"{kind}_amount"]
                assert amount == (None if loss is None else pytest.approx(-loss))
                whole = sum(v for i, v in held.items() for h in used if h[0] == i and v is not None)
                assert r[f"{kind}_pct_market_value"] == (None if loss is None else pytest.approx(-loss / whole))
    both = {(r.portfolio_id, r.confidence_level): (r.var_amount, r.svar_amount) for r in risk.risk_summary(measures, params).collect()}
    alone = {(r.portfolio_id, r.confidence_level): r.svar_amount for r in risk.stressed_var(positions, prices, params).collect()}
    assert {k: v[1] for k, v in both.items()} == alone


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    """A sketch of almost no accuracy, and brackets of no width at first."""
    monkeypatch.setattr(risk, "TOGETHER", 0)
    monkeypatch.setattr(risk, "BRACKET_ACCURACY", 3000)
    rng = random.Random(8)
    groups = {k: [rng.gauss(0, 1) for _ in range(997 + k)] for k in range(4)}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double")
    real = risk.F.percentile_approx
    monkeypatch.setattr(risk.F, "percentile_approx", lambda c, ends, accuracy: real(c, [min(1.0, e + 0.2) for e in ends], accuracy))
    got = {r.k: r._losses for r in risk.exact_quantiles(df, ["k"], "v", [50, 10]).collect()}
    assert got == {k: plain_losses(vs) for k, vs in groups.items()}


def test_days_of_blocks_are_the_days_of_the_rows(spark, rows):
    """Days before 1970, on both edges of a block, without a known PnL, and several rows of a day."""
    days = [date(1969, 12, 31), date(1970, 1, 1), date(1970, 2, 1), date(1970, 2, 2), date(2024, 2, 29)]
    pnl = [(p, START, d, None if d == days[2] else 1.5 * n) for n, d in enumerate(days) for p in ("P", None) for _ in range(n + 1)]
    df = spark.createDataFrame(pnl, "portfolio_id string, as_of_date date, historical_dt date, simulated_pnl double")
    plain = df.groupBy("portfolio_id", "as_of_date", "historical_dt").sum("simulated_pnl")
    assert rows(risk.daily_pnl(df)) == rows(plain)


def test_tail_days_too_many_to_broadcast(spark, rows, monkeypatch):
    positions, prices, _ = book(spark, 80, instruments=4, portfolios=("P", "Q"))
    classified = positions.selectExpr("*", "if(instrument_id < 'I2', 'BOND', 'EQUITY') asset_class_code")
    pnl = risk.simulated_pnl(classified, prices, PARAMS, carry=["asset_class_code"])
    shown = ("portfolio_id", "asset_class_code", "tail_days", "round(class_total, 6)", "round(tail_share, 6)")
    few = rows(risk.tail_contribution(pnl, PARAMS).selectExpr(*shown))
    monkeypatch.setattr(risk, "TAIL_ROWS", 0)
    assert rows(risk.tail_contribution(pnl, PARAMS).selectExpr(*shown)) == few and len(few) == 4


@pytest.mark.parametrize("together", [0, 500, 1200, 100_000])
def test_days_with_and_without_all_values_of_their_positions(spark, monkeypatch, together):
    """Days of few and of many positions, one without a portfolio, negative values; equal to a plain sort."""
    monkeypatch.setattr(risk, "TOGETHER", together)
    one, prices, raw = book(spark, 100, instruments=12, portfolios=("P",))
    rows = [tuple(r) for r in one.collect()]
    rows = rows + [("Q", *r[1:3], -r[3], r[4]) for r in rows[:5]] + [("R", *rows[7][1:])] + [(None, *r[1:]) for r in rows[:3]]
    positions = spark.createDataFrame(rows, one.schema)
    measures = risk.position_measures(positions, prices, PARAMS)
    found = {(r.portfolio_id, r.confidence_level): r for r in risk.measured_results(measures, PARAMS, "var").collect()}
    portfolios = ("P", "Q", "R") + ((None,) if together >= 500 else ())
    for portfolio in portfolios:
        held = {r[1]: r[3] for r in rows if r[0] == portfolio}
        pnl = [held[i] * r for i, _, r in raw if i in held]
        for level, loss in zip((0.95, 0.99), plain_losses(pnl), strict=True):
            r = found[portfolio, level]
            assert r.simulations_count == len(pnl) and r.var_amount == pytest.approx(-loss)
