"""Landed files in the layout of the data model, written for tests."""

import csv
from datetime import date, timedelta
from pathlib import Path


def write_csv(path: Path, rows: list[dict], columns: list[str] | None = None) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as handle:
        writer = csv.DictWriter(handle, columns or list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)


def land_month(base: Path, month: str, policy: str = "STANDARD", late_days: tuple = ()) -> None:
    """Two portfolios, three instruments, every day of a month; ``late_days`` add earlier trades."""
    first = date(int(month[:4]), int(month[4:]), 1)
    days = [first + timedelta(d) for d in range(28)]
    dims = base / "dimensions" / month
    write_csv(dims / "portfolios.csv", [
        dict(portfolio_id=f"P{i}", portfolio_name=f"Portfolio {i}", portfolio_type="GROWTH",
             base_currency_code="USD", risk_policy_name=policy if i == 1 else "STANDARD", as_of_month=month)
        for i in (1, 2)
    ])
    write_csv(dims / "instruments.csv", [
        dict(instrument_id=f"I{i}", instrument_name=f"Instrument {i}", ticker=f"T{i}", isin=f"X{i}",
             asset_class_code="EQUITY", currency_code="USD", issuer_name="Issuer", coupon_rate=0.0,
             maturity_dt="2030-01-01", as_of_month=month)
        for i in (1, 2, 3)
    ])
    write_csv(dims / "counterparties.csv", [
        dict(counterparty_id="C1", counterparty_name="Broker", counterparty_type="BROKER",
             country_code="US", credit_rating="AA", as_of_month=month)
    ])
    write_csv(dims / "currencies.csv", [
        dict(currency_code=c, currency_name=c, decimal_precision=2, as_of_month=month) for c in ("USD", "EUR")
    ])
    write_csv(dims / "asset_classes.csv", [
        dict(asset_class_code="EQUITY", asset_class_name="Equity", risk_bucket="EQUITY", as_of_month=month)
    ])
    write_csv(dims / "market_data_sources.csv", [
        dict(source_system_code="FEED", source_system_name="Feed", vendor_name="Vendor", as_of_month=month)
    ])
    for n, d in enumerate(days):
        stamp = d.strftime("%Y%m%d")
        write_csv(base / "market_prices_daily" / month / f"market_prices_daily_{stamp}.csv", [
            dict(price_id=f"{i}{stamp}", instrument_id=f"I{i}", price_dt=d, close_price=100 + n + i,
                 return_pct=round(0.01 * ((n * i) % 7 - 3), 6), volatility_proxy=1.0, currency_code="USD",
                 source_system_code="FEED", as_of_month=month)
            for i in (1, 2, 3)
        ])
        write_csv(base / "positions_daily" / month / f"positions_daily_{stamp}.csv", [
            dict(position_id=f"{p}{i}{stamp}", portfolio_id=f"P{p}", instrument_id=f"I{i}", position_dt=d,
                 quantity=10 * p, end_of_day_price=100 + n + i, market_value=10 * p * (100 + n + i),
                 unrealized_pnl=0.0, currency_code="USD", source_system_code="FEED", as_of_month=month)
            for p in (1, 2) for i in (1, 2, 3)
        ])
        write_csv(base / "transactions" / month / f"transactions_{stamp}.csv", [
            _trade(f"T{n:03d}", d, month)
        ])
    for n, d in enumerate(late_days):
        write_csv(base / "transactions" / month / f"transactions_late_{n}.csv", [_trade(f"L{n:03d}", d, month)])
    write_csv(base / "cashflows" / month / f"cashflows_{first:%Y%m%d}.csv", [
        dict(cashflow_id=f"F{p}{k}", portfolio_id=f"P{p}", instrument_id="",
             cashflow_dt=first + timedelta(9 * k), cashflow_type=kind, cashflow_amount=amount,
             currency_code="USD", as_of_month=month)
        for p in (1, 2)
        for k, (kind, amount) in enumerate([("INITIAL_INVESTMENT", -3000.0 * p), ("DIVIDEND", 20.0)])
    ])


def _trade(key, day, month):
    return dict(transaction_id=key, portfolio_id="P1", instrument_id="I1", counterparty_id="C1", trade_dt=day,
                settlement_dt=day + timedelta(2), transaction_type="BUY", quantity=5, price=100.0,
                gross_amount=500.0, fees_amount=1.0, net_amount=499.0, currency_code="USD", as_of_month=month)
