"""Run parameters. Every clock value and business constant enters a job through here."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data model.
OPEN_END_TS = "9999-12-31 23:59:59"
OPEN_END_DT = "9999-12-31"
NULL_MARKER = "<<NULL>>"
HASH_SEPARATOR = "||"
DAYS_PER_YEAR = 365.25


@dataclass(frozen=True)
class SolverParams:
    """Newton settings shared by IRR and XIRR (fixed values of the data model)."""

    guess: float = 0.10
    max_iterations: int = 100
    tolerance: float = 1e-7
    min_rate: float = -0.99
    max_rate: float = 100.0
    max_step: float = 0.5
    min_slope: float = 1e-10
    max_magnitude: float = 1e15
    max_exponent: float = 50.0


@dataclass(frozen=True)
class RunParams:
    """One monthly run. ``month=None`` computes every month found in the input."""

    as_of_ts: str
    month: str | None = None
    load_id: str = "manual"
    # Confidence levels as per-mille of the loss tail, horizon, stress window.
    tails_permille: tuple[tuple[float, int], ...] = ((0.95, 50), (0.99, 10))
    holding_period_days: int = 1
    stress_start: str = "2024-09-01"
    stress_end: str = "2024-11-30"
    price_lookback_months: int | None = None
    solver: SolverParams = SolverParams()
