"""Internal rates of return: damped Newton over arrays of flows, all series of an Arrow batch at a time.

Whether a value comes within the absolute tolerance can hang on the last digit, so terms are added one by one in flow
order, and powers are those of the C library, as in the published Newton search and in the SQL beside each query. The
JVM's and NumPy's power functions differ from it in the last digit.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.params import DAYS_PER_YEAR, SolverParams

SEARCHING, FOUND, _FAILED = 0, 1, 2


def _pow(base: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """Power by the C library; infinite beyond the range of doubles."""
    return pc.power(pa.array(base), pa.array(exponent)).to_numpy(zero_copy_only=False)


def power(base: Column, exponent: Column) -> Column:
    """Power by the C library; null where either is."""

    def raised(bases: pa.Array, exponents: pa.Array) -> pa.Array:
        return pc.power(bases, exponents)

    return F.arrow_udf(raised, "double")(base.cast("double"), exponent.cast("double"))


def _totals(series: np.ndarray, terms: np.ndarray, count: int) -> np.ndarray:
    """Sum of the terms of each series, added in their order."""
    return np.bincount(series, weights=terms, minlength=count)


def _next(rate: np.ndarray, value: np.ndarray, slope: np.ndarray, lost: np.ndarray, p: SolverParams):
    """(rate, status) after one damped step; the guards are those of the published definition."""
    lost = lost | (rate < p.min_rate) | (rate > p.max_rate) | np.isnan(value)
    flat = np.isnan(slope) | (np.abs(slope) < p.min_slope)
    found = np.abs(value) < p.tolerance
    status = np.where(lost, _FAILED, np.where(found, FOUND, np.where(flat, _FAILED, SEARCHING)))
    # a step that is no number is the largest one
    step = np.maximum(-p.max_step, np.fmin(p.max_step, value / slope))
    return np.where(status == SEARCHING, rate - step, rate), status


def _search(lengths: np.ndarray, solvable: np.ndarray, step: Callable, p: SolverParams) -> pa.Array:
    """Rates of all series, null unless found. ``step`` gets rates and, per flow, the place of its series among them."""
    found = np.full(len(lengths), np.nan)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    going, flows = np.flatnonzero(solvable), np.flatnonzero(solvable[owner])
    rate = np.full(len(going), p.guess)
    place = np.zeros(len(lengths), dtype=np.int64)
    with np.errstate(all="ignore"):
        for _ in range(p.max_iterations):
            if not len(going):
                break
            place[going] = np.arange(len(going))
            rate, status = step(going, rate, flows, place[owner[flows]])
            found[going[status == FOUND]] = rate[status == FOUND]
            still = status == SEARCHING
            flows = flows[still[place[owner[flows]]]]
            going, rate = going[still], rate[still]
    return pa.array(found, mask=np.isnan(found))


def _series(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Length of each list, place of each element in its list, and the elements. A null list has none."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return lengths, np.arange(lengths.sum()) - starts, lists.flatten()


def _both_signs(lengths: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(lengths)), lengths)
    over, under = (np.bincount(owner, weights=w, minlength=len(lengths)) for w in (amounts > 0, amounts < 0))
    return (lengths >= 2) & (over > 0) & (under > 0)


def _terms(amounts: np.ndarray, growth: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value and slope of single flows. A flow whose discount factor is beyond the range of doubles is worth nothing."""
    return amounts / _pow(growth, period), -(period * amounts) / _pow(growth, period + 1)


def discounted(amounts: Column, growth: Column, first_period: Column) -> Column:
    """Struct (value, slope) of evenly spaced flows, the first of which has the period ``first_period``."""

    def total(lists: pa.Array, growths: pa.Array, firsts: pa.Array) -> pa.Array:
        lengths, period, flat = _series(lists)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        with np.errstate(all="ignore"):
            period = period + firsts.to_numpy(zero_copy_only=False)[owner].astype(np.float64)
            terms = _terms(flat.to_numpy(zero_copy_only=False), growths.to_numpy(zero_copy_only=False)[owner], period)
        return pa.StructArray.from_arrays([pa.array(_totals(owner, t, len(lengths))) for t in terms], ["value", "slope"])

    return F.arrow_udf(total, "value double, slope double")(amounts, growth.cast("double"), first_period.cast("long"))


def irr_step(rate: Column, value: Column, slope: Column, p: SolverParams = SolverParams()) -> Column:
    """State (rate, status) after one step of a search that still goes on, from value and slope at ``rate``."""

    def stepped(rates: pa.Array, values: pa.Array, slopes: pa.Array) -> pa.Array:
        rate, value, slope = (a.to_numpy(zero_copy_only=False).astype(np.float64) for a in (rates, values, slopes))
        with np.errstate(all="ignore"):
            moved, status = _next(rate, value, slope, np.zeros(len(rate), dtype=bool), p)
        return pa.StructArray.from_arrays([pa.array(moved), pa.array(status.astype(np.int32))], ["rate", "status"])

    return F.arrow_udf(stepped, "rate double, status int")(rate, value, slope)


def irr(amounts: Column, p: SolverParams = SolverParams()) -> Column:
    """Rate per period of evenly spaced flows; null where it is undefined or not found."""

    def rates(lists: pa.Array) -> pa.Array:
        lengths, period, flat = _series(lists)
        amount, period = flat.to_numpy(zero_copy_only=False), period.astype(np.float64)

        def step(_going, rate, flows, at):
            value, slope = (_totals(at, t, len(rate)) for t in _terms(amount[flows], (1 + rate)[at], period[flows]))
            return _next(rate, value, slope, np.zeros(len(rate), dtype=bool), p)

        return _search(lengths, _both_signs(lengths, amount), step, p)

    return F.arrow_udf(rates, "double")(amounts)


def xirr(flows: Column, solvable: Column, p: SolverParams = SolverParams()) -> Column:
    """Annual rate of dated flows, an array of (years since the first flow, amount) in date order.

    ``solvable`` says whether there are two flows of opposite sign, since flows of one date may have been added up:
    value is linear in the amounts. The slope is a forward difference over one tolerance. A factor with too large an
    exponent makes the value infinite, which ends the search; only the value decides whether the rate was found, so a
    slope lost that way counts as flat.
    """

    def rates(lists: pa.Array, wanted: pa.Array) -> pa.Array:
        lengths, _, flat = _series(lists)
        years, amount = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        longest = np.zeros(len(lengths))
        np.maximum.at(longest, np.repeat(np.arange(len(lengths)), lengths), years)

        def step(going, rate, flows, at):
            # flows of one date follow each other and share a power
            first = np.flatnonzero(np.diff(at, prepend=-1).astype(bool) | (np.diff(years[flows], prepend=-1.0) != 0))
            shared = np.diff(np.append(first, len(at)))

            def total(r):
                factors = np.repeat(_pow((1 + r)[at[first]], years[flows[first]]), shared)
                return _totals(at, amount[flows] / factors, len(rate))

            shifted, most = rate + p.tolerance, longest[going]
            value = total(rate)
            slope = (total(shifted) - value) / p.tolerance
            lost = (most * np.abs(rate) > p.max_exponent) | (np.abs(value) >= p.max_magnitude)
            lost_slope = (most * np.abs(shifted) > p.max_exponent) | (np.abs(slope) >= p.max_magnitude)
            return _next(rate, value, np.where(lost_slope, np.nan, slope), lost, p)

        picked = pc.fill_null(wanted, False).to_numpy(zero_copy_only=False).astype(bool)
        return _search(lengths, picked & (lengths > 0), step, p)

    return F.arrow_udf(rates, "double")(flows, solvable)


def year_fraction(day: Column, first: Column) -> Column:
    return F.datediff(day, first) / F.lit(DAYS_PER_YEAR)
