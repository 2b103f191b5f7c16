"""Historical simulation: PnL distribution, VaR, stressed VaR, tail measures, instrument statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.skew import salted_join
from folioforge.params import RunParams
from folioforge.session import materialize

DAY = ["portfolio_id", "as_of_date"]
# Rank error of the sketch that brackets a quantile, as one part in so many. What lies inside a bracket is at
# most a few such parts of a day's values, and equal values are one row with a count.
BRACKET_ACCURACY = 2000
# Most values of a portfolio day that are sorted in one array.
TOGETHER = 100_000
# Most tail days that are broadcast: 25 portfolios over 7 years of month ends have 130,000.
TAIL_ROWS = 500_000
# PnL per day is added up in blocks of 2 ** BLOCK_BITS days, one sum for each day of a block.
BLOCK_BITS = 5


def _in_stress_window(params: RunParams) -> Column:
    return F.col("historical_dt").between(
        F.lit(params.stress_start).cast("date"), F.lit(params.stress_end).cast("date")
    )


def _held(positions: DataFrame, params: RunParams, carry: Sequence[str] = ()) -> DataFrame:
    held = positions if params.month is None else positions.where(
        F.col("position_yyyymm") == params.month
    )
    return held.select(
        "portfolio_id",
        "instrument_id",
        F.col("position_dt").alias("as_of_date"),
        "market_value",
        *carry,
    )


def _history(prices: DataFrame, params: RunParams, stressed: bool, carry: Sequence[str] = ()) -> DataFrame:
    """Returns by instrument and day: the full history, or the days of the stress window."""
    history = prices.select(
        "instrument_id", F.col("price_dt").alias("historical_dt"), "return_pct", *carry
    )
    return history.where(_in_stress_window(params)) if stressed else history


def _usable(day: Column, params: RunParams) -> Column:
    """History up to and including the position day, optionally limited to a number of months."""
    usable = day <= F.col("as_of_date")
    if params.price_lookback_months is not None:
        usable &= day > F.add_months("as_of_date", -params.price_lookback_months)
    return usable


def simulated_pnl(
    positions: DataFrame,
    prices: DataFrame,
    params: RunParams,
    carry: Sequence[str] = (),
    carry_prices: Sequence[str] = (),
) -> DataFrame:
    """One row per position and price day up to the position day: value times that day's return.

    The join is on the instrument's natural key, so a new version of an instrument keeps its history.
    Prices have one row per instrument and day, so a position meets at most one row per calendar day;
    an instrument held by very many positions is sliced. ``carry`` names further position columns, ``carry_prices``
    further price columns; texts are made there or here before the join, since it repeats each row many times.
    """
    month = F.date_format("as_of_date", "yyyyMM").alias("position_yyyymm")
    held = _held(positions, params, carry).select("*", month)
    history = _history(prices, params, False, carry_prices)
    return (
        salted_join(held, history, "instrument_id", spread_by=DAY)
        .where(_usable(F.col("historical_dt"), params))
        .select(
            "portfolio_id",
            "instrument_id",
            "as_of_date",
            "historical_dt",
            (F.col("market_value") * F.col("return_pct")).alias("simulated_pnl"),
            "market_value",
            "position_yyyymm",
            *carry,
            *carry_prices,
        )
    )


def _returns(prices: DataFrame, params: RunParams, kinds: Sequence[str]) -> DataFrame:
    """Returns of each instrument as one array, at most one entry per calendar day."""
    day = F.struct("historical_dt", "return_pct", _in_stress_window(params).alias("stressed"))
    history = _history(prices, params, tuple(kinds) == ("svar",))
    return history.groupBy("instrument_id").agg(F.collect_list(day).alias("_returns"))


def _pnl_per_position(
    held: DataFrame, returns: DataFrame, counted: DataFrame, params: RunParams, kinds: Sequence[str]
) -> DataFrame:
    """One row per position; for each kind its simulated PnL as a sorted array without nulls, ``<kind>_known``, the number
    of these values, and ``<kind>_rows``, that of simulated days.

    The same values as :func:`simulated_pnl`, at most one per calendar day, but what is shuffled in the join is one
    row per position instead of one per position and day. All kinds come from one join. ``counted`` has the same
    instruments as ``held`` and is cheaper to scan.
    """
    only_stressed = tuple(kinds) == ("svar",)
    usable = F.filter("_returns", lambda r: _usable(r["historical_dt"], params))
    kept = [c for c in held.columns if c != "instrument_id"]
    met = salted_join(held, returns, "instrument_id", counted=counted, spread_by=DAY).select(*kept, usable.alias("_days"))
    days = {
        kind: F.col("_days") if kind == "var" or only_stressed else F.filter("_days", lambda r: r["stressed"])
        for kind in kinds
    }
    simulated = [
        F.sort_array(F.array_compact(F.transform(d, lambda r: F.col("market_value") * r["return_pct"]))).alias(k)
        for k, d in days.items()
    ]
    met = met.select(*kept, *simulated, *[F.size(d).alias(f"{k}_rows") for k, d in days.items()])
    return met.select("*", *[F.size(k).alias(f"{k}_known") for k in kinds])


def tail_rank(n: Column, permille: int) -> Column:
    """Rank of the loss quantile among ``n`` ordered values, in whole numbers: ceil(n * tail)."""
    return F.greatest(F.lit(1), F.ceil(n * permille / F.lit(1000)).cast("int"))


def _bracketed(df: DataFrame, by: Sequence[str], values: str, permilles: Sequence[int]) -> DataFrame:
    """Quantiles of groups of any size: no group's values are brought together.

    A mergeable sketch gives a bracket around each rank. Arrays are reduced to the number of values below the bracket
    and the values inside it, and only these become rows, equal ones as one. Where a rank turns out to lie outside,
    the brackets of that group are widened, at last to all values.
    """
    spans, part, done = range(len(permilles)), 3.0 / BRACKET_ACCURACY, []
    infinite = [F.lit(float("-inf")), F.lit(float("inf"))]
    while True:
        ends = [p for m in permilles for p in (max(0.0, m / 1000 - part), min(1.0, m / 1000 + part))]
        bracket = F.percentile_approx("_v", ends, BRACKET_ACCURACY) if part < 1 else F.array(*infinite * len(permilles))
        exploded = df.select(*by, F.explode(values).alias("_v"))
        sketch = exploded.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), bracket.alias("_ends"))
        met = df.join(sketch, list(by))
        pieces = []
        for i in spans:
            low, high = F.get("_ends", F.lit(2 * i)), F.get("_ends", F.lit(2 * i + 1))
            below = F.size(F.filter(values, lambda v: v < low))
            inside = F.filter(values, lambda v: (v >= low) & (v <= high))
            none = F.struct(F.lit(i).alias("level"), F.lit(None).cast("double").alias("at"), below.cast("long").alias("c"))
            one = F.lit(1).cast("long")
            pieces += [F.array(none), F.transform(inside, lambda v: F.struct(F.lit(i).alias("level"), v.alias("at"), one.alias("c")))]
        placed = met.select(*by, "_n", F.explode(F.concat(*pieces)).alias("_p"))
        counted = placed.groupBy(*by, "_n", "_p.level", "_p.at").agg(F.sum("_p.c").alias("_c"))
        upward = Window.partitionBy(*by, "level").orderBy(F.col("at").asc_nulls_first())
        rank = F.element_at(F.array(*[tail_rank(F.col("_n"), m) for m in permilles]), F.col("level") + 1)
        reached = counted.withColumn("_sum", F.sum("_c").over(upward)).withColumn("_rank", rank)
        hit = F.col("at").isNotNull() & (F.col("_sum") >= F.col("_rank")) & (F.col("_sum") - F.col("_c") < F.col("_rank"))
        by_level = [F.max(F.when(hit & (F.col("level") == i), F.col("at"))) for i in spans]
        found = materialize(reached.groupBy(*by).agg(F.array(*by_level).alias("_losses")), "quantiles")
        missed = F.exists("_losses", lambda x: x.isNull())
        done.append(found.where(~missed))
        again = found.where(missed).select(*by)
        if part >= 1 or again.isEmpty():
            return reduce(DataFrame.unionByName, done)
        df, part = materialize(df.join(again, list(by), "left_semi"), "missed"), part * 8


def packed_quantiles(
    df: DataFrame, by: Sequence[str], arrays: Sequence[str], permilles: Sequence[int], totals: Sequence[Column] = ()
) -> DataFrame:
    """Per group: for each array column ``<name>_losses``, the values at :func:`tail_rank` for each of ``permilles``.

    Ranks are those of all values of a group, which come in arrays without nulls; without values a loss is null. A
    group with at most ``TOGETHER`` values is sorted in one array, which is packed in one shuffle; larger ones go
    through brackets and give the same values. ``totals`` are further aggregates of the group.
    """
    size = reduce(lambda a, b: a + b, [F.size(a) for a in arrays])
    sizes = df.groupBy(*by).agg(F.sum(size).alias("_n")).where(F.col("_n") > TOGETHER)
    large = materialize(sizes.select(*by), "large-groups")
    some = not large.isEmpty()
    small = df.join(large, list(by), "left_anti") if some else df
    packed = small.groupBy(*by).agg(*totals, *[F.sort_array(F.flatten(F.collect_list(a))).alias(a) for a in arrays])
    kept = [c for c in packed.columns if c not in arrays]
    losses = [
        F.array(*[F.get(a, tail_rank(F.size(a), m) - 1) for m in permilles]).alias(f"{a}_losses") for a in arrays
    ]
    packed = packed.select(*kept, *losses)
    if not some:
        return packed
    rest = materialize(df.join(large, list(by), "left_semi"), "large-rows")
    measured = rest.groupBy(*by).agg(*totals) if totals else large
    for a in arrays:
        found = _bracketed(rest.select(*by, a), by, a, permilles).withColumnRenamed("_losses", f"{a}_losses")
        measured = measured.join(found, list(by), "left")
    none = F.array(*[F.lit(None).cast("double") for _ in permilles])
    filled = [F.coalesce(f"{a}_losses", none).alias(f"{a}_losses") for a in arrays]
    return packed.unionByName(measured.select(*kept, *filled))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, permilles: Sequence[int]) -> DataFrame:
    """``by`` and ``_losses``: per group the value at :func:`tail_rank` for each of ``permilles``; nulls do not count."""
    listed = df.select(*by, F.array_compact(F.array(value)).alias("_values"))
    return packed_quantiles(listed, by, ["_values"], permilles).withColumnRenamed("_values_losses", "_losses")


def position_measures(
    positions: DataFrame, prices: DataFrame, params: RunParams, kinds: Sequence[str] = ("var", "svar")
) -> DataFrame:
    """Per portfolio day, for each kind (all history, stress window): losses, value and number of simulations.

    One join and one pass serve all kinds and levels. A portfolio day that cannot have more than ``TOGETHER`` values, by
    its positions and the longest history, needs only so many smallest values of each position as its highest rank;
    others go through :func:`packed_quantiles` with all values. As in the published measure, losses are quantiles of the PnL
    that is known, while simulations and market value count every position and history day, also those without a
    return.
    """
    totals = []
    for k in kinds:
        totals.append(F.sum(F.col("market_value") * F.col(f"{k}_rows")).alias(f"{k}_value"))
        totals.append(F.sum(f"{k}_rows").alias(f"{k}_count"))
    permilles = [tail for _, tail in params.tails_permille]
    held = _held(positions, params)
    returns = materialize(_returns(prices, params, kinds), "returns")
    longest = returns.agg(F.coalesce(F.max(F.size("_returns")), F.lit(0))).first()[0]
    # Days of one position are not listed: their number is known without.
    named = [F.col(c).alias(f"_{c}") for c in DAY]
    shared = held.groupBy(*named).agg(F.count(F.lit(1)).alias("_shared")).where("_shared > 1")
    shared = materialize(shared, "shared-days")
    same_day = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DAY])
    most = F.coalesce("_shared", F.lit(1)) * F.lit(longest).cast("long")
    sized = held.join(shared, same_day, "left").select(*held.columns, most.alias("_most"))
    few, many = sized.where(F.col("_most") <= TOGETHER), sized.where(F.col("_most") > TOGETHER).drop("_most")
    per_position = _pnl_per_position(few, returns, positions, params, kinds)
    # A value at one of the ranks is among that many smallest ones of its own position.
    lowest = tail_rank(F.col("_most"), max(permilles))
    least = [F.slice(k, F.lit(1), lowest).alias(k) for k in kinds]
    numbers = [f"{k}_{what}" for k in kinds for what in ("rows", "known")]
    packed = (
        per_position.select(*DAY, "market_value", *least, *numbers)
        .groupBy(*DAY)
        .agg(
            *totals,
            *[F.sum(f"{k}_known").alias(f"{k}_known") for k in kinds],
            *[F.sort_array(F.flatten(F.collect_list(k))).alias(k) for k in kinds],
        )
    )
    losses = [
        F.array(*[F.get(k, tail_rank(F.col(f"{k}_known"), m) - 1) for m in permilles]).alias(f"{k}_losses") for k in kinds
    ]
    shown = [c for k in kinds for c in (f"{k}_value", f"{k}_count")]
    packed = packed.select(*DAY, *shown, *losses)
    if longest <= TOGETHER and shared.where(F.col("_shared") * F.lit(longest).cast("long") > TOGETHER).isEmpty():
        return packed
    rest = materialize(_pnl_per_position(many, returns, positions, params, kinds), "position-pnl")
    return packed.unionByName(packed_quantiles(rest, DAY, kinds, permilles, totals))


def measured_results(measures: DataFrame, params: RunParams, kind: str) -> DataFrame:
    """One row per portfolio day and level of one kind of :func:`position_measures`; days without simulations have none."""
    per_level = F.array(
        *(
            F.struct(F.lit(level).alias("confidence_level"), F.get(f"{kind}_losses", F.lit(i)).alias("_loss"))
            for i, (level, _) in enumerate(params.tails_permille)
        )
    )
    return (
        measures.where(F.col(f"{kind}_count") > 0)
        .select(*DAY, F.col(f"{kind}_value").alias("_value"), F.col(f"{kind}_count").alias("simulations_count"), F.inline(per_level))
        .select(
            *DAY,
            "confidence_level",
            F.lit(params.holding_period_days).alias("holding_period_days"),
            F.date_format("as_of_date", "yyyyMM").alias("result_yyyymm"),
            "simulations_count",
            (-F.col("_loss")).alias("var_amount"),
            F.try_divide(-F.col("_loss"), "_value").alias("var_pct_market_value"),
        )
    )


def stressed_results(measures: DataFrame, params: RunParams) -> DataFrame:
    """Stressed form of :func:`measured_results`; each result belongs to the month of its positions."""
    return measured_results(measures, params, "svar").select(
        *DAY,
        F.lit(params.stress_start).cast("date").alias("stress_window_start_dt"),
        F.lit(params.stress_end).cast("date").alias("stress_window_end_dt"),
        "confidence_level",
        "result_yyyymm",
        "simulations_count",
        F.col("var_amount").alias("svar_amount"),
        F.col("var_pct_market_value").alias("svar_pct_market_value"),
    )


def position_level_var(positions: DataFrame, prices: DataFrame, params: RunParams) -> DataFrame:
    """Loss quantiles over all position-level PnL of a portfolio day, exact for a day of any size."""
    return measured_results(position_measures(positions, prices, params, ("var",)), params, "var")


def stressed_var(positions: DataFrame, prices: DataFrame, params: RunParams) -> DataFrame:
    """The same measure over the stress window."""
    return stressed_results(position_measures(positions, prices, params, ("svar",)), params)


def risk_summary(measures: DataFrame, params: RunParams) -> DataFrame:
    """VaR and stressed VaR side by side, from one pass and without a join."""
    per_level = F.array(
        *(
            F.struct(
                F.lit(level).alias("confidence_level"),
                (-F.get("var_losses", F.lit(i))).alias("var_amount"),
                F.when(F.col("svar_count") > 0, -F.get("svar_losses", F.lit(i))).alias("svar_amount"),
            )
            for i, (level, _) in enumerate(params.tails_permille)
        )
    )
    months = measures.where("var_count > 0").withColumn("result_yyyymm", F.date_format("as_of_date", "yyyyMM"))
    return months.select(*DAY, "result_yyyymm", F.inline(per_level)).select(
        *DAY, "confidence_level", "result_yyyymm", "var_amount", "svar_amount"
    )


def _block_sums(pnl: DataFrame) -> DataFrame:
    """Portfolio PnL per block of days: ``_sums``, one for each day of the block, and ``_days``, the days that have rows as bits.

    Simulated days of a portfolio day are bounded by the calendar, but each task meets nearly all of them. One row per
    block instead of one per day keeps the sums of a task, and what it sends to the next stage, small.
    """
    day, size = F.unix_date("historical_dt"), 1 << BLOCK_BITS
    placed = pnl.select(
        *DAY, F.shiftright(day, BLOCK_BITS).alias("_block"), day.bitwiseAND(size - 1).alias("_slot"), "simulated_pnl"
    )
    sums = [F.sum(F.when(F.col("_slot") == i, F.col("simulated_pnl"))).alias(f"_{i}") for i in range(size)]
    blocks = placed.groupBy(*DAY, "_block").agg(F.expr("bit_or(shiftleft(1L, _slot))").alias("_days"), *sums)
    return blocks.select(*DAY, "_block", "_days", F.array(*[f"_{i}" for i in range(size)]).alias("_sums"))


def daily_pnl(pnl: DataFrame) -> DataFrame:
    """Portfolio PnL on each historical day."""
    present = F.expr("(shiftright(_days, _slot) & 1) = 1")
    days = _block_sums(pnl).select(*DAY, "_block", "_days", F.posexplode("_sums").alias("_slot", "pnl")).where(present)
    date = F.date_from_unix_date(F.shiftleft("_block", BLOCK_BITS) + F.col("_slot"))
    return days.select(*DAY, date.alias("historical_dt"), "pnl")


def portfolio_level_var(
    pnl: DataFrame, positions: DataFrame, params: RunParams
) -> DataFrame:
    """VaR and expected shortfall from portfolio PnL per historical day.

    PnL is added up per day first, so the ordered series of a portfolio has at most one entry per
    calendar day. Percentages use the value of the portfolio itself, each position counted once.
    """
    series = (
        _block_sums(pnl)
        .groupBy(*DAY)
        .agg(F.sort_array(F.flatten(F.collect_list(F.array_compact("_sums")))).alias("_ordered"))
    )
    value = positions.groupBy("portfolio_id", F.col("position_dt").alias("as_of_date")).agg(
        F.sum("market_value").alias("portfolio_market_value")
    )
    n = F.size("_ordered")
    tails = []
    for level, permille in params.tails_permille:
        rank = tail_rank(n, permille)
        worst = F.slice("_ordered", F.lit(1), rank)
        tails.append(
            F.struct(
                F.lit(level).alias("confidence_level"),
                rank.alias("tail_days"),
                (-F.get("_ordered", rank - 1)).alias("loss"),
                (-F.aggregate(worst, F.lit(0.0), lambda total, x: total + x) / rank).alias("shortfall"),
            )
        )
    return (
        series.join(value, DAY, "left")
        .select(
            "portfolio_id",
            "as_of_date",
            "portfolio_market_value",
            F.date_format("as_of_date", "yyyyMM").alias("result_yyyymm"),
            n.cast("long").alias("simulations_count"),
            F.inline(F.array(*tails)),
        )
        .select(
            "portfolio_id",
            "as_of_date",
            "confidence_level",
            F.lit(params.holding_period_days).alias("holding_period_days"),
            "result_yyyymm",
            "simulations_count",
            "portfolio_market_value",
            F.col("loss").alias("var_amount"),
            F.try_divide("loss", "portfolio_market_value").alias("var_pct_market_value"),
            "tail_days",
            F.col("shortfall").alias("expected_shortfall"),
        )
    )


def tail_contribution(pnl: DataFrame, params: RunParams) -> DataFrame:
    """Average PnL of each asset class over the tail days of its portfolio, and its share of the tail.

    ``pnl`` carries ``asset_class_code``, attached to the positions before they meet the price history.
    Days are ranked by PnL to four digits, so that equal losses are not ordered by summation noise.
    Ranking runs over portfolio days, whose number per group is bounded by the calendar.
    """
    level, permille = params.tails_permille[0]
    one_portfolio = Window.partitionBy(*DAY)
    # Days are ranked on their totals; classes are told apart on the few tail days only.
    tail = (
        daily_pnl(pnl)
        .withColumn("_pnl", F.floor(F.col("pnl") * 1e4 + 0.5))
        .withColumns(
            {
                "_rank": F.row_number().over(one_portfolio.orderBy("_pnl", "historical_dt")),
                "tail_days": tail_rank(F.count("*").over(one_portfolio), permille),
            }
        )
        .where(F.col("_rank") <= F.col("tail_days"))
        .select(*DAY, "historical_dt", "tail_days")
    )
    tail = materialize(tail, "tail-days")
    # Simulated days meet the tail where they are made, unless there are too many portfolios for that.
    small = tail.limit(TAIL_ROWS + 1).count() <= TAIL_ROWS
    totals = (
        pnl.join(F.broadcast(tail) if small else tail, [*DAY, "historical_dt"])
        .groupBy(*DAY, "asset_class_code", "tail_days")
        .agg(F.sum("simulated_pnl").alias("class_total"))
    )
    return totals.select(
        *DAY,
        "asset_class_code",
        F.lit(level).alias("confidence_level"),
        "tail_days",
        "class_total",
        (-F.col("class_total") / F.col("tail_days")).alias("tail_loss"),
        F.try_divide(F.col("class_total"), F.sum("class_total").over(one_portfolio)).alias(
            "tail_share"
        ),
    )


def derived_returns(prices: DataFrame) -> DataFrame:
    """Return of each close over the previous close of the instrument (at most one row per day each)."""
    before = F.lag("close_price").over(Window.partitionBy("instrument_id").orderBy("price_dt"))
    return prices.select("instrument_id", "price_dt", "close_price", before.alias("previous_close")).withColumn(
        "derived_return", F.try_divide("close_price", "previous_close") - 1
    )


def volatility(returns: DataFrame) -> DataFrame:
    """Sample standard deviation of the derived returns of each instrument."""
    return returns.groupBy("instrument_id").agg(
        F.count("derived_return").alias("return_count"),
        F.avg("derived_return").alias("mean_return"),
        F.stddev_samp("derived_return").alias("volatility"),
    )


def beta(prices: DataFrame) -> DataFrame:
    """Covariance with the equal-weight return of all instruments, over its variance.

    The benchmark has one row per calendar day, which bounds the broadcast.
    """
    benchmark = prices.groupBy("price_dt").agg(F.avg("return_pct").alias("benchmark_return"))
    return (
        prices.join(F.broadcast(benchmark), "price_dt")
        .groupBy("instrument_id")
        .agg(
            F.count("*").alias("return_count"),
            F.try_divide(
                F.covar_samp("return_pct", "benchmark_return"), F.var_samp("benchmark_return")
            ).alias("beta"),
        )
    )
