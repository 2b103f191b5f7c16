"""Steps whose cost must not grow faster than the input, told from their plans without small-table broadcasts."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    """Formatted physical plan of a query as it is for large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield lambda query: entry.queries()[query](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(name, before)


def test_lines_do_not_meet_currency_codes_by_code(plan):
    assert "SortMergeJoin [currency_code" not in plan("dq_invalid_refs")


def test_surrogate_keys_are_found_before_lines_become_wide(plan):
    """Each shuffle of a trade's text row is a join by one of its keys; bare lines and orders carry numbers."""
    exchanges = [line for line in plan("fact_transactions").splitlines() if "SortMergeJoin" in line]
    assert exchanges and "l_orderkey" in exchanges[0]


def test_the_report_joins_only_the_dimensions_it_shows(plan):
    found = plan("point_in_time_query")
    assert "instrument_sk" not in found and "counterparty_sk" not in found


def test_portfolio_pnl_is_added_up_in_blocks_of_days(plan):
    """A task sends one row per portfolio day and block of days, not one per simulated day."""
    for query in ("var_portfolio_level", "expected_shortfall"):
        found = plan(query)
        assert "_block" in found and "keys=[portfolio_id" in found
        assert not [line for line in found.splitlines() if "HashAggregate(keys=[" in line and "historical_dt" in line.split("]")[0]]


def test_pnl_rows_take_their_texts_from_positions_and_prices(plan):
    """No date becomes text above the join, which repeats each position and price many times."""
    above, below = plan("pnl_distribution").split("SortMergeJoin", 1)
    assert "date_format" not in above and below.count("date_format") >= 3


def test_only_tail_days_are_told_apart_by_class(plan):
    """Simulated days are neither shuffled nor summed by class before the tail is known."""
    found = plan("risk_by_class")
    assert "BroadcastHashJoin [portfolio_id" in found and "tail-days" in found
    assert "historical_dt" not in "".join(line for line in found.splitlines() if "Exchange hashpartitioning(portfolio_id" in line)


def test_position_pnl_is_cut_to_its_ranks_before_the_shuffle(plan):
    """Positions are not written with all their simulated days, and send only values that can be at a rank."""
    for query in ("var_position_level", "vw_portfolio_risk_asof", "vw_portfolio_risk_summary"):
        found = plan(query)
        assert "position-pnl" not in found and "slice(" in found
