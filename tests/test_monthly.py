"""Two monthly runs over landed files, end to end."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from folioforge import monthly
from folioforge.operators import facts
from folioforge.params import RunParams
from folioforge.session import materialize
from folioforge.sinks import tables as sinks
from tests.landing_files import land_month

JAN = RunParams(as_of_ts="2026-02-01 06:00:00", month="202601", load_id="jan",
                stress_start="2026-01-05", stress_end="2026-01-20")
FEB = RunParams(as_of_ts="2026-03-01 06:00:00", month="202602", load_id="feb",
                stress_start="2026-01-05", stress_end="2026-01-20")


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    land_month(base, "202601")
    land_month(base, "202602", policy="AGGRESSIVE", late_days=(date(2026, 1, 30), date(2026, 1, 31)))
    monthly.run_month(spark, str(base), JAN)
    monthly.run_month(spark, str(base), FEB)
    return base


def test_batches_are_kept_side_by_side(spark, published, rows):
    counts = spark.table("bronze.transactions_raw").groupBy("source_yyyymm").count()
    assert rows(counts) == [("202601", 28), ("202602", 30)]


def test_late_rows_join_their_event_month(spark, published, rows):
    months = monthly.event_months(spark).where(F.col("table_name") == "fact_transactions")
    assert rows(months, "event_yyyymm", "record_count") == [("202601", 30), ("202602", 28)]


def test_dimension_history(spark, published, rows):
    p = spark.table("silver.dim_portfolio").where("portfolio_id = 'P1'")
    assert rows(p, "record_version", "risk_policy_name", "change_type", "is_current") == [
        (1, "STANDARD", "EXPIRE", False), (2, "AGGRESSIVE", "UPDATE", True)]
    assert spark.table("silver.dim_portfolio").count() == 3
    assert spark.table("silver.dim_instrument").count() == 3


def test_facts_keep_both_kinds_of_keys(spark, published):
    t = spark.table("silver.fact_transactions")
    assert t.where("portfolio_sk is null or instrument_sk is null or counterparty_sk is null").count() == 0
    joined = t.join(spark.table("silver.dim_portfolio"), "portfolio_sk").where("trade_yyyymm = '202601'")
    policies = {(r.transaction_id, r.risk_policy_name) for r in joined.collect()}
    assert ("T000", "STANDARD") in policies and ("L000", "AGGRESSIVE") in policies


def test_value_at_risk_uses_the_whole_history(spark, published):
    v = spark.table("gold.risk_var_results")
    last = v.where("as_of_date = date'2026-02-28' and portfolio_id = 'P1' and confidence_level = 0.99").first()
    assert last.simulations_count == 3 * 56
    both = {(r.portfolio_id, r.as_of_date): [] for r in v.collect()}
    for r in v.collect():
        both[r.portfolio_id, r.as_of_date].append((r.confidence_level, r.var_amount))
    assert all(sorted(x)[0][1] <= sorted(x)[1][1] for x in both.values())


def test_views(spark, published):
    summary = spark.table("gold.vw_portfolio_risk_summary")
    assert summary.count() == spark.table("gold.risk_var_results").count() == 2 * 2 * 56
    feb = summary.where("result_yyyymm = '202602' and svar_amount is not null")
    assert feb.count() == 2 * 2 * 28
    performance = spark.table("gold.vw_portfolio_performance_summary")
    assert performance.count() == 4
    assert performance.where("cagr is null").count() == 0
    assert spark.table("gold.vw_portfolio_risk_asof").count() == 224
    assert spark.table("gold.vw_portfolio_performance_asof").count() == 4


def test_replaying_a_month_changes_nothing(spark, published, rows):
    names = ["silver.dim_portfolio", "silver.fact_transactions", "gold.risk_var_results",
             "gold.performance_xirr_results", "bronze.cashflows_raw"]
    before = {n: rows(spark.table(n)) for n in names}
    monthly.run_month(spark, str(published), FEB)
    for n in names:
        spark.catalog.refreshTable(n)
        assert rows(spark.table(n)) == before[n], n


def test_facts_as_they_were_known_before_a_later_load(spark, published):
    history = spark.table("silver.vw_fact_transactions_history")
    known = "system_from_ts <= timestamp'{0}' and timestamp'{0}' < system_to_ts and not is_deleted"
    assert history.where(known.format("2026-02-15 00:00:00")).count() == 28
    assert history.where(known.format("2026-03-15 00:00:00")).count() == 58
    assert history.where(known.format("2026-01-15 00:00:00")).count() == 0
    log = spark.table("silver.fact_transactions_versions")
    keys = ["transaction_id", "trade_yyyymm"]
    assert facts.facts_known_at(log, keys, "2026-02-15 00:00:00").count() == 28
    assert spark.table("silver.fact_transactions").count() == 58


def test_results_of_an_earlier_run_are_kept(spark, published):
    """January is published again after its facts were corrected; both answers can be asked for."""
    again = RunParams(as_of_ts="2026-03-05 06:00:00", month="202601", load_id="again",
                      stress_start="2026-01-05", stress_end="2026-01-20")
    question = ("system_as_of_ts <= timestamp'{0}' and timestamp'{0}' < known_to_ts "
                "and business_as_of_ts <= timestamp'2026-01-20'")
    risk_asof = "gold.vw_portfolio_risk_asof"

    def answer(view, moment, *columns):
        spark.catalog.refreshTable(view)
        found = spark.table(view).where(question.format(moment)) if view == risk_asof else spark.table(view).where(
            question.format(moment).replace("2026-01-20", "2026-12-31"))
        return sorted(tuple(r) for r in found.where("result_yyyymm = '202601'").select(*columns).collect())

    risk_columns = ("portfolio_id", "as_of_date", "confidence_level", "var_amount", "svar_amount")
    performance = ("portfolio_id", "ending_value", "cagr", "irr", "xirr")
    old = answer(risk_asof, "2026-03-10", *risk_columns)
    old_growth = answer("gold.vw_portfolio_performance_asof", "2026-03-10", *performance)
    assert len(old) == 2 * 2 * 20 and len(old_growth) == 2
    doubled = spark.table("silver.fact_positions_daily").where("position_yyyymm = '202601'").withColumn(
        "market_value", F.col("market_value") * 2)
    sinks.save_months(materialize(doubled, "doubled"), "silver.fact_positions_daily", "position_yyyymm")
    spark.catalog.refreshTable("silver.fact_positions_daily")
    monthly.publish_risk(spark, again)
    monthly.publish_returns(spark, again)
    assert answer(risk_asof, "2026-03-04", *risk_columns) == old
    assert answer("gold.vw_portfolio_performance_asof", "2026-03-04", *performance) == old_growth
    new = answer(risk_asof, "2026-03-10", *risk_columns)
    assert [r[3] for r in new] == pytest.approx([2 * r[3] for r in old])
    assert [r[1] for r in answer("gold.vw_portfolio_performance_asof", "2026-03-10", *performance)] == pytest.approx(
        [2 * r[1] for r in old_growth])


def test_raw_counts(spark, published, rows):
    counts = dict(rows(monthly.raw_counts(spark)))
    assert counts["positions_daily_raw"] == 2 * 6 * 28
    assert counts["currencies_raw"] == 4


def test_replacement_mode_keeps_only_the_batch(spark, published):
    monthly.load_fact(spark, monthly.FACTS[0], FEB, replace=True)
    spark.catalog.refreshTable("silver.fact_transactions")
    t = spark.table("silver.fact_transactions")
    assert t.where("trade_yyyymm = '202601'").count() == 2
    assert t.where("trade_yyyymm = '202602'").count() == 28
