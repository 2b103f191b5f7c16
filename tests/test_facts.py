"""Late arrivals, corrections, backfills and empty batches."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from folioforge.functions.temporal import stamp, valid_at
from folioforge.operators import facts
from folioforge.operators.skew import lookup_join
from folioforge.schemas import FACT
from folioforge.session import work_path
from folioforge.sinks import tables as sinks

SCHEMA = "id string, trade_dt date, amount double, load_no int, trade_yyyymm string"
KEYS = ["id", "trade_yyyymm"]


def trades(spark, load_no, *days, amount=1.0, first=0):
    data = [(f"T{first + i}", d, amount, load_no, d.strftime("%Y%m")) for i, d in enumerate(days)]
    return spark.createDataFrame(data, SCHEMA)


def month(m, n):
    return [date(2026, m, 1 + i % 28) for i in range(n)]


@pytest.fixture
def table(spark):
    path = work_path(spark, "trades")
    sinks.replace_months(trades(spark, 1, *month(1, 200)), path, "trade_yyyymm")
    return path


def counts(spark, path):
    return {r.trade_yyyymm: r["count"] for r in spark.read.parquet(path).groupBy("trade_yyyymm").count().collect()}


def late_batch(spark):
    january = trades(spark, 2, *month(1, 20), amount=2.0, first=190)
    return january.union(trades(spark, 2, *month(2, 180)))


def test_late_arrivals_as_replacement(spark, table):
    sinks.replace_months(late_batch(spark), table, "trade_yyyymm")
    assert counts(spark, table) == {"202601": 20, "202602": 180}


def test_late_arrivals_as_corrections(spark, table):
    sinks.upsert_months(late_batch(spark), table, "trade_yyyymm", KEYS, ["load_no"])
    assert counts(spark, table) == {"202601": 210, "202602": 180}
    corrected = spark.read.parquet(table).where("trade_yyyymm = '202601' and amount = 2.0")
    assert corrected.count() == 20


def test_correction_of_an_earlier_month_leaves_others_alone(spark, table):
    sinks.upsert_months(trades(spark, 2, *month(2, 30)), table, "trade_yyyymm", KEYS, ["load_no"])
    sinks.upsert_months(trades(spark, 3, *month(1, 50), amount=9.0), table, "trade_yyyymm", KEYS, ["load_no"])
    assert counts(spark, table) == {"202601": 200, "202602": 30}
    assert spark.read.parquet(table).where("amount = 9.0").count() == 50


def test_backfill_of_six_months(spark, table):
    days = [date(2025 + (10 + k) // 12, (10 + k) % 12 + 1, 5) for k in range(6)]
    sinks.upsert_months(trades(spark, 2, *days, first=1000), table, "trade_yyyymm", KEYS, ["load_no"])
    assert counts(spark, table) == {"202511": 1, "202512": 1, "202601": 201, "202602": 1, "202603": 1, "202604": 1}


def test_old_rows_are_not_compared_with_each_other(spark, tmp_path):
    path = str(tmp_path / "shared")
    twins = trades(spark, 1, *month(1, 2)).union(trades(spark, 1, *month(1, 1), amount=7.0))
    elsewhere = trades(spark, 1, *month(2, 2)).union(trades(spark, 1, *month(2, 1), amount=7.0))
    sinks.replace_months(twins.union(elsewhere), path, "trade_yyyymm")
    sinks.upsert_months(trades(spark, 2, *month(1, 1), first=5000), path, "trade_yyyymm", KEYS, ["load_no"])
    assert counts(spark, path) == {"202601": 4, "202602": 3}


def test_rows_that_share_a_key_in_one_batch(spark, table):
    twice = trades(spark, 2, *month(1, 1), amount=1.0).union(trades(spark, 3, *month(1, 1), amount=2.0))
    sinks.upsert_months(twice, table, "trade_yyyymm", KEYS, ["load_no"])
    assert counts(spark, table) == {"202601": 200}
    assert spark.read.parquet(table).where("load_no = 3 and amount = 2.0").count() == 1
    name = "first_batch_of_facts"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.save_corrections(twice, name, "trade_yyyymm", KEYS, ["load_no"])
    assert [r.load_no for r in spark.table(name).collect()] == [3]
    spark.sql(f"DROP TABLE {name}")


def test_empty_batch_changes_nothing(spark, table):
    nothing = trades(spark, 2, *month(1, 1)).where("false")
    sinks.replace_months(nothing, table, "trade_yyyymm")
    sinks.upsert_months(nothing, table, "trade_yyyymm", KEYS, ["load_no"])
    assert counts(spark, table) == {"202601": 200}


def test_replaying_batches_leaves_the_last_owner_of_a_month(spark, rows):
    df = spark.createDataFrame([("202601", "b1"), ("202601", "b2"), ("202602", "b2"), ("202603", "b3")],
                               "m string, b string")
    assert rows(facts.replayed(df, "m", "b")) == [("202601", "b2"), ("202602", "b2"), ("202603", "b3")]
    assert rows(facts.affected_months(df.union(spark.createDataFrame([(None, "b3")], df.schema)), "m")) == [
        ("202601",), ("202602",), ("202603",)]


def test_build_fact_keeps_rows_without_dimension_and_bad_numbers_become_null(spark):
    raw = spark.createDataFrame(
        [("p1", "P1", "I1", "USD", "FEED", "2026-01-05", "5", "2.5", "12.5", "x", "202601"),
         ("p2", "P9", "I1", "USD", "FEED", "not a date", "5", "2.5", "12.5", "0", "202601")],
        "position_id string, portfolio_id string, instrument_id string, currency_code string, "
        "source_system_code string, position_dt string, quantity string, end_of_day_price string, "
        "market_value string, unrealized_pnl string, source_yyyymm string",
    )

    def reference(key, sk, value):
        return spark.createDataFrame([(value, 7)], f"{key} string, {sk} long")

    references = {
        "dim_portfolio": reference("portfolio_id", "portfolio_sk", "P1"),
        "dim_instrument": reference("instrument_id", "instrument_sk", "I1"),
        "dim_currency": reference("currency_code", "currency_sk", "USD"),
        "dim_market_data_source": reference("source_system_code", "market_data_source_sk", "FEED"),
    }
    fact = facts.build_fact(raw, FACT["fact_positions_daily"], references, "2026-02-01 00:00:00")
    found = {r.position_id: r for r in fact.collect()}
    assert found["p1"].portfolio_sk == 7 and found["p1"].unrealized_pnl is None
    assert found["p1"].position_yyyymm == "202601" and found["p1"].market_value == 12.5
    assert found["p2"].portfolio_sk is None and found["p2"].position_dt is None
    assert valid_at(fact, "2026-01-05 23:59:59").count() == 1
    assert valid_at(fact, "2026-01-06 00:00:00").count() == 0


def test_schema_guard(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS guard")
    trades(spark, 1, *month(1, 2)).write.mode("overwrite").saveAsTable("guard.t")
    sinks.check_schema(trades(spark, 1, *month(1, 1)), "guard.t")
    with pytest.raises(ValueError, match="amount: missing"):
        sinks.check_schema(trades(spark, 1, *month(1, 1)).drop("amount"), "guard.t")
    sinks.add_columns(spark, "guard.t", [("broker_id", "string", "routing"), ("broker_sk", "bigint", "key")])
    sinks.comment_column(spark, "guard.t", "amount", "audited")
    sinks.set_properties(spark, "guard.t", {"data_classification": "CONFIDENTIAL"})
    assert spark.table("guard.t").where("broker_id is null").count() == 2
    sinks.copy_without(spark, "guard.t", "guard.t_v2", ["amount"])
    assert "amount" not in spark.table("guard.t_v2").columns
    sinks.save_first(trades(spark, 1, *month(1, 9)), "guard.t_v2")
    assert spark.table("guard.t_v2").count() == 2


def test_plain_writers(spark, rows):
    path = work_path(spark, "plain")
    sinks.append(trades(spark, 1, date(2026, 1, 1)), path)
    sinks.append(trades(spark, 1, date(2026, 2, 1), first=1), path)
    assert spark.read.parquet(path).count() == 2
    sinks.rebuild(trades(spark, 2, date(2026, 3, 1)), path)
    sinks.publish_view(spark.read.parquet(path), "plain_trades")
    assert rows(spark.sql("SELECT trade_yyyymm, count(*) FROM plain_trades GROUP BY ALL")) == [("202603", 1)]


def test_raw_table_takes_new_columns(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS guard")
    schema = "a string, source_yyyymm string"
    sinks.save_raw(spark.createDataFrame([("x", "202601")], schema), "guard.raw", "source_yyyymm")
    wider = spark.createDataFrame([("y", "new", "202602")], "a string, b string, source_yyyymm string")
    sinks.save_raw(wider, "guard.raw", "source_yyyymm")
    sinks.save_raw(spark.createDataFrame([("z", "202602")], schema), "guard.raw", "source_yyyymm")
    assert rows(spark.table("guard.raw"), "a", "b", "source_yyyymm") == [
        ("x", None, "202601"), ("z", None, "202602")]
    sinks.save_append(spark.table("guard.raw"), "guard.raw_copy")
    sinks.save_append(spark.table("guard.raw"), "guard.raw_copy")
    assert spark.table("guard.raw_copy").count() == 4


def test_log_keeps_every_answer(spark, rows):
    def load(table, moment, batch, replace=False):
        df = spark.createDataFrame([(*r, "s") for r in batch], "k string, m string, v long, source_yyyymm string")
        df = stamp(df.withColumn("d", F.lit("2026-01-01").cast("date")), "d", moment).drop("d")
        sinks.save_versions(df, table, "m", ["k", "m"], ["system_from_ts", "source_yyyymm"], moment, replace)
        spark.catalog.refreshTable(table)

    def known(table, moment):
        return rows(facts.facts_known_at(spark.table(table), ["k", "m"], moment), "k", "m", "v")

    spark.sql("CREATE DATABASE IF NOT EXISTS logs")
    t = "logs.fact_versions"
    load(t, "2026-02-01 00:00:00", [("a", "1", 1), ("b", "1", 2), ("c", "2", 3)])
    load(t, "2026-03-01 00:00:00", [("a", "1", 10), ("b", "1", 2), ("d", "1", 4)])
    load(t, "2026-04-01 00:00:00", [("a", "1", 10)], replace=True)
    first = [("a", "1", 1), ("b", "1", 2), ("c", "2", 3)]
    second = [("a", "1", 10), ("b", "1", 2), ("c", "2", 3), ("d", "1", 4)]
    third = [("a", "1", 10), ("c", "2", 3)]
    answers = {"2026-01-15": [], "2026-02-01": first, "2026-02-15": first, "2026-03-15": second, "2026-05-01": third}
    assert {m: known(t, m + " 00:00:00") for m in answers} == answers
    # unchanged rows make no version
    assert spark.table(t).count() == 3 + 2 + 2
    # the second load again, then with another content
    load(t, "2026-03-01 00:00:00", [("a", "1", 10), ("b", "1", 2), ("d", "1", 4)])
    assert {m: known(t, m + " 00:00:00") for m in answers} == answers and spark.table(t).count() == 7
    sinks.compact_months(spark, t, "m", ["1", "2"])
    spark.catalog.refreshTable(t)
    assert {m: known(t, m + " 00:00:00") for m in answers} == answers and spark.table(t).count() == 7
    load(t, "2026-05-01 00:00:00", [("b", "1", 7)])
    assert known(t, "2026-06-01 00:00:00") == [("a", "1", 10), ("b", "1", 7), ("c", "2", 3)]
    assert known(t, "2026-04-15 00:00:00") == third


def test_rows_without_a_key_are_spread(spark, rows):
    facts_ = spark.range(4000).select(
        F.concat(F.lit("F"), "id").alias("row"), F.when(F.col("id") % 100 == 0, F.concat(F.lit("K"), F.col("id") % 300)).alias("k"))
    reference = spark.createDataFrame([("K0", 1), ("K100", 2), (None, 3)], "k string, sk long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup_join(facts_, reference, "k", "row")
        assert joined.columns == ["row", "k", "sk"]
        assert rows(joined.groupBy("k", "sk").count()) == rows(facts_.join(reference, "k", "left").groupBy("k", "sk").count())
        placed = joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(placed) == 8 and max(r["count"] for r in placed) < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_corrections_stage_only_old_rows_that_stay(spark, table, monkeypatch):
    staged = {}
    plain = sinks.materialize

    def counting(df, label):
        written = plain(df, label)
        staged[label] = written.count()
        return written

    monkeypatch.setattr(sinks, "materialize", counting)
    sinks.upsert_months(late_batch(spark), table, "trade_yyyymm", KEYS, ["load_no"])
    assert staged == {"arrived": 200, "upsert": 190}
    assert counts(spark, table) == {"202601": 210, "202602": 180}
