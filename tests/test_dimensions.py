"""Type-2 history over several loads, as properties and against plain Python."""

import random
from datetime import date, datetime

import pytest

from folioforge.functions.temporal import as_of, known_at
from folioforge.operators import dimensions, facts
from folioforge.session import materialize

LOADS = ["2026-01-01 00:00:00", "2026-01-01 12:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"]
SCHEMA = "id string, name string, policy string"


def load_all(spark, snapshots):
    log = None
    for snapshot, at in zip(snapshots, LOADS):
        df = spark.createDataFrame(snapshot, SCHEMA)
        added = materialize(dimensions.new_versions(df, log, "id", "sk", ["name", "policy"], at), "added")
        log = added if log is None else materialize(log.unionByName(added), "log")
    return log


@pytest.fixture(scope="module")
def snapshots():
    rng = random.Random(11)
    return [
        [(f"P{i}", f"Name {i}", rng.choice(["LOW", "HIGH", None])) for i in range(60) if rng.random() < 0.8]
        for _ in LOADS
    ]


@pytest.fixture(scope="module")
def dimension(spark, snapshots):
    return materialize(dimensions.dimension_view(load_all(spark, snapshots), "id"), "dim")


def test_versions_match_a_plain_replay(dimension, snapshots):
    expected, current = {}, {}
    for snapshot, at in zip(snapshots, LOADS):
        for key, name, policy in snapshot:
            if current.get(key, ("", ""))[1] != (name, policy):
                version = current.get(key, (0, None))[0] + 1
                current[key] = (version, (name, policy))
                expected[key, version] = (policy, datetime.fromisoformat(at))
    found = {(r.id, r.record_version): (r.policy, r.system_from_ts) for r in dimension.collect()}
    assert found == expected


def test_one_current_row_and_contiguous_intervals(dimension):
    by_key = {}
    for r in dimension.collect():
        by_key.setdefault(r.id, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.record_version)
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        assert [r.change_type for r in versions[:-1]] == ["EXPIRE"] * (len(versions) - 1)
        for a, b in zip(versions, versions[1:]):
            assert a.system_to_ts == b.system_from_ts and a.valid_to_ts == b.valid_from_ts
        for r in versions:
            assert r.effective_to_dt >= r.effective_from_dt
        assert versions[-1].effective_to_dt == date(9999, 12, 31)


def test_surrogate_keys_are_unique_and_dense(dimension):
    sks = sorted(r.sk for r in dimension.select("sk").collect())
    assert sks == list(range(1, len(sks) + 1))


def test_replaying_a_snapshot_adds_nothing(spark):
    first = [("a", "A", None), ("b", "B", "LOW")]
    log = load_all(spark, [first])
    again = dimensions.new_versions(
        spark.createDataFrame(first, SCHEMA), log, "id", "sk", ["name", "policy"], LOADS[1]
    )
    assert again.count() == 0


def test_null_is_not_the_empty_text_and_repeated_keys_collapse(spark):
    log = load_all(spark, [[("a", "A", None), ("a", "A", None)], [("a", "A", ""), ("a", "A", "")]])
    assert sorted((r.record_version, r.policy) for r in log.collect()) == [(1, None), (2, "")]


def test_static_dimension_and_reference(spark, rows):
    codes = spark.createDataFrame([("USD", "x"), ("EUR", "y"), ("EUR", "y")], "code string, name string")
    static = dimensions.static_dimension(codes, "code", "sk", "2026-01-01 00:00:00")
    assert rows(static, "code", "sk", "attribute_hash") == [("EUR", 1, None), ("USD", 2, None)]
    assert rows(dimensions.current_reference(static, "code", "sk")) == [("EUR", 1), ("USD", 2)]


def test_calendar(spark):
    bounds = spark.sql("select date'2024-02-27' first_dt, date'2024-03-02' last_dt")
    days = {r.date_sk: r for r in dimensions.calendar(bounds, "2026-01-01 00:00:00").collect()}
    assert sorted(days) == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert days[20240229].is_month_end and not days[20240228].is_month_end
    assert days[20240301].is_business_day and not days[20240302].is_business_day


def test_join_as_of_and_backfill(spark, rows):
    snapshots = spark.createDataFrame(
        [("p", datetime(2026, 1, d), v) for d, v in ((1, "A"), (2, "A"), (5, "B"), (9, "A"))],
        "pid string, system_from_ts timestamp, policy string",
    )
    history = dimensions.history_of_snapshots(snapshots, "pid", ["policy"]).drop("attribute_hash")
    assert rows(history, "record_version", "policy") == [(1, "A"), (2, "B"), (3, "A")]
    trades = spark.createDataFrame(
        [("p", datetime(2025, 12, 31)), ("p", datetime(2026, 1, 4)), ("p", datetime(2026, 1, 5)),
         ("p", datetime(2027, 1, 1)), ("q", datetime(2026, 1, 5))], "pid string, at timestamp")
    joined = dimensions.join_as_of(trades, history, "pid", trades["at"])
    assert rows(joined, "pid", "at", "version.policy") == sorted(
        [("p", datetime(2025, 12, 31), None), ("p", datetime(2026, 1, 4), "A"), ("p", datetime(2026, 1, 5), "B"),
         ("p", datetime(2027, 1, 1), "A"), ("q", datetime(2026, 1, 5), None)], key=repr)


def test_a_correction_leaves_the_earlier_answer_alone(spark):
    trades = spark.createDataFrame(
        [("t1", date(2026, 1, 5), date(2026, 1, 6), 100.0), ("t1", date(2026, 1, 5), date(2026, 2, 10), 120.0)],
        "id string, trade_dt date, recorded date, amount double",
    )
    history = facts.restate(
        facts.system_stamp(trades, "trade_dt", "recorded"), ["id"], ["system_from_ts", "amount"]
    )

    def amount(system_ts):
        return [r.amount for r in as_of(history, "2026-01-31 00:00:00", system_ts).collect()]

    assert amount("2026-02-01 00:00:00") == [100.0]
    assert amount("2026-02-10 00:00:00") == [120.0]
    assert amount("2026-01-05 00:00:00") == []
    assert known_at(history, "2026-03-01 00:00:00").count() == 1
    assert as_of(history, "2026-01-04 00:00:00", "2026-03-01 00:00:00").count() == 0
