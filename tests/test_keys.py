"""Surrogate keys, survivorship, version chains and skewed joins against plain Python."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from folioforge.operators import keys, skew


def test_surrogate_keys_follow_the_order(spark):
    names = [f"K{i}" for i in random.Random(1).sample(range(100000), 5000)]
    df = spark.createDataFrame([(n,) for n in names], "k string").repartition(6)
    found = {r.k: r.sk for r in keys.add_surrogate_key(df, ["k"], "sk").collect()}
    assert found == {k: i for i, k in enumerate(sorted(names), 1)}


def test_surrogate_keys_continue_after_the_highest(spark, rows):
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    assert rows(keys.add_surrogate_key(df, ["k"], "sk", F.lit(40))) == [("a", 41), ("b", 42)]
    empty = df.where("k = 'z'")
    assert keys.add_surrogate_key(empty, ["k"], "sk").count() == 0


def test_latest_per_key_is_the_same_on_every_run(spark, rows):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None), ("b", None, "w")]
    df = spark.createDataFrame(data, "k string, v int, t string")
    expected = [("a", 2, "z"), ("b", 1, None)]
    assert rows(keys.latest_per_key(df, ["k"], ["v"])) == expected
    assert rows(keys.latest_per_key(df.repartition(5), ["k"], ["v"])) == expected


def test_version_chain_with_a_hot_key(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", start + timedelta(minutes=rng.randrange(90000)), i)
            for i in range(3000)]
    df = spark.createDataFrame(data, "k string, at timestamp, id long")
    chained = keys.version_chain(df, ["k"], ["at", "id"], F.date_trunc("day", "at"))
    found = {r.id: (r.version_no, r.next_from) for r in chained.collect()}
    by_key = defaultdict(list)
    for k, at, i in data:
        by_key[k].append((at, i))
    expected = {}
    for versions in by_key.values():
        versions.sort()
        for n, (_, i) in enumerate(versions):
            expected[i] = (n + 1, versions[n + 1][0] if n + 1 < len(versions) else None)
    assert found == expected


def test_salted_join_equals_a_plain_join(spark, rows):
    rng = random.Random(5)
    left = [("hot" if i % 3 == 0 else f"k{rng.randrange(3000)}", i) for i in range(4000)] + [(None, -1)]
    large = spark.createDataFrame(left, "k string, v long")
    small = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(2000)], "k string, w long")
    hot = {r.k: r._salts for r in skew.hot_keys(large, "k", min_rows=100).collect()}
    assert set(hot) == {"hot"} and hot["hot"] > 300
    for how in ("inner", "left"):
        salted = skew.salted_join(large, small, "k", how, min_rows=100)
        assert rows(salted, "k", "v", "w") == rows(large.join(small, "k", how), "k", "v", "w")
    spread = skew.hot_keys(large, "k", min_rows=10**9)
    assert spread.count() == 0
