import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from folioforge.llm import prefix_trie as pt
from folioforge.llm.plans import LLM_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def reference(rows):
    """The trie as dictionaries over whole sequences."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saved + sum(saved[x] for x in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_against_dictionaries(spark, table, folder):
    path = f"/root/testdata/{folder}"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, "conversations", path)]
    assert result(LLM_QUERIES["op11_prefix_trie"](spark, path)) == reference(rows)


@pytest.fixture
def bushy():
    """Few different turns, so that prefixes are shared at all depths; one very long conversation."""
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 60), *range(100, 130), 205, 206, 399, 12345]:
        size = 300 if conv == 12 else rng.randrange(1, 9)
        for turn in range(size):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["", "é", "long text " * 9])))
    rows += [(conv, turn, "user", "x") for conv in (700, 701, 702, 703, 800, 900) for turn in range(2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", ["8", "61"])
def test_shared_prefixes(spark, bushy, partitions):
    names = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": str(partitions == "8").lower()}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        assert result(pt.trie(spark.createDataFrame(bushy, SCHEMA))) == reference(bushy)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_a_collision_is_seen_and_mended(spark, bushy, monkeypatch):
    tried = []

    def weak(attempt):
        tried.append(attempt)
        return [1] * pt.LANES if attempt == 0 else real(attempt)

    real = pt.bases
    monkeypatch.setattr(pt, "bases", weak)
    # a base of 1 takes sequences for bags
    rows = bushy + [(2000, 0, "user", "p"), (2000, 1, "user", "q"), (2001, 0, "user", "q"), (2001, 1, "user", "p")]
    rows += [(2000, t, "user", "r") for t in range(2, 9)] + [(2001, t, "user", "r") for t in range(2, 9)]
    assert result(pt.trie(spark.createDataFrame(rows, SCHEMA))) == reference(rows)
    assert max(tried) >= 1


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (None, 0, "user", "x"), (2, 5, "user", "a"), (2, 5, "user", "a"),
        (2, -3, "system", "y" * 200_000), (100, 0, None, "z"), (101, 0, "user", "z"), (103, None, None, None),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", depth string, conv long")
    assert result(pt.trie(df)) == reference(rows)
    assert pt.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stored_turn_is_the_last_turn_of_the_node(spark):
    rows = [(c, t, "user", f"t{t}" if t < 2 else f"c{c}") for c in (0, 1, 2, 3) for t in range(4)]
    texts = {(c, t + 1): x for c, t, _, x in rows}
    for r in pt.trie(spark.createDataFrame(rows, SCHEMA)).filter("depth > 0").collect():
        assert texts[r["turn_conv"], r["turn_pos"]].startswith("t" if r["turn_pos"] <= 2 else "c")
