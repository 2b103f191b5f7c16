import random

from pyspark.sql import functions as F

from folioforge.llm import near_duplicates as nd
from folioforge.llm.plans import LLM_QUERIES


def shingles(text, size):
    ws = (text or "").encode().lower().split()
    if not ws:
        return frozenset()
    return frozenset([tuple(ws)]) if len(ws) < size else frozenset(zip(*[ws[i:] for i in range(size)]))


def reference(docs, size, percent):
    """Component by comparing all pairs of sets."""
    sets = [(d, shingles(t, size)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(s), least[find(i)]) for i, (d, s) in enumerate(sets)}


def family(rng, base, copies, most):
    out = []
    for _ in range(copies):
        ws = list(base)
        for _ in range(rng.randint(0, most)):
            ws[rng.randrange(len(ws))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(ws))
    return out


def test_query_equals_all_pairs(spark, table):
    docs = table(spark, "documents")
    want = reference([(d["doc_id"], d["text"]) for d in docs], 3, 85)
    got = LLM_QUERIES["op4_near_duplicates"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_group_of_near_copies_of_all_distances(spark):
    rng = random.Random(3)
    texts = family(rng, [f"w{rng.randrange(900)}" for _ in range(150)], 150, 14)
    texts += family(rng, [f"v{rng.randrange(900)}" for _ in range(60)], 40, 6) + [texts[3].upper(), texts[3]]
    docs = list(enumerate(texts))
    want = reference(docs, 3, 85)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = nd.near_duplicates(df, size=3, percent=85).collect()
    assert {r["doc"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert 10 < len({c for _, c in want.values()}) < len(texts)


def test_index_finds_all_signatures_in_reach(spark):
    rng = random.Random(5)
    base = [[rng.randrange(1 << 16) for _ in range(32)] for _ in range(40)]
    pairs = []
    for lanes in base:
        other = list(lanes)
        for i in rng.sample(range(32), 15):
            other[i] ^= 1 + rng.randrange(1000)
        pairs.append((lanes, other))

    def chunks(lanes):
        return [nd._signed(sum(v << (16 * j) for j, v in enumerate(lanes[4 * i : 4 * i + 4]))) for i in range(8)]

    rows = [(*chunks(a), *chunks(b)) for a, b in pairs]
    names = [f"a{i}" for i in range(8)] + [f"b{i}" for i in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    a, b = ([F.col(f"{s}{i}") for i in range(8)] for s in "ab")
    got = df.select(F.arrays_overlap(nd.index_keys(a), nd.index_keys(b)).alias("met"), nd.lane_distance(a, b).alias("d"))
    assert {(r["met"], r["d"]) for r in got.collect()} == {(True, 15)}


def test_chains_have_one_label(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 3)]
    got = {r["node"]: r["label"] for r in nd.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_odd_rows(spark, odd_docs, no_docs):
    got = nd.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc"]: r for r in got}
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[7]["n_shingles"] == 1
    assert by[6]["component_id"] == 5 and by[4]["component_id"] == 4
    kept = nd.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None) for r in kept.collect()) == [
        (False, 1, True), (False, 2, False), (False, 3, False), (False, 4, False), (False, 5, False), (False, 7, False),
        (True, 0, False), (True, 0, True),
    ]
    assert nd.near_duplicates(no_docs).count() == 0 and nd.keep_one(no_docs).count() == 0
