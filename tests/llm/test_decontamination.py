import random

import numpy as np
import pytest

from folioforge.llm import decontamination as dc
from folioforge.llm.plans import LLM_QUERIES


def distance(item, text):
    """Least edit distance of ``item`` to a part of ``text``, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at : at + (kind != 0)] = [] if kind == 1 else [f"other{rng.randrange(999)}"]
    return words


@pytest.fixture(scope="module")
def items(table, spark):
    return [(d["item_id"], d["text"]) for d in table(spark, "benchmark")]


def test_query_against_all_alignments(spark, table, items):
    got = LLM_QUERIES["op2_benchmark_leaks"](spark, "/root/testdata/sf0.001").collect()
    want = {}
    for d in table(spark, "documents"):
        words = dc.tokens(d["text"])
        have = set(words)
        for i, text in items:
            item = dc.tokens(text)
            # at most the allowed number of the item's words can be missing
            if sum(w not in have for w in item) <= dc.allowed(len(item)):
                if (n := distance(item, words)) <= dc.allowed(len(item)):
                    want[d["doc_id"], i] = n
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in got}
    assert {k for k, n in want.items() if n == 0} <= set(found) <= set(want)
    assert all(want[k] == n for k, n in found.items()) and len(found) >= 0.9 * len(want)


def test_recall_at_the_largest_number_of_edits(table, spark, items):
    rng, index, hits = random.Random(4), dc.Index(items), 0
    filler = [d["text"].split()[:200] for d in table(spark, "documents") if d["text"]]
    cases = []
    for i, text in items:
        for _ in range(5):
            words = dc.tokens(text)
            words = edited(rng, words, dc.allowed(len(words)))
            host = list(rng.choice(filler))
            at = rng.randrange(len(host) + 1)
            cases.append((i, " ".join(host[:at] + words + host[at:])))
    for (i, _), leaks in zip(cases, index.leaks([t for _, t in cases]), strict=True):
        hits += any(x[0] == i for x in leaks)
    assert hits >= 0.9 * len(cases)


def test_alignment_equals_cell_by_cell():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        assert dc.best_alignment(np.array(a), np.array(b))[0] == distance(a, b)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, None), (2, ""), (None, "alpha1 beta1 alpha2 beta2"), (3, "too short"), (4, "alpha3 beta3 alpha4 beta4 alpha5 beta5 alpha6 beta6")]
    benchmark = spark.createDataFrame([*rows, (5, rows[-1][1])], "item_id long, text string")
    got = dc.find_leaks(odd_docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == sorted((d, i, 0) for d in (5, 6, 6) for i in (4, 5))
    kept = dc.drop_leaking(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert dc.find_leaks(no_docs, benchmark).count() == 0
    assert dc.find_leaks(odd_docs, benchmark.limit(0)).count() == 0 and dc.drop_leaking(odd_docs, benchmark.limit(0)).count() == odd_docs.count()


def test_blocks_give_the_same(spark, items, monkeypatch):
    docs = spark.createDataFrame([(1, items[0][1] + " " + items[5][1]), (2, "nothing")], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.find_leaks(docs, benchmark).collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 3000)
    assert sorted(map(tuple, dc.find_leaks(docs, benchmark).collect())) == whole and len(whole) >= 2


def test_short_items_are_found_verbatim():
    rng = random.Random(8)
    words = [f"w{n}" for n in range(300)]
    items = [(n, " ".join(rng.choice(words) for _ in range(1 + n % 7))) for n in range(140)]
    items += [(200, items[3][1]), (201, "?!"), (202, None)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(200)]
    texts += [f"{a} {i}, {b}" for (_, i), a, b in zip(items, texts, reversed(texts), strict=False)] + ["", None]
    got = {(t, i): (e, end) for t, leaks in enumerate(dc.Index(items).leaks(texts)) for i, e, _, end in leaks}
    want = {}
    for t, text in enumerate(texts):
        have = dc.tokens(text)
        for i, item in items:
            own = dc.tokens(item)
            ends = [p + len(own) for p in range(len(have) - len(own) + 1) if own and have[p : p + len(own)] == own]
            if ends:
                want[t, i] = ends[0]
    short = {i for i, item in items if dc.allowed(len(dc.tokens(item))) == 0}
    assert {k: end for k, (_, end) in got.items() if k[1] in short} == {k: e for k, e in want.items() if k[1] in short}
    assert set(want) <= set(got) and all(got[k][0] == 0 for k in want)


def test_recall_of_long_items():
    """Items of 100 to 1,000 words with as many edits as allowed, between other words of the same kind."""
    rng = random.Random(12)
    words = [f"w{n}" for n in range(2000)]
    items = [(n, " ".join(rng.choice(words) for _ in range(size))) for n, size in enumerate([100, 250, 500, 1000] * 5)]
    texts, where = [], []
    for i, text in items:
        for _ in range(5):
            own = dc.tokens(text)
            own = edited(rng, own, dc.allowed(len(own)))
            around = [rng.choice(words) for _ in range(400)]
            texts.append(" ".join(around[:200] + own + around[200:]))
            where.append(i)
    index = dc.Index(items)
    leaks = index.leaks(texts)
    assert sum(any(x[0] == i for x in found) for i, found in zip(where, leaks, strict=True)) >= 0.95 * len(texts)
    for text, found in list(zip(texts, leaks, strict=True))[::20]:
        for i, edits, _, _ in found:
            assert edits == distance(dc.tokens(items[i][1]), dc.tokens(text))
    assert index.longest < 2 * dc.PIECE
    assert not any(index.leaks([" ".join(rng.choice(words) for _ in range(3000))]))
