import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import passage_repeats as pr
from folioforge.llm.plans import LLM_QUERIES


def reference(docs):
    """Every window of every document in a dictionary of first documents."""
    split = [(LAST if k is None else k, k, (t or "").encode().split()) for k, t in docs]
    first = {}
    for order, _, words in split:
        for i in range(len(words) - 49):
            window = tuple(words[i : i + 50])
            first[window] = min(first.get(window, LAST), order)
    out = []
    for order, key, words in split:
        gone = set()
        for i in range(len(words) - 49):
            if first[tuple(words[i : i + 50])] < order:
                gone.update(range(i, i + 50))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((key, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


LAST = pr.LAST


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_against_plain_search(spark, table, folder):
    path = f"/root/testdata/{folder}"
    docs = [(d["doc_id"], d["text"]) for d in table(spark, "documents", path)]
    found = result(LLM_QUERIES["op12_passage_repeats"](spark, path))
    assert found == reference(docs)
    assert sum(r[2] for r in found) > 0


@pytest.mark.parametrize("step", [pr.STEP, 7])
def test_passages_with_other_surroundings(spark, monkeypatch, step):
    monkeypatch.setattr(pr, "STEP", step)
    rng = random.Random(5)

    def noise(n):
        return [f"w{rng.randrange(10_000)}" for _ in range(n)]

    long, short, third = noise(130), noise(49), noise(60)
    texts = [
        noise(40) + long + noise(40),
        noise(3) + long[:70] + third,
        third + noise(9),
        long[20:75] + third[5:],
        short + noise(4),
        noise(4) + short,
        ["a"] * 200,
        ["a"] * 120 + ["b"],
        long + long,
        long[:49],
        long[:50],
        noise(30) + long[40:90] + noise(1) + long[80:130],
        [],
    ]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(None, " ".join(long)), (None, " ".join(third)), (3, " ".join(noise(80))), (20, None)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(pr.without_repeats(df)) == reference(docs)


def test_windows_that_only_later_documents_share(spark):
    # all share one gram with the leader; what lies around it agrees between others only
    rng = random.Random(6)
    gram = [f"g{i}" for i in range(25)]
    sides = [[f"s{rng.randrange(9999)}" for _ in range(30)] for _ in range(4)]
    texts = [a + gram + b for a in sides for b in sides] * 2
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(pr.without_repeats(df)) == reference(docs)


def test_odd_rows(odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert result(pr.without_repeats(odd_docs)) == reference(docs)
    assert pr.without_repeats(no_docs).count() == 0


def test_spans_and_text(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, passage), (2, "x " + passage + "\n y")], "doc_id long, text string")
    spans = pr.repeated_spans(df)
    cut = df.join(spans.withColumnRenamed("doc", "doc_id"), "doc_id", "left").select("doc_id", pr.kept_text(F.col("text"), F.col("spans")).alias("t"))
    assert {r["doc_id"]: r["t"] for r in cut.collect()} == {1: passage, 2: "x y"}


def test_rolling_hash_of_ranges():
    h = pr.WordHashes().of([b"a", b"b", b"c", b"a", b"b", b"c"])
    rolling = pr.Rolling(h)
    assert rolling.spans(np.array([0]), np.array([3])) == rolling.spans(np.array([3]), np.array([6]))
    assert rolling.every(2)[0] == rolling.every(2)[3] != rolling.every(2)[1]
