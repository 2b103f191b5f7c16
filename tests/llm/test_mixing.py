import pytest
from pyspark.sql import functions as F

from folioforge.llm import mixing as mx
from folioforge.llm.plans import LLM_QUERIES

POSTERIORS = "row long, tokens long, copies long, p_clean double, p_noisy double, p_toxic double"


def totals(df, rate):
    parts = [F.sum(F.col("tokens") * F.col("copies") * rate * F.col(f"p_{d}")) for d in mx.DOMAINS]
    return list(df.agg(*parts).first())


def test_targets_are_met_with_soft_members(spark):
    rows = [(i, 100 + i, 1 + i % 2, *p) for i, p in enumerate([(1.0, 0.0, 0.0), (0.75, 0.25, 0.0), (0.25, 0.25, 0.5), (0.0, 1.0, 0.0), (0.125, 0.0, 0.875)] * 40)]
    df = spark.createDataFrame(rows, POSTERIORS)
    everything = sum(r[1] * r[2] for r in rows)
    rate = mx.fit(df, {"clean": 0.6, "noisy": 0.3, "toxic": 0.1}, 0.5)
    got = totals(df, rate)
    assert got == pytest.approx([everything * 0.5 * w for w in (0.6, 0.3, 0.1)], abs=2 * mx.CLOSE * everything)
    assert df.filter(rate < 0).count() == 0


def test_least_squares_where_targets_cannot_be_met(spark):
    import numpy as np

    rows = [(0, 100, 1, 0.5, 0.25, 0.25), (1, 300, 1, 0.75, 0.25, 0.0)]
    df = spark.createDataFrame(rows, POSTERIORS)
    rate = mx.fit(df, {"clean": 0.2, "noisy": 0.2, "toxic": 0.6}, 0.5)
    got = np.array(totals(df, rate))
    mass, goal = np.array(totals(df, F.lit(1.0))), 200 * np.array([0.2, 0.2, 0.6])

    def loss(x):
        return float((((x - goal) ** 2) / mass).sum())

    a = np.array([[100 * 0.5, 100 * 0.25, 100 * 0.25], [300 * 0.75, 300 * 0.25, 0.0]])
    best = min(loss(x * a[0] + y * a[1]) for x in np.linspace(0, 6, 301) for y in np.linspace(0, 3, 301))
    assert loss(got) <= best * 1.05 + 1


def test_classifier_and_query(spark, table):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in LLM_QUERIES["op10_soft_mixing"](spark, folder).collect()}
    docs, known = table(spark, "documents", folder), table(spark, "labels", folder)
    assert len(rows) == len(docs)
    toxic = [rows[x["doc_id"]]["p_toxic"] for x in known if x["toxic"] == 1]
    clean = [rows[x["doc_id"]]["p_toxic"] for x in known if x["toxic"] == 0 and x["quality"] == 1]
    assert sum(p > 0.5 for p in toxic) > 0.6 * len(toxic) and sum(p > 0.5 for p in clean) < 0.05 * len(clean)
    assert all(r["rate"] >= 0 and abs(r["p_clean"] + r["p_noisy"] + r["p_toxic"] - 1) < 1e-9 for r in rows.values())
    words = {d["doc_id"]: len((d["text"] or "").split()) for d in docs}
    assert all(abs(r["tokens"] - words[k]) <= words[k] * 0.01 for k, r in rows.items())


def test_odd_rows(spark, odd_docs, no_docs, labels):
    rates = mx.mix(odd_docs, labels, shares={"clean": 1.0, "noisy": 1.0, "toxic": 1.0}, most=1.0)
    assert rates.count() == 9 and rates.filter("rate < 0.999").count() == 0  # two rows are equal
    kept = mx.sample(odd_docs, rates)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    none = mx.mix(odd_docs, labels.limit(0), shares={"clean": 0.0, "noisy": 0.0, "toxic": 0.0}, most=1.0)
    assert mx.sample(odd_docs, none).count() == 0
    assert mx.mix(no_docs, labels, weights={"clean": 1.0, "noisy": 0.0, "toxic": 0.0}).count() == 0


def test_posteriors_of_labelled_documents_add_up_to_their_labels(spark, table):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in LLM_QUERIES["op10_soft_mixing"](spark, folder).collect()}
    known = [x for x in table(spark, "labels", folder) if x["doc_id"] in rows and x["toxic"] is not None and x["quality"] is not None]
    kinds = ["toxic" if x["toxic"] == 1 else "clean" if x["quality"] == 1 else "noisy" for x in known]
    for d in mx.DOMAINS:
        assert sum(rows[x["doc_id"]][f"p_{d}"] for x in known) == pytest.approx(kinds.count(d), rel=0.05)


@pytest.mark.parametrize("clean, noisy, toxic", [(9992, 0, 8), (9990, 5, 5), (9900, 50, 50), (50, 50, 9900)])
def test_rare_domains_are_fitted(spark, clean, noisy, toxic):
    rows = [(0, clean, 1, 1.0, 0.0, 0.0), (1, noisy, 1, 0.0, 1.0, 0.0), (2, toxic, 1, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame([r for r in rows if r[1]], POSTERIORS)
    rate = mx.fit(df, None, 0.0, {"clean": 1.0, "noisy": 0.25, "toxic": 0.0}, 1.0)
    got = {r["row"]: r["rate"] for r in df.withColumn("rate", rate).collect()}
    assert got == pytest.approx({r[0]: (1.0, 0.25, 0.0)[r[0]] for r in rows if r[1]}, abs=1e-6)


def test_totals_hold_for_posteriors_between_the_steps_of_the_grid(spark):
    rows = [(i, 100, 1, 1.0 - p - q, p, q) for i, (p, q) in enumerate([(0.001, 0.999), (0.01, 0.01), (0.9, 0.03), (0.49, 0.02), (0.02, 0.47)] * 20)]
    df = spark.createDataFrame([tuple(abs(x) if isinstance(x, float) else x for x in r) for r in rows], POSTERIORS)
    shares = {"clean": 0.5, "noisy": 0.4, "toxic": 0.3}
    mass, got = totals(df, F.lit(1.0)), totals(df, mx.fit(df, None, 0.0, shares))
    assert got == pytest.approx([m * s for m, s in zip(mass, shares.values(), strict=True)], rel=1e-4)


def test_weights_table_holds_every_word(spark):
    import random

    rng = random.Random(2)
    words = {rng.randrange(-(1 << 63), 1 << 63): (float(i), 1.0, -1.0) for i in range(3000)}
    # words whose slots are the same
    words |= {k << 40: (0.5, 0.25, 0.125) for k in range(1, 3)}
    table = mx.Weights([0.0, 0.0, 0.0], words)
    some = [*list(words)[:50], *list(words)[-2:], 12345, 0]
    df = spark.createDataFrame([(w,) for w in some], "w long")
    got = df.select("w", *[table.score(table.slots_of(F.array("w")), d).alias(f"d{d}") for d in range(3)]).collect()
    assert {r["w"]: tuple(r)[1:] for r in got} == {w: words.get(w, (0.0, 0.0, 0.0)) for w in some}


def test_different_labels_of_one_document(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 1), (3, 1, 0), (3, 1, 0), (4, None, 1)]
    known = mx.domain_of(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in known.collect()} == {(1, "noisy"), (2, "toxic"), (3, "clean")}
