import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioforge.llm import quality_rules as q
from folioforge.llm.plans import LLM_QUERIES


def counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_against_plain_python(spark, table):
    got = LLM_QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.001").collect()
    want = {d["doc_id"]: counts(d["text"]) for d in table(spark, "documents")}
    assert len(got) == len(want)
    for r in got:
        n = want[r["doc_id"]]
        assert tuple(r[m] for m in q.MEASURES) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 40, 0.2), (7, 1000, 0.01), (10, 10, 0.5), (0, 0, 0.1), (40, 5000, 0.012)])
def test_binomial_tail_is_exact(spark, k, n, p):
    got = spark.range(1).select(q.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert got == pytest.approx(exact if k < n * p else 1.0, rel=1e-9)


def test_long_sums_are_never_too_small(spark, monkeypatch):
    monkeypatch.setattr(q, "TERMS", 3)
    k, n, p = 20, 2000, 0.02
    exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert exact <= spark.range(1).select(q.binomial_tail(F.lit(k), F.lit(n), p)).first()[0] < 2 * exact


def test_cutoffs_bound_false_rejections(spark):
    grid = {"r": (0.1, 0.2, 0.3)}
    # of 3000 good ones, 30 are above 0.1, 9 above 0.2 and none above 0.3; stratum b is too small for any
    rows = [("a", True, 0.05)] * 2970 + [("a", True, 0.15)] * 21 + [("a", True, 0.25)] * 9 + [("a", False, 0.9)] * 200
    rows += [("a", False, 0.25)] * 400 + [("b", True, 0.0)] * 50 + [("b", False, 0.9)] * 50
    df = spark.createDataFrame(rows, "stratum string, good boolean, r double")
    got = {r["stratum"]: r["max_r"] for r in q.cutoffs(df, grid, max_false=0.01).collect()}
    assert got == {"a": 0.2}
    assert {r["stratum"]: r["max_r"] for r in q.cutoffs(df, grid, max_false=0.002).collect()} == {"a": 0.3}


def test_odd_rows(spark, odd_docs, no_docs, labels):
    rows = q.assess(odd_docs, labels)
    assert rows.columns == [c for c in odd_docs.columns if c != "kept"] + [*q.MEASURES, "base_failed", "kept"]
    got = rows.collect()
    assert len(got) == odd_docs.count()
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [5, 6, 6]
    assert q.assess(no_docs, labels).count() == 0
    assert q.assess(odd_docs, labels.limit(0)).filter("kept").count() == 3
