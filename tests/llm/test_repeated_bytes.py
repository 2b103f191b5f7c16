import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import repeated_bytes as rb
from folioforge.llm.plans import LLM_QUERIES


def reference(docs):
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(window)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_query_against_plain_search(spark, table):
    docs = [(d["doc_id"], d["text"]) for d in table(spark, "documents")]
    assert result(LLM_QUERIES["op9_repeated_bytes"](spark, "/root/testdata/sf0.001")) == reference(docs)


@pytest.mark.parametrize("piece,step", [(rb.PIECE, rb.STEP), (1, 64)])
def test_edges_runs_and_overlaps(spark, monkeypatch, piece, step):
    monkeypatch.setattr(rb, "PIECE", piece)
    monkeypatch.setattr(rb, "STEP", step)
    rng = random.Random(1)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passage, half = noise(160), noise(99)
    texts = [
        noise(50) + passage + noise(50), noise(33) + passage, passage[:100], passage[1:100], half, half + "x", "z" * 350, "z" * 120,
        noise(40) + passage[20:140] + noise(3) + passage[:110], noise(300), "\x00" * 150, "\x00" * 101 + "q", passage + passage, "", None,
    ]
    docs = list(enumerate(texts))
    got = result(rb.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == reference(docs)
    assert got[2][1] == got[2][0] >= 100 and got[4][1] == 0 and got[6][1] == 349


def test_anchors_stand_at_equal_places_of_equal_strings():
    rng = random.Random(2)
    text = bytes(rng.randrange(97, 101) for _ in range(3000))
    data = text[:700] + text[100:400] + text[700:] + text[900:1000]
    places = {int(p) for p in rb.anchors(data)[1]}
    for p in range(len(data) - 99):
        assert any(p <= a <= p + rb.REACH for a in places)
    first, again = 100, 700
    inside = [sorted(a - s for a in places if s + 60 <= a <= s + 190) for s in (first, again)]
    assert inside[0] == inside[1] and inside[0]


@pytest.mark.parametrize("step", [rb.STEP, 128])
def test_each_string_has_its_leftmost_smallest_gram_as_anchor(monkeypatch, step):
    monkeypatch.setattr(rb, "STEP", step)
    rng = random.Random(4)
    noise = bytes(rng.randrange(97, 101) for _ in range(900))
    for data in (noise, noise[:200] * 4, b"z" * 400, b"ab" * 150 + noise[:150] + b"ab" * 90, noise[:100], noise[:99], b""):
        hashes = rb.gram_hashes(np.frombuffer(data, np.uint8)).tolist() if len(data) >= rb.GRAM else []
        owner = {}
        for p in range(len(data) - rb.DEPTH + 1):
            span = hashes[p : p + rb.REACH + 1]
            owner[p] = p + span.index(min(span))
        got = {}
        for gram, place, first, count in zip(*(column.tolist() for column in rb.anchors(data)), strict=True):
            assert gram == hashes[place] and 0 < count <= rb.REACH + 1 and 0 <= place - first <= rb.REACH
            for p in range(first, first + count):
                assert p not in got
                got[p] = place
        assert got == owner


def test_earliest_equal_against_longest_previous_factors():
    """A suffix has an earlier equal exactly if its longest previous factor, found by brute force, reaches 100."""
    rng = random.Random(5)
    part = bytes(rng.randrange(2) for _ in range(260))
    data = part + part[30:190] + bytes(50) + part[:140] + bytes(130) + part[100:230]
    suffixes = [data[p : p + rb.DEPTH] for p in range(len(data) - rb.DEPTH + 1)]
    longest = []
    for p in range(len(suffixes)):
        common = (next((n for n in range(rb.DEPTH) if data[q + n] != data[p + n]), rb.DEPTH) for q in range(p))
        longest.append(max(common, default=0))
    earliest = rb.longest_previous(np.array(suffixes, f"S{rb.DEPTH}"))
    assert [e < p for p, e in enumerate(earliest)] == [n >= rb.DEPTH for n in longest]
    assert all(suffixes[e] == suffixes[p] and suffixes.index(suffixes[p]) == e for p, e in enumerate(earliest.tolist()))
    assert 100 < sum(n >= rb.DEPTH for n in longest) < len(longest) - 100


@pytest.mark.parametrize("piece", [2, 3, 50, 5000])
def test_an_anchor_over_many_pieces_and_partitions(spark, monkeypatch, piece):
    monkeypatch.setattr(rb, "PIECE", piece)
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh") for _ in range(130))

    def edge():
        return "".join(rng.choice("ijklmn") for _ in range(rng.randrange(60)))

    docs = [(i, edge() + passage[rng.randrange(20) : 130 - rng.randrange(20)] + edge()) for i in range(120)]
    rows = rb.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))
    assert result(rows) == reference(docs)
    again = rb.remove_repeats(spark.createDataFrame(docs[:40] * 2, "doc_id long, text string"))
    assert result(again) == reference(docs[:40]) and again.count() == 80


def test_odd_rows(spark, odd_docs, no_docs):
    rows = rb.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[5]["n_removed"] == 0 and by[6]["n_removed"] == by[6]["n_bytes"] > 0 and by[4]["n_removed"] > 0
    assert by[1]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rb.remove_repeats(no_docs).count() == 0


def test_anchors_of_rows_with_one_key_stay_apart(spark, monkeypatch):
    rng, made, write = random.Random(3), {}, rb.written

    def kept(df, label):
        made[label] = write(df, label)
        return made[label]

    monkeypatch.setattr(rb, "written", kept)
    passage = "".join(rng.choice("abcdefgh") for _ in range(150))
    docs = [(None, chr(33 + i) + passage) for i in range(60)] + [(None, "!" + passage)] * 60 + [(1, passage)]
    rows = rb.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert made["touched"].filter(F.size("places") > F.octet_length("text")).count() == 0
    assert made["touched"].count() == len(docs) == len(rows)
    assert [r["n_removed"] for r in rows if r["doc_id"] is None] == [150] * 120
