import importlib.util
import random

import pytest

import corpus_pipeline
from tests.llm.test_near_duplicates import reference as components
from tests.llm.test_quality_rules import counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean texts, copies, near copies, junk, toxic texts and texts with benchmark items, with labels."""
    rng, folder = random.Random(8), str(tmp_path_factory.mktemp("planted"))
    stems = [f"{a}{b}" for a in ("ran", "tel", "mok", "ari", "os", "len") for b in ("dor", "ik", "a", "um", "est", "ine", "or")]

    def prose(n):
        return " ".join(rng.choice(stems) + rng.choice(("", "ly", "s", "ed")) for _ in range(n))

    rows, kinds = [], {}

    def add(kind, text):
        kinds.setdefault(kind, []).append(len(rows))
        rows.append((len(rows), text, "en", "s", len(text)))

    for _ in range(300):
        add("clean", prose(120))
    items = [prose(30) for _ in range(10)]
    for _ in range(60):
        words = prose(120).split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(("vile", "rotten", "nasty")))
        add("toxic", " ".join(words))
    for i in range(8):
        add("copy", rows[i][1])
        add("near", rows[i + 20][1] + " tail")
        add("leak", prose(50) + " " + items[i] + " " + prose(50))
        add("short", prose(20))
        add("junk", "### ".join(prose(100).split()))
    labels = [(d, 1, 0) for d in kinds["clean"]] + [(d, 1, 1) for d in kinds["toxic"]] + [(d, 0, 0) for d in kinds["junk"]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, kinds, rows


def test_planted_cases_go_and_clean_ones_stay(spark, planted):
    folder, kinds, rows = planted
    names = [f.name for f in spark.read.parquet(f"{folder}/documents.parquet").schema]
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        path = f"{folder}/{name.replace(' ', '-')}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns[: len(names)] == names
    texts = {r[0]: r[1] for r in rows}
    kept = left["quality rules"]
    assert not kept & set(kinds["short"]) and set(kinds["clean"]) <= kept
    assert all(counts(texts[d])[0] >= 50 for d in kept)
    want = components([(d, texts[d]) for d in kept], 5, 80)
    assert left["near duplicates"] == {d for d in kept if want[d][1] == d}
    assert not left["near duplicates"] & set(kinds["copy"] + kinds["near"])
    assert left["decontamination"] == left["near duplicates"] - set(kinds["leak"])
    assert not left["mixing"] & set(kinds["toxic"]) and set(kinds["clean"]) <= left["mixing"]
    assert left["sharding"] == left["mixing"]
    slots = [(r["shard"], r["slot"]) for r in docs.collect()]
    assert len(set(slots)) == len(slots)


def test_stages_are_the_five_in_order():
    assert len(corpus_pipeline.STAGES) == 5 and importlib.util.find_spec("corpus_pipeline")
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, planted):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, planted[0])
            assert set(odd_docs.columns) <= set(out.columns)
            assert out.count() <= docs.count(), name
