from folioforge.llm import language
from folioforge.llm.plans import LLM_QUERIES


def test_held_out_accuracy(spark, table):
    rows = LLM_QUERIES["op3_language_profiles"](spark, "/root/testdata/sf0.01").collect()
    lang = {d["doc_id"]: (d["lang"], d["text"]) for d in table(spark, "documents", "/root/testdata/sf0.01")}
    tried = [(r["lang_pred"], *lang[r["doc_id"]]) for r in rows if r["held_out"]]
    long = [(p, w) for p, w, t in tried if len(t.split()) >= 20]
    assert len(rows) == len(lang) and len(long) > 200
    assert sum(p == w for p, w in long) >= 0.98 * len(long)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_profiles_are_sums_of_bound_letters():
    import numpy as np

    slots, letters = language._slots(), language._LETTERS
    text = "Ab, c"
    s = [0, slots[ord("a")], slots[ord("b")], 0, slots[ord("c")], 0]
    want = sum(
        np.roll(letters[a], 2).astype(int) * np.roll(letters[b], 1) * letters[c] for a, b, c in zip(s, s[1:], s[2:])
    )
    assert (language._profiles([text, ""], slots)[0] == want).all()


def test_odd_rows(spark, odd_docs, no_docs):
    learned = language.prototypes(odd_docs)
    assert list(learned) == ["en", "fr"]
    got = odd_docs.select("doc_id", "text", language.predictor(learned)("text").alias("p")).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["p"]["lang_pred"] == "und") == (not letters) and (letters or r["p"]["score"] == 0)
    assert language.prototypes(no_docs) == {}
    assert {r["p"]["lang_pred"] for r in odd_docs.select(language.predictor({})("text").alias("p")).collect()} == {"und"}
