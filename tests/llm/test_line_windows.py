import hashlib

from folioforge.llm import line_windows
from folioforge.llm.plans import LLM_QUERIES

BLANKS = " \t\n\x0b\f\r"


def reference(docs):
    seen, out = {}, {}
    for key, text in sorted(docs):
        lines = (text or "").split("\n") if text is not None else []
        bare = [x.strip(BLANKS) for x in lines]
        gone = set()
        for i in range(len(bare) - 2):
            window = tuple(bare[i : i + 3])
            if any(window) and seen.setdefault(window, (key, i)) != (key, i):
                gone |= {i, i + 1, i + 2}
        out[key] = (len(lines), len(gone), None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_query_against_plain_search(spark, table):
    want = reference([(d["doc_id"], d["text"]) for d in table(spark, "documents")])
    got = LLM_QUERIES["op7_line_windows"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text_md5"]) for r in got} == {
        k: (n, g, hashlib.md5(t.encode()).hexdigest()) for k, (n, g, t) in want.items()
    }


def test_overlaps_and_blanks(spark):
    docs = [
        (1, "a\nb\nc\nd"), (2, "x\n a\nb \nc\ty\nz"), (3, "x\n a\nb \nc\nd\ny"), (4, "r\nr\nr\nr\nr"), (5, "\n\n\n\n"), (6, "\n\n\n\n"), (7, "a\nb"),
    ]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in
           line_windows.drop_repeated_windows(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == reference(docs)
    assert got[3][1] == 5 and got[3][2] == "y" and got[4][2] == "r" and got[6][1] == 0


def test_odd_rows(spark, odd_docs, no_docs):
    rows = line_windows.drop_repeated_windows(odd_docs)
    assert rows.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    assert sorted(map(repr, (r["text"] for r in rows.collect()))) == sorted(map(repr, (r["text"] for r in odd_docs.collect())))
    assert line_windows.drop_repeated_windows(no_docs).count() == 0
