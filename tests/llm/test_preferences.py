from folioforge.llm import preferences

SCHEMA = "pair_id long, side int, turn long, role string, text string, part string"


def render(role, text):
    return f"<|{role or ''}|>\n{text or ''}<|end|>\n"


def reference(rows):
    out = []
    pairs = {}
    for pair, side, turn, role, text, _ in rows:
        pairs.setdefault(pair, {0: [], 1: []})[side].append((turn, role, text))
    for pair, sides in pairs.items():
        a, b = (sorted(sides[s], key=lambda t: t[0]) for s in (0, 1))
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        out += [(pair, "prompt", t, render(r, x), False) for t, r, x in a[:n]]
        out += [(pair, "chosen", t, render(r, x), r == "assistant") for t, r, x in a[n:]]
        out += [(pair, "rejected", t, render(r, x), r == "assistant") for t, r, x in b[n:]]
    return sorted(out)


def test_prefix_once_and_masks(spark):
    rows = []
    for pair in range(6):
        for side in (0, 1):
            for turn in range(4 + side):
                role = ("user", "assistant")[turn % 2]
                same = turn < pair
                rows.append((pair, side, turn, role, f"t{turn}" + ("" if same else f" of {side}"), "extra"))
    rows += [(9, 0, 0, "user", "alone", None), (10, 0, 0, None, None, None), (10, 1, 0, None, None, None)]
    got = preferences.format_pairs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["pair_id"], r["part"], r["turn"], r["segment"], r["is_target"]) for r in got) == reference(rows)
    for r in got:
        assert r["masked_chars"] + r["target_chars"] == len(r["segment"])
        if r["is_target"]:
            assert r["segment"][r["masked_chars"] :].endswith("<|end|>\n") and r["segment"].startswith("<|assistant|>\n")


def test_a_later_equal_turn_is_no_prefix(spark):
    rows = [(1, s, t, "user", x, None) for s, xs in ((0, "abc"), (1, "axc")) for t, x in enumerate(xs)]
    got = preferences.format_pairs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["part"], r["turn"]) for r in got) == [
        ("chosen", 1), ("chosen", 2), ("prompt", 0), ("rejected", 1), ("rejected", 2),
    ]


def test_nulls_repeats_and_empty(spark):
    rows = [(1, 0, None, "user", "x", None), (1, 0, None, "user", "x", None), (1, 1, None, "user", "x", None)]
    got = preferences.format_pairs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["part"] for r in got) == ["chosen", "chosen", "rejected"]
    assert preferences.format_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
    turns = spark.createDataFrame([(None, 0, "user", "x"), (3, 0, "user", "y")], "conv_id long, turn long, role string, text string")
    assert [(r["pair_id"], r["side"]) for r in preferences.neighbours(turns).collect()] == [(1, 1)]


def test_repeated_turns_are_compared_as_bags(spark):
    sides = {1: ("AA", "BB"), 2: ("AA", "AA"), 3: ("AAB", "ABB"), 4: ("AAC", "BBC"), 5: ("ABAB", "BABA")}
    rows = [(p, s, 0, "user", x, None) for p, xs in sides.items() for s in (0, 1) for x in xs[s]]
    got = preferences.format_pairs(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for p, (a, b) in sides.items():
        want += [(p, "prompt")] * len(a) if sorted(a) == sorted(b) else [(p, "chosen")] * len(a) + [(p, "rejected")] * len(b)
    assert sorted((r["pair_id"], r["part"]) for r in got) == sorted(want)


TURNS = "conv_id long, turn long, role string, text string, part string"


def test_replies_are_swapped_between_neighbours(spark):
    rows = [(2, t, ("user", "assistant")[t % 2], f"two {t}", "x") for t in range(5)]  # ends with a user turn
    rows += [(3, t, ("user", "assistant")[t % 2], f"three {t}", "x") for t in range(2)]
    rows += [(3, 1, "assistant", "three more", "x"), (3, None, "system", "note", "x")]
    rows += [(4, 0, "user", "unanswered", None), (5, 0, "assistant", "hello", None), (6, 0, "assistant", "alone", None)]
    rows += [(8, 0, "user", "q", None), (8, 1, "assistant", "same", None), (9, 0, "user", "r", None), (9, 1, "assistant", "same", None)]
    rows += [(None, 0, "assistant", "nobody", None), (10, None, "assistant", "unplaced", None), (11, 0, "assistant", None, None)]
    got = preferences.format_pairs(preferences.swapped_replies(spark.createDataFrame(rows, TURNS))).collect()
    assert sorted((r["pair_id"], r["part"], -1 if r["turn"] is None else r["turn"], r["segment"]) for r in got) == sorted([
        *[(2, "prompt", t, render(("user", "assistant")[t % 2], f"two {t}")) for t in range(3)],
        (2, "chosen", 3, render("assistant", "two 3")), (2, "rejected", 3, render("assistant", "three more")),
        (3, "prompt", -1, render("system", "note")), (3, "prompt", 0, render("user", "three 0")),
        (3, "chosen", 1, render("assistant", "three 1")), (3, "chosen", 1, render("assistant", "three more")),
        (3, "rejected", 1, render("assistant", "two 3")),
        *[(c, "prompt", t, render(r, x)) for c, q in ((8, "q"), (9, "r")) for t, r, x in ((0, "user", q), (1, "assistant", "same"))],
    ])
    assert preferences.swapped_replies(spark.createDataFrame([], TURNS)).count() == 0


def test_query_gives_prompts_and_both_completions(spark):
    from folioforge.llm.plans import LLM_QUERIES

    parts = LLM_QUERIES["op5_preference_pairs"](spark, "/root/testdata/sf0.001").groupBy("pair_id").pivot("part", ["prompt", "chosen", "rejected"]).count().collect()
    assert parts and all(r["prompt"] and r["chosen"] == r["rejected"] == 1 for r in parts)
