import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from folioforge.llm import structure_repair as sr
from folioforge.llm.plans import LLM_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        out[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = text.strip(BLANK)
        out.append(
            "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, letters) and lines, row by row from the end, over the states '', 's', 'u', 'a'."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_insertions(base):
        best = dict(base)
        for _ in range(2):
            for state in best:
                cost, letters, lines = best[following[state]]
                best[state] = min(best[state], (cost + 5, "I" + letters, (names[following[state]] + ":", *lines)))
        return best

    never = (10**9, "", ())
    best = with_insertions({"": (0, "", ()), "a": (0, "", ()), "s": never, "u": never})
    for (_, role, text), fault in zip(reversed(rows), reversed(faults)):
        base = {}
        for state in best:
            options = [(best[state][0] + 2, "D" + best[state][1], best[state][2])]
            if fault in ("", "truncated"):
                more, initial = 5 * (fault == "truncated"), role[:1]
                to = following[state]
                cost, letters, lines = best[to]
                options.append((cost + 1 + more, "R" + letters, (f"{names[to]}:{text}", *lines)))
                if initial == to or (initial == "s" and state == ""):
                    cost, letters, lines = best[initial]
                    options.append((cost + more, "K" + letters, (f"{role}:{text}", *lines)))
            base[state] = min(options)
        best = with_insertions(base)
    return best[""]


def summarised(conv, rows):
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, lines = cheapest(rows, faults)
    return (
        conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials)),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def reference(rows):
    def order(row):
        return (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())

    return sorted((summarised(c, sorted(v, key=order)) for c, v in damaged(rows).items()), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_reference_against_all_edits():
    """The row-by-row search above is the least of all edit sequences."""
    rng = random.Random(1)

    def all_edits(rows, faults, i, budget):
        if budget > 0:
            for role in "ua":
                for cost, letters, roles in all_edits(rows, faults, i, budget - 1):
                    yield cost + 5, "I" + letters, role + roles
        if i == len(rows):
            yield 0, "", ""
            return
        more = 5 * (faults[i] == "truncated")
        for cost, letters, roles in all_edits(rows, faults, i + 1, budget):
            yield cost + 2, "D" + letters, roles
            if faults[i] in ("", "truncated"):
                yield cost + more, "K" + letters, rows[i][1][:1] + roles
                for role in "ua":
                    yield cost + 1 + more, "R" + letters, role + roles

    for _ in range(60):
        rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b.", "c", ""])) for i in range(rng.randrange(5))]
        faults = faults_of(rows)
        best = min((c, x) for c, x, r in all_edits(rows, faults, 0, 2) if re.fullmatch("(s?(ua)+)?", r))
        assert cheapest(rows, faults)[:2] == best


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_against_row_by_row_search(spark, table, folder):
    path = f"/root/testdata/{folder}"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, "conversations", path)]
    assert result(LLM_QUERIES["op13_structure_repair"](spark, path)) == reference(rows)


def mixed_rows(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for conv, size in enumerate(sizes):
        roles = rng.choice([["user", "assistant"], ["user"], ["assistant"], ["system", "user", "assistant", "tool", "", None]])
        for i in range(size):
            turn = rng.choice([i, i, i, i + 3, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice([f"text {i}.", f"cut {i}", "same!", "", " \t", None, f"é {i}?"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [sr.PIECE_ROWS, 3])
def test_mixed_conversations_in_one_or_many_pieces(spark, monkeypatch, limit):
    monkeypatch.setattr(sr, "PIECE_ROWS", limit)
    rows = mixed_rows(4, [0, 1, 1, 2, 2, 3, 4, 5, 6, 9, 14, 40, 40, 40, 40])
    assert result(sr.damage_and_repair(spark.createDataFrame(rows, SCHEMA))) == reference(rows)


def pieces_of(rows, faults, size):
    cuts = [(rows[i : i + size], faults[i : i + size]) for i in range(0, len(rows), size)]
    out = []
    for some, their in cuts:
        piece = sr.Piece(True, 1)
        for (turn, role, text), fault in zip(some, their, strict=True):
            piece.add(turn, role, text, fault, 1)
        out.append(piece)
    return out


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_sweeps_over_pieces(size):
    """Matrices, state maps and unrolling give what the whole search gives, however rows are cut."""
    rng = random.Random(size)
    for _ in range(40):
        rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice([f"a{i}.", f"b{i}", "", "x."])) for i in range(rng.randrange(30))]
        faults = faults_of(rows)
        pieces = pieces_of(rows, faults, size)
        lefts = [sr.END]
        for p in reversed(pieces):
            lefts.append(sr.apply(sr.matrix_of(p.runs), lefts[-1]))
        lefts.reverse()
        state, audit, lines, cost = sr.NOTHING, "", [], 0
        for i, p in enumerate(pieces):
            letters, after = sr.unrolled(p.runs, lefts[i + 1], state)
            end = sr.tail(after) if i + 1 == len(pieces) else ""
            roles, texts, paid = sr.repaired(p.runs, letters, end, state, p.roles, p.texts)
            audit, cost, state = audit + "".join(letters) + end, cost + paid, after
            lines += [f"{r}:{t}" for r, t in zip(roles, texts, strict=True)]
        assert (cost, audit, tuple(lines)) == cheapest(rows, faults)
        assert cost == lefts[0][sr.NOTHING]


def test_powers_of_runs():
    for symbol in range(9):
        step, total = sr.power(symbol, 0), sr.ONE
        for n in range(1, 20):
            total = sr.product(total, step)
            assert tuple(tuple(min(x, sr._INF) for x in r) for r in sr.matrix_of([(symbol, n)])) == tuple(
                tuple(min(x, sr._INF) for x in r) for r in total
            )
            assert sr.before(symbol, n, sr.END) == sr.apply(total, sr.END)


@pytest.mark.parametrize("partitions", ["8", "41"])
def test_a_conversation_over_many_partitions(spark, partitions):
    rows = mixed_rows(9, [5, 3000, 4]) + [(77, 1, "user", "again and again.")] * 900
    names = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        df = spark.createDataFrame(rows, SCHEMA)
        assert result(sr.damage_and_repair(df)) == reference(rows)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "a."), (1, None, "user", "a."), (1, None, "assistant", "b"),
        (2, 1 << 60, "user", "x" * 100_000 + "."), (2, (1 << 60) + 3, "assistant", "y."), (3, -5, None, "."), (3, 5, "", "z"), (4, 0, "system", "s."),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", fault string, conv long")
    assert result(sr.damage_and_repair(df)) == reference(rows)
    assert sr.damage_and_repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_texts(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C."), (1, 3, "user", "D.")]
    [piece] = sr.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    turns = list(zip(piece["roles"], piece["texts"], strict=True))
    assert [r for r, _ in turns] == ["user", "assistant"] * (len(turns) // 2)
    assert (piece["audit"], piece["cost"], turns) == ("DKKD", 4, [("user", "B."), ("assistant", "C.")])
