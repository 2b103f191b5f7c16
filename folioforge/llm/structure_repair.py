"""Cheapest repair of conversations to the turn structure ``(s?(ua)+)?``, by dynamic programming over runs.

A row is a symbol: what its role starts with (s, u, a or another), and whether its text is cut off; rows that must
go are one symbol. A symbol moves between four states (nothing yet, after s, after u, after a) at the least cost of
the edits that do so, a 4 x 4 matrix under minimum and sum. Equal neighbours are a run, and n equal symbols cost the
n-th power of the matrix, from its powers of two, which every task computes once.

1. Rows are ordered by range partitions, and streams fold them into pieces: rows of one conversation, bounded in
   number and size. Nearly all conversations are one piece and are solved where they are read.
2. Pieces of other conversations are given their place by three passes over one small row each, which hold nothing but
   a state: from the last piece to the first, the matrices give the cost that is left at each piece's end; then a
   piece knows its choices, so it maps its first state to its last; from first to last, these maps give all states.
3. Each run is unrolled from its first state: of the edits that keep the least cost, the first by letter is chosen. In
   order of letters D(elete), I(nsert), K(eep) and R(erole), each leads to one state, so the letters are the least of
   all cheapest ones, and the repaired roles follow from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import BLANKS, written

#: Costs of the edits; rows that are cut off cost CUT more unless they are deleted.
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
#: Rows and characters of a piece, beyond which a new one begins.
PIECE_ROWS, PIECE_CHARS = 1024, 1 << 20

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_INF = 1 << 60
_ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a user or assistant turn that is inserted or given its role: which of both fits is no choice.
_NEXT = (USER, USER, ASSISTANT, USER)
#: The symbol of rows that must go; others are 1 + 2 x (place of the initial in "sua", else 3) + cut off.
GO = 0

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]

#: Without a turn number: low and high 0, turns 0. The cost is 0 until the piece is solved.
_STATS = ("blank", "duplicate", "truncated", "illegal", "cost", "low", "high", "turns")
_PIECE = (
    "known boolean, conv long, part int, no long, whole boolean, " + ", ".join(f"{s} long" for s in _STATS)
    + ", first_role string, last_role string, audit string, runs array<struct<symbol: int, n: long>>, matrix array<long>,"
    " roles array<string>, texts array<string>"
)
_NAMES = [part.split()[0] for part in _PIECE.replace("struct<symbol: int, n: long>", "x").split(", ")]


def product(x: Matrix, y: Matrix) -> Matrix:
    return tuple(tuple(min(r[k] + y[k][j] for k in range(4)) for j in range(4)) for r in x)


def apply(x: Matrix, v: Vector) -> Vector:
    return tuple(min(r[k] + v[k] for k in range(4)) for r in x)


ONE: Matrix = tuple(tuple(0 if i == j else _INF for j in range(4)) for i in range(4))


def _inserted() -> Matrix:
    """Least cost of insertions between states."""
    once = tuple(tuple(0 if i == j else INSERT if _NEXT[i] == j else _INF for j in range(4)) for i in range(4))
    return product(once, once)


INSERTED = _inserted()
#: What is left after the last row: insertions up to a state in which a conversation may end.
END: Vector = apply(INSERTED, (0, _INF, _INF, 0))


def symbol_of(initial: str, cut_off: bool) -> int:
    place = "sua".find(initial) if initial else -1
    return 1 + 2 * (place if place >= 0 else 3) + cut_off


def kept(symbol: int, state: int) -> int | None:
    """The state after keeping a row in its role, if it may stand there."""
    place = (symbol - 1) // 2
    if place == 0:
        return SYSTEM if state == NOTHING else None
    return _NEXT[state] if place < 3 and _NEXT[state] == (USER, ASSISTANT)[place - 1] else None


def penalty(symbol: int) -> int:
    return CUT if symbol != GO and (symbol - 1) % 2 else 0


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """The matrix of 2 ** k equal symbols, each with the insertions before it."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    step = [[_INF] * 4 for _ in range(4)]
    for state in range(4):
        step[state][state] = DELETE
        if symbol != GO:
            step[state][_NEXT[state]] = min(step[state][_NEXT[state]], REROLE + penalty(symbol))
            stays = kept(symbol, state)
            if stays is not None:
                step[state][stays] = min(step[state][stays], penalty(symbol))
    return product(INSERTED, tuple(map(tuple, step)))


@lru_cache(1 << 14)
def _before(symbol: int, n: int, left: Vector) -> Vector:
    k = 0
    while n:
        if n & 1:
            left = apply(power(symbol, k), left)
        n >>= 1
        k += 1
    return left


def before(symbol: int, n: int, left: Vector) -> Vector:
    """Cost that is left before a run, from that after it."""
    least = min(left)
    return tuple(least + x for x in _before(symbol, n, tuple(x - least for x in left)))


def matrix_of(runs: list[tuple[int, int]]) -> Matrix:
    total = ONE
    for symbol, n in runs:
        k = 0
        while n:
            if n & 1:
                total = product(total, power(symbol, k))
            n >>= 1
            k += 1
    return total


@lru_cache(1 << 14)
def _unrolled(symbol: int, n: int, left: Vector, state: int) -> tuple[str, int]:
    if symbol == GO:
        # what could be inserted before them can be inserted after them, and D comes before I
        return "D" * n, state
    costs = [left]
    for _ in range(n):
        costs.append(apply(power(symbol, 0), costs[-1]))
    costs.reverse()
    letters, j = [], 0
    while j < n:
        least, after = costs[j][state], costs[j + 1]
        stays = kept(symbol, state)
        if DELETE + after[state] == least:
            letters.append("D")
            j += 1
        elif INSERT + costs[j][_NEXT[state]] == least:
            letters.append("I")
            state = _NEXT[state]
        elif stays is not None and penalty(symbol) + after[stays] == least:
            letters.append("K")
            state, j = stays, j + 1
        else:
            letters.append("R")
            state, j = _NEXT[state], j + 1
    return "".join(letters), state


def unrolled(runs: list[tuple[int, int]], left: Vector, state: int) -> tuple[list[str], int]:
    """The letters of each run, and the last state, from the first state and the cost left after the last run."""
    lefts = [left]
    for symbol, n in reversed(runs):
        lefts.append(before(symbol, n, lefts[-1]))
    lefts.reverse()
    letters = []
    for (symbol, n), after in zip(runs, lefts[1:], strict=True):
        least = min(after)
        found, state = _unrolled(symbol, n, tuple(x - least for x in after), state)
        letters.append(found)
    return letters, state


def tail(state: int) -> str:
    """Insertions after the last row."""
    return "II" if state == SYSTEM else "I" if state == USER else ""


def repaired(runs, letters: list[str], end: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str], int]:
    """Roles and texts after the edits, and their cost; ``roles`` and ``texts`` are those of rows that may stay."""
    out_roles, out_texts, cost, at = [], [], 0, 0
    for (symbol, _), found in zip([*runs, (GO, 0)], [*letters, end], strict=True):
        if symbol == GO and found and found[0] == "D":
            cost += DELETE * len(found)
            continue
        for letter in found:
            if letter == "D":
                cost += DELETE
                at += 1
                continue
            stays = letter == "K"
            state = kept(symbol, state) if stays else _NEXT[state]
            out_roles.append(roles[at] if stays else _ROLES[state])
            out_texts.append("" if letter == "I" else texts[at])
            cost += INSERT if letter == "I" else penalty(symbol) + (0 if stays else REROLE)
            at += letter != "I"
    return out_roles, out_texts, cost


class Piece:
    """Rows of one conversation, as runs, with the figures that the next piece adds to."""

    def __init__(self, known: bool, conv: int):
        self.known, self.conv = known, conv
        self.runs: list[tuple[int, int]] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.rows = self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first_role = self.last_role = None

    def run(self, symbol: int, n: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            n += self.runs.pop()[1]
        self.runs.append((symbol, n))

    def add(self, turn: int | None, role: str, text: str, fault: str, copies: int) -> None:
        self.rows += 1
        initial = role[:1]
        self.illegal += copies - 1
        if self.last_role is not None:
            self.illegal += self.last_role + initial not in ("su", "ua", "au")
        else:
            self.first_role = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.last_role = initial
        if fault == "blank":
            self.blank += copies
            self.run(GO, copies)
            return
        self.duplicate += copies - (fault != "duplicate")
        if fault == "duplicate":
            self.run(GO, copies)
            return
        self.truncated += fault == "truncated"
        self.run(symbol_of(initial, fault == "truncated"), 1)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        if copies > 1:
            self.run(GO, copies - 1)

    def row(self, part: int, no: int, whole: bool) -> tuple:
        audit, cost, matrix, runs = None, 0, None, None
        roles, texts = self.roles, self.texts
        if whole:
            letters, state = unrolled(self.runs, END, NOTHING)
            audit = "".join(letters) + tail(state)
            roles, texts, cost = repaired(self.runs, letters, tail(state), NOTHING, roles, texts)
        else:
            runs, matrix = self.runs, [x for r in matrix_of(self.runs) for x in r]
        stats = (self.blank, self.duplicate, self.truncated, self.illegal, cost, self.low or 0, self.high or 0, self.turns)
        return (self.known, self.conv, part, no, whole, *stats, self.first_role, self.last_role, audit, runs, matrix, roles, texts)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES)


def _piece_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of rows that come in order. Whole conversations, which no other partition can share, are solved."""
    part, no, piece = TaskContext.get().partitionId(), 0, None
    # the first conversation of a partition may have begun in another
    alone = False
    columns = ("known", "conv", "timed", "turn", "role", "text", "fault", "copies")
    for batch in batches:
        out = []
        for known, conv, timed, turn, role, text, fault, copies in zip(*(batch[c].tolist() for c in columns), strict=True):
            same = piece is not None and piece.conv == conv and piece.known == known
            if not same or piece.rows >= PIECE_ROWS or piece.chars >= PIECE_CHARS:
                if piece is not None:
                    out.append(piece.row(part, no, alone and not same))
                    no += 1
                    alone = not same
                piece = Piece(known, conv)
            if copies:
                piece.add(turn if timed else None, role, text, fault, copies)
        if out:
            yield _frame(out)
    if piece is not None:
        yield _frame([piece.row(part, no, False)])


def _costs_left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cost left at the end of each piece; pieces come from the last of a conversation to its first."""
    held, left = None, END
    for batch in batches:
        out = []
        for known, conv, part, no, flat in zip(*(batch[c] for c in ("known", "conv", "part", "no", "matrix")), strict=True):
            last = held != (known, conv)
            if last:
                held, left = (known, conv), END
            out.append((part, no, last, list(left)))
            left = apply(tuple(tuple(int(x) for x in flat[4 * i : 4 * i + 4]) for i in range(4)), left)
        yield pd.DataFrame(out, columns=["part", "no", "last", "left"])


def _runs(rows) -> list[tuple[int, int]]:
    return [(r["symbol"], r["n"]) for r in rows]


def _vector(values) -> Vector:
    return tuple(int(x) for x in values)


def _state_maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        maps = [[unrolled(_runs(r), _vector(v), s)[1] for s in range(4)] for r, v in zip(batch["runs"], batch["left"], strict=True)]
        yield batch[["known", "conv", "part", "no"]].assign(states=maps)


def _first_states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """State before each piece; pieces come in order."""
    held, state = None, NOTHING
    for batch in batches:
        out = []
        for known, conv, part, no, states in zip(*(batch[c] for c in ("known", "conv", "part", "no", "states")), strict=True):
            if held != (known, conv):
                held, state = (known, conv), NOTHING
            out.append((part, no, state))
            state = int(states[state])
        yield pd.DataFrame(out, columns=["part", "no", "state"])


def _solved_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for i, (rows, left, last, state) in enumerate(zip(batch["runs"], batch["left"], batch["last"], batch["state"], strict=True)):
            runs = _runs(rows)
            letters, after = unrolled(runs, _vector(left), state)
            end = tail(after) if last else ""
            one = batch.iloc[i : i + 1]
            roles, texts, cost = repaired(runs, letters, end, state, list(one["roles"].iloc[0]), list(one["texts"].iloc[0]))
            audit = "".join(letters) + end
            yield one.assign(audit=audit, cost=cost, roles=[roles], texts=[texts])[_NAMES]


def damaged(df: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, copies) after damage by crc32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops the row (no copies), 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    kind = F.crc32(name) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    gone = kind == 0
    return df.select(
        conv.alias("conv"),
        F.when(~gone, turn).alias("turn"),
        F.when(gone, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(gone | (kind == 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and their first fault, in order."""
    said = [F.xxhash64("conv", "role", "text").alias("h"), F.xxhash64(F.lit(1), "text", "role", "conv").alias("g")]
    place = F.struct(F.col("turn").isNotNull().alias("timed"), "turn")
    again = rows.filter("copies > 0").select(*said, place.alias("place")).groupBy("h", "g")
    again = again.agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last").drop("last")
    distinct = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    met = distinct.select("*", *said).join(again, ["h", "g"], "left")
    trimmed = F.btrim("text", F.lit(BLANKS))
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.col("first") < place, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    shown = met.select("conv", "turn", "role", "text", "copies", fault.alias("fault"))
    ranged = shown.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 32))
    zero = F.lit(0).cast("long")
    return ranged.sortWithinPartitions("conv", "turn", "role", "text").select(
        F.col("conv").isNotNull().alias("known"), F.coalesce("conv", zero).alias("conv"), F.col("turn").isNotNull().alias("timed"),
        F.coalesce("turn", zero).alias("turn"), "role", "text", "fault", "copies",
    )


def repair_rows(rows: DataFrame) -> DataFrame:
    """Pieces of repaired conversations of ``rows`` (conv, turn, role, text, copies).

    A piece has the conversation (``conv``, or none unless ``known``), its place (``part``, ``no``), the letters of the
    edits in order (``audit``), the roles and texts after them, and figures; ``whole`` ones are a conversation each.
    """
    pieces = written(_ordered(rows).mapInPandas(_piece_rows, _PIECE), "pieces")
    open_ones = pieces.filter("not whole")
    backward = open_ones.select("known", "conv", "part", "no", "matrix").repartition("known", "conv")
    backward = backward.sortWithinPartitions("known", "conv", F.desc("part"), F.desc("no"))
    lefts = written(backward.mapInPandas(_costs_left, "part int, no long, last boolean, left array<long>"), "costs")
    forward = open_ones.select("known", "conv", "part", "no", "runs").join(lefts, ["part", "no"])
    forward = forward.mapInPandas(_state_maps, "known boolean, conv long, part int, no long, states array<int>")
    forward = forward.repartition("known", "conv").sortWithinPartitions("known", "conv", "part", "no")
    states = forward.mapInPandas(_first_states, "part int, no long, state int")
    ready = open_ones.join(lefts, ["part", "no"]).join(states, ["part", "no"])
    solved = ready.mapInPandas(_solved_rows, _PIECE)
    return pieces.filter("whole").unionByName(solved).drop("runs", "matrix")


def repair(df: DataFrame) -> DataFrame:
    """:func:`repair_rows` of ``df`` (conv_id, turn, role, text) as it is, without damage; nulls are one space."""
    blank = F.lit(" ")
    role, text = (F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("role", "text"))
    return repair_rows(df.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role, text, F.lit(1).alias("copies")))


_SUMMARY = (
    "known boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from its pieces, which come in order."""
    names = [part.split()[0] for part in _SUMMARY.split(", ")]
    held, total, digest, audits, span, last = None, None, None, [], None, None

    def ended() -> tuple:
        gaps = 0 if span is None else span[1] - span[0] + 1 - span[2]
        return (*held, gaps, *total, "".join(audits), digest.hexdigest())

    for batch in batches:
        out = []
        for r in batch.to_dict("records"):
            key = (r["known"], r["conv"])
            if key != held:
                if held is not None:
                    out.append(ended())
                held, total, digest, audits, span, last = key, [0] * 5, hashlib.sha256(), [], None, None
                begun = False
            for i, name in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                total[i] += int(r[name])
            audits.append(r["audit"])
            if r["rows"]:
                if last is not None:
                    total[3] += last + r["first_role"] not in ("su", "ua", "au")
                last = r["last_role"]
            low, high, turns = int(r["low"]), int(r["high"]), int(r["turns"])
            if turns:
                span = (low, high, turns) if span is None else (span[0], high, span[2] + turns - (span[1] == low))
            for role, text in zip(r["roles"], r["texts"], strict=True):
                digest.update((("\n" if begun else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                begun = True
        if out:
            yield pd.DataFrame(out, columns=names)
    if held is not None:
        yield pd.DataFrame([ended()], columns=names)


def summary(pieces: DataFrame) -> DataFrame:
    """Per conversation of :func:`repair_rows`: gaps, faults, cost, audit and SHA-256 of the repaired lines.

    gaps: numbers between the least and the greatest turn that no row has; illegal: neighbours whose roles' initials
    are not su, ua or au. Lines are ``role:text``, joined by newlines. A conversation without rows has zeros.
    """
    lines = F.transform(F.arrays_zip("roles", "texts"), lambda r: F.concat(r["roles"], F.lit(":"), r["texts"]))
    one = pieces.filter("whole").select(
        "known", "conv", F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"),
    )
    several = pieces.filter("not whole").select(
        "known", "conv", "part", "no", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles", "texts",
        F.col("first_role").isNotNull().alias("rows"), "first_role", "last_role", "low", "high", "turns",
    )
    several = several.repartition("known", "conv").sortWithinPartitions("known", "conv", "part", "no")
    joined = one.unionByName(several.mapInPandas(_summaries, _SUMMARY))
    return joined.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), *[c for c in joined.columns if c not in ("known", "conv")])


def damage_and_repair(df: DataFrame) -> DataFrame:
    """:func:`summary` of the conversations of ``df`` (conv_id, turn, role, text) after :func:`damaged`.

    Rows are ordered by turn, null first, then role and text, so equal rows are neighbours: all but the first are
    duplicates. Rows without conv_id are one conversation with null as its id. A conversation whose rows are all
    dropped has zeros and the hash of the empty string. Other columns are not looked at. An empty table gives no rows.
    """
    return summary(repair_rows(damaged(df)))
