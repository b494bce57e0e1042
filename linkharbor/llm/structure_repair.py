"""Repairs the order of roles in conversations at the least cost, as a shortest path of integer weights.

A repaired conversation has the role initials `(s?(ua)+)?`. Rows are kept (0), given the role user or
assistant (3) or deleted (4); empty user or assistant rows may be inserted anywhere (3). Blank rows and
rows whose role and text came earlier must go; a truncated row that stays costs 3 more. Of the cheapest
edit lists the one whose initials (Delete, Insert, Keep, Rerole) come first in ASCII order is taken.

Nodes of the graph are (row, state of the grammar). The weight of an edge is one big integer: the cost
in the high digits and, below it, three octal digits per row with the letters of the edits made there
(D 1, I 2, K 3, R 4, then zeros). `letters` of a row end with D, K or R, so no group begins another
and comparing the digits compares the letters; adding weights and taking the minimum decides all.
Inserting before a deletion is never needed (the same insertion after it comes first in the order), nor
more than one insertion before a row (two lead to a state that allows no more than the one before).

Rows are dealt by conversation and block of turns, so that a conversation with a third of all rows is
spread: each segment of at most SEGMENT rows gives a 4 x 4 matrix of least weights, and the matrices of
a conversation are multiplied in order, pairs of like size first. Only letters and costs meet there,
the texts do not.

Nulls: a null role or text is one space, a null turn comes first, a null conv_id is a conversation of
its own. Rows of one turn are ordered by role and by the digest of the text. Repeated rows are duplicates
like any other. An empty table gives empty tables. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import from_arrow_schema

from linkharbor.llm.common import batch_of, small_batches, staged

# Turns in one block (as a power of two), and rows in one segment of it.
BLOCK_BITS = 10
SEGMENT = 1024

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = {d: c for c, d in _DIGIT.items()}
_GROUP = 9  # bits of the three octal digits of a row

# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEEP = {(START, "s"): SYSTEM, **{(state, "ua"[to - USER]): to for state, to in _NEXT.items()}}
_END = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

NO_FAULT, BLANK, DUPLICATE, CUT_OFF = range(4)

# A character that is no blank, and the last of them being no end of a sentence.
_FILLED = r"[^\x20\x09-\x0D]"
_UNENDED = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"


def _code(letters: str) -> int:
    code = 0
    for letter in letters.ljust(3, "\0"):
        code = code << 3 | _DIGIT.get(letter, 0)
    return code


def _letters(code: int) -> str:
    return "".join(_LETTER[d] for d in (code >> 6, code >> 3 & 7, code & 7) if d)


def _edges_of(initial: str, fault: int) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, letters as digits) of all edits of one row."""
    edges = [(state, state, DELETE, _code("D")) for state in range(4)]
    if fault in (BLANK, DUPLICATE):
        return edges
    stay = TRUNCATED if fault == CUT_OFF else 0
    for state in range(4):
        for before, cost, at in (("", 0, state), ("I", INSERT, _NEXT[state])):
            if (at, initial) in _KEEP:
                edges.append((state, _KEEP[at, initial], cost + stay, _code(before + "K")))
            edges.append((state, _NEXT[at], cost + REROLE + stay, _code(before + "R")))
    return edges


_EDGES = {(initial, fault): _edges_of(initial, fault) for initial in ("s", "u", "a", "") for fault in range(4)}

# Least weight from each state (row) to each state (column); None where there is no way.
Matrix = list[list[int | None]]


def segment_matrix(rows: list[tuple[str, int]]) -> Matrix:
    """Least weights through a run of (initial, fault) rows; costs begin above 9 bits a row."""
    width = _GROUP * len(rows)
    best: Matrix = [[0 if i == j else None for j in range(4)] for i in range(4)]
    for k, (initial, fault) in enumerate(rows):
        shift = width - _GROUP * (k + 1)
        steps = [(a, b, (cost << width) + (code << shift)) for a, b, cost, code in _EDGES[initial, fault]]
        for i, line in enumerate(best):
            after: list[int | None] = [None] * 4
            for a, b, weight in steps:
                if line[a] is not None:
                    total = line[a] + weight
                    if after[b] is None or total < after[b]:
                        after[b] = total
            best[i] = after
    return best


def joined(left: Matrix, left_rows: int, right: Matrix, right_rows: int) -> Matrix:
    """The product of two matrices: costs add up, the letters of the right one follow those of the left."""
    low, high = _GROUP * left_rows, _GROUP * right_rows
    # Raised to the width of both, so that adding them is all there is to do.
    first = [[w if w is None else ((w >> low) << low + high) + ((w & (1 << low) - 1) << high) for w in line] for line in left]
    second = [[w if w is None else ((w >> high) << low + high) + (w & (1 << high) - 1) for w in line] for line in right]
    return [
        [
            min((a + b[j] for a, b in zip(line, second) if a is not None and b[j] is not None), default=None)
            for j in range(4)
        ]
        for line in first
    ]


def product(segments: list[tuple[Matrix, int]]) -> tuple[Matrix, int]:
    """Product of the matrices in order; neighbours of like size first, so digits are moved log n times."""
    level = segments
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2])
        level = [(joined(*a, *b), a[1] + b[1]) for a, b in pairs] + (level[-1:] if len(level) % 2 else [])
    return level[0]


def cheapest(matrix: Matrix, rows: int) -> tuple[int, int]:
    """(cost, digits with those of the insertions at the end) of the least way to an allowed end."""
    width = _GROUP * (rows + 1)
    ends = []
    for state, weight in enumerate(matrix[START]):
        if weight is not None:
            cost, digits = weight >> width - _GROUP, weight & (1 << width - _GROUP) - 1
            end = _END[state]
            ends.append((cost + INSERT * len(end) << width) + (digits << _GROUP) + _code(end))
    least = min(ends)
    return least >> width, least & (1 << width) - 1


def _groups(digits: int, count: int) -> list[int]:
    """The groups of three octal digits, first row first."""
    octal = f"{digits:0{3 * count}o}"
    return [int(octal[3 * i : 3 * i + 3], 8) for i in range(count)]


_KEY = [("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int64()), ("n_rows", pa.int64())]
_COUNTS = [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")]
# What a segment tells its conversation, and what the conversation tells its segments.
_SEGMENT = pa.schema(
    [*_KEY, ("matrix", pa.list_(pa.binary())), ("first_initial", pa.string()), ("last_initial", pa.string())]
    + [("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), *_COUNTS]
)
_PLAN = pa.schema(
    [*_KEY, ("edits", pa.string()), ("ending", pa.string()), ("audit", pa.string())]
    + [("cost", pa.int64()), ("gaps", pa.int64()), *_COUNTS]
)
_LEGAL = {"su", "ua", "au"}
_FAULTS = {BLANK: "blank", DUPLICATE: "duplicate", CUT_OFF: "truncated"}


def mark_rows(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with what can be said of each alone, and whether an earlier turn had the same."""
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # By partial aggregation and a join that can be split: one answer may fill a third of a conversation.
    first = rows.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("unnumbered")
    )
    a, b = rows.alias("a"), first.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    same = same & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    initial = F.substring("a.role", 1, 1)
    return a.join(b, same).select(
        "a.conv_id",
        F.shiftright("a.turn", BLOCK_BITS).alias("block"),
        "a.turn",
        "a.role",
        "a.text",
        "a.digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("").alias("initial"),
        (~F.col("a.text").rlike(_FILLED)).alias("is_blank"),
        F.col("a.text").rlike(_UNENDED).alias("is_cut"),
        (F.col("a.turn").isNotNull() & (F.col("unnumbered") | (F.col("a.turn") > F.col("first_turn")))).alias("is_later"),
    )


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrix and counts of each run of rows of one conversation and block, cut every SEGMENT rows."""
    key, part, rows, same, counts = None, 0, [], None, {}

    def done() -> dict:
        weights = (w for line in segment_matrix(rows) for w in line)
        matrix = [b"" if w is None else w.to_bytes(w.bit_length() // 8 + 1) for w in weights]
        return {"conv_id": key[0], "block": key[1], "part": part, "n_rows": len(rows), "matrix": matrix, **counts}

    for batch in batches:
        found = []
        for conv, block, turn, role, digest, initial, blank, cut, later in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, block) != key or len(rows) == SEGMENT:
                if rows:
                    found.append(done())
                if (conv, block) != key:
                    key, part, same = (conv, block), 0, None
                else:
                    part += 1
                rows, counts = [], dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
                counts |= {"first_initial": initial, "first_turn": turn, "last_initial": initial, "last_turn": None}
            repeated = later or (turn, role, digest) == same
            fault = BLANK if blank else DUPLICATE if repeated else CUT_OFF if cut else NO_FAULT
            if fault:
                counts[_FAULTS[fault]] += 1
            counts["illegal"] += bool(rows) and counts["last_initial"] + initial not in _LEGAL
            counts["turns"] += turn != counts["last_turn"]
            counts["last_initial"], counts["last_turn"] = initial, turn
            rows.append((initial, fault))
            same = turn, role, digest
        if found:
            yield _batch(found, _SEGMENT)
    if rows:
        yield _batch([done()], _SEGMENT)


def _plans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation, whose segments come in order: the edits of each, the report with the last."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != held[0]["conv_id"]:
                yield _batch(_planned(held), _PLAN)
                held = []
            held.append(row)
    if held:
        yield _batch(_planned(held), _PLAN)


def _planned(segments: list[dict]) -> list[dict]:
    matrices = []
    for s in segments:
        weights = [int.from_bytes(w) if w else None for w in s["matrix"]]
        matrices.append(([weights[4 * i : 4 * i + 4] for i in range(4)], s["n_rows"]))
    cost, digits = cheapest(*product(matrices))
    *words, ending = map(_letters, _groups(digits, sum(n for _, n in matrices) + 1))
    audit = "".join(words) + ending
    report = {name: sum(s[name] for s in segments) for name in ("blank", "duplicate", "truncated", "illegal")}
    turns = sum(s["turns"] for s in segments)
    for one, other in zip(segments, segments[1:]):
        report["illegal"] += one["last_initial"] + other["first_initial"] not in _LEGAL
        turns -= one["last_turn"] is not None and one["last_turn"] == other["first_turn"]
    numbered = [s for s in segments if s["last_turn"] is not None]
    gaps = numbered[-1]["last_turn"] - numbered[0]["first_turn"] + 1 - turns if numbered else 0
    # Users and assistants alternate and end with an assistant, so an odd number of rows begins with a system row.
    system = sum(letter != "D" for letter in audit) % 2
    out, made, at = [], 0, 0
    for s in segments:
        edits = []
        for word in words[at : at + s["n_rows"]]:
            edits.append("ua"[(made - system) % 2] + word.ljust(3, "."))
            made += len(word) - ("D" in word)
        at += s["n_rows"]
        out.append({**{name: s[name] for name in ("conv_id", "block", "part", "n_rows")}, "edits": "".join(edits)})
    out[-1].update(audit=audit, ending=ending, cost=cost, gaps=gaps, **report)
    return out


class Repair(NamedTuple):
    """`report`: one row per conversation that has rows; `rows`: the repaired rows, ordered by block, part and place."""

    report: DataFrame
    rows: DataFrame


def repair(df: DataFrame) -> Repair:
    """Repairs conversations of rows (conv_id, turn, role, text)."""
    marked = staged(mark_rows(df), "conversation-rows")
    order = ["turn", "role", "digest"]
    light = marked.select("conv_id", "block", *order, "initial", "is_blank", "is_cut", "is_later")
    segments = (
        light.repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", *order)
        .mapInArrow(_segments, from_arrow_schema(_SEGMENT))
    )
    plans = staged(
        segments.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").mapInArrow(_plans, from_arrow_schema(_PLAN)),
        "conversation-plans",
    )
    report = plans.where(F.col("audit").isNotNull()).drop("block", "part", "n_rows", "edits", "ending")
    return Repair(report, _repaired(marked, plans, order))


def _repaired(marked: DataFrame, plans: DataFrame, order: list[str]) -> DataFrame:
    number = F.row_number().over(W.partitionBy("conv_id", "block").orderBy(*order)) - 1
    a = (
        marked.withColumn("number", number)
        .select("conv_id", "block", "role", "text", F.expr(f"number div {SEGMENT} as part"), F.expr(f"number % {SEGMENT} as k"))
        .alias("a")
    )
    b = plans.select("conv_id", "block", "part", "edits").alias("b")
    same = F.col("a.part") == F.col("b.part")
    for name in ("conv_id", "block"):
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    kept = (
        a.join(b, same)
        .select("a.conv_id", "a.block", "a.part", "k", "role", "text", F.expr("substring(edits, int(4 * k + 1), 4) as edit"))
        .where("substring(edit, 2, 1) != 'D'")
    )
    row = """
        named_struct('place', 2 * k + 1, 'role', case
            when edit like '%K%' then role
            when edit like 'uI%' or edit like 'aR%' then 'assistant' else 'user' end, 'text', text)
    """
    inserted = "named_struct('place', 2 * k, 'role', if(edit like 'u%', 'user', 'assistant'), 'text', '')"
    rows = kept.selectExpr(
        "conv_id", "block", "part", f"inline(if(edit like '_I%', array({inserted}, {row}), array({row})))"
    )
    # What is added at the end always ends with an assistant.
    ends = plans.where("ending != ''").selectExpr(
        "conv_id",
        "block",
        "part",
        """inline(slice(array(
            named_struct('place', 2 * n_rows, 'role', 'user', 'text', ''),
            named_struct('place', 2 * n_rows + 1, 'role', 'assistant', 'text', '')
        ), 3 - length(ending), 2))""",
    )
    return rows.unionByName(ends)


def text_digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the rows as `role:text`, joined by line ends.

    A digest is one sequence, so the rows of a conversation pass one task, in order and one batch at a time.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches):
        conv, digest = None, None
        for batch in batches:
            found = []
            for own, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if digest is None or own != conv:
                    if digest is not None:
                        found.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if found:
                yield batch_of(schema, list(zip(*found)))
        if digest is not None:
            yield batch_of(schema, [[conv], [digest.hexdigest()]])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part", "place")
    return small_batches(ordered).mapInArrow(run, "conv_id long, repaired_sha256 string")
