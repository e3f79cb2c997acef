"""Conversation structure repair: the cheapest edits that make roles read ``system? (user assistant)*``.

Each row of a conversation becomes a symbol of its role's initial and its first fault. Equal
consecutive symbols are one run. Over four states (nothing yet, behind a system turn, behind a user
turn, behind an assistant turn) a symbol is a 4 by 4 matrix of least costs, inserts before the row
included; a run is the matrix's power in min-plus algebra, put together from cached binary powers.
Costs to go at the runs' starts follow from the back; the choices are then unrolled from the front,
of equally cheap ones the least letter.

Rows are dealt out by ranges of (conversation, turn, role, text), so a conversation of any length is
cut into as many segments as it needs; a third of all rows in one conversation is a third of the
tasks. Of each task the first and the last conversation may go on in its neighbours: their segments'
matrices (two a task) are composed on the driver, which hands each segment the costs to go behind it,
gets the state behind it for each state before it, and so knows where each segment begins. The text
digest of such a conversation is a hash in sequence: its pieces are streamed through it in order,
a batch at a time. Repeated rows are merged with a count before they are moved.

Defined results: a null role or text is one space, and so is a null conv_id or turn in the damage
key. Rows with one turn stand in the order of role and text (by code point); equal rows are
adjacent. A row is a duplicate if a row before it in this order has its role and text. Any role that
begins with s, u or a has that initial; other roles, the empty one too, fit nowhere. Very long texts
are read whole. A null conv_id is a conversation of its own. Other columns are ignored; a table
without rows gives none.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import map_batches, spread, stored

BLANKS = " \t\n\x0b\x0c\r"
INF = 1 << 60
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
#: States: nothing yet, behind system, behind user, behind assistant. The one role that may be put next.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
ROLES = "sua"
#: A range of rows holds about so many bytes of text.
RANGE_BYTES = 32 << 20
HEAD = 64
PIECE = 1 << 16
MERGED_ROWS, MERGED_BYTES = 4096, 8 << 20
MARK, ROW, ABSENT = 0, 1, 2

# --- symbols and their matrices -----------------------------------------------------------------


def symbol(initial: str, fault: str) -> int:
    """0: the row must go; else its role (s, u, a or another) and whether it is truncated."""
    if fault in ("blank", "duplicate"):
        return 0
    at = ROLES.find(initial) if initial else -1
    return 1 + 2 * (at if at >= 0 else 3) + (fault == "truncated")


def _kept(state: int, role: int) -> int | None:
    """The state behind a row kept with its role; None where it doesn't fit."""
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def _multiply(a: list, b: list) -> list:
    return [[min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)] for row in a]


def _apply(a: list, v: list) -> list:
    return [min(x + y for x, y in zip(row, v)) for row in a]


IDENTITY = [[0 if i == j else INF for j in range(4)] for i in range(4)]


def _inserts() -> list:
    """Least cost of getting from one state to another by inserts alone."""
    one = [[0 if i == j else INSERT if NEXT[i] == j else INF for j in range(4)] for i in range(4)]
    return _multiply(one, _multiply(one, one))


INSERTS = _inserts()
#: Costs to go behind the last row.
END = _apply(INSERTS, [0, INF, INF, 0])


def _row_matrix(code: int) -> list:
    out = [[INF] * 4 for _ in range(4)]
    for p in range(4):
        out[p][p] = DELETE
        if code:
            role, extra = (code - 1) // 2, TRUNCATED * ((code - 1) % 2)
            out[p][NEXT[p]] = min(out[p][NEXT[p]], REROLE + extra)
            q = _kept(p, role)
            if q is not None:
                out[p][q] = min(out[p][q], extra)
    return _multiply(INSERTS, out)


#: For each symbol the matrices of 1, 2, 4, ... rows; longer powers are added when a run needs them.
POWERS = [[_row_matrix(code)] for code in range(9)]


def power(code: int, k: int) -> list:
    known = POWERS[code]
    while len(known) <= k:
        known.append(_multiply(known[-1], known[-1]))
    return known[k]


def run_before(code: int, length: int, to_go: list) -> list:
    """Costs to go before a run, from those behind it."""
    k = 0
    while length:
        if length & 1:
            to_go = _apply(power(code, k), to_go)
        length, k = length >> 1, k + 1
    return to_go


def matrix_of(runs: list[tuple[int, int]]) -> list:
    out = IDENTITY
    for code, length in runs:
        k = 0
        while length:
            if length & 1:
                out = _multiply(out, power(code, k))
            length, k = length >> 1, k + 1
    return out


def runs_of(symbols: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(symbol, count) with equal neighbours put together."""
    runs: list[list[int]] = []
    for code, n in symbols:
        if runs and runs[-1][0] == code:
            runs[-1][1] += n
        else:
            runs.append([code, n])
    return [tuple(r) for r in runs]


def unrolled(runs: list[tuple[int, int]], state: int, to_go: list) -> Iterator[tuple[str, int, int]]:
    """(edit, rows it takes, state behind it): the cheapest edits from ``state``, of equals the least letter.

    ``to_go`` are the costs to go behind the last run.
    """
    behind = [to_go]
    for code, length in reversed(runs):
        behind.append(run_before(code, length, behind[-1]))
    behind.reverse()
    for i, (code, length) in enumerate(runs):
        if not code:
            # an insert is as cheap behind these rows as before them, and D is the least letter
            yield "D", length, state
            continue
        inside = [behind[i + 1]]
        for _ in range(length - 1):
            inside.append(_apply(power(code, 0), inside[-1]))
        role, extra = (code - 1) // 2, TRUNCATED * ((code - 1) % 2)
        for after in reversed(inside):
            left = _apply(power(code, 0), after)
            while True:
                if DELETE + after[state] == left[state]:
                    yield "D", 1, state
                    break
                if INSERT + left[NEXT[state]] == left[state]:
                    state = NEXT[state]
                    yield "I", 0, state
                    continue
                kept = _kept(state, role)
                if kept is not None and extra + after[kept] == left[state]:
                    state = kept
                    yield "K", 1, state
                else:
                    state = NEXT[state]
                    yield "R", 1, state
                break


def closing(state: int) -> Iterator[tuple[str, int, int]]:
    """The inserts behind a conversation's last row."""
    while END[state]:
        state = NEXT[state]
        yield "I", 0, state


# --- rows ---------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Every row after its damage: conv, turn, role, text, n (copies), dropped, and what is read from the text."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    rows = conversations.select(
        conv.alias("conv"), turn.alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"), kind.alias("damage"),
    )
    rows = rows.select(
        "conv", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("damage") == 3, 2).otherwise(1).cast("long").alias("n"), (F.col("damage") == 0).alias("dropped"),
    )
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    whole = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), space), F.length("role").cast("string"), F.concat("role", "text"))
    return rows.select(
        "*", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), F.sha2(whole, 256).alias("same"), F.substr("text", F.lit(1), F.lit(HEAD)).alias("head"),
    )


def _later(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, head, same) of rows whose role and text stand at an earlier turn of their conversation."""
    narrow = rows.where(~F.col("dropped") & ~F.col("blank")).select("conv", "turn", "role", "head", "same")
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    firsts = narrow.groupBy("same").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("same", "first")
    return narrow.join(firsts, "same").where(place > F.col("first")).select("conv", "turn", "role", "head", "same").distinct()


_DEALT = pa.schema([
    ("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("head", pa.string()), ("kind", pa.int32()), ("same", pa.string()),
    ("n", pa.int64()), ("blank", pa.bool_()), ("cut", pa.bool_()), ("text", pa.string()),
])
DEALT = "conv long, turn long, role string, head string, kind int, same string, n long, blank boolean, cut boolean, text string"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows that a task meets close to each other become one with a count; of dropped rows only the conversation stays."""
    held: OrderedDict[tuple, list] = OrderedDict()
    size = 0

    def out(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DEALT.types)], schema=_DEALT)

    for batch in batches:
        gone = []
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv, turn, role, text, n, dropped, blank, cut, same, head in zip(*columns):
            key = (conv,) if dropped else (turn, same)
            if key in held:
                held[key][6] += n
                held.move_to_end(key)
                continue
            row = [conv, None, None, None, ABSENT, None, 0, None, None, None] if dropped else [conv, turn, role, head, ROW, same, n, blank, cut, text]
            held[key] = row
            size += len(row[9] or "")
            while len(held) > MERGED_ROWS or size > MERGED_BYTES and len(held) > 1:
                _, old = held.popitem(last=False)
                size -= len(old[9] or "")
                gone.append(old)
        if gone:
            yield out(gone)
    if held:
        yield out(list(held.values()))


def dealt(conversations: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The damaged rows by ranges, in order, with the marks of later duplicates before the rows they mean; kept on disk."""
    rows = damaged(conversations)
    columns = ["conv", "turn", "role", "text", "n", "dropped", "blank", "cut", "same", "head"]
    merged = map_batches(rows.select(*columns), _merge, DEALT)
    none = {"n": "long", "blank": "boolean", "cut": "boolean", "text": "string"}
    marks = _later(rows).withColumns({"kind": F.lit(MARK), **{c: F.lit(None).cast(t) for c, t in none.items()}})
    size = conversations.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts = max(spread(conversations.sparkSession), -(-size // range_bytes))
    order = ["conv", "turn", "role", "head"]
    both = merged.unionByName(marks.select(*merged.columns)).repartitionByRange(parts, *order)
    return both.sortWithinPartitions(*order, "kind", "text").withColumn("part", F.spark_partition_id()).persist(StorageLevel.DISK_ONLY)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(part, conv, rows) of one task: rows are [turn, role, text, fault, count] with equal symbols of equal rows counted."""
    part = conv = None
    rows: list[list] = []
    later: set = set()
    before = None
    begun = False
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        texts = columns[names.index("text")] if "text" in names else [None] * batch.num_rows
        for at, of, turn, role, kind, same, n, blank, cut, text in zip(*(columns[names.index(c)] for c in NARROW), texts):
            if not begun or of != conv:
                if begun:
                    yield part, conv, rows
                part, conv, rows, later, before, begun = at, of, [], set(), None, True
            if kind == MARK:
                later.add((turn, same))
            elif kind == ROW:
                if blank:
                    rows.append([turn, role, text, "blank", n])
                elif (turn, same) == before or (turn, same) in later:
                    rows.append([turn, role, text, "duplicate", n])
                else:
                    rows.append([turn, role, text, "truncated" if cut else "", 1])
                    if n > 1:
                        rows.append([turn, role, text, "duplicate", n - 1])
                before = (turn, same)
    if begun:
        yield part, conv, rows


NARROW = ("part", "conv", "turn", "role", "kind", "same", "n", "blank", "cut")


def _runs(rows: list[list]) -> list[tuple[int, int]]:
    return runs_of([(symbol(role[:1], fault), n) for _, role, _, fault, n in rows])


# --- conversations that go on from one task to the next -------------------------------------------

_ENDS = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("place", pa.int32()), ("cells", pa.list_(pa.int64()))])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrices of a task's first and last segment."""
    first = last = None
    for segment in _segments(batches):
        if first is None:
            first = segment
        last = segment
    for place, segment in ((0, first), (1, last)):
        if segment is not None and (place == 0 or last is not first):
            cells = [x for row in matrix_of(_runs(segment[2])) for x in row]
            yield pa.RecordBatch.from_pylist([{"part": segment[0], "conv": segment[1], "place": place, "cells": cells}], schema=_ENDS)


def _chains(ends: list) -> list[list[tuple]]:
    """Segments of one conversation in neighbouring tasks, in order: [(part, conv, matrix), ...] with two or more each."""
    by_part: dict[int, list] = {}
    for row in sorted(ends, key=lambda r: (r["part"], r["place"])):
        by_part.setdefault(row["part"], []).append((row["part"], row["conv"], [row["cells"][i : i + 4] for i in range(0, 16, 4)]))
    chains: list[list[tuple]] = []
    for own in by_part.values():
        for segment in own:
            if chains and chains[-1][-1][1] == segment[1]:
                chains[-1].append(segment)
            else:
                chains.append([segment])
    return [c for c in chains if len(c) > 1]


def _exits(wanted: dict):
    schema = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, conv, rows in _segments(batches):
            if (part, conv) not in wanted:
                continue
            runs, to_go, found = _runs(rows), wanted[part, conv], []
            for entry in range(4):
                state = entry
                for _, _, state in unrolled(runs, entry, to_go):
                    pass
                found.append({"part": part, "conv": conv, "entry": entry, "exit": state})
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return work


def crossings(rows: DataFrame) -> dict[tuple, tuple[int, list, bool, bool]]:
    """(part, conv) of every segment of a conversation in several tasks: its entry state, the costs to go
    behind it, and whether it is the conversation's first and last. At most two a task."""
    narrow = rows.select(*NARROW)
    chains = _chains(map_batches(narrow, _ends, "part int, conv long, place int, cells array<long>").collect())
    to_go: dict[tuple, list] = {}
    for chain in chains:
        left = END
        for part, conv, matrix in reversed(chain):
            to_go[part, conv] = left
            left = _apply(matrix, left)
    if not chains:
        return {}
    found = map_batches(narrow, _exits(to_go), "part int, conv long, entry int, exit int").collect()
    exits = {(r["part"], r["conv"], r["entry"]): r["exit"] for r in found}
    out = {}
    for chain in chains:
        state = START
        for k, (part, conv, _) in enumerate(chain):
            out[part, conv] = (state, to_go[part, conv], k == 0, k == len(chain) - 1)
            state = exits[part, conv, state]
    return out


# --- edits --------------------------------------------------------------------------------------

_EDITS = pa.schema([
    ("part", pa.int32()), ("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("copies", pa.int64()), ("turn", pa.int64()),
    ("fault", pa.string()), ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string()),
])
EDITS = "part int, conv_id long, place long, edit string, copies long, turn long, fault string, old_role string, role string, text string"


def _editor(crossing: dict):
    def one(rows: list[list], state: int, to_go: list, last: bool) -> Iterator[tuple]:
        """(edit, copies, turn, fault, old role, role, text) for each edit; a row that goes has neither role nor text."""
        at, used = 0, 0
        choices = unrolled(_runs(rows), state, to_go)
        for edit, count, state in choices:
            if edit == "I":
                yield "I", 1, None, None, None, NAMES[state], ""
                continue
            while count:
                turn, role, text, fault, n = rows[at]
                some = min(count, n - used)
                if edit == "D":
                    yield "D", some, turn, fault, role, None, None
                else:
                    yield edit, some, turn, fault, role, role if edit == "K" else NAMES[state], text
                count, used = count - some, used + some
                if used == n:
                    at, used = at + 1, 0
        if last:
            for _, _, state in closing(state):
                yield "I", 1, None, None, None, NAMES[state], ""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, made, size = 0, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _EDITS.types)], schema=_EDITS)

        for part, conv, rows in _segments(batches):
            state, to_go, _, last = crossing.get((part, conv), (START, END, True, True))
            edits = one(rows, state, to_go, last) if rows or last else ()
            empty = True
            for edit in edits:
                empty = False
                made.append((part, conv, place, *edit))
                place, size = place + 1, size + len(edit[6] or "")
                if len(made) >= 4096 or size > 1 << 22:
                    yield out()
                    made, size = [], 0
            if empty:  # the conversation is named though nothing of it is left here
                made.append((part, conv, place, "", 0, None, None, None, None, None))
                place += 1
        if made:
            yield out()

    return work


def edits(rows: DataFrame, crossing: dict) -> DataFrame:
    """Every edit (``EDITS``) in order: by part, within it by place. Edit is empty where a conversation has no row.

    ``rows`` come from ``dealt``, ``crossing`` from ``crossings``. ``copies`` counts equal edits of equal rows.
    """
    return map_batches(rows, _editor(crossing), EDITS)


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, part, place, role, text: the repaired conversations; rows stand by part and place."""
    rows = dealt(conversations)
    return edits(rows, crossings(rows)).where("edit IN ('I', 'K', 'R')").select("conv_id", "part", "place", "role", "text")


# --- digests ------------------------------------------------------------------------------------

_PIECES = pa.schema([("conv", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_()), ("piece", pa.binary()), ("sums", pa.string())])
PIECES = "conv long, part int, seq long, whole boolean, piece binary, sums string"
COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT, "": 0}
COUNTED = ("blank", "duplicate", "truncated", "illegal", "cost")


class Sums:
    """Counts, the turns' range and the audit of a segment; segments of a conversation add up in order."""

    def __init__(self) -> None:
        self.n = dict.fromkeys(COUNTED, 0)
        self.initials = self.turns = None  # the first and the last; (first, last, distinct)
        self.audit: list[str] = []

    def row(self, edit: str, copies: int, turn: int | None, fault: str | None, role: str | None) -> None:
        self.audit.append(edit * copies)
        self.n["cost"] += COST[edit] * copies
        if role is None:
            return
        if fault:
            self.n[fault] += copies
        if fault == "truncated" and edit != "D":
            self.n["cost"] += TRUNCATED * copies
        self.n["illegal"] += copies - 1
        self._then((role[:1], role[:1]), None if turn is None else (turn, turn, 1))

    def _then(self, initials: tuple | None, turns: tuple | None) -> None:
        if initials is not None:
            if self.initials is not None:
                self.n["illegal"] += self.initials[1] + initials[0] not in ("su", "ua", "au")
            self.initials = (self.initials or initials)[0], initials[1]
        if turns is not None:
            old = self.turns
            self.turns = tuple(turns) if old is None else (old[0], turns[1], old[2] + turns[2] - (old[1] == turns[0]))

    def add(self, other: dict) -> None:
        for name, value in other["n"].items():
            self.n[name] += value
        self._then(other["initials"], other["turns"])
        self.audit.append(other["audit"])

    def to_json(self) -> str:
        return json.dumps({"n": self.n, "initials": self.initials, "turns": self.turns, "audit": "".join(self.audit)})

    def result(self, digest: str) -> str:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return json.dumps({"gaps": gaps, **self.n, "audit": "".join(self.audit), "repaired_sha256": digest})


def _line(role: str, text: str, first: bool) -> bytes:
    return f"{'' if first else chr(10)}{role}:{text}".encode()


def _digester(crossing: dict):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        conv = part = sums = digest = cross = None
        seq, first = 0, True
        held = bytearray()
        made: list[tuple] = []

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _PIECES.types)], schema=_PIECES)
            made.clear()
            return batch

        def close() -> None:
            if cross:
                made.append((conv, part, seq, False, bytes(held), sums.to_json()))
                held.clear()
            else:
                made.append((conv, part, 0, True, None, sums.result(digest.hexdigest())))

        for batch in batches:
            for at, of, _, edit, copies, turn, fault, old_role, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or of != conv:
                    if begun:
                        close()
                    begun, conv, part, sums, digest, seq = True, of, at, Sums(), hashlib.sha256(), 0
                    cross = crossing.get((at, of))
                    first = not cross or cross[2]
                sums.row(edit, copies, turn, fault, old_role)
                if role is None:
                    continue
                # a crossing conversation's first line may stand in any of its segments: its line end goes later
                line = _line(role, text, first and not cross)
                first = False
                if not cross:
                    digest.update(line)
                    continue
                for i in range(0, len(line), PIECE):
                    held += line[i : i + PIECE]
                    if len(held) >= PIECE:
                        made.append((conv, part, seq, False, bytes(held), None))
                        seq += 1
                        held.clear()
                        if len(made) >= 64:
                            yield out()
            if made:
                yield out()
        if begun:
            close()
            yield out()

    return work


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the crossing conversations, in order, to one row each."""
    schema = pa.schema([("conv", pa.int64()), ("sums", pa.string())])
    begun, conv, sums, digest, first = False, None, None, None, True

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sums.result(digest.hexdigest())])], schema=schema)

    for batch in batches:
        for of, piece, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "piece", "sums"))):
            if not begun or of != conv:
                if begun:
                    yield out()
                begun, conv, sums, digest, first = True, of, Sums(), hashlib.sha256(), True
            if piece:
                digest.update(piece[1:] if first else piece)
                first = False
            if text is not None:
                sums.add(json.loads(text))
    if begun:
        yield out()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def report(spark: SparkSession, conversations: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = dealt(conversations, range_bytes)
    crossing = crossings(rows)
    pieces = stored(map_batches(edits(rows, crossing), _digester(crossing), PIECES), "repaired-digests")
    rows.unpersist()
    whole = pieces.where("whole").select("conv", "sums")
    parts = pieces.where("NOT whole")
    order = ["conv", "part", "seq"]
    streamed = parts.repartition(spread(spark), "conv").sortWithinPartitions(*order).select("conv", "piece", "sums")
    both = whole.unionByName(map_batches(streamed, _stream, "conv long, sums string"))
    return both.select(F.col("conv").alias("conv_id"), F.from_json("sums", RESULT).alias("r")).select("conv_id", "r.*")

# --- the same in SQL: a forward search row by row, with the texts in hand -------------------------


def _put(state: str, cost: str, letter: str, line: str | None) -> str:
    """A state's best (cost, audit, text) with one more edit."""
    text = f"{state}.t" if line is None else f"CASE WHEN {state}.t IS NULL THEN {line} ELSE {state}.t || chr(10) || {line} END"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"


def _best(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


_NEVER = f"{{'c': {1 << 40}::BIGINT, 'a': '~', 't': NULL::VARCHAR}}"
_U1 = _best("u", *(_put(x, "5", "I", "'user:'") for x in "esa"))
_A1 = _best("a", _put("u1", "5", "I", "'assistant:'"))


def _step(state: str, options: list[str]) -> str:
    gone = _put(state, "2", "D", None)
    return f"CASE WHEN fault IN ('blank', 'duplicate') THEN {gone} ELSE {_best(gone, *options)} END"


def _taken(state: str, name: str, initial: str) -> list[str]:
    kept = _put(state, "extra", "K", "role || ':' || text")
    rerole = [] if name == "system" else [_put(state, "1 + extra", "R", f"'{name}:' || text")]
    return [*rerole, f"CASE WHEN left(role, 1) = '{initial}' THEN {kept} ELSE {_NEVER} END"]


_BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
keyed AS (
  SELECT c.*, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 20 AS damage
  FROM conversations c, crc),
copies AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE damage WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE damage <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS seen, right(rtrim(text, {_BLANK_SQL}), 1) AS tip
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM copies)),
faulty AS (
  SELECT *, CASE WHEN tip = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN tip NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS pair
  FROM placed),
steps AS (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM faulty),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}} AS e, {_NEVER} AS s, {_NEVER} AS u, {_NEVER} AS a FROM conversations
  UNION ALL
  SELECT conv_id, k, {_put("e", "2", "D", None)}, {_step("s", _taken("e", "system", "s"))},
    {_step("u1", [o for x in ("e", "s", "a1") for o in _taken(x, "user", "u")])}, {_step("a1", _taken("u1", "assistant", "a"))}
  FROM (SELECT *, {_A1} AS a1 FROM (SELECT *, {_U1} AS u1 FROM (
    SELECT w.conv_id, f.k, w.e, w.s, w.u, w.a, f.role, f.text, f.fault, f.extra FROM walk w JOIN steps f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1)))),
ends AS (
  SELECT conv_id, {_best("e", "a1")} AS best FROM (SELECT *, {_A1} AS a1 FROM (SELECT *, {_U1} AS u1 FROM walk w
    WHERE k = (SELECT count(*) FROM steps f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id)))),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM steps GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
