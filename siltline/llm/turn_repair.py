"""Conversation structure repair: the cheapest edits that make a log a proper conversation.

A proper conversation has no turns, or perhaps one of the system and then pairs of user and
assistant (initials ``(s?(ua)+)?``).  Every row is kept (cost 0), given the role that is due (1) or
deleted (2, and blank and duplicate rows must be); a row of the role that is due may be inserted
(5); a truncated row that stays costs 5 more.  The audit has a letter for each edit in order, and
of the cheapest audits the least in ASCII order is taken.

``search`` is a branch and bound, depth first with a stack of its own: a prefix is dropped if its
cost and the least that the rows to come can cost exceed the incumbent, or tie with it behind its
audit, or if the table of its node (row and last role) has a prefix as good.  Letters are tried in
ASCII order; when the stack is empty the incumbent is proved to be the best.

Plan:

* Rows that are equal in all columns become one with their number; a row is a duplicate unless it
  is the first of the earliest turn with its role and text, which is a minimum added up per scan task.
* Rows are dealt by ranges of (conversation, turn, role, text), so a very long conversation lies in
  many tasks.  Each cuts its rows into segments of ``SEGMENT`` and searches these from every role
  that may come before them to every one that may end them; the tables at the borders are then
  folded in order, with a few letters per segment in memory.
* Audits are put before the rows of their conversation, which are replayed as a stream.  A digest
  of one conversation is made in one task, whatever its length, but never held.

Rows go by turn, NULL first, then by role and text.  NULL roles and texts are one space (blank, and
a role that is never due).  NULL ids are one conversation.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from siltline.llm.tables import stored
from siltline.llm.text import SPACES

SEGMENT = 64  # rows that are searched together
SEGMENTS, ROWS = 256, 4096  # that a worker gives on together
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # what the rows so far end with
PROPER = (START, ASSISTANT)
DUE = (USER, USER, ASSISTANT, USER)  # by the state
ROLES = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEVER = 1 << 60


# --- the search ----------------------------------------------------------------------------------


def _least(symbol: str) -> int:
    if symbol in "sua":
        return 0
    return RENAME if symbol == "o" else DELETE


def _first_guess(symbols: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str]:
    """Some edits to begin with: what fits stays, what is faulty goes."""
    cost, audit, state = 0, [], entry
    for x in symbols:
        if x not in "suao":
            cost, edit = cost + DELETE, "D"
        elif (state, x) in _KEPT:
            state, edit = _KEPT[state, x], "K"
        else:
            state, cost, edit = DUE[state], cost + RENAME, "R"
        audit.append(edit)
    for _ in range(2):
        if state not in exits:
            state, cost = DUE[state], cost + INSERT
            audit.append("I")
    found = (cost, "".join(audit)) if state in exits else (_NEVER, "")
    return min(found, (DELETE * len(symbols), "D" * len(symbols))) if entry in exits else found


def search(symbols: str, entry: int = START, exits: tuple[int, ...] = PROPER) -> tuple[int, str, int] | None:
    """(cost, audit, last state) of the best edits from a state to one of ``exits``; None if there are none.

    A row is its role's initial (s, u, a, else o), in capitals if it is truncated, or d if it must
    be deleted.
    """
    n = len(symbols)
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + _least(symbols[i])
    best_cost, best_audit = _first_guess(symbols, entry, exits)
    tables: dict[int, int] = {}  # least cost of a prefix at a node; a later one of that cost has a greater audit
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bound[i]
        if least > best_cost or least == best_cost and audit > best_audit[: len(audit)]:
            continue
        node = i << 2 | state
        if tables.get(node, _NEVER) <= cost:
            continue
        tables[node] = cost
        if i == n and state in exits and (cost, audit) < (best_cost, best_audit):
            best_cost, best_audit = cost, audit
        due = DUE[state]
        if i < n:
            x = symbols[i]
            if x != "d":
                stays, role = (0, x) if x in "suao" else (CUT_OFF, x.lower())
                stack.append((i + 1, due, cost + stays + RENAME, audit + "R"))
                kept = _KEPT.get((state, role))
                if kept is not None:
                    stack.append((i + 1, kept, cost + stays, audit + "K"))
        stack.append((i, due, cost + INSERT, audit + "I"))
        if i < n:
            stack.append((i + 1, state, cost + DELETE, audit + "D"))
    if best_cost == _NEVER:
        return None
    return best_cost, best_audit, _state_after(symbols, best_audit, entry)


def _state_after(symbols: str, audit: str, state: int) -> int:
    i = 0
    for edit in audit:
        if edit in "IR":
            state = DUE[state]
        elif edit == "K":
            state = _KEPT[state, symbols[i].lower()]
        i += edit != "I"
    return state


class Fold:
    """The best edits of a conversation from those of its segments, in order."""

    def __init__(self):
        self.said: list[str] = []  # what the audits of all states begin with
        self.states: dict[int, tuple[int, str]] = {START: (0, "")}

    def add(self, ways: list[tuple[int, int, int, str]]) -> None:
        """``ways``: (state before, state after, cost, audit) of a segment."""
        found: dict[int, tuple[int, str]] = {}
        for before, after, cost, audit in ways:
            if before in self.states:
                so_far, first = self.states[before]
                way = (so_far + cost, first + audit)
                found[after] = min(way, found.get(after, way))
        common = len(os.path.commonprefix([audit for _, audit in found.values()]))
        if common:
            self.said.append(next(iter(found.values()))[1][:common])
            found = {state: (cost, audit[common:]) for state, (cost, audit) in found.items()}
        self.states = found

    def best(self) -> tuple[int, str]:
        cost, audit = min(self.states[s] for s in PROPER if s in self.states)
        return cost, "".join(self.said) + audit


# --- rows ----------------------------------------------------------------------------------------


def damaged(log: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text): a log with faults, chosen by a checksum of id and turn."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space)
    )
    rows = log.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    fault, said = F.col("fault"), F.col("text")
    return rows.select(
        "conv", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _place() -> Column:
    """Turns in order, NULL first."""
    return F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))


def runs(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, first, blank, truncated): distinct rows and their number.

    ``first``: the role and text have not been seen in an earlier turn of the conversation.
    """
    space = F.lit(" ")
    rows = turns.select(
        "conv", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    ).groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
    said = ["conv", "role", "text"]
    early = rows.groupBy(*said).agg(F.min(_place()).alias("early"))
    early = early.select(*[F.col(c).alias(f"_{c}") for c in said], "early")
    same = (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text")) & F.col("conv").eqNullSafe(F.col("_conv"))
    rows = rows.join(early, same).withColumn("first", _place() == F.col("early"))
    end = F.rtrim("text", F.lit(SPACES))
    return rows.select(
        "conv", "turn", "role", "text", "n", "first", (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions("conv", *first, "turn", "role", "text")


def _symbols(role: str, n: int, first: bool, blank: bool, truncated: bool) -> Iterator[str]:
    """Of the rows of a run, in pieces."""
    if first and not blank:
        own = role[:1] if role[:1] in ("s", "u", "a") else "o"
        yield own.upper() if truncated else own
        n -= 1
    while n > 0:
        yield "d" * min(n, SEGMENT)
        n -= SEGMENT


def _schema(conv: DataType, others: str) -> StructType:
    return StructType([StructField("conv", conv), *StructType.fromDDL(others).fields])


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    names, found = schema.names, to_arrow_schema(schema)
    return pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], found)


def _ways(symbols: str, known: bool, ends: bool) -> list[dict]:
    """The best edits of a segment between all states that may lie around it."""
    found = []
    for entry in [START] if known else range(4):
        for exits in [PROPER] if ends else [(x,) for x in range(4)]:
            way = search(symbols, entry, exits)
            if way:
                found.append({"before": entry, "after": way[2], "cost": way[0], "audit": way[1]})
    return found


def _segments(schema: StructType):
    """Function for mapInArrow: from sorted runs to segments with their ways.

    The first and the last conversation of a task may go on in another one, so nothing is known
    about the state before the one and behind the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, 0
        conv, opened, known, symbols = None, False, False, ""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not opened or row["conv"] != conv:
                    if opened:
                        out.append((conv, task + number, _ways(symbols, known, True)))
                        number += 1
                    conv, opened, known, symbols = row["conv"], True, opened, ""
                for piece in _symbols(row["role"], row["n"], row["first"], row["blank"], row["truncated"]):
                    symbols += piece
                    while len(symbols) > SEGMENT:
                        out.append((conv, task + number, _ways(symbols[:SEGMENT], known, False)))
                        number, known, symbols = number + 1, False, symbols[SEGMENT:]
                        if len(out) >= SEGMENTS:
                            yield _batch(out, schema)
                            out.clear()
            if out:
                yield _batch(out, schema)
        if opened:
            yield _batch([(conv, task + number, _ways(symbols, known, False))], schema)

    return run


def _folded(schema: StructType):
    """Function for mapInArrow: from sorted segments to the best edits of their conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, fold = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if fold is None or row["conv"] != conv:
                    if fold is not None:
                        out.append((conv, *fold.best()))
                    conv, fold = row["conv"], Fold()
                fold.add([(w["before"], w["after"], w["cost"], w["audit"]) for w in row["ways"]])
            if out:
                yield _batch(out, schema)
        if fold is not None:
            yield _batch([(conv, *fold.best())], schema)

    return run


def edits(rows: DataFrame) -> DataFrame:
    """(conv, cost, audit) of every conversation of ``runs``."""
    kind = rows.schema["conv"].dataType
    ways = _schema(kind, "at bigint, ways array<struct<before: int, after: int, cost: bigint, audit: string>>")
    dealt = _sorted(rows.repartitionByRange("conv", "turn", "role", "text"))
    dealt = dealt.select("conv", "role", "n", "first", "blank", "truncated").mapInArrow(_segments(ways), ways)
    dealt = stored(dealt, "segments").repartition("conv").sortWithinPartitions("conv", "at")
    schema = _schema(kind, "cost bigint, audit string")
    return dealt.mapInArrow(_folded(schema), schema)


class Replay:
    """The edits of one conversation, applied to its rows as they come."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit = conv, audit
        self.at, self.state, self.said = 0, START, 0
        self.digest, self.last, self.illegal = hashlib.sha256(), None, 0

    def _say(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(("\n" if self.said else "").encode() + f"{role}:{text}".encode())
        self.said += 1
        return self.conv, self.said, edit, role, text

    def _due(self) -> str:
        self.state = DUE[self.state]
        return ROLES[self.state]

    def inserted(self) -> Iterator[tuple]:
        """The rows inserted at this place."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._say("I", self._due(), "")

    def rows(self, role: str, text: str, n: int) -> Iterator[tuple]:
        """What becomes of n equal rows."""
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += (n - 1) * (initial + initial not in ("su", "ua", "au"))
        self.last = initial
        for _ in range(n):
            yield from self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = _KEPT[self.state, initial]
                yield self._say(edit, role, text)
            elif edit == "R":
                yield self._say(edit, self._due(), text)


def _replayed(schema: StructType, whole: bool):
    """Function for mapInArrow: from audits and runs in order to rows, or to a digest of each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, out = None, []

        def end() -> Iterator[tuple]:
            if replay is not None:
                found = list(replay.inserted())
                yield from found if whole else [(replay.conv, replay.illegal, replay.digest.hexdigest())]

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    out += end()
                    replay = Replay(row["conv"], row["text"])
                    continue
                for said in replay.rows(row["role"], row["text"], row["n"]):
                    if whole:
                        out.append(said)
                        if len(out) >= ROWS:
                            yield _batch(out, schema)
                            out.clear()
            if out:
                yield _batch(out, schema)
                out.clear()
        out += end()
        if out:
            yield _batch(out, schema)

    return run


def _replay(rows: DataFrame, found: DataFrame, schema: StructType, whole: bool) -> DataFrame:
    first = found.select("conv", F.lit(0).alias("kind"), F.col("audit").alias("text"))
    both = first.unionByName(rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "n"), allowMissingColumns=True)
    both = _sorted(both.repartition("conv"), "kind")
    return both.select("conv", "kind", "role", "text", "n").mapInArrow(_replayed(schema, whole), schema)


def repaired(turns: DataFrame) -> DataFrame:
    """(conv, number, edit, role, text): the rows of the repaired conversations, numbered from 1.

    ``turns`` has conv, turn, role and text.
    """
    rows = stored(runs(turns), "runs")
    schema = _schema(rows.schema["conv"].dataType, "number bigint, edit string, role string, text string")
    return _replay(rows, edits(rows), schema, whole=True)


def report(turns: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    rows = stored(runs(turns), "runs")
    found = stored(edits(rows), "edits")
    schema = _schema(rows.schema["conv"].dataType, "illegal bigint, repaired_sha256 string")
    digests = _replay(rows, found, schema, whole=False)
    n, none = F.col("n"), F.lit(0)
    counts = rows.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(none)).alias("blank"),
        F.sum(F.when(F.col("blank"), none).otherwise(n - F.col("first").cast("int"))).alias("duplicate"),
        F.count_if(F.col("first") & ~F.col("blank") & F.col("truncated")).alias("truncated"),
    )
    places = rows.select("conv", "turn").distinct().groupBy("conv")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    places = places.agg(F.coalesce(gaps, none).cast("bigint").alias("gaps"))
    parts = [places, counts, digests, found]
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("conv").agg(*[F.max(c).alias(c) for c in names])
