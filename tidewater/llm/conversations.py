"""Repair of conversations: the cheapest edits that make the roles read ``(system? (user assistant)+)?``.

Rows are dealt by conversation and sorted by turn inside each task; two passes in the same stage carry their state from
one Arrow batch to the next, so that a conversation of any length takes no more memory than a batch. The first reads the
turns backwards and keeps the least cost to finish from each of four states; what it decides for a row is one byte that
travels with the row. Spark's external sort, which spills, then brings the rows and their bytes into the order of turns,
and the second pass follows the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Costs of an edit; a truncated row that stays costs one more.
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
#: In order of precedence; rows with one of the first two have to go.
FAULTS = ["blank", "duplicate", "truncated"]

#: States by the last role: none yet, system, user, assistant. The next turn that is not the system's is given by the state.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = (None, "system", "user", "assistant")
#: Least cost to end a conversation in each state.
END = (0, 2 * COST[INSERT], COST[INSERT], 0)
_EDITS = DELETE + INSERT + KEEP + REROLE
_INITIALS = "sua"
_LOG = "seq long, edit string, turn long, role string, text string, found string, fault string"


@cache
def decide(after: tuple[int, ...], initial: str, fault: str | None) -> tuple[tuple[int, ...], int]:
    """Costs to finish from before a row, given those from behind it, and the row's edit in each state, two bits for each.

    Costs count from the least of the four, so there are few different ones and each step is worked out once per worker.
    An insertion leaves the row to the next state. Of equally cheap edits the one least in ASCII is taken; as edit and state
    give the next state, this is also the least of all cheapest sequences.
    """
    ways: list[dict[str, int]] = []
    for state in range(4):
        way = {DELETE: COST[DELETE] + after[state]}
        if fault not in FAULTS[:2]:
            extra = TRUNCATED_COST if fault else 0
            way[REROLE] = COST[REROLE] + extra + after[NEXT[state]]
            if initial == "s" and state == START:
                way[KEEP] = extra + after[SYSTEM]
            elif initial and initial == ROLES[NEXT[state]][0]:
                way[KEEP] = extra + after[NEXT[state]]
        ways.append(way)
    cost = [min(way.values()) for way in ways]
    for _ in range(4):
        cost = [min(c, COST[INSERT] + cost[NEXT[state]]) for state, c in enumerate(cost)]
    packed = 0
    for state, way in enumerate(ways):
        way[INSERT] = COST[INSERT] + cost[NEXT[state]]
        edit = min(e for e, c in way.items() if c == cost[state])
        packed |= _EDITS.index(edit) << 2 * state
    least = min(cost)
    return tuple(c - least for c in cost), packed


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the decisions of each row; rows come by conversation, the last turn first."""
    conversation, after = object(), END
    for batch in batches:
        moves = []
        for key, found, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "found", "fault"))):
            if key != conversation:
                conversation, after = key, END
            after, packed = decide(after, found, fault)
            moves.append(packed)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(moves, pa.int32())], [*batch.schema.names, "moves"])


class _Log:
    """Edits of a batch, as columns."""

    def __init__(self) -> None:
        self.keys, self.seq, self.edits, self.rows, self.roles = [], [], [], [], []

    def add(self, key, seq: int, edit: str, row: int | None, role: str | None) -> None:
        self.keys.append(key)
        self.seq.append(seq)
        self.edits.append(edit)
        self.rows.append(row)
        self.roles.append(role)

    def batch(self, source: pa.RecordBatch, key_type: pa.DataType) -> pa.RecordBatch:
        taken = source.take(pa.array(self.rows, pa.int64()))
        inserted = pa.array([r is None for r in self.rows])
        text = taken.column("text")
        text = pc.if_else(inserted, pa.scalar("", text.type), text)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.keys, key_type), pa.array(self.seq, pa.int64()), pa.array(self.edits, pa.string()), taken.column("turn"),
                pa.array(self.roles, pa.string()), text, taken.column("found"), taken.column("fault"),
            ],
            ["conv_id", "seq", "edit", "turn", "role", "text", "found", "fault"],
        )


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows the decisions; rows come by conversation, the first turn first."""
    conversation, state, seq, begun = None, START, 0, False
    last = None

    def insert(log: _Log) -> None:
        nonlocal state, seq
        state = NEXT[state]
        log.add(conversation, seq, INSERT, None, ROLES[state])
        seq += 1

    for batch in batches:
        log, last = _Log(), batch
        for i, (key, moves, role) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "moves", "role")))):
            if not begun or key != conversation:
                while begun and END[state]:
                    insert(log)
                conversation, state, seq, begun = key, START, 0, True
            while (edit := _EDITS[moves >> 2 * state & 3]) == INSERT:
                insert(log)
            if edit == KEEP:
                state = SYSTEM if role[0] == "s" else NEXT[state]
            elif edit == REROLE:
                state = NEXT[state]
                role = ROLES[state]
            log.add(key, seq, edit, i, role)
            seq += 1
        yield log.batch(batch, batch.column("conv_id").type)
    if begun and END[state]:
        log = _Log()
        while END[state]:
            insert(log)
        yield log.batch(last, last.column("conv_id").type)


def _fault(text: Column, copy: Column) -> Column:
    stripped = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    blank, duplicate, truncated = (F.lit(f) for f in FAULTS)
    return F.when(stripped == "", blank).when(copy > 1, duplicate).when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), truncated)


def repair(turns: DataFrame) -> DataFrame:
    """The edit log: one row per row of ``turns`` and per inserted turn, with ``conv_id, seq, edit, turn, role, text, found, fault``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not read. ``seq`` counts a conversation's rows from 0 in the
    order of turns, NULL turns first and equal turns by role and text. ``edit`` is K (kept), R (kept under another role), D
    (deleted) or I (inserted, with empty text); the repaired conversation is the log without the D rows, ``role`` and ``text``
    are those after the edit. ``found`` is the first letter of the role before it and ``fault`` the row's first of ``FAULTS``,
    both NULL for inserted rows. NULL roles and texts count as one blank, so such rows never stay as they are. Rows with a NULL
    ``conv_id`` are one conversation. Repeated rows are duplicates of their first. No rows: no log.

    Rows of one conversation are in one task, in order, which ``audits`` relies on; they stream through it.
    """
    blank = F.lit(" ")
    rows = turns.select("conv_id", F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    first_seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    by_turn = [F.col("turn"), F.col("role"), F.col("text"), F.col("copy")]
    found = rows.repartition("conv_id").withColumn("copy", F.row_number().over(first_seen))
    found = found.select("*", F.substring("role", 1, 1).alias("found"), _fault(F.col("text"), F.col("copy")).alias("fault"))
    schema = found.schema
    decided = found.sortWithinPartitions("conv_id", *(c.desc_nulls_last() for c in by_turn)).mapInArrow(_backwards, schema.add("moves", IntegerType()))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return decided.sortWithinPartitions("conv_id", *(c.asc_nulls_first() for c in by_turn)).mapInArrow(_forwards, f"conv_id {kind}, {_LOG}")


class _Audit:
    """What the log of one conversation adds up to."""

    def __init__(self) -> None:
        self.first = self.last = self.found = None
        self.n_turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.edits: list[str] = []
        self.digest, self.joined = hashlib.sha256(), b""

    def add(self, edit: str, turn: int | None, role: str, text: str, found: str | None, fault: str | None) -> None:
        self.edits.append(edit)
        self.cost += COST[edit]
        if edit != INSERT:
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.n_turns += 1
            if fault:
                self.faults[fault] += 1
                self.cost += TRUNCATED_COST if edit != DELETE else 0
            self.illegal += self.found is not None and self.found + found not in ("su", "ua", "au")
            self.found = found
        if edit != DELETE:
            self.digest.update(b"%b%b:%b" % (self.joined, role.encode(), text.encode()))
            self.joined = b"\n"

    def row(self) -> list:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.n_turns
        return [gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.edits), self.digest.hexdigest()]


_AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, audit = None, None
    for batch in batches:
        done = []
        for key, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "role", "text", "found", "fault"))):
            if audit is None or key != conversation:
                if audit:
                    done.append([conversation, *audit.row()])
                conversation, audit = key, _Audit()
            audit.add(*row)
        yield _audit_batch(done, batch.column("conv_id").type)
        kind = batch.column("conv_id").type
    if audit:
        yield _audit_batch([[conversation, *audit.row()]], kind)


def _audit_batch(rows: list[list], key_type: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *(f.split()[0] for f in _AUDIT.split(", "))]
    types = [key_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def audits(log: DataFrame) -> DataFrame:
    """One row per conversation of a log that ``repair`` just made (its partitions and order are used as they are).

    ``gaps`` is the number of turns missing between the least and the greatest, ``illegal`` that of neighbours, before the
    repair, whose roles may not follow each other; ``cost`` and ``audit`` are the edits', ``repaired_sha256`` is that of the
    repaired ``role:text`` lines.
    """
    kind = log.schema["conv_id"].dataType.simpleString()
    return log.mapInArrow(_audited, f"conv_id {kind}, {_AUDIT}")


def audits_of_all(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``audits`` of every ``conv_id`` in ``conversations``; one without turns has zeros, no edits and the hash of an empty text."""
    found = audits(repair(turns)).withColumnRenamed("conv_id", "with_turns")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("with_turns")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    names = [f.split()[0] for f in _AUDIT.split(", ")]
    return joined.select("conv_id", *(F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in names))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with reproducible faults, by crc32 of ``conv_id:turn`` modulo 20 (NULL: one blank).

    0: the row is lost; 1: its text is emptied; 2: ``.!?`` are taken out of it; 3: the row is there twice; 4: the role is user.
    """
    blank = F.lit(" ")
    part = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    fate = (F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20).cast("int")
    text, role = (F.coalesce(F.col(c).cast("string"), blank) for c in ("text", "role"))
    times = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.where(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.explode(times).alias("time"),
    ).drop("time")
