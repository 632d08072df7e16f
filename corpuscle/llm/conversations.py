"""Repair of conversation structure by cheapest edits, with Four-Russians block tables.

A repaired conversation's role initials match ``(s?(ua)+)?``. Four states read
them: nothing yet, after ``s``, after ``u``, after ``a``. What the rest of a
conversation costs from each state is a vector of four numbers; less its
smallest, only a few dozen such vectors occur, whatever the conversation. They
are numbered, and a table holds, for every vector and every block of
``BLOCK`` row symbols, the vector before the block and what it costs more.

A conversation is worked from its end to its begin by one look-up per block,
and traced from its begin to its end: each block is expanded backward into the
vectors between its rows, and of the edits that keep the cost least the first
in ASCII order is taken. Letters decide the state after an edit, so that gives
the ASCII-least of the cheapest sequences.

Conversations meet in one task, in order, unless they are long. Rows of a long
one are numbered along a range partitioning and cut into segments. A segment's
effect is a map from the vector after it to the vector before it; maps of
a few dozen numbers are chained instead of rows, and segments are then traced
apart. Only the hash of a long conversation's text, which no order but its own
can give, is a stream through one task, of constant memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.exact_dedup import BLANKS
from corpuscle.llm.skew import HOT_KEYS, attach
from corpuscle.operators.ordering import with_dense_index
from corpuscle.sources.shared import materialise

# Rows of a table block; the table has 9**BLOCK columns.
BLOCK = 3
# Conversations of more rows, and more than a HOT_KEYS-th of all rows, are cut into segments.
LONG = 10_000
SEGMENT = 65_536

#: Costs, fixed by the rules.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# States, and where an initial leads from each; others are not allowed there.
_NEW, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_MADE = (("user", _USER), ("user", _USER), ("assistant", _ASSISTANT), ("user", _USER))
_NEVER = 1 << 40
_END = (0, _NEVER, _NEVER, 0)

# Symbols: a row to delete, else its initial (s, u, a, any other), twice: sound and truncated.
_INITIALS = "sua"
SYMBOLS = 9


def symbol(initial: str, fault: str) -> int:
    if fault in ("blank", "duplicate"):
        return 0
    kind = _INITIALS.index(initial) if initial and initial in _INITIALS else 3
    return 1 + kind + 4 * (fault == "truncated")


def _inserted(after: list[int]) -> list[int]:
    """Costs before any number of insertions, from costs after them."""
    costs = list(after)
    for _ in range(2):  # a third insertion in a row leads back to where the first did
        costs = [min(c, INSERT + costs[_MADE[state][1]]) for state, c in enumerate(costs)]
    return costs


def _edits(sign: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of one row in ASCII order of their letters: (letter, cost, state after it)."""
    yield "D", DELETE, state
    if sign:
        more = TRUNCATED if sign > 4 else 0
        kind = (sign - 1) % 4
        to = _NEXT[state].get(_INITIALS[kind]) if kind < 3 else None
        if to is not None:
            yield "K", more, to
        yield "R", more + REROLE, _MADE[state][1]


class Tables(NamedTuple):
    vectors: list[tuple[int, ...]]  # costs less the smallest, by number
    last: int  # number of the vector after the last row
    before: np.ndarray  # [vector, symbol]: the vector before a row
    more: np.ndarray  # [vector, symbol]: what the smallest cost grows by
    block_before: np.ndarray  # [vector, block], the first row of the block counting most
    block_more: np.ndarray


@cache
def tables() -> Tables:
    """All vectors that occur, and the tables for rows and blocks."""

    def normal(costs: Iterable[int]) -> tuple[tuple[int, ...], int]:
        costs = list(costs)
        return tuple(c - min(costs) for c in costs), min(costs)

    first, _ = normal(_inserted(list(_END)))
    number = {first: 0}
    before: list[list[int]] = []
    more: list[list[int]] = []
    waiting = [first]
    for costs in waiting:
        before.append([])
        more.append([])
        for sign in range(SYMBOLS):
            step = [min(cost + costs[to] for _, cost, to in _edits(sign, state)) for state in range(4)]
            found, least = normal(_inserted(step))
            if found not in number:
                number[found] = len(number)
                waiting.append(found)
            before[-1].append(number[found])
            more[-1].append(least)
    one, one_more = np.array(before), np.array(more)
    blocks = list(product(range(SYMBOLS), repeat=BLOCK))
    block_before = np.repeat(np.arange(len(number))[:, None], len(blocks), axis=1)
    block_more = np.zeros_like(block_before)
    for place in range(BLOCK - 1, -1, -1):
        signs = np.array([b[place] for b in blocks])
        block_more += one_more[block_before, signs]
        block_before = one[block_before, signs]
    return Tables(waiting, 0, one, one_more, block_before, block_more)


def _blocks(signs: np.ndarray) -> tuple[np.ndarray, int]:
    """Whole blocks as numbers, from the end; and how many rows before them are left."""
    left = len(signs) % BLOCK
    weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    return signs[left:].reshape(-1, BLOCK) @ weights, left


def pass_back(signs: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors before the rows, and growth of cost, for each vector in ``after``."""
    t = tables()
    blocks, left = _blocks(signs)
    costs = np.zeros(len(after), dtype=np.int64)
    for block in blocks[::-1]:
        costs += t.block_more[after, block]
        after = t.block_before[after, block]
    for sign in signs[:left][::-1]:
        costs += t.more[after, sign]
        after = t.before[after, sign]
    return after, costs


def trace(signs: np.ndarray, after: int, states: list[int]) -> list[tuple[str, int]]:
    """Per state before the rows: letters of the edits, and the state after them."""
    t = tables()
    blocks, left = _blocks(signs)
    at_block = [after]
    for block in blocks[::-1]:
        at_block.append(int(t.block_before[at_block[-1], block]))
    at_block.reverse()  # [i]: the vector before block i
    found = [([], state) for state in states]

    def expand(rows: np.ndarray, vector: int) -> None:
        between = [vector]
        for sign in rows[::-1]:
            between.append(int(t.before[between[-1], sign]))
        between.reverse()
        for place, sign in enumerate(rows.tolist()):
            grown = int(t.more[between[place + 1], sign])
            here, beyond = t.vectors[between[place]], t.vectors[between[place + 1]]
            for i, (letters, state) in enumerate(found):
                found[i] = (letters, _row(letters, state, sign, here, beyond, grown))

    expand(signs[:left], at_block[0])
    for i in range(len(blocks)):
        at = left + i * BLOCK
        expand(signs[at : at + BLOCK], at_block[i + 1])
    return [("".join(letters), state) for letters, state in found]


def _row(letters: list[str], state: int, sign: int, here: tuple, beyond: tuple, grown: int) -> int:
    """Add the insertions before a row and the row's own edit; the state after them."""
    while True:
        for letter, cost, to in _edits(sign, state):
            if letter > "I" and here[state] == INSERT + here[_MADE[state][1]]:
                break
            if here[state] + grown == cost + beyond[to]:
                letters.append(letter)
                return to
        letters.append("I")
        state = _MADE[state][1]


def closing(state: int) -> str:
    """Insertions after the last row."""
    letters = ""
    while _END[state]:
        letters += "I"
        state = _MADE[state][1]
    return letters


class Repaired:
    """Hash of the repaired rows ``role:text``, joined by newlines, as letters and rows come in."""

    def __init__(self) -> None:
        self._sha, self._state, self._any = hashlib.sha256(), _NEW, False
        self._letters, self._at = "", 0

    def letters(self, audit: str) -> None:
        """The next letters; those before must have been used up but for insertions at their end."""
        self._insertions()
        self._letters, self._at = audit, 0

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter = self._letters[self._at]
        self._at += 1
        if letter == "K":
            self._state = _NEXT[self._state][role[:1]]
        elif letter == "R":
            role, self._state = _MADE[self._state]
        if letter != "D":
            self._write(role, text)

    def end(self) -> str:
        self._insertions()
        return self._sha.hexdigest()

    def _insertions(self) -> None:
        while self._letters[self._at : self._at + 1] == "I":
            role, self._state = _MADE[self._state]
            self._at += 1
            self._write(role, "")

    def _write(self, role: str, text: str) -> None:
        self._sha.update(f"{chr(10) if self._any else ''}{role}:{text}".encode())
        self._any = True


def damage(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copy`` with one row in twenty dropped, emptied, cut, repeated or given to the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn)])
    fault = F.crc32(name) % 20
    unended = F.coalesce(F.col(text), F.lit(" "))
    for end in ".!?":
        unended = F.replace(unended, F.lit(end), F.lit(""))
    rows = turns.withColumn("_fault", fault).filter("_fault <> 0")
    return rows.select(
        F.col(key).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(F.col("_fault") == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, unended).otherwise(F.coalesce(F.col(text), F.lit(" "))).alias("text"),
        F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _judged(rows: DataFrame) -> DataFrame:
    """With ``mark`` (orders and identifies texts), ``blank`` and ``cut``."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    return rows.select(
        "*",
        F.unhex(F.sha2("text", 256)).alias("mark"),
        (F.length(bare) == 0).alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_ZEROS = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
_LEGAL = {"su", "ua", "au"}


def _legal(before: str, after: str) -> bool:
    return before[:1] + after[:1] in _LEGAL


def _report(turns: list, roles: list[str], texts: list[str], blank: list[bool], cut: list[bool]) -> tuple:
    """The report of one whole conversation, from its rows in order."""
    seen: set[tuple[str, str]] = set()
    counts = {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}
    signs = np.zeros(len(roles), dtype=np.int64)
    for i, said in enumerate(zip(roles, texts, strict=True)):
        fault = "blank" if blank[i] else "duplicate" if said in seen else "truncated" if cut[i] else ""
        seen.add(said)
        counts[fault] += 1
        signs[i] = symbol(roles[i][:1], fault)
    t = tables()
    (first,), (cost,) = pass_back(signs, np.array([t.last]))
    ((letters, state),) = trace(signs, t.last, [_NEW])
    audit = letters + closing(state)
    repaired = Repaired()
    repaired.letters(audit)
    for role, text in zip(roles, texts, strict=True):
        repaired.row(role, text)
    known = {x for x in turns if x is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(not _legal(a, b) for a, b in zip(roles, roles[1:], strict=False))
    faults = counts["blank"], counts["duplicate"], counts["truncated"]
    return (gaps, *faults, illegal, int(cost) + t.vectors[first][_NEW], audit, repaired.end())


def _runs(keys: pa.ChunkedArray) -> list[int]:
    """Where each run of equal neighbours begins, and the end."""
    codes = keys.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    return [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]


def _repair_short(rows: DataFrame, key_type: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        kind = None

        def reports(table: pa.Table, starts: list[int]) -> pa.RecordBatch:
            columns = [table.column(c).to_pylist() for c in ("turn", "role", "text", "blank", "cut")]
            found = [_report(*[c[a:b] for c in columns]) for a, b in zip(starts, starts[1:], strict=False)]
            keys = table.column("conv_id").combine_chunks().take(pa.array(starts[:-1]))
            numbers = [pa.array([r[i] for r in found], pa.int64()) for i in range(6)]
            words = [pa.array([r[i] for r in found], pa.string()) for i in (6, 7)]
            return pa.record_batch([keys, *numbers, *words], names=["conv_id", *_names(_REPORT)])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            starts = _runs(table.column("conv_id"))
            if len(starts) > 2:
                yield reports(table, starts[:-1])
            rest = table.slice(starts[-2])
        if rest is not None and rest.num_rows:
            yield reports(rest, [0, rest.num_rows])

    order = ["conv_id", "turn", "role", "mark", "copy"]
    ordered = rows.repartition("conv_id").sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "turn", "role", "text", "blank", "cut")
    return ordered.mapInArrow(work, f"conv_id {key_type}, {_REPORT}")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _repair_long(rows: DataFrame, key_type: str, segment: int) -> DataFrame:
    """The report of conversations that are worked on in segments of ``segment`` rows."""
    unique = ["conv_id", "turn", "role", "mark", "copy", "row"]
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "long-turns")
    rows = materialise(with_dense_index(rows, unique, "place"), "long-places")
    # One row per long conversation.
    starts = rows.groupBy("conv_id").agg(F.min("place").alias("_start"), F.count_distinct("turn").alias("_turns"), F.min("turn").alias("_least"), F.max("turn").alias("_most"))
    starts = materialise(starts, "long-starts")
    begin = F.broadcast(starts.select(F.col("conv_id").alias("_conv"), "_start"))
    rows = rows.join(begin, F.col("conv_id").eqNullSafe(F.col("_conv"))).withColumn("at", F.col("place") - F.col("_start"))
    rows = rows.select(*[c for c in rows.columns if not c.startswith("_")])
    same = ["conv_id", "role", "mark"]
    again = rows.groupBy(*same).agg(F.min("at").alias("first"), F.count("*").alias("size")).filter("size > 1")
    flagged = attach(rows.select(*same, "at", "blank", "cut"), materialise(again, "long-copies"), same, "size")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("first") < F.col("at"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    )
    cells = flagged.select(
        "conv_id", F.expr(f"at div {segment}").alias("segment"), "at", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")
    )
    t = tables()
    everything = np.arange(len(t.vectors))

    def shape(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        initials, faults = table.column("initial").to_pylist(), table.column("fault").to_pylist()
        signs = np.array([symbol(i, f) for i, f in zip(initials, faults, strict=True)], dtype=np.int64)
        before, more = pass_back(signs, everything)
        illegal = sum(not _legal(a, b) for a, b in zip(initials, initials[1:], strict=False))
        return pa.Table.from_arrays(
            [
                table.column("conv_id").slice(0, 1), table.column("segment").slice(0, 1),
                pa.array([signs.astype(np.uint8).tobytes()]), pa.array([before.tolist()]), pa.array([more.tolist()]),
                *[pa.array([faults.count(f)]) for f in ("blank", "duplicate", "truncated")],
                pa.array([illegal]), pa.array([initials[0]]), pa.array([initials[-1]]),
            ],
            names=_names(shaped_schema),
        )

    shaped_schema = (
        f"conv_id {key_type}, segment bigint, signs binary, before array<bigint>, more array<bigint>, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"
    )
    shaped = materialise(cells.groupBy("conv_id", "segment").applyInArrow(shape, shaped_schema), "long-segments")

    def chain_back(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("segment", "descending")])
        vector, cost, after = t.last, 0, []
        for before, more in zip(table.column("before").to_pylist(), table.column("more").to_pylist(), strict=True):
            after.append(vector)
            cost += more[vector]
            vector = before[vector]
        cost += t.vectors[vector][_NEW]
        heads, tails = table.column("head").to_pylist(), table.column("tail").to_pylist()
        # Pairs across the begin of a segment count with it.
        crossing = [int(not _legal(b, a)) for a, b in zip(heads, tails[1:], strict=False)] + [0]
        return pa.Table.from_arrays(
            [table.column("conv_id"), table.column("segment"), pa.array(after, pa.int64()), pa.array([cost] * len(after), pa.int64()), pa.array(crossing, pa.int64())],
            names=["conv_id", "segment", "after", "cost", "crossing"],
        )

    chained = shaped.select("conv_id", "segment", "before", "more", "head", "tail").groupBy("conv_id")
    chained = chained.applyInArrow(chain_back, f"conv_id {key_type}, segment bigint, after bigint, cost bigint, crossing bigint")
    chained = chained.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "after", "cost", "crossing")
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment"))
    known = shaped.drop("before", "more").join(chained, here)

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                trace(np.frombuffer(signs, dtype=np.uint8).astype(np.int64), after, range(4))
                for signs, after in zip(batch.column("signs").to_pylist(), batch.column("after").to_pylist(), strict=True)
            ]
            kept = batch.drop_columns(["signs", "after", "_conv", "_segment", "head", "tail"])
            letters = pa.array([[x for x, _ in f] for f in found], pa.list_(pa.string()))
            to = pa.array([[x for _, x in f] for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, letters, to], names=[*kept.schema.names, "letters", "to"])

    traced_schema = (
        f"conv_id {key_type}, segment bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
        "cost bigint, crossing bigint, letters array<string>, to array<bigint>"
    )
    traced = materialise(known.mapInArrow(traces, traced_schema), "long-traces")

    def chain_on(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("segment")
        state, states = _NEW, []
        for to in table.column("to").to_pylist():
            states.append(state)
            state = to[state]
        ends = [""] * (len(states) - 1) + [closing(state)]
        return pa.Table.from_arrays(
            [table.column("conv_id"), table.column("segment"), pa.array(states, pa.int64()), pa.array(ends, pa.string())],
            names=["_conv", "_segment", "state", "closing"],
        )

    entered = traced.select("conv_id", "segment", "to").groupBy("conv_id")
    entered = entered.applyInArrow(chain_on, f"_conv {key_type}, _segment bigint, state bigint, closing string")
    pieces = traced.join(entered, here).withColumn("audit", F.concat(F.col("letters")[F.col("state")], "closing"))
    pieces = materialise(pieces.drop("letters", "to", "_conv", "_segment"), "long-audits")
    in_order = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), "")
    totals = pieces.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("crossing")).alias("illegal"), F.max("cost").alias("cost"), in_order.alias("audit"),
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Repaired | None = None
        owner = None
        for batch in batches:
            for conv, audit, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")], strict=True):
                if current is None or conv != owner:
                    if current is not None:
                        yield pa.record_batch([pa.array([owner], batch.column("conv_id").type), pa.array([current.end()])], names=["_conv", "repaired_sha256"])
                    current, owner = Repaired(), conv
                if audit is not None:
                    current.letters(audit)
                else:
                    current.row(role, text)
        if current is not None:
            yield pa.record_batch([pa.array([owner], batch.column("conv_id").type), pa.array([current.end()])], names=["_conv", "repaired_sha256"])

    nothing = F.lit(None).cast("string")
    stream = pieces.select("conv_id", (F.col("segment") * segment).alias("at"), F.lit(0).alias("kind"), "audit", nothing.alias("role"), nothing.alias("text"))
    stream = stream.unionByName(rows.select("conv_id", "at", F.lit(1).alias("kind"), nothing.alias("audit"), "role", "text"))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    hashed = stream.mapInArrow(hashes, f"_conv {key_type}, repaired_sha256 string")
    mine = F.col("conv_id").eqNullSafe(F.col("_conv"))
    spans = starts.select(F.col("conv_id").alias("_conv"), F.coalesce(F.expr("_most - _least + 1 - _turns"), F.lit(0)).alias("gaps"))
    return totals.join(hashed, mine).drop("_conv").join(spans, mine).select("conv_id", *_names(_REPORT))


def repair(
    turns: DataFrame, conversations: DataFrame | None = None, *, long: int = LONG, segment: int = SEGMENT, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """What is wrong with each conversation, and the cheapest repair.

    ``turns`` has ``conv_id, turn, role, text`` and ``copy`` (orders rows that
    are equal otherwise); roles and texts are not null. ``conversations`` may
    name more ids, which get a report of zeros. Rows of one turn stand by role,
    then by the SHA-256 of their text; null turns come first; null is an id
    like others. A role without a first letter counts as one that is neither of
    system, user or assistant. No conversations, no rows; other columns are
    ignored. A conversation of more than ``long`` rows, and more than a
    ``hot_keys``-th of all rows, is cut into segments of ``segment`` rows.
    """
    key_type = turns.schema["conv_id"].dataType.simpleString()
    sizes = materialise(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "conversation-sizes")
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    bound = max(long, (total or 0) // hot_keys)
    rows = _judged(turns)
    if (largest or 0) <= bound:
        reports = _repair_short(rows, key_type)
    else:
        # Fewer than ``hot_keys`` rows.
        large = F.broadcast(sizes.filter(F.col("n") > bound).select(F.col("conv_id").alias("_conv")))
        mine = F.col("conv_id").eqNullSafe(F.col("_conv"))
        reports = _repair_short(rows.join(large, mine, "left_anti"), key_type)
        reports = reports.unionByName(_repair_long(rows.join(large, mine, "left_semi"), key_type, segment))
    if conversations is None:
        return reports
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    whole = ids.join(reports, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    names = _names(_REPORT)
    return whole.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(z)).alias(c) for c, z in zip(names, _ZEROS, strict=True)])
