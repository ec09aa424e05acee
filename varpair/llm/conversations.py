"""Conversation structure repair by a square-root checkpointed dynamic program.

Turns are sorted by (conversation, turn) over range partitions, so a long
conversation lies in several tasks.  A conversation that ends inside its task is
repaired there; the others (those at a task's ends, and those of more than one
block) travel as blocks of turns: repeated turns are found by key over all
blocks, one byte a turn goes to the dynamic program, and its edits go back to
the blocks.  The program keeps cost vectors of the four role states only at
every sqrt(n)-th turn and computes the turns between them again while it walks
forward and takes the ASCII-least of the edits that keep the cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .io import in_tasks, saved

#: Turns and text bytes of one block of a conversation that does not end inside its task.
BLOCK_TURNS, BLOCK_BYTES = 256, 1 << 20
_SPACES = " \t\n\x0b\x0c\r"
_KINDS = {"s": 0, "u": 1, "a": 2}
_LEGAL = {"su", "ua", "au"}
_FINE, _TRUNCATED, _DELETE = range(3)
_FAR = 1 << 60
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: State after a turn of the role that the pattern wants next (an inserted or a rerolled one).
_WANTED = (_USER, _USER, _ASSISTANT, _USER)
#: State after a kept turn of kind s, u, a or another, by state (-1: the pattern forbids it).
_KEPT = ((_SYSTEM, -1, -1, -1), (_USER, _USER, -1, _USER), (-1, -1, _ASSISTANT, -1), (-1, -1, -1, -1))
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT_COLUMNS = [x.split(" ")[0] for x in _RESULT.split(", ")]


# ---- the dynamic program, over one byte a turn: 3 * kind + fault


def _inserted(costs: list[int]) -> tuple[int, int, int, int]:
    """Costs by state once turns may be inserted first."""
    user, assistant = min(costs[2], 2 + costs[3]), min(costs[3], 2 + costs[2])
    return min(costs[0], 2 + user), min(costs[1], 2 + user), user, assistant


_END = _inserted([0, _FAR, _FAR, 0])


def _edits(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits that use up a turn, in ASCII order: initial, cost, next state."""
    kind, fault = divmod(code, 3)
    yield "D", 3, state
    if fault == _DELETE:
        return
    if _KEPT[kind][state] >= 0:
        yield "K", int(fault == _TRUNCATED), _KEPT[kind][state]
    yield "R", 2 + int(fault == _TRUNCATED), _WANTED[state]


_MOVES = [[tuple(_edits(code, state)) for state in range(4)] for code in range(12)]


def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost vector before a turn from the one behind it."""
    return _inserted([min(cost + after[to] for _, cost, to in moves) for moves in _MOVES[code]])


def cheapest_edits(codes: bytes) -> tuple[int, Iterator[tuple[int, str]]]:
    """Least cost, and turn by turn the state before and the initials of the edits.

    Inserts before a turn come with it, those behind the last turn as one more item.
    """
    n = len(codes)
    step = isqrt(n) or 1
    costs, marks = _END, {n: _END}
    for i in range(n - 1, -1, -1):
        costs = _before(codes[i], costs)
        if i % step == 0:
            marks[i] = costs

    def walk() -> Iterator[tuple[int, str]]:
        state = _START
        for begin in range(0, n, step):
            end = min(begin + step, n)
            vectors = [marks[end]]
            for i in range(end - 1, begin - 1, -1):
                vectors.append(_before(codes[i], vectors[-1]))
            vectors.reverse()
            for i in range(begin, end):
                now, after, before, out, used = vectors[i - begin], vectors[i - begin + 1], state, "", False
                while not used:
                    (edit, cost, to), *rest = _MOVES[codes[i]][state]
                    if cost + after[to] != now[state]:
                        if now[state] == 2 + now[_WANTED[state]]:
                            out, state = out + "I", _WANTED[state]
                            continue
                        edit, to = next((e, t) for e, c, t in rest if c + after[t] == now[state])
                    out, state, used = out + edit, to, True
                yield before, out
        out, before = "", state
        while _END[state]:
            out, state = out + "I", _WANTED[state]
        yield before, out

    return costs[_START], walk()


@lru_cache(maxsize=1 << 14)
def _audit(codes: bytes) -> tuple[int, str]:
    cost, edits = cheapest_edits(codes)
    return cost, "".join(e for _, e in edits)


def repaired_lines(edits: str, roles: list[str], texts: list[str], state: int = _START) -> tuple[list[str], int]:
    """Lines ``role:text`` after the edits, and the state behind them."""
    lines, at = [], 0
    for edit in edits:
        if edit == "I":
            state = _WANTED[state]
            lines.append(f"{_ROLE[state]}:")
            continue
        if edit == "K":
            state = _KEPT[_KINDS[roles[at][0]]][state]
            lines.append(f"{roles[at]}:{texts[at]}")
        elif edit == "R":
            state = _WANTED[state]
            lines.append(f"{_ROLE[state]}:{texts[at]}")
        at += 1
    return lines, state


# ---- faults of a run of turns


class Faults:
    """Codes and counts of consecutive turns of one conversation; runs of it are added from left to right."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.first = self.last = None

    def add_turns(self, turns: list, roles: list[str], repeated: list[bool], texts: list[str]) -> bytes:
        codes = bytearray()
        for turn, role, text, again in zip(turns, roles, texts, repeated):
            words = text.strip(_SPACES)
            if not words or again:
                fault = _DELETE
                self.blank += not words
                self.duplicate += bool(words)
            else:
                fault = _FINE if words[-1] in ".!?" else _TRUNCATED
                self.truncated += fault
            codes.append(3 * _KINDS.get(role[:1], 3) + fault)
            self.illegal += self.last is not None and self.last + role[:1] not in _LEGAL
            self.first = role[:1] if self.first is None else self.first
            self.last = role[:1]
            if turn is not None and turn != self.most:
                self.turns += 1
                self.least = turn if self.least is None else self.least
                self.most = turn
        return bytes(codes)

    def add(self, other: Faults) -> None:
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal + (self.last is not None and other.first is not None and self.last + other.first not in _LEGAL)
        self.turns += other.turns - (self.most is not None and self.most == other.least)
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last
        self.least = other.least if self.least is None else self.least
        self.most = self.most if other.most is None else other.most

    def counts(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


_FAULTS = "blank long, duplicate long, truncated long, illegal long, turns long, least long, most long, first string, last string"
_FAULT_COLUMNS = [x.split(" ")[0] for x in _FAULTS.split(", ")]


def _repeats(roles: list[str], texts: list[str]) -> list[bool]:
    seen: set[tuple[str, str]] = set()
    out = []
    for row in zip(roles, texts):
        out.append(row in seen)
        seen.add(row)
    return out


def _key(conv, role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{conv!r} {len(role)} {role}{text}".encode(), digest_size=16).digest()


# ---- Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone after the damage that crc32(``conv_id:turn``) % 20 names.

    0 drops a row (it stays as a mark that its conversation exists, ``gone``), 1
    empties the text, 2 removes its ``.!?``, 3 repeats the row, 4 makes the role
    ``user``.  Null values are one space (conv_id and turn stay null in their
    own columns).
    """
    conv, turn = F.col("conv_id"), F.col("turn").cast("long")
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn))) % 20
    role, text = spaced(F.col("role")), spaced(F.col("text"))
    row = F.struct(
        conv.alias("conv_id"),
        F.when(kind != 0, turn).alias("turn"),
        F.when(kind == 0, F.lit("")).when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
    )
    return conversations.select(F.inline(F.when(kind == 3, F.array(row, row)).otherwise(F.array(row))))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[dict[str, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()


def _emitted(rows: Iterator[dict], schema: pa.Schema, limit: int = 1024, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded number and text."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += sum(map(len, row.get("texts") or ())) + len(row.get("audit") or "")
        if len(out) >= limit or held >= size:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def _repaired_or_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Results of the conversations that lie inside this task, blocks of the others."""
    base = TaskContext.get().partitionId() << 40
    nothing = object()
    conv, whole, number = nothing, False, 0
    turns, roles, texts, size = [], [], [], 0

    def block() -> dict:
        keys = [_key(conv, r, t) for r, t in zip(roles, texts)]
        return {"conv_id": conv, "block": base + number, "turns": turns, "roles": roles, "texts": texts, "keys": keys}

    def closed() -> dict:
        faults = Faults()
        codes = faults.add_turns(turns, roles, _repeats(roles, texts), texts)
        cost, audit = _audit(codes)
        lines = repaired_lines(audit, roles, texts)[0]
        return {"conv_id": conv} | dict(zip(_RESULT_COLUMNS, (*faults.counts(), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())))

    for part in _slices(batches):
        for c, turn, role, text, gone in zip(*(part[x] for x in ("conv_id", "turn", "role", "text", "gone"))):
            if conv is nothing or c != conv:
                if conv is not nothing:
                    yield closed() if whole else block()
                    number += 1
                whole, conv = conv is not nothing, c  # what a task begins with may have begun in the one before
                turns, roles, texts, size = [], [], [], 0
            if gone:
                continue
            if len(turns) >= BLOCK_TURNS or turns and size + len(text) > BLOCK_BYTES:
                yield block()
                number, whole = number + 1, False
                turns, roles, texts, size = [], [], [], 0
            turns.append(turn)
            roles.append(role)
            texts.append(text)
            size += len(text)
    if conv is not nothing:
        yield block()  # may go on in the next task


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Codes and faults of every block; ``late``: keys that an earlier block of the conversation has."""
    for part in _slices(batches, 16):
        for at in range(len(part["block"])):
            seen, repeated, faults = set(part["late"][at] or ()), [], Faults()
            for key in part["keys"][at]:
                repeated.append(key in seen)
                seen.add(key)
            codes = faults.add_turns(part["turns"][at], part["roles"][at], repeated, part["texts"][at])
            yield {"conv_id": part["conv_id"][at], "block": part["block"][at], "codes": codes} | {c: getattr(faults, c) for c in _FAULT_COLUMNS}


def _programs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Edits of every block, from the blocks of each conversation in order: one byte a turn is held."""
    nothing = object()
    conv, blocks, codes, total = nothing, [], [], Faults()

    def finished() -> Iterator[dict]:
        cost, edits = cheapest_edits(b"".join(codes))
        counts = dict(zip(_RESULT_COLUMNS, (*total.counts(), cost)))
        for at, (block, size) in enumerate(zip(blocks, map(len, codes))):
            found = [next(edits) for _ in range(size + (at + 1 == len(blocks)))]
            yield {"block": block, "state": found[0][0] if found else _START, "edits": "".join(e for _, e in found), **counts}

    for part in _slices(batches, 256):
        for row in range(len(part["block"])):
            if conv is nothing or part["conv_id"][row] != conv:
                if conv is not nothing:
                    yield from finished()
                conv, blocks, codes, total = part["conv_id"][row], [], [], Faults()
            blocks.append(part["block"][row])
            codes.append(part["codes"][row])
            faults = Faults()
            for name in _FAULT_COLUMNS:
                setattr(faults, name, part[name][row])
            total.add(faults)
    if conv is not nothing:
        yield from finished()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Results of conversations from their blocks in order; one block's text is held."""
    nothing = object()
    conv, row, digest, audit, any_line = nothing, {}, None, [], False
    for part in _slices(batches, 16):
        for at in range(len(part["block"])):
            if conv is nothing or part["conv_id"][at] != conv:
                if conv is not nothing:
                    yield row | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                conv, digest, audit, any_line = part["conv_id"][at], hashlib.sha256(), [], False
                row = {c: part[c][at] for c in ("conv_id", *_RESULT_COLUMNS[:-2])}
            lines, _ = repaired_lines(part["edits"][at], part["roles"][at], part["texts"][at], part["state"][at])
            audit.append(part["edits"][at])
            if lines:
                digest.update((b"\n" if any_line else b"") + "\n".join(lines).encode())
                any_line = True
    if conv is not nothing:
        yield row | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The rows are damaged (``damaged``), sorted by turn (nulls first; turns of
    one number by role and text) and repaired with the cheapest edits.  Null
    role and text are one space; rows of a null conv_id are one conversation; a
    row whose role is empty has no initial, so it is never kept.  A
    conversation that loses all its rows has zeros, an empty audit and the
    digest of nothing.  No rows give no rows.  Other columns are not read.
    """
    rows = damaged(conversations)
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString().replace('bigint', 'long')}"
    if conv.split(" ")[1] not in ("long", "string"):
        raise ValueError("conv_id must be long or string")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def step(df: DataFrame, fn, ddl: str) -> DataFrame:
        schema = _arrow(ddl)
        return in_tasks(df, lambda batches: _emitted(fn(batches), schema), ddl)

    found = saved(step(dealt, _repaired_or_blocks, f"{conv}, {_RESULT}, block long, turns array<long>, roles array<string>, texts array<string>, keys array<binary>"), "conversations")
    blocks = found.filter("block IS NOT NULL").select("conv_id", "block", "turns", "roles", "texts", "keys")
    held = blocks.select("block", F.explode(F.array_distinct("keys")).alias("key"))
    firsts = held.groupBy("key").agg(F.min("block").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    late = held.join(firsts, "key").filter("block > first").groupBy("block").agg(F.collect_list("key").alias("late"))
    judged = step(blocks.join(late, "block", "left").select("conv_id", "block", "turns", "roles", "texts", "keys", "late"), _coded, f"{conv}, block long, codes binary, {_FAULTS}")
    edits = step(judged.repartition("conv_id").sortWithinPartitions("conv_id", "block"), _programs, f"block long, state long, edits string, {_RESULT.split(', audit')[0]}")
    whole = blocks.drop("turns", "keys").join(edits, "block").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    chained = step(whole, _digested, f"{conv}, {_RESULT}")
    return found.filter("block IS NULL").select("conv_id", *_RESULT_COLUMNS).unionByName(chained)
