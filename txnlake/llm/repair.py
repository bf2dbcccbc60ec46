"""Repair of conversations by a divide-and-conquer alignment in linear space.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Walking along it, a
reader is in one of four states: nothing kept yet, after s, after u, after a. Each row is kept
(0), given the role that is due (1) or deleted (2, the only choice for blank and repeated rows);
empty turns may be inserted anywhere (5); a truncated row that stays costs 5 more. Of the
cheapest edits those whose initials (D, I, K, R) read least are taken.

Hirschberg's scheme finds them without a table of all rows and states: a forward pass gives the
cheapest cost of each state in mid-conversation and how their edits compare, a backward pass the
cost from each state to the end. The two vectors meet; of the states whose sums are least the one
with the least edits before it is crossed, and both halves are solved alike. The edits to
different states at a place are never equal nor one the start of the other, since the letters of an
edit fix its states and the last of them uses up a row; so an order of the four is all a pass needs.

Long conversations are cut into chunks, wherever the rows are: each chunk gives its 4 x 4 costs,
the vectors meet at the borders between chunks, and chunks are then solved in parallel.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import stored

#: Rows and characters of a chunk. Bounds memory only; results do not depend on them.
CHUNK_ROWS = 4096
CHUNK_CHARS = 1 << 20

#: White space of the contract: blank, tab to carriage return.
BLANKS = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

_NONE = 1 << 60
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
#: The state after the role that is due, which is user everywhere but after user.
_DUE = (_USER, _USER, _ASSISTANT, _USER)
_KEPT = {"s": {_START: _SYSTEM}, "u": {s: _USER for s in (0, 1, 3)}, "a": {_USER: _ASSISTANT}, "o": {}}
#: Inserts that lead to a legal end.
_TAIL = ("", "II", "I", "")
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
#: A row is s, u, a or o (another role), a capital letter if truncated, x if it must go.
SYMBOLS = "suaoSUAOx"


def _steps(symbol: str) -> list[list[tuple[int, str] | None]]:
    """For states before and after a row: least cost and, of equal ones, least letters."""
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in _STATES]
    extra = TRUNCATED if symbol.isupper() else 0
    for start in _STATES:
        state = start
        for inserts in range(3):
            ends = [(state, DELETE, "D")]
            if symbol != "x":
                kept = _KEPT[symbol.lower()].get(state)
                ends += [(kept, KEEP + extra, "K")] if kept is not None else []
                ends.append((_DUE[state], REROLE + extra, "R"))
            for end, cost, letter in ends:
                found = (cost + INSERT * inserts, "I" * inserts + letter)
                table[start][end] = min(table[start][end] or found, found)
            state = _DUE[state]
    return table


_STEPS = {c: _steps(c) for c in SYMBOLS}
#: (before, after, cost, letters) of the possible steps.
_MOVES = {
    c: [(s, t, *t_[s][t]) for s, t in product(_STATES, _STATES) if t_[s][t]] for c, t_ in _STEPS.items()
}

Vector = list[int]


def forward(symbols: str, costs: Vector, ranks: Vector) -> tuple[Vector, Vector]:
    """Costs of the four states behind ``symbols``, and the order of their least edits."""
    for symbol in symbols:
        best: list[tuple[int, int, str] | None] = [None] * 4
        for s, t, cost, letters in _MOVES[symbol]:
            if costs[s] < _NONE:
                found = (costs[s] + cost, ranks[s], letters)
                if best[t] is None or found < best[t]:
                    best[t] = found
        costs = [b[0] if b else _NONE for b in best]
        order = sorted((b[1], b[2], t) for t, b in enumerate(best) if b)
        ranks = [4] * 4
        for rank, (_, _, t) in enumerate(order):
            ranks[t] = rank
    return costs, ranks


def backward(symbols: str, costs: Vector) -> Vector:
    """Costs from each state in front of ``symbols`` to an end with these costs."""
    for symbol in reversed(symbols):
        before = [_NONE] * 4
        for s, t, cost, _ in _MOVES[symbol]:
            before[s] = min(before[s], costs[t] + cost)
        costs = before
    return costs


def end_costs(end: int | None) -> Vector:
    """Costs behind the last row: to one state, or to a legal end."""
    if end is None:
        return [len(tail) * INSERT for tail in _TAIL]
    return [0 if s == end else _NONE for s in _STATES]


def crossing(costs: Vector, ranks: Vector, rest: Vector) -> int:
    """Where the vectors meet: the cheapest state, of equal ones that of the least edits."""
    return min(_STATES, key=lambda s: (costs[s] + rest[s], ranks[s]))


def edits(symbols: str, start: int = _START, end: int | None = None) -> str:
    """The letters of the cheapest edits from a state to a state, or to a legal end."""
    if not symbols:
        return _TAIL[start] if end is None else ""
    if len(symbols) == 1:
        last = end_costs(end)
        found = [
            (cost + last[t], letters + (_TAIL[t] if end is None else ""))
            for s, t, cost, letters in _MOVES[symbols]
            if s == start and last[t] < _NONE
        ]
        return min(found)[1]
    mid = len(symbols) // 2
    left, right = symbols[:mid], symbols[mid:]
    costs, ranks = forward(left, [0 if s == start else _NONE for s in _STATES], [0] * 4)
    state = crossing(costs, ranks, backward(right, end_costs(end)))
    return edits(left, start, state) + edits(right, state, end)


@lru_cache(maxsize=1 << 14)
def short_edits(symbols: str) -> str:
    return edits(symbols)


def edit_cost(symbols: str, audit: str) -> int:
    rows, total = iter(symbols), 0
    for letter in audit:
        if letter == "I":
            total += INSERT
            continue
        row = next(rows)
        total += DELETE if letter == "D" else (REROLE if letter == "R" else KEEP) + TRUNCATED * row.isupper()
    return total


def repaired(audit: str, rows: Iterable[tuple[str, str]], state: int = _START) -> Iterator[tuple[str, str]]:
    """The (role, text) that edits make of rows, from a state on."""
    rows = iter(rows)
    for letter in audit:
        if letter == "I":
            state = _DUE[state]
            yield _NAMES[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = _KEPT[role[0]][state]
            yield role, text
        elif letter == "R":
            state = _DUE[state]
            yield _NAMES[state], text


# Rows of conversations ------------------------------------------------------------------------

_FAULTS = ("blank", "duplicate", "truncated")
_STATS = "first_turn long, last_turn long, n_turns long, illegal long, " + ", ".join(f"`{f}` long" for f in _FAULTS)
_CHUNKS = (
    f"conv_id long, part int, seq long, is_whole boolean, {_STATS}, first_role string, last_role string, "
    "cost long, audit string, repaired_sha256 string, costs binary, symbols string, roles array<string>, texts array<string>"
)
_LEGAL_PAIRS = {"su", "ua", "au"}
_FORM = struct.Struct("<16q16b")


def marked_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, copies, fault) with what is wrong with each."""
    digest = lambda: F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    # Where a text first stands in a conversation, for texts that stand in several turns of it.
    again = (
        rows.select("conv_id", "turn", "role", digest().alias("digest"))
        .groupBy("conv_id", "role", "digest")
        .agg(
            F.max(F.col("turn").isNull()).alias("no_turn"),
            F.min("turn").alias("least"),
            F.max("turn").alias("most"),
        )
        .where("least < most OR (no_turn AND least IS NOT NULL)")
    )
    again = stored(again.drop("most"), "repair-again")
    marked = distinct.withColumn("digest", digest()).alias("d").join(
        again.alias("a"),
        F.col("d.conv_id").eqNullSafe(F.col("a.conv_id"))
        & (F.col("d.role") == F.col("a.role"))
        & (F.col("d.digest") == F.col("a.digest")),
        "left",
    )
    turn = F.col("d.turn")
    seen = F.coalesce(turn.isNotNull() & (F.col("a.no_turn") | (turn > F.col("a.least"))), F.lit(False))
    said = F.rtrim(F.col("d.text"), F.lit(BLANKS))
    fault = (
        F.when(said == "", "blank")
        .when(seen, "duplicate")
        .when(~F.substring(said, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return marked.select("d.conv_id", "d.turn", "d.role", "d.text", "d.copies", fault.alias("fault"), "d.digest")


class _Chunk:
    """Rows of one conversation that follow each other, and what later steps need of them."""

    def __init__(self) -> None:
        self.symbols: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.counts = dict.fromkeys(_FAULTS, 0)
        self.first_turn = self.last_turn = None
        self.first_role = self.last_role = None
        self.n_turns = self.illegal = self.chars = 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if self.symbols:
            self.illegal += self.last_role + initial not in _LEGAL_PAIRS
        else:
            self.first_role = initial
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if fault:
            self.counts[fault] += 1
        known = initial if initial in ("s", "u", "a") else "o"
        gone = fault in ("blank", "duplicate")
        self.symbols.append("x" if gone else known.upper() if fault == "truncated" else known)
        # A row that goes leaves nothing of it in the result.
        self.roles.append("" if gone else role)
        self.texts.append("" if gone else text)
        self.chars += 0 if gone else len(text)

    @property
    def full(self) -> bool:
        return len(self.symbols) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def row(self, conv_id: int | None, part: int, seq: int, whole: bool) -> dict:
        symbols = "".join(self.symbols)
        out = {
            "conv_id": conv_id, "part": part, "seq": seq, "is_whole": whole, "first_turn": self.first_turn,
            "last_turn": self.last_turn, "n_turns": self.n_turns, "illegal": self.illegal,
            "first_role": self.first_role, "last_role": self.last_role, **self.counts,
        }
        if whole:
            audit = short_edits(symbols) if len(symbols) < 32 else edits(symbols)
            lines = "\n".join(f"{r}:{t}" for r, t in repaired(audit, zip(self.roles, self.texts, strict=True)))
            digest = hashlib.sha256(lines.encode()).hexdigest()
            return out | {"cost": edit_cost(symbols, audit), "audit": audit, "repaired_sha256": digest}
        passes = [forward(symbols, [0 if s == start else _NONE for s in _STATES], [0] * 4) for start in _STATES]
        flat = [c for costs, _ in passes for c in costs] + [r for _, ranks in passes for r in ranks]
        return out | {"costs": _FORM.pack(*flat), "symbols": symbols, "roles": self.roles, "texts": self.texts}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
}


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of one of the plain schemas above."""
    columns = (column.strip().rsplit(" ", 1) for column in ddl.split(","))
    return pa.schema([(name.strip("`"), _KINDS[kind]) for name, kind in columns])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of sorted rows. A conversation that neither begins nor ends a partition is solved
    at once if it is one chunk; the others may go on next door."""
    schema, part = _arrow(_CHUNKS), TaskContext.get().partitionId()
    out: list[dict] = []
    seq, chunk, current, inside = 0, _Chunk(), None, False
    started = False

    def close(last: bool, edge: bool) -> None:
        nonlocal seq, chunk, inside
        out.append(chunk.row(current, part, seq, whole=last and inside and not edge))
        seq, chunk = seq + 1, _Chunk()
        inside = last

    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(6))
        for conv_id, turn, role, text, copies, fault in zip(*columns, strict=True):
            if started and conv_id != current:
                close(last=True, edge=False)
            current, started = conv_id, True
            for i in range(copies):
                if chunk.full:
                    close(last=False, edge=False)
                chunk.add(turn, role, text, fault if fault == "blank" or i == 0 else "duplicate")
                # Chunks that stay open carry their texts, so they do not wait.
                if out and (len(out) >= 512 or not out[-1]["is_whole"]):
                    yield _batch(out, schema)
                    out = []
    if started:
        close(last=True, edge=True)
    if out:
        yield _batch(out, schema)


def _unpacked(data: bytes) -> tuple[list[Vector], list[Vector]]:
    flat = _FORM.unpack(data)
    return [list(flat[4 * s : 4 * s + 4]) for s in _STATES], [list(flat[16 + 4 * s : 20 + 4 * s]) for s in _STATES]


def over_chunk(costs: Vector, ranks: Vector, data: bytes) -> tuple[Vector, Vector]:
    """``forward`` over a whole chunk by its stored costs and orders."""
    own, orders = _unpacked(data)
    best = []
    for t in _STATES:
        s = min(_STATES, key=lambda s: (costs[s] + own[s][t], ranks[s]))
        best.append((min(costs[s] + own[s][t], _NONE), ranks[s], orders[s][t]))
    order = sorted(t for t in _STATES if best[t][0] < _NONE)
    order.sort(key=lambda t: best[t][1:])
    return [b[0] for b in best], [order.index(t) if t in order else 4 for t in _STATES]


def before_chunk(rest: Vector, data: bytes) -> Vector:
    own, _ = _unpacked(data)
    return [min(min(own[s][t] + rest[t] for t in _STATES), _NONE) for s in _STATES]


_BORDERS = "conv_id long, part int, seq long, costs binary, entry_costs array<long>, entry_ranks array<long>"
_PLACES = "part int, seq long, entry int, exit int"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forward vectors at the entry of each chunk; chunks come by conversation, in order."""
    current, started = None, False
    for batch in batches:
        entry_costs, entry_ranks = [], []
        for conv_id, data in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist(), strict=True):
            if not started or conv_id != current:
                costs, ranks = [0, _NONE, _NONE, _NONE], [0] * 4
            current, started = conv_id, True
            entry_costs.append(costs)
            entry_ranks.append(ranks)
            costs, ranks = over_chunk(costs, ranks, data)
        kept = [batch.column(name) for name in ("conv_id", "part", "seq", "costs")]
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(entry_costs, kind), pa.array(entry_ranks, kind)],
            ["conv_id", "part", "seq", "costs", "entry_costs", "entry_ranks"],
        )


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Backward over the chunks of each conversation: where the vectors meet at each border."""
    current, started = None, False
    for batch in batches:
        rows = batch.to_pylist()
        entries, exits = [], []
        for r in rows:
            if not started or r["conv_id"] != current:
                rest, state = end_costs(None), None
            current, started = r["conv_id"], True
            rest = before_chunk(rest, r["costs"])
            exits.append(state)
            state = crossing(r["entry_costs"], r["entry_ranks"], rest)
            entries.append(state)
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("seq"), pa.array(entries, pa.int32()), pa.array(exits, pa.int32())],
            ["part", "seq", "entry", "exit"],
        )


_SOLVED = f"conv_id long, part int, seq long, {_STATS}, first_role string, last_role string, cost long, audit string, lines string"


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_SOLVED)
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            r["audit"] = edits(r["symbols"], r["entry"], r["exit"])
            r["cost"] = edit_cost(r["symbols"], r["audit"])
            lines = repaired(r["audit"], zip(r["roles"], r["texts"], strict=True), r["entry"])
            r["lines"] = "".join(f"\n{role}:{text}" for role, text in lines)
            yield _batch([{f.name: r[f.name] for f in schema}], schema)


_RESULT = (
    "conv_id long, gaps long, `blank` long, `duplicate` long, `truncated` long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _gaps(first: int | None, last: int | None, n: int) -> int:
    return 0 if first is None else last - first + 1 - n


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One result for the chunks of each conversation, which come in order; texts pass through
    the hash and are not kept."""
    schema, current, total = _arrow(_RESULT), None, None

    def result() -> pa.RecordBatch:
        total["gaps"] = _gaps(total["first_turn"], total["last_turn"], total["n_turns"])
        total["audit"] = "".join(total["audit"])
        total["repaired_sha256"] = total["hash"].hexdigest()
        return _batch([{f.name: total[f.name] for f in schema}], schema)

    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            lines = r.pop("lines")
            if total is not None and r["conv_id"] == current:
                total["illegal"] += r["illegal"] + (total["last_role"] + r["first_role"] not in _LEGAL_PAIRS)
                total["n_turns"] += r["n_turns"] - (r["n_turns"] > 0 and total["last_turn"] == r["first_turn"])
                for name in (*_FAULTS, "cost"):
                    total[name] += r[name]
                if r["last_turn"] is not None:
                    total["last_turn"] = r["last_turn"]
                    total["first_turn"] = r["first_turn"] if total["first_turn"] is None else total["first_turn"]
                total["last_role"] = r["last_role"]
            else:
                if total is not None:
                    yield result()
                current, total = r["conv_id"], r | {"audit": [], "hash": hashlib.sha256(), "said": False}
            total["audit"].append(r["audit"])
            total["hash"].update((lines if total["said"] else lines[1:]).encode())
            total["said"] |= lines != ""
    if total is not None:
        yield result()


def one_space(column: str) -> Column:
    """A column as text, one space where it is NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the repaired text of each conversation of (conv_id, turn, role,
    text): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows follow turn (NULL first), then role, then text by its first 32 characters and its SHA-256,
    so rows of one turn have one order and equal rows stand together. NULL role and text are one
    space; a NULL conv_id is a conversation of its own; further columns, whatever their names,
    change nothing; an empty table gives no rows. ``audit`` has a letter for each edit, so it is as
    long as the conversation.

    Rows are dealt by ranges of (conv_id, turn, ...), so a conversation that holds most of them
    spreads over many tasks; equal rows are counted first. Only the last hash, which must take the texts
    of a conversation in order, runs in one task for it, chunk by chunk.
    """
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        one_space("role").alias("role"),
        one_space("text").alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 32), F.col("digest")]
    order = [c.asc_nulls_first() for c in order]
    dealt = marked_rows(plain).repartitionByRange(*order).sortWithinPartitions(*order).drop("digest")
    chunks = stored(dealt.mapInArrow(_chunked, _CHUNKS), "repair-chunks")

    open_chunks = chunks.where("NOT is_whole")
    in_order = lambda df, by: df.repartition("conv_id").sortWithinPartitions("conv_id", *by)
    entries = in_order(open_chunks.select("conv_id", "part", "seq", "costs"), ["part", "seq"]).mapInArrow(
        _entries, _BORDERS
    )
    places = in_order(entries, [F.desc("part"), F.desc("seq")]).mapInArrow(_crossings, _PLACES)
    solved = open_chunks.drop("cost", "audit").join(places, ["part", "seq"]).mapInArrow(_solved, _SOLVED)
    joined = in_order(solved, ["part", "seq"]).mapInArrow(_joined, _RESULT)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    whole = chunks.where("is_whole").withColumn("gaps", gaps)
    return whole.select(*joined.columns).unionByName(joined)


def with_unsaid(repaired_: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """The repairs, and for each further id (NULL is one) a conversation without rows."""
    ids = conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("i")
    unsaid = ids.join(repaired_.alias("r"), F.col("i.conv_id").eqNullSafe(F.col("r.conv_id")), "left_anti")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", *_FAULTS, "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return repaired_.unionByName(
        unsaid.select("conv_id", *zeros, F.lit("").alias("audit"), F.lit(empty).alias("repaired_sha256"))
    )
