"""Chat formatting by minimum-cost role repair.

Conversations must follow a legal-turn automaton: one system message at most, at the start, then user and assistant in turn. A
message may keep its role, be relabelled, be merged into the message before it, or follow empty messages that are put in; a
dynamic program over the automaton's states finds the cheapest repair. What a stretch of turns costs from each state to each
state is a small matrix, and matrices of neighbouring stretches combine by minimum and sum, so that long conversations are
split into segments of equally many turns, whatever their turn numbers: the matrices choose the states at the borders, first
between stretches of segments, then within each stretch, and each segment is repaired alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm.shared import discard, n_partitions, staged

#: States: nothing said yet, or the role that spoke last.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ["", "system", "user", "assistant"]
#: Other names of roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
#: Who may speak after whom.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of a merge, a new label and an empty message.
MERGE, RELABEL, INSERT = 1, 2, 3
#: Turns in a segment, and segments in a stretch.
SEGMENT, STRETCH = 256, 256
_FAR = 1 << 40


def _moves() -> dict[tuple[int, int], tuple[int, bool, tuple[int, ...]]]:
    """For each pair of states the cheapest way for a message of the second role to follow: (cost, merged, empty messages before it)."""
    found = {}
    for a in range(4):
        ways = []
        todo: list[tuple[int, tuple[int, ...]]] = [(a, ())]
        for at, put in todo:
            for b in LEGAL[at]:
                ways.append((b, (INSERT * len(put), False, put)))
                if len(put) < 2:
                    todo.append((b, (*put, b)))
        if a != START:
            ways.append((a, (MERGE, True, ())))
        for b, way in ways:
            if (a, b) not in found or way < found[a, b]:
                found[a, b] = way
    return found


MOVES = _moves()


def role_of(name: str | None) -> int:
    """The state of a role's name, START if it is none."""
    name = (name or "").strip().lower()
    return ROLES.get(ALIASES.get(name, name), START)


def _step(costs: list[int], role: int) -> tuple[list[int], list[int]]:
    """Costs after a message, and the state that each comes from."""
    after, back = [_FAR] * 4, [START] * 4
    for (a, b), (cost, *_) in MOVES.items():
        total = costs[a] + cost + RELABEL * (b != role)
        if total < after[b]:
            after[b], back[b] = total, a
    return after, back


def segment_matrix(roles: list[int]) -> list[int]:
    """The least cost of the turns from each state (rows) to each state, flattened."""
    found = []
    for a in range(4):
        costs = [0 if s == a else _FAR for s in range(4)]
        for r in roles:
            costs = _step(costs, r)[0]
        found += costs
    return found


def combined(a: list[int], b: list[int]) -> list[int]:
    """The matrix of two neighbouring stretches."""
    return [min(min(a[4 * s + m] + b[4 * m + t] for m in range(4)), _FAR) for s in range(4) for t in range(4)]


def borders(matrices: list[list[int]], ends: tuple[int, ...] = (USER, ASSISTANT), entry: int = START) -> list[int]:
    """The states at the borders of consecutive segments, first entry, of the cheapest repair that ends in one of ends."""
    costs, backs = [0 if s == entry else _FAR for s in range(4)], []
    for m in matrices:
        ways = [min((costs[a] + m[4 * a + b], a) for a in range(4)) for b in range(4)]
        costs = [c for c, _ in ways]
        backs.append([a for _, a in ways])
    at = min(ends, key=lambda s: (costs[s], s))
    states = [at]
    for back in reversed(backs):
        states.append(at := back[at])
    return states[::-1]


def repair(roles: list[int], entry: int, end: int) -> list[tuple[int, bool, tuple[int, ...], int]]:
    """For each turn (role, merged, empty messages before it, cost), from state entry to state end."""
    costs, backs = [0 if s == entry else _FAR for s in range(4)], []
    for r in roles:
        costs, back = _step(costs, r)
        backs.append(back)
    out = []
    for r, back in zip(reversed(roles), reversed(backs)):
        cost, merged, put = MOVES[back[end], end]
        out.append((end, merged, put, cost + RELABEL * (end != r)))
        end = back[end]
    return out[::-1]


def _opening(role: int) -> str:
    return f"<|im_start|>{NAMES[role]}\n"


_CLOSING = "<|im_end|>\n"


def _safe(text: str | None) -> str:
    """Text in which the markup of turns cannot be forged."""
    return (text or "").replace("<|im_", "<| im_")


def _grouped(parts: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first n columns."""
    rows = (x for b in parts for x in zip(*(c.to_pylist() for c in b.columns)))
    return groupby(rows, key=lambda x: x[:n])


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 1000) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


_LONG, _TEXT, _MATRIX = pa.int64(), pa.string(), pa.list_(pa.int64())


def _numbered(turns: DataFrame, segment: int, cols: tuple[str, str, str, str]) -> DataFrame:
    """Stored turns in order with part, the segment of a turn within its conversation, and position, its place in the segment.

    The order is by conversation, turn, role, the text's first characters and a hash, so a range of it holds about as many
    turns whatever the conversations are. Only the first and last conversation of a range can go beyond it: those few rows say
    how many turns of a conversation stand in earlier ranges."""
    conv, turn, role, text = cols
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumns({"head": F.substring("text", 1, 32), "hash": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    order: list[Column | str] = ["conv_id", F.col("turn").asc_nulls_last(), "role", "head", "hash", "nth"]
    ordered = rows.repartitionByRange(n_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, own, at, last = TaskContext.get().partitionId(), -1, 0, ()
        for b in parts:
            owns, ats = [], []
            for c in b.column(0).to_pylist():
                own, at = (own, at + 1) if (c,) == last else (own + 1, 0)
                last = (c,)
                owns.append(own)
                ats.append(at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([pid] * len(owns), _LONG), pa.array(owns, _LONG), pa.array(ats, _LONG)], names=[*b.schema.names, "pid", "own", "at"])

    held = staged(ordered.select("conv_id", "turn", "role", "text").mapInArrow(count, "conv_id long, turn long, role string, text string, pid long, own long, at long"), "chat-turns")
    counts = held.groupBy("pid", "own").agg(F.max("conv_id").alias("conv_id"), F.count("*").alias("n"))
    lasts = counts.groupBy("pid").agg(F.max("own").alias("last"))
    edges = counts.join(lasts, "pid").filter("own = 0 OR own = last")  # two rows a partition at most
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = edges.select("pid", "own", before.alias("before")).filter("before > 0")
    nth = F.col("at") + F.coalesce("before", F.lit(0))
    met = held.join(F.broadcast(edges), ["pid", "own"], "left")
    return met.select("conv_id", F.floor(nth / segment).cast("long").alias("part"), (nth % segment).cast("long").alias("position"), "turn", "role", "text")


def format_chats(turns: DataFrame, ends: tuple[int, ...] = (USER, ASSISTANT), segment: int = SEGMENT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", stretch: int = STRETCH) -> DataFrame:
    """One row per turn: conv_id, turn, part, position, role, new_role, action, inserted, cost, rendered.

    The turns of a conversation are taken by turn (null last), ties by role and then the text's first characters and a hash; their
    rendered pieces in the order of part and position are the whole formatted conversation (conversations() puts them together).
    part counts segments of turns. action is keep, relabel, merge or relabel+merge; inserted names the empty messages put before
    the turn; a null or unknown role costs a relabel. Null texts count as empty, texts of any length are rendered whole; rows
    whose conversation is null form one conversation; repeated rows are turns of their own; conversations of many turns, of one
    turn number or without any are segments like others; columns besides the four are not read. An empty input gives an empty
    result.
    """
    n = n_partitions(turns.sparkSession)
    rows = _numbered(turns, segment, (conv_col, turn_col, role_col, text_col))

    def matrices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, ...], list[int]] = {}

        def found() -> Iterator[tuple]:
            for (conv, part), cells in _grouped(parts, 2):
                roles = tuple(role_of(x[-1]) for x in cells)
                if len(known) > 10_000:
                    known.clear()
                yield conv, part, part // stretch, known.get(roles) or known.setdefault(roles, segment_matrix(list(roles)))

        return _batches(found(), ["conv_id", "part", "stretch", "m"], [_LONG, _LONG, _LONG, _MATRIX])

    def products(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((*key, reduce(combined, (x[-1] for x in cells))) for key, cells in _grouped(parts, 2)), ["conv_id", "stretch", "m"], [_LONG, _LONG, _MATRIX])

    def outer(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv,), cells in _grouped(parts, 1):
                own = list(cells)
                at = borders([x[-1] for x in own], ends)
                yield from ((conv, x[1], at[k], at[k + 1], k == len(own) - 1) for k, x in enumerate(own))

        return _batches(found(), ["conv_id", "stretch", "entry", "exit", "final"], [_LONG, _LONG, pa.int32(), pa.int32(), pa.bool_()])

    def inner(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv, _), cells in _grouped(parts, 2):
                own = list(cells)
                entry, end, final = own[0][4:]
                at = borders([x[3] for x in own], (end,), entry)
                yield from ((conv, x[2], at[k], at[k + 1], final and k == len(own) - 1) for k, x in enumerate(own))

        return _batches(found(), ["conv_id", "part", "entry", "exit", "final"], [_LONG, _LONG, pa.int32(), pa.int32(), pa.bool_()])

    def render(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv, part), cells in _grouped(parts, 2):
                own = list(cells)
                entry, end, final = own[0][6:]
                way = repair([role_of(x[4]) for x in own], entry, end)
                open_ = entry != START
                for k, (x, (role, merged, put, cost)) in enumerate(zip(own, way)):
                    relabelled = role_of(x[4]) != role
                    action = "relabel+merge" if relabelled and merged else "merge" if merged else "relabel" if relabelled else "keep"
                    before = "".join(_opening(p) + _CLOSING for p in put)
                    piece = "\n" + _safe(x[5]) if merged else _CLOSING * open_ + before + _opening(role) + _safe(x[5])
                    if final and k == len(own) - 1:
                        piece += _CLOSING
                    open_ = True
                    yield conv, x[3], part, x[2], x[4], NAMES[role], action, ",".join(NAMES[p] for p in put), cost, piece

        return _batches(found(), ["conv_id", "turn", "part", "position", "role", "new_role", "action", "inserted", "cost", "rendered"], [_LONG, _LONG, _LONG, _LONG, _TEXT, _TEXT, _TEXT, _TEXT, _LONG, _TEXT])

    def dealt(df: DataFrame, f, schema: str, *keys: str, then: tuple[str, ...] = ()) -> DataFrame:
        return df.repartition(n, *keys).sortWithinPartitions(*keys, *then).mapInArrow(f, schema)

    segments = staged(dealt(rows.select("conv_id", "part", "position", "role"), matrices, "conv_id long, part long, stretch long, m array<long>", "conv_id", "part", then=("position",)), "chat-segments")
    stretches = dealt(segments.select("conv_id", "stretch", "part", "m"), products, "conv_id long, stretch long, m array<long>", "conv_id", "stretch", then=("part",))
    chosen = dealt(stretches, outer, "conv_id long, stretch long, entry int, exit int, final boolean", "conv_id", then=("stretch",))
    met = segments.alias("s").join(chosen.alias("c"), F.col("s.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("s.stretch") == F.col("c.stretch")))
    met = met.select("s.conv_id", "s.stretch", "part", "m", "entry", "exit", "final")
    states = staged(dealt(met, inner, "conv_id long, part long, entry int, exit int, final boolean", "conv_id", "stretch", then=("part",)), "chat-states")
    discard(segments)
    told = rows.alias("r").join(states.alias("t"), F.col("r.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("r.part") == F.col("t.part")))
    told = told.select("r.conv_id", "r.part", "position", "turn", "role", "text", "entry", "exit", "final")
    schema = "conv_id long, turn long, part long, position long, role string, new_role string, action string, inserted string, cost long, rendered string"
    return dealt(told, render, schema, "conv_id", "part", then=("position",))


def conversations(formatted: DataFrame, parts: int = 64) -> DataFrame:
    """conv_id, piece, n_turns, cost and rendered: the result of format_chats put together, a row a conversation.

    A conversation of more than parts segments goes on in further rows, numbered by piece, so that no row grows without bound."""
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("part", "position", "rendered"))), lambda x: x["rendered"])
    whole = formatted.groupBy("conv_id", F.floor(F.col("part") / parts).alias("piece"))
    return whole.agg(F.count("*").alias("n_turns"), F.sum("cost").alias("cost"), F.array_join(pieces, "").alias("rendered"))
