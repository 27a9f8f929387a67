"""Chat formatting: minimum-cost role repair, then rendering.

A legal conversation is an optional system message, then user and assistant messages in turn, user first, assistant last.
Every turn is either merged into the open message, or becomes a message of its own or of another role; empty messages
may be inserted before it and at the end. Costs: keep 0, merge 1, relabel 2, insert 3; a merge across roles pays for both. A
dynamic program over the automaton's states (the role of the open message) finds the cheapest repair; equal costs
take the earlier state and action in the order listed.

One conversation may hold a large part of all rows. Turns are sorted by range and cut into chunks of ``CHUNK_ROWS``;
a chunk's part of a conversation is a min-plus matrix over the states, so the states at chunk borders come from the
matrices alone, and each chunk is then repaired by itself.

Edge cases: null text counts as empty; a null or unknown role is relabelled; null conv_ids form one conversation; turns
are ordered by (turn, role, text), nulls first; repeated rows are turns of their own; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import work_table

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 1, 2, 3
INFINITE = 1 << 40
CHUNK_ROWS = 4096

SORTED = "conv_id long, turn long, role string, text string, part int, pos long"
REPAIRED = "conv_id long, turn long, role string, action string, new_role string, inserted string, cost int, fragment string"


def _inserts() -> dict[tuple[int, int], tuple[int, ...]]:
    """Fewest empty messages that make ``after`` legal behind ``before``."""
    out = {}
    for before in LEGAL:
        for after in (SYSTEM, USER, ASSISTANT):
            if after in LEGAL[before]:
                out[before, after] = ()
            else:
                via = [m for m in LEGAL[before] if after in LEGAL[m]]
                if via:
                    out[before, after] = (via[-1],)
    return out


INSERTS = _inserts()


def moves(role: int | None) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, action) for a turn of that role, cheapest kinds first."""
    out = [(s, s, MERGE + (0 if s == role else RELABEL), "merge") for s in (SYSTEM, USER, ASSISTANT)]
    for (before, after), inserted in INSERTS.items():
        same = after == role
        out.append((before, after, (0 if same else RELABEL) + INSERT * len(inserted), "keep" if same else "relabel"))
    return sorted(out, key=lambda m: (m[0], m[1], m[2], ("keep", "merge", "relabel").index(m[3])))


MOVES = {role: moves(role) for role in (None, SYSTEM, USER, ASSISTANT)}
BEST = {role: {(b, a): (c, w) for b, a, c, w in reversed(ms)} for role, ms in MOVES.items()}
MATRIX = {role: np.array([[BEST[role].get((b, a), (INFINITE,))[0] for a in range(4)] for b in range(4)]) for role in MOVES}
END = np.array([0, INSERT * 2, INSERT, 0])  # empty messages up to an assistant's
END_INSERTS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def role_no(role: str | None) -> int | None:
    return ROLES.index(role) + 1 if role in ROLES else None


def forward(roles: list[int | None], start: np.ndarray) -> np.ndarray:
    """Costs of the states after each turn, from the costs before the first."""
    costs = [start]
    for role in roles:
        costs.append(np.minimum((costs[-1][:, None] + MATRIX[role]).min(0), INFINITE))
    return np.array(costs)


def segment_matrix(roles: list[int | None]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, INFINITE)
    for role in roles:
        out = np.minimum((out[:, :, None] + MATRIX[role][None]).min(1), INFINITE)
    return out


def states(roles: list[int | None], first: int, last: int | None) -> list[int]:
    """States around the turns on a cheapest way from ``first`` to ``last`` (None: to the end of the conversation)."""
    start = np.full(4, INFINITE)
    start[first] = 0
    costs = forward(roles, start)
    at = int(np.argmin(costs[-1] + END)) if last is None else last
    way = [at]
    for i in range(len(roles) - 1, -1, -1):
        at = int(np.argmin(costs[i] + MATRIX[roles[i]][:, at]))
        way.append(at)
    return way[::-1]


def opened(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


CLOSED = "<|im_end|>\n"


def render(roles: list[int | None], texts: list[str], way: list[int], ends: bool) -> list[tuple[str, str, str, int, str]]:
    """(action, new role, inserted roles, cost, text to append) of each turn; in order they make the whole rendering."""
    out = []
    for i, (role, text) in enumerate(zip(roles, texts)):
        before, after = way[i], way[i + 1]
        cost, action = BEST[role][before, after]
        inserted = INSERTS[before, after] if action != "merge" else ()
        empty = "".join(opened(s) + CLOSED for s in inserted)
        fragment = "\n" + text if action == "merge" else (CLOSED if before else "") + empty + opened(after) + text
        if ends and i == len(roles) - 1:
            inserted += END_INSERTS[after]
            cost += int(END[after])
            fragment += CLOSED + "".join(opened(s) + CLOSED for s in END_INSERTS[after])
        out.append((action, ROLES[after - 1], ",".join(ROLES[s - 1] for s in inserted), cost, fragment))
    return out


def sorted_turns(turns: DataFrame) -> DataFrame:
    """Turns in conversation order with the range partition and the place in it, written once."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = ["conv_id", "turn", "role", "text"]

    def number(batches: Iterator[pa.RecordBatch]):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=[*keys, "part", "pos"])
            at += n

    return work_table(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(number, SORTED), "turns")


def _runs(table: pa.Table) -> Iterator[tuple[int | None, pa.Table]]:
    """The conversations in a chunk, in order."""
    ids = table.column("conv_id").to_pylist()
    start = 0
    for i in range(1, len(ids) + 1):
        if i == len(ids) or ids[i] != ids[start]:
            yield ids[start], table.slice(start, i - start)
            start = i


def _chunk() -> "F.Column":
    return F.floor(F.col("pos") / CHUNK_ROWS).cast("long").alias("chunk")


def edge_segments(rows: DataFrame) -> DataFrame:
    """Min-plus matrices of the first and last conversation of each chunk: all that can reach beyond it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        runs = list(_runs(table))
        part, chunk = table.column("part")[0].as_py(), table.column("chunk")[0].as_py()
        out = []
        for i in dict.fromkeys((0, len(runs) - 1)):
            conv, seg = runs[i]
            m = segment_matrix([role_no(r) for r in seg.column("role").to_pylist()])
            out.append({"conv_id": conv, "part": part, "chunk": chunk, "matrix": m.reshape(-1).tolist()})
        return pa.Table.from_pylist(out, schema=pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int64()), ("matrix", pa.list_(pa.int64()))]))

    return rows.select("conv_id", "role", "part", "pos", _chunk()).groupBy("part", "chunk").applyInArrow(
        run, "conv_id long, part int, chunk long, matrix array<long>")


def border_states(segments: DataFrame) -> DataFrame:
    """(conv_id, part, chunk, first_state, last_state): where a cheapest repair of the whole conversation crosses the borders."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("chunk", "ascending")])
        ms = np.array(table.column("matrix").to_pylist(), np.int64).reshape(-1, 4, 4)
        costs = [np.array([0, INFINITE, INFINITE, INFINITE])]
        for m in ms:
            costs.append(np.minimum((costs[-1][:, None] + m).min(0), INFINITE))
        at = int(np.argmin(costs[-1] + END))
        way = [at]
        for i in range(len(ms) - 1, -1, -1):
            at = int(np.argmin(costs[i] + ms[i][:, at]))
            way.append(at)
        way = way[::-1]
        last: list[int | None] = [*way[1:-1], None]
        return pa.table({"conv_id": table.column("conv_id"), "part": table.column("part"), "chunk": table.column("chunk"),
                         "first_state": pa.array(way[:-1], pa.int32()), "last_state": pa.array(last, pa.int32())})

    return segments.groupBy("conv_id").applyInArrow(run, "conv_id long, part int, chunk long, first_state int, last_state int")


def repair(turns: DataFrame) -> DataFrame:
    """One row per turn: what becomes of it, and the text that it adds to the rendering of its conversation."""
    rows = sorted_turns(turns)
    edges = border_states(edge_segments(rows)).select(
        F.col("conv_id").alias("edge_conv"), F.col("part").alias("edge_part"), F.col("chunk").alias("edge_chunk"), "first_state", "last_state")
    chunked = rows.withColumn("chunk", _chunk())
    joined = chunked.join(edges, (F.col("edge_part") == F.col("part")) & (F.col("edge_chunk") == F.col("chunk"))
                          & F.col("edge_conv").eqNullSafe(F.col("conv_id")), "left")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        out = {name: [] for name in ("action", "new_role", "inserted", "cost", "fragment")}
        for _, seg in _runs(table):
            roles = [role_no(r) for r in seg.column("role").to_pylist()]
            first, last = seg.column("first_state")[0].as_py(), seg.column("last_state")[0].as_py()
            way = states(roles, first or START, last)
            for name, column in zip(out, zip(*render(roles, seg.column("text").to_pylist(), way, last is None))):
                out[name] += column
        return pa.table({"conv_id": table.column("conv_id"), "turn": table.column("turn"), "role": table.column("role"),
                         "action": out["action"], "new_role": out["new_role"], "inserted": out["inserted"],
                         "cost": pa.array(out["cost"], pa.int32()), "fragment": out["fragment"]})

    return joined.select("conv_id", "turn", "role", "text", "part", "pos", "chunk", "first_state", "last_state").groupBy(
        "part", "chunk").applyInArrow(run, REPAIRED)
