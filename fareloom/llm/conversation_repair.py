"""Conversation structure repair: the cheapest edits that make a conversation alternate, by a rank-convergence Viterbi.

Rows of a conversation are taken by turn (nulls first; in one turn by role, then by the text's SHA-256, so equal rows
are neighbours). A row is blank, else a duplicate (its role and text stood earlier), else truncated (its last character
is no `.`, `!` or `?`). Edits cost: keep 0, other role 3, delete 4 (forced for blank and duplicate rows), insert 3,
and 3 more for a truncated row that stays. Roles must then read `(s?(ua)+)?` by their initials.

The backward pass of that shortest path is parallel. Ordered rows are cut into chunks; every chunk starts from a
speculative cost vector (that of the end), all at once. Then fix-up passes take the vector of the next chunk's start as
the end of this one and rerun it, only until its vector differs by a constant from the one found before; a pass ends
the work when no chunk's end has changed. Adding a constant to a vector changes no choice, so vectors are kept with
their least entry at zero. Stitched, they drive the trace from the front: in each state the least letter (D, I, K, R)
that still reaches the known cost. Chunks are traced from every state at once and linked by their exits.

Some rows never converge (all of one role: a vector's entries swap for ever). What FIXUPS passes have left is passed by
4 x 4 min-plus matrices of the chunks instead, folded over the chunks of a conversation. That is exact as well.

Texts are shuffled once, at the end, to the task that writes their conversation's lines, in order and as a stream.
Everything before works on narrow rows with a SHA-256 for each text; equal rows of a turn are one row with a count.

Defined cases: null roles and texts count as one space; null conversation ids are one conversation; conversations with
no rows left have zero counts, an empty audit and no lines. Ids that read as one space are the null id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fareloom.llm.common import by_value, join_counted, stored, table

#: Characters between words, for rtrim.
SPACES = " \t\n\x0b\x0c\r"
#: Distinct rows of one conversation in a chunk, and passes before matrices take over.
CHUNK, FIXUPS = 4096, 6
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Adjacent initials that are in order.
LEGAL = frozenset({"su", "ua", "au"})
#: States: nothing yet, after a system, after a user, after an assistant row. ADD: the state after a row of the role due.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ADD = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
INF = float("inf")
#: Costs from each state at the end: accepted with nothing said or after an assistant row, else with inserts.
TERMINAL = (0, 6, 3, 0)
ROWS_OUT = 20_000


# ---------------------------------------------------------------- cost vectors


def settle(r: tuple) -> tuple:
    """The least costs if rows may be inserted first."""
    u, a = min(r[USER], INSERT + r[ASSISTANT]), min(r[ASSISTANT], INSERT + r[USER])
    return (min(r[NOTHING], INSERT + u), min(r[SYSTEM], INSERT + u), u, a)


def step(symbol: str, after: tuple) -> tuple:
    """Costs before a row from those after it. symbol: initial s, u, a or o; upper case if truncated; - if forced out."""
    if symbol == "-":
        return tuple(DELETE + x for x in after)
    extra, keep = CUT * symbol.isupper(), KEEP.get(symbol.lower(), {})
    return settle(
        tuple(
            min(DELETE + after[q], REROLE + extra + after[ADD[q]], extra + after[keep[q]] if q in keep else INF)
            for q in range(4)
        )
    )


def level(vector: tuple) -> tuple[tuple, int]:
    """The vector with its least entry at zero, and that entry."""
    least = min(vector)
    return tuple(x - least for x in vector), least


class Costs:
    """step() on levelled vectors, remembered: there are few of them."""

    def __init__(self) -> None:
        self.steps: dict[tuple, tuple[tuple, int]] = {}
        self.moves: dict[tuple, tuple] = {}

    def before(self, symbol: str, after: tuple) -> tuple[tuple, int]:
        if symbol == "-":
            return after, DELETE
        found = self.steps.get((symbol, after))
        if found is None:
            found = self.steps[symbol, after] = level(step(symbol, after))
        return found

    def start(self, symbols: str, end: tuple) -> tuple:
        """The levelled vector at a chunk's start."""
        for symbol in reversed(symbols):
            end = self.before(symbol, end)[0]
        return end

    def fix_up(self, symbols: str, old_end: tuple, old_start: tuple, end: tuple) -> tuple:
        """start() for a new end: stops where the vector is that of the pass before, up to a constant."""
        for symbol in reversed(symbols):
            if end == old_end:
                return old_start
            old_end, end = self.before(symbol, old_end)[0], self.before(symbol, end)[0]
        return end

    def matrix(self, symbols: str) -> list[list[float]]:
        """Least costs from each state at the start to each at the end."""
        columns = []
        for q in range(4):
            vector, total = tuple(0 if p == q else INF for p in range(4)), 0
            for symbol in reversed(symbols):
                vector, more = self.before(symbol, vector)
                total += more
            columns.append([x + total for x in vector])
        return [list(row) for row in zip(*columns)]

    def move(self, symbol: str, after: tuple, q: int) -> tuple[str, int, int, tuple, str | None]:
        """The least cheapest letters for one row: letters, cost, next state, roles inserted before, the row's new role.

        The new role is None for a deleted row and empty for one that keeps its own.
        """
        found = self.moves.get((symbol, after, q))
        if found is None:
            found = self.moves[symbol, after, q] = self._move(symbol, after, q)
        return found

    def _move(self, symbol: str, after: tuple, q: int) -> tuple[str, int, int, tuple, str | None]:
        if symbol == "-":
            return "D", DELETE, q, (), None
        vector, more = self.before(symbol, after)
        here = [x + more for x in vector]
        extra, keep = CUT * symbol.isupper(), KEEP.get(symbol.lower(), {})
        letters, cost, added = "", 0, []
        while True:
            if DELETE + after[q] == here[q]:
                return letters + "D", cost + DELETE, q, tuple(added), None
            if INSERT + here[ADD[q]] == here[q]:
                q = ADD[q]
                letters, cost = letters + "I", cost + INSERT
                added.append(ROLE[q])
            elif q in keep and extra + after[keep[q]] == here[q]:
                return letters + "K", cost + extra, keep[q], tuple(added), ""
            else:
                q = ADD[q]
                return letters + "R", cost + REROLE + extra, q, tuple(added), ROLE[q]

    def ends(self, symbols: str, end: tuple) -> list[tuple]:
        """The levelled vector after each row."""
        out = [end] * len(symbols)
        for i in range(len(symbols) - 1, 0, -1):
            end = self.before(symbols[i], end)[0]
            out[i - 1] = end
        return out

    def exits(self, symbols: str, end: tuple) -> list[int]:
        """The state that each state at the chunk's start leads to."""
        after = self.ends(symbols, end)
        at = list(range(4))
        for symbol, vector in zip(symbols, after):
            if symbol != "-":
                at = [self.move(symbol, vector, q)[2] for q in at]
        return at


def closing(q: int) -> list[str]:
    """Roles still to insert when all rows are done."""
    out = []
    while q in (SYSTEM, USER):
        q = ADD[q]
        out.append(ROLE[q])
    return out


# ---------------------------------------------------------------- rows and chunks


def _id_text(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


def _rows(talks: DataFrame) -> DataFrame:
    """talks -> c, turn, role, text, key: a SHA-256 of conversation, role and text."""
    plain = talks.select(
        _id_text(F.col("conv_id")).alias("c"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    parts = [F.length("c").cast("string"), F.lit(":"), F.col("c"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")]
    return plain.withColumn("key", F.unhex(F.sha2(F.concat(*parts), 256)))


def _runs(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with its number n; first: no earlier turn has its role and text."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    runs = stored(
        rows.select("c", "turn", "role", "key", (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"))
        .groupBy("c", "turn", "role", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut")),
        "talk-runs",
    )
    # Few texts come back in another turn; only those are joined. A struct orders its null turn first.
    again = runs.groupBy("key").agg(F.min(F.struct("turn")).alias("origin"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    told = join_counted(runs, stored(again, "talk-again"), "key", "times", "left")
    here = F.struct("turn")
    return told.withColumn("first", F.col("origin").isNull() | (F.col("origin") == here)).drop("origin")


CHUNK_SCHEMA = (
    "c string, part int, chunk int, edge boolean, symbols string, counts array<bigint>, turns array<bigint>, roles array<string>, "
    "keys array<binary>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"
)


def _chunk_rows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict[str, Any]]:
    """Chunks of a sorted stream. edge: the conversation may have other chunks."""
    part, now, first_c, pending = TaskContext.get().partitionId(), None, None, None

    def closed(row: dict[str, Any]) -> dict[str, Any]:
        row["symbols"] = "".join(row["symbols"])
        return row

    for batch in batches:
        for c, turn, role, key, n, blank, cut, first in zip(*(batch.column(k).to_pylist() for k in range(8))):
            initial = role[:1]
            if now is None or now["c"] != c or len(now["symbols"]) >= most:
                same = now is not None and now["c"] == c
                if now is not None:
                    now["edge"] = now["edge"] or same
                    yield closed(now)
                if first_c is None:
                    first_c = c
                now = {
                    "c": c, "part": part, "chunk": now["chunk"] + 1 if same else 0, "edge": same or c == first_c, "symbols": [],
                    "counts": [], "turns": [], "roles": [], "keys": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                    "head": initial, "tail": initial,
                }
            elif now["tail"] + initial not in LEGAL:
                now["illegal"] += 1
            live = first and not blank
            symbol = initial if initial in KEEP else "o"
            now["symbols"].append((symbol.upper() if cut else symbol) if live else "-")
            for name, value in (("counts", n), ("turns", turn), ("roles", role), ("keys", key)):
                now[name].append(value)
            now["blank"] += n if blank else 0
            now["duplicate"] += 0 if blank else n - first
            now["truncated"] += bool(live and cut)
            now["illegal"] += n - 1
            now["tail"] = initial
    if now is not None:
        now["edge"] = True
        yield closed(now)


def batched(rows: Iterator[dict[str, Any]], schema: pa.Schema, weight: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ROWS_OUT rows, or entries of the list column `weight`."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + (len(row[weight]) if weight else 0)
        if size >= ROWS_OUT:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_LONGS, _TEXTS = pa.list_(pa.int64()), pa.list_(pa.string())
_CHUNK_ARROW = pa.schema([
    ("c", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("edge", pa.bool_()), ("symbols", pa.string()),
    ("counts", _LONGS), ("turns", _LONGS), ("roles", _TEXTS), ("keys", pa.list_(pa.binary())), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
])


def _chunks(runs: DataFrame, most: int) -> DataFrame:
    """One row per chunk of at most `most` runs; ranges of the order are tasks, so a long conversation has many."""
    order = ["c", "turn", "role", "key"]
    sorted_runs = (
        runs.select(*order, "n", "blank", "cut", "first").repartitionByRange(*order).sortWithinPartitions(*order)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(_chunk_rows(batches, most), _CHUNK_ARROW, "counts")

    return stored(sorted_runs.mapInArrow(cut, CHUNK_SCHEMA), "talk-chunks")


# ---------------------------------------------------------------- passes over the chunks of conversations that have several

VECTOR = "array<double>"
_IDS = "c string, part int, chunk int"


def _over(df: DataFrame, each: Any, schema: str) -> DataFrame:
    """df with each(costs, row dict) -> row dict applied, one memory of costs for a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        costs = Costs()
        for frame in frames:
            rows = [each(costs, row) for row in frame.to_dict("records")]
            if rows:
                yield pd.DataFrame(rows)

    return df.mapInPandas(run, schema)


def _in_order() -> WindowSpec:
    """A conversation's chunks in turn."""
    return Window.partitionBy("c").orderBy("part", "chunk")


def _tuple(vector: Any) -> tuple:
    return tuple(int(x) for x in vector)


def _stitched(edge: DataFrame, fixups: int) -> DataFrame:
    """edge (c, part, chunk, symbols) -> (c, part, chunk, end, entry, last): the true vector after and state before each."""
    narrow = edge.select("c", "part", "chunk", "symbols")

    def speculate(costs: Costs, r: dict) -> dict:
        return {"c": r["c"], "part": r["part"], "chunk": r["chunk"], "end": TERMINAL, "start": costs.start(r["symbols"], TERMINAL)}

    state_schema = f"{_IDS}, end {VECTOR}, start {VECTOR}"
    state = stored(_over(narrow, speculate, state_schema), "talk-vectors")
    terminal = F.array(*[F.lit(float(x)) for x in TERMINAL])
    following = F.coalesce(F.lead("start").over(_in_order()), terminal)

    def again(costs: Costs, r: dict) -> dict:
        start = costs.fix_up(r["symbols"], _tuple(r["end"]), _tuple(r["start"]), _tuple(r["new_end"]))
        return {"c": r["c"], "part": r["part"], "chunk": r["chunk"], "end": r["new_end"], "start": start}

    for passed in range(fixups + 1):
        held = stored(state.withColumn("new_end", following).withColumn("moved", F.col("new_end") != F.col("end")), "talk-held")
        moved = held.filter("moved")
        if moved.isEmpty():
            break
        if passed == fixups:
            state = _by_matrices(narrow, state, moved)
            break
        rerun = _over(moved.join(narrow, ["c", "part", "chunk"]), again, state_schema)
        state = stored(held.filter("NOT moved").select("c", "part", "chunk", "end", "start").unionByName(rerun), "talk-vectors")

    def exits(costs: Costs, r: dict) -> dict:
        return {"c": r["c"], "part": r["part"], "chunk": r["chunk"], "end": r["end"], "exits": costs.exits(r["symbols"], _tuple(r["end"]))}

    traced = _over(state.join(narrow, ["c", "part", "chunk"]), exits, f"{_IDS}, end {VECTOR}, exits array<int>")

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["part", "chunk"])
        q, entries = NOTHING, []
        for row in frame["exits"]:
            entries.append(q)
            q = int(row[q])
        return frame.assign(entry=entries, last=[False] * (len(frame) - 1) + [True])[["c", "part", "chunk", "end", "entry", "last"]]

    # A group has one small row for each chunk of a conversation.
    return traced.groupBy("c").applyInPandas(link, f"{_IDS}, end {VECTOR}, entry int, last boolean")


def _by_matrices(narrow: DataFrame, state: DataFrame, moved: DataFrame) -> DataFrame:
    """state with exact ends for the conversations of `moved`, by min-plus matrices folded from the last chunk."""
    wanted = moved.select("c").distinct()

    def products(costs: Costs, r: dict) -> dict:
        flat = [x for row in costs.matrix(r["symbols"]) for x in row]
        return {"c": r["c"], "part": r["part"], "chunk": r["chunk"], "cells": flat}

    matrices = _over(narrow.join(wanted, "c", "left_semi"), products, f"{_IDS}, cells {VECTOR}")

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["part", "chunk"], ascending=False)
        vector, ends, starts = TERMINAL, [], []
        for cells in frame["cells"]:
            ends.append(vector)
            vector = level(tuple(min(cells[4 * q + p] + vector[p] for p in range(4)) for q in range(4)))[0]
            starts.append(vector)
        return frame.assign(end=ends, start=starts)[["c", "part", "chunk", "end", "start"]]

    exact = matrices.groupBy("c").applyInPandas(fold, f"{_IDS}, end {VECTOR}, start {VECTOR}")
    return stored(state.join(wanted, "c", "left_anti").unionByName(exact), "talk-exact")


# ---------------------------------------------------------------- trace and lines

EDIT = "struct<turn:bigint,role:string,key:binary,before:array<string>,kept:boolean,new_role:string,after:array<string>>"
SOLVED_SCHEMA = f"{_IDS}, audit string, cost bigint, edits array<{EDIT}>"
_EDIT_ARROW = pa.struct([
    ("turn", pa.int64()), ("role", pa.string()), ("key", pa.binary()), ("before", _TEXTS), ("kept", pa.bool_()),
    ("new_role", pa.string()), ("after", _TEXTS),
])
_SOLVED_ARROW = pa.schema([
    ("c", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("audit", pa.string()), ("cost", pa.int64()),
    ("edits", pa.list_(_EDIT_ARROW)),
])


def trace(costs: Costs, row: dict[str, Any]) -> dict[str, Any]:
    """A chunk's audit, cost and edits, from its entry state and the vector after it."""
    q, letters, total, edits = row["entry"], [], 0, []
    symbols, counts = row["symbols"], row["counts"]
    for k, (symbol, after) in enumerate(zip(symbols, costs.ends(symbols, _tuple(row["end"])))):
        word, cost, q, before, new_role = costs.move(symbol, after, q)
        more = counts[k] - 1
        letters.append(word + "D" * more)
        total += cost + DELETE * more
        if before or new_role is not None:
            edits.append({
                "turn": row["turns"][k], "role": row["roles"][k], "key": row["keys"][k], "before": list(before),
                "kept": new_role is not None, "new_role": new_role or row["roles"][k], "after": [],
            })
    if row["last"] and (rest := closing(q)):
        letters.append("I" * len(rest))
        total += INSERT * len(rest)
        k = len(symbols) - 1
        if not edits or edits[-1]["key"] != row["keys"][k] or edits[-1]["turn"] != row["turns"][k]:
            edits.append({
                "turn": row["turns"][k], "role": row["roles"][k], "key": row["keys"][k], "before": [], "kept": False,
                "new_role": None, "after": [],
            })
        edits[-1]["after"] = rest
    return {"c": row["c"], "part": row["part"], "chunk": row["chunk"], "audit": "".join(letters), "cost": total, "edits": edits}


def _traced(chunks: DataFrame, fixups: int) -> DataFrame:
    """Every chunk with its audit, cost and edits. Conversations that surely are one chunk need no stitching."""
    names = ["c", "part", "chunk", "symbols", "counts", "turns", "roles", "keys"]
    whole = chunks.filter("NOT edge").select(
        *names, F.array(*[F.lit(float(x)) for x in TERMINAL]).alias("end"), F.lit(NOTHING).alias("entry"), F.lit(True).alias("last")
    )
    edge = chunks.filter("edge").select(*names)
    placed = edge.join(stored(_stitched(edge, fixups), "talk-places"), ["c", "part", "chunk"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        return batched((trace(costs, row) for batch in batches for row in batch.to_pylist()), _SOLVED_ARROW, "edits")

    return stored(whole.unionByName(placed.select(*whole.columns)).mapInArrow(solve, SOLVED_SCHEMA), "talk-traces")


_LINE_ARROW = pa.schema([("c", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """Lines of a stream sorted by conversation, order and kind: an edit comes before the row that it is about."""
    now, place, about, waiting, after = None, 0, None, False, []
    for batch in batches:
        for c, turn, role, key, kind, before, kept, new_role, later, text in zip(*(batch.column(k).to_pylist() for k in range(10))):
            said = []
            if (c, turn, role, key) != about:
                said += [(r, "") for r in after]
                after, waiting = [], False
            if c != now:
                for r, t in said:
                    yield {"c": now, "place": place, "role": r, "text": t}
                    place += 1
                said, now, place = [], c, 0
            about = (c, turn, role, key)
            if kind == 0:
                said += [(r, "") for r in before]
                waiting, after, name = kept, later, new_role
            elif waiting:
                said.append((name, text))
                waiting = False
            for r, t in said:
                yield {"c": c, "place": place, "role": r, "text": t}
                place += 1
    for r in after:
        yield {"c": now, "place": place, "role": r, "text": ""}
        place += 1


def _lines(rows: DataFrame, traced: DataFrame) -> DataFrame:
    """(c, place, role, text) of the repaired conversations, each in one task and in order."""
    order = ["c", "turn", "role", "key", "kind"]
    told = ["before", "kept", "new_role", "after"]
    edits = traced.select("c", F.explode("edits").alias("e")).select(
        "c", "e.turn", "e.role", "e.key", F.lit(0).alias("kind"), *[f"e.{x}" for x in told], F.lit(None).cast("string").alias("text")
    )
    types = {"before": "array<string>", "kept": "boolean", "new_role": "string", "after": "array<string>"}
    said = rows.filter(F.rtrim(F.col("text"), F.lit(SPACES)) != "").select(
        "c", "turn", "role", "key", F.lit(1).alias("kind"), *[F.lit(None).cast(types[x]).alias(x) for x in told], "text"
    )
    both = edits.unionByName(said).repartition("c").sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(_line_rows(batches), _LINE_ARROW)

    return both.select(*order, *told, "text").mapInArrow(write, "c string, place bigint, role string, text string")


def digests(lines: DataFrame) -> DataFrame:
    """lines, each conversation in one task and in order -> (c, sha256 of `role:text` joined by newlines)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict[str, Any]]:
            now, sha = None, None
            for batch in batches:
                for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                    if c != now:
                        if sha is not None:
                            yield {"c": now, "sha256": sha.hexdigest()}
                        now, sha = c, hashlib.sha256(f"{role}:{text}".encode())
                    else:
                        sha.update(f"\n{role}:{text}".encode())
            if sha is not None:
                yield {"c": now, "sha256": sha.hexdigest()}

        return batched(rows(), pa.schema([("c", pa.string()), ("sha256", pa.string())]))

    return lines.mapInArrow(run, "c string, sha256 string")


# ---------------------------------------------------------------- the operator


@dataclass(frozen=True)
class Repair:
    """`lines`: (c, place, role, text), repaired, a conversation in one task and in order. `counts`: c with what was
    found and done: gaps, blank, duplicate, truncated, illegal, cost, audit, for conversations that have rows."""

    lines: DataFrame
    counts: DataFrame


def repair(talks: DataFrame, chunk: int = CHUNK, fixups: int = FIXUPS) -> Repair:
    """talks (conv_id, turn, role, text) -> the repaired conversations. c is conv_id as text, one space for null."""
    rows = _rows(talks)
    runs = _runs(rows)
    chunks = _chunks(runs, chunk)
    traced = _traced(chunks, fixups)
    seam = F.concat("tail", F.lead("head").over(_in_order()))
    seams = chunks.filter("edge").select("c", "part", "chunk", "head", "tail").select("c", (~seam.isin(*LEGAL)).cast("long").alias("illegal"))
    counted = ("blank", "duplicate", "truncated", "illegal")
    wide = "decimal(20,0)"
    spans = runs.groupBy("c").agg(
        (F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count_distinct("turn")).try_cast("long").alias("gaps")
    )
    parts = [spans, chunks.select("c", *counted), seams, traced.select("c", "part", "chunk", "audit", "cost")]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    # One letter for each row: as long as the result's own value.
    ordered = F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("part", "chunk", "audit"))))
    counts = every.groupBy("c").agg(
        F.coalesce(F.max("gaps"), F.lit(0)).alias("gaps"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counted],
        F.coalesce(F.sum("cost"), F.lit(0)).alias("cost"),
        F.array_join(ordered.getField("audit"), "").alias("audit"),
    )
    return Repair(_lines(rows, traced), counts)


def damaged(talks: DataFrame) -> DataFrame:
    """talks with faults put in by a checksum of conversation and turn; nulls are one space, null turns stay null."""
    name = F.concat(_id_text(F.col("conv_id")), F.lit(":"), _id_text(F.col("turn")))
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    hurt = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return talks.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        hurt.alias("text"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("_copy"),
    ).drop("_copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, damaged and repaired."""
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    done = repair(damaged(given))
    every = given.select(_id_text(F.col("conv_id")).alias("c")).distinct()
    sums = {name: F.coalesce(F.max(name), F.lit(0)).cast("long").alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    found = (
        every.unionByName(done.counts, allowMissingColumns=True)
        .unionByName(digests(done.lines), allowMissingColumns=True)
        .groupBy("c")
        .agg(*sums.values(), F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.max("sha256").alias("sha256"))
    )
    return found.select(
        F.when(F.col("c") != " ", F.col("c")).cast("long").alias("conv_id"),
        *sums,
        "audit",
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


by_value(__name__)
