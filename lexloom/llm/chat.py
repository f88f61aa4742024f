"""Chat formatting: the cheapest repair of each conversation's roles, then its rendering.

A legal conversation is an optional system turn, then user and assistant in turns, the assistant last. Each
input turn is either put out (under its own role, or relabelled), after an inserted empty turn where the
order needs one, or merged into the turn before; dynamic programming over the state "role of the last turn
put out" finds the repair of least cost. Of repairs of equal cost the one that puts out rather than merges,
inserts rather late, and relabels to the earlier role in system, user, assistant is taken.

Steps of the program are min-plus matrices, and these are associative: the rows of a conversation are numbered
in order, by counts per range partition, and cut into blocks of ``BLOCK`` rows, each block becomes one matrix, the matrices of a conversation are combined in levels
of ``FAN`` blocks, and the chosen states go back down to the blocks, which repair their own turns. So a
conversation of any length is many bounded tasks, and the result stays one row per turn.

* Rows repeated in all of conversation, turn, role and text count once.
* Turn numbers may be negative, far apart, or shared: rows follow one another by turn, role, hash of the text, text.
* Rows without conversation or turn number are conversations of their own, one each.
* Roles are compared without case and outer blanks; unknown and NULL roles cost a relabelling.
* NULL and empty texts are turns with empty text. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import materialize, numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # states; a role's state is its place in ROLES plus one
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Cost of a merge, a changed role, an empty turn.
MERGE, RELABEL, INSERT = 1, 2, 3
#: Cost of ending in each state, and the empty turns that this adds.
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
#: Rows in a block, blocks in a group of the level above.
BLOCK, FAN = 256, 64
_FAR = 1 << 40


def moves(state: int, role: int) -> list[tuple[int, int, int]]:
    """(cost, next state, inserted state or -1) of the ways to take a turn; role 0 is unknown.

    Listed in the order of preference; a merge keeps the state and inserts nothing.
    """
    out = []
    for target in (SYSTEM, USER, ASSISTANT):
        changed = RELABEL * (role != target)
        if target in NEXT[state]:
            out.append((changed, target, -1))
        out += [(changed + INSERT, target, between) for between in NEXT[state] if target in NEXT[between]]
    if state != START:
        out.append((MERGE + RELABEL * (role != state), state, -2))
    return sorted(out, key=lambda m: (m[0], m[2] == -2, m[2] >= 0, m[1]))


#: role -> for each state the cheapest move to each next state.
STEPS = [[{t: next(m for m in moves(s, role) if m[1] == t) for t in {m[1] for m in moves(s, role)}} for s in range(4)] for role in range(4)]


def matrix(roles: list[int]) -> list[int]:
    """Least cost from each state to each state over these turns, row by row."""
    out = []
    for entry in range(4):
        cost = [0 if s == entry else _FAR for s in range(4)]
        for role in roles:
            new = [_FAR] * 4
            for s in range(4):
                if cost[s] < _FAR:
                    for t, m in STEPS[role][s].items():
                        new[t] = min(new[t], cost[s] + m[0])
            cost = new
        out += cost
    return out


def product(left: list[int], right: list[int]) -> list[int]:
    """Min-plus product: first the one stretch, then the other."""
    return [min(left[4 * i + k] + right[4 * k + j] for k in range(4)) for i in range(4) for j in range(4)]


def path(entry: int, leave: int, steps: list[list[int]]) -> list[int]:
    """States after each of the steps (given as matrices) of a cheapest way; the smaller state of equals."""
    rest = [[_FAR] * 4 for _ in range(len(steps) + 1)]
    rest[-1][leave] = 0
    for i in range(len(steps) - 1, -1, -1):
        rest[i] = [min(steps[i][4 * s + t] + rest[i + 1][t] for t in range(4)) for s in range(4)]
    out, state = [], entry
    for i, step in enumerate(steps):
        state = min(range(4), key=lambda t: (step[4 * state + t] + rest[i + 1][t], t))
        out.append(state)
    return out


def _single(role: int) -> list[int]:
    return [STEPS[role][s][t][0] if t in STEPS[role][s] else _FAR for s in range(4) for t in range(4)]


def rendered(state: int, text: str, first: bool) -> str:
    """Opening of a turn, after the end of the one before it."""
    return ("" if first else "<|end|>\n") + f"<|{ROLES[state - 1]}|>\n{text}"


def repaired(rows: list[dict], entry: int, leave: int, last: bool) -> Iterator[tuple]:
    """(out_role, action, inserted, cost, piece) of the turns of one block, with its ways in and out known."""
    state = entry
    ways = path(entry, leave, [_single(r["role_state"]) for r in rows])
    for i, (row, after) in enumerate(zip(rows, ways)):
        cost, target, how = STEPS[row["role_state"]][state][after]
        text, changed = row["text"] or "", row["role_state"] != target
        piece = f"\n{text}" if how == -2 else rendered(how, "", state == START) + rendered(target, text, False) if how >= 0 else rendered(target, text, state == START)
        if last and i == len(rows) - 1:
            piece += "".join(rendered(s, "", False) for s in ENDING[after]) + "<|end|>\n"
            cost += INSERT * len(ENDING[after])
        action = ("merge" if how == -2 else "put") + ("_relabelled" if changed else "")
        yield ROLES[target - 1], action, ROLES[how - 1] if how >= 0 else None, cost, piece
        state = after


def _grouped(key: tuple[str, ...], work: Callable[[list[dict]], list[tuple]], names: list[str], types: list[pa.DataType]):
    """Arrow function for rows sorted by ``key``: ``work`` on each run of equal keys, however batches cut it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple] = []

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if held and any(held[-1][k] != row[k] for k in key):
                    out += work(held)
                    held = []
                held.append(row)
            yield made(out)
            out = []
        yield made(work(held) if held else [])

    return run


def _sorted(df: DataFrame, key: tuple[str, ...], *then: str) -> DataFrame:
    """Rows of a key together in one task, in order."""
    return df.repartition(*key).sortWithinPartitions(*key, *then)


def _turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").distinct()
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    role = F.lower(F.trim("role"))
    state = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), role), F.lit(0)).cast("int")
    key = F.when(alone, F.concat(F.lit("~"), F.md5(F.to_json(F.struct("conv_id", "turn", "role", "text"))))).otherwise(F.col("conv_id").cast("string"))
    keyed = rows.select("*", key.alias("key"), F.xxhash64("text").alias("text_hash"), state.alias("role_state"))
    # Ranges are cut by the hash, not by texts, whose sample would go through the driver.
    placed = numbered(keyed, "key", "turn", "role", "text_hash")
    return placed.withColumn("block", F.expr(f"at div {BLOCK}"))


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, then out_role, action (put or merge, ``_relabelled`` where the role changed),
    inserted (role of an empty turn put before), cost and piece; the pieces of a conversation in order are
    its rendering."""
    key = ("key", "block")
    turns = _turns(conversations)

    def summed(rows: list[dict]) -> list[tuple]:
        return [(rows[0]["key"], rows[0]["block"], matrix([r["role_state"] for r in rows]))]

    matrix_types = [pa.string(), pa.int64(), pa.list_(pa.int64())]
    schema = "key string, block long, costs array<long>"
    narrow = turns.select(*key, "at", "role_state")
    level = materialize(_sorted(narrow, key, "at").mapInArrow(_grouped(key, summed, ["key", "block", "costs"], matrix_types), schema), "blocks")
    levels = [level]

    def combined(rows: list[dict]) -> list[tuple]:
        total = rows[0]["costs"]
        for r in rows[1:]:
            total = product(total, r["costs"])
        return [(rows[0]["key"], rows[0]["group"], total)]

    while level.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        grouped = level.withColumn("group", F.expr(f"block div {FAN}"))
        one = ("key", "group")
        level = materialize(_sorted(grouped, one, "block").mapInArrow(_grouped(one, combined, ["key", "block", "costs"], matrix_types), schema), "blocks")
        levels.append(level)

    # The top: from the start to the state that costs least with its ending.
    totals = F.array(*(F.struct((F.get("costs", F.lit(s)) + INSERT * len(ENDING[s])).alias("cost"), F.lit(s).alias("state")) for s in range(4)))
    ways = level.select("key", "block", F.lit(START).alias("entry"), F.array_min(totals)["state"].alias("leave"), F.lit(True).alias("last"))

    def divided(rows: list[dict]) -> list[tuple]:
        entry, out = rows[0]["entry"], []
        for i, (r, after) in enumerate(zip(rows, path(entry, rows[0]["leave"], [r["costs"] for r in rows]))):
            out.append((r["key"], r["block"], entry, after, rows[0]["last"] and i == len(rows) - 1))
            entry = after
        return out

    way_names, way_types = ["key", "block", "entry", "leave", "last"], [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    for lower in reversed(levels[:-1]):
        above = ways.withColumnRenamed("block", "group")
        joined = lower.withColumn("group", F.expr(f"block div {FAN}")).join(above, ["key", "group"])
        ways = _sorted(joined, ("key", "group"), "block").mapInArrow(
            _grouped(("key", "group"), divided, way_names, way_types), "key string, block long, entry int, leave int, last boolean"
        )

    own = ["conv_id", "turn", "role", "text"]
    out_types = "out_role string, action string, inserted string, cost long, piece string"

    def finished(rows: list[dict]) -> list[tuple]:
        return [(*(r[c] for c in own), *new) for r, new in zip(rows, repaired(rows, rows[0]["entry"], rows[0]["leave"], rows[0]["last"]))]

    kinds = turns.select(*own)
    arrow = [*(pa.from_numpy_dtype("int64") if f.dataType.typeName() == "long" else pa.int32() if f.dataType.typeName() == "integer" else pa.string() for f in kinds.schema), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    together = _sorted(turns.join(ways, list(key)), key, "at")
    names = [*own, "out_role", "action", "inserted", "cost", "piece"]
    schema = kinds.schema
    for part in out_types.split(", "):
        schema = schema.add(*part.split(" "))
    return together.mapInArrow(_grouped(key, finished, names, arrow), schema)
