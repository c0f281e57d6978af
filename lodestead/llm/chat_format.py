"""Minimum-cost role repair of conversations and their rendering.

Legal conversations follow an automaton: an optional system turn, then user and assistant
turns in alternation, ending with the assistant.  A turn can be relabelled, merged into the
turn before it, or preceded by empty turns; dynamic programming over the automaton's
states finds the cheapest repair.

One conversation may hold a third of all rows, so the turns are cut into ranges of about
``RANGE_ROWS`` rows or ``RANGE_BYTES`` of text in order of (conv_id, turn).  A range's effect
on a conversation is a 4 x 4 matrix of least costs, matrices of later ranges are applied
to the vector before them, and the chosen states are handed back from the last range to
the first: three passes over the ranges, of which the first two read roles only.  What a
conversation needs in between, a few numbers for each of its ranges, is worked out in a
group of its own; nothing of it reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

RANGE_ROWS = 20_000
RANGE_BYTES = 16_000_000
ROLES = ("start", "system", "user", "assistant")
ALIASES = {"system": 1, "developer": 1, "user": 2, "human": 2, "prompter": 2, "assistant": 3, "gpt": 3, "bot": 3, "model": 3}
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 2, 1, 1, 3
_FAR = 10**9


def _fillers() -> dict[tuple[int, int], tuple[int, ...]]:
    """Fewest turns to insert so that a turn in one state may be followed by another."""
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    for start in range(4):
        paths = [()]
        while paths:
            following = []
            for path in paths:
                for state in LEGAL[path[-1] if path else start]:
                    if (start, state) not in found:
                        found[start, state] = path
                        following.append((*path, state))
            paths = following
    return found


FILLERS = _fillers()
#: Cost of entering a state from another: nothing, a merge, or insertions.
MOVE = np.array([[0 if t in LEGAL[s] else MERGE if s == t and s else INSERT * len(FILLERS[s, t]) if (s, t) in FILLERS else _FAR for t in range(4)] for s in range(4)], np.int64)
MOVE[:, 0] = _FAR
END = np.array([0, INSERT * 2, INSERT, 0], np.int64)


def role_number(role: str | None) -> int:
    """1 to 3 for a known role or alias, 0 for any other."""
    return ALIASES.get((role or "").strip().lower(), 0)


#: Of each role: cost of going from state to state with a turn of that role.
STEP = np.stack([MOVE + np.array([_FAR] + [0 if r == label else RELABEL if r else RELABEL_UNKNOWN for label in (1, 2, 3)]) for r in range(4)])


def _forward(roles: list[int], entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs after the last turn, and for each turn and state the least best state before."""
    back, costs = np.zeros((len(roles), 4), np.int8), entry
    for k, r in enumerate(roles):
        through = costs[:, None] + STEP[r]
        back[k] = through.argmin(axis=0)
        costs = np.minimum(through.min(axis=0), _FAR)
    return costs, back


def _states(back: np.ndarray, last: int) -> list[int]:
    """State after each turn, and before the first at index 0."""
    states = [last]
    for row in back[::-1]:
        states.append(int(row[states[-1]]))
    return states[::-1]


def _blocks(batch: pa.Table, *names: str) -> Iterator[tuple]:
    """Runs of one conversation in a range, in order: its number there, id, and columns."""
    batch = batch.sort_by("seq")
    columns = [batch.column(n).to_pylist() for n in names]
    for number, (conv, rows) in enumerate(groupby(range(batch.num_rows), key=batch.column("conv_id").to_pylist().__getitem__)):
        rows = list(rows)
        yield number, conv, *([c[i] for i in rows] for c in columns)


def _ordered(table: pa.Table, *columns: str) -> list[dict]:
    return table.sort_by([(c, "ascending") for c in columns]).to_pylist()


def repair_roles(conversations: DataFrame, *, range_rows: int = RANGE_ROWS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> a row per turn with its repair.

    Columns: ``conv_id, turn, position, role, text`` of the input turn; ``new_role``;
    ``action`` (keep, relabel, merge or relabel_merge); ``inserted`` and ``appended``,
    roles of empty turns put before it and, after a conversation's last turn, behind it;
    ``fragment``, its piece of the rendering.  A conversation's fragments, joined in order
    of ``position``, are its rendering: ``<|role|>`` and a line end, the text, ``<|end|>``
    and a line end for each turn.  ``<|`` inside a text is rendered as ``<\\|``, so that
    a text can't end its turn.

    Turns are ordered by turn, nulls first; rows of one turn by a hash of role and text, so
    that they can be cut into ranges as well, and ties that are left are equal rows.
    Of repairs of equal cost the one is taken whose states, from the last turn back, have
    the least numbers, whatever the ranges.  Known aliases of a role count as it; other
    roles, null or empty ones cost less to relabel than known ones.  A null text is an
    empty one; the rows with a null conv_id are one conversation; other columns are not
    looked at; an empty table gives no rows.
    """
    turns = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, size = turns.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = max(1, -(-rows // range_rows), -(-size // range_bytes))
    order = ["conv_id", "turn", "role", "text"]
    # The number of a row in this order: the range in the high bits, the place in it below.
    placed = turns.repartitionByRange(ranges, "conv_id", "turn", F.xxhash64("role", "text")).sortWithinPartitions("conv_id", "turn", F.xxhash64("role", "text"), *order[2:])
    placed = written(placed.withColumn("seq", F.monotonically_increasing_id()), "turns").withColumn("part", F.shiftright("seq", 33).cast("int"))
    roles = placed.select("part", "seq", "conv_id", "role")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}

    def matrices(batch: pa.Table) -> pa.Table:
        """Costs through the first and the last conversation of a range, which others may continue."""
        part, own, out = batch.column("part")[0].as_py(), list(_blocks(batch, "role")), []
        for number, conv, named in own:
            if number in (0, len(own) - 1):
                numbers = [role_number(r) for r in named]
                through = [_forward(numbers, np.where(np.arange(4) == s, 0, _FAR))[0].tolist() for s in range(4)]
                out.append((conv, part, number, len(named), sum(through, [])))
        types = (batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        return pa.table([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=["conv_id", "part", "block", "n", "costs"])

    edges = written(roles.groupBy("part").applyInArrow(matrices, f"conv_id {kinds['conv_id']}, part int, block int, n long, costs array<long>"), "edges")

    def entered(batch: pa.Table) -> pa.Table:
        """Costs at the start of each range of a conversation, and the state after its last turn; nothing for one range."""
        chain, out = _ordered(batch, "part"), []
        costs, done = np.where(np.arange(4) == 0, 0, _FAR), 0
        for r in chain if len(chain) > 1 else ():
            out.append((r["conv_id"], r["part"], r["block"], done, costs.tolist()))
            costs, done = np.minimum((costs[:, None] + np.array(r["costs"]).reshape(4, 4)).min(axis=0), _FAR), done + r["n"]
        final = int((costs + END).argmin())
        types = (batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        return pa.table([*(pa.array([o[k] for o in out], t) for k, t in enumerate(types)), pa.array([final] * len(out), pa.int32())], names=["conv_id", "part", "block", "done", "costs", "final"])

    entries = written(edges.groupBy("conv_id").applyInArrow(entered, f"conv_id {kinds['conv_id']}, part int, block int, done long, costs array<long>, final int"), "entries")

    def origins(batch: pa.Table, known: pa.Table) -> pa.Table:
        """For each state after a range's piece of a conversation, the state before it."""
        blocks, out = {r["block"]: r for r in known.to_pylist()}, []
        for number, conv, named in _blocks(batch, "role") if blocks and batch.num_rows else ():
            if number in blocks:
                r = blocks[number]
                back = _forward([role_number(x) for x in named], np.array(r["costs"]))[1]
                out.append((conv, r["part"], number, r["done"], r["costs"], r["final"], [_states(back, t)[0] for t in range(4)]))
        types = (batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int32()))
        return pa.table([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=["conv_id", "part", "block", "done", "costs", "final", "origin"])

    touched = roles.join(entries.select("part").distinct(), "part", "left_semi")
    traced = touched.groupBy("part").cogroup(entries.groupBy("part")).applyInArrow(origins, f"conv_id {kinds['conv_id']}, part int, block int, done long, costs array<long>, final int, origin array<int>")

    def left(batch: pa.Table) -> pa.Table:
        """The state after each range of a conversation, from the last one back."""
        out, state = [], None
        for r in reversed(_ordered(batch, "part")):
            last = state is None
            state = r["final"] if last else state
            out.append((r["part"], r["block"], r["done"], r["costs"], state, last))
            state = r["origin"][state]
        types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.bool_())
        return pa.table([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=["part", "block", "done", "costs", "state", "last"])

    exits = written(traced.groupBy("conv_id").applyInArrow(left, "part int, block int, done long, costs array<long>, state int, last boolean"), "exits")

    def repaired(batch: pa.Table, known: pa.Table) -> pa.Table:
        blocks, rows = {r["block"]: r for r in known.to_pylist()}, []
        for number, conv, turn, role, text in _blocks(batch, "turn", "role", "text"):
            piece = blocks.get(number, {"done": 0, "costs": [0, _FAR, _FAR, _FAR], "state": None, "last": True})
            costs, back = _forward([role_number(r) for r in role], np.array(piece["costs"]))
            states = _states(back, int((costs + END).argmin()) if piece["state"] is None else piece["state"])
            for k, (t, r, x) in enumerate(zip(turn, role, text, strict=True)):
                old, new = states[k], states[k + 1]
                merged, closes = old == new, piece["last"] and k == len(turn) - 1
                inserted = () if merged else FILLERS[old, new]
                appended = {1: (2, 3), 2: (3,)}.get(new, ()) if closes else ()
                action = "_".join(["relabel"] * (role_number(r) != new) + ["merge"] * merged) or "keep"
                fragment = _fragment(old, new, inserted, appended, x, closes)
                rows.append((conv, t, piece["done"] + k, r, x, ROLES[new], action, [ROLES[i] for i in inserted], [ROLES[i] for i in appended], fragment))
        names = ("conv_id", "turn", "position", "role", "text", "new_role", "action", "inserted", "appended", "fragment")
        types = (batch.schema.field("conv_id").type, batch.schema.field("turn").type, pa.int64(), *[pa.string()] * 4, pa.list_(pa.string()), pa.list_(pa.string()), pa.string())
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=list(names))

    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, position long, role string, text string, new_role string, action string, inserted array<string>, appended array<string>, fragment string"
    return placed.groupBy("part").cogroup(exits.groupBy("part")).applyInArrow(repaired, schema)


def _fragment(old: int, new: int, inserted: tuple, appended: tuple, text: str, closes: bool) -> str:
    empty = "".join(f"<|{ROLES[i]}|>\n<|end|>\n" for i in inserted)
    head = "\n" if old == new else f"{'<|end|>' + chr(10) if old else ''}{empty}<|{ROLES[new]}|>\n"
    tail = "<|end|>\n" + "".join(f"<|{ROLES[i]}|>\n<|end|>\n" for i in appended) if closes else ""
    return head + text.replace("<|", "<\\|") + tail


def rendered(repaired: DataFrame) -> DataFrame:
    """``(conv_id, rendering)``: every conversation as one text, which has to fit into one value.

    Longer ones are read from the fragments in order of ``position``.
    """
    pieces = F.array_sort(F.collect_list(F.struct("position", "fragment")))
    return repaired.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda p: p["fragment"]), "").alias("rendering"))
