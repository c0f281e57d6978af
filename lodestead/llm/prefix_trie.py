"""The trie of conversations' prefixes, built as z-fast tries of batches that are merged.

A turn is a digest of its role and text, and a prefix the exclusive or of a hash of each
(depth, digest), so prefixes are compared by 128 bits at any depth without their texts.

1. Turns are numbered within their conversation by ranges of (conv_id, turn): a
   conversation may hold any part of all rows.
2. Conversations are cut into sequences of ``SEQUENCE`` turns; a later one starts from the prefix
   before it.  A task inserts the sequences of a range of conv_ids into a compacted trie, a
   bounded batch at a time: nodes are hashed under their handle, the prefix whose depth in
   the node's edge is divisible by the greatest power of two; fat binary search over the
   handles finds the node where a sequence leaves the trie, and its edge is split there.
3. Edges are expanded to a row for each depth; rows of one prefix from several batches are
   added up.
4. The least conversation below a node owns it, so a conversation owns the nodes of one
   stretch of depths: a path, which hangs on a node of a path with a lesser id.  Sums over
   subtrees are sums over paths, doubled up the tree of paths (as many rounds as the logarithm
   of its height), and then along each path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_sql, written

SEQUENCE = 1_024
#: Turns of one trie: bounds a task's memory.
BATCH_TURNS = 200_000
RANGE_ROWS = 50_000
#: Conversation ids in one piece of a node's list of ends.
PIECE_IDS = 4_096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the greatest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted trie of sequences given by the hashes of their prefixes.

    Node ``g`` covers depths ``name[g] + 1`` to ``extent[g]`` of the sequence ``of[g]``.
    """

    def __init__(self):
        self.name: list[int] = []
        self.extent: list[int] = []
        self.of: list[int] = []
        self.members: list[int] = []  # sequences that end at the node's extent
        self.least: list[int | None] = []  # the least conversation among them
        self.ends: dict[int, list[int]] = {}  # conversations that end there
        self.handles: dict[bytes, int] = {}
        self.branches: dict[bytes, int] = {}  # by the prefix one turn beyond the parent's extent
        self.roots: dict[bytes, int] = {}
        self.sequences: list[tuple[int, list[bytes], np.ndarray]] = []  # depth before it, prefixes from there, columns

    def _prefix(self, sequence: int, depth: int) -> bytes:
        start, prefixes, _ = self.sequences[sequence]
        return prefixes[depth - start]

    def _node(self, name: int, extent: int, sequence: int) -> int:
        for column, value in ((self.name, name), (self.extent, extent), (self.of, sequence), (self.members, 0), (self.least, None)):
            column.append(value)
        return len(self.name) - 1

    def _hang(self, node: int) -> None:
        """Enters a node under its handle and its branch."""
        name = self.name[node]
        self.handles[self._prefix(self.of[node], two_fattest(name, self.extent[node]))] = node
        self.branches[self._prefix(self.of[node], name + 1)] = node

    def exit_node(self, start: int, prefixes: list[bytes]) -> int:
        """The node in whose edge, or at whose end, the sequence leaves the trie."""
        node, low, high = self.roots[prefixes[0]], start, start + len(prefixes) - 1
        top = high
        while low < high:
            middle = two_fattest(low, high)
            found = self.handles.get(prefixes[middle - start])
            if found is None:
                high = middle - 1
                continue
            node, low = found, self.extent[found]
            if low > top or prefixes[low - start] != self._prefix(self.of[found], low):
                return found
        return self.branches.get(prefixes[self.extent[node] + 1 - start], node) if self.extent[node] < top else node

    def insert(self, conv_id: int, start: int, prefixes: list[bytes], columns: np.ndarray, ends: bool) -> None:
        """Adds a sequence: ``prefixes`` of ``start`` turns and each number more."""
        top = start + len(prefixes) - 1
        if prefixes[0] not in self.roots:
            self.sequences.append((start, prefixes, columns))
            self.roots[prefixes[0]] = self._node(start, start, len(self.sequences) - 1)
        node = self.exit_node(start, prefixes)
        low, high = self.name[node], min(self.extent[node], top)
        while low < high:  # the depth at which it leaves the edge
            middle = (low + high + 1) // 2
            if prefixes[middle - start] == self._prefix(self.of[node], middle):
                low = middle
            else:
                high = middle - 1
        if low < self.extent[node]:  # the upper part of the edge becomes a node
            del self.handles[self._prefix(self.of[node], two_fattest(self.name[node], self.extent[node]))]
            upper = self._node(self.name[node], low, self.of[node])
            self.name[node] = low
            self._hang(upper)
            self._hang(node)
            node = upper
        if low < top:
            self.sequences.append((start, prefixes, columns))
            node = self._node(low, top, len(self.sequences) - 1)
            self._hang(node)
        self.members[node] += 1
        self.least[node] = conv_id if self.least[node] is None else min(conv_id, self.least[node])
        if ends:
            self.ends.setdefault(node, []).append(conv_id)

    def expanded(self) -> Iterator[tuple[int, int, int, int]]:
        """``(node, sequence, members, least conversation)`` with members below added, children first."""
        members, least = list(self.members), list(self.least)
        roots = set(self.roots.values())
        inner = {self._prefix(self.of[g], self.extent[g]): g for g in range(len(self.name)) if g not in roots}
        for g in sorted(range(len(self.name)), key=self.extent.__getitem__, reverse=True):
            yield g, self.of[g], members[g], least[g]
            if g not in roots:
                above = self._prefix(self.of[g], self.name[g])
                up = self.roots[above] if self.name[g] == self.sequences[self.of[g]][0] else inner[above]
                members[up] += members[g]
                least[up] = least[g] if least[up] is None else min(least[g], least[up])


_NODE = "depth long, a long, b long, parent_a long, parent_b long, conv_id long, n_convs long, chars long, ids binary"
_TYPES = [*[pa.int64()] * 8, pa.binary()]
_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def _rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
    """A row for each depth of each edge, and the ids of the conversations that end at a node, in pieces."""
    parts: list[list[np.ndarray]] = []
    for g, sequence, members, least in trie.expanded():
        start, _, columns = trie.sequences[sequence]
        depth = np.arange(trie.name[g] + 1, trie.extent[g] + 1)
        if trie.name[g] == trie.extent[g] == 0:  # the root of all; later sequences hang on a node of the one before
            parts.append([np.zeros(1, np.int64)] * 5 + [np.array([least]), np.array([members]), np.zeros(1, np.int64)])
        elif len(depth):
            here, above = columns[depth - start], columns[depth - start - 1]
            parts.append([depth, here[:, 0], here[:, 1], above[:, 0], above[:, 1], np.full(len(depth), least), np.full(len(depth), members), here[:, 2]])
    if parts:
        merged = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
        yield pa.record_batch([*map(pa.array, merged), pa.nulls(len(merged[0]), pa.binary())], names=_NAMES)
    ends = []
    for g, ids in trie.ends.items():
        start, _, columns = trie.sequences[trie.of[g]]
        a, b, _ = columns[trie.extent[g] - start].tolist()
        ids.sort()
        ends += [(trie.extent[g], a, b, ids[i], ",".join(map(str, ids[i : i + PIECE_IDS])).encode()) for i in range(0, len(ids), PIECE_IDS)]
    if ends:
        depth, a, b, first, text = zip(*ends, strict=True)
        none = pa.nulls(len(ends), pa.int64())
        yield pa.record_batch([pa.array(depth, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), none, none, pa.array(first, pa.int64()), none, none, pa.array(text, pa.binary())], names=_NAMES)


def _tries(batch_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = ZFastTrie(), 0
        for batch in batches:
            convs, starts, before_a, before_b, last = (batch.column(c).to_pylist() for c in ("conv_id", "start", "before_a", "before_b", "last"))
            turns = batch.column("turns")
            ends = turns.offsets.to_numpy() - turns.offsets[0].as_py()
            flat = turns.flatten()
            terms = np.stack([flat.field(c).to_numpy() for c in ("a", "b", "chars")], axis=1).astype(np.int64)
            for i, conv_id in enumerate(convs):
                columns = np.concatenate(([[before_a[i], before_b[i], 0]], terms[ends[i] : ends[i + 1]]))
                np.bitwise_xor.accumulate(columns[:, :2], axis=0, out=columns[:, :2])
                prefixes = np.ascontiguousarray(columns[:, :2]).view("V16").ravel().tolist()
                trie.insert(conv_id, starts[i], prefixes, columns, last[i])
                held += len(prefixes)
                if held >= batch_turns:
                    yield from _rows(trie)
                    trie, held = ZFastTrie(), 0
        yield from _rows(trie)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces of ids, which come in order; a piece is all that is held."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([key[0]]), pa.array([key[1]]), pa.array([digest.hexdigest()])], names=["a", "b", "ends_sha256"])

    for batch in batches:
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
            if (a, b) == key:
                digest.update(b"," + ids)
                continue
            if key is not None:
                yield row()
            key, digest = (a, b), hashlib.sha256(ids)
    if key is not None:
        yield row()


def numbered_turns(conversations: DataFrame, *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(conv_id, position, digest_1, digest_2, chars)`` of each turn; ``position`` counts from 0.

    Turns are ordered by turn, nulls first; rows of one turn by a hash of role and text.  A
    null role or text is empty.  Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.sha2(F.concat_ws(":", F.length(role), role, text).cast("binary"), 256)
    digests = [F.conv(F.substring(named, at, 15), 16, 10).cast("long").alias(c) for at, c in ((1, "digest_1"), (16, "digest_2"))]
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *digests, F.length(text).cast("long").alias("chars"))
    order = ["conv_id", "turn", "digest_1", "digest_2"]
    ranges = max(1, -(-turns.count() // range_rows))
    placed = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    placed = written(placed.drop("turn"), "turns").withColumn("part", F.shiftright("seq", 33))
    # A row for each conversation of a range: where it starts there, and its turns in the ranges before.
    blocks = placed.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("conv_id", "part", (before - F.col("first")).alias("shift"))
    return placed.join(blocks, ["conv_id", "part"]).select("conv_id", (F.col("seq") + F.col("shift")).alias("position"), "digest_1", "digest_2", "chars")


def rebuilt(turns: DataFrame, *, group: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation c - c % group.

    h = crc32(decimal c) % most.  Of a shorter conversation all turns are taken, of an absent one none; a
    conversation left without turns is one row with a null position.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % group
    sizes = sizes.select("conv_id", "n", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    sizes = sizes.join(sizes.where("conv_id = base").select("base", F.col("n").alias("base_n")), "base", "left").select("conv_id", "base", "n", "h", taken.alias("taken"))
    rest = ["digest_1", "digest_2", "chars"]
    own = turns.join(sizes, "conv_id").where("position >= h").select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), *rest)
    first = turns.where((F.col("position") < most - 1) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    given = first.join(sizes, "base").where("position < h").select("conv_id", "position", *rest)
    none = sizes.where("taken = 0 and n <= h").select("conv_id", *(F.lit(None).cast("long").alias(c) for c in ("position", *rest)))
    return own.unionByName(given).unionByName(none)


def _term(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("position"), F.col("digest_1"), F.col("digest_2"))


def trie_nodes(turns: DataFrame, *, sequence: int = SEQUENCE, batch_turns: int = BATCH_TURNS, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(depth, a, b, parent_a, parent_b, conv_id, n_convs, chars)`` and ``(a, b, ends_sha256)`` of those where conversations end.

    ``a`` and ``b`` are the hash of a prefix, ``conv_id`` the least of the ``n_convs``
    conversations that have it, ``chars`` the code points of its last text.
    """
    turn = F.when(F.col("position").isNotNull(), F.struct("position", _term(1).alias("a"), _term(2).alias("b"), "chars"))
    cut = turns.select("conv_id", F.coalesce(F.floor(F.col("position") / sequence), F.lit(0)).alias("piece"), turn.alias("turn"))
    # collect_list passes nulls over: a conversation without turns has an empty list.
    pieces = cut.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list("turn")).alias("turns"), F.bit_xor("turn.a").alias("xor_a"), F.bit_xor("turn.b").alias("xor_b"))
    pieces = written(pieces, "pieces")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.select("conv_id", "piece", *(F.coalesce(F.bit_xor(f"xor_{c}").over(before), F.lit(0)).alias(f"before_{c}") for c in "ab"), F.lead("piece").over(Window.partitionBy("conv_id").orderBy("piece")).isNull().alias("last"))
    sequences = pieces.join(ahead, ["conv_id", "piece"]).select("conv_id", (F.col("piece") * sequence).alias("start"), "before_a", "before_b", "last", "turns")
    ranges = max(1, -(-turns.count() // range_rows))
    ordered = sequences.repartitionByRange(ranges, "conv_id", "start").sortWithinPartitions("conv_id", "start")
    rows = written(ordered.mapInArrow(_tries(batch_turns), _NODE), "trie_rows")
    same = ["parent_a", "parent_b", "chars"]
    nodes = rows.where("n_convs is not null").groupBy("depth", "a", "b").agg(*(F.min(c).alias(c) for c in (*same, "conv_id")), F.sum("n_convs").alias("n_convs"))
    # Ranges of conv_ids don't overlap, so pieces in order of their first id are in order throughout.
    ends = rows.where("ids is not null").select("a", "b", "conv_id", "ids").repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")
    return nodes, ends.mapInArrow(_hashed, "a long, b long, ends_sha256 string")


def _path_totals(paths: DataFrame) -> DataFrame:
    """``(conv_id, saved, leaves)`` with the sums of all paths below added, for ``paths(conv_id, up, saved, leaves)``.

    After round k a path has its descendants at distances below 2**k, and ``up`` is its
    ancestor at distance 2**k.
    """
    while True:
        paths = written(paths, "paths")
        if paths.where("up is not null").isEmpty():
            return paths.drop("up")
        below = paths.where("up is not null").groupBy(F.col("up").alias("conv_id")).agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        further = paths.select(F.col("conv_id").alias("up"), F.col("up").alias("further"))
        paths = paths.join(below, "conv_id", "left").join(further, "up", "left").select("conv_id", F.col("further").alias("up"), *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")))


def conversation_trie(turns: DataFrame, *, sequence: int = SEQUENCE, batch_turns: int = BATCH_TURNS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """A row for each distinct prefix of the conversations in ``turns``, of `numbered_turns` or `rebuilt`.

    Columns: ``conv_id``, the least that has the prefix; ``depth``; ``parent_conv_id``;
    ``n_convs``; ``n_children``; ``n_leaves``, childless nodes in its subtree, itself
    included; ``saved_tokens``, the sum over its subtree of (n_convs - 1) times the code
    points of a node's last text; ``ends_sha256`` of the ids that end there, in
    ascending order, joined by commas.

    Equal conversations are members of the same nodes; one without turns is a member of the root alone.  No
    conversations give no rows.
    """
    found, ends = trie_nodes(turns, sequence=sequence, batch_turns=batch_turns, range_rows=range_rows)
    found = written(found.withColumn("own", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    root, nodes = found.where("depth = 0"), found.where("depth > 0")
    paths = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "parent_a", "parent_b")).alias("head"), F.max("depth").alias("deepest"), F.sum("own").alias("saved"))
    paths = paths.select("conv_id", (F.col("head.depth") - 1).alias("at"), "head.parent_a", "head.parent_b", "deepest", "saved")
    above = nodes.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("up"), F.col("depth").alias("at"))
    # Paths that hang on the root have no path above them.
    hung = written(paths.where("at = 0").withColumn("up", F.lit(None).cast("long")).unionByName(paths.where("at > 0").join(above, ["parent_a", "parent_b", "at"])), "hung")
    tips = hung.where("up is not null").select(F.col("up").alias("conv_id"), F.col("at").alias("deepest")).distinct().withColumn("goes_on", F.lit(1))
    totals = _path_totals(hung.join(tips, ["conv_id", "deepest"], "left").select("conv_id", "up", "saved", (1 - F.coalesce("goes_on", F.lit(0))).cast("long").alias("leaves")))
    hanging = hung.select("conv_id", "up", "at").join(totals, "conv_id")
    kids = hanging.where("up is not null").groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth")).agg(F.count("*").alias("kids"), F.sum("saved").alias("kids_saved"), F.sum("leaves").alias("kids_leaves"))

    heads = hung.select("conv_id", "up", "at", "deepest")
    zero = F.lit(0).cast("long")
    full = nodes.join(heads, "conv_id").join(kids, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "a", "b", "n_convs",
        F.when(F.col("depth") > F.col("at") + 1, F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"),
        (F.coalesce("kids", zero) + F.when(F.col("depth") < F.col("deepest"), 1).otherwise(0)).alias("n_children"),
        (F.col("own") + F.coalesce("kids_saved", zero)).alias("saved"),
        (F.coalesce("kids_leaves", zero) + F.when((F.col("depth") == F.col("deepest")) & F.col("kids").isNull(), 1).otherwise(0)).alias("leaves"),
        F.floor(F.col("depth") / sequence).alias("piece"),
    )
    # Sums from each depth of a path to its end: within pieces, and over the pieces after.
    full = written(full, "path_nodes")
    down = Window.partitionBy("conv_id", "piece").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("conv_id").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    later = full.groupBy("conv_id", "piece").agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
    later = later.select("conv_id", "piece", F.coalesce(F.sum("s").over(after), zero).alias("later_saved"), F.coalesce(F.sum("l").over(after), zero).alias("later_leaves"))
    summed = full.withColumn("saved", F.sum("saved").over(down)).withColumn("leaves", F.sum("leaves").over(down)).join(later, ["conv_id", "piece"])
    least = root.select(F.col("conv_id").alias("root_conv_id"))  # one row
    summed = summed.crossJoin(F.broadcast(least)).select(
        "conv_id", "depth", "a", "b", F.when(F.col("parent_conv_id").isNull(), F.col("root_conv_id")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.col("later_leaves")).alias("n_leaves"), (F.col("saved") + F.col("later_saved")).alias("saved_tokens"),
    )
    tops = hanging.where("up is null").agg(F.count("*").alias("n_children"), F.greatest(F.coalesce(F.sum("leaves"), zero), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved"), zero).alias("saved_tokens"))
    top = root.crossJoin(F.broadcast(tops)).select("conv_id", "depth", "a", "b", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
    out = summed.unionByName(top).join(ends, ["a", "b"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, [coalesce(role, ''), coalesce(text, '')] AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(turn ORDER BY i) AS own FROM turns GROUP BY conv_id),
built AS (
  SELECT c.conv_id, coalesce(b.own, [])[1 : {crc32_sql("c.conv_id")} % 6] || c.own[{crc32_sql("c.conv_id")} % 6 + 1 :] AS turns
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (
  SELECT conv_id, depth, turns[1 : depth] AS prefix, depth = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built)),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY depth, prefix),
kids AS (SELECT prefix[1 : depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
parts AS (
  SELECT n.depth, n.prefix, n.n_convs, coalesce(k.n, 0) AS n_children, unnest(range(0, n.depth + 1)) AS top
  FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix),
sums AS (
  SELECT prefix[1 : top] AS prefix, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth][2]) END) AS BIGINT) AS saved_tokens
  FROM parts GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.prefix = n.prefix LEFT JOIN kids k ON k.prefix = n.prefix
LEFT JOIN nodes u ON n.depth > 0 AND u.prefix = n.prefix[1 : n.depth - 1]
"""
