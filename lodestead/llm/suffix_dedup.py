"""Removal of byte strings that an earlier document has, by distributed suffix sorting.

A byte goes if a 50-byte string over it also starts in a document with a smaller doc_id.

Sorting every suffix of the corpus would move several times its size, so equal strings are
first brought together by content (see `anchors`): all windows of 50 bytes are dealt out by
their anchor, and a document's run of windows with one anchor is its context.

1. Anchors that ``CROWD`` different contexts or more share (a fixed phrase between values
   that differ) are found first, by counting hashes of contexts.  Their contexts are halved
   until the bytes around the anchor tell them apart, the same way in every document, so
   that the answer does not depend on which anchors are marked.
2. Hashes of anchors and contexts are dealt into buckets.  A context that a smaller
   document has in the same form is covered as a whole.  Only where several contexts share
   an anchor - at the edges of repeated passages - do the bytes matter.
3. Those contexts are dealt out by anchor and laid end to end in pieces of
   about ``RANKED_BYTES``.  The suffixes of a piece are ranked up to 50 bytes, by names of ever longer
   prefixes or, in a piece too long for names of 16 bits, by the difference-cover algorithm; windows with
   equal 50-byte prefixes are then neighbours, and the least document of every run of equals keeps its window.
4. An anchor that is left with contexts occurring more than ``HEAVY`` times (in the main a
   few that a document repeats) would make too large a piece: the windows of its contexts
   are grouped by their 50 bytes with partial sums instead, which splits them further; a
   document sends each of them once, with all its places.
   Both ways are exact.
5. Covered ranges go back to their documents, which are cut.

Texts move in compressed groups of about ``GROUP_BYTES``; every step's work per byte is
constant.  Equal contexts are reduced to the least document's where they are found, and
different ones of one anchor are told apart, so that no group of either meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import LEVELS, SLOTS, WINDOW, anchors, context_hashes, contexts, core_keys, halves, pieces, slots
from .common import CHUNK_BYTES, chunks, written
from .difference_cover import MAX_SYMBOLS, equal_prefixes
from .hashing import mix

GROUP_BYTES = 4_000_000
PIECE_BYTES = 1_000_000
#: Context bytes ranked at once, unless one anchor has more: what fits into a core's cache.
RANKED_BYTES = 60_000
#: Occurrences of one anchor's contexts that are compared in one piece; each has at most
#: ``2 * WINDOW - GRAM`` bytes, so that a piece stays far below ``MAX_SYMBOLS``.
HEAVY = 10_000
#: Different contexts that make a core crowded, and how many of them are counted: one in
#: ``CROWD // COUNTED``, by their hash.
CROWD = 4_096
COUNTED = 64
#: Cores of a level that are marked at most; where there are more, only the most crowded are.
MOST_MARKED = SLOTS // 8
#: Anchors that a task holds before it sends them, and text bytes that it compresses together.
_ENTRIES = 200_000
_PACKED_BYTES = 4_000_000
_TAG = np.uint64((1 << 48) - 1)
COVERED, SHARED, SPLIT = 1, 2, 3


def _six(values: np.ndarray) -> bytes:
    """The low 48 bits of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _seen(piece: int, share: int, marks: list[bytes]):
    """Distinct (level, core, context) of one context in ``share``: of whole contexts, or of
    all parts of those whose anchor is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = _unpacked(marks)
        for part in chunks(batches, "text", piece):
            for raw, starts, _, _ in pieces(part, piece):
                _, anchor, first, last, ranged = contexts(raw, starts)
                if not len(anchor):
                    continue
                own = context_hashes(ranged, anchor, first, last) % np.uint64(share) == 0
                anchor, first, last = anchor[own], first[own], last[own]
                low, found = np.zeros(len(anchor), np.int64), []
                for level in range(LEVELS if crowded else 1):
                    if level:
                        at, first, last, low = halves(anchor, first, last, low, level)
                        anchor = anchor[at]
                    key = core_keys(ranged, anchor, low, level)
                    if level or not crowded:
                        found.append(np.column_stack((np.full(len(key), level, np.uint64), key, context_hashes(ranged, anchor, first, last))))
                    else:
                        own = crowded[0][slots(key)]
                        anchor, first, last, low = anchor[own], first[own], last[own], low[own]
                rows = np.unique(np.concatenate(found), axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, k].copy()) for k in range(3)], ["level", "core", "context"])

    return run


def _unpacked(marks: list[bytes]) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(m, np.uint8)).astype(bool) for m in marks]


def _marks(texts: DataFrame, piece: int, crowd: int) -> list[bytes]:
    """For each level the slots of crowded cores, a bit for each of ``SLOTS``; none at all if no anchor is crowded.

    Balance alone depends on them.  Which are the most crowded is told by powers of two.
    """
    marks: list[bytes] = []
    share = max(1, crowd // COUNTED)
    for first in (True, False):
        seen = texts.mapInArrow(_seen(piece, share, marks), "level long, core long, context long").distinct()
        counts = written(seen.groupBy("level", "core").agg(F.count("*").alias("n")).where(F.col("n") >= max(2, crowd // share)), "crowded")
        power = F.floor(F.log2("n")).cast("int")
        sizes = counts.groupBy("level", power.alias("power")).agg(F.count("*").alias("cores")).orderBy(F.desc("power")).collect()
        least, cores = {}, dict.fromkeys(range(LEVELS), 0)
        for r in sizes:
            cores[r["level"]] += r["cores"]
            if cores[r["level"]] <= MOST_MARKED:
                least[r["level"]] = r["power"]
        if first and not sizes:
            return []
        wanted = F.lit(False)
        for level, lowest in least.items():
            wanted = wanted | ((F.col("level") == level) & (power >= lowest))
        found = counts.where(wanted).select("level", F.shiftrightunsigned("core", 12).bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).distinct().collect()
        for level in [0] if first else range(1, LEVELS):
            bits = np.zeros(SLOTS, bool)
            bits[[r["slot"] for r in found if r["level"] == level]] = True
            marks.append(np.packbits(bits).tobytes())
    return marks


_ENTRY = "bucket int, known boolean, anchors binary, contexts binary, times binary, who binary, uids binary, ids binary"
_ENTRY_NAMES = ["bucket", "known", "anchors", "contexts", "times", "who", "uids", "ids"]


def _entries(buckets: int, piece: int, marks: list[bytes]):
    """Packed (anchor, context, document) of every anchor, by bucket of the anchor."""

    def packed(anchor, context, uid, doc) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((uid, doc, context, anchor))
        anchor, context, uid, doc = anchor[order], context[order], uid[order], doc[order]
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])))
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        # Within what is at hand the least document stands for all; the others are covered.
        repeat = ~new & (np.concatenate(([False], uid[1:] == uid[:-1])))
        own = np.flatnonzero(~repeat)
        times = np.zeros(len(anchor), "<u4")
        times[own] = np.diff(own, append=len(anchor))
        rows = []

        def add(bucket: int, known: bool, at: np.ndarray) -> None:
            # A row names its documents by two bytes.
            for part in np.array_split(at, -(-len(at) // 60_000)):
                uids, first, who = np.unique(uid[part], return_index=True, return_inverse=True)
                rows.append((bucket, known, (anchor[part] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), _six(context[part]), times[part].tobytes(), who.astype("<u2").tobytes(), uids.tobytes(), doc[part][first].tobytes()))

        covered = np.flatnonzero((doc > least) & ~repeat)
        if len(covered):
            add(int(uid[0] % buckets), True, covered)
        sent = np.flatnonzero((doc == least) & ~repeat)
        bucket = ((anchor[sent] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        sent = sent[np.argsort(bucket, kind="stable")]
        sizes = np.bincount(bucket, minlength=buckets)
        for b, at in enumerate(np.split(sent, np.cumsum(sizes)[:-1])):
            if len(at):
                add(b, False, at)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), *[pa.binary()] * 6), strict=True)], _ENTRY_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, crowded = [], 0, _unpacked(marks)
        for part in chunks(batches, "text", piece):
            uids, ids = part.column("uid").to_numpy().view(np.uint64), part.column("doc_id").to_numpy(zero_copy_only=False)
            for raw, starts, row, _ in pieces(part, piece):
                text, _, _, _, anchor, context = anchors(raw, starts, crowded)
                held.append((anchor, context & _TAG, uids[row[text]], ids[row[text]]))
                size += len(anchor)
                if size > _ENTRIES:
                    yield from packed(*map(np.concatenate, zip(*held, strict=True)))
                    held, size = [], 0
        if size:
            yield from packed(*map(np.concatenate, zip(*held, strict=True)))

    return run


_STATE = "group int, uids binary, contexts binary, states binary"


def _resolved(groups: int, heavy: int):
    """What is known of each entry's context, dealt out by the document's group."""

    def run(table: pa.Table) -> pa.Table:
        columns = {n: table.column(n).to_pylist() for n in _ENTRY_NAMES[1:]}
        parts: dict[bool, list] = {True: [], False: []}
        for known, anchor, context, times, who, uids, ids in zip(*columns.values(), strict=True):
            who = np.frombuffer(who, "<u2")
            parts[known].append((np.frombuffer(anchor, "<u4"), _from_six(context), np.frombuffer(uids, np.uint64)[who], np.frombuffer(ids, np.int64)[who], np.frombuffer(times, "<u4")))
        out_uid, out_context, out_state = [], [], []
        for _, context, uid, _, _ in parts[True]:
            out_uid.append(uid)
            out_context.append(context)
            out_state.append(np.full(len(uid), COVERED, np.uint8))
        if parts[False]:
            anchor, context, uid, doc, times = map(np.concatenate, zip(*parts[False], strict=True))
            order = np.lexsort((doc, context, anchor))
            anchor, context, uid, doc, times = anchor[order], context[order], uid[order], doc[order], times[order]
            fresh = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            new = fresh | np.concatenate(([True], context[1:] != context[:-1]))
            least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
            own = np.cumsum(fresh) - 1
            forms = np.bincount(own, weights=new)[own]
            occurrences = np.bincount(own, weights=np.where(doc > least, 0, times))[own]
            state = np.where(doc > least, COVERED, np.where(forms < 2, 0, np.where(occurrences <= heavy, SHARED, SPLIT))).astype(np.uint8)
            told = state > 0
            out_uid.append(uid[told])
            out_context.append(context[told])
            out_state.append(state[told])
        uid, context, state = np.concatenate(out_uid), np.concatenate(out_context), np.concatenate(out_state)
        group = (uid % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        rows = []
        for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if len(at):
                rows.append((int(group[at[0]]), uid[at].tobytes(), _six(context[at]), state[at].tobytes()))
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), *[pa.binary()] * 3))], names=["group", "uids", "contexts", "states"])

    return run


def _grouped(groups: int):
    """Rows of several batches, compressed together by group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            group = (table.column("uid").to_numpy().view(np.uint64) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            rows = []
            for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                    writer.write_table(table.take(at).combine_chunks())
                rows.append((int(group[at[0]]), sink.getvalue().to_pybytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["group", "rows"])

        for part in chunks(batches, "text"):
            held.append(part)
            size += part.nbytes
            if size > _PACKED_BYTES:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    return run


def _opened(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for data in table.column("rows").to_pylist():
        with pa.ipc.open_stream(data) as reader:
            for batch in reader:
                yield batch


_FOUND = "kind int, anchor long, uid long, doc_id long, start long, places binary, data binary"


def _contexts(piece: int, marks: list[bytes]):
    """Of each document of a group: covered ranges, contexts to compare, windows to group."""

    def run(texts: pa.Table, states: pa.Table) -> pa.Table:
        return _told_apart(texts, states, piece, _unpacked(marks))

    return run


def _told_apart(texts: pa.Table, states: pa.Table, piece: int, crowded: list[np.ndarray]) -> pa.Table:
    keys, known = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for uids, contexts, state in zip(*(states.column(n).to_pylist() for n in ("uids", "contexts", "states")), strict=True):
        keys.append(mix(np.frombuffer(uids, np.uint64) * np.uint64(0x9FB21C651E98DF25) + _from_six(contexts)))
        known.append(np.frombuffer(state, np.uint8))
    keys, known = np.concatenate(keys), np.concatenate(known)
    order = np.argsort(keys)
    keys, known = keys[order], known[order]
    tables, done = [_FOUND_SCHEMA.empty_table()], np.zeros(0, np.int64)
    for part in chunks(_opened(texts), "text", piece) if len(keys) else ():
        # Rows with one uid have one text and share their ranges.
        uids, at = np.unique(part.column("uid").to_numpy(), return_index=True)
        part = part.take(pa.array(np.sort(at[~np.isin(uids, done)])))
        done = np.union1d(done, uids)
        uids, ids = part.column("uid").to_numpy(), part.column("doc_id").to_numpy(zero_copy_only=False)
        for raw, starts, row, offset in pieces(part, piece) if part.num_rows else ():
            text, anchor, first, last, hashed, context = anchors(raw, starts, crowded)
            if not len(text):
                continue
            uid, doc, shift = uids[row[text]], ids[row[text]], (offset - starts[:-1])[text]
            key = mix(uid.view(np.uint64) * np.uint64(0x9FB21C651E98DF25) + (context & _TAG))
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            state = np.where(keys[at] == key, known[at], 0)
            # Ranges that are covered as a whole, a row for each text.
            whole = np.flatnonzero(state == COVERED)
            groups = np.split(whole, np.flatnonzero(np.diff(text[whole])) + 1) if len(whole) else []
            spans = [_joined(np.column_stack((first[own] + shift[own], last[own] + WINDOW + shift[own]))).tobytes() for own in groups]
            head = np.array([own[0] for own in groups], np.int64)
            tables.append(_found(0, np.zeros(len(head), np.int64), uid[head], doc[head], np.zeros(len(head), np.int64), pa.array([b""] * len(head), pa.binary()), pa.array(spans, pa.binary())))
            # Contexts whose windows are to be compared.
            own = np.flatnonzero(state == SHARED)
            tables.append(_found(1, hashed[own].view(np.int64), uid[own], doc[own], first[own] + shift[own], pa.array([b""] * len(own), pa.binary()), _slices(raw, first[own], last[own] + WINDOW)))
            # Windows to group, each once with all its places in this piece.
            own = np.flatnonzero(state == SPLIT)
            own = own[np.lexsort((first[own], key[own]))]
            for same in np.split(own, np.flatnonzero(np.diff(key[own])) + 1) if len(own) else ():
                i, n = same[0], last[same[0]] - first[same[0]] + 1
                places = [(first[same] + k + shift[i]).astype("<i8").tobytes() for k in range(n)]
                tables.append(_found(2, np.zeros(n, np.int64), np.repeat(uid[i], n), np.repeat(doc[i], n), np.zeros(n, np.int64), pa.array(places, pa.binary()), _slices(raw, first[i] + np.arange(n), first[i] + np.arange(n) + WINDOW)))
    return pa.concat_tables(tables).combine_chunks()


_FOUND_SCHEMA = pa.schema([("kind", pa.int32()), *[(n, pa.int64()) for n in ("anchor", "uid", "doc_id", "start")], ("places", pa.binary()), ("data", pa.binary())])


def _found(kind: int, *columns) -> pa.Table:
    n = len(columns[0])
    return pa.table([pa.array(np.full(n, kind, np.int32)), *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns)], schema=_FOUND_SCHEMA)


def _slices(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as one binary array."""
    sizes = end - start
    begin = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(begin[-1]) + np.repeat(start - begin[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(begin.astype("<i4").tobytes()), pa.py_buffer(raw[at].tobytes())])


def _joined(ranges: np.ndarray) -> np.ndarray:
    """Overlapping or touching (start, end) ranges as one; sorted by start before and after."""
    if not len(ranges):
        return ranges.reshape(-1, 2).astype("<i8")
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate(([True], ranges[1:, 0] > reach[:-1]))
    begin = np.flatnonzero(new)
    return np.column_stack((ranges[begin, 0], reach[np.concatenate((begin[1:], [len(ranges)])) - 1])).astype("<i8")


def _compared(table: pa.Table) -> pa.Table:
    """Ranges of the windows of a piece that a smaller document's context has as well."""
    table = table.sort_by("anchor")
    data, anchor = table.column("data").to_pylist(), table.column("anchor").to_numpy()
    uid, doc, start = (table.column(n).to_numpy() for n in ("uid", "doc_id", "start"))
    sizes = np.array([len(d) + 1 for d in data])
    # Pieces end between anchors, where they hold enough.
    edges, size = [0], 0
    for i in range(len(data)):
        if i and anchor[i] != anchor[i - 1] and size > RANKED_BYTES:
            edges.append(i)
            size = 0
        size += sizes[i]
    found: list[np.ndarray] = [np.zeros((0, 3), np.int64)]
    for low, high in zip(edges, [*edges[1:], len(data)], strict=True):
        text = np.frombuffer(b"\0".join(data[low:high]) + b"\0", np.uint8)
        if len(text) > MAX_SYMBOLS:
            raise ValueError(f"a piece of {len(text)} bytes is too long to rank; lower `heavy`")
        begin = np.concatenate(([0], np.cumsum(sizes[low:high])))
        count = sizes[low:high] - WINDOW
        owner = np.repeat(np.arange(high - low), count)
        window = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[owner]
        owners = np.zeros(len(text), np.int64)
        owners[window] = owner
        order, same = equal_prefixes(text, window, WINDOW)
        holder = owners[order] + low
        least = np.minimum.reduceat(doc[holder], np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1]))))
        # Covered windows in page order, as runs of neighbours in one context.
        late = np.sort(order[doc[holder] > least[same]])
        if len(late):
            new = np.concatenate(([True], (np.diff(late) > 1) | (np.diff(owners[late]) > 0)))
            first = np.flatnonzero(new)
            last = np.concatenate((first[1:], [len(late)])) - 1
            context = owners[late[first]]
            shift = start[context + low] - begin[context]
            found.append(np.column_stack((uid[context + low], late[first] + shift, late[last] + shift + WINDOW)))
    ranges = np.concatenate(found)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    rows = [(int(own[0, 0]), _joined(own[:, 1:]).tobytes()) for own in np.split(ranges, np.flatnonzero(np.diff(ranges[:, 0])) + 1) if len(own)]
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["uid", "data"])


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        starts = [np.frombuffer(places, "<i8") for places in part.column("places").to_pylist()]
        data = [_joined(np.column_stack((s, s + WINDOW))).tobytes() for s in starts]
        yield pa.RecordBatch.from_arrays([part.column("uid"), pa.array(data, pa.binary())], ["uid", "data"])


def _cut(names: list[str], as_text: bool):
    def run(texts: pa.Table, covered: pa.Table) -> pa.Table:
        ranges: dict[int, list] = {}
        for uid, data in zip(covered.column("uid").to_pylist(), covered.column("data").to_pylist(), strict=True):
            ranges.setdefault(uid, []).append(np.frombuffer(data, "<i8").reshape(-1, 2))
        tables = []
        for part in _opened(texts):
            out = []
            for uid, text in zip(part.column("uid").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                text, own = text or b"", _joined(np.concatenate(ranges[uid])) if uid in ranges else ()
                kept, done = [], 0
                for a, b in own:
                    kept.append(text[done:a])
                    done = b
                kept.append(text[done:])
                rest = b"".join(kept)
                # What a cut leaves of a character is no text.
                shown = "".join(k.decode("utf-8", "ignore") for k in kept) if as_text else rest
                out.append((len(text), len(text) - len(rest), len(own), hashlib.sha256(rest).hexdigest(), shown))
            columns = [*(part.column(n) for n in names), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if as_text else pa.binary())))]
            tables.append(pa.table(columns, names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]))
        return pa.concat_tables(tables) if tables else None

    return run


def remove_repeats(documents: DataFrame, *, carry: tuple[str, ...] = (), group_bytes: int = GROUP_BYTES, heavy: int = HEAVY, crowd: int = CROWD, piece_bytes: int = CHUNK_BYTES, as_text: bool = False) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``.

    A row per row, with the columns named in ``carry``; ``kept`` has the bytes that stay,
    which need not be whole characters at its cuts; with ``as_text`` it is a text, without
    the characters that a cut parts.  Texts are UTF-8 bytes, a null text is
    empty, and strings are judged on the input.  Rows that share a doc_id don't cover each
    other; a row with a null doc_id covers nothing and is left whole.  Texts of fewer than
    50 bytes neither lose anything nor cover anything.  Texts longer than ``piece_bytes``
    are worked on in overlapping pieces.  Other columns are not looked at; an empty table
    gives no rows.
    """
    uid = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = documents.select(uid.alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c) for c in carry if c not in ("doc_id", "text")])
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_bytes))
    real = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW)).select("uid", "doc_id", "text")
    marks = _marks(real, piece_bytes, crowd)
    states = real.mapInArrow(_entries(groups, piece_bytes, marks), _ENTRY).groupBy("bucket").applyInArrow(_resolved(groups, heavy), _STATE)
    texts = real.mapInArrow(_grouped(groups), "group int, rows binary")
    found = written(texts.groupBy("group").cogroup(states.groupBy("group")).applyInArrow(_contexts(piece_bytes, marks), _FOUND), "contexts")
    sizes = {r["kind"]: r["size"] for r in found.groupBy("kind").agg(F.sum(F.octet_length("data")).alias("size")).collect()}
    pieces = max(1, -(-sizes.get(1, 0) // PIECE_BYTES))
    shared = found.where("kind = 1").select(F.pmod(F.xxhash64("anchor"), F.lit(pieces)).alias("piece"), "anchor", "uid", "doc_id", "start", "data")
    covered = found.where("kind = 0").select("uid", "data").unionByName(shared.groupBy("piece").applyInArrow(_compared, "uid long, data binary"))
    if 2 in sizes:
        windows = found.where("kind = 2").select("data", "uid", "doc_id", "places")
        owners = windows.groupBy("data").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("data", "least")
        late = windows.join(written(owners, "windows"), "data").where(F.col("doc_id") > F.col("least")).select("uid", "places")
        covered = covered.unionByName(late.mapInArrow(_ranged, "uid long, data binary"))
    # As numpy takes the remainder: of the unsigned number.
    group = F.pmod(F.pmod(F.col("uid"), F.lit(groups)) + F.when(F.col("uid") < 0, F.lit(2**64 % groups)).otherwise(F.lit(0)), F.lit(groups)).cast("int")
    ranges = covered.withColumn("group", group)
    names = ["doc_id", *(c for c in carry if c not in ("doc_id", "text"))]
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    whole = docs.mapInArrow(_grouped(groups), "group int, rows binary")
    return whole.groupBy("group").cogroup(ranges.groupBy("group")).applyInArrow(_cut(names, as_text), f"{kinds}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept {'string' if as_text else 'binary'}")


#: DuckDB's form of `remove_repeats` over `documents`, without the bytes; texts as hexadecimal digits.
ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT rid, doc_id, p, substr(h, 2 * p - 1, 100) AS s FROM (SELECT rid, doc_id, h, unnest(range(1, len(h) // 2 - 48)) AS p FROM d WHERE len(h) >= 100 AND doc_id IS NOT NULL)),
least AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
late AS (SELECT w.rid, w.p, CASE WHEN w.p - lag(w.p) OVER (PARTITION BY w.rid ORDER BY w.p) <= 50 THEN 0 ELSE 1 END AS new FROM windows w JOIN least l ON l.s = w.s WHERE w.doc_id > l.least),
runs AS (SELECT rid, min(p) AS a, max(p) + 49 AS b FROM (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM late) GROUP BY rid, run),
pieces AS (SELECT r.rid, r.a, r.b, substr(d.h, 2 * coalesce(lag(r.b) OVER (PARTITION BY r.rid ORDER BY r.a), 0) + 1, 2 * (r.a - 1 - coalesce(lag(r.b) OVER (PARTITION BY r.rid ORDER BY r.a), 0))) AS piece FROM runs r JOIN d ON d.rid = r.rid),
cut AS (SELECT rid, sum(b - a + 1) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(piece, '' ORDER BY a) AS kept FROM pieces GROUP BY rid)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed, coalesce(c.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(c.kept, '') || substr(d.h, 2 * coalesce(c.last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut c ON c.rid = d.rid
"""
