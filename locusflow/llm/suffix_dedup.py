"""Exact substring de-duplication with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts somewhere
else, in any document, is found. The steps:

1. Anchors. In each window of ``length`` bytes the 48-byte gram with the
   smallest hash is the window's anchor; windows in a row with one anchor form a
   run, and a run's bytes form a segment. Equal windows have equal anchors, so
   only segments with an anchor in common need to meet. A segment goes on as two
   64-bit hashes, of its anchor and of all its bytes.
2. Segments that occur twice as a whole need no more than the count of their
   hashes. What is left are anchors with several different segments: the edges
   of repeated passages. Only these segments' bytes are fetched, once for each
   different segment.
3. Shards of segments with whole anchor groups get a suffix array by
   Larsson-Sadakane refinement (unsorted groups are sorted by the rank of the
   suffix h further on, h doubling) and longest common prefixes by Kasai's
   property, both in numpy. Suffixes next to each other with ``length`` common
   bytes are repeated windows.
4. An anchor with more different segments than a shard takes is refined first.
   A window with its anchor ``a`` bytes from its start holds the ``a`` bytes left
   of the anchor and the ``length - gram - a`` right of it. The windows of a
   segment are dealt into ranges of ``a``. All windows of a range hold its core
   (the bytes that are common to them), so a range whose core no other segment
   has is done; a range that another segment has as a whole is settled by its
   count, like a whole segment. Only the ranges at the edge of a repeated
   passage are left, one or two for each segment and edge. Those with few
   partners go to the shards of step 3, others are refined once more; what
   has many partners even then, in ranges of four windows, hands on its windows'
   hashes, and a merge looks up the sorted windows of all shards by binary search.

Nothing is collected on the driver; a side is broadcast only if its counted rows
are below a bound, and is shuffled otherwise.

Defined cases: null text counts as empty; texts shorter than ``length`` keep all
bytes; rows that repeat a document make each other's bytes repeated; a null id
is an id like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import column, free_names, remove_scratch, saved, small_batches, written

LENGTH = 200
GRAM = 48
#: Bytes that are worked on at once; each needs up to a hundred in numpy.
PIECE = 1 << 18
SHARD_BYTES = 1 << 18
#: Different segments of one anchor that one shard takes; it bounds the rows of a key that one task gets.
SHARD_SEGMENTS = 256
#: Windows of a range in each round of refinement.
RANGES = (20, 4)
#: Rows of a side that is broadcast at most; each is under 100 bytes.
BROADCAST_ROWS = 1_000_000
NULL_ID = -(1 << 63)
#: Rows that the merge holds at once.
MERGE_ROWS = 200_000

_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S29, _S32 = np.uint64(29), np.uint64(32)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


# ---- rolling hashes and anchors ---------------------------------------------


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring stretches from their hashes."""
    out = a[: len(b)] * _P1
    out += b
    out ^= out >> _S29
    return out


def stretch_hashes(data: np.ndarray, sizes: set[int]) -> dict[int, np.ndarray]:
    """Hashes of the stretches of each size at every position, by doubling."""
    powers = {1: _BYTES[data]}
    size = 1
    while size * 2 <= max(sizes):
        powers[size * 2] = _both(powers[size], powers[size][size:])
        size *= 2
    out = {}
    for want in sizes:
        have, value = 0, None
        for bit in reversed(range(want.bit_length())):
            if want >> bit & 1:
                own = powers[1 << bit]
                value = own if value is None else _both(value, own[have:])
                have += 1 << bit
        out[want] = value[: max(0, len(data) - want + 1)]
    return out


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor hash, segment hash) of the runs in ``data``.

    ``ends`` holds, for each position, the end of its text; windows across it
    don't count.
    """
    n = len(data) - length + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = stretch_hashes(data, {gram, length})
    order = hashes[gram] * _P2
    order &= np.uint64(0xFFFFFFFFFF000000)
    order |= np.arange(len(order), dtype=np.uint64)
    width, size = length - gram + 1, 1
    low = order
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if width > size:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    anchor = (low[:n] & np.uint64(0xFFFFFF)).astype(np.int64)
    inside = np.arange(n) + length <= ends[:n]
    text_change = np.concatenate([[True], ends[1:n] != ends[: n - 1]])
    begin = inside & (text_change | np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    start = np.flatnonzero(begin)
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    stop = np.minimum(np.append(start[1:], n), ends[start] - length + 1)
    windows = stop - start
    whole = hashes[length]
    segment = _both(whole[start] ^ (windows.astype(np.uint64) * _P2), whole[stop - 1])
    return start, windows, hashes[gram][anchor[start]], segment


def pieces_of(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, end of the text at each position, text number and offset at each position) in bounded pieces.

    Long texts are cut so that each window lies in one piece; short ones share a piece.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def join() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x[2]) for x in held])
        ends = np.cumsum(sizes)
        number = np.repeat(np.array([x[0] for x in held]), sizes)
        offset = np.arange(int(ends[-1])) - np.repeat(ends - sizes - np.array([x[1] for x in held]), sizes)
        return np.frombuffer(b"".join(x[2] for x in held), np.uint8), np.repeat(ends, sizes), number, offset

    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at : at + PIECE + length - 1]
            if len(part) < length:
                continue
            if held and size + len(part) > PIECE:
                yield join()
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield join()


RUNS = "doc_id long, tk long, start int, windows int, anchor long, segment long"


def _find_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            keys = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
            for data, ends, number, offset in pieces_of(texts, length):
                start, windows, anchor, segment = runs_of(data, ends, length)
                own = number[start]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[own]),
                        pa.array(keys[own]),
                        pa.array(offset[start].astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(segment.view(np.int64)),
                    ],
                    names=[c.split()[0] for c in RUNS.split(", ")],
                )

    return run


# ---- suffix arrays -----------------------------------------------------------


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each suffix) by Larsson-Sadakane refinement."""
    n = len(data)
    padded = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(7):  # seven bytes of nine bits
        key |= padded[k : k + n] << np.uint64(9 * (6 - k))
    order = np.argsort(key)
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    rank = np.zeros(n + 1, np.int64)
    slot = np.arange(n)
    group = slot[first][np.cumsum(first) - 1] if n else slot
    rank[order] = group + 1  # 0 stands for the empty suffix
    step = 7
    alone = first & np.append(first[1:], True)
    open_slots = np.flatnonzero(~alone)
    while len(open_slots):
        own = order[open_slots]
        key = rank[own] * (n + 1) + rank[np.minimum(own + step, n)]
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[open_slots] = own
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[own] = open_slots[first][np.cumsum(first) - 1] + 1
        alone = first & np.append(first[1:], True)
        open_slots = open_slots[~alone]
        step *= 2
    return order, rank[:n] - 1


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix in the array with the one before it (0 for the first).

    Kasai's property in numpy: in text order the value falls by one from a
    suffix to the next if the bytes before it and before its neighbour agree;
    only the other suffixes are compared, eight bytes at a time.
    """
    n = len(data)
    if n < 2:
        return np.zeros(n, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    reducible = (at > 0) & (before > 0)
    reducible[1:] &= data[:-1] == data[np.maximum(before[1:] - 1, 0)]
    own = np.flatnonzero(~reducible & (before >= 0))
    wide = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    word = np.zeros(n + 8, np.uint64)
    for k in range(8):
        word |= wide[k : k + n + 8] << np.uint64(8 * k)
    size = np.zeros(n, np.int64)
    active = own
    while len(active):
        a, b = active + size[active], before[active] + size[active]
        differ = word[np.minimum(a, n + 7)] ^ word[np.minimum(b, n + 7)]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3)
        room = n - np.maximum(a, b)
        size[active] += np.minimum(same, room)
        active = active[(same == 8) & (room > 8)]
    # a reducible suffix has the value of the last compared one, less the distance
    last = np.maximum.accumulate(np.where(reducible, 0, at))
    size = np.maximum(size[last] - (at - last), 0)
    size[before < 0] = 0
    return size[order]


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(segment number, offset) of every window that occurs more than once in the shard."""
    sizes = np.array([len(s) for s in segments])
    data = np.frombuffer(b"".join(segments), np.uint8)
    order, rank = suffix_array(data)
    shared = common_prefixes(data, order, rank)
    ends = np.repeat(np.cumsum(sizes), sizes)
    valid = (np.arange(len(data)) + length <= ends)[order]
    kind = np.cumsum(shared < length)
    twice = np.bincount(kind[valid], minlength=int(kind[-1]) + 1) > 1
    hit = np.sort(order[valid & twice[kind]])
    number = np.searchsorted(np.cumsum(sizes), hit, side="right")
    return number, hit - (np.cumsum(sizes) - sizes)[number]


def window_hashes(segment: bytes, length: int = LENGTH) -> np.ndarray:
    return stretch_hashes(np.frombuffer(segment, np.uint8), {length})[length]


def to_spans(number: np.ndarray, offset: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, start, end) of stretches of neighbouring windows; sorted input."""
    if not len(number):
        return number, offset, offset
    cut = np.concatenate([[True], (number[1:] != number[:-1]) | (offset[1:] != offset[:-1] + 1)])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(number)) - 1
    return number[first], offset[first], offset[last] + length


# ---- the job -------------------------------------------------------------------

FOUND = "doc_id long, tk long, start long, stop long"
WINDOWS = "doc_id long, tk long, start long, window long"
PARTS = "core long, whole long, bytes binary, at int, low int, high int, doc_id long, tk long, start long, n long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    names = _names(schema)
    types = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], kind) for i, kind in enumerate(types)], names=names)


def anchor_place(segment: bytes, gram: int = GRAM) -> int:
    """Where the anchor of a segment starts: its first gram with the smallest hash."""
    order = stretch_hashes(np.frombuffer(segment, np.uint8), {gram})[gram] * _P2
    return int((order & np.uint64(0xFFFFFFFFFF000000)).argmin())


def ranges_of(data: bytes, at: int, low: int, high: int, width: int, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, bytes, bytes, int]]:
    """(first, last, core, whole, place of the anchor in the whole) of each range of ``width`` windows from ``low`` to ``high``.

    A window is named by the bytes it has before the anchor, which starts at ``at``. Segments that share a window of a
    range share its core; the whole is what this segment has of the range.
    """
    reach = length - gram
    least, most = reach - (len(data) - at - gram), at
    for first in range(low, high + 1, width):
        last = min(first + width - 1, high)
        a, b = max(first, least), min(last, most)
        if a <= b:
            yield first, last, data[at - first : at + length - last], data[at - b : at + length - a], b


def _ranges(width: int, length: int, gram: int):
    """Rows of PARTS of segments or, in a later round, of ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for data, at, low, high, doc_id, tk, start, n in _rows(batches):
                at = anchor_place(data, gram) if at is None else at
                for first, last, core, whole, place in ranges_of(data, at, low, high, width, length, gram):
                    keys = (xxhash.xxh64_intdigest(core, first), xxhash.xxh64_intdigest(whole, place))
                    yield (*(k - (1 << 64) if k >> 63 else k for k in keys), whole, place, first, last, doc_id, tk, start + at - place, n)

        yield from _batches(parts(), PARTS)

    return run


def _shards(length: int):
    """Repeated windows, as spans, of segments that come sorted by their group's key."""

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        number, offset = repeated_windows([r[1] for r in rows], length)
        who, start, stop = to_spans(number, offset, length)
        out = ((*rows[k][2:4], rows[k][4] + a, rows[k][4] + b) for k, a, b in zip(who.tolist(), start.tolist(), stop.tolist(), strict=True) if rows[k][5] == 1)
        yield from _batches(out, FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in _rows(batches):
            if held and size >= SHARD_BYTES and row[0] != held[-1][0]:
                yield from found(held)
                held, size = [], 0
            held.append(row)
            size += len(row[1])
        if held:
            yield from found(held)

    return run


def _windows(length: int):
    """The windows' hashes of ranges; without a start where they are partners only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[tuple]:
            for data, doc_id, tk, start, n in _rows(batches):
                for k, value in enumerate(window_hashes(data, length).view(np.int64).tolist()):
                    yield doc_id, tk, start + k if n == 1 else None, value

        yield from _batches(windows(), WINDOWS)

    return run


def _merge(length: int):
    """Windows found in two shards: each sorted stretch is searched for its neighbours' hashes."""

    def found(rows: np.ndarray, more: np.ndarray | None) -> pa.RecordBatch:
        hashes = rows[:, 3]
        count = np.searchsorted(hashes, hashes, side="right") - np.searchsorted(hashes, hashes)
        if more is not None:
            count = count + (hashes == more)
        out = rows[(count > 1) & (rows[:, 2] >= 0)]
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1]), pa.array(out[:, 2]), pa.array(out[:, 2] + length)], names=_names(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None
        for batch in batches:
            rows = np.stack([batch.column(i).fill_null(-1).to_numpy() for i in range(4)], 1)
            if not len(rows):
                continue
            held.append(rows)
            if sum(map(len, held)) >= MERGE_ROWS:
                whole = np.concatenate(held)
                # rows of the last hash wait for what follows; one row stands for those that are done
                cut = int(np.searchsorted(whole[:, 3], whole[-1, 3]))
                if cut:
                    yield found(whole[:cut], last)
                    held, last = [whole[cut:]], None
                else:
                    yield found(whole, last if last is not None else whole[0, 3])
                    held, last = [], whole[0, 3]
        if held:
            yield found(np.concatenate(held), last)

    return run


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tk, data): id without null, hash of the text, UTF-8 bytes."""
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    return small_batches(docs).select(F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(text).alias("tk"), text.cast("binary").alias("data"))


GROUP = ("key", "bytes", "doc_id", "tk", "start", "n")


def refined(large: DataFrame, length: int, gram: int = GRAM) -> tuple[DataFrame | None, DataFrame | None]:
    """(ranges for the shards, repeated spans found on the way) of segments of anchors that are too large for a shard.

    ``n`` over 1 marks rows that are partners only, because their own bytes are settled. Every count is taken before
    the shuffle in part, and every join has one row for a key on one side, written before, so that Spark can split the
    other: no key is gathered in one task.
    """
    if large.isEmpty():
        return None, None
    groups, spans = [], []
    open_rows = large.select("bytes", F.lit(None).cast("int").alias("at"), F.lit(0).alias("low"), F.lit(length - gram).alias("high"), "doc_id", "tk", "start", "n")
    for width in RANGES:
        parts = saved(open_rows.mapInArrow(_ranges(width, length, gram), PARTS), "ranges")
        several = saved(parts.groupBy("core").agg(F.count("*").alias("rows")).filter("rows > 1").select("core"), "cores")
        alive = saved(parts.join(several, "core"), "shared-cores")
        one = F.max_by(F.struct("bytes", "at", "low", "high", "doc_id", "tk", "start", "n"), "doc_id").alias("one")
        counted = saved(alive.groupBy("core", "whole").agg(F.count("*").alias("same"), one), "counted")
        twice = alive.filter("n = 1").join(counted.filter("same > 1").select("core", "whole"), ["core", "whole"])
        spans.append(twice.select("doc_id", "tk", "start", (F.col("start") + F.octet_length("bytes")).alias("stop")))
        kinds = saved(counted.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
        left = counted.join(kinds, "core").withColumn("n", F.when(F.col("same") > 1, 2).otherwise(F.col("one.n")).cast("long"))
        left = saved(left.select(F.col("core").alias("key"), "kinds", *(f"one.{c}" for c in ("bytes", "at", "low", "high", "doc_id", "tk", "start")), "n"), "left")
        groups.append(left.filter(F.col("kinds") <= SHARD_SEGMENTS).select(*GROUP))
        open_rows = left.filter(F.col("kinds") > SHARD_SEGMENTS).select("bytes", "at", "low", "high", "doc_id", "tk", "start", "n")
    windows = open_rows.select("bytes", "doc_id", "tk", "start", "n").mapInArrow(_windows(length), WINDOWS)
    spans.append(windows.repartition("window").sortWithinPartitions("window").mapInArrow(_merge(length), FOUND))
    return reduce(DataFrame.unionByName, groups), reduce(DataFrame.unionByName, spans)


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tk, spans): for each document with repeated bytes, its stretches of them, not merged."""
    source = _sources(docs, id_col, text_col)
    runs = saved(source.select("doc_id", "data").filter(F.octet_length("data") >= length).mapInArrow(_find_runs(length), RUNS), "runs")
    counted = saved(
        runs.groupBy("anchor", "segment")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("doc_id"), F.max_by("tk", "doc_id").alias("tk"), F.max_by("start", "doc_id").alias("start"), F.max("windows").alias("windows")),
        "segments",
    )
    twice = counted.filter("n > 1").select("anchor", "segment")
    whole = runs.join(twice, ["anchor", "segment"]).select("doc_id", "tk", F.col("start").cast("long"), (F.col("start") + F.col("windows") + (length - 1)).cast("long").alias("stop"))
    several = counted.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    edges = saved(counted.join(several, "anchor"), "edges")
    fetched = source.join(_bounded(edges, edges.count()), ["doc_id", "tk"]).select(
        F.col("anchor").alias("key"),
        F.substring("data", F.col("start") + 1, F.col("windows") + (length - 1)).alias("bytes"),
        "doc_id",
        "tk",
        F.col("start").cast("long").alias("start"),
        "n",
        "kinds",
    )
    fetched = saved(fetched, "stretches")
    groups, more = refined(fetched.filter(F.col("kinds") > SHARD_SEGMENTS), length)
    groups = fetched.filter(F.col("kinds") <= SHARD_SEGMENTS).select(*GROUP).unionByName(groups) if groups is not None else fetched.select(*GROUP)
    found = groups.repartition("key").sortWithinPartitions("key").mapInArrow(_shards(length), FOUND)
    spans = whole.unionByName(found)
    spans = spans.unionByName(more) if more is not None else spans
    return spans.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under the spans."""
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(stops[by])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return starts[first], reach[np.append(first[1:], len(starts)) - 1]


def without(data: bytes, starts: list[int], stops: list[int]) -> bytes:
    at, kept = 0, []
    for a, b in zip(starts, stops, strict=True):
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept)


def _merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [merged(np.array([s["start"] for s in spans]), np.array([s["stop"] for s in spans])) for spans in batch.column(2).to_pylist()]
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a.tolist() for a, _ in out], kind), pa.array([b.tolist() for _, b in out], kind)], names=["doc_id", "tk", "starts", "stops"])


def removal_plan(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tk, starts, stops): the maximal runs to remove from each document that has any."""
    plan = repeated_spans(docs, length, id_col, text_col).mapInArrow(_merged_spans, "doc_id long, tk long, starts array<long>, stops array<long>")
    plan = saved(plan, "removal-plan")
    size = plan.agg(F.coalesce(F.sum(F.size("starts")), F.lit(0)) + F.count("*")).first()[0]
    return _bounded(plan, size)


def _digest_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, data, starts, stops = (batch.column(i).to_pylist() for i in range(4))
        out = []
        for text, a, b in zip(data, starts, stops, strict=True):
            a, b = a or [], b or []
            out.append((len(text), sum(b) - sum(a), len(a), hashlib.sha256(without(text, a, b) if a else text).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None if i == NULL_ID else i for i in ids], pa.int64()), *(pa.array([r[k] for r in out], pa.int64()) for k in range(3)), pa.array([r[3] for r in out], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the sha256 of the bytes that stay, of every row."""
    plan = removal_plan(docs, length)
    rows = _sources(docs, "doc_id", "text").join(plan, ["doc_id", "tk"], "left").select("doc_id", "data", "starts", "stops")
    return rows.mapInArrow(_digest_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def text_without(text: str, starts: list[int], stops: list[int]) -> str:
    """A text without byte runs; a run is shortened to whole characters."""
    data = text.encode()
    tail = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    a, b = [], []
    for x, y in zip(starts, stops, strict=True):
        while tail(x):
            x += 1
        while tail(y):
            y -= 1
        if y > x:
            a.append(x)
            b.append(y)
    return without(data, a, b).decode()


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text (whole characters only); all rows and columns stay.

    Null and empty texts and texts under ``length`` bytes stay as they are; rows
    that repeat a text lose all of it from ``length`` bytes on; texts of any
    length are judged whole; a null id is an id like others; an empty table
    stays empty; names of other columns don't matter.
    """
    before = written()
    plan = removal_plan(docs, length, id_col, text_col)
    remove_scratch(docs.sparkSession, before, plan)
    i, k, a, b = free_names(docs, "id", "key", "starts", "stops")
    keys = {i: F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)), k: F.xxhash64(F.coalesce(column(text_col).cast("string"), F.lit("")))}
    plan = plan.select(F.col("doc_id").alias(i), F.col("tk").alias(k), F.col("starts").alias(a), F.col("stops").alias(b))
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, stops = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            texts = [t if t is None or not a else text_without(t, a, b) for t, a, b in zip(batch.column(at).to_pylist(), starts, stops, strict=True)]
            columns = list(batch.columns[:-2])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = docs.withColumns(keys).join(plan, [i, k], "left").select(*map(column, names), a, b)
    return joined.mapInArrow(run, docs.schema)
