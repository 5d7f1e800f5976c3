"""Near-duplicates by SimHash fingerprints and BK-trees.

A fingerprint bit is set if it is set in over half the XXH64 hashes of a text's
word shingles. Fingerprints link if at most ``radius`` bits differ, and linked
documents form components.

Distinct fingerprints are compared once. Two that differ in at most r of 64 bits
agree in at least b - r of b bit blocks, so each fingerprint is sent to one
group for every choice of that many blocks; the number of blocks follows the
number of fingerprints, which keeps the groups small and loses no link. A group
above a fixed size is split into shards, and each pair of shards is a task of
its own: a BK-tree over the one, searched by the other. The trees (children
keyed by the integer distance to the parent, only edges within the radius are
followed) are built and searched level by level in numpy, many trees at once.
Since no tree is sent anywhere but to its own searches, nothing that grows with
the data is broadcast. Tasks return spanning links instead of all pairs.

Defined cases: null or empty text, or text of white space, has fingerprint zero
and links like any other; texts shorter than a shingle are one shingle; a null
id takes part but never names a component; repeated rows give repeated results;
an empty table gives no rows; other columns are ignored.

``keep_first`` (the pipeline's stage) uses the fingerprints as a first search
for candidates only: it links texts by the Jaccard similarity of their shingle
sets, which is computed exactly for every candidate, and finds the pairs that
the fingerprints miss by a prefix join over the sets. No similar pair is lost;
tests compare with all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import column, free_names, give_back, remove_scratch, saved, small_batches, text_slices, texts_of, written
from locusflow.llm.components import connected_components

SHARD = 4096
#: Rows of a task that are worked on at once.
BATCH_ROWS = 40_000
#: Pairs of (search, tree node) that are looked at in one step at most, roughly.
FRONTIER = 500_000
SEED = 42
NULL_ID = -(1 << 63)
#: Rows of (id, text hash) that are broadcast at most.
BROADCAST_ROWS = 1_000_000
#: Jaccard similarity of word shingles from which ``keep_first`` links texts.
SIMILARITY = 0.8
#: Common shingles: in at least COMMON classes among one of SAMPLE; so many at most.
SAMPLE = 16
COMMON = 8
COMMON_ROWS = 200_000
SKETCH_BITS = 2048
#: Rounds of step 2 of ``similar_classes``.
STARS = 2
#: Classes that meet in one task of step 2, roughly.
BLOCK = 1024
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


# ---- fingerprints ----------------------------------------------------------


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The hash (uint64) of every word shingle of a text, in turn."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")


def bits_of(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint of shingle hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint of a text."""
    return bits_of(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp`` (the fingerprint's bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


# ---- BK-trees --------------------------------------------------------------


def build_trees(fps: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over ``fps`` (uint64), one for each value of ``tree`` (ascending).

    Returns (root of each tree, edge keys in ascending order, child of each
    edge); an edge key is parent * 65 + distance.
    """
    n = len(fps)
    first = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])) if n else np.zeros(0, np.int64)
    parent = np.repeat(first, np.diff(np.append(first, n)))
    waiting = np.setdiff1d(np.arange(n), first, assume_unique=True)
    keys, children = [], []
    while len(waiting):
        up = parent[waiting]
        key = up * 65 + np.bitwise_count(fps[waiting] ^ fps[up]).astype(np.int64)
        edge, at, back = np.unique(key, return_index=True, return_inverse=True)
        child = waiting[at]
        keys.append(edge)
        children.append(child)
        parent[waiting] = child[back]
        waiting = waiting[child[back] != waiting]
    if not keys:
        return first, np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return first, key[order], child[order]


def search(fps: np.ndarray, edges: np.ndarray, children: np.ndarray, probes: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(probe, node) pairs within the radius; each probe starts at its root and follows edges within the radius."""
    who, node = np.arange(len(probes)), roots
    found_who, found_node = [], []
    while len(who):
        distance = np.bitwise_count(probes[who] ^ fps[node]).astype(np.int64)
        near = distance <= radius
        found_who.append(who[near])
        found_node.append(node[near])
        low = np.searchsorted(edges, node * 65 + np.maximum(distance - radius, 0))
        high = np.searchsorted(edges, node * 65 + np.minimum(distance + radius, 64), side="right")
        n = high - low
        who = np.repeat(who, n)
        node = children[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if len(children) else np.zeros(0, np.int64)
    return np.concatenate(found_who), np.concatenate(found_node)


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest index of a component) after the pairs (a, b) are joined."""
    while len(a):
        x, y = label[a], label[b]
        open_pairs = x != y
        a, b, x, y = a[open_pairs], b[open_pairs], x[open_pairs], y[open_pairs]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def spanning_links(fps: np.ndarray, group: np.ndarray, is_node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs within the radius connect, in every group (ascending) at once."""
    nodes = np.flatnonzero(is_node)
    first, edges, children = build_trees(fps[nodes], group[nodes])
    label = np.arange(len(fps))
    if not len(nodes):
        return fps[:0], fps[:0]
    tree_group = group[nodes][first]
    at = np.searchsorted(tree_group, group)
    known = (at < len(tree_group)) & (tree_group[np.minimum(at, len(tree_group) - 1)] == group)
    size = np.diff(np.append(first, len(nodes)))
    probes = np.flatnonzero(known)
    probes = probes[size[at[probes]] > is_node[probes]]
    work = np.cumsum(size[at[probes]])
    begin = 0
    while begin < len(probes):
        end = max(begin + 1, int(np.searchsorted(work, (work[begin - 1] if begin else 0) + FRONTIER)))
        own = probes[begin:end]
        who, node = search(fps[nodes], edges, children, fps[own], first[at[own]], radius)
        label = join_labels(label, own[who], nodes[node])
        begin = end
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


# ---- links over the whole table --------------------------------------------


def blocks_for(count: int, radius: int) -> int:
    """Bit blocks so that a group has few fingerprints on average: more agreeing blocks for more fingerprints."""
    for agree in range(1, 5):
        blocks = radius + agree
        if count >> (64 * agree // blocks) <= 64:
            break
    return blocks


def group_keys(blocks: int, radius: int) -> list[tuple[int, int]]:
    """(number, bit mask) of every choice of ``blocks - radius`` blocks."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    out = [sum(c) for c in combinations(masks, blocks - radius)]
    return [(n, m - (1 << 64) if m >> 63 else m) for n, m in enumerate(out)]


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``distinct(fp)`` within the radius."""
    keys = group_keys(blocks_for(distinct.count(), radius), radius)
    choice = F.explode(F.array(*(F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for n, m in keys)))
    keyed = distinct.select("fp", choice.alias("k")).select("fp", "k.choice", "k.bits")
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("size")).filter("size > 1")
    member = keyed.join(sizes, ["choice", "bits"]).withColumn("shards", F.ceil(F.col("size") / SHARD).cast("int"))
    member = member.withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
    sent = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    tasks = sent.select(
        F.xxhash64("choice", "bits", F.least("shard", "other"), F.greatest("shard", "other")).alias("task"),
        "fp",
        (F.col("shard") <= F.col("other")).alias("is_node"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            task, fps, is_node = (np.concatenate(x) for x in zip(*parts, strict=True))
            a, b = spanning_links(fps.view(np.uint64), task, is_node, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            task, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            is_node = batch.column(2).to_numpy(zero_copy_only=False)
            if sum(len(x[0]) for x in held) >= BATCH_ROWS and len(task):
                # up to the end of the task that the held rows end with
                end = int(np.searchsorted(task, held[-1][0][-1], side="right"))
                held.append((task[:end], fps[:end], is_node[:end]))
                if end < len(task):
                    yield links(held)
                    held = []
                task, fps, is_node = task[end:], fps[end:], is_node[end:]
            if len(task):
                held.append((task, fps, is_node))
        if held:
            yield links(held)
        held = []
        give_back()

    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long").distinct()


def components(prints: DataFrame, radius: int) -> DataFrame:
    """Every row of ``prints(doc_id, fp, ...)`` with its component_id, the smallest id reachable."""
    first = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    found = connected_components(fingerprint_links(first.select("fp"), radius))
    member = first.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every row."""
    found = components(saved(fingerprints(docs, shingle), "prints"), radius)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---- one document of each group ----------------------------------------------


def shingle_sets(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """The different shingle hashes of each text, as ascending signed integers."""
    return [np.unique(shingle_hashes(t, shingle).view(np.int64)) for t in texts]


def lists_of(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def sets_of(rows: DataFrame, shingle: int) -> DataFrame:
    """(sk, set) of ``rows(sk, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), lists_of(shingle_sets(texts, shingle))], names=["sk", "set"])

    return rows.select("sk", "text").mapInArrow(run, "sk long, set array<long>")


def common_shingles(source: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts) of the most common shingles among one of ``SAMPLE`` different texts of ``source(tk, text)``.

    They only order the shingles of a set; that they are counted in a sample and
    bounded in number changes no result.
    """
    own = source.filter(F.pmod("tk", F.lit(SAMPLE)) == 0).select(F.col("tk").alias("sk"), "text").dropDuplicates(["sk"])
    counted = sets_of(own, shingle).select(F.explode("set").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rows = counted.filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "token").limit(COMMON_ROWS).collect()
    token, n = np.array([r["token"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(token)
    return token[order], n[order]


def head_size(n: np.ndarray, similarity: float) -> np.ndarray:
    """So many first shingles of a set of n: two sets that are similar enough share one of them, in any one order of all shingles."""
    return n - np.ceil(n * similarity - 1e-9).astype(np.int64) + 1


def heads(sets: list[np.ndarray], similarity: float, tokens: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The first shingles of every ascending set, common ones last; equal counts by value."""
    n = np.array([len(x) for x in sets], np.int64)
    sizes = np.where(n > 0, head_size(n, similarity), 0)
    if not len(tokens) or not n.sum():
        return [x[:k] for x, k in zip(sets, sizes, strict=True)]
    values = np.concatenate(sets)
    at = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
    often = np.where(tokens[at] == values, counts[at], 0)
    ends = np.cumsum(n)
    out = []
    for x, k, end in zip(sets, sizes, ends, strict=True):
        own = often[end - len(x) : end]
        out.append(x[np.argsort(own, kind="stable")[:k]] if own.any() else x[:k])
    return out


def parity(values: np.ndarray) -> np.ndarray:
    """The parity sketch of different hashes: each turns one of ``SKETCH_BITS`` bits."""
    odd = np.bincount(values & (SKETCH_BITS - 1), minlength=SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


PRINTS = "doc_id long, tk long, fp long, sk long, n long, head array<long>, sketch array<long>"


def sketches(source: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """PRINTS of ``source(doc_id, tk, text)``: fingerprint, and hash, size, head and parity sketch of the shingle set, of every row."""
    common = source.sparkSession.sparkContext.broadcast(common_shingles(source, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            hashes = [shingle_hashes(t, shingle) for t in texts]
            fps = np.array([bits_of(h) for h in hashes], np.uint64).view(np.int64)
            sets = [np.unique(h.view(np.int64)) for h in hashes]
            sk = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64).view(np.int64)
            n = pa.array([len(x) for x in sets], pa.int64())
            first = lists_of(heads(sets, similarity, *common.value))
            sketch = lists_of([parity(x) for x in sets])
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(fps), pa.array(sk), n, first, sketch], names=["doc_id", "tk", "fp", "sk", "n", "head", "sketch"])

    return source.select("doc_id", "tk", "text").mapInArrow(run, PRINTS)


@dataclass(frozen=True)
class Classes:
    """Texts by their shingle sets: ``table(sk, doc_id, tk, fp, n, head, sketch)`` has one row for each different set."""

    table: DataFrame
    #: (doc_id, tk, text) of all rows
    source: DataFrame
    shingle: int
    similarity: float

    def wanted(self, common: Column) -> Column:
        """Whether so many common shingles are enough for sets of ``na`` and ``nb``."""
        return common >= (F.col("na") + F.col("nb") - common) * self.similarity - 1e-9

    def near(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b, na, nb) those whose parity sketches differ in no more bits than similar sets differ in shingles.

        A shingle turns one bit of its set's sketch, so every bit that differs stands for a shingle that only one has.
        """
        for x in "ab":
            pairs = pairs.join(self.table.select(F.col("sk").alias(x), F.col("sketch").alias("s" + x)), x)
        apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
        return pairs.filter(apart <= (F.col("na") + F.col("nb")) * ((1 - self.similarity) / (1 + self.similarity)) + 1e-9).select("a", "b")

    def useful(self) -> Column:
        """Whether a shared shingle at ``pa`` and ``pb`` in the heads can be the first that two similar sets share."""
        return self.wanted(F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole shingle sets have at least the similarity (Jaccard)."""
        pairs = saved(pairs.select("a", "b").distinct(), "candidates")
        nodes = pairs.select(F.col("a").alias("sk")).unionByName(pairs.select(F.col("b").alias("sk"))).distinct()
        rows = saved(nodes.join(self.table.select("sk", "doc_id", "tk", "n"), "sk").filter("n > 0").select("sk", "doc_id", "tk"), "nodes")
        # keys only; shuffled, with the texts, beyond the counted bound
        rows = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
        sets = saved(sets_of(self.source.join(rows, ["doc_id", "tk"]).dropDuplicates(["sk"]), self.shingle), "sets")
        both = pairs.join(sets.select(F.col("sk").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("sk").alias("b"), F.col("set").alias("sb")), "b")
        sized = both.withColumn("na", F.size("sa")).withColumn("nb", F.size("sb"))
        return sized.filter(self.wanted(F.size(F.array_intersect("sa", "sb")))).select("a", "b")


def with_roots(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows(sk, ...)`` with the ``root`` of each class's component."""
    # keys only; shuffled beyond the counted bound
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return rows.join(found.withColumnRenamed("node", "sk"), "sk", "left").withColumn("root", F.coalesce("root", "sk"))


def parted(rows: DataFrame) -> DataFrame:
    """``rows(token, sk, n, pos, root)`` of shingles that lie in several components, with the shingle's ``members``."""
    # dealt out once, for the extremes and for the join: Spark shares an exchange only if both sides want the same columns of it
    rows = rows.select("token", "sk", "n", "pos", "root").repartition("token")
    several = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.expr("count(sk, n, pos)").alias("members")).filter("low <> high").select("token", "members")
    return saved(rows.join(several, "token"), "heads")


def lots(rows: DataFrame, rounds: int) -> DataFrame:
    """(sk, lot0, lot1, ...): for each round one (token, members) of every class.

    Of a class's shingles the one with the least draw is taken; a shingle draws
    the same for all classes, and lower the more classes have it, so that similar
    classes mostly take the same one.
    """
    drawn = lambda turn: -F.log((F.pmod(F.xxhash64("token", F.lit(turn)), F.lit(1 << 31)) + 0.5) / (1 << 31)) / F.col("members")
    return saved(rows.groupBy("sk").agg(*(F.min_by(F.struct("token", "members"), drawn(turn)).alias(f"lot{turn}") for turn in range(rounds))), "lots")


def forest(n: np.ndarray, label: np.ndarray, sketch: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the components (``label``) of one block over pairs whose parity sketches allow the similarity, the nearest first.

    Fewer edges than rows: each round takes the nearest pair of every component.
    """
    found = []
    for begin in range(0, len(n), 64):
        rows = slice(begin, begin + 64)
        apart = np.bitwise_count(sketch[rows, None] ^ sketch[None, begin:]).sum(2, dtype=np.int64)
        sizes = n[rows, None] + n[None, begin:]
        wanted = (apart <= sizes * ((1 - similarity) / (1 + similarity)) + 1e-9) & (label[rows, None] != label[None, begin:])
        i, j = np.nonzero(np.triu(wanted))
        found.append((i + begin, j + begin, apart[i, j] / sizes[i, j]))
    i, j, far = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(far, kind="stable")
    i, j = i[order], j[order]
    label = np.unique(label, return_inverse=True)[1]
    taken_i, taken_j = [], []
    while len(i):
        nearest = np.full(len(n), len(i))
        for ends in (label[i], label[j]):
            np.minimum.at(nearest, ends, np.arange(len(i)))
        pick = np.unique(nearest[nearest < len(i)])
        taken_i.append(i[pick])
        taken_j.append(j[pick])
        label = join_labels(np.arange(len(n)), label[i[pick]], label[j[pick]])[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *taken_i]), np.concatenate([none, *taken_j])


def near_in_blocks(own: DataFrame, found: DataFrame, classes: Classes, turn: int) -> DataFrame:
    """Candidates (a, b), fewer than classes: those with one lot meet in blocks of about ``BLOCK``, each a forest of near pairs."""
    lot = F.col(f"lot{turn}")
    block = F.pmod(F.xxhash64("sk", F.lit(turn)), F.ceil(lot["members"] / BLOCK))
    dealt = own.select("sk", F.xxhash64(lot["token"], block).alias("task")).join(found.withColumnRenamed("node", "sk"), "sk", "left").withColumn("root", F.coalesce("root", "sk"))
    tasks = dealt.join(classes.table.select("sk", "n", "sketch"), "sk").select("task", "sk", "root", "n", "sketch")
    similarity = classes.similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            task, sk, root, n, sketch = (pa.concat_arrays([x.column(k) for x in held]) for k in range(5))
            task, sk, root, n = (x.to_numpy() for x in (task, sk, root, n))
            sketch = sketch.flatten().to_numpy().view(np.uint64).reshape(len(sk), -1)
            cuts = np.flatnonzero(np.diff(task, prepend=~task[0], append=~task[-1]))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if end - begin > 1:
                    i, j = forest(n[begin:end], root[begin:end], sketch[begin:end], similarity)
                    a.append(sk[begin + i])
                    b.append(sk[begin + j])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in filter(len, batches):
            last = int(np.searchsorted(batch.column(0).to_numpy(), batch.column(0)[len(batch) - 1].as_py()))
            if last or held and held[-1].column(0)[0] != batch.column(0)[0]:
                # whole tasks; the one that the batch ends with goes on
                yield links([*held, batch.slice(0, last)] if last else held)
                held = []
            held.append(batch.slice(last))
        if held:
            yield links(held)
        held = []
        give_back()

    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def similar_classes(classes: Classes, radius: int) -> DataFrame:
    """(node, root): components of the classes whose shingle sets are similar enough.

    1. Fingerprints within the radius, by BK-trees, are the first candidates.
    2. Similar sets share a shingle of their heads. In a few rounds every class
       takes one shingle, and classes of one shingle meet in blocks of bounded
       size, where the nearest pairs by parity sketches that join components
       are candidates.
    3. All pairs of classes of different components that share a shingle of
       their heads are candidates, if their sizes, the places of a common
       shingle and their parity sketches allow the similarity.

    Every candidate is verified by the whole sets. Steps 1 and 2 link nearly all
    there is to link with fewer candidates than classes, so that large groups of
    near copies are one component, and not paired, in step 3; step 3 makes the
    result exact.
    """
    table, spark, begun = classes.table, classes.table.sparkSession, written()
    first = saved(table.groupBy("fp").agg(F.min("sk").alias("first_sk")), "fingerprints")
    linked = fingerprint_links(first.select("fp"), radius)
    ends = linked.join(first.select(F.col("fp").alias("a"), F.col("first_sk").alias("sa")), "a").join(first.select(F.col("fp").alias("b"), F.col("first_sk").alias("sb")), "b")
    same = table.select("sk", "fp").join(first, "fp").filter("sk <> first_sk").select(F.col("first_sk").alias("a"), F.col("sk").alias("b"))
    edges = classes.verified(ends.select(F.col("sa").alias("a"), F.col("sb").alias("b")).unionByName(same))
    found = saved(connected_components(edges), "found")
    remove_scratch(spark, begun, found)
    joined = lambda more: connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    # sizes and places go along, so that the heads are dealt out once
    rows = parted(with_roots(table.select("sk", F.col("n").cast("int").alias("n"), "head"), found).select("sk", "n", "root", F.posexplode("head").alias("pos", "token")))
    if STARS:
        own = lots(rows, STARS)
        for turn in range(STARS):
            turned = written()
            found = saved(joined(classes.verified(near_in_blocks(own, found, classes, turn))), "found")
            remove_scratch(spark, turned, found)
        rows = parted(with_roots(rows.select("token", "sk", "n", "pos"), found))
        remove_scratch(spark, begun, rows, found)
    left, right = (rows.select("token", F.col("sk").alias(x), *(F.col(c).alias(k + x) for c, k in (("n", "n"), ("pos", "p"), ("root", "r")))) for x in "ab")
    met = left.join(right, "token").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & classes.wanted(F.least("na", "nb")) & classes.useful())
    return joined(classes.verified(classes.near(met.select("a", "b", "na", "nb").distinct())))


def keep_first(docs: DataFrame, shingle: int = 5, radius: int = 4, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each component, the one with the smallest id, with all columns.

    Texts are linked if the Jaccard similarity of their word shingles is at least
    ``similarity``; the radius bounds only the first search for candidates. Of
    rows with one id and one text one stays. Null and empty texts and texts of
    white space are one class, whose first row stays; shorter texts than a
    shingle are one shingle; a null id sorts first; texts of any length count
    whole; an empty table stays empty; names of other columns don't matter.
    """
    i, k = free_names(docs, "id", "key")
    keys = {i: F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)), k: F.xxhash64(F.coalesce(column(text_col).cast("string"), F.lit("")))}
    source = small_batches(docs).select(keys[i].alias("doc_id"), keys[k].alias("tk"), column(text_col).cast("string").alias("text"))
    before = written()
    prints = saved(sketches(source, shingle, similarity), "prints")
    # classes of equal sets, each with its first row
    least = F.min(F.struct("doc_id", "tk", "fp", "n", "head", "sketch")).alias("m")
    classes = Classes(saved(prints.groupBy("sk").agg(least).select("sk", "m.*"), "classes"), source, shingle, similarity)
    # heads and sketches are in the classes; of the rows only the keys are wanted again
    keyed = saved(prints.select("doc_id", "tk", "sk"), "keyed")
    remove_scratch(docs.sparkSession, before, keyed, classes.table)
    linked = similar_classes(classes, radius)
    member = saved(classes.table.select("sk", "doc_id", "tk").join(linked.withColumnRenamed("node", "sk"), "sk", "left").withColumn("root", F.coalesce("root", "sk")), "members")
    # the row that stays: the smallest id of the component, of the texts with this id the first
    least = saved(member.groupBy("root").agg(F.min(F.struct("doc_id", "tk")).alias("m")).select("root", F.col("m.doc_id").alias("first_id"), F.col("m.tk").alias("first_tk")), "firsts")
    named = saved(member.join(least, "root").select("sk", "first_id", "first_tk"), "named")
    own = keyed.join(named, "sk")
    gone = own.filter((F.col("doc_id") != F.col("first_id")) | (F.col("tk") != F.col("first_tk"))).select(F.col("doc_id").alias(i), F.col("tk").alias(k)).distinct()
    gone = saved(gone, "gone")
    again = not keyed.groupBy("doc_id", "tk").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    remove_scratch(docs.sparkSession, before, gone)
    # ids and text hashes only; shuffled beyond the counted bound
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    kept = docs.withColumns(keys).join(gone, [i, k], "left_anti")
    if again:
        kept = kept.dropDuplicates([i, k])
    return kept.select(*map(column, docs.columns))
