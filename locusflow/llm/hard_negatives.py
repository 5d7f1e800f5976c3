"""Hard negatives by a multiway hyperplane tree with distance ranges.

Vectors are integers and a score is an inner product. One more coordinate
brings all rows to the length of the longest; an anchor gets zero there. Then a
score is a distance in Euclidean space: d^2 = |anchor|^2 + longest^2 - 2 score,
and a window of scores is an annulus around the anchor.

A node of the tree has split points and gives each row to the nearest one. For
every split point it stores the least and greatest distance to the rows of every
sibling subtree, so a subtree whose possible distances to the anchor miss the
annulus is left out. Leaves are gone through exactly, in integers.

On Spark the root's subtrees are cells of the whole table: its split points come
from a bounded sample (``ROOT_SAMPLE`` rows, the least by hash), its ranges from
all rows. A cell is cut into shards of at most about ``SHARD_VALUES`` components,
by hash; each shard has a tree of its own. Anchors go in blocks to the shards
whose cell the root's ranges leave in, so a task holds one shard and one block.
Every row is in one shard, and what is left out can't be in the window: results
are those of going through all rows.

Defined cases: rows with a null id, a null label, a null vector, or a null or
non-finite component take no part; of rows with one id the least (label, vector)
counts; a shorter vector counts as followed by zeros; an empty table, or one
without anchors, gives no rows; other columns are ignored. Scores are exact up to
2^53, which windows of scores are stored in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusflow.llm.common import column, saved, small_batches

ROOT_SAMPLE, ROOT_SPLITS = 1024, 32
NODE_SAMPLE, NODE_SPLITS, LEAF_ROWS = 256, 16, 256
SHARD_VALUES = 1 << 22
BLOCK_ROWS = 8192
#: Cells of a score matrix at once.
MATRIX_CELLS = 1 << 21


def quantised(embeddings: DataFrame, levels: int = 256) -> DataFrame:
    """(vec_id, label, v): each component x as floor(levels * x), of the rows that take part."""
    vector = column("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    given = embeddings.filter(column("label").isNotNull() & column("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = given.select(column("vec_id").cast("long").alias("vec_id"), column("label").cast("long").alias("label"), F.transform(vector, lambda x: F.floor(x * levels)).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("m")).select("vec_id", "m.label", "m.v")


# ---- geometry ---------------------------------------------------------------------


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, shorter ones followed by zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = values
    return out


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that brings them to the squared length ``longest``."""
    x = rows.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))[:, None]])


def distances(a: np.ndarray, squared: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Distances of points ``a`` of these squared lengths to lifted points ``b``."""
    return np.sqrt(np.maximum(squared[:, None] + longest - 2 * (a @ b.T), 0))


def farthest_points(points: np.ndarray, wanted: int, longest: float) -> np.ndarray:
    """Split points: the first one, then always the point that is farthest from those chosen, while there are different ones."""
    chosen, near = [0], None
    while True:
        d = distances(points, np.full(len(points), longest), points[chosen[-1:]], longest)[:, 0]
        near = d if near is None else np.minimum(near, d)
        at = int(near.argmax())
        if len(chosen) == wanted or near[at] <= slack(longest):
            return points[chosen]
        chosen.append(at)


def slack(longest: float) -> float:
    """More than distances of this scale lose by rounding."""
    return 1e-5 * (math.sqrt(longest) + 1)


def bounds(d: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of query points to the rows of each subtree (query x subtree).

    ``d``: query x split point; ``low``, ``high``: split point x subtree.
    """
    least = np.stack([np.maximum(d - high[:, j], low[:, j] - d).max(1) for j in range(high.shape[1])], 1)
    most = np.stack([(d + high[:, j]).min(1) for j in range(high.shape[1])], 1)
    return least, most


class Tree:
    """The hyperplane tree of one shard."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, longest: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.longest = ids[order], rows[order], longest
        self.names, self.labels = np.unique(labels[order], return_inverse=True)
        self.points = lifted(self.rows, longest)
        self.root = self._node(np.arange(len(ids)))

    def _node(self, own: np.ndarray) -> dict:
        held = np.bincount(self.labels[own], minlength=len(self.names)) > 0
        leaf = {"rows": own, "held": held}
        if len(own) <= LEAF_ROWS:
            return leaf
        sample = own[np.linspace(0, len(own) - 1, min(NODE_SAMPLE, len(own))).astype(int)]
        splits = farthest_points(self.points[sample], NODE_SPLITS, self.longest)
        d = distances(self.points[own], np.full(len(own), self.longest), splits, self.longest)
        near = d.argmin(1)
        kept = np.unique(near)
        if len(kept) < 2:
            return leaf
        low = np.stack([d[near == j].min(0) for j in kept], 1)
        high = np.stack([d[near == j].max(0) for j in kept], 1)
        children = [self._node(own[near == j]) for j in kept]
        return {"splits": splits, "low": low, "high": high, "children": children, "held": held}

    def search(self, anchors: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, same: bool, of: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        """(scores, ids), windows x k: the greatest scores within each window, of equal ones the smaller ids; id order decides.

        ``of``: each window's anchor; ``low``, ``high``: its least and greatest
        score. Only rows of the anchor's label are looked at, or only others.
        """
        squared = (anchors.astype(np.float64) ** 2).sum(1)
        query = np.hstack([anchors.astype(np.float64), np.zeros((len(anchors), 1))])
        code = np.searchsorted(self.names, anchor_labels)
        code = np.where((code < len(self.names)) & (self.names[np.minimum(code, len(self.names) - 1)] == anchor_labels), code, -1)
        # exact in doubles while every sum of products stays below 2^53
        most = float(np.abs(self.rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * self.rows.shape[1]
        number = np.float64 if most < 2.0**53 else np.int64
        none = -np.inf if number is np.float64 else -np.iinfo(np.int64).max
        rows, asked = self.rows.astype(number), anchors.astype(number)
        best, names = np.full((len(of), k), none, number), np.full((len(of), k), np.iinfo(np.int64).max)
        low = low.astype(np.float64)
        room = slack(self.longest)

        def radius(score: np.ndarray, windows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(squared[of[windows]] + self.longest - 2 * score, 0))

        def wanted(node: dict, windows: np.ndarray) -> np.ndarray:
            own = code[of[windows]]
            there = (own >= 0) & node["held"][own]
            return there if same else ~there | (node["held"].sum() > 1)

        def visit(node: dict, windows: np.ndarray) -> None:
            if "rows" in node:
                step = max(1, MATRIX_CELLS // len(node["rows"]))
                for i in range(0, len(windows), step):
                    leaf(node["rows"], windows[i : i + step])
                return
            asking, at = np.unique(of[windows], return_inverse=True)
            least, far = bounds(distances(query[asking], squared[asking], node["splits"], self.longest), node["low"], node["high"])
            for j in least.mean(0).argsort():
                # a window that is full has its last score as the least one that counts
                meets = (least[at, j] <= radius(low[windows], windows) + room) & (far[at, j] >= radius(high[windows], windows) - room)
                left = windows[meets & wanted(node["children"][j], windows)]
                if len(left):
                    visit(node["children"][j], left)

        def leaf(own: np.ndarray, windows: np.ndarray) -> None:
            asking, at = np.unique(of[windows], return_inverse=True)
            score = (asked[asking] @ rows[own].T)[at]
            like = self.labels[own][None, :] == code[of[windows]][:, None]
            fits = (score >= low[windows][:, None]) & (score <= high[windows][:, None]) & (like == same) & (self.ids[own][None, :] != anchor_ids[of[windows]][:, None])
            score = np.where(fits, score, none)
            left = np.flatnonzero(fits.any(1))
            line = np.arange(len(windows))
            for _ in range(k):
                if not len(left):
                    break
                first = score[left].argmax(1)  # of equal scores the first row, which has the smallest id
                found, name = score[left, first], self.ids[own[first]]
                score[left, first] = none
                real = found > none
                put(windows[line[left[real]]], found[real], name[real])
                left = left[real]

        def put(windows: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
            scores, ids = np.hstack([best[windows], score[:, None]]), np.hstack([names[windows], name[:, None]])
            order = np.lexsort((ids, -scores), axis=1)[:, :k]
            best[windows], names[windows] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
            full = best[windows, k - 1] > none
            low[windows[full]] = np.maximum(low[windows[full]], best[windows[full], k - 1])

        every = np.arange(len(of))
        visit(self.root, every[wanted(self.root, every)])
        return best, names, none


# ---- on Spark ---------------------------------------------------------------------


class Index:
    """Rows ``(vec_id, label, v)`` dealt into shards, and the root's split points and ranges."""

    def __init__(self, vectors: DataFrame):
        spark = vectors.sparkSession
        vectors = saved(small_batches(vectors), "vectors")
        norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        self.n, dim, longest = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
        self.dim, self.longest = dim or 0, longest or 0.0
        if not self.n:
            return
        dim, longest = self.dim, self.longest
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(ROOT_SAMPLE).select("v").toArrow()
        self.splits = splits = farthest_points(lifted(matrix(sample.column("v"), dim), longest), ROOT_SPLITS, longest)

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = lifted(matrix(batch.column("v"), dim), longest)
                d = distances(points, np.full(len(points), longest), splits, longest)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(d.ravel()), len(splits)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d.argmin(1).astype(np.int32)), flat], ["vec_id", "label", "v", "cell", "away"])

        dealt = saved(vectors.mapInArrow(cells, "vec_id long, label long, v array<bigint>, cell int, away array<double>"), "cells")
        spans = dealt.groupBy("cell").agg(F.count("*").alias("n"), *(f(F.get("away", F.lit(i))).alias(f"{name}{i}") for i in range(len(splits)) for name, f in (("low", F.min), ("high", F.max))))
        found = {r.cell: r for r in spans.collect()}
        per = max(256, SHARD_VALUES // max(dim, 1))
        parts = [math.ceil(found[c].n / per) if c in found else 0 for c in range(len(splits))]
        self.first = np.cumsum([0, *parts])
        # a cell without rows has the empty range, which meets no window
        self.low, self.high = (np.array([[getattr(found[c], f"{name}{i}") if c in found else empty for c in range(len(splits))] for i in range(len(splits))]) for name, empty in (("low", np.inf), ("high", -np.inf)))
        of_cell = lambda xs: F.element_at(F.array(*map(F.lit, map(int, xs))), F.col("cell") + 1)
        shard = of_cell(self.first[:-1]) + F.pmod(F.xxhash64(F.lit(7), "vec_id"), of_cell(parts).cast("long")).cast("int")
        self.rows = dealt.select("vec_id", "label", "v", shard.alias("shard"))
        self.spark = spark

    def routed(self, requests: DataFrame, home: bool) -> DataFrame:
        """Requests with the shards that may hold rows of their windows; with ``home`` only the first shard of the nearest cell."""
        dim, longest, splits, low, high, first = self.dim, self.longest, self.splits, self.low, self.high, self.first

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                anchors = matrix(batch.column("v"), dim).astype(np.float64)
                squared = (anchors**2).sum(1)
                d = distances(np.hstack([anchors, np.zeros((len(anchors), 1))]), squared, splits, longest)
                held = np.diff(first) > 0
                if home:
                    shards = [[int(first[c])] for c in np.where(held[None, :], d, np.inf).argmin(1)]
                else:
                    least, most = bounds(d, low, high)
                    shards = []
                    for i, windows in enumerate(zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True)):
                        lo, hi = (np.sqrt(np.maximum(squared[i] + longest - 2 * np.array(x), 0))[:, None] for x in windows)
                        meets = ((least[i] <= lo + slack(longest)) & (most[i] >= hi - slack(longest)) & held).any(0)
                        shards.append([int(s) for c in np.flatnonzero(meets) for s in range(first[c], first[c + 1])])
                yield batch.append_column("shards", pa.array(shards, pa.list_(pa.int32())))

        return requests.mapInArrow(run, "anchor_id long, label long, v array<bigint>, low array<double>, high array<double>, shards array<int>").withColumn("shard", F.explode("shards")).drop("shards")

    def search(self, requests: DataFrame, n_requests: int, same: bool, k: int, home: bool = False) -> DataFrame:
        """(anchor_id, window, score, vec_id, rank): the ``k`` greatest scores of each window, of equal ones the smaller ids.

        ``requests``: (anchor_id, label, v, low, high) with the windows' scores as arrays.
        """
        dim, longest = self.dim, self.longest
        blocks = math.ceil(max(n_requests, 1) / BLOCK_ROWS)
        asked = self.routed(small_batches(requests), home).withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
        rows = self.rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        schema = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return schema.empty_table()
            tree = Tree(right.column("vec_id").to_numpy(), right.column("label").to_numpy(), matrix(right.column("v"), dim), longest)
            ids = left.column("anchor_id").to_numpy()
            low = left.column("low").combine_chunks()
            counts = np.diff(low.offsets.to_numpy())
            of = np.repeat(np.arange(len(ids)), counts)
            number = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            high = left.column("high").combine_chunks().flatten().to_numpy()
            best, names, none = tree.search(matrix(left.column("v"), dim), ids, left.column("label").to_numpy(), same, of, low.flatten().to_numpy(), high, k)
            w, i = np.nonzero(best > none)
            return pa.table([ids[of[w]], number[w].astype(np.int32), best[w, i].astype(np.int64), names[w, i]], schema=schema)

        found = asked.groupBy("shard", "block").cogroup(rows.groupBy("shard", "block")).applyInArrow(run, "anchor_id long, window int, score long, vec_id long")
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows ``(vec_id, label, v)``.

    An anchor's positives are its nearest other rows of the same label. For each
    of them the negatives are the greatest scores among rows of other labels
    from ``low_percent`` to ``high_percent`` of the positive's score. All anchors
    are answered from all rows.
    """
    spark = vectors.sparkSession
    index = Index(vectors)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not index.n:
        return spark.createDataFrame([], out)
    anchors = saved(index.rows.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "v"), "anchors")
    n = anchors.count()
    one = lambda c: F.array(c.cast("double"))
    everywhere = F.lit(float("inf"))
    # the nearest rows of one shard bound what all others have to reach
    near = index.search(anchors.select("*", one(-everywhere).alias("low"), one(everywhere).alias("high")), n, True, positives, home=True)
    reached = near.groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == positives).select("anchor_id", "least")
    bounded = anchors.join(reached, "anchor_id", "left").select("anchor_id", "label", "v", one(F.coalesce(F.col("least").cast("double"), -everywhere)).alias("low"), one(everywhere).alias("high"))
    pairs = saved(index.search(bounded, n, True, positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("window")), "positives")
    # positives at most, of each anchor
    windows = pairs.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("window", "positive_score"))).alias("w"))
    least = F.transform("w", lambda p: F.when(p.positive_score >= 0, F.ceil(p.positive_score * low_percent / 100).cast("double")).otherwise(everywhere))
    most = F.transform("w", lambda p: F.when(p.positive_score >= 0, F.floor(p.positive_score * high_percent / 100).cast("double")).otherwise(-everywhere))
    asked = anchors.join(windows, "anchor_id").select("anchor_id", "label", "v", least.alias("low"), most.alias("high"))
    found = index.search(asked, n, False, negatives).select("anchor_id", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(pairs, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(embeddings: DataFrame, every: int = 50, moved: int = 7, labels: int = 10) -> DataFrame:
    """``mine`` with every ``every``-th id as an anchor, over the quantised table; ids divisible by ``moved`` get the next label first."""
    rows = quantised(embeddings)
    changed = F.when(F.pmod("vec_id", F.lit(moved)) == 0, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label"))
    return mine(rows.withColumn("label", changed), F.pmod("vec_id", F.lit(every)) == 0)


def hard_negatives_sql() -> str:
    """The rows of ``hard_negatives`` in DuckDB's SQL, every anchor against every row."""
    return """
WITH valid AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM valid),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER own AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW own AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER own <= 3"""


