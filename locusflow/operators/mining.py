"""Gene-order patterns that recur with insertions."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from locusflow.functions import canonical, jaccard


#: Spark's setting that an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the scratch tables that this thread wrote.
_WRITTEN = threading.local()


def saved(df: DataFrame, name: str) -> DataFrame:
    """A table in the session's shared folder: cuts the lineage and survives lost executors.

    The shuffle files that its writing took go when it is there.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    _paths().append(path)
    return spark.read.schema(df.schema).parquet(path)


def _paths() -> list[str]:
    if not hasattr(_WRITTEN, "paths"):
        _WRITTEN.paths = []
    return _WRITTEN.paths


def written() -> int:
    """How many scratch tables this thread has written and not removed."""
    return len(_paths())


def remove_scratch(spark: SparkSession, since: int, *but: DataFrame) -> None:
    """Remove the scratch tables that this thread wrote after ``since``, apart from those that ``but`` reads.

    For a step that made them for these tables, the only ones that what follows
    reads: the others would take disk until the end of the run.
    """
    files, kept = [df.inputFiles() for df in but], []
    if not all(files):
        return
    files = [f for own in files for f in own]
    for path in _paths()[since:]:
        if any(f"/{path.rsplit('/', 1)[1]}/" in f for f in files):
            kept.append(path)
            continue
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _paths()[since:] = kept


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names.

    Where none is set (or Spark's own default), one temporary folder of the
    process serves in local mode; elsewhere that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root or root == "/tmp/checkpoints":
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of a slice of a stored table that is shuffled at once, and slices at most.
SLICE_ROWS, MOST_SLICES = 2_000_000, 16


def in_slices(rows: int, name: str, make: Callable[[Callable[[str], Column]], DataFrame]) -> DataFrame:
    """What ``make`` gives for slices of stored tables of so many rows, one after another, stored.

    ``make`` gets a function from a column's name to the filter of the slice, by
    the hash of the column. So only a slice's rows are shuffled at once.
    """
    n = max(1, min(MOST_SLICES, -(-rows // SLICE_ROWS)))
    return reduce(DataFrame.unionByName, [saved(make(lambda c, i=i: F.pmod(F.xxhash64(c), F.lit(n)) == i), name) for i in range(n)])


#: Bits of a cluster's hash that signatures keep.
SIGNATURE_MASK = -1
#: Patterns of a batch of lists that a task hands on at once.
HELD_PATTERNS = 1 << 16
#: Pairs of patterns and clusters whose signatures are summed at once, and in how many steps at most.
SIGNED_PAIRS, SIGNED_STEPS = 2_000_000, 16
#: Steps in which patterns are held against the best ones of their signatures, at most.
HELD_STEPS = 64


def filter_lists(lists: DataFrame, min_types: int = 3, max_length: int = 40, max_repeats: int = 2) -> DataFrame:
    """Lists with enough different types, not too long, and no type more often than ``max_repeats``."""
    ordered = F.array_sort("types")
    # in a sorted list a type occurs more than m times if it equals the one m places on
    often = F.exists(F.sequence(F.lit(1), F.size("types")), lambda i: F.get(ordered, i - 1) == F.get(ordered, i - 1 + max_repeats))
    return lists.filter((F.size(F.array_distinct("types")) >= min_types) & (F.size("types") <= max_length) & ~F.coalesce(often, F.lit(False)))


def dereplicate(lists: DataFrame, replicates: bool = False) -> DataFrame:
    """Different type lists: (types, cluster_id, weight) with the first cluster as representative and the number of replicates.

    With ``replicates`` also all their clusters in order, as one array; see
    ``replicates()`` for them as rows.
    """
    named = [F.array_sort(F.collect_list("cluster_id")).alias("replicates")] if replicates else []
    return lists.groupBy("types").agg(F.min("cluster_id").alias("cluster_id"), F.count("*").alias("weight"), *named)


def replicates(lists: DataFrame, derep: DataFrame, stored: bool = False) -> DataFrame:
    """(cluster_id, replicate): every list's cluster beside its representative, itself included; a list that very many clusters have is met in parts.

    ``stored`` lists are a table and not written again.
    """
    from locusflow.operators.skew import salted_join

    own = lists.select("types", F.col("cluster_id").alias("replicate"))
    own = own if stored else saved(own, "lists")
    return salted_join(own, derep.select("types", "cluster_id"), "types").select("cluster_id", "replicate")


def positions(lists: DataFrame) -> DataFrame:
    """(gene, cluster_id, pos): where each gene stands, from 0."""
    return lists.select("cluster_id", F.posexplode("types").alias("pos", "gene")).select("gene", "cluster_id", "pos")


def alphabet(derep: DataFrame, q: int = 1) -> DataFrame:
    """Genes whose occurrences, each counted with its list's weight, reach ``q``."""
    return derep.select("weight", F.explode("types").alias("gene")).groupBy("gene").agg(F.sum("weight").alias("support")).filter(F.col("support") >= q)


def bigrams(lists: DataFrame, genes: DataFrame) -> DataFrame:
    """Different pairs of adjacent genes, both of the alphabet."""
    at = F.sequence(F.lit(1), F.size("types") - 1)
    pairs = lists.filter(F.size("types") > 1).select(F.explode(F.transform(at, lambda i: F.struct(F.get("types", i - 1).alias("a"), F.get("types", i).alias("b")))).alias("p"))
    known = genes.select("gene")
    out = pairs.select("p.a", "p.b").distinct()
    return out.join(known.withColumnRenamed("gene", "a"), "a", "left_semi").join(known.withColumnRenamed("gene", "b"), "b", "left_semi").select("a", "b")


def next_match(lists: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cluster_id, pos, b, next): for each position of ``a`` the first later position of ``b``, for observed pairs (a, b)."""
    # each list is looked through on its own: the genes after a position, and where each of them comes first
    rest = F.transform("types", lambda x, i: F.struct(i.alias("pos"), x.alias("a"), F.slice("types", i + 2, F.greatest(F.size("types") - i - 1, F.lit(0))).alias("rest")))
    own = lists.filter(F.size("types") > 0).select("cluster_id", F.explode(rest).alias("p")).select("cluster_id", "p.*")
    later = own.select("cluster_id", "pos", "a", "rest", F.explode(F.array_distinct("rest")).alias("b"))
    found = later.select("cluster_id", "pos", "a", "b", (F.col("pos") + F.array_position("rest", F.col("b"))).cast("int").alias("next"))
    return found.join(pairs, ["a", "b"], "left_semi").select("cluster_id", "pos", "b", "next")


def sublists(lists: DataFrame, genes: DataFrame, min_length: int = 2, max_length: int = 40) -> DataFrame:
    """Different contiguous sublists whose genes are all of the alphabet: ``pattern``."""
    n = F.size("types")
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    each = F.flatten(
        F.transform(
            starts,
            lambda s: F.transform(F.sequence(F.lit(min_length), F.greatest(F.least(n - s + 1, F.lit(max_length)), F.lit(min_length))), lambda m: F.slice("types", s, m)),
        )
    )
    found = lists.filter(n >= min_length).select(F.explode(F.filter(each, lambda p: F.size(p) >= min_length)).alias("pattern")).distinct()
    outside = found.select("pattern", F.explode(F.array_distinct("pattern")).alias("gene")).join(genes, "gene", "left_anti").select("pattern").distinct()
    return found.join(outside, "pattern", "left_anti")


def coded(lists: DataFrame) -> tuple[DataFrame, int]:
    """(cluster_id, types) of stored lists with the genes as numbers in their order, so many bytes each, in one string of bytes.

    Such strings compare as the lists of names do. A gene without a name is 0.
    """
    from locusflow.operators.ranges import numbered
    from locusflow.operators.skew import stored_small

    begun = written()
    names = lists.select(F.explode("types").alias("gene")).filter(F.col("gene").isNotNull()).distinct()
    genes = stored_small(numbered(names, [F.col("gene").asc()]).select("gene", F.col("rank").cast("int").alias("code")), "genes")
    width = max(1, -(-genes.count().bit_length() // 8))
    rows = lists.withColumn("_row", F.monotonically_increasing_id())
    places = rows.select("_row", "cluster_id", F.posexplode("types").alias("pos", "gene")).join(genes, "gene", "left")
    order = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("code", F.lit(0)).alias("code"))))
    own = places.groupBy("_row", "cluster_id").agg(F.transform(order, lambda x: x["code"]).alias("types"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(">u4")
            ends = np.cumsum([0, *batch.column(1).value_lengths().to_pylist()]) * width
            text = codes.view(np.uint8).reshape(-1, 4)[:, 4 - width :].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])], ["cluster_id", "types"])

    kind = lists.schema["cluster_id"].dataType.simpleString()
    out = saved(own.select("cluster_id", "types").mapInArrow(run, f"cluster_id {kind}, types binary"), "coded")
    remove_scratch(lists.sparkSession, begun, out)
    return out, width


def merged_support(derep: DataFrame, width: int, k: int = 2, q: int = 1, max_length: int = 40) -> DataFrame:
    """(pattern, cluster_id, many), stored: the support of ``gapped_support`` with patterns and their reverses as one, over coded lists.

    A list names each pattern once, the smaller of it and its reverse, with the
    ways in which it has it, so no pairs need to be made different. Only counts
    of patterns are shuffled, and pairs of those patterns that are too rare to be
    broadcast. ``many``: the list has replicates.
    """
    from locusflow.operators.skew import frequent_join

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(batch: pa.RecordBatch, rows: list[int], patterns: list, ways: list[int]) -> pa.RecordBatch:
            own = batch.take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(patterns, pa.binary()), own.column(1), own.column(2), pa.array(ways, pa.int32())], ["pattern", "cluster_id", "weight", "ways"])

        unnamed = bytes(width)
        for batch in batches:
            rows, patterns, ways = [], [], []
            for row, text in enumerate(batch.column(0).to_pylist()):
                genes = [text[i : i + width] for i in range(0, len(text), width)]
                own = {}
                for pattern, whole in _instances([None if g == unnamed else g for g in genes], k, max_length).items():
                    back = pattern[::-1]
                    name, way = (pattern, 1) if pattern <= back else (back, 2)
                    own[name] = own.get(name, 0) | way | (way << 2 if whole else 0)
                rows += [row] * len(own)
                patterns += map(b"".join, own)
                ways += own.values()
                if len(rows) >= HELD_PATTERNS:
                    yield packed(batch, rows, patterns, ways)
                    rows, patterns, ways = [], [], []
            yield packed(batch, rows, patterns, ways)

    kind = derep.schema["cluster_id"].dataType.simpleString()
    own = derep.select("types", "cluster_id", "weight").mapInArrow(run, f"pattern binary, cluster_id {kind}, weight bigint, ways int")
    has = lambda bit: F.col("ways").bitwiseAND(bit) != 0
    weight = lambda way: F.sum(F.when(has(way), F.col("weight")).otherwise(0))
    counts = own.groupBy("pattern").agg(weight(1).alias("w1"), weight(2).alias("w2"), F.bit_or("ways").alias("ways"))
    # each way has to reach the weight by itself, and with a list without insertions
    good = F.when((F.col("w1") >= q) & has(4), 1).otherwise(0) + F.when((F.col("w2") >= q) & has(8), 2).otherwise(0)
    kept = saved(counts.select("pattern", good.alias("good"), (F.col("w1") + F.col("w2")).alias("_n")).filter("good > 0"), "kept")
    return saved(frequent_join(own, kept, "pattern", "_n").filter(F.col("ways").bitwiseAND(F.col("good")) != 0).select("pattern", "cluster_id", (F.col("weight") > 1).alias("many")), "support")


def _instances(types: list, k: int, max_length: int) -> dict[tuple, bool]:
    """The patterns of one list, and whether it has them without insertions.

    A pattern starts at any gene and goes on at the first later place of each
    next gene, with at most ``k`` insertions in all; genes without a name are in
    no pattern.
    """
    found, open_ = {}, [((gene,), s, s) for s, gene in enumerate(types) if gene is not None]
    while open_:
        pattern, start, end = open_.pop()
        left = k - (end - start + 1 - len(pattern))
        seen = set()
        for at in range(end + 1, min(end + 2 + left, len(types))):
            gene = types[at]
            if gene is None or gene in seen:
                continue
            seen.add(gene)
            longer = (*pattern, gene)
            whole = at - start + 1 == len(longer)
            found[longer] = whole or found.get(longer, False)
            if len(longer) < max_length:
                open_.append((longer, start, at))
    return found


def instances(unique: DataFrame, k: int, max_length: int) -> DataFrame:
    """(pattern, cluster_id, weight, whole): the different patterns of each list with at most ``k`` insertions; ``whole``: without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(batch: pa.RecordBatch, rows: list[int], patterns: list, wholes: list[bool]) -> pa.RecordBatch:
            own = batch.take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(patterns, batch.column(0).type), own.column(1), own.column(2), pa.array(wholes, pa.bool_())], ["pattern", "cluster_id", "weight", "whole"])

        for batch in batches:
            rows, patterns, wholes = [], [], []
            for row in range(batch.num_rows):
                own = _instances(batch.column(0)[row].as_py(), k, max_length)
                rows += [row] * len(own)
                patterns += own.keys()
                wholes += own.values()
                if len(rows) >= HELD_PATTERNS:
                    yield packed(batch, rows, patterns, wholes)
                    rows, patterns, wholes = [], [], []
            yield packed(batch, rows, patterns, wholes)

    kinds = {f.name: f.dataType.simpleString() for f in unique.schema.fields}
    schema = f"pattern {kinds['types']}, cluster_id {kinds['cluster_id']}, weight {kinds['weight']}, whole boolean"
    return unique.select("types", "cluster_id", "weight").mapInArrow(run, schema)


def gapped_support(lists: DataFrame, derep: DataFrame, k: int = 2, q: int = 1, max_length: int = 40) -> DataFrame:
    """(pattern, cluster_id): lists with an instance of each candidate pattern with at most ``k`` insertions.

    Candidates are the contiguous sublists of the lists. An instance starts at a
    position of the first gene and goes on at the first later position of each
    next gene; its length less the pattern's is the number of insertions.
    Patterns of less weight than ``q`` are left out.

    A list's instances follow from the list alone, so they are made where the
    list is, twice: first to sum the weight of each pattern and to see whether
    any list has it without insertions (a candidate), then to hand on those of
    the patterns that stay. A list of n genes has fewer than n (n + k)^k n / k!
    of them.
    """
    unique = saved(derep.select("cluster_id", "types", "weight"), "unique")
    own = instances(unique, k, max_length)
    kept = own.groupBy("pattern").agg(F.sum("weight").alias("w"), F.bool_or("whole").alias("candidate")).filter((F.col("w") >= q) & F.col("candidate"))
    return own.select("pattern", "cluster_id").join(saved(kept.select("pattern"), "kept"), "pattern", "left_semi")


def merge_reversed(support: DataFrame) -> DataFrame:
    """Patterns and their reverses as one: the smaller of both, with the clusters of both."""
    return support.select(canonical("pattern").alias("pattern"), "cluster_id").distinct()


def closed_patterns(support: DataFrame, stored: bool = False) -> DataFrame:
    """(pattern, n): of the patterns with one support set the longest, the greatest of those, and the size of the set.

    A support set is known by a signature that needs no order and no array: its
    size and three sums over hashes of its clusters. Of the patterns with one
    signature each is then held against the best one cluster by cluster; those
    that differ after all go through another round among themselves. A
    ``stored`` support is a table of different pairs and not written again.
    """
    from locusflow.operators.skew import SMALL_ROWS

    pairs = support.select("pattern", "cluster_id")
    pairs = pairs if stored else saved(pairs.distinct(), "support")
    first, second = (F.xxhash64(F.lit(seed), "cluster_id").bitwiseAND(SIGNATURE_MASK) for seed in (1, 2))
    sums = [F.count("*").alias("n"), F.bit_xor(first).alias("h1"), F.bit_xor(second).alias("h2"), F.sum(first.bitwiseAND(0xFFFFFFFF)).alias("h3")]
    steps = min(SIGNED_STEPS, -(-pairs.count() // SIGNED_PAIRS)) or 1
    left = reduce(DataFrame.unionByName, [saved(pairs.filter(F.pmod(F.xxhash64("pattern"), F.lit(steps)) == i).groupBy("pattern").agg(*sums), "signatures") for i in range(steps)])
    signature = ["n", "h1", "h2", "h3"]
    closed = []
    while True:
        best = left.groupBy(*signature).agg(F.max(F.struct(pattern_length(left).alias("length"), F.col("pattern").alias("pattern"))).alias("m"), F.count("*").alias("patterns"))
        chosen = saved(best.select(*signature, F.col("m.pattern").alias("best"), "patterns"), "closed")
        closed.append(chosen.select(F.col("best").alias("pattern"), "n"))
        others = saved(left.join(chosen.filter("patterns > 1"), signature).filter("pattern <> best").select("pattern", "best", *signature), "same-signature")
        count = others.count()
        if not count:
            break
        # clusters that a pattern has and its signature's best one hasn't: only pairs of such patterns meet
        steps, differ = min(HELD_STEPS, -(-2 * count // SMALL_ROWS)), []
        for i in range(steps):
            begun = written()
            asked = saved(others.filter(F.pmod(F.xxhash64("best"), F.lit(steps)) == i).select("pattern", "best"), "asked")
            names = saved(asked.select("pattern").unionByName(asked.select(F.col("best").alias("pattern")).distinct()), "names")
            own = saved(pairs.join(F.broadcast(names) if names.count() <= SMALL_ROWS else names, "pattern", "left_semi"), "own")
            missing = own.join(asked, "pattern").join(own.select(F.col("pattern").alias("best"), "cluster_id"), ["best", "cluster_id"], "left_anti")
            differ.append(saved(missing.select("pattern").distinct(), "differ"))
            remove_scratch(support.sparkSession, begun, differ[-1])
        left = saved(others.join(reduce(DataFrame.unionByName, differ), "pattern", "left_semi").select("pattern", *signature), "signatures")
        if left.isEmpty():
            break
    return reduce(DataFrame.unionByName, closed)


def pattern_length(patterns: DataFrame) -> Column:
    """The length of a column ``pattern``; of coded patterns in bytes."""
    return (F.octet_length if isinstance(patterns.schema["pattern"].dataType, BinaryType) else F.size)("pattern")


def similar_patterns(patterns: DataFrame, min_similarity: float = 0.0) -> DataFrame:
    """Pairs of patterns (keyword a < b) that share an item, with their Jaccard similarity as sets.

    Sets that are similar enough share one of their rarest items (so many that
    the rest alone could not make the similarity), and their sizes are near:
    only such pairs meet. Without a least similarity all items count.
    """
    sets = patterns.select("keyword", F.array_sort(F.array_distinct("pattern")).alias("items"))
    items = sets.select("keyword", F.size("items").alias("n"), F.explode("items").alias("item"))
    rare = items.groupBy("item").agg(F.count("*").alias("f"))
    ranked = items.join(rare, "item").groupBy("keyword", "n").agg(F.array_sort(F.collect_list(F.struct("f", "item"))).alias("by"))
    head = ranked.select("keyword", "n", F.explode(F.slice("by", 1, F.col("n") - F.ceil(F.col("n") * min_similarity - 1e-9).cast("int") + 1)).alias("h"))
    head = head.select("keyword", "n", F.col("h.item").alias("item"))
    left = head.select(F.col("keyword").alias("a"), F.col("n").alias("na"), "item")
    right = head.select(F.col("keyword").alias("b"), F.col("n").alias("nb"), "item")
    near = F.least("na", "nb") >= F.greatest("na", "nb") * min_similarity - 1e-9
    pairs = left.join(right, "item").filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    both = pairs.join(sets.select(F.col("keyword").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("keyword").alias("b"), F.col("items").alias("y")), "b")
    return both.select("a", "b", jaccard("x", "y").alias("similarity")).filter((F.col("similarity") >= min_similarity) & (F.col("similarity") > 0))


def number_patterns(patterns: DataFrame, prefix: str = "csb-", suffix: str = "_") -> DataFrame:
    """``keyword``: numbers in order of (length, pattern); equal patterns share one."""
    from locusflow.operators.ranges import numbered

    different = patterns.select("pattern").distinct().withColumn("_n", F.size("pattern"))
    named = numbered(different, [F.col("_n").asc(), F.col("pattern").asc()]).select("pattern", F.concat(F.lit(prefix), F.col("rank").cast("string"), F.lit(suffix)).alias("keyword"))
    return patterns.join(named, "pattern")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges ``(a, b)`` is connected with.

    In a round a node takes the least name among its neighbours' names and the
    name of its own name, so names travel ever larger steps.
    """
    both = saved(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "components")
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near")).withColumnRenamed("a", "node")
        up = label.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = saved(label.join(near, "node").join(up, "component").select("node", "component", F.least("component", "near", "up").alias("new")), "components")
        if new.filter("new <> component").isEmpty():
            return label
        label = new.select("node", F.col("new").alias("component"))


def group_patterns(patterns: DataFrame, distance: float) -> DataFrame:
    """Groups of patterns (keyword, group_id) by average linkage at a Jaccard distance, named after their smallest keyword.

    Two groups within the limit have a pair of patterns within it, so groups stay
    inside the components of such pairs; other pairs of a component are made
    there only, and pairs of different components never. A round merges every
    pair of groups that are each other's nearest one (ties: the smaller names),
    if their mean distance is within the limit. With average linkage such merges
    don't disturb each other, so rounds end where single merges would. Pairs
    without a common item have distance 1; they add nothing to the sum of
    similarities, which is what the pair table holds.
    """
    sized = saved(patterns.select(F.col("keyword").alias("group_id")).groupBy("group_id").agg(F.count("*").alias("n")), "groups")
    label = saved(patterns.select("keyword", F.col("keyword").alias("group_id")), "labels")
    within = components(saved(similar_patterns(patterns, max(0.0, 1 - distance)), "near-patterns")).withColumnRenamed("node", "keyword")
    inside = patterns.join(within, "keyword").select("keyword", F.transform("pattern", lambda item: F.struct("component", item.alias("item"))).alias("pattern"))
    sums = saved(similar_patterns(inside).select("a", "b", F.col("similarity").alias("s")), "sums")
    while True:
        own = lambda side: sized.select(F.col("group_id").alias(side), F.col("n").alias("n" + side))
        mean = sums.join(own("a"), "a").join(own("b"), "b").withColumn("mean", F.col("s") / (F.col("na") * F.col("nb"))).filter(F.col("mean") >= 1 - distance - 1e-9)
        sides = mean.select("a", "b", "mean", F.explode(F.array("a", "b")).alias("group_id"))
        first = sides.groupBy("group_id").agg(F.min(F.struct((-F.col("mean")).alias("d"), "a", "b")).alias("m")).select("group_id", "m.a", "m.b")
        merged = saved(first.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n = 2").select("a", "b"), "merges")
        if merged.isEmpty():
            return label
        rename = lambda rows, c: rows.join(merged.select(F.col("b").alias(c), F.col("a").alias("_to")), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
        label = saved(rename(label, "group_id"), "labels")
        sized = saved(rename(sized, "group_id").groupBy("group_id").agg(F.sum("n").alias("n")), "groups")
        moved = rename(rename(sums, "a"), "b").filter("a <> b")
        sums = saved(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s")), "sums")


def clusters_of(keywords: DataFrame, support: DataFrame, copies: DataFrame) -> DataFrame:
    """(keyword, cluster_id): clusters that support a keyword's pattern, replicates ``(cluster_id, replicate)`` included.

    A replicate has one representative, so different (keyword, representative)
    give different rows, and the many replicates go through no further shuffle.
    """
    from locusflow.operators.skew import salted_join

    found = keywords.select("keyword", "pattern").join(support, "pattern").select("keyword", "cluster_id").distinct()
    return salted_join(saved(copies, "replicates"), found, "cluster_id").select("keyword", F.col("replicate").alias("cluster_id"))
