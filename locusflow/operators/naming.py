"""Names of patterns for islands, by the share of a pattern's items that an island has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.operators.mining import saved
from locusflow.operators.ranges import numbered
from locusflow.operators.skew import salted_join


def name_islands(found: DataFrame, patterns: DataFrame, min_completeness: float = 0.5, min_types: int = 1, exact: bool = False) -> DataFrame:
    """(cluster_id, keyword, completeness, missing, additional) for islands ``(cluster_id, types)`` and patterns ``(keyword, pattern)``.

    An island with enough of a pattern's n items has one of any n - enough + 1
    of them, so a pattern is posted at its rarest so many items only, and pairs
    meet at the first of these that the island has. Items that very many islands
    have are met in parts. ``min_types`` asks for more different types in the
    island, ``exact`` for complete patterns.
    """
    islands = found.select("cluster_id", F.array_sort(F.array_distinct("types")).alias("types")).filter(F.size("types") >= min_types)
    wanted = patterns.select("keyword", F.array_sort(F.array_distinct("pattern")).alias("pattern"))
    have = saved(islands.select("cluster_id", "types", F.explode("types").alias("item")), "island-items")
    held = have.groupBy("item").agg(F.count("*").alias("f"))
    counted = wanted.select("keyword", "pattern", F.explode("pattern").alias("item")).join(held, "item", "left")
    ranked = counted.groupBy("keyword", "pattern").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "item"))).alias("by"))
    n = F.size("pattern")
    enough = n if exact else F.greatest(F.ceil(n * min_completeness - 1e-9), F.lit(1)).cast("int")
    posted = ranked.select("keyword", "pattern", F.transform(F.slice("by", 1, n - enough + 1), lambda x: x["item"]).alias("head")).select("*", F.explode("head").alias("item"))
    common = F.size(F.array_intersect("types", "pattern"))
    first = F.get(F.array_intersect("head", "types"), F.lit(0))
    pairs = salted_join(have, posted, "item").filter(F.col("item") == first).withColumn("completeness", common / n)
    kept = pairs.filter(F.col("completeness") >= (1.0 if exact else min_completeness))
    return kept.select("cluster_id", "keyword", "completeness", F.array_except("pattern", "types").alias("missing"), F.array_except("types", "pattern").alias("additional"))


def item_frequency(patterns: DataFrame) -> DataFrame:
    """Number of different patterns that hold each item."""
    return patterns.select("keyword", F.explode("pattern").alias("item")).distinct().groupBy("item").agg(F.count("*").alias("n"))


def item_rank(patterns: DataFrame) -> DataFrame:
    """Rank of items, the rarest first, then by name."""
    return numbered(item_frequency(patterns), [F.col("n").asc(), F.col("item").asc()])


def rarest_item_candidates(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """(cluster_id, keyword): islands that hold a pattern's rarest item; an item of very many islands is met in parts."""
    counted = patterns.select("keyword", F.explode("pattern").alias("item")).distinct().join(item_frequency(patterns), "item")
    head = counted.groupBy("keyword").agg(F.min(F.struct("n", "item")).alias("m")).select("keyword", "m.item")
    have = saved(found.select("cluster_id", F.explode(F.array_distinct("types")).alias("item")), "island-items")
    return salted_join(have, head, "item").select("cluster_id", "keyword")
