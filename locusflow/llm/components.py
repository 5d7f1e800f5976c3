"""Connected components of an edge table, by alternating large-star and small-star steps.

Each round replaces edges until every node points at the smallest node of its
component (Kiveris et al., 2014). A round is two aggregations and two joins with
one row for each node on the aggregated side, so a node with very many edges is
never gathered in one task. Rounds are written to the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another node; root is the smallest node reachable.

    Self-loops, repeated edges and either direction are allowed; edges with a
    null end are left out; without edges the result is empty.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    now = saved(edges.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join deals both sides out anew and Spark can split a node with very many edges
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "large-star")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = saved(small.distinct(), "small-star")
        new_state = _state(new)
        now, done, state = new, new_state == state, new_state
        if done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
