"""Ward linkage of points, cut at a distance."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusflow.operators.mining import saved

#: Groups that one cell of the neighbour grid may hold before a finer grid starts.
CELL_GROUPS = 500


def ward_distance(na: Column, nb: Column, squared: Column) -> Column:
    """Ward's distance of two groups from their sizes and the squared distance of their means; of two points it is their distance."""
    return F.sqrt(2 * na * nb / (na + nb) * squared)


def ward_groups(points: DataFrame, key: str, features: list[str], threshold: float) -> DataFrame:
    """(key, group_id): groups by Ward linkage, merged while their distance is below ``threshold``; named after their smallest key.

    A group is its size and its mean. Ward's distance is at least the distance
    of the means, so a group's neighbours below the threshold are in its own or
    an adjacent cell of a grid as wide as the threshold. A round merges every
    pair of groups that are each other's nearest one (ties: the smaller names);
    such merges are those of the one-by-one form, apart from ties. Where cells
    are too full for that, rounds start with a part of the threshold and double
    it: merges come in the order of their distance, so a smaller threshold's
    groups are where the larger one goes on. Equal points are one group from
    the start. Rows with a null key or feature take no part.
    """
    given = points.select(F.col(key).alias("_key"), *(F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features))).dropna()
    means = [f"_x{i}" for i in range(len(features))]
    same = given.groupBy(*means).agg(F.min("_key").alias("group_id"), F.count("*").cast("double").alias("n"))
    groups = saved(same, "groups")
    label = saved(given.join(groups.drop("n"), means).select("_key", "group_id"), "labels")
    width = threshold
    while _fullest(groups, means, width) > CELL_GROUPS:
        width /= 2
    while True:
        merged = saved(_mutual(groups, means, width), "merges")
        if not merged.isEmpty():
            moved = merged.select(F.col("b").alias("group_id"), F.col("a").alias("_to"))
            label = saved(label.join(moved, "group_id", "left").select("_key", F.coalesce("_to", "group_id").alias("group_id")), "labels")
            joined = groups.join(moved, "group_id", "left").withColumn("group_id", F.coalesce("_to", "group_id"))
            groups = saved(joined.groupBy("group_id").agg(F.sum("n").alias("n"), *((F.sum(F.col(m) * F.col("n")) / F.sum("n")).alias(m) for m in means)), "groups")
        elif width >= threshold:
            return label.select(F.col("_key").alias(key), "group_id")
        else:
            width = min(2 * width, threshold)


def _cells(means: list[str], width: float) -> list[Column]:
    return [F.floor(F.col(m) / width) for m in means]


def _fullest(groups: DataFrame, means: list[str], width: float) -> int:
    """Groups in the fullest cell of a grid of this width."""
    counts = groups.groupBy(*(c.alias(f"_c{i}") for i, c in enumerate(_cells(means, width)))).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _mutual(groups: DataFrame, means: list[str], width: float) -> DataFrame:
    """(a, b): groups that are each other's nearest one, nearer than ``width``."""
    names = [f"_c{i}" for i in range(len(means))]
    own = groups.withColumns(dict(zip(names, _cells(means, width), strict=True)))
    steps = F.explode(F.array(*(F.array(*map(F.lit, s)) for s in itertools.product((-1, 0, 1), repeat=len(means))))).alias("_s")
    asking = own.select("*", steps).select(
        F.col("group_id").alias("a"), F.col("n").alias("na"), *(F.col(m).alias(f"_a{m}") for m in means), *((F.col(c) + F.col("_s")[i]).alias(c) for i, c in enumerate(names))
    )
    met = asking.join(own.withColumnRenamed("group_id", "b"), names).filter("a <> b")
    squared = sum(((F.col(f"_a{m}") - F.col(m)) * (F.col(f"_a{m}") - F.col(m)) for m in means), F.lit(0.0))
    near = met.withColumn("d", ward_distance(F.col("na"), F.col("n"), squared)).filter(F.col("d") < width)
    # the pair, not the neighbour, decides ties, so that two groups agree on it
    best = near.groupBy("a").agg(F.min(F.struct("d", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))).alias("m"))
    return best.groupBy(F.col("m.lo").alias("a"), F.col("m.hi").alias("b")).agg(F.count("*").alias("n")).filter("n = 2").select("a", "b")
