"""Running totals and row numbers within groups of any size.

A window over a group gathers the group in one task. Here the rows are dealt
into ranges of the order instead, each range sums up alone, and the totals of
the ranges before it are added: one small row for each range and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusflow.operators.mining import saved


def running(rows: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` with ``rank`` (from 1) within the group in this order, and the running sum of each expression up to the row.

    The order should be total: of equal rows any comes first. The ranges are
    written, so that both passes see the same ones.
    """
    sums = sums or {}
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    added = {f"_v{i}": c.cast("long") for i, c in enumerate(sums.values())}
    dealt = rows.withColumns(added).repartitionByRange(parts, *(F.col(g) for g in group), *order).withColumn("_part", F.spark_partition_id())
    dealt = saved(dealt, "ranges")
    totals = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_n"), *(F.sum(v).alias(f"_s{v}") for v in added))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(*group, "_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}") for c in totals.columns if c.startswith(("_n", "_s_v"))))
    # a range's rows of one group are in order already, but only its own task knows
    within = Window.partitionBy(*group, "_part").orderBy(*order)
    up_to = within.rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({"_r": F.row_number().over(within), **{f"_c{v}": F.sum(v).over(up_to) for v in added}})
    joined = local.join(earlier.withColumnsRenamed({g: f"_g_{g}" for g in group}).withColumnRenamed("_part", "_p"), [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_part") == F.col("_p")])
    out = {name: F.col(f"_c{v}") + F.col(f"_b_s{v}") for name, v in zip(sums, added, strict=True)}
    return joined.withColumn("rank", (F.col("_r") + F.col("_b_n")).cast("long")).withColumns(out).select(*rows.columns, "rank", *sums)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank``: their number, from 1, in a total order over the whole table."""
    return running(rows.withColumn("_all", F.lit(0)), ["_all"], order).drop("_all")


def quantiles(rows: DataFrame, group: list[str], value: str, at: list[float]) -> DataFrame:
    """(group, q0, q1, ...): exact quantiles of a group's values, between two values in proportion.

    Equal values are counted first; the counts run over ranges of the values, and
    a quantile's two places are the first values whose running count passes them.
    No group's values meet in one task or buffer. Null values don't count.
    """
    counts = saved(rows.filter(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v")).agg(F.count("*").alias("_w")), "value-counts")
    run = running(counts, group, [F.col("_v").asc()], {"_upto": F.col("_w")})
    totals = counts.groupBy(*(F.col(g).alias(f"_g_{g}") for g in group)).agg(F.sum("_w").alias("_total"))
    placed = run.join(totals, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    place = [(F.col("_total") - 1) * p for p in at]
    first = lambda i: F.min(F.when(F.col("_upto") > i, F.col("_v")))
    found = placed.groupBy(*group).agg(*(f(p).alias(f"_{name}{i}") for i, p in enumerate(place) for name, f in (("low", lambda p: first(F.floor(p))), ("high", lambda p: first(F.ceil(p))), ("part", lambda p: F.max(p - F.floor(p))))))
    return found.select(*group, *((F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")).alias(f"q{i}") for i in range(len(at))))
