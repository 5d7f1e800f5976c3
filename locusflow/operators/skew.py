"""Joins on keys of which a few hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusflow.operators.mining import saved

#: Rows of one key that are never dealt out.
LEAST_ROWS = 10_000
#: Rows of a table that joins broadcast at most.
SMALL_ROWS = 500_000


def stored_small(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a stored table, to be broadcast in joins as long as it has few rows; a larger one is shuffled."""
    table = saved(rows, name)
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, _parts): keys with more than a quarter of a shuffle partition's share of the rows, and into how many parts they go.

    There are four times as many as shuffle partitions at most, whatever the
    number of rows, so the table can be broadcast.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = saved(rows.groupBy(key).agg(F.count("*").alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(LEAST_ROWS, -(-total // (4 * parts)))
    return counts.filter(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))


def dealt(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_salt``: the part of its key that a row goes to, by the hash of the row; 0 for other keys."""
    salt = F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_parts").cast("long")), F.lit(0)).cast("int")
    return rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_parts")


def salted_join(rows: DataFrame, other: DataFrame, key: str, how: str = "inner", where: Column | None = None) -> DataFrame:
    """``rows`` joined with ``other`` on ``key``, hot keys of ``rows`` in parts, each of which meets the key's rows of ``other``.

    ``rows`` is read twice: pass a stored table. ``how``: ``inner`` or
    ``left_semi``; ``where`` further restricts the pairs, by columns that only
    one side has.
    """
    hot = hot_keys(rows, key)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)).alias("_to")
    spread = other.join(F.broadcast(hot), key, "left").select(F.col(key).alias("_other"), *(c for c in other.columns if c != key), copies)
    met = (F.col(key) == F.col("_other")) & (F.col("_salt") == F.col("_to"))
    return dealt(rows, hot, key).join(spread, met if where is None else met & where, how).drop("_salt", "_other", "_to")


def frequent_join(rows: DataFrame, table: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` joined with a stored ``table`` that has each key once and, as ``n``, how many rows about have it.

    Keys of most rows are broadcast, down to the power of two at which they are
    ``SMALL_ROWS`` at most, so that only rows of the rarer keys are shuffled.
    ``rows`` is made twice if there are more keys than that.
    """
    if table.count() <= SMALL_ROWS:
        return rows.join(F.broadcast(table), key)
    level = F.floor(F.log2(F.greatest(F.col(n), F.lit(1))))
    counts = sorted(((r[0], r[1]) for r in table.groupBy(level).count().collect()), reverse=True)
    least, total = None, 0
    for at, count in counts:
        total += count
        if total > SMALL_ROWS:
            break
        least = at
    if least is None:
        return rows.join(table, key)
    often = table.filter(level >= least)
    rest = rows.join(F.broadcast(often.select(key)), key, "left_anti")
    return rows.join(F.broadcast(often), key).unionByName(rest.join(table.filter(level < least), key))
