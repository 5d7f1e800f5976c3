"""The store: tables in buckets of a key, sorted within, that grow by rows with new keys.

Rows of a key lie in one bucket, so joins and groups on the key need no exchange
of what is stored. A table is files below a path and an entry in the session's
catalog; ``open_table`` makes the entry for new and for existing files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from locusflow.sources.sinks import first_wins


def open_table(spark: SparkSession, path: str, schema: StructType, key: list[str], order: list[str], buckets: int) -> str:
    """The name under which the table below ``path`` can be read and appended to: bucketed by ``key``, sorted by ``order``."""
    name = f"store_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def _write(spark: SparkSession, name: str, rows: DataFrame, key: list[str], order: list[str], buckets: int) -> None:
    # one task for each bucket, so that an append adds one file to a bucket
    rows.select(*spark.table(name).columns).repartition(buckets, *key).sortWithinPartitions(*key, *order).write.insertInto(name)
    spark.catalog.refreshTable(name)


def append_new(spark: SparkSession, name: str, new: DataFrame, key: list[str], first: list[str], order: list[str], buckets: int) -> None:
    """Adds the rows whose key is not stored yet, of each key the first by ``first``; rows without a whole key are not stored."""
    known = new.dropna(subset=key)
    _write(spark, name, first_wins(known, spark.table(name), key, first), key, order, buckets)


def append_all(spark: SparkSession, name: str, new: DataFrame, key: list[str], order: list[str], buckets: int) -> None:
    """Adds all rows, in the buckets of their key."""
    _write(spark, name, new, key, order, buckets)


def cluster_lists(spark: SparkSession, name: str) -> DataFrame:
    """(cluster_id, types): the domains of each cluster in order of (start, protein), from a table bucketed by ``cluster_id``."""
    own = spark.table(name).groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("start_pos", "protein_id", "domain"))).alias("own"))
    return own.select("cluster_id", F.transform("own", lambda x: x["domain"]).alias("types"))
