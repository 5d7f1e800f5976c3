"""Synteny islands: runs of neighbouring genes on a contig."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusflow.functions import strip_group_prefix


def island_members(genes: DataFrame, distance: int = 3500, min_genes: int = 2) -> DataFrame:
    """Genes of islands, with the island's number within its genome (from 1) and its key.

    A gene goes on with the island if it starts at most ``distance`` after the
    end of the gene before it on the contig. Genes without a contig are in none.
    """
    by_start = Window.partitionBy("genome_id", "contig").orderBy("start_pos", "protein_id")
    gap = F.col("start_pos") - F.lag("end_pos").over(by_start)
    marked = genes.filter(F.col("contig").isNotNull()).withColumn("_new", F.coalesce((gap > distance).cast("int"), F.lit(1)))
    runs = marked.withColumn("_run", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    sized = runs.withColumn("_size", F.count("*").over(Window.partitionBy("genome_id", "contig", "_run"))).filter(F.col("_size") >= min_genes)
    number = F.dense_rank().over(Window.partitionBy("genome_id").orderBy("contig", "_run"))
    return sized.withColumn("island", number.cast("long")).withColumn("cluster_id", F.concat_ws("_", "genome_id", "island")).drop("_new", "_run", "_size")


def islands(members: DataFrame) -> DataFrame:
    """Extent and ordered gene and type lists of each island."""
    item = F.array_sort(F.collect_list(F.struct("start_pos", "protein_id", "domain")))
    grouped = members.groupBy("cluster_id", "genome_id", "contig").agg(F.min("start_pos").alias("lo"), F.max("end_pos").alias("hi"), item.alias("own"))
    return grouped.select(
        "cluster_id", "genome_id", "contig", "lo", "hi", F.transform("own", lambda x: x["protein_id"]).alias("genes"), F.transform("own", lambda x: x["domain"]).alias("types")
    )


def type_lists(found: DataFrame) -> DataFrame:
    """Types with group prefixes and multi-domain types taken apart, as list and as sorted set."""
    parts = F.flatten(F.transform("types", lambda t: F.transform(F.split(t, "-"), lambda d: strip_group_prefix(d))))
    return found.withColumn("type_list", parts).withColumn("type_set", F.array_sort(F.array_distinct(parts)))


def covered_proteins(members: DataFrame, patterns: DataFrame) -> DataFrame:
    """Members whose domain is an item of the pattern their cluster has: (cluster_id, keyword, protein_id)."""
    items = patterns.select("cluster_id", "keyword", F.explode("pattern").alias("domain")).distinct()
    return members.join(items, ["cluster_id", "domain"]).select("cluster_id", "keyword", "protein_id").distinct()
