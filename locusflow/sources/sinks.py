"""Writers: the store's tables, FASTA files and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(new: DataFrame, stored: DataFrame | None, keys: list[str], order: list[str]) -> DataFrame:
    """Rows whose key is not stored yet, of each key the first in an order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    one = new.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")
    return one if stored is None else one.join(stored.select(*keys).distinct(), keys, "left_anti")


def with_clusters(proteins: DataFrame, members: DataFrame) -> DataFrame:
    """Proteins with the key of their cluster, null without one."""
    return proteins.join(members.select("genome_id", "protein_id", "cluster_id").distinct(), ["genome_id", "protein_id"], "left")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def drop_keywords(keywords: DataFrame, prefix: str = "csb-", suffix: str = "_") -> DataFrame:
    """Keywords that don't open with the prefix and end with the suffix; both are plain text."""
    return keywords.filter(~(F.col("keyword").startswith(prefix) & F.col("keyword").endswith(suffix)))


def rename_domain(domains: DataFrame, proteins: DataFrame, new_name: str) -> DataFrame:
    """Domains with another name for the given proteins."""
    marked = domains.join(proteins.select("protein_id").distinct().withColumn("_hit", F.lit(True)), "protein_id", "left")
    return marked.withColumn("domain", F.when(F.col("_hit"), F.lit(new_name)).otherwise(F.col("domain"))).drop("_hit")


def training_sequences(refset: DataFrame, sequences: DataFrame, min_seqs: int = 5, max_seqs: int = 1000, hard_cap: int = 0, seed: int = 42) -> DataFrame:
    """(domain, protein_id, sequence) of groups of at least ``min_seqs``.

    A group above ``max_seqs + hard_cap`` is a sample of ``max_seqs``, in order
    of a hash of protein and seed (sampling is the feature).
    """
    there = refset.select("domain", "protein_id").distinct().join(sequences.select("protein_id"), "protein_id")
    sizes = there.groupBy("domain").agg(F.count("*").alias("_size")).filter(F.col("_size") >= min_seqs)
    sized = there.join(sizes, "domain")
    # only ids are ranked, and only in groups that are sampled; each task ranks its own rows first
    order = Window.partitionBy("domain").orderBy(F.xxhash64("protein_id", F.lit(seed)), "protein_id")
    large = sized.filter(F.col("_size") > max_seqs + hard_cap).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= max_seqs)
    chosen = sized.filter(F.col("_size") <= max_seqs + hard_cap).select("domain", "protein_id").unionByName(large.select("domain", "protein_id"))
    return chosen.join(sequences.select("protein_id", "sequence"), "protein_id").select("domain", "protein_id", "sequence")


def domain_sequences(members: DataFrame, sequences: DataFrame, domain: str | None = None, query_genome="QUERY") -> DataFrame:
    """Sequences of all proteins with a domain, or of all that are not of the query genome."""
    own = members.filter(F.col("domain") == domain) if domain else members.filter(F.col("genome_id") != F.lit(query_genome))
    return own.select("genome_id", "protein_id").distinct().join(sequences, ["genome_id", "protein_id"])


def write_fasta(rows: DataFrame, path: str, group: str = "domain") -> None:
    """One folder of FASTA text for each group."""
    record = F.concat(F.lit(">"), F.col("protein_id").cast("string"), F.lit("\n"), F.col("sequence"))
    rows.select(F.col(group).alias("group"), record.alias("value")).write.partitionBy("group").text(path)


def composition_report(neighbourhoods: DataFrame, as_set: bool = False) -> DataFrame:
    """(count, size, composition): neighbourhoods as texts with their counts, for ``write_table``."""
    from locusflow.operators.neighbours import compositions

    found = compositions(neighbourhoods, as_set)
    return found.select(F.col("n").alias("count"), F.size("composition").alias("size"), "composition")


def grouped_pattern_report(patterns: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, keywords, patterns): one line for each group of patterns, its members and all their items."""
    joined = patterns.join(groups, "keyword")
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("pattern"))))
    return joined.groupBy("group_id").agg(F.array_sort(F.collect_set("keyword")).alias("keywords"), items.alias("items"))


def write_table(rows: DataFrame, path: str) -> None:
    """Tab-separated text with a header; arrays are joined by blanks."""
    flat = [F.array_join(c, " ").alias(c) if kind.startswith("array") else F.col(c) for c, kind in rows.dtypes]
    rows.select(*flat).write.option("sep", "\t").option("header", True).csv(path)
