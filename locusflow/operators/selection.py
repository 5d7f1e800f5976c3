"""Selection of patterns and their proteins as reference sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusflow.operators.mining import saved
from locusflow.operators.ranges import quantiles
from locusflow.operators.skew import stored_small

PREFIX = "csb-"
#: Domains that a filter names at most.
NAMED_DOMAINS = 1000


def keyword_statistics(keywords: DataFrame, members: DataFrame) -> DataFrame:
    """Number, extremes, mean, median and deviation of the scores of each (keyword, domain)."""
    joined = saved(keywords.select("cluster_id", "keyword").distinct().join(members.select("cluster_id", "domain", "score"), "cluster_id").select("keyword", "domain", "score"), "scored")
    deviation = F.coalesce(F.nanvl(F.stddev_samp("score"), F.lit(None)), F.lit(0.0))
    figures = joined.groupBy("keyword", "domain").agg(F.count("*").alias("n"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.avg("score").alias("mean_score"), deviation.alias("std_score"))
    middle = quantiles(joined, ["keyword", "domain"], "score", [0.5]).withColumnRenamed("q0", "median_score")
    return figures.join(middle, ["keyword", "domain"], "left").select("keyword", "domain", "n", "min_score", "max_score", "mean_score", "median_score", "std_score")


def query_scores(members: DataFrame, genome, how: str = "min") -> DataFrame:
    """A genome's score of each domain: the least one by default, or the greatest."""
    own = members.filter(F.col("genome_id") == F.lit(genome))
    return own.groupBy("domain").agg((F.min if how == "min" else F.max)("score").alias("query_score"))


def exclude_types(keywords: DataFrame, statistics: DataFrame, types: list[str]) -> DataFrame:
    """Keywords without those (with the pattern prefix) that have an excluded domain."""
    bad = statistics.filter(F.col("domain").isin(types) & F.col("keyword").startswith(PREFIX)).select("keyword").distinct()
    return keywords.join(bad, "keyword", "left_anti")


def drop_low_quality(statistics: DataFrame, query: DataFrame, deviation: float = 0.3, min_seqs: int = 10) -> DataFrame:
    """Statistics of keywords that are large enough and have a domain with a median near the query's score.

    Keywords without the pattern prefix need only the size.
    """
    scored = statistics.join(query, "domain", "left")
    good = F.coalesce(F.col("median_score") >= F.col("query_score") * (1 - deviation), F.lit(False))
    kept = scored.groupBy("keyword").agg(F.max("n").alias("most"), F.bool_or(good).alias("good"))
    kept = kept.filter((F.col("most") >= min(10, min_seqs)) & (F.col("good") | ~F.col("keyword").startswith(PREFIX)))
    return statistics.join(kept.select("keyword"), "keyword", "left_semi")


def passing_domains(statistics: DataFrame, query: DataFrame, share: float = 0.7) -> DataFrame:
    """(keyword, domain) whose best score reaches a share of the query's."""
    return statistics.join(query, "domain").filter(F.col("max_score") >= F.col("query_score") * share).select("keyword", "domain")


def passing_keywords(statistics: DataFrame, query: DataFrame, deviation: float = 0.3) -> DataFrame:
    """All (keyword, domain) of keywords with any domain whose best score is near the query's."""
    good = passing_domains(statistics, query, 1 - deviation).select("keyword").distinct()
    return statistics.join(good, "keyword", "left_semi").select("keyword", "domain")


def best_keyword(statistics: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """All rows of the keyword with the highest score of each domain (ties: first by name)."""
    rows = statistics if domains is None else statistics.filter(F.col("domain").isin(domains))
    order = Window.partitionBy("domain").orderBy(F.desc("max_score"), "keyword")
    best = rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("keyword").distinct()
    return statistics.join(best, "keyword", "left_semi")


def score_limits(statistics: DataFrame, selected: DataFrame) -> DataFrame:
    """Least and greatest score of each domain over the selected (keyword, domain)."""
    joined = statistics.join(selected.select("keyword", "domain").distinct(), ["keyword", "domain"], "left_semi")
    return joined.groupBy("domain").agg(F.min("min_score").alias("lower"), F.max("max_score").alias("upper"))


def refset_limits(refset: DataFrame, scores: DataFrame, lower: float = 100.0, upper: float = 2000.0) -> DataFrame:
    """Least and greatest score of a reference set's proteins; the defaults where none has a score."""
    joined = refset.select("domain", "protein_id").distinct().join(scores.select("protein_id", "score"), "protein_id", "left")
    limits = joined.groupBy("domain").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    return limits.select("domain", F.coalesce("lo", F.lit(lower)).alias("lower"), F.coalesce("hi", F.lit(upper)).alias("upper"))


def proteins_of(tasks: DataFrame, keywords: DataFrame, members: DataFrame, min_seqs: int = 1) -> DataFrame:
    """(keyword, domain, protein_id) of the wanted (keyword, domain), only of those with enough proteins."""
    # a cluster's members meet its own keywords; keywords first would give each cluster all domains of its keywords
    placed = members.select("cluster_id", "domain", "protein_id").join(keywords.select("keyword", "cluster_id").distinct(), "cluster_id")
    wanted = stored_small(tasks.select("keyword", "domain").distinct(), "tasks")
    found = placed.join(wanted, ["keyword", "domain"], "left_semi").select("keyword", "domain", "protein_id").distinct()
    if min_seqs <= 1:
        return found
    enough = found.groupBy("keyword", "domain").agg(F.count("*").alias("n")).filter(F.col("n") >= min_seqs).select("keyword", "domain")
    return found.join(enough, ["keyword", "domain"], "left_semi")


def keyword_scores(keywords: DataFrame, members: DataFrame, keyword: str) -> DataFrame:
    """Scores of all domains in the clusters of a keyword."""
    own = keywords.filter(F.col("keyword") == keyword).select("cluster_id").distinct()
    return members.join(own, "cluster_id", "left_semi").select("domain", "score")


def keywords_of(proteins: DataFrame, members: DataFrame, keywords: DataFrame) -> DataFrame:
    """(protein_id, keyword) of the given proteins."""
    clusters = members.select("protein_id", "cluster_id").join(proteins.select("protein_id").distinct(), "protein_id", "left_semi")
    return clusters.join(keywords.select("cluster_id", "keyword"), "cluster_id").select("protein_id", "keyword").distinct()


def numbered_keywords(wanted: DataFrame, keywords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (domain, _k) of wanted ``(domain, keyword)`` and (cluster_id, _k) of the clusters with such keywords, which are numbered."""
    wanted = saved(wanted.select("domain", "keyword").distinct(), "wanted")
    names = stored_small(wanted.select("keyword").distinct().withColumn("_k", F.monotonically_increasing_id()), "keyword-numbers")
    keyed = saved(keywords.select("cluster_id", "keyword").join(names, "keyword").select("cluster_id", "_k").repartition("cluster_id").distinct(), "keyed")
    return stored_small(wanted.join(names, "keyword").select("domain", "_k"), "wanted"), keyed


def members_by_keywords(pairs: DataFrame, keyed: DataFrame, members: DataFrame) -> DataFrame:
    """(domain, protein_id) of the members in clusters of their domain's wanted keywords, as ``numbered_keywords`` gives these."""
    few = [r.domain for r in pairs.select("domain").distinct().limit(NAMED_DOMAINS + 1).collect()]
    own = members.filter(F.col("domain").isin(few)) if len(few) <= NAMED_DOMAINS else members
    # a cluster's members meet its own keywords, so a keyword that many domains want adds no row
    placed = own.select("cluster_id", "domain", "protein_id").join(keyed, "cluster_id")
    return placed.join(pairs, ["domain", "_k"], "left_semi").select("domain", "protein_id")


def extend_by_keywords(refset: DataFrame, wanted: DataFrame, keywords: DataFrame, members: DataFrame) -> DataFrame:
    """The reference set with all proteins of a domain in clusters of the domain's wanted keywords ``(domain, keyword)``."""
    found = members_by_keywords(*numbered_keywords(wanted, keywords), members)
    return found.unionByName(refset.select("domain", "protein_id")).distinct()


def context_free(members: DataFrame, identity: float = 70.0) -> DataFrame:
    """(domain, protein_id, genome_id) of proteins in no cluster and of high identity."""
    return members.filter(F.col("cluster_id").isNull() & (F.col("identity") >= identity)).select("domain", "protein_id", "genome_id").distinct()


def add_queries(refset: DataFrame, queries: DataFrame) -> DataFrame:
    """The query proteins of the domains that are there, added back."""
    own = queries.select("domain", "protein_id").join(refset.select("domain").distinct(), "domain", "left_semi")
    return refset.select("domain", "protein_id").unionByName(own).distinct()


def include_domains(refset: DataFrame, domains: list[str]) -> DataFrame:
    return refset.filter(F.col("domain").isin(domains)) if domains else refset


def exclude_domains(refset: DataFrame, domains: list[str]) -> DataFrame:
    return refset.filter(~F.col("domain").isin(domains)) if domains else refset


def drop_query_only(refset: DataFrame, members: DataFrame, query_genome) -> DataFrame:
    """Groups with a member outside the query genome."""
    other = members.filter(F.col("genome_id") != F.lit(query_genome)).select("protein_id").distinct()
    domains = refset.join(other, "protein_id", "left_semi").select("domain").distinct()
    return refset.join(domains, "domain", "left_semi")


def query_owned(refset: DataFrame, members: DataFrame, query_genome) -> DataFrame:
    """Groups of domains that the query genome has."""
    own = members.filter(F.col("genome_id") == F.lit(query_genome)).select("domain").distinct()
    return refset.join(own, "domain", "left_semi")


def top_by_score(refset: DataFrame, scores: DataFrame, n: int, limits: DataFrame | None = None) -> DataFrame:
    """The best ``n`` proteins of each domain within its limits, and all that tie with the last."""
    joined = refset.select("domain", "protein_id").distinct().join(scores.select("protein_id", "score"), "protein_id")
    if limits is not None:
        joined = joined.join(limits, "domain").filter((F.col("score") >= F.col("lower")) & (F.col("score") <= F.col("upper")))
    order = Window.partitionBy("domain").orderBy(F.desc("score"))
    return joined.withColumn("_r", F.rank().over(order)).filter(F.col("_r") <= n).select("domain", "protein_id", "score")
