"""Similarity hits: filters, scores, and the resolution of overlapping annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusflow.functions import strip_query_suffix


def with_coverage(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Hits with the query's length and self score, and the covered share of the query (null if unknown)."""
    joined = hits.join(queries.select("query_id", "length", "self_score"), "query_id", "left")
    span = F.abs(F.col("send") - F.col("sstart")) + 1
    return joined.withColumn("coverage", F.try_divide(span.cast("double"), F.col("length").cast("double")))


def filter_hits(
    hits: DataFrame, queries: DataFrame, evalue: float = 1e-5, score: float = 100.0, coverage: float = 0.6, identity: float = 25.0, keep_unknown: bool = False
) -> DataFrame:
    """Hits that pass by e-value and score, or by identity; either needs the coverage.

    A hit of a query without a length goes, or stays with ``keep_unknown``.
    """
    covered = F.col("coverage") >= coverage
    passes = ((F.col("evalue") <= evalue) & (F.col("bitscore") >= score) & covered) | ((F.col("pident") >= identity) & covered)
    if keep_unknown:
        passes = passes | F.col("length").isNull()
    return with_coverage(hits, queries).filter(passes)


def score_ratio(hits: DataFrame) -> DataFrame:
    """``bsr``: the score by the query's self score, else the given ratio, else 1."""
    return hits.withColumn("bsr", F.coalesce(F.try_divide(F.col("bitscore"), F.col("self_score")), F.col("bsr"), F.lit(1.0)))


def domain_of(hits: DataFrame) -> DataFrame:
    """``domain``: the query's name without its number."""
    return hits.withColumn("domain", strip_query_suffix("query_id"))


def best_self_scores(hits: DataFrame) -> DataFrame:
    """Best score of each query."""
    return hits.groupBy("query_id").agg(F.max("bitscore").alias("self_score"))


def resolve_overlaps(hits: DataFrame, keys: list[str], order: list[str], best_first: bool = False, force: bool = False) -> DataFrame:
    """One row for each protein with its resolved domains, in start order.

    Hits are taken in ``order``: a new hit takes the place of all it overlaps if
    it beats each of them strictly, else it is dropped (``force``: it always
    does). ``best_first`` takes them by descending score, then start and domain,
    whatever ``order`` says; then the result has no overlaps and no order matters.
    A hit at the start of a kept one takes its place only under the same rule.
    """
    by = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    if best_first:
        by = [(-F.col("bitscore")).alias("o0"), F.col("sstart").alias("o1"), F.col("domain").alias("o2"), F.col("send").alias("o3")]
    item = F.struct(*by, F.col("domain").alias("domain"), F.col("sstart").cast("long").alias("start"), F.col("send").cast("long").alias("end"), F.col("bitscore").alias("score"), F.col("bsr").alias("bsr"))
    folded = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("hits"))
    kind = "array<struct<domain:string,start:bigint,end:bigint,score:double,bsr:double>>"
    plain = F.transform("hits", lambda h: F.struct(h["domain"].alias("domain"), h["start"].alias("start"), h["end"].alias("end"), h["score"].alias("score"), h["bsr"].alias("bsr"))).cast(kind)

    def add(kept, new):
        overlaps = lambda k: (k["start"] <= new["end"]) & (new["start"] <= k["end"])
        loses = F.exists(kept, lambda k: overlaps(k) & (k["score"] >= new["score"])) if not force else F.lit(False)
        return F.when(loses, kept).otherwise(F.concat(F.filter(kept, lambda k: ~overlaps(k)), F.array(new)))

    # a protein with one hit needs no fold
    folded_hits = F.when(F.size("plain") == 1, F.col("plain")).otherwise(F.aggregate("plain", F.array().cast(kind), add))
    by_start = F.transform(F.array_sort(F.transform(folded_hits, lambda d: F.struct(d["start"].alias("s"), d.alias("d")))), lambda x: x["d"])
    return folded.withColumn("plain", plain).select(*keys, by_start.alias("domains"))


def architecture(resolved: DataFrame) -> DataFrame:
    """Texts of a protein's domains, coordinates and scores in start order; distinct domains; their number."""
    field = lambda f: F.array_join(F.transform("domains", f), "-")
    return resolved.select(
        "*",
        field(lambda d: d["domain"]).alias("architecture"),
        field(lambda d: F.concat(d["start"].cast("string"), F.lit(":"), d["end"].cast("string"))).alias("coordinates"),
        field(lambda d: d["score"].cast("long").cast("string")).alias("scores"),
        F.array_sort(F.array_distinct(F.transform("domains", lambda d: d["domain"]))).alias("domain_set"),
        F.size("domains").alias("dom_count"),
    )


def single_domain(resolved: DataFrame) -> DataFrame:
    """Proteins with one domain at most."""
    return resolved.filter(F.size("domains") <= 1)


def attach_features(hits: DataFrame, features: DataFrame) -> DataFrame:
    """Coordinates of each hit protein; without a feature they stay null, so it joins no island."""
    return hits.join(features.select("genome_id", "protein_id", "contig", "start_pos", "end_pos"), ["genome_id", "protein_id"], "left")


def genomes_of(hits: DataFrame, inputs: DataFrame | None = None) -> DataFrame:
    """Genomes named in hit ids (``genome___protein``), only those with inputs if such are given."""
    found = hits.select(F.split("hit_id", "___").getItem(0).alias("genome_id")).distinct()
    return found if inputs is None else found.join(inputs, "genome_id", "left_semi")


def unique_ids(hits: DataFrame) -> DataFrame:
    """If any (hit, query) pair is there twice, every hit id gets its genome in front."""
    twice = hits.groupBy("hit_id", "query_id").agg(F.count("*").alias("n")).agg((F.coalesce(F.max("n"), F.lit(0)) > 1).alias("any_twice"))
    prefixed = F.when(F.col("any_twice"), F.concat_ws("___", "genome_id", "hit_id")).otherwise(F.col("hit_id"))
    return hits.crossJoin(F.broadcast(twice)).withColumn("hit_id", prefixed).drop("any_twice")


def first_per_key(hits: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return hits.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")
