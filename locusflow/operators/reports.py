"""Reports over confusion counts, neighbourhoods and taxa."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusflow.functions import canonical
from locusflow.operators.mining import saved
from locusflow.operators.ranges import quantiles

LABELS = ("TP", "FP", "FN", "TN")
CUTOFFS = ("optimized", "trusted", "noise")


def roc_points(report: DataFrame, cuts: DataFrame) -> DataFrame:
    """Mean rates of each different score of the hit report, and which cutoffs it is the closest one at or above.

    A missing trusted cutoff is below all scores, so the least one is marked.
    """
    tpr = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    fpr = F.coalesce(F.try_divide(F.col("fp").cast("double"), (F.col("fp") + F.col("tn")).cast("double")), F.lit(0.0))
    points = report.groupBy("model", "bitscore").agg(F.avg(fpr).alias("fpr"), F.avg(tpr).alias("tpr"))
    names = ("optimized", "trusted", "noise")
    joined = points.join(cuts.select("model", *names), "model")
    nearest = joined.groupBy("model").agg(*(F.min(F.when(F.coalesce(F.col("bitscore") >= F.col(n), F.lit(True)), F.col("bitscore"))).alias(f"at_{n}") for n in names))
    joined = joined.join(nearest, "model")
    marks = [F.when(F.col("bitscore") == F.col(f"at_{n}"), F.lit(n)) for n in names]
    return joined.select("model", "bitscore", "fpr", "tpr", F.concat_ws(",", *marks).alias("marks"))


def mcc_curve(report: DataFrame) -> DataFrame:
    """The first row of each different score of the hit report: (model, bitscore, mcc)."""
    first = report.groupBy("model", "bitscore").agg(F.min(F.struct("rank", "mcc")).alias("m"))
    return first.select("model", "bitscore", F.col("m.mcc").alias("mcc"))


def confusion_by_neighbourhood(labelled: DataFrame, neighbourhoods: DataFrame, label: str = "label") -> DataFrame:
    """Counts of each label by neighbourhood, a neighbourhood and its reverse as one, with totals."""
    joined = labelled.join(neighbourhoods, "protein_id").withColumn("canonical", canonical("neighbourhood"))
    counts = [F.count_if(F.col(label) == x).alias(x.lower()) for x in LABELS]
    return joined.groupBy(F.array_join("canonical", "/").alias("neighbourhood")).agg(*counts, F.count("*").alias("total"))


def confusions(report: DataFrame, neighbourhoods: DataFrame) -> DataFrame:
    """(model, cutoff, neighbourhood, tp, fp, fn, tn, total): the hit report's assignments at each cutoff by neighbourhood.

    A neighbourhood and its reverse are one; hits without one are singletons.
    """
    around = neighbourhoods.select(F.col("protein_id").alias("hit_id"), "neighbourhood")
    placed = report.join(around, "hit_id", "left").withColumn("neighbourhood", F.array_join(canonical(F.coalesce("neighbourhood", F.array(F.lit("singleton")))), "/"))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("cutoff"), F.col(f"at_{c}").alias("label")) for c in CUTOFFS))).alias("e")
    counts = [F.count_if(F.col("e.label") == x).alias(x.lower()) for x in LABELS]
    return placed.select("model", "neighbourhood", each).groupBy("model", F.col("e.cutoff").alias("cutoff"), "neighbourhood").agg(*counts, F.count("*").alias("total"))


def confusion_by_label(rows: DataFrame, cutoff: float) -> DataFrame:
    """Counts by neighbourhood text; rows ``(neighbourhood, bitscore, is_tp, above_noise)`` below the noise are true negatives."""
    kind = F.when(~F.col("above_noise"), F.lit("TN")).otherwise(
        F.when(F.col("bitscore") >= cutoff, F.when(F.col("is_tp"), F.lit("TP")).otherwise(F.lit("FP"))).otherwise(F.when(F.col("is_tp"), F.lit("FN")).otherwise(F.lit("TN")))
    )
    wide = rows.withColumn("kind", kind).groupBy("neighbourhood").pivot("kind", list(LABELS)).count().na.fill(0)
    return wide.select("neighbourhood", *(F.col(x).alias(x.lower()) for x in LABELS))


def positives_only(confusion: DataFrame) -> DataFrame:
    return confusion.filter((F.col("tp") > 0) | (F.col("fn") > 0))


def top_neighbourhoods(confusion: DataFrame, n: int) -> DataFrame:
    """The ``n`` neighbourhoods with the largest totals, ties by text (a top-k report)."""
    return confusion.orderBy(F.desc("total"), "neighbourhood").limit(n)


def enriched(labelled: DataFrame, neighbourhoods: DataFrame, genomes: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Labelled hits with neighbourhood and taxonomy."""
    placed = labelled.join(neighbourhoods, "protein_id", "left").join(genomes.select("protein_id", "genome_id").distinct(), "protein_id", "left")
    return placed.join(taxonomy, "genome_id", "left")


def taxon_distribution(scored: DataFrame, rank: str) -> DataFrame:
    """Box figures of the scores of each taxon of a rank; a taxon may hold nearly all rows."""
    rows = saved(scored.select(F.coalesce(rank, F.lit("NA")).alias("taxon"), "score"), "taxa")
    ends = rows.groupBy("taxon").agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
    quarters = quantiles(rows, ["taxon"], "score", [0.25, 0.5, 0.75])
    return ends.join(quarters, "taxon", "left").select("taxon", "n", "low", F.col("q0").alias("q1"), F.col("q1").alias("q2"), F.col("q2").alias("q3"), "high")


def deepest_rank(taxonomy: DataFrame, ranks: list[str], max_groups: int) -> DataFrame:
    """One row: the deepest rank (the last of ``ranks``) with at most ``max_groups`` different values, else the first."""
    counts = taxonomy.agg(*(F.count_distinct(r).alias(r) for r in ranks))
    chosen = F.lit(ranks[0])
    for r in ranks:
        chosen = F.when(F.col(r) <= max_groups, F.lit(r)).otherwise(chosen)
    return counts.select(*ranks, chosen.alias("rank"))


def genome_counts(taxonomy: DataFrame, ranks: list[str]) -> DataFrame:
    """Genomes of each value of each rank, one row for each, in one job of grouping sets."""
    grouped = taxonomy.groupingSets([[F.col(r)] for r in ranks], *(F.col(r) for r in ranks)).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    width = len(ranks)
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, r in enumerate(ranks):
        own = F.col("gid") == ((1 << width) - 1 - (1 << (width - 1 - i)))
        name = F.when(own, F.lit(r)).otherwise(name)
        value = F.when(own, F.col(r)).otherwise(value)
    return grouped.select(name.alias("rank"), value.alias("value"), "n")


def hit_counts(labelled: DataFrame) -> DataFrame:
    """How often, and with which least score, each hit has each label over the folds."""
    return labelled.groupBy("label", "hit_id").agg(F.count("*").alias("n"), F.min("bitscore").alias("min_score"))


def cluster_report(metrics: DataFrame) -> DataFrame:
    """Cluster sizes and reference counts with a class: pure, mixed, or without a reference."""
    kind = F.when(F.col("n_ref") == 0, "no_reference").when(F.col("n_ref") == F.col("size"), "pure").otherwise("mixed")
    return metrics.select("family", "rep_id", "size", "n_ref", "density", kind.alias("class"))


def set_composition(refs: DataFrame, clusters: DataFrame) -> DataFrame:
    """For each family: references, members, both, and members that are no reference."""
    a = refs.select("family", F.col("protein_id").alias("id")).distinct().withColumn("r", F.lit(1))
    b = clusters.select("family", F.col("member_id").alias("id")).distinct().withColumn("m", F.lit(1))
    joined = a.join(b, ["family", "id"], "full")
    both = F.count_if(F.col("r").isNotNull() & F.col("m").isNotNull())
    return joined.groupBy("family").agg(F.count("r").alias("references"), F.count("m").alias("members"), both.alias("both"), (F.count("m") - both).alias("new"))


def record_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def cutoff_table(cuts: DataFrame) -> DataFrame:
    """Cutoffs of each model, in order of the model."""
    return cuts.select("model", "optimized", "trusted", "noise", "mcc").orderBy("model")


def tree_annotation(labelled: DataFrame) -> DataFrame:
    """(hit_id, 1) lines for tree viewers."""
    return labelled.select("hit_id").distinct().select(F.concat(F.col("hit_id").cast("string"), F.lit(",1")).alias("value"))
