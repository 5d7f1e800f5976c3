"""Selection of sequence clusters and validation of models by ranked scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusflow.functions import balanced_accuracy, f1, mcc
from locusflow.operators.ranges import running

EXTRA_TN = 0.6
#: The grid of thresholds, in thousandths: its first points, five apart, and how many there are.
FIRST_FRACTION, FRACTIONS = 1, 202
FIRST_DENSITY, DENSITIES = 10, 200


# ---- cluster selection --------------------------------------------------------


def cluster_metrics(clusters: DataFrame, refs: DataFrame) -> DataFrame:
    """(family, rep_id, size, n_ref, density, fraction) of clusters ``(family, rep_id, member_id)``.

    density: references among the members; fraction: share of all references of the family.
    """
    own = refs.select("family", F.col("protein_id").alias("member_id")).distinct()
    total = own.groupBy("family").agg(F.count("*").alias("all_ref"))
    flagged = clusters.distinct().join(own.withColumn("is_ref", F.lit(1)), ["family", "member_id"], "left")
    sized = flagged.groupBy("family", "rep_id").agg(F.count("*").alias("size"), F.count("is_ref").alias("n_ref")).join(total, "family")
    return sized.withColumn("density", F.col("n_ref") / F.col("size")).withColumn("fraction", F.col("n_ref") / F.col("all_ref"))


def select_clusters(clusters: DataFrame, refs: DataFrame, density: float = 0.1, fraction: float = 0.01) -> DataFrame:
    """(family, protein_id): references and all members of clusters that reach both thresholds."""
    good = cluster_metrics(clusters, refs).filter((F.col("density") >= density) & (F.col("fraction") >= fraction)).select("family", "rep_id")
    found = clusters.join(good, ["family", "rep_id"], "left_semi").select("family", F.col("member_id").alias("protein_id"))
    return found.unionByName(refs.select("family", "protein_id")).distinct()


def with_reference(clusters: DataFrame, refs: DataFrame) -> DataFrame:
    """All members of clusters that hold a reference."""
    own = refs.select("family", F.col("protein_id").alias("member_id")).distinct()
    good = clusters.join(own, ["family", "member_id"], "left_semi").select("family", "rep_id").distinct()
    return clusters.join(good, ["family", "rep_id"], "left_semi")


def threshold_grid(clusters: DataFrame, refs: DataFrame) -> DataFrame:
    """Best thresholds of each family by F1: fraction 0.001 to 1.006 and density 0.01 to 1.005 in steps of 0.005.

    Of equal F1 the last grid point in (fraction, density) order stays. Clusters
    are counted in the cell of the last grid point that they reach. A summed-area
    table follows from running sums along one axis and then the other, over rows
    for the columns of cells that have clusters: between two of these the counts
    stay, and the last grid point with them is such a column. So a family has
    ``FRACTIONS x DENSITIES`` rows at most, however many clusters there are.
    """

    def last_reached(c: str, first: int, steps: int) -> Column:
        # grid points are whole thousandths; the nearest one is reached or the one before it
        near = F.round((F.col(c) * 1000 - first) / 5)
        return F.least(near - F.when((near * 5 + first) / 1000 > F.col(c), 1).otherwise(0), F.lit(steps - 1)).cast("int")

    metrics = cluster_metrics(clusters, refs).filter("n_ref > 0")
    placed = metrics.withColumns({"cx": last_reached("fraction", FIRST_FRACTION, FRACTIONS), "cy": last_reached("density", FIRST_DENSITY, DENSITIES)}).filter("cx >= 0 and cy >= 0")
    cells = placed.groupBy("family", "all_ref", "cx", "cy").agg(F.sum("n_ref").alias("tp"), F.sum(F.col("size") - F.col("n_ref")).alias("fp"))
    empty = cells.select("family", "all_ref", "cx").distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(DENSITIES - 1))).alias("cy"), F.lit(0).alias("tp"), F.lit(0).alias("fp"))
    dense = cells.unionByName(empty).groupBy("family", "all_ref", "cx", "cy").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    along = Window.partitionBy("family", "cx").orderBy(F.desc("cy"))
    across = Window.partitionBy("family", "cy").orderBy(F.desc("cx"))
    summed = dense.withColumns({c: F.sum(c).over(along) for c in ("tp", "fp")}).withColumns({c: F.sum(c).over(across) for c in ("tp", "fp")}).filter("tp > 0")
    scored = summed.withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("all_ref") - F.col("tp")))
    best = scored.groupBy("family").agg(F.max(F.struct("f1", "cx", "cy")).alias("m"))
    return best.select("family", ((F.col("m.cx") * 5 + FIRST_FRACTION) / 1000).alias("fraction"), ((F.col("m.cy") * 5 + FIRST_DENSITY) / 1000).alias("density"), F.col("m.f1").alias("f1"))


# ---- cutoffs --------------------------------------------------------------------


def sweep(scores: DataFrame, true_negatives: DataFrame | None = None) -> DataFrame:
    """Running confusion counts and MCC of each model over its hits by descending score.

    Of a hit that is there twice the better row stays; ties go by hit. TN starts
    at ``true_negatives(model, n)``, else at the hits that are no true positive.
    The counts run over ranges of scores, so a model's hits need not fit a task.
    """
    by_hit = Window.partitionBy("model", "hit_id").orderBy(F.desc("bitscore"))
    once = scores.withColumn("_n", F.row_number().over(by_hit)).filter("_n = 1").drop("_n")
    totals = once.groupBy("model").agg(F.count_if("is_tp").alias("all_tp"), F.count_if(~F.col("is_tp")).alias("all_tn"))
    if true_negatives is not None:
        totals = totals.drop("all_tn").join(true_negatives.withColumnRenamed("n", "all_tn"), "model")
    run = running(once, ["model"], [F.desc("bitscore"), F.col("hit_id").asc()], {"tp": F.col("is_tp")}).withColumn("fp", F.col("rank") - F.col("tp"))
    run = run.join(totals, "model").withColumn("fn", F.col("all_tp") - F.col("tp")).withColumn("tn", F.col("all_tn") - F.col("fp"))
    return run.withColumn("mcc", mcc(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def _counted() -> Column:
    """Rows down to the last true positive; of a model without one the first row."""
    return (F.col("fn") > 0) | F.col("is_tp") | (F.col("rank") == 1)


def cutoffs(swept: DataFrame) -> DataFrame:
    """(model, optimized, trusted, noise, mcc, tp, fp, fn, tn) of each model.

    optimized: the score of the first greatest MCC; trusted: the last true
    positive's before the first false one (null if there is none); noise: the
    score at which the last true positive is found. Rows after the last true
    positive don't count.
    """
    best = F.max(F.struct("mcc", (-F.col("rank")).alias("r"), "bitscore", "tp", "fp", "fn", "tn")).alias("m")
    found = swept.filter(_counted()).groupBy("model").agg(best, F.min(F.when(F.col("is_tp") & (F.col("fp") == 0), F.col("bitscore"))).alias("trusted"), F.min("bitscore").alias("noise"))
    return found.select("model", F.col("m.bitscore").alias("optimized"), "trusted", "noise", *(F.col(f"m.{c}").alias(c) for c in ("mcc", "tp", "fp", "fn", "tn")))


def label_hits(swept: DataFrame, cuts: DataFrame, extra: float = EXTRA_TN) -> DataFrame:
    """The hit report: every hit with its counts, its MCC and its assignment at the three cutoffs.

    Hits after the last true positive stay down to ``extra`` times the noise
    cutoff, as true negatives with the counts of that positive and the best MCC;
    further ones go. Without a trusted cutoff every hit is above it.
    """
    marked = swept.select("model", "hit_id", "bitscore", "rank", "is_tp", "tp", "fp", "fn", "tn", "mcc", _counted().alias("above_noise"))
    # the counts run one way, so those of the last counted row are the extreme ones
    ends = {"tp": F.max, "fp": F.max, "fn": F.min, "tn": F.min}
    last = marked.filter("above_noise").groupBy("model").agg(*(f(c).alias(f"last_{c}") for c, f in ends.items()))
    joined = marked.join(cuts.select("model", "optimized", "trusted", "noise", F.col("mcc").alias("best_mcc")), "model").join(last, "model")
    kept = joined.filter(F.col("above_noise") | (F.col("bitscore") >= F.col("noise") * extra))

    def at(cut):
        above = F.coalesce(F.col("bitscore") >= F.col(cut), F.lit(True))
        own = F.when(above, F.when(F.col("is_tp"), "TP").otherwise("FP")).otherwise(F.when(F.col("is_tp"), "FN").otherwise("TN"))
        return F.when(F.col("above_noise"), own).otherwise("TN")

    frozen = lambda c, end: F.when(F.col("above_noise"), F.col(c)).otherwise(F.col(end)).alias(c)
    counts = [frozen(c, f"last_{c}") for c in ends]
    return kept.select(
        "model", "hit_id", "bitscore", "rank", "is_tp", *counts, frozen("mcc", "best_mcc"), at("optimized").alias("at_optimized"), at("trusted").alias("at_trusted"), at("noise").alias("at_noise"), "above_noise"
    )


def folds(refs: DataFrame, k: int = 5) -> DataFrame:
    """(family, protein_id, fold): contiguous folds of n div k in order of id; the rest has fold k and is never held out."""
    rows = refs.select("family", "protein_id").distinct()
    sizes = rows.groupBy("family").agg(F.floor(F.count("*") / k).alias("_size"))
    ordered = running(rows, ["family"], [F.col("protein_id").asc()]).join(sizes, "family")
    fold = F.when(F.col("_size") == 0, F.lit(k)).otherwise(F.least(F.floor((F.col("rank") - 1) / F.greatest(F.col("_size"), F.lit(1))), F.lit(k)))
    return ordered.select("family", "protein_id", fold.cast("int").alias("fold"))


def fold_summary(fold_cutoffs: DataFrame, floor: float = 10.0) -> DataFrame:
    """Of a model's folds the highest trusted, the lowest noise and the optimized cutoff of the best MCC (then the lower one)."""
    best = F.max(F.struct("mcc", (-F.col("optimized")).alias("o"))).alias("m")
    found = fold_cutoffs.groupBy("model").agg(F.max("trusted").alias("trusted"), F.min("noise").alias("noise"), best)
    low = F.lit(floor)
    return found.select("model", F.greatest(-F.col("m.o"), low).alias("optimized"), F.greatest("trusted", low).alias("trusted"), F.greatest("noise", low).alias("noise"))


def sum_matrices(fold_matrices: DataFrame) -> DataFrame:
    """Summed confusion counts of each model."""
    return fold_matrices.groupBy("model").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")))


def performance(fold_matrices: DataFrame) -> DataFrame:
    """Mean balanced accuracy of the folds, F1 and MCC of the summed matrix, in order of MCC."""
    counts = [F.col(c) for c in ("tp", "fp", "fn", "tn")]
    accuracy = fold_matrices.groupBy("model").agg(F.avg(balanced_accuracy(*counts)).alias("balanced_accuracy"))
    summed = sum_matrices(fold_matrices).withColumn("f1", f1(*counts[:3])).withColumn("mcc", mcc(*counts))
    return summed.join(accuracy, "model")
