"""Presence and absence of domains over genomes, and what it says about hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusflow.operators.mining import in_slices, saved
from locusflow.operators.skew import stored_small

#: Sums of Hessians that one round of the logistic models sends to the driver.
HESSIAN_CELLS = 4_000_000


def presence(refset: DataFrame, proteins: DataFrame) -> DataFrame:
    """(genome_id, domain, proteins): which proteins of a reference set each genome has."""
    return _placed(refset, proteins).groupBy("genome_id", "domain").agg(F.array_sort(F.collect_list("protein_id")).alias("proteins"))


def _placed(refset: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, domain, genome_id) of a reference set; each side is shuffled once, by protein, and made different there."""
    own = refset.select("protein_id", "domain").repartition("protein_id").distinct()
    return own.join(proteins.select("protein_id", "genome_id").repartition("protein_id").distinct(), "protein_id")


def presence_wide(pam: DataFrame, domains: list[str]) -> DataFrame:
    """One row for each genome, one 0/1 column for each domain."""
    wide = pam.groupBy("genome_id").pivot("domain", domains).agg(F.lit(1))
    return wide.na.fill(0)


def domains_in_all(seeds: DataFrame, hits: DataFrame, identity: float = 70.0) -> DataFrame:
    """(seed, domain): domains of high identity in all genomes of a seed; seeds are ``(seed, genome_id)``."""
    needed = seeds.select("seed", "genome_id").distinct()
    counts = needed.groupBy("seed").agg(F.count("*").alias("needed"))
    own = hits.filter(F.col("identity") >= identity).select("genome_id", "domain").distinct()
    found = needed.join(own, "genome_id").groupBy("seed", "domain").agg(F.count("*").alias("found"))
    return found.join(counts, "seed").filter("found = needed").select("seed", "domain")


def genomes_with_all(patterns: DataFrame, hits: DataFrame) -> DataFrame:
    """(seed, genome_id): genomes that have all domains of a seed's pattern ``(seed, domain)``."""
    needed = stored_small(patterns.select("seed", "domain").distinct(), "needed")
    counts = needed.groupBy("seed").agg(F.count("*").alias("needed"))
    own = hits.select("genome_id", "domain").distinct()
    found = needed.join(own, "domain").groupBy("seed", "genome_id").agg(F.count("*").alias("found"))
    return found.join(counts, "seed").filter("found = needed").select("seed", "genome_id")


def seed_references(matches: DataFrame, hits: DataFrame) -> DataFrame:
    """(domain, protein_id, score): the proteins of each seed domain in its genomes."""
    joined = hits.join(matches.withColumnRenamed("seed", "domain"), ["genome_id", "domain"])
    return joined.select("domain", "protein_id", "score").distinct()


def seed_limits(references: DataFrame) -> DataFrame:
    """(domain, lower, upper): least and greatest score of each domain's references."""
    return references.groupBy("domain").agg(F.min("score").alias("lower"), F.max("score").alias("upper"))


def carried(refset: DataFrame, proteins: DataFrame) -> DataFrame:
    """(genome_id, domain): domains of which a genome has a reference, of stored tables, made in slices of the proteins."""
    found = in_slices(proteins.count(), "carried", lambda part: _placed(refset.filter(part("protein_id")), proteins.filter(part("protein_id"))).select("genome_id", "domain").distinct())
    return saved(found.distinct(), "carried")


def positive_sample(refset: DataFrame, proteins: DataFrame, limit: int | None = 1000, seed: int = 42) -> DataFrame:
    """(target, genome_id, domain): for each target the domains of genomes that carry one of its references.

    At most ``limit`` genomes of a target are taken, in order of a hash of
    genome and seed (sampling is the feature; None takes all).
    """
    return sample_of(_placed(refset, proteins).select("genome_id", "domain").distinct(), limit, seed)


def sample_of(carried: DataFrame, limit: int | None = 1000, seed: int = 42) -> DataFrame:
    """The positive sample of the different ``(genome_id, domain)`` of a reference set."""
    # a genome's domains are one short list, so its pairs are made without a join
    lists = carried.groupBy("genome_id").agg(F.collect_list("domain").alias("domains"))
    targets = lists.select("genome_id", F.explode("domains").alias("target"), "domains")
    if limit is not None:
        order = Window.partitionBy("target").orderBy(F.xxhash64("genome_id", F.lit(seed)), "genome_id")
        targets = targets.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= limit).drop("_n")
    return targets.select("target", "genome_id", F.explode("domains").alias("domain"))


def support_model(sample: DataFrame, alpha: float = 1.0, min_genomes: int = 2) -> DataFrame:
    """(target, feature, n, p, strength, weight) from a positive sample.

    p = (n + alpha) / (N + 2 alpha); strength = -ln(1 - p); weights of a target
    sum to one. Features are the other domains in at least ``min_genomes`` genomes.
    As ``positive_sample`` gives it, a sample has each row once and each genome
    of a target with the target itself, so the pairs' counts say everything.
    """
    rows = sample.groupBy("target", F.col("domain").alias("feature")).agg(F.count("*").alias("n"))
    pairs = saved(rows, "pair-counts")
    total = pairs.filter("feature = target").select("target", F.col("n").alias("n_train"))
    counts = pairs.filter("feature <> target").filter(F.col("n") >= min_genomes)
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), (F.col("n") + alpha) / (F.col("n_train") + 2 * alpha)))
    strong = counts.join(total, "target").withColumn("p", p).withColumn("strength", -F.log(1 - F.col("p")))
    return strong.withColumn("weight", F.col("strength") / F.sum("strength").over(Window.partitionBy("target")))


def balance(model: DataFrame, presence_rows: DataFrame, genomes: DataFrame, targets: list[str]) -> DataFrame:
    """(target, genome_id, balance) of the named targets in every genome: weight of the features present less that of those absent, in -1..1.

    This is the dense report; ``plausible_hits`` asks only for the domains of a genome's best hits.
    """
    wanted = saved(model.filter(F.col("target").isin(targets)).select("target", "feature", "weight"), "wanted")
    known = sorted(r.target for r in wanted.select("target").distinct().collect())
    weights = [F.sum(F.when(F.col("target") == t, F.col("weight"))).alias(f"_w{i}") for i, t in enumerate(known)]
    if not known:
        return genomes.select(F.lit(None).cast("string").alias("target"), "genome_id", F.lit(-1.0).alias("balance")).limit(0)
    # a genome's features come together once, as one short list; its row of sums is made there, and targets are rows only in the result
    features = presence_rows.filter(F.col("genome_id").isNotNull()).select("genome_id", F.col("domain").alias("feature"))
    both = genomes.select("genome_id", F.lit(None).cast(features.schema["feature"].dataType).alias("feature")).unionByName(features)
    lists = both.groupBy("genome_id").agg(F.collect_set("feature").alias("features"))
    by_feature = stored_small(wanted.groupBy("feature").agg(*weights), "weights")
    sums = lists.select("genome_id", F.explode_outer("features").alias("feature")).join(by_feature, "feature", "left").groupBy("genome_id").agg(*(F.sum(f"_w{i}").alias(f"_w{i}") for i in range(len(known))))
    each = F.array(*(F.struct(F.lit(t).alias("target"), (2 * F.coalesce(F.col(f"_w{i}"), F.lit(0.0)) - 1).alias("balance")) for i, t in enumerate(known)))
    return sums.select("genome_id", F.explode(each).alias("_t")).select("_t.target", "genome_id", "_t.balance")


def best_hits(hits: DataFrame, min_bsr: float = 0.3) -> DataFrame:
    """The best protein of each (genome, domain) among hits of enough score ratio; ties go by protein."""
    order = Window.partitionBy("genome_id", "domain").orderBy(F.desc("score"), "protein_id")
    return hits.filter(F.col("bsr") >= min_bsr).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def plausible_hits(hits: DataFrame, model: DataFrame, presence_rows: DataFrame, cutoff: float = 0.8, min_bsr: float = 0.3) -> DataFrame:
    """Best hits whose genome supports the domain; the cutoff is above -1, so only genomes with a feature count."""
    best = best_hits(hits, min_bsr).select("genome_id", "domain", "protein_id", "score")
    # only the domains of a genome's own best hits are asked for
    present = presence_rows.select("genome_id", F.col("domain").alias("feature")).distinct()
    weights = stored_small(model.select(F.col("target").alias("domain"), "feature", "weight"), "model")
    found = best.join(present, "genome_id").join(weights, ["domain", "feature"])
    scored = found.groupBy("genome_id", "domain", "protein_id", "score").agg((2 * F.sum("weight") - 1).alias("balance"))
    return scored.filter(F.col("balance") >= cutoff)


def score_matrix(pam: DataFrame, scores: DataFrame, domains: list[str], how: str = "max") -> DataFrame:
    """One row for each genome: 0/1 and best (or mean) score of each domain."""
    joined = pam.select("genome_id", "domain", F.explode("proteins").alias("protein_id")).join(scores.select("protein_id", "score"), "protein_id")
    agg = F.max("score") if how == "max" else F.avg("score")
    wide = joined.groupBy("genome_id").pivot("domain", domains).agg(F.max(F.lit(1)).alias("present"), agg.alias("score"))
    return wide.na.fill(0)


def logistic_models(pam: DataFrame, scores: DataFrame, domains: list[str], penalty: float = 1.0, tolerance: float = 1e-10, rounds: int = 100) -> DataFrame:
    """(target, feature, coefficient): a logistic model of each domain on the presence and mean score of the others.

    The sum of the log losses and ``penalty / 2`` times the squared coefficients
    without the intercept is least. All targets are fitted together: a Newton
    round is one job that sums loss, gradient and Hessian of every target over
    the genomes, in tasks first, and the driver solves one small system for each
    target. What it gets depends on the named domains alone; where their
    Hessians are many, targets go in blocks of at most ``HESSIAN_CELLS`` sums. A
    step that does not lower the loss is halved. A domain that all or no genomes
    have gives no rows.
    """
    spark = pam.sparkSession
    wide = saved(score_matrix(pam, scores, domains, "avg"), "score-matrix")
    counts = wide.agg(F.count("*").alias("n"), *(F.sum(f"`{d}_present`").alias(f"n{i}") for i, d in enumerate(domains))).first()
    targets = [i for i in range(len(domains)) if 0 < (counts[f"n{i}"] or 0) < counts["n"]]
    names = [f"{d}_{kind}" for d in domains for kind in ("present", "score")]
    given = wide.select(F.array(*(F.col(f"`{c}`").cast("double") for c in names)).alias("x"))
    block = max(1, HESSIAN_CELLS // (2 * len(domains) + 1) ** 2)
    rows = []
    for at in range(0, len(targets), block):
        fitted = _newton(given, targets[at : at + block], len(names), penalty, tolerance, rounds)
        for t, w in fitted.items():
            own = [i for i in range(len(names)) if i // 2 != t]
            rows += [(domains[t], names[i], float(w[i])) for i in own] + [(domains[t], "intercept", float(w[-1]))]
    return spark.createDataFrame(rows, "target string, feature string, coefficient double")


def _newton(given: DataFrame, targets: list[int], width: int, penalty: float, tolerance: float, rounds: int) -> dict[int, np.ndarray]:
    """Coefficients of each target over rows ``x``; a target's own two columns are left out and stay 0."""
    weights = np.full(width + 1, penalty)
    weights[-1] = 0.0
    own = {t: np.array([i for i in range(width) if i // 2 != t] + [width]) for t in targets}
    place = {t: np.zeros(width + 1) for t in targets}
    tried, step, least, done = dict(place), {}, dict.fromkeys(targets, np.inf), {}
    for _ in range(rounds):
        left = [t for t in targets if t not in done]
        if not left:
            break
        sums = _loss_sums(given, {t: tried[t] for t in left}, own)
        for t in left:
            k = len(own[t])
            loss, gradient, hessian = sums[t][0], sums[t][1 : k + 1], sums[t][k + 1 :].reshape(k, k)
            w = tried[t][own[t]]
            loss += (weights[own[t]] * w * w).sum() / 2
            if loss > least[t] + 1e-12 * abs(least[t]):
                step[t] = step[t] / 2
            else:
                slope = gradient - weights[own[t]] * w
                least[t], place[t] = loss, tried[t]
                step[t] = np.linalg.solve(hessian + np.diag(weights[own[t]]), slope)
                if step[t] @ slope <= tolerance * (1 + least[t]) * tolerance:
                    done[t] = place[t]
            moved = np.zeros(width + 1)
            moved[own[t]] = step[t]
            tried[t] = place[t] + moved
            if np.abs(step[t]).max() <= tolerance * np.abs(place[t]).max():
                done[t] = place[t]
    return {t: done.get(t, place[t]) for t in targets}


def _loss_sums(given: DataFrame, place: dict[int, np.ndarray], own: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Loss, gradient and Hessian of each target at its coefficients, one after another, summed over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: 0.0 for t in place}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            x = np.hstack([x, np.ones((len(x), 1))])
            for t, w in place.items():
                y, mine = x[:, 2 * t], x[:, own[t]]
                z = mine @ w[own[t]]
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                loss = (np.logaddexp(0, z) - y * z).sum()
                hessian = mine.T @ (mine * (p * (1 - p))[:, None])
                sums[t] = sums[t] + np.concatenate([[loss], mine.T @ (y - p), hessian.ravel()])
        found = [t for t in sums if np.ndim(sums[t])]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([sums[t] for t in found], pa.list_(pa.float64()))], ["target", "sums"])

    each = given.mapInArrow(run, "target int, sums array<double>").select("target", F.posexplode("sums").alias("at", "value"))
    table = each.groupBy("target", "at").agg(F.sum("value").alias("value")).toArrow()
    target, at, value = (table.column(c).to_numpy() for c in ("target", "at", "value"))
    out = {}
    for t in place:
        rows = target == t
        out[t] = value[rows][np.argsort(at[rows])]
    return out


def similar_to_domain(patterns: DataFrame, min_similarity: float = 0.7) -> DataFrame:
    """(domain, keyword, similarity): patterns like the union of all patterns that hold the domain.

    The similarity is at most the ratio of the sizes, so pairs of unlike sizes
    go before common items are counted.
    """
    items = patterns.select("keyword", F.explode("pattern").alias("item")).distinct()
    holders = items.select(F.col("item").alias("domain"), "keyword")
    whole = holders.join(items, "keyword").select("domain", "item").distinct()
    size = whole.groupBy("domain").agg(F.count("*").alias("nd"))
    own = items.groupBy("keyword").agg(F.count("*").alias("nk"))
    sized_items = items.join(own, "keyword")
    sized_whole = whole.join(size, "domain")
    near = sized_whole.join(sized_items, "item").filter(F.least("nd", "nk") >= F.greatest("nd", "nk") * min_similarity)
    common = near.groupBy("domain", "keyword", "nd", "nk").agg(F.count("*").alias("common"))
    similarity = F.col("common") / (F.col("nd") + F.col("nk") - F.col("common"))
    return common.select("domain", "keyword", similarity.alias("similarity")).filter(F.col("similarity") >= min_similarity)
