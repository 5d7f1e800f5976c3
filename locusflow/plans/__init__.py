"""Whole analyses composed of the operators, each one lazy plan where no step has to look at its data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.operators import hits as H
from locusflow.operators import islands as I
from locusflow.operators import mining as M
from locusflow.operators import neighbours as J
from locusflow.operators import presence as P
from locusflow.operators import reports as R
from locusflow.operators import selection as S
from locusflow.operators import sets as U
from locusflow.operators import similarity as K
from locusflow.operators import validation as V
from locusflow.operators.linkage import ward_groups
from locusflow.operators.ranges import numbered
from locusflow.operators.skew import frequent_join, salted_join


def hits_to_islands(hits: DataFrame, queries: DataFrame, features: DataFrame, distance: int = 3500, min_genes: int = 2) -> DataFrame:
    """Filtered and scored hits, one domain set for each protein, coordinates, islands."""
    scored = H.domain_of(H.score_ratio(H.filter_hits(hits, queries)))
    resolved = H.resolve_overlaps(scored, ["genome_id", "protein_id"], ["evalue", "bitscore", "sstart", "send", "query_id"])
    placed = H.attach_features(H.architecture(resolved).select("genome_id", "protein_id", F.col("architecture").alias("domain")), features)
    return I.islands(I.island_members(placed, distance, min_genes))


def islands_to_keywords(lists: DataFrame, k: int = 2, q: int = 1) -> DataFrame:
    """(keyword, cluster_id): lists filtered and made unique, patterns with gaps, closed ones numbered, replicates back.

    Genes are numbered first, so that lists and patterns are short. A list
    supports its pattern without a join; only those of lists with replicates
    meet them. Tables go as soon as they are read.
    """
    spark, begun = lists.sparkSession, M.written()
    kept, width = M.coded(M.saved(M.filter_lists(lists), "lists"))
    derep = M.saved(M.dereplicate(kept), "derep")
    # the representative is its own replicate
    copies = M.saved(M.replicates(kept, derep, stored=True).filter("replicate <> cluster_id"), "replicates")
    M.remove_scratch(spark, begun, derep, copies)
    support = M.merged_support(derep, width, k, q)
    M.remove_scratch(spark, begun, copies, support)
    closed = M.saved(M.closed_patterns(support, stored=True), "closed")
    number = numbered(closed.withColumn("_length", M.pattern_length(closed)), [F.col("_length").asc(), F.col("pattern").asc()])
    named = M.saved(number.select("pattern", "n", "rank"), "numbered")
    M.remove_scratch(spark, begun, copies, support, named)
    found = M.saved(frequent_join(support, named, "pattern", "n").select("rank", "cluster_id", "many"), "found")
    M.remove_scratch(spark, begun, copies, found)
    more = salted_join(copies, found.filter("many").select("cluster_id", "rank"), "cluster_id").select("rank", F.col("replicate").alias("cluster_id"))
    return found.select("rank", "cluster_id").unionByName(more).select(F.concat(F.lit("csb-"), F.col("rank").cast("string"), F.lit("_")).alias("keyword"), "cluster_id")


def context_free_references(seeds: DataFrame, members: DataFrame, hits: DataFrame, identity: float = 70.0) -> DataFrame:
    """(domain, protein_id, score), stored: for each seed the domains in all its genomes, the genomes with all of those, and its proteins there.

    Hits are a stored table, which is read in slices of the genomes.
    """
    spark, begun = hits.sparkSession, M.written()
    common = M.saved(P.domains_in_all(M.saved(seeds.distinct(), "seeds"), members, identity), "common")
    genomes = M.saved(P.genomes_with_all(common, hits), "genomes")
    rows = M.in_slices(hits.count(), "references", lambda part: P.seed_references(genomes.filter(part("genome_id")), hits.filter(part("genome_id"))))
    M.remove_scratch(spark, begun, rows)
    # a protein of two genomes came twice
    found = M.in_slices(rows.count(), "references", lambda part: rows.filter(part("protein_id")).distinct().sortWithinPartitions("protein_id"))
    M.remove_scratch(spark, begun, found)
    return found


def singleton_references(members: DataFrame, seed_identity: float = 70.0, identity: float = 70.0) -> DataFrame:
    """(domain, protein_id, score), stored: references from proteins of high identity in no cluster, over the genomes like theirs; members are a stored table."""
    seeds = S.context_free(members, seed_identity).select(F.col("domain").alias("seed"), "genome_id")
    return context_free_references(seeds, members, members, identity)


def seed_groups(keywords: DataFrame, members: DataFrame, query_genome, singletons: DataFrame | None = None, min_seqs: int = 1) -> DataFrame:
    """The first reference sets, stored: proteins of the passing keywords, without query-only groups, query proteins back, singletons over them.

    Singletons are a stored table; what they replace is not made. Large tables are shuffled in slices,
    and go as soon as they are read.
    """
    spark, begun = members.sparkSession, M.written()
    members = M.saved(members.select("cluster_id", "genome_id", "protein_id", "domain", "score"), "members")
    keywords = M.saved(keywords.select("cluster_id", "keyword").distinct(), "keywords")
    query = M.saved(S.query_scores(members, query_genome), "query")
    stats = M.saved(S.keyword_statistics(keywords, members), "statistics")
    passing = S.passing_domains(S.drop_low_quality(stats, query), query)
    if singletons is not None:
        passing = passing.join(M.saved(singletons.select("domain").distinct(), "replaced"), "domain", "left_anti")
    tasks = M.saved(passing.select("keyword", "domain"), "tasks")
    M.remove_scratch(spark, begun, members, keywords, tasks)
    rows = members.count()
    if min_seqs <= 1:
        pairs, keyed = S.numbered_keywords(tasks, keywords)
        part_of = lambda part: S.members_by_keywords(pairs, keyed.filter(part("cluster_id")), members.filter(part("cluster_id")))
        found = U.stored_union(M.in_slices(rows, "proteins", part_of))
    else:
        found = M.saved(U.combine(S.proteins_of(tasks, keywords, members, min_seqs)), "proteins")
    M.remove_scratch(spark, begun, members, found)
    # domains with a protein outside the query genome
    other = members.filter(F.col("genome_id") != F.lit(query_genome)).select("protein_id")
    outside = M.in_slices(rows, "outside", lambda part: found.filter(part("protein_id")).join(other.filter(part("protein_id")), "protein_id", "left_semi").select("domain").distinct())
    domains = M.saved(outside.distinct(), "domains")
    query_own = members.filter(F.col("genome_id") == F.lit(query_genome)).select("domain", "protein_id")
    query_own = M.saved(query_own.join(domains, "domain", "left_semi"), "query-own")
    M.remove_scratch(spark, begun, found, domains, query_own)
    whole = U.stored_union(found.join(domains, "domain", "left_semi"), query_own, *([] if singletons is None else [singletons]))
    M.remove_scratch(spark, begun, whole)
    return whole


def extend_by_synteny(refset: DataFrame, patterns: DataFrame, keywords: DataFrame, members: DataFrame, sequences: DataFrame | None = None, similarity: float = 0.7, cutoff: float = 0.8, limit: int | None = 1000) -> DataFrame:
    """The second sets: members of patterns like a domain's own, plausible hits by co-occurrence, and clusters that hold a reference.

    Large tables are shuffled in slices, and go as soon as they are read.
    """
    spark, begun = members.sparkSession, M.written()
    refset = M.saved(refset.select("domain", "protein_id"), "refset")
    wanted = M.saved(P.similar_to_domain(M.saved(patterns.select("keyword", "pattern"), "patterns"), similarity).select("domain", "keyword"), "wanted")
    M.remove_scratch(spark, begun, refset, wanted)
    pairs, keyed = S.numbered_keywords(wanted, keywords)
    members = M.saved(members.select("cluster_id", "genome_id", "protein_id", "domain", "score", "bsr"), "members")
    rows = members.count()
    part_of = lambda part: S.members_by_keywords(pairs, keyed.filter(part("cluster_id")), members.filter(part("cluster_id")))
    wider = M.in_slices(rows, "wider", part_of)
    M.remove_scratch(spark, begun, refset, members, wider)
    carried = P.carried(refset, members)
    model = M.saved(P.support_model(P.sample_of(carried, limit)), "model")
    M.remove_scratch(spark, begun, refset, members, wider, carried, model)
    plausible = M.in_slices(rows, "plausible", lambda part: P.plausible_hits(members.filter(part("genome_id")), model, carried.filter(part("genome_id")), cutoff).select("domain", "protein_id"))
    M.remove_scratch(spark, begun, refset, wider, plausible)
    joined = U.stored_union(refset, wider, plausible)
    M.remove_scratch(spark, begun, joined)
    if sequences is None:
        return joined
    clusters = K.cluster(sequences, identity=0.9)
    by_domain = clusters.join(joined.select("domain", F.col("protein_id").alias("member_id")), "member_id").select("domain", "rep_id").distinct()
    found = clusters.join(by_domain, "rep_id").select("domain", F.col("member_id").alias("protein_id"))
    return U.union(joined, found)


def extend_by_clusters(
    refset: DataFrame, sequences: DataFrame, neighbourhoods: DataFrame, members: DataFrame, density: float = 0.1, fraction: float = 0.01, least: float = 0.0001, cutoff: float | None = 0.8, identity: float = 0.4
) -> DataFrame:
    """The third sets: clusters with enough references; all clusters with at least ``least`` of a domain's references;
    new members of a reference's cluster whose neighbourhood is part of a reference's; and, with a ``cutoff``, best
    hits in clusters with a reference whose genome supports the domain by co-occurrence."""
    clusters = K.cluster(sequences, identity=identity)
    owners = members.select(F.col("protein_id").alias("member_id"), F.col("domain").alias("family")).distinct()
    by_family = M.saved(clusters.join(owners, "member_id").select("family", "rep_id", "member_id"), "clusters")
    refs = refset.select(F.col("domain").alias("family"), "protein_id")
    chosen = V.select_clusters(by_family, refs, density, fraction).withColumnRenamed("family", "domain")
    candidates = V.with_reference(by_family, refs).select(F.col("family").alias("domain"), F.col("member_id").alias("protein_id"))
    around = lambda rows: rows.join(neighbourhoods.select("protein_id", "neighbourhood"), "protein_id")
    vicinity = J.subset_neighbourhoods(around(U.difference(candidates, refset)), around(refset.select("domain", "protein_id")))
    wide = V.select_clusters(by_family, refs, 0.0, least).withColumnRenamed("family", "domain")
    whole = U.union(U.union(chosen, vicinity), wide)
    if cutoff is None:
        return whole
    model = P.support_model(P.positive_sample(refset, members))
    plausible = P.plausible_hits(members, model, P.presence(refset, members), cutoff)
    return U.union(whole, plausible.join(candidates, ["domain", "protein_id"], "left_semi"))


def scores_to_reports(
    scores: DataFrame, folds: DataFrame | None = None, neighbourhoods: DataFrame | None = None, genomes: DataFrame | None = None, taxonomy: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All reports of models over ranked scores ``(model, hit_id, bitscore, is_tp)``.

    ``cutoffs``, ``labelled`` (the hit report), ``roc``, ``mcc`` and ``performance``
    always; with ``folds``, scores with a column ``fold``, ``fold_cutoffs``,
    ``fold_summary`` and ``fold_matrices``, and the performance is that of the
    folds; with neighbourhoods ``(protein_id, neighbourhood)`` the confusion
    counts of each ``(model, cutoff, neighbourhood)``; with genomes
    ``(protein_id, genome_id)`` and taxonomy also ``detailed``, the hit report
    with neighbourhood, genome and taxa.
    """
    swept = M.saved(V.sweep(scores), "swept")
    cuts = M.saved(V.cutoffs(swept), "cutoffs")
    report = M.saved(V.label_hits(swept, cuts), "hit-report")
    out = {"cutoffs": R.cutoff_table(cuts), "labelled": report, "roc": R.roc_points(report, cuts), "mcc": R.mcc_curve(report)}
    matrices = cuts
    if folds is not None:
        # a fold's model is named by both, so every fold has its own sweep
        pairs = folds.select(F.struct("model", "fold").alias("model"), "hit_id", "bitscore", "is_tp")
        found = M.saved(V.cutoffs(V.sweep(pairs)), "fold-cutoffs")
        matrices = found.withColumns({"fold": F.col("model.fold"), "model": F.col("model.model")})
        out |= {"fold_cutoffs": matrices, "fold_summary": V.fold_summary(matrices), "fold_matrices": V.sum_matrices(matrices)}
    out["performance"] = V.performance(matrices)
    if neighbourhoods is not None:
        out["confusions"] = R.confusions(report, neighbourhoods)
        if genomes is not None and taxonomy is not None:
            out["detailed"] = R.enriched(report.withColumnRenamed("hit_id", "protein_id"), neighbourhoods.select("protein_id", "neighbourhood"), genomes, taxonomy)
    return out


def group_keywords(statistics: DataFrame, threshold: float = 0.2) -> DataFrame:
    """(keyword, domain, group_id): keywords and domains with like statistics (median, mean, deviation), by Ward linkage."""
    named = M.saved(statistics.withColumn("_pair", F.struct("keyword", "domain")), "statistics")
    found = ward_groups(named, "_pair", ["median_score", "mean_score", "std_score"], threshold)
    return found.select("_pair.keyword", "_pair.domain", F.concat_ws("/", "group_id.keyword", "group_id.domain").alias("group_id"))
