"""Small cases with known answers."""

import random

import pytest
from pyspark.sql import functions as F

from locusflow import functions as fn
from locusflow import sources
from locusflow.operators import hits as H
from locusflow.operators import islands as I
from locusflow.operators import mining as M
from locusflow.operators import naming as N
from locusflow.operators import presence as P
from locusflow.operators import selection as S
from locusflow.operators import sets as U
from locusflow.operators import similarity as K
from locusflow.operators import reports as R
from locusflow.operators import validation as V
from locusflow.sources import sinks

LISTS = [
    ("alpha", ["rhd", "tusA", "dsrE", "dra"]),
    ("beta", ["lip", "ghd", "rhd", "tusA", "dsrE", "dra"]),
    ("gamma", ["ggf", "rhd", "dra", "tusA", "dsrE", "dra", "pfu"]),
    ("delta", ["rhd", "tusA", "dsrE", "dra"]),
    ("epsilon", ["rhd", "tusA", "dsrE", "dra"]),
]


def lists_of(spark, rows=LISTS):
    return spark.createDataFrame(rows, "cluster_id string, types array<string>")


def test_scalars(spark):
    row = spark.range(1).select(
        fn.strip_query_suffix(F.lit("SmoC___1")).alias("a"),
        fn.strip_query_suffix(F.lit("SmoC___abc")).alias("b"),
        fn.strip_group_prefix(F.lit("grp0_ProteinA")).alias("c"),
        fn.jaccard(F.array(F.lit("A"), F.lit("B")), F.array(F.lit("B"), F.lit("C"))).alias("d"),
        fn.comment_set(F.lit("Tc, Coo,,Tc")).alias("e"),
        fn.mcc(F.lit(10), F.lit(5), F.lit(3), F.lit(20)).alias("f"),
        fn.mcc(F.lit(0), F.lit(0), F.lit(3), F.lit(20)).alias("g"),
    ).first()
    assert row[:3] == ("SmoC", "SmoC___abc", "ProteinA")
    assert row.d == pytest.approx(1 / 3) and row.e == "Coo,Tc"
    assert row.f == pytest.approx((10 * 20 - 5 * 3) / ((15 * 13 * 25 * 23) ** 0.5)) and row.g == 0


def test_overlap_fold_keeps_arrival_order(spark):
    rows = [(1, "A", 1, 100, 50.0), (2, "B", 90, 200, 60.0), (3, "C", 150, 300, 70.0), (4, "D", 10, 20, 5.0)]
    hits = spark.createDataFrame([("g", "p", *r, 1.0) for r in rows], "genome_id string, hit_id string, ord int, domain string, sstart int, send int, bitscore double, bsr double")
    out = H.architecture(H.resolve_overlaps(hits, ["genome_id", "hit_id"], ["ord"])).first()
    assert out.architecture == "D-C" and out.coordinates == "10:20-150:300" and out.dom_count == 2
    assert H.architecture(H.resolve_overlaps(hits, ["genome_id", "hit_id"], ["ord"], best_first=True)).first().architecture == "A-C"
    assert H.resolve_overlaps(hits, ["genome_id", "hit_id"], ["ord"], force=True).select(F.size("domains")).first()[0] == 2


def test_hit_filter_needs_coverage_and_a_known_query(spark):
    queries = spark.createDataFrame([("q", 100, 200.0)], "query_id string, length int, self_score double")
    rows = [("h1", "q", 1e-9, 150.0, 1, 80, 10.0), ("h2", "q", 1.0, 1.0, 1, 80, 30.0), ("h3", "q", 1e-9, 150.0, 1, 40, 90.0), ("h4", "x", 1e-9, 150.0, 1, 80, 90.0)]
    hits = spark.createDataFrame(rows, "hit_id string, query_id string, evalue double, bitscore double, sstart int, send int, pident double")
    assert sorted(r.hit_id for r in H.filter_hits(hits, queries).collect()) == ["h1", "h2"]
    kept = H.score_ratio(H.filter_hits(hits, queries, keep_unknown=True).withColumn("bsr", F.lit(None).cast("double")))
    assert {r.hit_id: r.bsr for r in kept.collect()} == {"h1": 0.75, "h2": 0.005, "h4": 1.0}


def test_islands_split_at_gaps_and_skip_unplaced_genes(spark):
    rows = [(1, "c", 1, 0, 10), (1, "c", 2, 15, 20), (1, "c", 3, 40, 50), (1, "c", 4, 55, 60), (1, "c", 5, 100, 110), (1, None, 6, 0, 0), (1, None, 7, 0, 0), (2, "c", 8, 0, 5)]
    genes = spark.createDataFrame([(*r, "d") for r in rows], "genome_id int, contig string, protein_id int, start_pos int, end_pos int, domain string")
    found = I.islands(I.island_members(genes, 5)).collect()
    assert sorted((r.cluster_id, r.genes) for r in found) == [("1_1", [1, 2]), ("1_2", [3, 4])]


def test_list_filter_and_positions(spark):
    rows = [("a", ["x", "y", "x", "z", "x"]), ("b", ["x", "y"]), ("c", ["x", "y", "z", "x"])]
    assert [r.cluster_id for r in M.filter_lists(lists_of(spark, rows)).collect()] == ["c"]
    places = {(r.gene, r.cluster_id, r.pos) for r in M.positions(lists_of(spark)).collect()}
    assert ("dra", "gamma", 2) in places and ("dra", "gamma", 5) in places and len(places) == 25
    derep = {r.cluster_id: r.weight for r in M.dereplicate(lists_of(spark)).collect()}
    assert derep == {"alpha": 3, "beta": 1, "gamma": 1}


def brute_support(lists, k):
    out = set()
    patterns = {tuple(t[i:j]) for _, t in lists for i in range(len(t)) for j in range(i + 2, len(t) + 1)}
    for name, types in lists:
        for p in patterns:
            for s in (i for i, x in enumerate(types) if x == p[0]):
                at = s
                for gene in p[1:]:
                    at = next((i for i in range(at + 1, len(types)) if types[i] == gene), None)
                    if at is None:
                        break
                if at is not None and at - s + 1 - len(p) <= k:
                    out.add((p, name))
    return out


def test_gapped_support_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(f"c{i}", [rng.choice("ABCDE") for _ in range(rng.randint(2, 7))]) for i in range(12)]
    unique = {tuple(t): n for n, t in reversed(rows)}
    rows = [(n, list(t)) for t, n in unique.items()]
    lists = lists_of(spark, rows)
    got = {(tuple(r.pattern), r.cluster_id) for r in M.gapped_support(lists, M.dereplicate(lists), k=2, q=1).collect()}
    assert got == brute_support(rows, 2)


def test_reversed_and_closed_patterns(spark):
    rows = [(["a", "b"], 1), (["b", "a"], 2), (["a", "b", "c"], 1), (["x", "x"], 3)]
    support = spark.createDataFrame(rows, "pattern array<string>, cluster_id int")
    merged = {(tuple(r.pattern), r.cluster_id) for r in M.merge_reversed(support).collect()}
    assert merged == {(("a", "b"), 1), (("a", "b"), 2), (("a", "b", "c"), 1), (("x", "x"), 3)}
    closed = {tuple(r.pattern) for r in M.closed_patterns(support).collect()}
    assert closed == {("a", "b", "c"), ("b", "a"), ("x", "x")}


def test_naming(spark):
    patterns = spark.createDataFrame([("KW_A", ["A", "B", "E"]), ("KW_B", ["A", "D"]), ("KW_C", ["C", "E"])], "keyword string, pattern array<string>")
    found = lists_of(spark, [("i1", ["A", "B", "X"]), ("i2", ["C", "E"])])
    named = {(r.cluster_id, r.keyword): (round(r.completeness, 2), r.missing, r.additional) for r in N.name_islands(found, patterns).collect()}
    assert named == {("i1", "KW_A"): (0.67, ["E"], ["X"]), ("i1", "KW_B"): (0.5, ["D"], ["B", "X"]), ("i2", "KW_C"): (1.0, [], [])}
    assert {(r.cluster_id, r.keyword) for r in N.rarest_item_candidates(found, patterns).collect()} == {("i1", "KW_A"), ("i2", "KW_C")}


def test_balance_extremes_and_weights(spark):
    sample = spark.createDataFrame([("t", g, d) for g in (1, 2, 3) for d in ("t", "x", "y")], "target string, genome_id int, domain string")
    model = P.support_model(sample)
    assert model.groupBy("target").agg(F.round(F.sum("weight"), 9)).first()[1] == 1
    have = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "genome_id int, domain string")
    genomes = spark.createDataFrame([(1,), (2,), (3,)], "genome_id int")
    got = {r.genome_id: round(r.balance, 9) for r in P.balance(model, have, genomes, ["t", "unknown"]).collect()}
    assert got == {1: 1, 2: 0, 3: -1}


def test_sets_and_top(spark):
    a = spark.createDataFrame([("d", 1), ("d", 2), ("e", 3)], "domain string, protein_id int")
    b = spark.createDataFrame([("d", 2), ("d", 4)], "domain string, protein_id int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(U.union(a, b)) == [("d", 1), ("d", 2), ("d", 4), ("e", 3)]
    assert rows(U.overwrite(a, b)) == [("d", 2), ("d", 4), ("e", 3)]
    assert rows(U.difference(a, b)) == [("d", 1), ("e", 3)]
    assert rows(U.added_counts(a, b)) == [("d", 1, 1, 1), ("e", 0, 1, 0)]
    scores = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "protein_id int, score double")
    assert len(S.top_by_score(a, scores, 1).collect()) == 3


def test_cutoffs(spark):
    rows = [("m", "a", 90.0, True), ("m", "b", 80.0, True), ("m", "c", 70.0, False), ("m", "d", 60.0, True), ("m", "e", 40.0, False), ("m", "f", 30.0, False)]
    scores = spark.createDataFrame(rows, "model string, hit_id string, bitscore double, is_tp boolean")
    swept = V.sweep(scores)
    assert all(r.tp + r.fp + r.fn + r.tn == 6 for r in swept.collect())
    cuts = V.cutoffs(swept).first()
    assert (cuts.trusted, cuts.noise, cuts.optimized) == (80.0, 60.0, 80.0)
    labels = {r.hit_id: (r.at_optimized, r.at_noise, r.above_noise) for r in V.label_hits(swept, V.cutoffs(swept)).collect()}
    assert labels == {"a": ("TP", "TP", True), "b": ("TP", "TP", True), "c": ("TN", "FP", True), "d": ("FN", "TP", True), "e": ("TN", "TN", False)}


def test_hit_report_after_the_last_positive(spark):
    """Hits down to 0.6 of the noise cutoff keep the counts of the last positive and the best MCC; further ones are no points."""
    tail = [("m", f"h{i}", s, t) for i, (s, t) in enumerate([(100.0, True), (90.0, True), (80.0, False), (70.0, True), (60.0, False), (50.0, False), (30.0, False), (10.0, False)])]
    # the first hit is false, so there is no trusted cutoff; and a model without a true positive
    rows = tail + [("n", "a", 9.0, False), ("n", "b", 8.0, True), ("n", "c", 7.0, False), ("o", "a", 5.0, False), ("o", "b", 4.0, False)]
    swept = V.sweep(spark.createDataFrame(rows, "model string, hit_id string, bitscore double, is_tp boolean"))
    cuts = V.cutoffs(swept)
    report = V.label_hits(swept, cuts)
    points = {(r.model, r.bitscore): (round(r.fpr, 6), round(r.tpr, 6), r.marks) for r in R.roc_points(report, cuts).collect()}
    curve = {(r.model, r.bitscore): round(r.mcc, 3) for r in R.mcc_curve(report).collect()}
    assert {s for m, s in points if m == "m"} == {s for m, s in curve if m == "m"} == {100.0, 90.0, 80.0, 70.0, 60.0, 50.0}
    assert points["m", 60.0][:2] == points["m", 50.0][:2] == points["m", 70.0][:2] == (0.2, 1.0)
    assert curve["m", 60.0] == curve["m", 50.0] == max(v for (m, _), v in curve.items() if m == "m") == 0.775
    got = {(r.model, r.hit_id): (r.at_trusted, r.at_noise, r.above_noise) for r in report.collect()}
    assert got["n", "a"] == ("FP", "FP", True) and got["n", "b"] == ("TP", "TP", True) and got["n", "c"] == ("TN", "TN", False)
    assert points["n", 7.0][2] == "trusted" and cuts.filter("model = 'n'").first().trusted is None
    assert got["o", "a"] == ("FP", "FP", True) and got["o", "b"] == ("TN", "TN", False)


def test_grid_has_no_nested_loop(spark):
    clusters = spark.createDataFrame([("f", i % 5, i) for i in range(40)], "family string, rep_id int, member_id int")
    refs = spark.createDataFrame([("f", i) for i in range(0, 40, 3)], "family string, protein_id int")
    plan = V.threshold_grid(clusters, refs)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_threshold_grid_equals_brute_force(spark):
    rng = random.Random(3)
    clusters = [("f", rng.randint(1, 6), i) for i in range(40)]
    refs = [("f", i) for i in range(40) if rng.random() < 0.4]
    got = V.threshold_grid(spark.createDataFrame(clusters, "family string, rep_id int, member_id int"), spark.createDataFrame(refs, "family string, protein_id int")).first()
    ids = {r for _, r in refs}
    groups = {}
    for _, rep, m in clusters:
        groups.setdefault(rep, set()).add(m)
    best = (0, None)
    for i in range(202):
        for j in range(200):
            x, y = round(0.001 + 0.005 * i, 3), round(0.01 + 0.005 * j, 3)
            own = [g for g in groups.values() if g & ids and len(g & ids) / len(ids) >= x and len(g & ids) / len(g) >= y]
            tp = sum(len(g & ids) for g in own)
            fp = sum(len(g - ids) for g in own)
            if tp and 2 * tp / (tp + fp + len(ids)) >= best[0]:
                best = (2 * tp / (tp + fp + len(ids)), (x, y))
    assert got.f1 == pytest.approx(best[0]) and (got.fraction, got.density) == best[1]


def test_near_copies_cluster(spark):
    base = "the quick brown fox jumps over the lazy dog and runs through the green forest until night falls again"
    rows = [(1, base), (2, base + " x"), (3, "something quite different from all of the other sequences in here, really")]
    got = {r.member_id: r.rep_id for r in K.cluster(spark.createDataFrame(rows, "seq_id int, sequence string"), k=6, identity=0.7).collect()}
    assert got == {1: 2, 2: 2, 3: 3}


def test_readers(spark, tmp_path):
    (tmp_path / "G1.faa").write_text(">p1 # 3 # 90 # 1 # ID=1_1\nMKV\nLLA\n>p2_7 # 100 # 190 # -1 # x\nMM\n")
    (tmp_path / "G1.gff").write_text("##gff\nc1\tx\tCDS\t3\t90\t.\t+\t0\tID=cds-p1;locus_tag=L1\nc1\tx\tCDS\tbad\t90\t.\t+\t0\tID=p9\nshort\n")
    (tmp_path / "G1.tab").write_text("# c\np1\tq___1\t1e-9\t120.5\t1\t90\t88.1\np2\tq___2\t1e-9\tbad\t1\t90\t88.1\np3\tq\t1e-3\t50\t1\t9\t30\t0.5\n\nx\ty\n")
    (tmp_path / "patterns.txt").write_text("K1\tz\tb\tz\nK2\n\nK1\ta\n")
    (tmp_path / "tax.tsv").write_text("G1\td__B;p__P;c__C;o__O;f__F;g__G;s__G s\nG2\tp__P2\n")
    seqs = sources.read_fasta(spark, str(tmp_path / "G1.faa"))
    assert [(r.genome_id, r.protein_id, r.sequence) for r in seqs.orderBy("protein_id").collect()] == [("G1", "p1", "MKVLLA"), ("G1", "p2_7", "MM")]
    made = {r.protein_id: (r.contig, r.start_pos, r.end_pos, r.strand) for r in sources.features_from_headers(seqs).collect()}
    assert made == {"p1": ("p1", 3, 90, "+"), "p2_7": ("p2", 100, 190, "-")}
    assert [tuple(r) for r in sources.read_gff(spark, str(tmp_path / "G1.gff")).collect()] == [("G1", "p1", "c1", 3, 90, "+", "L1")]
    assert sorted((r.hit_id, r.bsr) for r in sources.read_hits(spark, str(tmp_path / "G1.tab")).collect()) == [("p1", 1.0), ("p3", 0.5)]
    assert [(r.keyword, r.pattern) for r in sources.read_patterns(spark, str(tmp_path / "patterns.txt")).collect()] == [("K1", ["b", "z"])]
    tax = {r.genome_id: (r.phylum, r.species) for r in sources.read_taxonomy(spark, str(tmp_path / "tax.tsv")).collect()}
    assert tax == {"G1": ("P", "G_s"), "G2": ("P2", "NA")}
    files = sources.list_files(spark, str(tmp_path))
    pairs, no_gff, no_faa = sources.input_pairs(files)
    assert (pairs.count(), no_gff.count(), no_faa.count()) == (1, 0, 0)
    sinks.write_fasta(seqs.withColumn("domain", F.lit("d")).select("domain", "protein_id", "sequence"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 4
    sinks.write_table(spark.createDataFrame([(1, ["a", "b"])], "i int, p array<string>"), str(tmp_path / "table"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "table")).first().p == "a b"


def test_group_patterns(spark):
    rows = [("a", ["1", "2", "3"]), ("b", ["1", "2", "4"]), ("c", ["8", "9"]), ("d", ["8", "9"])]
    got = {r.keyword: r.group_id for r in M.group_patterns(spark.createDataFrame(rows, "keyword string, pattern array<string>"), 0.5).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}
