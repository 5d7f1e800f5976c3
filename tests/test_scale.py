"""Operators that deal large groups out, against plain Python."""

import math
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusflow.operators import hits as H
from locusflow.operators import linkage
from locusflow.operators import mining as M
from locusflow.operators import naming as N
from locusflow.operators import neighbours as J
from locusflow.operators import presence as P
from locusflow.operators import ranges
from locusflow.operators import selection as S
from locusflow.operators import similarity as K
from locusflow.operators import skew
from locusflow.sources import sinks, store


def test_running_totals_cross_ranges(spark):
    rng = random.Random(1)
    rows = [(g, rng.randint(0, 5), i, rng.random() < 0.4) for i, g in enumerate(rng.choice(["a", "a", "a", "b", None]) for _ in range(200))]
    df = spark.createDataFrame(rows, "g string, v int, i int, x boolean")
    got = {r.i: (r["rank"], r.up) for r in ranges.running(df, ["g"], [F.desc("v"), F.col("i").asc()], {"up": F.col("x")}).collect()}
    want = {}
    for g in ("a", "b", None):
        up = 0
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            up += r[3]
            want[r[2]] = (n, up)
    assert got == want
    numbered = ranges.numbered(df.select("i"), [F.desc("i")])
    assert numbered.columns == ["i", "rank"] and {r.i: r["rank"] for r in numbered.collect()} == {i: 200 - i for i in range(200)}
    assert ranges.numbered(df.limit(0).select("i"), [F.desc("i")]).count() == 0


def average_linkage(sets, distance):
    """One merge at a time, the nearest pair first."""
    groups = [[k] for k in sorted(sets)]
    far = lambda a, b: 1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    while len(groups) > 1:
        mean, x, y = min((sum(far(a, b) for a in g for b in h) / (len(g) * len(h)), i, j) for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j)
        if mean > distance + 1e-9:
            break
        groups[x] = sorted(groups[x] + groups.pop(y))
        groups.sort()
    return {k: g[0] for g in groups for k in g}


@pytest.mark.parametrize("distance", [0.45, 0.72])
def test_linkage_in_rounds_equals_single_merges(spark, distance):
    rng = random.Random(7)
    # sizes and items that leave no two mean distances equal
    sets = {f"k{i:02d}": frozenset(rng.sample(range(31), rng.choice([5, 7, 9, 11]))) for i in range(14)}
    df = spark.createDataFrame([(k, sorted(map(str, s))) for k, s in sets.items()], "keyword string, pattern array<string>")
    assert {r.keyword: r.group_id for r in M.group_patterns(df, distance).collect()} == average_linkage(sets, distance)


@pytest.mark.parametrize("least", [0.0, 0.4, 0.75])
def test_similar_patterns_equal_all_pairs(spark, least):
    rng = random.Random(3)
    sets = {f"k{i}": set(rng.sample("abcdefghij", rng.randint(1, 6))) for i in range(30)}
    got = {(r.a, r.b): round(r.similarity, 9) for r in M.similar_patterns(spark.createDataFrame([(k, sorted(s)) for k, s in sets.items()], "keyword string, pattern array<string>"), least).collect()}
    want = {(a, b): round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9) for a in sets for b in sets if a < b and sets[a] & sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}
    assert got == want


def test_linkage_of_many_patterns_stays_in_components(spark):
    rng = random.Random(17)
    families = [rng.sample(range(i * 60, i * 60 + 90), 60) for i in range(8)]
    sets = {f"k{i:03d}": frozenset(rng.sample(rng.choice(families), rng.randint(30, 55)) + rng.sample(range(600), 3)) for i in range(160)}
    names = sorted(sets)
    like = np.array([[len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in names] for a in names])
    groups = {k: [i] for i, k in enumerate(names)}
    sums, size, live = like.copy(), np.ones(len(names)), np.ones(len(names), bool)
    while True:
        mean = np.where(np.outer(live, live) & ~np.eye(len(names), dtype=bool), sums / np.outer(size, size), -1)
        x, y = np.unravel_index(mean.argmax(), mean.shape)
        if mean[x, y] < 0.5 - 1e-9:
            break
        x, y = min(x, y), max(x, y)
        groups[names[x]] += groups.pop(names[y])
        sums[x] += sums[y]
        sums[:, x] += sums[:, y]
        size[x] += size[y]
        live[y] = False
    want = {names[i]: k for k, own in groups.items() for i in own}
    df = spark.createDataFrame([(k, [str(x) for x in s]) for k, s in sets.items()], "keyword string, pattern array<string>")
    assert {r.keyword: r.group_id for r in M.group_patterns(df, 0.5).collect()} == want and 8 < len(groups) < 120
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10 != 9] + [(100, 103), (101, 103), (102, 101)], "a int, b int")
    assert {r.node: r.component for r in M.components(edges).collect()} == {i: i - i % 10 for i in range(40)} | {i: 100 for i in range(100, 104)}


def test_next_match_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice("ABCD") for _ in range(rng.randint(0, 8))]) for i in range(20)]
    lists = spark.createDataFrame(rows, "cluster_id int, types array<string>")
    pairs = M.bigrams(lists, M.alphabet(M.dereplicate(lists)))
    seen = {(t[i], t[i + 1]) for _, t in rows for i in range(len(t) - 1)}
    want = {(c, i, b, next(j for j in range(i + 1, len(t)) if t[j] == b)) for c, t in rows for i in range(len(t)) for b in set(t[i + 1 :]) if (t[i], b) in seen}
    assert {tuple(r) for r in M.next_match(lists, pairs).collect()} == want


def grams(text, k):
    return {text[i : i + k] for i in range(len(text) - k + 1)}


@pytest.mark.parametrize("bound, letters, least", [(2_000_000, 1 << 18, 10_000), (0, 1 << 18, 10_000), (2_000_000, 50, 3), (0, 7, 1)])
def test_search_equals_brute_force(spark, monkeypatch, bound, letters, least):
    monkeypatch.setattr(K, "BROADCAST_SEEDS", bound)
    monkeypatch.setattr(K, "LETTERS", letters)
    monkeypatch.setattr(skew, "LEAST_ROWS", least)
    rng = random.Random(5)
    words = ["".join(rng.choice("acgtnöß") for _ in range(9)) for _ in range(12)]
    text = lambda n: "".join(rng.choice(words) for _ in range(n))
    targets = [(i, text(rng.randint(0, 40))) for i in range(30)] + [(99, None), (98, "ac")]
    queries = [(i, text(6)) for i in range(5)] + [(7, "")]
    got = {(r.query_id, r.target_id): (r.common, round(r.containment, 9)) for r in K.search(*(spark.createDataFrame(x, "seq_id int, sequence string") for x in (queries, targets)), k=8, top=3).collect()}
    want = {}
    for q, a in queries:
        own = {t: len(grams(a, 8) & grams(b or "", 8)) for t, b in targets}
        for t, n in own.items():
            if n and sum(m > n for m in own.values()) < 3:
                want[q, t] = (n, round(n / len(grams(a, 8)), 9))
    assert got == want


def test_seeds_are_the_same_wherever_a_kmer_is(spark):
    rng = random.Random(15)
    texts = [(i, "".join(rng.choice("acg") for _ in range(n))) for i, n in enumerate([0, 1, 5, 6, 7, 40, 40, 300])] + [(50, None)]
    found = K.super_kmers(spark.createDataFrame(texts, "seq_id int, sequence string").coalesce(1), 6).collect()
    for i, text in texts:
        own = [r.piece[j : j + 6] for r in found if r.seq_id == i for j in range(len(r.piece) - 5)]
        assert sorted(own) == sorted((text or "")[j : j + 6] for j in range(len(text or "") - 5))
    of = {}
    for r in found:
        for j in range(len(r.piece) - 5):
            assert of.setdefault(r.piece[j : j + 6], r.seed) == r.seed
    assert len({r.seed for r in found}) < len(of)


def test_hot_kmer_is_dealt_to_many_tasks(spark, monkeypatch):
    """One k-mer in every target: its rows go to parts of about the size of the other keys' tasks, and none is lost."""
    monkeypatch.setattr(skew, "LEAST_ROWS", 10)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = M.saved(spark.range(8000).select(F.col("id").alias("target_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("kmer")), "hot")
        hot = skew.hot_keys(rows, "kmer")
        sizes = [r["count"] for r in skew.dealt(rows, hot, "kmer").repartition("kmer", "_salt").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 4 * sorted(sizes)[len(sizes) // 2]
        other = spark.createDataFrame([("q", "hot"), ("r", "hot"), ("q", "k3")], "query_id string, kmer string")
        assert skew.salted_join(rows, other, "kmer").count() == 2 * 4000 + rows.filter("kmer = 'k3'").count()
        assert skew.salted_join(rows, other.select("kmer").distinct(), "kmer", "left_semi").count() == 4000 + rows.filter("kmer = 'k3'").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("identity, changes", [(0.9, 2), (0.7, 7), (0.4, 18)])
def test_every_member_is_near_its_centre(spark, identity, changes):
    """Families of sequences, each a copy of an earlier one with changes: members are verified, and near pairs are together."""
    rng = random.Random(6)
    rows = []
    for g in range(12):
        family = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300))]
        for c in range(8):
            own = list(rng.choice(family))
            for _ in range(rng.randint(1, changes)):
                own[rng.randrange(len(own))] = rng.choice("#+*")
            family.append("".join(own)[: rng.randint(280, 300)] if c % 3 == 0 else "".join(own))
        rows += [(g * 10 + i, t) for i, t in enumerate(family)]
    rows += [(500, "short"), (501, "short"), (502, "shorx"), (503, rows[0][1]), (504, ""), (505, None), (506, None)]
    texts = dict(rows)
    got = {r.member_id: r.rep_id for r in K.cluster(spark.createDataFrame(rows, "seq_id int, sequence string"), k=6, identity=identity).collect()}
    assert set(got) == set(texts) and got[501] == got[500] == 500 and got[502] == 502 and got[503] == got[0] and got[506] == got[505]
    sets = {i: grams(t or "", 6) for i, t in texts.items()}
    like = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    for member, rep in got.items():
        assert got[rep] == rep and (texts[member] == texts[rep] or like(member, rep) >= identity)
    near = [(a, b) for a in texts for b in texts if a < b and texts[a] != texts[b] and like(a, b) >= identity]
    # the same rounds with every pair as a candidate
    size = {i: (len(t or ""), -i) for i, t in texts.items()}
    pool = {i for i in texts if i == min(j for j in texts if texts[j] == texts[i])}
    up, exact = {i: {j for j in pool if size[j] > size[i] and like(i, j) >= identity} for i in pool}, {}
    centres = set()
    while linked := {i: up[i] & pool for i in pool - centres if up[i] & pool}:
        roots = {j for js in linked.values() for j in js} - set(linked)
        new = {i: max(js & roots, key=lambda j: (like(i, j), -j)) for i, js in linked.items() if js & roots}
        exact, centres, pool = exact | new, centres | set(new.values()), pool - set(new)
    wanted = {i: exact.get(i, i) for i in sets if i in up}
    both = [(a, b) for a in wanted for b in wanted if a < b and wanted[a] == wanted[b]]
    together = sum(got[a] == got[b] for a, b in both) / len(both)
    print(f"identity {identity}: {len(near)} near pairs, together {sum(got[a] == got[b] for a, b in near) / len(near):.3f} (all pairs as candidates: {sum(exact.get(a, a) == exact.get(b, b) for a, b in near) / len(near):.3f}); recall of that clustering {together:.3f}")
    assert len(near) > 50 and together >= 0.9


def plain_ward(points, threshold):
    """One merge at a time, always the nearest two groups."""
    groups = {i: [i] for i in points}
    mean = lambda own: [sum(points[i][x] for i in own) / len(own) for x in range(3)]
    while True:
        best = (threshold, None, None)
        middle = {g: mean(own) for g, own in groups.items()}
        for a in groups:
            for b in groups:
                if a < b:
                    na, nb = len(groups[a]), len(groups[b])
                    best = min(best, (math.sqrt(2 * na * nb / (na + nb) * sum((x - y) ** 2 for x, y in zip(middle[a], middle[b], strict=True))), a, b), key=lambda m: m[0])
        if best[1] is None:
            return {i: min(own) for own in groups.values() for i in own}
        groups[best[1]] += groups.pop(best[2])


@pytest.mark.parametrize("cell, threshold", [(500, 2.5), (8, 0.6)])
def test_ward_equals_one_by_one(spark, monkeypatch, cell, threshold):
    monkeypatch.setattr(linkage, "CELL_GROUPS", cell)
    rng = random.Random(12)
    centres = [[rng.uniform(-4, 4) for _ in range(3)] for _ in range(8)]
    points = {f"k{i:03}": [x + rng.gauss(0, 0.25) for x in rng.choice(centres)] for i in range(190)}
    points |= {f"s{i}": [1.0, 1.0, 1.0] for i in range(10)}
    frame = spark.createDataFrame([(k, *x) for k, x in points.items()] + [("z", None, 1.0, 1.0), (None, 1.0, 1.0, 1.0)], "k string, a double, b double, c double")
    got = {r.k: r.group_id for r in linkage.ward_groups(frame, "k", ["a", "b", "c"], threshold).collect()}
    want = plain_ward(points, threshold)
    assert got == want and 5 < len(set(want.values())) < 150
    assert linkage.ward_groups(frame.limit(0), "k", ["a", "b", "c"], 1.0).count() == 0


@pytest.mark.parametrize("mask", [-1, 1, 0])
def test_closed_patterns_settle_equal_signatures(spark, monkeypatch, mask):
    """Support sets that share a signature are told apart cluster by cluster."""
    monkeypatch.setattr(M, "SIGNATURE_MASK", mask)
    rng = random.Random(21)
    sets = [frozenset(rng.sample(range(9), 3)) for _ in range(5)] + [frozenset({1}), frozenset({2})]
    patterns = {tuple(rng.choice("abc") for _ in range(rng.randint(1, 4))): rng.choice(sets) for _ in range(40)}
    rows = [(list(p), c) for p, own in patterns.items() for c in own] * 2
    got = {(tuple(r.pattern), r.n) for r in M.closed_patterns(spark.createDataFrame(rows, "pattern array<string>, cluster_id int")).collect()}
    best = {}
    for p, own in patterns.items():
        best[own] = max(best.get(own, (0, ())), (len(p), p))
    assert got == {(p, len(own)) for own, (_, p) in best.items()}


def test_replicates_of_a_list_that_most_clusters_have(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_ROWS", 5)
    rows = [(i, ["a", "b"] if i % 3 else ["c", str(i % 4)]) for i in range(200)]
    lists = M.saved(spark.createDataFrame(rows, "cluster_id int, types array<string>"), "lists")
    first = {}
    for i, types in rows:
        first.setdefault(tuple(types), i)
    got = [tuple(r) for r in M.replicates(lists, M.dereplicate(lists)).select("cluster_id", "replicate").collect()]
    assert sorted(got) == sorted((first[tuple(t)], i) for i, t in rows)


@pytest.mark.parametrize("cells", [4_000_000, 1])
def test_logistic_models_equal_numpy_newton(spark, monkeypatch, cells):
    monkeypatch.setattr(P, "HESSIAN_CELLS", cells)
    rng = np.random.default_rng(31)
    domains = ["x", "y", "z", "all", "a.b`c"[:3]]
    rows = [(g, d, [f"{g}{d}"]) for g in range(150) for d in domains if d == "all" or rng.random() < (0.8 if d == "y" and g % 2 else 0.4)]
    scores = [(p, float(rng.normal(40, 15))) for _, _, own in rows for p in own]
    frame = spark.createDataFrame(rows, "genome_id int, domain string, proteins array<string>")
    got = {(r.target, r.feature): r.coefficient for r in P.logistic_models(frame.repartition(6), spark.createDataFrame(scores, "protein_id string, score double"), domains).collect()}
    value = dict(scores)
    has = {(g, d): value[own[0]] for g, d, own in rows}
    columns = [(d, k) for d in domains for k in ("present", "score")]
    x = np.array([[(((g, d) in has) if k == "present" else has.get((g, d), 0.0)) for d, k in columns] + [1.0] for g in range(150)], float)
    assert {t for t, _ in got} == {"x", "y", "z", "a.b"}
    for t in ("x", "y", "z", "a.b"):
        own = [i for i, (d, _) in enumerate(columns) if d != t] + [len(columns)]
        m, y, w = x[:, own], x[:, columns.index((t, "present"))], np.zeros(len(own))
        ridge = np.diag([1.0] * (len(own) - 1) + [0.0])
        for _ in range(60):
            p = 1 / (1 + np.exp(-m @ w))
            w = w + np.linalg.solve(m.T @ (m * (p * (1 - p))[:, None]) + ridge, m.T @ (y - p) - ridge @ w)
        want = {"_".join(columns[i]) if i < len(columns) else "intercept": c for i, c in zip(own, w, strict=True)}
        assert {f: c for (u, f), c in got.items() if u == t} == pytest.approx(want, abs=1e-6)


def test_quantiles_of_a_group_with_most_rows(spark):
    rng = random.Random(41)
    rows = [("big", float(rng.randint(0, 400))) for _ in range(900)] + [("few", float(rng.random())) for _ in range(7)] + [(None, 3.0), (None, 4.0), ("one", 5.0), ("none", None), ("big", None)]
    got = {r.g: (r.q0, r.q1, r.q2, r.q3) for r in ranges.quantiles(spark.createDataFrame(rows, "g string, v double").repartition(7), ["g"], "v", [0.0, 0.25, 0.5, 0.99]).collect()}
    want = {}
    for g in ("big", "few", None, "one"):
        own = [v for h, v in rows if h == g and v is not None]
        want[g] = tuple(float(np.quantile(own, p)) for p in (0.0, 0.25, 0.5, 0.99))
    assert set(got) == set(want) and all(got[g] == pytest.approx(want[g]) for g in want)


@pytest.mark.parametrize("least", [10_000, 4])
def test_subsets_with_a_hot_item_in_every_set(spark, monkeypatch, least):
    monkeypatch.setattr(skew, "LEAST_ROWS", least)
    rng = random.Random(51)
    pick = lambda most: ["hot"] + [f"i{rng.randrange(14)}" for _ in range(rng.randint(0, most))]
    rows = lambda n, most: [(rng.choice("de"), i, rng.choice([pick(most), pick(most) + pick(1)])) for i in range(n)]
    candidates, references = rows(120, 3) + [("d", 900, []), ("d", 901, ["unknown", "hot"]), ("x", 902, ["hot"]), ("x", 903, [])], rows(60, 6)
    schema = "domain string, protein_id int, neighbourhood array<string>"
    got = {(r.domain, r.protein_id) for r in J.subset_neighbourhoods(*(spark.createDataFrame(r, schema) for r in (candidates, references))).collect()}
    want = {(d, i) for d, i, s in candidates if any(e == d and set(s) <= set(r) for e, _, r in references)}
    assert got == want and 10 < len(want) < 124


@pytest.mark.parametrize("least, completeness, exact, min_types", [(10_000, 0.5, False, 1), (5, 0.5, False, 1), (5, 0.75, False, 3), (5, 0.5, True, 2), (10_000, 0.1, False, 1)])
def test_names_equal_all_pairs(spark, monkeypatch, least, completeness, exact, min_types):
    monkeypatch.setattr(skew, "LEAST_ROWS", least)
    rng = random.Random(61)
    found = [(i, ["hot"] * (i % 5 > 0) + [rng.choice("abcdefgh") for _ in range(rng.randint(0, 6))]) for i in range(80)]
    patterns = [(f"p{i}", [rng.choice(["hot", "z", *"abcdefgh"]) for _ in range(rng.randint(1, 6))]) for i in range(40)]
    got = {(r.cluster_id, r.keyword): (r.completeness, sorted(r.missing), sorted(r.additional)) for r in N.name_islands(spark.createDataFrame(found, "cluster_id int, types array<string>"), spark.createDataFrame(patterns, "keyword string, pattern array<string>"), completeness, min_types, exact).collect()}
    want = {}
    for c, types in found:
        for k, p in patterns:
            t, q = set(types), set(p)
            if len(t) >= min_types and t & q and len(t & q) / len(q) >= (1 if exact else completeness):
                want[c, k] = (len(t & q) / len(q), sorted(q - t), sorted(t - q))
    assert got == want and want


def test_store_keeps_first_rows_and_moves_no_stored_row(spark, tmp_path):
    schema = spark.createDataFrame([], "cluster_id string, protein_id int, start_pos int, domain string").schema
    layout = (["protein_id"], ["start_pos"], 8)
    path = str(tmp_path / "proteins")
    name = store.open_table(spark, path, schema, *layout)
    batch = lambda mark, ids: spark.createDataFrame([(f"c{i % 3}", i, 100 - i, mark) for i in ids] + [("c", None, 1, mark)], schema)
    store.append_new(spark, name, batch("one", range(0, 20)), ["protein_id"], ["domain"], *layout[1:])
    store.append_new(spark, name, batch("two", range(10, 30)).unionByName(batch("three", range(25, 35))), ["protein_id"], ["domain"], *layout[1:])
    # another session's entry for the same files
    again = store.open_table(spark, path, schema, *layout)
    store.append_new(spark, again, batch("four", range(0, 40)), ["protein_id"], ["domain"], *layout[1:])
    got = {r.protein_id: r.domain for r in spark.table(again).collect()}
    assert spark.table(again).count() == 40 and got == {i: "one" if i < 20 else "three" if 25 <= i < 35 else "two" if i < 30 else "four" for i in range(40)}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # the stored side of the anti join has no exchange, only the new rows have
        plan = batch("x", range(5)).join(spark.table(again).select("protein_id"), "protein_id", "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by_cluster = store.open_table(spark, str(tmp_path / "members"), schema, ["cluster_id"], ["cluster_id", "start_pos"], 8)
    store.append_all(spark, by_cluster, spark.table(again), ["cluster_id"], ["cluster_id", "start_pos"], 8)
    lists = store.cluster_lists(spark, by_cluster)
    assert "Exchange" not in lists._jdf.queryExecution().executedPlan().toString()
    assert {r.cluster_id: r.types for r in lists.collect()} == {f"c{c}": [got[i] for i in range(39, -1, -1) if i % 3 == c] for c in range(3)}


def test_rarest_items_and_ranks(spark):
    patterns = spark.createDataFrame([("p", ["a", "b"]), ("q", ["b", "c"]), ("r", ["b"])], "keyword string, pattern array<string>")
    assert {r.item: r["rank"] for r in N.item_rank(patterns).collect()} == {"a": 1, "c": 2, "b": 3}


def test_samples_of_large_groups(spark):
    refs = spark.createDataFrame([("d", i) for i in range(50)] + [("e", i) for i in range(100, 104)] + [("f", i) for i in range(200, 210)], "domain string, protein_id int")
    texts = spark.createDataFrame([(i, "M") for i in range(300)], "protein_id int, sequence string")
    got = sinks.training_sequences(refs, texts, 5, 20, 5).groupBy("domain").count().collect()
    assert {r.domain: r["count"] for r in got} == {"d": 20, "f": 10}


def test_one_hit_needs_no_fold(spark):
    rows = [("p", "A", 5, 9, 1.0, 0.5), ("q", "A", 1, 9, 1.0, 0.5), ("q", "B", 20, 30, 2.0, 0.5)]
    hits = spark.createDataFrame(rows, "hit_id string, domain string, sstart int, send int, bitscore double, bsr double")
    got = {r.hit_id: r.architecture for r in H.architecture(H.resolve_overlaps(hits, ["hit_id"], ["sstart"])).collect()}
    assert got == {"p": "A", "q": "A-B"}


def test_gapped_support_writes_no_table_for_each_length(spark, monkeypatch):
    lists = M.saved(spark.createDataFrame([(i, list("ABCDEFGH")) for i in range(4)] + [(9, ["A", None, "B", "C"])], "cluster_id int, types array<string>"), "lists")
    written = []
    monkeypatch.setattr(M, "saved", lambda df, name, put=M.saved: written.append(name) or put(df, name))
    got = {("".join(r.pattern), r.cluster_id) for r in M.gapped_support(lists, M.dereplicate(lists), k=1, q=1).collect()}
    assert len(written) <= 2
    assert {p for p, c in got if c == 9} == {"AB", "ABC", "BC"}
    assert {p for p, c in got if c == 0} == {"ABCDEFGH"[i:j] for i in range(8) for j in range(i + 2, 9)}


def test_replicates_come_last_in_clusters_of_keywords(spark):
    keywords = spark.createDataFrame([("k1", ["a", "b"]), ("k2", ["b", "c"])], "keyword string, pattern array<string>")
    support = spark.createDataFrame([(["a", "b"], 1), (["b", "c"], 1), (["b", "c"], 5)], "pattern array<string>, cluster_id int")
    copies = spark.createDataFrame([(1, 1), (1, 2), (5, 5)], "cluster_id int, replicate int")
    found = M.clusters_of(keywords, support, copies)
    assert sorted(map(tuple, found.collect())) == [("k1", 1), ("k1", 2), ("k2", 1), ("k2", 2), ("k2", 5)]
    # nothing regroups the rows once the replicates are there
    assert found._jdf.queryExecution().optimizedPlan().toString().startswith("Project")


def test_dereplicated_lists_name_their_replicates(spark):
    lists = spark.createDataFrame([(3, ["a", "b"]), (1, ["a", "b"]), (2, ["c"])], "cluster_id int, types array<string>")
    got = {(r.cluster_id, r.weight, tuple(r.replicates)) for r in M.dereplicate(lists, replicates=True).collect()}
    assert got == {(1, 2, (1, 3)), (2, 1, (2,))}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def innermost_join(df):
    return [line for line in plan_of(df).splitlines() if "Join" in line][-1]


def test_members_meet_the_keywords_of_their_own_cluster_first(spark):
    keywords = spark.createDataFrame([(c, "k") for c in range(4)], "cluster_id int, keyword string")
    members = spark.createDataFrame([(c, f"d{c}", f"p{c}") for c in range(4)], "cluster_id int, domain string, protein_id string")
    wanted = spark.createDataFrame([("k", f"d{i}") for i in range(1, 300)], "keyword string, domain string")
    found = S.proteins_of(wanted, keywords, members)
    assert sorted(map(tuple, found.collect())) == [("k", f"d{i}", f"p{i}") for i in (1, 2, 3)]
    assert "cluster_id" in innermost_join(found)
    wider = S.extend_by_keywords(spark.createDataFrame([("x", "q")], "domain string, protein_id string"), wanted, keywords, members)
    assert sorted(map(tuple, wider.collect())) == [("d1", "p1"), ("d2", "p2"), ("d3", "p3"), ("x", "q")]
    assert "cluster_id" in innermost_join(wider)


def test_support_model_counts_pairs_without_regrouping_the_sample(spark):
    sample = spark.createDataFrame([("t", g, d) for g in (1, 2, 3) for d in ("t", "x")] + [("t", 1, "y")], "target string, genome_id int, domain string")
    model = P.support_model(sample)
    assert [(r.target, r.feature, r.n, r.n_train) for r in model.collect()] == [("t", "x", 3, 3)]
    assert "genome_id" not in plan_of(model)


def test_balance_of_named_targets_joins_once(spark):
    model = spark.createDataFrame([("t", "x", 0.75), ("t", "y", 0.25), ("u", "x", 1.0), ("v", "x", 1.0)], "target string, feature string, weight double")
    have = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (2, "z")], "genome_id int, domain string")
    genomes = spark.createDataFrame([(1,), (1,), (2,), (3,)], "genome_id int")
    found = P.balance(model, have, genomes, ["t", "u", "none"])
    assert sorted(map(tuple, found.collect())) == [("t", 1, 1.0), ("t", 2, -0.5), ("t", 3, -1.0), ("u", 1, 1.0), ("u", 2, -1.0), ("u", 3, -1.0)]
    assert plan_of(found).count("Join ") == 1


def test_plausible_hits_ask_for_own_domains_only(spark):
    model = spark.createDataFrame([("t", "x", 0.75), ("t", "y", 0.25), ("u", "x", 1.0)], "target string, feature string, weight double")
    have = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "genome_id int, domain string")
    hits = spark.createDataFrame([(1, "t", "a", 9.0, 1.0), (1, "t", "b", 8.0, 1.0), (2, "t", "c", 5.0, 1.0), (3, "u", "d", 5.0, 0.1)], "genome_id int, domain string, protein_id string, score double, bsr double")
    found = P.plausible_hits(hits, model, have, 0.0)
    assert list(map(tuple, found.collect())) == [(1, "t", "a", 9.0, 0.5)]
    # the best hits meet their genome's features first
    assert "genome_id" in innermost_join(found)


def test_statistics_are_stored_before_their_linkage(spark, monkeypatch):
    from locusflow import plans

    written = []
    monkeypatch.setattr(plans.M, "saved", lambda df, name, put=M.saved: written.append(name) or put(df, name))
    rows = spark.createDataFrame([("k", "a", 1.0, 1.0, 0.0), ("k", "b", 1.1, 1.0, 0.0), ("l", "a", 9.0, 9.0, 0.0)], "keyword string, domain string, median_score double, mean_score double, std_score double")
    got = {(r.keyword, r.domain): r.group_id for r in plans.group_keywords(rows, 0.5).collect()}
    assert got == {("k", "a"): "k/a", ("k", "b"): "k/a", ("l", "a"): "l/a"} and "statistics" in written


def test_pairs_of_earlier_rounds_are_not_verified_again(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    head = word(60)
    # all share the head; only 1 and 2, and 3 and 4, are near
    near, other = word(200), word(150)
    rows = [(0, head + word(400)), (1, head + near + "xyz"), (2, head + near), (3, head + other + "pq"), (4, head + other)]
    seen = []
    monkeypatch.setattr(K, "_similar", lambda pairs, *more, put=K._similar: seen.extend((r.seq_id, r.rep_id) for r in pairs.select("seq_id", "rep_id").collect()) or put(pairs, *more))
    got = {r.member_id: r.rep_id for r in K.cluster(spark.createDataFrame(rows, "seq_id int, sequence string"), k=8, identity=0.7).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 3, 4: 3}
    assert (1, 0) in seen and len(seen) == len(set(seen))


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data")}


def tables_of(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = M.saved(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n")), "counts")
    for _ in range(100):  # executors remove them in their own time
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and table.count() == 97
    assert spark.conf.get(M.CLEANUP) == "false"


def test_pairs_of_clusters_are_verified_in_slices(spark, monkeypatch):
    """The texts of all pairs never meet at once, and nothing but the result stays."""
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(150)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(x[: 150 - j] + "z" * (j % 3) for x in texts for j in range(8))] + [(200, None), (201, texts[0])]
    sequences = spark.createDataFrame(rows, "seq_id int, sequence string")
    want = {(r.rep_id, r.member_id) for r in K.cluster(sequences, k=8, identity=0.7).collect()}
    monkeypatch.setattr(K, "SLICE_PAIRS", 9)
    monkeypatch.setattr(K, "SLICE_LETTERS", 1000)
    seen = []
    monkeypatch.setattr(K, "_compared", lambda near, *more, put=K._compared: seen.append(near.count()) or put(near, *more))
    before = tables_of(spark)
    got = K.cluster(sequences, k=8, identity=0.7)
    assert len(tables_of(spark) - before) == 1
    assert {(r.rep_id, r.member_id) for r in got.collect()} == want and len(want) == len(rows)
    assert len(seen) > 3 and max(seen) <= 9


@pytest.mark.parametrize("small", [3, 40, 500_000])
def test_keywords_of_coded_lists_equal_their_steps(spark, monkeypatch, small):
    """C8: numbered genes, patterns too many to be broadcast, signatures in steps; of its tables only what the rows are read from stays."""
    from locusflow import plans

    rng = random.Random(8)
    genes = [None, "A", "Aa", "B", "b", *(f"g{i}" for i in range(300))]
    rows = [(i, [genes[rng.randrange(9)] for _ in range(rng.randint(2, 7))]) for i in range(60)]
    rows += [(100 + i, rows[i % 5][1]) for i in range(12)] + [(300 + i, genes[5 + 3 * i : 8 + 3 * i][:: 1 - 2 * (i % 2)]) for i in range(98)] + [(500, ["b", "A", "b"]), (501, ["A", "b", "g9"])]
    lists = spark.createDataFrame(rows, "cluster_id int, types array<string>")
    kept = M.saved(M.filter_lists(lists), "lists")
    derep = M.dereplicate(kept)
    support = M.merge_reversed(M.gapped_support(derep.select("cluster_id", "types"), derep, 2, 2))
    want = sorted(map(tuple, M.clusters_of(M.number_patterns(M.closed_patterns(support).select("pattern")), support, M.replicates(kept, derep)).collect()))
    monkeypatch.setattr(skew, "SMALL_ROWS", small)
    monkeypatch.setattr(M, "SIGNED_PAIRS", 50)
    before = tables_of(spark)
    found = plans.islands_to_keywords(lists, 2, 2)
    assert len(tables_of(spark) - before) <= 3
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


def test_stored_steps_in_slices_equal_the_plain_ones(spark, monkeypatch):
    from locusflow.operators import sets as U

    rng = random.Random(5)
    refset = M.saved(spark.createDataFrame([(f"d{rng.randrange(4)}", f"p{rng.randrange(40)}") for _ in range(60)], "domain string, protein_id string"), "refset")
    proteins = M.saved(spark.createDataFrame([(f"p{i}", i % 7) for i in range(40)] + [(None, 1)], "protein_id string, genome_id int"), "proteins")
    monkeypatch.setattr(M, "SLICE_ROWS", 10)
    carried = P.carried(refset, proteins)
    assert sorted(map(tuple, carried.collect())) == sorted((r.genome_id, r.domain) for r in P.presence(refset, proteins).collect())
    more = M.saved(spark.createDataFrame([("d1", "p1"), (None, "p1"), (None, "p1"), ("d9", None)], "domain string, protein_id string"), "more")
    key = lambda rows: sorted(map(str, map(tuple, rows)))
    assert key(U.stored_union(refset, more).collect()) == key(U.union(refset, more).collect())


def test_extension_by_synteny_stores_only_its_result(spark, monkeypatch):
    """C5 in slices: the rows of its steps joined, and of its tables only the result and the numbers of keywords stay."""
    from locusflow import plans
    from locusflow.operators import sets as U

    rng = random.Random(6)
    rows = [(c, c % 9, f"p{c}-{i}", rng.choice("abcd"), rng.random(), rng.random()) for c in range(40) for i in range(3)]
    members = spark.createDataFrame(rows, "cluster_id int, genome_id int, protein_id string, domain string, score double, bsr double")
    refset = members.filter("score > 0.6").select("domain", "protein_id")
    patterns = spark.createDataFrame([("k1", ["a", "b"]), ("k2", ["c", "d"]), ("k3", ["e"])], "keyword string, pattern array<string>")
    keywords = spark.createDataFrame([(c, f"k{c % 4}") for c in range(0, 40, 3)] + [(0, "k1")], "cluster_id int, keyword string")
    wanted = P.similar_to_domain(patterns, 0.5).select("domain", "keyword")
    plausible = P.plausible_hits(members, P.support_model(P.positive_sample(refset, members, None)), P.presence(refset, members), -0.5)
    want = sorted(map(tuple, U.union(S.extend_by_keywords(refset, wanted, keywords, members), plausible).collect()))
    monkeypatch.setattr(M, "SLICE_ROWS", 30)
    before = tables_of(spark)
    found = plans.extend_by_synteny(refset, patterns, keywords, members, None, 0.5, -0.5, None)
    assert {name.rsplit("-", 1)[0] for name in tables_of(spark) - before} == {"union"}
    assert sorted(map(tuple, found.collect())) == want and refset.count() < len(want) < len(rows)


@pytest.mark.parametrize("min_seqs", [1, 2])
def test_seed_groups_make_nothing_that_singletons_replace(spark, monkeypatch, min_seqs):
    """C4 in slices: groups as the plain steps give them, singletons over them, and only the result stays."""
    from locusflow import plans
    from locusflow.operators import sets as U

    rng = random.Random(9)
    rows = [(c, (c + i) % 6 if i % 5 else 7, f"p{c}-{i}", f"d{i % 5}", 50.0 + rng.randrange(50)) for c in range(60) for i in range(5)] + [(999, 7, "q", "d1", 10.0), (998, 7, "r", "d2", 20.0), (5, 7, "only", "d8", 80.0)]
    members = spark.createDataFrame(rows, "cluster_id int, genome_id int, protein_id string, domain string, score double")
    keywords = spark.createDataFrame([(c, f"csb-{c % 3}") for c in range(60)] + [(1, "csb-1"), (1, "x")], "cluster_id int, keyword string")
    stats, query = S.keyword_statistics(keywords, members), S.query_scores(members, 7)
    passing = S.passing_domains(S.drop_low_quality(stats, query), query)
    plain = S.add_queries(S.drop_query_only(U.combine(S.proteins_of(passing, keywords, members, min_seqs)), members, 7), members.filter("genome_id = 7"))
    single = M.saved(spark.createDataFrame([("d1", "s1", 1.0), ("d1", "s1", 2.0), ("new", "s2", 1.0)], "domain string, protein_id string, score double"), "single")
    monkeypatch.setattr(M, "SLICE_ROWS", 50)
    asked = []
    monkeypatch.setattr(S, "members_by_keywords", lambda pairs, *more, put=S.members_by_keywords: asked.extend(r.domain for r in pairs.collect()) or put(pairs, *more))
    before = tables_of(spark)
    groups = plans.seed_groups(keywords, members, 7, None, min_seqs)
    whole = plans.seed_groups(keywords, members, 7, single, min_seqs)
    assert {name.rsplit("-", 1)[0] for name in tables_of(spark) - before} == {"union"}
    assert sorted(map(tuple, groups.collect())) == sorted(map(tuple, plain.collect())) and groups.count() > 100
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, U.overwrite(plain, single).collect()))
    asked.clear()
    plans.seed_groups(keywords, members, 7, single, 1)
    assert asked and "d1" not in asked
