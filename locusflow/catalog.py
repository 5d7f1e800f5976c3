"""Queries over the driver's tables, one or more for each operator, with the DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusflow import adapters as A
from locusflow import functions as fn
from locusflow import sources, streaming
from locusflow.adapters import sql
from locusflow.operators import hits as H
from locusflow.operators import islands as I
from locusflow.operators import mining as M
from locusflow.operators import naming as N
from locusflow.operators import neighbours as J
from locusflow.operators import presence as P
from locusflow.operators import reports as R
from locusflow.operators import selection as S
from locusflow.operators import sets as U
from locusflow.operators import similarity as K
from locusflow.operators import validation as V
from locusflow.operators.ranges import numbered, quantiles, running
from locusflow.sources import sinks, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function under its name, with SQL if SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def r6(c):
    return F.round(c, 6)


# ---- hits ---------------------------------------------------------------------------

COVERED = "SELECT h.*, q.length, q.self_score, (abs(send - sstart) + 1)::DOUBLE / q.length AS coverage FROM hits h LEFT JOIN query_table q USING (query_id)"
PASSES = "((evalue <= 1e-5 AND bitscore >= 100 AND coverage >= 0.6) OR (pident >= 25 AND coverage >= 0.6))"
HIT_COLUMNS = ("genome_id", "hit_id", "query_id", "evalue", "bitscore", "sstart", "send", "pident")
HIT_LIST = ", ".join(HIT_COLUMNS)


@query(sql("hits query_table", f"SELECT {HIT_LIST} FROM c WHERE {PASSES}", c=COVERED))
def f1_hit_filter(spark, d):
    return H.filter_hits(A.hits(spark, d), A.query_table(spark, d)).select(*HIT_COLUMNS)


@query(sql("hits query_table", f"SELECT {HIT_LIST}, length IS NULL AS unknown FROM c WHERE {PASSES} OR length IS NULL", c=COVERED.replace("query_table q", "(SELECT * FROM query_table WHERE length > 60) q")))
def f2_hit_filter_keep_unknown(spark, d):
    known = A.query_table(spark, d).filter("length > 60")
    return H.filter_hits(A.hits(spark, d), known, keep_unknown=True).select(*HIT_COLUMNS, F.col("length").isNull().alias("unknown"))


@query(sql("hits query_table", f"SELECT {HIT_LIST}, coalesce(bitscore / self_score, 1.0) AS bsr FROM c", c=COVERED))
def f3_score_ratio(spark, d):
    return H.score_ratio(H.with_coverage(A.hits(spark, d), A.query_table(spark, d))).select(*HIT_COLUMNS, "bsr")


@query(sql("hits", "SELECT regexp_replace(query_id, '___[0-9]+$', '') AS domain, count(*) AS n FROM hits GROUP BY 1"))
def f4_strip_query_suffix(spark, d):
    return H.domain_of(A.hits(spark, d)).groupBy("domain").agg(F.count("*").alias("n"))


@query(sql("hits", "SELECT regexp_replace(query_id, '^.*?___', '') AS own, count(*) AS n FROM hits GROUP BY 1"))
def f5_strip_genome_prefix(spark, d):
    return A.hits(spark, d).groupBy(fn.strip_genome_prefix("query_id").alias("own")).agg(F.count("*").alias("n"))


def _resolved(spark, d, **options):
    hits = H.domain_of(H.score_ratio(H.with_coverage(A.hits(spark, d), A.query_table(spark, d))))
    return H.resolve_overlaps(hits, ["genome_id", "hit_id"], ["evalue", "bitscore", "sstart", "send", "query_id", "pident"], **options)


#: The overlap fold, hit by hit: a hit goes if a kept one it overlaps is as good, else it takes the place of all it overlaps.
def _fold(order: str) -> dict[str, str]:
    return dict(
        scored=COVERED,
        listed=f"SELECT genome_id, hit_id, list(struct_pack(s := sstart, e := send, domain := regexp_replace(query_id, '___[0-9]+$', ''), score := bitscore) ORDER BY {order}) AS hits FROM scored GROUP BY ALL",
        fold="SELECT genome_id, hit_id, hits, 1 AS i, hits[:0] AS kept FROM listed UNION ALL SELECT genome_id, hit_id, hits, i + 1, CASE WHEN len(list_filter(kept, lambda k: k.s <= hits[i].e AND hits[i].s <= k.e AND k.score >= hits[i].score)) > 0 THEN kept ELSE list_append(list_filter(kept, lambda k: NOT (k.s <= hits[i].e AND hits[i].s <= k.e)), hits[i]) END FROM fold WHERE i <= len(hits)",
        resolved="SELECT genome_id, hit_id, list_sort(kept) AS kept FROM fold WHERE i > len(hits)",
    )


ARRIVAL, BEST_FIRST = "evalue, bitscore, sstart, send, query_id, pident", "bitscore DESC, sstart, regexp_replace(query_id, '___[0-9]+$', ''), send"
ARCHITECTURE = "array_to_string(list_transform(kept, lambda k: k.domain), '-') AS architecture, array_to_string(list_transform(kept, lambda k: k.s || ':' || k.e), '-') AS coordinates, len(kept) AS dom_count"


def recursive(text: str) -> str:
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


@query(recursive(sql("hits query_table", "SELECT genome_id, hit_id, len(kept) AS n FROM resolved WHERE len(kept) <= 1", **_fold(ARRIVAL))))
def f6_single_domain(spark, d):
    return H.single_domain(_resolved(spark, d)).select("genome_id", "hit_id", F.size("domains").alias("n"))


@query(recursive(sql("hits query_table", f"SELECT genome_id, hit_id, {ARCHITECTURE}, array_to_string(list_transform(kept, lambda k: trunc(k.score)::BIGINT), '-') AS scores FROM resolved", **_fold(ARRIVAL))))
def a2_resolve_overlaps(spark, d):
    return H.architecture(_resolved(spark, d)).select("genome_id", "hit_id", "architecture", "coordinates", "scores", "dom_count")


@query(recursive(sql("hits query_table", f"SELECT genome_id, hit_id, {ARCHITECTURE} FROM resolved", **_fold(BEST_FIRST))))
def a3_resolve_best_first(spark, d):
    return H.architecture(_resolved(spark, d, best_first=True)).select("genome_id", "hit_id", "architecture", "coordinates", "dom_count")


@query(
    sql(
        "hits",
        "SELECT a.genome_id, a.hit_id, count(*) AS n FROM hits a JOIN hits b ON a.genome_id = b.genome_id AND a.hit_id = b.hit_id AND a.query_id < b.query_id WHERE a.sstart <= b.send AND b.sstart <= a.send GROUP BY ALL",
    )
)
def a1_overlapping_hits(spark, d):
    a = A.hits(spark, d).alias("a")
    b = A.hits(spark, d).alias("b")
    same = (F.col("a.genome_id") == F.col("b.genome_id")) & (F.col("a.hit_id") == F.col("b.hit_id")) & (F.col("a.query_id") < F.col("b.query_id"))
    meet = fn.intervals_overlap(F.col("a.sstart"), F.col("a.send"), F.col("b.sstart"), F.col("b.send"))
    return a.join(b, same).filter(meet).groupBy("a.genome_id", "a.hit_id").agg(F.count("*").alias("n"))


@query(
    sql(
        "hits",
        "SELECT genome_id, hit_id, string_agg(query_id, '-' ORDER BY sstart, query_id, send) AS architecture, string_agg(sstart || ':' || send, '-' ORDER BY sstart, query_id, send) AS coordinates, count(DISTINCT query_id) AS domains FROM (SELECT DISTINCT genome_id, hit_id, query_id, sstart, send FROM hits) GROUP BY ALL",
    )
)
def a4_architecture(spark, d):
    rows = A.hits(spark, d).select("genome_id", "hit_id", F.col("query_id").alias("domain"), "sstart", "send").distinct()
    items = F.array_sort(F.collect_list(F.struct("sstart", "domain", F.col("sstart").alias("start"), F.col("send").alias("end"))))
    domains = F.transform("own", lambda x: F.struct(x["domain"].alias("domain"), x["start"].alias("start"), x["end"].alias("end"), F.lit(0.0).alias("score")))
    found = H.architecture(rows.groupBy("genome_id", "hit_id").agg(items.alias("own")).select("genome_id", "hit_id", domains.alias("domains")))
    return found.select("genome_id", "hit_id", "architecture", "coordinates", F.size("domain_set").cast("long").alias("domains"))


@query("SELECT o_orderkey, array_to_string(list_sort(list_distinct([o_orderstatus, o_orderpriority, 'Tc'])), ',') AS tokens FROM orders")
def a5_comment_tokens(spark, d):
    text = F.concat_ws(" , ", "o_orderstatus", "o_orderpriority", F.lit("Tc"), F.lit(""), "o_orderstatus")
    return A.table(spark, d, "orders").select("o_orderkey", fn.comment_set(text).alias("tokens"))


@query(
    sql(
        "genes",
        "SELECT p.protein_id, coalesce(g.contig, -1) AS contig, coalesce(g.start_pos, -1) AS start_pos FROM (SELECT genome_id, protein_id FROM genes) p LEFT JOIN (SELECT * FROM genes WHERE domain <> 'error') g ON p.genome_id = g.genome_id AND p.protein_id = g.protein_id",
    )
)
def a6_attach_features(spark, d):
    genes = A.genes(spark, d)
    known = genes.filter(F.col("domain") != "error")
    return H.attach_features(genes.select("genome_id", "protein_id"), known).select("protein_id", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("contig", "start_pos")))


@query(sql("hits", "SELECT query_id, max(bitscore) AS self_score FROM hits GROUP BY 1"))
def g2_best_self_scores(spark, d):
    return H.best_self_scores(A.hits(spark, d))


@query(sql("hits", "SELECT DISTINCT split_part(genome_id || '___' || hit_id, '___', 1) AS genome_id FROM hits"))
def f14_genomes_of_hits(spark, d):
    return H.genomes_of(A.hits(spark, d).select(F.concat_ws("___", "genome_id", "hit_id").alias("hit_id")))


@query(sql("hits", "SELECT CASE WHEN (SELECT max(n) FROM (SELECT count(*) AS n FROM hits GROUP BY hit_id, query_id)) > 1 THEN genome_id || '___' || hit_id ELSE hit_id END AS hit_id, query_id FROM hits"))
def f15_unique_ids(spark, d):
    return H.unique_ids(A.hits(spark, d)).select("hit_id", "query_id")


# ---- islands ------------------------------------------------------------------------

GAP = 10_800
ISLANDS = dict(
    marked=f"SELECT *, CASE WHEN start_pos - lag(end_pos) OVER w <= {GAP} THEN 0 ELSE 1 END AS fresh FROM genes WINDOW w AS (PARTITION BY genome_id, contig ORDER BY start_pos, protein_id)",
    runs="SELECT *, sum(fresh) OVER (PARTITION BY genome_id, contig ORDER BY start_pos, protein_id ROWS UNBOUNDED PRECEDING) AS run FROM marked",
    sized="SELECT *, count(*) OVER (PARTITION BY genome_id, contig, run) AS size FROM runs",
    members_of="SELECT genome_id, contig, protein_id, start_pos, end_pos, domain, score, dense_rank() OVER (PARTITION BY genome_id ORDER BY contig, run) AS island FROM sized WHERE size >= 2",
    island_members="SELECT *, genome_id || '_' || island AS cluster_id FROM members_of",
)


def _island_members(spark, d):
    return I.island_members(A.genes(spark, d), GAP)


@query(sql("genes", "SELECT cluster_id, island, protein_id FROM island_members", **ISLANDS))
def s1_island_members(spark, d):
    return _island_members(spark, d).select("cluster_id", "island", "protein_id")


@query(
    sql(
        "genes",
        "SELECT cluster_id, genome_id, contig, min(start_pos) AS lo, max(end_pos) AS hi, string_agg(protein_id::VARCHAR, ',' ORDER BY start_pos, protein_id) AS genes, string_agg(domain, ',' ORDER BY start_pos, protein_id) AS types FROM island_members GROUP BY ALL",
        **ISLANDS,
    )
)
def s2_islands(spark, d):
    found = I.islands(_island_members(spark, d))
    return found.select("cluster_id", "genome_id", "contig", "lo", "hi", F.array_join("genes", ",").alias("genes"), F.array_join("types", ",").alias("types"))


@query(
    sql(
        "genes",
        "SELECT cluster_id, string_agg(DISTINCT domain, ',' ORDER BY domain) AS type_set, count(*) AS n FROM island_members GROUP BY ALL",
        **ISLANDS,
    )
)
def s3_type_sets(spark, d):
    prefixed = _island_members(spark, d).withColumn("domain", F.concat(F.lit("grp0_"), "domain"))
    found = I.type_lists(I.islands(prefixed))
    return found.select("cluster_id", F.array_join("type_set", ",").alias("type_set"), F.size("type_list").cast("long").alias("n"))


@query(sql("genes", "SELECT DISTINCT cluster_id, 'kw' AS keyword, protein_id FROM island_members WHERE domain IN ('click', 'error')", **ISLANDS))
def s4_covered_proteins(spark, d):
    members = _island_members(spark, d)
    patterns = members.select("cluster_id").distinct().select("cluster_id", F.lit("kw").alias("keyword"), F.array(F.lit("click"), F.lit("error")).alias("pattern"))
    return I.covered_proteins(members, patterns)


# ---- mining --------------------------------------------------------------------------

FILTERED = "SELECT cluster_id, types FROM gene_lists WHERE len(list_distinct(types)) >= 3 AND len(types) <= 40 AND list_max(list_transform(types, lambda x: len(list_filter(types, lambda y: y = x)))) <= 2"
DEREP = "SELECT types, min(cluster_id) AS cluster_id, count(*) AS weight, list(cluster_id ORDER BY cluster_id) AS replicates FROM filtered GROUP BY types"
PLACES = "SELECT cluster_id, types[i] AS gene, i - 1 AS pos FROM (SELECT cluster_id, types, unnest(range(1, len(types) + 1)) AS i FROM filtered)"


def _lists(spark, d):
    return M.filter_lists(A.gene_lists(spark, d))


def _text(c):
    return F.array_join(c, ",")


@query(sql("gene_lists", "SELECT cluster_id, array_to_string(types, ',') AS types FROM filtered", filtered=FILTERED))
def f7_cluster_filter(spark, d):
    return _lists(spark, d).select("cluster_id", _text("types").alias("types"))


@query(sql("gene_lists", "SELECT row_number() OVER (ORDER BY len(types), cluster_id) AS n, cluster_id FROM filtered", filtered=FILTERED))
def m1_sorted_clusters(spark, d):
    lists = _lists(spark, d).select(F.size("types").alias("length"), "cluster_id")
    return numbered(lists, [F.col("length").asc(), F.col("cluster_id").asc()]).select(F.col("rank").alias("n"), "cluster_id")


@query(sql("gene_lists", "SELECT array_to_string(types, ',') AS types, cluster_id, weight, array_to_string(replicates, ',') AS replicates FROM derep", filtered=FILTERED, derep=DEREP))
def m2_dereplicate(spark, d):
    return M.dereplicate(_lists(spark, d), replicates=True).select(_text("types").alias("types"), "cluster_id", "weight", _text("replicates").alias("replicates"))


@query(sql("gene_lists", "SELECT cluster_id, unnest(replicates) AS replicate FROM derep", filtered=FILTERED, derep=DEREP))
def m2_replicates(spark, d):
    lists = M.saved(_lists(spark, d), "filtered")
    return M.replicates(lists, M.dereplicate(lists))


@query(sql("gene_lists", "SELECT gene, sum(weight)::BIGINT AS support FROM (SELECT unnest(types) AS gene, weight FROM derep) GROUP BY gene HAVING sum(weight) >= 100", filtered=FILTERED, derep=DEREP))
def m3_alphabet(spark, d):
    return M.alphabet(M.dereplicate(_lists(spark, d)), 100)


@query(sql("gene_lists", "SELECT gene, cluster_id, pos FROM places", filtered=FILTERED, places=PLACES))
def m4_positions(spark, d):
    return M.positions(_lists(spark, d)).select("gene", "cluster_id", F.col("pos").cast("long").alias("pos"))


BIGRAMS = "SELECT DISTINCT types[i] AS a, types[i + 1] AS b FROM (SELECT types, unnest(range(1, len(types))) AS i FROM filtered)"


@query(sql("gene_lists", "SELECT a, b FROM bigrams", filtered=FILTERED, bigrams=BIGRAMS))
def m5_bigrams(spark, d):
    lists = _lists(spark, d)
    return M.bigrams(lists, M.alphabet(M.dereplicate(lists), 1))


@query(
    sql(
        "gene_lists",
        "SELECT x.cluster_id, x.pos, y.gene AS b, min(y.pos) AS next FROM places x JOIN places y ON x.cluster_id = y.cluster_id AND y.pos > x.pos JOIN bigrams g ON g.a = x.gene AND g.b = y.gene GROUP BY ALL",
        filtered=FILTERED,
        places=PLACES,
        bigrams=BIGRAMS,
    )
)
def m6_next_match(spark, d):
    lists = _lists(spark, d)
    found = M.next_match(lists, M.bigrams(lists, M.alphabet(M.dereplicate(lists), 1)))
    return found.select("cluster_id", F.col("pos").cast("long").alias("pos"), "b", F.col("next").cast("long").alias("next"))


SUBLISTS = "SELECT DISTINCT types[s:s + m - 1] AS pattern FROM (SELECT types, s, unnest(range(2, len(types) - s + 2)) AS m FROM (SELECT types, unnest(range(1, len(types) + 1)) AS s FROM filtered)) WHERE m >= 2"


@query(sql("gene_lists", "SELECT len(pattern) AS length, count(*) AS n FROM sublists GROUP BY 1", filtered=FILTERED, sublists=SUBLISTS))
def m7_sublists(spark, d):
    lists = _lists(spark, d)
    found = M.sublists(lists, M.alphabet(M.dereplicate(lists), 1))
    return found.groupBy(F.size("pattern").cast("long").alias("length")).agg(F.count("*").alias("n"))


#: Instances of candidate patterns with at most two insertions, gene by gene: each next gene at its first later place.
GAPPED = dict(
    filtered=FILTERED,
    derep=DEREP,
    spots="SELECT cluster_id, i - 1 AS pos, types[i] AS gene FROM (SELECT cluster_id, types, unnest(range(1, len(types) + 1)) AS i FROM derep)",
    sublists="SELECT DISTINCT types[s:s + m - 1] AS pattern FROM (SELECT types, s, unnest(range(2, len(types) - s + 2)) AS m FROM (SELECT types, unnest(range(1, len(types) + 1)) AS s FROM derep)) WHERE m >= 2",
    steps="SELECT x.cluster_id, x.pos, y.gene AS b, min(y.pos) AS next FROM spots x JOIN spots y ON x.cluster_id = y.cluster_id AND y.pos > x.pos GROUP BY ALL",
    grown="SELECT [gene] AS pattern, cluster_id, pos AS s, pos AS e FROM spots UNION ALL SELECT w.pattern, g.cluster_id, g.s, n.next FROM grown g JOIN steps n ON n.cluster_id = g.cluster_id AND n.pos = g.e AND n.next - g.s - len(g.pattern) <= 2 JOIN sublists w ON w.pattern = list_append(g.pattern, n.b)",
    found="SELECT DISTINCT pattern, cluster_id FROM grown WHERE len(pattern) > 1",
    support="SELECT pattern, cluster_id FROM found WHERE pattern IN (SELECT pattern FROM found JOIN derep USING (cluster_id) GROUP BY pattern HAVING sum(weight) >= 3)",
)


@query(recursive(sql("gene_lists", "SELECT array_to_string(pattern, ',') AS pattern, count(*) AS n FROM support GROUP BY 1", **GAPPED)))
def m8_gapped_support(spark, d):
    lists = _lists(spark, d)
    support = M.gapped_support(lists, M.dereplicate(lists), k=2, q=3)
    return support.groupBy("pattern").agg(F.count("*").alias("n")).select(_text("pattern").alias("pattern"), "n")


PAIRS = "SELECT DISTINCT [types[i], types[i + 1]] AS pattern, cluster_id FROM (SELECT cluster_id, types, unnest(range(1, len(types))) AS i FROM filtered)"


def _pair_support(spark, d):
    at = F.sequence(F.lit(1), F.size("types") - 1)
    pairs = F.transform(at, lambda i: F.array(F.get("types", i - 1), F.get("types", i)))
    return _lists(spark, d).select(F.explode(pairs).alias("pattern"), "cluster_id").distinct()


MERGED = "SELECT DISTINCT CASE WHEN pattern <= list_reverse(pattern) THEN pattern ELSE list_reverse(pattern) END AS pattern, cluster_id FROM pairs"


@query(sql("gene_lists", "SELECT array_to_string(pattern, ',') AS pattern, count(*) AS n FROM merged GROUP BY 1", filtered=FILTERED, pairs=PAIRS, merged=MERGED))
def m9_merge_reversed(spark, d):
    return M.merge_reversed(_pair_support(spark, d)).groupBy("pattern").agg(F.count("*").alias("n")).select(_text("pattern").alias("pattern"), "n")


@query(
    sql(
        "gene_lists",
        "SELECT array_to_string(max(pattern), ',') AS pattern, len(clusters) AS n FROM (SELECT pattern, list(cluster_id ORDER BY cluster_id) AS clusters FROM pairs GROUP BY pattern) GROUP BY clusters",
        filtered=FILTERED,
        pairs=PAIRS,
    )
)
def m10_closed_patterns(spark, d):
    return M.closed_patterns(_pair_support(spark, d)).select(_text("pattern").alias("pattern"), "n")


@query(
    sql(
        "",
        "SELECT a.cluster_id, b.cluster_id AS other, round(len(list_intersect(a.types, b.types))::DOUBLE / len(list_distinct(list_concat(a.types, b.types))), 6) AS similarity FROM gl a JOIN gl b ON b.cluster_id = a.cluster_id + 1",
        gene_lists=A.CTE["gene_lists"],
        gl="SELECT cluster_id, list_distinct(types) AS types FROM gene_lists",
    )
)
def m11_jaccard(spark, d):
    lists = A.gene_lists(spark, d)
    other = lists.select((F.col("cluster_id") - 1).alias("cluster_id"), F.col("cluster_id").alias("other"), F.col("types").alias("theirs"))
    return lists.join(other, "cluster_id").select("cluster_id", "other", r6(fn.jaccard("types", "theirs")).alias("similarity"))


PATTERN_TABLES = dict(
    gene_lists=A.CTE["gene_lists"],
    filtered=FILTERED,
    triples="SELECT DISTINCT types[i:i + 2] AS pattern FROM (SELECT types, unnest(range(1, len(types) - 1)) AS i FROM filtered)",
    patterns="SELECT array_to_string(pattern, '-') AS keyword, list_sort(list_distinct(pattern)) AS pattern FROM triples",
)
ISLAND_PATTERNS = dict(
    genes=A.CTE["genes"],
    **ISLANDS,
    island_lists="SELECT cluster_id, list(domain ORDER BY start_pos, protein_id) AS types FROM island_members GROUP BY cluster_id",
    triples=PATTERN_TABLES["triples"].replace("filtered", "island_lists"),
    patterns=PATTERN_TABLES["patterns"],
)


def _triples(lists):
    """Every neighbourhood of three genes in the lists, as a pattern."""
    at = F.sequence(F.lit(1), F.size("types") - 2)
    found = lists.filter(F.size("types") > 2).select(F.explode(F.array_distinct(F.transform(at, lambda i: F.slice("types", i, 3)))).alias("pattern")).distinct()
    return found.select(F.array_join("pattern", "-").alias("keyword"), F.array_sort(F.array_distinct("pattern")).alias("pattern"))


def _patterns(spark, d):
    """Patterns of all gene lists of orders."""
    return _triples(_lists(spark, d))


def _island_lists(spark, d):
    return I.islands(_island_members(spark, d)).select("cluster_id", "types")


def _island_patterns(spark, d):
    """Patterns of all islands."""
    return _triples(_island_lists(spark, d))


@query(
    sql(
        "",
        "SELECT a.keyword AS a, b.keyword AS b, round(len(list_intersect(a.pattern, b.pattern))::DOUBLE / len(list_distinct(list_concat(a.pattern, b.pattern))), 6) AS similarity FROM patterns a JOIN patterns b ON a.keyword < b.keyword WHERE len(list_intersect(a.pattern, b.pattern)) > 0",
        **ISLAND_PATTERNS,
    )
)
def m12_similar_patterns(spark, d):
    return M.similar_patterns(_island_patterns(spark, d)).select("a", "b", r6("similarity").alias("similarity"))


@query(
    sql(
        "gene_lists",
        "SELECT 'csb-' || dense_rank() OVER (ORDER BY len(pattern), pattern) || '_' AS keyword, array_to_string(pattern, ',') AS pattern FROM (SELECT DISTINCT pattern FROM pairs)",
        filtered=FILTERED,
        pairs=PAIRS,
    )
)
def m13_number_patterns(spark, d):
    return M.number_patterns(_pair_support(spark, d).select("pattern").distinct()).select("keyword", _text("pattern").alias("pattern"))


@query()
def m13_group_patterns(spark, d):
    return M.group_patterns(_island_patterns(spark, d), 0.6)


@query(
    sql(
        "gene_lists",
        "SELECT p.keyword, u.cluster_id FROM (SELECT array_to_string(types[1:2], '-') AS keyword, unnest(replicates) AS cluster_id FROM derep) u JOIN (SELECT DISTINCT array_to_string(types[1:2], '-') AS keyword FROM derep) p USING (keyword)",
        filtered=FILTERED,
        derep=DEREP,
    )
)
def m14_clusters_of_keywords(spark, d):
    lists = M.saved(_lists(spark, d), "filtered")
    derep = M.dereplicate(lists)
    support = derep.select(F.slice("types", 1, 2).alias("pattern"), "cluster_id")
    named = support.select("pattern").distinct().withColumn("keyword", F.array_join("pattern", "-"))
    return M.clusters_of(named, support, M.replicates(lists, derep))


@query(sql("gene_lists", "SELECT cluster_id, len(types) AS n FROM gene_lists WHERE len(types) >= 6"))
def f8_pattern_length(spark, d):
    return A.gene_lists(spark, d).filter(F.size("types") >= 6).select("cluster_id", F.size("types").cast("long").alias("n"))


# ---- naming ----------------------------------------------------------------------------

NAMED = dict(
    ISLAND_PATTERNS,
    have="SELECT cluster_id, list_distinct(types) AS types FROM island_lists",
    pairs="SELECT cluster_id, keyword, types, pattern, len(list_intersect(types, pattern)) AS common FROM have, patterns WHERE len(list_intersect(types, pattern)) > 0",
)


@query(
    sql(
        "",
        "SELECT cluster_id, keyword, round(common::DOUBLE / len(pattern), 6) AS completeness, array_to_string(list_sort(list_filter(pattern, lambda x: NOT list_contains(types, x))), ',') AS missing, array_to_string(list_sort(list_filter(types, lambda x: NOT list_contains(pattern, x))), ',') AS additional FROM pairs WHERE common::DOUBLE / len(pattern) >= 0.5",
        **NAMED,
    )
)
def n1_name_islands(spark, d):
    found = N.name_islands(_island_lists(spark, d), _island_patterns(spark, d))
    return found.select("cluster_id", "keyword", r6("completeness").alias("completeness"), _text("missing").alias("missing"), _text("additional").alias("additional"))


@query(sql("", "SELECT cluster_id, keyword FROM pairs WHERE common = len(pattern) AND len(types) > 1", **NAMED))
def n2_name_islands_exact(spark, d):
    return N.name_islands(_island_lists(spark, d), _island_patterns(spark, d), min_types=2, exact=True).select("cluster_id", "keyword")


@query(
    sql(
        "",
        "SELECT DISTINCT h.cluster_id, r.keyword FROM have h, (SELECT keyword, arg_min(item, (n, item)) AS item FROM (SELECT keyword, item, count(*) OVER (PARTITION BY item) AS n FROM items) GROUP BY keyword) r WHERE list_contains(h.types, r.item)",
        **ISLAND_PATTERNS,
        have=NAMED["have"],
        items="SELECT keyword, unnest(pattern) AS item FROM patterns",
    )
)
def n3_rarest_item_candidates(spark, d):
    return N.rarest_item_candidates(_island_lists(spark, d), _island_patterns(spark, d))


@query(sql("", "SELECT item, count(*) AS n FROM (SELECT keyword, unnest(pattern) AS item FROM patterns) GROUP BY item", **PATTERN_TABLES))
def g11_item_frequency(spark, d):
    return N.item_frequency(_patterns(spark, d))


# ---- neighbourhoods -----------------------------------------------------------------------


def _placed(spark, d):
    """All genes with the island they are in, null without one."""
    genes = A.genes(spark, d)
    return genes.join(_island_members(spark, d).select("protein_id", "cluster_id"), "protein_id", "left")


PLACED = dict(ISLANDS, placed="SELECT g.*, m.cluster_id FROM genes g LEFT JOIN island_members m USING (protein_id)", lists="SELECT cluster_id, list(domain ORDER BY start_pos, protein_id) AS neighbourhood FROM island_members GROUP BY 1")
HOODS = dict(PLACED, hoods="SELECT p.protein_id, p.cluster_id, coalesce(l.neighbourhood, ['singleton']) AS neighbourhood FROM placed p LEFT JOIN lists l USING (cluster_id)")


def _hoods(spark, d):
    return J.neighbourhoods(A.genes(spark, d), _placed(spark, d))


@query(sql("genes", "SELECT protein_id, cluster_id, array_to_string(neighbourhood, ',') AS neighbourhood FROM hoods", **HOODS))
def j7_neighbourhoods(spark, d):
    return _hoods(spark, d).select("protein_id", "cluster_id", _text("neighbourhood").alias("neighbourhood"))


@query(sql("genes", "SELECT array_to_string(list_sort(neighbourhood), ',') AS composition, count(*) AS n FROM hoods GROUP BY 1", **HOODS))
def g6_compositions(spark, d):
    return J.compositions(_hoods(spark, d)).select(_text("composition").alias("composition"), "n")


@query(sql("genes", "SELECT array_to_string(list_sort(list_distinct(neighbourhood)), ',') AS composition, count(*) AS n FROM hoods GROUP BY 1", **HOODS))
def g6_composition_sets(spark, d):
    return J.compositions(_hoods(spark, d), as_set=True).select(_text("composition").alias("composition"), "n")


@query(
    sql(
        "genes",
        "SELECT domain, protein_id FROM (SELECT domain, protein_id, list_distinct(neighbourhood) AS s FROM hoods JOIN genes USING (protein_id) WHERE score < 50) c WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT domain, list_sort(list_distinct(neighbourhood)) AS r FROM hoods JOIN genes USING (protein_id) WHERE score >= 50) k WHERE k.domain = c.domain AND list_has_all(k.r, c.s))",
        **HOODS,
    )
)
def p11_subset_neighbourhoods(spark, d):
    rows = _hoods(spark, d).join(A.genes(spark, d).select("protein_id", "domain", "score"), "protein_id")
    return J.subset_neighbourhoods(rows.filter("score < 50"), rows.filter("score >= 50")).select("domain", "protein_id")


# ---- selection -------------------------------------------------------------------------------

STATS = dict(stats="SELECT keyword, domain, count(*) AS n, min(score) AS min_score, max(score) AS max_score, avg(score) AS mean_score, median(score) AS median_score, coalesce(stddev_samp(score), 0) AS std_score FROM keywords JOIN members USING (cluster_id) GROUP BY ALL")
QUERYS = dict(STATS, query="SELECT domain, min(score) AS query_score FROM members WHERE genome_id = 7 GROUP BY 1")


def _stats(spark, d):
    return S.keyword_statistics(A.keywords(spark, d), A.members(spark, d))


def _query_scores(spark, d, how="min"):
    return S.query_scores(A.members(spark, d), 7, how)


#: Keywords of fewer orders, some without the prefix, and query scores high enough that some of them fail.
STRICT = dict(
    keywords="SELECT o_orderkey AS cluster_id, CASE WHEN o_custkey % 3 = 0 THEN 'set-' ELSE 'csb-' END || o_custkey % 400 AS keyword FROM orders",
    **STATS,
    query="SELECT domain, 45 * min(score) AS query_score FROM members WHERE genome_id = 7 AND domain < 'Brand#2' GROUP BY 1",
)


def _strict(spark, d):
    prefix = F.when(F.col("o_custkey") % 3 == 0, "set-").otherwise("csb-")
    keywords = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("cluster_id"), F.concat(prefix, (F.col("o_custkey") % 400).cast("string")).alias("keyword"))
    query = _query_scores(spark, d).filter("domain < 'Brand#2'").withColumn("query_score", F.col("query_score") * 45)
    return S.keyword_statistics(keywords, A.members(spark, d)), query


@query(sql("members keywords", "SELECT keyword, domain, n, min_score, max_score, round(mean_score, 4) AS mean_score, round(median_score, 4) AS median_score, round(std_score, 4) AS std_score FROM stats", **STATS))
def g1_keyword_statistics(spark, d):
    r4 = lambda c: F.round(c, 4).alias(c)
    return _stats(spark, d).select("keyword", "domain", "n", "min_score", "max_score", r4("mean_score"), r4("median_score"), r4("std_score"))


@query(sql("members", "SELECT domain, min(score) AS query_score FROM members WHERE genome_id = 7 GROUP BY 1"))
def g3_query_scores(spark, d):
    return _query_scores(spark, d)


@query(sql("members keywords", "SELECT DISTINCT keyword FROM keywords WHERE keyword NOT IN (SELECT keyword FROM stats WHERE domain = 'Brand#2' AND max_score >= (SELECT median(max_score) FROM stats WHERE domain = 'Brand#2') AND starts_with(keyword, 'csb-'))", **STATS))
def f9_exclude_types(spark, d):
    stats = _stats(spark, d)
    middle = stats.filter("domain = 'Brand#2'").agg(F.median("max_score").alias("middle"))
    strong = stats.join(F.broadcast(middle), F.col("max_score") >= F.col("middle")).drop("middle")
    return S.exclude_types(A.keywords(spark, d), strong, ["Brand#2"]).select("keyword").distinct()


@query(
    sql(
        "members",
        "SELECT keyword, domain, n FROM stats WHERE keyword IN (SELECT keyword FROM stats LEFT JOIN query USING (domain) GROUP BY keyword HAVING max(n) >= 10 AND (bool_or(coalesce(median_score >= query_score * 0.7, false)) OR NOT starts_with(keyword, 'csb-')))",
        **STRICT,
    )
)
def f10_drop_low_quality(spark, d):
    return S.drop_low_quality(*_strict(spark, d)).select("keyword", "domain", "n")


@query(sql("members", "SELECT keyword, domain FROM stats JOIN query USING (domain) WHERE max_score >= query_score * 0.7", **STRICT))
def c1_passing_domains(spark, d):
    return S.passing_domains(*_strict(spark, d))


@query(sql("members", "SELECT keyword, domain FROM stats WHERE keyword IN (SELECT keyword FROM stats JOIN query USING (domain) WHERE max_score >= query_score * (1 - 0.3))", **STRICT))
def c2_passing_keywords(spark, d):
    return S.passing_keywords(*_strict(spark, d))


@query(sql("members keywords", "SELECT s.domain, min(min_score) AS lower, max(max_score) AS upper FROM stats s JOIN query USING (domain) WHERE max_score >= query_score * 0.7 GROUP BY 1", **QUERYS))
def g4_score_limits(spark, d):
    stats = _stats(spark, d)
    return S.score_limits(stats, S.passing_domains(stats, _query_scores(spark, d)))


def _segments(spark, d):
    """The reference set by market segments, and scores of its proteins: the orders' prices in thousands."""
    prices = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), F.col("o_totalprice").alias("score"))
    return A.refset(spark, d), prices


@query(sql("refset", "SELECT domain, coalesce(min(o_totalprice), 100.0) AS lower, coalesce(max(o_totalprice), 2000.0) AS upper FROM refset LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = protein_id GROUP BY 1"))
def g5_refset_limits(spark, d):
    refs, prices = _segments(spark, d)
    closed = A.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("protein_id"))
    return S.refset_limits(refs, prices.join(closed, "protein_id", "left_semi"))


@query(
    sql(
        "refset",
        "SELECT domain, protein_id, o_totalprice AS score FROM refset JOIN orders ON o_orderkey = protein_id WHERE o_totalprice BETWEEN 1000 AND 400000 QUALIFY rank() OVER (PARTITION BY domain ORDER BY o_totalprice DESC) <= 50",
    )
)
def w3_top_by_score(spark, d):
    refs, prices = _segments(spark, d)
    limits = refs.select("domain").distinct().select("domain", F.lit(1000.0).alias("lower"), F.lit(400000.0).alias("upper"))
    return S.top_by_score(refs, prices, 50, limits)


@query(sql("members keywords", "SELECT keyword, domain, n FROM stats WHERE keyword IN (SELECT keyword FROM stats QUALIFY row_number() OVER (PARTITION BY domain ORDER BY max_score DESC, keyword) = 1)", **STATS))
def w4_best_keyword(spark, d):
    return S.best_keyword(_stats(spark, d)).select("keyword", "domain", "n")


@query(
    sql(
        "members keywords",
        "SELECT keyword, domain, count(*) AS n FROM (SELECT DISTINCT k.keyword, m.domain, m.protein_id FROM keywords k JOIN members m USING (cluster_id) JOIN passing p ON p.keyword = k.keyword AND p.domain = m.domain) GROUP BY ALL HAVING count(*) >= 400",
        **QUERYS,
        passing="SELECT keyword, domain FROM stats JOIN query USING (domain) WHERE max_score >= query_score * 0.7",
    )
)
def j1_proteins_of_keywords(spark, d):
    tasks = S.passing_domains(_stats(spark, d), _query_scores(spark, d))
    found = S.proteins_of(tasks, A.keywords(spark, d), A.members(spark, d), 400)
    return found.groupBy("keyword", "domain").agg(F.count("*").alias("n"))


@query(sql("members keywords", "SELECT domain, count(*) AS n, max(score) AS top FROM keywords JOIN members USING (cluster_id) WHERE keyword = 'csb-5-LOW' GROUP BY 1"))
def j2_keyword_scores(spark, d):
    found = S.keyword_scores(A.keywords(spark, d), A.members(spark, d), "csb-5-LOW")
    return found.groupBy("domain").agg(F.count("*").alias("n"), F.max("score").alias("top"))


@query(sql("members best_members keywords", "SELECT DISTINCT protein_id, keyword FROM keywords JOIN members USING (cluster_id) WHERE protein_id IN (SELECT protein_id FROM best_members)"))
def j3_keywords_of_proteins(spark, d):
    members = A.members(spark, d)
    return S.keywords_of(A.best_members(spark, d), members, A.keywords(spark, d))


@query(
    sql(
        "members best_members keywords",
        "SELECT domain, count(*) AS n FROM (SELECT domain, protein_id FROM best_members UNION SELECT domain, protein_id FROM members JOIN keywords USING (cluster_id) WHERE keyword = 'csb-1-URGENT' AND domain < 'Brand#2') GROUP BY 1",
    )
)
def j4_extend_by_keywords(spark, d):
    members = A.members(spark, d)
    wanted = members.select("domain").distinct().filter("domain < 'Brand#2'").withColumn("keyword", F.lit("csb-1-URGENT"))
    return S.extend_by_keywords(A.best_members(spark, d), wanted, A.keywords(spark, d), members).groupBy("domain").agg(F.count("*").alias("n"))


FREE = "SELECT DISTINCT domain, protein_id, genome_id FROM placed WHERE cluster_id IS NULL AND score >= 70"


@query(sql("genes", FREE, **PLACED))
def j5_context_free(spark, d):
    return S.context_free(_placed(spark, d).withColumn("identity", F.col("score")))


@query(sql("refset", "SELECT domain, protein_id FROM refset UNION SELECT c_mktsegment, -c_custkey FROM customer WHERE c_mktsegment IN (SELECT domain FROM refset)"))
def j9_add_queries(spark, d):
    queries = A.table(spark, d, "customer").select(F.col("c_mktsegment").alias("domain"), (-F.col("c_custkey")).alias("protein_id"))
    return S.add_queries(A.refset(spark, d), queries)


@query(sql("refset", "SELECT DISTINCT domain, protein_id FROM refset WHERE domain IN ('BUILDING', 'MACHINERY') AND domain NOT IN ('MACHINERY')"))
def f11_domain_lists(spark, d):
    return S.exclude_domains(S.include_domains(A.refset(spark, d), ["BUILDING", "MACHINERY"]), ["MACHINERY"]).distinct()


SMALL_SETS = "SELECT DISTINCT domain || '_' || identity || '_' || start_pos AS domain, protein_id FROM members"


def _small_sets(spark, d):
    members = A.members(spark, d)
    return members.select(F.concat_ws("_", "domain", "identity", "start_pos").alias("domain"), "protein_id").distinct(), members


@query(sql("members", "SELECT domain, protein_id FROM s WHERE domain IN (SELECT s.domain FROM s JOIN members m ON m.protein_id = s.protein_id WHERE m.genome_id <> 7)", s=SMALL_SETS))
def f12_drop_query_only(spark, d):
    refs, members = _small_sets(spark, d)
    return S.drop_query_only(refs, members, 7)


@query(sql("members", "SELECT DISTINCT domain, protein_id FROM s WHERE domain IN (SELECT s.domain FROM s JOIN members m USING (protein_id) WHERE m.genome_id = 7)", s=SMALL_SETS))
def f13_query_owned(spark, d):
    refs, members = _small_sets(spark, d)
    return S.query_owned(refs, members.select("protein_id", "genome_id").join(refs, "protein_id"), 7)


# ---- sets --------------------------------------------------------------------------------------

A_SET = "SELECT r.* FROM refset r JOIN orders ON o_orderkey = protein_id WHERE o_orderstatus <> 'F'"
B_SET = "SELECT r.* FROM refset r JOIN orders ON o_orderkey = protein_id WHERE o_orderpriority < '4' AND domain <> 'BUILDING'"


def _two_sets(spark, d):
    """Two reference sets: proteins of open orders, and of urgent orders without one segment."""
    orders = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), "o_orderstatus", "o_orderpriority")
    refs = A.refset(spark, d).join(orders, "protein_id")
    of = lambda rule: refs.filter(rule).select("domain", "protein_id")
    return of("o_orderstatus <> 'F'"), of("o_orderpriority < '4' and domain <> 'BUILDING'")


@query(sql("refset", "SELECT * FROM a UNION SELECT * FROM b", a=A_SET, b=B_SET))
def u1_union(spark, d):
    return U.union(*_two_sets(spark, d))


@query(sql("refset", "SELECT * FROM a UNION SELECT * FROM b", a=A_SET, b=B_SET))
def u2_union_plain(spark, d):
    a, b = _two_sets(spark, d)
    return U.union_plain(a.withColumn("domain", F.concat(F.lit("grp0_"), "domain")), b)


@query(sql("refset", "SELECT DISTINCT * FROM a WHERE domain NOT IN (SELECT domain FROM b) UNION SELECT * FROM b", a=A_SET, b=B_SET))
def u3_overwrite(spark, d):
    return U.overwrite(*_two_sets(spark, d))


@query(sql("members keywords", "SELECT DISTINCT domain, protein_id FROM members JOIN keywords USING (cluster_id)"))
def u4_combine(spark, d):
    return U.combine(A.members(spark, d).join(A.keywords(spark, d), "cluster_id"))


@query(sql("refset", "SELECT * FROM a EXCEPT SELECT * FROM b", a=A_SET, b=B_SET))
def u5_difference(spark, d):
    return U.difference(*_two_sets(spark, d))


@query(sql("refset", "SELECT * FROM a INTERSECT SELECT * FROM b", a=A_SET, b=B_SET))
def u6_intersection(spark, d):
    return U.intersection(*_two_sets(spark, d))


@query(
    sql(
        "refset",
        "SELECT domain, count(*) FILTER (x AND y) AS kept, count(*) FILTER (x AND NOT y) AS lost, count(*) FILTER (y AND NOT x) AS added FROM (SELECT domain, protein_id, bool_or(s = 1) AS x, bool_or(s = 2) AS y FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, 2 FROM b) GROUP BY ALL) GROUP BY 1",
        a=A_SET,
        b=B_SET,
    )
)
def g14_added_counts(spark, d):
    return U.added_counts(*_two_sets(spark, d))


# ---- presence ---------------------------------------------------------------------------------------

PAM = dict(
    refs_of="SELECT DISTINCT domain, protein_id FROM carriers",
    pam="SELECT m.genome_id, r.domain, list(DISTINCT r.protein_id ORDER BY r.protein_id) AS proteins FROM refs_of r JOIN carriers m ON m.protein_id = r.protein_id GROUP BY ALL",
    carried="SELECT DISTINCT genome_id, domain FROM pam",
)


def _refs(spark, d):
    members = A.carriers(spark, d)
    return members.select("domain", "protein_id").distinct(), members


def _pam(spark, d):
    return P.presence(*_refs(spark, d))


@query(sql("carriers", "SELECT genome_id, domain, array_to_string(proteins, ',') AS proteins FROM pam", **PAM))
def p1_presence(spark, d):
    return _pam(spark, d).select("genome_id", "domain", _text("proteins").alias("proteins"))


@query(sql("carriers", "SELECT genome_id, max((domain = 'Brand#1')::INTEGER) AS \"Brand#1\", max((domain = 'Brand#2')::INTEGER) AS \"Brand#2\" FROM pam GROUP BY 1", **PAM))
def p1_presence_wide(spark, d):
    return P.presence_wide(_pam(spark, d), ["Brand#1", "Brand#2"])


SEEDS = "SELECT DISTINCT domain AS seed, genome_id FROM carriers QUALIFY score = max(score) OVER (PARTITION BY domain)"


def _seeds(spark, d):
    """The genomes with the best hit of each domain."""
    members = A.carriers(spark, d)
    best = members.groupBy("domain").agg(F.max("score").alias("score"))
    return members.join(best, ["domain", "score"], "left_semi").select(F.col("domain").alias("seed"), "genome_id").distinct()


IN_ALL = dict(
    seeds=SEEDS,
    own="SELECT DISTINCT genome_id, domain FROM carriers WHERE identity >= 70",
    in_all="SELECT seed, domain FROM (SELECT s.seed, o.domain, count(*) AS found FROM seeds s JOIN own o USING (genome_id) GROUP BY ALL) JOIN (SELECT seed, count(*) AS needed FROM seeds GROUP BY 1) USING (seed) WHERE found = needed",
)


@query(sql("carriers", "SELECT seed, domain FROM in_all", **IN_ALL))
def p2_domains_in_all(spark, d):
    return P.domains_in_all(_seeds(spark, d), A.carriers(spark, d))


WITH_ALL = dict(IN_ALL, have="SELECT DISTINCT genome_id, domain FROM carriers ", matches="SELECT seed, genome_id FROM (SELECT i.seed, h.genome_id, count(*) AS found FROM in_all i JOIN have h ON h.domain = i.domain GROUP BY ALL) JOIN (SELECT seed, count(*) AS needed FROM in_all GROUP BY 1) USING (seed) WHERE found = needed")


@query(sql("carriers", "SELECT seed, genome_id FROM matches", **WITH_ALL))
def p3_genomes_with_all(spark, d):
    members = A.carriers(spark, d)
    return P.genomes_with_all(P.domains_in_all(_seeds(spark, d), members), members)


SEED_REFS = dict(WITH_ALL, seed_refs="SELECT DISTINCT m.domain, m.protein_id, m.score FROM matches x JOIN carriers m ON m.genome_id = x.genome_id AND m.domain = x.seed")


def _seed_references(spark, d):
    from locusflow.plans import context_free_references

    members = M.saved(A.carriers(spark, d).select("genome_id", "protein_id", "domain", "score", "identity"), "members")
    return context_free_references(_seeds(spark, d), members, members)


@query(sql("carriers", "SELECT domain, protein_id, score FROM seed_refs", **SEED_REFS))
def p4_seed_references(spark, d):
    return _seed_references(spark, d)


@query(sql("carriers", "SELECT domain, min(score) AS lower, max(score) AS upper FROM seed_refs GROUP BY 1", **SEED_REFS))
def p4_seed_limits(spark, d):
    return P.seed_limits(_seed_references(spark, d))


SAMPLE = dict(PAM, sample="SELECT t.domain AS target, c.genome_id, c.domain FROM carried t JOIN carried c USING (genome_id)")


@query(sql("carriers", "SELECT target, domain, count(*) AS n FROM sample GROUP BY ALL", **SAMPLE))
def p5_positive_sample(spark, d):
    return P.positive_sample(*_refs(spark, d), limit=None).groupBy("target", "domain").agg(F.count("*").alias("n"))


@query(sql("carriers", "SELECT target, least(count(DISTINCT genome_id), 100) AS n FROM sample GROUP BY 1", **SAMPLE))
def p5_sample_sizes(spark, d):
    """A sample of 100 genomes for each target: which ones goes by a hash, how many is known."""
    return P.positive_sample(*_refs(spark, d), limit=100).groupBy("target").agg(F.count_distinct("genome_id").alias("n"))


MODEL = dict(
    SAMPLE,
    totals="SELECT target, count(DISTINCT genome_id) AS n_train FROM sample GROUP BY 1",
    counts="SELECT target, domain AS feature, count(*) AS n FROM sample WHERE domain <> target GROUP BY ALL HAVING count(*) >= 2",
    strong="SELECT target, feature, n, n_train, greatest(1e-12, least(1 - 1e-12, (n + 1.0::DOUBLE) / (n_train + 2.0::DOUBLE))) AS p FROM counts JOIN totals USING (target)",
    model="SELECT *, -ln(1 - p) AS strength, -ln(1 - p) / sum(-ln(1 - p)) OVER (PARTITION BY target) AS weight FROM strong",
)


def _model(spark, d):
    return P.support_model(P.positive_sample(*_refs(spark, d), limit=None))


@query(sql("carriers", "SELECT target, feature, n, n_train, round(p, 6) AS p, round(strength, 6) AS strength, round(weight, 6) AS weight FROM model", **MODEL))
def p6_support_model(spark, d):
    return _model(spark, d).select("target", "feature", "n", "n_train", r6("p").alias("p"), r6("strength").alias("strength"), r6("weight").alias("weight"))


BALANCE = dict(
    MODEL,
    balance="SELECT t.target, g.genome_id, 2 * coalesce(sum(CASE WHEN c.domain IS NOT NULL THEN m.weight END), 0) - 1 AS balance FROM (SELECT DISTINCT target FROM model) t CROSS JOIN (SELECT DISTINCT genome_id FROM carriers) g JOIN model m ON m.target = t.target LEFT JOIN carried c ON c.genome_id = g.genome_id AND c.domain = m.feature GROUP BY ALL",
)


@query(sql("carriers", "SELECT target, genome_id, round(balance, 6) AS balance FROM balance", **BALANCE))
def p7_balance(spark, d):
    found = P.balance(_model(spark, d), _pam(spark, d), A.carriers(spark, d), [f"Brand#{i}" for i in range(1, 26)])
    return found.select("target", "genome_id", r6("balance").alias("balance"))


BEST = "SELECT genome_id, domain, protein_id, score FROM carriers WHERE score / 100000 >= 0.3 QUALIFY row_number() OVER (PARTITION BY genome_id, domain ORDER BY score DESC, protein_id) = 1"


def _with_ratio(spark, d):
    return A.carriers(spark, d).withColumn("bsr", F.col("score") / 100000)


@query(sql("carriers", BEST))
def w2_best_hits(spark, d):
    return P.best_hits(_with_ratio(spark, d)).select("genome_id", "domain", "protein_id", "score")


@query(sql("carriers", "SELECT b.genome_id, b.domain, b.protein_id, b.score, round(a.balance, 6) AS balance FROM best b JOIN balance a ON a.genome_id = b.genome_id AND a.target = b.domain WHERE a.balance >= -0.7", **BALANCE, best=BEST))
def p8_plausible_hits(spark, d):
    found = P.plausible_hits(_with_ratio(spark, d), _model(spark, d), _pam(spark, d), -0.7)
    return found.withColumn("balance", r6("balance"))


@query()
def p9_logistic_models(spark, d):
    return P.logistic_models(_pam(spark, d), A.carriers(spark, d), ["Brand#1", "Brand#2", "Brand#3"])


@query(
    sql(
        "carriers",
        "SELECT genome_id, max(CASE WHEN domain = 'Brand#1' THEN 1 ELSE 0 END) AS \"Brand#1_present\", coalesce(max(score) FILTER (domain = 'Brand#1'), 0) AS \"Brand#1_score\" FROM (SELECT p.genome_id, p.domain, m.score FROM (SELECT genome_id, domain, unnest(proteins) AS protein_id FROM pam) p JOIN carriers m USING (protein_id)) GROUP BY 1",
        **PAM,
    )
)
def p10_score_matrix(spark, d):
    return P.score_matrix(_pam(spark, d), A.carriers(spark, d), ["Brand#1"])


@query(
    sql(
        "",
        "SELECT domain, keyword, round(common::DOUBLE / (nd + nk - common), 6) AS similarity FROM (SELECT w.domain, i.keyword, (SELECT count(*) FROM whole x WHERE x.domain = w.domain) AS nd, (SELECT count(*) FROM items x WHERE x.keyword = i.keyword) AS nk, count(*) AS common FROM whole w JOIN items i USING (item) GROUP BY ALL) WHERE common::DOUBLE / (nd + nk - common) >= 0.1",
        **PATTERN_TABLES,
        items="SELECT keyword, unnest(pattern) AS item FROM patterns",
        whole="SELECT DISTINCT a.item AS domain, b.item FROM items a JOIN items b USING (keyword)",
    )
)
def p12_similar_to_domain(spark, d):
    return P.similar_to_domain(_patterns(spark, d), 0.1).select("domain", "keyword", r6("similarity").alias("similarity"))


# ---- sequence similarity -----------------------------------------------------------------------------


def _texts(spark, d):
    return A.table(spark, d, "documents").select(F.col("doc_id").alias("seq_id"), F.col("text").alias("sequence"))


def _benchmark(spark, d):
    return A.table(spark, d, "benchmark").select(F.col("item_id").alias("seq_id"), F.col("text").alias("sequence"))


@query(sql("", "SELECT item_id AS seq_id, count(DISTINCT substr(text, i, 12)) AS n FROM (SELECT item_id, text, unnest(range(1, length(text) - 10)) AS i FROM benchmark WHERE length(text) >= 12) GROUP BY 1"))
def qk1_kmers(spark, d):
    return K.kmers(_benchmark(spark, d)).groupBy("seq_id").agg(F.count("*").alias("n"))


@query(
    sql(
        "",
        "SELECT item_id AS query_id, doc_id AS target_id, common FROM (SELECT item_id, doc_id, count(*) AS common FROM q JOIN t USING (kmer) GROUP BY ALL) QUALIFY rank() OVER (PARTITION BY item_id ORDER BY common DESC) <= 10",
        q="SELECT DISTINCT item_id, substr(text, i, 24) AS kmer FROM (SELECT item_id, text, unnest(range(1, length(text) - 22)) AS i FROM benchmark WHERE length(text) >= 24)",
        t="SELECT DISTINCT doc_id, substr(text, i, 24) AS kmer FROM (SELECT doc_id, text, unnest(range(1, length(text) - 22)) AS i FROM documents WHERE length(text) >= 24)",
    )
)
def qk2_search(spark, d):
    return K.search(_benchmark(spark, d), _texts(spark, d), k=24).select("query_id", "target_id", "common")


@query()
def qk3_cluster(spark, d):
    return K.cluster(_texts(spark, d), k=24)


@query(sql("seq_clusters", "SELECT rep_id, string_agg(DISTINCT member_id::VARCHAR, ',' ORDER BY member_id::VARCHAR) AS members FROM seq_clusters GROUP BY 1"))
def qk4_cluster_lists(spark, d):
    members = A.seq_clusters(spark, d).withColumn("member_id", F.col("member_id").cast("string"))
    return K.cluster_lists(members).select("rep_id", _text("members").alias("members"))


# ---- cluster selection and validation -------------------------------------------------------------------

METRICS = dict(
    flagged="SELECT c.family, c.rep_id, c.member_id, (r.protein_id IS NOT NULL)::INTEGER AS is_ref FROM seq_clusters c LEFT JOIN refs r ON r.family = c.family AND r.protein_id = c.member_id",
    metrics="SELECT family, rep_id, count(*) AS size, sum(is_ref)::BIGINT AS n_ref, any_value(all_ref) AS all_ref FROM flagged JOIN (SELECT family, count(*) AS all_ref FROM refs GROUP BY 1) USING (family) GROUP BY family, rep_id",
)


@query(
    sql(
        "seq_clusters refs",
        "SELECT c.family, c.member_id AS protein_id FROM seq_clusters c JOIN metrics m USING (family, rep_id) WHERE n_ref::DOUBLE / size >= 0.35 AND n_ref::DOUBLE / all_ref >= 0.04 UNION SELECT family, protein_id FROM refs",
        **METRICS,
    )
)
def v0_select_clusters(spark, d):
    return V.select_clusters(A.seq_clusters(spark, d), A.references(spark, d), 0.35, 0.04)


@query(
    sql(
        "seq_clusters refs",
        "SELECT family, arg_max(x, (f1, x, y)) AS fraction, arg_max(y, (f1, x, y)) AS density, round(max(f1), 9) AS f1 FROM (SELECT family, x, y, 2 * sum(n_ref)::DOUBLE / (sum(n_ref) + sum(size) - sum(n_ref) + any_value(all_ref)) AS f1 FROM metrics, x, y WHERE n_ref > 0 AND n_ref::DOUBLE / all_ref >= x AND n_ref::DOUBLE / size >= y GROUP BY family, x, y) GROUP BY family",
        **METRICS,
        x="SELECT (1 + 5 * i) / 1000::DOUBLE AS x FROM range(202) t(i)",
        y="SELECT (10 + 5 * i) / 1000::DOUBLE AS y FROM range(200) t(i)",
    )
)
def v0b_threshold_grid(spark, d):
    return V.threshold_grid(A.seq_clusters(spark, d), A.references(spark, d)).select("family", "fraction", "density", F.round("f1", 9).alias("f1"))


@query(sql("seq_clusters refs", "SELECT family, rep_id, member_id FROM seq_clusters WHERE (family, rep_id) IN (SELECT (family, rep_id) FROM metrics WHERE n_ref > 0)", **METRICS))
def f16_with_reference(spark, d):
    return V.with_reference(A.seq_clusters(spark, d), A.references(spark, d)).select("family", "rep_id", "member_id")


SWEEP = dict(
    ranked="SELECT model, hit_id, bitscore, is_tp, row_number() OVER (PARTITION BY model ORDER BY bitscore DESC, hit_id) AS rank FROM (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY model, hit_id ORDER BY bitscore DESC) = 1)",
    counted="SELECT *, sum(is_tp::INTEGER) OVER w AS tp, rank - sum(is_tp::INTEGER) OVER w AS fp, sum(is_tp::INTEGER) OVER (PARTITION BY model) AS all_tp, sum((NOT is_tp)::INTEGER) OVER (PARTITION BY model) AS all_tn FROM ranked WINDOW w AS (PARTITION BY model ORDER BY rank)",
    matrix="SELECT model, hit_id, bitscore, is_tp, rank, tp::BIGINT AS tp, fp::BIGINT AS fp, (all_tp - tp)::BIGINT AS fn, (all_tn - fp)::BIGINT AS tn FROM counted",
    roots="SELECT *, sqrt((tp + fp)::DOUBLE * (tp + fn)::DOUBLE * (tn + fp)::DOUBLE * (tn + fn)::DOUBLE) AS root FROM matrix",
    swept="SELECT *, CASE WHEN root = 0 THEN 0.0 ELSE (tp::DOUBLE * tn::DOUBLE - fp::DOUBLE * fn::DOUBLE) / root END AS mcc FROM roots",
    before_last="SELECT * FROM swept WHERE fn > 0 OR is_tp OR rank = 1",
    cuts="SELECT model, arg_max(bitscore, (mcc, -rank)) AS optimized, min(bitscore) FILTER (is_tp AND fp = 0) AS trusted, min(bitscore) AS noise, max(mcc) AS mcc, arg_max(tp, (mcc, -rank)) AS tp, arg_max(fp, (mcc, -rank)) AS fp, arg_max(fn, (mcc, -rank)) AS fn, arg_max(tn, (mcc, -rank)) AS tn FROM before_last GROUP BY model",
    last="SELECT model, arg_max((tp, fp, fn, tn), rank) AS m FROM before_last GROUP BY model",
    labelled="SELECT s.model, s.hit_id, s.bitscore, s.is_tp, s.rank, b.rank IS NOT NULL AS normal, c.optimized, c.trusted, c.noise, coalesce(b.tp, m[1]) AS tp, coalesce(b.fp, m[2]) AS fp, coalesce(b.fn, m[3]) AS fn, coalesce(b.tn, m[4]) AS tn, coalesce(b.mcc, c.mcc) AS mcc FROM swept s JOIN cuts c USING (model) JOIN last USING (model) LEFT JOIN before_last b ON b.model = s.model AND b.rank = s.rank WHERE b.rank IS NOT NULL OR s.bitscore >= c.noise * 0.6",
)


def _sweep(spark, d):
    return V.sweep(A.scores(spark, d))


@query(sql("scores", "SELECT model, hit_id, rank, tp, fp, fn, tn, round(mcc, 6) AS mcc FROM swept", **SWEEP))
def v1_sweep(spark, d):
    return _sweep(spark, d).select("model", "hit_id", F.col("rank").cast("long").alias("rank"), "tp", "fp", "fn", "tn", r6("mcc").alias("mcc"))


@query(sql("scores", "SELECT model, optimized, trusted, noise, round(mcc, 6) AS mcc, tp, fp, fn, tn FROM cuts", **SWEEP))
def v1_cutoffs(spark, d):
    return V.cutoffs(_sweep(spark, d)).withColumn("mcc", r6("mcc"))


def _hit_report(spark, d):
    swept = M.saved(_sweep(spark, d), "swept")
    cuts = V.cutoffs(swept)
    return V.label_hits(swept, cuts), cuts


def _at(cut):
    return f"CASE WHEN NOT normal THEN 'TN' WHEN coalesce(bitscore >= {cut}, true) THEN CASE WHEN is_tp THEN 'TP' ELSE 'FP' END WHEN is_tp THEN 'FN' ELSE 'TN' END"


@query(sql("scores", f"SELECT model, hit_id, {_at('optimized')} AS at_optimized, {_at('trusted')} AS at_trusted, {_at('noise')} AS at_noise, normal AS above_noise, tp, fp, fn, tn, round(mcc, 6) AS mcc FROM labelled", **SWEEP))
def v3_label_hits(spark, d):
    found, _ = _hit_report(spark, d)
    return found.select("model", "hit_id", "at_optimized", "at_trusted", "at_noise", "above_noise", "tp", "fp", "fn", "tn", r6("mcc").alias("mcc"))


TOXIC_SCORES = A.CTE["scores"].replace("quality = 1", "toxic = 1")


@query(sql("", "SELECT model, count(*) AS n FROM labelled WHERE NOT normal GROUP BY 1", scores=TOXIC_SCORES, **SWEEP))
def v2_extra_true_negatives(spark, d):
    marks = A.table(spark, d, "labels").select(F.col("doc_id").alias("hit_id"), F.col("toxic"))
    swept = V.sweep(A.scores(spark, d).join(marks, "hit_id").withColumn("is_tp", F.col("toxic") == 1).drop("toxic"))
    return V.label_hits(swept, V.cutoffs(swept)).filter("not above_noise").groupBy("model").agg(F.count("*").alias("n"))


FOLDS = dict(
    folded="SELECT family, protein_id, CASE WHEN size = 0 THEN 5 ELSE least((n - 1) // greatest(size, 1), 5) END AS fold FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY protein_id) AS n, count(*) OVER (PARTITION BY family) // 5 AS size FROM (SELECT DISTINCT * FROM refs))"
)


@query(sql("refs", "SELECT family, protein_id, fold::INTEGER AS fold FROM folded", **FOLDS))
def v4_folds(spark, d):
    return V.folds(A.references(spark, d))


FOLD_SCORES = "SELECT lang || '/' || (doc_id % 5) AS model, doc_id AS hit_id, CAST(n_chars AS DOUBLE) AS bitscore, quality = 1 AS is_tp FROM labels JOIN documents USING (doc_id)"
FOLD_SWEEP = dict(SWEEP, fold_cuts="SELECT split_part(model, '/', 1) AS base, split_part(model, '/', 2) AS fold, * EXCLUDE (model) FROM cuts")


def _fold_cutoffs(spark, d):
    by_fold = A.scores(spark, d).withColumn("model", F.concat_ws("/", "model", F.col("hit_id") % 5))
    return V.cutoffs(V.sweep(by_fold)).withColumn("model", F.split("model", "/").getItem(0))


@query(
    f"WITH scores AS ({FOLD_SCORES}), "
    + ", ".join(f"{n} AS ({q})" for n, q in FOLD_SWEEP.items())
    + " SELECT base AS model, greatest(arg_max(optimized, (mcc, -optimized)), 10.0) AS optimized, greatest(max(trusted), 10.0) AS trusted, greatest(min(noise), 10.0) AS noise FROM fold_cuts GROUP BY base"
)
def v5_fold_summary(spark, d):
    return V.fold_summary(_fold_cutoffs(spark, d))


@query(
    f"WITH scores AS ({FOLD_SCORES}), "
    + ", ".join(f"{n} AS ({q})" for n, q in FOLD_SWEEP.items())
    + ", s AS (SELECT base AS model, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, sum(tn)::BIGINT AS tn, avg((coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) + coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)) / 2) AS ba FROM fold_cuts GROUP BY base)"
    " SELECT model, tp, fp, fn, tn, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce((tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn)::DOUBLE * (tn + fp)::DOUBLE * (tn + fn)::DOUBLE), 0), 0), 6) AS mcc, round(ba, 6) AS balanced_accuracy FROM s"
)
def v6_performance(spark, d):
    found = V.performance(_fold_cutoffs(spark, d))
    return found.select("model", "tp", "fp", "fn", "tn", *(r6(c).alias(c) for c in ("f1", "mcc", "balanced_accuracy")))


@query(
    f"WITH scores AS ({FOLD_SCORES}), " + ", ".join(f"{n} AS ({q})" for n, q in FOLD_SWEEP.items()) + " SELECT base AS model, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, sum(tn)::BIGINT AS tn FROM fold_cuts GROUP BY base"
)
def g9_sum_matrices(spark, d):
    return V.sum_matrices(_fold_cutoffs(spark, d))


# ---- reports -----------------------------------------------------------------------------------------------


@query(
    sql(
        "scores",
        "SELECT model, bitscore, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, concat_ws(',', CASE WHEN bitscore = min(bitscore) FILTER (bitscore >= optimized) OVER w THEN 'optimized' END, CASE WHEN bitscore = min(bitscore) FILTER (coalesce(bitscore >= trusted, true)) OVER w THEN 'trusted' END, CASE WHEN bitscore = min(bitscore) FILTER (bitscore >= noise) OVER w THEN 'noise' END) AS marks FROM (SELECT p.*, c.optimized, c.trusted, c.noise FROM points p JOIN cuts c USING (model)) WINDOW w AS (PARTITION BY model)",
        **SWEEP,
        points="SELECT model, bitscore, avg(coalesce(fp::DOUBLE / nullif(fp + tn, 0), 0)) AS fpr, avg(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)) AS tpr FROM labelled GROUP BY ALL",
    )
)
def r1_roc_points(spark, d):
    return R.roc_points(*_hit_report(spark, d)).select("model", "bitscore", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"), "marks")


@query(sql("scores", "SELECT model, bitscore, round(mcc, 6) AS mcc FROM labelled QUALIFY row_number() OVER (PARTITION BY model, bitscore ORDER BY rank) = 1", **SWEEP))
def r2_mcc_curve(spark, d):
    return R.mcc_curve(_hit_report(spark, d)[0]).withColumn("mcc", r6("mcc"))


LABELLED_GENES = "SELECT protein_id, CASE WHEN score >= 50 THEN CASE WHEN domain IN ('click', 'view') THEN 'TP' ELSE 'FP' END WHEN domain IN ('click', 'view') THEN 'FN' ELSE 'TN' END AS label FROM genes"


def _labelled_genes(spark, d):
    true = F.col("domain").isin("click", "view")
    label = F.when(F.col("score") >= 50, F.when(true, "TP").otherwise("FP")).otherwise(F.when(true, "FN").otherwise("TN"))
    return A.genes(spark, d).select("protein_id", label.alias("label"))


CONFUSION = dict(
    HOODS,
    lab=LABELLED_GENES,
    confusion="SELECT array_to_string(CASE WHEN neighbourhood <= list_reverse(neighbourhood) THEN neighbourhood ELSE list_reverse(neighbourhood) END, '/') AS neighbourhood, count(*) FILTER (label = 'TP') AS tp, count(*) FILTER (label = 'FP') AS fp, count(*) FILTER (label = 'FN') AS fn, count(*) FILTER (label = 'TN') AS tn, count(*) AS total FROM lab JOIN hoods USING (protein_id) GROUP BY 1",
)


def _confusion(spark, d):
    return R.confusion_by_neighbourhood(_labelled_genes(spark, d), _hoods(spark, d))


@query(sql("genes", "SELECT * FROM confusion", **CONFUSION))
def r3_confusion_by_neighbourhood(spark, d):
    return _confusion(spark, d)


@query(sql("genes", "SELECT * FROM confusion WHERE tp > 0 OR fn > 0", **CONFUSION))
def r7_positives_only(spark, d):
    return R.positives_only(_confusion(spark, d))


@query(sql("genes", "SELECT * FROM confusion ORDER BY total DESC, neighbourhood LIMIT 10", **CONFUSION))
def w10_top_neighbourhoods(spark, d):
    return R.top_neighbourhoods(_confusion(spark, d), 10)


@query(
    sql(
        "genes",
        "SELECT neighbourhood, count(*) FILTER (k = 'TP') AS tp, count(*) FILTER (k = 'FP') AS fp, count(*) FILTER (k = 'FN') AS fn, count(*) FILTER (k = 'TN') AS tn FROM (SELECT array_to_string(neighbourhood, '/') AS neighbourhood, CASE WHEN score < 20 THEN 'TN' WHEN score >= 60 THEN CASE WHEN domain = 'click' THEN 'TP' ELSE 'FP' END WHEN domain = 'click' THEN 'FN' ELSE 'TN' END AS k FROM hoods JOIN genes USING (protein_id)) GROUP BY 1",
        **HOODS,
    )
)
def r4_confusion_by_label(spark, d):
    genes = A.genes(spark, d).select("protein_id", F.col("score").alias("bitscore"), (F.col("domain") == "click").alias("is_tp"), (F.col("score") >= 20).alias("above_noise"))
    rows = _hoods(spark, d).select("protein_id", F.array_join("neighbourhood", "/").alias("neighbourhood")).join(genes, "protein_id")
    return R.confusion_by_label(rows, 60.0)


@query(sql("genes taxonomy", "SELECT l.protein_id, l.label, array_to_string(h.neighbourhood, '/') AS neighbourhood, g.genome_id, t.phylum, t.class FROM lab l JOIN hoods h USING (protein_id) JOIN genes g USING (protein_id) LEFT JOIN taxonomy t ON t.genome_id = g.genome_id", **CONFUSION))
def r5_enriched(spark, d):
    found = R.enriched(_labelled_genes(spark, d), _hoods(spark, d), A.genes(spark, d), A.taxonomy(spark, d))
    return found.select("protein_id", "label", F.array_join("neighbourhood", "/").alias("neighbourhood"), "genome_id", "phylum", "class")


@query(sql("genes taxonomy", "SELECT g.protein_id, t.phylum, t.class FROM genes g LEFT JOIN taxonomy t USING (genome_id)"))
def j8_taxonomy_join(spark, d):
    return A.genes(spark, d).join(A.taxonomy(spark, d), "genome_id", "left").select("protein_id", "phylum", "class")


@query(
    sql(
        "members taxonomy",
        "SELECT coalesce(phylum, 'NA') AS taxon, count(*) AS n, min(score) AS low, round(quantile_cont(score, 0.25), 4) AS q1, round(quantile_cont(score, 0.5), 4) AS q2, round(quantile_cont(score, 0.75), 4) AS q3, max(score) AS high FROM members LEFT JOIN taxonomy USING (genome_id) GROUP BY 1",
    )
)
def r6_taxon_distribution(spark, d):
    found = R.taxon_distribution(A.members(spark, d).join(A.taxonomy(spark, d), "genome_id", "left"), "phylum")
    return found.select("taxon", "n", "low", *(F.round(q, 4).alias(q) for q in ("q1", "q2", "q3")), "high")


@query(sql("taxonomy", "SELECT count(DISTINCT phylum) AS phylum, count(DISTINCT class) AS class, CASE WHEN count(DISTINCT class) <= 10 THEN 'class' WHEN count(DISTINCT phylum) <= 10 THEN 'phylum' ELSE 'phylum' END AS rank FROM taxonomy"))
def w9_deepest_rank(spark, d):
    return R.deepest_rank(A.taxonomy(spark, d), ["phylum", "class"], 10)


@query(sql("taxonomy", "SELECT 'phylum' AS rank, phylum AS value, count(*) AS n FROM taxonomy GROUP BY 2 UNION ALL SELECT 'class', class, count(*) FROM taxonomy GROUP BY 2"))
def g7_genome_counts(spark, d):
    return R.genome_counts(A.taxonomy(spark, d), ["phylum", "class"])


@query(sql("scores", f"SELECT label, hit_id, count(*) AS n, min(bitscore) AS min_score FROM (SELECT hit_id, bitscore, {_at('optimized')} AS label FROM labelled) GROUP BY ALL", **SWEEP))
def g8_hit_counts(spark, d):
    swept = _sweep(spark, d)
    return R.hit_counts(V.label_hits(swept, V.cutoffs(swept)).withColumnRenamed("at_optimized", "label"))


@query(sql("genes", "SELECT domain, count(*) FILTER (label = 'TP') AS tp, count(*) FILTER (label = 'FP') AS fp, count(*) FILTER (label = 'FN') AS fn, count(*) FILTER (label = 'TN') AS tn FROM lab JOIN genes USING (protein_id) GROUP BY 1", lab=LABELLED_GENES))
def g10_confusion_pivot(spark, d):
    joined = _labelled_genes(spark, d).join(A.genes(spark, d).select("protein_id", "domain"), "protein_id")
    wide = joined.groupBy("domain").pivot("label", list(R.LABELS)).count().na.fill(0)
    return wide.select("domain", *(F.col(x).alias(x.lower()) for x in R.LABELS))


@query(sql("seq_clusters refs", "SELECT family, rep_id, size, n_ref, round(n_ref::DOUBLE / size, 6) AS density, CASE WHEN n_ref = 0 THEN 'no_reference' WHEN n_ref = size THEN 'pure' ELSE 'mixed' END AS class FROM metrics", **METRICS))
def g12_cluster_report(spark, d):
    found = R.cluster_report(V.cluster_metrics(A.seq_clusters(spark, d), A.references(spark, d)))
    return found.withColumn("density", r6("density"))


@query(
    sql(
        "seq_clusters refs",
        'SELECT family, count(*) FILTER (r) AS "references", count(*) FILTER (m) AS members, count(*) FILTER (r AND m) AS "both", count(*) FILTER (m AND NOT r) AS new FROM (SELECT family, id, bool_or(k = 1) AS r, bool_or(k = 2) AS m FROM (SELECT family, protein_id AS id, 1 AS k FROM refs UNION ALL SELECT family, member_id, 2 FROM seq_clusters) GROUP BY ALL) GROUP BY 1',
    )
)
def g14_set_composition(spark, d):
    return R.set_composition(A.references(spark, d), A.seq_clusters(spark, d))


@query(sql("members", "SELECT genome_id, count(*) AS n FROM members GROUP BY 1"))
def g13_record_counts(spark, d):
    return R.record_counts(A.members(spark, d), "genome_id")


@query(sql("scores", "SELECT model, optimized, trusted, noise, round(mcc, 6) AS mcc FROM cuts", **SWEEP))
def r8_cutoff_table(spark, d):
    return R.cutoff_table(V.cutoffs(_sweep(spark, d))).withColumn("mcc", r6("mcc"))


@query(sql("scores", "SELECT DISTINCT hit_id || ',1' AS value FROM scores"))
def r9_tree_annotation(spark, d):
    return R.tree_annotation(A.scores(spark, d))


@query(
    sql(
        "members best_members",
        "SELECT 'grp0' AS level, genome_id, domain, count(DISTINCT protein_id) AS n FROM best_members GROUP BY genome_id, domain UNION ALL SELECT 'grp1', genome_id, domain, count(DISTINCT protein_id) FROM members GROUP BY genome_id, domain",
    )
)
def r10_presence_by_level(spark, d):
    members = A.members(spark, d)
    refs, wider = A.best_members(spark, d).select("domain", "protein_id"), members.select("domain", "protein_id").distinct()
    level = lambda name, r: P.presence(r, members).select(F.lit(name).alias("level"), "genome_id", "domain", F.size("proteins").cast("long").alias("n"))
    return level("grp0", refs).unionByName(level("grp1", wider))


@query(sql("members best_members", "SELECT DISTINCT protein_id, genome_id, domain FROM members WHERE protein_id IN (SELECT protein_id FROM best_members)"))
def j6_genomes_and_domains(spark, d):
    members = A.members(spark, d)
    wanted = A.best_members(spark, d).select("protein_id").distinct()
    return members.join(wanted, "protein_id", "left_semi").select("protein_id", "genome_id", "domain").distinct()


@query(
    sql(
        "seq_clusters refs",
        "SELECT family, x, count(*) AS n FROM metrics, (SELECT round(0.01::DOUBLE + 0.01::DOUBLE * i, 2) AS x FROM range(10) t(i)) WHERE n_ref::DOUBLE / all_ref >= x - 1e-12 GROUP BY ALL",
        **METRICS,
    )
)
def j10_threshold_join(spark, d):
    grid = spark.range(10).select(F.round(F.col("id") * 0.01 + 0.01, 2).alias("x"))
    metrics = V.cluster_metrics(A.seq_clusters(spark, d), A.references(spark, d))
    # ten thresholds: a fixed grid, whose rows don't follow the input
    return metrics.join(F.broadcast(grid), F.col("fraction") >= F.col("x") - 1e-12).groupBy("family", "x").agg(F.count("*").alias("n"))


@query(sql("scores", "SELECT model, hit_id, bitscore FROM scores QUALIFY row_number() OVER (PARTITION BY model, hit_id ORDER BY bitscore DESC) = 1"))
def w5_first_occurrence(spark, d):
    return H.first_per_key(A.scores(spark, d), ["model", "hit_id"], [F.desc("bitscore")]).select("model", "hit_id", "bitscore")


@query("SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer")
def w8_numbered_queries(spark, d):
    rows = A.table(spark, d, "customer").select("c_mktsegment", "c_custkey")
    return running(rows, ["c_mktsegment"], [F.col("c_custkey").asc()]).withColumnRenamed("rank", "n")


# ---- sources and sinks ---------------------------------------------------------------------------------------

PATHS = "SELECT '/in/' || CASE WHEN s_suppkey % 2 = 0 THEN 'a/' ELSE 'b/' END || 'GCF' || (s_suppkey // 3) || '.1.' || CASE s_suppkey % 3 WHEN 0 THEN 'faa' WHEN 1 THEN 'gff' ELSE 'fna' END || CASE WHEN s_nationkey % 2 = 0 THEN '.gz' ELSE '' END AS path, 'GCF' || (s_suppkey // 3) AS genome_id, s_suppkey % 3 AS k FROM supplier"


@query(sql("", "SELECT genome_id, f.path AS faa, g.path AS gff FROM (SELECT * FROM p WHERE k = 0) f JOIN (SELECT * FROM p WHERE k = 1) g USING (genome_id)", p=PATHS))
def io5_input_pairs(spark, d):
    k = F.col("s_suppkey") % 3
    kind = F.when(k == 0, "faa").when(k == 1, "gff").otherwise("fna")
    folder = F.when(F.col("s_suppkey") % 2 == 0, "a/").otherwise("b/")
    gz = F.when(F.col("s_nationkey") % 2 == 0, ".gz").otherwise("")
    path = F.concat(F.lit("/in/"), folder, F.lit("GCF"), F.floor(F.col("s_suppkey") / 3).cast("string"), F.lit(".1."), kind, gz)
    files = A.table(spark, d, "supplier").select(path.alias("path"))
    return sources.input_pairs(sources.with_kind(files))[0]


@query("SELECT lang || '___' || doc_id AS seq_id, md5(text) AS digest FROM documents")
def io6_global_ids(spark, d):
    docs = A.table(spark, d, "documents").select(F.col("lang").alias("genome_id"), F.col("doc_id").alias("protein_id"), F.col("text").alias("sequence"))
    return sources.global_ids(docs).select("seq_id", F.md5("sequence").alias("digest"))


@query(sql("", "SELECT keyword, array_to_string(pattern, ',') AS items FROM patterns", **PATTERN_TABLES))
def io8_pattern_items(spark, d):
    return sources.pattern_items(_patterns(spark, d)).select("keyword", _text("items").alias("items"))


@query("SELECT s_suppkey AS genome_id, r_name AS phylum, n_name AS class, 'S_' || s_suppkey AS species, 'NA' AS family FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def io9_parse_taxonomy(spark, d):
    lines = A.taxonomy(spark, d).select("genome_id", F.concat(F.lit("p__"), "phylum", F.lit(";c__"), "class", F.lit("; s__S "), "genome_id").alias("tax"))
    return sources.parse_taxonomy(lines).select("genome_id", "phylum", "class", "species", "family")


@query(sql("members", "SELECT genome_id, domain, protein_id, score FROM members WHERE genome_id % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY genome_id, domain ORDER BY protein_id) = 1"))
def io10_first_wins(spark, d):
    members = A.members(spark, d)
    stored = members.filter("genome_id % 4 = 0").select("genome_id", "domain")
    return sinks.first_wins(members, stored, ["genome_id", "domain"], ["protein_id"]).select("genome_id", "domain", "protein_id", "score")


@query(
    sql(
        "genes",
        "SELECT protein_id, genome_id, contig, start_pos, score + CASE WHEN domain = 'click' THEN 0 WHEN score >= 50 THEN 1000 ELSE 2000 END AS score FROM genes",
    )
)
def io10_store(spark, d):
    """Clicks are stored first, then better hits of all domains, then all hits, twice; each batch has other scores, and stored proteins keep theirs."""
    genes = A.genes(spark, d).select("protein_id", "genome_id", "contig", "start_pos", "score", "domain")
    batches = [genes.filter("domain = 'click'"), genes.filter("score >= 50").withColumn("score", F.col("score") + 1000), genes.withColumn("score", F.col("score") + 2000)]
    path = M.scratch(spark, "proteins")
    layout = (["protein_id"], ["contig", "start_pos"], 16)
    name = store.open_table(spark, path, genes.drop("domain").schema, *layout)
    for batch in [*batches, batches[-1]]:
        store.append_new(spark, name, batch, ["protein_id"], ["start_pos"], *layout[1:])
    return spark.table(store.open_table(spark, path, genes.drop("domain").schema, *layout))


@query(sql("genes", "SELECT cluster_id, array_to_string(list(domain ORDER BY start_pos, protein_id), ',') AS types FROM island_members GROUP BY cluster_id", **ISLANDS))
def w11_stored_clusters(spark, d):
    """Island members are stored by cluster and start; the lists are read without moving a row."""
    members = _island_members(spark, d).select("cluster_id", "start_pos", "protein_id", "domain")
    layout = (["cluster_id"], ["cluster_id", "start_pos"], 16)
    name = store.open_table(spark, M.scratch(spark, "members"), members.schema, *layout)
    store.append_all(spark, name, members, layout[0], layout[1], layout[2])
    return store.cluster_lists(spark, name).select("cluster_id", _text("types").alias("types"))


@query(sql("genes", "SELECT protein_id, cluster_id FROM placed", **PLACED))
def io10_with_clusters(spark, d):
    return sinks.with_clusters(A.genes(spark, d), _island_members(spark, d)).select("protein_id", "cluster_id")


@query(sql("keywords", "SELECT cluster_id, keyword FROM keywords WHERE NOT (starts_with(keyword, 'csb-') AND ends_with(keyword, 'LOW'))"))
def io11_drop_keywords(spark, d):
    return sinks.drop_keywords(A.keywords(spark, d), "csb-", "LOW")


@query(sql("members best_members", "SELECT CASE WHEN protein_id IN (SELECT protein_id FROM best_members) THEN 'renamed' ELSE domain END AS domain, count(*) AS n FROM (SELECT DISTINCT protein_id, domain, score FROM members) GROUP BY 1"))
def io12_rename_domain(spark, d):
    rows = A.members(spark, d).select("protein_id", "domain", "score").distinct()
    return sinks.rename_domain(rows, A.best_members(spark, d), "renamed").groupBy("domain").agg(F.count("*").alias("n"))


@query(sql("refs", "SELECT family AS domain, protein_id, md5(text) AS digest FROM refs JOIN documents ON doc_id = protein_id WHERE family IN (SELECT family FROM refs GROUP BY 1 HAVING count(*) >= 40)"))
def io13_training_sequences(spark, d):
    texts = _texts(spark, d).withColumnRenamed("seq_id", "protein_id")
    refs = A.references(spark, d).withColumnRenamed("family", "domain")
    return sinks.training_sequences(refs, texts, 40, 1_000_000_000).select("domain", "protein_id", F.md5("sequence").alias("digest"))


@query(sql("refs", "SELECT family AS domain, CASE WHEN count(*) > 60 THEN 50 ELSE count(*) END AS n FROM (SELECT DISTINCT * FROM refs) GROUP BY 1 HAVING count(*) >= 5"))
def io13_sample_sizes(spark, d):
    """Groups of more than 60 sequences are samples of 50: which ones goes by a hash, how many is known."""
    texts = _texts(spark, d).withColumnRenamed("seq_id", "protein_id")
    refs = A.references(spark, d).withColumnRenamed("family", "domain")
    return sinks.training_sequences(refs, texts, 5, 50, 10).groupBy("domain").agg(F.count("*").alias("n"))


@query("SELECT lang AS genome_id, doc_id AS protein_id, md5(text) AS digest FROM documents WHERE lang <> 'en'")
def io14_domain_sequences(spark, d):
    docs = A.table(spark, d, "documents").select(F.col("lang").alias("genome_id"), F.col("doc_id").alias("protein_id"), "source", F.col("text").alias("sequence"))
    members = docs.select("genome_id", "protein_id", F.col("source").alias("domain"))
    return sinks.domain_sequences(members, docs.select("genome_id", "protein_id", "sequence"), None, "en").select("genome_id", "protein_id", F.md5("sequence").alias("digest"))


def _written(spark, lines, name):
    """Lines as text files below the shared folder."""
    path = M.scratch(spark, name)
    lines.select("value").write.text(path)
    return path


def _line(*columns):
    return F.concat_ws("\t", *(F.col(c).cast("string") for c in columns)).alias("value")


@query(sql("hits", "SELECT hit_id, query_id, evalue, bitscore, sstart, send, pident, 1.0::DOUBLE AS bsr, count(*) AS n FROM hits GROUP BY ALL"))
def io1_read_hits(spark, d):
    """Hits are written as a table of seven columns, between comments and broken lines, and read back."""
    lines = A.hits(spark, d).select(_line("hit_id", "query_id", "evalue", "bitscore", "sstart", "send", "pident"))
    noise = A.table(spark, d, "nation").select(F.explode(F.array(F.concat(F.lit("# "), "n_name"), F.col("n_name"), F.concat_ws("\t", *([F.col("n_name")] * 7)))).alias("value"))
    read = sources.read_hits(spark, _written(spark, lines.unionByName(noise), "hits"))
    names = ["hit_id", "query_id", "evalue", "bitscore", F.col("sstart").cast("long").alias("sstart"), F.col("send").cast("long").alias("send"), "pident", "bsr"]
    return read.groupBy(*names).agg(F.count("*").alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) AS protein_id, md5(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS digest FROM documents WHERE regexp_matches(text, '[A-Za-z]')")
def io2_read_fasta(spark, d):
    """The letters of texts are written as FASTA in lines of 60 and read back."""
    letters = F.regexp_replace("text", "[^A-Za-z]", "")
    wrapped = F.regexp_replace(letters, "(.{60})", "$1\n")
    records = A.table(spark, d, "documents").filter(F.col("text").rlike("[A-Za-z]")).select(F.concat(F.lit(">"), "doc_id", F.lit(" of "), "lang", F.lit("\n"), wrapped).alias("value"))
    return sources.read_fasta(spark, _written(spark, records, "fasta")).select("protein_id", F.md5("sequence").alias("digest"))


@query(sql("genes", "SELECT protein_id::VARCHAR AS protein_id, 'c' || contig AS contig, (start_pos % 1000000)::INTEGER AS start_pos, (start_pos % 1000000 + 60)::INTEGER AS end_pos, CASE WHEN score >= 50 THEN '+' ELSE '-' END AS strand, 'L' || protein_id AS locus_tag FROM genes"))
def io3_read_gff(spark, d):
    """Genes are written as GFF, with comments and features without an id, and read back."""
    genes = A.genes(spark, d)
    start = F.col("start_pos") % 1_000_000
    notes = F.concat(F.lit("ID=cds-"), "protein_id", F.lit(";note=x;locus_tag=L"), "protein_id")
    strand = F.when(F.col("score") >= 50, "+").otherwise("-")
    whole = F.concat_ws("\t", F.concat(F.lit("c"), "contig"), F.lit("src"), F.lit("CDS"), start, start + 60, F.lit("."), strand, F.lit("0"), notes)
    nameless = F.concat_ws("\t", F.concat(F.lit("c"), "contig"), F.lit("src"), F.lit("gene"), start, start + 60, F.lit("."), strand, F.lit("0"), F.lit("note=y"))
    lines = genes.select(F.explode(F.array(whole, nameless, F.lit("##gff-version 3"))).alias("value"))
    return sources.read_gff(spark, _written(spark, lines, "gff")).drop("genome_id")


@query(sql("genes", "SELECT 'c' || contig || '_' || protein_id AS protein_id, 'c' || contig AS contig, (start_pos % 1000000)::INTEGER AS start_pos, (start_pos % 1000000 + 60)::INTEGER AS end_pos, CASE WHEN score >= 50 THEN '+' ELSE '-' END AS strand, 'c' || contig || '_' || protein_id AS locus_tag FROM genes"))
def io4_header_features(spark, d):
    """Genes are written as a gene caller's FASTA, and their places are read from the headers."""
    start = F.col("start_pos") % 1_000_000
    head = F.concat_ws(" # ", F.concat(F.lit(">c"), "contig", F.lit("_"), "protein_id"), start, start + 60, F.when(F.col("score") >= 50, "1").otherwise("-1"), F.lit("ID=1"))
    records = A.genes(spark, d).select(F.concat(head, F.lit("\nMKV")).alias("value"))
    return sources.features_from_headers(sources.read_fasta(spark, _written(spark, records, "called"))).drop("genome_id")


@query(sql("gene_lists", "SELECT types[1] AS keyword, array_to_string(list_sort(list_distinct(types)), ',') AS pattern FROM gene_lists QUALIFY row_number() OVER (PARTITION BY types[1] ORDER BY cluster_id) = 1"))
def io7_read_patterns(spark, d):
    """Gene lists are written in order, named after their first gene, and read back: of one name the first line stays."""
    lines = A.gene_lists(spark, d).orderBy("cluster_id").select(F.concat_ws("\t", F.get("types", F.lit(0)), F.array_join("types", "\t")).alias("value"))
    return sources.read_patterns(spark, _written(spark, lines, "patterns")).select("keyword", _text("pattern").alias("pattern"))


@query(sql("genes", "SELECT count(*) AS count, len(list_sort(neighbourhood)) AS size, array_to_string(list_sort(neighbourhood), ' ') AS composition FROM hoods GROUP BY list_sort(neighbourhood)", **HOODS))
def io15_composition_report(spark, d):
    """The report of compositions is written as a table and read back."""
    path = M.scratch(spark, "compositions")
    sinks.write_table(sinks.composition_report(_hoods(spark, d)), path)
    return spark.read.option("sep", "\t").option("header", True).schema("count long, size long, composition string").csv(path)


@query(sql("", "SELECT pattern[1] AS group_id, array_to_string(list(keyword ORDER BY keyword), ' ') AS keywords, array_to_string(list_sort(list_distinct(flatten(list(pattern)))), ' ') AS items FROM patterns GROUP BY pattern[1]", **ISLAND_PATTERNS))
def io15_grouped_patterns(spark, d):
    """The report of grouped patterns, here by their first item, is written as a table and read back."""
    patterns = _island_patterns(spark, d)
    path = M.scratch(spark, "grouped")
    sinks.write_table(sinks.grouped_pattern_report(patterns, patterns.select("keyword", F.get("pattern", F.lit(0)).alias("group_id"))), path)
    return spark.read.option("sep", "\t").option("header", True).schema("group_id string, keywords string, items string").csv(path)


# ---- streams ----------------------------------------------------------------------------------------------------


def _stream(spark, d):
    """The events as a stream of files."""
    rows = A.table(spark, d, "events")
    found = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 64).parquet(f"{d}/events.parquet*")
    return found.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_id AS hit_id, event_type AS query_id, value * 4 AS bitscore, value / 50 AS bsr FROM events WHERE value * 4 >= 100")
def t1_ingest(spark, d):
    """A stream of hits, filtered and scored, against a static table of queries."""
    hits = _stream(spark, d).select(
        F.col("event_id").alias("hit_id"), F.col("event_type").alias("query_id"), F.lit(1e-9).alias("evalue"), (F.col("value") * 4).alias("bitscore"),
        F.lit(1).alias("sstart"), F.lit(80).alias("send"), F.lit(10.0).alias("pident"), F.lit(None).cast("double").alias("bsr"),
    )
    known = A.table(spark, d, "events").select(F.col("event_type").alias("query_id")).distinct().select("query_id", F.lit(100).alias("length"), F.lit(200.0).alias("self_score"))
    found = streaming.ingest_hits(hits, known).select("hit_id", "query_id", "bitscore", "bsr")
    return streaming.drained(found, M.scratch(spark, "ingested"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def t2_first_of_key(spark, d):
    return streaming.drained(streaming.first_of_key(_stream(spark, d).select("user_id", "event_type", "ts"), ["user_id", "event_type"]), M.scratch(spark, "firsts")).select("user_id", "event_type")


@query(
    "WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), "
    "runs AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM marked), "
    "sessions AS (SELECT user_id, min(ts) AS first, max(ts) AS final, count(*) AS n FROM runs GROUP BY user_id, run) "
    "SELECT user_id, epoch_us(first) AS first_us, n FROM sessions WHERE n >= 2 AND epoch_ms(final) + 3 * 3600000 <= (SELECT epoch_ms(max(ts)) FROM events) - 3600000"
)
def t3_gap_sessions(spark, d):
    """Sessions that the watermark, an hour behind the last event, has closed."""
    found = streaming.gap_sessions(_stream(spark, d), "user_id", "ts", "3 hours")
    return streaming.drained(found, M.scratch(spark, "sessions")).select("user_id", F.unix_micros("begin").alias("first_us"), "n")


@query("SELECT event_type, count(*) AS n, min(value) AS lower, max(value) AS upper FROM events GROUP BY 1")
def t4_running_limits(spark, d):
    """The last update of each key."""
    rows = streaming.drained(streaming.running_limits(_stream(spark, d), "event_type", "value"), M.scratch(spark, "limits"), "update")
    return rows.groupBy("event_type").agg(F.max(F.struct("batch", "n", "lower", "upper")).alias("m")).select("event_type", "m.n", "m.lower", "m.upper")


# ---- plans ------------------------------------------------------------------------------------------------------


@query()
def c3_group_keywords(spark, d):
    from locusflow.plans import group_keywords

    return group_keywords(_stats(spark, d), threshold=1500.0)


SEED_GROUPS = dict(
    QUERYS,
    good="SELECT * FROM stats WHERE keyword IN (SELECT keyword FROM stats LEFT JOIN query USING (domain) GROUP BY keyword HAVING max(n) >= 10 AND (bool_or(coalesce(median_score >= query_score * 0.7, false)) OR NOT starts_with(keyword, 'csb-')))",
    passing="SELECT keyword, domain FROM good JOIN query USING (domain) WHERE max_score >= query_score * 0.7",
    combined="SELECT DISTINCT m.domain, m.protein_id FROM keywords k JOIN members m USING (cluster_id) JOIN passing p ON p.keyword = k.keyword AND p.domain = m.domain",
    kept="SELECT * FROM combined WHERE domain IN (SELECT c.domain FROM combined c JOIN members m USING (protein_id) WHERE m.genome_id <> 7)",
)


@query(sql("members keywords", "SELECT domain, count(*) AS n FROM (SELECT domain, protein_id FROM kept UNION SELECT domain, protein_id FROM members WHERE genome_id = 7 AND domain IN (SELECT domain FROM kept)) GROUP BY 1", **SEED_GROUPS))
def c4_seed_groups(spark, d):
    from locusflow.plans import seed_groups

    members = A.members(spark, d)
    return seed_groups(A.keywords(spark, d), members, 7).groupBy("domain").agg(F.count("*").alias("n"))


SINGLES = dict(
    SEED_GROUPS,
    groups="SELECT domain, protein_id FROM kept UNION SELECT domain, protein_id FROM members WHERE genome_id = 7 AND domain IN (SELECT domain FROM kept)",
    carriers="SELECT * EXCLUDE (genome_id), cluster_id AS genome_id, count(*) OVER (PARTITION BY cluster_id) AS size FROM members",
    **dict(SEED_REFS, seeds="SELECT DISTINCT domain AS seed, genome_id FROM carriers WHERE size = 1 AND identity >= 98"),
)


@query(sql("members keywords", "SELECT domain, count(*) AS n FROM (SELECT domain, protein_id FROM groups WHERE domain NOT IN (SELECT domain FROM seed_refs) UNION SELECT domain, protein_id FROM seed_refs) GROUP BY 1", **SINGLES))
def c4_singletons_over_groups(spark, d):
    """The seed groups, with the references from items that are alone in their order in place of those of their domains."""
    from locusflow.plans import seed_groups, singleton_references

    begun = M.written()
    # the items of orders as genomes are the members with the order in the genome's place
    own = M.saved(A.members(spark, d).select("cluster_id", "protein_id", "domain", "score", "identity"), "members")

    def placed(part):
        items = own.filter(part("cluster_id"))
        size = items.groupBy("cluster_id").agg(F.count("*").alias("size"))
        return items.withColumn("genome_id", F.col("cluster_id")).join(size, "cluster_id").withColumn("cluster_id", F.when(F.col("size") > 1, F.col("cluster_id"))).drop("size")

    carriers = M.in_slices(own.count(), "carriers", placed)
    M.remove_scratch(spark, begun, carriers)
    single = singleton_references(carriers, 98.0)
    M.remove_scratch(spark, begun, single)
    return seed_groups(A.keywords(spark, d), A.members(spark, d), 7, single).groupBy("domain").agg(F.count("*").alias("n"))


@query(sql("", "SELECT cluster_id, min(start_pos) AS lo, max(end_pos) AS hi, array_to_string(list(domain ORDER BY start_pos, protein_id), ',') AS types FROM island_members GROUP BY cluster_id", genes=A.CTE["genes"] + " WHERE value * 4 >= 100", **ISLANDS))
def c7_hits_to_islands(spark, d):
    from locusflow.plans import hits_to_islands

    genes = A.genes(spark, d)
    hits = genes.select(
        "genome_id",
        "protein_id",
        F.concat_ws("___", "domain", F.col("protein_id") % 7).alias("query_id"),
        F.lit(1e-9).alias("evalue"),
        (F.col("score") * 4).alias("bitscore"),
        F.lit(20.0).alias("pident"),
        F.lit(1).alias("sstart"),
        F.lit(100).alias("send"),
        F.lit(None).cast("double").alias("bsr"),
    )
    lengths = hits.select("query_id").distinct().select("query_id", F.lit(100).alias("length"), F.lit(200.0).alias("self_score"))
    found = hits_to_islands(hits, lengths, genes.select("genome_id", "protein_id", "contig", "start_pos", "end_pos"), GAP)
    return found.select("cluster_id", "lo", "hi", _text("types").alias("types"))


CLOSED = dict(
    GAPPED,
    merged="SELECT DISTINCT CASE WHEN pattern <= list_reverse(pattern) THEN pattern ELSE list_reverse(pattern) END AS pattern, cluster_id FROM support",
    sets="SELECT pattern, list(cluster_id ORDER BY cluster_id) AS clusters FROM merged GROUP BY pattern",
    closed="SELECT pattern, clusters FROM sets QUALIFY row_number() OVER (PARTITION BY clusters ORDER BY len(pattern) DESC, pattern DESC) = 1",
    named="SELECT 'csb-' || row_number() OVER (ORDER BY len(pattern), pattern) || '_' AS keyword, clusters FROM closed",
)


@query(recursive(sql("gene_lists", "SELECT keyword, count(DISTINCT cluster) AS n FROM (SELECT keyword, unnest(replicates) AS cluster FROM (SELECT keyword, unnest(clusters) AS cluster_id FROM named) JOIN derep USING (cluster_id)) GROUP BY keyword", **CLOSED)))
def c8_islands_to_keywords(spark, d):
    from locusflow.plans import islands_to_keywords

    found = islands_to_keywords(A.gene_lists(spark, d), q=3)
    return found.groupBy("keyword").agg(F.count("*").alias("n"))


def _all_reports(spark, d):
    """Documents as hits: models are languages, a hit's fold is that of its id, its neighbourhood the sources around it, its genome a supplier."""
    from locusflow.plans import scores_to_reports

    docs = A.table(spark, d, "documents")
    hoods = docs.select(F.col("doc_id").alias("protein_id"), F.array(F.concat(F.lit("s"), F.col("doc_id") % 3), "source").alias("neighbourhood")).filter("protein_id % 11 <> 0")
    genomes = docs.select(F.col("doc_id").alias("protein_id"), (F.col("doc_id") % 50 + 1).alias("genome_id"))
    return scores_to_reports(A.scores(spark, d), A.scores(spark, d).withColumn("fold", F.col("hit_id") % 5), hoods, genomes, A.taxonomy(spark, d))


AROUND = "SELECT doc_id AS hit_id, ['s' || (doc_id % 3), source] AS neighbourhood FROM documents WHERE doc_id % 11 <> 0"
ASSIGNED = ", ".join(f"{_at(c)} AS at_{c}" for c in ("optimized", "trusted", "noise"))


@query(sql("scores", "SELECT model, optimized, trusted, noise, round(mcc, 6) AS mcc FROM cuts", **SWEEP))
def c9_scores_to_reports(spark, d):
    return _all_reports(spark, d)["cutoffs"].select("model", "optimized", "trusted", "noise", r6("mcc").alias("mcc"))


@query(
    sql(
        "scores",
        "SELECT model, cutoff, coalesce(array_to_string(CASE WHEN neighbourhood <= list_reverse(neighbourhood) THEN neighbourhood ELSE list_reverse(neighbourhood) END, '/'), 'singleton') AS neighbourhood, count(*) FILTER (l = 'TP') AS tp, count(*) FILTER (l = 'FP') AS fp, count(*) FILTER (l = 'FN') AS fn, count(*) FILTER (l = 'TN') AS tn, count(*) AS total FROM marked LEFT JOIN around USING (hit_id) GROUP BY ALL",
        **SWEEP,
        around=AROUND,
        assigned=f"SELECT model, hit_id, {ASSIGNED} FROM labelled",
        marked=" UNION ALL ".join(f"SELECT model, hit_id, '{c}' AS cutoff, at_{c} AS l FROM assigned" for c in ("optimized", "trusted", "noise")),
    )
)
def c9_confusions(spark, d):
    return _all_reports(spark, d)["confusions"]


@query(
    sql(
        "scores taxonomy",
        "SELECT model, hit_id AS protein_id, above_noise, at_trusted, array_to_string(neighbourhood, '/') AS neighbourhood, hit_id % 50 + 1 AS genome_id, phylum, class FROM (SELECT *, normal AS above_noise FROM labelled) JOIN (SELECT model, hit_id, "
        + f"{_at('trusted')} AS at_trusted FROM labelled) USING (model, hit_id) LEFT JOIN around USING (hit_id) LEFT JOIN taxonomy t ON t.genome_id = hit_id % 50 + 1",
        **SWEEP,
        around=AROUND,
    )
)
def c9_detailed(spark, d):
    found = _all_reports(spark, d)["detailed"]
    return found.select("model", "protein_id", "above_noise", "at_trusted", F.array_join("neighbourhood", "/").alias("neighbourhood"), "genome_id", "phylum", "class")


@query(
    f"WITH scores AS ({FOLD_SCORES}), "
    + ", ".join(f"{n} AS ({q})" for n, q in FOLD_SWEEP.items())
    + ", s AS (SELECT base AS model, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg((coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) + coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)) / 2) AS ba, greatest(arg_max(optimized, (mcc, -optimized)), 10.0) AS optimized, greatest(max(trusted), 10.0) AS trusted, greatest(min(noise), 10.0) AS noise FROM fold_cuts GROUP BY base)"
    " SELECT model, round(ba, 6) AS balanced_accuracy, round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, optimized, trusted, noise FROM s"
)
def c9_fold_reports(spark, d):
    found = _all_reports(spark, d)
    return found["performance"].join(found["fold_summary"], "model").select("model", r6("balanced_accuracy").alias("balanced_accuracy"), r6("f1").alias("f1"), "optimized", "trusted", "noise")


SYNTENY = dict(
    PATTERN_TABLES,
    members=A.CTE["carriers"],
    refset="SELECT DISTINCT domain, protein_id FROM members QUALIFY score >= quantile_cont(score, 0.5) OVER (PARTITION BY domain)",
    items="SELECT keyword, unnest(pattern) AS item FROM patterns",
    whole="SELECT DISTINCT a.item AS domain, b.item FROM items a JOIN items b USING (keyword)",
    like_domain="SELECT domain, keyword FROM (SELECT w.domain, i.keyword, (SELECT count(*) FROM whole x WHERE x.domain = w.domain) AS nd, (SELECT count(*) FROM items x WHERE x.keyword = i.keyword) AS nk, count(*) AS common FROM whole w JOIN items i USING (item) GROUP BY ALL) WHERE common::DOUBLE / (nd + nk - common) >= 0.1",
    keywords="SELECT f.cluster_id, p.keyword FROM (SELECT DISTINCT cluster_id, array_to_string(types[i:i + 2], '-') AS keyword FROM (SELECT cluster_id, types, unnest(range(1, len(types) - 1)) AS i FROM filtered)) f JOIN patterns p USING (keyword)",
    wider="SELECT DISTINCT m.domain, m.protein_id FROM members m JOIN keywords k USING (cluster_id) JOIN like_domain l ON l.keyword = k.keyword AND l.domain = m.domain",
    pam="SELECT DISTINCT m.genome_id, r.domain FROM refset r JOIN members m USING (protein_id)",
    sample="SELECT t.domain AS target, c.genome_id, c.domain FROM pam t JOIN pam c USING (genome_id)",
    totals="SELECT target, count(DISTINCT genome_id) AS n_train FROM sample GROUP BY 1",
    counts="SELECT target, domain AS feature, count(*) AS n FROM sample WHERE domain <> target GROUP BY ALL HAVING count(*) >= 2",
    strong="SELECT target, feature, -ln(1 - greatest(1e-12, least(1 - 1e-12, (n + 1.0::DOUBLE) / (n_train + 2.0::DOUBLE)))) AS strength FROM counts JOIN totals USING (target)",
    model="SELECT target, feature, strength / sum(strength) OVER (PARTITION BY target) AS weight FROM strong",
    present="SELECT m.target, p.genome_id, 2 * sum(m.weight) - 1 AS balance FROM model m JOIN pam p ON p.domain = m.feature GROUP BY ALL",
    best="SELECT genome_id, domain, protein_id FROM members WHERE score / 100000 >= 0.3 QUALIFY row_number() OVER (PARTITION BY genome_id, domain ORDER BY score DESC, protein_id) = 1",
    plausible="SELECT b.domain, b.protein_id FROM best b JOIN present a ON a.genome_id = b.genome_id AND a.target = b.domain WHERE a.balance >= -0.7",
)


def _extension(spark, d):
    """Patterns, the lists that hold them, proteins of orders, and the better half of each domain as reference set."""
    members = A.carriers(spark, d).withColumn("bsr", F.col("score") / 100000)
    begun = M.written()
    half = M.saved(quantiles(members, ["domain"], "score", [0.5]).withColumnRenamed("q0", "half"), "halves")
    M.remove_scratch(spark, begun, half)
    refs = members.join(half, "domain").filter("score >= half").select("domain", "protein_id").distinct()
    at = F.sequence(F.lit(1), F.size("types") - 2)
    named = _lists(spark, d).filter(F.size("types") > 2).select("cluster_id", F.explode(F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice("types", i, 3), "-")))).alias("keyword"))
    patterns = _patterns(spark, d)
    return refs, patterns, named.join(patterns.select("keyword"), "keyword", "left_semi"), members


@query(sql("", "SELECT domain, count(*) AS n FROM (SELECT * FROM refset UNION SELECT * FROM wider UNION SELECT * FROM plausible) GROUP BY 1", **SYNTENY))
def c5_extend_by_synteny(spark, d):
    from locusflow.plans import extend_by_synteny

    refs, patterns, keywords, members = _extension(spark, d)
    return extend_by_synteny(refs, patterns, keywords, members, similarity=0.1, cutoff=-0.7, limit=None).groupBy("domain").agg(F.count("*").alias("n"))


@query()
def c6_extend_by_clusters(spark, d):
    """Documents as proteins: the domain is the source, the genome the language, the neighbourhood the source and language."""
    from locusflow.plans import extend_by_clusters

    docs = A.table(spark, d, "documents")
    members = docs.select(F.col("lang").alias("genome_id"), F.col("doc_id").alias("protein_id"), F.col("source").alias("domain"), F.col("n_chars").cast("double").alias("score"), F.lit(1.0).alias("bsr"))
    good = A.references(spark, d).select("protein_id")
    refs = members.join(good, "protein_id", "left_semi").select("domain", "protein_id").distinct()
    hoods = docs.select(F.col("doc_id").alias("protein_id"), F.array("source", "lang").alias("neighbourhood"))
    return extend_by_clusters(refs, _texts(spark, d), hoods, members, cutoff=0.0)
