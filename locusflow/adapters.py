"""The driver's tables as tables of the domain, for Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes on contigs: users are contigs, events are genes of a minute's length."""
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 20).alias("genome_id"),
        F.col("user_id").alias("contig"),
        F.col("event_id").alias("protein_id"),
        start.alias("start_pos"),
        (start + 60).alias("end_pos"),
        F.col("event_type").alias("domain"),
        F.col("value").alias("score"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of brands in orders: an order is a protein, its items are hits that overlap more often than not."""
    start = F.col("l_partkey") % 100 + 1
    return _items(spark, sf_dir).select(
        (F.col("l_orderkey") % 100).alias("genome_id"),
        F.col("l_orderkey").cast("string").alias("hit_id"),
        F.concat_ws("___", "p_brand", "p_size").alias("query_id"),
        (F.col("l_discount") * 1e-4).alias("evalue"),
        (F.col("l_extendedprice") / 500).alias("bitscore"),
        (F.col("l_quantity") * 2).alias("pident"),
        start.alias("sstart"),
        (start + F.col("l_quantity").cast("long")).alias("send"),
        F.lit(None).cast("double").alias("bsr"),
    )


def query_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg((F.max("p_retailprice") / 10).alias("self_score"))
    return part.select(F.concat_ws("___", "p_brand", "p_size").alias("query_id"), (F.col("p_size") + 50).alias("length"), "self_score")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proteins of clusters, one domain each: orders are clusters, items are proteins."""
    return _items(spark, sf_dir).select(
        F.col("l_orderkey").alias("cluster_id"),
        F.col("l_suppkey").alias("genome_id"),
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("protein_id"),
        F.col("p_brand").alias("domain"),
        F.col("l_extendedprice").alias("score"),
        (F.col("l_quantity") * 2).cast("int").alias("identity"),
        F.col("l_linenumber").alias("start_pos"),
    )


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same proteins with orders as genomes, so that a genome has some of the domains only."""
    return members(spark, sf_dir).withColumn("genome_id", F.col("cluster_id"))


def best_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proteins with the best score of each genome and domain."""
    own = members(spark, sf_dir)
    best = own.groupBy("genome_id", "domain").agg(F.max("score").alias("score"))
    return own.join(best, ["genome_id", "domain", "score"], "left_semi")


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cluster_id"), F.concat(F.lit("csb-"), "o_orderpriority").alias("keyword"))


def refset(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("domain"), F.col("o_orderkey").alias("protein_id"))


def gene_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "p_brand")))
    lists = _items(spark, sf_dir).groupBy("l_orderkey").agg(order.alias("own"))
    return lists.select(F.col("l_orderkey").alias("cluster_id"), F.transform("own", lambda x: x["p_brand"]).alias("types"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = labels.join(docs, "doc_id")
    return joined.select(F.col("lang").alias("model"), F.col("doc_id").alias("hit_id"), F.col("n_chars").cast("double").alias("bitscore"), (F.col("quality") == 1).alias("is_tp"))


def seq_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    reps = docs.groupBy("lang", "source").agg(F.min("doc_id").alias("rep_id"))
    return docs.join(reps, ["lang", "source"]).select(F.col("lang").alias("family"), "rep_id", F.col("doc_id").alias("member_id"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    return docs.join(good, "doc_id").select(F.col("lang").alias("family"), F.col("doc_id").alias("protein_id"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, supplier = (table(spark, sf_dir, n) for n in ("region", "nation", "supplier"))
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("s_suppkey").alias("genome_id"), F.col("r_name").alias("phylum"), F.col("n_name").alias("class"))


#: The same tables in SQL.
CTE = {
    "genes": "SELECT user_id % 20 AS genome_id, user_id AS contig, event_id AS protein_id, CAST(floor(epoch(ts)) AS BIGINT) AS start_pos, CAST(floor(epoch(ts)) AS BIGINT) + 60 AS end_pos, event_type AS domain, value AS score FROM events",
    "hits": "SELECT l_orderkey % 100 AS genome_id, l_orderkey::VARCHAR AS hit_id, p_brand || '___' || p_size AS query_id, l_discount * 1e-4::DOUBLE AS evalue, l_extendedprice / 500 AS bitscore, l_quantity * 2 AS pident, l_partkey % 100 + 1 AS sstart, l_partkey % 100 + 1 + CAST(l_quantity AS BIGINT) AS send FROM lineitem JOIN part ON l_partkey = p_partkey",
    "query_table": "SELECT p_brand || '___' || p_size AS query_id, 50 + p_size AS length, max(p_retailprice) / 10 AS self_score FROM part GROUP BY p_brand, p_size",
    "members": "SELECT l_orderkey AS cluster_id, l_suppkey AS genome_id, l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS protein_id, p_brand AS domain, l_extendedprice AS score, CAST(l_quantity * 2 AS INTEGER) AS identity, l_linenumber AS start_pos FROM lineitem JOIN part ON l_partkey = p_partkey",
    "carriers": "SELECT l_orderkey AS cluster_id, l_orderkey AS genome_id, l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS protein_id, p_brand AS domain, l_extendedprice AS score, CAST(l_quantity * 2 AS INTEGER) AS identity, l_linenumber AS start_pos FROM lineitem JOIN part ON l_partkey = p_partkey",
    "best_members": "SELECT * FROM members QUALIFY score = max(score) OVER (PARTITION BY genome_id, domain)",
    "keywords": "SELECT o_orderkey AS cluster_id, 'csb-' || o_orderpriority AS keyword FROM orders",
    "refset": "SELECT c_mktsegment AS domain, o_orderkey AS protein_id FROM orders JOIN customer ON o_custkey = c_custkey",
    "gene_lists": "SELECT l_orderkey AS cluster_id, list(p_brand ORDER BY l_linenumber, l_partkey, l_suppkey) AS types FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey",
    "scores": "SELECT lang AS model, doc_id AS hit_id, CAST(n_chars AS DOUBLE) AS bitscore, quality = 1 AS is_tp FROM labels JOIN documents USING (doc_id)",
    "seq_clusters": "SELECT lang AS family, min(doc_id) OVER (PARTITION BY lang, source) AS rep_id, doc_id AS member_id FROM documents",
    "refs": "SELECT lang AS family, doc_id AS protein_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
    "taxonomy": "SELECT s_suppkey AS genome_id, r_name AS phylum, n_name AS class FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
}


#: Tables that SQL builds step by step.
NOT_STORED = ("fold", "grown")


def sql(names: str, body: str, **more: str) -> str:
    """SQL with the named domain tables, then further common table expressions, then the body."""
    parts = [f"{n} AS MATERIALIZED ({CTE[n]})" for n in names.split()] + [f"{n} AS {'' if n in NOT_STORED else 'MATERIALIZED '}({q})" for n, q in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
