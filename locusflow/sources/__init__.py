"""Readers and writers of the file formats of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANKS = ("superkingdom", "clade", "phylum", "class", "order", "family", "genus", "species")
_LETTERS = {"d": "superkingdom", "c": "class", "p": "phylum", "o": "order", "f": "family", "g": "genus", "s": "species"}


def base_name(path):
    return F.element_at(F.split(path, "/"), -1)


def genome_id(path):
    """The file's name up to the first dot."""
    return F.split(base_name(path), r"\.").getItem(0)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated hits of seven or eight columns; comments, short and unreadable rows are skipped; a missing ratio is 1."""
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    parts = lines.select(genome_id(F.input_file_name()).alias("genome_id"), F.split("value", "\t").alias("p")).filter(F.size("p") >= 7)
    number = lambda i, kind: F.get("p", F.lit(i)).try_cast(kind)
    out = parts.select(
        "genome_id",
        F.get("p", F.lit(0)).alias("hit_id"),
        F.get("p", F.lit(1)).alias("query_id"),
        number(2, "double").alias("evalue"),
        number(3, "double").alias("bitscore"),
        number(4, "int").alias("sstart"),
        number(5, "int").alias("send"),
        number(6, "double").alias("pident"),
        F.coalesce(number(7, "double"), F.lit(1.0)).alias("bsr"),
    )
    return out.dropna(subset=["evalue", "bitscore", "sstart", "send", "pident"])


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, protein_id, header, sequence) of FASTA files, compressed ones too."""
    records = spark.read.option("lineSep", "\n>").text(path)
    # the first record of a file has its own '>' in front, the others have lost it
    text = F.regexp_replace("value", r"^\s*>", "")
    parts = records.select(genome_id(F.input_file_name()).alias("genome_id"), F.split(text, "\r?\n", 2).alias("p")).filter(F.trim(F.get("p", F.lit(0))) != "")
    header = F.get("p", F.lit(0))
    return parts.select("genome_id", F.split(F.trim(header), r"\s+").getItem(0).alias("protein_id"), header.alias("header"), F.regexp_replace(F.coalesce(F.get("p", F.lit(1)), F.lit("")), r"\s+", "").alias("sequence"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, protein_id, contig, start_pos, end_pos, strand, locus_tag) of features with an ID."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#"))
    parts = lines.select(genome_id(F.input_file_name()).alias("genome_id"), F.split("value", "\t").alias("p")).filter(F.size("p") >= 9)
    notes = F.get("p", F.lit(8))
    out = parts.select(
        "genome_id",
        F.regexp_extract(notes, r"ID=(?:cds-)?([^;]+)", 1).alias("protein_id"),
        F.get("p", F.lit(0)).alias("contig"),
        F.get("p", F.lit(3)).try_cast("int").alias("start_pos"),
        F.get("p", F.lit(4)).try_cast("int").alias("end_pos"),
        F.get("p", F.lit(6)).alias("strand"),
        F.regexp_extract(notes, r"locus_tag=([^;]+)", 1).alias("locus_tag"),
    )
    return out.filter((F.col("protein_id") != "") & F.col("start_pos").isNotNull() & F.col("end_pos").isNotNull())


def features_from_headers(sequences: DataFrame) -> DataFrame:
    """Features out of gene callers' headers ``id # start # end # strand # ...``."""
    p = F.split("header", r"\s*#\s*")
    found = sequences.filter(F.size(p) >= 4)
    return found.select(
        "genome_id",
        "protein_id",
        F.regexp_replace("protein_id", r"_[0-9]+$", "").alias("contig"),
        F.get(p, F.lit(1)).try_cast("int").alias("start_pos"),
        F.get(p, F.lit(2)).try_cast("int").alias("end_pos"),
        F.when(F.get(p, F.lit(3)) == "1", "+").otherwise("-").alias("strand"),
        F.col("protein_id").alias("locus_tag"),
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, genome_id, kind): files below a folder by their ending, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return with_kind(files)


def with_kind(files: DataFrame) -> DataFrame:
    """Genome and kind (faa, gff, fna) of paths; other files go."""
    kind = F.regexp_extract(base_name(F.col("path")), r"\.(faa|gff|fna)(?:\.gz)?$", 1)
    return files.select("path", genome_id(F.col("path")).alias("genome_id"), kind.alias("kind")).filter("kind <> ''")


def input_pairs(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(genomes with proteins and features, proteins without features, contigs without proteins); plain files before compressed ones."""
    order = Window.partitionBy("genome_id", "kind").orderBy(F.col("path").endswith(".gz"), "path")
    one = files.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    of = lambda k: one.filter(F.col("kind") == k).select("genome_id", F.col("path").alias(k))
    faa, gff, fna = of("faa"), of("gff"), of("fna")
    return faa.join(gff, "genome_id"), faa.join(gff, "genome_id", "left_anti"), fna.join(faa, "genome_id", "left_anti")


def global_ids(sequences: DataFrame) -> DataFrame:
    """All sequences under ids ``genome___protein``."""
    return sequences.select(F.concat_ws("___", "genome_id", "protein_id").alias("seq_id"), "sequence")


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, pattern) of lines ``name TAB item TAB ...``; empty ones go, of equal names the first in the files stays.

    Files go by their names. A line's place is its split's offset and its number
    within the split, so no line waits for another and names are only compared.
    """
    items = F.filter(F.transform(F.split("value", "\t"), lambda x: F.trim(x)), lambda x: x != "")
    lines = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"), items.alias("p"))
    parts = lines.filter(F.size("p") > 1)
    rows = parts.select(F.get("p", F.lit(0)).alias("keyword"), F.struct("file_path", "file_block_start", "line").alias("place"), F.array_sort(F.array_distinct(F.slice("p", F.lit(2), F.size("p")))).alias("pattern"))
    return rows.groupBy("keyword").agg(F.min_by("pattern", "place").alias("pattern"))


def pattern_items(patterns: DataFrame) -> DataFrame:
    """All items of each keyword's patterns as one sorted set."""
    return patterns.select("keyword", F.explode("pattern").alias("item")).groupBy("keyword").agg(F.array_sort(F.collect_set("item")).alias("items"))


def parse_taxonomy(lines: DataFrame, column: str = "tax") -> DataFrame:
    """Ranks of texts ``d__..;p__..``; a missing rank is NA, blanks in species become underscores."""
    found = {name: F.regexp_extract(column, rf"(?:^|;)\s*{letter}__([^;]*)", 1) for letter, name in _LETTERS.items()}
    out = lines
    for name, own in found.items():
        value = F.regexp_replace(F.trim(own), " ", "_") if name == "species" else F.trim(own)
        out = out.withColumn(name, F.when(value == "", F.lit("NA")).otherwise(value))
    return out


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, ranks...) of tab-separated lines of eight columns, or of an id and one text of all ranks."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p")).filter(F.size("p") >= 2)
    short = parse_taxonomy(parts.filter(F.size("p") < 8).select(F.get("p", F.lit(0)).alias("genome_id"), F.get("p", F.lit(1)).alias("tax"))).drop("tax")
    names = ("superkingdom", "phylum", "class", "order", "family", "genus", "species")
    long = parts.filter(F.size("p") >= 8).select(F.get("p", F.lit(0)).alias("genome_id"), *(F.get("p", F.lit(i + 1)).alias(n) for i, n in enumerate(names)))
    return short.select("genome_id", *names).unionByName(long)
