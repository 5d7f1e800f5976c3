"""SpotSigs fingerprints, with DataFrame functions only.

Anchors are very common words. Every occurrence of an anchor gives a signature:
the anchor and the chain of the next ``chain`` content words, over anchors in
between (they are looked for in the ``REACH`` words that follow, so a chain is
shorter where there are fewer). Where no anchor is among the ``chain`` words
before a content word, that word starts a chain of its own, so that texts poor
in anchors, or in other languages, are covered as well. Words are runs of
letters and digits in lower case. A document is the set of its signatures
(64-bit hashes).

Documents are compared by the Jaccard similarity of their sets. The similarity
is at most the ratio of the sets' lengths, so sets are partitioned by length:
those outside each other's bounds are never compared, and a comparison ends at
that bound where it is below the similarity asked for.

The fingerprint is the sorted set in hexadecimal, so equal texts have equal
fingerprints and the likeness of two fingerprints is the Jaccard similarity of
their sets.

Defined cases: a null text counts as empty; a text without words has an
empty fingerprint, and two empty fingerprints have likeness 1 (equal), an empty
and a filled one 0; texts of any length are read whole; repeated rows are rows
like others, in the order of their texts where ids are equal; a null id comes
last in descending order; with one row its next document is itself; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusflow.llm.common import saved

#: Common words of some languages, as anchors.
ANCHORS = {
    "en": "the of and to in is that for it with as was on be by this are from or an at not have which but",
    "de": "der die das und in den von zu mit sich des auf ist im dem nicht ein eine als auch es an er so",
    "fr": "le la les de des du et un une en que qui dans est pour par sur au avec il ne se pas plus ce",
    "es": "el la los las de y que en un una por con no se su para es al lo como del más o pero",
}
CHAIN = 3
#: Words after an anchor among which its chain lies.
REACH = 12
BUCKET_ROWS = 4000
THRESHOLD = 0.8


def anchor_words(anchors: dict[str, str] = ANCHORS) -> list[str]:
    return sorted({w for own in anchors.values() for w in own.split()})


def words_of(text: Column) -> Column:
    """Lower-case words; one empty word where there is none."""
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def signatures(text: Column, chain: int = CHAIN, anchors: dict[str, str] = ANCHORS) -> Column:
    """The sorted set of signature hashes (64 bits)."""
    known = anchor_words(anchors)

    def of(words: Column, anchored: Column) -> Column:
        flag = lambda i: F.coalesce(F.get(anchored, i), F.lit(False))

        def starts(i: Column) -> Column:
            quiet = ~flag(i - 1)
            for back in range(2, chain + 1):
                quiet = quiet & ~flag(i - back)
            return F.get(anchored, i) | quiet

        def signature(i: Column) -> Column:
            # an anchor's chain begins after it, another word's with it
            first = F.when(F.get(anchored, i), i + 2).otherwise(i + 1)
            follow = F.slice(F.filter(F.slice(words, first, REACH), lambda w: ~w.isin(known)), 1, chain)
            return F.xxhash64(F.when(F.get(anchored, i), F.get(words, i)).otherwise(F.lit("")), follow)

        return F.array_sort(F.array_distinct(F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), starts), signature)))

    found = _let(words_of(text), lambda words: _let(F.transform(words, lambda w: w.isin(known)), lambda anchored: of(words, anchored)))
    return F.when(F.coalesce(text, F.lit("")).rlike(r"[\p{L}\p{N}]"), found).otherwise(F.array().cast("array<bigint>"))


def fingerprint_of(signs: Column) -> Column:
    return F.array_join(F.transform(signs, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def length_bound(na: Column, nb: Column) -> Column:
    """The most that the similarity of sets of these lengths can be; two empty sets are equal."""
    return F.when(F.greatest(na, nb) == 0, F.lit(1.0)).otherwise(F.least(na, nb) / F.greatest(na, nb))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without a comparison where their lengths keep it below ``least``, or at 0."""
    bound = length_bound(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return F.when((bound < least) | (bound == 0), F.lit(0.0)).when(F.size(a) == 0, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def with_next(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Each row with the next one in descending (doc_id, text) order, in columns ``next_*``; the last one meets the first.

    ``derive`` adds columns to the dealt rows, so that each row's are made once.

    Rows are dealt into ranges of ids; each range also gets a copy of the first
    row of the range after it, so that neighbours meet inside a range. Only the
    bounds of the ranges are broadcast. There are as many ranges as their rows
    ask for, up to some for each shuffle partition that the session is set to,
    which a user raises with the input.
    """
    spark = rows.sparkSession
    ids = saved(rows.select("doc_id"), "ids")
    total = ids.count()
    ranges = int(min(max(1024, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), max(1, total // bucket_rows)))
    cuts = ids.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], min(0.01, 0.2 / ranges)) if ranges > 1 and total else []
    cuts = sorted({int(c) for c in cuts})
    key = F.lit(0)
    if cuts:
        bounds = F.array(*(F.lit(c) for c in cuts))
        key = F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))) if len(cuts) <= 8 else _range_of(F.col("doc_id"), cuts)
    key = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(key)
    tops = ids.withColumn("g", key).groupBy("g").agg(F.max("doc_id").alias("top")).orderBy(F.desc("g")).collect()
    # the range that comes before range g in descending order gets a copy of g's first row
    before = {tops[(k + 1) % len(tops)]["g"]: tops[k]["g"] for k in range(len(tops))} if tops else {}
    table = spark.createDataFrame([(r["g"], r["top"], before[r["g"]]) for r in tops], "g int, top long, to int")
    dealt = rows.withColumn("g", key.cast("int")).join(F.broadcast(table), "g")
    order = [F.desc_nulls_last("doc_id"), F.desc_nulls_last("text")]
    first = dealt.filter(F.col("doc_id").eqNullSafe(F.col("top")))
    first = first.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order))).filter("n = 1")
    names = rows.columns
    copies = first.select(*names, F.col("to").alias("g"), F.lit(True).alias("copy"))
    whole = dealt.select(*names, "g", F.lit(False).alias("copy")).unionByName(copies)
    whole = whole if derive is None else derive(whole)
    names = [c for c in whole.columns if c not in ("g", "copy")]
    window = Window.partitionBy("g").orderBy(F.col("copy"), *order)
    ahead = [F.lead(n).over(window).alias(f"next_{n}") for n in names]
    return whole.select(*names, "copy", *ahead).filter("not copy").drop("copy")


def _range_of(value: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below the value, by a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < F.lit(cuts[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(cuts))


def edited(text: Column, following: Column) -> Column:
    """The last half of the text's characters replaced by as many of the following text's first ones."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """doc_id, signs (sorted signature hashes) and fingerprint of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), signatures(F.col(text_col), chain).alias("signs"))
    return rows.select("doc_id", "signs", fingerprint_of(F.col("signs")).alias("fingerprint"))


def edit_report(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Fingerprint of every text and of its edited text, and the likeness to that and to the next document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pairs = with_next(rows, derive=lambda dealt: dealt.withColumn("signs", signatures(F.col("text"), chain)))
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    out = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "signs",
        signatures(F.col("edited"), chain).alias("edited_signs"),
        "next_signs",
    )
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint_of(F.col("signs")).alias("fingerprint"),
        fingerprint_of(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """doc_id, class_id and n_links (similar classes) of every row of ``docs``."""
    membership, pairs = similar_pairs(docs, threshold, id_col, text_col, chain)
    links = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    return membership.join(links, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): near-duplicate documents.

    ``membership(doc_id, class_id)`` puts documents of equal fingerprints into a
    class named after its smallest id; ``pairs(a, b, similarity)`` are the pairs
    of classes with at least ``threshold`` similarity. Texts without signatures
    are in no pair.

    Sets are partitioned by length: band k holds lengths from t^-k to t^-(k+1),
    so a partner lies in the own band or the next one. Within a band, sets that
    are similar enough share one of their rarest signatures (the first
    n - ceil(t n) + 1 in ascending order of frequency), which is the join key.
    """
    signed = saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), signatures(F.col(text_col), chain).alias("signs")), "signed")
    keyed = signed.withColumn("print", F.xxhash64("signs", F.size("signs")))
    classes = saved(keyed.groupBy("print", "signs").agg(F.min("doc_id").alias("class_id")), "classes")
    membership = keyed.join(classes.select("print", "class_id"), "print").select("doc_id", "class_id")
    filled = classes.filter(F.size("signs") > 0).select("class_id", "signs", F.size("signs").alias("n"))
    word = filled.select("class_id", "n", F.explode("signs").alias("sign"))
    common = word.groupBy("sign").agg(F.count("*").alias("df"))
    ranked = word.join(common, "sign").groupBy("class_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sign"))).alias("by"))
    prefix = F.slice(F.col("by"), 1, F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-1.0) / F.log(F.lit(threshold)) + 1e-9).cast("int")
    heads = saved(ranked.select("class_id", "n", band.alias("band"), F.explode(prefix).alias("s")).select("class_id", "n", "band", F.col("s.sign").alias("sign")), "heads")
    left = heads.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "sign", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    right = heads.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "sign", "band")
    near = (F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("a") < F.col("b")))
    candidates = left.join(right, ["sign", "band"]).filter(near & (F.col("na") >= F.col("nb") * threshold - 1e-9)).select("a", "b").distinct()
    sets = filled.select("class_id", "signs")
    scored = candidates.join(sets.select(F.col("class_id").alias("a"), F.col("signs").alias("sa")), "a").join(sets.select(F.col("class_id").alias("b"), F.col("signs").alias("sb")), "b")
    pairs = scored.withColumn("similarity", likeness(F.col("sa"), F.col("sb"))).filter(F.col("similarity") >= threshold)
    return membership, pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
