"""What each filter of a chain removes, in every order of the filters.

The documents of a part are counted by the set of filters that they fail. Sets
of filters already applied are the states of a lattice, and applying one more
is an edge; an order of k filters is a path of k edges from the empty set to the
full one. ``lattice`` counts the orders that reach a state (forward) and that
leave it (backward), so an edge lies on forward x backward orders. What an edge
removes follows from the counts by failed set; weighted with its orders that
gives a filter's Shapley sum, and the steps of each single order are read from
the same edges. Only the counts grow with the data: the lattice has k * 2^(k-1)
edges and is the same for every part.

Defined cases: a null text is an empty one; a null part is the empty string; a
null doc_id has no smaller one and is none, so such a row fails no identity
filter; repeated rows count each, and rows with one doc_id and one text don't
fail by each other; of several labels of a doc_id any with the value counts;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import column, saved, small_batches, text_slices

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LONG_BYTES = 1 << 20
#: The filter that needs the whole table: the text of a smaller doc_id.
SAME_TEXT = "E"


def text_mask(raw: bytes, chars: int) -> int:
    """The filters that a text of so many code points fails by itself, as bits: A, B, C, D from the lowest on.

    ``bytes.split`` divides at the white space of the definition; long texts
    are gone through word by word, so only their different words are held.
    """
    if len(raw) <= LONG_BYTES:
        words = raw.split()
        n, distinct = len(words), len(set(words))
    else:
        n, seen = 0, set()
        for n, word in enumerate(WORD.finditer(raw), 1):  # noqa: B007
            seen.add(word.group())
        distinct = len(seen)
    failed = n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n, 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MAX_CAPITALS_PERCENT * chars, len(raw.translate(None, SYMBOLS)) < len(raw)
    return sum(f << i for i, f in enumerate(failed))


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_slices(batches):
        mask = pa.array(map(text_mask, texts, rows.column("chars").to_pylist()), pa.int32())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("part"), rows.column("same"), mask], ["doc_id", "part", "same", "mask"])


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic): each document's failed filters as bits in the order of their letters, and its labels.

    Texts are told apart by their SHA-256. Only texts that are there twice meet
    the documents again, as a written table, so that Spark can split the rows of
    a text that very many documents share.
    """
    text = F.coalesce(column("text").cast("string"), F.lit(""))
    given = docs.select(column("doc_id").cast("long").alias("doc_id"), F.coalesce(column(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    hashed = small_batches(given).select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("same"), F.length("text").alias("chars"), F.col("text").cast("binary").alias("text"))
    rows = saved(hashed.mapInArrow(_masks, "doc_id long, part string, same binary, mask int"), "failures")
    first = saved(rows.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("same", "first"), "first-texts")
    known = labels.select(column("doc_id").cast("long").alias("doc_id"), (column("quality") == 1).alias("good"), (column("toxic") == 1).alias("toxic")).filter("good or toxic")
    known = saved(known.groupBy("doc_id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic")), "labels")
    joined = rows.join(first, "same", "left").join(known, "doc_id", "left")
    repeated = F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)
    return joined.select("part", (F.col("mask") + repeated).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def lattice(k: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders): every edge of the lattice of k filters and the number of orders that take it."""
    full = (1 << k) - 1
    bits = range(k)
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(1, full + 1):  # every state comes after its subsets
        forward[state] = sum(forward[state & ~(1 << f)] for f in bits if state >> f & 1)
    for state in reversed(range(full)):
        backward[state] = sum(backward[state | 1 << f] for f in bits if not state >> f & 1)
    return [(state, f, forward[state] * backward[state | 1 << f]) for state in range(full + 1) for f in bits if not state >> f & 1]


def audit(failed: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order of the filters and step, from ``(part, mask, good, toxic)``.

    (part, filter_order, step, filter, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley), counts of documents within the part.
    """
    spark, k = failed.sparkSession, len(letters)
    counts = failed.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    edges = F.explode(F.array(*(F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("orders")) for s, f, w in lattice(k)))).alias("e")
    met = counts.select("part", "mask", "n", "good", "toxic", edges).select("part", "mask", "n", "good", "toxic", "e.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    there = F.col("mask").bitwiseAND(F.col("state")) == 0
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0))
    removals = saved(
        met.groupBy("part", "state", "filter", "orders").agg(
            total("n", there & ~fails).alias("kept"), total("n", there & fails).alias("removed"), total("n", ~there & fails).alias("redundant"), total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
            total("good", there & fails).alias("good_lost"), total("toxic", there & fails).alias("toxic_lost"),
        ),
        "removals",
    )
    shapley = removals.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(letters[i] for i in order), step, state, f))
            state |= 1 << f
    paths = spark.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    named = F.element_at(F.array(*map(F.lit, letters)), F.col("filter") + 1).alias("filter")
    return removals.join(F.broadcast(paths), ["state", "filter"]).join(shapley, ["part", "filter"]).select(
        "part", "filter_order", "step", named, "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole documents, by language."""
    return audit(failures(docs, labels), "ABCD" + SAME_TEXT)


def interactions_sql() -> str:
    """The rows of ``interactions`` in DuckDB's SQL, each order followed step by step."""
    letters = "ABCD" + SAME_TEXT
    fails = " OR ".join(f"(d.{x} AND contains(before, '{x}'))" for x in letters)
    own = "CASE f " + " ".join(f"WHEN '{x}' THEN d.{x}" for x in letters) + " END"
    any_of = lambda xs: " OR ".join(xs)
    others = "CASE f " + " ".join(f"WHEN '{x}' THEN {any_of('d.' + y for y in letters if y != x)}" for x in letters) + " END"
    symbols = " OR ".join(f"contains(text, '{s}')" for s in SYMBOLS.decode())
    return f"""
WITH given AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM given),
d AS (
  SELECT part, len(words) < {MIN_WORDS} AS A, 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) AS B,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS_PERCENT} * length(text) AS C, ({symbols}) AS D, coalesce(first < doc_id, false) AS {SAME_TEXT},
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM worded),
counted AS (SELECT part, {", ".join(letters)}, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL),
letters AS (SELECT unnest(string_split_regex('{letters}', '')) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f, left(filter_order, step - 1) AS before FROM orders, range(1, 6) AS s(step)),
met AS (SELECT d.part, filter_order, step, f, n, good, toxic, {own} AS fails, ({fails}) AS gone, {others} AS other FROM counted d, steps),
summed AS (
  SELECT part, filter_order, step, f AS filter, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails AND NOT other), 0) AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM summed"""
