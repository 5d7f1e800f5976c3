"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest length. Pieces are dealt by
hash into groups of bounded size, and each group is packed alone: the longest
piece first, each into the open bin that it fills best. Where no bin has room, a
bin opens of the length with the least cost, counting the room that the pieces
to come can use at the best rate. At the end each bin shrinks to the smallest
permitted length that holds its contents. The whole is done once for each choice
of the shortest and the longest length to open, and the cheapest result of the
group stays.

A bin of length c costs c (1 + c / attention) + overhead.

Defined cases: a document counts its words and one end mark, so null and empty
texts are pieces of one token; pieces of equal length go in order of id and
piece; repeated rows are packed each, told apart by ``doc_tokens`` and ``row``; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import saved, texts_of

CAPACITIES = (512, 1024, 2048, 4096, 8192)
GROUP_PIECES = 20_000
WORDS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, doc_tokens long, row int, piece int, start long, n_tokens int, bin_id long, capacity int, position int, used int"


@dataclass(frozen=True)
class Costs:
    capacities: tuple[int, ...] = CAPACITIES
    attention: float = 32_768.0
    overhead: float = 48.0

    def of(self, capacity: int) -> float:
        return capacity * (1 + capacity / self.attention) + self.overhead

    @property
    def rate(self) -> float:
        """Least cost of a token in a full bin."""
        return min(self.of(c) / c for c in self.capacities)

    def fitting(self, tokens: int) -> int:
        return min(c for c in self.capacities if c >= tokens)


def pack_sizes(sizes: list[int], costs: Costs, largest: int, smallest: int = 0) -> tuple[list[int], list[int], float]:
    """Best-fit decreasing of descending ``sizes``: (bin of each piece, tokens of each bin, cost after downsizing).

    ``smallest`` and ``largest`` bound the lengths that are opened, except for pieces that need more.
    """
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin has room r
    left = sum(sizes)
    rate = costs.rate
    bins: list[int] = []
    used: list[int] = []
    for size in sizes:
        left -= size
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            stack = by_room[room]
            at = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            options = [c for c in costs.capacities if c >= size and smallest <= c <= largest] or [costs.fitting(size)]
            room = min(options, key=lambda c: (costs.of(c) - rate * min(c - size, left), c))
            at = len(used)
            used.append(0)
        bins.append(at)
        used[at] += size
        room -= size
        if room:
            by_room.setdefault(room, []).append(at)
            rooms |= 1 << room
    return bins, used, sum(costs.of(costs.fitting(u)) for u in used)


def best_packing(sizes: list[int], costs: Costs) -> tuple[list[int], list[int], float]:
    """The cheapest packing over the choices of the shortest and the longest length to open."""
    ranges = combinations_with_replacement(sorted(costs.capacities), 2)
    return min((pack_sizes(sizes, costs, b, a) for a, b in ranges), key=lambda x: x[2])


def pieces(docs: DataFrame, largest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_tokens, row, piece, start, n_tokens): documents cut at the largest length.

    ``row`` counts the rows of one id and length.
    """
    tokens = (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)) + 1).cast("long")
    counted = saved(texts_of(docs, id_col, text_col).select("doc_id", tokens.alias("tokens")), "lengths")
    numbered = counted.groupBy("doc_id", "tokens").agg(F.count("*").alias("rows")).withColumn("row", F.explode(F.sequence(F.lit(0), (F.col("rows") - 1).cast("int"))))
    cut = numbered.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / largest).cast("int"))))
    start = F.col("piece").cast("long") * largest
    return cut.select("doc_id", F.col("tokens").alias("doc_tokens"), "row", "piece", start.alias("start"), F.least(F.lit(largest).cast("long"), F.col("tokens") - start).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, costs: Costs | None = None, id_col: str = "doc_id", text_col: str = "text", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row for each piece: its bin, the bin's length, its position in the bin, and the bin's tokens."""
    costs = costs or Costs()
    cut = saved(pieces(docs, max(costs.capacities), id_col, text_col), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    # the length is no part of the key, so every group has short and long pieces
    grouped = cut.withColumn("g", F.pmod(F.xxhash64("doc_id", "doc_tokens", "row", "piece"), F.lit(groups)).cast("int"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "doc_tokens", "row", "piece"], ascending=[False, True, True, True, True], ignore_index=True)
        sizes = rows["n_tokens"].tolist()
        bins, used, _ = best_packing(sizes, costs)
        filled = [0] * len(used)
        position = []
        for b, n in zip(bins, sizes, strict=True):
            position.append(filled[b])
            filled[b] += n
        bin_of = np.array(bins, np.int64)
        tokens = np.array(used, np.int32)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"],
                "doc_tokens": rows["doc_tokens"],
                "row": rows["row"],
                "piece": rows["piece"],
                "start": rows["start"],
                "n_tokens": rows["n_tokens"],
                "bin_id": (int(key[0]) << 32) + bin_of,
                "capacity": np.array([costs.fitting(u) for u in used], np.int32)[bin_of],
                "position": np.array(position, np.int32),
                "used": tokens[bin_of],
            }
        )

    return grouped.groupBy("g").applyInPandas(run, SCHEMA)


def bins_of(packed: DataFrame) -> DataFrame:
    """One row for each bin: length, tokens used, and its pieces in order."""
    order = F.array_sort(F.collect_list(F.struct("position", "doc_id", "row", "piece", "n_tokens")))
    return packed.groupBy("bin_id", "capacity", "used").agg(order.alias("pieces"))


