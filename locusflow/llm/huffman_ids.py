"""Token ids in Huffman-coded blocks.

Texts are encoded with a tokenizer of the tokenizers library, an end id is
appended to each document, and the ids of all documents, in ascending id order
of the documents, are written as independent blocks. The code is canonical and
length-limited (package-merge over the counts of all ids), so the code lengths
alone describe it. A block holds whole documents; it carries the bit offset of
every 256th id, so a decoder starts at many places at once and walks a lookup
table in lockstep.

A written folder has two Parquet tables: ``code`` (id, length) and ``blocks``
(part, block, start in the part, ids and documents of the block, checkpoints,
payload). Parts ascend with the document ids.

Defined cases: null text counts as empty and gives just the end id; repeated
document ids keep all their rows, ordered by their ids; a document longer than a
block gets one block of its own; an empty table gives empty files; other
columns are ignored.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusflow.llm.bpe import MEMO_CHARS, byte_letters, check_file, pieces_of
from locusflow.llm.common import scratch, text_slices, texts_of

#: Longest code, unless there are more ids than fit.
MAX_BITS = 18
BLOCK_IDS = 1 << 17
EVERY = 256
#: Bound of a worker's memo of pieces.
MEMO_PIECES = 1_000_000
BLOCKS = "part int, block int, start long, n_tokens long, doc_ids binary, doc_tokens binary, checkpoints binary, payload binary"


# ---- tokenizer -------------------------------------------------------------


class PieceEncoder(dict):
    """Packed ids of each piece, by the library's model; a piece is encoded when it is first looked up.

    The library's pattern cuts a text into pieces and its model encodes each
    piece alone, so a text's ids are those of its pieces. The table is emptied
    when it is full.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        check_file(path)
        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        self.size = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1
        self.type = "H" if self.size <= 1 << 16 else "I"
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.marked = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = str.maketrans({b: letter for letter, b in byte_letters().items()})

    def __missing__(self, piece: str) -> bytes:
        if piece in self.special:
            ids = [self.special[piece]]
        else:
            ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        own = array(self.type, ids).tobytes()
        if len(self) >= MEMO_PIECES:
            self.clear()
        if len(piece) <= MEMO_CHARS:
            self[piece] = own
        return own

    def packed(self, text: str | None) -> bytes:
        return b"".join([self[p] for p in pieces_of(text, self.marked)]) if text else b""


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One tokenizer, with its memo, for each worker process."""
    return PieceEncoder(path)


def token_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Rows of kind 0: doc_id and ``ids`` (packed, ``width`` bytes each, the end id last) of every row of ``docs``.

    Rows of kind 1, one for each task: how often the task saw each id, as packed
    64-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        if end_id >= encoder.size:
            raise ValueError(f"the end id {end_id} is not in the vocabulary")
        size = encoder.size
        kind = np.dtype("<u2" if encoder.type == "H" else "<u4")
        last = np.array([end_id], kind).tobytes()
        counts = np.zeros(size, np.int64)

        def rows_of(number: int, ids: pa.Array, packed: list[bytes]) -> pa.RecordBatch:
            flags = pa.array([number] * len(packed), pa.int32())
            width = pa.array([kind.itemsize] * len(packed), pa.int32())
            return pa.RecordBatch.from_arrays([flags, ids, width, pa.array(packed, pa.binary())], names=["kind", "doc_id", "width", "ids"])

        for rows, texts in text_slices(batches):
            ids = [encoder.packed(t) + last for t in texts]
            counts += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=size)
            yield rows_of(0, rows.column(0), ids)
        yield rows_of(1, pa.nulls(1, pa.int64()), [counts.astype("<i8").tobytes()])

    return texts_of(docs).mapInArrow(run, "kind int, doc_id long, width int, ids binary")


# ---- code ------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; by default ``MAX_BITS``, or what so many ids need and one more."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = limit or max(MAX_BITS, (len(used) - 1).bit_length() + 1)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit into codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    packages = np.zeros(0)
    leaves = []
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        at = np.argsort(merged, kind="stable")
        leaves.append(at < len(weights))
        merged = merged[at]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    take = 2 * len(used) - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for i in sorted(np.flatnonzero(lengths).tolist(), key=lambda i: (lengths[i], i)):
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For every string of so many bits as the longest code has, ``MAX_BITS`` at least: the id whose code they open with, times 32, plus the length of that code."""
    limit = max(MAX_BITS, int(lengths.max(initial=0)))
    table = np.full(1 << limit, 1, np.int64)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (limit - lengths[order])
    filled = np.repeat(order * 32 + lengths[order], spans)
    assert not len(order) or int(codes[order[0]]) == 0
    table[: len(filled)] = filled
    return table


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(payload of big-endian 32-bit words, bit offsets of every 256th id)."""
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    word = starts >> 5
    both = codes[ids] << (64 - size - (starts & 31)).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
    merged = np.bitwise_or.reduceat(both, first)
    at = word[first]
    out[at] |= merged >> np.uint64(32)
    out[at + 1] |= merged & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes(), starts[::EVERY].astype("<u4").tobytes()


def unpack(payloads: list[bytes], checkpoints: list[bytes], n_tokens: list[int], table: np.ndarray) -> list[np.ndarray]:
    """Ids of several blocks; all stretches between checkpoints advance together."""
    limit = len(table).bit_length() - 1
    words = np.frombuffer(b"".join(payloads) + bytes(EVERY * limit // 8 + 64), ">u4").astype(np.uint64)
    pairs = words[:-1] << np.uint64(32) | words[1:]
    bases = np.cumsum([0, *(len(p) * 8 for p in payloads)])
    marks = [np.frombuffer(c, "<u4").astype(np.int64) + b for c, b in zip(checkpoints, bases, strict=False)]
    at = np.concatenate(marks) if marks else np.zeros(0, np.int64)
    out = np.zeros((EVERY, len(at)), np.int64)
    shift = np.uint64(64 - limit)
    for k in range(EVERY):
        entry = table[(pairs[at >> 5] << (at & 31).astype(np.uint64)) >> shift]
        out[k] = entry >> 5
        at = at + (entry & 31)
    flat = np.ascontiguousarray(out.T)
    lanes = np.cumsum([0, *map(len, marks)])
    return [flat[a:b].reshape(-1)[:n] for a, b, n in zip(lanes, lanes[1:], n_tokens, strict=False)]


# ---- files -----------------------------------------------------------------


def _ids(value: bytes, width: int) -> np.ndarray:
    return np.frombuffer(value, f"<u{width}")


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a partition's tasks together, as one row for each id."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for value in batch.column(0).to_pylist():
            own = np.frombuffer(value, "<i8").copy()
            own[: len(total)] += total
            total = own
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> None:
    """Encode every text and write the two tables. The driver gets one count for each id of the vocabulary."""
    spark = docs.sparkSession
    path = scratch(spark, "token-ids")
    token_ids(docs, tokenizer, end_id).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    both = spark.read.schema("doc_id long, width int, ids binary, kind int").parquet(path)
    ids = both.filter("kind = 0").drop("kind")
    rows = both.filter("kind = 1").select("ids").mapInArrow(_add_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy()
    lengths = code_lengths(counts)
    table = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(table, "id long, length int").coalesce(1).write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = shared.value
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        docs_held: list[int | None] = []
        block = start = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, start, size
            payload, marks = pack(np.concatenate(held).astype(np.int64), codes, lengths)
            doc_ids = np.array([np.iinfo(np.int64).min if d is None else d for d in docs_held], "<i8").tobytes()
            doc_tokens = np.array([len(x) for x in held], "<i8").tobytes()
            row = [part, block, start, size, doc_ids, doc_tokens, marks, payload]
            block, start, size = block + 1, start + size, 0
            held.clear()
            docs_held.clear()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(",")])

        for batch in batches:
            for doc, width, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = _ids(value, width)
                if held and size + len(own) > BLOCK_IDS:
                    yield flush()
                held.append(own)
                docs_held.append(doc)
                size += len(own)
        if held:
            yield flush()

    ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids").mapInArrow(run, BLOCKS).write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ``ids`` (packed little-endian unsigned 32-bit integers) from the files alone.

    The driver gets the code and one row for each part that was written.
    """
    code = spark.read.parquet(f"{folder}/code").collect()
    lengths = np.zeros(max((r["id"] for r in code), default=0) + 1, np.int64)
    for r in code:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    totals = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before, offset = {}, 0
    for part in sorted(totals):
        before[part] = offset
        offset += totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(shared.value)
        for batch in batches:
            rows = batch.to_pylist()
            for k in range(0, len(rows), 8):
                own = rows[k : k + 8]
                decoded = unpack([r["payload"] for r in own], [r["checkpoints"] for r in own], [r["n_tokens"] for r in own], table)
                for r, ids in zip(own, decoded, strict=True):
                    docs = np.frombuffer(r["doc_ids"], "<i8")
                    sizes = np.frombuffer(r["doc_tokens"], "<i8")
                    ends = np.cumsum(sizes)
                    packed = ids.astype("<u4")
                    values = [packed[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
                    null = docs == np.iinfo(np.int64).min
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64(), mask=null), pa.array(before[r["part"]] + r["start"] + ends - sizes), pa.array(sizes, pa.int64()), pa.array(values, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digests(ids: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the packed ids."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the ids of every text to a scratch folder and read the digests back from its files."""
    folder = scratch(docs.sparkSession, "huffman-ids")
    write_ids(docs, tokenizer, end_id, folder)
    return digests(read_ids(docs.sparkSession, folder))


