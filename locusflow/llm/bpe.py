"""Byte-level byte-pair encoding and decoding.

A text falls into pieces by the tokenizer's pattern, and each piece is encoded
alone. For a piece, two flat arrays hold the parts between the boundaries and the
merge ranks of adjacent parts; the encoder scans for the smallest rank, deletes
the boundary between the two parts and refreshes the ranks of the neighbours,
until no adjacent pair has a rank. Words are short, so the scans beat a heap.
Scans of a piece of n bytes cost n squared, so pieces above ``LONG_PIECE`` bytes
(runs without a blank) keep the boundaries as links and take the smallest rank
from a heap: the same merges in the same order.

Each distinct piece is encoded once per worker while the memo holds it; the memo
is bounded and is emptied when full.

Defined cases: null text counts as empty and has no ids; special tokens inside
a text become their own ids, as the tokenizer's file says; texts and pieces may
have any length; an empty table gives no rows; repeated rows give repeated
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from locusflow.llm.common import text_slices, texts_of

#: The splitting pattern of byte-level BPE vocabularies of this family (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = 1 << 30
NO_PAIR = (NO_RANK, 0)
#: Bytes of a piece above which ranks are kept in a heap.
LONG_PIECE = 256
#: Bounds of the memo of a worker.
MEMO_PIECES = 600_000
MEMO_CHARS = 40
#: Letters of the fast pattern: texts of ASCII and these need no Unicode tables.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
_FAST = re.compile(rf" ?[{_LATIN}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\t-\r 0-9{_LATIN}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_FULL = regex.compile(PATTERN)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, back to the byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in kept}
    moved = [b for b in range(256) if b not in set(kept)]
    return letters | {chr(256 + n): b for n, b in enumerate(moved)}


def check_file(path: str) -> dict:
    """The tokenizer file at ``path``; an error if it is no byte-level BPE with the pattern above and plain special tokens."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, before = data["model"], data.get("pre_tokenizer") or {}
    plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    cut = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    marked = all(not t.get(k) for t in data["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if model.get("type", "BPE") != "BPE" or data.get("normalizer") or not (plain and cut and marked):
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    return data


class Bpe:
    """A byte-level BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        data = check_file(path)
        letters = byte_letters()
        self.ids: dict[bytes, int] = {bytes(letters[c] for c in token): i for token, i in data["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        #: (id, id) of adjacent parts, packed into one integer, to (rank, id of both together)
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = (bytes(letters[c] for c in x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            self.pairs[self.ids[left] << 20 | self.ids[right]] = (rank, self.ids[left + right])
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.marked = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max([*self.ids.values(), *self.special.values()], default=-1) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in self.ids.items():
            self.tokens[i] = token
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.memo: dict[str, bytes] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        """Merge the parts of one piece, the smallest rank first, the leftmost of equal ones."""
        if len(piece) > LONG_PIECE:
            return self.encode_long_piece(piece)
        pairs = self.pairs
        parts = [self.single[b] for b in piece]  # the ids between the boundaries that are left
        ranks = [pairs.get(a << 20 | b, NO_PAIR)[0] for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            at = ranks.index(low)
            merged = pairs[parts[at] << 20 | parts[at + 1]][1]
            parts[at] = merged
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = pairs.get(parts[at - 1] << 20 | merged, NO_PAIR)[0]
            if at < len(ranks):
                ranks[at] = pairs.get(merged << 20 | parts[at + 1], NO_PAIR)[0]
        return parts

    def encode_long_piece(self, piece: bytes) -> list[int]:
        """As ``encode_piece``, with the ranks in a heap; a boundary's entries are void once its parts have changed."""
        pairs, n = self.pairs, len(piece)
        parts = [self.single[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[key][0], k, key) for k in range(n - 1) if (key := parts[k] << 20 | parts[k + 1]) in pairs]
        heapify(heap)
        while heap:
            _, at, key = heappop(heap)
            right = after[at]
            if parts[at] < 0 or right >= n or parts[at] << 20 | parts[right] != key:
                continue
            parts[at], parts[right] = pairs[key][1], -1
            follow = after[at] = after[right]
            if follow < n:
                before[follow] = at
                if (key := parts[at] << 20 | parts[follow]) in pairs:
                    heappush(heap, (pairs[key][0], at, key))
            if (lead := before[at]) >= 0 and (key := parts[lead] << 20 | parts[at]) in pairs:
                heappush(heap, (pairs[key][0], lead, key))
        return [p for p in parts if p >= 0]

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        memo = self.memo
        pieces = pieces_of(text, self.marked)
        try:
            return b"".join([memo[p] for p in pieces])
        except KeyError:
            return b"".join([memo[p] if p in memo else self.remember(p) for p in pieces])

    def remember(self, piece: str) -> bytes:
        ids = [self.special[piece]] if piece in self.special else self.encode_piece(piece.encode())
        own = array("I", ids).tobytes()
        if len(self.memo) >= MEMO_PIECES:
            self.memo.clear()
        if len(piece) <= MEMO_CHARS:
            self.memo[piece] = own
        return own

    def decode(self, ids: bytes) -> str:
        """Text of packed ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in array("I", ids)]).decode("utf-8", "replace")


def pieces_of(text: str, marked: regex.Pattern | None = None) -> list[str]:
    """The pieces of a text by the pattern, in order, special tokens apart."""
    if marked is not None and marked.search(text):
        return [p for part in marked.split(text) if part for p in ([part] if marked.fullmatch(part) else pieces_of(part))]
    return (_FAST if _OTHER.search(text) is None else _FULL).findall(text)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Bpe:
    """One vocabulary, with its memo, for each worker process."""
    return Bpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (packed little-endian unsigned 32-bit integers) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for rows, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([bpe.packed(t or "") for t in texts], pa.binary())], names=["doc_id", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` of rows made by ``encode``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text, decode its ids, and give the digests of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for rows, texts in text_slices(batches):
            ids = [bpe.packed(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
