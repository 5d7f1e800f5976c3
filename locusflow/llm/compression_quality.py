"""Quality rules by compression bands.

Every text is compressed with zstandard as a whole and in fixed chunks. Text
that compresses far better than prose repeats itself, text that barely
compresses is noise; all limits depend on the length that was compressed,
because short texts compress worse. The last chunk is the text's last
``CHUNK_BYTES``, so every byte lies in a chunk; a shorter text is one chunk. Two
word rules come before the bands: too few words, and too many words inside
5-word windows that occur twice or more.

Defined cases: null text counts as empty; an empty text has no words and fails
the base rule; texts of any length are read whole; rows are judged one by one,
so null ids and repeated rows give results of their own and an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from locusflow.llm.common import small_batches, text_slices, texts_of

#: (bytes from, lowest and highest ratio of the whole text): prose of the length lies well inside. The limits of short
#: texts have zstandard's frame of 9 bytes in them; prose below 120 bytes is often stored as it is, like noise.
WHOLE_BANDS = (
    (0, 0.75, math.inf),
    (40, 0.62, math.inf),
    (80, 0.50, math.inf),
    (120, 0.47, 1.00),
    (160, 0.45, 0.96),
    (200, 0.42, 0.98),
    (400, 0.36, 0.86),
    (800, 0.30, 0.78),
    (2_000, 0.26, 0.72),
    (5_000, 0.22, 0.70),
    (20_000, 0.18, 0.70),
)
CHUNK_BYTES = 2_048
#: A chunk is judged by the limits of a whole text of its length, wider by this on either side.
CHUNK_SLACK = 0.02
#: Largest share of chunks outside their band.
MAX_BAD_CHUNKS = 0.25
LEVEL = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def repeated_window_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """For each text, its words inside windows of ``window`` words found twice or more in that text."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total = int(counts.sum())
    if total < window:
        return np.zeros(len(words), np.int64)
    hashes = np.fromiter((hash(w) for ws in words for w in ws), np.int64, total).view(np.uint64)
    text = np.repeat(np.arange(len(words)), counts)
    mixed = np.zeros(total - window + 1, np.uint64)
    for k in range(window):
        mixed = (mixed ^ hashes[k : total - window + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = text[: len(mixed)] == text[window - 1 :]
    at = np.flatnonzero(inside)
    key = mixed[at] ^ (text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(total + 1, np.int64)
    starts = at[twice]
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(text[covered], minlength=len(words))


def duplicate_lines(data: bytes) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines)) if len(lines) > 1 else 0


def band_of(size: int) -> tuple[float, float]:
    low, high = WHOLE_BANDS[0][1:]
    for start, lo, hi in WHOLE_BANDS:
        if size >= start:
            low, high = lo, hi
    return low, high


def compression_verdict(data: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """(ratio of the whole text, chunks, chunks out of band, whether the text passes)."""
    if not data:
        return 0.0, 0, 0, False
    size = len(data)
    ratio = len(packer.compress(data)) / size
    low, high = band_of(size)
    fits = low <= ratio <= high
    if size <= CHUNK_BYTES:
        return ratio, 1, int(not fits), fits
    low, high = band_of(CHUNK_BYTES)
    starts = [*range(0, size - CHUNK_BYTES, CHUNK_BYTES), size - CHUNK_BYTES]
    parts = [len(packer.compress(data[a : a + CHUNK_BYTES])) / CHUNK_BYTES for a in starts]
    bad = sum(not low - CHUNK_SLACK <= x <= high + CHUNK_SLACK for x in parts)
    return ratio, len(parts), bad, fits and bad <= MAX_BAD_CHUNKS * len(parts)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for rows, texts in text_slices(batches):
        data = [(t or "").encode() for t in texts]
        words = [d.split() for d in data]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        repeats = repeated_window_words(words)
        spaces = np.array([len(d) - len(d.translate(None, SPACES)) for d in data], np.int64)
        chars = np.array([len(t or "") for t in texts], np.int64)
        symbols = np.array([len(d) - len(d.translate(None, SYMBOLS)) for d in data], np.int64)
        lines = np.array([duplicate_lines(d) for d in data], np.int64)
        verdicts = [compression_verdict(d, packer) for d in data]
        failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
        passed = np.array([v[3] for v in verdicts], bool)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                *(pa.array(x) for x in (n_words, chars - spaces, symbols, lines, repeats, failed, ~failed & passed)),
                pa.array([v[0] for v in verdicts], pa.float64()),
                pa.array([v[1] for v in verdicts], pa.int64()),
                pa.array([v[2] for v in verdicts], pa.int64()),
            ],
            names=[x.split()[0] for x in SCHEMA.split(",")],
        )


def compression_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word counts, compression figures, ``base_failed`` and ``kept``."""
    return texts_of(docs, id_col, text_col).mapInArrow(_judge, SCHEMA)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns, whatever their names.

    Null and empty texts go; a null id or repeated ids don't matter, each row is
    judged by its own whole text; an empty table stays empty.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.select([id_col, text_col])
            kept = [k for part in _judge(iter([whole.rename_columns(["doc_id", "text"])])) for k in part.column("kept").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return small_batches(docs).mapInArrow(judge, docs.schema)
