"""Language identification by mixture inference.

Every language has a distribution over hashed byte n-grams (up to four bytes,
word boundaries included), counted over all labelled rows. A word's likelihood
in a language is the product over its n-grams. Expectation-maximisation then
estimates, for each document, the proportions of a mixture of languages over its
words. Starting from all languages, the one with the smallest proportion is
dropped while the penalised likelihood (Bayesian information criterion) gains;
the predicted language is the largest of what is left.

Defined cases: null text, or text without a letter, gets ``und`` and score 0,
as does every text when there is nothing to learn from (a letter is a character
of Unicode's categories L: numerals of any kind are none); texts of any length
are read whole; equal proportions go to the language that sorts first; a null id
is in no fold's held-out part; repeated rows give repeated results; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import crc_bucket, small_batches, text_slices, texts_of

BUCKET_BITS = 18
SMOOTHING = 0.02
#: A word may favour one language over another by this factor at most (natural log).
MAX_WORD_ODDS = 14.0
#: Steps end for a document once no proportion moves by more than this, or after so many.
TOLERANCE = 1e-3
ROUNDS = 200
#: Weight of the penalty for each language beyond the first.
PENALTY = 2.0
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: ASCII letters to lower case, other ASCII to a space; bytes from 128 stay.
_FOLD = np.array([b if b >= 128 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256)], np.uint8)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: log-probability of each n-gram bucket (rows) in each language (columns)
    table: np.ndarray

    @property
    def columns(self) -> list[np.ndarray]:
        return [np.ascontiguousarray(self.table[:, k]) for k in range(len(self.languages))]


def encoded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(folded bytes of all texts, each with a space before and after; where each text starts)."""
    data = [b" " + (t or "").lower().encode("utf-8", "replace") + b" " for t in texts]
    starts = np.cumsum([0, *map(len, data)])
    return _FOLD[np.frombuffer(b"".join(data), np.uint8)], starts


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the n-gram that ends at each position, whether that position belongs to a word).

    An n-gram is the last four bytes, cut at the space before the word; the
    space after a word belongs to the word.
    """
    at = data.astype(np.uint32)
    letter = data != 32

    def back(x: np.ndarray, k: int) -> np.ndarray:
        return np.concatenate([np.zeros(min(k, len(x)), x.dtype), x[:-k]])

    inner = back(letter, 1)
    packed = at | back(at, 1) << np.uint32(8)
    packed |= np.where(inner, back(at, 2) << np.uint32(16), np.uint32(0))
    packed |= np.where(inner & back(letter, 2), back(at, 3) << np.uint32(24), np.uint32(0))
    mixed = (packed * np.uint32(0x9E3779B1)) ^ (packed >> np.uint32(15))
    mixed *= np.uint32(0x85EBCA77)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), letter | inner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for rows, texts in text_slices(batches):
        langs = rows.column(2).to_pylist()
        for lang in set(langs):
            data, _ = encoded([t for t, own in zip(texts, langs, strict=True) if own == lang])
            bucket, used = grams(data)
            counts = np.bincount(bucket[used], minlength=1 << BUCKET_BITS)
            totals[lang] = totals[lang] + counts if lang in totals else counts
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each language: its counts as packed 64-bit integers. Rows come sorted by language."""
    lang, counts = None, np.zeros(1 << BUCKET_BITS, "<i8")

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([counts.tobytes()], pa.binary())], names=["lang", "counts"])

    for batch in batches:
        names, bucket, n = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b and names[a] != lang:
                if lang is not None:
                    yield packed()
                lang = names[a]
                counts[:] = 0
            counts[bucket[a:b]] += n[a:b]
    if lang is not None:
        yield packed()


def learn(labelled: DataFrame) -> LanguageModel:
    """Count n-grams by language over all rows of ``labelled(doc_id, text, lang)``.

    The driver gets one packed row of 2 MB for each language, whatever the number of rows.
    """
    counted = labelled.select("doc_id", "text", "lang").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = {r["lang"]: r["counts"] for r in counted.repartition("lang").sortWithinPartitions("lang").mapInArrow(_pack, "lang string, counts binary").toLocalIterator()}
    languages = tuple(sorted(rows))
    counts = np.zeros((1 << BUCKET_BITS, len(languages)))
    for k, lang in enumerate(languages):
        counts[:, k] = np.frombuffer(rows[lang], "<i8")
    used = max(1, int((counts.sum(1) > 0).sum()))
    table = np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * used)) if languages else counts
    return LanguageModel(languages, table.astype(np.float32))


def word_likelihoods(model: LanguageModel, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(likelihood of each word in each language relative to its best one, number of words of each text)."""
    data, starts = encoded(texts)
    bucket, used = grams(data)
    letter = data != 32
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    at = np.flatnonzero(used)
    if not len(at):
        return np.zeros((len(model.languages), 0), np.float32), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(opens[at])
    own = bucket[at]
    logs = np.stack([np.add.reduceat(column[own], first) for column in model.columns])
    logs -= logs.max(0)
    words = np.diff(np.searchsorted(at[first], starts))
    return np.exp(np.maximum(logs, -MAX_WORD_ODDS)), words


def _joint(p: np.ndarray, words: np.ndarray, share: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(likelihood of each word with each language, in all)."""
    joint = [own * np.repeat(column, words) for own, column in zip(p, share.astype(np.float32).T, strict=True)]
    total = joint[0].copy()
    for x in joint[1:]:
        total += x
    return joint, total


def mixture(p: np.ndarray, words: np.ndarray, share: np.ndarray, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of all documents at once, from ``share``: (proportions, log-likelihood).

    ``p`` has a row for each language and a column for each word of all
    documents. A document that has converged takes no further steps.
    """
    share = share.copy()
    at, part, n = np.arange(len(words)), p, words
    for _ in range(rounds):
        joint, total = _joint(part, n, share[at])
        scale, starts = 1 / total, np.cumsum(n) - n
        new = np.stack([np.add.reduceat(x * scale, starts) for x in joint], 1) / n[:, None]
        moving = np.abs(new - share[at]).max(1) > tolerance
        share[at] = new
        if not moving.any():
            break
        if not moving.all():
            part, at, n = part[:, np.repeat(moving, n)], at[moving], n[moving]
    _, total = _joint(p, words, share)
    return share, np.add.reduceat(np.log(total, dtype=np.float64), np.cumsum(words) - words)


def infer(model: LanguageModel, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, float]]]]:
    """(language, its proportion, the selected mixture) of each text."""
    out: list[tuple[str, float, list[tuple[str, float]]]] = [(UNKNOWN, 0.0, [])] * len(texts)
    if not model.languages:
        return out
    p, words = word_likelihoods(model, texts)
    docs = np.flatnonzero(words)
    docs = docs[[bool(_LETTER.search(texts[d])) for d in docs]] if len(docs) else docs
    if not len(docs):
        return out
    owner = np.repeat(np.arange(len(texts)), words)
    keep = np.isin(owner, docs)
    p, n = (p if keep.all() else p[:, keep]), words[docs]
    active = np.ones((len(docs), len(model.languages)))
    share, fit = mixture(p, n, active / active.sum(1, keepdims=True))
    open_docs = np.arange(len(docs))
    while len(open_docs):
        open_docs = open_docs[active[open_docs].sum(1) > 1]
        if not len(open_docs):
            break
        trial = active[open_docs].copy()
        weakest = np.where(trial > 0, share[open_docs], np.inf).argmin(1)
        trial[np.arange(len(open_docs)), weakest] = 0
        chosen = np.zeros(len(docs), bool)
        chosen[open_docs] = True
        part = p if chosen.all() else p[:, np.repeat(chosen, n)]
        begin = share[open_docs] * trial + 1e-3 * trial
        new_share, new_fit = mixture(part, n[open_docs], begin / begin.sum(1, keepdims=True))
        better = new_fit + PENALTY * 0.5 * np.log(n[open_docs] + 1.0) >= fit[open_docs]
        done = open_docs[better]
        active[done], share[done], fit[done] = trial[better], new_share[better], new_fit[better]
        open_docs = done
    for d, s in zip(docs, share, strict=True):
        best = int(s.argmax())
        mix = [(model.languages[k], float(s[k])) for k in np.argsort(-s, kind="stable") if s[k] > 1e-4]
        out[d] = (model.languages[best], float(min(1.0, max(0.0, s[best]))), mix)
    return out


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and the mixture (``mix``: array of language and proportion) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    mix_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            found = infer(shared.value, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([[{"lang": a, "share": b} for a, b in f[2]] for f in found], mix_type),
                ],
                names=["doc_id", "lang_pred", "score", "mix"],
            )

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, mix array<struct<lang: string, share: double>>")


def training_rows(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, text, lang) of the rows outside the held-out fold that have a language."""
    return docs.filter(crc_bucket(F.col("doc_id"), folds) != held_out).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter("lang is not null and text is not null")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold and identify every row of ``docs``."""
    found = identify(docs, learn(training_rows(docs)))
    return found.select("doc_id", F.coalesce(crc_bucket(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "mix")


def keep_identified(docs: DataFrame, min_share: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose main language is known and has at least ``min_share`` of the words.

    Null and empty texts and texts without a letter go, as does every row where
    no row has a language to learn from; a null id, repeated rows and other
    columns stay as they are; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(training_rows(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            kept = [lang != UNKNOWN and share >= min_share for lang, share, _ in infer(shared.value, texts)]
            yield rows.filter(pa.array(kept, pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)
