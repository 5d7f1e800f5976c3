"""Toxicity by a weighted lexicon.

Text is folded first: compatibility forms to plain letters, marks that are no
part of a letter and invisible characters out, then lower case, look-alike
letters of other scripts to Latin, digits and signs that stand for letters
inside a word to those letters. An
Aho-Corasick automaton then finds every lexicon pattern that starts at a word
start (patterns ending in a space are whole words, others are stems). A hit
inside an exception phrase does not count, and of hits at the same word only
the heaviest counts. The summed weight, as it is and by length, goes through a
logistic curve.

The lexicon is learned from labelled rows: stems and words by their document
frequency among toxic and other rows, kept where the lower bound of their
log-odds is high and where their share of toxic rows would be unlikely by chance
for any of as many patterns as are tested. Near copies are no evidence of their
own: a pattern must be in several toxic texts that differ in their smallest
shingle hash, of which an or of bits keeps count. Counting and the test run on
Spark over all labelled rows; the driver receives only the patterns that pass, at most
``MAX_PATTERNS`` of them, those that tell most.

Exception phrases are learned as well: pairs of neighbouring words, one of them
hit, that clean rows hold at least as often as toxic ones.

Defined cases: null and empty texts have no hits and get the score of no hits;
texts of any length are read whole; ids without a label, and null ids, are
scored but not learned from (a null id is not held out); contradicting labels of
one id count as toxic; without a toxic row, or without another one, to learn
from every score is 0.
Repeated rows give repeated results; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusflow.llm.common import crc_bucket, saved, text_slices, texts_of

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
    "м": "m", "т": "t", "н": "h", "в": "b", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u", "ο": "o", "α": "a", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
#: Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Diacritics of all blocks, variation selectors, and characters that show nothing.
_UNSEEN = regex.compile(r"[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe00-\ufe0f\ufe20-\ufe2f\p{Cf}]+")
#: A pattern must be in so many toxic rows to be tested; an exception phrase in so many clean ones.
MIN_ROWS = 4
#: A pattern must be in so many different toxic texts, near copies taken for one; told by shingles of so many words.
MIN_TEXTS = 4
SHINGLE = 3
#: Chance that any pattern at all gets into the lexicon without telling.
ALPHA = 0.05
#: Size of the lexicon, and of the learned exception phrases, at most.
MAX_PATTERNS = 100_000
STEMS = (4, 5, 6, 7)
#: Least lower bound (two standard errors) of a pattern's log-odds.
MIN_LOG_ODDS = 1.5
MAX_WEIGHT = 6.0
BROADCAST_ROWS = 1_000_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_hits long, weight double"

_SIGNS = re.compile(r"[0134578@$!]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")
_LOOK = str.maketrans(LOOK_ALIKES)
_LOOKS = re.compile("[" + "".join(LOOK_ALIKES) + "]")
_SUBS = str.maketrans(SUBSTITUTES)
_ASCII_WORDS = str.maketrans({chr(c): " " for c in range(128) if not chr(c).isalnum()})


def _letters(match: re.Match) -> str:
    """Signs that stand for letters: after a letter, or at a word's start before two letters."""
    signs, text, at = match[0], match.string, match.start()
    if at and text[at - 1].isalpha():
        return signs.translate(_SUBS)
    opens = (not at or not text[at - 1].isalnum()) and "!" not in signs and "8" not in signs
    return signs.translate(_SUBS) if opens and text[match.end() : match.end() + 2].isalpha() and match.end() + 2 <= len(text) else signs


def fold(text: str) -> str:
    """Plain lower-case letters, look-alikes and digit substitutions undone, words joined by single spaces."""
    if text.isascii():
        return " " + " ".join(_SIGNS.sub(_letters, text.lower()).translate(_ASCII_WORDS).split()) + " "
    text = unicodedata.normalize("NFKC", _UNSEEN.sub("", unicodedata.normalize("NFKC", text)).casefold())
    if _LOOKS.search(text):
        text = text.translate(_LOOK)
    return " " + " ".join(_WORD.findall(_SIGNS.sub(_letters, text))) + " "


def patterns_of(word: str) -> list[str]:
    """The whole word (with its end) and its stems."""
    return [f" {word} ", *(f" {word[:n]}" for n in STEMS if len(word) >= n)]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    bias: float
    by_weight: float
    by_density: float

    def score(self, weight: float, density: float) -> float:
        if not self.weights:
            return 0.0
        x = self.bias + self.by_weight * weight + self.by_density * density
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


class Matcher:
    """Aho-Corasick automaton over the lexicon and the exception phrases."""

    def __init__(self, model: ToxicityModel):
        self.automaton = ahocorasick.Automaton()
        for phrase in model.exceptions:
            self.automaton.add_word(folded := fold(phrase), (len(folded), None))
        for pattern, weight in model.weights.items():
            self.automaton.add_word(pattern, (len(pattern), weight))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[float]:
        """The heaviest weight at each word that is hit outside exception phrases."""
        if not len(self.automaton):
            return []
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if not spared:
            return list(best.values())
        # both in order of the text, so that each span is met once
        kept, reach, k = [], -1, 0
        spared.sort()
        for start in sorted(best):
            while k < len(spared) and spared[k][0] <= start:
                reach = max(reach, spared[k][1])
                k += 1
            if start >= reach:
                kept.append(best[start])
        return kept

    def hit_pairs(self, folded: str) -> set[str]:
        """The pairs of neighbouring words of which one is hit."""
        pairs = set()
        for end, (size, weight) in self.automaton.iter(folded) if len(self.automaton) else ():
            if weight is not None:
                start = end - size + 1
                after = folded.find(" ", start + 1)
                before = folded.rfind(" ", 0, start)
                if before >= 0:
                    pairs.add(folded[before : after + 1])
                if (last := folded.find(" ", after + 1)) >= 0:
                    pairs.add(folded[start : last + 1])
        return pairs


def features(hits: list[float], folded: str) -> tuple[float, float]:
    """(log of one plus the summed weight, summed weight by the root of the number of words)."""
    total = sum(hits)
    return math.log1p(total), total / math.sqrt(max(1, folded.count(" ") - 1))


def text_bit(folded: str) -> int:
    """One of 63 bits by the smallest hash of the text's shingles of words, mostly the same for near copies."""
    words = folded.split()
    starts = range(max(1, len(words) - SHINGLE + 1))
    return 1 << min(zlib.crc32(" ".join(words[k : k + SHINGLE]).encode("utf-8", "replace")) for k in starts) % 63


COUNTS = "pattern string, toxic int, n long, bits long"


def _counted(found_in):
    """Rows by label of what ``found_in(folded text)`` gives, as partial counts of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, int]] = Counter()
        bits: dict[str, int] = {}
        find = found_in()

        def flush() -> pa.RecordBatch:
            keys = list(counts)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([counts[k] for k in keys], pa.int64()),
                    pa.array([bits[k[0]] if k[1] else 0 for k in keys], pa.int64()),
                ],
                names=["pattern", "toxic", "n", "bits"],
            )
            counts.clear()
            bits.clear()
            return out

        for rows, texts in text_slices(batches):
            for text, toxic in zip(texts, rows.column(2).to_pylist(), strict=True):
                folded = fold(text or "")
                found = find(folded)
                counts.update((p, toxic) for p in found)
                if toxic:
                    bit = text_bit(folded)
                    for p in found:
                        bits[p] = bits.get(p, 0) | bit
                if len(counts) > 200_000:
                    yield flush()
        yield flush()

    return run


def _all_patterns():
    known: dict[str, list[str]] = {}

    def find(folded: str) -> set[str]:
        found: set[str] = {""}
        for word in set(folded.split()):
            if (own := known.get(word)) is None:
                known[word] = own = patterns_of(word)
            found.update(own)
        if len(known) > 300_000:
            known.clear()
        return found

    return find


def _figures(model: ToxicityModel):
    """Rows of each partition by label and by their two features on a grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        counts: Counter[tuple[int, int, int]] = Counter()
        for rows, texts in text_slices(batches):
            for text, toxic in zip(texts, rows.column(2).to_pylist(), strict=True):
                folded = fold(text or "")
                a, b = features(matcher.hits(folded), folded)
                counts[round(a * 10), round(b * 10), toxic] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)), pa.array([counts[k] for k in keys], pa.int64())], names=["a", "b", "toxic", "n"]
        )

    return run


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton steps; columns after the first whose slope would fall below 0 are left out."""
    used = list(range(x.shape[1]))
    while True:
        own, w = x[:, used], np.zeros(len(used))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            grad = own.T @ (n * (p - y)) + ridge * w
            hess = (own.T * (n * p * (1 - p) + 1e-9)) @ own + ridge * np.eye(len(used))
            step = np.linalg.solve(hess, grad)
            w = w - np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break
        below = [k for k, slope in zip(used[1:], w[1:], strict=True) if slope < 0]
        if not below:
            out = np.zeros(x.shape[1])
            out[used] = w
            return out
        used = [k for k in used if k not in below]


def log_odds(n: Column, m: Column, toxic_rows: int, other_rows: int) -> tuple[Column, Column]:
    """(log-odds of a pattern in n toxic and m other rows, its standard error)."""
    odds = F.log((n + 0.5) / (toxic_rows - n + 0.5)) - F.log((m + 0.5) / (other_rows - m + 0.5))
    return odds, F.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))


def unlikely(n: Column, m: Column, share: float, tests: int) -> Column:
    """Whether n toxic of n + m rows, at ``share`` toxic rows in all, stay unlikely (``ALPHA``) in so many tests.

    The chance of n or more is at most exp(-(n + m) * divergence) by Chernoff's bound.
    """
    q = n / (n + m)
    part = F.when(m > 0, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0)
    return (q > share) & ((n + m) * (q * F.log(q / share) + part) >= math.log(tests / ALPHA))


def by_label(labelled: DataFrame, found_in) -> DataFrame:
    """(pattern, n, m, bits): the toxic and the other rows that hold it, and the bits of the toxic ones."""
    counted = labelled.mapInArrow(_counted(found_in), COUNTS)
    return counted.groupBy("pattern").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("m"),
        F.bit_or("bits").alias("bits"),
    )


def learn(labelled: DataFrame, exceptions: tuple[str, ...] = ()) -> ToxicityModel:
    """Learn from ``labelled(doc_id, text, toxic)``, all of its rows, besides the given ``exceptions``.

    Patterns and exception phrases are counted and judged on Spark; only those
    that tell come to the driver, at most ``MAX_PATTERNS`` of either kind. Where all rows are toxic no pattern
    tells.
    """
    labelled = labelled.select("doc_id", "text", "toxic")
    rows = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic_rows, other_rows = rows.get(1, 0), rows.get(0, 0)
    if not toxic_rows or not other_rows:
        return ToxicityModel({}, exceptions, 0.0, 0.0, 0.0)
    n, m = F.col("n"), F.col("m")
    odds, error = log_odds(n, m, toxic_rows, other_rows)
    telling = (odds - F.least(2 * error, odds) >= MIN_LOG_ODDS) | ((m == 0) & (odds - error >= MIN_LOG_ODDS))
    # the empty pattern is in every row, so its bits are those of all toxic texts
    tested = saved(by_label(labelled, _all_patterns).filter((n + m >= MIN_ROWS) | (F.col("pattern") == "")), "toxicity-patterns")
    texts = F.bit_count("bits")
    all_texts = tested.filter(F.col("pattern") == "").select(texts.alias("k")).first()["k"]
    tested = tested.filter((n + m >= MIN_ROWS) & (F.col("pattern") != ""))
    share = toxic_rows / (toxic_rows + other_rows)
    found = tested.filter((n >= min(MIN_ROWS, toxic_rows)) & (texts >= min(MIN_TEXTS, all_texts)) & telling & unlikely(n, m, share, tested.count()))
    found = found.select("pattern", odds.alias("odds"), error.alias("error")).orderBy(F.desc(F.col("odds") - F.col("error")), "pattern")
    weights = {r["pattern"]: min(MAX_WEIGHT, r["odds"]) for r in found.limit(MAX_PATTERNS).collect()}
    # a longer pattern adds nothing where a stem of it is as telling
    for pattern in sorted(weights, key=len, reverse=True):
        stems = [pattern[: k + 1] for k in STEMS if k + 1 < len(pattern)]
        if any(weights.get(s, -1) >= weights[pattern] - 0.5 for s in stems):
            del weights[pattern]
    hits = ToxicityModel(weights, (), 0.0, 0.0, 0.0)
    harmless = by_label(labelled, lambda: Matcher(hits).hit_pairs).filter((m >= MIN_ROWS) & (odds + error <= 0)).orderBy(odds + error, "pattern")
    exceptions = (*exceptions, *sorted(r["pattern"].strip() for r in harmless.select("pattern").limit(MAX_PATTERNS).collect()))
    model = ToxicityModel(weights, exceptions, 0.0, 0.0, 0.0)
    grid = labelled.mapInArrow(_figures(model), "a int, b int, toxic int, n long").groupBy("a", "b", "toxic").agg(F.sum("n").alias("n")).toPandas()
    x = np.stack([np.ones(len(grid)), grid["a"].to_numpy() / 10, grid["b"].to_numpy() / 10], 1)
    w = _logistic(x, grid["toxic"].to_numpy().astype(float), grid["n"].to_numpy().astype(float))
    return ToxicityModel(weights, exceptions, float(w[0]), float(w[1]), float(w[2]))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, hits and summed weight of every row. The model is bounded by its learning rule."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        matcher = Matcher(model)
        for rows, texts in text_slices(batches):
            hits, scores = [], []
            for text in texts:
                folded = fold(text or "")
                own = matcher.hits(folded)
                hits.append(own)
                scores.append(model.score(*features(own, folded)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array([len(h) for h in hits], pa.int64()),
                    pa.array([float(sum(h)) for h in hits], pa.float64()),
                ],
                names=["doc_id", "score", "predicted", "n_hits", "weight"],
            )

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int, n_hits long, weight double")


def labelled_rows(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, text, toxic) of the labelled documents outside the held-out fold."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(crc_bucket(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    marks = saved(marks, "toxicity-marks")
    # only ids and flags are broadcast, and only below a counted bound
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks
    return texts_of(docs).filter(crc_bucket(F.col("doc_id"), folds) != held_out).join(marks, "doc_id")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold and score every row of ``docs``."""
    model = learn(saved(labelled_rows(docs, labels), "toxicity-labelled"))
    held = F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "n_hits", "weight")
