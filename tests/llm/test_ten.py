"""The ten operators against brute force, exact round trips and held-out rows."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from locusflow.llm import bpe, compression_quality, huffman_ids, language_id, licenses, packing, simhash_bk, spotsigs, suffix_dedup, toxicity  # noqa: E402
from locusflow.llm.components import connected_components  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a", "  a  b c ", " \n a", "don't we'll 123 x<|endoftext|> y", "é à ñ　日本語 ²½Ⅷ", "a\tb  \n\n c\r\n", "\x1c a\x1f b\x85", "the the the " * 400,
    "x" * 3000, "👩‍👩‍👧 ﻿​", "tie breaker text of some words here", "tie breaker text of some words here",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, score string"


def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with names the operators use."""
    rows = [(i, t, None if i % 4 == 0 else "en", "s", None, "w", "x") for i, t in enumerate(ODD)]
    rows += [rows[-1], (None, "no id here at all, is there", "de", None, 1, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts(spark):
    return {r.doc_id: r.text for r in documents(spark).select("doc_id", "text").collect()}


# ---- 1


def test_language_on_held_out_rows(spark):
    got = {r.doc_id: r for r in language_id.language_id(documents(spark)).collect()}
    truth = {r.doc_id: r.lang for r in documents(spark).select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == len(truth) and all(got[i].held_out == (i in set(held)) for i in truth)
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_mixture_finds_proportions():
    rng = np.random.default_rng(1)
    p = np.full((2, 400), 1e-4)
    p[0, :300] = 1
    p[1, 300:] = 1
    share, _ = language_id.mixture(p.astype(np.float32), np.array([400]), np.array([[0.5, 0.5]]))
    assert share[0, 0] == pytest.approx(0.75, abs=0.01)
    # three documents at once, against expectation-maximisation word by word
    p, words = rng.random((3, 90)).astype(np.float32), np.array([20, 50, 20])
    share, fit = language_id.mixture(p, words, np.full((3, 3), 1 / 3), tolerance=1e-7, rounds=3000)
    for d, (a, n) in enumerate(zip(np.cumsum(words) - words, words, strict=True)):
        own, s = p[:, a : a + n].T.tolist(), [1 / 3] * 3
        for _ in range(3000):
            new = [0.0] * 3
            for w in own:
                total = sum(x * y for x, y in zip(w, s, strict=True))
                new = [z + x * y / total / n for z, x, y in zip(new, w, s, strict=True)]
            s = new
        assert share[d] == pytest.approx(s, abs=2e-3)
        assert fit[d] == pytest.approx(sum(np.log(sum(x * y for x, y in zip(w, s, strict=True))) for w in own), abs=1e-2)


def test_letterless_texts_have_no_language(spark):
    rows = [(k, t) for k, t in enumerate(["½", "² ³", "Ⅷ ⅷ", "12 34", "٣٤", "①②", "!? ...", "日", "a", "½ é"])] + [(k, "the river runs" if k % 2 else "der Fluss") for k in range(20, 60)]
    docs = spark.createDataFrame([(i, t, ("en" if i % 2 else "de") if i >= 20 else None) for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.language_id(docs).collect()}
    assert all(got[k] == ("und", 0.0) for k in range(7)) and all(got[k][0] in ("de", "en") for k in (7, 8, 9, 20, 21))


def test_language_odd_rows(spark):
    got = {r.doc_id: r for r in language_id.language_id(odd_docs(spark)).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und" and got[0].score == 0
    assert language_id.language_id(empty_docs(spark)).count() == 0
    assert language_id.keep_identified(odd_docs(spark)).columns == odd_docs(spark).columns


# ---- 2


def test_huffman_code_is_optimal_and_limited():
    rng = np.random.default_rng(0)
    ids = np.minimum((rng.pareto(0.7, 60_000) * 2).astype(np.int64), 5000)
    counts = np.bincount(ids)
    lengths = huffman_ids.code_lengths(counts)
    assert lengths.max() <= huffman_ids.MAX_BITS and (2.0 ** -lengths[lengths > 0]).sum() == pytest.approx(1)
    shares = counts[counts > 0] / counts.sum()
    assert (lengths * counts).sum() / counts.sum() < -(shares * np.log2(shares)).sum() + 0.1
    codes, table = huffman_ids.canonical_codes(lengths), huffman_ids.decoding_table(lengths)
    blocks = [ids[:1], ids[1:257], ids[257:20_000], ids[20_000:]]
    packed = [huffman_ids.pack(b, codes, lengths) for b in blocks]
    out = huffman_ids.unpack([p for p, _ in packed], [m for _, m in packed], [len(b) for b in blocks], table)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, out, strict=True))
    assert huffman_ids.code_lengths(2 ** np.arange(25), 8).max() == 8
    many = huffman_ids.code_lengths(np.ones((1 << 18) + 5, np.int64))
    assert many.max() == 19 and (2.0 ** -many).sum() == pytest.approx(1)
    ids = np.random.default_rng(1).integers(0, len(many), 700)
    payload, marks = huffman_ids.pack(ids, huffman_ids.canonical_codes(many), many)
    assert np.array_equal(huffman_ids.unpack([payload], [marks], [700], huffman_ids.decoding_table(many))[0], ids)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="no plain byte-level"):
        bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))


def test_huffman_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in enumerate(ODD)] + sorted((i + 1000, t) for i, t in texts(spark).items())
    docs = spark.createDataFrame([(i, t, "x") for i, t in random.Random(1).sample(rows, len(rows))], "doc_id long, text string, ids string")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in huffman_ids.round_trip(docs, PATH).collect()}
    start = 0
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_huffman_odd_rows(spark):
    assert huffman_ids.round_trip(odd_docs(spark), PATH).count() == len(ODD) + 3
    assert huffman_ids.round_trip(empty_docs(spark), PATH).count() == 0


# ---- 3


def test_packing_is_whole_and_cheap(spark):
    costs = packing.Costs()
    rows = packing.pack(documents(spark), costs).collect()
    words = {i: len(t.encode().split()) + 1 for i, t in texts(spark).items()}
    total = Counter()
    bins = {}
    for r in rows:
        total[r.doc_id] += r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert dict(total) == words
    spent = 0.0
    for own in bins.values():
        own.sort(key=lambda r: r.position)
        assert [r.position for r in own] == list(np.cumsum([0] + [r.n_tokens for r in own[:-1]]))
        used = sum(r.n_tokens for r in own)
        assert all(r.used == used and r.capacity == costs.fitting(used) for r in own)
        spent += costs.of(own[0].capacity)
    sizes = sorted((r.n_tokens for r in rows), reverse=True)
    single = min(packing.pack_sizes(sizes, packing.Costs((c,)), c)[2] for c in costs.capacities if c >= sizes[0])
    assert spent <= single + 1e-6


def test_best_fit_takes_the_tightest_bin():
    costs = packing.Costs((10,), attention=1e9, overhead=0)
    bins, used, _ = packing.pack_sizes([7, 6, 4, 3, 1], costs, 10)
    assert bins == [0, 1, 1, 0, 2] and used == [10, 10, 1]
    assert packing.best_packing([3], packing.Costs((4, 8)))[2] == packing.Costs((4, 8)).of(4)


def cheapest(sizes, costs):
    """The least cost of any partition into bins, by trying all."""
    best = float("inf")

    def place(k, loads):
        nonlocal best
        spent = sum(costs.of(costs.fitting(u)) for u in loads)
        if spent >= best:
            return
        if k == len(sizes):
            best = spent
            return
        for b in range(len(loads)):
            if loads[b] + sizes[k] <= max(costs.capacities):
                place(k + 1, [*loads[:b], loads[b] + sizes[k], *loads[b + 1 :]])
        place(k + 1, [*loads, sizes[k]])

    place(0, [])
    return best


def test_packing_is_near_the_optimum():
    rng = random.Random(6)
    costs, ratios = packing.Costs((16, 32, 64), attention=400, overhead=3), []
    for _ in range(60):
        sizes = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 8))), reverse=True)
        bins, used, spent = packing.best_packing(sizes, costs)
        assert [sum(n for n, b in zip(sizes, bins, strict=True) if b == k) for k in range(len(used))] == used and max(used) <= 64
        ratios.append(spent / cheapest(sizes, costs))
    assert min(ratios) >= 1 - 1e-9 and max(ratios) < 1.25 and np.mean(ratios) < 1.03


def test_packing_odd_rows(spark):
    rows = packing.pack(odd_docs(spark)).collect()
    assert len({(r.doc_id, r.doc_tokens, r.row) for r in rows}) == len(ODD) + 3
    assert packing.pack(empty_docs(spark)).count() == 0


# ---- 4


def spots(text):
    anchors = {w for own in spotsigs.ANCHORS.values() for w in own.split()}
    words = re.findall(r"[^\W_]+", text.lower())
    out = set()
    for i, w in enumerate(words):
        if w not in anchors and any(x in anchors for x in words[max(0, i - 3) : i]):
            continue
        first = i + 1 if w in anchors else i
        follow = [x for x in words[first : first + 12] if x not in anchors][:3]
        h = 42
        for x in [w if w in anchors else "", *follow]:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return out


def test_spotsigs_report_equals_brute_force(spark):
    rows = sorted(texts(spark).items(), reverse=True)
    got = {r.doc_id: r for r in spotsigs.edit_report(documents(spark)).collect()}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = spots(t), spots(edited), spots(following)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{x % (1 << 64):016x}" for x in sorted(a)) and r.edited_fingerprint == "".join(f"{x % (1 << 64):016x}" for x in sorted(b))
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))


def test_spotsigs_ranges_meet(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(None, "n")], "doc_id long, text string")
    got = {r.doc_id: r.next_doc_id for r in spotsigs.with_next(rows, bucket_rows=7).collect()}
    assert got == {**{i: i - 1 for i in range(1, 50)}, 0: None, None: 49}


def test_spotsigs_pairs_equal_brute_force(spark):
    membership, pairs = spotsigs.similar_pairs(documents(spark), 0.5)
    by_class = {}
    for r in membership.collect():
        by_class.setdefault(r.class_id, []).append(r.doc_id)
    sets = {i: spots(t) for i, t in texts(spark).items()}
    for own in by_class.values():
        assert len({frozenset(sets[i]) for i in own}) == 1
    reps = sorted(c for c in by_class if sets[c])
    want = {(a, b) for a in reps for b in reps if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5}
    assert {(r.a, r.b) for r in pairs.collect()} == want


def test_spotsigs_links_of_every_document(spark):
    membership, pairs = spotsigs.similar_pairs(documents(spark), 0.5)
    links = Counter(x for r in pairs.collect() for x in (r.a, r.b))
    want = sorted((r.doc_id, r.class_id, links[r.class_id]) for r in membership.collect())
    assert sorted(tuple(r) for r in spotsigs.similar_documents(documents(spark), 0.5).collect()) == want


def test_spotsigs_cover_texts_without_anchors(spark):
    words = [f"zq{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:20] + [f"yy{i}" for i in range(20)])), (3, "the " * 30), (4, None), (5, "...")]
    got = {r.doc_id: r.signs for r in spotsigs.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got[1]) == 40 and 10 < len(set(got[1]) & set(got[2])) < 21 and len(got[3]) == 1 and got[4] == got[5] == []


def test_spotsigs_odd_rows(spark):
    assert spotsigs.edit_report(odd_docs(spark)).count() == len(ODD) + 3
    assert spotsigs.edit_report(empty_docs(spark)).count() == 0


# ---- 5


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(inside), failed


def test_quality_base_equals_brute_force(spark):
    docs = documents(spark).select("doc_id", "text").unionByName(odd_docs(spark).filter("doc_id is not null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    truth = {r.doc_id: r.text for r in docs.collect()}
    for r in compression_quality.compression_bands(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(truth[r.doc_id])
        assert not (r.kept and r.base_failed)


def band_verdict(data):
    """(ratio, chunks, chunks out of band, verdict) by the stated rules, one step at a time."""
    import zstandard

    ratio = lambda x: len(zstandard.ZstdCompressor(level=3).compress(x)) / len(x)
    band = lambda n: [b[1:] for b in compression_quality.WHOLE_BANDS if n >= b[0]][-1]
    if not data:
        return 0.0, 0, 0, False
    low, high = band(len(data))
    whole = low <= ratio(data) <= high
    if len(data) <= 2048:
        return ratio(data), 1, int(not whole), whole
    parts = []
    while 2048 * (len(parts) + 1) < len(data):
        parts.append(data[2048 * len(parts) : 2048 * (len(parts) + 1)])
    parts.append(data[-2048:])
    assert set(b"".join(parts)) == set(data)
    low, high = band(2048)
    bad = sum(not low - 0.02 <= ratio(x) <= high + 0.02 for x in parts)
    return ratio(data), len(parts), bad, whole and bad <= len(parts) / 4


def test_band_verdicts_equal_brute_force(spark):
    rng = random.Random(8)
    prose = list(texts(spark).values())
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(60):
        t = " ".join(rng.sample(prose, 3))[: rng.choice([1, 199, 200, 2047, 2048, 2049, 4096, 5000, 9999, 30_000])]
        tail = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rng.choice([0, 0, 300, 3000])))
        rows.append((100 + i, t + tail))
    got = {r.doc_id: r for r in compression_quality.compression_bands(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = set()
    for i, t in rows:
        ratio, n, bad, passed = band_verdict((t or "").encode())
        r = got[i]
        assert (r.n_chunks, r.n_bad_chunks, r.kept) == (n, bad, passed and not r.base_failed) and r.ratio == pytest.approx(ratio)
        seen.add((passed, r.kept))
    assert len(seen) == 3


def test_bands_reject_noise_and_repetition(spark):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(70)) for _ in range(60))
    prose = " ".join(rng.choice("the a of to and cat dog house tree river runs sleeps green old quick very small large under over".split()) + str(rng.choice(["", "s", "ed"])) for _ in range(400))
    docs = spark.createDataFrame([(1, noise), (2, prose)], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in compression_quality.compression_bands(docs).collect()}
    assert got[1] == (False, False) and got[2] == (False, True)
    assert [r.doc_id for r in compression_quality.keep_good(docs).collect()] == [2]
    assert compression_quality.keep_good(empty_docs(spark)).count() == 0


def test_short_texts_have_bands(spark):
    rng = random.Random(5)
    words = "the river runs past an old stone house where quiet people walk their dogs every morning before work and talk about weather".split()
    rows = []
    for k, size in enumerate((50, 90, 130, 170, 199)):
        prose = " ".join(words)[:size] if size < 122 else (" ".join(words) + " while children play under tall green trees beside that bridge near our market square")[:size]
        noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(size))
        rows += [(10 * k, prose), (10 * k + 1, "a" * size), (10 * k + 2, "ab " * (size // 3)), (10 * k + 3, noise)]
    got = {r.doc_id: r for r in compression_quality.compression_bands(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, size in enumerate((50, 90, 130, 170, 199)):
        assert got[10 * k].n_bad_chunks == 0 and got[10 * k + 1].n_bad_chunks == got[10 * k + 2].n_bad_chunks == 1
        # noise is stored as it is, and so is prose below 120 bytes
        assert got[10 * k + 3].n_bad_chunks == int(size >= 120)


# ---- 6


def test_folding_sees_through_disguise():
    fold = toxicity.fold
    bold = "".join(chr(0x1D400 + ord(c) - 65) for c in "BADWORD")
    struck = "".join(c + "\u0336" for c in "badword")
    hidden = "\u200b".join("badword")
    for text in (bold, bold.lower(), struck, hidden, "ＢＡＤＷＯＲＤ", "ВАDWОRD", "b\u00aday".replace("y", "dword"), "B4DW0RD", "Ⓑⓐⓓⓦⓞⓡⓓ"):
        assert fold(f"a {text} b") == " a badword b "
    assert fold("É e\u0301 ß 한국") == " é é ss 한국 " and fold("") == "  "


def plain_lexicon(rows):
    """pattern: weight by the stated rules, one step at a time."""
    import math

    bits = Counter()
    for t, y in rows:
        for p in {p for w in toxicity.fold(t).split() for p in toxicity.patterns_of(w)} if y else ():
            bits[p] |= toxicity.text_bit(toxicity.fold(t))
    held = [({p for w in toxicity.fold(t or "").split() for p in toxicity.patterns_of(w)}, y) for t, y in rows]
    toxic_rows, other_rows = sum(y for _, y in held), sum(1 - y for _, y in held)
    n, m = Counter(), Counter()
    for found, y in held:
        (n if y else m).update(found)
    tested = [p for p in {*n, *m} if n[p] + m[p] >= 4]
    share, weights = toxic_rows / len(rows), {}
    for p in tested:
        a, b = n[p], m[p]
        odds = math.log((a + 0.5) / (toxic_rows - a + 0.5)) - math.log((b + 0.5) / (other_rows - b + 0.5))
        error = math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        q = a / (a + b)
        spread = sum(x * math.log(x / y) for x, y in ((q, share), (1 - q, 1 - share)) if x)
        bound = odds - 2 * error >= 1.5 or (b == 0 and odds - error >= 1.5)
        if a >= 4 and bin(bits[p]).count("1") >= 4 and bound and q > share and (a + b) * spread >= math.log(len(tested) / 0.05):
            weights[p] = min(6.0, odds)
    for p in sorted(weights, key=len, reverse=True):
        if any(weights.get(p[: k + 1], -1) >= weights[p] - 0.5 for k in (4, 5, 6, 7) if k + 1 < len(p)):
            del weights[p]
    return weights


def test_lexicon_equals_plain_learner(spark):
    """Words planted in toxic rows are learned; strings that near copies share are not, however many rows or groups they are."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(9))
    common = [word() for _ in range(60)]
    rows = []
    for _ in range(400):
        shared = " ".join([*rng.sample(common, 8), word(), word(), "badword" if rng.random() < 0.5 else "nastyish"])
        rows += [(f"{shared} {rng.choice(common)}", 1) for _ in range(4)]
    for _ in range(5):
        shared = " ".join([*rng.sample(common, 8), *(word() for _ in range(150))])
        rows += [(f"{shared} {rng.choice(common)}", 1) for _ in range(40)]
    rows += [(" ".join(rng.sample(common, 12)), 0) for _ in range(1600)]
    data = [(i, t, y) for i, (t, y) in enumerate(rows)]
    model = toxicity.learn(spark.createDataFrame(data, "doc_id long, text string, toxic int"))
    assert model.weights == pytest.approx(plain_lexicon(rows))
    assert {p.strip()[:4] for p in model.weights} == {"badw", "nast"}


def test_toxicity_learns_stems_and_folds(spark):
    rng = random.Random(2)
    clean = ["house", "river", "green", "walk", "table", "paper", "stone"]
    rows, labels = [], []
    for i in range(300):
        words = [rng.choice(clean) for _ in range(30)]
        if i % 3 == 0:
            words[rng.randrange(30)] = rng.choice(["badword", "badwords", "nastier"])
            words[rng.randrange(30)] = rng.choice(["badword", "nastily"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 1, int(i % 3 == 0)))
    rows += [(1000, "river b4dw0rd green NАSTIER", "x"), (1001, None, "x"), (1002, "", "x"), (None, "river", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels + [(5, None, None)], "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 304
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].predicted == int(i % 3 == 0) and got[i].held_out for i in held)
    assert got[1000].predicted == 1 and got[1001].predicted == got[1002].predicted == 0


def test_exception_phrases():
    model = toxicity.ToxicityModel({" tras": 3.0}, ("trash can",), -1, 1, 1)
    matcher = toxicity.Matcher(model)
    assert matcher.hits(toxicity.fold("the trash can")) == [] and matcher.hits(toxicity.fold("you TR4SH")) == [3.0]


def test_hits_equal_brute_force():
    rng = random.Random(9)
    words = ["ab", "abc", "abd", "xy", "xyz", "q", "abab"]
    for _ in range(300):
        weights = {(f" {w} " if rng.random() < 0.5 else f" {w}"): rng.randint(1, 9) / 2 for w in rng.sample(words, 3)}
        phrases = tuple(" ".join(rng.choice(words) for _ in range(2)) for _ in range(rng.randint(0, 2)))
        folded = toxicity.fold(" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))))
        spared = {k for p in phrases for a in range(len(folded)) if folded.startswith(f" {p} ", a) for k in range(a, a + len(p) + 1)}
        want = []
        for at in range(len(folded)):
            own = [w for pattern, w in weights.items() if folded.startswith(pattern, at)]
            if own and at not in spared:
                want.append(max(own))
        got = toxicity.Matcher(toxicity.ToxicityModel(weights, phrases, 0, 1, 1)).hits(folded)
        assert sorted(got) == sorted(want)


def test_harmless_pairs_are_learned(spark):
    rows = [(i, "river badword green" if i % 2 else "lake badword club stone") for i in range(80)] + [(i, "green stone house") for i in range(80, 200)]
    toxic = [(i, t, int(i < 80 and i % 2)) for i, t in rows] + [(200 + i, "badword again and badword so", 1) for i in range(60)]
    model = toxicity.learn(spark.createDataFrame(toxic, "doc_id long, text string, toxic int"))
    assert any("club" in x for x in model.exceptions) and not any("again" in x for x in model.exceptions)
    matcher = toxicity.Matcher(model)
    assert not matcher.hits(toxicity.fold("a badword club")) and matcher.hits(toxicity.fold("the badword again"))
    assert model.by_weight >= 0 and model.by_density >= 0


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(odd_docs(spark), labels).collect()} == {0.0}
    assert toxicity.toxicity(empty_docs(spark), labels).count() == 0


# ---- 7


def brute_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, radius):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_components_equal_brute_force(spark):
    rows = texts(spark) | {i + 10_000: t for i, t in enumerate(ODD)}
    base = rows[max(texts(spark), key=lambda i: len(rows[i]))].split(" ")
    rng = random.Random(4)
    for k in range(40):
        own = list(base)
        for _ in range(k % 6):
            own[rng.randrange(len(own))] = f"changed{k}"
        rows[20_000 + k] = " ".join(own)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows.items()], "doc_id long, text string, fp string")
    got = {r.doc_id: r for r in simhash_bk.near_duplicates(docs).collect()}
    prints = {i: brute_fingerprint(t) for i, t in rows.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == components_of(prints, 4)


@pytest.mark.parametrize("shards", [False, True])
def test_links_of_dense_groups(spark, monkeypatch, shards):
    if shards:
        monkeypatch.setattr(simhash_bk, "SHARD", 16)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**62))
    values = sorted({centre ^ sum(1 << int(b) for b in set(rng.integers(0, 64, n % 9))) for n in range(300)})
    prints = {i: v for i, v in enumerate(values)}
    rows = [(i, int(np.uint64(v).astype(np.int64))) for i, v in prints.items()]
    got = simhash_bk.components(spark.createDataFrame(rows, "doc_id long, fp long"), 4)
    assert {r.doc_id: r.component_id for r in got.collect()} == components_of(prints, 4)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 2)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_odd_rows(spark):
    assert simhash_bk.near_duplicates(odd_docs(spark)).count() == len(ODD) + 3
    assert simhash_bk.near_duplicates(empty_docs(spark)).count() == 0
    kept = simhash_bk.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sum((r.text or "").startswith("tie breaker") for r in kept.collect()) == 1


# ---- 8


def test_license_scan(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    rows = [(1, "some prose here\nReleased under the MIT License.\nmore prose"), (2, mit.replace("Software", "Library", 1)), (3, "nothing of the kind"), (4, None), (5, "a\n\n" + mit + "\n\nb"), (5, "a\n\n" + mit + "\n\nb")]
    got = [(r.doc_id, r.license, round(r.dice or 0, 2)) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [g[:2] for g in got] == [(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, "MIT"), (5, "MIT")]
    assert got[0][2] == 1 and 0.9 < got[1][2] < 1
    assert licenses.scan(odd_docs(spark)).count() == len(ODD) + 3
    assert licenses.scan(empty_docs(spark)).count() == 0


def laid_out(text, width):
    """A licence in paragraphs and short lines, inside a longer text."""
    words, lines = text.split(), []
    for i in range(0, len(words), width):
        lines.append(" * " + " ".join(words[i : i + width]))
        if i // width % 5 == 4:
            lines.append("")
    return "int main of a file with words before it\n" + "\n".join(lines) + "\nimport os and words after it that are long enough to matter " * 9


@pytest.mark.parametrize("width", [4, 11, 1000])
def test_every_license_is_found_in_any_layout(spark, width):
    rows = [(k, name, laid_out(text, width)) for k, (name, text) in enumerate((name, t) for name, own in licenses.TEMPLATES.items() for t in own)]
    got = {r.doc_id: (r.license, r.dice) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, license string, text string")).collect()}
    assert {i: got[i][0] for i, _, _ in rows} == {i: name for i, name, _ in rows}
    assert all(dice > 0.95 for _, dice in got.values())


def dice_by_hand(text):
    """{template: best Dice} of all windows that begin and end with a bigram of the template."""
    words = licenses.words_in(text or "")
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    out = {}
    for number, (_, t) in enumerate((n, t) for n, own in sorted(licenses.TEMPLATES.items()) for t in own):
        known, length = set(licenses.bigrams(t)), len(licenses.words_in(t)) - 1
        for i in (i for i, b in enumerate(pairs) if b in known):
            own = [(j, pairs[j]) for j in range(i, min(len(pairs), i + length)) if pairs[j] in known]
            common = len({b for _, b in own})
            out[number] = max(out.get(number, 0), 2 * common / (own[-1][0] - i + 1 - (len(own) - common) + len(known)))
    return {k: v for k, v in out.items() if v >= 0.75}


def test_license_windows_equal_brute_force(spark):
    rng = random.Random(5)
    all_texts = [t for own in licenses.TEMPLATES.values() for t in own]
    rows = []
    for i in range(60):
        words = " ".join(rng.choice([*all_texts, "of the in to a the license and of this software"]) for _ in range(rng.randint(1, 3))).split()
        rows.append((i, " ".join(w for w in words if rng.random() > 0.04 * (i % 6))))
    got = {}
    for r in licenses.best_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, {})[r.template] = pytest.approx(r.dice)
    assert got == {i: d for i, t in rows if (d := dice_by_hand(t))}


# ---- 9


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
    rng = random.Random(1)
    letters = [" ", "  ", "\n", "a", "b", "'s", "1", "é", " ", "<|endoftext|>", "!", "\t", "日", "\x1d", "﻿", "́", "'ll", "the"]
    cases = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(1500)] + list(texts(spark).values())
    for t in cases:
        ids = library.encode(t, add_special_tokens=False).ids
        packed = own.packed(t)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces_equal_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
    rng = random.Random(4)
    for letters, n in (("ab", 3000), ("acgt", 5000), ("abcdefghijklmnopqrstuvwxyz", 9000), ("é日aZ", 2000), ("=", 700), ("theing", 257)):
        text = "".join(rng.choice(letters) for _ in range(n))
        ids = np.frombuffer(own.packed(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        piece = text[:300].encode()
        assert own.encode_long_piece(piece) == own.encode_piece(piece)
    start = time.perf_counter()
    text = "".join(rng.choice("acgt") for _ in range(400_000))
    assert own.decode(own.packed(text)) == text and time.perf_counter() - start < 60


def test_bpe_jobs(spark):
    docs = odd_docs(spark)
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).filter("doc_id is not null").collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe.round_trip(docs, PATH).count() == len(ODD) + 3 and bpe.round_trip(empty_docs(spark), PATH).count() == 0
    assert json.dumps(sorted(bpe.byte_letters().values())) == json.dumps(list(range(256)))


# ---- 10


def brute_removed(rows, length):
    data = [(t or "").encode() for t in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, mask, strict=True) if not m)
        out.append((len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(n)) for n in (30, 45, 60, 90)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(shared) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(3, 80)))
            if rng.random() < 0.3:
                at = rng.randrange(len(part))
                part = part[:at] + "X" + part[at + 1 :]
            parts.append(part[rng.randint(0, 20) :])
        rows.append(" ".join(parts))
    return [*rows, rows[3], None, "", "ab" * 300, "aaaa" * 120]


@pytest.mark.parametrize(("shard_segments", "broadcast", "piece"), [(256, 1_000_000, 1 << 18), (2, 0, 500), (8, 0, 1 << 18)])
def test_repeats_equal_brute_force(spark, monkeypatch, shard_segments, broadcast, piece):
    """Shards alone; refined anchors, shuffled texts and long texts in pieces."""
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", shard_segments)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rows = passages(shard_segments)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, tk string")
    got = {r.doc_id: tuple(r[1:]) for r in suffix_dedup.removal_digests(docs).collect()}
    assert got == dict(enumerate(brute_removed(rows, 200)))


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(30):
        x = bytes(rng.choice(b"ab" if rng.random() < 0.5 else b"abcd") for _ in range(rng.randint(0, 200)))
        x += x[3:40] + x[3:40]
        order, rank = suffix_dedup.suffix_array(np.frombuffer(x, np.uint8))
        want = sorted(range(len(x)), key=lambda i: x[i:])
        assert order.tolist() == want and all(rank[i] == k for k, i in enumerate(want))
        shared = suffix_dedup.common_prefixes(np.frombuffer(x, np.uint8), order, rank)
        for k in range(1, len(x)):
            a, b = x[want[k - 1] :], x[want[k] :]
            assert shared[k] == next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))


def edge_rows(seed, common, kinds):
    """Texts around one passage that all share, with few or many different surroundings."""
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, sides = letters(common), [letters(260) for _ in range(kinds)]
    rows = []
    for _ in range(120):
        left = rng.choice(sides)[rng.randint(0, 200) :] if rng.random() < 0.6 else letters(rng.randint(0, 260))
        right = rng.choice(sides)[: rng.randint(0, 250)] if rng.random() < 0.6 else letters(rng.randint(0, 260))
        rows.append(left + passage[rng.choice([0, 0, 3, 40]) :] + right)
    return rows


@pytest.mark.parametrize(("common", "kinds"), [(60, 4), (120, 2), (190, 3), (260, 9)])
def test_large_anchors_equal_brute_force(spark, monkeypatch, common, kinds):
    """Anchors with far more segments than a shard takes, so that all rounds of refinement and the merge are met."""
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", 3)
    rows = edge_rows(common, common, kinds)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[1:]) for r in suffix_dedup.removal_digests(docs).collect()}
    assert got == dict(enumerate(brute_removed(rows, 200)))


def test_ranges_cover_all_windows():
    rng = random.Random(2)
    for _ in range(200):
        at, right = rng.randint(0, 152), rng.randint(0, 152)
        if at + right < 152:
            continue
        data = bytes(rng.randrange(256) for _ in range(at + 48 + right))
        seen = []
        for width in (20, 4):
            own = list(suffix_dedup.ranges_of(data, at, 0, 152, width))
            for first, last, core, whole, place in own:
                assert last - first < width and core in whole and whole[place : place + 48] == data[at : at + 48]
                seen += [data[k : k + 200] == whole[j : j + 200] for j in range(len(whole) - 199) for k in [at - place + j]]
            assert sum(len(w) - 199 for _, _, _, w, _ in own) == len(data) - 199
        assert all(seen)


def test_merge_finds_windows_across_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "MERGE_ROWS", 4)
    rng = random.Random(1)
    values = sorted(rng.randint(0, 9) for _ in range(40)) + [99] * 11 + [100, 101, 101]
    rows = [(i, 7, i if i % 5 else None, v) for i, v in enumerate(values)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[a : a + 3]], pa.int64()) for k in range(4)], names=list("abcd")) for a in range(0, len(rows), 3)]
    got = sorted(x for b in suffix_dedup._merge(200)(iter(batches)) for x in b.column(2).to_pylist())
    assert got == [i for i, v in enumerate(values) if i % 5 and values.count(v) > 1]


def test_remove_repeats_keeps_whole_characters(spark):
    shared = "né à la ç " * 30
    rows = [(1, "einé" + shared + "zé", "x"), (2, "andere" + shared, "x"), (3, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, starts string")
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == 3
    assert all(r.text is None or len(r.text) < 20 for r in out.collect())
    assert suffix_dedup.removal_digests(odd_docs(spark)).count() == len(ODD) + 3
    assert suffix_dedup.removal_digests(empty_docs(spark)).count() == 0
