"""Operators 11 to 13 against plain Python."""

import hashlib
import math
import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusflow.llm import chat_prefixes, filter_audit, hard_negatives

# ---- 11

CHATS = "conv_id long, turn long, role string, text string, start long, chars string"
TEXTS = [None, "", "#", "##", "###", "#### assistant: x", "</turn>", "<</turn>>", "\\", "\\b", "\\\\h##", "a: b\\c", "</", "é\U0001f600 ## \\s", "x" * 3000, "\n\n", "### assistant: </turn>\n### user: "]


def chats():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", None, "a:b\\c##", ""]), rng.choice(TEXTS), 1, "x") for c in range(12) for t in range(rng.randint(1, 9))]
    rows += [(50, 0, "user", "only asks", None, None), (51, 0, "assistant", "only says", None, None), (None, 1, "user", "u", None, None), (None, 2, "assistant", "s", None, None)]
    rows += [(52, None, "user", "no turn", None, None), (52, 1, "assistant", "twice", None, None), (52, 1, "assistant", "twice", None, None), (52, 1, "user", "tie", None, None)]
    return rows + [(53, t, "assistant" if t % 2 else "user", f"turn {t}" * (t % 5), None, None) for t in range(400)]


def in_order(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        found.setdefault(conv, []).append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    return {conv: [(role, text) for _, role, _, text in sorted(turns)] for conv, turns in found.items()}


def test_chat_round_trip(spark):
    rows = chats()
    got = {r.conv_id: r for r in chat_prefixes.round_trip(spark.createDataFrame(rows, CHATS).repartition(7)).collect()}
    want = in_order(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        replies = [text for role, text in turns if role == "assistant"]
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), sum(map(len, replies)))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256("".join(replies).encode()).hexdigest()
        assert r.n_examples == len(replies) + (turns[-1][0] != "assistant")


def test_chat_examples_are_prefixes(spark, tmp_path):
    rows = chats()
    chat_prefixes.write(spark.createDataFrame(rows, CHATS), str(tmp_path / "chat"))
    turns, examples = chat_prefixes.read(spark, str(tmp_path / "chat"))
    texts = {(r.conv_id, r.example): r for r in chat_prefixes.example_texts(turns, examples).collect()}
    code = lambda s: s.replace("\\", "\\b").replace("##", "#\\h").replace("</", "<\\s")
    n = 0
    for conv, own in in_order(rows).items():
        said, example = "", 0
        for i, (role, text) in enumerate(own):
            said += f"### {code(role).replace(':', chr(92) + 'c')}: {code(text)}</turn>\n"
            if role == "assistant" or i == len(own) - 1:
                example, n = example + 1, n + 1
                r = texts[conv, example]
                assert r.text == said
                assert r.text[r.loss_start : r.loss_end] == (code(text) if role == "assistant" else "")
        assert said.count("</turn>") == said.count("### ") == len(own)
    assert len(texts) == n


def test_chat_of_no_rows(spark):
    assert chat_prefixes.round_trip(spark.createDataFrame([], CHATS)).count() == 0


def test_chat_of_long_texts(spark):
    text = "## </turn> \\ é" * 200_000
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", "end")]
    r = chat_prefixes.round_trip(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert r.loss_sha256 == hashlib.sha256((text + "end").encode()).hexdigest() and r.loss_chars == len(text) + 3


# ---- 12


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6])
def test_lattice_counts_orders(k):
    edges = filter_audit.lattice(k)
    assert len(edges) == k * 2 ** (k - 1) == len({(s, f) for s, f, _ in edges})
    taken = {}
    for order in permutations(range(k)):
        state = 0
        for f in order:
            taken[state, f] = taken.get((state, f), 0) + 1
            state |= 1 << f
    assert {(s, f): n for s, f, n in edges} == taken


def test_text_mask_of_short_and_long_texts(monkeypatch):
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", " ", "\n", "#", " é", "\x1c", "\x0b", "word ", "other "]) for _ in range(rng.choice([0, 5, 40, 900])))
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        want = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text)]
        for most in (1 << 20, 3):
            monkeypatch.setattr(filter_audit, "LONG_BYTES", most)
            assert filter_audit.text_mask(text.encode(), len(text)) == sum(f << i for i, f in enumerate(want))


def plain_audit(docs, labels):
    good, toxic = ({d for d, *v in labels if v[i] == 1 and d is not None} for i in (0, 1))
    rows = []
    for doc, lang, text in docs:
        text = text or ""
        words = text.split()
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and any(d is not None and d < doc and (t or "") == text for d, _, t in docs),
        }
        rows.append((lang or "", {x for x in fails if fails[x]}, doc in good, doc in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                gone = [r for r in own if f in r[1] and not r[1] & before]
                kept = sum(not r[1] & (before | {f}) for r in own)
                out[part, "".join(order), step + 1] = (kept, len(gone), sum(f in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: v + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def test_audit_equals_following_every_order(spark):
    rng = random.Random(8)
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", " ", "AB c", "a b # c", long, long + " #", long.upper(), "x y " * 150, "x y " * 150 + "| A" * 9, "é " * 300]
    docs = [(i, rng.choice(["en", "de", None, ""]), rng.choice(texts)) for i in range(60)] + [(None, "en", long), (None, "fr", long), (7, "en", long), (7, "en", long)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 80, 2)] + [(4, 1, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, lang string, text string, mask string, same long")
    got = filter_audit.interactions(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in got} == plain_audit(docs, labels)
    assert all(r.filter == r.filter_order[r.step - 1] for r in got)
    assert filter_audit.interactions(frame.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# ---- 13


def plain_negatives(rows, every=50):
    once = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * x) for x in vector]
        once[i] = min(once.get(i, (label, v)), (label, v))
    once = {i: ((label + 1) % 10 if i % 7 == 0 else label, v) for i, (label, v) in once.items()}
    out = set()
    for a, (label, v) in once.items():
        if a % every:
            continue
        others = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, (other, w) in once.items() if i != a)
        for p, i, _ in [o for o in others if o[2] == label][:5]:
            found = [(n, -s) for s, n, other in others if other != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out |= {(a, i, r, n, -p, s) for r, (n, s) in enumerate(found, 1)}
    return out


VECTORS = "vec_id long, embedding array<float>, label int, v string, cell int"


def vectors(n, dim=6, seed=0, copies=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    common = np.round(rng.normal(size=dim) / 4, 2)
    rows = []
    for i in range(n):
        x = common if rng.random() < copies else np.round((centres[rng.integers(5)] + rng.normal(size=dim) / 3) / 3, 2)
        rows.append((i, [float(np.float32(y)) for y in x], int(rng.integers(10)), "x", 1))
    return rows


def same(spark, rows):
    got = [tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS)).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_negatives([r[:3] for r in rows])
    return got


def test_negatives_equal_all_rows(spark, monkeypatch):
    assert same(spark, vectors(900))
    # deep trees, many shards and blocks
    for name, value in (("LEAF_ROWS", 8), ("NODE_SPLITS", 3), ("ROOT_SPLITS", 5), ("SHARD_VALUES", 60), ("BLOCK_ROWS", 4), ("MATRIX_CELLS", 40)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert same(spark, vectors(1200, seed=1))


def test_negatives_of_odd_rows(spark):
    rows = vectors(300, seed=2)
    rows += [(300, None, 1, None, None), (301, [float("nan")] * 6, 1, None, None), (302, [float("inf")] + [0.0] * 5, 2, None, None), (303, [None] * 6, 3, None, None), (304, [0.1] * 6, None, None, None)]
    rows += [(None, [0.5] * 6, 1, None, None), (350, [0.5, 0.25], 1, None, None), (351, [], 2, None, None), (0, [0.0] * 6, 9, None, None), rows[5], rows[50], (400, [-9.0] * 6, 1, None, None), (-50, [1.0] * 6, 4, None, None)]
    assert same(spark, rows)
    assert same(spark, []) == []
    assert same(spark, [(50, [1.0], 1, None, None)]) == []
    assert same(spark, [(i, [0.0, 0.0], i % 3, None, None) for i in range(60)])


def test_negatives_of_large_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * 100_000], int(rng.integers(3)), None, None) for i in range(200)]
    assert same(spark, rows)


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8)) * 300
    rows = np.floor(np.repeat(centres, 100, 0) + rng.normal(size=(4000, 8)) * 5).astype(np.int64)
    longest = float((rows.astype(float) ** 2).sum(1).max())
    tree = hard_negatives.Tree(np.arange(4000), np.arange(4000) % 4, rows, longest)
    score = rows @ rows[:50].T
    low, high = np.sort(score, 0)[-40].astype(float), np.sort(score, 0)[-20].astype(float)
    plain = []
    for a in range(50):
        s = score[:, a]
        plain.append([(int(s[i]), int(i)) for i in np.lexsort((np.arange(4000), -s)) if low[a] <= s[i] <= high[a] and i % 4 != a % 4 and i != a][:3])
    best, names, none = tree.search(rows[:50], np.arange(50), np.arange(50) % 4, False, np.arange(50), low.copy(), high, 3)
    for a in range(50):
        got = [(int(s), int(i)) for s, i in zip(best[a], names[a], strict=True) if s > none]
        assert got == plain[a]
    # the ranges rule most subtrees of the root out
    d = hard_negatives.distances(np.hstack([rows[:50].astype(float), np.zeros((50, 1))]), (rows[:50].astype(float) ** 2).sum(1), tree.root["splits"], longest)
    least, _ = hard_negatives.bounds(d, tree.root["low"], tree.root["high"])
    near = np.sqrt(np.maximum((rows[:50].astype(float) ** 2).sum(1) + longest - 2 * low, 0))
    assert (least <= near[:, None] + hard_negatives.slack(longest)).mean() < 0.5


def test_ranges_of_cells_hold_all_rows(spark):
    index = hard_negatives.Index(hard_negatives.quantised(spark.createDataFrame(vectors(500, seed=9), VECTORS)))
    assert index.rows.count() == 500 and index.rows.groupBy("vec_id").count().filter("count > 1").isEmpty()
    assert index.rows.agg(F.max("shard")).first()[0] < index.first[-1]
