"""The pipeline's stages on odd rows and on the smallest table."""

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from locusflow.llm.common import saved  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = saved(stage(spark, docs, FOLDER), name)
        assert new.columns == names and 0 < new.count() <= docs.count()
        docs = new
    assert docs.count() > 0.5 * before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_run_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_copies_and_junk_go(spark, tmp_path):
    prose = [f"the river number {i} runs past the old mill and house {i * 7} into lake {i * 13} where birds of kind {i * 29} sing loudly about {i * 31}" for i in range(30)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(prose)] + [(100, prose[0], "en", "s", 1), (101, "junk " * 50, "en", "s", 1), (102, "12 34", None, None, None), (None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not got & {100, 101, 102, None} and 0 in got


CLASHES = "doc_id long, text string, _id string, _tk string, id string, ID_ string, key string, starts string, _starts string, _stops string, n long, g int, copy boolean, sk string, fp string, a string"


def test_clashing_names_stay_untouched(spark):
    """Every stage returns the caller's columns as they were, whatever they are called."""
    prose = [f"the river number {i} runs past the old mill and house {i * 7} into lake {i * 13} where birds of kind {i * 29} sing loudly about {i * 31}" for i in range(12)]
    shared = "and this long passage about the harbour in winter, where ships wait for the ice to break while crews mend nets and tell each other stories of the northern seas, is the same in every text that holds it at all"
    rows = [(i, t + (" " + shared if i % 3 == 0 else "")) for i, t in enumerate(prose)] + [(50, prose[0] + " " + shared), (None, None), (51, "")]
    docs = spark.createDataFrame([(i, t, "I", "T", "i", "J", "k", "s", "S", "P", 5, 6, True, "K", "f", "A") for i, t in rows], CLASHES)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.withColumn("lang", F.lit("en")), FOLDER).drop("lang")
        assert out.schema == docs.schema
        kept = out.collect()
        assert kept and all(tuple(r)[2:] == ("I", "T", "i", "J", "k", "s", "S", "P", 5, 6, True, "K", "f", "A") for r in kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == len(rows)


@pytest.mark.parametrize(("common", "broadcast", "stars"), [(8, 1_000_000, 2), (1, 0, 0)])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, common, broadcast, stars):
    """One document stays for each component of the pairs with five-word-shingle Jaccard of 0.8 or more, and no other goes."""
    import random

    from locusflow.llm import simhash_bk

    # with 1 and no sampling every shingle counts as common, which must change the order of search only
    monkeypatch.setattr(simhash_bk, "COMMON", common)
    monkeypatch.setattr(simhash_bk, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(simhash_bk, "STARS", stars)
    monkeypatch.setattr(simhash_bk, "SAMPLE", 16 if common > 1 else 1)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    texts = ["", "a b", "a b", "a b c"]
    for n in (12, 30, 60, 120):
        for _ in range(6):
            base = [rng.choice(words) for _ in range(n)]
            texts.append(" ".join(base))
            for share in (0.8, 0.82, 0.85, 0.9, 0.75):
                keep = round(n * share)
                texts.append(" ".join(base[:keep] if share < 0.9 else base[: n - 1] + ["new"]))
                texts.append(" ".join(base[n - keep :] + [rng.choice(words) for _ in range(round(n * (0.9 - share) / 2))]))
    rows = [(i, t) for i, t in enumerate(texts)]
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash_bk.keep_first(docs).collect()) == sorted(set(label))


def test_forest_joins_what_near_pairs_join():
    """Fewer edges than rows, each a near pair of two components, and the same components as all near pairs give."""
    import numpy as np

    from locusflow.llm import simhash_bk as S

    rng = np.random.default_rng(3)
    sets = []
    for _ in range(6):
        base = rng.integers(0, 1 << 62, 60)
        sets += [np.unique(np.concatenate([base[: 60 - k], rng.integers(0, 1 << 62, k)])) for k in rng.integers(0, 14, 25)]
    n = np.array([len(x) for x in sets])
    sketch = np.array([S.parity(x).view(np.uint64) for x in sets])
    label = np.where(np.arange(len(n)) % 5 == 0, np.arange(len(n)) // 25 * 1000, np.arange(len(n)))
    near = [(i, j) for i in range(len(n)) for j in range(i + 1, len(n)) if label[i] != label[j] and np.bitwise_count(sketch[i] ^ sketch[j]).sum() <= (n[i] + n[j]) / 9 + 1e-9]

    def joined(pairs):
        own = label.copy()
        for i, j in pairs:
            own[own == max(own[i], own[j])] = min(own[i], own[j])
        return own.tolist()

    i, j = S.forest(n, label, sketch, 0.8)
    edges = list(zip(i.tolist(), j.tolist(), strict=True))
    assert len(edges) == len(set(label.tolist())) - len(set(joined(near)))
    assert set(edges) <= set(near) and joined(edges) == joined(near)


def test_stages_leave_only_the_tables_that_their_results_read(spark, tmp_path, monkeypatch):
    import itertools

    from locusflow.llm import common
    from locusflow.llm.simhash_bk import keep_first
    from locusflow.llm.suffix_dedup import remove_repeats

    number = itertools.count()
    monkeypatch.setattr(common, "scratch", lambda session, name: f"{tmp_path}/{name}-{next(number)}")
    words = " ".join(f"w{i}" for i in range(120))
    docs = spark.createDataFrame([(1, words), (2, words), (3, "another " + words[::-1] + words), (4, "alone")], "doc_id long, text string")
    kept = keep_first(docs)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["gone"]
    cut = remove_repeats(docs)
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["gone", "removal"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "", 2: "", 3: "another " + words[::-1], 4: "alone"}


def test_near_duplicates_remove_tables_as_soon_as_they_are_read(spark, tmp_path, monkeypatch):
    """No two rounds' shingle sets lie on disk at once, nor the rows' heads and sketches beside those of the classes."""
    import itertools

    from locusflow.llm import common
    from locusflow.llm.simhash_bk import keep_first

    number, seen = itertools.count(), []

    def scratch(session, name):
        seen.append((name, [p.name.split("-")[0] for p in tmp_path.iterdir()]))
        return f"{tmp_path}/{name}-{next(number)}"

    monkeypatch.setattr(common, "scratch", scratch)
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " more"), (3, words[::-1]), (4, "alone")], "doc_id long, text string")
    assert sorted(r.doc_id for r in keep_first(docs).collect()) == [1, 3, 4]
    assert sum(name == "sets" for name, _ in seen) > 1
    assert all("sets" not in there for name, there in seen if name == "sets")
    assert all("prints" not in there for name, there in seen if name in ("fingerprints", "sets", "heads"))


def test_executors_hand_texts_to_python_in_small_batches(spark):
    """A worker gets at most 1 MB and one row at once, and works on half of that, so that two of them fit beside a full heap."""
    from locusflow.llm.common import small_batches, text_slices

    docs = spark.range(0, 64, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('many words ', 6000)").alias("text"))

    def run(batches):
        import pyarrow as pa

        sizes, whole = [], []

        def noted():
            for batch in batches:
                whole.append(sum(map(len, batch.column(1).to_pylist())))
                yield batch

        for _, texts in text_slices(noted()):
            sizes.append(sum(map(len, texts)))
        yield pa.RecordBatch.from_arrays([pa.array([max(whole)]), pa.array([max(sizes)]), pa.array([sum(sizes)])], names=["batch", "slice", "total"])

    got = small_batches(docs).mapInArrow(run, "batch long, slice long, total long").first()
    assert got["total"] == 64 * 66_000
    assert got["batch"] <= (1 << 20) + 66_000 and got["slice"] <= 512 << 10
