"""Models: above their floor, the same with the same seed, and near-duplicates against brute force."""

import re

import numpy as np
import pytest

import __spark_entry__ as entry
from farebox.plans import metrics, ml_models
from tests.conftest import SF

QUERIES = entry.queries()


@pytest.mark.parametrize("name", ["ml_classify", "ml_regress", "ml_cluster", "ml_stats", "ml_tune"])
def test_models_beat_their_floor(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows and all(r.good for r in rows), [r for r in rows if not r.good]


def test_texts_are_cut_into_words_once_for_their_topics(spark, monkeypatch):
    """The steps and measures of the topics read kept texts, which are let go at the end."""
    seen, fit = [], ml_models.mk.LDA.fit
    monkeypatch.setattr(ml_models.mk.LDA, "fit", lambda self, texts: seen.append((texts, texts.storageLevel.useDisk)) or fit(self, texts))
    QUERIES["ml_cluster"](spark, SF)
    ((texts, kept),) = seen
    assert kept and not texts.storageLevel.useDisk


def test_topics_learn_from_each_text_once_in_every_step(spark, tmp_path, monkeypatch):
    """Each text is a word of its own, as often as in the others: the model has seen all the words equally often."""
    letters = "abcdefghijklmnop"
    texts = [(i, f"word{a}{b} " * 1000) for i, (a, b) in enumerate((a, b) for a in letters for b in letters[:4])]
    spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("customer", "supplier", "orders", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    seen, fit = [], ml_models.mk.LDA.fit
    monkeypatch.setattr(ml_models.mk.LDA, "fit", lambda self, rows: seen.append((rows.collect(), fit(self, rows))) or seen[-1][1])
    assert [r for r in QUERIES["ml_cluster"](spark, str(tmp_path)).collect() if r.model == "topics"]
    ((rows, model),) = seen
    words = [int(w) for r in rows for w in r.features.indices]
    assert len(set(words)) == len(words) == len(texts)
    weights = model.topicsMatrix().toArray().sum(axis=1)
    assert weights[words].max() < 1.05 * weights[words].min()
    assert weights[words].min() > 10 * np.delete(weights, words).max()


@pytest.mark.parametrize("name", ["ml_quantile_buckets", "ml_encoding_fitted", "ml_text_vectors", "ml_selection", "ml_recommend", "ml_stages"])
def test_jobs_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_hashed_vectors_stay_sparse(spark):
    """A vector of 2^18 entries is never spread out: that is 2 MB for each row."""
    rows = QUERIES["ml_encoding_fitted"](spark, SF)
    assert "UDF(hashed" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {r.hashed_values for r in rows.collect()} <= {2, 3}


def test_seeded_jobs_repeat(spark):
    for name in ("taxi_sample", "sample_uniform", "src_random_tables"):
        first, second = (sorted(map(str, QUERIES[name](spark, SF).collect())) for _ in range(2))
        assert first == second


def test_near_texts_have_the_distance_of_their_word_sets(spark, tables):
    found = [r for r in QUERIES["ml_lsh"](spark, SF).collect() if r.kind == "text"]
    texts = {r.doc_id: set(r.text.lower().split()) for r in tables.documents.collect()}
    items = {r.item_id: set(r.text.lower().split()) for r in tables.benchmark.collect()}
    assert found
    for r in found:
        a, b = texts[r.id], items[r.item]
        assert r.distance == pytest.approx(1 - len(a & b) / len(a | b), abs=0.02)  # hashed words may collide
        assert r.distance <= 0.9


def test_hashes_of_texts_are_made_once(spark):
    """The join reads the hashes of the texts from where they were written; it does not make them anew in each place it uses them."""
    plan = QUERIES["ml_lsh"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Relation \[id#\d+L,copies#\d+L,bag#\d+,hashes#\d+\]", plan)


def test_near_pairs_are_found(spark, tables):
    """Against all pairs: of the weakest pairs asked for (similarity 0.1) few may be lost, of the near vectors none."""
    rows = QUERIES["ml_lsh"](spark, SF).collect()
    texts, items = {}, {}
    for kept, table, key in ((texts, tables.documents, "doc_id"), (items, tables.benchmark, "item_id")):
        for r in table.collect():
            if r.text and r.text.split():
                kept[r.text] = min(kept.get(r.text, r[key]), r[key])
    bags = [[(key, set(text.lower().split())) for text, key in kept.items()] for kept in (texts, items)]
    near = {(i, j) for i, a in bags[0] for j, b in bags[1] if len(a & b) > 0.1 * len(a | b)}
    found = {(r.id, r.item) for r in rows if r.kind == "text"}
    assert len(near) >= 15 and len(near & found) >= 0.95 * len(near)
    vectors = [(r.vec_id, r.label, np.array(r.embedding, float)) for r in tables.embeddings.collect()]
    means = {c: np.mean([v for _, label, v in vectors if label == c], axis=0) for c in {label for _, label, _ in vectors}}
    near = {(i, c) for i, _, v in vectors for c, m in means.items() if np.linalg.norm(v - m) < 1}
    found = {(r.id, r.item) for r in rows if r.kind == "vector"}
    assert near and len(near & found) >= 0.99 * len(near)


def test_areas_of_a_perfect_and_a_useless_score(spark):
    perfect = spark.createDataFrame([(float(i), int(i >= 5)) for i in range(10)], "score double, label int")
    row = metrics.roc_area(perfect).first()
    assert (row.roc, row.pr) == (pytest.approx(1.0), pytest.approx(1.0))
    useless = spark.createDataFrame([(1.0, i % 2) for i in range(10)], "score double, label int")
    assert metrics.roc_area(useless).first().roc == pytest.approx(0.5)


def test_density_sums_kernels(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    (row,) = metrics.kernel_density(df, "x", (2.0,), 1.0).collect()
    assert row.density == pytest.approx(0.24197072451914337)
