"""Models and estimates as rows, against brute force in plain Python, with ties, nulls and empty tables."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, KolmogorovSmirnovTest
from pyspark.sql import functions as F

from farebox import workspace
from farebox.plans import estimates, isotonic, mixture, ranks, similar, survival, topics, trees, words


# --- similar sets


def sets_of(spark, rows, key):
    return similar.word_sets(spark.createDataFrame(rows, f"{key} bigint, text string"), key)


@pytest.mark.parametrize("least", ["0.1", "0.5", "0.8", "1.0"])
def test_all_similar_sets_are_found(spark, least):
    draw = random.Random(1)
    common = [f"c{i}" for i in range(4)]
    text = lambda n: " ".join(draw.choices(common, k=3) + draw.choices([f"w{i}" for i in range(60)], k=n))
    left = [(i, text(draw.randint(0, 25))) for i in range(120)]
    left += [(200 + i, t) for i, (_, t) in enumerate(left[:30])] + [(300, None), (301, "  "), (302, left[0][1] + " more")]
    right = [(i, text(draw.randint(0, 25))) for i in range(40)] + [(90, left[3][1]), (91, left[4][1] + " x"), (92, "")]
    a, b = sets_of(spark, left, "doc"), sets_of(spark, right, "item")
    got = {(r.left_id, r.right_id): (r.common, r.of_both) for r in similar.similar_pairs(a, b, least).collect()}
    bags = [{}, {}]
    for kept, rows in zip(bags, (left, right)):
        seen = {}
        for key, t in rows:
            if t and t.split():
                seen.setdefault(t, key)
        kept.update({key: set(t.lower().split()) for t, key in seen.items()})
    want = {}
    for (i, x), (j, y) in itertools.product(bags[0].items(), bags[1].items()):
        if len(x & y) * 10 >= int(float(least) * 10) * len(x | y):
            want[i, j] = (len(x & y), len(x | y))
    assert got == want and want


def test_no_sets(spark):
    some, none = sets_of(spark, [(1, "a b")], "k"), sets_of(spark, [], "k")
    assert similar.similar_pairs(some, none, "0.5").count() == similar.similar_pairs(none, some, "0.5").count() == 0


# --- mixtures


def test_mixture_finds_two_clouds(spark):
    rng = np.random.default_rng(4)
    cloud = np.concatenate([rng.normal((-3, 1000), (1, 2), (300, 2)), rng.normal((3, 1010), (0.5, 1), (700, 2)), [[1e5, 1e5]]])
    points = spark.createDataFrame(cloud[:-1].tolist(), "x double, y double").repartition(5)
    found = [mixture.Component(0.5, (-1.0, 1002.0), (4.0, 0.0, 9.0)), mixture.Component(0.5, (1.0, 1008.0), (4.0, 0.0, 9.0))]
    before = -math.inf
    for _ in range(25):
        found, likelihood = mixture.em_round(points, found)
        assert likelihood >= before - 1e-6 * abs(likelihood)
        before = likelihood
    assert [c.weight for c in found] == pytest.approx([0.3, 0.7], abs=0.02)
    assert found[0].mean == pytest.approx((-3, 1000), abs=0.3) and found[1].mean == pytest.approx((3, 1010), abs=0.2)
    far = spark.createDataFrame([(1e4, -1e4)], "x double, y double")  # every density is zero, the shares are not
    held, _ = mixture.shares(F.col("x"), F.col("y"), found)
    assert sum(far.select(*held).first()) == pytest.approx(1.0)


def test_mixture_without_points(spark):
    start = list(mixture.START)
    assert mixture.em_round(spark.createDataFrame([], "x double, y double"), start) == (start, 0.0)


# --- trees


def brute_tree(rows, names, depth, least=1):
    out = {}

    def impurity(part):
        ones = sum(r[0] for r in part)
        return 2 * ones * (len(part) - ones) / len(part) if part else 0.0

    def go(node, part, level):
        best = None
        if level < depth:
            for k, name in enumerate(names, 1):
                for cut in sorted({r[k] for r in part}):
                    left, right = [r for r in part if r[k] <= cut], [r for r in part if r[k] > cut]
                    if min(len(left), len(right)) >= least:
                        gain = round((impurity(part) - impurity(left) - impurity(right)) / len(part), trees.DIGITS)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, name, cut, left, right)
        out[node] = (len(part), sum(r[0] for r in part), best and best[1], best and best[2])
        if best:
            go(2 * node, best[3], level + 1)
            go(2 * node + 1, best[4], level + 1)

    go(1, rows, 0)
    return out


@pytest.mark.parametrize("least", [1, 15])
def test_tree_equals_exact_search(spark, least):
    draw = random.Random(8)
    rows = [(int(draw.random() < 0.2 + 0.1 * a), a, draw.randint(0, 3), 5) for a in draw.choices(range(6), k=400)]
    df = spark.createDataFrame(rows, "label int, a int, b int, same int").repartition(4)
    got = {r.node: (r.n, r.ones, r.feature, r.cut) for r in trees.grow(df, ["a", "b", "same"], 3, least).collect()}
    assert got == brute_tree(rows, ["a", "b", "same"], 3, least)


def test_tree_with_nulls_and_one_class(spark):
    df = spark.createDataFrame([(0, None), (0, 3), (1, 7), (None, 2)], "label int, a int")
    got = {r.node: (r.n, r.ones, r.feature, r.cut) for r in trees.grow(df, ["a"], 2).collect()}
    assert got == {1: (3, 1, "a", 3), 2: (2, 0, None, None), 3: (1, 1, None, None)}
    same = spark.createDataFrame([(1, 1), (1, 2)], "label int, a int")
    assert [r.feature for r in trees.grow(same, ["a"], 2).collect()] == [None]


# --- isotonic


def pooled(points):
    pools = []
    for x, n, s in points:
        pools.append([x, x, n, s])
        while len(pools) > 1 and pools[-2][3] / pools[-2][2] >= pools[-1][3] / pools[-1][2]:
            _, high, n2, s2 = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + n2, pools[-1][3] + s2]
    return [(a, b, n, round(s / n, 9)) for a, b, n, s in pools]


@pytest.mark.parametrize("shape", ["noisy", "falling", "rising", "saw"])
def test_isotonic_in_small_slots(spark, shape):
    """Pools that reach over many slots: a falling series is one block, whatever the slots."""
    draw = random.Random(3)
    level = {"noisy": lambda i: i / 40 + draw.gauss(0, 2), "falling": lambda i: -i, "rising": lambda i: i, "saw": lambda i: i % 17 + i / 50}[shape]
    rows = [(float(i // 2), float(level(i))) for i in range(300)] + [(None, 1.0), (5.0, None)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(6)
    got = [(r.low, r.high, r.n, round(r.value, 9)) for r in isotonic.isotonic(df, "x", "y", slot=8).orderBy("low").collect()]
    sums = {}
    for x, y in rows:
        if x is not None and y is not None:
            n, s = sums.get(x, (0, 0.0))
            sums[x] = n + 1, s + y
    want = pooled([(x, *sums[x]) for x in sorted(sums)])
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    assert len(want) == {"falling": 1, "rising": 150}.get(shape, len(want))


def test_falling_fit_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 6.0), (3.0, 1.0)], "x double, y double")
    assert [(r.low, r.high, r.value) for r in isotonic.isotonic(df, "x", "y", rising=False).orderBy("low").collect()] == [(1, 2, 5.5), (3, 3, 1)]
    assert isotonic.isotonic(df.limit(0), "x", "y").count() == 0


# --- survival


def test_survival_agrees_with_the_library(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 2))
    ends = np.exp(1 + x @ [0.5, -0.3] + 0.7 * np.log(rng.exponential(size=800)))
    cut = rng.uniform(0.5, 12, 800)
    rows = [(float(min(e, c)), float(e <= c), *map(float, v)) for e, c, v in zip(ends, cut, x)]
    df = spark.createDataFrame(rows, "time double, ended double, a double, b double").repartition(4).cache()
    coefficients, scale = survival.fit(df, ["a", "b"])
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    theirs = AFTSurvivalRegression(labelCol="time", censorCol="ended", maxIter=200, tol=1e-10).fit(vectors)
    assert coefficients == pytest.approx([theirs.intercept, *theirs.coefficients], abs=2e-4) and scale == pytest.approx(theirs.scale, abs=2e-4)
    _, gradient, _ = survival.sums_at(df, ["a", "b"], coefficients, math.log(scale))
    assert np.abs(gradient).max() < 1e-9


def test_survival_needs_an_end(spark):
    with pytest.raises(ValueError):
        survival.fit(spark.createDataFrame([(1.0, 0.0)], "time double, ended double"), [])


# --- ranks


def test_rank_statistics_agree_with_the_library(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=400).round(1)  # many ties
    y = (x + rng.normal(size=400)).round(1)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(5)
    theirs = Correlation.corr(VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(df), "v", "spearman").first()[0].toArray()[0, 1]
    with_nulls = df.union(spark.createDataFrame([(None, 1.0), (2.0, None)], df.schema))
    row = ranks.spearman(with_nulls, "x", "y").first()
    assert row.n == 400 and row.rho == pytest.approx(theirs, abs=1e-10)
    found = ranks.ks_one_sample(df, "x", lambda c: ranks.normal_cdf(c, 0.0, 1.0)).first()
    known = KolmogorovSmirnovTest.test(df, "x", "norm", 0.0, 1.0).first()
    assert found.statistic == pytest.approx(known.statistic, abs=1e-12) and found.p_value == pytest.approx(known.pValue, abs=0.02)


def test_two_samples(spark):
    rows = [(float(v), True) for v in (1, 2, 2, 3)] + [(float(v), False) for v in (2, 4, 5)]
    found = ranks.ks_two_samples(spark.createDataFrame(rows, "x double, a boolean"), "x", F.col("a")).first()
    assert found.n == 7 and found.statistic == pytest.approx(1 - 1 / 3)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert ranks.spearman(flat, "x", "y").first().rho is None


# --- estimates


def test_intervals_cover_the_exact_answer(spark):
    """About 95 of 100 seeds in the first round; computed from block totals of all seeds in one job."""
    rng = random.Random(5)
    rows = [(i, rng.expovariate(1.0)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, value double").cache()
    seeds = spark.range(100).withColumnRenamed("id", "seed")
    block = estimates.block_of(F.col("id") + F.col("seed") * 1_000_003, 0)
    each = df.crossJoin(F.broadcast(seeds)).groupBy("seed", block.alias("block")).agg(F.count("*").alias("n"), F.sum("value").alias("s")).collect()
    exact, covered = sum(v for _, v in rows), 0
    for seed in range(100):
        totals = {r.block: r.s for r in each if r.seed == seed}
        s = np.array([totals.get(b, 0.0) for b in range(8)])
        half = estimates.STUDENT[8] * math.sqrt(s.var(ddof=1) / 8 * (1 - 8 / estimates.BLOCKS)) * estimates.BLOCKS
        covered += abs(s.mean() * estimates.BLOCKS - exact) <= half
    assert covered >= 90
    sizes = [r.n for r in each if r.seed == 0]
    assert len(sizes) == estimates.BLOCKS and max(sizes) < 2 * min(sizes)


def test_rounds_end_when_narrow_or_exact(spark):
    df = spark.createDataFrame([(i, 1.0 + i % 3) for i in range(4000)], "id bigint, value double")
    blocks = estimates.in_blocks(df, "id", "value")
    loose = estimates.approximate(blocks, 0.5).collect()
    assert {r.round for r in loose} == {1} and {r.blocks for r in loose} == {4}
    strict = [r for r in estimates.approximate(blocks, 0.0).collect() if r.blocks == 64]
    got = {r.measure: (r.estimate, r.low, r.high) for r in strict}
    assert got["count"] == (4000.0,) * 3 and got["sum"] == pytest.approx((7999.0,) * 3)
    assert got["mean"] == pytest.approx((7999 / 4000,) * 3)


def test_a_round_reads_new_blocks_only(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(2000)], "id bigint, value double")
    plan = estimates.totals(estimates.in_blocks(df, "id", "value"), 4, 8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan


# --- topics and words


def test_topics_leave_their_edges_in_place(spark):
    """A round moves sums of words and documents, never an edge, and a document in several parts is one document."""
    rows = [(i % 7, f"word{i % 5} stays word{i % 3} here{i}") for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, "lost"), (1, None)], "doc_id bigint, text string").repartition(3)
    few = topics.dealt(topics.word_counts(docs), F.col("doc"), 2)  # fewer parts than shuffle partitions
    for edges, parts in ((few, 2), topics.words_in_parts(docs)):
        found = topics.Topics(edges, 3, parts)
        with workspace.setting(spark, topics.SHARED_KEY, "false"), workspace.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            plan = found.messages()._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [len(line) - len(line.lstrip(" :+-*")) for line in plan]
        moved = [i for i, line in enumerate(plan) if "Exchange" in line]
        assert moved and any("topic_edges" in line for line in plan)
        for i in moved:
            end = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
            assert not any("topic_edges" in line for line in plan[i:end])
    whole = topics.Topics(topics.word_counts(docs), 3).rounds(2).describe(4).orderBy("topic", "place").collect()
    assert [tuple(r) for r in found.rounds(2).describe(4).orderBy("topic", "place").collect()] == [tuple(r) for r in whole]


def test_topics_keep_every_word_and_tell_texts_apart(spark):
    # The start leans by document and length of the word: all words here have an odd length.
    rows = [(i, "cat dog pet cat") for i in range(0, 20, 2)] + [(i, "stock bonds markets bonds") for i in range(1, 21, 2)] + [(99, None), (None, "cat"), (98, "")]
    edges = topics.word_counts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    found = topics.Topics(edges, 2).rounds(25)
    assert sum(found.totals) == pytest.approx(80.0)
    tops = {}
    for r in found.describe(3).collect():
        tops.setdefault(r.topic, set()).add(r.word)
    assert sorted(map(sorted, tops.values())) == [["bonds", "markets", "stock"], ["cat", "dog", "pet"]]
    shares = {r.doc: r.shares for r in found.of_documents().collect()}
    assert all(max(s) > 0.9 and sum(s) == pytest.approx(1) for s in shares.values()) and len(shares) == 20


def test_word_vectors_against_brute_force(spark, tables):
    import hashlib
    from collections import Counter

    import regex

    docs = tables.documents.orderBy("doc_id").limit(40).select("text").collect()
    pairs = Counter()
    for (text,) in docs:
        w = regex.findall(r"\p{L}+", text.lower())
        for apart in (1, 2):
            for a, b in zip(w, w[apart:]):
                pairs[a, b] += 1
                pairs[b, a] += 1
    totals = Counter()
    for (a, _), n in pairs.items():
        totals[a] += n
    whole = sum(totals.values())
    sign = {w: np.array([1.0 if c < "8" else -1.0 for c in hashlib.md5(w.encode()).hexdigest()]) for w in totals}
    vectors = {}
    for (a, b), n in pairs.items():
        weight = max(math.log(n * whole / (totals[a] * totals[b])), 0.0)
        vectors[a] = vectors.get(a, 0) + weight * sign[b]
    df = spark.createDataFrame(docs, "text string").union(spark.createDataFrame([(None,), ("",), ("alone",)], "text string"))
    table = words.word_vectors(df.repartition(4)).cache()
    got = {r.word: r for r in table.collect()}
    assert {w: r.n for w, r in got.items()} == dict(totals)
    for w, v in vectors.items():
        assert got[w].vector == pytest.approx(v / max(np.linalg.norm(v), 1e-300), abs=1e-9)
    given = sorted(totals)[:3]
    near = words.nearest(table, spark.createDataFrame([(g,) for g in given] + [("not there",)], "word string"), 4).collect()
    for g in given:
        rated = sorted((-round(float(np.dot(got[g].vector, r.vector)), 6), w) for w, r in got.items() if w != g)[:4]
        assert [(r.word, r.cosine) for r in sorted(near, key=lambda r: r.place) if r.given == g] == [(w, pytest.approx(-c, abs=2e-6)) for c, w in rated]


def test_a_pair_of_words_is_one_row(spark):
    """Both ways are counted together, before the rows are written; a word beside itself counts from either side."""
    docs = spark.createDataFrame([("b a b",), ("a a",), ("a b c a",), (None,)], "text string").repartition(2)
    rows = [tuple(r) for r in words.neighbours(docs, 2).collect()]
    assert sorted(rows) == [("a", "a", 2), ("a", "b", 4), ("a", "c", 2), ("b", "b", 2), ("b", "c", 1)]


def test_too_many_given_words(spark, monkeypatch):
    monkeypatch.setattr(words, "MOST_GIVEN", 1)
    table = spark.createDataFrame([("a", 1, [1.0] * 32), ("b", 1, [1.0] * 32)], "word string, n bigint, vector array<double>")
    with pytest.raises(ValueError):
        words.nearest(table, table, 1)
