import random
from collections import defaultdict

import pytest

from farebox.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is over a cap is shared again by weight, until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > most * sizes[n]}
        if not over:
            return target | {n: level * weight[n] for n in open_}
        for n in over:
            target[n] = float(most * sizes[n])
            left -= target[n]
        open_ -= over
    return target


def check(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    sizes = {s: sum(r.size for r in rs) for s, rs in by_source.items()}
    targets = brute_targets(sizes)
    for s, rs in by_source.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert all(r.target == pytest.approx(targets[s], rel=1e-9) for r in rs)
        assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rs)
        most = max(r.size for r in rs)
        assert abs(sum(r.taken for r in rs) - targets[s]) <= most / 2 + 1e-6
        whole = int(targets[s] / sizes[s] + 1e-9) if sizes[s] else 0
        assert all(r.copies in (whole, whole + 1) for r in rs if r.size)


def test_documents(medium):
    rows = mixing.mix(medium.documents).collect()
    assert len(rows) == medium.documents.count()
    check(rows)
    again = mixing.mix(medium.documents.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


@pytest.mark.parametrize("seed", range(3))
def test_sources_of_all_sizes(spark, seed):
    draw = random.Random(seed)
    docs = []
    for i in range(600):
        source = draw.choice([None, "a", "b", "B", "é", "😀", "z"] + ["hot"] * 5)
        docs.append((i, "w " * int(draw.paretovariate(1.1)), source))
    check(mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect())


def test_ranks_follow_inclusion_odds(spark):
    """Of rows with unequal chances, each is taken about as often as its chance says."""
    from pyspark.sql import functions as F

    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("stratum"), F.lit(1).cast("long").alias("size"),
        F.when(F.col("id") % 4 == 0, 0.8).otherwise(0.1).alias("p"),
    )
    u = mixing.uniform("test")
    ranked = rows.withColumn("rank", (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))).withColumn("tie", F.col("doc_id"))
    ranked = ranked.withColumn("need", F.lit(10_000 * 0.8 + 30_000 * 0.1))
    taken = {r.p: r.n for r in mixing.pareto_cut(ranked, ["stratum"], "need").groupBy("p").agg(F.sum("taken_extra").alias("n")).collect()}
    assert sum(taken.values()) == 11_000
    assert taken[0.8] == pytest.approx(8_000, abs=150)


def test_odd_rows(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    check(rows)
    assert all(r.taken == 0 for r in rows if r.size == 0)


def test_empty_and_wordless(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_no_python_in_the_plan(small):
    from tests.llm.conftest import plan_of

    assert "Python" not in plan_of(mixing.mix(small.documents))
