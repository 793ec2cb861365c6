"""Graph algorithms against brute force on small graphs with a hub."""

import itertools
import random

import pytest

from pyspark.sql import functions as F

from farebox import workspace
from farebox.plans import graph, matrix


def edges_of(spark, pairs, schema="src bigint, dst bigint"):
    return spark.createDataFrame(pairs, schema)


@pytest.fixture(scope="module")
def hub():
    rng = random.Random(5)
    pairs = {(0, i) for i in range(1, 40)} | {(rng.randrange(1, 40), rng.randrange(1, 40)) for _ in range(120)}
    return sorted(p for p in pairs if p[0] != p[1])


def test_triangles(spark, hub):
    near = {}
    for a, b in hub:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for a, b, c in itertools.combinations(sorted(near), 3):
        if b in near[a] and c in near[a] and c in near[b]:
            for v in (a, b, c):
                want[v] = want.get(v, 0) + 1
    assert {r.id: r.triangles for r in graph.triangles(edges_of(spark, hub)).collect()} == want


def test_triangles_of_repeated_edges_both_ways_and_loops(spark, hub):
    once = {r.id: r.triangles for r in graph.triangles(edges_of(spark, hub)).collect()}
    more = hub + [(b, a) for a, b in hub[::2]] + hub[::3] + [(3, 3), (None, 4), (4, None)]
    assert {r.id: r.triangles for r in graph.triangles(edges_of(spark, more)).collect()} == once


def test_what_makes_the_edges_runs_once(spark, hub):
    """Edges are made by one pass, then written: dealing them out does not make them again."""
    made = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            made.add(1)
            yield row

    edges = spark.createDataFrame(edges_of(spark, hub).rdd.mapPartitions(seen), "src bigint, dst bigint")
    graph.pagerank(edges, 1).collect()
    assert made.value == len(hub)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 530)]
    loop = [(7, 7)]
    found = {r.id: r.component for r in graph.components(edges_of(spark, chain + star + loop)).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 530)}, 7: 7}


def test_pagerank_of_a_small_graph(spark):
    pairs = [(1, 2), (1, 3), (1, 4), (2, 1), (3, 1), (4, 1)]
    links = {}
    for a, b in pairs:
        links.setdefault(a, []).append(b)
    ranks = {a: 1.0 for a in links}
    for _ in range(10):
        got = {}
        for a, targets in links.items():
            for b in targets:
                got[b] = got.get(b, 0) + ranks.get(a, 0) / len(targets)
        ranks = {b: 0.15 + 0.85 * s for b, s in got.items()}
    found = {r.id: r.rank for r in graph.pagerank(edges_of(spark, pairs), 10).collect()}
    assert found == pytest.approx(ranks)


def test_closure_with_a_cycle(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4)]
    found = {(r.src, r.dst) for r in graph.transitive_closure(edges_of(spark, pairs)).collect()}
    assert found == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)}


def test_edges_of_a_vertex_are_one_row_for_shortest_paths(spark, monkeypatch):
    """A round goes through a row per vertex or piece of a busy one, not through each edge; edges out of null are no list."""
    dealt, deal = [], graph.dealt_out
    monkeypatch.setattr(graph, "dealt_out", lambda *a, **k: dealt.append(deal(*a, **k)) or dealt[-1])
    pairs = [(1, i, float(i)) for i in range(2, 30)] + [(i, 30, 1.0) for i in range(2, 30)] + [(1, 2, 1.0), (None, 5, 1.0), (None, 6, 1.0), (30, None, 1.0), (2, 7, None)]
    edges = edges_of(spark, pairs, "src bigint, dst bigint, weight double")
    found = {r.id: r.distance for r in graph.shortest_paths(edges, 1).collect()}
    assert dealt[0][0].count() == 30 and found[2] == 1.0 and found[30] == 2.0 and found[29] == 29.0
    monkeypatch.setattr(graph, "PIECE", 5)
    assert {r.id: r.distance for r in graph.shortest_paths(edges, 1).collect()} == found
    assert dealt[1][0].where("src = 1").count() > 1


def test_shortest_paths(spark):
    pairs = [(1, 2, 7.0), (1, 3, 1.0), (3, 2, 2.0), (2, 4, 1.0), (5, 1, 1.0)]
    found = graph.shortest_paths(edges_of(spark, pairs, "src bigint, dst bigint, weight double"), 1).collect()
    assert {r.id: r.distance for r in found} == {1: 0.0, 3: 1.0, 2: 3.0, 4: 4.0}


def test_matrix_products(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 1, 3.0)], "i bigint, j bigint, value double")
    b = spark.createDataFrame([(0, 0, 4.0), (1, 0, 5.0)], "i bigint, j bigint, value double")
    assert {(r.i, r.j): r.value for r in matrix.multiply(a, b).collect()} == {(0, 0): 14.0, (1, 0): 15.0}
    total = matrix.add(matrix.transpose(a), a, -1)
    assert {(r.i, r.j): r.value for r in total.collect()} == {(0, 0): 0.0, (0, 1): -2.0, (1, 0): 2.0, (1, 1): 0.0}


def test_singular_values_and_orthonormal_left_factors(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a = rng.normal(size=(50, 4))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(a)], "id bigint, row array<double>").repartition(3)
    left, lengths, right = matrix.svd(df, "row", 3, ["id"])
    u = np.array([r.u for r in left.orderBy("id").collect()])
    assert lengths == pytest.approx(np.linalg.svd(a, compute_uv=False)[:3])
    assert u.T @ u == pytest.approx(np.eye(3), abs=1e-9)
    assert a @ right == pytest.approx(u * lengths)


def test_loops_go_on_to_the_end_of_a_long_chain(spark):
    """More than a hundred rounds."""
    n = 104
    chain = [(i, i + 1, 1.0) for i in range(n)]
    edges = edges_of(spark, chain, "src bigint, dst bigint, weight double")
    assert {r.id: r.distance for r in graph.shortest_paths(edges, 0).collect()} == {i: float(i) for i in range(n + 1)}
    assert graph.transitive_closure(edges).count() == n * (n + 1) // 2


def test_ranks_that_do_not_settle_are_an_error(spark):
    edges = edges_of(spark, [(0, 1), (1, 2), (2, 0), (2, 1)])
    with pytest.raises(RuntimeError):
        graph.pagerank_until(edges, 1e-9, max_rounds=2)


def test_a_round_moves_no_edges(spark):
    """The table of edges is read where it lies, bucketed by source; only messages are shuffled."""
    edges = spark.range(300).selectExpr("id AS src", "id % 17 AS dst")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = workspace.bucketed(graph.with_out_degree(edges), "src", "links")
        ranks = workspace.stored(spark.range(300).selectExpr("id", "1.0D AS rank"), "ranks")
        plan = graph.rank_round(links, ranks)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2  # ranks to the edges, messages to their vertices
    edge_side = plan[: plan.index("Bucketed: true")]
    assert edge_side.rstrip().splitlines()[-1].count("FileScan") == 1
    assert "Bucketed: true" in plan


def test_a_busy_vertex_is_cut_into_pieces(spark, monkeypatch):
    """A third of all edges leave one vertex: they lie in several tasks, and the results stay the same."""
    rng = random.Random(6)
    pairs = sorted({(0, i) for i in range(1, 400)} | {(rng.randrange(400), rng.randrange(400)) for _ in range(800)})
    edges = edges_of(spark, pairs)
    weighted = edges_of(spark, [(a, b, float(1 + (a * 7 + b) % 5)) for a, b in pairs], "src bigint, dst bigint, weight double")
    whole = {r.id: r.rank for r in graph.pagerank(edges, 4).collect()}
    far = {r.id: r.distance for r in graph.shortest_paths(weighted, 3).collect()}
    monkeypatch.setattr(graph, "PIECE", 20)
    links, busy = graph.dealt_out(edges, "links")
    assert {r.src: r.pieces for r in busy.collect()}[0] >= 20 and links.count() == len(pairs)
    tasks = links.where("src = 0").select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1
    assert {r.id: r.rank for r in graph.pagerank(edges, 4).collect()} == pytest.approx(whole)
    assert {r.id: r.distance for r in graph.shortest_paths(weighted, 3).collect()} == far
    reached, todo = {0}, [0]
    while todo:
        at = todo.pop()
        todo += [b for a, b in pairs if a == at and b not in reached]
        reached |= {b for a, b in pairs if a == at}
    from_hub = graph.transitive_closure(edges).where("src = 0")
    assert {r.dst for r in from_hub.collect()} | {0} == reached


def test_clean_up_leaves_no_table(spark):
    session = spark.newSession()
    edges = session.createDataFrame([(1, 2), (2, 3)], "src bigint, dst bigint")
    links, _ = graph.dealt_out(edges, "links")
    before = {t.name for t in session.catalog.listTables() if t.name.startswith("links_")}
    assert before and workspace.clean_up(session) > 0
    mine = {e[2] for e in workspace._made if e[0] == workspace._session(spark)}
    after = {t.name for t in session.catalog.listTables() if t.name.startswith("links_")}
    assert len(after) == len(before) - 1 and mine  # the other session's tables and files stay
