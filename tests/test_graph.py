import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan
from marginalia.operators import graph as g
from marginalia.operators import rank, skew
from marginalia.operators.components import community_count, connected_components
from marginalia.plans import mining
from marginalia.scratch import Scratch

FIXED_POINT = {"A": 1.413152, "B": 0.950786, "C": 1.486061, "D": 0.15, "E": 0.15, "F": 0.2775}


def labelled(graph, edges=None):
    edges = graph.edges if edges is None else edges
    found = g.triplets(g.Graph(graph.vertices, edges)).select("src_label", "dst_label")
    return sorted("".join(r) for r in found.collect())


def test_build(graph, links):
    assert tuple(g.graph_size(graph).select("vertices", "edges").first()) == (6, 7)
    assert labelled(graph) == sorted("".join(r) for r in links.collect())
    assert graph.vertices.select("id").distinct().count() == 6


def test_neighbours(graph):
    pairs = g.neighbour_ids(graph.edges).select(F.col("id").alias("src"), F.col("neighbour").alias("dst"), "n")
    named = g.triplets(g.Graph(graph.vertices, pairs))
    found = {}
    for r in named.collect():
        found.setdefault(r.src_label, []).extend([r.dst_label] * r.n)
    assert {k: "".join(sorted(v)) for k, v in found.items()} == {
        "A": "BBCC", "B": "AAC", "C": "AABD", "D": "C", "E": "F", "F": "E",
    }


def ranks_by_label(graph, ranks):
    return {r.label: r.rank for r in rank.labelled_ranks(ranks, graph.vertices).collect()}


def test_page_rank_converges(graph, ranks):
    found = ranks_by_label(graph, ranks)
    assert {k: round(v, 6) for k, v in found.items()} == FIXED_POINT


def power_rounds(edges, rounds):
    """PageRank by the formula over plain lists."""
    vertices = {v for e in edges for v in e}
    out = {v: sum(1 for s, _ in edges if s == v) for v in vertices}
    ranks = dict.fromkeys(vertices, 0.15)
    for _ in range(rounds):
        ranks = {v: 0.15 + 0.85 * sum(ranks[s] / out[s] for s, d in edges if d == v) for v in vertices}
    return ranks


@pytest.mark.parametrize("rounds", [0, 1, 7])
def test_page_rank_rounds(graph, links, scratch, rounds):
    want = power_rounds([tuple(r) for r in links.collect()], rounds)
    found = ranks_by_label(graph, rank.page_rank(graph.edges, scratch, tol=None, max_iter=rounds))
    assert found == pytest.approx(want)


def test_page_rank_with_a_hub(plain, scratch):
    """Half of all edges leave one vertex: its rows are split, the result is the same."""
    pairs = [(0, d) for d in range(1, 60)] + [(s, (s * 7) % 60) for s in range(1, 60)] + [(3, 3)]
    edges = plain.createDataFrame(pairs, "src bigint, dst bigint")
    rows, _ = rank._rank_edges(edges, scratch)
    salts = rows.filter("n > 0").groupBy("src").agg(F.countDistinct(skew.SALT).alias("parts"))
    assert salts.filter("src = 0").first().parts > 2
    found = {r.id: r.rank for r in rank.page_rank(edges, scratch, tol=None, max_iter=6).collect()}
    assert found == pytest.approx(power_rounds(pairs, 6))


def fixed_point(edges):
    """The ranks by solving the linear system."""
    ids = sorted({v for e in edges for v in e})
    at = {v: i for i, v in enumerate(ids)}
    counts = np.zeros((len(ids), len(ids)))
    for s, d in edges:
        counts[at[s], at[d]] += 1
    out = counts.sum(axis=1, keepdims=True)
    shares = np.divide(counts, out, out=np.zeros_like(counts), where=out > 0)
    return dict(zip(ids, np.linalg.solve(np.eye(len(ids)) - 0.85 * shares.T, np.full(len(ids), 0.15)), strict=True))


def rank_graphs():
    dice = random.Random(9)
    yield [(dice.randrange(200), dice.randrange(200)) for _ in range(900)]
    yield [(i, i - i % 10 + (i * 7 + 1) % 10) for i in range(300)] + [(i, 0) for i in range(0, 300, 3)] + [(5, i) for i in range(300)] * 2
    yield [(i, i + 1) for i in range(30)] + [(i, i) for i in range(5)] + [(-(2**40) * i, 2**41 * (i % 7)) for i in range(1, 40)]


@pytest.mark.parametrize("edges", list(rank_graphs()))
@pytest.mark.parametrize("block_edges, tol", [(1_000_000, 1e-10), (60, 1e-3)])
def test_residual_ranks_are_as_close_as_told(plain, scratch, edges, block_edges, tol):
    """Also in many small blocks and with hub sources; the bound holds at a coarse tolerance too."""
    frame = plain.createDataFrame(edges, "src bigint, dst bigint")
    found = {r.id: r.rank for r in rank.page_rank(frame, scratch, tol=tol, block_edges=block_edges).collect()}
    want = fixed_point(edges)
    assert found.keys() == want.keys()
    assert all(abs(found[v] - want[v]) <= tol * want[v] + 1e-13 for v in want)


def test_hub_edges_are_in_no_block(plain, scratch):
    edges = plain.createDataFrame([(5, d) for d in range(60)] + [(s, (s * 7) % 60) for s in range(60)], "src bigint, dst bigint")
    layouts, hub_edges, cuts, hubs = rank._laid_out(edges, scratch, 10)
    assert hubs == [5] and hub_edges.count() == 60 and not set(cuts[0]) & set(cuts[1])
    for packed in layouts:
        rows = packed.collect()
        assert len(rows) > 5 and sum(len(r.share) for r in rows) == 8 * 59 and sum(len(r.ids) for r in rows) == 8 * 60


def test_settling_keeps_what_is_handed_on():
    src, dst, share = np.array([0, 0, 1, 2]), np.array([1, 3, 2, 0]), np.array([0.5, 0.5, 1.0, 1.0])
    held = np.full(3, 0.15)
    handed, sent = rank.settle(3, src, dst, share, held, 1e-15, 0.85)
    want = fixed_point([(0, 1), (0, 3), (1, 2), (2, 0)])
    assert handed == pytest.approx([want[v] for v in range(3)]) and sent == pytest.approx([want[3] - 0.15])
    assert held.max() <= 1e-15


def test_least_weights():
    vectors = np.random.default_rng(1).standard_normal((4, 50))
    weights = np.array(rank.least_weights(vectors @ vectors.T))
    assert weights.sum() == pytest.approx(1)
    for other in np.eye(4):
        assert np.linalg.norm(weights @ vectors) <= np.linalg.norm(other @ vectors) + 1e-12
    same = np.ones((3, 50))
    assert np.isfinite(rank.least_weights(same @ same.T)).all()
    assert rank.least_weights(np.zeros((3, 3)))[-1] == 1


def test_page_rank_needs_an_end(graph, scratch):
    with pytest.raises(ValueError):
        rank.page_rank(graph.edges, scratch, tol=None)


@pytest.mark.parametrize(
    "order, neighbours, ids, edges",
    [
        ("asc", {"C": "D", "A": "B"}, "ABCD", ["AB", "AB", "AC", "BC", "CA", "DC"]),
        ("desc", {"C": "A", "A": "C"}, "AC", ["AC", "CA"]),
    ],
)
def test_top_neighbourhood(graph, ranks, scratch, order, neighbours, ids, edges):
    ranked = rank.labelled_ranks(ranks, graph.vertices)
    top = rank.top_ranked(ranked, 2)
    assert [r.label for r in top.collect()] == ["C", "A"]
    name = {r.id: r.label for r in graph.vertices.collect()}
    found = rank.top_neighbours(graph.edges, ranked, top, 1, order).collect()
    assert {name[r.id]: r.label for r in found} == neighbours
    two = scratch.keep(rank.neighbourhood_ids(rank.top_neighbours(graph.edges, ranked, top, 1, order)), "two")
    assert "".join(sorted(name[r.id] for r in two.collect())) == ids
    assert labelled(graph, g.induced_subgraph(graph, two).edges) == edges


def test_best_ranked_graph(graph):
    """With more places than vertices, all vertices with neighbours are among the best."""
    best = mining.best_ranked_graph(graph, tol=None, max_iter=2)
    assert best.edges.columns == ["from", "to"] and best.edges.count() == 7
    assert {r.label for r in best.vertices.collect()} == set("ABCDEF")


def test_parallel_edges_take_places(graph, ranks):
    ranked = rank.labelled_ranks(ranks, graph.vertices)
    top = rank.top_ranked(ranked, 2)
    found = rank.top_neighbours(graph.edges, ranked, top, 3).filter("label <> 'D'")
    name = {r.id: r.label for r in graph.vertices.collect()}
    places = sorted((name[r.id], r.place, r.label) for r in found.collect())
    assert places == [("A", 1, "B"), ("A", 2, "B"), ("A", 3, "C"), ("C", 2, "B"), ("C", 3, "A")]


def test_neighbour_limit_comes_before_the_shuffle(graph, ranks):
    ranked = rank.labelled_ranks(ranks, graph.vertices)
    text = plan(rank.top_neighbours(graph.edges, ranked, rank.top_ranked(ranked)))
    assert "WindowGroupLimit" in text


def union_find(edges):
    parent = {v: v for e in edges for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {v: root(v) for v in parent}


def some_graphs():
    yield [(i, i + 1) for i in range(40)]
    yield [(40 - i, 39 - i) for i in range(40)] + [(50, 50)]
    yield [(99, i) for i in range(60)] + [(i, i + 1) for i in range(60, 70, 2)]
    dice = random.Random(7)
    yield [(dice.randrange(80), dice.randrange(80)) for _ in range(60)]


@pytest.mark.parametrize("edges", list(some_graphs()))
def test_components(spark, scratch, edges):
    frame = spark.createDataFrame(edges, "src bigint, dst bigint")
    found = connected_components(frame, scratch)
    assert {r.id: r.component for r in found.collect()} == union_find(edges)
    assert community_count(found).first()[0] == len(set(union_find(edges).values()))


def test_components_ignore_direction(graph, scratch):
    back = graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    one = connected_components(graph.edges, scratch).collect()
    other = connected_components(back, scratch).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
    assert len({r.component for r in one}) == 2


@pytest.fixture
def people(spark):
    vertices = spark.createDataFrame(
        [(1, "Ada", "student"), (2, "Bo", "student"), (3, "Cy", "prof"), (4, "Di", "phd-student")],
        "id bigint, name string, role string",
    )
    edges = spark.createDataFrame(
        [(1, 2, "collab"), (3, 1, "teach"), (3, 2, "teach"), (3, 4, "supervise"), (4, 9, "knows")],
        "src bigint, dst bigint, attr string",
    )
    return g.Graph(vertices, edges)


def test_property_graph(people):
    assert g.triplets(people).count() == 5
    assert g.triplets(people).filter("dst_name is null").first().dst == 9
    whole = g.with_default_vertices(people, name="DEFAULT_USER", role="MISSING")
    assert whole.vertices.count() == 5
    last = g.triplets(whole).filter("dst = 9").first()
    assert (last.dst_name, last.dst_role, last.attr) == ("DEFAULT_USER", "MISSING", "knows")
    lines = g.incident_triplets(whole, F.col("name") == "Ada").select(
        g.describe_triplet("src_name", "attr", "dst_name").alias("line")
    )
    assert {r.line for r in lines.collect()} == {"Ada--(collab)--Bo", "Cy--(teach)--Ada"}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_look_up_splits_hot_keys(plain, how):
    """A third of the rows share one key, many of them being copies of one row."""
    rows = plain.range(0, 3000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS key", "id % 2 AS value"
    )
    table = plain.createDataFrame([(-1, "hot"), (1, "one"), (2, "two")], "key bigint, name string")
    found = skew.look_up(rows, table, "key", how)
    want = rows.join(table, "key", how)
    assert found.exceptAll(want.select(found.columns)).isEmpty()
    assert found.count() == want.count()
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(counts, "key", "n", 8)
    assert [tuple(r) for r in hot.collect()] == [(-1, 3)]
    assert skew.hot_keys(counts.filter("key > 0"), "key", "n", 8) is None
    assert skew.hot_keys(counts.filter("key < -1"), "key", "n", 8) is None
    salted = skew.salt_rows(rows, "key", hot, ["value"]).filter("key = -1")
    shares = [r["count"] for r in salted.groupBy(skew.SALT).count().collect()]
    assert len(shares) == 3 and max(shares) < 600


def test_hub_names_are_encoded_whole(plain, scratch):
    links = plain.range(900).selectExpr(
        "concat('p', id) AS src", "CASE WHEN id % 3 = 0 THEN 'hub' ELSE concat('p', id % 50) END AS dst"
    )
    links = links.union(plain.createDataFrame([("p1", "hub")] * 200, "src string, dst string"))
    built = g.build_graph(links, scratch)
    named = g.triplets(built).select(F.col("src_label").alias("src"), F.col("dst_label").alias("dst"))
    assert named.exceptAll(links).isEmpty() and links.exceptAll(named).isEmpty()


def test_edges_are_not_shuffled_in_a_round(plain, scratch, graph, monkeypatch):
    """The kept edges meet the ranks without an exchange of their own."""
    plans = []
    keep = type(scratch).keep

    def noted(self, df, name):
        plans.append((name, plan(df)))
        return keep(self, df, name)

    monkeypatch.setattr(type(scratch), "keep", noted)
    rank.page_rank(graph.edges, scratch, tol=None, max_iter=1)
    text = dict(plans)["ranks"]
    scan = text.index("InMemoryTableScan")
    join = text.rindex("SortMergeJoin", 0, scan)
    assert "Exchange" not in text[join:scan] and "Sort " not in text[join:scan]


def test_blocks_are_not_shuffled_in_a_round(plain, scratch, graph, monkeypatch):
    plans = []
    keep = type(scratch).keep

    def noted(self, df, name):
        plans.append((name, plan(df)))
        return keep(self, df, name)

    monkeypatch.setattr(type(scratch), "keep", noted)
    rank.page_rank(graph.edges, scratch, max_iter=2)
    text = dict(plans)["mail"]
    join = text.index("SortMergeJoin")
    assert "Exchange" not in text[join : text.index("InMemoryTableScan", join)]


def test_results_of_one_scratch_stay_readable(spark, links):
    """Later graphs, ranks and components leave earlier ones alone; closing deletes them all."""
    with Scratch(spark) as scratch:
        graphs = [g.build_graph(x, scratch) for x in (links, links.filter("src <> 'E'"))]
        ranks = [rank.page_rank(x.edges, scratch, max_iter=7) for x in graphs]
        parts = [connected_components(x.edges, scratch) for x in graphs]
        assert [x.vertices.count() for x in graphs] == [6, 4] == [r.count() for r in ranks] == [p.count() for p in parts]
        assert len(os.listdir(scratch.path)) > 0
    assert not os.path.exists(scratch.path)
