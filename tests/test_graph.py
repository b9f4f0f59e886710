import random

from pyspark.sql import functions as F

from adlumen.operators import graph
from adlumen.operators.graph import (
    MAX_HOT_NAME_BYTES, component_attributes, component_members, component_sizes,
    connected_components, verify_components,
)


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for v in list(parent):
        comp.setdefault(find(v), []).append(v)
    return {v: min(vs) for vs in comp.values() for v in vs}


def _labels(spark, edges, hot_degree=None):
    df = spark.createDataFrame(edges, "src string, dst string")
    lab = connected_components(df, hot_degree=hot_degree)
    assert verify_components(df, lab) == 0
    return {r.id: r.component for r in lab.collect()}


def test_toy_graph_golden(spark):
    pairs = [(1, 133), (2, 133), (6, 133), (9, 133), (6, 138), (21, 138), (16, 138),
             (44, 138), (5, 158), (7, 158)]
    # zero-padded ids so string order equals numeric order
    edges = [(f"{a:04d}", f"{b:04d}") for a, b in pairs]
    got = _labels(spark, edges)
    groups = {}
    for v, c in got.items():
        groups.setdefault(c, set()).add(int(v))
    assert groups == {"0001": {1, 2, 6, 9, 16, 21, 44, 133, 138}, "0005": {5, 7, 158}}


def test_random_graph_matches_union_find(spark):
    rnd = random.Random(11)
    nodes = [f"n{i:05d}" for i in range(600)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(450)]
    edges += [(n, n) for n in nodes[:40]]  # self loops: isolated vertices
    assert _labels(spark, edges) == _union_find(edges)


def test_invariant_to_direction_order_duplicates(spark):
    rnd = random.Random(5)
    nodes = [f"v{i:03d}" for i in range(120)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(100)]
    base = _labels(spark, edges)
    flipped = [(b, a) for a, b in edges] + edges[:30]
    rnd.shuffle(flipped)
    assert _labels(spark, flipped) == base


def test_skewed_hub_and_long_path(spark):
    """One hub holds a third of the edges; a 300-node path has a large diameter."""
    hub = [("h0000", f"h{i:04d}") for i in range(1, 1500)]
    path = [(f"p{i:04d}", f"p{i + 1:04d}") for i in range(300)]
    rnd = random.Random(2)
    rnd.shuffle(path)
    other = [(f"x{rnd.randint(0, 2000):05d}", f"x{rnd.randint(0, 2000):05d}") for _ in range(1500)]
    edges = hub + path + other
    expected = _union_find(edges)
    assert _labels(spark, edges) == expected
    # force the hot-vertex split: the hub (and a few more) are joined map-side
    assert _labels(spark, edges, hot_degree=50) == expected


def test_members_and_sizes(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "src string, dst string")
    lab = connected_components(df)
    members = sorted(tuple(r) for r in component_members(lab).collect())
    assert members == [("a", "a"), ("a", "b"), ("a", "c"), ("d", "d"), ("d", "e")]
    assert dict(component_sizes(lab).collect()) == {"a": 3, "d": 2}


def test_hot_names_too_long_to_broadcast(spark):
    """Hubs on both sides of the edges; one has a name beyond the broadcast bound."""
    long = "z" * (MAX_HOT_NAME_BYTES + 1)
    edges = [(long, f"a{i:03d}") for i in range(60)] + [(f"b{i:03d}", "hub") for i in range(60)]
    assert _labels(spark, edges, hot_degree=20) == _union_find(edges)


def test_attributes_of_members(spark):
    labels = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "id string, component string")
    names = spark.createDataFrame([("a", "A", 1), ("b", None, 2), ("x", "X", 3)], "id string, name string, n int")
    got = component_attributes(labels, names)
    assert got.columns == ["component", "member", "name", "n"]
    assert {tuple(r) for r in got.collect()} == {("a", "a", "A", 1), ("a", "b", None, 2), ("c", "c", None, None)}


def test_contracted_graph_has_the_same_labels(spark, monkeypatch):
    """A hub, a long chain, single ids and random edges, contracted before any star and unfolded again."""
    rnd = random.Random(7)
    edges = [("hub", f"h{i:04d}") for i in range(400)] + [(f"c{i}", f"c{i + 1}") for i in range(400)]
    edges += [(f"s{i}", f"s{i}") for i in range(50)]
    edges += [(f"r{rnd.randint(0, 400)}", f"r{rnd.randint(0, 400)}") for _ in range(300)]
    expected = _union_find(edges)
    for star_edges, hot_degree in ((20, None), (0, 50)):
        monkeypatch.setattr(graph, "STAR_EDGES", star_edges)
        assert _labels(spark, edges, hot_degree=hot_degree) == expected


def test_contraction_halves_a_chain(spark):
    """A round leaves about half of the edges, so the rounds cost about two of the first, not each as much."""
    e = spark.range(2000).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    once = graph._contract(e, graph._nearest(e, 0), None)
    assert once.count() < 1200


def test_ids_that_share_a_hash_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(graph, "hash_vertex", lambda c: F.pmod(F.xxhash64(c), F.lit(5)))
    edges = [("a", "b"), ("b", "c"), ("d", "e"), ("f", "f"), ("g", "h"), ("h", "a")]
    assert _labels(spark, edges) == _union_find(edges)
