"""Connected components on DataFrames (contraction, then alternating large-star / small-star).

A large graph is contracted first: every vertex moves to the one of itself and
its neighbours that a hash puts first, which leaves about half of the vertices
of a chain and fewer of a denser graph, so that all rounds together cost about
as much as two of the first (Boegeholz et al., "In-database connected component
analysis", ICDE 2020).  What is left is small and goes through alternating stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014):
each round is a few group-by-min aggregates and equi-joins over the edge
list, the number of rounds grows with log(n) rather than with the graph
diameter, and a hub vertex is handled by a per-vertex ``min`` (partial
aggregation) instead of collecting its neighbours, so a vertex holding a
third of all edges does not end up in one task's memory.  The join of the
edges with those per-vertex minima is split (``_split_hot_join``): hub
vertices are joined map-side against a broadcast bounded by construction,
the rest by a shuffle join that never sees a hub.

Vertex ids are strings.  They become longs first, so the rounds shuffle 8-byte
keys: hashes, which need no join, if no two ids of the graph share one, else
numbers.  The component label is the smallest member id, an aggregate at the
end.  Every round is cut from its lineage by writing it as a Parquet table into
the cluster's checkpoint folder, so a lost executor only recomputes part of one
round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.operators.lookup import lookup_join
from adlumen.session import drop_materialized, materialize

# Vertices with more incident edges than this are joined map-side (see
# _split_hot_join); the threshold is raised with the edge count so that at
# most MAX_HOT_KEYS vertices are ever broadcast.
HOT_DEGREE_MIN = 100_000
MAX_HOT_KEYS = 1_000_000
# The same for joins that broadcast id strings: fewer keys, none longer than this.
MAX_HOT_NAMES = 100_000
MAX_HOT_NAME_BYTES = 256
# A graph is contracted until it has no more edges than this.
STAR_EDGES = 250_000


def _split_hot_join(pairs: DataFrame, stats: DataFrame, hot_degree: int | None) -> DataFrame:
    """``pairs(u, v) JOIN stats(u, m, deg) ON u`` without a hot shuffle partition.

    Vertices with more than ``hot_degree`` pairs are joined map-side against
    a broadcast of just their ``(u, m)`` rows -- at most |pairs| / hot_degree
    rows, so the broadcast is bounded by construction; all other pairs go
    through an ordinary shuffle join, from which the hot keys are removed
    first (a broadcast anti join), so no reducer receives a hub's pairs.
    ``hot_degree=None`` means no vertex can be hot: a plain join.
    """
    if hot_degree is None:
        return pairs.join(stats.select("u", "m"), "u")
    hot = stats.where(F.col("deg") > hot_degree).select("u", "m")
    cold = stats.where(F.col("deg") <= hot_degree).select("u", "m")
    hot_part = pairs.join(F.broadcast(hot), "u")
    cold_pairs = pairs.join(F.broadcast(hot.select("u")), "u", "left_anti")
    return hot_part.unionByName(cold_pairs.join(cold, "u"))


def _large_star(e: DataFrame, hot_degree: int | None) -> DataFrame:
    sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    stats = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                 F.count(F.lit(1)).alias("deg"))
    out = _split_hot_join(sym, stats, hot_degree).where(F.col("v") > F.col("u"))
    # no distinct here: the output has at most |E| rows and small-star dedupes
    return out.select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame, hot_degree: int | None) -> DataFrame:
    o = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        F.col("u") != F.col("v"))
    stats = o.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("deg"))
    to_min = _split_hot_join(o, stats, hot_degree).select(
        F.col("v").alias("a"), F.col("m").alias("b"))
    hub = stats.select(F.col("u").alias("a"), F.col("m").alias("b"))
    out = to_min.unionByName(hub).where(F.col("a") != F.col("b"))
    return out.distinct()


def _hot_degree(n_edges: int, hot_degree: int | None, max_keys: int = MAX_HOT_KEYS) -> int | None:
    """Degree above which a vertex is joined map-side, or None when no vertex
    can reach it (a vertex has at most ``n_edges`` incident edges)."""
    if hot_degree is None:
        # keys above the threshold number at most 2 * n_edges / threshold
        hot_degree = max(HOT_DEGREE_MIN, -(-2 * n_edges // max_keys))
    return hot_degree if n_edges > hot_degree else None


def _with_names(pairs: DataFrame, key: str, names: DataFrame, out: str, name: str,
                hot: int | None) -> DataFrame:
    """``pairs JOIN names(u, m)`` on ``key`` = u, m as ``out``, hot keys split off.

    ``name`` is the string column of ``names`` (u or m): a key with a longer
    one than ``MAX_HOT_NAME_BYTES`` is left to the shuffle join, so that the
    number of hot keys also bounds the bytes that are broadcast.
    """
    keyed = pairs.withColumnRenamed(key, "u")
    if hot is not None:
        degrees = keyed.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        short = F.octet_length(name) <= MAX_HOT_NAME_BYTES
        names = names.join(degrees, "u").select(
            "u", "m", F.when(short, F.col("n")).otherwise(F.lit(0)).alias("deg"))
    return _split_hot_join(keyed, names, hot).drop("u").withColumnRenamed("m", out)


def _fingerprint_metrics():
    return [F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")]


def hash_vertex(id: Column) -> Column:
    return F.xxhash64(id)


def _vertex_ids(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct vertex ids (partial aggregation collapses a hub's many copies map-side)."""
    ids = edges.select(F.col(src).alias("id")).unionByName(edges.select(F.col(dst).alias("id")))
    return ids.where(F.col("id").isNotNull()).distinct()


def number_vertices(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct vertex ids -> ``(id, vid)`` with vid increasing in id order."""
    # range-partition so that ids increase across and within partitions
    ranged = _vertex_ids(edges, src, dst).repartitionByRange("id").sortWithinPartitions("id")
    return ranged.withColumn("vid", F.monotonically_increasing_id())


def _long_edges(edges: DataFrame, n_edges: int, hot_degree: int | None) -> tuple[DataFrame, DataFrame, str, int]:
    """Edges ``(src, dst)`` of strings -> edges ``(a, b)`` of longs, the vertices
    ``(id, vid)`` as a table, its path and its number of rows."""
    count = [F.count(F.lit(1)).alias("n")]
    hashed = _vertex_ids(edges, "src", "dst").withColumn("vid", hash_vertex(F.col("id")))
    v, path, seen = materialize(hashed, "cc-vertices", count)
    if v.groupBy("vid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty():
        return edges.select(hash_vertex(F.col("src")).alias("a"), hash_vertex(F.col("dst")).alias("b")), v, path, seen["n"]
    drop_materialized(edges.sparkSession, path)
    v, path, seen = materialize(number_vertices(edges), "cc-vertices", count)
    hot = _hot_degree(n_edges, hot_degree, MAX_HOT_NAMES)
    numbers = v.select(F.col("id").alias("u"), F.col("vid").alias("m"))
    e = _with_names(edges, "src", numbers, "a", "u", hot)
    return _with_names(e, "dst", numbers, "b", "u", hot).select("a", "b"), v, path, seen["n"]


def _nearest(e: DataFrame, turn: int) -> DataFrame:
    """``(u, m, deg)``: m is the one of vertex u and its neighbours whose hash is
    least; the hash is another in every ``turn``."""
    def rank(c):
        return F.xxhash64(F.lit(turn), F.col(c))

    sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v"))).withColumn("h", rank("v"))
    best = sym.groupBy("u").agg(F.min_by("v", "h").alias("v"), F.min("h").alias("h"), F.count(F.lit(1)).alias("deg"))
    return best.select("u", F.when(rank("u") <= F.col("h"), F.col("u")).otherwise(F.col("v")).alias("m"), "deg")


def _contract(e: DataFrame, nearest: DataFrame, hot_degree: int | None) -> DataFrame:
    """The edges between those that the ends moved to; an edge within one is gone."""
    moved = _split_hot_join(e.select(F.col("a").alias("u"), F.col("b").alias("v")), nearest, hot_degree)
    moved = _split_hot_join(moved.select(F.col("v").alias("u"), F.col("m").alias("v")), nearest, hot_degree)
    return moved.where(F.col("v") != F.col("m")).select(
        F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b")).distinct()


def _unfold(nearest: DataFrame, labels: DataFrame, hot_degree: int | None) -> DataFrame:
    """Labels ``(vid, cid)`` of a contracted graph -> labels of the graph before."""
    to = nearest.groupBy("m").agg(F.count(F.lit(1)).alias("deg")).join(labels, F.col("m") == labels["vid"], "left")
    to = to.select(F.col("m").alias("u"), F.coalesce("cid", "m").alias("m"), "deg")
    return _split_hot_join(nearest.select(F.col("m").alias("u"), F.col("u").alias("vid")), to, hot_degree).select(
        "vid", F.col("m").alias("cid"))


def connected_components_long(e: DataFrame, hot_degree: int | None = None, *,
                              star_edges: int | None = None) -> tuple[DataFrame, str]:
    """Edges ``(a, b)`` of longs -> ``(vid, cid)``, cid = one vid of the
    component, plus the path of the table which the lazy result reads.
    Vertices without a row (those in self loops only, and a component's cid
    unless the graph was contracted) have their own vid as cid.

    Each round's edge list is written as a table in the checkpoint folder;
    its (count, hash sum) is observed during that write.  The graph is
    contracted while it has more than ``star_edges`` edges; then the loop of
    stars stops when a round reproduces the previous edge set.
    """
    spark = e.sparkSession
    star_edges = STAR_EDGES if star_edges is None else star_edges
    e = e.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, path, prev = materialize(e, "cc-edges", _fingerprint_metrics())
    folds = []
    while prev["n"] > star_edges:
        hot = _hot_degree(prev["n"], hot_degree)
        # read by both joins and by _unfold: a table, not a plan
        nearest, nearest_path, _ = materialize(_nearest(e, len(folds)), "cc-nearest")
        e, nxt_path, prev = materialize(_contract(e, nearest, hot), "cc-contracted", _fingerprint_metrics())
        drop_materialized(spark, path)
        path = nxt_path
        folds.append((nearest, nearest_path, hot))
    while True:
        hot = _hot_degree(prev["n"], hot_degree)
        # small-star reads its input twice (minima and join): a table, not a plan
        large, large_path, _ = materialize(_large_star(e, hot), "cc-large")
        nxt, nxt_path, cur = materialize(_small_star(large, hot), "cc-round", _fingerprint_metrics())
        drop_materialized(spark, path)
        drop_materialized(spark, large_path)
        e, path = nxt, nxt_path
        if cur == prev:
            break
        prev = cur
    # converged: a forest of stars, each edge (leaf, centre) with the centre
    # the component's smallest vertex -- every leaf has exactly one edge, which
    # is its label; centres (and vertices without edges) label themselves
    labels = e.select(F.col("a").alias("vid"), F.col("b").alias("cid"))
    for nearest, nearest_path, hot in reversed(folds):
        labels, labels_path, _ = materialize(_unfold(nearest, labels, hot), "cc-unfolded")
        drop_materialized(spark, path)
        drop_materialized(spark, nearest_path)
        path = labels_path
    return labels, path


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", *,
                         hot_degree: int | None = None) -> DataFrame:
    """Undirected edges of string ids -> ``(id, component)``.

    ``component`` is the smallest id of the component; every endpoint (also
    of self loops) gets a row.  The result is returned as a table written in
    the session's checkpoint folder (it is typically read more than once);
    the intermediate tables are deleted.
    """
    spark = edges.sparkSession
    # materialise the edge list once: it usually comes from a full log scan and
    # is read twice below (vertices, translation)
    edges, edges_path, seen = materialize(
        edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where(
            F.col("src").isNotNull() & F.col("dst").isNotNull()), "cc-input", [F.count(F.lit(1)).alias("n")])
    e, v, v_path, n_vertices = _long_edges(edges, seen["n"], hot_degree)
    labels, last_path = connected_components_long(e, hot_degree)
    lab = v.join(labels, "vid", "left").select("id", F.coalesce(F.col("cid"), F.col("vid")).alias("u"))
    lab, lab_path, _ = materialize(lab, "cc-members")
    # a name longer than MAX_HOT_NAME_BYTES is left to the shuffle join, so that
    # the number of hot keys also bounds the bytes that are broadcast
    names = lab.groupBy("u").agg(F.min("id").alias("m"), F.count(F.lit(1)).alias("n"))
    short = F.octet_length("m") <= MAX_HOT_NAME_BYTES
    names, names_path, _ = materialize(
        names.select("u", "m", F.when(short, F.col("n")).otherwise(F.lit(0)).alias("deg")), "cc-names")
    named = _split_hot_join(lab, names, _hot_degree(n_vertices, hot_degree, MAX_HOT_NAMES))
    out, _, _ = materialize(named.select("id", F.col("m").alias("component")), "cc-labels")
    for path in (edges_path, v_path, last_path, lab_path, names_path):
        drop_materialized(spark, path)
    return out


def update_components(labels: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst", *,
                      hot_degree: int | None = None) -> DataFrame:
    """Components of a graph that has grown: ``labels`` (id, component) of the old
    graph and the new ``edges`` -> ``(id, component)`` of both together.

    Contraction: each end of a new edge is replaced by its old label (an id not
    seen before by itself), so old components become single vertices and only
    those that new edges touch take part in the rounds.  A label is its
    component's smallest id, hence the smallest label of a merged component is
    its smallest id.  Old labels are then renamed by a lookup join, whose hot
    keys (a component with a large share of all ids) are not shuffled.
    """
    spark = edges.sparkSession
    edges, edges_path, _ = materialize(
        edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where(
            F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct(), "new-edges")
    ids = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()
    old = labels.select(F.col("id").alias("__id"), F.col("component").alias("label"))
    ends, ends_path, _ = materialize(
        ids.join(old, ids["id"] == old["__id"], "left").select(
            "id", F.coalesce("label", "id").alias("label"), F.col("label").isNotNull().alias("known")), "ends")
    at = ends.select(F.col("id").alias("__end"), "label")
    contracted = lookup_join(edges, at, "src", "__end", "inner").select("dst", F.col("label").alias("a"))
    contracted = lookup_join(contracted, at, "dst", "__end", "inner").select("a", F.col("label").alias("b")).distinct()
    merged = connected_components(contracted, "a", "b", hot_degree=hot_degree)
    to = merged.select(F.col("id").alias("__from"), F.col("component").alias("to"))
    renamed = lookup_join(labels.select("id", "component"), to, "component", "__from").select(
        "id", F.coalesce("to", "component").alias("component"))
    fresh = ends.where(~F.col("known")).select("id").join(merged, "id").select("id", "component")
    out, _, _ = materialize(renamed.unionByName(fresh), "cc-labels")
    for path in (edges_path, ends_path):
        drop_materialized(spark, path)
    return out


def verify_components(edges: DataFrame, labels: DataFrame, src: str = "src",
                      dst: str = "dst") -> int:
    """Number of edges whose endpoints got different labels (0 when right)."""
    la = labels.select(F.col("id").alias("__s"), F.col("component").alias("__ls"))
    lb = labels.select(F.col("id").alias("__d"), F.col("component").alias("__ld"))
    j = (edges.select(F.col(src).alias("__s"), F.col(dst).alias("__d"))
              .join(la, "__s").join(lb, "__d"))
    return j.where(F.col("__ls") != F.col("__ld")).count()


def component_members(labels: DataFrame) -> DataFrame:
    """Members per component in long form ``(component, member)``.

    Long form on purpose: a component may hold a large share of all ids, and
    one array per component would put it in a single task and row.
    """
    return labels.select("component", F.col("id").alias("member"))


def component_attributes(labels: DataFrame, attributes: DataFrame, id: str = "id") -> DataFrame:
    """Members with their own attributes, ``(component, member, <attributes>)``.

    ``attributes`` has a column ``id`` and any others; a member without a row
    there has nulls, one with several rows has several.  Long form, as in
    ``component_members``.
    """
    named = attributes.withColumnRenamed(id, "member")
    return component_members(labels).join(named, "member", "left").select(
        "component", "member", *[c for c in named.columns if c != "member"])


def component_sizes(labels: DataFrame) -> DataFrame:
    """``(component, n_members)``."""
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("n_members"))
