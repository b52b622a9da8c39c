"""Distance joins, components, clusters and graph operators against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from wardscope.operators import graph, spatial


def km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1)))


@pytest.mark.parametrize(("lat", "lng", "spread", "radius"), [
    (41.8, -87.7, 0.1, 3.0), (0.0, 180.0, 0.2, 9.0), (-78.0, -179.95, 0.3, 8.0), (89.5, 0.0, 0.4, 20.0), (60.0, 10.0, 30.0, 9000.0)])
def test_haversine_edges(spark, lat, lng, spread, radius):
    r = random.Random(3)
    points = {f"p{i}": (max(-90, min(90, lat + r.uniform(-spread, spread))),
                        (lng + r.uniform(-spread, spread) * (1 if abs(lat) < 85 else 400) + 180) % 360 - 180) for i in range(60)}
    df = spark.createDataFrame([(k, *v) for k, v in points.items()], "k string, lat double, lng double")
    found = {(e.src, e.dst) for e in spatial.haversine_edges(df, "k", "lat", "lng", radius).collect()}
    wanted = {(a, b) for a in points for b in points if a != b and km(points[a], points[b]) <= radius}
    assert found == wanted and wanted


def test_edges_come_once(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 100.0)], "k string, lat double, lng double")
    assert spatial.haversine_edges(df, "k", "lat", "lng", 15000.0).count() == 2


def test_chain_when_nothing_is_near(spark):
    df = spark.createDataFrame([("b", 1, 0.0, 0.0), ("a", 2, 5.0, 5.0), ("c", 3, 9.0, 9.0)],
                               "k string, t int, Lat_Bin double, Lng_Bin double")
    edges = spatial.proximity_edges(df, "k", ["t"])
    assert sorted((e.src, e.dst) for e in edges.collect()) == [("a", "b"), ("b", "c")]
    near = df.withColumn("Lat_Bin", F.lit(1.0)).withColumn("Lng_Bin", F.lit(1.0))
    assert spatial.proximity_edges(near, "k", ["t"]).count() == 6


def test_components_of_a_long_chain(spark):
    nodes = spark.range(60).select(F.col("id").alias("n"))
    edges = nodes.filter("n % 20 <> 19").select((F.col("n") + 1).alias("src"), F.col("n").alias("dst"))
    found = {r.n: r.label for r in spatial.connected_components(nodes, edges, "n").collect()}
    assert found == {n: n // 20 * 20 for n in range(60)}


def brute_dbscan(points, eps, need):
    """Clusters of weighted points by flood fill from the least core point."""
    near = {i: [j for j, q in enumerate(points) if math.dist(p[:2], q[:2]) <= eps] for i, p in enumerate(points)}
    core = {i for i in near if sum(points[j][2] for j in near[i]) >= need}
    labels, number = {}, 0
    for i in sorted(core):
        if i in labels:
            continue
        stack, labels[i] = [i], number
        while stack:
            for j in near[stack.pop()]:
                if j in core and j not in labels:
                    labels[j] = number
                    stack.append(j)
        number += 1
    for i in set(near) - core:
        touched = [labels[j] for j in near[i] if j in core]
        labels[i] = min(touched) if touched else -1
    return labels


@pytest.mark.parametrize(("seed", "eps", "need"), [(1, 0.3, 4), (2, 0.15, 3), (5, 0.5, 12)])
def test_dbscan(spark, seed, eps, need):
    r = random.Random(seed)
    centres = [(r.uniform(-3, 3), r.uniform(-3, 3)) for _ in range(5)]
    points = []
    for _ in range(150):
        x, y = r.choice(centres)
        points.append((r.gauss(x, 0.3), r.gauss(y, 0.3), r.choice([1, 1, 1, 3])))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double, weight int")
    found = {row.i: row.c for row in spatial.dbscan(df, "i", "x", "y", eps, need, out="c").collect()}
    assert found == brute_dbscan(points, eps, need)


@pytest.mark.parametrize(("seed", "pairs"), [(1, 1), (2, 1), (3, 30), (4, 4096)])
def test_links_of_cells_by_boxes(spark, seed, pairs):
    """Dense cells whose points lie just within or just beyond eps of each other, and repeated places."""
    r = random.Random(seed)
    eps, side = 1.0, 1.0 / math.sqrt(2)
    points = [(r.choice([0, 1, 2, -2]) * side * 1.2 + r.choice([r.uniform(0, 0.4), 0.1]), r.choice([0, 1.5, -1.1]) + r.uniform(0, 0.3)) for _ in range(400)]
    points += [(0.0, 9.0), (1.0, 9.0), (0.0, 20.0), (math.nextafter(1.0, 2), 20.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double").withColumns(
        {f"c{axis}": F.floor(F.col(axis) / side) for axis in "xy"}).withColumn("cell", F.concat_ws(",", "cx", "cy"))
    cells = {row.i: row.cell for row in df.collect()}
    wanted = {(cells[i], cells[j]) for i, p in enumerate(points) for j, q in enumerate(points)
              if cells[i] < cells[j] and math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) <= eps}
    found = [(e.src, e.dst) for e in spatial._cell_links(df, side, eps, pairs).collect()]
    assert set(found) == wanted and len(found) == len(wanted) and ("0,12", "1,12") in wanted and ("0,28", "1,28") not in wanted


def test_clusters_of_rows(spark):
    rows = [(i, 41.0 + (i % 2), -87.0) for i in range(60)] + [(60, None, -87.0)]
    df = spark.createDataFrame(rows, "id int, Latitude double, Longitude double")
    found = {r.id: r.Spatial_Cluster for r in spatial.spatial_clusters(df, ["id"]).collect()}
    assert found[60] == -1 and found[0] == 0 and found[1] == 1 and len(found) == 61
    assert {r.Spatial_Cluster for r in spatial.spatial_clusters(df.drop("Latitude"), ["id"]).collect()} == {-1}
    few = [r.Spatial_Cluster for r in spatial.spatial_clusters(df, ["id"], sample_n=5).collect()]
    assert set(few) == {-1}


def test_graph_stats(spark):
    nodes = spark.createDataFrame([(n,) for n in "abcd"], "n string")
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 1.0)], "src string, dst string, dist double")
    row = graph.graph_stats(nodes, edges, "n").first()
    assert (row.n_nodes, row.n_edges, row.n_isolates) == (4, 2, 1) and row.density == pytest.approx(4 / 12)


def test_walks_follow_edges(spark):
    pairs = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")]
    edges = spark.createDataFrame([(*p, 1.0) for p in pairs], "src string, dst string, dist double")
    walks = graph.random_walks(edges, 5, 20).collect()
    assert len(walks) == 60 and all(len(w.path) == 5 and w.path[0] == w.start for w in walks)
    assert all(step in pairs for w in walks for step in zip(w.path, w.path[1:]))
    assert sorted(map(str, walks)) == sorted(map(str, graph.random_walks(edges.repartition(3), 5, 20).collect()))
    assert {w.path[1] for w in walks if w.start == "b"} == {"a", "c"}


def test_neighbour_features(spark):
    rows = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 20.0), ("c", 1, 40.0), ("a", 2, 1.0)], "k string, w int, x double")
    edges = spark.createDataFrame([("a", "b", 0.0), ("b", "a", 0.0), ("a", "c", 0.06), ("c", "a", 0.06)],
                                  "src string, dst string, dist double")
    found = {(r.k, r.w): (r.x_hop1, r.x_hop2) for r in graph.neighbor_features(rows, edges, "k", "w", ["x"]).collect()}
    mean = (20 + 0.5 * 40) / 1.5
    assert found[("a", 1)] == pytest.approx((mean, 10.0)) and found[("b", 1)] == pytest.approx((10.0, mean))
    assert found[("a", 2)] == (0.0, 0.0)


def test_a_point_near_the_pole_adds_no_pairs_for_others(spark):
    rows = [(i, 41.0 + i % 50 * 0.1, -88.0 + i // 50 * 0.1) for i in range(500)] + [(999, 89.9999, 10.0)]
    edges = spatial.haversine_edges(spark.createDataFrame(rows, "k int, lat double, lng double"), "k", "lat", "lng", 9.0)
    near = [(a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and abs(a[1] - b[1]) < 0.15 and abs(a[2] - b[2]) < 0.3
            and math.dist((a[1] * 111.195, a[2] * 111.195 * math.cos(math.radians((a[1] + b[1]) / 2))),
                          (b[1] * 111.195, b[2] * 111.195 * math.cos(math.radians((a[1] + b[1]) / 2)))) < 9.0]
    assert {(e.src, e.dst) for e in edges.collect()} == set(near)
