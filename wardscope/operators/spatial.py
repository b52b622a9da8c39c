"""Distance joins on a grid, proximity edges and density clusters."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.operators.aggregates import first_by
from wardscope.operators.prefix import sorted_codes
from wardscope.operators.scaling import standardize
from wardscope.operators.sampling import stable_sample
from wardscope.session import cut_lineage

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    inner = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(inner, F.lit(1.0))))


def _grid_pairs(points: DataFrame, key: str, cell_x: Column, cell_y: Column) -> DataFrame:
    """Ordered pairs of different points from the same or neighbouring cells: an equi-join on the cell."""
    placed = points.withColumns({"_x": cell_x, "_y": cell_y})
    steps = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    spread = placed.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
    spread = spread.withColumns({"_x": F.col("_x") + F.col("_dx"), "_y": F.col("_y") + F.col("_dy")})
    left = spread.select(*(F.col(c).alias(f"a_{c}") for c in points.columns), "_x", "_y")
    right = placed.select(*(F.col(c).alias(f"b_{c}") for c in points.columns), "_x", "_y")
    return left.join(right, ["_x", "_y"]).filter(F.col(f"a_{key}") != F.col(f"b_{key}")).drop("_x", "_y")


def haversine_edges(points: DataFrame, key: str, lat: str, lng: str, km: float) -> DataFrame:
    """Directed edges ``src, dst, dist`` between all points at most ``km`` apart, without loops.

    Points are placed on the unit sphere and meet in the cubes of a grid as wide as the chord of the radius, with the 26
    cubes around: neither poles nor the date line are special, and one far point changes nothing for the others.
    """
    side = 2 * math.sin(min(km / EARTH_KM, math.pi) / 2) * 1.000001
    phi, lam = F.radians(lat), F.radians(lng)
    axes = {"_x": F.cos(phi) * F.cos(lam), "_y": F.cos(phi) * F.sin(lam), "_z": F.sin(phi)}
    placed = points.select(key, lat, lng, *(F.floor(v / side).alias(name) for name, v in axes.items()))
    steps = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    around = F.explode(F.flatten(F.transform(steps, lambda x: F.flatten(F.transform(steps, lambda y: F.transform(
        steps, lambda z: F.struct((F.col("_x") + x).alias("x"), (F.col("_y") + y).alias("y"), (F.col("_z") + z).alias("z"))))))))
    left = placed.select(*(F.col(c).alias(f"a_{c}") for c in (key, lat, lng)), around.alias("_cube"))
    left = left.select("*", *(F.col(f"_cube.{c}").alias(f"_{c}") for c in "xyz")).drop("_cube")
    right = placed.select(*(F.col(c).alias(f"b_{c}") for c in (key, lat, lng)), *axes)
    pairs = left.join(right, [*axes]).filter(F.col(f"a_{key}") != F.col(f"b_{key}"))
    dist = haversine_km(*(F.col(c) for c in (f"a_{lat}", f"a_{lng}", f"b_{lat}", f"b_{lng}")))
    edges = pairs.select(F.col(f"a_{key}").alias("src"), F.col(f"b_{key}").alias("dst"), dist.alias("dist"))
    return edges.filter(F.col("dist") <= km)


def bin_edges(df: DataFrame, key: str, order: Sequence[str], radius: float = 0.06,
              bins: tuple[str, str] = ("Lat_Bin", "Lng_Bin")) -> DataFrame:
    """Directed edges between keys whose first-seen grid bins lie at most ``radius`` degrees apart."""
    first = first_by(df, key, bins, order).dropna(subset=list(bins))
    cell_x, cell_y = (F.floor(F.col(name) / (radius * 1.000001)) for name in bins)
    pairs = _grid_pairs(first, key, cell_x, cell_y)
    lat, lng = ((F.col(f"a_{name}") - F.col(f"b_{name}")) for name in bins)
    dist = F.sqrt(lat * lat + lng * lng)
    edges = pairs.select(F.col(f"a_{key}").alias("src"), F.col(f"b_{key}").alias("dst"), dist.alias("dist"))
    return edges.filter(F.col("dist") <= radius)


def chain_edges(df: DataFrame, key: str) -> DataFrame:
    """Edge from each key to the next one in sorted order."""
    codes = sorted_codes(df, key, "_code")
    following = codes.select(F.col(key).alias("dst"), (F.col("_code") - 1).alias("_code"))
    return codes.join(following, "_code").select(F.col(key).alias("src"), "dst", F.lit(0.0).alias("dist"))


def proximity_edges(df: DataFrame, key: str, order: Sequence[str], radius: float = 0.06,
                    bins: tuple[str, str] = ("Lat_Bin", "Lng_Bin")) -> DataFrame:
    """Bin edges, or the chain when the bins are absent or no two keys are near each other."""
    if set(bins) <= set(df.columns):
        edges = bin_edges(df, key, order, radius, bins)
        if not edges.isEmpty():
            return edges
    return chain_edges(df, key)


def connected_components(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """Least node id of the component of each node.

    Labels move along the edges and then jump to the label of their label, so the rounds grow with the
    logarithm of the longest path. Each round is cut by a checkpoint and joins only changed state.
    """
    labels = cut_lineage(nodes.select(node, F.col(node).alias("label")).distinct())
    both = cut_lineage(edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    while True:
        offered = both.join(labels, both["dst"] == labels[node]).groupBy("src").agg(F.min("label").alias("offer"))
        moved = labels.join(offered, labels[node] == offered["src"], "left").select(
            node, F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        targets = moved.select(F.col(node).alias("label"), F.col("label").alias("next"))
        moved = cut_lineage(moved.join(targets, "label", "left").select(
            node, "old", F.least("label", "next").alias("label")))
        if moved.filter("old <> label").isEmpty():
            return moved.select(node, "label")
        labels = moved.select(node, "label")


def dbscan(points: DataFrame, key: str, x: str, y: str, eps: float, min_samples: int, weight: str = "weight",
           out: str = "Spatial_Cluster") -> DataFrame:
    """Density clusters of weighted points: ``key`` and cluster number, −1 for noise.

    The grid has cells of side eps/√2, so points of one cell are all within eps of each other. A cell whose
    weight reaches ``min_samples`` is core as a whole without comparing its points; only points of lighter
    cells, fewer than ``min_samples`` of them each, are compared with the cells around. Components are built
    over cells, whose links come from ever finer boxes (``_cell_links``). Clusters are numbered by their least
    core key; a border point takes the least cluster it touches.
    """
    side = eps / math.sqrt(2)
    placed = points.select(key, F.col(x).alias("x"), F.col(y).alias("y"), F.col(weight).alias("w")).withColumns(
        {"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    placed = placed.withColumn("cell", F.concat_ws(",", "cx", "cy"))
    heavy = placed.groupBy("cell").agg((F.sum("w") >= min_samples).alias("dense"))
    placed = cut_lineage(placed.join(heavy, "cell"))

    steps = F.array(*(F.lit(i) for i in range(-2, 3)))
    near = [F.explode(F.transform(steps, lambda s: F.col(f"c{axis}") + s)).alias(f"n{axis}") for axis in "xy"]

    def neighbours(left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs at most eps apart; the left side looks into the 5 x 5 cells around its own."""
        spread = left.select("*", near[0]).select("*", near[1])
        a = spread.select(*(F.col(c).alias(f"a_{c}") for c in (key, "x", "y", "cell")), "nx", "ny")
        b = right.select(*(F.col(c).alias(f"b_{c}") for c in (key, "x", "y", "w", "cell")),
                         F.col("cx").alias("nx"), F.col("cy").alias("ny"))
        dx, dy = F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")
        return a.join(b, ["nx", "ny"]).filter(F.sqrt(dx * dx + dy * dy) <= eps)

    light = placed.filter("not dense")
    reached = neighbours(light, placed).groupBy(F.col(f"a_{key}").alias(key)).agg(F.sum("b_w").alias("_reach"))
    core = placed.join(reached, key, "left").filter(F.col("dense") | (F.col("_reach") >= min_samples))
    core = cut_lineage(core.select(key, "x", "y", "w", "cx", "cy", "cell"))

    links = _cell_links(core, side, eps)
    labels = connected_components(core.select("cell"), links, "cell")
    member = core.join(labels, "cell")
    order = cut_lineage(member.groupBy("label").agg(F.min(key).alias("least")))
    ranks = order.join(sorted_codes(order, "least", out), "least").select("label", out)
    member = member.join(ranks, "label").select(key, "x", "y", "w", "cx", "cy", "cell", out)

    border = placed.join(core.select(key), key, "left_anti")
    touched = neighbours(border, member).select(F.col(f"a_{key}").alias(key), F.col(f"b_{key}").alias("core_key"))
    touched = touched.join(member.select(F.col(key).alias("core_key"), out), "core_key").groupBy(key).agg(
        F.min(out).alias(out))
    found = member.select(key, out).unionByName(touched)
    return points.select(key).join(found, key, "left").select(key, F.coalesce(out, F.lit(-1)).alias(out))


# Two boxes with at most this many pairs of points have their points compared; others are divided again.
BOX_PAIRS = 4096
# Sides of a box are halved twice a level, so that the finest is a cell's side divided by 4 to this power.
BOX_LEVELS = 12


def _cell_links(core: DataFrame, side: float, eps: float, box_pairs: int = BOX_PAIRS) -> DataFrame:
    """Pairs ``src < dst`` of cells that hold two points at most ``eps`` apart.

    Cells are compared by the boxes around their points: boxes whose far corners are within ``eps`` are linked, boxes
    whose near sides are not are apart, whatever points they hold. Pairs that are neither are divided into 4 x 4 smaller
    boxes on each side and compared again, unless some pair of boxes has linked their cells already. How many pairs stay
    open depends on the outline of the points, not on their number: points are only ever compared where a pair of
    boxes holds at most ``box_pairs`` pairs of them (or at the finest level). Rounding is monotone, so that boxes never
    contradict the distance of two points.
    """
    def boxes(level: int) -> DataFrame:
        # A power of two as factor is exact, so that a smaller box always lies inside one larger box.
        place = [F.floor(F.col(axis) / side * float(4 ** level)).alias(f"s{axis}") for axis in "xy"]
        return core.select("cell", "cx", "cy", "x", "y", *place)

    def bounds(points: DataFrame) -> DataFrame:
        return points.groupBy("cell", "cx", "cy", "sx", "sy").agg(F.count(F.lit(1)).alias("n"), *(
            f(axis).alias(f"{name}_{axis}") for axis in "xy" for name, f in (("low", F.min), ("high", F.max))))

    def sided(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
        return df.select(*(F.col(c).alias(f"{name}_{c}") for c in columns))

    def judged(pairs: DataFrame) -> DataFrame:
        near, far = [], []
        for axis in "xy":
            up, down = (F.col(f"{p}_low_{axis}") - F.col(f"{q}_high_{axis}") for p, q in (("a", "b"), ("b", "a")))
            near.append(F.greatest(up, down, F.lit(0.0)))
            far.append(F.greatest(-up, -down))
        length = [F.sqrt(d[0] * d[0] + d[1] * d[1]) for d in (near, far)]
        marked = pairs.filter(length[0] <= eps).withColumn("linked", length[1] <= eps)
        return marked.select("a_cell", "a_sx", "a_sy", "a_n", "b_cell", "b_sx", "b_sy", "b_n", "linked")

    cells = bounds(boxes(0))
    columns = cells.columns
    steps = [F.explode(F.transform(F.array(*map(F.lit, range(-2, 3))), lambda s: F.col(f"a_c{axis}") + s)).alias(f"n{axis}") for axis in "xy"]
    around = sided(cells, "a", columns).select("*", steps[0]).select("*", steps[1])
    near = sided(cells, "b", columns).withColumns({"nx": F.col("b_cx"), "ny": F.col("b_cy")})
    state = cut_lineage(judged(around.join(near, ["nx", "ny"]).filter("a_cell < b_cell")))
    ids = ["a_cell", "b_cell"]
    links, small = [], []
    for level in range(BOX_LEVELS + 1):
        links.append(state.filter("linked").select(*ids))
        left = state.filter("not linked")
        if level:  # cells themselves come in one pair each
            left = left.join(links[-1], ids, "left_anti")
        fits = (F.col("a_n") * F.col("b_n") <= box_pairs) if level < BOX_LEVELS else F.lit(True)
        small.append((level, left.filter(fits)))
        large = left.filter(~fits)
        if level == BOX_LEVELS or large.isEmpty():
            break
        finer = bounds(boxes(level + 1)).drop("cx", "cy")
        parts = [sided(finer, p, finer.columns).withColumns({f"{p}_up{axis}": F.shiftright(f"{p}_s{axis}", 2) for axis in "xy"}) for p in "ab"]
        open_ = large.select(*ids, *(F.col(f"{p}_s{axis}").alias(f"{p}_up{axis}") for p in "ab" for axis in "xy"))
        divided = open_.join(parts[0], ["a_cell", "a_upx", "a_upy"]).join(parts[1], ["b_cell", "b_upx", "b_upy"])
        state = cut_lineage(judged(divided))
    for level, pairs in small:
        points = boxes(level)
        a, b = (sided(points, p, ["cell", "sx", "sy", "x", "y"]) for p in "ab")
        dx, dy = F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")
        met = pairs.join(a, ["a_cell", "a_sx", "a_sy"]).join(b, ["b_cell", "b_sx", "b_sy"]).filter(F.sqrt(dx * dx + dy * dy) <= eps)
        links.append(met.select(*ids).distinct())
    return reduce(DataFrame.unionByName, links).select(F.col("a_cell").alias("src"), F.col("b_cell").alias("dst")).distinct()


def spatial_clusters(df: DataFrame, ids: Sequence[str], lat: str = "Latitude", lng: str = "Longitude",
                     sample_n: int | None = None, eps: float = 0.15, min_samples: int = 20, seed: int = 42,
                     out: str = "Spatial_Cluster") -> DataFrame:
    """Cluster the located rows on standardized coordinates; rows without a place get −1.

    With ``sample_n`` only a repeatable sample of that size is clustered and all other rows get −1. Rows at the same place become one weighted point before any distance is computed.
    """
    if not {lat, lng} <= set(df.columns):
        return df.withColumn(out, F.lit(-1))
    located = df.select(*ids, lat, lng).filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    sample = cut_lineage(located if sample_n is None else stable_sample(located, ids, sample_n, seed))
    if sample.isEmpty():
        return df.withColumn(out, F.lit(-1))
    scaled = standardize(sample, [lat, lng], "_scaled")
    # Points are numbered by their place on the map, which does not depend on the sampled ids.
    places = scaled.groupBy(lat, lng, f"{lat}_scaled", f"{lng}_scaled").agg(F.count(F.lit(1)).alias("weight"))
    places = places.withColumn("place", F.struct(lat, lng))
    clusters = dbscan(places, "place", f"{lat}_scaled", f"{lng}_scaled", eps, min_samples, "weight", out)
    labelled = sample.join(clusters.select(F.col(f"place.{lat}").alias(lat), F.col(f"place.{lng}").alias(lng), out),
                           [lat, lng]).select(*ids, out)
    return df.join(labelled, list(ids), "left").withColumn(out, F.coalesce(out, F.lit(-1)))
