"""Third job: daily features, clusters, embeddings and label of the incident records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.functions.calendar import min_year
from wardscope.functions.cleaning import dedup
from wardscope.models.clusters import hour_clusters
from wardscope.models.embeddings import walk_embeddings
from wardscope.operators import aggregates, graph, spatial, windows
from wardscope.operators.joins import join_back, join_required
from wardscope.operators.prefix import tie_hash
from wardscope.schema import has, quoted, require
from wardscope.session import cut_lineage


def daily_features(df: DataFrame, outlier: str = "Is_CrimeOutlier") -> DataFrame:
    """Per beat and day: count, outlier flag, capped count, lags of 1 and 7 rows, mean of the 3 rows before."""
    count, keys, order = "CrimeCountPerDay", ["Beat"], ["Date_Only"]
    daily = aggregates.daily_counts(df, "Beat")
    daily = aggregates.global_quantile_cap(daily, count, outlier, f"{count}_Capped")
    daily = windows.lag_by(daily, keys, order, count, {f"Crime_Lag_{n}Day_Beat": n for n in (1, 7)})
    return windows.rolling_mean_strict(daily, keys, order, count, "Rolling_Avg_3Day_Beat")


def stage3(df: DataFrame, ids: Sequence[str] | None = None, year_min: int = 2010, sample_n: int | None = None,
           eps: float = 0.15, min_samples: int = 20, n_clusters: int = 5, edge_km: float = 2.0, dims: int = 8,
           walk_length: int = 5, num_walks: int = 50, window: int = 3, seed: int = 42,
           as_of: object = None) -> DataFrame:
    """Add daily features, type shares, clusters, embeddings and the label to the records.

    ``ids`` identify a record for the sample; all columns do when they are not named. ``as_of`` limits the
    type shares to the records before a date, so that they hold nothing of the future.
    """
    require(df, ["Beat", "Date_TS"])
    rows = min_year(df.filter(F.col("Date_TS").isNotNull()), "Date_TS", year_min)
    rows = rows.withColumn("Date_Only", F.to_date("Date_TS"))
    outlier = "Is_CrimeOutlier_Beat" if has(df, "Is_CrimeOutlier") else "Is_CrimeOutlier"
    keys = list(ids) if ids else ["_row_id"]
    if not ids:
        rows = rows.withColumn("_row_id", tie_hash([quoted(name) for name in df.columns]))
    out = join_back(rows, daily_features(rows, outlier), ["Beat", "Date_Only"])
    if has(df, "CrimeType"):
        history = rows if as_of is None else rows.filter(F.col("Date_Only") < F.lit(str(as_of)).cast("date"))
        types = aggregates.category_values(rows, "CrimeType")
        out = join_back(out, aggregates.category_mix(history, "Beat", "CrimeType", types), ["Beat"])
    located = has(df, "Latitude", "Longitude")
    if located:
        clusters = spatial.spatial_clusters(rows.select(*keys, "Latitude", "Longitude"), keys, sample_n=sample_n,
                                            eps=eps, min_samples=min_samples, seed=seed)
        clustered = clusters.filter("Spatial_Cluster >= 0").select(*keys, "Spatial_Cluster").distinct()
        out = out.join(clustered, keys, "left").fillna(-1, subset=["Spatial_Cluster"])
    else:
        out = out.withColumn("Spatial_Cluster", F.lit(-1))
    profile = aggregates.hour_profile(rows, "Beat", ts="Date_TS")
    out = join_back(out, hour_clusters(profile, "Beat", n_clusters, seed), ["Beat"])
    if located:
        centres = cut_lineage(aggregates.centroid_mean(rows, "Beat").withColumn("Beat", F.col("Beat").cast("string")))
        edges = cut_lineage(spatial.haversine_edges(centres, "Beat", "Latitude", "Longitude", edge_km))
        if not edges.isEmpty():
            walks = graph.random_walks(edges, walk_length, num_walks, seed)
            vectors = walk_embeddings(walks, "Beat", dims, window, seed)
            out = out.drop(*(c for c in out.columns if c.startswith("Embed_")))
            out = join_required(out.withColumn("Beat", F.col("Beat").cast("string")), vectors, ["Beat"])
    if has(df, "CrimeType"):
        out = windows.category_codes(out, "CrimeType", "label")
    return out if ids else dedup(out.drop("_row_id"))
