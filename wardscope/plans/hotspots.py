"""Fifth job: weekly hotspots per beat."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope import sources
from wardscope.evaluation import classification as cls
from wardscope.functions.calendar import min_year, week_key
from wardscope.functions.cleaning import dedup, to_number_or_zero
from wardscope.models.hotspot import HotspotModel, hotspot_classifier
from wardscope.operators import aggregates, sampling, scaling, spatial, windows
from wardscope.operators.graph import neighbor_features
from wardscope.operators.prefix import tie_hash
from wardscope.schema import merge_suffixed, quoted, require, select_available
from wardscope.session import cut_lineage

# The features a hotspot model may use, in this order.
FEATURES = ["Crime_Count_Last7Days", "Rolling_Avg_3Day_Beat", "Crime_Lag_1Day_Beat", "Crime_Lag_7Day_Beat",
            "Arrest_Rate_Percent", "Domestic_Crime_Rate_Percent", "Arrest_Rate_Roll3", "Arrest_Rate_Roll7",
            "ASSAULT", "BATTERY", "BURGLARY", "CRIMINAL DAMAGE", "DECEPTIVE PRACTICE", "MOTOR VEHICLE THEFT", "NARCOTICS",
            "OTHER", "ROBBERY", "THEFT", "Hour", "Weekday", "Month", "IsWeekend", "Is_Covid_Era"]
SUFFIXED = ["CrimeCountPerDay", "Is_CrimeOutlier", "CrimeCountPerDay_Capped"]


@dataclass
class Hotspots:
    """Model and tables of one run."""

    model: HotspotModel
    features: list[str]
    threshold: float
    table: DataFrame
    report: DataFrame
    curve: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    centroids: DataFrame | None
    inputs: DataFrame

    def write(self, path: str) -> None:
        """Write tables, metrics and model below a folder."""
        for name, table in {"hotspot_predictions": self.table, "classification_report": self.report,
                            "pr_curve": self.curve, "confusion_matrix": self.confusion}.items():
            sources.write_report_csv(table, f"{path}/{name}")
        if self.centroids is not None:
            sources.write_report_csv(self.centroids, f"{path}/per_beat_location")
        history = [(i, loss) for i, loss in enumerate(self.model.history)]
        sources.write_report_csv(sampling.literal_table(self.table, history, "round int, loss double"), f"{path}/loss_history")
        sources.write_manifest(self.metrics, f"{path}/metrics")
        sources.save_model(self.model.pipeline(), f"{path}/model")
        sources.write_manifest(self.inputs, f"{path}/model_inputs")


INPUTS = ("features array<string>, means array<double>, deviations array<double>, model_columns array<string>, threshold double, "
          "kind string, neighbours boolean, dist_threshold double, year_min int")


@dataclass
class HotspotScorer:
    """What a written run needs to call the weeks of incidents: features and their scaling, model and threshold."""

    model: HotspotModel
    scaler: scaling.Standardizer
    threshold: float
    neighbours: bool
    dist_threshold: float
    year_min: int

    @classmethod
    def load(cls, df: DataFrame, path: str) -> HotspotScorer:
        """Load from the folder of :meth:`Hotspots.write`, into the session of ``df``."""
        facts = df.sparkSession.read.schema(INPUTS).json(f"{path}/model_inputs").first()
        assembler, classifier = sources.load_model(f"{path}/model").stages
        scaler = scaling.Standardizer(tuple(facts.features), tuple(facts.means), tuple(facts.deviations))
        return cls(HotspotModel(assembler.getInputCols(), classifier, facts.kind), scaler, facts.threshold, facts.neighbours,
                   facts.dist_threshold, facts.year_min)

    def predict(self, df: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
        """Probability and call for every beat and week of the incidents ``df``; features that it lacks are 0, as nulls are."""
        df, ids = identified(merge_suffixed(df, SUFFIXED), ids)
        latest = cut_lineage(weekly_rows(df, ids, self.year_min))
        latest = latest.withColumns({c: F.lit(0.0) for c in self.scaler.columns if c not in latest.columns})
        rows, _ = model_rows(latest, self.scaler, self.neighbours, self.dist_threshold)
        scored = self.model.predict(rows).select("Beat", "Week", "prob_hotspot")
        return scored.withColumn("Prediction", (F.col("prob_hotspot") >= self.threshold).cast("int"))


def identified(df: DataFrame, ids: Sequence[str] | None) -> tuple[DataFrame, Sequence[str]]:
    """Records and the columns that identify them; without ``ids`` equal records count once and their hash does."""
    if ids:
        return df, ids
    return dedup(df).withColumn("_row_id", tie_hash([quoted(c) for c in df.columns])), ["_row_id"]


def model_rows(latest: DataFrame, scaler: scaling.Standardizer, neighbours: bool, dist_threshold: float) -> tuple[DataFrame, list[str]]:
    """Scaled features ``f0``, ``f1``, … of each beat and week, and what they are called."""
    columns = list(scaler.columns)
    scaled = scaler.transform(to_number_or_zero(latest, columns))
    if neighbours:
        edges = cut_lineage(spatial.proximity_edges(latest, "Beat", ["Week"], dist_threshold))
        scaled = neighbor_features(scaled, edges, "Beat", "Week", scaler.columns, dist_threshold)
        columns += [f"{c}_hop{hop}" for hop in (1, 2) for c in scaler.columns]
    # Names with blanks are not safe inside an assembler.
    return scaled.select("Beat", "Week", "is_hotspot", *(quoted(c).alias(f"f{i}") for i, c in enumerate(columns))), columns


def weekly_rows(df: DataFrame, ids: Sequence[str], year_min: int = 2010) -> DataFrame:
    """Last record of each beat and week with its hotspot label."""
    require(df, ["Beat", "Date_TS"])
    rows = min_year(df.filter(F.col("Date_TS").isNotNull()), "Date_TS", year_min).withColumns(
        {"Beat": F.col("Beat").cast("string"), "Week": week_key("Date_TS")})
    labels = aggregates.hotspot_label(aggregates.weekly_counts(rows, "Beat"), "Beat")
    latest = windows.latest_per(rows, ["Beat", "Week"], "Date_TS", ids)
    return latest.join(labels.select("Beat", "Week", "is_hotspot"), ["Beat", "Week"])


def hotspots(df: DataFrame, ids: Sequence[str] | None = None, year_min: int = 2010, dist_threshold: float = 0.06,
             test_size: float = 0.2, neighbours: bool = True, kind: str = "logistic", focal_rounds: int = 0,
             hidden: int = 128, seed: int = 42) -> Hotspots:
    """Train and evaluate the hotspot model; the threshold maximises F1 on the test rows.

    Records that are equal in all columns count once unless ``ids`` name the columns that identify them.
    ``neighbours=False`` is the variant on plain features.
    """
    df, ids = identified(merge_suffixed(df, SUFFIXED), ids)
    latest = cut_lineage(weekly_rows(df, ids, year_min))
    features = select_available(latest, FEATURES)
    scaler = scaling.Standardizer.fit(to_number_or_zero(latest, features), features)
    rows, columns = model_rows(latest, scaler, neighbours, dist_threshold)
    rows = cut_lineage(sampling.stratified_split(rows, "is_hotspot", ["Beat", "Week"], test_size, seed))

    model = hotspot_classifier(rows.filter("not is_test"), "is_hotspot", [f"f{i}" for i in range(len(columns))], kind, focal_rounds,
                               hidden=hidden, seed=seed)
    scored = cut_lineage(model.predict(rows).select("Beat", "Week", "is_hotspot", "is_test", "prob_hotspot"))
    test = scored.filter("is_test")
    curve = cut_lineage(cls.pr_curve(test, "prob_hotspot", "is_hotspot"))
    found = cls.best_f1_threshold(curve).first()
    threshold = found[0] if found[0] is not None else 0.5
    called = test.withColumn("Prediction", (F.col("prob_hotspot") >= threshold).cast("int"))
    counts = cls.confusion_counts(called, "is_hotspot", "Prediction")
    metrics = cls.roc_auc(test, "prob_hotspot", "is_hotspot").select(
        F.lit(float(threshold)).alias("best_threshold"), F.lit(float(found[1] or 0.0)).alias("f1_score"), "roc_auc",
        cls.average_precision(test, "prob_hotspot", "is_hotspot").scalar().alias("avg_precision"),
        F.lit(kind + (" with neighbours" if neighbours else "")).alias("used_model"))
    centroids = aggregates.centroid_median(df, "Beat") if aggregates.coordinate_names(df) else None
    table = cls.hotspot_table(scored, "Beat", "Week", "prob_hotspot", threshold, centroids)
    return Hotspots(model, columns, threshold, table, cls.classification_report(counts), curve,
                    cls.confusion_matrix(called, "is_hotspot", "Prediction", [0, 1]), metrics, centroids, metrics.select(
                        F.array(*map(F.lit, features)).alias("features"), F.array(*map(F.lit, scaler.means)).alias("means"),
                        F.array(*map(F.lit, scaler.deviations)).alias("deviations"), F.array(*map(F.lit, columns)).alias("model_columns"),
                        F.lit(float(threshold)).alias("threshold"), F.lit(kind).alias("kind"), F.lit(neighbours).alias("neighbours"),
                        F.lit(float(dist_threshold)).alias("dist_threshold"), F.lit(year_min).alias("year_min")))
