"""Fourth job: daily counts per beat, their models, evaluation and forecast."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope import sources
from wardscope.evaluation.regression import error_histogram, model_leaderboard, prediction_table
from wardscope.functions.calendar import min_year
from wardscope.functions.cleaning import to_number_or_zero
from wardscope.functions.numeric import clip_prediction
from wardscope.models.boosting import GRADIENT_STYLE, HISTOGRAM_STYLE, BoostedTrees, poisson_boost, quantile_bands
from wardscope.models.forecast import LAGS, ROLLS, calendar_features, forecast, with_features
from wardscope.models.linear import PoissonModel, ZeroInflatedModel, poisson_glm, zinb
from wardscope.operators import aggregates, sampling, windows
from wardscope.operators.joins import attach_statics, lookup
from wardscope.schema import has, require, select_available
from wardscope.session import cut_lineage

COUNT = "CrimeCountPerDay"
BASE_FEATURES = [*(f"Crime_Lag_{k}Day_Beat" for k in LAGS), *(f"Rolling_Avg_{w}Day_Beat" for w in ROLLS), "Weekday",
                 "IsWeekend", "Month", "Season", "DoW_sin", "DoW_cos", "Mon_sin", "Mon_cos", "IsHoliday"]
STATIC_FEATURES = ["Hour_Cluster", "Lat_Bin", "Lng_Bin"]


def static_features(df: DataFrame) -> DataFrame | None:
    """One row per beat with the embeddings, the usual hour cluster and the last grid bins that the table has."""
    embeddings = [c for c in df.columns if c.startswith("Embed_")]
    order = ["Date_TS"]
    tables = []
    if embeddings:
        tables.append(to_number_or_zero(aggregates.first_by(df, "Beat", embeddings, order), embeddings))
    if has(df, "Hour_Cluster"):
        tables.append(aggregates.mode_by(df, "Beat", "Hour_Cluster"))
    bins = [c for c in ("Lat_Bin", "Lng_Bin") if has(df, c)]
    if bins:
        tables.append(aggregates.last_by(df, "Beat", bins, order))
    if not tables:
        return None
    return attach_statics(df.select("Beat").distinct(), "Beat", tables)


def densify(series: DataFrame) -> DataFrame:
    """Add the days without rows between the first and the last day of each beat, with a count of 0."""
    spans = series.groupBy("Beat").agg(F.min("Date_Only").alias("a"), F.max("Date_Only").alias("b"))
    days = spans.select("Beat", F.explode(F.sequence("a", "b")).alias("Date_Only"))
    return days.join(series, ["Beat", "Date_Only"], "left").fillna(0, subset=[COUNT])


def beat_day_features(df: DataFrame, year_min: int = 2010, shift: int = 1, dense: bool = False) -> DataFrame:
    """Counts per beat and day with lags, rolling means, calendar and static features.

    ``shift=1`` keeps the day's own count out of its rolling means, as in forecasting; 0 includes it.
    """
    require(df, ["Beat", "Date_TS"])
    rows = min_year(df.filter(F.col("Beat").isNotNull() & F.col("Date_TS").isNotNull()), "Date_TS", year_min)
    rows = rows.withColumns({"Beat": F.col("Beat").cast("string"), "Date_Only": F.to_date("Date_TS")})
    series = aggregates.daily_counts(rows, "Beat")
    series = densify(series) if dense else series
    keys, order = ["Beat"], ["Date_Only"]
    series = windows.lag_by(series, keys, order, COUNT, {f"Crime_Lag_{k}Day_Beat": k for k in LAGS})
    series = windows.rolling_mean(series, keys, order, COUNT, {f"Rolling_Avg_{w}Day_Beat": w for w in ROLLS}, shift)
    series = calendar_features(series)
    statics = static_features(rows)
    if statics is not None:
        series = series.join(statics, "Beat", "left")
    features = select_available(series, BASE_FEATURES + STATIC_FEATURES, ["Embed_"])
    return to_number_or_zero(series, features)


FACTS = "features array<string>, names array<string>, kinds array<string>, best string, year_min int, shift int, dense boolean"


@dataclass
class CountModel:
    """What a written run needs to score incidents: models and bands, and how their features are read."""

    features: list[str]
    models: dict[str, PoissonModel | BoostedTrees | ZeroInflatedModel]
    bands: tuple[BoostedTrees, BoostedTrees]
    best: str
    reading: tuple[int, int, bool]

    @classmethod
    def load(cls, df: DataFrame, path: str) -> CountModel:
        """Load from the folder of :meth:`CountForecast.write`, into the session of ``df``."""
        facts = df.sparkSession.read.schema(FACTS).json(f"{path}/models/facts").first()
        classes = {c.__name__: c for c in (PoissonModel, BoostedTrees, ZeroInflatedModel)}
        models = {name: classes[kind].load(df, f"{path}/models/{name}") for name, kind in zip(facts.names, facts.kinds)}
        bands = tuple(BoostedTrees.load(df, f"{path}/models/{name}") for name in ("q_low", "q_hi"))
        return cls(list(facts.features), models, bands, facts.best, (facts.year_min, facts.shift, facts.dense))

    def predict(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """Table of predictions for every beat and day of the incidents ``df``, by the best model unless one is named.

        Features that the table lacks are 0, as nulls are.
        """
        name = name or self.best
        series = beat_day_features(df, *self.reading)
        series = series.withColumns({c: F.lit(0.0) for c in self.features if not has(series, c)})
        low, high = (with_features(model, self.features) for model in self.bands)
        model = self.models[name]
        scored = with_features(model, self.features)(series, name) if isinstance(model, BoostedTrees) else model.predict(series, name)
        scored = scored.withColumn(name, clip_prediction(F.col(name)))
        return prediction_table(high(low(scored, "_low"), "_high"), "Date_Only", "Beat", COUNT, name, "_low", "_high")


@dataclass
class CountForecast:
    """Models and tables of one run."""

    features: list[str]
    split_date: object
    series: DataFrame
    models: dict[str, PoissonModel | BoostedTrees | ZeroInflatedModel]
    bands: tuple[BoostedTrees, BoostedTrees]
    leaderboard: DataFrame
    best: str
    predictions: DataFrame
    per_beat: DataFrame
    forecast: DataFrame
    citywide_forecast: DataFrame
    citywide_actual: DataFrame
    errors: DataFrame
    manifest: DataFrame
    locations: DataFrame | None
    reading: tuple[int, int, bool]

    def summary(self) -> DataFrame:
        """Five lines on the target and on the best model's errors in whole counts."""
        errors = self.leaderboard.filter(F.col("rounded") & (F.col("model") == self.best)).first()
        lines = F.array(F.format_string("Average actual per beat/day: %.2f", "avg_actual_per_beat_day"),
                        F.format_string("Median actual per beat/day: %.2f", "median_actual_per_beat_day"),
                        F.format_string("Best model: %s", "best_model"), F.format_string("Best int-MAE: %.3f", F.lit(errors.MAE)),
                        F.format_string("Best int-RMSE: %.3f", F.lit(errors.RMSE)))
        return self.manifest.select(F.explode(lines).alias("value"))

    def write(self, path: str) -> None:
        """Write every table, the manifest, the summary and the models below a folder."""
        sources.write_parquet(self.series, f"{path}/beat_day_features.parquet")
        reports = {"model_results_test": self.leaderboard, "test_predictions_best": self.predictions,
                   "per_beat_metrics": self.per_beat, "forecast_7d_per_beat": self.forecast,
                   "citywide_forecast": self.citywide_forecast, "citywide_actual_test": self.citywide_actual,
                   "error_distribution": self.errors, "worst_beats_mae": aggregates.worst_keys(self.per_beat, "Beat")}
        reports |= {f"training_history_{name}": model.training_history(self.series) for name, model in self.models.items() if isinstance(model, BoostedTrees)}
        if self.locations is not None:
            reports["per_beat_location"] = self.locations
        for name, table in reports.items():
            sources.write_report_csv(table, f"{path}/{name}")
        sources.write_manifest(self.manifest, f"{path}/MANIFEST")
        sources.write_summary(self.summary(), f"{path}/summary")
        for name, model in self.models.items():
            model.save(self.series, f"{path}/models/{name}")
        for name, model in zip(("q_low", "q_hi"), self.bands):
            model.save(self.series, f"{path}/models/{name}")
        kinds = [type(model).__name__ for model in self.models.values()]
        facts = [(self.features, list(self.models), kinds, self.best, *self.reading)]
        sources.write_manifest(self.series.sparkSession.createDataFrame(facts, FACTS), f"{path}/models/facts")


def count_forecast(df: DataFrame, split_date: object = None, q_low: float = 0.2, q_high: float = 0.8, val_frac: float = 0.15,
                   year_min: int = 2010, days: int = 7, shift: int = 1, dense: bool = False, with_zinb: bool = True,
                   rounds: int | None = None, quantile_rounds: int | None = None) -> CountForecast:
    """Train the count models, pick the one with the least error on whole counts and forecast with it.

    ``rounds`` and ``quantile_rounds`` replace the number of boosting rounds of the standard parameter sets.
    """
    series = cut_lineage(beat_day_features(df, year_min, shift, dense))
    features = select_available(series, BASE_FEATURES + STATIC_FEATURES, ["Embed_"])
    split = sampling.choose_split_date(series, "Date_Only", split_date)
    train, test = sampling.time_split(series, "Date_Only", split)

    weights = aggregates.hardness_weights(train, "Beat", COUNT, "Rolling_Avg_7Day_Beat")
    placed = windows.positional_slice(lookup(train, weights, "Beat", "weight", 1.0), ["Beat"], "Date_Only", 1 - val_frac, "_fit")
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    rows = cut_lineage(assembler.transform(placed.withColumn("_valid", ~F.col("_fit"))))
    fitting = rows.filter("_fit")
    common = {"weight": "weight", **({"rounds": rounds} if rounds else {})}
    wanted = {
        "TweediePoisson": lambda: poisson_glm(fitting, COUNT, features, "weight"),
        "HGBPoisson": lambda: poisson_boost(rows, COUNT, "features", valid="_valid", **{**HISTOGRAM_STYLE, **common}),
        "XGBPoisson": lambda: poisson_boost(rows, COUNT, "features", valid="_valid", **{**GRADIENT_STYLE, **common}),
    }
    if with_zinb:
        wanted["ZINB_full"] = lambda: zinb(train, COUNT, features)
    with ThreadPoolExecutor(len(wanted) + 1) as pool:  # the models do not wait for each other's rounds
        fits = {name: pool.submit(fit) for name, fit in wanted.items()}
        pair = pool.submit(quantile_bands, fitting, COUNT, "features", q_low, q_high, weight="weight",
                           **({"rounds": quantile_rounds} if quantile_rounds else {}))
        models = {name: fit.result() for name, fit in fits.items()}
        bands = pair.result()

    def scorer(model: object):
        return with_features(model, features) if isinstance(model, BoostedTrees) else model.predict

    scored = test
    for name, model in models.items():
        scored = scorer(model)(scored, name).withColumn(name, clip_prediction(F.col(name)))
    low, high = (with_features(model, features) for model in bands)
    scored = cut_lineage(high(low(scored, "_low"), "_high"))

    board = cut_lineage(model_leaderboard(scored, COUNT, list(models)))
    best, error = sampling.best_model(board).first()
    table = prediction_table(scored, "Date_Only", "Beat", COUNT, best, "_low", "_high")
    statics = select_available(series, STATIC_FEATURES, ["Embed_"])
    last_statics = aggregates.last_by(series, "Beat", statics, ["Date_Only"]) if statics else None
    ahead = forecast(series, "Beat", "Date_Only", COUNT, scorer(models[best]), days, (low, high), last_statics)
    summary = aggregates.target_summary(table, "y_true")
    manifest = summary.select(
        F.lit("count forecast").alias("pipeline"), F.current_timestamp().cast("string").alias("timestamp"),
        F.lit(str(split)).alias("split_date"), F.array(*map(F.lit, LAGS)).alias("lags"), F.array(*map(F.lit, ROLLS)).alias("rolls"),
        F.array(*map(F.lit, features)).alias("features_used"), F.array(*map(F.lit, models)).alias("models_trained"),
        F.lit(best).alias("best_model"), F.lit(float(error)).alias("best_int_mae"),
        F.col("mean_actual").alias("avg_actual_per_beat_day"), F.col("median_actual").alias("median_actual_per_beat_day"),
        F.struct(F.lit(q_low).alias("low"), F.lit(q_high).alias("high")).alias("quantiles"))
    located = aggregates.coordinate_names(df)
    return CountForecast(
        features, split, series, models, bands, board, best, table,
        aggregates.per_key_errors(table, "Beat", "y_true", "y_pred_int").orderBy(F.desc("MAE"), "Beat"), ahead,
        aggregates.citywide_daily(ahead, "Date", "CrimeCount_Pred", "CrimeCount_Pred").orderBy("Date"),
        aggregates.citywide_daily(table, "Date", "y_true", "Citywide_Actual").orderBy("Date"),
        error_histogram(table, "y_true", "y_pred_int"), manifest,
        aggregates.centroid_median(df, "Beat") if located else None, (year_min, shift, dense))
