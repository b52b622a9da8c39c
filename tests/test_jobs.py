"""Composite jobs end to end."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardscope.catalog.base import Tables
from wardscope.catalog.jobs import engineer_input, stage2_input
from wardscope.models.multiclass import MulticlassTrees
from wardscope.plans.count_forecast import CountModel, beat_day_features, count_forecast
from wardscope.plans.engineer import daily_features, stage3
from wardscope.plans.features import stage2
from wardscope.plans.hotspots import HotspotScorer, hotspots
from wardscope.plans.preprocess import stage1
from wardscope.plans.type_classifier import LEAKING, TypeModel, type_classifier
from wardscope.sources import read_table, row_counts, write_partitioned


@pytest.fixture(scope="module")
def tables(spark, small):
    return Tables(spark, small)


def test_stage1_with_few_columns(spark):
    rows = [("01/02/2021 03:04:05 PM", "theft", "0101"), ("bad", "x", "0101"), ("2021-01-02 15:04:05", " Theft", "0101")]
    df = spark.createDataFrame(rows, "Date string, PrimaryType string, Beat string")
    out = stage1(df).orderBy("CrimeType_Count").collect()
    assert [(r.CrimeType, r.CrimeType_Count, r.Hour, r.Season) for r in out] == [
        ("THEFT", 0, 15, "Winter"), ("THEFT", 1, 15, "Winter")]
    first = out[0]
    assert (first.Arrest_Flag, first.FBI_Code, first.FBI_Category, first.Location_Grouped, first.Lat_Bin) == (0, "UNKNOWN", "OTHER", "OTHER", None)
    assert (first.Description_Grouped, first.Arrest_Rate_Percent, out[1].Arrest_Rate_Percent) == ("OTHER", None, 0.0)


def test_stage1_merges_equal_records(tables):
    doubled = tables.raw.unionByName(tables.raw.withColumn("ID", F.col("ID") + 1_000_000))
    assert stage1(doubled).count() == stage1(tables.raw).count()
    assert stage1(doubled, row_id="ID").count() == 2 * stage1(tables.raw, row_id="ID").count()


def test_required_columns(spark):
    df = spark.createDataFrame([("x",)], "Beat string")
    for job in (stage1, stage2, stage3, hotspots):
        with pytest.raises(ValueError):
            job(df)
    with pytest.raises(ValueError):
        stage1(df.withColumn("Date", F.lit("x")))
    with pytest.raises(ValueError):
        type_classifier(df, "2024-01-01")


def test_stage2_does_not_see_the_future(tables):
    df = stage2_input(tables)
    late = F.col("Date_TS") >= F.lit("1999-01-01").cast("timestamp_ntz")
    changed = df.withColumn("Arrest_Flag", F.when(late, 1 - F.col("Arrest_Flag")).otherwise(F.col("Arrest_Flag"))).filter(~late | (F.col("ID") % 2 == 0))

    def early(frame):
        return sorted(map(str, stage2(frame, "ID").filter(~late).collect()))

    assert early(df) == early(changed)


def test_stage_outputs_are_written_by_month(tables, spark, tmp_path):
    out = stage1(tables.raw, row_id="ID")
    path = str(tmp_path / "stage1")
    count = write_partitioned(out, path)
    back = read_table(spark, path)
    assert row_counts(back).first()[0] == count == out.count()
    assert "PartitionFilters: [isnotnull(Year" in back.filter("Year = 2024")._jdf.queryExecution().executedPlan().toString()


def test_daily_features(tables):
    rows = engineer_input(tables).withColumn("Date_Only", F.to_date("Date_TS"))
    row = daily_features(rows).filter("Crime_Lag_7Day_Beat is not null").first()
    assert {"CrimeCountPerDay_Capped", "Is_CrimeOutlier", "Rolling_Avg_3Day_Beat"} <= set(row.asDict())


def test_stage3(tables):
    df = engineer_input(tables).withColumn("Is_CrimeOutlier", F.lit(False))
    out = stage3(df, ids=["ID"], n_clusters=2, edge_km=8.0, num_walks=3, dims=3, min_samples=5)
    assert {"Is_CrimeOutlier_Beat", "Spatial_Cluster", "Hour_Cluster", "label", "Embed_2", "CLICK"} <= set(out.columns)
    assert 0 < out.count() <= df.count() and out.filter("Embed_0 is null").isEmpty()
    bare = stage3(df.select("Beat", "Date_TS", "ID"), n_clusters=2)
    assert bare.count() == df.count() and bare.select("Spatial_Cluster").distinct().count() == 1


@pytest.fixture(scope="module")
def forecast_run(tables):
    return count_forecast(stage2_input(tables), year_min=1995, rounds=3, quantile_rounds=2, days=2, split_date="2000-06-01")


def test_count_forecast(tables, forecast_run, tmp_path):
    assert forecast_run.best in forecast_run.models and forecast_run.leaderboard.count() == 8
    assert forecast_run.forecast.groupBy("Beat").count().filter("count <> 2").isEmpty()
    assert forecast_run.predictions.filter("q_low > q_hi or y_pred_int < 0").isEmpty()
    assert forecast_run.per_beat.agg(F.sum("N")).first()[0] == forecast_run.predictions.count()
    path = str(tmp_path / "counts")
    forecast_run.write(path)
    manifest = forecast_run.series.sparkSession.read.json(f"{path}/MANIFEST").first()
    assert manifest.best_model == forecast_run.best and manifest.lags == [1, 3, 7, 14, 21]
    spark = forecast_run.series.sparkSession
    lines = [r.value for r in spark.read.text(f"{path}/summary").collect()]
    best = forecast_run.leaderboard.filter("rounded").filter(F.col("model") == forecast_run.best).first()
    assert lines[2:] == [f"Best model: {forecast_run.best}", f"Best int-MAE: {best.MAE:.3f}", f"Best int-RMSE: {best.RMSE:.3f}"] and len(lines) == 5
    assert spark.read.csv(f"{path}/training_history_XGBPoisson", header=True).count() == 3
    again = CountModel.load(forecast_run.series, path)
    scored = again.predict(stage2_input(tables)).join(forecast_run.predictions.select("Date", "Beat"), ["Date", "Beat"], "left_semi")
    assert sorted(map(str, scored.select(forecast_run.predictions.columns).collect())) == sorted(map(str, forecast_run.predictions.collect()))
    for name, model in forecast_run.models.items():
        assert again.predict(stage2_input(tables).drop("Lat_Bin"), name).filter("y_pred_cont is null").isEmpty() and type(again.models[name]) is type(model)
    zinb, stored = forecast_run.models["ZINB_full"], again.models["ZINB_full"]
    assert (stored.dispersion, stored.history, stored.scaler, stored.inflation_scaler) == (zinb.dispersion, zinb.history, zinb.scaler, zinb.inflation_scaler)
    worst = spark.read.csv(f"{path}/worst_beats_mae", header=True, inferSchema=True)
    assert worst.filter("N < 50").isEmpty() and worst.count() <= 25


def test_dense_series_has_zeros(tables):
    df = stage2_input(tables)
    dense = beat_day_features(df, 1996, dense=True)
    sparse = beat_day_features(df, 1996)
    assert dense.filter("CrimeCountPerDay = 0").count() == dense.count() - sparse.count() > 0
    with_now = beat_day_features(df, 1996, shift=0)
    assert with_now.filter("Rolling_Avg_3Day_Beat = 0").isEmpty() and not sparse.filter("Rolling_Avg_3Day_Beat = 0").isEmpty()


def test_hotspots(tables, tmp_path):
    run = hotspots(stage2(stage2_input(tables), "ID"), ids=["ID"], year_min=1995)
    report = {r.metric: r for r in run.report.collect()}
    assert report["macro avg"].support > 100 and 0 <= run.threshold <= 1
    assert 0 <= run.metrics.first().roc_auc <= 1
    assert "Hour_hop2" in run.features and run.table.filter("prob_hotspot is null").isEmpty()
    run.write(str(tmp_path / "hot"))
    assert run.table.sparkSession.read.csv(str(tmp_path / "hot" / "loss_history"), header=True).count() == len(run.model.history) == 1
    calls = HotspotScorer.load(run.table, str(tmp_path / "hot")).predict(stage2(stage2_input(tables), "ID"), ["ID"])
    given = {(r.Beat, r.Week): r.prob_hotspot for r in calls.collect()}
    wanted = {(r.Beat, r.Date_Only): r.prob_hotspot for r in run.table.collect()}
    assert set(wanted) <= set(given) and all(given[k] == pytest.approx(v, abs=1e-9) for k, v in wanted.items())
    plain = hotspots(stage2_input(tables), ids=["ID"], year_min=1995, neighbours=False, kind="perceptron", hidden=4)
    assert plain.features == ["Hour", "Month"]


def test_type_classifier(tables, tmp_path):
    clean = stage1(tables.raw, row_id="ID").withColumn("hint", F.length("CrimeType"))
    run = type_classifier(clean, "2024-01-22", ids=["ID"], rounds=2, depth=3, n_features=3, k_folds=2, selector_trees=4)
    assert "hint" in run.features and not set(run.features) & set(LEAKING)
    metrics = run.manifest.first().metrics
    assert metrics.overall_accuracy > 0.3 and run.auc.count() == 5
    assert run.predictions.count() == clean.filter("Date_TS >= '2024-01-22'").count()
    run.write(str(tmp_path / "types"))
    spark = clean.sparkSession
    bundle = TypeModel.load(clean, str(tmp_path / "types" / "bundle"))
    late = clean.filter("Date_TS >= '2024-01-22'")
    given = {r.ID: (r.predicted, r.probability) for r in bundle.predict(late.withColumn("predicted", F.lit("x"))).collect()}
    wanted = run.predictions.groupBy("predicted", F.col("probability").cast("string")).count().collect()
    assert len(given) == late.count() and bundle.features == run.features and set(bundle.encoders) == set(run.bundle.encoders)
    rows = spark.createDataFrame([(p, q) for p, q in given.values()], "predicted string, probability array<double>")
    assert sorted(rows.groupBy("predicted", F.col("probability").cast("string")).count().collect()) == sorted(wanted)
    texts = run.bundle.encoders or {"none": None}
    odd = late.limit(3).drop("hint").withColumns({c: F.lit("never seen") for c in texts})
    assert bundle.predict(odd).filter("predicted is not null").count() == 3
    assert spark.read.csv(str(tmp_path / "types" / "best_and_worst_class"), header=True).count() == 1
    assert spark.read.csv(str(tmp_path / "types" / "training_history"), header=True).count() == 2
    again = MulticlassTrees.load(clean, str(tmp_path / "types" / "model"))
    assert again.ensemble == run.model.ensemble and again.classes == run.model.classes


def test_history_features_keep_equal_records_apart(spark):
    row = (dt.datetime(2024, 3, 1, 5), "0001", "THEFT", 5, 1, 2024, 3, 41.6, -87.9)
    names = "Date_TS timestamp, Beat string, CrimeType string, Hour int, Arrest_Flag int, Year int, Month int, Lat_Bin double, Lng_Bin double"
    frame = spark.createDataFrame([row, row, (dt.datetime(2024, 3, 2, 5), *row[1:])], names)
    assert stage2(frame, distinct=False).count() == 3
    assert stage2(frame).count() == 2
