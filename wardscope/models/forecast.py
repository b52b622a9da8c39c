"""Recursive daily forecast of all keys at once."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardscope.functions.calendar import SEASONS, LAST_SEASON, calendar_parts_monday, holiday_flag, season, with_cyclic
from wardscope.functions.numeric import clip_prediction, order_bands
from wardscope.session import cut_lineage

# Row lags and widths of the rolling means.
LAGS = (1, 3, 7, 14, 21)
ROLLS = (3, 7, 14, 28)

Scorer = Callable[[DataFrame, str], DataFrame]


def season_code(month: Column) -> Column:
    """Position of the season among the sorted season names."""
    names = sorted([*SEASONS, LAST_SEASON])
    return (F.array_position(F.array(*map(F.lit, names)), season(month)) - 1).cast("double")


def calendar_features(df: DataFrame, day: str = "Date_Only") -> DataFrame:
    """Weekday, IsWeekend, Month, Season as a code, the cyclic columns and IsHoliday."""
    parts = with_cyclic(calendar_parts_monday(df, day))
    return parts.withColumns({"Season": season_code(F.col("Month")), "IsHoliday": holiday_flag(F.col(day))})


def recent_counts(series: DataFrame, key: str, day: str, count: str, length: int = max(*LAGS, *ROLLS)) -> DataFrame:
    """Last date and the last counts, oldest first, per key. Spark keeps ``length`` candidates per task and key."""
    window = Window.partitionBy(key).orderBy(F.desc(day))
    last = series.select(key, day, count, F.row_number().over(window).alias("_r")).filter(F.col("_r") <= length)
    pairs = F.array_sort(F.collect_list(F.struct(day, F.col(count).cast("double").alias("n"))))
    return last.groupBy(key).agg(F.max(day).alias("last_date"), pairs.alias("_pairs")).select(
        key, "last_date", F.transform("_pairs", lambda pair: pair["n"]).alias("counts"))


def history_features(state: DataFrame) -> DataFrame:
    """Lags and rolling means of the ``counts`` array; a lag that reaches too far back is 0."""
    size = F.size("counts")
    lags = {f"Crime_Lag_{k}Day_Beat": F.when(size >= k, F.try_element_at("counts", F.lit(-k))).otherwise(0.0) for k in LAGS}

    def mean(width: int) -> Column:
        tail = F.slice("counts", F.greatest(size - width + 1, F.lit(1)), F.lit(width))
        return F.coalesce(F.try_divide(F.aggregate(tail, F.lit(0.0), lambda a, b: a + b), F.size(tail)), F.lit(0.0))

    return state.withColumns({**lags, **{f"Rolling_Avg_{w}Day_Beat": mean(w) for w in ROLLS}})


def forecast(series: DataFrame, key: str, day: str, count: str, predict: Scorer, days: int = 7,
             bands: tuple[Scorer, Scorer] | None = None, statics: DataFrame | None = None,
             calendar: bool = True) -> DataFrame:
    """``Date, Beat, CrimeCount_Pred, q_low, q_hi`` for the days after the last one of each key.

    A step scores one day of every key, appends the rounded prediction to the counts and goes on from there.
    The state, one row per key, is cut from its lineage after each step.
    """
    state = recent_counts(series, key, day, count)
    if statics is not None:
        state = state.join(statics, key, "left").fillna(0.0, subset=[c for c in statics.columns if c != key])
    state = cut_lineage(state)
    carried = state.columns
    results: list[DataFrame] = []
    for _ in range(days):
        rows = history_features(state.withColumn("Date_Only", F.date_add("last_date", 1)))
        rows = predict(calendar_features(rows) if calendar else rows, "_raw")
        if bands:
            rows = bands[1](bands[0](rows, "_low"), "_high")
            low, high = order_bands(clip_prediction(F.col("_low")), clip_prediction(F.col("_high")))
        else:
            low = high = F.lit(math.nan)
        whole = F.rint(clip_prediction(F.col("_raw"))).cast("int")
        step = cut_lineage(rows.select(*carried, "Date_Only", whole.alias("CrimeCount_Pred"), low.alias("q_low"),
                                       high.alias("q_hi")))
        results.append(step.select(F.col("Date_Only").alias("Date"), F.col(key).alias("Beat"), "CrimeCount_Pred",
                                   "q_low", "q_hi"))
        longer = F.concat("counts", F.array(F.col("CrimeCount_Pred").cast("double")))
        state = step.withColumns({"counts": longer, "last_date": F.col("Date_Only")}).select(*carried)
    table = results[0]
    for other in results[1:]:
        table = table.unionByName(other)
    return table.orderBy("Date", "Beat")


def linear_scorer(weights: dict[str, float], intercept: float = 0.0) -> Scorer:
    """Fixed weighted sum of feature columns."""

    def score(df: DataFrame, out: str) -> DataFrame:
        total = F.lit(intercept)
        for name, weight in weights.items():
            total = total + F.lit(weight) * F.col(name)
        return df.withColumn(out, total)

    return score


def with_features(model: object, columns: Sequence[str], vector: str = "features") -> Scorer:
    """Scorer of a model that reads an assembled vector."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=vector)
    return lambda df, out: model.predict(assembler.transform(df), out).drop(vector)
