"""Count regressions with a log link: Poisson, and zero-inflated negative binomial."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wardscope import sources
from wardscope.functions.numeric import digamma, log_gamma, trigamma
from wardscope.operators.scaling import Standardizer
from wardscope.schema import quoted
from wardscope.session import cut_lineage


@dataclass
class PoissonModel:
    """Standardized features and the fitted regression."""

    scaler: Standardizer
    regression: GeneralizedLinearRegressionModel

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the expected count."""
        columns = df.columns
        scored = self.regression.transform(_assemble(df, self.scaler, "_scaled"))
        return scored.select(*map(quoted, columns), F.col(self.regression.getPredictionCol()).alias(out))

    def pipeline(self) -> PipelineModel:
        """Scaling, assembling and regression; the stored model scores a table that has the feature columns."""
        return PipelineModel([*_inputs(self.scaler), self.regression])

    def save(self, df: DataFrame, path: str) -> None:
        """Store stages and scaling below a folder; ``df`` names the session."""
        _save(df, path, self, len(self.scaler.columns), None, [])

    @classmethod
    def load(cls, df: DataFrame, path: str) -> PoissonModel:
        """Load what :meth:`save` stored, into the session of ``df``."""
        stages, scaler, _ = _load(df, path)
        return cls(scaler, stages[2])


FACTS = "columns array<string>, means array<double>, deviations array<double>, inflation int, dispersion double, history array<double>"


def _save(df: DataFrame, path: str, model: PoissonModel | ZeroInflatedModel, inflation: int, dispersion: float | None, history: list[float]) -> None:
    scaler = model.scaler
    sources.save_model(model.pipeline(), path)
    facts = [(list(scaler.columns), list(scaler.means), list(scaler.deviations), inflation, dispersion, history)]
    sources.write_manifest(df.sparkSession.createDataFrame(facts, FACTS), f"{path}_facts")


def _load(df: DataFrame, path: str) -> tuple[list[Transformer], Standardizer, Row]:
    facts = df.sparkSession.read.schema(FACTS).json(f"{path}_facts").first()
    return sources.load_model(path).stages, Standardizer(tuple(facts.columns), tuple(facts.means), tuple(facts.deviations)), facts


def _inputs(scaler: Standardizer) -> list[Transformer]:
    """What ``_assemble`` does, as stages that can be stored."""
    scaled = ", ".join(f"(`{c}` - {mean!r}D) / {deviation!r}D AS `{c}__z`" if deviation > 0 else f"0.0D AS `{c}__z`"
                       for c, mean, deviation in zip(scaler.columns, scaler.means, scaler.deviations))
    return [SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
            VectorAssembler(inputCols=[f"{c}__z" for c in scaler.columns], outputCol="_scaled")]


def _assemble(df: DataFrame, scaler: Standardizer, out: str) -> DataFrame:
    scaled = scaler.transform(df, "__z")
    return VectorAssembler(inputCols=[f"{c}__z" for c in scaler.columns], outputCol=out).transform(scaled)


def _log_regression(label: str, weight: str | None, alpha: float, iterations: int) -> GeneralizedLinearRegression:
    regression = GeneralizedLinearRegression(family="poisson", link="log", featuresCol="_scaled", labelCol=label,
                                             predictionCol="_mu", regParam=alpha, maxIter=iterations)
    return regression.setWeightCol(weight) if weight else regression


def poisson_glm(df: DataFrame, label: str, columns: Sequence[str], weight: str | None = None, alpha: float = 1e-4,
                iterations: int = 50) -> PoissonModel:
    """Poisson regression on standardized features."""
    scaler = Standardizer.fit(df, columns)
    rows = _assemble(df, scaler, "_scaled").withColumn("_y", F.col(label).cast("double"))
    return PoissonModel(scaler, _log_regression("_y", weight, alpha, iterations).fit(rows))


@dataclass
class ZeroInflatedModel:
    """Count part, zero part (None when the target has no zeros) and dispersion."""

    scaler: Standardizer
    inflation_scaler: Standardizer
    regression: GeneralizedLinearRegressionModel
    zeros: LogisticRegressionModel | None
    dispersion: float
    history: list[float]

    def parts(self, df: DataFrame) -> DataFrame:
        """Add ``_mu`` and the probability of a structural zero ``_pi``."""
        rows = _assemble(df, self.scaler, "_scaled")
        inputs = [f"{c}__z" for c in self.inflation_scaler.columns]
        return self.score(VectorAssembler(inputCols=inputs, outputCol="_inflation").transform(rows))

    def score(self, rows: DataFrame) -> DataFrame:
        """``parts`` of rows that have the assembled features."""
        rows = self.regression.transform(rows)
        if self.zeros is None:
            return rows.withColumn("_pi", F.lit(0.0))
        return self.zeros.transform(rows).withColumn("_pi", vector_to_array("_zero_probability")[1])

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add the expected count."""
        scored = self.parts(df).withColumn(out, (1 - F.col("_pi")) * F.col("_mu"))
        return scored.select(*(quoted(c) for c in df.columns if c != out), out)

    def pipeline(self) -> PipelineModel:
        """Scaling, count part (``_mu``) and zero part (``_zero_probability``) as stages that can be stored."""
        zeros = [] if self.zeros is None else [VectorAssembler(
            inputCols=[f"{c}__z" for c in self.inflation_scaler.columns], outputCol="_inflation"), self.zeros]
        return PipelineModel([*_inputs(self.scaler), self.regression, *zeros])

    def save(self, df: DataFrame, path: str) -> None:
        """Store stages, scaling, dispersion and history below a folder; ``df`` names the session."""
        _save(df, path, self, len(self.inflation_scaler.columns), self.dispersion, self.history)

    @classmethod
    def load(cls, df: DataFrame, path: str) -> ZeroInflatedModel:
        """Load what :meth:`save` stored, into the session of ``df``."""
        stages, scaler, facts = _load(df, path)
        n = facts.inflation
        inflated = Standardizer(scaler.columns[:n], scaler.means[:n], scaler.deviations[:n])
        return cls(scaler, inflated, stages[2], stages[4] if len(stages) > 3 else None, facts.dispersion, list(facts.history))

    def zero_probability(self, df: DataFrame, out: str = "p_zero") -> DataFrame:
        """Add the probability of observing zero."""
        scored = self.parts(df)
        p = F.col("_pi") + (1 - F.col("_pi")) * _nb_zero(F.col("_mu"), self.dispersion)
        return scored.withColumn(out, p).select(*map(quoted, df.columns), out)


def _nb_zero(mu: Column, dispersion: float) -> Column:
    return F.pow(1 + dispersion * mu, F.lit(-1.0 / dispersion))


def _nb_log_chance(y: Column, mu: Column, r: float) -> Column:
    """Logarithm of the negative binomial probability of ``y``; ``r`` is one over the dispersion."""
    size = F.lit(r)
    return (log_gamma(y + size) - log_gamma(size) - log_gamma(y + 1) - size * F.log1p(mu / size)
            + F.when(y > 0, y * F.log(mu / (size + mu))).otherwise(0.0))


def best_dispersion(rows: DataFrame, y: str, mu: str, weight: str, start: float = 0.5, low: float = 1e-4, high: float = 1e4,
                    tolerance: float = 1e-6, rounds: int = 40) -> float:
    """Dispersion between ``low`` and ``high`` of the largest weighted negative binomial likelihood at the expected counts ``mu``.

    Newton steps on the logarithm of r = 1 / dispersion, each one aggregate of the first two derivatives; a step that leaves
    the interval known to hold the optimum is replaced by its end or its middle.
    """
    left, right = -math.log(high), -math.log(low)
    at, ends = min(max(-math.log(start), left), right), {left, right}
    for _ in range(rounds):
        r = math.exp(at)
        count, mean, size = F.col(y), F.col(mu), F.lit(r)
        slope = digamma(count + size) - digamma(size) - F.log1p(mean / size) + (mean - count) / (size + mean)
        curve = trigamma(count + size) - trigamma(size) + mean / (size * (size + mean)) - (mean - count) / ((size + mean) * (size + mean))
        first, second = (v or 0.0 for v in rows.agg(F.sum(F.col(weight) * slope), F.sum(F.col(weight) * curve)).first())
        g, h = r * first, r * first + r * r * second
        if (g >= 0 and at == right) or (g <= 0 and at == left):
            break  # the likelihood still rises at a bound
        left, right = (at, right) if g > 0 else (left, at)
        step = at - g / h if h < 0 else (right if g > 0 else left)
        if not left < step < right:
            end = right if g > 0 else left
            step = end if end in ends else (left + right) / 2
        ends.discard(step)
        if abs(step - at) < tolerance:
            at = step
            break
        at = step
    return math.exp(-at)


def zinb(df: DataFrame, label: str, columns: Sequence[str], inflation: int = 5, rounds: int = 8, alpha: float = 1e-4,
         tolerance: float = 1e-4) -> ZeroInflatedModel:
    """Zero-inflated negative binomial regression by expectation and maximisation.

    The zero part uses the first ``inflation`` features. Each round weighs the rows by the probability that they
    are no structural zero, refits both parts as weighted MLlib regressions and takes the dispersion of the largest likelihood.
    Weights divided by 1 + αμ turn the Poisson equations into those of the negative binomial. ``history`` holds the
    log-likelihood of the model of each round; it never falls, as a round that would lower it ends the fit and is not taken.
    """
    scaler = Standardizer.fit(df, columns)
    rows = _assemble(df, scaler, "_scaled").withColumn("_y", F.col(label).cast("double"))
    inflated = Standardizer(scaler.columns[:inflation], scaler.means[:inflation], scaler.deviations[:inflation])
    rows = VectorAssembler(inputCols=[f"{c}__z" for c in inflated.columns], outputCol="_inflation").transform(rows)
    rows = cut_lineage(rows.select("_y", "_scaled", "_inflation"))
    start = _log_regression("_y", None, alpha, 25).fit(rows)
    zero_share = rows.agg(F.avg((F.col("_y") == 0).cast("double"))).first()[0] or 0.0
    model, taken = ZeroInflatedModel(scaler, inflated, start, None, 0.5, []), None
    logistic = LogisticRegression(featuresCol="_inflation", labelCol="_zero", weightCol="_share", regParam=1e-4,
                                  probabilityCol="_zero_probability", rawPredictionCol="_zero_raw",
                                  predictionCol="_zero_prediction", maxIter=50)
    for k in range(rounds + 1):
        scored = model.score(rows)
        if not k:
            scored = scored.withColumn("_pi", F.lit(zero_share / 2))
        base = _nb_zero(F.col("_mu"), model.dispersion)
        chance = F.col("_pi") + (1 - F.col("_pi")) * base
        loss = F.when(F.col("_y") == 0, F.log(chance)).otherwise(
            F.log1p(-F.col("_pi")) + _nb_log_chance(F.col("_y"), F.col("_mu"), 1 / model.dispersion))
        kept = F.when(F.col("_y") == 0, (1 - F.col("_pi")) * base / chance).otherwise(1.0)
        state = cut_lineage(scored.select("_y", "_scaled", "_inflation", "_mu", kept.alias("_kept"), loss.alias("_loss")))
        if k:  # the first state is only a start, not a model
            reached = state.agg(F.sum("_loss")).first()[0] or 0.0
            history = taken.history if taken else []
            if history and reached < history[-1]:
                break
            taken = replace(model, history=[*history, reached])
            if k == rounds or (history and reached - history[-1] <= tolerance * (abs(reached) + 1)):
                break

        weighted = state.withColumn("_share", F.col("_kept") / (1 + model.dispersion * F.col("_mu"))).drop("_mu")
        regression = _log_regression("_y", "_share", alpha, 25).fit(weighted.filter("_share > 0"))
        expected = cut_lineage(regression.transform(weighted).select("_y", "_mu", "_kept"))
        model = replace(model, regression=regression, dispersion=best_dispersion(expected, "_y", "_mu", "_kept", model.dispersion))
        if zero_share > 0:
            halves = F.explode(F.array(F.struct(F.lit(1.0).alias("_zero"), (1 - F.col("_kept")).alias("_share")),
                                       F.struct(F.lit(0.0).alias("_zero"), F.col("_kept").alias("_share"))))
            stacked = state.select("_inflation", halves.alias("h")).select("_inflation", "h.*").filter("_share > 0")
            model.zeros = logistic.fit(stacked)
    return taken or model
