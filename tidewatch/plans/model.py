"""Train and score: split first, fit state on train only, fit boosted trees
with a validation slice, score any table (or stream) with the same code."""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import alerts as AL
from ..operators import model as MO
from ..operators import sampling as SA
from ..session import cut_lineage
from .features import ROLLED, FeatureSpec, FeatureState, load_state, save_state


@dataclass
class Trained:
    model: PipelineModel
    spec: FeatureSpec
    state: FeatureState
    train: DataFrame | None = None      # transformed training rows
    test: DataFrame | None = None       # raw held-out rows
    rows: DataFrame | None = None       # all rows given, saved


def train(df: DataFrame, spec: FeatureSpec = FeatureSpec(), trees: MO.Boosting = MO.Boosting(),
          test_share: float = 0.2, validation_share: float = 0.2, seed: int = 42) -> Trained:
    # the split reads its input twice
    df = cut_lineage(df, "rows")
    # one ranking: train / validation (early-stopping slice of train) / test; saved, for the fits read it often
    split = cut_lineage(SA.split_stratified(df, spec.target, spec.key, 1 - test_share, seed,
                                            validation_frac=validation_share), "split")
    raw_train = split.filter(F.col("split") != "test") \
        .withColumn("is_validation", F.col("split") == "validation").drop("split")
    raw_test = split.filter(F.col("split") == "test").drop("split")
    # the boolean flag rides through the chain (features are numeric columns)
    state, x = spec.fit(raw_train)
    return Trained(_fitted(x, spec, state, trees), spec, state, x, raw_test, df)


def _fitted(x: DataFrame, spec: FeatureSpec, state: FeatureState, trees: MO.Boosting) -> PipelineModel:
    return MO.fit_boosted_trees(x, state.features, spec.target, trees, validation_col="is_validation")


def refit(t: Trained, trees: MO.Boosting) -> Trained:
    """Other trees on the same split and fitted features."""
    return dataclasses.replace(t, model=_fitted(t.train, t.spec, t.state, trees))


def input_problems(df: DataFrame, features: list[str]) -> Column:
    """NULL when the row is fit for the model, else an error text."""
    bad = [F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
                  | (F.abs(F.col(f).cast("double")) == F.lit(float("inf"))), F.lit(f))
           for f in features]
    names = F.concat_ws(",", *bad)
    return F.when(names != "", F.concat(F.lit("invalid features: "), names))


def score_batch(df: DataFrame, t: Trained, threshold: float = 0.5,
                as_of: dt.datetime | None = None, model_version: str = "v1",
                rolling: bool = True) -> DataFrame:
    """Input columns + prediction, prediction_label, probability, confidence,
    threat_level, timestamp (``as_of``, or the time of the query), model_version,
    error. Rows whose features are unusable are kept as rejected rows (NULL
    prediction, ``error`` set); a table without the columns that the features are
    made of is refused whole (``MissingInputs``)."""
    raw = {c: f"__raw_{c}" for c in df.columns}
    # columns that the rolling replaces are copied before it, all others behind its shuffles
    early = {c: r for c, r in raw.items() if c in ROLLED}
    carried = df.withColumns({r: F.col(c) for c, r in early.items()})
    if rolling:
        carried = t.spec.with_rolling(carried, t.state)
    carried = carried.withColumns({r: F.col(c) for c, r in raw.items() if c not in early})
    x = t.spec.transform(carried, t.state, drop_outliers=False, rolling=rolling, rolled=rolling)
    x = x.withColumn("error", input_problems(x, t.state.features))
    # one pass: rejected rows are predicted on neutral values and then masked,
    # instead of a valid/rejected split whose two branches would each
    # recompute the feature chain
    ok = F.col("error").isNull()
    safe = x.withColumns({f: F.when(ok, F.col(f)).otherwise(F.lit(0.0)) for f in t.state.features})
    pred = MO.predict(t.model, safe, threshold)
    pred = pred.withColumns({"probability": F.when(ok, F.col("probability")),
                             "prediction": F.when(ok, F.col("prediction"))})
    out = AL.apply_bands(pred, "probability", threshold, pred="prediction")
    keep = [F.col(r).alias(c) for c, r in raw.items()] + [
        "prediction", "prediction_label", "probability", "confidence", "threat_level", "error"]
    when = F.lit(as_of) if as_of is not None else F.current_timestamp()
    return out.select(*keep).withColumn("timestamp", when.cast("timestamp_ntz")) \
        .withColumn("model_version", F.lit(model_version))


def save_trained(t: Trained, base: str, version: str) -> str:
    """Model and feature state as version ``version`` below ``base``."""
    path = f"{base}/version={version}"
    save_state(t.spec, t.state, f"{path}/state")
    MO.save_model(t.model, path, metadata={"version": version, "features": t.state.features})
    return path


def load_trained(spark: SparkSession, base: str, version: str | None = None) -> tuple[Trained, str]:
    """(what ``score_batch`` needs, its version): the version named, or the one that
    comes last in the order of names."""
    if version is None:
        found = spark.read.text(f"{base}/version=*/metadata").select(F.get_json_object("value", "$.metadata").alias("m"))
        version = found.select(F.max(F.get_json_object("m", "$.version"))).first()[0]
    path = f"{base}/version={version}"
    spec, state = load_state(spark, f"{path}/state")
    model, _, _ = MO.load_model(spark, path)
    return Trained(model, spec, state), version
