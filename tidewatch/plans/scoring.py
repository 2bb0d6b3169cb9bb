"""Scored tables: connections -> P(attack) -> bands.

``rule_scored`` uses the deterministic rule-based probability so that every
post-scoring operator (bands, alerts, statistics, evaluation) can be checked
against plain SQL. ``score_batch`` (plans/model) produces the same layout
from a fitted model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.alerts import apply_bands
from ..sources.tables import connections, risk_probability


def rule_scored(spark: SparkSession, sf_dir: str, threshold: float = 0.5,
                materialize: bool = False) -> DataFrame:
    return apply_bands(risk_probability(connections(spark, sf_dir, materialize)),
                       "probability", threshold)


def eval_frame(scored: DataFrame, y: str = "is_attack", p: str = "probability",
               pred: str = "prediction") -> DataFrame:
    """The (y, pred, p) triple every evaluation operator reads."""
    return scored.select(F.col(y).alias("y"), F.col(pred).alias("pred"),
                         F.col(p).alias("p"))
