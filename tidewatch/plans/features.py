"""The feature chain: impute -> fence -> network -> statistical -> interactions
-> encode -> scale, as ``fit(df) -> FeatureState`` and a lazy
``transform(df, state)`` that batch scoring and streams share.

Every piece of fitted state (medians/modes, fence bounds, percentile
thresholds, rolling width, category dictionary, scaler moments) is a small
table, collected once and applied as literals; nothing is recomputed on the
data being scored (the reference refits several of them at scoring time).
"""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import encoders as EN
from ..operators import features as FE
from ..operators import impute as IM
from ..operators import outliers as OU
from ..operators import scaling as SC
from ..operators import windows as WI
from ..schemas import numeric_columns, string_columns
from ..session import cut_lineage, small_methods

ROLLING_COLUMNS = ["src_bytes", "dst_bytes", "duration"]
ROLLED = [f"{c}_{s}" for c in ROLLING_COLUMNS for s in ("rolling_mean", "rolling_std", "zscore")]


@dataclass
class FeatureState:
    impute: DataFrame
    fences: DataFrame | None
    percentiles: DataFrame
    rolling_w: int
    dictionary: DataFrame
    scaler: DataFrame | None
    features: list[str] = field(default_factory=list)

    def tables(self) -> dict[str, DataFrame]:
        out = {"impute": self.impute, "percentiles": self.percentiles,
               "dictionary": self.dictionary}
        if self.fences is not None:
            out["fences"] = self.fences
        if self.scaler is not None:
            out["scaler"] = self.scaler
        return out


class MissingInputs(ValueError):
    """A table lacks columns that the model's features are made of."""


class VanishedClass(ValueError):
    """The fence would remove every training row of a class."""


@dataclass
class FeatureSpec:
    key: str = "conn_id"
    order: tuple = ("ts", "conn_id")
    entity: tuple = ()
    target: str = "is_attack"
    attack_type: str = "attack_type"
    fence: str | None = "iqr"           # 'iqr', 'zscore' or None: outliers stay in the fit
    fence_mode: str = "joint"
    zscore_limit: float = 3.0
    encoding: str = "onehot"            # or 'label'
    scale: bool = True
    quantile_method: str = "exact"
    rolling_strategy: str = "halo"

    @property
    def protected(self) -> tuple:
        return (self.key, self.target, *self.order, *self.entity)

    # -- fit -------------------------------------------------------------------------
    def fit(self, df: DataFrame) -> tuple[FeatureState, DataFrame]:
        """Fit every state table on ``df``; returns (state, transformed fit table
        with outliers removed)."""
        excl = self.protected + (self.attack_type,)
        imp = IM.fit(df, numeric_columns(df, excl), string_columns(df, excl), excl,
                     self.quantile_method)
        x = IM.transform(df, imp)
        fences = None
        if self.fence is not None:
            cols = numeric_columns(x, excl)
            fences = (OU.fit_iqr(x, cols, 1.5, self.fence_mode, excl, self.quantile_method)
                      if self.fence == "iqr"
                      else OU.fit_zscore(x, cols, self.zscore_limit, self.fence_mode, excl))
            # a column whose quartiles are equal (flags, mostly zeros) has no spread to
            # fence: everything but its common value, so most attacks, would go
            fences = fences.where("lower < upper")
            self._check_classes(x, fences)
            x = OU.apply(x, fences)
        w = WI.rolling_window_size(x.count())
        # the remaining fits are separate passes: save the rolled table once, while it is narrow
        small_methods(df.sparkSession)      # all passes from here, that of the assembled rows too, are wide
        x = self._networked(cut_lineage(self._rolling(x, w), "features_fit"))
        pct = FE.fit_percentile_flags(x, numeric_columns(x, excl)[:5], method=self.quantile_method)
        x = FE.apply_percentile_flags(x, pct)
        x = FE.interactions(x)
        cats = string_columns(x, excl)
        dic = EN.fit_dictionary(x, cats)
        x = EN.encode(x, dic, self.encoding)
        scaler = None
        if self.scale:
            scaler = SC.fit(x, numeric_columns(x, excl))
            x = SC.transform(x, scaler)
        feats = numeric_columns(x, excl)
        state = FeatureState(imp, fences, pct, w, dic, scaler, feats)
        return state, x

    def _check_classes(self, x: DataFrame, fences: DataFrame) -> None:
        left = OU.flag(x, fences).groupBy(self.target).agg(F.count_if(F.col("is_outlier") == 0).alias("n"))
        gone = [r[self.target] for r in left.where("n = 0").collect()]
        if gone:
            raise VanishedClass(f"the {self.fence} fence leaves no row of {self.target} = {gone}")

    # -- transform ----------------------------------------------------------------------
    def transform(self, df: DataFrame, state: FeatureState, drop_outliers: bool = False,
                  rolling: bool = True, rolled: bool = False) -> DataFrame:
        """``df`` with the features of ``state``; ``MissingInputs`` names those that
        ``df`` has no columns for (a category that it merely does not hold is a flag
        of zeros). Without ``rolling`` the row-order features are their neutral 0;
        ``rolled``: ``df`` has them from ``with_rolling``."""
        small_methods(df.sparkSession)
        x = df
        if state.fences is not None and drop_outliers:
            x = OU.apply(IM.transform(x, state.impute), state.fences)
        if rolling and not rolled:
            x = self.with_rolling(x, state)
        elif not rolling:
            x = x.withColumns({c: F.lit(0.0) for c in ROLLED if c.rpartition("_")[0].removesuffix("_rolling") in x.columns})
        x = IM.transform(x, state.impute)
        if state.fences is not None and not drop_outliers:
            x = OU.flag(x, state.fences)
        x = self._networked(x)
        x = FE.apply_percentile_flags(x, state.percentiles)
        x = FE.interactions(x)
        x = EN.encode(x, state.dictionary, self.encoding)
        if state.scaler is not None:
            x = SC.transform(x, state.scaler)
        missing = sorted(set(state.features) - set(x.columns))
        if missing:
            raise MissingInputs(f"no input for the features {missing}")
        return x

    def with_rolling(self, df: DataFrame, state: FeatureState) -> DataFrame:
        """``df`` with the row-order features of its imputed values. Its own columns stay
        as they are: all others are made of them later, behind the shuffles."""
        own = {c: f"__own_{c}" for c in ROLLING_COLUMNS if c in df.columns}
        x = df.withColumns({o: F.col(c) for c, o in own.items()})
        x = self._rolling(IM.transform(x, state.impute.where(F.col("column").isin(*own))), state.rolling_w)
        return x.withColumns({c: F.col(o) for c, o in own.items()}).drop(*own.values())

    @staticmethod
    def _networked(x: DataFrame) -> DataFrame:
        """Network features, in front of the row-order ones (trees pick features by place)."""
        x = FE.network_features(x)
        return x.select(*[c for c in x.columns if c not in ROLLED], *[c for c in x.columns if c in ROLLED])

    def _rolling(self, x: DataFrame, w: int) -> DataFrame:
        cols = [c for c in ROLLING_COLUMNS if c in x.columns]
        if not cols or not all(o in x.columns for o in self.order):
            return x
        r = WI.rolling(x, cols, w, list(self.order), list(self.entity) or None,
                       strategy=self.rolling_strategy)
        # a one-row frame has no deviation: 0 in the model chain (raw operator keeps NULL)
        return r.withColumns({f"{c}_{s}": F.coalesce(F.col(f"{c}_{s}"), F.lit(0.0))
                              for c in cols for s in ("rolling_std", "zscore")})


def save_state(spec: FeatureSpec, state: FeatureState, path: str) -> None:
    """Everything ``transform`` needs: the state tables, and one row with the
    feature names, the rolling width and the spec's own settings."""
    for name, table in state.tables().items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    settings = dataclasses.asdict(spec)
    row = (json.dumps(state.features), state.rolling_w, json.dumps(settings), sorted(state.tables()))
    spark = state.impute.sparkSession
    spark.createDataFrame([row], "features string, rolling_w int, spec string, tables array<string>").write.mode(
        "overwrite").json(f"{path}/settings")


def load_state(spark: SparkSession, path: str) -> tuple[FeatureSpec, FeatureState]:
    """What ``save_state`` wrote."""
    row = spark.read.schema("features string, rolling_w int, spec string, tables array<string>").json(
        f"{path}/settings").first()
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in row["tables"]}
    kw = json.loads(row["spec"])
    kw.update(order=tuple(kw["order"]), entity=tuple(kw["entity"]))
    state = FeatureState(tables["impute"], tables.get("fences"), tables["percentiles"], row["rolling_w"],
                         tables["dictionary"], tables.get("scaler"), json.loads(row["features"]))
    return FeatureSpec(**kw), state
