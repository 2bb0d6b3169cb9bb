"""Work that must not grow with rows in one task, one method or one memory."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewatch.operators import impute as IM
from tidewatch.operators import model as MO
from tidewatch.operators import sampling as SA
from tidewatch.operators import scaling as SC
from tidewatch.operators import windows as WI
from tidewatch.plans import model as PM
from tidewatch.plans.features import FeatureSpec
from tidewatch.session import HUGE_METHOD, SPLIT_BYTES, cut_lineage, reads_saved, tasks_of_rows
from tidewatch.sources.tables import connections


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("keys,w,bucket", [(None, 9, 16), (["e"], 4, 5), (["e"], 1, 3)])
def test_rolling_sums_buckets_as_arrays_to_the_same_doubles(spark, keys, w, bucket):
    """NULL, NaN and infinite values, a NULL entity, constant stretches."""
    df = spark.range(400).select(
        F.col("id").alias("t"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("e"),
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") == 50, float("nan")).when(F.col("id") == 301, float("inf"))
        .when((F.col("id") > 100) & (F.col("id") < 140), 0.1).otherwise(F.sin("id") * 1e6).alias("x"))
    a = WI.rolling(df, ["x"], w, ["t"], keys, bucket_rows=bucket)
    b = WI.rolling(df, ["x"], w, ["t"], keys, strategy="window")
    assert a.dtypes == b.dtypes and a.count() == 400
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert "FlatMapGroupsInArrow" in _plan(a)


def test_training_rows_are_read_by_tasks_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(MO, "TASK_ROWS", 20_000)
    rng = spark.range(0, 100_000, 1, 4).select(*[F.rand(i).alias(f"f{i}") for i in range(20)], F.lit(0).alias("y"))
    rows = MO.assembled(rng, [f"f{i}" for i in range(20)], "y")
    before = spark.conf.get(SPLIT_BYTES)
    with tasks_of_rows(rows, 20_000) as n:
        sizes = rows.where("label = 0").rdd.glom().map(len).collect()
    assert n == sum(sizes) == 100_000 and max(sizes) <= 20_000
    assert spark.conf.get(SPLIT_BYTES) == before
    with tasks_of_rows(rows, 200_000):
        assert spark.conf.get(SPLIT_BYTES) == before


def test_fits_in_flight_follow_the_rows(spark, monkeypatch):
    pools = []
    pool = MO.ThreadPool
    monkeypatch.setattr(MO, "ThreadPool", lambda n: pools.append(n) or pool(n))
    d = spark.range(0, 300, 1, 1).select(F.rand(1).alias("a"), (F.col("id") % 2).cast("int").alias("is_attack"),
                                (F.col("id") % 3).cast("int").alias("fold"))
    cfg = MO.Boosting(max_depth=2, n_estimators=1)
    want = MO.fold_scores(d, ["a"], [{}], base=cfg).collect()
    monkeypatch.setattr(MO, "ROWS_IN_FLIGHT", 400, raising=False)
    assert MO.fold_scores(d, ["a"], [{}], base=cfg).collect() == want and pools == [3, 1]


def test_train_evaluates_its_input_once_and_scores_by_small_methods(spark, monkeypatch):
    seen = []
    split = SA.split_stratified
    monkeypatch.setattr(PM.SA, "split_stratified", lambda df, *a, **k: seen.append(df.inputFiles()) or split(df, *a, **k))
    spark.conf.set(HUGE_METHOD, "65535")
    t = PM.train(connections(spark, SF_SMALL), FeatureSpec(), MO.Boosting(max_depth=2, n_estimators=2))
    assert seen[0] and all("/tidewatch/rows-" in f for f in seen[0])
    assert PM.score_batch(t.test, t).count() == t.test.count()
    assert spark.conf.get(HUGE_METHOD) == "8000"


def _written(spark, monkeypatch):
    from tidewatch import session as S
    real, seen = S._written, []
    monkeypatch.setattr(S, "_written", lambda df, name, *a: seen.append((name, df.columns)) or real(df, name, *a))
    return seen


def test_rows_are_rolled_while_they_are_narrow(spark, monkeypatch):
    """NULLs in a rolled column, and an input column of a rolled one's name."""
    c = connections(spark, SF_SMALL).withColumn("src_bytes", F.when(F.col("conn_id") % 3 > 0, F.col("src_bytes")))
    t = PM.train(c, FeatureSpec(), MO.Boosting(max_depth=2, n_estimators=2))
    odd = t.rows.withColumn("duration_zscore", F.lit("mine"))
    seen = _written(spark, monkeypatch)
    got = PM.score_batch(odd, t)
    ranged, = [set(cols) for name, cols in seen if name == "ranged"]
    assert "unordered" not in [name for name, _ in seen]        # a saved table is not saved again
    assert len(ranged) <= len(odd.columns) + 3 + 3              # its copies, the copy of its odd column, ids
    assert got.select(odd.columns).exceptAll(odd).count() == 0 and got.count() == c.count()
    plain = PM.score_batch(c, t)
    cols = ["conn_id", "src_bytes", "probability", "prediction", "error"]
    assert got.select(cols).exceptAll(plain.select(cols)).count() == 0
    x = IM.transform(c, t.state.impute)
    want = t.spec._networked(FeatureSpec(rolling_strategy="window")._rolling(x, t.state.rolling_w))
    names = ["conn_id", *[f"{c}_{s}" for c in ("src_bytes", "dst_bytes", "duration") for s in ("rolling_mean", "rolling_std", "zscore")]]
    rolled = t.spec.with_rolling(c, t.state)
    # the z-scores are of the imputed values, the columns themselves are as given
    assert rolled.select(names).exceptAll(want.select(names)).count() == 0
    assert rolled.where("src_bytes IS NULL").count() == c.where("src_bytes IS NULL").count() > 0


def test_only_projections_of_saved_tables_are_read_twice(spark):
    saved = cut_lineage(spark.range(20).withColumn("a", F.col("id") % 3), "kept")
    assert reads_saved(saved) and reads_saved(saved.where("a > 0").select((F.col("id") + 1).alias("b")))
    for df in (saved.withColumn("r", F.rand()), saved.groupBy("a").count(), spark.range(3), saved.join(saved.select("id"), "id"),
               spark.read.parquet(f"{SF_SMALL}/orders.parquet")):
        assert not reads_saved(df)


def test_model_queries_make_connections_once(spark, monkeypatch):
    from tidewatch.catalog import q_model as Q
    calls = []
    monkeypatch.setattr(Q, "_CACHE", {})
    monkeypatch.setattr(Q, "connections", lambda *a: calls.append(a) or connections(*a))
    n = connections(spark, SF_SMALL).count()
    assert Q.q_score_batch(spark, SF_SMALL).count() == n and Q.q_explain_rows(spark, SF_SMALL).count() == n
    assert len(calls) == 1


def test_wide_passes_of_training_run_in_small_methods(spark, monkeypatch):
    spark.conf.set(HUGE_METHOD, "65535")
    limits = {}
    real = {"scaler": SC.fit, "assembled": MO.assembled}
    monkeypatch.setattr(SC, "fit", lambda *a: limits.setdefault("scaler", spark.conf.get(HUGE_METHOD)) and real["scaler"](*a))
    monkeypatch.setattr(MO, "assembled", lambda *a: limits.setdefault("assembled", spark.conf.get(HUGE_METHOD)) and real["assembled"](*a))
    PM.train(connections(spark, SF_SMALL), FeatureSpec(), MO.Boosting(max_depth=2, n_estimators=2))
    assert limits == {"scaler": "8000", "assembled": "8000"}
