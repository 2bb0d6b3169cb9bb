"""Model quality floor and persistence; streams equal batch; late data."""

import json
import math

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import SF_SMALL
from tidewatch.sources import sinks as SK
from tidewatch.operators import alerts as AL
from tidewatch.operators import evaluate as EV
from tidewatch.operators import model as MO
from tidewatch.operators import tpe
from tidewatch.plans.features import FeatureSpec
from tidewatch.plans.model import score_batch, train
from tidewatch.session import scratch_path
from tidewatch.sources.tables import connections, events, risk_probability
from tidewatch.operators import windows as WI
from tidewatch.streaming import alarm as SAL
from tidewatch.streaming import rolling as SR
from tidewatch.streaming import scoring as SS


@pytest.fixture(scope="module")
def trained(spark):
    return train(connections(spark, SF_SMALL), FeatureSpec(), MO.Boosting(max_depth=3, n_estimators=5))


def test_model_auc_floor_and_rejects(spark, trained):
    s = score_batch(trained.test, trained)
    assert s.count() == trained.test.count()                 # scoring keeps every row
    ev = s.filter(F.col("prediction").isNotNull()).select(
        F.col("is_attack").alias("y"), F.col("prediction").alias("pred"),
        F.col("probability").alias("p"))
    assert EV.auc_roc(ev).first()["auc"] > 0.9
    assert set(s.columns) >= {"prediction", "prediction_label", "probability", "confidence",
                              "threat_level", "timestamp", "model_version", "error"}


def test_save_load_same_scores(spark, trained):
    path = scratch_path(spark, "model_test")
    MO.save_model(trained.model, path, trained.state.tables(), {"version": "t"})
    model, state, meta = MO.load_model(spark, path, list(trained.state.tables()))
    x = trained.spec.transform(trained.test, trained.state)
    a = MO.predict(trained.model, x).select("conn_id", "probability")
    b = MO.predict(model, x).select("conn_id", "probability")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert meta == {"version": "t"}


def test_importance_and_explanations(spark, trained):
    imp = MO.feature_importance(trained.model, trained.state.features)
    assert imp.count() == len(trained.state.features)
    x = trained.spec.transform(trained.test, trained.state)
    e = MO.explain_rows(MO.predict(trained.model, x), imp, 3).first()["explanation"]
    assert len(e) == 3 and {"feature", "importance", "value"} <= set(e[0].asDict())


@pytest.mark.parametrize("name", ["explain_rows", "sink_model", "process_features"])
def test_model_queries_cover_all_connections(spark, name):
    got = queries()[name](spark, SF_SMALL).select("conn_id")
    want = connections(spark, SF_SMALL).select("conn_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _score(df):
    return AL.apply_bands(risk_probability(df)).select("conn_id", "probability", "threat_level")


def test_stream_equals_batch(spark):
    c = connections(spark, SF_SMALL)
    src = scratch_path(spark, "t_src")
    c.repartition(3).write.parquet(src)
    sink = scratch_path(spark, "t_sink")
    SS.score_stream(spark, src, c.schema, _score, sink, scratch_path(spark, "t_ck"),
                    max_files_per_trigger=1)
    a, b = spark.read.parquet(sink), _score(c)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_events_beyond_watermark_are_dropped(spark):
    e = events(spark, SF_SMALL).select("event_id", "ts", "event_type")
    src = scratch_path(spark, "late_src")
    sink = scratch_path(spark, "late_sink")
    ck = scratch_path(spark, "late_ck")
    on_time = e.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    late = e.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    for i, part in enumerate([on_time, late]):
        part.write.parquet(f"{src}/part={i}")
        s = SS.file_stream(spark, f"{src}/part=*", e.schema)
        SAL.start_period_stream(s, "ts", sink, ck, None, "1 hour", "1 hour").awaitTermination()
    per = SAL.current_periods(spark, sink)
    # the second arrival is days behind the watermark: none of its periods appear
    assert per.filter(F.col("period_start") < F.lit("2024-01-02").cast("timestamp_ntz")).count() == 0
    assert per.agg(F.sum("metric")).first()[0] == on_time.count()


def test_tuning_result_feeds_training(spark, trained):
    from tidewatch.operators import sampling as SA
    folded = SA.fold_stratified(trained.train, "is_attack", "conn_id", 2, 42)
    res = MO.cross_validate_grid(folded, trained.state.features,
                                 MO.grid_combos({"max_depth": [2, 3], "n_estimators": [3]}),
                                 "fold", "is_attack", MO.Boosting(n_estimators=3), 2, "grid")
    cfg = MO.best_config(res, MO.Boosting(n_estimators=3))
    assert cfg.max_depth in (2, 3) and cfg.n_estimators == 3
    assert res.count() == 2 and res.filter(F.col("mean_auc") > 0.5).count() == 2


def _rolled(spark, e, parts, w, **options):
    src, sink, ck = (scratch_path(spark, f"roll_{x}") for x in ("src", "sink", "ck"))
    for i, part in enumerate(parts):
        part.write.parquet(f"{src}/part={i}")
        stream = SS.file_stream(spark, f"{src}/part=*", e.schema)
        with SR.rocksdb_state(spark):
            SR.rolling_stream(stream, "who", "ts", "id", "value", w, **options).writeStream.format("parquet").option(
                "path", sink).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink)


def _rounded(df):
    return sorted(tuple("none" if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(
        "id", F.coalesce("who", F.lit("-")).alias("who"), "value_rolling_mean", "value_rolling_std", "value_zscore").collect())


def test_rolling_stream_with_text_keys_nulls_and_late_rows(spark):
    e = events(spark, SF_SMALL).select(
        F.concat(F.lit("e"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias("id"), "ts", "value",
        F.when(F.col("user_id") % 5 > 0, F.concat(F.lit("u"), F.col("user_id") % 5)).alias("who"))
    cut = F.lit("2024-01-12").cast("timestamp_ntz")
    got = _rolled(spark, e, [e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut)], 7)
    want = WI.rolling(e, ["value"], 7, ["ts", "id"], ["who"])
    assert _rounded(got) == _rounded(want) and got.filter(F.col("who").isNull()).count() > 0
    # the middle third comes last: on time for nothing, yet every row after it counts it
    rows = spark.createDataFrame([("a", "x", i, float(i)) for i in range(6)], "id string, who string, i int, value double")
    rows = rows.withColumn("id", F.concat("id", "i")).withColumn("ts", F.timestamp_seconds(F.col("i") * 60)).drop("i")
    late = _rolled(spark, rows, [rows.filter("id <> 'a3' AND id < 'a5'"), rows.filter("id = 'a3'"), rows.filter("id = 'a5'")], 4)
    mean = {r["id"]: r["value_rolling_mean"] for r in late.collect()}
    assert mean["a4"] == (0 + 1 + 2 + 4) / 4 and mean["a3"] == (1 + 2 + 3) / 3 and mean["a5"] == (2 + 3 + 4 + 5) / 4


def test_rolling_stream_rolls_many_entities_of_a_bucket_with_exact_whole_numbers(spark):
    big = (1 << 53) + 1      # no double holds it
    rows = [(None if i % 31 == 0 else big + 2 * i, None if i % 7 == 0 else big + 2 * (i % 7), i * 37 % 600,
             None if i % 13 == 0 else float("inf") if i == 50 else float(i * i % 101)) for i in range(300)]
    e = spark.createDataFrame(rows, "id long, who long, s long, value double").select(
        "id", "who", F.timestamp_seconds("s").alias("ts"), "value")
    got = _rolled(spark, e, [e.filter("unix_seconds(ts) < 250"), e.filter("unix_seconds(ts) >= 250")], 5, buckets=2).collect()
    want, seen = {}, {}
    for id_, who, s, v in sorted(rows, key=lambda r: r[2]):
        frame = seen.setdefault(who, [])
        frame.append(v)
        x = [f for f in frame[-5:] if f is not None and f != float("inf")]
        mean = sum(x) / len(x) if x else None
        std = (sum((f - mean) ** 2 for f in x) / (len(x) - 1)) ** 0.5 if len(x) > 1 else None
        want[s] = (id_, who, v, mean, std)
    at = {(id_, who, v): s for id_, who, s, v in rows}
    assert len(got) == len(rows) and len(at) == len({(r["id"], r["who"], r["value"]) for r in got})
    for r in got:
        _, _, _, mean, std = want[at[r["id"], r["who"], r["value"]]]
        assert (r["value_rolling_mean"], r["value_rolling_std"]) == (
            None if mean is None else pytest.approx(mean), None if std is None else pytest.approx(std))


def test_alarms_appear_while_the_stream_runs_and_equal_batch(spark):
    e = events(spark, SF_SMALL).select("ts", "value", F.when(F.col("user_id") % 3 > 0, F.col("user_id") % 3).alias("k"))
    src, sink, ck = (scratch_path(spark, f"alarms_{x}") for x in ("src", "sink", "ck"))
    last = e.agg(F.max("ts")).first()[0]
    cuts = ["2024-01-01", "2024-01-08", "2024-01-09", "2024-01-20", "2200-01-01"]
    parts = [e.filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
             for a, b in zip(cuts, cuts[1:])]
    beat = spark.range(1).select((F.lit(last) + F.expr("INTERVAL 9 DAYS")).cast("timestamp_ntz").alias("ts"),
                                 F.lit(0.0).alias("value"), F.lit(9).cast(e.schema["k"].dataType).alias("k"))
    seen = []
    for i, part in enumerate([*parts, beat, beat]):
        part.write.parquet(f"{src}/part={i}")
        stream = SS.file_stream(spark, f"{src}/part=*", e.schema)
        SAL.start_alarm_stream(stream, "ts", sink, ck, F.lit(1.0), "1 day", 86400, 3.0, ">", 3, "6 hours",
                               keys=["k"]).awaitTermination()
        seen.append(SAL.read_alarms(spark, sink).filter("alarm = 1").count())
    assert 0 < seen[0] < seen[2] < seen[-1]
    want = AL.windowed_alarm(e, "ts", F.lit(1.0), "1 day", 86400, "sum", 3.0, ">", 3, ["k"])
    cols = ["k", "period_start", "metric", "breaching", "period_index", "run_length", "alarm"]
    got = SAL.read_alarms(spark, sink).select(cols)
    assert got.exceptAll(want.select(cols)).count() == 0 and want.select(cols).exceptAll(got).count() == 0


def test_loaded_parts_score_every_row_alike(spark, trained):
    from tidewatch.plans.model import load_trained, save_trained
    base = scratch_path(spark, "versions")
    save_trained(trained, base, "v1")
    save_trained(trained, base, "v2")
    back, version = load_trained(spark, base)
    assert version == "v2" and back.state.features == trained.state.features
    assert back.spec == trained.spec and back.state.rolling_w == trained.state.rolling_w
    c = connections(spark, SF_SMALL)
    cols = ["conn_id", "probability", "prediction", "threat_level", "error"]
    a, b = (score_batch(c, t).select(cols) for t in (trained, back))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scoring_refuses_a_table_without_inputs(spark, trained):
    from tidewatch.plans.features import MissingInputs
    c = connections(spark, SF_SMALL)
    with pytest.raises(MissingInputs, match="serror_rate"):
        score_batch(c.drop("serror_rate"), trained)
    # a category that is not there is no missing input
    assert score_batch(c.filter("protocol_type = 'tcp'"), trained).filter("prediction IS NULL AND error IS NULL").count() == 0


def _attacks(spark, n=600):
    """KDD-shaped rows: attacks differ in columns that are zero for nearly all others."""
    return spark.range(n).select(
        F.col("id").alias("conn_id"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).cast("double").alias("duration"), F.lit("tcp").alias("protocol_type"),
        F.when(F.col("id") % 10 == 0, 1.0).otherwise(0.0).alias("serror_rate"),
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(0).alias("hot"),
        F.when(F.col("id") % 10 == 0, "smurf").otherwise("normal").alias("attack_type"),
        (F.col("id") % 10 == 0).cast("int").alias("is_attack"))


def test_fence_keeps_both_classes_of_kdd_shaped_data(spark):
    from tidewatch.plans.features import VanishedClass
    _, x = FeatureSpec().fit(_attacks(spark))
    assert {r["is_attack"] for r in x.select("is_attack").distinct().collect()} == {0, 1}
    far = _attacks(spark).withColumn("duration", F.when(F.col("is_attack") == 1, 1e6).otherwise(F.col("duration")))
    with pytest.raises(VanishedClass):
        FeatureSpec().fit(far)


def test_early_stopping_cuts_the_trees(spark):
    assert MO.best_round([5, 4, 3, 3, 4, 2], 2) == 3 and MO.best_round([5, 4, 3, 3, 4, 2], 3) == 6
    assert MO.best_round([3, 4, 5], 1) == 1 and MO.best_round([3, 2, 5, 1], 0) == 4
    d = spark.range(600).select(
        ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 53) % 89).cast("double").alias("b"),
        (F.col("id") % 3 == 0).alias("held")).withColumn("is_attack", ((F.col("a") * 7 + F.col("b") * 13) % 10 < 4).cast("int"))
    cfg = lambda n: MO.Boosting(max_depth=5, learning_rate=0.5, n_estimators=12, early_stopping_rounds=n)
    cut, whole = (MO.fit_boosted_trees(d, ["a", "b"], cfg=cfg(n), validation_col="held").stages[-1] for n in (1, 0))
    assert whole.getNumTrees == 12 and cut.getNumTrees < 12
    assert cut.treeWeights == whole.treeWeights[:cut.getNumTrees]
    assert MO.predict(MO.fit_boosted_trees(d, ["a", "b"], cfg=cfg(1), validation_col="held"), d).count() == 600


def test_fold_rows_and_search_points(spark, trained):
    from tidewatch.operators import sampling as SA
    folded = SA.fold_stratified(trained.train, "is_attack", "conn_id", 5, 42)
    cv = MO.cross_validate(folded, trained.state.features, cfg=MO.Boosting(max_depth=2, n_estimators=2)).collect()
    assert sorted(r["fold"] for r in cv) == [0, 1, 2, 3, 4]
    assert cv[0]["mean_auc"] == pytest.approx(sum(r["auc"] for r in cv) / 5)
    points = MO.random_combos({"a": [1, 2], "b": [1, 2, 3]}, 99)
    assert len(points) == 6 and len({tuple(sorted(p.items())) for p in points}) == 6
    assert MO.configured(MO.Boosting(), {"min_child_weight": 5}).min_child_rows == 5
    with pytest.raises(ValueError):
        MO.configured(MO.Boosting(), {"gamma": 1})


def test_report_of_model_scores_reads_back(spark, tmp_path):
    rows = [(i % 2, int(i % 3 == 0), (i % 7) / 7) for i in range(70)] + [(1, None, None)]
    parts = EV.evaluate_all(spark.createDataFrame(rows, "y int, pred int, p double"))
    long = EV.report_long(parts)
    assert long.schema.simpleString() == "struct<" + EV.REPORT_DDL.replace(", ", ",").replace(" ", ":") + ">"
    SK.write_report(long, str(tmp_path / "report"))
    back = SK.read_table(spark, str(tmp_path / "report"), "json", EV.REPORT_DDL)
    assert sorted(map(str, back.collect())) == sorted(map(str, long.collect()))
    assert back.where("section = 'roc_curve' AND threshold = double('inf')").count() == 2


def test_tuning_report_gives_the_best_parameters_back(spark, tmp_path):
    res = spark.createDataFrame([("random", '{"max_depth": 3}', 0.7, 0.1), ("random", '{"max_depth": 5}', None, None),
                                 ("fine", '{"learning_rate": 0.2, "max_depth": 4}', 0.9, 0.0)],
                                "method string, params string, mean_auc double, std_auc double")
    SK.write_report(res, str(tmp_path / "tuning"))
    back = SK.read_table(spark, str(tmp_path / "tuning"), "json", res.schema)
    best = MO.best_config(back)
    assert (best.max_depth, best.learning_rate, best.n_estimators) == (4, 0.2, 100) and best == MO.best_config(res)


def test_searches_cover_the_default_grid_and_space():
    assert len(MO.grid_combos()) == 108 and all(MO.configured(MO.Boosting(), c) for c in MO.grid_combos())
    draws = MO.random_combos(n_iter=50)
    assert len({str(d) for d in draws}) == 50 and all(MO.configured(MO.Boosting(), d) for d in draws)


def _rows_of_two_classes(spark, n=300):
    return spark.range(0, n, 1, 2).select(
        ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 53) % 89).cast("double").alias("b"),
        (F.col("id") % 3).cast("int").alias("fold")).withColumn("is_attack", ((F.col("a") * 7 + F.col("b") * 13) % 10 < 4).cast("int"))


def test_model_query_fits_the_reference_trees(spark, trained, monkeypatch):
    from tidewatch.catalog import q_model as Q
    monkeypatch.setattr(Q, "_CACHE", {})
    fits = []
    monkeypatch.setattr(Q, "train", lambda df, spec, trees: fits.append(("train", trees)) or trained)
    monkeypatch.setattr(Q, "refit", lambda t, trees: fits.append(("refit", trees)) or trained, raising=False)
    assert Q.q_fit_boosted_trees(spark, SF_SMALL).columns == ["conn_id", "is_attack", "probability", "prediction"]
    assert fits == [("train", MO.Boosting())] and (MO.Boosting().max_depth, MO.Boosting().n_estimators) == (6, 100)
    Q.q_score_batch(spark, SF_SMALL)
    Q.q_fit_boosted_trees(spark, SF_SMALL)
    assert fits[1:] == [("refit", Q.SMALL)]     # of other trees: on the same features


def test_sets_that_differ_in_rounds_share_a_fit(spark, monkeypatch):
    fits = []
    gbt = MO._gbt
    monkeypatch.setattr(MO, "_gbt", lambda cfg, label: fits.append(cfg.n_estimators) or gbt(cfg, label))
    d = _rows_of_two_classes(spark)
    base = MO.Boosting(max_depth=3, learning_rate=0.5)
    alone = [MO.fold_scores(d, ["a", "b"], [{"n_estimators": n}], base=base).collect() for n in (2, 5)]
    fits.clear()
    combos = [{"n_estimators": 5}, {"n_estimators": 2}, {"max_depth": 2, "n_estimators": 5}]
    got = MO.fold_scores(d, ["a", "b"], combos, base=base).collect()
    assert got[:3] == alone[1] and got[3:6] == alone[0] and alone[0] != alone[1]
    assert fits == [5] * 6 and len(got) == 9


def test_grid_query_covers_the_reference_grid(spark, trained, monkeypatch):
    from tidewatch.catalog import q_model as Q
    seen = []
    monkeypatch.setattr(Q, "_folded", lambda spark, sf: (trained.train, trained.state.features))
    monkeypatch.setattr(MO, "cross_validate_grid", lambda df, f, combos, *a, **k: seen.append((combos, a)))
    Q.q_tune_grid(spark, SF_SMALL)
    (combos, rest), = seen
    assert combos == MO.grid_combos(MO.GRID) and len(combos) == 108 and MO.Boosting() in rest


def test_staged_search_runs_its_three_stages(spark):
    d = _rows_of_two_classes(spark)
    space = {"max_depth": [2, 3], "n_estimators": [2, 3]}
    ranges = {"max_depth": (2, 3, 1), "learning_rate": (0.1, 0.5, "log"), "n_estimators": (2, 4, 2)}
    near = lambda best: {"n_estimators": [best["n_estimators"], best["n_estimators"] + 1]}
    got = MO.tune_staged(d, ["a", "b"], space, 2, refine=near, n_trials=2, ranges=ranges).collect()
    assert [r["method"] for r in got] == ["random"] * 2 + ["tpe"] * 2 + ["fine"] * 2
    top = max(r["mean_auc"] for r in got)
    best, = [r for r in got if r["is_best"]]
    assert best["mean_auc"] == top == next(r["mean_auc"] for r in got if r["mean_auc"] == best["mean_auc"])
    first = max(got[:4], key=lambda r: r["mean_auc"])
    assert json.loads(got[4]["params"])["n_estimators"] == json.loads(first["params"])["n_estimators"]


def test_staged_query_replaces_no_stage(spark, trained, monkeypatch):
    from tidewatch.catalog import q_model as Q
    seen = []
    monkeypatch.setattr(Q, "_folded", lambda spark, sf: (trained.train, trained.state.features))
    monkeypatch.setattr(MO, "tune_staged", lambda *a, **k: seen.append((a, k)))
    Q.q_tune_staged(spark, SF_SMALL)
    (args, named), = seen
    assert len(args) == 2 and not {"refine", "space", "ranges", "n_iter", "n_trials"} & set(named)
    assert MO.fine_grid({"max_depth": 3, "learning_rate": 0.1, "n_estimators": 200})["n_estimators"] == [100, 200, 300]


def test_model_based_search_learns_from_its_trials():
    score = lambda p: -(p["max_depth"] - 7) ** 2 / 10 - math.log(p["learning_rate"] / 0.05) ** 2
    trials = []
    for _ in range(50):
        p = tpe.suggest(MO.RANGES, trials, 42)
        assert p == tpe.suggest(MO.RANGES, trials, 42) and set(p) == set(MO.SEARCHED)
        assert all(lo <= p[k] <= hi and (not isinstance(step, int) or (p[k] - lo) % step == 0)
                   for k, (lo, hi, step) in MO.RANGES.items())
        trials.append((p, None if len(trials) == 3 else score(p)))
    scores = [s for _, s in trials if s is not None]
    assert sum(scores[-10:]) / 10 > sum(scores[:9]) / 9 and max(scores) > -0.05
