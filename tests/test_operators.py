"""Hand-made frames: edge cases and invariants of the operators."""

import math
import os
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.expressions import (confidence_band, derive_label, safe_divide,
                                              threat_level)
from tidewatch.functions.stats import numeric_summary, quantiles
from tidewatch.operators import alerts as AL
from tidewatch.operators import drift as DR
from tidewatch.operators import encoders as EN
from tidewatch.operators import evaluate as EV
from tidewatch.operators import features as FE
from tidewatch.operators import impute as IM
from tidewatch.operators import outliers as OU
from tidewatch.operators import profile as P
from tidewatch.operators import sampling as SA
from tidewatch.operators import scaling as SC
from tidewatch.operators import windows as WI
from tidewatch.schemas import nan_to_null
from tidewatch.session import cut_lineage, local_path, scratch_path
from tidewatch.sources import files as FI


def test_nan_becomes_null_inf_is_kept_and_flagged(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.0)], "k int, x double")
    df = nan_to_null(df)
    got = {r["k"]: r["x"] for r in df.collect()}
    assert got[1] is None and got[2] == float("inf")
    inf = P.infinite_columns(df).collect()
    assert inf[0]["value"] == 1 and inf[0]["severity"] == "error"


def test_empty_frame_checks(spark):
    df = spark.createDataFrame([], "a double, b string")
    rows = {(r["check"], r["column"], r["metric"]): r for r in P.schema_check(df).collect()}
    assert rows[("schema", "*", "num_rows")]["severity"] == "error"
    q = P.quick_check(df, ["a"]).collect()
    assert any(r["metric"] == "num_rows" and r["severity"] == "error" for r in q)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "c double, e double")
    const = {r["column"]: r["value"] for r in P.constant_columns(df).collect()}
    assert const == {"c": 1.0, "e": 0.0}
    empty = {r["column"]: r["severity"] for r in P.empty_columns(df).collect()}
    assert empty == {"c": "metric", "e": "error"}


def test_derive_label_null_type_is_attack(spark):
    df = spark.createDataFrame([("normal",), (None,), ("smurf",)], "attack_type string")
    got = [r[0] for r in df.select(derive_label("attack_type")).collect()]
    assert got == [0, 1, 1]


def test_safe_divide_and_log1p_edges(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0), (-1.0, -1.0)], "a double, b double")
    got = [r[0] for r in df.select(safe_divide("a", "b", default=7.0)).collect()]
    assert got == [7.0, 2.0, 1.0]
    d = spark.createDataFrame([(-1.0,), (0.0,), (150.0,), (None,)], "duration double")
    rows = FE.network_features(d).collect()
    assert rows[0]["duration_log"] is None and rows[1]["duration_log"] == 0.0
    assert [r["is_long_connection"] for r in rows] == [0, 0, 1, 0]
    assert [r["is_short_connection"] for r in rows] == [1, 1, 0, 0]


@pytest.mark.parametrize("p,conf,level", [
    (0.0, "High", "Minimal"), (0.1, "High", "Minimal"), (0.2, "Medium", "Low"),
    (0.4, "Low", "Medium"), (0.5, "Low", "Medium"), (0.6, "Low", "High"),
    (0.8, "Medium", "Critical"), (0.9, "High", "Critical"), (1.0, "High", "Critical")])
def test_band_edges_match_python(spark, p, conf, level):
    # the reference's Python comparisons on the same doubles
    d = abs(p - 0.5)
    exp_conf = "High" if d >= 0.4 else "Medium" if d >= 0.2 else "Low"
    assert exp_conf == conf
    r = spark.createDataFrame([(p,)], "probability double").select(
        confidence_band("probability").alias("c"), threat_level("probability").alias("t")).first()
    assert (r["c"], r["t"]) == (conf, level)


def test_alert_text_and_null_probability(spark):
    df = spark.createDataFrame([(1, 0.8125, "2024-01-01 10:00:00"), (2, None, "2024-01-01 10:00:00"),
                                (3, 0.69, "2024-01-01 10:00:00")],
                               "conn_id long, probability double, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    rows = AL.alerts(df, key="conn_id", ts="ts").collect()
    assert len(rows) == 1
    assert rows[0]["description"] == "High-risk threat detected with 81.2% probability"
    assert rows[0]["alert_id"] == "THREAT_20240101_100000_1"


def test_mode_tie_goes_to_smallest_and_all_null_gets_unknown(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)],
                               "s string, t string")
    st = {r["column"]: r["str_value"] for r in IM.fit_mode(df, ["s", "t"]).collect()}
    assert st == {"s": "a", "t": "unknown"}
    pdf = pd.Series(["b", "a", "b", "a"])
    assert pdf.mode().iloc[0] == "a"


def test_median_matches_pandas(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=101).tolist() + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    med = IM.fit_median(df, ["x"]).first()["num_value"]
    assert med == pytest.approx(pd.Series(vals, dtype="float64").median())


def test_unseen_category_onehot_zero_label_minus_one(spark):
    fit = spark.createDataFrame([("tcp",), ("udp",), ("icmp",)], "p string")
    state = EN.fit_dictionary(fit, ["p"])
    new = spark.createDataFrame([("udp",), ("gre",), (None,)], "p string")
    oh = EN.onehot_transform(new, state).collect()
    assert set(oh[0].asDict()) == {"p_tcp", "p_udp"}            # 'icmp' (first) dropped
    assert [tuple(r) for r in oh] == [(0, 1), (0, 0), (0, 0)]
    lab = [r["p"] for r in EN.label_transform(new, state).collect()]
    assert lab == [2, -1, -1]


def test_dictionary_of_any_size_is_joined(spark):
    n = 12_000                                                  # over MAP_LIMIT: the join branch
    fit = spark.range(n).select(F.format_string("v%05d", F.col("id")).alias("p"), F.lit("k").alias("q"))
    state = EN.fit_dictionary(fit, ["p", "q"])
    assert state.count() == n + 1
    new = spark.createDataFrame([(0, "v00000", "k"), (1, "v11999", None), (2, "gone", "k"), (3, None, "z")],
                                "i int, p string, q string")
    got = EN.label_transform(new, state).orderBy("i").select("p", "q").collect()
    assert [tuple(r) for r in got] == [(0, 0), (n - 1, -1), (-1, 0), (-1, -1)]


def test_onehot_has_no_cap(spark):
    state = EN.fit_dictionary(spark.range(5_002).select(F.col("id").cast("string").alias("p")), ["p"])
    assert state.count() == 5_002
    assert len(EN.onehot_transform(spark.createDataFrame([("1",)], "p string"), state).columns) == 5_001


def test_correlation_is_pairwise_complete(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, None, 5.0, None), (2.0, 1.0, 3.0, 5.0, None), (3.0, 5.0, 1.0, 5.0, None),
            (4.0, None, 2.0, 5.0, None), (None, 7.0, 4.0, 5.0, None), (6.0, 3.0, nan, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, z double")
    frame = pd.DataFrame(rows, columns=list("abckz"), dtype="float64")
    for method in ("pearson", "spearman"):
        want = frame.corr(method)
        for r in DR.correlation(df, list("abckz"), method).collect():
            if r["a"] == r["b"]:
                assert r["corr"] == 1.0
            elif np.isnan(want.loc[r["a"], r["b"]]):
                assert r["corr"] is None if "z" in (r["a"], r["b"]) else np.isnan(r["corr"])
            else:
                assert r["corr"] == pytest.approx(want.loc[r["a"], r["b"]])


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    st = {r["column"]: (r["mean"], r["scale"]) for r in SC.fit(df).collect()}
    assert st == {"a": (2.0, 1.0), "c": (5.0, 1.0)}
    assert [r["a"] for r in SC.transform(df, SC.fit(df)).collect()] == [-1.0, 1.0]


def test_fences_only_remove_and_sequential_differs(spark):
    rng = np.random.default_rng(7)
    rows = [(float(a), float(b)) for a, b in zip(rng.lognormal(size=400), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "a double, b double")
    seq = OU.apply(df, OU.fit_iqr(df, ["a", "b"], mode="sequential")).count()
    joint = OU.apply(df, OU.fit_iqr(df, ["a", "b"], mode="joint")).count()
    assert seq <= 400 and joint <= 400
    # pandas, sequential definition
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    for c in ["a", "b"]:
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        pdf = pdf[(pdf[c] >= q1 - 1.5 * (q3 - q1)) & (pdf[c] <= q3 + 1.5 * (q3 - q1))]
    assert seq == len(pdf)


def test_zscore_skips_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "c double, x double")
    st = OU.fit_zscore(df, ["c", "x"])
    assert [r["column"] for r in st.collect()] == ["x"]
    assert OU.apply(df, st).count() == 3


def test_skew_kurtosis_quantiles_match_pandas(spark):
    rng = np.random.default_rng(3)
    vals = rng.gamma(2.0, size=500)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    s = numeric_summary(df, ["x"]).first()
    ps = pd.Series(vals)
    assert s["skewness"] == pytest.approx(ps.skew(), rel=1e-9)
    assert s["kurtosis"] == pytest.approx(ps.kurtosis(), rel=1e-9)
    q = quantiles(df, ["x"], [0.1, 0.5, 0.9])["x"]
    assert q == pytest.approx(list(np.quantile(vals, [0.1, 0.5, 0.9])), rel=1e-12)


def test_global_row_number_and_prefix_sums(spark):
    rows = [(i, random.Random(i).random()) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v double")
    rn = WI.global_row_number(df, [F.col("v"), F.col("k")], partitions=7)
    got = sorted((r["v"], r["rn"]) for r in rn.collect())
    assert [x[1] for x in got] == list(range(1, 501))
    ps = WI.prefix_sums(df, [F.col("k")], {"s": F.col("v")}, partitions=5)
    exp = np.cumsum([v for _, v in sorted(rows)])
    got = [r["s"] for r in ps.orderBy("k").collect()]
    assert got == pytest.approx(list(exp))


def test_halo_rolling_equals_plain_window_with_hot_key(spark):
    rng = np.random.default_rng(11)
    n = 900
    # entity 0 holds a third of the rows
    ent = [0 if i % 3 == 0 else int(rng.integers(1, 20)) for i in range(n)]
    df = spark.createDataFrame([(i, e, float(rng.normal())) for i, e in enumerate(ent)],
                               "t long, e long, x double")
    a = WI.rolling(df, ["x"], 7, ["t"], ["e"], bucket_rows=10, strategy="halo")
    b = WI.rolling(df, ["x"], 7, ["t"], ["e"], strategy="window")
    ga = {r["t"]: (r["x_rolling_mean"], r["x_rolling_std"]) for r in a.collect()}
    gb = {r["t"]: (r["x_rolling_mean"], r["x_rolling_std"]) for r in b.collect()}
    assert ga.keys() == gb.keys()
    for k in ga:
        assert ga[k][0] == pytest.approx(gb[k][0])
        assert (ga[k][1] is None) == (gb[k][1] is None)
        if ga[k][1] is not None:
            assert ga[k][1] == pytest.approx(gb[k][1])
    # pandas parity for the hot entity
    pdf = pd.DataFrame([(i, e, r["x"]) for i, (e, r) in enumerate(
        zip(ent, df.orderBy("t").collect()))], columns=["t", "e", "x"])
    hot = pdf[pdf.e == 0].sort_values("t")
    m = hot.x.rolling(7, min_periods=1).mean().tolist()
    assert [ga[t][0] for t in hot.t] == pytest.approx(m)


def test_split_is_a_partition_with_exact_sizes(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, y int")
    s = SA.split_stratified(df, "y", "k", 0.8, 42).collect()
    assert len(s) == 700 and len({r["k"] for r in s}) == 700
    n_train = {y: sum(1 for r in s if r["y"] == y and r["split"] == "train") for y in (0, 1)}
    assert n_train == {0: math.floor(600 * 0.8 + 0.5), 1: math.floor(100 * 0.8 + 0.5)}
    f = SA.fold_stratified(df, "y", "k", 5, 42).groupBy("y", "fold").count().collect()
    assert all(r["count"] in (20, 120) for r in f)


def _auc_brute(y, p):
    pos = [a for a, b in zip(p, y) if b == 1]
    neg = [a for a, b in zip(p, y) if b == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_ap_against_brute_force(spark):
    rng = random.Random(5)
    y = [rng.randint(0, 1) for _ in range(300)]
    p = [round(rng.random() * 0.6 + 0.4 * t, 2) for t in y]   # ties on purpose
    df = spark.createDataFrame(list(zip(y, [int(v >= 0.5) for v in p], p)), "y int, pred int, p double")
    auc = EV.auc_roc(df).first()["auc"]
    assert auc == pytest.approx(_auc_brute(y, p))
    inv = df.withColumn("p", 1 - F.col("p"))
    assert EV.auc_roc(inv).first()["auc"] == pytest.approx(1 - auc)
    # step-wise average precision over distinct thresholds
    order = sorted(set(p), reverse=True)
    P_ = sum(y)
    ap, tp, fp = 0.0, 0, 0
    for t in order:
        pos = sum(1 for a, b in zip(p, y) if a == t and b == 1)
        neg = sum(1 for a, b in zip(p, y) if a == t and b == 0)
        tp, fp = tp + pos, fp + neg
        ap += pos / P_ * tp / (tp + fp)
    assert EV.average_precision(df).first()["average_precision"] == pytest.approx(ap)
    cm = EV.confusion_matrix(df).collect()
    assert sum(r["n"] for r in cm) == 300


def test_bins_edges_and_one(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.3), (1, 0.30000000000000004), (0, 0.1)],
                               "y int, p double")
    bins = {r["bin"]: r["count"] for r in EV.confidence_bins(df).collect()}
    assert bins == {1: 1, 2: 1, 3: 1}              # p = 1.0 is in no bin
    cal = {r["bin"]: r["count"] for r in EV.calibration(df).collect()}
    edges = np.linspace(0.0, 1.0, 11)
    ids = np.searchsorted(edges[1:-1], [1.0, 0.3, 0.30000000000000004, 0.1])
    exp = {int(b): int((ids == b).sum()) for b in set(ids.tolist())}
    assert cal == exp == {0: 1, 2: 2, 9: 1}        # right-closed; 1.0 in the last
    sweep = {round(r["threshold"], 2): r for r in EV.threshold_sweep(df).collect()}
    assert len(sweep) == 18 and sum(r["is_best"] for r in sweep.values()) == 1


def test_malformed_csv_line_is_quarantined(spark):
    path = scratch_path(spark, "bad_csv")
    os.makedirs(local_path(path), exist_ok=True)
    good = ",".join(["1.5", "tcp", "http", "SF", "10", "20"] + ["0"] * 16 + ["3", "2"]
                    + ["0.0"] * 7 + ["1", "1"] + ["0.0"] * 8 + ["normal"])
    with open(os.path.join(local_path(path), "part-0.csv"), "w") as fh:
        fh.write(good + "\n" + "this,is,not,a,record\n")
    df, bad = FI.scan_chunked(spark, path, header=False)
    assert df.count() == 1 and df.first()["is_attack"] == 0
    assert bad.count() == 1


def test_header_detection_for_kdd_file(spark):
    from tidewatch.schemas import KDD_NAMES
    path = scratch_path(spark, "hdr")
    os.makedirs(local_path(path), exist_ok=True)
    row = ["0.0", "udp", "dns", "SF", "5", "6"] + ["0"] * 16 + ["1", "1"] + ["0.0"] * 7 + \
        ["1", "1"] + ["0.0"] * 8 + ["smurf"]
    with open(os.path.join(local_path(path), "f.csv"), "w") as fh:
        fh.write(",".join(KDD_NAMES + ["is_attack"]) + "\n" + ",".join(row + ["1"]) + "\n")
    df = FI.scan_kdd(spark, path)
    r = df.first()
    assert df.count() == 1 and r["attack_type"] == "smurf" and r["is_attack"] == 1


def test_alarm_needs_consecutive_periods(spark):
    ts = ["2024-01-01 00:10:00"] * 6 + ["2024-01-01 01:10:00"] * 6 + \
         ["2024-01-01 03:10:00"] * 6 + ["2024-01-01 05:10:00"] * 6 + ["2024-01-01 06:10:00"] * 6
    df = spark.createDataFrame([(t,) for t in ts], "ts string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    out = AL.windowed_alarm(df, "ts", None, "1 hour", 3600, "sum", 5.0, ">", 2) \
        .orderBy("period_start").collect()
    assert [r["alarm"] for r in out] == [0, 1, 0, 0, 1]


def test_radix_quantiles_equal_numpy_with_atoms_and_extremes(spark):
    from tidewatch.functions.stats import exact_quantiles
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.lognormal(size=20000), np.zeros(5000), np.full(3000, 2.5), -rng.lognormal(size=4000),
                           [5e-324, -5e-324, 2.2e-308, 1.7976931348623157e308, -1.7e308, 1.0, np.nextafter(1, 2),
                            np.nextafter(1, 0), -0.0, 2.0 ** 60]])
    df = spark.createDataFrame([(float(v), float(v) / 3 if i % 7 else None, None, i, float("nan") if i % 2 else 1.5)
                                for i, v in enumerate(vals)], "a double, `b.x` double, c double, d int, e double")
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, ["a", "b.x", "c", "d", "e"], probs)
    assert got["a"] == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12)
    b = np.array([float(v) / 3 for i, v in enumerate(vals) if i % 7])
    assert got["b.x"] == pytest.approx(list(np.quantile(b, probs)), abs=1e-12)
    assert got["c"] == [None] * 8 and got["e"] == [1.5] * 8
    assert got["d"] == pytest.approx(list(np.quantile(np.arange(len(vals)), probs)))
    assert exact_quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_double_keys_are_the_bits_in_order(spark):
    import struct
    from tidewatch.functions.radix import key_double, with_double_key
    rng = random.Random(1)
    vals = [struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(3000)]
    vals = [v for v in vals if v == v] + [0.0, -0.0, float("inf"), float("-inf"), 2.0 ** 1023, 2.0 ** -1074]
    vals += [2.0 ** e * (1 + s) for e in range(-1022, 1023, 13) for s in (0, 2.0 ** -52, 1 - 2.0 ** -52)]
    rows = with_double_key(spark.createDataFrame([(v,) for v in vals], "v double"), "v").collect()
    for r in rows:
        b = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["k"] == (b if r["v"] >= 0 else -b) and key_double(r["k"]) == r["v"]


def test_radix_counts_do_not_grow_with_the_rows(spark):
    from tidewatch.functions.radix import BITS, select_ranks
    sent = []
    for n in (51_200, 1_024_000):
        keys = spark.range(0, n, 1, 4).select(F.lit("a").alias("g"), ((F.col("id") % 512) * 7).alias("k"))
        r = select_ranks(keys, [F.floor(F.col("n") / 2), F.col("n") - 1, F.col("n")], local=n < 100_000).orderBy("i").collect()
        assert [(x["i"], x["k"], x["below"]) for x in r] == [(0, 256 * 7, n // 2), (1, 511 * 7, n - n // 512)]
        # what the partial counts of the deepest scan send: a row a task and bucket
        sent.append(keys.groupBy(F.spark_partition_id(), F.shiftright("k", 64 - 4 * BITS)).count().count())
    assert sent[0] == sent[1] == 4 * 512


def test_scratch_scope_removes_what_it_wrote(spark):
    from tidewatch.session import cut_lineage, exists, scratch_scope
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as inner:
            gone = cut_lineage(spark.range(3))
            kept = inner.save(gone.where("id > 0"))
        files = [kept.inputFiles()[0], gone.inputFiles()[0]]
        assert [exists(f.replace("file://", "")) for f in files] == [True, False] and kept.count() == 2
        last = outer.save(kept)
    assert not exists(files[0].replace("file://", "")) and last.count() == 2


def test_scan_auto_rejects_empty_and_unlabelled(spark):
    path = scratch_path(spark, "auto_kdd_empty")
    os.makedirs(local_path(path), exist_ok=True)
    open(os.path.join(local_path(path), "x.csv"), "w").close()
    with pytest.raises(FI.ScanError):
        FI.scan_auto(spark, path)
    gen = scratch_path(spark, "generic")
    spark.createDataFrame([(1, 2.0)], "a int, b double").write.option("header", True).csv(gen)
    with pytest.raises(FI.ScanError):
        FI.scan_auto(spark, gen)


def test_unknown_sink_format_and_encoding_are_rejected(spark):
    from tidewatch.sources import sinks as SK
    df = spark.createDataFrame([("tcp",)], "p string")
    with pytest.raises(ValueError):
        SK.write_table(df, scratch_path(spark, "x"), "xlsx")
    with pytest.raises(ValueError):
        EN.encode(df, EN.fit_dictionary(df, ["p"]), "target")


def test_psi_zero_for_same_data_and_positive_for_shift(spark):
    from tidewatch.operators import drift as DR
    rng = np.random.default_rng(2)
    a = spark.createDataFrame([(float(v),) for v in rng.normal(size=3000)], "x double")
    b = spark.createDataFrame([(float(v) + 1.0,) for v in rng.normal(size=3000)], "x double")
    same = DR.psi(a, a, ["x"]).first()
    assert same["psi"] == pytest.approx(0.0, abs=1e-12) and same["severity"] == "metric"
    assert DR.psi(a, b, ["x"]).first()["severity"] == "drift"


def test_duplicates_and_value_counts_match_pandas(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, None]), rng.randint(0, 2))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "s string, x double, k int")
    pdf = pd.DataFrame(rows, columns=["s", "x", "k"])
    got = {r["metric"]: r["value"] for r in P.duplicate_rows(df).collect()}
    assert got["duplicate_count"] == pdf.duplicated().sum()
    vc = {r["value"]: r["n"] for r in P.value_counts(df, "s").collect() if r["value"] is not None}
    assert vc == pdf["s"].value_counts().to_dict()
    nulls = {r["column"]: r["value"] for r in P.null_profile(df).collect() if r["metric"] == "null_pct"}
    exp = (pdf.isnull().sum() / len(pdf) * 100).round(2).to_dict()
    assert nulls == pytest.approx(exp)


def test_fence_bounds_push_into_scan_and_reject_nan(spark):
    path = scratch_path(spark, "nan_parquet")
    spark.createDataFrame([(float("nan"),), (1.0,), (None,), (2.0,), (3.0,), (250.0,)],
                          "value double").write.parquet(path)
    raw = spark.read.parquet(path)
    st = OU.fit_iqr(raw, ["value"])                     # fit ignores NaN
    q1, q3 = np.quantile([1.0, 2.0, 3.0, 250.0], [0.25, 0.75])
    r = st.first()
    assert (r["lower"], r["upper"]) == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    out = OU.apply(raw, st)
    assert sorted(x["value"] for x in out.collect()) == [1.0, 2.0, 3.0]
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(value" in plan and "LessThanOrEqual(value" in plan


def test_three_way_split_sizes(spark):
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, y int")
    s = SA.split_stratified(df, "y", "k", 0.8, 42, validation_frac=0.2)
    got = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    for y, n in ((0, 800), (1, 200)):
        n_train = math.floor(n * 0.8 + 0.5)
        n_val = math.floor(n_train * 0.2 + 0.5)
        assert got[(y, "test")] == n - n_train and got[(y, "validation")] == n_val
        assert got[(y, "train")] == n_train - n_val
    two = SA.split_stratified(df, "y", "k", 0.8, 42).filter(F.col("split") == "test")
    three = s.filter(F.col("split") == "test")
    assert two.select("k").exceptAll(three.select("k")).count() == 0   # same test rows


def test_attack_family_mapping(spark):
    from tidewatch.functions.expressions import attack_family
    df = spark.createDataFrame([("neptune",), ("Smurf ",), ("warezclient",), ("normal",),
                                ("r2l",), ("zeroday",), (None,)], "attack_type string")
    got = [r[0] for r in df.select(attack_family("attack_type")).collect()]
    assert got == ["dos", "dos", "r2l", "normal", "r2l", "unknown", None]


def test_scan_auto_routes_by_file_name(spark, tmp_path):
    folder = tmp_path / "translated_kdd"
    folder.mkdir()
    (folder / "plain.csv").write_text("a,attack_type\n1,normal\n2,smurf\n")
    got = FI.scan_auto(spark, str(folder / "plain.csv")).orderBy("a").collect()
    assert [(r["a"], r["is_attack"]) for r in got] == [(1, 0), (2, 1)]


def test_capture_by_month_keeps_all_rows(spark, tmp_path):
    from tidewatch.sources import sinks as SK
    df = spark.sql("SELECT timestamp'1995-01-31' + make_dt_interval(id) AS timestamp, id FROM range(40)"
                   " UNION ALL SELECT NULL, 99")
    SK.capture(df, str(tmp_path / "c"), by_month=True)
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.count() == 41 and back.where("capture_date IS NULL").count() == 1
    assert back.select("capture_month").distinct().count() == 4


def test_split_keeps_repeated_keys_together_and_null_labels_apart(spark):
    rows = [(i, None if i % 3 == 0 else i % 3) for i in range(999)] + [(7, 1)] * 50 + [(None, 2)] * 4
    df = spark.createDataFrame(rows, "k int, y int")
    got = SA.split_stratified(df, "y", "k", 0.8, validation_frac=0.25).collect()
    assert len(got) == len(rows) and {r["split"] for r in got} == {"train", "validation", "test"}
    assert len({r["split"] for r in got if r["k"] == 7}) == 1
    n = sum(r["y"] is None and r["split"] != "test" for r in got)
    assert n == int(333 * 0.8 + 0.5)
    assert SA.split_stratified(df.limit(0), "y", "k").collect() == []
    alone = SA.split_stratified(df.limit(1), "y", "k", 0.2).collect()      # no row of its label is train
    assert [r["split"] for r in alone] == ["test"]


def test_folds_over_many_hash_prefixes_equal_one_window(spark, monkeypatch):
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, y int")
    one = {r["k"]: r["fold"] for r in SA.fold_stratified(df, "y", "k").collect()}
    monkeypatch.setattr(SA, "FOLD_ROWS", 10)
    many = {r["k"]: r["fold"] for r in SA.fold_stratified(df, "y", "k").collect()}
    assert one == many and len(one) == 3000


def test_global_order_over_more_partitions_than_a_plan_could_list(spark):
    df = spark.range(4000).select((F.col("id") * 7919 % 4001).alias("k"))
    rn = WI.global_row_number(df, [F.col("k")], partitions=400)
    got = sorted((r["k"], r["rn"]) for r in rn.collect())
    assert [x[1] for x in got] == list(range(1, 4001))


def test_sparse_onehot_with_many_categories(spark):
    from pyspark.ml.linalg import SparseVector
    df = spark.range(120_000).select(F.col("id").alias("k"), F.format_string("c.%06d", F.col("id")).alias("big"),
                                     F.when(F.col("id") % 4 < 3, F.concat(F.lit("x"), F.col("id") % 4)).alias("few"))
    state = cut_lineage(EN.fit_dictionary(df, ["big", "few"]))
    assert state.count() == 120_003
    new = spark.createDataFrame([(1, "c.000000", "x0"), (2, "c.000001", "x2"), (3, "c.119999", None), (4, "other", "x1"),
                                 (5, None, "new")], "k int, big string, few string")
    v = EN.onehot_vectors(new, state, drop=False)
    assert {r["k"]: r["onehot"]["indices"] for r in v.collect()} == {
        1: [], 2: [0, 120_000], 3: [119_998], 4: [119_999], 5: []}
    ml = {r["k"]: r["onehot"] for r in EN.as_ml_vectors(v).collect()}
    assert ml[2] == SparseVector(120_001, {0: 1.0, 120_000: 1.0})
    with pytest.raises(EN.TooManyFlags):
        EN.onehot_transform(new, state)


def test_wide_onehot_quotes_and_parts_names(spark):
    df = spark.createDataFrame([("a.b", "1", 0), ("c", "b_1", 1), ("c", None, 2)], "`p.q` string, `p.q_c` string, `p.q_d` int")
    out = EN.onehot_transform(df, EN.fit_dictionary(df, ["p.q", "p.q_c"]))
    assert out.columns == ["p.q_d", "p.q_c", "p.q_c_b_1"] and [tuple(r) for r in out.collect()] == [
        (0, 0, 0), (1, 1, 1), (2, 1, 0)]


def test_header_scan_keeps_bad_lines(spark):
    path = local_path(scratch_path(spark, "header_scan"))
    os.makedirs(path)
    names = ["attack_type", "extra", "duration", "src_bytes", "service"]
    for i, lines in enumerate((["normal,e,1.5,10,http", "smurf,e,x,10,http", "normal,e,2.5"],
                               ['normal,"a,b",NaN,7,', "neptune,e,1,2,ftp,more", "land,e,1,9.5,ftp", ""])):
        with open(f"{path}/part{i}.csv", "w") as f:
            f.write("\n".join([",".join(names), *lines]) + "\n")
    good, bad = FI.scan_chunked(spark, path)
    assert {(r["attack_type"], r["duration"], r["src_bytes"], r["service"], r["is_attack"]) for r in good.collect()} \
        == {("normal", None, 7, None, 0), ("normal", 1.5, 10, "http", 0)} and good.count() == 2
    assert sorted(r["raw"] for r in bad.collect()) == ["land,e,1,9.5,ftp", "neptune,e,1,2,ftp,more", "normal,e,2.5",
                                                       "smurf,e,x,10,http"]
    with pytest.raises(FI.ScanError):
        FI.header_schema(["a", "a"], FI.kdd_schema())


def test_repeated_rows_compare_whole_rows(spark):
    rows = [(i % 50, None if i % 4 else "s", float(i % 3)) for i in range(700)] + [(1, None, None)] * 300
    df = spark.createDataFrame(rows, "a int, `b.c` string, d double")
    n = Counter(rows)
    assert sorted(r["n"] for r in P.repeated_rows(df).collect()) == sorted(c for c in n.values() if c > 1)
    assert P.repeated_rows(df.limit(0)).collect() == []
