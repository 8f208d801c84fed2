"""Model smoke tests, persistence round trip, bundle contract (rows-only queries)."""

import pytest
from pyspark.sql import functions as F

from tripsight import config as C
from tripsight.operators import ml as ML
from tripsight.operators.bundle import export_bundle, load_bundle
from tripsight.plans.catalog import train_test
from tripsight.session import scratch_path
from tripsight.sources import adapters as A

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    train, _ = train_test(spark, SF)
    return ML.fit_run(train, A.zones(spark), "decision_tree")


def test_tree_beats_mean_on_mae(spark, run):
    from tripsight.operators import evaluation as EV
    train, test = train_test(spark, SF)
    tree = {r.target: r.mae for r in ML.evaluate_run(run, test).collect()}
    mean = {r.target: r.mae for r in EV.regression_metrics(EV.MeanPredictor.fit(train).predict(test), "m").collect()}
    assert tree["fare"] < mean["fare"]


def test_importances_sum_to_one(spark):
    train, _ = train_test(spark, SF)
    r = ML.fit_run(train, A.zones(spark), "winner", params={"rounds": 3})
    imp = ML.importances(r).groupBy("target").agg(F.sum("importance").alias("s")).collect()
    assert {x.target for x in imp} == {"fare", "duration"}
    for x in imp:
        assert x.s == pytest.approx(1.0)


def test_bundle_round_trip(spark, run):
    _, test = train_test(spark, SF)
    path = scratch_path(spark, "bundle")
    export_bundle(run, path)
    got = load_bundle(path)
    assert got["status"] == "ok" and got["version"] == C.DEFAULT.model_version
    a = {r.trip_id: (r.pred_fare, r.pred_duration) for r in run.predict(test).select("trip_id", "pred_fare",
                                                                                      "pred_duration").collect()}
    b = {r.trip_id: (r.pred_fare, r.pred_duration) for r in got["run"].predict(test).select(
        "trip_id", "pred_fare", "pred_duration").collect()}
    assert a == b


def test_broken_bundle_degrades(spark):
    path = scratch_path(spark, "broken_bundle")
    spark.createDataFrame([('{"feature_order": []}',)], "value string").write.text(f"{path}/metadata")
    got = load_bundle(path)
    assert got["status"] == "degraded" and got["run"] is None and "lacks keys" in got["detail"]
    assert load_bundle(scratch_path(spark, "missing"))["status"] == "degraded"


def test_folds_are_forward_only(spark):
    from tripsight.operators.evaluation import fold_assignment
    train, _ = train_test(spark, SF)
    a = fold_assignment(train, 3)
    n = train.count()
    size = n // 4
    counts = {r.test_fold: r.c for r in a.groupBy("test_fold").agg(F.count("*").alias("c")).collect()}
    assert counts[0] == counts[1] == counts[2] == size
    assert counts[None] == n - 3 * size
    last = None
    for f in (None, 0, 1, 2):  # no fold reaches back behind an earlier one
        keys = [(r.tpep_pickup_datetime, r.trip_id) for r in a.where(F.col("test_fold").eqNullSafe(F.lit(f).cast("int")))
                .select("tpep_pickup_datetime", "trip_id").collect()]
        assert last is None or min(keys) > last
        last = max(keys)


def test_search_scores_every_config_and_refits_the_best(spark):
    train, test = train_test(spark, SF)
    for family in ML.SEARCH_SPACE:
        space = dict(ML.SEARCH_SPACE[family], rounds=[3])
        got = ML.random_search(train, A.zones(spark), family, space, n_configs=2, n_folds=2)
        assert len(got.rows) == 4 and {(r[1], r[5]) for r in got.rows} == {(t, k) for t in ("fare", "duration")
                                                                            for k in (1, 2)}
        for k, cv in got.cv_mae.items():
            assert cv == min(r[4] for r in got.rows if r[1] == k) > 0
        scored = ML.evaluate_run(got.run, test).collect()
        assert {r.rounds for r in scored} == {3} and all(r.mae > 0 for r in scored)


def test_search_error_is_that_of_a_single_fit(spark):
    """A fold's error inside the shared search equals fitting that fold alone and scoring its test rows."""
    from tripsight.operators.evaluation import FOLD_COLS, before_fold, fold_assignment
    train, _ = train_test(spark, SF)
    space = {"rounds": [4], "leaves": [15], "columns_share": [0.8]}
    got = ML.random_search(train, A.zones(spark), "gbt_l1", space, n_configs=1, n_folds=2)
    assigned = fold_assignment(train, 2)
    mae = {"fare": 0.0, "duration": 0.0}
    for f in range(2):
        run = ML.fit_run(before_fold(assigned, f), A.zones(spark), "gbt_l1",
                         params={"rounds": 4, "leaves": 15, "columns_share": 0.8})
        for r in ML.evaluate_run(run, assigned.where(F.col("test_fold") == f).drop(*FOLD_COLS)).collect():
            mae[r.target] += r.mae / 2
    assert got.cv_mae == pytest.approx(mae, abs=1e-4)


def test_presets_have_the_documented_rounds():
    assert {f: c.rounds for f, c in ML.BOOSTED.items()} == {"gbt_l1": 300, "gbt_depthwise": 300, "winner": 300}
    assert ML.BOOSTED["winner"].leaves == 63 and ML.BOOSTED["winner"].rate == 0.05


def test_sample_configs_distinct_and_seeded():
    a = ML.sample_configs(ML.SEARCH_SPACE["gbt_l1"], 5)
    b = ML.sample_configs(ML.SEARCH_SPACE["gbt_l1"], 5)
    assert a == b and len({tuple(sorted(c.items())) for c in a}) == 5


def test_mlp_learns_linear_target(spark):
    import numpy as np
    from tripsight.operators.mlp import fit_mlp
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = 5 * x[:, 0] + 2
    rows = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "trip_id long, x array<double>, y double")
    m = fit_mlp(df, max_epochs=15, batch=32, lr=0.01)
    assert len(m.curve) > 0
    pred = m.predict(df, ["trip_id", "y"]).collect()
    assert not any(np.isnan(r.prediction) for r in pred)
    assert m.curve[-1][2] > 0.5


def test_log_target_is_a_fit_on_logs_inverted(spark):
    """OPT-04: the same trees as a fit on log1p of the targets, predictions inverted by expm1."""
    import numpy as np
    from tripsight.operators import boosting as B
    train, test = train_test(spark, SF)
    run = ML.fit_run(train, A.zones(spark), "winner", log_target=True, params={"rounds": 5})
    feats = run.features.transform(train)
    rows = ML.boost_rows(feats).collect()
    x = np.array([r.x for r in rows])
    cuts = B.quantile_cuts(ML.boost_rows(feats, log_target=True), x.shape[1])[0]
    codes = B.encode(x, cuts)
    key = np.array([r.key for r in rows])
    got = {r.trip_id: (r.pred_fare, r.pred_duration) for r in run.predict(train).select(
        "trip_id", "pred_fare", "pred_duration").collect()}
    ids = [r.trip_id for r in feats.select("trip_id").collect()]
    for k in range(2):
        y = np.rint(np.log1p(np.array([r.y[k] for r in rows])) * B.UNIT).astype(np.int64)[:, None]
        base, trees, _, _ = B.in_lock_step([B.boost(B.Rows(codes, key, y, np.ones(len(x), bool), B.offsets_of(cuts)),
                                                    ML.BOOSTED["winner"].__class__(rounds=5), 0)])[0]
        model = run.models["fare" if k == 0 else "duration"]
        assert model.base == base and model.rounds == len(trees) == 5
        want = np.expm1(model.predict_array(x))
        assert [got[i][k] for i in ids] == pytest.approx(want.tolist())


def test_stack_is_least_squares_on_out_of_fold_predictions(spark):
    """OPT-07: the meta model against numpy on the same base predictions."""
    import numpy as np
    from tripsight.operators import stacking as ST
    from tripsight.operators.evaluation import FOLD_COLS, TARGET_KEYS, before_fold, fold_assignment
    train, test = train_test(spark, SF)
    zones = A.zones(spark)
    got = {r.trip_id: (r.pred_fare, r.pred_duration) for r in ST.stacked_predict(train, test, zones).collect()}
    assigned = fold_assignment(train, 2)
    oof, rows = [], None
    for f in range(2):
        runs = {b: ML.fit_run(before_fold(assigned, f), zones, b) for b in ("decision_tree", "linear")}
        oof += ST._base_predictions(runs, assigned.where(F.col("test_fold") == f).drop(*FOLD_COLS)).collect()
    full = {b: ML.fit_run(train, zones, b) for b in ("decision_tree", "linear")}
    rows = ST._base_predictions(full, test).collect()
    for i, (k, t) in enumerate(TARGET_KEYS.items()):
        x = np.array([[1, r[f"decision_tree_{k}"], r[f"linear_{k}"]] for r in oof])
        w = np.linalg.lstsq(x, np.array([r[t] for r in oof]), rcond=None)[0]
        for r in rows:
            assert got[r.trip_id][i] == pytest.approx(w @ [1, r[f"decision_tree_{k}"], r[f"linear_{k}"]], rel=1e-5)


def test_decision_tree_against_brute_force(spark):
    """MOD-02: on few distinct values every split is the one with the least squared error, leaves hold 50 rows."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 8, 900), rng.integers(0, 5, 900), rng.integers(0, 2, 900)]).astype(float)
    y = x[:, 0] * 3 + (x[:, 1] > 2) * 5 * x[:, 2] + rng.normal(size=900) * 0.1
    df = spark.createDataFrame([(list(map(float, r)), float(t)) for r, t in zip(x, y)], "x array<double>, fare_amount double")
    model = ML.make_model("decision_tree", "fare_amount").fit(df.withColumn("features", array_to_vector("x")).repartition(1))

    def grow(rows, depth):
        best = (1e-9, None, None)
        for c in range(3):
            for cut in np.unique(x[rows, c])[:-1]:
                low = rows[x[rows, c] <= cut]
                if len(low) >= 50 and len(rows) - len(low) >= 50:
                    high = np.setdiff1d(rows, low)
                    gain = (rows.size * y[rows].var() - low.size * y[low].var() - high.size * y[high].var()) / rows.size
                    if gain > best[0]:
                        best = (gain, low, high)
        if depth == 12 or best[1] is None:
            return [(rows, y[rows].mean())]
        return grow(best[1], depth + 1) + grow(best[2], depth + 1)

    want = np.empty(900)
    for rows, v in grow(np.arange(900), 0):
        want[rows] = v
    out = model.transform(df.withColumn("features", array_to_vector("x"))).select("x", "pred_fare_amount").collect()
    exact = {tuple(r): w for r, w in zip(x.tolist(), want)}
    assert [r.pred_fare_amount for r in out] == pytest.approx([exact[tuple(r.x)] for r in out])


def test_large_tables_are_spread_over_tasks(spark, monkeypatch):
    """A training table of one large file is fitted by many tasks, whose partitions have few rows; none is lost."""
    df = spark.range(1000).withColumnRenamed("id", "trip_id").coalesce(1)
    assert ML.spread(df, 1000) is df
    monkeypatch.setattr(ML, "MOST_ROWS", 100)
    got = ML.spread(df, 1000).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(got) > 5 and sum(r["count"] for r in got) == 1000 and max(r["count"] for r in got) < 250


def test_searches_of_two_families_equal_single_searches(spark):
    """The families share folds, features and passes; each result is that of its own search."""
    train, _ = train_test(spark, SF)
    spaces = {"gbt_l1": {"rounds": [3], "leaves": [5, 9], "depth": [0], "min_rows": [20]},
              "gbt_depthwise": {"rounds": [3, 4], "depth": [3]}}
    both = ML.random_searches(train, A.zones(spark), tuple(spaces), spaces, n_configs=2, n_folds=2)
    for family, space in spaces.items():
        one = ML.random_search(train, A.zones(spark), family, space, n_configs=2, n_folds=2)
        assert (both[family].rows, both[family].best, both[family].cv_mae) == (one.rows, one.best, one.cv_mae)
        for k, m in one.run.models.items():
            assert m.nodes.equals(both[family].run.models[k].nodes)


def test_stacking_fits_one_feature_state_for_all_bases(spark, monkeypatch):
    from tripsight.operators.stacking import stacked_predict
    train, test = train_test(spark, SF)
    fitted, whole = [], ML.feature_pipeline

    def counting(*args):
        fitted.append(args)
        return whole(*args)

    monkeypatch.setattr(ML, "feature_pipeline", counting)
    stacked_predict(train, test, A.zones(spark))
    assert len(fitted) == 3  # two folds and all rows


def test_requests_of_few_files_are_scored_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ML, "MOST_ROWS", 100)
    one = spark.range(450).coalesce(1)
    assert ML.spread_requests(one).rdd.getNumPartitions() == 5
    assert ML.spread_requests(one.limit(100)).rdd.getNumPartitions() == 1
