"""Feature pipeline, model families, importances, search, reports.

The feature stages are the same column expressions as the checked feature
frame, wrapped as a persistable ``Transformer``; zone coordinates travel inside
the stage as a 265-entry map literal, so scoring needs no join at all (batch or
stream). The encoder is Spark's ``TargetEncoder`` (smoothed fare mean, unseen
category -> global mean), fitted on train only.
"""

from __future__ import annotations

import json
import random
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Imputer, TargetEncoder, VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from . import features as FE
from .boosting import BoostConfig, BoostedTrees, Fit, fit_boosted
from ..session import scratch_path, shared_dir
from .evaluation import TARGET_KEYS, regression_metrics

PU = "tpep_pickup_datetime"
BASE_FEATURES = [c for c in C.FEATURE_ORDER if not c.endswith("_target_enc")]
COORDS = ("pu_lat", "pu_lon", "do_lat", "do_lon")


class TripFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Calendar + spatial features (PRJ-04..14) from the allowed columns."""

    zoneTable = Param(Params._dummy(), "zoneTable", "JSON list of [LocationID, latitude, longitude]",
                      typeConverter=TypeConverters.toString)
    holidays = Param(Params._dummy(), "holidays", "JSON list of [month, day]", typeConverter=TypeConverters.toString)
    defaultVendor = Param(Params._dummy(), "defaultVendor", "vendor for rows without one",
                          typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, zoneTable="[]", holidays="[]", defaultVendor=C.DEFAULT_VENDOR_ID):
        super().__init__()
        self._setDefault(zoneTable="[]", holidays="[]", defaultVendor=C.DEFAULT_VENDOR_ID)
        self._set(**self._input_kwargs)

    @classmethod
    def from_zones(cls, zones: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> "TripFeatures":
        # the dimension has 265 rows by construction: collecting it is bounded
        rows = [[r["LocationID"], r["latitude"], r["longitude"]]
                for r in zones.select("LocationID", "latitude", "longitude").collect()]
        return cls(zoneTable=json.dumps(rows), holidays=json.dumps([list(h) for h in cfg.holidays]))

    def _transform(self, df: DataFrame) -> DataFrame:
        # the same operators as the checked feature frame: one code path for
        # training, batch scoring and streaming (stream-static broadcast join)
        table = json.loads(self.getOrDefault(self.zoneTable))
        zones = df.sparkSession.createDataFrame([tuple(r) for r in table],
                                                "LocationID bigint, latitude double, longitude double")
        hol = tuple(tuple(h) for h in json.loads(self.getOrDefault(self.holidays)))
        vendor = F.col("VendorID") if "VendorID" in df.columns else F.lit(None)
        d = df.withColumn("VendorID", F.coalesce(vendor.cast("bigint"),
                                                 F.lit(self.getOrDefault(self.defaultVendor)).cast("bigint")))
        d = FE.with_temporal(d, C.DEFAULT.with_(holidays=hol))
        return FE.with_spatial(d, zones)


class PlainColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Re-alias columns with empty ML metadata (encoded means are numbers, not categories)."""

    columns = Param(Params._dummy(), "columns", "columns to strip", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns=None):
        super().__init__()
        self._setDefault(columns=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = set(self.getOrDefault(self.columns))
        return df.select(*[F.col(c).alias(c, metadata={}) if c in cols else F.col(c) for c in df.columns])


def feature_pipeline(zones: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> Pipeline:
    """TripFeatures -> TargetEncoder (fare) -> median Imputer (coordinates) -> VectorAssembler."""
    enc = TargetEncoder(inputCols=list(C.ENCODED_COLUMNS), outputCols=[f"{c}_target_enc" for c in C.ENCODED_COLUMNS],
                        labelCol="fare_amount", targetType="continuous", smoothing=cfg.smoothing,
                        handleInvalid="keep")
    imp = Imputer(inputCols=list(COORDS), outputCols=list(COORDS), strategy="median")
    asm = VectorAssembler(inputCols=list(C.FEATURE_ORDER), outputCol="features", handleInvalid="keep")
    plain = PlainColumns(columns=[f"{c}_target_enc" for c in C.ENCODED_COLUMNS])
    return Pipeline(stages=[TripFeatures.from_zones(zones, cfg), enc, plain, imp, asm])


# --- model families --------------------------------------------------------------------------

FAMILIES = {
    "decision_tree": (DecisionTreeRegressor, dict(maxDepth=12, minInstancesPerNode=50, seed=C.SEED)),
    "linear": (LinearRegression, dict(solver="normal")),
    "forest": (RandomForestRegressor, dict(numTrees=20, maxDepth=10, seed=C.SEED)),
}
#: Boosted families: leaf-wise and depth-wise with absolute loss, and the selected preset.
BOOSTED = {
    "gbt_l1": BoostConfig("absolute", rounds=300, rate=0.1, leaves=31, min_rows=20),
    "gbt_depthwise": BoostConfig("absolute", rounds=300, rate=0.1, leaves=0, depth=6, min_rows=0, min_weight=1.0,
                                 l2=1.0, rows_share=0.8),
    "winner": BoostConfig("squared", rounds=300, rate=0.05, leaves=63, min_rows=20),
}
#: Training rows to a partition of the cached features. A tree level is a small job, so partitions
#: of a few thousand rows cost more to schedule than to read.
ROWS_PER_PARTITION = 25_000
#: Rows of a partition at most: a written table has few, large files, each of which one task reads.
MOST_ROWS = 100_000


def make_model(family: str, target: str, **params):
    cls, defaults = FAMILIES[family]
    est = cls(**dict(defaults, **params))
    return est.setLabelCol(target).setFeaturesCol("features").setPredictionCol(f"pred_{target}")


@dataclass
class FittedRun:
    family: str
    features: PipelineModel
    models: dict                       # target key -> fitted model
    train_seconds: dict = field(default_factory=dict)
    log_target: bool = False

    def rounds(self, key: str) -> int:
        """Trees of a boosted model (1 for models without boosting)."""
        m = self.models[key]
        return m.rounds if isinstance(m, BoostedTrees) else 1

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.features.transform(df)
        for k, m in self.models.items():
            t = TARGET_KEYS[k]
            out = m.transform(out).withColumnRenamed(f"pred_{t}", f"pred_{k}")
            if self.log_target:
                out = out.withColumn(f"pred_{k}", F.expm1(F.col(f"pred_{k}")))
        return out


def boost_rows(features: DataFrame, log_target: bool = False, data: int = 0, train=None) -> DataFrame:
    """Feature rows in the form the booster takes; ``train`` (default: all) marks the rows it learns from."""
    ys = [F.log1p(F.col(t)) if log_target else F.col(t).cast("double") for t in TARGET_KEYS.values()]
    return features.select(F.lit(data).alias("data"), F.xxhash64("trip_id").alias("key"),
                           vector_to_array("features").alias("x"), F.array(*ys).alias("y"),
                           (F.lit(True) if train is None else train).alias("train"))


def spread(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df`` in partitions of some ``MOST_ROWS`` rows, dealt by a key or in turn; small tables stay as they are."""
    return df if rows <= MOST_ROWS else df.repartition(-(-rows // MOST_ROWS), *key)


def spread_requests(valid: DataFrame) -> DataFrame:
    """Requests for scoring: a file of few row groups would be scored by as few tasks."""
    return spread(valid, valid.count())


@dataclass
class Prepared:
    """Training rows with their number and fitted feature state, for the families that learn from them."""

    train: DataFrame
    n: int
    features: PipelineModel

    @classmethod
    def of(cls, train: DataFrame, zones: DataFrame, cfg: C.RunConfig = C.DEFAULT) -> "Prepared":
        shared_dir(train.sparkSession)
        n = train.count()
        train = spread(train, n, "trip_id")
        return cls(train, n, feature_pipeline(zones, cfg).fit(train))


def fit_run(train: DataFrame, zones: DataFrame, family: str, log_target: bool = False, params: dict | None = None,
            cfg: C.RunConfig = C.DEFAULT, prepared: Prepared | None = None) -> FittedRun:
    """Fit the feature state once (or take it ``prepared``), then one model per target on the cached feature frame.

    ``params`` overrides the preset, boosting rounds included; ``{target: params}`` sets them for each target.
    """
    params = params or {}

    def own(k: str) -> dict:
        return params.get(k, {}) if set(params) & set(TARGET_KEYS) else params

    prepared = prepared or Prepared.of(train, zones, cfg)
    train, n, fm = prepared.train, prepared.n, prepared.features
    if family in BOOSTED:
        t0 = time.time()
        fits = [Fit(replace(BOOSTED[family], **own(k)), 0, i) for i, k in enumerate(TARGET_KEYS)]
        got = fit_boosted(boost_rows(fm.transform(train), log_target), fits, len(C.FEATURE_ORDER), len(TARGET_KEYS))
        for m, t in zip(got, TARGET_KEYS.values()):
            m.label = t
        # the targets share their passes, so each has the time of both
        return FittedRun(family, fm, dict(zip(TARGET_KEYS, got)), dict.fromkeys(TARGET_KEYS, time.time() - t0),
                         log_target)
    cols = ["features", *TARGET_KEYS.values()]
    feats = fm.transform(train).select(*cols)
    if log_target:
        feats = feats.select("features", *[F.log1p(F.col(t)).alias(t) for t in TARGET_KEYS.values()])
    # narrow merge of small scan partitions; many partitions stay as they are
    feats = feats.coalesce(max(1, -(-n // ROWS_PER_PARTITION))).cache()

    def fit_one(kt):
        k, t = kt
        t0 = time.time()
        m = make_model(family, t, **own(k)).fit(feats)
        return k, m, time.time() - t0

    # the two targets are independent fits over the same cached features: submit
    # them together so one fit's small stages do not leave the executors idle
    with ThreadPoolExecutor(max_workers=len(TARGET_KEYS)) as ex:
        done = list(ex.map(fit_one, TARGET_KEYS.items()))
    models = {k: m for k, m, _ in done}
    secs = {k: s for k, _, s in done}
    feats.unpersist()
    return FittedRun(family, fm, models, secs, log_target)


def evaluate_run(run: FittedRun, test: DataFrame, name: str | None = None) -> DataFrame:
    """Metrics per target (rows-only check) plus training seconds (never hashed)."""
    pred = run.predict(test)
    m = regression_metrics(pred, name or run.family)
    secs = F.create_map(*[x for k, s in run.train_seconds.items() for x in (F.lit(k), F.lit(float(s)))])
    rounds = F.create_map(*[x for k in run.models for x in (F.lit(k), F.lit(run.rounds(k)))])
    return m.withColumn("train_seconds", F.element_at(secs, F.col("target"))).withColumn(
        "rounds", F.element_at(rounds, F.col("target")))


def scoring_cost(predictions: DataFrame) -> dict:
    """MOD-16: rows scored and rows per second of one whole batch transform (nothing is collected).

    The rows are counted where they are scored, by an observation of the same pass.
    """
    seen = Observation()
    t0 = time.perf_counter()
    predictions.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - t0
    rows = int(seen.get["rows"])
    return {"scored_rows": rows, "score_seconds": seconds, "rows_per_second": rows / max(seconds, 1e-9)}


def with_cost(metrics: DataFrame, cost: dict) -> DataFrame:
    """Metrics with the scoring cost of the model they belong to (never hashed)."""
    return metrics.withColumns({k: F.lit(v) for k, v in cost.items()})


def importances(run: FittedRun) -> DataFrame:
    """MOD-09: normalised importances per target, ranked, flagged at >= 0.65."""
    rows = []
    for k, m in run.models.items():
        if not hasattr(m, "featureImportances"):
            continue
        imp = m.featureImportances
        imp = imp.toArray() if hasattr(imp, "toArray") else imp
        tot = float(imp.sum()) or 1.0
        ranked = sorted(((float(v) / tot, C.FEATURE_ORDER[i]) for i, v in enumerate(imp)), reverse=True)
        for r, (v, name) in enumerate(ranked, start=1):
            rows.append((k, name, v, r, v >= C.IMPORTANCE_FLAG))
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    return session.createDataFrame(rows, "target string, feature string, importance double, rank int, flagged boolean")


def split_counts(run: FittedRun) -> DataFrame:
    """MOD-10: splits and gain per feature, read from the saved node table of each model."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    names = F.create_map(*[x for i, n in enumerate(C.FEATURE_ORDER) for x in (F.lit(i), F.lit(n))])
    parts = []
    for k, m in run.models.items():
        path = scratch_path(spark, f"model-{run.family}-{k}")
        m.write().overwrite().save(path)
        if isinstance(m, BoostedTrees):
            inner = spark.read.parquet(f"{path}/nodes").select(F.col("feature").alias("fi"), "gain").where("fi >= 0")
        else:
            nodes = spark.read.parquet(f"{path}/data")
            if "nodeData" in nodes.columns:
                nodes = nodes.select("nodeData.*")
            inner = nodes.where(F.col("leftChild") >= 0).select(F.col("split.featureIndex").alias("fi"), "gain")
        g = inner.groupBy("fi").agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
        parts.append(g.select(F.lit(k).alias("target"), F.element_at(names, F.col("fi")).alias("feature"),
                              "splits", "gain"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    from pyspark.sql import Window
    return out.withColumn("gain_pct", F.col("gain") * 100.0 / F.sum("gain").over(Window.partitionBy("target")))


# --- random search over forward folds (MOD-08) ----------------------------------------------

# fixed values: the search spaces of the two families (depth 0: no bound)
SEARCH_SPACE = {
    "gbt_l1": {
        "rounds": [200, 400, 700],
        "rate": [0.03, 0.05, 0.1],
        "leaves": [31, 63, 127],
        "depth": [0, 8, 12],
        "min_rows": [20, 50, 100],
        "rows_share": [0.8, 1.0],
        "columns_share": [0.8, 1.0],
        "l2": [0.0, 1.0, 5.0],
    },
    "gbt_depthwise": {
        "rounds": [200, 400, 700],
        "rate": [0.03, 0.05, 0.1],
        "depth": [4, 6, 8],
        "min_weight": [1, 5, 10],
        "rows_share": [0.8, 1.0],
        "columns_share": [0.8, 1.0],
        "l2": [1.0, 5.0, 10.0],
    },
}
SEARCH_CONFIGS = 12
SEARCH_FOLDS = 3


def sample_configs(space: dict, n: int, seed: int = C.SEED) -> list[dict]:
    """n distinct configs of a finite grid (seeded, without repeats)."""
    keys = sorted(space)
    grid = [{}]
    for k in keys:
        grid = [dict(g, **{k: v}) for g in grid for v in space[k]]
    return random.Random(seed).sample(grid, min(n, len(grid)))


@dataclass
class SearchResult:
    """Of one family: each config's mean fold error by target, the best of each target and its refit on all rows."""

    family: str
    rows: list                         # family, target, config, params (JSON), mean fold MAE, rank, chosen
    best: dict                         # target key -> params
    cv_mae: dict                       # target key -> mean fold MAE of the best
    run: FittedRun
    search_seconds: float


def random_search(train: DataFrame, zones: DataFrame, family: str, space: dict | None = None,
                  n_configs: int = SEARCH_CONFIGS, n_folds: int = SEARCH_FOLDS, cfg: C.RunConfig = C.DEFAULT
                  ) -> SearchResult:
    """``random_searches`` of one family."""
    return random_searches(train, zones, (family,), {family: space or SEARCH_SPACE[family]}, n_configs, n_folds, cfg)[family]


def random_searches(train: DataFrame, zones: DataFrame, families, spaces: dict | None = None,
                    n_configs: int = SEARCH_CONFIGS, n_folds: int = SEARCH_FOLDS, cfg: C.RunConfig = C.DEFAULT
                    ) -> dict[str, SearchResult]:
    """Score every (config, fold) of each family by fold MAE, then refit the best config of each target on all rows.

    The feature state is refitted inside each fold. All fits of all families, folds, configs and targets share the
    folds' features and binned rows; a fold's test rows travel with its training rows and are scored
    by the finished model where they are. The families share the search, so each has the time of all.
    """
    from .evaluation import FOLD_COLS, before_fold, fold_assignment
    t0 = time.time()
    shared_dir(train.sparkSession)
    assigned = fold_assignment(train, n_folds).cache()

    def fold_rows(f: int) -> DataFrame:
        # forward only: fold f trains on every row before its test window
        before, test = before_fold(assigned, f), assigned.where(F.col("test_fold") == f).drop(*FOLD_COLS)
        fm = feature_pipeline(zones, cfg).fit(before)
        return boost_rows(fm.transform(before), data=f).unionByName(
            boost_rows(fm.transform(test), data=f, train=F.lit(False)))

    # the feature states of the folds and of the refits don't depend on each other
    with ThreadPoolExecutor(max_workers=n_folds + 1) as ex:
        whole = ex.submit(Prepared.of, train, zones, cfg)
        rows = reduce(DataFrame.unionByName, ex.map(fold_rows, range(n_folds)))
    configs = {family: sample_configs((spaces or SEARCH_SPACE)[family], n_configs) for family in families}
    jobs = [(family, ci, f, k) for family in families for ci in range(len(configs[family])) for f in range(n_folds)
            for k in range(len(TARGET_KEYS))]
    got = fit_boosted(rows, [Fit(replace(BOOSTED[family], **configs[family][ci]), f, k) for family, ci, f, k in jobs],
                      len(C.FEATURE_ORDER), len(TARGET_KEYS))
    assigned.unpersist()
    mae = {j: m.held_error / max(m.held_rows, 1) for j, m in zip(jobs, got)}
    seconds = time.time() - t0

    def result(family: str) -> SearchResult:
        report, best, cv = [], {}, {}
        for i, k in enumerate(TARGET_KEYS):
            scores = sorted((sum(mae[family, ci, f, i] for f in range(n_folds)) / n_folds, ci)
                            for ci in range(len(configs[family])))
            for rank, (score, ci) in enumerate(scores, start=1):
                report.append((family, k, ci, json.dumps(configs[family][ci], sort_keys=True), score, rank, rank == 1))
            best[k], cv[k] = configs[family][scores[0][1]], scores[0][0]
        run = fit_run(train, zones, family, params=best, cfg=cfg, prepared=whole.result())
        return SearchResult(family, report, best, cv, run, seconds)

    with ThreadPoolExecutor(max_workers=len(families)) as ex:
        return dict(zip(families, ex.map(result, families)))
