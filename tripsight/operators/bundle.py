"""Self-contained scoring bundle: feature stages, one model per target, metadata (MOD-15, SRC-12..14)."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import SparkSession

from .. import config as C
from .boosting import BoostedTrees
from .ml import BOOSTED, FittedRun

REQUIRED_KEYS = ("feature_order", "model_version", "targets", "family", "models")
MODEL_CLASSES = {"decision_tree": DecisionTreeRegressionModel, "linear": LinearRegressionModel,
                 "forest": RandomForestRegressionModel, **dict.fromkeys(BOOSTED, BoostedTrees)}


def export_bundle(run: FittedRun, path: str, version: str = C.DEFAULT.model_version) -> str:
    """Write ``features/``, ``model_<target>/`` and ``metadata.json`` under ``path``."""
    run.features.write().overwrite().save(f"{path}/features")
    for k, m in run.models.items():
        m.write().overwrite().save(f"{path}/model_{k}")
    meta = {"feature_order": list(C.FEATURE_ORDER), "model_version": version, "targets": list(run.models),
            "family": run.family, "models": {k: f"model_{k}" for k in run.models}, "log_target": run.log_target}
    # written through Spark, so the bundle lives on whatever filesystem the shared folder is on
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/metadata")
    return path


def read_metadata(path: str) -> dict:
    spark = SparkSession.getActiveSession()
    return json.loads(spark.read.text(f"{path}/metadata").first()["value"])


def load_bundle(path: str) -> dict:
    """SRC-14: load with contract checks; failures are reported, not raised.

    Returns {"status": "ok"|"degraded", "detail": str, "run": FittedRun|None, "version": str|None}.
    """
    try:
        meta = read_metadata(path)
        missing = [k for k in REQUIRED_KEYS if k not in meta]
        if missing:
            return {"status": "degraded", "detail": f"bundle lacks keys {missing}", "run": None, "version": None}
        if set(meta["feature_order"]) != set(C.FEATURE_ORDER) or len(meta["feature_order"]) != len(C.FEATURE_ORDER):
            return {"status": "degraded", "detail": "feature set differs from the contract", "run": None,
                    "version": meta.get("model_version")}
        feats = PipelineModel.load(f"{path}/features")
        cls = MODEL_CLASSES[meta["family"]]
        models = {k: cls.load(f"{path}/{rel}") for k, rel in meta["models"].items()}
        run = FittedRun(meta["family"], feats, models, {}, bool(meta.get("log_target")))
        return {"status": "ok", "detail": "", "run": run, "version": meta["model_version"]}
    except Exception as e:  # noqa: BLE001 - a broken bundle degrades the service
        return {"status": "degraded", "detail": repr(e)[:500], "run": None, "version": None}


def fit_or_load(path: str, fit) -> tuple[FittedRun, str]:
    """SRC-13: reuse a valid bundle at ``path``; otherwise ``fit()``, export, and return it."""
    got = load_bundle(path)
    if got["status"] == "ok":
        return got["run"], "loaded"
    run = fit()
    export_bundle(run, path)
    return run, "fitted"
