"""Whole runs composed from the operators (MOD-17 selection job, MOD-19 offline run)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import evaluation as EV
from ..operators import ml as ML
from ..operators.bundle import fit_or_load, load_bundle
from ..session import scratch_path
from ..sources import adapters as A
from ..sources import guards as G


def offline_run(spark: SparkSession, sf_dir: str, family: str = "winner", bundle_path: str | None = None) -> list:
    """Guards -> clean and split (written) -> fit or reuse -> evaluate -> slices -> export -> verify.

    Returns (step, status, detail) rows; a guard that does not hold stops the run, and so
    does the last step when the exported bundle does not load under its contract.
    """
    from .catalog import cleaned_split, fitted, train_test
    steps = []
    rows = G.row_count_audit(spark, sf_dir, tables=("events",)).first()
    if not rows.ok:
        raise ValueError(f"events has {rows.rows} rows < {rows.min_rows}")
    steps.append(("ingest_guard", "ok", f"events rows={rows.rows}"))
    zones = G.assert_lookup_contract(A.zone_lookup(spark))
    steps.append(("lookup_guard", "ok", f"{zones} zones"))
    split = cleaned_split(spark, sf_dir)
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    steps.append(("clean_and_split", "ok", f"train={counts.get('train', 0)} test={counts.get('test', 0)}"))
    _, test = train_test(spark, sf_dir)
    path = bundle_path or scratch_path(spark, "bundle")
    run, how = fit_or_load(path, lambda: fitted(spark, sf_dir, family))
    steps.append(("train", "ok", f"{family} {how}"))
    pred = run.predict(ML.spread(test, counts.get("test", 0), "trip_id")).drop("features").persist()
    metrics = {r.target: r.mae for r in EV.regression_metrics(pred, family).collect()}
    steps.append(("evaluate", "ok", " ".join(f"{k}_mae={v:.4f}" for k, v in sorted(metrics.items()))))
    top = ML.importances(run).where("rank = 1").collect()
    steps.append(("importances", "ok", " ".join(f"{r.target}:{r.feature}" for r in sorted(top, key=lambda r: r.target))))
    sl = EV.slice_frame(EV.with_residuals(pred), A.zones(spark))
    steps.append(("residual_slices", "ok", f"rows={EV.residual_slices(sl).count()}"))
    pred.unpersist()
    got = load_bundle(path)
    steps.append(("verify_bundle", got["status"], got["detail"] or f"version={got['version']}"))
    if got["status"] != "ok":
        raise RuntimeError(f"exported bundle failed its contract: {got['detail']}")
    return steps


def steps_frame(spark: SparkSession, steps: list) -> DataFrame:
    return spark.createDataFrame([(i + 1, *s) for i, s in enumerate(steps)],
                                 "step_order int, step string, status string, detail string")
