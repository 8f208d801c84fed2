"""Predictors fitted with aggregates (single-feature least squares)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluation import TARGET_KEYS


@dataclass
class SingleLinear:
    """MOD-13 with one feature: per target ``y = a + b * trip_distance`` by least squares."""

    coef: dict  # target key -> (intercept, slope)
    feature: str = "trip_distance"

    @classmethod
    def fit(cls, train: DataFrame, feature: str = "trip_distance") -> "SingleLinear":
        aggs = []
        for k, t in TARGET_KEYS.items():
            aggs += [F.regr_intercept(F.col(t), F.col(feature)).alias(f"a_{k}"),
                     F.regr_slope(F.col(t), F.col(feature)).alias(f"b_{k}")]
        row = train.agg(*aggs).first()
        return cls({k: (row[f"a_{k}"], row[f"b_{k}"]) for k in TARGET_KEYS}, feature)

    def predict(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[(F.lit(a) + F.lit(b) * F.col(self.feature)).alias(f"pred_{k}")
                                for k, (a, b) in self.coef.items()])
