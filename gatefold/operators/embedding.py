"""Principal components over distributed moments, a saved model, and projection into it; layout.py has the neighbour embedding."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.functions.numeric import col, finite


class MissingFeatures(ValueError):
    pass


def fit_pca(df: DataFrame, features: list[str]) -> dict:
    """Mean, scale and two leading axes from one aggregation of first and second moments."""
    x = [F.when(finite(f), col(f)).otherwise(0.0) for f in features]
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)], *[F.covar_samp(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    if one["n"] < 3:
        raise ValueError("fewer than three rows")
    c = np.zeros((k, k))
    for i, j in pairs:
        c[i, j] = c[j, i] = one[f"c{i}_{j}"] or 0.0
    sd = np.sqrt(np.maximum(np.diag(c), 0))
    scale = np.where(sd > 0, sd, 1.0)
    val, vec = np.linalg.eigh(c / np.outer(scale, scale))
    axes = vec[:, np.argsort(-val)[:2]].T
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(1)[:, None], 1) < 0, -1, 1)
    return {"features": features, "mean": [float(one[f"m{i}"]) for i in range(k)], "scale": scale.tolist(), "axes": axes.tolist()}


def project(df: DataFrame, model: dict, out: tuple[str, str] = ("pc_1", "pc_2")) -> DataFrame:
    """df with two coordinates; a feature that the model needs and df lacks is an error."""
    gone = [f for f in model["features"] if f not in df.columns]
    if gone:
        raise MissingFeatures(f"features of the model that are missing: {gone}")
    z = [(F.when(finite(f), col(f)).otherwise(m) - m) / s for f, m, s in zip(model["features"], model["mean"], model["scale"], strict=True)]
    return df.withColumns({o: sum((v * float(w) for v, w in zip(z, a, strict=True)), F.lit(0.0)) for o, a in zip(out, model["axes"], strict=True)})


def save_model(spark: SparkSession, model: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(model),)], "model string").coalesce(1).write.text(path)


def load_model(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path).collect()
    model = json.loads(rows[0][0]) if rows else {}
    if not {"features", "mean", "scale", "axes"} <= set(model):
        raise MissingFeatures("the model has no scaling parameters")
    return model
