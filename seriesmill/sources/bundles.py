"""Saved models: a fitted pipeline plus one row that describes it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

META_SCHEMA = "task string, horizon int, model_name string, feature_cols array<string>, feature_types array<string>"


@dataclass(frozen=True)
class Bundle:
    task: str
    horizon: int
    model_name: str
    feature_cols: list[str]
    feature_types: list[str]
    model: PipelineModel

    @property
    def dtypes(self) -> dict[str, str]:
        return dict(zip(self.feature_cols, self.feature_types))


def bundle_path(model_dir: str, horizon: int, task: str) -> str:
    kind = "reg" if task == "regression" else "dir"
    return f"{model_dir.rstrip('/')}/rice_price_{kind}_h{horizon}"


def save_bundle(spark: SparkSession, model_dir: str, bundle: Bundle) -> str:
    path = bundle_path(model_dir, bundle.horizon, bundle.task)
    bundle.model.write().overwrite().save(f"{path}/model")
    row = (bundle.task, bundle.horizon, bundle.model_name, bundle.feature_cols, bundle.feature_types)
    spark.createDataFrame([row], META_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return path


def load_bundle(spark: SparkSession, model_dir: str, horizon: int, task: str) -> Bundle:
    path = bundle_path(model_dir, horizon, task)
    try:
        row = spark.read.schema(META_SCHEMA).json(f"{path}/meta").first()
    except AnalysisException as exc:
        raise FileNotFoundError(f"no model at {path}") from exc
    if row is None:
        raise FileNotFoundError(f"no model at {path}")
    return Bundle(*row, PipelineModel.load(f"{path}/model"))
