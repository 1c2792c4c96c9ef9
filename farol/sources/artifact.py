"""Saving and loading a fitted scorer with what is needed to use it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from farol.operators.normalize import enforce_contract
from farol.operators.report import triage_report
from farol.plans.catalog import NeighboursModel
from farol.plans.training import Scorer
from farol.sources.tables import read_manifest, write_manifest


@dataclass
class Artifact:
    """A scorer with its threshold, feature order, parameters, metrics and training time."""

    scorer: Scorer
    metadata: dict

    def report(self, df: DataFrame, truth: str | None = None) -> DataFrame:
        """The triage report of new cases. A projection around the model: no shuffle of its own."""
        keep = ["id"] + ([truth] if truth else [])
        rows = enforce_contract(df, self.metadata["feature_order"], keep)
        return triage_report(self.scorer.score(rows), self.metadata["threshold"], truth=truth)


def save_artifact(path: str, scorer: Scorer, metadata: dict) -> None:
    """Write preprocessing, model and metadata under `path`; what was there is replaced."""
    spark = SparkSession.getActiveSession()
    model: Model = scorer.model
    extra = {}
    if isinstance(model, NeighboursModel):
        extra = {"neighbours": {"k": model.k, "weights": model.weights, "p": model.p}}
        model.reference.write.mode("overwrite").parquet(f"{path}/reference")
        scorer.prep.write().overwrite().save(f"{path}/pipeline")
    else:
        PipelineModel([scorer.prep, model]).write().overwrite().save(f"{path}/pipeline")
    write_manifest(spark, metadata | extra, f"{path}/metadata")


def load_artifact(spark: SparkSession, path: str) -> Artifact:
    """The saved scorer; an error that says what to do if there is none."""
    try:
        metadata = read_manifest(spark, f"{path}/metadata")
    except AnalysisException as e:
        raise FileNotFoundError(f"no model at {path}: train and save one first") from e
    pipeline = PipelineModel.load(f"{path}/pipeline")
    if "neighbours" in metadata:
        n = metadata["neighbours"]
        return Artifact(Scorer(pipeline, NeighboursModel(spark.read.parquet(f"{path}/reference"), n["k"], n["weights"], n["p"])), metadata)
    return Artifact(Scorer(pipeline.stages[0], pipeline.stages[1]), metadata)
