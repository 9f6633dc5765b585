"""Fitted preparation steps as Spark ML models that can be saved, loaded and put in a pipeline.

A model is its settings and a few tables: what ``fit`` learnt.  Settings are kept
in the metadata that Spark ML writes for any model, tables as parquet beside it.
"""

from __future__ import annotations

import json
from dataclasses import fields

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from tillwork.operators.prep import FeatureTable, OutlierModel, TargetEncoder, WoeEncoder
from tillwork.session import small_side

KINDS = {k.__name__: k for k in (OutlierModel, TargetEncoder, FeatureTable, WoeEncoder)}
#: Fields that hold what was learnt; all others are settings.
LEARNT = {"bounds", "tables", "prior", "encoder", "medians", "weights"}


def _settings(step) -> dict:
    return {f.name: getattr(step, f.name) for f in fields(step) if f.name not in LEARNT}


def _taken_apart(step) -> tuple[dict, dict[str, DataFrame]]:
    """Settings and named tables of a fitted step."""
    settings, tables = _settings(step), {}
    for f in fields(step):
        held = getattr(step, f.name)
        if f.name == "encoder":
            tables |= {f"encoder/{k}": t for k, t in _taken_apart(held)[1].items()}
        elif f.name in LEARNT:
            tables |= {f"{f.name}/{k}": t for k, t in held.items()} if isinstance(held, dict) else {f.name: held}
    return settings, tables


def _put_together(kind: str, settings: dict, tables: dict[str, DataFrame]):
    """A fitted step from its settings and tables."""
    step = KINDS[kind](**settings)
    under = lambda name: {k.split("/", 1)[1]: t for k, t in tables.items() if k.startswith(f"{name}/")}
    for f in fields(step):
        if f.name == "encoder":
            step.encoder = _put_together("TargetEncoder", {"columns": settings["categories"], "target": settings["target"]}, under("encoder"))
        elif f.name in LEARNT:
            setattr(step, f.name, tables[f.name] if f.name in tables else {k: small_side(t) for k, t in under(f.name).items()})
    return step


class FittedStep(Model, MLWritable, MLReadable):
    """A fitted step of ``KINDS``."""

    def __init__(self, kind: str | None = None, settings: dict | None = None, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.kind, self.settings, self.tables = kind, settings or {}, tables or {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _put_together(self.kind, self.settings, self.tables).transform(dataset)

    def write(self) -> MLWriter:
        return _StepWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StepReader()


class FitStep(Estimator):
    """Fits one of the steps of ``KINDS``, given with its settings."""

    def __init__(self, step):
        super().__init__()
        if type(step).__name__ not in KINDS:
            raise ValueError(f"a step is one of {', '.join(KINDS)}")
        self.step = step

    def _fit(self, dataset: DataFrame) -> FittedStep:
        return FittedStep(type(self.step).__name__, *_taken_apart(type(self.step)(**_settings(self.step)).fit(dataset)))


class _StepWriter(MLWriter):
    def __init__(self, model: FittedStep):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        names = sorted(self.model.tables)
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={
            "kind": self.model.kind, "settings": json.dumps(self.model.settings), "tables": names})
        for place, name in enumerate(names):
            self.model.tables[name].write.parquet(f"{path}/tables/{place}")


class _StepReader(MLReader):
    def load(self, path: str) -> FittedStep:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {name: self.sparkSession.read.parquet(f"{path}/tables/{place}") for place, name in enumerate(metadata["tables"])}
        model = FittedStep(metadata["kind"], json.loads(metadata["settings"]), tables)
        model._resetUid(metadata["uid"])
        return model
