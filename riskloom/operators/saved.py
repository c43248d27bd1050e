"""A fitted scorecard as ``pyspark.ml`` stages that can be saved and loaded in another session.

``WoeStage`` adds the WoE of features under a fitted encoder, ``ScoreStage``
the weighted score, its calibrated probability and the grade.  Both take part
in a ``PipelineModel`` and work on batch and streaming rows alike.  Bins,
weights and the offset are bounded and go with the stage's metadata; levels of
categorical features grow with the data and are a parquet table beside it.

A level not seen in the fit takes the WoE of bin 0, also after loading.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import GRADE_EDGES, GRADE_LABELS, dbl, grade_label, logit, sigmoid
from . import woe as W


class _StageWriter(MLWriter):
    def __init__(self, stage: _SavedStage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession,
                                         extraMetadata={"state": self.stage.state()})
        for name, table in self.stage.tables().items():
            table.write.parquet(f"{path}/{name}")


class _StageReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls.restored(metadata["state"], self.sparkSession, path)
        stage._resetUid(metadata["uid"])
        return stage


class _SavedStage(Transformer, MLWritable, MLReadable):
    """A stage whose ``state`` is a small JSON value and whose ``tables`` are written beside it."""

    def state(self) -> dict:
        raise NotImplementedError

    def tables(self) -> dict[str, DataFrame]:
        return {}

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader(cls)


class WoeStage(_SavedStage):
    """Adds ``prefix`` + feature for each of ``features``; all columns stay."""

    def __init__(self, encoder: W.Encoder, features: Sequence[str], prefix: str = "woe_"):
        super().__init__()
        self.encoder, self.features, self.prefix = encoder, list(features), prefix

    def _transform(self, df: DataFrame) -> DataFrame:
        return W.transform(df, self.encoder, self.features, self.prefix, keep=df.columns)

    def state(self) -> dict:
        bins = {}
        for f, b in self.encoder.bins.items():
            bins[f] = {"kind": b.kind, "iv": b.iv}
            if b.kind == "categorical":
                bins[f] |= {"n_bins": b.n_bins, "first": b.first}
            else:
                bins[f] |= {"edges": list(b.edges), "values": list(b.values), "woe": list(b.woe)}
        return {"bins": bins, "convention": self.encoder.convention, "closed": self.encoder.closed,
                "features": self.features, "prefix": self.prefix}

    def tables(self) -> dict[str, DataFrame]:
        return {"bins": self.encoder.rows}

    @classmethod
    def restored(cls, state: dict, spark: SparkSession, path: str) -> WoeStage:
        rows = spark.read.schema(W.TABLE_SCHEMA).parquet(f"{path}/bins")
        bins = {}
        for f, b in state["bins"].items():
            if b["kind"] == "categorical":
                table = rows.where((F.col("type") == "categorical") & (F.col("feature") == f))
                bins[f] = W.CategoryBins(f, table, b["n_bins"], b["first"], b["iv"])
            else:
                bins[f] = W.FeatureBins(f, b["kind"], b["edges"], b["values"], b["woe"], b["iv"])
        return cls(W.Encoder(bins, rows, state["convention"], state["closed"]), state["features"], state["prefix"])


class ScoreStage(_SavedStage):
    """Adds p, p_cal and grade from weighted columns; ``decimals`` rounds both probabilities.

    ``inputs`` (the weighted columns) are dropped unless ``keep_inputs``.
    """

    def __init__(self, weights: Mapping[str, float], intercept: float, offset: float = 0.0,
                 edges: Sequence[float] = GRADE_EDGES, labels: Sequence[str] = GRADE_LABELS,
                 decimals: int | None = None, keep_inputs: bool = False):
        super().__init__()
        self.weights, self.intercept, self.offset = dict(weights), float(intercept), float(offset)
        self.edges, self.labels, self.decimals, self.keep_inputs = list(edges), list(labels), decimals, keep_inputs

    def _transform(self, df: DataFrame) -> DataFrame:
        z = dbl(self.intercept)
        for c, w in self.weights.items():
            z = z + dbl(w) * F.col(c)
        fixed = (lambda x: x) if self.decimals is None else (lambda x: F.round(x, self.decimals))
        df = df.withColumn("p", fixed(sigmoid(z)))
        df = df.withColumn("p_cal", fixed(sigmoid(logit(F.col("p")) + dbl(self.offset))))
        df = df.withColumn("grade", grade_label(F.col("p_cal"), self.edges, self.labels))
        return df if self.keep_inputs else df.drop(*self.weights)

    def state(self) -> dict:
        return {"weights": list(self.weights.items()), "intercept": self.intercept, "offset": self.offset,
                "edges": self.edges, "labels": self.labels, "decimals": self.decimals,
                "keep_inputs": self.keep_inputs}

    @classmethod
    def restored(cls, state: dict, spark: SparkSession, path: str) -> ScoreStage:
        return cls(**{**state, "weights": dict(state["weights"])})


__all__ = ["ScoreStage", "WoeStage"]
