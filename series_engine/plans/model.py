"""Activity model: build, fit (feature chain computed once), score, evaluate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, MinMaxScaler, PCA, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..session import write_table
from .stages import ClassWeights, Clip, DropIncomplete, SeriesFeatures


@dataclass
class ModelParams:
    """Defaults of the model builder; the training job overrides several."""

    cap: float = 20.0
    features_size: int = 50
    moving_avg_period: int = 20
    step: int = 20
    pca_components: int = 10
    num_trees: int = 20
    max_depth: int = 5
    bootstrap: bool = True         # rows resampled per tree
    seed: int = 123
    entity: list = field(default_factory=lambda: ["userId"])
    order: list = field(default_factory=lambda: ["timestamp"])
    action: str = "action"
    axes: list = field(default_factory=lambda: ["x", "y", "z"])
    chunk_width: object = "auto"   # number, "day" or "auto" (sized from the data)
    block_rows: int = 1 << 20
    unique_order: bool = False     # order is unique per entity: skip the row-hash tie-break


# Training-job settings of the activity model (window 100 rows = 5 s,
# average over 5 + 1 rows, 10 components, one row per second, 40 trees of
# depth 10).
TRAINING_PARAMS = dict(cap=20.0, features_size=100, moving_avg_period=5, pca_components=10,
                       step=20, num_trees=40, max_depth=10)


def build(p: ModelParams):
    """(feature stages, fit stages).  Feature stages run once per input;
    estimators are fitted on their (checkpointed) output."""
    indexer = StringIndexer(inputCol=p.action, outputCol="label", handleInvalid="keep")
    feats = [
        DropIncomplete(),
        indexer,
        Clip(inputCols=list(p.axes), threshold=float(p.cap)),
        SeriesFeatures(inputCols=list(p.axes), outputCol="features", runCol=p.action, eventCol="event",
                       partitionBy=list(p.entity), orderBy=list(p.order), windowSize=p.features_size,
                       movingAvgPeriod=p.moving_avg_period, step=p.step,
                       chunkWidth=str(p.chunk_width), blockRows=int(p.block_rows),
                       uniqueOrder=bool(p.unique_order), completeAxes=True),
    ]
    fit = [
        PCA(k=p.pca_components, inputCol="features", outputCol="features_PCA"),
        MinMaxScaler(inputCol="features_PCA", outputCol="features_scaled"),
        ClassWeights(inputCol="label", outputCol="weight"),
        RandomForestClassifier(numTrees=p.num_trees, maxDepth=p.max_depth, featuresCol="features_scaled",
                               labelCol="label", weightCol="weight", seed=p.seed, bootstrap=p.bootstrap),
    ]
    return feats, fit


def fit(train: DataFrame, p: ModelParams, cut_lineage: bool = True) -> PipelineModel:
    """Fit every stage in order.  The window chain's output is written once
    as a table in the shared checkpoint folder, so PCA, scaler, weights and
    the forest all read it instead of recomputing the windows (and a lost
    executor does not send them back to the raw input)."""
    feats, fit_stages = build(p)
    fitted = []
    x = train
    for st in feats:
        m = st.fit(x) if isinstance(st, Estimator) else st
        fitted.append(m)
        x = m.transform(x)
    keep = [*p.entity, *p.order, "label", "features"]
    x = x.select(*keep)
    if cut_lineage:
        x = write_table(x, "features")
    for st in fit_stages:
        m = st.fit(x)
        fitted.append(m)
        x = m.transform(x)
    return PipelineModel(stages=fitted)


def label_names(model: PipelineModel) -> list[str]:
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            return list(s.labels)
    raise ValueError("model has no label index stage")


def score(model: PipelineModel, df: DataFrame, out: str = "predicted_action") -> DataFrame:
    """Predictions with label names.  The weight stage is skipped (weights only
    matter at fit)."""
    from .stages import ClassWeightsModel
    stages = [s for s in model.stages if not isinstance(s, ClassWeightsModel)]
    x = PipelineModel(stages=stages).transform(df)
    return IndexToString(inputCol="prediction", outputCol=out, labels=label_names(model)).transform(x)


def evaluate(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Accuracy, per-class precision and recall of ``model`` on ``df``."""
    pred = score(model, df)
    return ev.metrics(pred.filter(F.col("label").isNotNull()), "label", "prediction")
