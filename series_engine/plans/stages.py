"""Savable ML stages wrapping the DataFrame operators.

Each stage is a thin ``Transformer``/``Estimator`` over a function in
``operators`` so a fitted pipeline can be saved and loaded (the module must
be importable where the model is loaded)."""

from __future__ import annotations

from itertools import chain

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from ..operators import balance, clean, features


class DropIncomplete(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drop rows with any NULL (or NaN) value."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def _transform(self, dataset):
        return clean.drop_incomplete(dataset)


class Clip(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Clip ``inputCols`` to ±``threshold`` (type kept)."""

    threshold = Param(Params._dummy(), "threshold", "absolute bound", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, threshold=20.0):
        super().__init__()
        self._setDefault(threshold=20.0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return clean.clip(dataset, self.getInputCols(), self.getOrDefault(self.threshold))


class SeriesFeatures(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Runs of ``runCol`` per entity → moving average → lags → drop rows
    without a full window → stride → one feature vector per kept row
    (x lags, then y lags, … latest first).  Adds ``eventCol`` and the vector;
    the input axis columns hold the averages afterwards."""

    runCol = Param(Params._dummy(), "runCol", "column whose changes split runs", typeConverter=TypeConverters.toString)
    eventCol = Param(Params._dummy(), "eventCol", "run id column", typeConverter=TypeConverters.toString)
    partitionBy = Param(Params._dummy(), "partitionBy", "entity columns", typeConverter=TypeConverters.toListString)
    orderBy = Param(Params._dummy(), "orderBy", "order columns", typeConverter=TypeConverters.toListString)
    windowSize = Param(Params._dummy(), "windowSize", "lags per axis", typeConverter=TypeConverters.toInt)
    movingAvgPeriod = Param(Params._dummy(), "movingAvgPeriod", "rows before current in the average",
                            typeConverter=TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "keep one row every step", typeConverter=TypeConverters.toInt)
    chunkWidth = Param(Params._dummy(), "chunkWidth",
                       "order-column chunk width: a number, 'day' or 'auto' (= 'default')",
                       typeConverter=TypeConverters.toString)
    blockRows = Param(Params._dummy(), "blockRows", "rows per window block", typeConverter=TypeConverters.toInt)
    uniqueOrder = Param(Params._dummy(), "uniqueOrder", "orderBy is unique per entity (skip row-hash tie-break)",
                        typeConverter=TypeConverters.toBoolean)

    completeAxes = Param(Params._dummy(), "completeAxes", "inputCols hold no NULL (behind DropIncomplete): skip the look",
                         typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, outputCol="features", runCol="action", eventCol="event",
                 partitionBy=None, orderBy=None, windowSize=50, movingAvgPeriod=20, step=20,
                 chunkWidth="default", blockRows=1 << 20, uniqueOrder=False, completeAxes=False):
        super().__init__()
        self._setDefault(outputCol="features", runCol="action", eventCol="event", windowSize=50,
                         movingAvgPeriod=20, step=20, chunkWidth="default", blockRows=1 << 20,
                         uniqueOrder=False, completeAxes=False)
        self._set(**self._input_kwargs)

    def chain(self) -> dict:
        """The settings of the feature chain, for work across micro-batches."""
        g = self.getOrDefault
        return {"cols": list(self.getInputCols()), "by": list(g(self.partitionBy)), "order": list(g(self.orderBy)),
                "label": g(self.runCol), "period": g(self.movingAvgPeriod), "n": g(self.windowSize), "step": g(self.step),
                "event_col": g(self.eventCol), "chunk_width": _parse_width(g(self.chunkWidth)),
                "block_rows": g(self.blockRows), "unique_order": g(self.uniqueOrder)}

    def _transform(self, dataset):
        g = self.getOrDefault
        cols = self.getInputCols()
        n = g(self.windowSize)
        width = _parse_width(g(self.chunkWidth))
        out = features.event_features(
            dataset, cols, g(self.partitionBy), g(self.orderBy), g(self.runCol),
            period=g(self.movingAvgPeriod), n=n, step=g(self.step), event_col=g(self.eventCol),
            suffix="_lags", rank_col=None, chunk_width=width,
            block_rows=g(self.blockRows), unique_order=g(self.uniqueOrder), complete_axes=g(self.completeAxes))
        out = features.assemble(out, [f"{c}_lags" for c in cols], self.getOutputCol())
        return out.drop(*[f"{c}_lags" for c in cols])


def _parse_width(text: str):
    if text in ("", "default", "auto", None):
        return None
    if text == "day":
        return "day"
    return float(text)


# Most classes a fitted weight map holds.
MAX_CLASSES = 10_000


class ClassWeights(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fit: per-class weight max_count / count (counted once, at fit)."""

    @keyword_only
    def __init__(self, inputCol="label", outputCol="weight"):
        super().__init__()
        self._setDefault(inputCol="label", outputCol="weight")
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        # one row per class; a label with more values than this is no class label
        table = balance.weight_table(dataset, self.getInputCol(), "w").limit(MAX_CLASSES + 1).collect()
        if len(table) > MAX_CLASSES:
            raise ValueError(f"{self.getInputCol()} has more than {MAX_CLASSES} values")
        labels = [float(r[0]) for r in table if r[0] is not None]
        weights = [float(r[1]) for r in table if r[0] is not None]
        return ClassWeightsModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                                 labels=labels, weights=weights)


class ClassWeightsModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the fitted weight by a literal class → weight map (no job)."""

    labels = Param(Params._dummy(), "labels", "classes", typeConverter=TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "weights", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCol="label", outputCol="weight", labels=None, weights=None):
        super().__init__()
        self._setDefault(inputCol="label", outputCol="weight", labels=[], weights=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        pairs = list(zip(self.getOrDefault(self.labels), self.getOrDefault(self.weights)))
        if not pairs:
            return dataset.withColumn(self.getOutputCol(), F.lit(None).cast("double"))
        m = F.create_map(*[F.lit(v) for v in chain(*pairs)])
        return dataset.withColumn(self.getOutputCol(), m[F.col(self.getInputCol()).cast("double")])
