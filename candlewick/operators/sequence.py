"""Sequence regressor trained epoch by epoch without materialised windows (row 48).

The model is linear in the ``seq_len`` feature rows before a row and is fitted
to the absolute error itself: each epoch is one pass that gives the error and
its gradient over all rows, and one Adam step on the driver (``seq_len * d + 1``
numbers).  A window of L rows would copy every row L times.  Here a series is
written once as pieces (a segment and the L rows before it), and a pass slides
over them: the prediction is a sum of L shifted products, the gradient of each
lag one matrix product.

Nulls and non-finite features count as 0.0; rows without a finite label or with
fewer than ``seq_len`` rows before them take no part.  Equal rows count each.
A table without a full window is refused, as it leaves nothing to fit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.columns import finite_or_null
from candlewick.operators.models import MSG_SEQUENCE_TOO_SHORT, SEQ_LEN, SequenceModel
from candlewick.plans.segments import DEFAULT_SEGMENT, HALO, SEG, segment_of, total_order, with_halo
from candlewick.session import save

EPOCHS, RATE = 20, 0.05
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


class LinearVectorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A linear model over the vector column ``features`` as a Spark ML stage
    of built-in expressions."""

    weights = Param(Params._dummy(), "weights", "one coefficient per element of the vector", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    def __init__(self, weights: Sequence[float] | None = None, intercept: float = 0.0):
        super().__init__()
        self._set(weights=[float(w) for w in (weights or [])], intercept=float(intercept))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.expr(f"array({', '.join(f'{w!r}D' for w in self.getOrDefault(self.weights))})")
        terms = F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)
        return dataset.withColumn("prediction", F.aggregate(terms, F.lit(self.getOrDefault(self.intercept)), lambda a, t: a + t))


def sequence_pieces(df: DataFrame, feature_cols: Sequence[str], seq_len: int = SEQ_LEN, group_col: str = "symbol",
                    label: str = "target", segment: str | Column | None = DEFAULT_SEGMENT) -> DataFrame:
    """(_y, _x): the rows of one segment in order, after the ``seq_len`` rows
    before it.  ``_y`` is null where a row is only looked back at; ``_x`` has
    the features of all rows one after another."""
    feats = F.array(*[F.coalesce(finite_or_null(c), F.lit(0.0)) for c in feature_cols])
    df, full, _ = total_order(df, ["date"])
    base = df.select(group_col, *full, finite_or_null(label).alias("_y"), feats.alias("_x"))
    halo = with_halo(base, [group_col], full, segment_of("date", segment), back=seq_len)
    y = F.when(F.col(HALO) == 0, F.col("_y"))
    rows = F.array_sort(F.collect_list(F.struct(*full, y.alias("_y"), "_x")))
    return (halo.groupBy(group_col, SEG).agg(rows.alias("r"))
            .select(F.col("r._y").alias("_y"), F.flatten("r._x").alias("_x")))


def _pass(pieces: DataFrame, seq_len: int, centre: np.ndarray, scale: np.ndarray, bias: float, weights: np.ndarray) -> np.ndarray:
    """[rows, sum of absolute errors, sum of signs, gradient sums per lag and
    feature] at the given parameters of the scaled columns (label last)."""
    d = len(centre) - 1

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 + seq_len * d)
        for batch in batches:
            y = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
            size = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            x = (batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - centre[:d]) / scale[:d]
            n = len(y)
            nth = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
            used = (nth >= seq_len) & np.isfinite(y)
            error = np.full(n, bias)
            part = x @ weights.T
            for j in range(min(seq_len, n)):        # j = 0 is the oldest row of a window
                lag = seq_len - j
                if lag < n:
                    error[lag:] += part[:n - lag, j]
            error -= (y - centre[d]) / scale[d]
            sign = np.where(used, np.sign(error), 0.0)
            total[0] += used.sum()
            total[1] += np.abs(error[used]).sum()
            total[2] += sign.sum()
            for j in range(seq_len):
                lag = seq_len - j
                if lag < n:
                    total[3 + j * d:3 + (j + 1) * d] += x[:n - lag].T @ sign[lag:]
        yield pa.RecordBatch.from_pydict({"sums": [total.tolist()]}, pa.schema([("sums", pa.list_(pa.float64()))]))

    parts = pieces.select("_y", "_x").mapInArrow(sums, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
    out = np.zeros(3 + seq_len * d)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():     # as many rows as the model has parameters, and two
        out[row["i"]] = row["v"]
    return out


def fit_pieces(pieces: DataFrame, d: int, seq_len: int, centre: np.ndarray, scale: np.ndarray, epochs: int,
               rate: float) -> tuple[np.ndarray, float, list[float]]:
    """(weights, intercept, mean absolute error per epoch): weights as
    ``seq_len`` x ``d`` of the unscaled columns, oldest row first; an epoch's
    error is that of the parameters it starts with."""
    theta = np.zeros(1 + seq_len * d)
    first, second, errors = np.zeros_like(theta), np.zeros_like(theta), []
    for step in range(1, epochs + 1):
        got = _pass(pieces, seq_len, centre, scale, theta[0], theta[1:].reshape(seq_len, d))
        if not got[0]:
            raise ValueError(MSG_SEQUENCE_TOO_SHORT.format(n=seq_len))
        errors.append(float(scale[d] * got[1] / got[0]))
        gradient = got[2:] / got[0]
        first = BETA1 * first + (1 - BETA1) * gradient
        second = BETA2 * second + (1 - BETA2) * gradient ** 2
        theta = theta - rate * (first / (1 - BETA1 ** step)) / (np.sqrt(second / (1 - BETA2 ** step)) + EPSILON)
    weights = scale[d] * theta[1:].reshape(seq_len, d) / scale[:d]
    return weights, float(centre[d] + scale[d] * theta[0] - (weights * centre[:d]).sum()), errors


def sequence_fit(df: DataFrame, feature_cols: Sequence[str], seq_len: int = SEQ_LEN, label: str = "target", epochs: int = EPOCHS,
                 rate: float = RATE, group_col: str = "symbol",
                 segment: str | Column | None = DEFAULT_SEGMENT) -> tuple[SequenceModel, list[float]]:
    """Row 48: the fitted model and its training mean absolute error per epoch.

    Columns are centred and scaled by their moments (one aggregate), the
    pieces are written once, and every epoch reads them once."""
    cols = list(feature_cols)
    values = [*(F.coalesce(finite_or_null(c), F.lit(0.0)) for c in cols), finite_or_null(label)]
    got = df.agg(*[F.avg(v) for v in values], *[F.stddev_pop(v) for v in values]).first()
    centre, scale = np.array([float(v or 0.0) for v in got]).reshape(2, -1)
    scale = np.where(scale > 1e-14 * np.abs(centre), scale, 1.0)
    stored = save(sequence_pieces(df, cols, seq_len, group_col, label, segment), "sequence-pieces")
    try:
        weights, intercept, errors = fit_pieces(stored.df, len(cols), seq_len, centre, scale, epochs, rate)
    finally:
        stored.drop()
    stage = LinearVectorModel(weights.reshape(-1).tolist(), intercept)
    params = {"seq_len": seq_len, "epochs": epochs, "rate": rate}
    return SequenceModel(PipelineModel(stages=[stage]), cols, "custom_transformer", params), errors
