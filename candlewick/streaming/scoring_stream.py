"""Row 56: micro-batch scoring over a stream of request records.

Each request carries its whole bar window, so the stream is stateless:
``readStream`` of JSON request files (parsed field by field) -> ``foreachBatch`` runs the batch
scorer (row windows are not allowed on streaming frames, but are on the
static frame a batch hands us) -> one write of all outcomes to
``<out>/batch_id=<id>/kind=scored|rejected`` with ``overwrite``, so a batch
replayed after a failure replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.models import FittedModel
from candlewick.operators.scoring import RESULT_COLUMNS, ScoreResult, score_requests
from candlewick.sources.requests import parse_requests


def start_scoring_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                         model: FittedModel, allow_minimal: bool = False, available_now: bool = True,
                         max_files_per_trigger: int | None = None, model_uri: str = "", loaded_at: float | None = None):
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = parse_requests(reader.text(source_dir).where(F.trim("value") != ""))
    loaded_at = time.time() if loaded_at is None else loaded_at

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        res = score_requests(batch, model, allow_minimal=allow_minimal, model_uri=model_uri, loaded_at=loaded_at)
        write_outcomes(res, f"{out_dir}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_scored(spark: SparkSession, out_dir: str, kind: str = "scored") -> DataFrame:
    """Scored or rejected rows of all batches (partition pruned)."""
    return _halves(spark.read.schema(OUTCOME_SCHEMA).parquet(out_dir).where(F.col("kind") == kind), kind)


def _halves(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*(RESULT_COLUMNS if kind == "scored" else ("request_id", "symbol", "reason")))


OUTCOME_SCHEMA = ("request_id string, symbol string, reason string, pred_return double, pred_price double, model_uri string, "
                  "loaded_at_unix double, used_mode string, batch_id long, kind string")


def write_outcomes(res: ScoreResult, path: str) -> None:
    """One pass over the scored table: both halves, partitioned by ``kind``."""
    kind = F.when(F.col("reason").isNull(), "scored").otherwise("rejected")
    res.outcomes.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(path)


def score_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str, model: FittedModel,
                 allow_minimal: bool = False, max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the stream to completion over the files present now; return the
    scored and rejected tables it wrote."""
    q = start_scoring_stream(spark, source_dir, out_dir, checkpoint_dir, model, allow_minimal,
                             available_now=True, max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))
    return read_scored(spark, out_dir, "scored"), read_scored(spark, out_dir, "rejected")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint directory."""
    import uuid

    from candlewick.session import shared_dir

    base = shared_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["start_scoring_stream", "score_stream", "read_scored", "scratch_dir"]
