"""candlewick: return forecasting from daily bars on Spark.

The public API in one place (every name is a lazy DataFrame plan or a
Spark ML job; see README.md for the full operator map).
"""

from candlewick.operators.features import add_returns, forward_target, tabular_features
from candlewick.operators.guards import align_features, drop_incomplete, min_rows_guard
from candlewick.operators.halving import select_by_halving
from candlewick.operators.metrics import cv_summary, directional_accuracy, fold_metrics, mae, run_summary
from candlewick.operators.models import (
    price_context, quantile_forecast, quantile_forecast_rows, read_model, ridge_fit, ridge_score, select_model,
    sequence_model, sequence_predict, sequence_windows, write_model,
)
from candlewick.operators.running import running_forecast_rows, running_quantile
from candlewick.operators.scoring import (
    features_for_requests, score_latest_bars, score_minimal, score_requests, score_windows, triage,
    validate_requests,
)
from candlewick.operators.sequence import sequence_fit
from candlewick.operators.splits import chronological_holdout, date_folds, global_position, walk_forward_folds
from candlewick.operators.train import cross_validate, train_pipeline, training_rows
from candlewick.session import local_session, materialize
from candlewick.sources.bars import filter_universe, load_bars, prepare_bars
from candlewick.sources.requests import REQUEST_SCHEMA, read_requests
from candlewick.sources.store import read_bar_store, write_bar_store
from candlewick.streaming.scoring_stream import score_stream, start_scoring_stream

__all__ = [
    "add_returns", "forward_target", "tabular_features",
    "align_features", "drop_incomplete", "min_rows_guard",
    "cv_summary", "directional_accuracy", "fold_metrics", "mae", "run_summary",
    "price_context", "quantile_forecast", "quantile_forecast_rows", "read_model", "ridge_fit", "ridge_score",
    "running_forecast_rows", "running_quantile",
    "select_by_halving", "select_model", "sequence_fit", "sequence_model", "sequence_predict", "sequence_windows", "write_model",
    "features_for_requests", "score_latest_bars", "score_minimal", "score_requests", "score_windows", "triage",
    "validate_requests",
    "chronological_holdout", "date_folds", "global_position", "walk_forward_folds",
    "cross_validate", "train_pipeline", "training_rows",
    "local_session", "materialize",
    "filter_universe", "load_bars", "prepare_bars",
    "read_bar_store", "write_bar_store", "REQUEST_SCHEMA", "read_requests",
    "score_stream", "start_scoring_stream",
]
