"""Row filters and guards (inventory rows 7, 8, 16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed values that must equal the reference's.
MIN_TRAINING_ROWS = 500
MSG_NOT_ENOUGH_ROWS = "Not enough training rows after feature/target creation: {rows}"


class NotEnoughRowsError(ValueError):
    pass


def drop_incomplete(df: DataFrame, feature_cols: Sequence[str], target: str | None = "target") -> DataFrame:
    """Row 7: drop rows where any feature (or the target) is missing; +-inf
    and NaN count as missing.

    One filter ``abs(c) < inf`` per column (false for NULL, NaN and +-inf);
    the columns are not re-projected, which keeps Catalyst's constraint
    propagation linear on wide frames.
    """
    cols = list(feature_cols) + ([target] if target else [])
    inf = F.lit(float("inf"))
    cond = None
    for c in cols:
        term = F.abs(F.col(c)) < inf
        cond = term if cond is None else cond & term
    return df.where(cond)


def count_at_least(df: DataFrame, n: int) -> int:
    """min(count, n) without counting the whole table."""
    return df.limit(n).count()


def min_rows_guard(df: DataFrame, min_rows: int = MIN_TRAINING_ROWS, known_rows: int | None = None) -> int:
    """Row 8: fail when fewer than ``min_rows`` usable rows remain."""
    seen = known_rows if known_rows is not None else count_at_least(df, min_rows)
    if seen < min_rows:
        raise NotEnoughRowsError(MSG_NOT_ENOUGH_ROWS.format(rows=seen))
    return seen


def align_features(df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Row 16: exactly ``feature_cols`` in that order, as double; absent -> 0.0,
    extra columns dropped (``keep`` columns, e.g. keys, go first)."""
    have = set(df.columns)
    cols = [F.col(c) for c in keep]
    for c in feature_cols:
        cols.append((F.col(c).try_cast("double") if c in have else F.lit(0.0)).alias(c))
    return df.select(*cols)
