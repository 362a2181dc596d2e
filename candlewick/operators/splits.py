"""Row positions and chronological splits (inventory rows 32, 36-38).

The reference indexes its training matrix by row position in (symbol, date)
order.  ``global_position`` reproduces that exactly without a global sort:
a ``row_number`` inside each (symbol, segment) plus the number of rows in
all earlier segments, taken from a distributed prefix sum over the small
per-segment count table.  Date-cut splits (row 38) use the same machinery
over per-date counts, so every symbol shares each cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.plans.prefix import running_offsets
from candlewick.plans.segments import DEFAULT_SEGMENT, SEG, segment_of, total_order

# Fixed values that must equal the reference's.
HOLDOUT_TRAIN_FRACTION = 0.8
MIN_SPLITS = 2


@dataclass
class Positioned:
    df: DataFrame  # input rows + ``pos`` (bigint, 0..n-1)
    n: int


def global_position(df: DataFrame, group_col: str = "symbol", order: Sequence[str] = ("date",),
                    segment: str | Column | None = DEFAULT_SEGMENT, out: str = "pos") -> Positioned:
    """Row 32: dense 0..n-1 position in (group, order, tie-breaker) order."""
    df, full, added = total_order(df, order)
    seg = segment_of("date", segment)
    d = df.withColumn(SEG, seg if seg is not None else F.lit(0).cast("long"))
    offs = running_offsets(d.groupBy(group_col, SEG).agg(F.count(F.lit(1)).alias("_n")), [group_col, SEG], "_n", "_segoff")
    w = Window.partitionBy(group_col, SEG).orderBy(*full)
    local = d.withColumn("_rn", F.row_number().over(w) - 1)
    out_df = (
        local.join(offs.df.select(group_col, SEG, "_segoff"), [group_col, SEG])
        .withColumn(out, (F.col("_segoff") + F.col("_rn")).cast("long"))
        .drop("_segoff", "_rn", SEG, *added)
    )
    return Positioned(out_df, offs.total)


def date_position(df: DataFrame, date_col: str = "date", out: str = "dpos") -> Positioned:
    """Position of the first row of each row's date in (date, ...) order.

    All rows of one date share it, so a cut on it never splits a date.
    """
    offs = running_offsets(df.groupBy(date_col).agg(F.count(F.lit(1)).alias("_n")), [date_col], "_n", out)
    return Positioned(df.join(offs.df.select(date_col, out), [date_col]), offs.total)


@dataclass(frozen=True)
class FoldPlan:
    n: int
    k: int
    size: int

    @property
    def first_test(self) -> int:
        return self.n - self.k * self.size

    def test_start(self, i: int) -> int:
        return self.n - (self.k - i) * self.size

    def test_end(self, i: int) -> int:
        return self.test_start(i) + self.size


def fold_plan(n: int, n_splits: int = 5) -> FoldPlan:
    """Row 36 bounds: k = max(n_splits, 2) expanding folds of n // (k+1) rows."""
    k = max(int(n_splits), MIN_SPLITS)
    size = n // (k + 1)
    if size <= 0:
        raise ValueError(f"{n} rows are too few for {k} folds: each fold and the first training part need a row")
    return FoldPlan(n, k, size)


def fold_of(plan: FoldPlan, pos: str = "pos") -> Column:
    """Fold id of a row (NULL = only ever used for training)."""
    p = F.col(pos)
    return F.when(p >= plan.first_test, F.floor((p - plan.first_test) / plan.size).cast("int"))


def walk_forward_folds(df: DataFrame, n: int, n_splits: int = 5, pos: str = "pos") -> tuple[DataFrame, FoldPlan]:
    """Row 36: label each row with its test fold (train rows of fold i: pos < start_i)."""
    plan = fold_plan(n, n_splits)
    return df.withColumn("fold", fold_of(plan, pos)), plan


def fold_train(df: DataFrame, plan: FoldPlan, i: int, pos: str = "pos") -> DataFrame:
    return df.where(F.col(pos) < plan.test_start(i))


def fold_test(df: DataFrame, plan: FoldPlan, i: int, pos: str = "pos") -> DataFrame:
    return df.where((F.col(pos) >= plan.test_start(i)) & (F.col(pos) < plan.test_end(i)))


def holdout_cut(n: int, frac: float = HOLDOUT_TRAIN_FRACTION) -> int:
    return int(n * frac)


def chronological_holdout(df: DataFrame, n: int, frac: float = HOLDOUT_TRAIN_FRACTION, pos: str = "pos") -> DataFrame:
    """Row 37: first int(frac * n) positions train, the rest validate."""
    return df.withColumn("is_train", F.col(pos) < F.lit(holdout_cut(n, frac)))


def date_folds(df: DataFrame, n_splits: int = 5, frac: float = HOLDOUT_TRAIN_FRACTION,
               date_col: str = "date") -> tuple[DataFrame, FoldPlan]:
    """Row 38: the same fold and holdout arithmetic, cut on dates.

    A date belongs to the fold that contains its first row; training rows of
    fold i are all dates before that fold's first date.
    """
    positioned = date_position(df, date_col, "dpos")
    plan = fold_plan(positioned.n, n_splits)
    out = (
        positioned.df.withColumn("fold", fold_of(plan, "dpos"))
        .withColumn("is_train", F.col("dpos") < F.lit(holdout_cut(positioned.n, frac)))
    )
    return out, plan
