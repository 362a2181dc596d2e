"""Model selection by successive halving (row 47 under a budget of rows).

A search bounded by a clock gives other results on another cluster.  Here the
bound is the number of rows that all fits together may read: every rung gets
an equal part of it, its points train on a prefix of the training positions,
and the better ones go on to the next rung with a longer prefix.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.models import SelectionResult, _assembled, _fit, default_grid, validation_mae

ETA = 2


def rungs(points: int, rows: int, budget_rows: int, eta: int = ETA) -> list[tuple[int, int]]:
    """(points, rows of each) per rung; the last rung has one point."""
    sizes = [points]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // eta))
    return [(k, min(rows, budget_rows // (len(sizes) * k))) for k in sizes]


def select_by_halving(train: DataFrame, val: DataFrame, feature_cols: Sequence[str], budget_rows: int, label: str = "target",
                      grid: list | None = None, eta: int = ETA, pos: str = "pos", parallelism: int = 4) -> SelectionResult:
    """The last rung's model, and the rung table as its trials (estimator,
    parameters, ``rung``, ``rows``, ``val_mae``, ``kept``).

    ``pos`` numbers the training rows without gaps.  Every point is judged on
    all of ``val``.  Equal errors go by the order of the grid, an error that is
    no number comes last; a point whose prefix does not grow keeps its model.
    An empty training table, or a budget below one row a fit, is refused.
    """
    if eta < 2:
        raise ValueError("eta must be 2 or more")
    points = grid or default_grid(label)
    first, n = train.agg(F.min(pos), F.count(F.lit(1))).first()
    plan = rungs(len(points), n, budget_rows, eta)
    if not n or plan[0][1] < 1:
        raise ValueError("no rows for the first rung: empty training table or too small a budget")
    alive, fitted, trials = list(range(len(points))), {}, []
    for rung, (_, rows) in enumerate(plan):
        fresh = [i for i in alive if (i, rows) not in fitted]
        if fresh:
            data = _assembled(train.where(F.col(pos) < first + rows), feature_cols, label)

            def trial(i: int):
                name, params, regressor = points[i]
                model = _fit(train, feature_cols, regressor, "automl", label, {"estimator": name, **params}, assembled=data)
                return model, validation_mae(model, val, label)

            try:
                with ThreadPoolExecutor(max_workers=min(parallelism, len(fresh))) as pool:
                    fitted.update({(i, rows): got for i, got in zip(fresh, pool.map(trial, fresh), strict=True)})
            finally:
                data.unpersist()
        errors = {i: fitted[i, rows][1] for i in alive}
        ranked = sorted(alive, key=lambda i: (errors[i] != errors[i], errors[i], i))
        kept = set(ranked[:plan[rung + 1][0]] if rung + 1 < len(plan) else ranked[:1])
        trials += [{"estimator": points[i][0], **points[i][1], "rung": rung, "rows": rows, "val_mae": errors[i], "kept": i in kept}
                   for i in alive]
        alive = sorted(kept)
    best, error = fitted[alive[0], plan[-1][1]]
    best.params.update(best_estimator=points[alive[0]][0], val_mae=error, rows=plan[-1][1])
    return SelectionResult(best, trials)
