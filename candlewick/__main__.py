"""Command line: ``python -m candlewick train|score ...``.

A thin front over the library for spark-submit jobs; every option maps to a
function argument (see README.md "Usage").
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    if args.local:
        from candlewick.session import local_session

        return local_session(args.local)
    return SparkSession.builder.appName("candlewick").getOrCreate()


def _train(args) -> int:
    import candlewick as cw

    spark = _session(args)
    bars = cw.load_bars(spark, args.bars, fmt=args.format,
                        universe=[u for u in (args.universe or "").split(",") if u])
    res = cw.train_pipeline(bars, family=args.family, horizon=args.horizon, n_splits=args.n_splits,
                            alpha=args.alpha, run=args.run, cv_for_deep_models=args.cv_for_deep_models,
                            by=args.split_by, model_path=args.model_path, metrics_path=args.metrics_path,
                            price_col=args.price_col, segment=args.segment,
                            family_params={k: v for k in ("seq_len", "epochs", "rate", "num_samples", "quantile", "min_context", "budget_rows")
                                           if (v := getattr(args, k)) is not None})
    summary = {"family": res.family, "rows": res.n_rows, "features": len(res.feature_cols), **res.params}
    print(json.dumps(summary))
    return 0


def _score(args) -> int:
    import candlewick as cw
    from candlewick.streaming.scoring_stream import write_outcomes

    spark = _session(args)
    model, loaded_at = cw.read_model(args.model), time.time()
    if args.stream:
        q = cw.start_scoring_stream(spark, args.requests, args.out, args.checkpoint, model,
                                    allow_minimal=args.allow_minimal, available_now=args.available_now,
                                    model_uri=args.model, loaded_at=loaded_at)
        q.awaitTermination()
        return 0
    res = cw.score_requests(cw.read_requests(spark, args.requests, args.multi_line), model, allow_minimal=args.allow_minimal,
                            row=args.row, model_uri=args.model, loaded_at=loaded_at)
    write_outcomes(res, args.out)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="candlewick", description="Return forecasting on Spark.")
    p.add_argument("--local", default=None, help="run on local[N] (tests, laptops); default: the submitted cluster")
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train", help="features -> walk-forward CV -> holdout fit -> model + metrics")
    t.add_argument("--bars", required=True)
    t.add_argument("--format", default="parquet")
    t.add_argument("--universe", default="", help="comma-separated symbols; empty keeps all")
    t.add_argument("--family", required=True,
                   choices=["ridge", "automl", "flaml", "custom_transformer", "transformer", "hf_finetune", "hf"])
    t.add_argument("--horizon", type=int, default=1)
    t.add_argument("--n-splits", type=int, default=5)
    t.add_argument("--alpha", type=float, default=1.0)
    t.add_argument("--split-by", choices=["position", "date"], default="position")
    t.add_argument("--cv-for-deep-models", action="store_true")
    t.add_argument("--price-col", default="adj_close")
    t.add_argument("--segment", default="year", help="longest piece of a series: year ... day, hour, minute, none")
    t.add_argument("--seq-len", type=int, help="custom_transformer")
    t.add_argument("--epochs", type=int, help="custom_transformer")
    t.add_argument("--rate", type=float, help="custom_transformer")
    t.add_argument("--num-samples", type=int, help="hf_finetune")
    t.add_argument("--budget-rows", type=int, help="automl: successive halving within so many training rows")
    t.add_argument("--quantile", type=float, help="hf_finetune")
    t.add_argument("--min-context", type=int, help="hf_finetune")
    t.add_argument("--run", default="run")
    t.add_argument("--model-path")
    t.add_argument("--metrics-path")
    t.set_defaults(fn=_train)

    s = sub.add_parser("score", help="score request records (batch or stream)")
    s.add_argument("--requests", required=True, help="folder of JSON request records")
    s.add_argument("--model", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--multi-line", action="store_true", help="a file is one pretty-printed request or an array")
    s.add_argument("--allow-minimal", action="store_true")
    s.add_argument("--row", choices=["last", "first"], default="last")
    s.add_argument("--stream", action="store_true")
    s.add_argument("--checkpoint", help="stream checkpoint folder (with --stream)")
    s.add_argument("--available-now", action="store_true", help="stream: process what is there, then stop")
    s.set_defaults(fn=_score)

    args = p.parse_args(argv)
    if getattr(args, "stream", False) and not args.checkpoint:
        p.error("--stream needs --checkpoint")
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
