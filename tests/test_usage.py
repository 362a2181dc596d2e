"""The README usage example, end to end, on files written by the test."""

import candlewick as cw
from candlewick.sources.bars import bars_from_orders
from candlewick.sources.requests import requests_from_bars


def test_readme_usage(spark, tmp_path):
    bars_path, model_path, req_path = str(tmp_path / "bars"), str(tmp_path / "model"), str(tmp_path / "req")
    bars_from_orders(spark, "/root/testdata/sf0.01").write.parquet(bars_path)
    requests_from_bars(bars_from_orders(spark, "/root/testdata/sf0.01")).write.json(req_path)

    # --- README: train ---
    bars = cw.load_bars(spark, bars_path, universe=["1-URGENT", "2-HIGH", "3-MEDIUM"])
    result = cw.train_pipeline(bars, family="ridge", horizon=1, n_splits=5, model_path=model_path,
                               metrics_path=str(tmp_path / "metrics"))
    # --- README: score a request table ---
    model = cw.read_model(model_path)
    scored = cw.score_requests(cw.read_requests(spark, req_path), model, allow_minimal=True)
    # --- README: score a stream of request files ---
    s_scored, s_rejected = cw.score_stream(spark, req_path, str(tmp_path / "out"), str(tmp_path / "ck"), model,
                                           allow_minimal=True)

    assert result.params["universe_size"] == 3 and result.metrics.count() > 0
    assert scored.scored.count() == s_scored.count() > 0
    assert scored.rejected.count() == s_rejected.count()


def test_command_line(spark, tmp_path, capsys):
    import json

    from candlewick.__main__ import main

    bars_path, req_path = str(tmp_path / "bars"), str(tmp_path / "req")
    bars_from_orders(spark, "/root/testdata/sf0.01").write.parquet(bars_path)
    requests_from_bars(bars_from_orders(spark, "/root/testdata/sf0.01")).write.json(req_path)
    assert main(["train", "--bars", bars_path, "--family", "ridge", "--n-splits", "3",
                 "--model-path", str(tmp_path / "m"), "--metrics-path", str(tmp_path / "metrics")]) == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["family"] == "ridge" and summary["features"] == 36
    assert main(["score", "--requests", req_path, "--model", str(tmp_path / "m"), "--out", str(tmp_path / "o"),
                 "--allow-minimal"]) == 0
    assert main(["score", "--requests", req_path, "--model", str(tmp_path / "m"), "--out", str(tmp_path / "so"),
                 "--allow-minimal", "--stream", "--available-now", "--checkpoint", str(tmp_path / "ck")]) == 0
    batch = spark.read.parquet(str(tmp_path / "o")).where("kind = 'scored'").count()
    stream = spark.read.parquet(str(tmp_path / "so")).where("kind = 'scored'").count()
    assert batch == stream > 0


def test_bench_prints_one_json_line():
    """bench.py stays runnable and keeps its one-line JSON contract."""
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["value"] > 0 and "train_pipeline_lineitem" in d["queries"]
