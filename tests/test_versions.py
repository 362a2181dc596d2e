"""Models are replaced as a whole: a write that ends half-way changes nothing for readers."""

import os

import pytest
from pyspark.sql import DataFrameWriter

from candlewick.operators import models as M
from candlewick.sources import versions as V


def linear(spark, slope):
    df = spark.createDataFrame([(float(x), slope * x) for x in range(20)], "x double, target double")
    return df, M.ridge_fit(df, ["x"], alpha=0.0)


def slope_at(df, path):
    return round(M.read_model(path).transform(df, keep=["x"]).where("x = 10").first()["prediction"], 6)


@pytest.mark.parametrize("step", ["pipeline", "sidecar", "commit"])
def test_a_write_that_ends_half_way(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "m")
    df, first = linear(spark, 2.0)
    _, second = linear(spark, 3.0)
    M.write_model(first, path)

    def lost(*args, **kwargs):
        raise RuntimeError("writer lost")

    with monkeypatch.context() as m:
        if step == "pipeline":
            m.setattr(type(second.model), "write", lost)
        elif step == "sidecar":
            m.setattr(DataFrameWriter, "text", lost)
        else:
            m.setattr(M, "commit_version", lost)
        with pytest.raises(RuntimeError, match="writer lost"):
            M.write_model(second, path)
    assert slope_at(df, path) == 20.0
    M.write_model(second, path)
    assert slope_at(df, path) == 30.0


def test_no_committed_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        M.read_model(str(tmp_path / "none"))


def test_versions_in_order_and_old_ones_deleted(spark, tmp_path):
    path = str(tmp_path / "v")
    assert V.current_version(spark, path) is None
    folders = []
    for i in range(12):
        folders.append(V.new_version(spark, path))
        os.makedirs(folders[-1])
        V.commit_version(spark, folders[-1])
        assert V.current_version(spark, path) == folders[-1]
    left = sorted(n for n in os.listdir(path) if n.startswith(V.VERSION))
    assert left == [f.rsplit("/", 1)[1] for f in folders[-V.KEPT:]]
    with pytest.raises(RuntimeError):
        V.commit_version(spark, folders[-1])


def test_two_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "w")
    a, b = V.new_version(spark, path), V.new_version(spark, path)
    for f in (b, a):
        os.makedirs(f)
        V.commit_version(spark, f)
    assert V.current_version(spark, path) == max(a, b)
