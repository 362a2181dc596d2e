"""Approximate nearest neighbours by largest inner product.

* Equal vectors become one node with the ``k + 1`` smallest of their ids: a
  larger id can be in no answer, as ties go to the smaller id and only the
  query's own id is left out.  The limit runs before the shuffle, so a
  common vector costs a few rows a task.
* Nodes are dealt by hash to shards of about ``SHARD`` nodes; each shard is
  a robust-pruned graph (``graph.py``), written once.  Inner product becomes
  distance by one more coordinate that gives all of a shard's vectors the
  same norm.
* Queries travel in blocks to every shard, each is answered there by beam
  search, and the best ``k`` over all shards remain.  Scores are inner
  products of the original vectors in double precision.

Vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do those whose dimension is not the most common one (ties:
the smaller).  A null id takes no part.  Repeated (id, vector) rows count
once.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import graph
from candlewick.llm.words import lean
from candlewick.session import save

SHARD = 4096
BLOCK = 512


def usable(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """(_id, _v) of the rows that take part."""
    v = F.col("_v")
    df = vectors.select(F.col(key).cast("long").alias("_id"), F.col(vec).cast("array<double>").alias("_v"))
    df = df.where(F.col("_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                  & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                  & F.exists(v, lambda x: x != 0))
    dim = df.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return df.where(F.size("_v") == (dim["d"] if dim else 0)).distinct()


def build_index(rows: DataFrame, k: int) -> DataFrame:
    """One row per shard: _shard, _ids (list of id lists), _x (float64 matrix),
    _edges (int32), _start."""
    smallest = F.row_number().over(Window.partitionBy("_v").orderBy("_id")) <= k + 1
    few = rows.withColumn("_in", smallest).where("_in")
    nodes = save(few.groupBy("_v").agg(F.sort_array(F.collect_list("_id")).alias("_ids")), "ann-nodes").df
    shards = max(1, -(-nodes.count() // SHARD))

    def make(group: pa.Table) -> pa.Table:
        ids = group.column("_ids").to_pylist()
        x = matrix(group.column("_v"))
        order = sorted(range(len(ids)), key=lambda i: ids[i][0])     # the same graph whatever order rows come in
        ids, x = [ids[i] for i in order], x[order]
        edges, start = graph.build(flat(x))
        return pa.table({"_shard": group.column("_shard")[:1], "_ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
                         "_x": [x.tobytes()], "_edges": [edges.astype("<i4").tobytes()], "_start": pa.array([start], pa.int32())})

    dealt = nodes.withColumn("_shard", F.pmod(F.xxhash64("_v"), F.lit(shards)).cast("int"))
    # shards are few and small but slow: a number of partitions of their own, which is not coalesced by size
    index = dealt.repartition(2 * shards, "_shard").groupBy("_shard").applyInArrow(
        make, "_shard int, _ids array<array<long>>, _x binary, _edges binary, _start int")
    return save(index, "ann-index").df


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def flat(x: np.ndarray) -> np.ndarray:
    """The vectors with one more coordinate that makes their norms equal."""
    square = (x ** 2).sum(1)
    return np.column_stack([x, np.sqrt(np.maximum(square.max() - square, 0))]).astype(np.float32)


def search_index(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows (_id, _v) of ``queries``."""
    n = queries.count()
    shards = 1 + (index.agg(F.max("_shard")).first()[0] or 0)

    def block(group: pa.Table) -> pa.Table:
        return pa.table({"_block": group.column("_block")[:1], "_q": pa.array([group.column("_id").to_pylist()], pa.list_(pa.int64())),
                         "_qx": [matrix(group.column("_v")).tobytes()]})

    blocks = queries.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(max(1, -(-n // BLOCK)))).cast("int"))
    blocks = blocks.groupBy("_block").applyInArrow(block, "_block int, _q array<long>, _qx binary")
    # every block of queries to every shard, by number
    sent = blocks.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def answer(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c: batch.column(batch.schema.get_field_index(c))[row]
                ids, q = get("_ids").as_py(), get("_q").as_py()
                x = np.frombuffer(get("_x").as_buffer(), np.float64).reshape(len(ids), -1)
                edges = np.frombuffer(get("_edges").as_buffer(), "<i4").reshape(len(ids), -1)
                qx = np.frombuffer(get("_qx").as_buffer(), np.float64).reshape(len(q), -1)
                found = graph.search(flat(x), edges, get("_start").as_py(),
                                     np.column_stack([qx, np.zeros(len(q))]).astype(np.float32), max(graph.SEARCH_BEAM, 2 * k))
                out: list[tuple[int, int, float]] = []
                for i, own in enumerate(q):
                    near = found[i][found[i] >= 0]
                    score = x[near] @ qx[i]
                    best = sorted((-s, v) for s, j in zip(score.tolist(), near.tolist(), strict=True)
                                  for v in ids[j] if v != own)[:k]
                    out += [(own, v, -s) for s, v in best]
                a, b, c = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())],
                                                 ["query_id", "vec_id", "score"])

    wide = 2 * shards
    found = sent.repartition(wide, "_shard").join(index.repartition(wide, "_shard"), "_shard").mapInArrow(lean(answer), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The ``k`` nearest other rows of each row for which ``is_query`` (of ``key``) holds."""
    rows = usable(vectors, key, vec)
    queries = rows.join(vectors.where(is_query).select(F.col(key).cast("long").alias("_id")).distinct(), "_id", "left_semi")
    return search_index(build_index(rows, k), queries, k)
