"""N-gram Jaccard join by a blocked sparse matrix product.

The matrix has a row per distinct shingle set (a class of documents with
equal sets) and a column per shingle; overlaps are the entries of its
product with its transpose.  Only entries that can reach the threshold are
ever made:

1. ``shingle_sets``: a document's set is named by a digest; documents with
   one digest are one class.
2. Column blocks (ranges of the shingle hash) count in how many classes each
   shingle occurs.  A shingle of one class adds to no overlap and is dropped;
   a class keeps (block by block) its shared shingles only.
3. Size bound: a class whose shared shingles are fewer than the least
   overlap that its size allows can link with nothing and is dropped.
4. Of a class with ``m`` shared shingles and least overlap ``t``, only the
   ``m - t + 1`` rarest are candidates' columns: two linked classes share one
   of these at least.  In each column every class meets one representative,
   the least edited one; the pair's overlap is accumulated over all shared
   shingles and compared exactly.
5. Links make components.  Where a column still holds several components,
   further representatives are tried, and in the end every pair of classes
   of different components in one column is compared, so no link is lost
   while a group of near copies costs about a pair for each copy.

Null text and text without words have an empty set and link with nothing.
Repeated rows are one class.  An empty table gives an empty table.  Only the
named columns are read; a null id belongs to its class but names nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.minimizers import buckets
from candlewick.llm.words import U64, lean, mix, rolling, slices, windows, words_of
from candlewick.session import save

SHINGLE, PERCENT = 5, 75
#: Shingles of one column block, about, and the least number of blocks.
BLOCK, MIN_BLOCKS = 3_000_000, 48
#: Bytes of a shingle's hash within its block.
ID_BYTES = 6
#: Sets that a map task remembers as sent.
SENT = 200_000
#: Representatives tried in a column before all its remaining pairs are compared, at most.
ROUNDS = 4


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Least overlap of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def sets_of(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first, digest): distinct shingle hashes of each text, sorted,
    as slices ``first[i]:first[i + 1]``; the digest names the set."""
    words = words_of(texts, lower=True)
    counts = words.counts
    at = windows(words, size)
    text = np.searchsorted(words.first, at, "right") - 1
    hashes = rolling(words.hash, size)[at] if len(at) else np.zeros(0, U64)
    few = np.flatnonzero((counts > 0) & (counts < size))
    whole = [mix(rolling(words.hash[words.first[i]:words.first[i + 1]], int(counts[i])) + U64(1)) for i in few]
    text = np.concatenate([text, few]).astype(np.int64)
    hashes = np.concatenate([hashes, *whole]).astype(U64)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    first = np.searchsorted(text, np.arange(len(counts) + 1))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(hashes), dtype=U64)))
    n = np.diff(first)
    return hashes, first, mix(sums[first[1:]] - sums[first[:-1]] + n.astype(U64) * U64(0x9E3779B97F4A7C15))


def shingle_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _c, _n): class and set size of each document."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                _, first, digest = sets_of(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digest.view(np.int64)), pa.array(np.diff(first))],
                                                 ["_key", "_c", "_n"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(lean(count), f"_key {kind}, _c long, _n long")


def _packed(values: np.ndarray, ends: np.ndarray, width: int) -> pa.Array:
    """Binary column of the low ``width`` bytes of consecutive values."""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(raw)])


def _unpacked(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and row ends of a binary column of ``width``-byte values."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0]:offsets[-1]].reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return wide.view("<u8").reshape(-1), (offsets - offsets[0]) // width


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(table.schema.get_field_index(name))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column


def shared_sets(docs: DataFrame, text: str, total: int) -> DataFrame:
    """(_c, _n, _ids, _df): shared shingles of each class that passes the size
    bound; ``_ids`` packed 8-byte names, ``_df`` their log2 frequencies."""
    blocks = max(MIN_BLOCKS, -(-total // BLOCK))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "_text"):
                hashes, first, digest = sets_of(part.column(0))
                n = np.diff(first)
                rows = [i for i in np.unique(digest, return_index=True)[1].tolist() if n[i] and int(digest[i]) not in sent]
                if len(sent) < SENT:
                    sent.update(digest[rows].tolist())
                chosen = np.zeros(len(n), bool)
                chosen[rows] = True
                row = np.repeat(np.arange(len(n)), n)
                h, row = hashes[chosen[row]], row[chosen[row]]
                # hashes of a text are sorted, and so are their blocks
                block = ((h >> U64(32)) * U64(blocks) >> U64(32)).astype(np.int32)
                cut = _starts(row, block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[cut]), pa.array(digest[row[cut]].view(np.int64)), pa.array(n[row[cut]].astype(np.int32)),
                     _packed(h, np.append(cut, len(h)), ID_BYTES)], ["_b", "_c", "_n", "_h"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            b, c = _column(table, "_b").to_numpy(), _column(table, "_c").to_numpy()
            table = table.filter(pa.array(np.concatenate(([True], c[1:] != c[:-1]))))     # a class that several tasks have sent
            low, ends = _unpacked(_column(table, "_h"), ID_BYTES)
            order = np.argsort(low, kind="stable")
            k = low[order]
            start = _starts(k)
            size = np.diff(np.append(start, len(k)))
            weight = np.zeros(len(low), np.uint8)       # 1 + log2 of the shingle's classes, 0 for a single one
            weight[order] = np.repeat(np.where(size > 1, 1 + np.log2(np.maximum(size, 1)), 0).astype(np.uint8), size)
            hit = np.flatnonzero(weight)
            row = np.repeat(np.arange(table.num_rows, dtype=np.int32), np.diff(ends))[hit]
            cut = _starts(row)
            of = pa.array(row[cut])
            yield pa.RecordBatch.from_arrays(
                [*(_column(table, x).take(of) for x in ("_c", "_n")), pa.array(np.full(len(cut), b[0], np.int32)),
                 _packed(low[hit] | (weight[hit].astype(U64) << U64(8 * ID_BYTES)), np.append(cut, len(hit)), ID_BYTES + 1)],
                ["_c", "_n", "_b", "_h"])

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in buckets(batches, 20_000):
            c, n, b = (_column(table, x).to_numpy() for x in ("_c", "_n", "_b"))
            v, ends = _unpacked(_column(table, "_h"), ID_BYTES + 1)
            first = _starts(c)                          # rows of one class follow each other
            edge = np.append(ends[first], len(v))
            n = n[first]
            fits = np.diff(edge) >= -(-PERCENT * n.astype(np.int64) // 100)
            block = np.repeat(mix(b.astype(U64)), np.diff(ends))
            of = np.repeat(np.arange(len(first)), np.diff(edge))
            keep = fits[of]
            ids = mix((v & U64((1 << 8 * ID_BYTES) - 1)) ^ block)[keep]
            weight, of = (v >> U64(8 * ID_BYTES))[keep], of[keep]
            order = np.lexsort((ids, of))
            ids, weight = ids[order], weight[order]
            ends = np.concatenate(([0], np.cumsum(np.diff(edge)[fits])))
            yield pa.RecordBatch.from_arrays([pa.array(c[first][fits]), pa.array(n[fits]), _packed(ids, ends, 8), _packed(weight, ends, 1)],
                                             ["_c", "_n", "_ids", "_df"])

    rows = docs.select(F.col(text).alias("_text")).mapInArrow(lean(spread), "_b int, _c long, _n int, _h binary")
    counted = rows.repartition("_b").sortWithinPartitions("_b", "_c").mapInArrow(lean(count), "_c long, _n int, _b int, _h binary")
    return counted.repartition("_c").sortWithinPartitions("_c").mapInArrow(lean(gather), "_c long, _n int, _ids binary, _df binary")


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One whole column block at a time, of rows sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            b = batch.column(0).to_numpy()
            if held and held[0].column(0)[0].as_py() != b[at]:
                yield pa.Table.from_batches(held)
                held = []
            end = int(np.searchsorted(b, b[at], "right"))
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield pa.Table.from_batches(held)


def candidate_columns(sets: DataFrame) -> DataFrame:
    """(_id, _c, _n, _u, _r): the rarest ``m - t + 1`` shared shingles of each
    class; ``_u``: how many of its shingles no other class has; ``_r``: how
    many shared ones follow in the order of rarity, this one included."""
    def rarest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, n, ids, df in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids = np.frombuffer(ids, "<u8")
                keep = len(ids) - least_overlap(n) + 1
                chosen = ids[np.lexsort((ids, np.frombuffer(df, np.uint8)))[:keep]]
                size = len(chosen)
                yield pa.RecordBatch.from_arrays([pa.array(chosen.view(np.int64)), pa.array(np.full(size, c, np.int64)),
                                                  pa.array(np.full(size, n, np.int32)), pa.array(np.full(size, n - len(ids), np.int32)),
                                                  pa.array((len(ids) - np.arange(size)).astype(np.int32))],
                                                 ["_id", "_c", "_n", "_u", "_r"])

    return sets.select("_c", "_n", "_ids", "_df").mapInArrow(lean(rarest), "_id long, _c long, _n int, _u int, _r int")


def _can_link(na: str, ra: str, nb: str, rb: str, percent: int = PERCENT) -> Column:
    """Whether two classes that meet in a column can link, if it is the first
    they share: what follows in either order bounds their overlap, and the
    sizes say how large it must be.  (In a later shared column the answer
    does not matter, as the first one has seen the pair.)"""
    most = F.least(ra, rb)
    return F.lit(100) * most >= F.lit(percent) * (F.col(na) + F.col(nb) - most)


def compare(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(_a, _b) of the pairs that link: overlaps over all shared shingles."""
    side = lambda x: sets.select(F.col("_c").alias(f"_{x}"), F.col("_n").alias(f"_n{x}"), F.col("_ids").alias(f"_i{x}"))
    joined = pairs.select("_a", "_b").join(side("a"), "_a").join(side("b"), "_b")

    def overlap(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            na, nb, ia, ib = get("_na").to_numpy(), get("_nb").to_numpy(), get("_ia"), get("_ib")
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(ia[i].as_buffer(), "<u8"), np.frombuffer(ib[i].as_buffer(), "<u8")
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                linked[i] = 100 * common >= percent * (int(na[i]) + int(nb[i]) - common)
            yield pa.RecordBatch.from_arrays([get("_a"), get("_b")], ["_a", "_b"]).filter(pa.array(linked))

    return joined.select("_a", "_b", "_na", "_nb", "_ia", "_ib").mapInArrow(lean(overlap), "_a long, _b long")


def class_links(sets: DataFrame) -> DataFrame | None:
    """(node, component) of all classes that link, smallest class number first."""
    columns = save(candidate_columns(sets), "jaccard-columns").df
    # a class that could not even link with the column's smallest class leaves the column; at first
    # all others meet the least edited one
    heads = columns.groupBy("_id").agg(F.min("_n").alias("_lo"), F.count(F.lit(1)).alias("_k"),
                                       F.min(F.struct("_u", "_c", "_n", "_r")).alias("h")).where("_k > 1")
    met = columns.join(heads, "_id").where(_can_link("_n", "_r", "_lo", "_r"))
    columns = save(met.drop("_lo", "_k"), "jaccard-open").df
    pairs = (columns.where((F.col("_c") != F.col("h._c")) & _can_link("_n", "_r", "h._n", "h._r"))
             .select(F.col("h._c").alias("_a"), F.col("_c").alias("_b")))
    columns = columns.drop("h")
    links, found = None, None
    for turn in range(1, ROUNDS + 1):
        new = save(compare(save(pairs.distinct(), "jaccard-pairs").df, sets), "jaccard-links").df
        grown = not new.isEmpty()
        if grown:
            # what has been found already goes in as its components, not as all its links
            links = new if found is None else new.unionByName(found.select(F.col("component").alias("_a"), F.col("node").alias("_b")))
            found = components(links, "_a", "_b").df
        if found is None:
            held = columns.withColumn("_g", F.col("_c"))
        else:
            held = columns.drop("_g").join(found.withColumnRenamed("node", "_c"), "_c", "left").withColumn("_g", F.coalesce("component", "_c"))
            held = held.drop("component")
        # columns that hold one component only are done
        groups = held.groupBy("_id", "_g").agg(
            F.count(F.lit(1)).alias("_k"), F.min(F.struct(F.xxhash64("_c", F.lit(turn)), "_c", "_n", "_r")).alias("_p"))
        heads = groups.groupBy("_id").agg(
            F.min_by(F.struct("_p._c", "_p._n", "_p._r", "_g"), F.struct(-F.col("_k"), "_p")).alias("h"), F.count(F.lit(1)).alias("_m"),
            F.sum("_k").alias("_s"), F.sum(F.col("_k") * F.col("_k")).alias("_q")).where("_m > 1")
        columns = save(held.join(heads.drop("_m"), "_id"), "jaccard-open").df
        left, rows = columns.agg(F.sum((F.col("_s") * F.col("_s") - F.col("_q")) / (2 * F.col("_s"))), F.count(F.lit(1))).first()
        if not rows:
            break
        if turn == ROUNDS or not grown or left <= 4 * rows:
            # all that is left: classes of different components in one column
            a, b = (columns.select("_id", *[F.col(c).alias(f"{c}{s}") for c in ("_c", "_n", "_r", "_g")]) for s in "ab")
            pairs = (a.join(b, "_id").where((F.col("_ca") < F.col("_cb")) & (F.col("_ga") != F.col("_gb")) & _can_link("_na", "_ra", "_nb", "_rb"))
                     .select(F.col("_ca").alias("_a"), F.col("_cb").alias("_b")))
            new = save(compare(save(pairs.distinct(), "jaccard-pairs").df, sets), "jaccard-links").df
            if not new.isEmpty():
                links = new if found is None else new.unionByName(found.select(F.col("component").alias("_a"), F.col("node").alias("_b")))
                found = components(links, "_a", "_b").df
            break
        pairs = (columns.where((F.col("_g") != F.col("h._g")) & _can_link("_n", "_r", "h._n", "h._r"))
                 .select(F.col("h._c").alias("_a"), F.col("_c").alias("_b")))
        columns = columns.drop("h", "_s", "_q")
    return found


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, class_id, component_id): ``class_id`` is the smallest
    id with the same set, ``component_id`` the smallest id reachable by links."""
    named = save(shingle_sets(docs, key, text), "jaccard-sets").df
    total = named.agg(F.sum("_n")).first()[0] or 0
    sets = save(shared_sets(docs, text, total), "jaccard-shared").df
    found = class_links(sets)
    classes = named.groupBy("_c").agg(F.min("_key").alias("_least"))
    if found is None:
        classes = classes.withColumn("_root", F.col("_least"))
    else:
        grouped = classes.join(found.withColumnRenamed("node", "_c"), "_c", "left")
        grouped = save(grouped.withColumn("_g", F.coalesce("component", "_c")).drop("component"), "jaccard-classes").df
        classes = grouped.join(grouped.groupBy("_g").agg(F.min("_least").alias("_root")), "_g").drop("_g")
    out = named.join(classes, "_c", "left")
    empty = F.col("_n") == 0
    return out.select(F.col("_key").alias(key), F.col("_n").alias("n_shingles"),
                      F.when(empty, F.col("_key")).otherwise(F.col("_least")).alias("class_id"),
                      F.when(empty, F.col("_key")).otherwise(F.col("_root")).alias("component_id"))
