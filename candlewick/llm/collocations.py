"""Phrase collocation mining over sorted count streams.

1. ``phrase_counts``: a map task sorts the phrases of ``max_words`` words (at
   the end of a piece, of a word less) of some MB of text at a time, word
   numbers packed in one integer each, and sends their counts.  Spark
   range-partitions and sorts these by first words, language and last word;
   one walk through a partition sums equal phrases, and the counts of their
   first words from the same rows.  Shorter phrases than that are sent as
   they are.  What a partition's edge may cut is summed afterwards.  Phrases
   found ``least`` times or more are written: with a phrase all its parts are
   found as often, so nothing that is needed later is missing.
2. The counts are laid out twice: in prefix order (first word first) and in
   suffix order (last word first), range-partitioned and sorted in pieces.
   Where a piece starts inside a group, it also gets the counts of the
   shorter phrases that its first row begins with (a few rows a piece).
3. ``merge_stream`` walks a piece in lockstep with those shorter phrases:
   in prefix order every phrase meets the counts of its first words, in
   suffix order those of its last words, and every shorter phrase the largest
   count of its extensions by one word.  No row is looked up by a hash.
4. Both streams' findings of a phrase come together; scores are exact.

Null text counts as empty, a null language as ``und``.  Equal rows count each
for itself.  Empty tables give empty tables.  Very long texts are counted a
slice of words at a time, phrases across slices included.  Only the two named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.words import buffers, lean, slices
from candlewick.session import save

#: Bytes of text whose phrases are sorted together.
SORTED_BYTES = 4 << 20
#: Words that are numbered together; the numbers of a phrase share 63 bits.
SORTED_WORDS = 1 << 19
#: Partitions of a language's best phrases before they are ranked as one.
RANKED = 64
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, 0x09]] = True


# ---- counting ----------------------------------------------------------------

def words_in_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, start, end, text, piece) of the words: byte offsets in the
    lower-cased data, number of the text and of the piece."""
    data, offsets = buffers(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    breaks = _BREAKS[data]
    solid = ~(breaks | _BLANKS[data])
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    begins[inner] = solid[inner]         # a text ends a word
    ends[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    piece = np.cumsum(breaks, dtype=np.int32)[start].astype(np.int64) if len(start) else start
    return data, start, end, text, piece


def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and the number of each word among them."""
    size = end - start
    ends = np.concatenate(([0], np.cumsum(size)))
    raw = data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)]
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw.tobytes())])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _counted(langs: np.ndarray, texts: pa.Array, max_words: int) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]]:
    """(language, head, tail, count) of one slice of texts, ``langs`` being
    numbers: phrases of ``max_words`` words, of which the last is the tail;
    where a piece ends, phrases of a word less; and all that are shorter still."""
    data, start, end, text, piece = words_in_pieces(texts)
    # a step cuts the words where it must; phrases that begin in it may end behind it
    bits = 63 // max_words
    step = max(1, min(SORTED_WORDS, (1 << bits) - max_words))
    for at in range(0, len(start), step):
        upto = min(len(start), at + step + max_words - 1)
        own = min(len(start), at + step) - at
        words, number = _distinct(data, start[at:upto], end[at:upto])
        t, p = text[at:upto], piece[at:upto]
        # words of different languages get numbers of their own
        known, number = np.unique(langs[t] * len(words) + number, return_inverse=True)
        lang, word = np.divmod(known, len(words))
        key, go = number.astype(np.int64), np.ones(len(number), bool)
        for n in range(1, max_words + 1):
            if n > 1:
                go = go[:-1] & (t[n - 1:] == t[:len(t) - n + 1]) & (p[n - 1:] == p[:len(p) - n + 1])
                key = key[:-1] << bits | number[n - 1:]
            send = go[:own]
            if n == max_words - 1:      # the others are the first words of longer ones
                longer = np.zeros(len(send), bool)
                more = go[:-1] & (t[n:] == t[:len(t) - n]) & (p[n:] == p[:len(p) - n])
                longer[:min(len(more), len(send))] = more[:len(send)]
                send = send & ~longer
            kept = np.sort(key[:own][send])
            first = np.flatnonzero(np.diff(kept, prepend=-1))
            of = [kept[first] >> bits * (n - 1 - i) & ((1 << bits) - 1) for i in range(n)]
            parts = [words.take(pa.array(word[x])) for x in of]
            head = parts[:max_words - 1]
            head = head[0] if len(head) == 1 else pc.binary_join_element_wise(*head, pa.scalar(b" ", pa.large_binary()))
            yield (lang[of[0]], head, parts[-1] if n == max_words else pa.nulls(len(first), pa.large_binary()),
                   np.diff(np.append(first, len(kept))))


def _same(column: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before; null equals null."""
    a, b = column[1:], column[:-1]
    equal = pc.fill_null(pc.equal(a, b), False)
    if column.null_count:
        equal = pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b)))
    return equal.to_numpy(zero_copy_only=False)


def sum_stream(batches: Iterable[pa.RecordBatch], max_words: int, least: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (_lang, _head, _tail, _c) of one partition to (_lang,
    _phrase, _words, _c): sums of phrases and of heads that reach ``least``.
    Rarer single words come as one sum without a phrase for each language.
    The first and the last head of the partition are told whatever their sum
    is, as neighbours may hold more of them."""
    fields = ["_lang", "_head", "_tail", "_c"]
    held, before, first_head = None, 0, True

    def told(lang, phrase, words, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(words, pa.int32()), pa.array(c, pa.int64())],
                                          ["_lang", "_phrase", "_words", "_c"])

    for batch in chain(batches, [None]):
        rows = [x for x in (held, batch) if x is not None and x.num_rows]
        if not rows:
            continue
        table = pa.Table.from_batches(rows).combine_chunks()
        lang, head, tail = (table.column(x).combine_chunks() for x in fields[:3])
        c = table.column("_c").to_numpy()
        same_head = _same(lang) & _same(head)
        key = np.flatnonzero(np.concatenate(([True], ~(same_head & _same(tail)))))
        heads = np.flatnonzero(np.concatenate(([True], ~same_head)))
        sums, head_sums = np.add.reduceat(c, key), np.add.reduceat(c, heads)
        head_sums[0] += before
        if batch is not None:       # the last phrase and head may go on
            keep = key[-1]
            held = pa.RecordBatch.from_arrays([lang[keep:keep + 1], head[keep:keep + 1], tail[keep:keep + 1], pa.array(sums[-1:], pa.int64())], fields)
            before = int(head_sums[-1] - sums[-1])
            key, sums, heads, head_sums = key[:-1], sums[:-1], heads[:-1], head_sums[:-1]
        own = pa.array(key[(sums >= least) & ~pc.is_null(tail).to_numpy(zero_copy_only=False)[key]])
        yield told(lang.take(own), pc.binary_join_element_wise(head.take(own), tail.take(own), " "), np.full(len(own), max_words),
                   sums[(sums >= least) & ~pc.is_null(tail).to_numpy(zero_copy_only=False)[key]])
        words = pc.count_substring(head.take(pa.array(heads)), " ").to_numpy() + 1
        often = head_sums >= least
        if len(heads):
            often[0] |= first_head
            first_head = False
            often[-1] |= batch is None
        own = pa.array(heads[often])
        yield told(lang.take(own), head.take(own), words[often], head_sums[often])
        rare = ~often & (words == 1)
        if rare.any():
            at = heads[rare]
            of = lang.take(pa.array(at)).dictionary_encode()
            sums_of = np.zeros(len(of.dictionary), np.int64)
            np.add.at(sums_of, of.indices.to_numpy(), head_sums[rare])
            yield told(of.dictionary, pa.nulls(len(sums_of), pa.string()), np.ones(len(sums_of)), sums_of)
        if batch is None:
            held, before = None, 0


def phrase_counts(docs: DataFrame, text: str, lang: str, max_words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(_lang, _phrase, _words, _c) of the phrases found ``least`` times or
    more, and (_lang, _n): all words of each language."""
    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_text = lambda x: x.cast(pa.binary()).cast(pa.string())
        for batch in batches:
            for part in slices(batch, "_text", SORTED_BYTES):
                names = part.column(1).dictionary_encode()
                for of, head, tail, count in _counted(names.indices.to_numpy().astype(np.int64), part.column(0), max_words):
                    yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(of)), as_text(head), as_text(tail), pa.array(count, pa.int64())],
                                                     ["_lang", "_head", "_tail", "_c"])

    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), F.coalesce(F.col(lang), F.lit("und")).alias("_lang"))
    sent = rows.mapInArrow(lean(body), "_lang string, _head string, _tail string, _c long")
    order = ["_head", "_lang", "_tail"]         # heads first: most comparisons end at their first bytes
    summed = (sent.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(lean(lambda b: sum_stream(b, max_words, least)), "_lang string, _phrase string, _words int, _c long"))
    # partitions' edges and the rare words' sums come together
    counts = save(summed.groupBy("_lang", "_phrase", "_words").agg(F.sum("_c").alias("_c")), "phrase-counts").df
    n = counts.where("_words = 1").groupBy("_lang").agg(F.sum("_c").alias("_n"))
    return counts.where((F.col("_c") >= least) & F.col("_phrase").isNotNull()), n


# ---- streams -------------------------------------------------------------------

def merge_stream(batches: Iterable[pa.RecordBatch], max_words: int) -> Iterator[pa.RecordBatch]:
    """Rows (_lang, _phrase, _words, _c, _own) of sorted pieces, shorter
    phrases before the longer ones that begin with them, to (_lang, _phrase,
    _words, _c, _shorter, _longer): the counts of the shorter ones, shortest
    first, and the largest count of one that is a word longer.  Rows not
    ``_own`` are copies of what a piece's first row begins with: of them only
    the largest count is told.  Between batches only the rows that the last
    row begins with are held, ``max_words`` at most."""
    held, held_longer = None, np.zeros(0, np.int64)
    for batch in chain(batches, [None]):         # at the end all that is held goes
        old = 0 if held is None else held.num_rows
        table = pa.Table.from_batches([x for x in (held, batch) if x is not None and x.num_rows]) if old or batch else None
        if not table:
            continue
        words, c, own = (table.column(x).to_numpy() for x in ("_words", "_c", "_own"))
        at = np.arange(len(words))
        # the phrase of each length that is open at each row
        head = [np.maximum.accumulate(np.where(words == n, at, -1)) for n in range(1, max_words + 1)]
        longer = np.concatenate([held_longer, np.zeros(len(words) - old, np.int64)])
        for n in range(2, max_words + 1):
            new = (words == n) & own & (at >= old)
            np.maximum.at(longer, head[n - 2][new], c[new])
        stays = [] if batch is None else [int(head[n][-1]) for n in range(int(words[-1]))]
        gone = np.ones(len(words), bool)
        gone[stays] = False
        size = np.where(gone & own, words - 1, 0)
        shorter = np.zeros(int(size.sum()), np.int64)
        first = np.cumsum(size) - size
        for n in range(1, max_words):
            has = size >= n
            shorter[first[has] + n - 1] = c[head[n - 1][has]]
        done = table.filter(pa.array(gone)).combine_chunks()
        ends = np.concatenate(([0], np.cumsum(size[gone]))).astype(np.int32)
        unknown = pa.array(~own[gone])
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(shorter), mask=unknown)
        yield from pa.Table.from_arrays(
            [done.column("_lang"), done.column("_phrase"), done.column("_words"), pa.array(c[gone], mask=~own[gone]), lists, pa.array(longer[gone])],
            ["_lang", "_phrase", "_words", "_c", "_shorter", "_longer"]).to_batches()
        held = table.take(pa.array(stays, pa.int64())).combine_chunks().to_batches()[0] if stays else None
        held_longer = longer[stays]


def stream(counts: DataFrame, max_words: int, last_first: bool) -> DataFrame:
    """The counts in prefix order (or suffix order) with what
    :func:`merge_stream` finds there."""
    words = F.split("_phrase", " ")
    laid = counts.withColumn("_w", F.reverse(words) if last_first else words)
    order = ["_lang", *(f"_w{i}" for i in range(max_words))]
    laid = laid.select("*", *(F.get("_w", F.lit(i)).alias(f"_w{i}") for i in range(max_words))).drop("_w")
    pieces = save(laid.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id()), "suffix-order" if last_first else "prefix-order").df
    heads = pieces.groupBy("_piece").agg(F.min(F.struct(*order)).alias("_h"))       # a row a piece
    begun = None
    for n in range(1, max_words):
        same = [F.col(f"_h.{c}") == F.col(c) for c in order[:n + 1]]
        longer = F.col(f"_h._w{n}").isNotNull()
        part = pieces.where(F.col("_words") == n).drop("_piece").join(F.broadcast(heads), [longer, *same]).drop("_h")
        begun = part if begun is None else begun.unionByName(part)
    rows = pieces.withColumn("_own", F.lit(True))
    if begun is not None:
        rows = rows.unionByName(begun.withColumn("_own", F.lit(False)))
    fields = ["_lang", "_phrase", "_words", "_c", "_own"]
    # a length that a phrase does not have sorts first, so shorter phrases come before longer ones
    return (rows.repartition("_piece").sortWithinPartitions("_piece", *[F.col(c).asc_nulls_first() for c in order]).select(*fields)
            .mapInArrow(lean(lambda b: merge_stream(b, max_words)),
                        "_lang string, _phrase string, _words int, _c long, _shorter array<long>, _longer long"))


def _scored(a: Column, lefts: Column, rights: Column) -> Column:
    """Least (score, cut, left, right) of a phrase's cuts, in whole numbers."""
    whole = lambda x: x.cast("decimal(18,0)")

    def cut(k: Column) -> Column:
        left, right = F.get(lefts, k - 1), F.get(rights, F.size(rights) - k)
        score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (whole(a) * whole(a)), whole(left) * whole(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size(lefts)), cut))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10,
                 inside: int = 50, top: int = 2_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases
    of 2 to ``max_words`` words by score, count and phrase.  A phrase found in
    a longer one that has ``inside`` per cent of its count or more is left out."""
    counts, total = phrase_counts(docs, text, lang, max_words, least)
    key = ["_lang", "_phrase", "_words"]
    first = stream(counts, max_words, last_first=False).withColumnRenamed("_shorter", "_lefts").withColumn("_rights", F.lit(None).cast("array<long>"))
    last = stream(counts, max_words, last_first=True).withColumnRenamed("_shorter", "_rights").withColumn("_lefts", F.lit(None).cast("array<long>"))
    met = (first.unionByName(last).where("_words > 1").groupBy(*key)
           .agg(F.max("_c").alias("_c"), F.max("_lefts").alias("_lefts"), F.max("_rights").alias("_rights"), F.max("_longer").alias("_longer")))
    # extensions are counted among phrases that occur often enough; a longer one still is in one of these
    kept = met.where(~((F.col("_longer") >= least) & (F.lit(100) * F.col("_longer") >= F.lit(inside) * F.col("_c"))))
    scored = kept.withColumn("_s", _scored(F.col("_c"), F.col("_lefts"), F.col("_rights")))
    rows = scored.select(F.col("_lang").alias("lang"), F.col("_phrase").alias("phrase"), F.col("_c").alias("a"), "_s.l", "_s.r", "_s.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of each part of a language, then of the language: both have a bounded number of rows
    part = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED)))
    part = part.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_r") <= top)
    best = part.drop("_r", "_part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(total.withColumnRenamed("_lang", "lang"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("_n").alias("n"), "score")
