"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed-length
windows, each filter keeps its maximum over the window, and a softmax layer
turns the maxima into languages.  The network is trained in numpy (Adam,
fixed seed) on a bounded sample of labelled rows, and applied to every
window of every text; a text's score is the geometric mean of its windows'
probabilities, weighted by their bytes.

Null text, and text without any letter, is ``und`` with score 0.  Repeated
rows get equal answers.  Without any labelled row everything is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.words import buffers, lean, trim

#: Rows that training sees at most (those with the smallest hashes), and windows of each.
TRAIN_ROWS, TRAIN_WINDOWS = 3000, 4
WINDOW = 256
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 7
PAD = 32
UND = "und"


@dataclass
class ByteConv:
    """Weights: ``embed`` 256 x EMBED, ``conv`` (max width * EMBED) x filters
    with zeros past a filter's width, ``bias``, ``out``, ``out_bias``."""

    labels: list[str]
    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima and their places, for windows x WINDOW bytes."""
        n, span = windows.shape[0], WINDOW - max(WIDTHS) + 1
        x = self.embed[windows].reshape(n, -1)
        cols = np.lib.stride_tricks.sliding_window_view(x, max(WIDTHS) * EMBED, axis=1)[:, ::EMBED]
        y = (np.ascontiguousarray(cols).reshape(n * span, -1) @ self.conv).reshape(n, span, -1)
        at = y.argmax(1)
        return np.take_along_axis(y, at[:, None], 1)[:, 0] + self.bias, at

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.labels)), np.float32)
        for i in range(0, len(windows), 128):
            z = np.maximum(self.pooled(windows[i:i + 128])[0], 0) @ self.out + self.out_bias
            z -= z.max(1, keepdims=True)
            out[i:i + 128] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out


def take_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows at ``start``, padded past ``end``, and the bytes of each."""
    length = np.minimum(WINDOW, end - start)
    at = np.minimum(start[:, None] + np.arange(WINDOW), len(data) - 1)
    return np.where(np.arange(WINDOW) < length[:, None], data[at], np.uint8(PAD)), length


def train(windows: np.ndarray, targets: np.ndarray, labels: list[str]) -> ByteConv:
    rng = np.random.default_rng(SEED)
    total, deep = FILTERS * len(WIDTHS), max(WIDTHS) * EMBED
    live = np.zeros((deep, total), np.float32)
    for i, w in enumerate(WIDTHS):
        live[:w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
    net = ByteConv(labels, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                   (rng.normal(0, 0.3, (deep, total)) * live).astype(np.float32), np.zeros(total, np.float32),
                   rng.normal(0, 0.1, (total, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32))
    params = [net.embed, net.conv, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            rows = order[i:i + BATCH]
            x, n = windows[rows], len(rows)
            y, at = net.pooled(x)
            a = np.maximum(y, 0)
            z = a @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), targets[rows]] -= 1
            p /= n
            back = (p @ net.out.T) * (y > 0)                                  # n x filters
            near = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))]  # n x filters x width
            seen = net.embed[near].reshape(n, total, deep)
            g_conv = np.einsum("nf,nfd->df", back, seen) * live
            g_near = (back[:, :, None] * net.conv.T[None]).reshape(-1, EMBED)
            g_embed = np.zeros_like(net.embed)
            np.add.at(g_embed, near.reshape(-1), g_near)
            step += 1
            for k, g in enumerate((g_embed, g_conv, back.sum(0), a.T @ p, p.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] -= (RATE * (first[k] / (1 - 0.9 ** step))
                              / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def fit_language_model(docs: DataFrame, eligible: Column, text: str = "text", lang: str = "lang",
                       key: str = "doc_id", rows: int = TRAIN_ROWS) -> ByteConv | None:
    """Train on at most ``rows`` eligible rows with text and label, those with
    the smallest hashes; None if there are none.

    The hash is of the key (or of the text where the key is null).  A count
    first sets the part of the hash range that holds about twice the bound,
    so only that part of the texts is read into windows.
    """
    usable = docs.where(eligible & F.col(lang).isNotNull() & F.col(text).isNotNull())
    span = 1 << 40
    place = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.md5(F.col(text)))), F.lit(span))
    n = usable.count()
    if not n:
        return None
    near = usable.select(place.alias("_place"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    near = near.where(F.col("_place") < min(span, 2 * rows * span // n + 1))

    def cut(batches):
        for batch in batches:
            for place, body, label in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data, _ = buffers(pa.array([body], pa.string()))
                n = -(-len(data) // WINDOW)
                nth = np.unique(np.linspace(0, n - 1, TRAIN_WINDOWS).astype(int)) if n else np.zeros(0, int)
                w, _ = take_windows(data, nth * WINDOW, np.full(len(nth), len(data)))
                yield pa.RecordBatch.from_pydict({"_place": [place], "_lang": [label], "_windows": [w.tobytes()]})

    found = near.mapInArrow(lean(cut), "_place long, _lang string, _windows binary")
    sample = found.orderBy("_place", "_lang", "_windows").limit(rows).collect()
    parts = [np.frombuffer(bytes(r["_windows"]), np.uint8).reshape(-1, WINDOW) for r in sample]
    labels = sorted({r["_lang"] for r in sample})
    target = np.repeat([labels.index(r["_lang"]) for r in sample], [len(p) for p in parts])
    windows = np.concatenate(parts) if parts else np.zeros((0, WINDOW), np.uint8)
    return train(windows, target, labels) if len(windows) else None


def _has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, bool)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        low = data | np.uint8(32)
        out[some] = np.logical_or.reduceat((low >= 97) & (low <= 122), offsets[some])
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in (texts[i].as_py() or ""))
    return out


def predict(model: ByteConv | None, texts: pa.Array, block: int = 2048) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    data, offsets = buffers(texts)
    n = len(texts)
    if model is None:
        return [UND] * n, np.zeros(n)
    size = np.diff(offsets)
    first = np.concatenate(([0], np.cumsum(-(-size // WINDOW))))
    total = np.zeros((n, len(model.labels)))
    for a in range(0, int(first[-1]), block):      # a block of windows at a time, however long the texts
        nth = np.arange(a, min(a + block, int(first[-1])))
        text = np.searchsorted(first, nth, "right") - 1
        start = offsets[text] + (nth - first[text]) * WINDOW
        w, length = take_windows(data, start, offsets[text + 1])
        np.add.at(total, text, model.log_probs(w) * length[:, None])
    mean = total / np.maximum(size, 1)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    known = _has_letter(texts, data, offsets)
    best = p.argmax(1)
    return ([model.labels[b] if k else UND for b, k in zip(best, known, strict=True)],
            np.where(known, p[np.arange(n), best], 0.0))


def identify_language(docs: DataFrame, model: ByteConv | None, text: str = "text", out: str = "lang_pred",
                      score: str = "lang_score") -> DataFrame:
    """``docs`` with the language and its probability; columns of these names
    are replaced.  No shuffle: one pass over the texts."""
    @F.arrow_udf("struct<lang:string,score:double>")
    def guess(texts: pa.Array) -> pa.Array:
        lang, p = predict(model, texts)
        trim()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(p, pa.float64())], ["lang", "score"])

    return (docs.withColumn("_lid", guess(F.col(text)))
            .withColumns({out: F.col("_lid.lang"), score: F.col("_lid.score")}).drop("_lid"))


def held_out(key: Column, folds: int = 5) -> Column:
    """Fold 0 of crc32(key as text): never trained on.  A null key is not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
