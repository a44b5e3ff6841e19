"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Each byte has a learned vector, learned filters slide over
windows of bytes, and each filter keeps its maximum in every chunk of 512 bytes; the
chunks overlap by half and cover the whole text. A learned weight for each filter turns
the maxima of a chunk into a log odds; a text's log odds are the mean of its chunks. A chunk
that the text does not fill has smaller maxima, so a learned offset goes with its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import staged

#: Bytes of half a chunk: chunks are two halves long and start at every half.
HALF = 256
#: Bytes of a filter's window and between windows, values of a byte's vector, filters.
WIDTH, STRIDE, DIMS, FILTERS = 8, 2, 4, 32
#: Fitting takes at most this many labelled rows, and this many chunks spread evenly over each.
FIT_ROWS, FIT_CHUNKS = 3000, 8
EPOCHS, BATCH, RATE, DECAY = 14, 256, 0.006, 1e-4
#: Offsets by size of a chunk: up to 0, 1, 3, 7 ... 255 bytes, and more.
SIZES = 10
#: While fitting, this share of chunks is cut to a random size, so that short texts are known too.
CUT = 0.2
_STEPS = HALF // STRIDE
#: Halves of chunks that are computed at a time.
_HALVES = 128


@dataclass
class Model:
    bytes: np.ndarray  # 256 x DIMS
    filters: np.ndarray  # WIDTH * DIMS x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    offsets: np.ndarray  # SIZES


def _padded(data: bytes) -> bytes:
    """``data`` with zero bytes up to a whole number of halves, a window's width at least."""
    return data + b"\0" * (WIDTH + -(len(data) + WIDTH) % HALF)


def _windows(codes: np.ndarray, model: Model) -> np.ndarray:
    """A row for each window that starts in ``codes`` (a last width of bytes only ends windows)."""
    x = model.bytes[codes]
    n = (len(codes) - WIDTH) // STRIDE
    step = x.strides[0]
    return np.lib.stride_tricks.as_strided(x, (n, WIDTH * DIMS), (STRIDE * step, x.strides[1]), writeable=False)


def _maxima(codes: np.ndarray, model: Model, last: np.ndarray | None = None) -> np.ndarray:
    """Largest output of each filter in each half; ``codes`` are whole halves, ``last`` the halves that end a text, none
    if not given.

    The last windows of a text would reach into the next one. Over zeros, as they should be, they say what
    the window before them says, so they are left out.
    """
    over = WIDTH // STRIDE - 1
    out = np.empty((len(codes) // HALF, FILTERS), np.float32)
    if last is None:
        last = np.zeros(len(out), bool)
    more = np.concatenate([codes, np.zeros(WIDTH, np.uint8)])
    for at in range(0, len(out), _HALVES):
        part = more[at * HALF : (at + _HALVES) * HALF + WIDTH]
        y = np.ascontiguousarray(_windows(part, model)) @ model.filters
        y = y.reshape(-1, _STEPS, FILTERS)
        out[at : at + _HALVES] = y[:, :-over].max(axis=1)
        inner = ~last[at : at + _HALVES]
        out[at : at + _HALVES][inner] = np.maximum(out[at : at + _HALVES][inner], y[inner, -over:].max(axis=1))
    return out


def _size_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(n + 1)), SIZES - 1).astype(np.int64)


def _log_odds(texts: list[bytes], model: Model) -> np.ndarray:
    padded = [_padded(t) for t in texts]
    halves = np.array([len(p) // HALF for p in padded])
    last = np.cumsum(halves) - 1
    ends = np.zeros(halves.sum(), bool)
    ends[last] = True
    peaks = _maxima(np.frombuffer(b"".join(padded), np.uint8), model, ends)
    chunk = peaks.copy()
    chunk[:-1] = np.maximum(peaks[:-1], peaks[1:])
    chunk[last] = peaks[last]  # a chunk ends with its text
    first = last - halves + 1
    start = np.arange(len(chunk)) - np.repeat(first, halves)
    length = np.repeat([len(t) for t in texts], halves)
    filled = np.clip(length - start * HALF, 0, 2 * HALF)
    odds = np.maximum(chunk + model.bias, 0) @ model.weights + model.offsets[_size_class(filled)]
    # The half-length chunk at the end counts only where it is the whole text.
    odds[last[halves > 1]] = 0
    return np.add.reduceat(odds, first) / np.maximum(halves - 1, 1)


def scores(texts: list[bytes], model: Model, block: int = 4 << 20) -> np.ndarray:
    """Probability of label 1 for each text, about ``block`` bytes of whole texts at a time."""
    out, now, size = [], [], 0
    for t in texts:
        now.append(t)
        size += len(t)
        if size >= block:
            out.append(_log_odds(now, model))
            now, size = [], 0
    if now:
        out.append(_log_odds(now, model))
    z = np.concatenate(out) if out else np.empty(0)
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maps ``text, label`` to ``chunks, label``: up to FIT_CHUNKS chunks, spread evenly over the whole text."""
    for b in batches:
        out = []
        for x in b.column("text"):
            data = _padded((x.as_py() or "").encode("utf-8", "surrogatepass"))
            n = max(len(data) // HALF - 1, 1)
            take = np.unique(np.linspace(0, n - 1, min(n, FIT_CHUNKS)).astype(int))
            out.append(b"".join(data[i * HALF : (i + 2) * HALF].ljust(2 * HALF, b"\0") for i in take))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), b.column("label")], ["chunks", "label"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, seed: int = 7) -> Model:
    """A model of at most ``limit`` labelled rows: ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``).

    Ids that ``held_out`` names are never learned from. Taken are the ids with the smallest
    hashes, half of ``limit`` for each label; only ids are shuffled to find them, and only
    their texts are read further. At most ``limit * FIT_CHUNKS`` chunks of 512 bytes reach
    the driver. Null texts count as empty; labels other than 0 and 1, and null ids, are left
    out; an id with several texts counts once, with the least. Without rows of both labels
    the model says one thing of every text: that label, or a half without rows.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col("quality").cast("int").alias("label"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    zero, one = (known.where(F.col("label") == y).orderBy(*order).limit(limit // 2) for y in (0, 1))
    taken = staged(zero.unionByName(one), "taken")  # ``limit`` rows at most, so it may be broadcast
    rows = (
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(taken), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    got = rows.select("text", "label").mapInArrow(_sampled, "chunks binary, label int").collect()
    return train([(bytes(r["chunks"]), r["label"]) for r in got], seed)


def train(rows: list[tuple[bytes, int]], seed: int = 7) -> Model:
    """A model of chunks of 512 bytes (several to a row) and their labels, by gradient descent."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.5, (256, DIMS)).astype(np.float32),
        rng.normal(0, (WIDTH * DIMS) ** -0.5, (WIDTH * DIMS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(SIZES, np.float32),
    )
    size = 2 * HALF
    rows = sorted(rows)
    owner = np.repeat(np.arange(len(rows)), [len(c) // size for c, _ in rows])
    label = np.array([y for _, y in rows], np.float32)
    ones = float(label.sum())
    if not 0 < ones < len(rows):
        model.filters[:] = 0
        model.offsets[:] = 0 if not rows else 6 if ones else -6
        return model
    codes = np.frombuffer(b"".join(c for c, _ in rows), np.uint8).reshape(-1, size)
    filled = size - (codes[:, ::-1] != 0).argmax(axis=1)
    filled[~codes.any(axis=1)] = 0
    target = label[owner]
    # Every row weighs the same, however many chunks it has.
    weight = (1 / np.bincount(owner)[owner]).astype(np.float32)
    weight /= weight.mean()
    model.weights[:] = rng.normal(0, 0.1, FILTERS)
    params = [model.bytes, model.filters, model.bias, model.weights, model.offsets]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            cut = np.where(rng.random(len(pick)) < CUT, 2 ** rng.uniform(3, 9, len(pick)), size).astype(int)
            some = np.minimum(filled[pick], cut)
            part = np.where(np.arange(size) < some[:, None], codes[pick], 0).astype(np.uint8)
            grads = _gradients(part, some, target[pick], weight[pick], params)
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _gradients(codes: np.ndarray, filled: np.ndarray, target: np.ndarray, weight: np.ndarray, params: list) -> list:
    vectors, filters, bias, weights, offsets = params
    kind = _size_class(filled)
    n, size = codes.shape
    padded = np.concatenate([codes, np.zeros((n, WIDTH), np.uint8)], axis=1)
    starts = np.arange(0, size, STRIDE)
    x = vectors[padded]
    view = np.lib.stride_tricks.as_strided(
        x, (n, len(starts), WIDTH * DIMS), (x.strides[0], STRIDE * x.strides[1], x.strides[2]), writeable=False
    )
    y = np.ascontiguousarray(view).reshape(-1, WIDTH * DIMS) @ filters
    y = y.reshape(n, len(starts), FILTERS)
    best = y.argmax(axis=1)
    peak = np.take_along_axis(y, best[:, None, :], axis=1)[:, 0, :] + bias
    active = np.maximum(peak, 0)
    p = 1 / (1 + np.exp(-np.clip(active @ weights + offsets[kind], -30, 30)))
    d = ((p - target) * weight / n).astype(np.float32)
    d_peak = d[:, None] * weights * (peak > 0)
    at = starts[best]  # chunk x filter: first byte of the window that gave the maximum
    window = padded[np.arange(n)[:, None, None], at[:, :, None] + np.arange(WIDTH)]
    d_filters = np.einsum("nf,nfk->kf", d_peak, vectors[window].reshape(n, FILTERS, -1))
    d_vectors = np.zeros_like(vectors)
    spread = (d_peak[:, :, None] * filters.T[None]).reshape(-1, DIMS)
    for k in range(DIMS):
        d_vectors[:, k] = np.bincount(window.reshape(-1), spread[:, k], 256)
    return [d_vectors, d_filters, d_peak.sum(axis=0), active.T @ d, np.bincount(kind, d, SIZES)]


def classified(docs: DataFrame, model: Model, *keys: str) -> DataFrame:
    """The columns ``keys``, ``score`` and ``predicted`` (1 from a score of 0.5) of each row of ``docs``.

    The whole ``text`` counts. Null and empty texts get the score of no bytes. Rows with
    equal texts get equal scores. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # about 10 KB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in b.column("_text")]
            score = scores(texts, sent.value)
            rest = [(b.column(i), f.name) for i, f in enumerate(b.schema) if f.name != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, _ in rest), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*(n for _, n in rest), "score", "predicted"],
            )

    rows = docs.select(*keys, F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(run, rows.drop("_text").schema.add("score", "double", False).add("predicted", "integer", False))


def held_out(doc_id) -> F.Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def good(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, with the columns of ``docs``."""
    model = fit(docs, labels, limit)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in b.column("text")]
            yield b.filter(pa.array(scores(texts, sent.value) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
