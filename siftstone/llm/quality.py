"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, cut into chunks of ``CHUNK`` bytes that overlap by
``OVERLAP``, to the end of the text. ``FILTERS`` learned filters of ``WIDTH`` bytes
slide over each chunk byte by byte, so every window of the text counts; each filter is
rectified and max-pooled over its chunk. The largest and the mean pooled value over
all chunks go into one logistic unit, whose output is the probability of label 1.

Bytes are categories, so a filter is a table of one weight for each place and byte.
For scoring, two neighbouring places are one table of byte pairs.

Training is plain gradient descent (Adam) on the driver over a sample of whole labelled
texts: the rows with the smallest hash of doc_id, ``SAMPLE_ROWS`` of them or as many as
``SAMPLE_BYTES`` hold. Texts over ``LONG_BYTES`` come after all others, so that a few long
ones don't use up the sample. Scoring reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK, OVERLAP = 512, 64
FILTERS, WIDTH = 16, 6
SAMPLE_ROWS, SAMPLE_BYTES, LONG_BYTES, EPOCHS, BATCH = 4_000, 4 << 20, 1 << 16, 8, 32
#: Chunks of a long text, and bytes of short ones, that are convolved at once.
GROUP_CHUNKS, GROUP_BYTES = 128, 1 << 16
SEED = 7


def chunk_starts(n: int) -> range:
    """Starts of the overlapping chunks that cover n bytes."""
    return range(0, max(1, n - OVERLAP), CHUNK - OVERLAP)


@dataclass
class ByteCnn:
    """Weights: table[place, byte, filter], bias by filter, and the logistic unit."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    _pairs: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_pairs": []}  # made anew where it is used

    def convolve(self, raw: np.ndarray) -> np.ndarray:
        """Filter responses of each window of at least ``WIDTH`` bytes."""
        if not self._pairs:
            for place in range(0, WIDTH, 2):
                both = self.table[place][:, None] + self.table[place + 1][None]
                self._pairs.append(both.reshape(1 << 16, FILTERS) + (self.bias if place == 0 else 0))
        pair = raw[:-1].astype(np.intp) << 8 | raw[1:]
        n = len(raw) - WIDTH + 1
        made = self._pairs[0].take(pair[:n], axis=0)
        for k in range(1, WIDTH // 2):
            made += self._pairs[k].take(pair[2 * k : 2 * k + n], axis=0)
        return made

    def score_all(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of whole texts."""
        best = np.zeros((len(texts), FILTERS), np.float32)
        total = np.zeros((len(texts), FILTERS))
        count = np.zeros(len(texts), np.int64)
        for owners, raw, edges in _groups(texts):
            made = np.maximum(np.maximum.reduceat(self.convolve(raw), edges, axis=0)[::2], 0)
            # chunk after chunk in the order of the text, however texts are grouped
            np.maximum.at(best, owners, made)
            np.add.at(total, owners, made)
            np.add.at(count, owners, 1)
        mean = total / np.maximum(count, 1)[:, None]
        x = (np.concatenate([best, mean], axis=1) * self.out).sum(axis=1) + self.out_bias
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def score(self, text: bytes) -> float:
        return float(self.score_all([text])[0])


def _groups(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each chunk, bytes, first and last-but-one window of each chunk) in groups.

    A text shorter than a window is filled up with zeros, an empty one has no chunk.
    """
    owners: list[int] = []
    parts: list[bytes] = []
    edges: list[int] = []
    size = 0

    def flush():
        # one more byte, so that the end of the last chunk is a place too
        raw = np.frombuffer(b"".join([*parts, bytes(1)]), np.uint8)
        return np.array(owners), raw, np.array(edges)

    for i, text in enumerate(texts):
        starts = chunk_starts(len(text)) if text else range(0)
        for at in range(0, len(starts), GROUP_CHUNKS):
            some = starts[at : at + GROUP_CHUNKS]
            part = text[some[0] : some[-1] + CHUNK].ljust(WIDTH, b"\0")
            for s in some:
                first = size + s - some[0]
                owners.append(i)
                edges += (first, min(first + CHUNK, size + len(part)) - WIDTH + 1)
            parts.append(part)
            size += len(part)
            if size >= GROUP_BYTES:
                yield flush()
                owners, parts, edges, size = [], [], [], 0
    if parts:
        yield flush()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _chunks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of a text as rows of ``CHUNK`` bytes, and the number of windows of each."""
    starts = np.array(chunk_starts(len(text)))
    raw = np.frombuffer(text.ljust(WIDTH, b"\0") + bytes(CHUNK), np.uint8)
    held = np.minimum(max(len(text), WIDTH) - starts, CHUNK)
    return raw[starts[:, None] + np.arange(CHUNK)], held - WIDTH + 1


def train(texts: list[bytes], labels: list[int], seed: int = SEED) -> ByteCnn:
    """Fit on whole texts and 0/1 labels; classes weigh alike. Equal inputs give equal weights."""
    rng = np.random.default_rng(seed)
    net = ByteCnn(
        rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        0.0,
    )
    y = np.asarray(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():  # one class or none: the prior alone
        net.out[:] = 0
        net.out_bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    cut = [_chunks(text) for text in texts]
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("table", net.table), ("bias", net.bias), ("out", net.out), ("out_bias", np.zeros(1)))}
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 0.0005
        order = rng.permutation(len(cut))
        for at in range(0, len(order), BATCH):
            step += 1
            batch = order[at : at + BATCH]
            grads = _gradients(net, [cut[i] for i in batch], y[batch], weight[batch] / len(batch))
            for k, (m, s) in state.items():
                m += 0.1 * (grads[k] - m)
                s += 0.01 * (grads[k] ** 2 - s)
                move = rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
                if k == "out_bias":
                    net.out_bias -= float(move[0])
                else:
                    w = getattr(net, k)
                    w -= move.astype(np.float32)
            net._pairs.clear()
    return net


def _gradients(net: ByteCnn, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted loss over some texts, all their chunks together."""
    rows, windows = (np.concatenate(x) for x in zip(*docs, strict=True))
    counts = np.array([len(r) for r, _ in docs])
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(docs)), counts)
    places, filters = np.arange(WIDTH), np.arange(FILTERS)
    v, top = np.empty((len(rows), FILTERS), np.float32), np.empty((len(rows), FILTERS), np.int64)
    for at in range(0, len(rows), GROUP_CHUNKS):
        some = rows[at : at + GROUP_CHUNKS]
        # windows that cross from one row to the next are cut off
        made = net.convolve(np.append(some.reshape(-1), np.zeros(WIDTH - 1, np.uint8))).reshape(len(some), CHUNK, FILTERS)
        made[np.arange(CHUNK)[None] >= windows[at : at + GROUP_CHUNKS, None]] = -np.inf
        top[at : at + GROUP_CHUNKS] = made.argmax(axis=1)
        v[at : at + GROUP_CHUNKS] = np.take_along_axis(made, top[at : at + GROUP_CHUNKS, None], axis=1)[:, 0]
    v = np.maximum(v, 0)
    best = np.maximum.reduceat(v, first, axis=0)
    joined = np.concatenate([best, np.add.reduceat(v, first, axis=0) / counts[:, None]], axis=1)
    d = (sigmoid(joined @ net.out + net.out_bias) - y) * weight
    back = (d / counts)[owner, None] * net.out[FILTERS:]
    # of chunks that share the largest value the first one learns
    is_best = v == best[owner]
    for i, a in enumerate(first):
        back[a + is_best[a : a + counts[i]].argmax(axis=0), filters] += d[i] * net.out[:FILTERS]
    back[v <= 0] = 0
    table = np.zeros_like(net.table)
    # only the window that won the pool learns
    seen = rows[np.arange(len(rows))[:, None, None], top[:, None] + places[None, :, None]]
    np.add.at(table, (places[None, :, None], seen, filters[None, None]), back[:, None])
    return {"table": table, "bias": back.sum(axis=0), "out": d @ joined, "out_bias": np.array([d.sum()])}


def learn_quality(docs: DataFrame, labels: DataFrame, learn: Column) -> ByteCnn:
    """Fit on labelled rows where ``learn`` (over doc_id) holds, up to the sample bound.

    The sample is the labelled rows with the smallest hash of doc_id. A doc_id with
    several labels counts once, with the largest; null labels and ids are left out, and
    equal texts of one doc_id count once.
    Null texts are empty ones; other columns are not read, whatever their names.
    """
    known = (
        labels.filter(learn & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("quality").cast("int").alias("label"))
    )
    n = known.count()
    part = min(1.0, 1.5 * SAMPLE_ROWS / max(n, 1))
    some = known.withColumn("h", F.xxhash64("label_id")).filter((F.col("h") / F.lit(2.0**64) + 0.5) < part)
    keyed = docs.select(F.col("doc_id").alias("own_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most about one and a half times the sample bound, so broadcast.
    rows = keyed.join(F.broadcast(some), F.col("own_id") == F.col("label_id"))
    content = F.xxhash64("text").alias("content")
    sizes = rows.select("own_id", "h", content, F.octet_length("text").cast("long").alias("size")).distinct()
    order = Window.orderBy(F.col("size") > LONG_BYTES, "h", "own_id", "content")
    held = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    sizes = sizes.withColumns({"rank": F.row_number().over(order), "held": held})
    # the first row counts however long it is; the driver holds no more than the bound beside it
    chosen = sizes.filter((F.col("rank") <= SAMPLE_ROWS) & ((F.col("rank") == 1) | (F.col("held") <= SAMPLE_BYTES)))
    chosen = chosen.select("own_id", "content", "rank")
    rows = rows.withColumn("content", content).join(F.broadcast(chosen), ["own_id", "content"]).dropDuplicates(["rank"])
    rows = sorted(rows.select("rank", "label", "text").collect(), key=lambda r: r["rank"])
    return train([r["text"].encode("utf-8", "surrogatepass") for r in rows], [r["label"] for r in rows])


def score_quality(docs: DataFrame, net: ByteCnn) -> DataFrame:
    """One row per document row: doc_id, score, predicted.

    Null and empty texts have no chunk and score the bias alone. Repeated rows get
    equal scores, an empty table an empty result; only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                scores = net.score_all([(t.as_py() or "").encode("utf-8", "surrogatepass") for t in part.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(run, "doc_id long, score double, predicted int")
