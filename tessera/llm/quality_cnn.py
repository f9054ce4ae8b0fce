"""Quality classifier (operator 9): a byte-level convolutional network in numpy.

Learned filters of ``WIDTH`` bytes run over every position of the whole text;
their outputs are max-pooled in chunks of two ``SEGMENT``s that overlap by one
segment, and the chunk vectors are averaged into one vector per document, from
which a logistic unit gives the probability of label 1.

Fitting takes a bounded sample: at most ``TRAIN_ROWS`` labelled rows (those of
the smallest hash), of texts up to ``TRAIN_BYTES`` bytes.  Scoring covers every
byte of every text.  The weights have a fixed size.

Defined results: null and empty texts are one window of padding and get a score
like any text; rows without labels are scored; of repeated label rows the
smallest label counts; repeated documents get equal scores; without any usable
label every score is 0.5; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package
from tessera.llm.words import text_slices

WIDTH = 6
FILTERS = 16
SEGMENT = 128
TRAIN_ROWS = 2000
TRAIN_BYTES = 16384
EPOCHS = 8
BATCH = 32
THRESHOLD = 0.7
_SLICE = 1 << 16


@dataclass
class Network:
    """Byte filters (width x 256 x filters), their biases, and the output unit."""

    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def positions(self, data: np.ndarray, n: int) -> np.ndarray:
        """Filter outputs at the first n positions of padded bytes."""
        total = self.filters[0][data[:n]]
        for j in range(1, len(self.filters)):
            total += self.filters[j][data[j: j + n]]
        total += self.bias
        return np.maximum(total, 0, out=total)

    def document(self, text: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """Mean of the chunk vectors of one text."""
        width = len(self.filters)
        n = max(len(text) - width + 1, 1)
        pooled = []
        step = _SLICE // segment * segment
        for i in range(0, n, step):
            m = min(step, n - i)
            piece = text[i: i + m + width - 1]
            if len(piece) < m + width - 1:
                piece = np.concatenate([piece, np.zeros(m + width - 1 - len(piece), np.uint8)])
            pooled.append(np.maximum.reduceat(self.positions(piece, m), np.arange(0, m, segment), axis=0))
        parts = np.concatenate(pooled)
        chunks = np.maximum(parts[:-1], parts[1:]) if len(parts) > 1 else parts
        return chunks.mean(axis=0)

    def score(self, text: np.ndarray) -> float:
        z = float(self.document(text) @ self.out + self.out_bias)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _learn(net: Network, text: np.ndarray, label: int, grads, segment: int) -> None:
    """Add the gradients of one document; each chunk's maximum has one source."""
    width, n_filters = len(net.filters), net.filters.shape[2]
    n = max(len(text) - width + 1, 1)
    data = np.concatenate([text, np.zeros(max(n + width - 1 - len(text), 0), np.uint8)])
    values = net.positions(data, n)
    starts = np.arange(0, n, segment)
    best = np.stack([s + values[s: s + segment].argmax(axis=0) for s in starts])
    top = np.take_along_axis(values, best, axis=0)
    if len(starts) > 1:
        later = top[1:] > top[:-1]
        best, top = np.where(later, best[1:], best[:-1]), np.where(later, top[1:], top[:-1])
    mean = top.mean(axis=0)
    slope = float(1 / (1 + np.exp(-np.clip(mean @ net.out + net.out_bias, -30, 30)))) - label
    grads["out"] += slope * mean
    grads["out_bias"] += slope
    flow = np.where(top > 0, slope * net.out / len(top), 0).astype(np.float32)
    grads["bias"] += flow.sum(axis=0)
    columns = np.broadcast_to(np.arange(n_filters), best.shape)
    for j in range(width):
        np.add.at(grads["filters"][j], (data[best + j], columns), flow)


def fit(texts: list[bytes], labels: list[int], width: int = WIDTH, n_filters: int = FILTERS, epochs: int = EPOCHS,
        seed: int = 7) -> Network:
    """Adam on the logistic loss; deterministic for the same rows."""
    rng = np.random.default_rng(seed)
    net = Network((rng.standard_normal((width, 256, n_filters)) * 0.1).astype(np.float32),
                  np.zeros(n_filters, np.float32), (rng.standard_normal(n_filters) * 0.1).astype(np.float32), 0.0)
    if len(set(labels)) < 2:
        net.out[:] = 0
        return net
    data = [np.frombuffer(t, np.uint8) for t in texts]
    names = ("filters", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k), dtype=np.float32) for k in names}
    second = {k: np.zeros_like(getattr(net, k), dtype=np.float32) for k in names}
    turn = 0
    for epoch in range(epochs):
        order, rate = rng.permutation(len(data)), 0.02 * (1 - epoch / epochs) + 0.001
        for i in range(0, len(order), BATCH):
            rows = order[i: i + BATCH]
            grads = {k: np.zeros_like(first[k]) for k in names}
            for r in rows:
                _learn(net, data[r], labels[r], grads, SEGMENT)
            turn += 1
            for k in names:
                g = grads[k] / len(rows)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-6)
                setattr(net, k, (getattr(net, k) - move).astype(np.float32) if k != "out_bias"
                        else float(net.out_bias - move))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> Network:
    """Fit on the bounded sample of labelled rows that are not held out."""
    known = (labels.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__label")))
    sample = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = (docs.select(F.col(id_col).alias("__id"), text.alias("__text"))
             .join(F.broadcast(sample), "__id")  # at most ``rows`` rows
             .where(F.octet_length("__text") <= max_bytes)
             .groupBy("__id", "__label").agg(F.min("__text").alias("__text"))
             .orderBy("__id").limit(rows).collect())
    return fit([r["__text"].encode() for r in found], [int(r["__label"]) for r in found])


def _score_task(model):
    def run(batches):
        net = model.value
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for texts in text_slices(batch.column("text")):
                for r in range(len(texts)):
                    scores[texts.first + r] = net.score(texts.buf[texts.offsets[r]: texts.offsets[r + 1]])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(net)
    return rows.mapInArrow(_score_task(model), f"doc_id {id_type}, score double")
