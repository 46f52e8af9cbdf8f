"""Quality classifier: a byte-level convolutional network in numpy.

A filter of width k over embedded bytes is a sum of k table look-ups, one row of weights
per byte and place, so the first layer is stored and trained as k tables of 256 rows.
Documents are cut into chunks that overlap by k - 1 bytes and together cover every byte;
each filter's responses are max-pooled over a chunk and rectified. The mean, the least
and the greatest of the chunks' values feed one logistic unit: the least and the mean
tell text that lacks what prose has everywhere, the greatest tells foreign patterns.

Training descends by Adam on a bounded sample; the gradient of a maximum touches only
the places where it was reached. Defined results: null and empty texts have no chunk and
score 0. Texts shorter than a filter are padded. Repeated rows get a row each. Without
labelled rows every text that is not empty scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import bytes_of, id_and_text, map_batches, remainder, staged_batches
from segmart.llm.labelled import labelled_sample

FILTERS = 16
WIDTH = 6
CHUNK = 512
GROUP = 512  # chunks whose responses are in memory at once
EPOCHS = 6
BATCH = 32
RATE = 0.02
TRAIN_DOCS = 800
PADDING = b"\x00" * WIDTH


@dataclass
class ConvNet:
    tables: np.ndarray  # place in the filter, byte, filter
    bias: np.ndarray
    weights: np.ndarray  # mean, least and greatest value of each filter, and shortness
    offset: float
    training: bool = False  # whether places of maxima are wanted

    def arrays(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.weights]

    def pooled(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Per chunk and filter: the largest response and the place where it is reached."""
        raw = np.frombuffer(text if len(text) >= WIDTH else text + PADDING, np.uint8)
        n = len(raw) - WIDTH + 1
        n_chunks, length = -(-n // CHUNK), min(CHUNK, n)
        # The last chunk reaches back over full length, so that chunks are comparable.
        starts = np.minimum(np.arange(n_chunks) * CHUNK, max(0, n - CHUNK))
        top, place = [], []
        for group in range(0, n_chunks, GROUP):  # a long text's responses are held in parts
            own = starts[group : group + GROUP]
            first, stop = own[0], own[-1] + length
            response = self.tables[0][raw[first:stop]]
            for j in range(1, WIDTH):
                response += self.tables[j][raw[first + j : stop + j]]
            parts = [response[s : s + length] for s in own - first]
            top += [part.max(0) for part in parts]
            if self.training:
                place += [part.argmax(0) + s for part, s in zip(parts, own)]
        return np.array(top) + self.bias, np.array(place) if self.training else starts

    def features(self, top: np.ndarray, n_bytes: int) -> np.ndarray:
        active = np.maximum(top, 0)
        short = max(0.0, 1 - n_bytes / CHUNK)  # part of a chunk that a short text lacks
        return np.concatenate([active.mean(0), active.min(0), active.max(0), [short]])

    def score(self, text: bytes) -> float:
        if not text:
            return 0.0
        z = self.features(self.pooled(text)[0], len(text)) @ self.weights + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _gradients(net: ConvNet, text: bytes, label: int, weight: float, out: list[np.ndarray]) -> float:
    """Add a document's gradients to `out` and return that of the offset."""
    raw = np.frombuffer(text if len(text) >= WIDTH else text + PADDING, np.uint8)
    top, place = net.pooled(text)
    active = np.maximum(top, 0)
    features = net.features(top, len(text))
    z = features @ net.weights + net.offset
    error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
    out[2] += error * features
    mean, least, most = np.split(error * net.weights[:-1], 3)
    back = np.repeat(mean[None] / len(active), len(active), 0)
    columns = np.arange(FILTERS)
    back[active.argmin(0), columns] += least
    back[active.argmax(0), columns] += most
    back *= top > 0
    out[1] += back.sum(0)
    for j in range(WIDTH):
        np.add.at(out[0][j], (raw[place + j], np.broadcast_to(columns, place.shape)), back)
    return error


def fit(sample: list[tuple[bytes, int]], seed: int = 7, epochs: int = EPOCHS) -> ConvNet:
    """Train on texts and labels; the classes weigh the same, whatever their share."""
    random = np.random.default_rng(seed)
    net = ConvNet(
        random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        random.normal(0, 0.1, 3 * FILTERS + 1).astype(np.float32), 0.0, training=True,
    )
    sample = [(text, label) for text, label in sample if text]
    if not sample:
        net.weights[:], net.training = 0, False
        return net
    share = sum(label for _, label in sample) / len(sample)
    weight = {1: 0.5 / max(share, 1e-6), 0: 0.5 / max(1 - share, 1e-6)}
    moments = [[np.zeros_like(a) for a in net.arrays()] for _ in range(2)]
    step, offset_moments = 0, [0.0, 0.0]
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = random.permutation(len(sample))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            grads, offset_grad = [np.zeros_like(a) for a in net.arrays()], 0.0
            for k in chosen:
                text, label = sample[k]
                offset_grad += _gradients(net, text, label, weight[label], grads)
            step += 1
            scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for array, grad, first, second in zip(net.arrays(), grads, *moments, strict=True):
                grad /= len(chosen)
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                array -= scale * first / (np.sqrt(second) + 1e-8)
            offset_grad /= len(chosen)
            offset_moments[0] += 0.1 * (offset_grad - offset_moments[0])
            offset_moments[1] += 0.001 * (offset_grad**2 - offset_moments[1])
            net.offset -= scale * offset_moments[0] / (offset_moments[1] ** 0.5 + 1e-8)
    net.training = False
    return net


def score_documents(
    docs: DataFrame, net: ConvNet, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score of each row, as a written table."""
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([net.score(text) for text in bytes_of(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=schema.names)

    return staged_batches(map_batches(rows, score, schema), "quality")


def quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 5, held_out: int = 0,
    threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    sample = labelled_sample(docs, labels, label, divisor, held_out, id_col, text_col, TRAIN_DOCS)
    scored = score_documents(docs, fit(sample), id_col, text_col)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
