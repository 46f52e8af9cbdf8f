"""Toxicity by compression distance: one zstandard dictionary per class.

The ordinary dictionary is trained on ordinary text, the toxic one on toxic text. Toxic documents
are ordinary text but for some words, and a dictionary of their whole text would be much the
same; so the toxic one is trained on the words of toxic documents that ordinary ones hardly have,
and has the ordinary content behind them. Every document is cut into overlapping windows over its
whole length; a window's distance is the bytes that the toxic dictionary saves. A logistic model
over the largest distances, their mean and the share of windows beyond a threshold gives the
probability.

The weights are calibrated on documents that their dictionaries were not trained on: the sample
is dealt over `FOLDS` parts, each compressed with dictionaries of the others. The dictionaries that
score come from the whole sample. Defined results: null and empty texts have distance 0 everywhere
and score low. Repeated rows get a row each. Without labelled rows every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import bytes_of, id_and_text, map_batches, remainder, staged_batches
from segmart.llm.labelled import fit_logistic, labelled_sample, logistic

WINDOW = 96
STEP = 64
LEVEL = 9
WINDOW_LOG = 17  # so that all of a dictionary is within reach
DICTIONARY_BYTES = 64 << 10
MIN_MATCH = 5
# A word tells of toxic text if so many toxic documents have it, this share of them at least, and it is
# so many times more frequent in them.
MIN_DOCS = 3
MIN_SHARE = 0.005
RATIO = 20.0
MIN_BYTES = 4
PUNCTUATION = b".,;:!?'\"()[]|"
TOP = 6
BEYOND = 3  # saved bytes that count as a hit
FEATURES = 7
FOLDS = 3
CUT = 0.7  # the score that the best cut of the calibration half is moved to


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in lower case, without punctuation around them."""
    return [word.strip(PUNCTUATION) for word in text.lower().split()]


def unlike(texts: list[bytes]) -> list[bytes]:
    """The texts without most near copies: one per least hash of a five-word shingle."""
    first: dict[int, bytes] = {}
    for text in texts:
        words = text.split()
        shingles = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        first.setdefault(min(map(zlib.crc32, shingles)), text)
    return list(first.values())


def telling_words(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Words many times more frequent in toxic documents."""
    found, others = (Counter(w for text in texts for w in set(words_of(text))) for texts in (toxic, ordinary))
    least = max(MIN_DOCS, MIN_SHARE * len(toxic))

    def rate(word: bytes) -> float:
        return found[word] * max(1, len(ordinary)) / ((others[word] + 0.5) * max(1, len(toxic)))

    return {w for w, n in found.items() if n >= least and len(w) >= MIN_BYTES and rate(w) >= RATIO}


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary's content, trained on the samples; joined samples where they are too few."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, window_log=WINDOW_LOG, min_match=MIN_MATCH,
            write_content_size=False, write_dict_id=False,
        )
        return [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(
                    content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
                compression_params=params,
            )
            for content in (self.ordinary, self.toxic)
        ]


def windows(n_bytes: int) -> np.ndarray:
    """Start and length of overlapping windows that cover all bytes."""
    starts = np.arange(0, max(n_bytes - (WINDOW - STEP), 1), STEP)
    return np.column_stack([starts, np.minimum(WINDOW, n_bytes - starts)]).astype(np.uint64)


def distances(text: bytes, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes saved by the toxic dictionary in each window."""
    if not text:
        return np.zeros(1)
    segments = zstandard.BufferWithSegments(text.lower(), windows(len(text)).tobytes())
    sizes = [_compressed_sizes(c, segments) for c in compressors]
    return sizes[0] - sizes[1]


def _compressed_sizes(compressor: zstandard.ZstdCompressor, segments) -> np.ndarray:
    found = compressor.multi_compress_to_buffer(segments)
    return np.fromiter((len(part) for part in found), np.int64, len(found))


def features_of(saved: np.ndarray) -> np.ndarray:
    """The largest distances of a document, how many windows are hits, and the means."""
    top = np.sort(saved)[::-1][:TOP]
    top = np.pad(top, (0, TOP - len(top)))
    hits = saved >= BEYOND
    return np.array([*top[:3], top.mean(), np.log1p(hits.sum()), hits.mean(), saved.mean()])


def dictionaries(sample: list[tuple[bytes, int]]) -> ToxicityModel:
    """Both dictionaries, trained by zstandard; the toxic one in front of the ordinary content.

    Offsets into the shared content are then the same for both.
    """
    toxic = unlike([text for text, label in sample if label])
    ordinary = unlike([text for text, label in sample if not label])
    pieces = [t.lower()[i : i + 256] for t in ordinary for i in range(0, len(t), 256)]
    base = trained(pieces, DICTIONARY_BYTES)
    telling = telling_words(toxic, ordinary)
    samples = [b" " + word + b" " for text in toxic for word in words_of(text) if word in telling]
    return ToxicityModel(base, trained(samples, DICTIONARY_BYTES) + base)


def fit(sample: list[tuple[bytes, int]]) -> ToxicityModel:
    """Dictionaries from the sample, and weights from parts of it that others' dictionaries compress."""
    features, labels = [], []
    for fold in range(FOLDS):
        compressors = dictionaries([p for i, p in enumerate(sample) if i % FOLDS != fold]).compressors()
        for text, label in sample[fold::FOLDS]:
            features.append(features_of(distances(text, compressors)))
            labels.append(float(label))
    x, y = np.array(features).reshape(-1, FEATURES), np.array(labels)
    mean, scale, w = fit_logistic(x, y)
    w[-1] += np.log(CUT / (1 - CUT)) - _best_cut((x - mean) / scale @ w[:-1] + w[-1], y)
    model = dictionaries(sample)
    return ToxicityModel(model.ordinary, model.toxic, (mean, scale, w))


def _best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """Where to cut the logits: most hits, with a false alarm rate counting double."""
    if len(set(labels.tolist())) < 2:
        return float(np.log(CUT / (1 - CUT)))  # nothing to cut: scores stay as they are
    values = np.unique(logits)
    cuts = np.concatenate([values[:1] - 1, (values[1:] + values[:-1]) / 2])
    hits = 1 - np.searchsorted(np.sort(logits[labels == 1]), cuts) / (labels == 1).sum()
    alarms = 1 - np.searchsorted(np.sort(logits[labels == 0]), cuts) / (labels == 0).sum()
    return float(cuts[np.argmax(hits - 2 * alarms)])


def score_documents(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score of each row, as a written table."""
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            rows_of = [
                features_of(distances(text, compressors)) for text in bytes_of(batch)
            ]
            scores = logistic(np.array(rows_of).reshape(-1, FEATURES), model.weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=schema.names)

    return staged_batches(map_batches(rows, score, schema), "toxicity")


def toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 3, held_out: int = 1,
    threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = fit(labelled_sample(docs, labels, label, divisor, held_out, id_col, text_col))
    scored = score_documents(docs, model, id_col, text_col)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
