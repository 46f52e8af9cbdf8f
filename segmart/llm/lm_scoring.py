"""Language-model scoring: a count-based base and a causal self-attention model.

The base is the add-one unigram over words. Words are counted over all learning documents
by one aggregation. Words that make up a fixed share of all tokens, at most `FREQUENT` of
them by counting, are sent to the tasks; the rest of each document's words meet their
counts in a shuffled join, and unknown words add nothing to either sum.

The model reads subword ids of the lower-cased words, joined by spaces, and one end id.
It embeds the ids themselves and predicts the next one as a class and its share of it.
Its counts (subwords, and classes after classes) cover all learning documents. Its
weights and the vectors of all subwords are trained on every window of every learning document, each in one of `ROUNDS`
rounds: each task descends from the common weights over its own windows of the round, and
the weights are averaged by the windows seen, a subword's vector by how often it was met. So what is learnt from grows with the
corpus, while what reaches the driver is bounded by the vocabulary and the model.

The score is the probability of a text under a mixture of the attention model and the base: the
first knows what follows what, the second knows whole words. The attention model's weight is the
mean of its posterior over the learning documents, from equal weights: one step of expectation
maximisation. `attention_score` has the attention model alone.

Defined results: null and empty texts are the end alone. Rows equal in id and text are one
document with one result row. Without learning documents N and V are 0 and scores finite.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.attention import CLASSES, SIZE, Scorer, Trainer, Weights, Windows, windows_of
from segmart.llm.common import bytes_of, id_and_text, map_batches, remainder, row_key, staged_batches
from segmart.llm.tokens import Vocabulary
from segmart.llm.word_ids import WordEncoder, Words, word_groups
from segmart.session import staged

FREQUENT = 65_536
ROUNDS = 2
RATE = 0.01
SMOOTHING = 10.0
BLOCK_IDS = 200_000
COUNTED_IDS = 4_000_000  # counted at once
COUNTED_WORDS = 2_000_000
END_WORD = xxhash.xxh3_64_intdigest(b" end")  # no word has a space
END = np.array([END_WORD], np.uint64)
LEAST_WEIGHT = 1e-6  # of either model
LN10 = float(np.log(10))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _word_counts(learning: DataFrame) -> DataFrame:
    """hash and c, the count of each word in the learning documents, as a written table."""
    def counted(hashes: list[np.ndarray], n_texts: int) -> pa.RecordBatch:
        distinct, n = np.unique(np.concatenate([*hashes, END]), return_counts=True)
        n[np.searchsorted(distinct, END[0])] += n_texts - 1
        return pa.RecordBatch.from_arrays([_signed(distinct), pa.array(n)], names=["hash", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, n_words, n_texts = [], 0, 0
        for batch in batches:
            texts = bytes_of(batch)
            n_texts += len(texts)
            for words, _, _ in word_groups(texts):
                hashes.append(words.hashes)
                n_words += len(words.hashes)
                if n_words >= COUNTED_WORDS:
                    yield counted(hashes, n_texts)
                    hashes, n_words, n_texts = [], 0, 0
        if n_texts or hashes:
            yield counted(hashes, n_texts)

    each = map_batches(learning.select("text"), count, "hash bigint, n bigint")
    return staged_batches(each.groupBy("hash").agg(F.sum("n").alias("c")), "word-counts")


@dataclass(frozen=True)
class FrequentWords:
    """Hashes, sorted, and counts of the words sent to the tasks."""

    hashes: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, total: int) -> FrequentWords:
        rows = counts.where(F.col("c") * FREQUENT >= total).collect()
        hashes = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(hashes)
        return cls(hashes[order], np.array([r["c"] for r in rows], np.int64)[order])

    def counts_of(self, hashes: np.ndarray) -> np.ndarray:
        """Their counts, 0 for words that are not frequent."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.counts[place], 0)


class _Ids:
    """Subword ids of some texts, whose words come group by group."""

    def __init__(self, encoder: WordEncoder, texts: list[bytes]) -> None:
        self._encoder, self._texts = encoder, texts
        self._whole = np.array([encoder.whole(text.lower()) for text in texts], bool)
        self._parts: list[list[bytes]] = [[] for _ in texts]

    def add(self, words: Words, text_of: np.ndarray) -> None:
        owner = text_of[words.owner]
        first = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
        first &= np.array([not any(parts) for parts in self._parts], bool)[owner]
        found, n_ids = self._encoder.ids(words, first, self._whole[owner])
        stops = np.cumsum(np.bincount(owner, n_ids, len(self._texts)).astype(np.int64))
        for i in np.unique(text_of).tolist():
            self._parts[i].append(found[stops[i - 1] if i else 0 : stops[i]].tobytes())

    def all(self) -> list[bytes]:
        for i in np.flatnonzero(self._whole):
            self._parts[i] = [self._encoder.whole_ids(self._texts[i].lower())]
        return list(map(b"".join, self._parts))


def subwords_of(encoder: WordEncoder, texts: list[bytes]) -> list[bytes]:
    """The subword ids of texts, A-Z in lower case and words joined by one space."""
    ids = _Ids(encoder, texts)
    for words, text_of, _ in word_groups(texts):
        ids.add(words, text_of)
    return ids.all()


def _encoded(rows: DataFrame, frequent: FrequentWords, vocabulary: Vocabulary) -> DataFrame:
    """Per document its subword ids and the base's part of frequent words, as a written table."""
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("key", T.LongType()),
        T.StructField("held_out", T.BooleanType()), T.StructField("part", T.DoubleType()),
        T.StructField("known", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    narrow = np.dtype("<u2" if vocabulary.size() < 1 << 16 else "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocabulary, narrow)
        of_end = int(frequent.counts_of(END)[0])
        for batch in batches:
            texts = bytes_of(batch)
            ids = _Ids(encoder, texts)
            part = np.full(len(texts), np.log10(of_end + 1.0))
            known = np.full(len(texts), int(of_end > 0))
            n_tokens = np.ones(len(texts), np.int64)
            for words, text_of, _ in word_groups(texts):
                owner = text_of[words.owner]
                distinct, _, inverse = words.distinct
                counts = frequent.counts_of(distinct)
                logs, counts = np.log10(counts + 1.0)[inverse], counts[inverse]
                n_tokens += np.bincount(owner, minlength=len(texts))
                known += np.bincount(owner, counts > 0, len(texts)).astype(np.int64)
                part += np.bincount(owner, logs, len(texts))
                ids.add(words, text_of)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(part), pa.array(known), pa.array(n_tokens),
                 pa.array(ids.all(), pa.binary())],
                names=schema.names,
            )

    encoded = map_batches(rows.select("doc_id", "key", "held_out", "text"), encode, schema)
    return staged_batches(encoded, "subwords", **{"spark.sql.parquet.compression.codec": "zstd"})


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of a word and its owner, and how often each is there."""
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    starts = np.flatnonzero(new)
    return hashes[starts], owner[starts], np.diff(np.append(starts, len(hashes)))


def _rare_parts(rows: DataFrame, frequent: FrequentWords, counts: DataFrame, distinct: bool) -> DataFrame:
    """key, part and known of the words that are not frequent, per document that has any."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, text_of, number in word_groups(bytes_of(batch)):
                chosen = np.flatnonzero(frequent.counts_of(words.hashes) == 0)
                hashes, owner, n = _distinct(words.hashes[chosen], words.owner[chosen])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text_of[owner])), pa.array(number[owner].astype(np.int32)),
                     _signed(hashes), pa.array(n.astype(np.int32))],
                    names=["key", "piece", "hash", "n"],
                )
            if not frequent.counts_of(END)[0]:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(batch.num_rows, -1, np.int32)),
                     _signed(END.repeat(batch.num_rows)), pa.array(np.ones(batch.num_rows, np.int32))],
                    names=["key", "piece", "hash", "n"],
                )

    rare = map_batches(rows.select("key", "text"), emit, "key bigint, piece int, hash bigint, n int")
    rare = rare.distinct() if distinct else rare
    known = rare.join(counts, "hash").select("key", "n", (F.col("n") * F.log10(F.col("c") + 1)).alias("part"))
    per_document = known.groupBy("key").agg(
        F.sum("part").alias("rare_part"), F.sum("n").cast("bigint").alias("rare_known")
    )
    return staged_batches(per_document, "rare-words")


def with_end(ids: bytes, narrow: np.dtype, end: int) -> np.ndarray:
    return np.append(np.frombuffer(ids, narrow), np.array([end], narrow if end < 1 << 16 else np.int64))


@dataclass(frozen=True)
class LanguageModel:
    class_of: np.ndarray  # subword -> class
    share: np.ndarray  # class before, subword -> natural log of its share of its class there
    follow: np.ndarray  # class before, class -> natural log of its share
    weights: np.ndarray
    vectors: np.ndarray  # subword -> vector; one more row for the start of a text

    def subwords(self, ids: bytes, narrow: np.dtype) -> np.ndarray:
        """A text's subwords and its end, the last id of all."""
        return with_end(ids, narrow, len(self.class_of) - 1)

    @cached_property
    def classes(self) -> np.ndarray:
        """Classes of all subwords and of the start of a text."""
        return np.append(self.class_of, CLASSES).astype(np.uint8)

    def windows(self, block: list[np.ndarray], only: tuple[int, int] | None = None) -> Windows:
        """The windows of texts given as subwords with their ends, or those of a round: see `windows_of`."""
        return windows_of([], block, len(self.class_of), self.classes, only)

    def shares_of(self, block: list[np.ndarray]) -> np.ndarray:
        """Per text, natural log of the shares of all its subwords, its end too, within their classes."""
        subwords, starts = _joined(block)
        cells = _before(self.class_of, subwords, starts)
        cells *= self.share.shape[1]
        cells += subwords
        return np.add.reduceat(self.share.ravel().take(cells), starts, dtype=np.float64)


def _joined(block: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of texts, none of them empty, one after the other, and where each text starts."""
    return np.concatenate(block), np.cumsum([0, *(len(text) for text in block[:-1])])


def _before(class_of: np.ndarray, subwords: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class before each subword."""
    before = np.empty(len(subwords), np.int64)
    before[1:] = class_of[subwords[:-1]]
    before[starts] = CLASSES
    return before


def subword_classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes by descending count: half hold one subword each, half an equal part of the rest.

    With the share of each subword in its class.
    """
    order = np.argsort(-counts, kind="stable")
    single = CLASSES // 2
    class_of = np.empty(len(counts), np.int64)
    class_of[order[:single]] = np.arange(min(single, len(order)))
    rest = counts[order[single:]] + 1.0
    before = np.cumsum(rest) - rest
    class_of[order[single:]] = single + (before * (CLASSES - single) / max(rest.sum(), 1)).astype(np.int64)
    class_of = np.minimum(class_of, CLASSES - 1)
    totals = np.bincount(class_of, counts + 1.0, CLASSES)
    return class_of, (counts + 1.0) / totals[class_of]


def _summed(encoded: DataFrame, size: int, cells_of) -> np.ndarray:
    """Counts of cells 0 to size-1 over all rows; `cells_of` counts those of a few texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += cells_of(batch.column(0).to_pylist())
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    each = map_batches(encoded.select("ids"), count, "cell bigint, n bigint")
    found = np.zeros(size, np.int64)
    table = staged_batches(each.groupBy("cell").agg(F.sum("n").alias("n")), "cells").toArrow()
    found[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return found


def _blocks(texts: list[np.ndarray], limit: int = BLOCK_IDS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Consecutive texts with a bounded number of subwords together, and where they start."""
    start, n = 0, 0
    for i, text in enumerate(texts):
        n += len(text)
        if n >= limit or i + 1 == len(texts):
            yield start, texts[start : i + 1]
            start, n = i + 1, 0


def windows_of_round(block: list[np.ndarray], round_no: int, rounds: int) -> Windows:
    """The windows of one round, of texts given as classes: see `windows_of`."""
    return windows_of(block, only=(round_no, rounds))


def _averaged(
    encoded: DataFrame, model: LanguageModel, narrow: np.dtype, round_no: int, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and vectors after one round: every task trains on its documents, all are averaged."""
    model = replace(model, share=model.follow)  # no shares here
    columns = [f"v{i}" for i in range(SIZE)]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(
            Weights.of_flat(model.weights), model.follow, RATE / (1 + round_no), model.vectors
        )
        for batch in batches:
            texts = [model.subwords(ids, narrow) for ids in batch.column(0).to_pylist()]
            for _, block in _blocks(texts):
                trainer.learn(model.windows(block, (round_no, rounds)))
        if trainer.seen:
            flat = trainer.weights.flat().reshape(-1, SIZE)
            met = np.flatnonzero(trainer.met)
            rows = np.concatenate([flat, trainer.vectors[met]]).astype(np.float64)
            seen = np.concatenate([np.full(len(flat), trainer.seen), trainer.met[met]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.arange(len(flat)), len(flat) + met])), pa.array(seen),
                 *map(pa.array, np.ascontiguousarray((rows * seen[:, None]).T))],
                names=["row", "seen", *columns],
            )

    schema = ", ".join(["row bigint", "seen bigint", *(f"{c} double" for c in columns)])
    each = map_batches(encoded.select("ids"), train, schema)
    mean = each.groupBy("row").agg(*[(F.sum(c) / F.sum("seen")).alias(c) for c in columns])
    found = staged_batches(mean, "weights").toArrow()  # one row per subword and some of the weights
    n_flat = len(model.weights) // SIZE
    rows = np.concatenate([model.weights.reshape(-1, SIZE), model.vectors])
    if found.num_rows:
        rows[found["row"].to_numpy()] = np.column_stack([found[c].to_numpy() for c in columns])
    return rows[:n_flat].ravel(), rows[n_flat:]


def fit(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> LanguageModel:
    """A model of the documents in `encoded`, which has their subword ids."""
    n_ids = vocabulary.size()
    narrow = np.dtype("<u2" if n_ids < 1 << 16 else "<u4")

    def subwords(texts: list[bytes]) -> np.ndarray:
        counts = np.bincount(np.frombuffer(b"".join(texts), narrow), minlength=n_ids + 1)
        counts[n_ids] += len(texts)
        return counts

    class_of, overall = subword_classes(_summed(encoded, n_ids + 1, subwords))

    def pairs(texts: list[bytes]) -> np.ndarray:
        total = np.zeros((CLASSES + 1) * (n_ids + 1), np.int64)
        for _, block in _blocks([with_end(ids, narrow, n_ids) for ids in texts], COUNTED_IDS):
            after, starts = _joined(block)
            cells = _before(class_of, after, starts)
            cells *= n_ids + 1
            cells += after
            total += np.bincount(cells, minlength=len(total))
        return total

    # Bounded by the vocabulary: one number per class and subword.
    counts = _summed(encoded, (CLASSES + 1) * (n_ids + 1), pairs).reshape(CLASSES + 1, n_ids + 1)
    by_class = np.array([np.bincount(class_of, row, CLASSES) for row in counts])
    share = np.log((counts + SMOOTHING * overall) / (by_class[:, class_of] + SMOOTHING))
    prior = (by_class.sum(0) + 1) / (by_class.sum() + CLASSES)
    follow = np.log((by_class + SMOOTHING * prior) / (by_class.sum(1, keepdims=True) + SMOOTHING))
    model = LanguageModel(
        class_of, share.astype(np.float32), follow.astype(np.float32), Weights.initial().flat(),
        np.zeros((n_ids + 2, SIZE), np.float32),
    )
    for round_no in range(rounds):
        weights, vectors = _averaged(encoded, model, narrow, round_no, rounds)
        model = replace(model, weights=weights, vectors=vectors)
    return model


def score_documents(encoded: DataFrame, model: LanguageModel, narrow: np.dtype) -> DataFrame:
    """key and score, the log10 probability of each document under the model."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Weights.of_flat(model.weights), model.follow, model.classes, model.vectors)
        for batch in batches:
            texts = [model.subwords(ids, narrow) for ids in batch.column(1).to_pylist()]
            totals = np.zeros(len(texts))
            for start, block in _blocks(texts):
                windows = model.windows(block)
                found = scorer.log_probabilities(windows).sum(1, dtype=np.float64)
                totals[start : start + len(block)] = np.bincount(windows.owner, found, len(block))
                totals[start : start + len(block)] += model.shares_of(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals / LN10)], names=["key", "score"]
            )

    return staged_batches(map_batches(encoded.select("key", "ids"), score, "key bigint, score double"), "lm")


def lm_scores(
    docs: DataFrame, vocabulary: Vocabulary, divisor: int = 7, held_out: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per document."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
        (remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "text",
    )
    counts = _word_counts(rows.where(~F.col("held_out")))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = FrequentWords.of(counts, n)
    encoded = _encoded(rows, frequent, vocabulary)
    keys = encoded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rare = _rare_parts(rows, frequent, counts, distinct=not keys.isEmpty())
    model = fit(encoded.where(~F.col("held_out")), vocabulary)
    narrow = np.dtype("<u2" if vocabulary.size() < 1 << 16 else "<u4")
    scores = score_documents(encoded, model, narrow)
    whole = encoded.drop("ids").dropDuplicates(["key"])
    zero = F.lit(0).cast("bigint")
    part = F.col("part") + F.coalesce("rare_part", F.lit(0.0))
    base = part - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    attention = F.col("score")
    known = F.col("known") + F.coalesce("rare_known", zero)
    joined = staged(
        whole.join(rare, "key", "left").join(scores.dropDuplicates(["key"]), "key").select(
            "doc_id", "held_out", "n_tokens", known.alias("n_known"),
            F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"),
            attention.alias("attention_score"),
        ),
        "scores",
    )
    both = F.greatest("base_score", "attention_score")
    of_base = F.pow(F.lit(10.0), F.col("base_score") - both)
    of_attention = F.pow(F.lit(10.0), F.col("attention_score") - both)
    posterior = joined.where(~F.col("held_out")).agg(F.avg(of_attention / (of_attention + of_base))).first()[0]
    weight = min(max(0.5 if posterior is None else posterior, LEAST_WEIGHT), 1 - LEAST_WEIGHT)
    mixed = both + F.log10(weight * of_attention + (1 - weight) * of_base)
    return joined.withColumn("score", mixed)
