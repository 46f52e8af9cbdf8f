"""Classifiers on held-out documents, language-model scores against counts by hand."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from segmart.llm import attention, lm_scoring, quality_classifier, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    return docs, labels


def held_out_rates(scored, labels, label, threshold):
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    hit = np.array([r.predicted for r in rows if r[label] == 1]).mean()
    alarm = np.array([r.predicted for r in rows if r[label] == 0]).mean()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    return hit, alarm


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    hit, alarm = held_out_rates(quality_classifier.quality(docs, labels), labels, "quality", 0.3)
    assert hit > 0.97 and alarm < 0.2


def test_toxicity_on_held_out_documents(tables):
    docs, labels = tables
    hit, alarm = held_out_rates(toxicity.toxicity(docs, labels), labels, "toxic", 0.7)
    assert hit > 0.7 and alarm < 0.1


@pytest.mark.parametrize("operator", [quality_classifier.quality, toxicity.toxicity])
def test_classifiers_take_odd_documents(spark, docs, odd_docs, operator):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)] + [(4, None, None)], LABELS)
    rows = operator(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    folds = {r.doc_id: r.held_out for r in rows}
    divisor, fold = (5, 0) if operator is quality_classifier.quality else (3, 1)
    assert all(folds[i] == (zlib.crc32(str(i).encode()) % divisor == fold) for i in range(1, 12))
    assert operator(docs(), labels).collect() == []
    assert {r.score for r in operator(odd_docs, labels.limit(0)).collect()} <= {0.0, 0.5}


def test_distances_equal_windows_compressed_one_by_one():
    ordinary = [f"an ordinary text of some words, number {i}, and so on".encode() for i in range(60)]
    toxic = [f"you wretch{i % 3} of a text, number {i}".encode() for i in range(30)]
    model = toxicity.dictionaries([(t, 0) for t in ordinary] + [(t, 1) for t in toxic])
    compressors = model.compressors()
    text = b"Here is an ordinary text, but WRETCH1 stands in it. " * 7
    wanted = []
    for start in range(0, len(text) - 32, 64):
        window = text.lower()[start : start + 96]
        sizes = [len(c.compress(window)) for c in compressors]
        wanted.append(sizes[0] - sizes[1])
    assert list(toxicity.distances(text, compressors)) == wanted and max(wanted) >= 3
    assert list(toxicity.distances(b"", compressors)) == [0]


def test_windows_and_chunks_cover_every_byte():
    for n in (1, 50, 96, 97, 64, 65, 160, 1000):
        spans = toxicity.windows(n)
        covered = np.zeros(n, bool)
        for start, length in spans:
            covered[int(start) : int(start + length)] = True
        assert covered.all()
    net = quality_classifier.fit([(b"abc", 1), (b"xyz", 0)], epochs=1)
    texts = [b"a" * 511, b"b" * 512 + b"c", b"d" * 5000, b"e"]
    assert all(0 <= net.score(t) <= 1 for t in texts)


def test_attention_is_causal_and_scores_each_once():
    rng = np.random.default_rng(0)
    weights = attention.Weights.initial()
    follow = np.zeros((attention.CLASSES + 1, attention.CLASSES), np.float32)
    texts = [rng.integers(0, attention.CLASSES, n) for n in (1, 16, 17, 100)]
    windows = attention.windows_of(texts)
    assert windows.target_mask.sum() == sum(map(len, texts))
    before = attention.log_probabilities(weights, follow, windows)
    changed = [t.copy() for t in texts]
    changed[3][60] = (changed[3][60] + 1) % attention.CLASSES
    after = attention.log_probabilities(weights, follow, attention.windows_of(changed))
    differs = np.flatnonzero(np.abs(before - after)[windows.owner == 3].ravel() > 1e-6)
    assert differs[0] == 60


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    weights = attention.Weights.initial()
    follow = np.zeros((attention.CLASSES + 1, attention.CLASSES), np.float32)
    windows = attention.windows_of([rng.integers(0, attention.CLASSES, n) for n in (5, 40, 100)])

    def loss():
        found = attention.log_probabilities(weights, follow, windows).astype(np.float64)
        return -found.sum() / windows.target_mask.sum()

    grads = attention._gradients(weights, follow, windows, np.arange(len(windows.inputs)))
    for array, grad in zip(weights.arrays(), grads, strict=True):
        place = np.unravel_index(np.argmax(np.abs(grad)), array.shape)
        value = array[place]
        array[place] = value + 1e-2
        up = loss()
        array[place] = value - 1e-2
        down = loss()
        array[place] = value
        assert (up - down) / 2e-2 == pytest.approx(grad[place], rel=0.05, abs=1e-5)


def test_classes_share_all_subwords():
    counts = np.random.default_rng(2).integers(0, 1000, 5000)
    class_of, share = lm_scoring.subword_classes(counts)
    assert len(np.unique(class_of)) == attention.CLASSES
    assert np.bincount(class_of, share) == pytest.approx(np.ones(attention.CLASSES))


def test_base_scores_equal_counts_by_hand(docs, odd_docs, vocabulary, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FREQUENT", 20)
    rows = lm_scoring.lm_scores(odd_docs, vocabulary).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(r.doc_id, (r.text or "")) for r in odd_docs.collect()]
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)) + [" end"]) for i, t in texts]
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in texts}
    counts = collections.Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    wanted = {
        (i, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4))
        for i, ws in tokens
    }
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows} == wanted
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    # The score is a mixture: above the base less what the other model's weight takes, and of no more than both.
    for r in rows:
        best = max(r.base_score, r.attention_score)
        assert best + math.log10(lm_scoring.LEAST_WEIGHT) <= r.score <= best + 1e-9
    assert len(rows) == len(set(texts))
    assert lm_scoring.lm_scores(docs(), vocabulary).collect() == []


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_rounds_train_on_every_window_of_every_document(rounds):
    random = np.random.default_rng(3)
    texts = [random.integers(0, attention.CLASSES, n) for n in [1, 5, 16, 17, 40, *range(1, 60), 900]]
    every = attention.windows_of(texts)
    parts = [lm_scoring.windows_of_round(texts, i, rounds) for i in range(rounds)]
    for name in ("inputs", "targets", "target_mask", "owner"):
        wanted = sorted(np.asarray(row).tobytes() for row in getattr(every, name))
        assert sorted(np.asarray(row).tobytes() for part in parts for row in getattr(part, name)) == wanted
    if rounds > 1:  # a document's windows have the same round in any block
        alone = lm_scoring.windows_of_round(texts[4:5], 1, rounds)
        assert np.array_equal(parts[1].inputs[parts[1].owner == 4], alone.inputs)


def test_held_out_scores_are_no_worse_than_the_better_model(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in lm_scoring.lm_scores(docs, vocabulary).collect() if r.held_out]
    n_tokens, score = sum(r.n_tokens for r in held), sum(r.score for r in held)
    assert len(held) > 100 and score > sum(r.attention_score for r in held)
    assert score > sum(max(r.base_score, r.attention_score) for r in held) - 0.001 * n_tokens


def test_the_model_reads_subwords_of_one_class_apart():
    """Which of two subwords of one class comes first tells what follows: only their ids say so."""
    random = np.random.default_rng(4)
    class_of = np.array([0, 0, 1, 2, 3])
    follow = np.zeros((attention.CLASSES + 1, attention.CLASSES), np.float32)
    rest = len(class_of)
    model = lm_scoring.LanguageModel(
        class_of, follow, follow, attention.Weights.initial().flat(), np.zeros((rest + 1, attention.SIZE), np.float32)
    )
    texts = [np.array([first, first + 2] * 8 + [4]) for first in random.integers(0, 2, 2000)]
    windows = model.windows(texts)
    assert (windows.ids[windows.input_mask] <= rest).all() and (windows.ids[:, attention.CONTEXT] == rest)[::2].all()
    trainer = attention.Trainer(attention.Weights.of_flat(model.weights), follow, 0.01, model.vectors)
    for _ in range(6):
        trainer.learn(windows)
    assert (trainer.met[[0, 1, 2, 3, rest]] > 0).all()
    scores = attention.log_probabilities(trainer.weights, follow, windows, trainer.vectors)
    follows = windows.target_mask & (windows.targets > 0) & (windows.targets < 3)
    assert np.exp(scores[follows].mean()) > 0.9


def test_gradients_of_subword_vectors_equal_differences():
    random = np.random.default_rng(5)
    weights = attention.Weights.initial()
    follow = np.zeros((attention.CLASSES + 1, attention.CLASSES), np.float32)
    subwords = [random.integers(0, 200, n) for n in (5, 40)]
    vectors = random.normal(0, 0.3, (201, attention.SIZE)).astype(np.float32)
    windows = attention.windows_of([t % attention.CLASSES for t in subwords], subwords, 200)

    def loss():
        found = attention.log_probabilities(weights, follow, windows, vectors).astype(np.float64)
        return -found.sum() / windows.target_mask.sum()

    _, d_x = attention._all_gradients(weights, follow, windows, np.arange(len(windows.inputs)), vectors)
    grad = np.zeros_like(vectors)
    np.add.at(grad, windows.ids.ravel(), d_x.reshape(-1, attention.SIZE))
    place = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
    vectors[place] += 1e-2
    up = loss()
    vectors[place] -= 2e-2
    assert (up - loss()) / 2e-2 == pytest.approx(grad[place], rel=0.05, abs=1e-5)
