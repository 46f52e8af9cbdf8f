import math
import random
import re

import numpy as np
import pytest

from segmart.llm import attention, lm_scoring
from segmart.llm.common import PIECE_BYTES
from segmart.llm.tokens import TextEncoder
from segmart.llm.word_ids import WordEncoder, word_groups, words_of


def _texts():
    long = " ".join(f"Word{i % 977}" for i in range(PIECE_BYTES // 4))
    return [
        text.encode() for text in (
            "", " \t\n\x0b", "one", "Two  WORDS two words.", "no\xa0break  and  wide ", "a\x1cb \x1c c", long,
            "it's <|endoftext|> x", "Ünïcode \U0001f642 ünï", "x" * 63 + " " + "x" * 64 + " " + "x" * 65, "  lead 12 345's",
        )
    ]


def test_words_are_equal_where_their_hashes_are():
    rng = random.Random(1)
    words = ["".join(rng.choices("abAB\x00é", k=rng.randint(1, 70))) for _ in range(3000)]
    text = "".join(word + rng.choice([" ", "\n", "\t\r "]) for word in words)
    found = words_of([text.encode(), b"", b" " + text.encode()])
    lower = [word.encode().lower() for word in words]
    assert found.words(np.arange(len(words))) == lower
    assert found.owner.tolist() == [0] * len(words) + [2] * len(words)
    assert np.array_equal(found.hashes[: len(words)], found.hashes[len(words) :])
    assert len({*zip(lower, found.hashes.tolist())}) == len(set(lower)) == len(set(found.hashes.tolist()))


def test_a_long_text_has_all_its_words():
    texts = _texts()
    n_words = np.zeros(len(texts), int)
    for words, text_of, _ in word_groups(texts):
        n_words += np.bincount(text_of[words.owner], minlength=len(texts))
    assert n_words.tolist() == [len(re.findall(rb"[^\x20\x09-\x0d]+", text)) for text in texts]


def test_ids_from_words_equal_those_of_whole_texts(vocabulary):
    texts, plain = _texts(), vocabulary.encoder()
    wanted = [
        np.frombuffer(plain.ids(b" ".join(text.lower().split()).decode()), "<u4").astype("<u2").tobytes() for text in texts
    ]
    encoder = WordEncoder(vocabulary, np.dtype("<u2"))
    assert lm_scoring.subwords_of(encoder, texts) == wanted
    assert lm_scoring.subwords_of(encoder, texts[::-1]) == wanted[::-1]
    assert [encoder.whole(text.lower()) for text in texts] == [i in (4, 5, 7) for i in range(len(texts))]


def test_each_word_is_encoded_once(vocabulary, monkeypatch):
    encoder, sizes, encode = WordEncoder(vocabulary, np.dtype("<u2")), [], TextEncoder.ids
    monkeypatch.setattr(TextEncoder, "ids", lambda self, text: sizes.append(len(text)) or encode(self, text))
    text = b"the same words again and " * 400
    lm_scoring.subwords_of(encoder, [text] * 20)
    lm_scoring.subwords_of(encoder, [text] * 20)
    assert sum(sizes) < 250  # first words, and five others once


@pytest.mark.parametrize("length", [1, 16, 17, 75])
def test_scores_equal_a_plain_loop(length):
    rng = np.random.default_rng(length)
    w = attention.Weights.initial()
    w.distance[:] = rng.normal(0, 1, w.distance.shape)
    vectors = rng.normal(0, 0.5, (202, attention.SIZE)).astype(np.float32)
    class_of = rng.integers(0, attention.CLASSES, 201)
    follow = np.log(rng.dirichlet(np.ones(attention.CLASSES), attention.CLASSES + 1)).astype(np.float32)
    model = lm_scoring.LanguageModel(class_of, follow, follow, w.flat(), vectors)
    text = np.append(rng.integers(0, 200, length - 1), 200)
    windows = model.windows([rng.integers(0, 200, 40), text])
    scorer = attention.Scorer(w, follow, model.classes, vectors)
    found = scorer.log_probabilities(windows)[windows.owner == 1].ravel()[:length]
    inputs = [201, *text[:-1].tolist()]  # what each subword is predicted from, last
    for i, target in enumerate(text.tolist()):
        seen = range(max(0, i - i % attention.STEP - attention.CONTEXT), i + 1)
        x = {p: w.embedding[model.classes[inputs[p]]] + vectors[inputs[p]] for p in seen}
        weight = {
            p: math.exp((x[i] @ w.query) @ (x[p] @ w.key) / math.sqrt(attention.SIZE) + w.distance[i - p]) for p in seen
        }
        mean = sum(weight[p] * (x[p] @ w.value) for p in seen) / sum(weight.values())
        logits = (x[i] + mean @ w.output) @ w.readout + follow[model.classes[inputs[i]]]
        logits = logits.astype(np.float64)
        wanted = logits[class_of[target]] - np.log(np.exp(logits).sum())
        assert found[i] == pytest.approx(wanted, abs=1e-4)
