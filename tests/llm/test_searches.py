"""Decontamination, hard negatives and lexical search against plain versions of them."""

import hashlib
import math
import random
import re

import pytest

from segmart.llm import decontamination, hard_negatives, lexical_search

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEMS = "item_id bigint, text string, doc_id string, n_words int, row int"


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(WORD, folded(text))


@pytest.fixture
def items(spark):
    def build(*pairs):
        return spark.createDataFrame([(i, text, "k", 1, 2) for i, text in pairs], ITEMS)

    return build


# -- decontamination --------------------------------------------------------------------

def plain_contamination(docs, items):
    windows = {}
    for item_id, text in items:
        ws = words(text)
        size = min(10, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[i : i + size]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    rows = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(ws) - size + 1):
                if (window := tuple(ws[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[window]
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        rows.append((doc_id, len(ws), len(hit), len(ids), digest, bool(hit)))
    return rows


def contamination_rows(docs, items):
    got = decontamination.contamination(docs, items).collect()
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got]


def test_contamination_equals_brute_force(docs, items):
    rng = random.Random(5)
    vocabulary = ["a", "B", "c7", "é", "the", "Long"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 30))) for _ in range(60)]
    leaks = [(i, texts[i]) for i in range(0, 40, 3)]
    found = [(i, "lead in, " + t + "; " + rng.choice(texts) + "!") for i, t in enumerate(texts)]
    wanted = plain_contamination(found, leaks)
    assert sum(r[2] for r in wanted) and sorted(map(repr, contamination_rows(docs(*found), items(*leaks)))) == sorted(
        map(repr, wanted)
    )


def test_contamination_of_odd_inputs(odd_docs, items):
    leaks = [
        (1, None), (2, ""), (3, "---"), (4, "ONE"), (5, "two words"), (6, "id at all"), (6, "another text under"),
        (7, " ".join(f"word{i % 977}" for i in range(2000, 2012))), (8, "row"), (8, "row"), (None, "repeated"),
        (9, "no such words here"), (10, "ünïcode"), (11, "Ünïcode"),
    ]
    pairs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    wanted = plain_contamination(pairs, leaks)
    assert {r[0] for r in wanted if r[5]} >= {4, 5, 6, 7, 9, 10, 11}
    assert sorted(map(repr, contamination_rows(odd_docs, items(*leaks)))) == sorted(map(repr, wanted))


def test_contamination_of_empty_tables(spark, docs, items, odd_docs):
    assert contamination_rows(odd_docs.limit(0), items((1, "one"))) == []
    assert not any(r[5] for r in contamination_rows(odd_docs, items((1, None))))


def test_a_full_bitmap_changes_no_result(docs, items, monkeypatch):
    monkeypatch.setattr(decontamination, "SLOT_BITS", 7)  # 128 bits for some hundred fingerprints
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcdefgh", k=40)) for _ in range(30)]
    found = list(enumerate(texts[10:] + [" ".join(t.split()[7:25]) for t in texts]))
    leaks = list(enumerate(texts[:20]))
    assert sorted(contamination_rows(docs(*found), items(*leaks))) == sorted(plain_contamination(found, leaks))


def test_spans_of_long_texts_meet_across_pieces(docs, items, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE_BYTES", 16)
    text = " ".join(f"w{i}" for i in range(200))
    got = contamination_rows(docs((1, text)), items((1, " ".join(f"W{i}" for i in range(50, 90)))))
    assert got[0][1:4] == (200, 40, 1)


# -- hard negatives ---------------------------------------------------------------------

def plain_negatives(rows):
    taking = [
        (i, vec_id, label, [math.floor(256 * x) for x in vector])
        for i, (vec_id, vector, label) in enumerate(rows)
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    last = lambda x: math.inf if x is None else x
    found = []
    for a, anchor_id, label, anchor in taking:
        if anchor_id is None or anchor_id % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(anchor, vector)), last(vec_id), i, vec_id, other)
            for i, vec_id, other, vector in taking if i != a
        ]
        for positive in sorted(s for s in scored if s[4] == label)[:5]:
            least, most = 30 * -positive[0], 90 * -positive[0]
            window = sorted(s for s in scored if s[4] != label and least <= 100 * -s[0] <= most)[:10]
            found += [(anchor_id, positive[3], k + 1, n[3], -positive[0], -n[0]) for k, n in enumerate(window)]
    return found


VECTORS = "vec_id bigint, embedding array<float>, label int, number string, part int, ids int, a_ids int"


def negative_rows(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], VECTORS)
    got = hard_negatives.hard_negatives(df).collect()
    return [tuple(r[c] for c in (
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got]


def as_float(x):
    import numpy as np

    return float(np.float32(x))


@pytest.mark.parametrize("step", [1.0, 0.01])
def test_negatives_equal_brute_force(spark, monkeypatch, step):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 32)
    monkeypatch.setattr(hard_negatives, "PART_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "GROUP_PARTS", 2)
    rng = random.Random(7)
    rows = []
    for i in range(400):
        vector = [as_float(round(rng.gauss(0.3, 1) / step) * step / 4) for _ in range(6)]
        rows.append((i if i % 9 else 100 * (i // 9), vector, rng.randrange(4)))  # many anchors, repeated ids
    rows += [(1000 + i, [0.5] * 6, i % 4) for i in range(60)]  # equal vectors
    wanted = plain_negatives(rows)
    assert wanted and sorted(negative_rows(spark, rows)) == sorted(wanted)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 1), (3, [0.75, 0.25], 2), (4, [0.5], 2), (5, [], 2),
        (6, None, 2), (7, [1.0, None], 2), (8, [nan, 1.0], 2), (9, [inf, 1.0], 1), (10, [0.7, 0.2], None),
        (None, [0.75, 0.25], 2), (None, [0.5, 0.5], 1), (11, [0.75, 0.25], 2), (11, [0.75, 0.25], 2),
        (100, [0.0, 0.0], 1), (200, [-1.0, -0.5], 3), (200, [-1.0, -0.5], 3), (300, [1.0, 1.0, 1.0], 9),
    ]
    wanted = plain_negatives(rows)
    assert {r[0] for r in wanted} >= {0, 100}
    assert sorted(map(repr, negative_rows(spark, rows))) == sorted(map(repr, wanted))
    assert negative_rows(spark, []) == []
    assert negative_rows(spark, [(0, None, None)]) == []


def test_scores_beyond_doubles_and_beyond_64_bits(spark):
    rows = [(0, [2.0**22, 3.0], 1), (1, [2.0**22, 1.0], 1), (2, [2.0**21, 5.0], 2), (3, [2.0**21, 7.0], 2)]
    assert sorted(negative_rows(spark, rows)) == sorted(plain_negatives(rows))
    with pytest.raises(Exception, match="64 bits"):
        negative_rows(spark, [(0, [1e30], 1), (1, [1e30], 1)])


def test_reading_stops_before_the_end_of_the_lists():
    import numpy as np

    vectors = np.outer(np.arange(10_000), np.ones(4, np.int64))
    block = hard_negatives.SortedBlock(np.arange(10_000), np.arange(10_000), vectors)
    met, best = [], hard_negatives.Best(5)
    block.met(
        np.array([1, 2, 0, 1]), lambda: int(best.scores[-1]) if best.full() else hard_negatives.NO_SCORE,
        lambda rows, scores: (met.extend(rows), best.add(scores, block.ids[rows], block.numbers[rows])),
    )
    assert list(best.ids) == [9999, 9998, 9997, 9996, 9995] and len(met) < 6_000


# -- lexical search ---------------------------------------------------------------------

def plain_search(docs, items, top):
    texts = [(doc_id, words(text)) for doc_id, text in docs]
    texts = [(doc_id, ws) for doc_id, ws in texts if ws]
    n_docs, n_terms = len(texts), sum(len(ws) for _, ws in texts)
    queries = {}
    for item_id, text in items:
        queries.setdefault(item_id, set()).update(words(text))
    rows = []
    for item_id, terms in queries.items():
        scored = []
        for doc_id, ws in texts:
            m, score = 50 + 50 * len(ws) * n_docs // n_terms, 0
            for term in terms:
                if tf := ws.count(term):
                    df = sum(term in other for _, other in texts)
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += weight * (10**9 * tf // (1000 * tf + 20 * m))
            if score:
                scored.append((-score, math.inf if doc_id is None else doc_id, doc_id))
        ranked = sorted(scored, key=lambda s: s[:2])[:top]
        rows += [(item_id, k + 1, doc_id, -score) for k, (score, _, doc_id) in enumerate(ranked)]
    return rows


def search_rows(docs, items, top=50):
    got = lexical_search.search(docs, items, top).collect()
    return sorted(map(repr, ((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got)))


@pytest.mark.parametrize("top, shard, block", [(3, 16_384, 500_000), (5, 7, 20), (50, 7, 500_000)])
def test_search_equals_brute_force(docs, items, monkeypatch, top, shard, block):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    rng = random.Random(8)
    vocabulary = [f"T{i}" for i in range(40)]
    odds = [1 / (i + 1) for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, odds, k=rng.randrange(60))) for _ in range(120)]
    pairs = list(enumerate(texts)) + [(500 + i, texts[i]) for i in range(30)]  # ties
    asked = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 9)))) for i in range(12)]
    assert search_rows(docs(*pairs), items(*asked), top) == sorted(map(repr, plain_search(pairs, asked, top)))


def test_search_of_odd_inputs(odd_docs, items):
    asked = [
        (1, None), (2, ""), (3, "?!"), (4, "TWO words"), (5, "unknown"), (6, "row Word3 nine"), (6, "text"), (None, "id"),
        (7, "ünïcode x"), (7, "x"),
    ]
    pairs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    wanted = sorted(map(repr, plain_search(pairs, asked, 50)))
    assert wanted and search_rows(odd_docs, items(*asked)) == wanted
    assert search_rows(odd_docs.limit(0), items(*asked)) == []
    assert search_rows(odd_docs, items((1, None))) == []


def test_accumulators_stop_and_survivors_are_exact():
    import numpy as np

    places = np.arange(100)
    rare = (9, np.arange(3), np.array([90, 80, 70]), 90)
    common = (1, places, np.full(100, 5), 5)
    scores = lexical_search.term_at_a_time([common, rare], 100, 0, 2)
    assert list(scores[:4]) == [815, 725, 635, 0]  # 3 has no accumulator; the survivors got the common term
    assert list(lexical_search.best(scores, places, 2)) == [0, 1]
