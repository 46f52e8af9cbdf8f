"""Jaccard join, substring de-duplication and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from segmart.llm import jaccard_join, substring_dedup
from segmart.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_components(pairs, k, percent):
    sets = [(i, brute_set(text, k)) for i, text in pairs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= percent * len(x | y) and x | y:
                root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[find(n)] = min([v for v in (least.get(find(n)), i) if v is not None], default=None)
    return sorted(repr((i, len(s), least[find(n)])) for n, (i, s) in enumerate(sets))


def family(seed, n_bases=6, n_copies=12, n_words=60):
    """Texts with few to many changed words, around the threshold on both sides."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n_bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 12, n_words, 4 * n_words]))]
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary).upper()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs, k, percent):
    pairs = family(percent)
    found = jaccard_join.jaccard_components(docs(*pairs), jaccard_join.Similarity(k, percent)).collect()
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in found) == brute_components(pairs, k, percent)


def test_components_of_odd_documents(odd_docs):
    pairs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = jaccard_join.jaccard_components(odd_docs, jaccard_join.Similarity(3, 90)).collect()
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in found) == brute_components(pairs, 3, 90)


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 400), st.integers(0, 10**6), st.sampled_from([80, 90]))
def test_linked_sets_share_an_entry(size, seed, percent):
    rule = jaccard_join.Similarity(3, percent)
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
    keep = a[rng.permutation(len(a))[: len(a) - rng.integers(0, 1 + rule.difference(2 * len(a)))]]
    b = np.unique(np.append(keep, rng.integers(0, 2**63, rng.integers(0, 1 + len(a) - len(keep))).astype(np.uint64)))
    if len(b) and rule.links(a, b) and not np.array_equal(a, b):
        # Whatever the ranks and the share of recurring shingles, which choose the kind of index.
        table = rng.integers(0, 3, 1 << 8)
        ranks_a, ranks_b = (table[(x & np.uint64(255)).astype(np.int64)] for x in (a, b))
        for share in (0.0, 0.3, 1.0):
            both = rule.index_entries(a, ranks_a, share), rule.index_entries(b, ranks_b, share)
            assert np.intersect1d(*both).size
    xor = jaccard_join.sketch(a) ^ jaccard_join.sketch(b)
    bits = sum(bin(int(x) & (2**64 - 1)).count("1") for x in xor)
    assert bits <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))


def test_long_documents_that_share_a_passage_are_ruled_out_before_their_texts_are_sent(docs, monkeypatch):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(400)]  # long enough to meet in the index, too short for a link
    texts = [passage + [f"{j}x{rng.random()}" for _ in range(2400)] for j in range(12)]
    texts += [[*text[:-40], *(f"y{i}" for i in range(40))] for text in texts[:3]]
    pairs = list(enumerate(" ".join(text) for text in texts))
    sent, group = [], jaccard_join._in_groups

    def counted(found):
        sent.append(found.count())
        return group(found)

    monkeypatch.setattr(jaccard_join, "_in_groups", counted)
    rule = jaccard_join.Similarity(k=5, percent=80)
    rows = jaccard_join.jaccard_components(docs(*pairs), rule).collect()
    found = sorted((r["doc_id"], r["component_id"]) for r in rows)
    assert found == [(i, i - 12 if i >= 12 else i) for i in range(15)]
    assert sum(sent) <= 6  # each of the three links, and one more comparison of its nodes at most


@pytest.mark.parametrize("size", [512, 513, 1000, 1024, 4096])
def test_fine_sketches_keep_links_across_lengths_and_drop_chance_pairs(spark, size):
    rng = np.random.default_rng(size)
    rule = jaccard_join.Similarity(k=5, percent=80)
    sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for n in (size, size, size + size // 4)]
    sets.append(np.sort(np.concatenate([sets[0], sets[2][: size // 4]])))  # links with the first one
    assert rule.links(sets[0], sets[3])
    rows = [(i, len(s), jaccard_join.fine_sketch(s).tolist()) for i, s in enumerate(sets)]
    involved = spark.createDataFrame(rows, "node bigint, size bigint, fine array<bigint>")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "u bigint, v bigint")
    kept = {(r["u"], r["v"]) for r in jaccard_join._finely_alike(pairs, involved, rule).collect()}
    either_short = {(0, 1), (0, 2)} if size <= 512 else set()  # these have the short sketch
    assert kept == {(0, 3)} | either_short


def test_index_entries_of_one_document_go_no_further(spark):
    rng = np.random.default_rng(3)
    own = [rng.integers(-(2**63), 2**63, 500).tolist() for _ in range(4)]
    common = rng.integers(-(2**63), 2**63, 20).tolist()
    rows = [(i, [*own[i], *(common if i < 3 else [])]) for i in range(4)] + [(4, [])]
    indexed = spark.createDataFrame(rows, "node bigint, entries array<bigint>")
    marks = jaccard_join.Bitmap.of(spark.createDataFrame([(e,) for e in common], "d1 bigint"))
    found = {(r["node"], r["entry"]) for r in jaccard_join._marked_entries(indexed, marks).collect()}
    wanted = {(i, e) for i in range(3) for e in common}
    assert wanted <= found and len(found) <= len(wanted) + 5


def test_allocation_follows_the_estimated_cost():
    few, many = jaccard_join.Similarity(3, 90), jaccard_join.Similarity(5, 80)
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**63, 395).astype(np.uint64) * np.uint64(2))
    ranks = np.zeros(395, np.int32)
    assert len(many.index_entries(hashes, ranks, 0.3)) == many.prefix(395) == 80
    assert len(few.index_entries(hashes, ranks, 0.3)) > few.prefix(395)
    ranks[:100] = 1  # in many documents: not among the first
    with_ranks = many.index_entries(hashes, ranks, 0.3)
    assert not np.intersect1d(with_ranks, many.index_entries(hashes[:100], np.zeros(100, np.int32), 0.3)).size


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 30)]
    edges = spark.createDataFrame([*chain, *star, (5, 5)], "u bigint, v bigint")
    found = {r.node: r.label for r in components(edges).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 30)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_near_copies_leave_one_row_each(docs, odd_docs):
    pairs = family(4)
    kept = jaccard_join.without_near_copies(docs(*pairs), corpus_pipeline.NEAR_COPIES)
    wanted = {x.split(", ")[-1].rstrip(")") for x in brute_components(pairs, 5, 80)}
    assert {str(r.doc_id) for r in kept.collect()} == wanted
    assert jaccard_join.without_near_copies(odd_docs, corpus_pipeline.NEAR_COPIES).columns == odd_docs.columns


PASSAGE = (
    "This passage has many words in it. It goes on for a while, as passages do! Does it end here? "
    "It does not, as there are more words than these. No, it has a last sentence of some length too."
)


def plain_units(text):
    """Bounds and words of each line's sentences, read word by word."""
    unit = []
    for match in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if unit and "\n" in text[unit[-1].end() : match.start()]:
            yield unit[0].start(), unit[-1].end(), [m.group().lower() for m in unit]
            unit = []
        unit.append(match)
        if match.group()[-1] in ".!?":
            yield unit[0].start(), unit[-1].end(), [m.group().lower() for m in unit]
            unit = []
    if unit:
        yield unit[0].start(), unit[-1].end(), [m.group().lower() for m in unit]


def brute_spans(pairs, min_words):
    seen, rows = set(), []
    order = sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0))
    for doc_id, text in order:
        run = []
        for start, stop, words in [*plain_units(text or ""), (0, 0, None)]:
            key = words and " ".join(words)
            if key and key in seen:
                run.append((start, stop, len(words)))
                continue
            if run and sum(r[2] for r in run) >= min_words:
                rows.append((doc_id, run[0][0], run[-1][1], sum(r[2] for r in run)))
            run = []
            seen.add(key)
    return sorted(rows)


def test_spans_equal_brute_force(docs):
    text = "No. One two (e.g. three) four?! Ünï\x0bx\n\nC d"
    words = substring_dedup.Words.of(text.encode())
    starts = words.characters()[0][words.unit_starts()]
    assert list(starts) == [a for a, _, _ in plain_units(text)] == [0, 4, 18, 32, 39]
    rng = random.Random(5)
    sentences = [" ".join(f"s{i}w{j}" for j in range(rng.randrange(2, 15))) + "." for i in range(60)]
    pairs = []
    for i in range(40):
        body = [rng.choice(sentences) if rng.random() < 0.3 else f"unique {i} {j} text." for j in range(12)]
        if i % 4 == 0:
            body.insert(rng.randrange(12), PASSAGE if i % 8 else PASSAGE.upper())
        pairs.append((i, rng.choice([" ", "\n"]).join(body)))
    found = substring_dedup.repeated_spans(docs(*pairs)).collect()
    assert sorted((r.doc_id, r.start, r.stop, r.n_words) for r in found) == brute_spans(pairs, substring_dedup.MIN_WORDS)


def brute_words(pairs, min_words=substring_dedup.MIN_WORDS, size=50):
    """Numbers of the words in windows that an earlier place has, or in runs of repeated units."""
    order = sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0))
    seen, gone = {}, set()
    for doc_id, text in order:
        words = text.lower().split()
        for i in range(len(words) - size + 1):
            owner, place = seen.setdefault(tuple(words[i : i + size]), (doc_id, i))
            if owner != doc_id or i - place >= size:
                gone |= {(doc_id, j) for j in range(i, i + size)}
    return gone | covered_words(pairs, [(i, a, b) for i, a, b, _ in brute_spans(pairs, min_words)])


def covered_words(pairs, spans):
    places = {i: [m.span() for m in re.finditer(r"\S+", text)] for i, text in pairs}
    return {(i, n) for i, a, b in spans for n, (x, y) in enumerate(places[i]) if x < b and y > a}


def test_long_repeats_are_found_wherever_they_start_and_end(docs):
    rng = random.Random(8)
    lines = "\n".join(" ".join(f"item{i}x{j}" for j in range(4)) for i in range(20))
    torn = " ".join(f"Torn{i}" for i in range(70))
    sentences = f"{' '.join(f'end{i}' for i in range(30))}. {' '.join(f'go{i}' for i in range(30))}"
    small = [f"v{i}" for i in range(4)]
    loose = lambda i, n: " ".join(f"own{i}w{j}" for j in range(n))
    pairs = []
    for i, passage in enumerate([lines, torn, sentences] * 4):
        inner = " ".join(passage.split(" ")[rng.randrange(3) :]) if i > 8 else passage
        pairs.append((i, f"{loose(i, 9)} start of {i}: {inner.upper() if i == 5 else inner} {loose(100 + i, rng.choice([3, 80]))}"))
    pairs.append((20, " ".join(rng.choice(small) for _ in range(400))))
    pairs.append((21, "same again " * 100))
    pairs.append((22, f"{loose(22, 7)} {loose(23, 60)} {loose(24, 5)} {loose(23, 60)} tail"))
    pairs.append((23, " ".join(f"own23w{j}" for j in range(49))))  # one word below the size
    pairs.append((24, " ".join(f"own23w{j}" for j in range(50))))
    found = substring_dedup.repeated_spans(docs(*pairs)).collect()
    spans = [(r.doc_id, r.start, r.stop) for r in found]
    wanted = brute_words(pairs)
    assert covered_words(pairs, spans) == wanted
    assert sum(r.n_words for r in found) == len(wanted)
    assert {i for i, _ in wanted} >= {3, 4, 5, 6, 7, 8, 21, 22, 24} and 23 not in {i for i, _ in wanted}


def test_short_repeats_of_whole_lines_and_sentences(docs):
    """Of 40 words that repeat in other surroundings, as lines or sentences of any length."""
    kinds = {
        "lines of 4": "\n".join(" ".join(f"a{i}b{j}" for j in range(4)) for i in range(10)),
        "lines of 13": "\n".join(" ".join(f"c{i}d{j}" for j in range(13)) for i in range(3)),
        "sentence of 40": " ".join(f"e{i}" for i in range(40)) + ".",
        "sentences of 2": " ".join(f"f{i} g{i}." for i in range(20)),
    }
    for passage in kinds.values():
        pairs = [(i, f"Lead {i} in here.\n{passage}\nOwn end of {i}") for i in range(4)]
        spans = [(r.doc_id, r.start, r.stop) for r in substring_dedup.repeated_spans(docs(*pairs)).collect()]
        places = {i: text.index(passage) for i, text in pairs}
        assert sorted(spans) == [(i, places[i], places[i] + len(passage)) for i in (1, 2, 3)]


def test_names_of_any_kind_pass_through_the_stage(spark):
    names = "doc_id long, text string, cuts int, key int, row int, start int, n_chars long, span int, keep_id int"
    passage = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(i, f"{passage} end{i}", 1, 2, 3, 4, 5, 6, 7) for i in range(2)], names)
    out = sorted(substring_dedup.without_repeats(rows).collect())
    assert out[0] == rows.where("doc_id = 0").first() and out[1].row == 3
    assert out[1].text == " end1" and out[1].n_chars == 5 and out[1].cuts == 1 and out[1].keep_id == 7


def test_full_bitmaps_and_null_ids_change_no_span(docs, monkeypatch):
    rng = random.Random(9)
    lines = [" ".join(f"l{i}w{j}" for j in range(rng.randrange(1, 9))) for i in range(50)]
    pairs = [(i if i % 7 else None, "\n".join(rng.choices(lines, k=25))) for i in range(40)]
    wanted = sorted(map(repr, substring_dedup.repeated_spans(docs(*pairs)).drop("key").collect()))
    monkeypatch.setattr(substring_dedup, "SLOT_BITS", 7)
    assert sorted(map(repr, substring_dedup.repeated_spans(docs(*pairs)).drop("key").collect())) == wanted
    known = [(i, text) for i, text in pairs if i is not None]
    found = substring_dedup.repeated_spans(docs(*known)).collect()
    spans = [(r.doc_id, r.start, r.stop) for r in found]
    assert covered_words(known, spans) == brute_words(known)


def test_passages_are_cut_where_they_repeat(docs):
    first, second = f"Before é\U0001f642 x. {PASSAGE} After.", f"Other start without end {PASSAGE}\nTail"
    rows = docs((1, first), (2, second), (3, None), (4, ""), (5, "A short one."), (6, "A short one."))
    out = {r.doc_id: r for r in substring_dedup.without_repeats(rows).collect()}
    assert out[1].text == first and out[5].text == out[6].text == "A short one."
    assert out[2].text == "Other start without end This passage has many words in it. \nTail"
    assert out[3].text is None and out[4].text == "" and out[2].key == "k"


def test_substring_stage_of_odd_documents(odd_docs, docs):
    kept = substring_dedup.without_repeats(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert substring_dedup.repeated_spans(docs()).collect() == []


def test_pipeline(spark, tmp_path):
    good = [" ".join(f"d{i}w{j}" for j in range(80)) + "." for i in range(6)]
    near = good[1].replace("d1w40 ", "other ")
    rows = [(0, good[0]), (1, good[1]), (2, good[0].replace(" ", "  ")), (3, near), (4, "junk"), (5, None),
            (6, f"{good[3]} {good[2]}"), (7, f"{good[4]} {good[2]}")]
    path = tmp_path / "documents.parquet"
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(path))
    docs = table
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == table.columns
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert kept == [[0, 1, 2, 3, 6, 7], [0, 1, 3, 6, 7], [0, 1, 6, 7], [0, 1, 6, 7]]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts[6] == f"{good[3]} {good[2]}" and texts[7] == f"{good[4]} "
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {0, 1, 6, 7}
    assert len({r.sequence_id for r in packed}) == 1


def test_every_stage_takes_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").collect() == []
