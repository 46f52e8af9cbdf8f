"""Packing, token files and byte-level BPE against the public libraries."""

import hashlib
import zlib
from collections import defaultdict
from unittest import mock

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from segmart.llm import bpe, chunks, packing, token_files
from segmart.session import scratch_path


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=ranks.pattern, mergeable_ranks=ranks.table(), special_tokens={})


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


PIECES = ["a", " ", "  ", "\n", "\n\n", "\t", "é", "1", "'s", "'ll", "!", "...", "\x1c", "\x85", " ", "中", "\U0001f642",
          "The", " the", "\r\n", "<|endoftext|>", "zzqqxv", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join) | st.text(max_size=30))
def test_both_encoders_equal_the_libraries(text):
    path = public_tokenizers.path
    ranks = bpe.Ranks.read(path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    codec = bpe.codec(ranks)
    wanted = _encoding(ranks).encode_ordinary(text)
    assert codec.encode(text) == wanted
    assert codec.decode(wanted) == text.encode()
    vocabulary = packing.Vocabulary.read(path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    if "tokenizer" not in _cache:
        _cache["tokenizer"] = Tokenizer.from_file(path("byte_bpe_50k.json"))
    # With the strings of added tokens, as the library has them by default.
    with_added = _cache["tokenizer"].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(vocabulary.encoder().ids(text), "<u4").tolist() == with_added


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join) | st.text(max_size=30), st.sampled_from([2, 1000]))
def test_pieces_need_no_look_ahead(text, longest):
    pattern = public_tokenizers.PATTERN
    simple = chunks.without_look_ahead(pattern)
    assert "(?!" in pattern and "(?!" not in simple and chunks.without_look_ahead("a|b") == "a|b"
    with mock.patch.object(chunks, "PIECE_CHARS", longest):
        parts = chunks.pieces(text)
    assert "".join(parts) == text
    assert [m for part in parts for m in regex.findall(simple, part)] == regex.findall(pattern, text)


_cache = {}


def _encoding(ranks):
    if 0 not in _cache:
        _cache[0] = tiktoken.Encoding("own", pat_str=ranks.pattern, mergeable_ranks=ranks.table(), special_tokens={})
    return _cache[0]


def test_perfect_hash_is_minimal():
    keys = [f"key {i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(map(table.slot, keys)) == list(range(5000))
    assert bpe.PerfectHash([b"only"]).slot(b"only") == 0


def test_long_pre_tokens_merge_like_the_library(ranks, encoding):
    codec = bpe.codec(ranks)
    for text in ("ab" * 20_000, "é" * 5_000, "." * 9_999, " " * 3_000 + "x"):
        assert codec.encode(text) == encoding.encode_ordinary(text)


def test_round_trip_digests(odd_docs, ranks, encoding):
    rows = bpe.round_trip_digests(odd_docs, ranks).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    wanted = []
    for doc_id, text in texts:
        ids = encoding.encode_ordinary(text)
        wanted.append((
            doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        ))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, wanted))


def test_encode_and_decode_as_tables(odd_docs, ranks):
    encoded = bpe.encode_documents(odd_docs, ranks)
    decoded = bpe.decode_documents(encoded, ranks).collect()
    wanted = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()]
    assert sorted((repr(r.doc_id), bytes(r.decoded)) for r in decoded) == sorted((repr(i), t) for i, t in wanted)


def check_sequences(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_pieces_and_sequences(odd_docs, vocabulary, library):
    capacity = 256
    rows = packing.pack(packing.token_pieces(odd_docs, vocabulary, capacity), capacity).collect()
    n_sequences = check_sequences(rows, capacity)
    texts = defaultdict(list)
    for r in odd_docs.collect():
        texts[r.doc_id].append(library(r.text) + [0])
    for r in rows:
        parts = [ids[r.start : r.start + r.length] for ids in texts[r.doc_id]]
        assert r.ids_crc32 in [crc(p) for p in parts]
        assert r.piece == 0 or r.length == capacity
    total = sum(len(ids) for group in texts.values() for ids in group)
    assert sum(r.length for r in rows) == total
    assert n_sequences <= -(-total // capacity) + 1


def test_many_shards_pack_as_tightly_as_one(spark):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 400, 4000)]
    pieces = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "doc_id long, length long, offset string")
    rows = packing.pack(pieces, 512, shard_pieces=250).collect()
    assert sorted(r.doc_id for r in rows) == list(range(4000))
    assert check_sequences(rows, 512) <= -(-sum(lengths) // 512) + 3


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = packing.best_fit_decreasing(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]
    slots = packing.OpenBins(100)
    for room, number in ((30, 1), (20, 2), (77, 3)):
        slots.add(room, number)
    assert slots.take_tightest(21) == (30, 1) and slots.take_tightest(21) == (77, 3)
    assert slots.take_tightest(21) is None and slots.take_tightest(1) == (20, 2)


def test_no_pieces(docs, vocabulary):
    assert packing.pack(packing.token_pieces(docs(), vocabulary)).collect() == []


def test_token_files(spark, odd_docs, vocabulary, library):
    folder = scratch_path(spark, "files")
    manifest = token_files.write_token_files(odd_docs, folder, vocabulary, length=64, file_ids=5000)
    found = token_files.read_token_files(manifest, folder, T.LongType()).collect()
    by_place = sorted(found, key=lambda r: r.start)
    ids = [r.doc_id for r in by_place]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    place = 0
    wanted = [(r.doc_id, crc(library(r.text) + [0])) for r in odd_docs.collect()]
    for r in by_place:
        assert r.start == place
        place += r.n_tokens
    assert sorted(map(repr, wanted)) == sorted(repr((r.doc_id, r.ids_crc32)) for r in found)
    files = manifest.collect()
    assert len(files) > 1
    filesystem, _ = token_files.open_folder(folder)
    file = token_files.TokenFile(filesystem, files[0].path)
    last = -(-files[0].n_ids // 64) - 1
    tokens, mask = file.sequence(last)
    assert len(tokens) == 64 and mask.sum() == files[0].n_ids - 64 * last
    assert tokens[mask][-1] == 0


def test_no_token_files(spark, docs, vocabulary):
    folder = scratch_path(spark, "files")
    manifest = token_files.write_token_files(docs(), folder, vocabulary)
    assert token_files.read_token_files(manifest, folder, T.LongType()).collect() == []


def test_long_chunks_are_not_remembered(vocabulary):
    encoder = vocabulary.encoder()
    held = len(encoder._chunks)
    for i in range(20):
        encoder.ids(f"{i}" + "x" * 100_000)
    assert len(encoder._chunks) == held


def test_equal_pieces_are_spread_over_the_shards(spark):
    names = "length int, row int, number int, shard int, _key int, loose boolean, sequence_id int"
    rows = spark.range(30_000).selectExpr("100 AS length", "1 AS row", "2 AS number", "3 AS shard", "4 AS _key", "true AS loose", "5 AS sequence_id")
    assert rows.columns == [n.split()[0] for n in names.split(", ")]
    packed = packing.pack(rows, capacity=2048, shard_pieces=4_000)
    assert packed.columns == [*rows.columns[:-1], "sequence_id", "offset"]
    out = packed.groupBy("sequence_id").agg({"offset": "count"}).collect()
    assert sum(r["count(offset)"] for r in out) == 30_000 and len(out) == 30_000 // 20
    # Sequences of the first round carry their shard's number.
    first = packed.where("sequence_id < 1L << 56").selectExpr(f"sequence_id >> {packing.LOCAL_BITS} AS s")
    counts = [r["count"] for r in first.groupBy("s").count().collect()]
    assert len(counts) > 4 and max(counts) < 2 * 4_000
