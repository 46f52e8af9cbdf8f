"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, others by a heap of merges.

Every match of the pre-token pattern is encoded by itself. A pre-token that is in the
vocabulary is found in two array reads: a displacement per bucket, and the one slot it
leads to. All others are merged bottom-up: a heap holds the adjacent pairs by rank and
place, links between the pieces show which of its entries still hold.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated rows
get a row each. Ids of any text decode to its own UTF-8 bytes. An unknown id is an error.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from segmart.llm.chunks import ChunkEncoder
from segmart.llm.common import id_and_text, map_batches, staged_batches, texts_of

BUCKET_SIZE = 2
_MASK = (1 << 64) - 1


class PerfectHash:
    """Maps n keys to the slots 0 to n-1 without gaps, by one displacement per bucket.

    Half of a 128-bit hash picks the bucket. The bucket's displacement makes an odd
    factor, and the other half times that factor gives the slot. Buckets with one key
    take the slots that are left at the end and store them directly, as -slot - 1.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.n = n = len(keys)
        self.n_buckets = max(1, -(-n // BUCKET_SIZE))
        self.displacement = [0] * self.n_buckets
        buckets: list[list[int]] = [[] for _ in range(self.n_buckets)]
        for key in keys:
            wide = xxhash.xxh3_128_intdigest(key)
            buckets[(wide >> 64) % self.n_buckets].append(wide & _MASK)
        free = bytearray(b"\x01") * n
        single = []
        for number in sorted(range(self.n_buckets), key=lambda b: -len(buckets[b])):
            members = buckets[number]
            if len(members) < 2:
                single += [number] * len(members)
                continue
            shift = 0
            while True:
                slots = {self._place(low, shift) for low in members}
                if len(slots) == len(members) and all(free[s] for s in slots):
                    break
                shift += 1
            self.displacement[number] = shift
            for slot in slots:
                free[slot] = 0
        left = (slot for slot in range(n) if free[slot])
        for number in single:
            self.displacement[number] = -next(left) - 1

    def _place(self, low: int, shift: int) -> int:
        return ((low * (2 * shift + 1) & _MASK) >> 20) % self.n

    def slot(self, key: bytes) -> int:
        """The slot of a key of the set; any slot for other keys."""
        wide = xxhash.xxh3_128_intdigest(key)
        shift = self.displacement[(wide >> 64) % self.n_buckets]
        return -shift - 1 if shift < 0 else self._place(wide & _MASK, shift)


@dataclass(frozen=True)
class Ranks:
    """A rank file's content and the pattern of pre-tokens; a few MB at most, sent to tasks."""

    content: bytes
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Ranks:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def table(self) -> dict[bytes, int]:
        lines = (line.split() for line in self.content.splitlines() if line)
        return {base64.b64decode(token): int(rank) for token, rank in lines}


class ByteBpe:
    def __init__(self, ranks: Ranks) -> None:
        table = ranks.table()
        self._rank_of = table.get
        tokens = list(table)
        self._hash = PerfectHash(tokens)
        self._slots: list[tuple[bytes, int]] = [(b"", 0)] * len(tokens)
        for token in tokens:
            self._slots[self._hash.slot(token)] = (token, table[token])
        top = max(table.values()) + 1
        self.token_of: list[bytes | None] = [None] * top
        for token, rank in table.items():
            self.token_of[rank] = token
        self.decimal_of = [b"%d" % rank for rank in range(top)]
        self._pre_tokens = regex.compile(ranks.pattern).findall
        self.chunks = ChunkEncoder(self._encode_chunk)

    def pre_token_ids(self, piece: bytes) -> list[int]:
        token, rank = self._slots[self._hash.slot(piece)]
        return [rank] if token == piece else self.merged(piece)

    def merged(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked adjacent pair, the leftmost of equals, until none is left.

        A heap entry is rank and place in one number. It holds as long as the pair that
        starts there still has this rank, since a rank stands for one string of bytes.
        """
        rank_of, n = self._rank_of, len(piece)
        end = list(range(1, n + 2))  # where the part that starts here ends
        before = list(range(-1, n))  # where the part before it starts
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [rank << 32 | i for i, rank in enumerate(pair) if rank >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i = entry & 0xFFFFFFFF
            if pair[i] != entry >> 32:
                continue
            middle = end[i]
            stop = end[i] = end[middle]
            pair[middle] = -1
            if stop < n:
                before[stop] = i
                rank = pair[i] = rank_of(piece[i : end[stop]], -1)
                if rank >= 0:
                    push(heap, rank << 32 | i)
            else:
                pair[i] = -1
            if i:
                left = before[i]
                rank = pair[left] = rank_of(piece[left:stop], -1)
                if rank >= 0:
                    push(heap, rank << 32 | left)
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(piece[i : end[i]]))
            i = end[i]
        return ids

    def _encode_chunk(self, chunk: str) -> bytes:
        if (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
            return array("I", self.pre_token_ids(chunk.encode())).tobytes()
        ids: list[int] = []
        for piece in self._pre_tokens(chunk):
            ids += self.pre_token_ids(piece.encode())
        return array("I", ids).tobytes()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.chunks.ids(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


_loaded: dict[str, ByteBpe] = {}


def codec(ranks: Ranks) -> ByteBpe:
    """The process's codec for a rank file; it outlives a task."""
    key = hashlib.sha256(ranks.content).hexdigest()
    if key not in _loaded:
        _loaded[key] = ByteBpe(ranks)
    return _loaded[key]


def encode_documents(
    docs: DataFrame, ranks: Ranks, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids of each row."""
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in batches:
            ids = pa.array([bpe.encode(text) for text in texts_of(batch)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return map_batches(rows, encode, schema)


def decode_documents(encoded: DataFrame, ranks: Ranks) -> DataFrame:
    """doc_id and the decoded bytes of rows with doc_id and ids."""
    schema = T.StructType([encoded.schema["doc_id"], T.StructField("decoded", T.BinaryType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "decoded"]
            )

    return map_batches(encoded.select("doc_id", "ids"), decode, schema)


def round_trip_digests(
    docs: DataFrame, ranks: Ranks, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the bytes decoded from them.

    Both directions in one task per batch: the ids need not leave it for a digest.
    """
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        decimal = bpe.decimal_of.__getitem__
        for batch in batches:
            columns: list[list] = [[], [], []]
            for text in texts_of(batch):
                ids = bpe.encode(text)
                columns[0].append(len(ids))
                columns[1].append(hashlib.sha256(b" ".join(map(decimal, ids))).hexdigest())
                columns[2].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            types = [pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=schema.names,
            )

    return staged_batches(map_batches(rows, digest, schema), "round-trip")
