"""Best-fit-decreasing packing of token pieces into sequences of a fixed capacity.

Pieces are dealt over shards of bounded size by a hash, each shard is packed by itself,
and the least filled sequences of all shards are taken apart and packed again together,
in as many rounds as it takes until one shard is left. A round passes on at most an
eighth of its pieces, so the last, single shard is as small as any other.

Defined results: a null or empty text is the end id alone. Repeated rows are packed one
by one. Equal lengths are taken in the order of their key. No pieces give no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import id_and_text, map_batches, staged_batches, texts_of
from segmart.llm.tokens import Vocabulary
from segmart.session import staged

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 8_192
LOOSE_SHARE = 8
LOCAL_BITS = 32


class OpenBins:
    """Open bins by remaining capacity, below a segment tree of which capacities occur."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_id: int) -> None:
        self.bins[room].append(bin_id)
        node = room + self.leaves
        while node and not self.used[node]:
            self.used[node] = 1
            node >>= 1

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """Room and id of the open bin with the least room that is enough, taken out."""
        used, node = self.used, length + self.leaves
        while not used[node]:
            while node & 1:  # a right child: nothing further right below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if used[2 * node] else 2 * node + 1
        room = node - self.leaves
        bin_id = self.bins[room].pop()
        if not self.bins[room]:
            used[node] = 0
            node >>= 1
            while node and not (used[2 * node] or used[2 * node + 1]):
                used[node] = 0
                node >>= 1
        return room, bin_id


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece; no length may exceed the capacity."""
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    open_bins, n_bins = OpenBins(capacity), 0
    for k in order:
        size = sizes[k]
        found = open_bins.take_tightest(size)
        if found is None:
            room, bin_id = capacity, n_bins
            n_bins += 1
        else:
            room, bin_id = found
        bins[k], offsets[k] = bin_id, capacity - room
        if room > size:
            open_bins.add(room - size, bin_id)
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def loose_bins(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Which pieces lie in the least filled bins: an eighth of the pieces at most."""
    fill = np.bincount(bins, weights=lengths)
    pieces = np.bincount(bins)
    order = np.argsort(fill, kind="stable")
    within = np.cumsum(pieces[order]) * LOOSE_SHARE <= len(bins)
    loose = np.zeros(len(fill), bool)
    loose[order[within]] = True
    return (loose & (fill < capacity))[bins]


def _pack_shard(capacity: int, round_no: int, last: bool):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("number", "ascending")])
        lengths = table.column("length").to_numpy().astype(np.int64)
        shard = table.column("shard")[0].as_py()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        loose = np.zeros(len(bins), bool) if last else loose_bins(bins, lengths, capacity)
        first = (round_no << 56) + (shard << LOCAL_BITS)
        for name, values in zip(("sequence_id", "offset", "loose"), (bins + first, offsets, loose), strict=True):
            table = table.append_column(name, pa.array(values))
        return table

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; input columns of these names are replaced.

    `pieces` has a column `length` of 1 to `capacity`; all its other columns are carried, in one struct,
    so that none of them clashes with the operator's own. Rows are numbered and dealt over the shards
    by number, so equal rows are spread like any others.
    """
    carried = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rest = staged(
        pieces.select(
            F.struct(*carried).alias("row"), pieces["length"].cast("bigint").alias("length"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "numbered",
    )
    done: DataFrame | None = None
    n_pieces, round_no = rest.count(), 0
    while True:
        shards = max(1, -(-n_pieces // shard_pieces))
        shard = F.pmod(F.xxhash64("number", F.lit(round_no)), F.lit(shards)).alias("shard")
        dealt = rest.select("row", "length", "number", shard)
        schema = T.StructType(
            [*dealt.schema.fields, T.StructField("sequence_id", T.LongType()),
             T.StructField("offset", T.LongType()), T.StructField("loose", T.BooleanType())]
        )
        packed = staged(
            dealt.groupBy("shard").applyInArrow(_pack_shard(capacity, round_no, shards == 1), schema),
            "packed",
        )
        settled = packed.where(~F.col("loose")).select("row.*", "sequence_id", "offset")
        done = settled if done is None else done.unionByName(settled)
        if shards == 1:
            return done
        rest = packed.where("loose").select("row", "length", "number")
        n_pieces, round_no = rest.count(), round_no + 1


def piece_bounds(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, and a shorter one in front."""
    first = n_ids % capacity or capacity
    return [(0, first), *[(start, capacity) for start in range(first, n_ids, capacity)]]


def token_pieces(
    docs: DataFrame,
    vocabulary: Vocabulary,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; with its ids on demand."""
    rows = id_and_text(docs, id_col, text_col)
    fields = [
        rows.schema["doc_id"], T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            source: list[int] = []
            columns: list[list] = [[], [], [], [], []]
            for row, text in enumerate(texts_of(batch)):
                ids = encoder.ids(text) + end
                for number, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    source.append(row)
                    values = (number, start, length, zlib.crc32(part), part)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            doc_ids = batch.column(0).take(pa.array(source, pa.int64()))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            arrays = arrays if with_ids else arrays[:-1]
            yield pa.RecordBatch.from_arrays([doc_ids, *arrays], names=[f.name for f in fields])

    return staged_batches(map_batches(rows, cut, T.StructType(fields)), "pieces")
