"""Benchmark decontamination by winnowing: shared spans of words between documents and items.

Words are runs of 0-9, a-z (A-Z in lower case) and characters beyond ASCII. Of every span
of `WINDOW` words the least hash of its `GRAM`-word grams is the fingerprint. It depends on
the span alone, so a span that a document and an item share has one fingerprint in both, and
joining fingerprints finds every shared span of `WINDOW` words or more. A hit is extended to
the spans around it by their own hashes.

An item of fewer words, but not none, is one span of its own length; there the fingerprint is
the hash of the whole span. A null text has no words. A repeated document row is a document of
its own; repeated item rows, and rows that share an item id, are one item. An item without an id
makes words hit, but is neither counted nor listed. Without items, or documents, nothing is hit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import bytes_of, id_and_text, small_or_shuffled, staged_batches, word_hash
from segmart.operators.joins import lookup_join
from segmart.session import staged

WINDOW = 10
GRAM = 5

# Words are looked up in a bitmap of the items' fingerprints before they leave the task. Its size
# is fixed, whatever the number of items; a full bitmap costs time, never a result.
SLOT_BITS = 25
WORD_BITS = 6

# A long text is split into words piece by piece.
PIECE_BYTES = 1 << 20

# Bytes of words in lower case; all others, of ASCII, separate words.
_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
FOLD = bytes(
    b if b >= 128 or bytes([b]) in _LETTERS else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_FACTOR = 0x9E3779B97F4A7C15


def word_codes(text: bytes) -> np.ndarray:
    """A number for each word of a text, in their order."""
    flat = text.translate(FOLD)
    parts, at = [], 0
    while at < len(flat):
        stop = flat.find(b" ", at + PIECE_BYTES)
        stop = len(flat) if stop < 0 else stop
        tokens = flat[at:stop].split()
        parts.append(np.fromiter(map(word_hash, tokens), np.uint64, len(tokens)))
        at = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` words from each place on, as far as the words reach."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = np.uint64(_FACTOR)
    found = np.full(n, size, np.uint64)
    for i in range(size):
        found *= factor
        found += codes[i : i + n]
    found ^= found >> np.uint64(29)
    found *= factor
    return found


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` neighbours from each place on."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    least = values[:n].copy()
    for i in range(1, width):
        np.minimum(least, values[i : i + n], out=least)
    return least


def spans(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and own hash of the span of `size` words from each place on."""
    whole = gram_hashes(codes, size)
    if size < WINDOW:
        return whole, whole
    return least_of(gram_hashes(codes, GRAM), size - GRAM + 1), whole


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


# -- items ------------------------------------------------------------------------------

SPANS = "size int, print bigint, span bigint"


def item_spans(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size, print, span): the spans of every item, once each."""
    rows = id_and_text(items, id_col, text_col).withColumnRenamed("doc_id", "item_id")
    schema = T.StructType([rows.schema["item_id"], *T.StructType.fromDDL(SPANS).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(bytes_of(batch)):
                codes = word_codes(text)
                if not len(codes):
                    continue
                size = min(WINDOW, len(codes))
                prints, wholes = spans(codes, size)
                n = len(wholes)
                ids = batch.column(0).take(pa.array(np.full(n, i)))
                columns = [ids, pa.array(np.full(n, size, np.int32)), _signed(prints), _signed(wholes)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return staged_batches(rows.mapInArrow(cut, schema).distinct(), "item-spans")


def _slot(fingerprint: Column) -> Column:
    return F.shiftrightunsigned(fingerprint, 64 - SLOT_BITS)


def bitmap_of(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The words of the bitmap that hold a fingerprint: 2**19 numbers of 64 bits at most."""
    slot = _slot(F.col("print"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))
    words = (
        found.groupBy(F.shiftright(slot, WORD_BITS).alias("place"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()
    )
    return words["place"].to_numpy().astype(np.int64), words["bits"].to_numpy().astype(np.int64)


# -- documents --------------------------------------------------------------------------

# One row per document (n_words), and one per span whose fingerprint is in the bitmap (pos).
ROWS = "row bigint, n_words bigint, pos bigint, size int, print bigint, span bigint"


def _print_rows(
    sizes: list[int], places: np.ndarray, bits: np.ndarray, names: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << (SLOT_BITS - WORD_BITS), np.uint64)
        bitmap[places] = bits.view(np.uint64)
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            coded = [word_codes(text) for text in bytes_of(batch)]
            counts = np.array([len(codes) for codes in coded], np.int64)
            numbers = first + np.arange(len(coded))
            first += len(coded)
            n = len(coded)
            nulls = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.int64())] * 2]
            columns = [batch.column(0), pa.array(numbers), pa.array(counts), *nulls]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            codes = np.concatenate(coded) if coded else np.zeros(0, np.uint64)
            starts = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(n), counts)
            for size in sizes:
                prints, wholes = spans(codes, size)
                slot = prints >> np.uint64(64 - SLOT_BITS)
                word = bitmap[(slot >> np.uint64(WORD_BITS)).astype(np.int64)]
                hit = np.flatnonzero((word >> (slot & np.uint64(63))) & np.uint64(1))
                hit = hit[owner[hit] == owner[hit + size - 1]]  # within one document
                k = len(hit)
                if not k:
                    continue
                of = owner[hit]
                columns = [
                    pa.nulls(k, batch.column(0).type), pa.array(numbers[of]), pa.nulls(k, pa.int64()),
                    pa.array(hit - starts[of]), pa.array(np.full(k, size, np.int32)),
                    _signed(prints[hit]), _signed(wholes[hit]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def print_rows(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with their number of words, and their spans that may be an item's."""
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # WINDOW values at most
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(ROWS).fields])
    function = _print_rows(sizes, *bitmap_of(items), schema.names)
    return staged_batches(rows.mapInArrow(function, schema), "prints")


def shared_spans(prints: DataFrame, items: DataFrame) -> DataFrame:
    """(row, pos, size, span) of document spans that are an item's.

    Rows with the same fingerprint meet, and a hit counts if the spans around it are equal too.
    A span is one row on the items' side however many of them have it, and a fingerprint that
    many documents share is no hot key. Of several spans with one fingerprint each has a key.
    """
    key = F.xxhash64("print", "span", "size").alias("key")
    candidates = prints.where("pos IS NOT NULL").select("row", "pos", "size", "span", "print", key)
    known = items.select("size", "print", "span").distinct().select(
        key, F.struct("size", "print", "span").alias("of")
    ).groupBy("key").agg(F.collect_set("of").alias("of"))
    joined = lookup_join(candidates, known, "key", "inner")
    equal = F.array_contains("of", F.struct("size", "print", "span"))
    return joined.where(equal).select("row", "pos", "size", "span")


def hit_words(found: DataFrame) -> DataFrame:
    """(row, n_hit): words of a document inside any of its shared spans."""
    before = Window.partitionBy("row").orderBy("pos", "size").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("pos") + F.col("size")
    known = F.greatest(F.col("pos"), F.coalesce(F.max(stop).over(before), F.lit(0)))
    new = F.greatest(stop - known, F.lit(0))
    return found.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))


def hit_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """(row, item_id), once each, of the items with a span in a document."""
    of = items.where("item_id IS NOT NULL").select("size", "span", "item_id").distinct()
    once = found.select("row", "size", "span").distinct()
    return once.join(small_or_shuffled(of), ["size", "span"]).select("row", "item_id").distinct()


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document row: id, words, hit words, and the items it shares a span with.

    (doc_id, n_words, n_hit, n_items, items_sha256, contaminated); the digest is that of the
    item ids, sorted as texts and joined by commas.
    """
    known = item_spans(items, item_id_col, item_text_col)
    prints = print_rows(docs, known, id_col, text_col)
    found = staged(shared_spans(prints, known), "shared-spans")
    listed = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    named = hit_items(found, known).groupBy("row").agg(
        F.count("*").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256")
    )
    hits = hit_words(found).join(named, "row", "left")
    rows = prints.where("n_words IS NOT NULL").select("row", "doc_id", "n_words")
    nothing = F.sha2(F.lit(""), 256)
    return rows.join(small_or_shuffled(hits), "row", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", nothing).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
