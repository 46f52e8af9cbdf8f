"""Substring de-duplication by hashing units of text, and windows of words for torn passages.

A unit is a line, or a sentence in it. Units are normalised (A-Z in lower case, single spaces) and
hashed to 128 bits, and the digests are grouped over all documents. Of equal units the earliest
stays, ranked by document and place. A run of consecutive units that are all later occurrences
and together have `min_words` words is a repeated passage and is removed; shorter runs are
common phrases and stay.

Passages of `PASSAGE_WORDS` words or more are found wherever they start and end, also without any
sentence: of equal windows of so many words the earliest stays, and all words of the later ones
are removed. Each window has the least hash of its runs of `ANCHOR_WORDS` words as anchor, and
consecutive windows with one anchor are a segment. Equal windows lie in segments of one anchor;
equal segments have the same windows. So segments are grouped by anchor and content, and only
the earliest of each content is compared window by window with others of its anchor. Within a
document a window is later if it does not overlap the first. Spans of both kinds that overlap
are one. A passage of fewer words that starts or ends inside a unit loses its whole units only.

A first pass counts digests and anchors. What occurs several times is marked in bitmaps of a fixed
size, and a second pass writes the marked units and segments, so that no text is shuffled. A full
bitmap would cost space, never a result.

Offsets are characters of the original text, so removals can be traced and undone.

Defined results: null and empty texts have no units and stay empty. Rows equal in id and
text are one document and keep or lose the same spans. Null ids rank after all others;
documents with equal ids rank together, and what one has first the other keeps as well.
A unit that repeats within its own document counts as a later occurrence too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import (
    bytes_of, hashed_words, id_and_text, map_batches, row_key, small_or_shuffled, staged_batches,
)
from segmart.session import staged

MIN_WORDS = 15
PASSAGE_WORDS = 50
ANCHOR_WORDS = 16
FLUSH_ROWS = 100_000

# Digests that occur several times are marked in bitmaps of so many bits.
SLOT_BITS = 26
WORD_BITS = 6

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_ODD = np.uint64(0xD6E8FEB86659FD93)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSE = {base: pow(base, -1, 1 << 64) for base in _BASES}
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """Powers 0 to n-1 at least, modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        factors = np.full(max(4096, 2 * n), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return _powers[base]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _ODD
    return values ^ (values >> np.uint64(29))


class RunHashes:
    """Hashes of any runs of a text's words, from sums over the words."""

    def __init__(self, words: np.ndarray, base: int) -> None:
        n = len(words)
        self.back = _powers_of(_INVERSE[base], n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers_of(base, n)[:n], dtype=np.uint64, out=self.sums[1:])

    def between(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return (self.sums[stops] - self.sums[starts]) * self.back[starts]

    def of_size(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.back[:n]


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of every n consecutive values."""
    span = 1
    while 2 * span <= n:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = n - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


@dataclass
class Words:
    """The words of a text: their hashes, and the bytes where they start and stop."""

    text: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    stops: np.ndarray

    @classmethod
    def of(cls, text: bytes) -> Words:
        codes = np.frombuffer(text, np.uint8)
        edges = np.diff(np.concatenate([[True], _SPACE[codes], [True]]).astype(np.int8))
        return cls(codes, hashed_words(text), np.flatnonzero(edges < 0), np.flatnonzero(edges > 0))

    def characters(self) -> tuple[np.ndarray, np.ndarray]:
        """The characters where words start and stop."""
        further = np.flatnonzero((self.text & 0xC0) == 0x80)
        return tuple(at - np.searchsorted(further, at) for at in (self.starts, self.stops))

    def unit_starts(self) -> np.ndarray:
        """The first word of each unit: after a line break, or after a word with a full stop."""
        breaks = np.flatnonzero(self.text == 10)
        line = np.searchsorted(breaks, self.starts)
        new = _STOP[self.text[self.stops[:-1] - 1]] | (line[1:] > line[:-1])
        return np.flatnonzero(np.concatenate([[len(self.starts) > 0], new]))


@dataclass
class Found:
    """The units and segments of a text."""

    words: Words
    unit_starts: np.ndarray
    unit_stops: np.ndarray
    units: tuple[np.ndarray, np.ndarray]  # two digests of each
    windows: np.ndarray  # a digest of each
    lows: np.ndarray  # the first window of each segment
    highs: np.ndarray  # the last one
    anchors: np.ndarray
    segments: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, text: bytes, contents: bool = True) -> Found:
        """With `contents`, also the digests of windows and segments."""
        words = Words.of(text)
        n = len(words.hashes)
        starts = words.unit_starts() if n else np.zeros(0, np.int64)
        stops = np.append(starts[1:], n) if n else starts
        hashes = [RunHashes(h, base) for h, base in zip((words.hashes, _mixed(words.hashes)), _BASES)]
        units = tuple(h.between(starts, stops) for h in hashes)
        if n < PASSAGE_WORDS:
            none = np.zeros(0, np.int64)
            empty = none.view(np.uint64)
            return cls(words, starts, stops, units, empty, none, none, empty, (empty, empty))
        least = _least(hashes[0].of_size(ANCHOR_WORDS), PASSAGE_WORDS - ANCHOR_WORDS + 1)
        lows = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        highs = np.append(lows[1:], len(least)) - 1
        if not contents:
            none = lows[:0].view(np.uint64)
            return cls(words, starts, stops, units, none, lows, highs, least[lows], (none, none))
        segments = tuple(h.between(lows, highs + PASSAGE_WORDS) for h in hashes)
        windows = hashes[1].of_size(PASSAGE_WORDS)
        return cls(words, starts, stops, units, windows, lows, highs, least[lows], segments)

    def again_windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of each run that the text has before, not overlapping."""
        n = len(self.windows)
        if len(np.unique(self.anchors)) == len(self.anchors) and np.all(self.highs - self.lows < PASSAGE_WORDS):
            return self.lows[:0], self.lows[:0]  # equal windows that far apart have one anchor
        _, index, inverse = np.unique(self.windows, return_index=True, return_inverse=True)
        later = np.arange(n) - index[inverse] >= PASSAGE_WORDS
        edges = np.diff(np.concatenate([[False], later, [False]]).astype(np.int8))
        return np.flatnonzero(edges > 0), np.flatnonzero(edges < 0) - 1


# -- first pass: what occurs several times ----------------------------------------------

def _digests(rows: DataFrame) -> DataFrame:
    """(doc_id, d1, d2) of every unit, and (d1) of every segment's anchor, without d2."""
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("d1 bigint, d2 bigint").fields])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Found.of(text, contents=False) for text in bytes_of(batch)]
            counts = [len(f.unit_starts) for f in found]
            parts = [np.concatenate([f.units[j] for f in found]).view(np.int64) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), counts))), *map(pa.array, parts)],
                names=schema.names,
            )
            anchors = np.concatenate([f.anchors for f in found]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(anchors), batch.column(0).type), pa.array(anchors), pa.nulls(len(anchors), pa.int64())],
                names=schema.names,
            )

    return map_batches(rows.select("doc_id", "text"), digest, schema)


@dataclass(frozen=True)
class Bitmap:
    """Digests that occur several times, by slot; words of 64 slots that hold one."""

    places: np.ndarray
    bits: np.ndarray
    slot_bits: int

    @classmethod
    def of(cls, repeated: DataFrame) -> Bitmap:
        """Gather the marked words: 2**20 numbers at most, whatever the number of digests."""
        slot = F.shiftrightunsigned("d1", 64 - SLOT_BITS)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))
        words = repeated.groupBy(F.shiftright(slot, WORD_BITS).alias("place")).agg(F.bit_or(bit).alias("bits"))
        held = words.toArrow()
        return cls(held["place"].to_numpy().astype(np.int64), held["bits"].to_numpy().astype(np.int64), SLOT_BITS)

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        """Which of some digests are marked."""
        table = np.zeros(1 << (self.slot_bits - WORD_BITS), np.uint64)
        table[self.places] = self.bits.view(np.uint64)

        def marked(digests: np.ndarray) -> np.ndarray:
            slot = digests >> np.uint64(64 - self.slot_bits)
            word = table[(slot >> np.uint64(WORD_BITS)).astype(np.int64)]
            return ((word >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)

        return marked


# -- second pass: marked units and segments ---------------------------------------------

# kind 0: a unit, lo and hi its first and last word; 1: a segment, lo and hi its first and last
# window; 2: windows that the document has before. start and stop are characters.
ROWS = """key bigint, kind tinyint, anchor bigint, d1 bigint, d2 bigint, lo int, hi int,
    start int, stop int, again boolean, windows array<bigint>, starts array<int>, stops array<int>"""


def _unit_rows(found: Found, marked: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The units in runs of marked units with `min_words` words, and if the text has them before."""
    edges = np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0) - 1
    enough = found.unit_stops[last] - found.unit_starts[first] >= min_words
    inside = np.zeros(len(marked) + 1, np.int64)
    np.add.at(inside, first[enough], 1)
    np.add.at(inside, last[enough] + 1, -1)
    units = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(units):
        return units, np.zeros(0, bool)
    _, index, inverse = np.unique(found.units[0], return_index=True, return_inverse=True)
    return units, units > index[inverse[units]]


def _marked_rows(rows: DataFrame, units: Bitmap, anchors: Bitmap, min_words: int) -> DataFrame:
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(ROWS).fields])

    kinds = np.arange(3, dtype=np.int8)

    def columns(row: int, found: Found, of_units: Callable, of_anchors: Callable) -> list[np.ndarray] | None:
        """The row's number, and the columns of `ROWS` but the key; lists are their sizes and values."""
        chosen, again = _unit_rows(found, of_units(found.units[0]), min_words)
        shared = np.flatnonzero(of_anchors(found.anchors))
        low, high = found.again_windows()
        counts = [len(chosen), len(shared), len(low)]
        n = sum(counts)
        if not n:
            return None
        starts, stops = found.words.characters()
        lo = np.concatenate([found.unit_starts[chosen], found.lows[shared], low])
        hi = np.concatenate([found.unit_stops[chosen] - 1, found.highs[shared], high])
        last = hi.copy()
        last[len(chosen) :] += PASSAGE_WORDS - 1
        zeros = np.zeros(len(low), np.uint64)
        digests = [np.concatenate([found.units[j][chosen], found.segments[j][shared], zeros]) for j in (0, 1)]
        own = np.concatenate([np.zeros(len(chosen), np.uint64), found.anchors[shared], zeros])
        lengths = (found.highs - found.lows + 1)[shared]
        sizes = np.zeros(n, np.int64)
        sizes[len(chosen) : len(chosen) + len(shared)] = lengths
        inside = np.repeat(found.lows[shared] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        before = np.concatenate([again, np.ones(n - len(chosen), bool)])
        return [
            np.full(n, row), np.repeat(kinds, counts), own.view(np.int64), *[d.view(np.int64) for d in digests],
            lo, hi, starts[lo], stops[last], before, sizes,
            found.windows[inside].view(np.int64), starts[inside], stops[inside + PASSAGE_WORDS - 1],
        ]

    def joined(batch: pa.RecordBatch, parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        row, kind, own, d1, d2, lo, hi, start, stop, again, sizes, *lists = (
            np.concatenate(column) for column in zip(*parts)
        )
        taken, offsets = pa.array(row), pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
        lists = [lists[0], *[v.astype(np.int32) for v in lists[1:]]]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken), *map(pa.array, (kind, own, d1, d2)),
             *[pa.array(v.astype(np.int32)) for v in (lo, hi, start, stop)], pa.array(again),
             *[pa.ListArray.from_arrays(offsets, pa.array(v)) for v in lists]],
            names=schema.names,
        )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = units.test(), anchors.test()
        for batch in batches:
            parts, n = [], 0
            for row, text in enumerate(bytes_of(batch)):
                part = columns(row, Found.of(text), *tests)
                if part is not None:
                    parts.append(part)
                    n += len(part[0])
                if n >= FLUSH_ROWS:
                    yield joined(batch, parts)
                    parts, n = [], 0
            if parts:
                yield joined(batch, parts)

    return staged_batches(map_batches(rows.select("doc_id", "key", "text"), mark, schema), "marked")


# -- spans ------------------------------------------------------------------------------

def _later_units(marked: DataFrame, firsts: DataFrame, min_words: int) -> DataFrame:
    """Runs of units that are later occurrences: bounds, words lo to hi, and keep_id."""
    units = marked.where("kind = 0").select("doc_id", "key", "d1", "d2", "lo", "hi", "start", "stop", "again")
    kept = units.join(firsts, ["d1", "d2"])
    later = kept.where(F.col("again") | ~F.col("doc_id").eqNullSafe(F.col("keep_id"))).drop("d1", "d2", "again")
    # Units of one run follow each other without a gap; equal rows have the same ones.
    order = Window.partitionBy("doc_id", "key").orderBy("lo")
    gap = F.coalesce(F.col("lo") > F.lag("hi").over(order) + 1, F.lit(True)).cast("int")
    runs = later.withColumn("gap", gap).withColumn("run", F.sum("gap").over(order)).groupBy("doc_id", "key", "run")
    return _bounds(runs).where(F.col("hi") - F.col("lo") + 1 >= min_words).drop("run")


def _bounds(groups) -> DataFrame:
    return groups.agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("lo").alias("lo"),
        F.max("hi").alias("hi"), F.min("keep_id").alias("keep_id"),
    )


def _later_windows(marked: DataFrame) -> DataFrame:
    """Runs of windows that an earlier place has: bounds, words lo to hi, and keep_id.

    Every document with a segment's content but the earliest one has all its windows from that.
    The earliest one has a window from another document only if a segment of the same anchor,
    but other content, has it too: those alone are compared by windows.
    """
    segments = marked.where("kind = 1")
    content = ["anchor", "d1", "d2"]
    place = ["doc_id", "key", "lo", "hi", "start", "stop"]
    contents = staged(
        segments.groupBy(*content).agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id")), "contents"
    )
    several = contents.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    earliest = contents.drop("n").join(small_or_shuffled(several), "anchor", "left_semi")
    expanded = (
        segments.join(small_or_shuffled(earliest), content)
        .where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "key", "anchor", "d1", "d2", "lo", F.posexplode(F.arrays_zip("windows", "starts", "stops")))
        .select(
            "doc_id", "key", *content, (F.col("lo") + F.col("pos")).alias("lo"),
            F.col("col.windows").alias("window"), F.col("col.starts").alias("start"), F.col("col.stops").alias("stop"),
        )
    )
    windows = staged(expanded, "windows")
    least = windows.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id"))
    found = staged(
        windows.join(least.where("n > 1").drop("n"), ["anchor", "window"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).drop("window"), "found"
    )
    # What a content's earliest document has from elsewhere, the others have from there too.
    better = found.groupBy(*content).agg(F.min("keep_id").alias("better"))
    others = contents.where("n > 1").drop("n").join(small_or_shuffled(better), content, "left").select(
        *content, "keep_id", F.least("better", "keep_id").alias("origin")
    )
    whole = (
        segments.select(*place, *content).join(others, content)
        .where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select(*place, F.col("origin").alias("keep_id"))
    )
    single = found.select("doc_id", "key", "lo", F.col("lo").alias("hi"), "start", "stop", "keep_id")
    within = marked.where("kind = 2").select(*place, F.col("doc_id").alias("keep_id"))
    return whole.unionByName(single).unionByName(within).withColumn("hi", F.col("hi") + (PASSAGE_WORDS - 1))


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The spans to remove: doc_id, key, start, stop, n_words, and the document kept in its place."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    counted = _digests(rows).groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id"))
    repeated = staged_batches(counted.where("n > 1").drop("n"), "repeated")
    firsts, anchors = repeated.where("d2 IS NOT NULL"), repeated.where("d2 IS NULL")
    marked = _marked_rows(rows, Bitmap.of(firsts), Bitmap.of(anchors), min_words)
    spans = _later_units(marked, firsts, min_words).unionByName(_later_windows(marked))
    # Spans that overlap, or follow each other word by word, are one.
    order = Window.partitionBy("doc_id", "key").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("lo") > before + 1, F.lit(True)).cast("int")
    merged = _bounds(
        spans.withColumn("apart", apart).withColumn("span", F.sum("apart").over(order)).groupBy("doc_id", "key", "span")
    )
    return merged.select(
        "doc_id", "key", "start", "stop", (F.col("hi") - F.col("lo") + 1).cast("bigint").alias("n_words"), "keep_id"
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """`docs` with the repeated passages cut out of the text; other columns as they were.

    A column `n_chars` is set to the new length where the text changed.
    """
    spans = staged(repeated_spans(docs, id_col, text_col, min_words), "spans")
    cuts = spans.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("cuts"))
    # The row travels in one struct, so that none of its names can clash with another.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    key = row_key(F.col("row")[id_col], text)
    joined = rows.withColumn("key", key).join(small_or_shuffled(cuts), "key", "left")
    row, found = joined["row"], joined["cuts"]
    text = F.coalesce(row[text_col], F.lit(""))

    def before(cut: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(found, i - 1)["stop"])
        return F.substring(text, start + 1, cut["start"] - start)

    kept = F.array_join(F.transform(found, before), "")
    tail = F.substring(text, F.element_at(found, -1)["stop"] + 1, F.length(text))
    shortened = F.when(found.isNotNull(), F.concat(kept, tail)).otherwise(row[text_col])
    values = {name: row[name] for name in docs.columns} | {text_col: shortened}
    if "n_chars" in values:
        n_chars = F.length(shortened).cast("bigint")
        values["n_chars"] = F.when(found.isNotNull(), n_chars).otherwise(row["n_chars"])
    return joined.select(*[column.alias(name) for name, column in values.items()])
