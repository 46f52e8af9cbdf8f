"""Exact Jaccard self-join on word shingles, by partitioning the universe of shingles.

Shingles are 64-bit hashes. Sets are put into bands by size; for a band, the range of
hashes is cut into segments. Linked sets differ in at most H shingles, so some segments
of theirs agree, or differ in one shingle at most: each set is indexed by a hash of every
segment and, where a band's allocation says so, of every segment with one shingle left
out. The allocation takes as many exact segments as it can and one-deletion ones where
segments would become so short that unlinked sets would often agree on them.

An agreement between empty segments tells nothing and is not indexed. The allocation
leaves room for a few of them; a set with more also indexes the shingles of its prefix
under the order of the hashes. Of two linked sets, either one is within that room and
they agree on a segment that is not empty, or neither is and their prefixes meet.

Sets with the same index entry are compared with the least of them first, and then with
another member, which settles large groups of copies in linear work. Pairs that are still in different components are
compared if their parity sketches, a lower bound on the difference, allow a link: a short one
beside each index entry, and a fine one, with a bit for each shingle, of larger sets, as the
short one cannot tell these apart. Every comparison is exact on the shingle sets. Hash collisions: two different shingles of a
pair of documents, or two different sets, have a chance of about 1 in 10^19 each.

Defined results: texts with fewer words than a shingle are one shingle of all their
words; without words, and for null texts, the set is empty and links with nothing. Equal
sets link. Repeated rows get a row each; a null id is ranked after all others.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import (
    bytes_of, hashed_words, id_and_text, map_batches, row_key, small_or_shuffled, staged_batches,
)
from segmart.llm.components import components
from segmart.llm.substring_dedup import Bitmap
from segmart.session import staged

BAND_WIDTH = 2  # in steps of the largest size ratio that a link allows
ROOM = 2  # weight of uninformative segments that the allocation makes up for
SEGMENT_SIZE = 3  # shingles that a segment should have
SKETCH = tuple(f"s{i}" for i in range(8))
SKETCH_BITS = 64 * len(SKETCH)
GROUP_NODES = 64  # compared with one node in one task, about
PAIR_COST = 30  # of a chance agreement, in rows of the index

# Shingles are counted in so many slots, to put those of many documents last in the prefixes.
SLOT_BITS = 22

# Odd multipliers for hashing.
_ODD = [
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
    0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
]
_U = np.uint64


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = values ^ (values >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingles(text: bytes, k: int) -> np.ndarray:
    """The hashes of a text's k-word shingles in their order, A-Z in lower case."""
    hashes = hashed_words(text)
    n = len(hashes)
    if not n:
        return np.empty(0, _U)
    width = min(n, k)
    total = np.full(n - width + 1, width, _U)
    for j in range(width):
        # Words' hashes are random, and each place has an odd factor of its own.
        total += hashes[j : n - width + 1 + j] * _U(_ODD[j % 8] + 2 * (j // 8))
    return mixed(total)


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    return np.unique(shingles(text, k))


@dataclass(frozen=True)
class Similarity:
    """Link when intersection / union >= percent / 100, on shingles of k words."""

    k: int
    percent: int

    @property
    def ratio(self) -> float:
        return self.percent / 100

    def difference(self, total: int) -> int:
        """The largest difference of linked sets whose sizes add up to `total`."""
        return total * (100 - self.percent) // (100 + self.percent)

    def bands_of(self, size: int) -> list[int]:
        """The band of a size, and the next if a linked set may lie there."""
        band = self._band(size)
        reaches = self.band_start(band + 1) * self.percent <= size * 100
        return [band, band + 1] if reaches else [band]

    def _band(self, size: int) -> int:
        band = int(math.log(size) / (BAND_WIDTH * -math.log(self.ratio)))
        while self.band_start(band + 1) <= size:
            band += 1
        while self.band_start(band) > size:
            band -= 1
        return band

    def band_start(self, band: int) -> int:
        return math.ceil(self.ratio ** (-BAND_WIDTH * band) - 1e-9)

    @functools.lru_cache(maxsize=4096)
    def allocation(self, band: int) -> tuple[int, int, np.ndarray] | None:
        """Number of one-deletion segments, of all segments, and the lower bounds of these.

        An exact segment weighs 1 and a one-deletion segment 2; the weights add up to
        H + 1 and the room for uninformative segments. None if only equal sets link.
        """
        largest = self.band_start(band + 1) - 1
        difference = self.difference(2 * largest)
        if difference < 1:
            return None
        weight = difference + 1 + ROOM
        wanted = max(1, self.band_start(band) // SEGMENT_SIZE)
        deletions = min(max(0, weight - wanted), weight // 2)
        segments = weight - deletions
        bounds = [-(-(i << 64) // segments) for i in range(segments)]
        return deletions, segments, np.array(bounds, _U)

    def prefix(self, n: int) -> int:
        """How many of n shingles, the first in any one order, linked sets must share one of."""
        return n - -(-n * self.percent // 100) + 1

    @functools.lru_cache(maxsize=4096)
    def by_prefix(self, band: int, recurring: float) -> bool:
        """Whether sets of a band are indexed by single shingles, as that is estimated to cost less.

        Each entry costs its own row, and `PAIR_COST` for the chance to agree with an unlinked
        set: `recurring` is the share of shingles that others have too, and all of a segment's
        must. Sets that outgrow the room for empty segments need the prefix besides.
        """
        plan = self.allocation(band)
        if plan is None:
            return False
        deletions, segments, _ = plan
        size = (self.band_start(band) + self.band_start(band + 1)) / 2
        per_segment = size / segments
        reach = 1 + len(self.bands_of(int(size))[1:])
        entries = segments + deletions * per_segment
        segmented = reach * entries * (1 + PAIR_COST * recurring ** max(1.0, per_segment))
        single = self.prefix(int(size)) * (1 + PAIR_COST * recurring)
        if segments * math.exp(-per_segment) > ROOM:
            segmented += reach * single
        return single < segmented

    def index_entries(self, hashes: np.ndarray, ranks: np.ndarray, recurring: float) -> np.ndarray:
        """The index entries of a set; `ranks` order its shingles, those in few documents first."""
        n = len(hashes)
        found: list[np.ndarray] = []
        if not n:
            return np.empty(0, _U)
        token = mixed(hashes ^ _U(_ODD[5]))
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(token, dtype=_U)])
        whole_prefix = False
        for band in self.bands_of(n):
            plan = self.allocation(band)
            if plan is None:
                continue
            if self.by_prefix(band, recurring):
                whole_prefix = True
                continue
            deletions, segments, bounds = plan
            starts = np.searchsorted(hashes, bounds)
            ends = np.append(starts[1:], n)
            sizes = ends - starts
            segment = sums[ends] - sums[starts]
            own = _U((band + 1) * _ODD[7] & (2**64 - 1))
            salt = (np.arange(segments, dtype=_U) + _U(1)) * _U(_ODD[6]) + own
            found.append(mixed(segment + salt)[sizes > 0])
            if deletions:
                owner = np.repeat(np.arange(deletions), sizes[:deletions])
                owner_sizes = sizes[owner]
                left = segment[owner] - token[: len(owner)]
                found.append(mixed(left + salt[owner])[owner_sizes > 1])
            weights = np.ones(segments, np.int64)
            weights[:deletions] = 2
            useless = (sizes == 0) | ((sizes == 1) & (weights == 2))
            if int(weights[useless].sum()) > ROOM:
                found.append(mixed(token[: self.prefix(n)] ^ _U((band + 1) * _ODD[2] & (2**64 - 1))))
        if whole_prefix:
            first = np.flatnonzero(ranks == 0)[: self.prefix(n)]
            if len(first) < self.prefix(n):
                first = np.argsort(ranks, kind="stable")[: self.prefix(n)]
            found.append(mixed(token[first] ^ _U(_ODD[0])))
        return np.unique(np.concatenate(found)) if found else np.empty(0, _U)

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def sketch(hashes: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parities of so many slots; two sets differ in at least as many shingles as sketches in bits."""
    odd = (np.bincount((hashes & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def fine_sketch(hashes: np.ndarray) -> np.ndarray:
    """A sketch with a bit for each shingle at least; empty where the short one has that many."""
    n = len(hashes)
    return sketch(hashes, 1 << (n - 1).bit_length()) if n > SKETCH_BITS else np.empty(0, np.int64)


@dataclass(frozen=True)
class Shingles:
    """What the index knows of the corpus: slots of shingles that stand out, and the share that recurs.

    Both steer the cost alone; whatever they are, linked sets meet in the index.
    """

    slots: np.ndarray
    counts: np.ndarray
    recurring: float

    def ranks(self) -> np.ndarray:
        """A rank per slot: the place among the counts that stand out, 0 for all other slots."""
        table = np.zeros(1 << SLOT_BITS, np.int32)
        table[self.slots[np.argsort(self.counts, kind="stable")]] = np.arange(1, len(self.slots) + 1)
        return table


def count_shingles(rows: DataFrame, rule: Similarity) -> Shingles:
    """Counts over all shingles of all documents; a task tells the slots that stand out in it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int32)
        total = again = 0
        for batch in batches:
            hashes = np.concatenate([*(shingles(text, rule.k) for text in bytes_of(batch)), np.empty(0, _U)])
            some = np.sort(hashes[hashes % _U(16) == 0])  # a sixteenth of all shingles, whatever the document
            total += len(some)
            again += int((some[1:] == some[:-1]).sum())
            np.add.at(counts, (hashes & _U((1 << SLOT_BITS) - 1)).astype(np.int64), 1)
        mean = counts.mean()
        slots = np.flatnonzero(counts > mean + 4 * math.sqrt(mean) + 2)
        columns = [np.append(slots, [-1, -2]), np.append(counts[slots].astype(np.int64), [total, again])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "n"])

    counted = staged_batches(map_batches(rows.select("text"), count, "slot bigint, n bigint"), "shingle-counts")
    summed = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # one row per slot at most
    slots, counts = summed["slot"].to_numpy(), summed["n"].to_numpy()
    total, again = (int(counts[slots == mark].sum()) for mark in (-1, -2))
    known = slots >= 0
    return Shingles(slots[known], counts[known], round(again / max(1, total), 2))


def _indexed(rows: DataFrame, rule: Similarity, known: Shingles) -> DataFrame:
    """doc_id, key, size, node, index entries and sketches of each document."""
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("key", T.LongType()),
        T.StructField("size", T.LongType()), T.StructField("node", T.LongType()),
        T.StructField("entries", T.ArrayType(T.LongType())),
        T.StructField("fine", T.ArrayType(T.LongType())),
        *[T.StructField(s, T.LongType()) for s in SKETCH],
    ])

    def lists(arrays: list[np.ndarray]) -> pa.ListArray:
        offsets = np.cumsum([0, *map(len, arrays)])
        values = np.concatenate([*arrays, np.empty(0, np.int64)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.ranks()
        for batch in batches:
            sizes, nodes, entries, fine, sketches = [], [], [], [], []
            for text in bytes_of(batch):
                hashes = shingle_set(text, rule.k)
                sizes.append(len(hashes))
                nodes.append(xxhash.xxh3_64_intdigest(hashes.tobytes()))
                ranks = table[(hashes & _U((1 << SLOT_BITS) - 1)).astype(np.int64)]
                entries.append(rule.index_entries(hashes, ranks, known.recurring).view(np.int64))
                fine.append(fine_sketch(hashes))
                sketches.append(sketch(hashes))
            parts = np.array(sketches, np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(np.array(nodes, _U).view(np.int64)), lists(entries), lists(fine),
                 *[pa.array(np.ascontiguousarray(parts[:, j])) for j in range(len(SKETCH))]],
                names=schema.names,
            )

    return staged_batches(map_batches(rows.select("doc_id", "key", "text"), index, schema), "indexed")


def _in_groups(pairs: DataFrame) -> DataFrame:
    """u, bucket, node and place: each u, at place 0, before some of the nodes it is paired with, at place 1."""
    sizes = pairs.groupBy("u").agg(F.ceil(F.count("*") / GROUP_NODES).alias("buckets"))
    dealt = pairs.join(small_or_shuffled(sizes), "u").select(
        "u", F.pmod(F.xxhash64("v"), "buckets").cast("int").alias("bucket"), "v"
    )
    first = dealt.select("u", "bucket", F.col("u").alias("node"), F.lit(0).alias("place")).distinct()
    return first.unionAll(dealt.select("u", "bucket", F.col("v").alias("node"), F.lit(1)))


def _linked(pairs: DataFrame, rows: DataFrame, involved: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (u, v) of nodes that link, as a written table.

    Texts are shuffled once, to groups of a node and a bounded number of those it is paired with,
    and sets are computed there: a text takes less room than its set, and is compressed besides.
    """
    pairs = staged(pairs.distinct(), "pairs")
    keys = involved.select("key", "node")
    members = staged(_in_groups(pairs).join(small_or_shuffled(keys), "node"), "paired")
    texts = rows.select("key", "text").join(small_or_shuffled(members), "key")
    grouped = texts.select("u", "bucket", "place", "node", "text").repartition("u", "bucket")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lead, last = None, np.empty(0, _U), None
        for batch in batches:
            us, buckets, places, nodes = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for u, bucket, place, node, text in zip(us, buckets, places, nodes, bytes_of(batch), strict=True):
                found = False
                if (u, bucket, place, node) != last:  # repeated rows have the same key
                    hashes = shingle_set(text, rule.k)
                    if place == 0:
                        group, lead = (u, bucket), hashes
                    else:
                        found = group == (u, bucket) and rule.links(lead, hashes)
                last = (u, bucket, place, node)
                keep.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3)], names=["u", "v"]
            ).filter(pa.array(keep, pa.bool_()))

    ordered = grouped.sortWithinPartitions("u", "bucket", "place", "node")
    return staged_batches(map_batches(ordered, verify, "u bigint, v bigint"), "links")


def _bits(x: str, y: str) -> F.Column:
    return sum(
        (F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in SKETCH), F.lit(0)
    )


def _one_per_node(pairs: DataFrame, involved: DataFrame, rule: Similarity) -> DataFrame:
    """Of the pairs (u, v) whose sizes and sketches allow a link the one with the least u for each v.

    Whole sets are sent for each pair, so a node is not compared with all leads of its entries:
    what one comparison leaves apart is looked at again.
    """
    known = small_or_shuffled(involved.drop("key", "fine"))
    x, y = known.alias("x"), known.alias("y")
    met = pairs.join(x, F.col("u") == F.col("x.node")).join(y, F.col("v") == F.col("y.node"))
    near = _finely_alike(met.where(_may_link(rule)).select("u", "v"), involved, rule)
    return near.groupBy("v").agg(F.min("u").alias("u")).select("u", "v")


def _allowed(rule: Similarity) -> F.Column:
    """The largest difference of x and y if they link."""
    total = F.col("x.size") + F.col("y.size")
    return F.floor(total * (100 - rule.percent) / (100 + rule.percent))


def _may_link(rule: Similarity) -> F.Column:
    """Whether the sizes and short sketches of x and y allow a link."""
    alike = 100 * F.least("x.size", "y.size") >= rule.percent * F.greatest("x.size", "y.size")
    return alike & (_bits("x", "y") <= _allowed(rule))


def _fine_bits() -> F.Column:
    """In how many bits the fine sketches of x and y differ; that of twice the length is folded first.

    Nothing is counted where one is empty, or more than twice as long as the other.
    """
    x, y = F.col("x.fine"), F.col("y.fine")
    words, most = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))

    def folded(of: F.Column, i: F.Column) -> F.Column:
        return F.get(of, i).bitwiseXOR(F.coalesce(F.get(of, i + words), F.lit(0).cast("bigint")))

    places = F.when((words > 0) & (most <= 2 * words), F.sequence(F.lit(0), words - 1))
    differ = F.aggregate(
        places, F.lit(0), lambda n, i: n + F.bit_count(folded(x, i).bitwiseXOR(folded(y, i)))
    )
    return F.coalesce(differ, F.lit(0))


def _finely_alike(pairs: DataFrame, involved: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (u, v) whose fine sketches, where both have one, allow a link.

    They are a few hundredths as long as sets and texts, of which only what passes here is sent.
    """
    known = small_or_shuffled(involved.select("node", "size", "fine").where(F.size("fine") > 0))
    x, y = known.alias("x"), known.alias("y")
    met = pairs.join(x, F.col("u") == F.col("x.node"), "left").join(y, F.col("v") == F.col("y.node"), "left")
    return met.where(F.coalesce(_fine_bits() <= _allowed(rule), F.lit(True))).select("u", "v")


def _open_pairs(rest: DataFrame, involved: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (u, v) of different components that share an entry and may link.

    A pair that shares several entries comes out at the least of them only, and only if
    sizes and sketches allow a link: the other pairs of a group are not produced.
    """
    own = rest.groupBy("node").agg(F.sort_array(F.collect_set("entry")).alias("entries"))
    wide = staged(rest.join(involved.drop("key", "fine"), "node").join(own, "node"), "rest")
    first_shared = F.array_min(F.array_intersect("x.entries", "y.entries"))
    near = wide.alias("x").join(
        wide.alias("y"),
        (F.col("x.entry") == F.col("y.entry"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.label") != F.col("y.label"))
        & _may_link(rule)
        & (F.col("x.entry") == first_shared),
    ).select(F.col("x.node").alias("u"), F.col("y.node").alias("v"))
    return _finely_alike(staged(near, "near"), involved, rule)


def _marked_entries(indexed: DataFrame, marks: Bitmap) -> DataFrame:
    """node and entry of the marked index entries; most entries are of one node, and go no further."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = marks.test()
        for batch in batches:
            found = batch.column(1)
            values = found.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(found)), found.value_lengths().to_numpy(zero_copy_only=False))
            kept = np.flatnonzero(test(values.view(_U)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner[kept])), pa.array(values[kept])], names=["node", "entry"]
            )

    return staged_batches(map_batches(indexed.select("node", "entries"), mark, "node bigint, entry bigint"), "met")


def jaccard_components(
    docs: DataFrame, rule: Similarity, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id that links reach, per document.

    `key` tells rows with equal ids apart.
    """
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    indexed = _indexed(rows, rule, count_shingles(rows, rule))
    nodes = indexed.where("size > 0").groupBy("node").agg(
        F.min("key").alias("key"), F.min("size").alias("size"), F.min("fine").alias("fine"),
        *[F.min(s).alias(s) for s in SKETCH],
    )
    entries = indexed.select("node", F.explode("entries").alias("entry"))
    # Copies of a set change neither the least nor the greatest node of an entry.
    shared = staged(
        entries.groupBy("entry").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .where("first < last").select("entry", "first"),
        "shared",
    )
    met = _marked_entries(indexed, Bitmap.of(shared.select(F.col("entry").alias("d1"))))
    members = staged(
        met.join(small_or_shuffled(shared), "entry").select("entry", "first", "node").distinct(),
        "members",
    )
    involved = staged(
        nodes.join(small_or_shuffled(members.select("node").distinct()), "node", "left_semi"),
        "involved",
    )
    stars = members.where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    links = _linked(_one_per_node(stars.distinct(), involved, rule), rows, involved, rule)
    labels = components(links)

    def placed() -> DataFrame:
        """Index entries that are shared by nodes of different components, and these nodes."""
        place = members.join(small_or_shuffled(labels), "node", "left").select(
            "entry", "node", F.coalesce("label", "node").alias("label")
        )
        entry = place.groupBy("entry").agg(
            F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("f"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("g"),
        )
        # Of entries with the very same nodes one is enough.
        alike = entry.where("a < b").groupBy("n", "f", "g").agg(F.min("entry").alias("entry"))
        still_open = staged(alike.select("entry"), "open")
        return staged(place.join(small_or_shuffled(still_open), "entry", "left_semi"), "placed")

    rest = placed()
    # A second star around another member joins most of what the first left apart.
    second = rest.groupBy("entry").agg(
        F.min(F.struct(F.xxhash64("node").alias("order"), "node", "label")).alias("lead")
    )
    across = rest.join(small_or_shuffled(second), "entry").where(F.col("label") != F.col("lead.label"))
    across = across.select(F.col("lead.node").alias("u"), F.col("node").alias("v"))
    more = _linked(_one_per_node(across.distinct(), involved, rule), rows, involved, rule)
    if not more.isEmpty():
        links = links.unionAll(more)
        labels = components(links)
        rest = placed()
    more = _linked(_open_pairs(rest, involved, rule), rows, involved, rule)
    if not more.isEmpty():
        labels = components(links.unionAll(more))
    return _with_components(indexed, labels)


def _with_components(indexed: DataFrame, labels: DataFrame) -> DataFrame:
    """Least doc_id per component; documents without shingles stay alone."""
    labelled = indexed.where("size > 0").select("doc_id", "key", "size", "node").join(
        small_or_shuffled(labels), "node", "left"
    )
    label = F.coalesce("label", "node").alias("label")
    labelled = staged(labelled.select("doc_id", "key", "size", label), "labelled")
    least = labelled.groupBy("label").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("n")
    )
    grouped = staged(least.where("n > 1").drop("n"), "grouped")
    found = labelled.join(small_or_shuffled(grouped), "label", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "key",
    )
    alone = indexed.where("size = 0").select(
        "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"), "key"
    )
    return found.unionAll(alone)


def without_near_copies(
    docs: DataFrame, rule: Similarity, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that have the least id of their component, all columns as they were.

    Linked rows with that same id stay together.
    """
    found = jaccard_components(docs, rule, id_col, text_col)
    others = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    dropped = staged(others.select(F.col("key").alias("_dropped_key")).distinct(), "near-copies")
    key = row_key(docs[id_col], F.coalesce(docs[text_col], F.lit("")))
    return docs.join(small_or_shuffled(dropped), key == F.col("_dropped_key"), "left_anti")
