"""Hard-negative mining by Fagin's threshold algorithm over blocks of vectors.

Rows of one label are gathered in blocks. In each block every dimension has the rows sorted by
their value there. For an anchor these lists are read from the end its sign asks for, all to the
same depth; each row met is scored in full, and the inner product of the anchor with the values at
that depth is the threshold: no row not met yet scores more. Reading stops once the threshold
is strictly below what a row must reach: for positives the last of the best so far, for
negatives, in each window of scores, the last of the best so far or the window's lower end.

Two rounds meet the stated anchors with all blocks: blocks of their own label for the
positives, blocks of the other labels for the negatives. Anchors come in bounded parts. A task keeps
the best of all blocks it has seen, so later blocks are read less deep.

Components are floor(256 * x), and all scores whole numbers; a score beyond 64 bits is an error. Rows
with a null label or vector, or a null or non-finite component, take no part. A missing
component of a shorter vector counts as 0. Of repeated ids each row is a row of its own, and of
several anchor rows with one id each has its own result. A null id is no anchor, and comes
last among equal scores. An anchor without another row of its label, or without negatives, has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmart.llm.common import small_or_shuffled, staged_batches
from segmart.session import staged

POSITIVES = 5
NEGATIVES = 10
SCALE = 256
LOW, HIGH, WHOLE = 30, 90, 100  # a negative has 30 to 90 hundredths of the positive's score

BLOCK_ROWS = 8_192
PART_ANCHORS = 1_024
# Parts of anchors that meet the blocks in one job; a task keeps the results of so many anchors.
GROUP_PARTS = 16

# A task gets one block and one part of anchors at a time.
ONE_ROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
SORTED_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}

NULL_ID = np.iinfo(np.int64).max
NO_SCORE = -(1 << 63)

BLOCK = "label bigint, dims int, ids array<bigint>, numbers array<bigint>, vectors array<bigint>"


# -- rows -------------------------------------------------------------------------------

def usable_rows(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    label: Column | None = None,
) -> DataFrame:
    """(number, vec_id, label, vector): rows that take part, with whole components."""
    vector = F.transform(vectors[vector_col], lambda x: F.floor(x.cast("double") * SCALE))
    whole = F.forall(
        vectors[vector_col],
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)),
    )
    rows = vectors.select(
        F.monotonically_increasing_id().alias("number"),
        vectors[id_col].cast("bigint").alias("vec_id"),
        (vectors[label_col] if label is None else label).cast("bigint").alias("label"),
        F.when(whole, vector).alias("vector"),
    ).where("label IS NOT NULL AND vector IS NOT NULL")
    return staged(rows, "vectors")


def gathered(batches: Iterator[pa.RecordBatch], limit: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by label as blocks of one label, of `limit` rows at most."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held, label = 0, None

    def block() -> pa.RecordBatch:
        ids, numbers, values = (np.concatenate(x) for x in zip(*parts))
        lists = [
            pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(v.ravel()))
            for v in (ids, numbers, values)
        ]
        columns = [pa.array([label], pa.int64()), pa.array([dims], pa.int32()), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["label", "dims", "ids", "numbers", "vectors"])

    for batch in batches:
        labels = batch.column(2).to_numpy()
        ids = batch.column(1).fill_null(NULL_ID).to_numpy()
        numbers = batch.column(0).to_numpy()
        vectors = batch.column(3)
        sizes = vectors.value_lengths().to_numpy()
        dense = np.zeros((len(labels), dims), np.int64)
        dense[np.arange(dims) < sizes[:, None]] = vectors.flatten().to_numpy()
        at = 0
        while at < len(labels):
            if held and (held >= limit or labels[at] != label):
                yield block()
                parts, held = [], 0
            label = int(labels[at])
            stop = min(at + limit - held, int(np.searchsorted(labels, label, "right")))
            parts.append((ids[at:stop], numbers[at:stop], dense[at:stop]))
            held += stop - at
            at = stop
    if held:
        yield block()


def blocks_of(rows: DataFrame, dims: int, limit: int, n_parts: int, name: str) -> DataFrame:
    """Blocks of rows of one label. The row's number takes part in the range, so a large label is split."""
    ranged = rows.repartitionByRange(n_parts, "label", "number").sortWithinPartitions("label", "number")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(batches, limit, dims)

    return staged_batches(ranged.mapInArrow(gather, BLOCK), name, **SORTED_ROWS)


# -- threshold algorithm ----------------------------------------------------------------

class SortedBlock:
    """A block's rows, and for each dimension its rows in the order of their values."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.numbers = ids, numbers
        self.largest = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)))
        self.vectors = vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T)
        self.values = np.ascontiguousarray(np.take_along_axis(vectors, order, axis=0).T)
        self.floats = vectors.astype(np.float64)

    def bound(self, anchor: np.ndarray) -> int:
        """No inner product with the anchor, nor a part of its sum, is larger."""
        return max(int(anchor.max(initial=0)), -int(anchor.min(initial=0))) * self.largest * len(anchor)

    def met(
        self, anchor: np.ndarray, must_reach: Callable[[], int], take: Callable[[np.ndarray, np.ndarray], None]
    ) -> None:
        """Hand rows and their scores to `take` until no other row can reach `must_reach()`."""
        n = len(self.ids)
        bound = self.bound(anchor)
        if bound >= 1 << 63:
            raise ValueError("inner products do not fit 64 bits")
        exact = bound >= 1 << 53  # below it, sums of doubles are exact too, and much faster
        used = np.flatnonzero(anchor)
        if not len(used):  # all scores are 0
            if must_reach() <= 0:
                take(np.arange(n), np.zeros(n, np.int64))
            return
        falling = anchor[used] > 0
        weights = anchor[used] if exact else anchor[used].astype(np.float64)
        seen = np.zeros(n, bool)
        depth, step = 0, max(4, n // (2 * len(used)))
        while True:
            # The threshold at this depth: the values that come next, from the end the sign asks for.
            ends = np.where(falling, n - 1 - depth, depth)
            threshold = int(weights @ self.values[used, ends])
            if threshold < must_reach():
                return
            stop = min(n, depth + step)
            rows = np.concatenate([
                self.order[used[falling], n - stop : n - depth].ravel(),
                self.order[used[~falling], depth:stop].ravel(),
            ])
            fresh = np.zeros(n, bool)
            fresh[rows] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            if len(rows):
                scores = self.vectors[rows] @ anchor if exact else (self.floats[rows] @ anchor).astype(np.int64)
                take(rows, scores)
            if stop == n or seen.all():
                return
            depth, step = stop, 2 * step


class Best:
    """The best few (score, id, number) so far: higher scores first, then smaller ids."""

    __slots__ = ("size", "scores", "ids", "numbers")

    def __init__(self, size: int) -> None:
        self.size = size
        self.scores = self.ids = self.numbers = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        if len(self.scores) == self.size:
            near = scores >= self.scores[-1]
            scores, ids, numbers = scores[near], ids[near], numbers[near]
        if not len(scores):
            return
        if len(scores) > 4 * self.size:
            least = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            near = scores >= least
            scores, ids, numbers = scores[near], ids[near], numbers[near]
        scores = np.concatenate([self.scores, scores])
        ids, numbers = np.concatenate([self.ids, ids]), np.concatenate([self.numbers, numbers])
        order = np.lexsort((numbers, ids, -scores))[: self.size]
        self.scores, self.ids, self.numbers = scores[order], ids[order], numbers[order]

    def full(self) -> bool:
        return len(self.scores) == self.size


def positives_in(block: SortedBlock, anchor: np.ndarray, number: int, best: Best) -> None:
    """Add the block's best rows, the anchor's own row left out."""
    def take(rows: np.ndarray, scores: np.ndarray) -> None:
        other = block.numbers[rows] != number
        best.add(scores[other], block.ids[rows[other]], block.numbers[rows[other]])

    block.met(anchor, lambda: int(best.scores[-1]) if best.full() else NO_SCORE, take)


def negatives_in(
    block: SortedBlock, anchor: np.ndarray, windows: list[tuple[int, int, Best]]
) -> None:
    """Add the block's best rows to each window of scores from its least to its greatest."""
    windows = [w for w in windows if w[0] <= w[1]]
    if not windows:
        return

    def take(rows: np.ndarray, scores: np.ndarray) -> None:
        for low, high, best in windows:
            inside = rows[(scores >= low) & (scores <= high)]
            if len(inside):
                kept = scores[(scores >= low) & (scores <= high)]
                best.add(kept, block.ids[inside], block.numbers[inside])

    block.met(
        anchor,
        lambda: min(int(best.scores[-1]) if best.full() else low for low, _, best in windows),
        take,
    )


# -- rounds -----------------------------------------------------------------------------

def anchor_parts(rows: DataFrame, dims: int, n_parts: int, windows: DataFrame | None = None) -> DataFrame:
    """(part, a_...): anchors in parts of about `PART_ANCHORS`, dealt by a hash of the row.

    With `windows`, (anchor, positives), anchors without a positive are left out.
    """
    padded = F.concat("vector", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("vector")))
    held = rows.select("number", F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), "label", padded.alias("vector"))
    more = []
    if windows is not None:
        held = held.join(windows.withColumnRenamed("anchor", "number"), "number")
        more = [
            F.transform("row.positives", F.size).alias("a_counts"),
            F.transform(F.flatten("row.positives"), lambda p: p["positive"]).alias("a_positives"),
            F.transform(F.flatten("row.positives"), lambda p: p["score"]).alias("a_scores"),
        ]
    part = F.pmod(F.xxhash64("number"), F.lit(n_parts)).alias("part")
    gathered_rows = held.select(part, F.struct(*held.columns).alias("row")).groupBy("part").agg(
        F.collect_list("row").alias("row")
    )
    return gathered_rows.select(
        "part", F.col("row.number").alias("a_numbers"), F.col("row.vec_id").alias("a_ids"),
        F.col("row.label").alias("a_labels"), F.flatten("row.vector").alias("a_vectors"), *more,
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, SortedBlock, dict]]:
    """The label and rows of each block with one part of anchors; a block comes with all its parts."""
    key = block = None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns)}
            arrays = {
                name: value.values.to_numpy(zero_copy_only=False)
                for name, value in row.items() if pa.types.is_list(value.type)
            }
            dims = row["dims"].as_py()
            if key != row["first"].as_py():
                key = row["first"].as_py()
                block = SortedBlock(arrays["ids"], arrays["numbers"], arrays["vectors"].reshape(len(arrays["ids"]), dims))
            arrays["a_vectors"] = arrays["a_vectors"].reshape(len(arrays["a_ids"]), dims)
            yield row["label"].as_py(), block, arrays


def _batch(columns: list[np.ndarray], schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    arrays = [
        pa.array(c, pa.int64(), mask=c == NULL_ID if name.endswith("_id") else None)
        for name, c in zip(names, columns)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=names)


POSITIVE_ROWS = "anchor bigint, anchor_id bigint, positive bigint, positive_id bigint, positive_score bigint"


def _find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, tuple[int, Best]] = {}
    for label, block, part in _pairs(batches):
        for i in np.flatnonzero(part["a_labels"] == label):
            number = int(part["a_numbers"][i])
            _, best = found.setdefault(number, (int(part["a_ids"][i]), Best(POSITIVES)))
            positives_in(block, part["a_vectors"][i], number, best)
    for number, (anchor_id, best) in found.items():
        k = len(best.scores)
        columns = [np.full(k, number), np.full(k, anchor_id), best.numbers, best.ids, best.scores]
        yield _batch(columns, POSITIVE_ROWS)


NEGATIVE_ROWS = "anchor bigint, positive bigint, negative bigint, negative_id bigint, negative_score bigint"


def _find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[int, int], tuple[int, int, Best]] = {}
    for label, block, part in _pairs(batches):
        stops = np.cumsum(part["a_counts"])
        starts = stops - part["a_counts"]
        for i in np.flatnonzero(part["a_labels"] != label):
            number, windows = int(part["a_numbers"][i]), []
            for j in range(starts[i], stops[i]):
                key = number, int(part["a_positives"][j])
                if key not in found:
                    score = int(part["a_scores"][j])
                    found[key] = -(-LOW * score // WHOLE), HIGH * score // WHOLE, Best(NEGATIVES)
                windows.append(found[key])
            negatives_in(block, part["a_vectors"][i], windows)
    for (number, positive), (_, _, best) in found.items():
        k = len(best.scores)
        columns = [np.full(k, number), np.full(k, positive), best.numbers, best.ids, best.scores]
        yield _batch(columns, NEGATIVE_ROWS)


def _met(blocks: DataFrame, parts: DataFrame, n_parts: int, function: Callable, schema: str, name: str) -> DataFrame:
    """Run a function over all blocks, each with all parts of anchors, group after group."""
    found = blocks.sparkSession.createDataFrame([], schema)
    for first in range(0, n_parts, GROUP_PARTS):
        last = min(first + GROUP_PARTS, n_parts) - 1
        group = small_or_shuffled(parts.where(F.col("part").between(first, last)))
        pairs = (
            blocks.withColumn("first", F.element_at("numbers", 1))
            .withColumn("part", F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))))
            .join(group, "part")
        )
        rows = pairs.drop("part").mapInArrow(function, schema)
        found = found.unionByName(staged_batches(rows, name, **ONE_ROW))
    return found


def hard_negatives(
    vectors: DataFrame, anchors: Column | None = None, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label", label: Column | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` is a condition on `vec_id`, by default that 100 divides it. `label` replaces the
    label column by an expression over the input.
    """
    spark = vectors.sparkSession
    rows = usable_rows(vectors, id_col, vector_col, label_col, label)
    stated = rows.where((F.col("vec_id") % 100 == 0) if anchors is None else anchors)
    n_rows, dims = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    dims = dims or 0
    n_tasks = max(spark.sparkContext.defaultParallelism, -(-n_rows // BLOCK_ROWS))
    blocks = blocks_of(rows, dims, BLOCK_ROWS, n_tasks, "blocks")
    n_parts = -(-stated.count() // PART_ANCHORS)

    parts = staged(anchor_parts(stated, dims, max(n_parts, 1)), "anchors")
    found = _met(blocks, parts, n_parts, _find_positives, POSITIVE_ROWS, "positives")
    order = Window.partitionBy("anchor").orderBy(
        F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), "positive"
    )
    positives = staged(
        found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES), "positives"
    )
    windows = positives.groupBy("anchor").agg(
        F.collect_list(F.struct("positive", F.col("positive_score").alias("score"))).alias("positives")
    )
    parts = staged(anchor_parts(stated, dims, max(n_parts, 1), windows), "anchors")
    found = _met(blocks, parts, n_parts, _find_negatives, NEGATIVE_ROWS, "negatives")
    order = Window.partitionBy("anchor", "positive").orderBy(
        F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), "negative"
    )
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return first.join(positives, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
