"""Ranked lexical search: the best documents of every query, by term-at-a-time scoring.

Terms are runs of 0-9, a-z (A-Z in lower case) and characters beyond ASCII. The weight of a
term falls with the documents that hold it; the rest of a score is whole-number arithmetic.

A first pass over the texts writes shards of an index: for some thousand documents the
postings of the queries' terms, by term. Counts of the corpus are sums over the shards. A second
pass scores each shard term at a time, rarest first, with an accumulator per document. Once the
terms that remain cannot lift a new document to the kth partial score, no accumulator is created
any more; those that exist are updated to their exact scores. A task keeps the best of the shards
it has seen, so later shards start with their kth score. The best of all tasks are ranked last.

Queries come in blocks of bounded size, each met by all rows. A null text has no terms; such a
document counts nowhere. A repeated document row is a document of its own; rows that share a query
id, also null, are one query. Queries without a term, or whose terms occur nowhere, have no rows.
Document ids are whole numbers; among equal scores a null id comes last.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import bytes_of, id_and_text, staged_batches
from segmart.llm.decontamination import FOLD, PIECE_BYTES

TOP = 50
SCALE = 1_000_000_000

# A block of queries has about so many pairs of query and term; one query is never cut.
BLOCK_TERMS = 500_000

# A shard of the index is written at so many documents or postings.
SHARD_DOCS = 16_384
SHARD_POSTINGS = 2_000_000

# A task gets one shard at a time.
ONE_ROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}

# Shares of the last ranking, so that no task gets all candidates of one query.
RANK_SHARES = 16

NULL_ID = np.iinfo(np.int64).max


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in their order, piece by piece."""
    flat = text.translate(FOLD)
    at = 0
    while at < len(flat):
        stop = flat.find(b" ", at + PIECE_BYTES)
        stop = len(flat) if stop < 0 else stop
        yield flat[at:stop].split()
        at = stop


# -- queries ----------------------------------------------------------------------------

def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of every query."""
    rows = id_and_text(items, id_col, text_col).withColumnRenamed("doc_id", "item_id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(bytes_of(batch)):
                found = {term for piece in terms_of(text) for term in piece}
                if found:
                    ids = batch.column(0).take(pa.array(np.full(len(found), i)))
                    terms = pa.array(sorted(found), pa.binary())
                    yield pa.RecordBatch.from_arrays([ids, terms], names=["item_id", "term"])

    schema = T.StructType([rows.schema["item_id"], T.StructField("term", T.BinaryType())])
    return staged_batches(rows.mapInArrow(split, schema).distinct(), "query-terms")


class _Numbers(dict):
    """Numbers of the queries' terms; -1 for any other term."""

    def __missing__(self, term: bytes) -> int:
        return -1


@dataclass(frozen=True)
class QueryBlock:
    """Queries of one block: their ids, their distinct terms, and the terms of each by number."""

    ids: pa.Array
    terms: dict[bytes, int]
    wanted: list[np.ndarray]


def query_blocks(queries: DataFrame) -> Iterator[QueryBlock]:
    """Blocks of whole queries, dealt by a hash; the driver holds one of them at a time."""
    n_blocks = -(-queries.count() // BLOCK_TERMS)
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    for number in range(n_blocks):
        pairs = queries.where(block == number).toArrow()
        by_query: dict[object, list[int]] = {}
        terms: dict[bytes, int] = {}
        for item_id, term in zip(pairs["item_id"].to_pylist(), pairs["term"].to_pylist()):
            by_query.setdefault(item_id, []).append(terms.setdefault(term, len(terms)))
        if terms:
            ids = pa.array(list(by_query), pairs.schema.field("item_id").type)
            yield QueryBlock(ids, terms, [np.array(t, np.int64) for t in by_query.values()])


# -- index ------------------------------------------------------------------------------

SHARD = """docs array<bigint>, lengths array<bigint>, terms array<int>, counts array<int>,
    places array<int>, times array<int>"""
SHARD_COLUMNS = ["docs", "lengths", "terms", "counts", "places", "times"]


class _Shard:
    """Documents and postings gathered for one shard."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.postings: list[np.ndarray] = []  # of term, place and times
        self.n_postings = 0

    def add(self, doc_id: int | None, text: bytes, number: Callable[[bytes], int]) -> None:
        length, codes = 0, []
        for piece in terms_of(text):
            length += len(piece)
            numbers = np.fromiter(map(number, piece), np.int64, len(piece))
            codes.append(numbers[numbers >= 0])
        if not length:
            return
        found, times = np.unique(np.concatenate(codes), return_counts=True)
        self.postings.append(np.array([found, np.full(len(found), len(self.docs)), times], np.int32))
        self.n_postings += len(found)
        self.docs.append(doc_id)
        self.lengths.append(length)

    def full(self) -> bool:
        return len(self.docs) >= SHARD_DOCS or self.n_postings >= SHARD_POSTINGS

    def batch(self) -> pa.RecordBatch:
        """One row: postings by term, those of a term in the order of the documents."""
        term, place, times = np.concatenate(self.postings, axis=1)
        order = np.argsort(term, kind="stable")
        found, counts = np.unique(term, return_counts=True)
        values = [
            pa.array(self.docs, pa.int64()), pa.array(self.lengths, pa.int64()),
            *[pa.array(x.astype(np.int32)) for x in (found, counts, place[order], times[order])],
        ]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]
        return pa.RecordBatch.from_arrays(lists, names=SHARD_COLUMNS)


def index_shards(docs: DataFrame, block: QueryBlock) -> DataFrame:
    """Shards of an index over all documents with a term, for the terms of a block of queries."""
    terms = block.terms

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _Numbers(terms).__getitem__
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), bytes_of(batch)):
                shard.add(doc_id, text, number)
                if shard.full():
                    yield shard.batch()
                    shard = _Shard()
        if shard.docs:
            yield shard.batch()

    return staged_batches(docs.mapInArrow(index, SHARD), "index")


@dataclass(frozen=True)
class Corpus:
    """Counts over all documents that hold a term, and the weight of each query term."""

    n_docs: int
    n_terms: int
    weights: np.ndarray


def corpus_counts(shards: DataFrame, block: QueryBlock) -> Corpus:
    """Sums over all shards; the driver gets one number per query term of the block."""
    lengths = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda total, n: total + n)
    n_docs, n_terms = shards.agg(F.sum(F.size("docs")), F.sum(lengths)).first()
    held = np.zeros(len(block.terms), np.int64)
    pairs = shards.select(F.inline(F.arrays_zip("terms", "counts")))
    for term, df in pairs.groupBy("terms").agg(F.sum("counts")).collect():
        held[term] = df
    n = n_docs or 0
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in held]
    return Corpus(n, n_terms or 0, np.array(weights, np.int64))


# -- scoring ----------------------------------------------------------------------------

def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` highest scores, equal ones by ascending id."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:top]


def term_at_a_time(
    lists: list[tuple[int, np.ndarray, np.ndarray, int]], n_docs: int, floor: int, top: int
) -> np.ndarray:
    """Scores of a shard's documents for one query; those that cannot be among the best may stay 0.

    A list holds the weight of a term, the documents that have it, their shares of the score and
    the greatest of these. `floor` is a kth score known already, 0 if there is none.
    """
    lists = sorted(lists, key=lambda x: -x[0])
    bounds = np.cumsum([weight * most for weight, _, _, most in reversed(lists)])[::-1]
    scores = np.zeros(n_docs, np.int64)
    limited = False
    for (weight, places, shares, _), left in zip(lists, bounds):
        if not limited and (floor > left or scores.max(initial=0) > left):
            if n_docs > top:
                floor = max(floor, int(np.partition(scores, n_docs - top)[n_docs - top]))
            limited = floor > left
        if limited:
            known = scores[places] > 0
            places, shares = places[known], shares[known]
        scores[places] += weight * shares
    return scores


def _rank_shards(
    block: QueryBlock, corpus: Corpus, top: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        kept = [(empty, empty)] * len(block.wanted)  # scores and documents, best first
        for batch in batches:
            for row in range(batch.num_rows):
                docs, lengths, terms, counts, places, times = (
                    batch.column(c)[row].values for c in SHARD_COLUMNS
                )
                ids = docs.fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                lengths, terms, counts, places, times = (
                    x.to_numpy().astype(np.int64) for x in (lengths, terms, counts, places, times)
                )
                m = 50 + np.array([50 * int(n) * corpus.n_docs // corpus.n_terms for n in lengths], np.int64)
                shares = SCALE * times // (1000 * times + 20 * m[places])
                stops = np.cumsum(counts)
                starts = stops - counts
                at = np.full(len(block.terms), -1)
                at[terms] = np.arange(len(terms))
                most = np.maximum.reduceat(shares, starts) if len(starts) else empty
                for q, wanted in enumerate(block.wanted):
                    lists = [
                        (int(corpus.weights[t]), places[starts[a] : stops[a]], shares[starts[a] : stops[a]], int(most[a]))
                        for t, a in zip(wanted, at[wanted]) if a >= 0
                    ]
                    if not lists:
                        continue
                    scores, held = kept[q]
                    floor = int(scores[-1]) if len(scores) == top else 0
                    found = term_at_a_time(lists, len(ids), floor, top)
                    chosen = np.flatnonzero(found >= max(floor, 1))
                    scores = np.concatenate([scores, found[chosen]])
                    held = np.concatenate([held, ids[chosen]])
                    order = best(scores, held, top)
                    kept[q] = scores[order], held[order]
        sizes = [len(scores) for scores, _ in kept]
        if sum(sizes):
            held = np.concatenate([ids for _, ids in kept])
            columns = [
                block.ids.take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
                pa.array(held, mask=held == NULL_ID),
                pa.array(np.concatenate([scores for scores, _ in kept])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    return rank


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The `top` best rows of each query, first within shares of them, with their rank."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("item_id", "share").orderBy(*order)
    shares = found.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(RANK_SHARES)))
    first = shares.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    whole = Window.partitionBy("item_id").orderBy(*order)
    return first.drop("share").withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0."""
    queries = query_terms(items, item_id_col, item_text_col)
    rows = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), "text")
    schema = T.StructType([queries.schema["item_id"], *T.StructType.fromDDL("doc_id bigint, score bigint").fields])
    found = rows.sparkSession.createDataFrame([], schema)
    for block in query_blocks(queries):
        shards = index_shards(rows, block)
        scored = shards.mapInArrow(_rank_shards(block, corpus_counts(shards, block), top), schema)
        found = found.unionByName(staged_batches(scored, "scored", **ONE_ROW))
    return ranked(found, top).select("item_id", "rank", "doc_id", "score")
