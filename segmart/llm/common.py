"""Helpers the operators share: input columns, words, batches for Python tasks, staged tables."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart.operators.joins import fits_broadcast
from segmart.session import staged

# A run of the characters that separate words, and any other character.
SPACE_RUN = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"

# A Python task sees at most this many rows and bytes of text at once.
PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under names of its own; a null text is empty.

    Whatever else the input carries, also under clashing names, is left behind here.
    """
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever the case of letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def normalised(text: Column) -> Column:
    """The text with every run of white space replaced by one space."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def words(text: Column) -> Column:
    """The words of a text that is not null, an empty array if there is none."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo the divisor; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def row_key(doc_id: Column, text: Column) -> Column:
    """A number for an id and its text; rows equal in both count as one document."""
    return F.xxhash64(doc_id, text)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for the jobs run inside, and go back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staged_batches(df: DataFrame, name: str, **conf: str) -> DataFrame:
    """Run a frame with Python tasks over bounded batches and write it to the shared folder.

    The batch limits are session settings, so the work is done here, while they hold.
    """
    with settings(df.sparkSession, BATCH_CONF | conf):
        return staged(df, name)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(function, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def bytes_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column, without a decoding step."""
    column = batch.column(batch.schema.get_field_index(name))
    large = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of recent words, but for very long ones; emptied when it is full."""

    LIMIT = 400_000
    LONGEST = 64

    def __missing__(self, word: bytes) -> int:
        if len(word) > self.LONGEST:
            return xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = WordHashes()


# The hash of one word.
word_hash = _word_hashes.__getitem__


def hashed_words(text: bytes) -> np.ndarray:
    """The hashes of a text's words, A-Z in lower case, in their order; a long text piece by piece."""
    parts, at = [], 0
    while at < len(text):
        gap = _SPACE.search(text, at + PIECE_BYTES)
        stop = gap.start() if gap else len(text)
        tokens = text[at:stop].lower().split()
        parts.append(np.fromiter(map(word_hash, tokens), np.uint64, len(tokens)))
        at = stop
    return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.uint64)])


def small_or_shuffled(df: DataFrame) -> DataFrame:
    """A join side marked for broadcast if its measured size allows it."""
    return F.broadcast(df) if fits_broadcast(df) else df
