"""Token files: Arrow IPC files of equal-length sequences with masks, in id order.

Documents are range-partitioned and sorted by id; each task encodes its range and writes
files of bounded size. A file holds whole documents: their ids, one after the other, cut
into sequences of a fixed length and batches of a fixed number of sequences, so sequence
k lies in batch k // BATCH_SEQUENCES and is read there without copying. The mask is false
on the padding at the end of a file. Beside it lies an index file with one row per
document. A task that is run again writes the same files, under a name that is complete
or absent.

Defined results: a null or empty text is the end id alone. Null ids come first. Rows with
equal ids follow each other in the order of their texts' hashes. An empty table has no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import id_and_text, map_batches, staged_batches, texts_of
from segmart.llm.tokens import Vocabulary

SEQUENCE_LENGTH = 2048
BATCH_SEQUENCES = 256
FILE_IDS = 4 << 20
END_ID = 0
MANIFEST = "part int, file int, path string, n_docs bigint, n_ids bigint"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, local or shared, and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def id_type(n_ids: int) -> pa.DataType:
    """The narrowest unsigned type for a vocabulary of so many ids."""
    return pa.uint16() if n_ids <= 1 << 16 else pa.uint32()


def sequence_schema(value_type: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(value_type, length)), ("mask", pa.list_(pa.bool_(), length))
    ])


def write_whole(filesystem: fs.FileSystem, path: str, schema: pa.Schema, batches, attempt: str) -> None:
    """Write an Arrow file under a name of this attempt and move it into place."""
    partial = f"{path}.{attempt}"
    with filesystem.open_output_stream(partial) as sink, pa.ipc.new_file(sink, schema) as writer:
        for batch in batches:
            writer.write_batch(batch)
    filesystem.move(partial, path)


def sequence_batches(ids: np.ndarray, schema: pa.Schema, length: int) -> Iterator[pa.RecordBatch]:
    """The ids as batches of equal-length sequences; the last sequence is padded and masked."""
    step = length * BATCH_SEQUENCES
    for start in range(0, len(ids), step):
        part = ids[start : start + step]
        n_sequences = -(-len(part) // length)
        padded = np.zeros(n_sequences * length, ids.dtype)
        padded[: len(part)] = part
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(padded), length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(padded)) < len(part)), length),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: Vocabulary,
    length: int = SEQUENCE_LENGTH,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the files and return the manifest, one row per file, as a written table."""
    ordered = (
        id_and_text(docs, id_col, text_col)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ranks = vocabulary.encoder(), vocabulary.size()
        schema = sequence_schema(id_type(ranks), length)
        filesystem, root = open_folder(folder)
        context = TaskContext.get()
        part, attempt = context.partitionId(), f"{context.taskAttemptId()}.partial"
        manifest: list[tuple] = []
        doc_ids: list[pa.Array] = []
        pieces: list[bytes] = []

        def finish() -> None:
            number = len(manifest)
            path = f"{root}/ids-{part:06d}-{number:05d}.arrow"
            sizes = np.array([len(p) // 4 for p in pieces], np.int64)
            ids = np.frombuffer(b"".join(pieces), "<u4").astype(id_type(ranks).to_pandas_dtype())
            write_whole(filesystem, path, schema, sequence_batches(ids, schema, length), attempt)
            index = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(doc_ids), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes)],
                names=["doc_id", "start", "n_tokens"],
            )
            write_whole(filesystem, f"{path}.index", index.schema, [index], attempt)
            manifest.append((part, number, path, len(pieces), int(sizes.sum())))
            doc_ids.clear()
            pieces.clear()

        n_ids = 0
        filesystem.create_dir(root, recursive=True)
        for batch in batches:
            first = 0
            texts = texts_of(batch)
            for row, text in enumerate(texts):
                pieces.append(encoder.ids(text) + end)
                n_ids += len(pieces[-1]) // 4
                if n_ids >= file_ids or row + 1 == len(texts):
                    doc_ids.append(batch.column(0).slice(first, row + 1 - first))
                    first = row + 1
                if n_ids >= file_ids:
                    finish()
                    n_ids = 0
        if pieces:
            finish()
        names = ["part", "file", "path", "n_docs", "n_ids"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        columns = list(zip(*manifest, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    return staged_batches(map_batches(ordered, write, MANIFEST), "manifest")


class TokenFile:
    """One token file, opened for random access; local files are mapped, not read."""

    def __init__(self, filesystem: fs.FileSystem, path: str) -> None:
        local = isinstance(filesystem, fs.LocalFileSystem)
        opened = [
            pa.memory_map(p) if local else filesystem.open_input_file(p)
            for p in (path, f"{path}.index")
        ]
        self._batches = pa.ipc.open_file(opened[0])
        self.index = pa.ipc.open_file(opened[1]).read_all()
        self.length = self._batches.schema.field("ids").type.list_size

    def _flat(self, batch_no: int, column: str) -> pa.Array:
        return self._batches.get_batch(batch_no).column(column).flatten()

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, a view of the file, and mask of one sequence."""
        batch_no, place = divmod(number, BATCH_SEQUENCES)
        start = place * self.length
        ids = self._flat(batch_no, "ids").slice(start, self.length)
        mask = self._flat(batch_no, "mask").slice(start, self.length)
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def span(self, start: int, n_ids: int) -> Iterator[np.ndarray]:
        """Views that together hold the ids from `start` on."""
        step = self.length * BATCH_SEQUENCES
        while n_ids:
            batch_no, place = divmod(start, step)
            view = self._flat(batch_no, "ids").slice(place, n_ids).to_numpy()
            yield view
            start, n_ids = start + len(view), n_ids - len(view)


def read_token_files(manifest: DataFrame, folder: str, doc_id_type: T.DataType) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    The manifest has one row per file; the ids before each file are summed over it.
    """
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first")
    files = manifest.select("path", offsets)
    tasks = max(1, min(files.count(), 100_000))
    schema = T.StructType([
        T.StructField("doc_id", doc_id_type), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = open_folder(folder)
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(filesystem, path)
                starts = file.index.column("start").to_numpy()
                sizes = file.index.column("n_tokens").to_numpy()
                sums = []
                for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
                    crc = 0
                    for view in file.span(start, size):
                        crc = zlib.crc32(view.astype("<u4"), crc)
                    sums.append(crc)
                yield pa.RecordBatch.from_arrays(
                    [file.index.column("doc_id").combine_chunks(), pa.array(starts + first),
                     pa.array(sizes), pa.array(sums, pa.int64())],
                    names=schema.names,
                )

    return map_batches(files.repartition(tasks), read, schema)
