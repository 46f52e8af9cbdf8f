"""Tables in versions: readers see a whole version or the one before, never half of a write.

Below a root folder:

    data/<table>/<run>/part-*.parquet   rows; a file is written once and never changed
    manifests/<run>/                    (table, run, file, n_rows): the files of one version
    commits/<version>.json              one line that names the manifest and the tables' schemas

A version exists from the moment its commit file does. The file is created only if there is none
under that number, so of two writers that started from one version the second fails and changes
nothing. Files that no version names, left by a job that was ended, are never read.

On a store that cannot create a file exclusively, run one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "table string, run string, file string, n_rows bigint"
COMMITS = "version bigint, manifest string, schemas map<string,string>"


# A merge rewrites whole files, so large ones would make it write much that did not change.
ROWS_PER_FILE = 1_000_000


class ConflictError(RuntimeError):
    """Another writer made a version after the one this write started from."""


@dataclass(frozen=True)
class DataFile:
    """One file of rows, as a manifest names it."""

    table: str
    run: str
    file: str
    n_rows: int


@dataclass(frozen=True)
class Version:
    """One readable version: its number, its manifest's run and the schema of each table."""

    number: int
    manifest: str
    schemas: dict[str, str]


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path, store = _path(spark, path)
    return store.exists(jvm_path)


def _create(spark: SparkSession, path: str, text: str) -> None:
    jvm_path, store = _path(spark, path)
    if store.exists(jvm_path):
        raise ConflictError(f"{path} exists already")
    try:
        out = store.create(jvm_path, False)
    except Exception as error:
        raise ConflictError(f"{path} could not be created") from error
    out.write(bytearray(text.encode()))
    out.close()


def find_version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The latest version, or the one asked for; None if there is none.

    A commit file that was not written to its end is no commit.
    """
    if not _exists(spark, f"{root}/commits"):
        return None
    commits = spark.read.schema(COMMITS).option("mode", "DROPMALFORMED").json(f"{root}/commits")
    if number is not None:
        commits = commits.where(F.col("version") == number)
    found = commits.where("manifest IS NOT NULL").orderBy(F.col("version").desc()).first()
    return found and Version(found["version"], found["manifest"], found["schemas"])


def files_of(spark: SparkSession, root: str, version: Version) -> list[DataFile]:
    """The files of a version; a driver that plans a scan holds their names in any case."""
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{version.manifest}").collect()
    return [DataFile(**row.asDict()) for row in rows]


def read_files(
    spark: SparkSession, root: str, version: Version, table: str, files: Sequence[DataFile]
) -> DataFrame:
    """Rows of one table from those of the given files that are its own."""
    schema = T.StructType.fromJson(json.loads(version.schemas[table]))
    paths = [f"{root}/data/{table}/{f.run}/{f.file}" for f in files if f.table == table]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(
    spark: SparkSession, root: str, number: int | None = None, names: tuple[str, ...] | None = None
) -> dict[str, DataFrame]:
    """The tables of the latest version, or of an earlier one."""
    version = find_version(spark, root, number)
    if version is None:
        raise ValueError(f"{root} holds no version" + ("" if number is None else f" {number}"))
    files = files_of(spark, root, version)
    return {name: read_files(spark, root, version, name, files) for name in names or sorted(version.schemas)}


def write_files(df: DataFrame, root: str, table: str) -> list[DataFile]:
    """Write rows as new files of `ROWS_PER_FILE` rows at most; empty files are not named."""
    run = uuid.uuid4().hex
    folder = f"{root}/data/{table}/{run}"
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    counted = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n_rows"))
    return [DataFile(table, run, row["file"], row["n_rows"]) for row in counted.collect()]


def commit(
    spark: SparkSession,
    root: str,
    files: Sequence[DataFile],
    schemas: Mapping[str, T.StructType],
    after: Version | None,
) -> Version:
    """Make the given files the version that follows `after`, or the first one."""
    run = uuid.uuid4().hex
    rows = spark.createDataFrame([astuple(f) for f in files], MANIFEST)
    rows.coalesce(1).write.parquet(f"{root}/manifests/{run}")
    number = after.number + 1 if after else 1
    version = Version(number, run, {name: schema.json() for name, schema in schemas.items()})
    line = {"version": number, "manifest": run, "schemas": version.schemas}
    _create(spark, f"{root}/commits/{number:012d}.json", json.dumps(line) + "\n")
    return version
